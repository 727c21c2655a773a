"""One row per game, seen from the player."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plyframe.functions import text as tx
from plyframe.functions import timing as tm
from plyframe.operators.attacks import with_mating_pieces
from plyframe.operators.perspective import both_sides, outcome, outcome_reason


def moves_text(extract: Column) -> Column:
    return F.coalesce(tx.list_text(extract), F.lit(""))


def game_link(extract: Column, color: Column) -> Column:
    """Analysis link of a game, from its numbered moves and the player's colour."""
    return tx.analysis_url(moves_text(extract), color)


def describe_games(staged: DataFrame, username: str | Column) -> DataFrame:
    """Everything that needs only the game's own row: no shuffle.

    ``username`` is the player of interest as written in lower case, or a column naming
    that player per row when archives of many players are loaded together.  Where the
    White player's name differs, the player counts as Black.
    """
    player = F.lit(username) if isinstance(username, str) else username
    c = F.col
    base = tx.time_control_base(c("time_class"), c("time_control"))
    is_white = F.coalesce(F.lower("white__username") == player, F.lit(False))
    color = F.when(is_white, "White").otherwise("Black")
    sides = both_sides(is_white, "white__", "black__", {"rating": "rating", "result": "result"})
    own, other = sides["player_result"], sides["opponent_result"]
    moves = tx.move_block(c("pgn"))
    extract = tx.all_matches(moves, tx.NUMBERED_MOVE)
    eco_url = tx.header(c("pgn"), "ECOUrl")
    start_date = tm.dotted_date(tx.header(c("pgn"), "UTCDate"))
    start_time = tx.header(c("pgn"), "StartTime")
    start, end = tm.timestamp_from(start_date, start_time), c("end_time")
    # One projection over shared expressions: the optimizer computes each of them once,
    # and no intermediate row is built.
    return staged.withColumns(
        {
            "time_control_base": base,
            "time_control_add_seconds": tx.time_control_increment(c("time_class"), c("time_control")),
            "game_mode": tx.game_mode(c("time_class"), c("time_control"), base),
            "player_color": color,
            **sides,
            "is_stronger_opponent": sides["opponent_rating"] > sides["player_rating"],
            "player_wdl": outcome(own, other),
            "player_wdl_reason": outcome_reason(own, other),
            "pgn_header": tx.header_block(c("pgn")),
            "pgn_moves": moves,
            "pgn_move_extract": extract,
            "pgn_clock_extract": tx.all_matches(moves, tx.CLOCK_NOTE),
            "pgn_move_extract_string": moves_text(extract),
            "game_analysis_url": game_link(extract, color),
            "eco": tx.header(c("pgn"), "ECO"),
            "eco_url": eco_url,
            "eco_name": F.replace(eco_url, F.lit(tx.OPENING_SITE), F.lit("")),
            "game_start_date": start_date,
            "game_start_time": start_time,
            "game_start_timestamp": start,
            "game_end_timestamp": end,
            "time_played_interval": end - start,
            "time_played_seconds": tm.calendar_age(end, start).total_seconds(),
        }
    )


# Columns the per-game table adds to staging, in order.
ADDED = [
    "time_control_base",
    "time_control_add_seconds",
    "game_mode",
    "player_color",
    "player_rating",
    "player_result",
    "opponent_rating",
    "opponent_result",
    "is_stronger_opponent",
    "player_wdl",
    "player_wdl_reason",
    "pgn_header",
    "pgn_moves",
    "pgn_move_extract",
    "pgn_clock_extract",
    "pgn_move_extract_string",
    "game_analysis_url",
    "eco",
    "eco_url",
    "eco_name",
    "game_start_date",
    "game_start_time",
    "game_start_timestamp",
    "game_end_timestamp",
    "time_played_interval",
    "time_played_seconds",
    "checkmate_pieces",
]


def prepare_games(staged: DataFrame, username: str | Column, partitions: int | None = None) -> DataFrame:
    """The per-game table.

    The mating pieces join back by ``game_uuid``.  With ``partitions`` the staged rows are hashed
    by that key first, before the derived texts and lists widen them; the join, a bucketed write
    and all later steps keep that layout.
    """
    if partitions:
        staged = staged.repartition(partitions, "game_uuid")
    games = describe_games(staged, username)
    return with_mating_pieces(games, ["game_uuid"]).select(*staged.columns, *ADDED)

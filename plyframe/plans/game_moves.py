"""One row per move."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plyframe.functions.numbers import round_to
from plyframe.functions.positions import lost_letter, phase_ladder, piece_counts
from plyframe.functions.text import joined, list_text, move_tokens, part
from plyframe.functions.timing import clocks_seconds

GAME = "game_uuid"
FACTS = ["rules", "time_class", "time_control_base", "time_control_add_seconds", "player_color"]

# Columns of the move table, in order.
COLUMNS = [
    "id",
    GAME,
    *FACTS,
    "game_move_index",
    "pgn_header",
    "pgn_cum_move",
    "color_move",
    "color_move_index",
    "game_move",
    "captured_piece",
    "clock_interval_move",
    "clock_interval_post_move",
    "prev_clock_interval",
    "move_time_seconds",
    "fen",
    "major_minor_cnt",
    "black_major_minor",
    "white_major_minor",
    "is_backrank_sparse",
    "is_midgame",
    "is_endgame",
    "game_phase",
]


def explode_moves(games: DataFrame, partitions: int | None = None) -> DataFrame:
    """Pair each game's moves with its clock notes; the shorter list is padded.

    ``partitions`` hashes games that are not bucketed before they expand, so the shuffle
    carries each move text once; bucketed games keep their layout.
    """
    texts = games.select(GAME, *FACTS, "pgn_header", "pgn_moves", F.col("pgn_clock_extract").alias("clocks"))
    if partitions:
        texts = texts.repartition(partitions, GAME)
    lists = texts.withColumns({"moves": move_tokens(F.col("pgn_moves")), "clocks": clocks_seconds(F.col("clocks"))})
    noted = lists.withColumn("numbered", F.transform(F.arrays_zip("moves", "clocks"), lambda pair, place: _numbered(pair["moves"], place, F.size("moves"))))
    paired = noted.select(
        GAME,
        *FACTS,
        "pgn_header",
        "clocks",
        "numbered",
        F.size("moves").alias("played"),
        F.posexplode(F.arrays_zip("moves", "clocks")).alias("place", "pair"),
    )
    place, played = F.col("place"), F.col("played")
    is_move = place < played
    # The same side moved two places before; beyond the last move, notes follow each other.
    former = F.when(is_move, place - 2).otherwise(F.when(place > played, place - 1))
    upto = F.when(is_move, place + 1).otherwise(F.size("numbered"))
    return paired.select(
        GAME,
        *FACTS,
        "pgn_header",
        F.when(is_move, (place + 1).cast("long")).alias("game_move_index"),
        F.col("pair.moves").alias("game_move"),
        F.when(is_move, F.when(place % 2 == 0, "White").otherwise("Black")).alias("color_move"),
        _index(place, played).cast("long").alias("color_move_index"),
        F.col("pair.clocks").alias("clock_interval_post_move"),
        F.when(former >= 0, F.get("clocks", former)).alias("former_clock"),
        list_text(F.slice("numbered", F.lit(1), upto)).alias("pgn_cum_move"),
    )


def _index(place: Column, played: Column) -> Column:
    """Number of a move among its side's, or of a note beyond the last move among those."""
    return F.when(place < played, F.floor(place / 2) + 1).otherwise(place - played + 1)


def _numbered(move: Column, place: Column, played: Column) -> Column:
    dots = F.when((place < played) & (place % 2 == 0), ". ").otherwise("... ")
    return joined(_index(place, played).cast("string"), dots, move)


def with_positions(moves: DataFrame, positions: DataFrame | None) -> DataFrame:
    """``fen`` after each move from a table (game_uuid, game_move_index, fen); NULL without one."""
    if positions is None:
        return moves.withColumn("fen", F.lit(None).cast("string"))
    return moves.join(positions.select(GAME, "game_move_index", "fen"), [GAME, "game_move_index"], "left")


def time_moves(moves: DataFrame) -> DataFrame:
    """Clock accounting per move; in daily games a move takes no time."""
    daily = F.col("time_class") == "daily"
    before = F.coalesce("former_clock", F.col("time_control_base").cast("double"))
    spent = F.col("prev_clock_interval") - F.col("clock_interval_move")
    return moves.withColumns(
        {
            "clock_interval_move": F.col("clock_interval_post_move")
            - F.col("time_control_add_seconds"),
            "prev_clock_interval": F.when(daily, F.lit(0.0)).otherwise(before),
        }
    ).withColumn("move_time_seconds", round_to(F.when(daily, F.lit(0.0)).otherwise(spent), 1))


def follow_board(moves: DataFrame, given: bool = True) -> DataFrame:
    """Captured piece and phase of the game after each move; no board is followed where no positions are ``given``."""
    by_game = Window.partitionBy(GAME).orderBy(F.asc_nulls_last("game_move_index"))
    none, board = F.lit(None).cast("string"), F.col("board")
    pawns = F.length(board) - F.length(F.replace(F.replace(board, F.lit("P"), F.lit("")), F.lit("p"), F.lit("")))
    # A letter can only be lost when the pieces or the pawns became fewer.
    changed = (F.col("men") != F.col("prev_men")) | (F.col("prev_board") == "")
    boards = moves.withColumn("id", F.concat(GAME, F.lit("_"), F.col("game_move_index").cast("string"))).withColumn(
        "board", part(F.col("fen"), " ", 1)
    ).withColumns(piece_counts(F.col("fen")))
    if given:
        boards = boards.withColumn("men", F.struct(F.col("major_minor_cnt"), pawns)).withColumns(
            {"prev_board": F.coalesce(F.lag("board").over(by_game), F.lit("")), "prev_men": F.lag("men").over(by_game)}
        )
    return boards.withColumns(
        {
            "captured_piece": F.when(changed, lost_letter(F.col("prev_board"), board)) if given else none,
            **phase_ladder(F.col("major_minor_cnt"), F.col("black_major_minor"), F.col("white_major_minor")),
        }
    )


def prepare_moves(
    games: DataFrame, partitions: int | None = None, positions: DataFrame | None = None
) -> DataFrame:
    """The per-move table.

    A game is one input row: numbers, former clocks and running text are taken from its own lists as it expands, so moves
    are neither shuffled nor sorted.  The columns about the board (``fen``, counts, phase, captures) are
    filled from ``positions`` if it is given, by windows inside a game, else NULL.
    """
    moves = with_positions(time_moves(explode_moves(games, partitions)), positions)
    return follow_board(moves, positions is not None).select(*COLUMNS)

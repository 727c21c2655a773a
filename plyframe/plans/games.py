"""The wide mart: one row per game with its totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plyframe.functions.numbers import binned
from plyframe.functions.positions import phase_ladder, piece_counts
from plyframe.operators.aggregates import pivot_columns
from plyframe.operators.perspective import both_sides

GAME = "game_uuid"
COLORS = ["White", "Black"]

# Columns of the mart, in order.
COLUMNS = [
    GAME,
    "url", "rated", "rules", "time_class", "game_mode", "game_analysis_url",
    "time_control", "time_control_base", "time_control_add_seconds", "time_played_seconds",
    "game_start_date", "game_start_time", "game_start_timestamp", "game_end_timestamp",
    "white__uuid", "white__username", "white__aid", "white__rating", "white__result",
    "white_total_move_time", "white_num_moves",
    "black__uuid", "black__username", "black__aid", "black__rating", "black__result",
    "black_total_move_time", "black_num_moves",
    "player_color", "player_rating", "player_result", "player_total_move_time", "player_num_moves",
    "opponent_rating", "opponent_result", "opponent_total_move_time", "opponent_num_moves",
    "is_stronger_opponent", "player_wdl", "player_wdl_reason", "initial_setup",
    "fen", "pgn", "pgn_moves", "pgn_move_extract", "pgn_clock_extract",
    "eco", "eco_url", "eco_name", "checkmate_pieces", "ended_game_phase", "tcn",
    "accuracies__white", "accuracies__black", "opponent_rating_bin",
]


def game_totals(moves: DataFrame) -> DataFrame:
    """Time and moves per colour: one pass, one group."""
    return moves.groupBy(GAME).agg(
        *pivot_columns(
            F.col("color_move"), COLORS, F.col("move_time_seconds"), "total_move_time", "num_moves"
        ),
    )


def build_games(games: DataFrame, moves: DataFrame) -> DataFrame:
    """Attach the totals to the games and swap them to the player's view.

    The phase a game ended in is that of the record's own final position.

    Both inputs bucketed by ``game_uuid`` join without a shuffle; otherwise the totals,
    already one small row per game, are what makes the join cheap to hash.
    """
    fields = {"total_move_time": "total_move_time", "num_moves": "num_moves"}
    is_white = F.col("player_color") == "White"
    ended = phase_ladder(*piece_counts(F.col("fen")).values())["game_phase"]
    return (
        games.join(game_totals(moves).hint("shuffle_hash"), GAME, "left")
        .withColumns(
            {
                **both_sides(is_white, "white_", "black_", fields),
                "ended_game_phase": ended,
                "opponent_rating_bin": binned(F.col("opponent_rating"), 100),
            }
        )
        .select(*COLUMNS)
    )

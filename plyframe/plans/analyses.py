"""Questions asked of the mart; each takes the (filtered) mart and returns a small table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plyframe.functions.text import prefix_text
from plyframe.functions.timing import WEEKDAYS, duration_text, in_zone, weekday_name, weekday_number
from plyframe.operators.aggregates import (
    counts,
    grand_total,
    last_value,
    percent_where,
    ratio,
    share_of_total,
    share_within,
)
from plyframe.operators.ranking import (
    distinct_sorted,
    numbered_top_rows,
    place_in,
    sample_rows,
    top_dense_ranks,
    top_rows,
)

PHASES = ["Opening", "Midgame", "Endgame"]
DISPLAY_WEEK = [*WEEKDAYS[1:], WEEKDAYS[0]]
BOTH_COLORS = ["White", "Black"]


def colors_for(choice: str) -> list[str]:
    """``All`` stands for both colours."""
    return BOTH_COLORS if choice == "All" else [choice]


def filter_options(games: DataFrame) -> dict[str, DataFrame]:
    """Values to choose from, per filter."""
    return {c: distinct_sorted(games, c) for c in ("rules", "time_class", "player_color")}


def date_bounds(games: DataFrame, time_class: str, colors: list[str]) -> DataFrame:
    return games.filter(
        (F.col("time_class") == time_class) & F.col("player_color").isin(colors)
    ).agg(F.min("game_start_date").alias("first_date"), F.max("game_start_date").alias("last_date"))


def select_games(
    games: DataFrame, rules: str, time_class: str, colors: list[str], first: date, last: date
) -> DataFrame:
    """The base filter under every analysis; all of it reaches the scan."""
    return games.filter(
        (F.col("rules") == rules)
        & (F.col("time_class") == time_class)
        & F.col("player_color").isin(colors)
        & F.col("game_start_date").between(F.lit(first), F.lit(last))
    )


def key_figures(games: DataFrame, time_class: str) -> DataFrame:
    """Games, share won, best rating, moves and time spent, in one pass."""
    figures = games.agg(
        F.count(F.lit(1)).alias("num_games"),
        ratio(F.col("player_wdl") == "win").alias("win_perc"),
        F.max("player_rating").alias("highest_rating"),
        F.sum("player_num_moves").alias("num_moves"),
        F.sum("player_total_move_time").alias("total_seconds"),
    )
    spent = F.lit("NA") if time_class == "daily" else duration_text(F.round("total_seconds", 3))
    return figures.withColumn("total_move_time", spent)


def daily_rating(games: DataFrame) -> DataFrame:
    """Rating after the last game of each day, and games that day."""
    latest = F.struct("game_start_timestamp", "game_uuid")
    return games.groupBy("game_start_date").agg(
        last_value(F.col("player_rating"), latest).alias("player_rating"),
        F.count(F.lit(1)).alias("num_games"),
    )


def outcome_share(games: DataFrame) -> DataFrame:
    return share_of_total(games, ["player_wdl"])


def outcome_reason_share(games: DataFrame) -> DataFrame:
    return share_of_total(games, ["player_wdl", "player_wdl_reason"])


def outcome_reason_stack(games: DataFrame) -> DataFrame:
    """Reasons as parts of their outcome."""
    return share_within(games, ["player_wdl"], ["player_wdl_reason"])


def in_local_time(games: DataFrame, zone: str) -> DataFrame:
    local = in_zone(F.col("game_start_timestamp"), zone)
    day = weekday_number(local)
    return games.withColumns(
        {
            "ts_hour": F.hour(local),
            "ts_day_of_week": day,
            "ts_day_of_week_name": weekday_name(day),
        }
    )


def in_display_order(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    return df.orderBy(place_in(values, F.col(column)))


def games_by_weekday(games: DataFrame, zone: str) -> DataFrame:
    return counts(in_local_time(games, zone), ["ts_day_of_week_name"])


def outcomes_by_weekday(games: DataFrame, zone: str) -> DataFrame:
    return share_within(in_local_time(games, zone), ["ts_day_of_week_name"], ["player_wdl"])


def games_by_hour(games: DataFrame, zone: str) -> DataFrame:
    return counts(in_local_time(games, zone), ["ts_hour"])


def outcomes_by_hour(games: DataFrame, zone: str) -> DataFrame:
    return share_within(in_local_time(games, zone), ["ts_hour"], ["player_wdl"])


def win_rate_by_weekday_hour(games: DataFrame, zone: str) -> DataFrame:
    return (
        in_local_time(games, zone)
        .groupBy("ts_day_of_week_name", "ts_hour")
        .agg(
            percent_where(F.col("player_wdl") == "win").alias("perc"),
            F.count(F.lit(1)).alias("num_games"),
        )
    )


def mating_combinations(games: DataFrame, wdl: str | None = None) -> DataFrame:
    """Sets of mating pieces by outcome, most frequent first."""
    mated = games.filter(F.col("player_wdl_reason") == "checkmated")
    if wdl is not None:
        mated = mated.filter(F.col("player_wdl") == wdl)
    return counts(mated, ["player_wdl", "checkmate_pieces"]).orderBy(
        F.asc_nulls_last("player_wdl"), F.desc("num_games"), "checkmate_pieces"
    )


def end_phases(games: DataFrame) -> DataFrame:
    """Phase a game ended in, by outcome, beside the number of all games."""
    grouped = counts(games, ["ended_game_phase", "player_wdl"])
    return grouped.withColumn("total_games", grand_total(grouped))


def games_by_end_phase(phases: DataFrame) -> DataFrame:
    """Second step on :func:`end_phases`: outcomes summed up."""
    return phases.groupBy("ended_game_phase").agg(F.sum("num_games").alias("num_games"))


def outcomes_by_end_phase(games: DataFrame) -> DataFrame:
    return share_within(games, ["ended_game_phase"], ["player_wdl"])


def starting_moves(count: int) -> Column:
    return prefix_text(F.col("pgn_move_extract"), count)


def top_openings(games: DataFrame, count: int = 5, places: int = 5) -> DataFrame:
    """Most played first moves per colour, split by outcome.

    Openings with equal totals share a place, so more than ``places`` of them may stay.
    """
    grouped = counts(
        games.filter(F.size("pgn_move_extract") > 0).select(
            "player_color", "player_wdl", starting_moves(count).alias("starting_moves")
        ),
        ["player_color", "player_wdl", "starting_moves"],
        "wdl_num_games",
    )
    per_opening = Window.partitionBy("player_color", "starting_moves")
    totals = grouped.withColumn("num_games", F.sum("wdl_num_games").over(per_opening))
    return top_dense_ranks(totals, ["player_color"], "num_games", places, "rn").withColumn(
        "perc", F.lit(100.0) * F.col("wdl_num_games") / F.col("num_games")
    )


def best_openings(
    openings: DataFrame, color: str, wdl: str, places: int = 3, alias: str | None = None
) -> DataFrame:
    """Of the top openings, those most often ending in ``wdl`` for ``color``."""
    chosen = openings.filter((F.col("player_color") == color) & (F.col("player_wdl") == wdl))
    return numbered_top_rows(
        chosen, places, alias or f"{wdl}_order", F.desc("perc"), F.asc("starting_moves")
    )


def games_of_opening(
    games: DataFrame, opening: str, count: int, color: str, wdl: str
) -> DataFrame:
    """Drill-through: games of one colour and outcome that begin with ``opening``."""
    return games.filter(
        (F.col("player_color") == color)
        & (F.col("player_wdl") == wdl)
        & (starting_moves(count) == opening)
    ).select("game_analysis_url")


def sample_games_of_opening(
    games: DataFrame, opening: str, count: int, color: str, wdl: str, size: int = 5, seed: int = 0
) -> DataFrame:
    return sample_rows(games_of_opening(games, opening, count, color, wdl), size, "game_analysis_url", seed)


def latest_games(games: DataFrame, count: int = 20) -> DataFrame:
    return top_rows(
        games, count, F.desc_nulls_last("game_start_timestamp"), F.asc("game_uuid")
    ).select(
        "white__username",
        "black__username",
        "player_color",
        "player_wdl",
        "player_wdl_reason",
        "opponent_rating",
        "game_analysis_url",
    )

"""A cube of the mart: mergeable states, from which changing filters are answered without the mart.

A cell is one quarter of an hour of one kind of game: rules, time class, colour, outcome, reason and the phase it ended in.
Its states merge by sum or maximum, so any filter and any coarser group re-aggregates cells.  Quarters of hours are whole in every
time zone of today, hence local weekdays and hours come from the cells too.  The number of cells is bounded by the calendar
and the kinds, whatever the number of games.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plyframe.functions.timing import duration_text
from plyframe.operators.aggregates import counts, grand_total, share_of_total, share_within
from plyframe.operators.ranking import distinct_sorted
from plyframe.plans import analyses as an

KEYS = ["rules", "time_class", "player_color", "game_start_date", "slot", "player_wdl", "player_wdl_reason", "ended_game_phase"]
GAMES = "num_games"
SECONDS = "decimal(30,3)"  # exact, so that the order of sums does not matter


def build_cube(mart: DataFrame) -> DataFrame:
    """One pass, one group, combined before the shuffle; cells of a time class and a range of days adjoin."""
    rated = F.when(F.col("player_rating").isNotNull(), F.struct("game_start_timestamp", "game_uuid"))
    latest = F.max(F.struct(rated.alias("at"), F.col("player_rating").alias("rating")))
    start = F.col("game_start_timestamp")
    past = F.make_dt_interval(F.lit(0), F.lit(0), F.minute(start) % 15, F.extract(F.lit("SECOND"), start))
    slot = start - past
    return mart.withColumn("slot", slot).groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias(GAMES),
        F.sum("player_num_moves").alias("num_moves"),
        F.sum(F.col("player_total_move_time").cast(SECONDS)).alias("total_seconds"),
        F.max("player_rating").alias("highest_rating"),
        latest.alias("latest"),
    )


def write_cube(mart: DataFrame, path: str) -> None:
    """Partitioned by time class and sorted by day, so that the base filter prunes folders and row groups."""
    cells = build_cube(mart).repartitionByRange("time_class", "game_start_date").sortWithinPartitions("game_start_date")
    cells.write.mode("overwrite").partitionBy("time_class").parquet(path)


def select_cells(cube: DataFrame, rules: str, time_class: str, colors: list[str], first: date, last: date) -> DataFrame:
    return an.select_games(cube, rules, time_class, colors, first, last)


def filter_options(cube: DataFrame) -> dict[str, DataFrame]:
    return {c: distinct_sorted(cube, c) for c in ("rules", "time_class", "player_color")}


def date_bounds(cube: DataFrame, time_class: str, colors: list[str]) -> DataFrame:
    return an.date_bounds(cube, time_class, colors)


def key_figures(cells: DataFrame, time_class: str) -> DataFrame:
    won = F.sum(F.when(F.col("player_wdl") == "win", F.col(GAMES)).otherwise(0))
    figures = cells.agg(
        F.coalesce(F.sum(GAMES), F.lit(0).cast("long")).alias(GAMES),
        F.try_divide(won, F.sum(GAMES)).alias("win_perc"),
        F.max("highest_rating").alias("highest_rating"),
        F.sum("num_moves").alias("num_moves"),
        F.sum("total_seconds").cast("double").alias("total_seconds"),
    )
    spent = F.lit("NA") if time_class == "daily" else duration_text(F.round("total_seconds", 3))
    return figures.withColumn("total_move_time", spent)


def daily_rating(cells: DataFrame) -> DataFrame:
    """The latest state of a day is the greatest of its cells' latest states."""
    day = cells.groupBy("game_start_date").agg(F.max("latest").alias("latest"), F.sum(GAMES).alias(GAMES))
    return day.select("game_start_date", F.col("latest.rating").alias("player_rating"), GAMES)


def outcome_share(cells: DataFrame) -> DataFrame:
    return share_of_total(cells, ["player_wdl"], weight=GAMES)


def outcome_reason_share(cells: DataFrame) -> DataFrame:
    return share_of_total(cells, ["player_wdl", "player_wdl_reason"], weight=GAMES)


def outcome_reason_stack(cells: DataFrame) -> DataFrame:
    return share_within(cells, ["player_wdl"], ["player_wdl_reason"], weight=GAMES)


def in_local_time(cells: DataFrame, zone: str) -> DataFrame:
    return an.in_local_time(cells.withColumnRenamed("slot", "game_start_timestamp"), zone)


def games_by_weekday(cells: DataFrame, zone: str) -> DataFrame:
    return counts(in_local_time(cells, zone), ["ts_day_of_week_name"], weight=GAMES)


def games_by_hour(cells: DataFrame, zone: str) -> DataFrame:
    return counts(in_local_time(cells, zone), ["ts_hour"], weight=GAMES)


def outcomes_by_weekday(cells: DataFrame, zone: str) -> DataFrame:
    return share_within(in_local_time(cells, zone), ["ts_day_of_week_name"], ["player_wdl"], weight=GAMES)


def outcomes_by_hour(cells: DataFrame, zone: str) -> DataFrame:
    return share_within(in_local_time(cells, zone), ["ts_hour"], ["player_wdl"], weight=GAMES)


def win_rate_by_weekday_hour(cells: DataFrame, zone: str) -> DataFrame:
    won = F.sum(F.when(F.col("player_wdl") == "win", F.col(GAMES)).otherwise(0))
    grouped = in_local_time(cells, zone).groupBy("ts_day_of_week_name", "ts_hour")
    return grouped.agg((F.lit(100.0) * won / F.sum(GAMES)).alias("perc"), F.sum(GAMES).alias(GAMES))


def end_phases(cells: DataFrame) -> DataFrame:
    grouped = counts(cells, ["ended_game_phase", "player_wdl"], weight=GAMES)
    return grouped.withColumn("total_games", grand_total(grouped))


def outcomes_by_end_phase(cells: DataFrame) -> DataFrame:
    return share_within(cells, ["ended_game_phase"], ["player_wdl"], weight=GAMES)

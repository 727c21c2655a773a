"""Data checks; each returns the offending rows or counts, empty when all is well."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row (column_name, nulls) per column with NULLs; one pass for all columns."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in columns])
    )
    return counted.select(pairs.alias("p")).select("p.*").filter("nulls > 0")


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once (NULL keys are another check's matter)."""
    present = df.select(*keys).dropna(subset=list(keys))
    return present.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def unaccepted(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the accepted list and how often they occur; NULL passes."""
    return (
        df.filter(~F.col(column).isin(*values))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )


def violations(df: DataFrame, broken: Column, *show: str) -> DataFrame:
    """Rows for which a rule is broken."""
    return df.filter(broken).select(*show)


def unexplained_mates(games: DataFrame) -> DataFrame:
    """Games flagged as mated without mating pieces."""
    flagged = (F.col("player_result") == "checkmated") | (F.col("opponent_result") == "checkmated")
    return violations(games, flagged & (F.size("checkmate_pieces") == 0), "game_uuid")


def unexpected_mates(games: DataFrame) -> DataFrame:
    """Games not flagged as mated that have mating pieces."""
    plain = (F.col("player_result") != "checkmated") & (F.col("opponent_result") != "checkmated")
    return violations(games, plain & (F.size("checkmate_pieces") > 0), "game_uuid")


def negative_share(df: DataFrame, column: str, threshold: float) -> DataFrame:
    """One row (neg_time, num_rows, perc) if more than ``threshold`` % of values are negative."""
    negative = F.count_if(F.col(column) < 0)
    rows = F.count(F.lit(1))
    return df.agg(
        negative.alias("neg_time"), rows.alias("num_rows"), (F.try_divide(negative, rows) * 100.0).alias("perc")
    ).filter(F.col("perc") > threshold)


class CheckFailed(AssertionError):
    """A data check found offending rows."""


def require_empty(name: str, offending: DataFrame) -> None:
    """Fail with up to five examples if a check returned rows."""
    examples = offending.limit(5).collect()
    if examples:
        raise CheckFailed(f"{name}: {examples}")

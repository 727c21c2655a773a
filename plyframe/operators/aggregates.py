"""Aggregates: pivots, last values, ratios and shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot_columns(on: Column, values: list[str], total: Column, total_name: str, count_name: str) -> list[Column]:
    """Sum and count per pivot value, as aggregates of one ``groupBy``.

    Named ``<value>_<name>`` in lower case; a value that never occurs counts 0 and sums
    to NULL.  Being plain aggregates they combine map-side and share a pass with others.
    """
    columns = []
    for value in values:
        columns.append(F.sum(F.when(on == value, total)).alias(f"{value.lower()}_{total_name}"))
        columns.append(F.count_if(on == value).alias(f"{value.lower()}_{count_name}"))
    return columns


def last_value(value: Column, order: Column) -> Column:
    """Value at the greatest ``order``, among rows where both are known."""
    return F.max_by(value, F.when(value.isNotNull(), order))


def ratio(condition: Column) -> Column:
    """Part of all rows where ``condition`` holds; NULL on no rows."""
    hits = F.sum(F.when(condition, 1).otherwise(0))
    return hits / F.count(F.lit(1))


def percent_where(condition: Column) -> Column:
    return F.lit(100.0) * F.count_if(condition) / F.count(F.lit(1))


def counts(df: DataFrame, by: list[str], alias: str = "num_games", weight: str | None = None) -> DataFrame:
    """Rows per group; the sum of ``weight`` where a row stands for several."""
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(*by).agg(rows.alias(alias))


def grand_total(grouped: DataFrame, count: str = "num_games") -> Column:
    """Total of an aggregated table as a one-row subquery (no unpartitioned window)."""
    return grouped.select(F.sum(count)).scalar()


def share_of_total(
    df: DataFrame, by: list[str], alias: str = "num_games", share: str = "win_perc", weight: str | None = None
) -> DataFrame:
    """Rows per group and their percentage of all rows."""
    grouped = counts(df, by, alias, weight)
    return grouped.withColumn(share, F.lit(100.0) * F.col(alias) / grand_total(grouped, alias))


def share_within(
    df: DataFrame, within: list[str], by: list[str], alias: str = "num_games", share: str = "share", weight: str | None = None
) -> DataFrame:
    """Rows per group and their part of the rows that agree on ``within`` (a full stack)."""
    grouped = counts(df, [*within, *by], alias, weight)
    totals = grouped.groupBy(*within).agg(F.sum(alias).alias("__total"))
    condition = F.lit(True)
    for key in within:
        totals = totals.withColumnRenamed(key, f"__{key}")
        condition = condition & grouped[key].eqNullSafe(F.col(f"__{key}"))
    return grouped.join(totals, condition).select(
        *within, *by, alias, (F.col(alias) / F.col("__total")).alias(share)
    )

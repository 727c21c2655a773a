"""Sorts, top-n, ranks and samples."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """Distinct values, NULL last."""
    return df.select(column).distinct().orderBy(F.asc_nulls_last(column))


def top_rows(df: DataFrame, count: int, *order: Column) -> DataFrame:
    """The first ``count`` rows; a heap per task, no full sort."""
    return df.orderBy(*order).limit(count)


def numbered_top_rows(df: DataFrame, count: int, alias: str, *order: Column) -> DataFrame:
    """The first ``count`` rows with their place; the window sees only those rows."""
    return top_rows(df, count, *order).withColumn(
        alias, F.row_number().over(Window.orderBy(*order))
    )


def top_dense_ranks(
    df: DataFrame, within: list[str], measure: str, places: int, alias: str
) -> DataFrame:
    """Rows whose ``measure`` is among the ``places`` greatest distinct ones of their group.

    Ties share a place, so all of them stay.  The rank runs over the distinct measures
    only (duplicates fall away before the shuffle), and the surviving ``places`` values per
    group join back, so a group that holds most rows is not ranked row by row.  How that
    join runs is decided by the size the values turn out to have.
    """
    values = df.select(*within, measure).distinct()
    ranked = values.withColumn(
        alias, F.dense_rank().over(Window.partitionBy(*within).orderBy(F.desc_nulls_last(measure)))
    ).filter(F.col(alias) <= places)
    condition = F.lit(True)
    for key in [*within, measure]:
        ranked = ranked.withColumnRenamed(key, f"__{key}")
        condition = condition & df[key].eqNullSafe(F.col(f"__{key}"))
    return df.join(ranked, condition).drop(*[f"__{key}" for key in [*within, measure]])


def sample_rows(df: DataFrame, count: int, key: str, seed: int = 0) -> DataFrame:
    """A uniform sample of exactly ``count`` rows (all, if fewer), the same on every run.

    Rows are drawn in the order of a hash of ``key`` and ``seed``, so the sample does not
    depend on how the rows are laid out and any engine with md5 draws the same one.
    """
    drawn = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    return df.orderBy(drawn, key).limit(count)


def place_in(values: list[str], column: Column) -> Column:
    """Sort key of a fixed display order; unknown values last."""
    place = F.when(column == values[0], 0)
    for index, value in enumerate(values[1:], start=1):
        place = place.when(column == value, index)
    return place.otherwise(len(values))


def global_ranks(df: DataFrame, by: str, ties: list[Column], folder: str, descending: bool = True) -> DataFrame:
    """All rows with their ``place`` (row number), ``standing`` (rank) and ``level`` (dense rank) in the whole table.

    Equal values of column ``by`` share a standing, ``ties`` order them for the place; NULL comes last.  Together they must tell rows apart
    for the place to be the same on every run.  Rows are range-partitioned by both, so even rows that all tie are spread; a task
    numbers its own range.  What comes before a range is told by one small row per range: its number of rows, of different
    values, and its first and last value, which shows a tie that runs across the border.  The ranges are written once below
    ``folder``, so that numbers and offsets are taken from the same ones, also after executors were lost.
    """
    spark = df.sparkSession
    path = f"{folder}-{uuid.uuid4().hex}"
    order = F.desc_nulls_last(by) if descending else F.asc_nulls_last(by)
    ordered = df.repartitionByRange(order, *ties).withColumn("__range", F.spark_partition_id())
    ordered.write.parquet(path)
    ranges = spark.read.schema(ordered.schema).parquet(path)
    within = Window.partitionBy("__range")
    full = within.orderBy(order, *ties)
    numbered = ranges.withColumns(
        {
            "__row": F.row_number().over(full),
            "__rank": F.rank().over(within.orderBy(order)),
            "__dense": F.dense_rank().over(within.orderBy(order)),
        }
    )
    plain = F.col(by)
    sizes = ranges.groupBy("__range").agg(F.count(F.lit(1)).alias("rows"))
    edges = numbered.where(F.col("__row") == 1).select("__range", F.struct(plain.alias("v")).alias("first"))
    # The last row of a range has its greatest dense rank and the rank at which its value began.
    ends = numbered.groupBy("__range").agg(F.max_by(F.struct(F.struct(plain.alias("v")).alias("last"), "__rank", "__dense"), "__row").alias("end"))
    summary = sizes.join(edges, "__range").join(ends, "__range").orderBy("__range").collect()  # one row a range
    offsets, rows, level, last, standing = [], 0, 0, None, 0
    for r in summary:
        tied = last is not None and last == r["first"]
        offsets.append((r["__range"], rows, level - (1 if tied else 0), standing if tied else None))
        if not (tied and r["end"]["__dense"] == 1):  # else the tie goes on from before this range
            standing = rows + r["end"]["__rank"]
        level += r["end"]["__dense"] - (1 if tied else 0)
        rows += r["rows"]
        last = r["end"]["last"]
    before = spark.createDataFrame(offsets, "__range int, __before long, __levels long, __tied long")
    at_first = (F.col("__rank") == 1) & F.col("__tied").isNotNull()
    return numbered.join(F.broadcast(before), "__range").select(  # one row a range
        *df.columns,
        (F.col("__row") + F.col("__before")).alias("place"),
        F.when(at_first, F.col("__tied")).otherwise(F.col("__rank") + F.col("__before")).alias("standing"),
        (F.col("__dense") + F.col("__levels")).alias("level"),
    )


def samples_per_group(df: DataFrame, keys: list[str], count: int, key: str, seed: int = 0) -> DataFrame:
    """A uniform sample of ``count`` rows of every group (all, if fewer), the same on every run.

    A group keeps the rows of smallest hash: each task keeps its own smallest before the one shuffle, so no group, however large, sends
    more than ``count`` rows from a task.
    """
    drawn = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    order = Window.partitionBy(*keys).orderBy("__drawn", key)
    numbered = df.withColumn("__drawn", drawn).withColumn("__place", F.row_number().over(order))
    return numbered.where(F.col("__place") <= count).drop("__drawn", "__place")

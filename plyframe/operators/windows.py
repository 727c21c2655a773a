"""Ordered operators inside groups.

The plain forms use one window per group and suit groups of bounded size (the moves of
one game).  The ``*_in_chunks`` forms take a ``chunk`` column that grows with the order
(a minute, ten thousand turns): a group's rows are then spread over its chunks, and only
one summary row per chunk meets in the group's window, so one huge group is no hot task.
Choose it so that neither a chunk's rows nor a group's chunks are too many for one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_index(keys: list[str], order: list[str]) -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*order))


def previous(value: str, keys: list[str], order: list[str], default: Column) -> Column:
    """Value of the row before; ``default`` for the first row and after a NULL."""
    return F.coalesce(F.lag(value).over(Window.partitionBy(*keys).orderBy(*order)), default)


def running_text(text: str, keys: list[str], order: Column) -> Column:
    """All texts up to and including this row, separated by blanks."""
    return F.listagg(text, F.lit(" ")).over(Window.partitionBy(*keys).orderBy(order))


def _keyed(df: DataFrame, keys: list[str], chunk: Column) -> DataFrame:
    """Add ``__key``, group and chunk in one struct.

    A struct is never NULL itself and compares NULL fields as equal, so rows of a NULL key
    join like any other; and window, group and join share one hash layout.
    """
    return df.withColumn("__chunk", chunk).withColumn("__key", F.struct(*keys, "__chunk"))


def _along_chunks(keys: list[str]):
    """The chunks of a group, in order."""
    key = F.col("__key")
    return Window.partitionBy(*[key[k] for k in keys]).orderBy(key["__chunk"])


def running_index_in_chunks(
    df: DataFrame, keys: list[str], order: list[str], chunk: Column, alias: str
) -> DataFrame:
    """Row number per group: number inside the chunk plus the size of the chunks before."""
    rows = _keyed(df, keys, chunk)
    earlier = _along_chunks(keys).rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("__key").agg(F.count(F.lit(1)).alias("__size"))
    before = sizes.select(
        "__key", F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__before")
    )
    return (
        rows.withColumn("__index", running_index(["__key"], order))
        .join(before, "__key")
        .withColumn(alias, F.col("__index") + F.col("__before"))
        .drop("__index", "__before", "__chunk", "__key")
    )


def previous_in_chunks(
    df: DataFrame,
    value: str,
    keys: list[str],
    order: list[str],
    chunk: Column,
    default: Column,
    alias: str,
) -> DataFrame:
    """Value of the row before; a chunk's first row takes the last value of the chunk before."""
    rows = _keyed(df, keys, chunk)
    inside = Window.partitionBy("__key").orderBy(*order)
    # The last value is wrapped, so that max_by keeps one that is NULL.
    lasts = rows.groupBy("__key").agg(
        F.max_by(F.struct(F.col(value).alias("v")), F.struct(*order)).alias("__last")
    )
    carried = lasts.select("__key", F.lag("__last").over(_along_chunks(keys))["v"].alias("__carried"))
    first = F.row_number().over(inside) == 1
    return (
        rows.withColumns({"__lag": F.lag(value).over(inside), "__first": first})
        .join(carried, "__key")
        .withColumn(
            alias,
            F.coalesce(F.when(F.col("__first"), F.col("__carried")).otherwise(F.col("__lag")), default),
        )
        .drop("__lag", "__first", "__carried", "__chunk", "__key")
    )

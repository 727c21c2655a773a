"""Exact nearest binary codes by incremental multi-index hashing.

Codes of 64 bits are cut into segments, and each segment's value is an index key.  Round ``a`` lets every
open query ask for all values at exactly ``a`` bits from its own, segment by segment.  A code that no
segment has shown after round ``a`` differs by more than ``a`` bits in each, so all distances below
segments x (a + 1) are covered; after ``j`` segments of the next round, ``j`` more.  A query closes
once its verified k-th distance is covered, ties included.

Equal codes are one entry with its smallest ids; equal queries are searched once.  Candidates are
verified within the join: one that lies beyond the k-th distance so far, or was shown before, makes no
row.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plyframe.llm.shared import written

BITS = 64


def sign_codes(vectors: DataFrame) -> DataFrame:
    """(vec_id, code): bit i is set where dimension i is above zero; at most 64 dimensions.

    Rows without id or vector have no code and are left out; a null or NaN dimension sets no bit.
    """
    bit = F.transform(
        "embedding",
        lambda x, i: F.when((x > 0) & ~F.isnan(x), F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")),
    )
    code = F.aggregate(bit, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))
    fits = F.when(F.size("embedding") <= BITS, code).otherwise(F.raise_error(F.lit("more than 64 dimensions")).cast("long"))
    return vectors.where("vec_id is not null and embedding is not null").select(F.col("vec_id").cast("long").alias("vec_id"), fits.alias("code"))


def _segment(code: F.Column, s: int, width: int) -> F.Column:
    return F.shiftrightunsigned(code, s * width).bitwiseAND(F.lit((1 << width) - 1))


def _firsts(codes: DataFrame, key: str, order: list[str], n: int) -> DataFrame:
    """The ``n`` smallest rows of each ``key``."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return codes.withColumn("place", place).where(F.col("place") <= n).drop("place")


def search(codes: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, distance): for every query its ``k`` nearest other ids, all verified.

    ``codes`` and ``queries`` have (vec_id, code).  Neighbours are ordered by distance, then id; the
    query's own id is left out.  Defined cases: repeated rows count once; fewer than ``k`` others give
    that many rows; an empty table on either side gives none.
    """
    spark = codes.sparkSession
    held = codes.distinct()
    entries = written(
        _firsts(held, "code", ["vec_id"], k + 1).groupBy("code").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "topk-codes"
    )
    asked = written(queries.distinct(), "topk-queries")
    n = entries.count()
    segments = min(16, max(4, int(BITS / math.log2(max(2, n)))))
    segments = next(m for m in (16, 8, 4) if m <= segments)  # equal widths
    width = BITS // segments
    parts = F.array(*(F.struct(F.lit(s).alias("s"), _segment(F.col("code"), s, width).alias("v")) for s in range(segments)))
    index = written(entries.select("code", "ids", F.inline(parts)), "topk-index")
    masks = spark.range(1 << width).select(F.col("id").alias("mask"), F.bit_count("id").alias("a"))  # 65536 rows at most
    best = asked.select(F.col("code").alias("q")).distinct().select("q", F.lit(None).cast("int").alias("d"), F.lit(None).cast("long").alias("vec_id"))
    for a in range(width + 1):
        full = F.count("d") == k + 1
        state = best.groupBy("q").agg(F.when(full, F.max("d")).alias("limit"))
        wide = F.when(F.col("limit").isNull(), segments).otherwise(F.least(F.lit(segments), F.col("limit") - segments * a + 1))
        open_ = state.withColumn("wide", wide).where("wide > 0")
        if open_.isEmpty():
            break
        probe = (
            open_.withColumn("s", F.explode(F.sequence(F.lit(0), F.col("wide") - 1)))
            .withColumn("a", F.lit(a))
            .join(F.broadcast(masks.where(F.col("a") == a)), "a")
        )
        own = F.lit(0).cast("long")
        for s in range(segments):
            own = F.when(F.col("s") == s, _segment(F.col("q"), s, width)).otherwise(own)
        probe = probe.select("q", "limit", "s", own.bitwiseXOR(F.col("mask")).alias("v"))
        x, y = F.col("x.q").bitwiseXOR(F.col("y.code")), F.col("x.s")
        unseen = F.lit(True)
        for s in range(segments):  # not shown by an earlier round, nor by an earlier segment of this one
            far = F.bit_count(_segment(x, s, width))
            unseen = unseen & F.when(y > s, far > a).otherwise(far >= a)
        near = F.bit_count(x)
        found = (
            probe.alias("x")
            .join(index.alias("y"), (F.col("x.s") == F.col("y.s")) & (F.col("x.v") == F.col("y.v")) & unseen & (F.col("limit").isNull() | (near <= F.col("limit"))))
            .select("q", near.alias("d"), F.explode("ids").alias("vec_id"))
        )
        best = written(_firsts(best.unionByName(found), "q", [F.col("d").asc_nulls_last(), "vec_id"], k + 1), "topk-best")
    others = asked.select(F.col("vec_id").alias("query_id"), F.col("code").alias("q")).join(best.where("d is not null"), "q").where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id", "q").orderBy("d", "vec_id"))
    return others.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", F.col("d").alias("distance"))

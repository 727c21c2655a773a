"""SimHash near-duplicates by pivot distance tables.

A fingerprint's Hamming distances to reference fingerprints (pivots) are kept beside it, packed
one byte each.  Two fingerprints within ``BITS`` bits differ by at most ``BITS`` in every such
coordinate, so pairs with a larger maximum difference are dropped before their distance is taken.

Pairs are met through keys, never all against all: of four 16-bit quarters two are untouched by
two changed bits, so equal pairs of quarters (six 32-bit keys a fingerprint) meet every link.
Where a key holds more than ``CROWD`` fingerprints, its members go another exact way instead:
each emits itself and its 64 one-bit neighbours; two fingerprints are within two bits exactly if
they share such a key, and all that share one are within two bits of each other.  No key of that
kind has more than 65 members, so a crowd of any size costs 65 rows a member.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plyframe.llm.shared import connected_components, prepare, written

BITS = 2
PIVOTS = 16
CROWD = 64
SEED = 42


def fingerprint(data: bytes, words: int = 3) -> int:
    """SimHash of a text's word shingles, as an unsigned 64-bit number; 0 without words."""
    found = data.lower().split()
    if not found:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(found) < words:
        return digest(b" ".join(found), SEED)
    shingles = zip(*(found[i:] for i in range(words)), strict=False)
    total, set_bits = 0, np.zeros(64, dtype=np.int64)
    hashes = np.fromiter((digest(b" ".join(x), SEED) for x in shingles), dtype="<u8", count=len(found) - words + 1)
    for start in range(0, len(hashes), 1 << 16):  # 64 bytes a shingle
        part = hashes[start : start + (1 << 16)]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
        total += len(part)
    return int(np.packbits(2 * set_bits > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, version, fp): every whole text's hash and its fingerprint, as signed longs.  Null text counts as empty."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            found = np.array([fingerprint(x.as_py() or b"", words) for x in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("version"), pa.array(found.view(np.int64))], names=["doc_id", "version", "fp"]
            )

    text = F.col("text").cast("string")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _version().alias("version"), text.alias("text"))
    return own.mapInArrow(run, "doc_id long, version long, fp long")


def _version() -> F.Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _pivot_table(distinct: DataFrame) -> DataFrame:
    """Adds t0 and t1, the distances to sixteen pivots, eight to a long."""
    chosen = distinct.orderBy(F.xxhash64("fp"), "fp").limit(PIVOTS).collect()  # sixteen rows
    pivots = [r["fp"] for r in chosen] or [0]
    pivots += [pivots[-1]] * (PIVOTS - len(pivots))
    packed = []
    for half in (pivots[:8], pivots[8:]):
        lane = F.lit(0).cast("long")
        for i, p in enumerate(half):
            far = F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("long")
            lane = lane.bitwiseOR(F.shiftleft(far, 8 * i))
        packed.append(lane)
    return distinct.withColumns({"t0": packed[0], "t1": packed[1]})


def _close(left: str, right: str) -> F.Column:
    """No coordinate of the pivot tables differs by more than BITS, and the distance is at most BITS."""
    near = F.lit(True)
    for t in ("t0", "t1"):
        for i in range(8):
            a, b = (F.shiftrightunsigned(F.col(f"{x}.{t}"), 8 * i).bitwiseAND(F.lit(255)) for x in (left, right))
            near = near & (F.abs(a - b) <= BITS)
    return near & (F.bit_count(F.col(f"{left}.fp").bitwiseXOR(F.col(f"{right}.fp"))) <= BITS)


def links(distinct: DataFrame) -> DataFrame:
    """Edges (a, b) that connect what two or fewer differing bits connect, from distinct ``fp``."""
    quarters = [F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(65535)) for i in range(4)]
    both = [(i, j) for i in range(4) for j in range(i)]
    keys = F.array(
        *(
            F.shiftleft(F.lit(k).cast("long"), 32).bitwiseOR(F.shiftleft(quarters[i], 16)).bitwiseOR(quarters[j])
            for k, (i, j) in enumerate(both)
        )
    )
    keyed = _pivot_table(distinct).select("fp", "t0", "t1", F.explode(keys).alias("key"))
    held = keyed.groupBy("key").count()
    crowded = written(held.where(F.col("count") > CROWD).select("key"), "simhash-crowded")
    shared = keyed.join(held.where(F.col("count").between(2, CROWD)).select("key"), "key")
    pairs = (
        shared.alias("x")
        .join(shared.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.fp") < F.col("y.fp")) & _close("x", "y"))
        .select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    )
    members = keyed.join(crowded, "key", "left_semi").select("fp").distinct()
    around = F.concat(
        F.array("fp"),
        F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))),
    )
    stars = members.select("fp", F.explode(around).alias("key"))
    centre = stars.groupBy("key").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1")
    return pairs.unionByName(
        stars.join(centre, "key").where("fp <> a").select("a", F.col("fp").alias("b"))
    )


def _rooted(prints: DataFrame) -> DataFrame:
    """(fp, root): the smallest fingerprint that each fingerprint reaches."""
    distinct = written(prints.select("fp").distinct(), "simhash-distinct")
    roots = connected_components(links(distinct), "simhash-stars")
    return distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    Defined cases: null or wordless text has fingerprint zero and links like any other; equal
    fingerprints are one node, whatever their number; repeated rows give repeated rows; a row
    without doc_id gets its component's smallest doc_id; an empty table gives no rows; other columns
    are ignored.
    """
    prints = written(fingerprints(docs, words), "simhash-prints")
    rooted = _rooted(prints)
    firsts = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")).join(rooted, "fp")
    named = rooted.join(firsts.groupBy("root").agg(F.min("first_id").alias("component_id")), "root").select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def first_of_each(docs: DataFrame, prints: DataFrame, rooted: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are the first document of a root; ``prints`` has their fp, ``rooted`` the root of each fp."""
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "version")
    firsts = prints.groupBy("fp").agg(F.min(order).alias("first")).join(rooted, "fp")
    kept = firsts.groupBy("root").agg(F.min("first").alias("first")).select("first.doc_id", "first.version")
    same = docs["doc_id"].cast("long").eqNullSafe(kept["doc_id"]) & (_version() == kept["version"])
    return docs.join(kept, same, "left_semi")


def without_near_copies(docs: DataFrame, words: int = 3) -> DataFrame:
    """The rows of ``docs``, with all their columns, of which one document of each component stays.

    That is the one of smallest doc_id, null last, then of smallest hash of its text.  Rows that repeat both
    doc_id and text are one document and stay together.
    """
    prints = written(fingerprints(docs, words), "simhash-prints")
    return first_of_each(docs, prints, _rooted(prints))

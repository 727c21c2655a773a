"""Source divergence audit: how far a source's words are from another's and from its language's.

A language keeps the terms that ``LEAST`` of its documents hold.  A term's share p in a group (lang, source), and in
the whole language, is smoothed and fixed-point, so every figure is an exact integer.

Pairs of sources are compared on bitmaps.  The kept terms of a language are dealt by hash into tiles of about
``TILE`` terms and numbered there from the most frequent on; for every group and count, the terms of that count
are a bitmap, held as its words that are not zero.  AND and popcount of two groups' bitmaps give the number of terms in
the joint cell (a, b), which weighs f(a, b).  Terms with count 0 in a group have no bitmap; their cells are the
complement:  with g(a, b) = f(a, b) - f(a, 0) - f(0, b) + f(0, 0), the sum of f over all terms is

    sum J(a, b) g(a, b)  +  sum |A_a| (f(a, 0) - f(0, 0))  +  sum |B_b| (f(0, b) - f(0, 0))  +  V f(0, 0).

A task has one tile and two blocks of at most about ``BLOCK`` sources; numbering by frequency makes words hold few
counts.  A hot language has more tiles, a hot source the same bitmaps with larger counts: no task grows with either.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plyframe.llm.shared import prepare, written

LEAST = 30
TOP = 50
SCALE = 1_000_000_000
PLUS = 5
TILE = 16_384  # terms
BLOCK = 24  # sources
HELD = 1 << 18  # different terms a task keeps before it hands its counts on
PIECE = 1 << 22  # bytes of a text cut into words at once
# A byte as it counts: A-Z lower-cased, a-z and all bytes beyond ASCII as they are, others as blank.
_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def term_counts(text: bytes) -> Counter:
    """Counts of the terms of a whole text; long texts are cut between terms and counted piece by piece."""
    plain, found, at = text.translate(_BYTES), Counter(), 0
    while len(plain) - at > PIECE:
        end = plain.rfind(b" ", at, at + PIECE)
        end = end if end > at else plain.find(b" ", at + PIECE)
        if end < 0:
            break
        found.update(plain[at:end].split())
        at = end
    found.update(plain[at:].split())
    return found


def group_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of every term in a group, counted by the task first.

    Rows of term null, with n 0, stand for the groups themselves.
    """
    prepare(docs.sparkSession)
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])

    def rows(seen: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (counts, inside) in seen.items():
            terms = list(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (len(terms) + 1), pa.string()), pa.array([source] * (len(terms) + 1), pa.string()), pa.array([None, *terms], pa.binary()),
                 pa.array([0, *(counts[t] for t in terms)], pa.int64()), pa.array([0, *(inside[t] for t in terms)], pa.int64())],
                schema=schema,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, tuple[Counter, Counter]] = {}
        held = 0
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts, strict=True):
                counts, inside = seen.setdefault((lang, source), (Counter(), Counter()))
                found = term_counts(text.as_py())
                held -= len(counts)
                counts.update(found)
                inside.update(found.keys())
                held += len(counts)
                if held > HELD:
                    yield from rows(seen)
                    seen, held = {}, 0
        yield from rows(seen)

    own = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    out = own.mapInArrow(run, "lang string, source string, term binary, n long, docs long")
    return out.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """p = 1 + floor(SCALE (count + PLUS) / (total + PLUS V)), exact; without kept terms there is no share, and what is given is not used."""
    over = (F.lit(SCALE).cast("decimal(10,0)") * (count + PLUS).cast("decimal(20,0)")).alias("over")
    return F.lit(1).cast("long") + F.call_function("div", over, F.greatest(total + PLUS * kept, F.lit(1)).cast("decimal(20,0)"))


def _top_terms(counts: DataFrame, groups: DataFrame, langs: DataFrame, kept: DataFrame, top: int) -> DataFrame:
    q = kept.join(langs, "lang").select("lang", "term", share(F.col("n_lang"), F.col("total_lang"), F.col("v")).alias("q"))
    own = counts.join(groups, ["lang", "source"]).select("lang", "source", "term", share(F.col("n"), F.col("total"), F.col("v")).alias("p"))
    over = own.join(q, ["lang", "term"]).where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return over.withColumn("rank", place).where(F.col("rank") <= top)


def _joint(tile: pa.Table) -> pa.Table:
    """Partial sums (lang, a, b, value) of all pairs of sources between the two blocks of one tile."""
    left, right = tile.column("left")[0].as_py(), tile.column("right")[0].as_py()
    coded = tile.column("source").combine_chunks().dictionary_encode()
    codes, names = coded.indices.to_numpy(), coded.dictionary.to_pylist()
    block, p0s, word, p, bits = (tile.column(c).fill_null(0).to_numpy() for c in ("block", "p0", "word", "p", "bits"))
    heads = np.flatnonzero(~tile.column("word").is_valid().to_numpy())
    rest = np.flatnonzero(tile.column("word").is_valid().to_numpy())
    rest = rest[np.lexsort((word[rest], codes[rest]))]
    groups = {}
    for head in heads:
        code = codes[head]
        at = rest[np.searchsorted(codes[rest], code, "left") : np.searchsorted(codes[rest], code, "right")]
        b = bits[at].view(np.uint64)
        groups[int(block[head]), names[code]] = int(p0s[head]), word[at], p[at], b, np.bitwise_count(b).astype(np.int64)
    terms = tile.column("terms")[0].as_py()
    out = []
    ordered = sorted(groups)
    for x in ordered:
        if x[0] != left:
            continue
        p0, words, shares, maps, sizes = groups[x]
        for y in ordered:
            if y[0] != right or (left == right and y[1] <= x[1]):
                continue
            q0, words2, shares2, maps2, sizes2 = groups[y]
            zero = abs(p0 - q0)
            low, high = np.searchsorted(words2, words, "left"), np.searchsorted(words2, words, "right")
            many = high - low
            i = np.repeat(np.arange(len(words)), many)
            j = np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
            cell = np.bitwise_count(maps[i] & maps2[j]).astype(np.int64)
            i, j, cell = i[cell > 0], j[cell > 0], cell[cell > 0]
            a, b = shares[i], shares2[j]
            total = int((cell * (np.abs(a - b) - np.abs(a - q0) - np.abs(b - p0) + zero)).sum())
            total += int((sizes * (np.abs(shares - q0) - zero)).sum()) + int((sizes2 * (np.abs(shares2 - p0) - zero)).sum())
            out.append((*sorted((x[1], y[1])), total + terms * zero))
    lang = tile.column("lang")[0].as_py()
    return pa.table({"lang": pa.array([lang] * len(out), pa.string()), "a": pa.array([o[0] for o in out], pa.string()),
                     "b": pa.array([o[1] for o in out], pa.string()), "value": pa.array([o[2] for o in out], pa.int64())})


def bitmaps(counts: DataFrame, groups: DataFrame, kept: DataFrame, langs: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """(lang, source, tile, word, p, bits), and (lang, tile, terms).

    ``bits`` are the terms of one count, whose share is ``p``, in the ``word``-th 64 terms of the tile.
    """
    tiles = F.greatest(F.lit(1), F.ceil(F.col("v") / size)).cast("long")
    dealt = kept.join(langs, "lang").select("lang", "term", "n_lang", F.pmod(F.xxhash64("term"), tiles).alias("tile"))
    place = F.row_number().over(Window.partitionBy("lang", "tile").orderBy(F.desc("n_lang"), "term")) - 1
    placed = written(dealt.select("lang", "term", "tile", place.alias("place")), "audit-places")
    own = counts.join(groups, ["lang", "source"]).select("lang", "source", "term", "n", share(F.col("n"), F.col("total"), F.col("v")).alias("p"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place").bitwiseAND(F.lit(63)))
    held = own.join(placed, ["lang", "term"]).select("lang", "source", "tile", F.shiftright("place", 6).alias("word"), "n", "p", bit.alias("bit"))
    maps = held.groupBy("lang", "source", "tile", "word", "n", "p").agg(F.bit_or("bit").alias("bits")).drop("n")
    return maps, placed.groupBy("lang", "tile").agg(F.count("*").alias("terms"))


def _pairs(counts: DataFrame, groups: DataFrame, kept: DataFrame, langs: DataFrame, size: int, block: int) -> DataFrame:
    """(lang, source, item, value) for every ordered pair of different sources of a language."""
    maps, tiles = bitmaps(counts, groups, kept, langs, size)
    many = F.greatest(F.lit(1), F.ceil(F.col("sources") / block)).cast("long")
    own = groups.select("lang", "source", share(F.lit(0), F.col("total"), F.col("v")).alias("p0"), many.alias("blocks"), F.pmod(F.xxhash64("source"), many).alias("block"))
    # Every group has one row without a word in every tile, so that its zeros count where it has no term.
    rows = own.join(tiles, "lang").select("*", F.lit(None).cast("int").alias("word"), F.lit(None).cast("long").alias("p"), F.lit(None).cast("long").alias("bits"))
    rows = rows.unionByName(maps.join(own, ["lang", "source"]).withColumn("terms", F.lit(None).cast("long")).select(*rows.columns))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    met = rows.withColumn("other", other).select(
        "lang", "tile", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"), "block", "source", "p0", "terms", "word", "p", "bits"
    )

    def run(group: pa.Table) -> pa.Table:
        return _joint(group.sort_by([("terms", "ascending")]))  # null last: the first row has the tile's terms

    sums = met.groupBy("lang", "tile", "left", "right").applyInArrow(run, "lang string, a string, b string, value long")
    total = written(sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "audit-pairs")
    # A language without kept terms has no tile: its pairs are 0.
    bare = groups.where("v = 0")
    x, y = bare.select("lang", F.col("source").alias("source")), bare.select("lang", F.col("source").alias("item"))
    none = x.join(y, "lang").where("source <> item").select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    ways = [total.select("lang", F.col(s).alias("source"), F.col(t).alias("item"), "value") for s, t in ("ab", "ba")]
    return ways[0].unionByName(ways[1]).unionByName(none)


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP, size: int = TILE, block: int = BLOCK) -> DataFrame:
    """(lang, source, part, item, value, rank): the pairs of sources, and the terms that stand out in a source.

    Part ``pair``: every other source of the language by the sum of absolute differences of shares over
    the kept terms.  Part ``term``: the ``top`` terms with the largest excess over the language's share.

    Defined cases: null text, lang and source are the empty text, a lang or source of its own; every row is a document, repeated ones
    too; a group without terms takes part with counts of 0; a lang without kept terms has pairs of value 0 and
    no terms; ties go by the item's bytes; an empty table gives no rows; other columns are ignored.
    """
    counts = written(group_terms(docs), "audit-counts")
    known = counts.where("term IS NOT NULL")
    kept = written(
        known.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("docs").alias("docs")).where(F.col("docs") >= least).select("lang", "term", "n_lang"), "audit-kept"
    )
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n_lang").alias("total_lang"))
    own = written(known.join(kept.select("lang", "term"), ["lang", "term"], "left_semi").select("lang", "source", "term", "n"), "audit-own")
    totals = own.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    every = counts.select("lang", "source").distinct()
    sources = every.groupBy("lang").agg(F.count("*").alias("sources"))
    langs = written(sources.join(sizes, "lang", "left").select("lang", "sources", *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("v", "total_lang")]), "audit-langs")
    groups = every.join(totals, ["lang", "source"], "left").join(langs, "lang")
    groups = written(groups.select("lang", "source", F.coalesce("total", F.lit(0).cast("long")).alias("total"), "v", "sources"), "audit-groups")
    terms = _top_terms(own, groups, langs, kept, top).withColumn("item", F.col("item").cast("string"))
    pairs = _pairs(own, groups, kept, langs, size, block)
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    parts = {"pair": pairs.withColumn("rank", place), "term": terms}
    out = [df.select("lang", "source", F.lit(name).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank")) for name, df in parts.items()]
    return out[0].unionByName(out[1])

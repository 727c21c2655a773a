"""Repeated byte strings by merged Burrows-Wheeler transforms.

A byte goes if it lies in a SPAN-byte string that also starts earlier: in a document of smaller doc_id,
or earlier in the same one.

1. Every SPAN-byte window names its anchor, the leftmost GRAM-byte string of smallest hash within it.
   Equal windows have equal anchors at equal places, so windows only need comparing where their
   anchors agree.  Consecutive windows with one anchor are one stretch; a document sends a row (anchor's
   hash, stretch's hash, where) for each.
2. Of equal stretches that one task meets, only the earliest is sent to be compared, so that a passage of very
   many documents is no hot key.  Rows are sorted by anchor and stretch.  Anchors that occur once are dropped.  Of equal stretches
   all but the first are repeats as a whole.  The first ones of anchors with different stretches are left.
3. The bytes of those are fetched, and tasks take them in portions of whole anchors.  A portion is cut into
   shards; each shard's Burrows-Wheeler transform is built by itself, and the transforms are merged by
   refining their interleave: after k rounds the merged order is right for the first k symbols, and
   the borders that appear in round k are where the common prefix is k - 1.  Symbols are SYMBOL bytes, and a
   suffix goes on SYMBOL bytes further, so SPAN / SYMBOL rounds give the intervals of equal windows.
   Within an interval all but the earliest window are repeats.

Anchors with more than HOT different stretches do not fit a portion; their windows are compared by grouping
128-bit hashes instead, which has no group to hold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plyframe.llm.shared import prepare, written

SPAN = 100
GRAM = 32
SYMBOL = 10
PIECE = 1 << 20
PORTION = 1_000_000  # bytes
SHARD = 250_000  # bytes
HOT = 8_000
KNOWN = 20_000  # stretches a task remembers
TEXTS = 64  # documents a task takes at once
LAST = (1 << 63) - 1
_MULTIPLIER = 0x9E3779B97F4A7C15
_PLACE = np.uint64((1 << 21) - 1)


def _byte_values() -> np.ndarray:
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUES = _byte_values()


def _joined(left: np.ndarray, right: np.ndarray, length: int, n: int) -> np.ndarray:
    """Hashes of strings made of ``left`` and the ``length`` bytes of ``right`` after it."""
    return left[:n] * np.uint64(pow(_MULTIPLIER, length, 1 << 64)) + right[:n]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position on."""
    h = {1: _VALUES[data]}
    size = 1
    while size * 2 <= GRAM:
        h[size * 2] = _joined(h[size], h[size][size:], size, len(data) - 2 * size + 1)
        size *= 2
    out, rest = h[size], GRAM - size
    done = size
    while rest:
        while size > rest:
            size //= 2
        out = _joined(out, h[size][done:], size, len(data) - done - size + 1)
        done, rest = done + size, rest - size
    out = out ^ (out >> np.uint64(32))
    out = out * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(29))


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if width > size else x


def stretches(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and numbers of windows of all stretches, and their anchors' hashes."""
    starts, counts, keys = [], [], []
    whole = np.frombuffer(data, dtype=np.uint8)
    for at in range(0, len(data) - SPAN + 1, PIECE):
        h = gram_hashes(whole[at : at + PIECE + SPAN - 1])
        ranked = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
        anchor = (_sliding_least(ranked, SPAN - GRAM + 1) & _PLACE).astype(np.int64)
        first = np.nonzero(np.diff(anchor, prepend=-1))[0]
        starts.append(first + at)
        counts.append(np.diff(first, append=len(anchor)))
        keys.append(h[anchor[first]])
    return np.concatenate(starts), np.concatenate(counts), np.concatenate(keys)


def _packed(version: int, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """23 bits of the version, 32 of the start, 8 of the number of windows; sorts in that order."""
    return (np.int64(version) << np.int64(40)) | (start.astype(np.int64) << np.int64(8)) | count.astype(np.int64)


def _documents(docs: DataFrame) -> DataFrame:
    """did (doc_id, the largest number for null), version (of the text) and text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("did"),
        F.xxhash64(text).bitwiseAND(F.lit((1 << 23) - 1)).alias("version"),
        text.alias("text"),
    )


class Met:
    """Stretches that a task met more than once, with their earliest place; forgets all of them beyond KNOWN.

    What it tells apart saves the shuffle of very common stretches: a task sends one of each to be compared.
    """

    def __init__(self) -> None:
        self.places: dict[tuple[int, int], tuple[int, int]] = {}

    def repeats(self, key: np.ndarray, content: np.ndarray, did: np.ndarray, pos: np.ndarray) -> np.ndarray:
        """Rows with an equal stretch at an earlier place, in these rows or in ones met before."""
        order = np.lexsort((pos, did, content, key))
        k, c, d, p = key[order], content[order], did[order], pos[order]
        new = np.ones(len(k), dtype=bool)
        new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
        first = np.nonzero(new)[0]
        group = np.cumsum(new) - 1
        later = (d != d[first][group]) | (p != p[first][group])  # a repeated row is no later place
        if self.places:
            known = np.fromiter((x[1] for x in self.places), dtype=np.int64, count=len(self.places))
            for i in first[np.isin(c[first], known)].tolist():
                at, own = (int(k[i]), int(c[i])), (int(d[i]), int(p[i]))
                if self.places.get(at, own) < own:
                    later[i] = True
                elif at in self.places:
                    self.places[at] = own
        if len(self.places) > KNOWN:
            self.places.clear()
        for i in first[np.diff(first, append=len(k)) > 1].tolist():
            self.places.setdefault((int(k[i]), int(c[i])), (int(d[i]), int(p[i])))
        out = np.empty(len(k), dtype=bool)
        out[order] = later
        return out


def _rows(marked: DataFrame) -> DataFrame:
    """A row per stretch (key, content, did, pos); those with an equal one earlier in the task have a null key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, met = xxhash.xxh3_64_intdigest, Met()
        for batch in (whole.slice(at, TEXTS) for whole in batches for at in range(0, whole.num_rows, TEXTS)):
            keys, contents, ids, places = [], [], [], []
            texts = batch.column("text").cast(pa.large_binary())
            for did, version, text in zip(batch.column("did").to_pylist(), batch.column("version").to_pylist(), texts, strict=True):
                data = text.as_py()
                if len(data) < SPAN:
                    continue
                start, count, key = stretches(data)
                stop = start + count + (SPAN - 1)
                content = np.array([digest(data[s:e]) for s, e in zip(start.tolist(), stop.tolist(), strict=True)], dtype=np.uint64)
                keys.append(key.view(np.int64)), contents.append(content.view(np.int64))
                places.append(_packed(version, start, count)), ids.append(np.full(len(start), did, dtype=np.int64))
            if keys:
                columns = [np.concatenate(x) for x in (keys, contents, ids, places)]
                repeat = met.repeats(*columns)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], mask=repeat), *map(pa.array, columns[1:])], names=["key", "content", "did", "pos"]
                )

    return marked.mapInArrow(run, "key long, content long, did long, pos long")


def _sorted_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key, content, did, pos: repeats (key null), and firsts of keys with several contents.

    Holds one row between batches, the first of a key that has shown one content so far.
    """
    last_key = last_content = last_place = None
    several, held = False, None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, content, did, pos = (batch.column(i).to_numpy() for i in range(4))
        # Rows of repeated documents are the same place, not a later one.
        other = np.ones(len(key), dtype=bool)
        other[1:] = (did[1:] != did[:-1]) | (pos[1:] != pos[:-1])
        other[0] = last_place != (int(did[0]), int(pos[0]))
        last_place = int(did[-1]), int(pos[-1])
        key, content, did, pos = (x[other] for x in (key, content, did, pos))
        n = len(key)
        if not n:
            continue
        new_key = np.ones(n, dtype=bool)
        new_key[1:] = key[1:] != key[:-1]
        new_content = new_key.copy()
        new_content[1:] |= content[1:] != content[:-1]
        goes_on = last_key is not None and int(key[0]) == last_key
        if goes_on:
            new_key[0] = False
            new_content[0] = int(content[0]) != last_content
        group = np.cumsum(new_key)
        group -= group[0]
        kinds = np.bincount(group, weights=new_content).astype(np.int64)  # contents that begin in this batch
        more = kinds > 1
        if goes_on:
            more[0] = several or kinds[0] > 0
        out = [(None, did[~new_content], pos[~new_content])]
        firsts = new_content & more[group]
        out.append((key[firsts], did[firsts], pos[firsts]))
        if held is not None and (not goes_on or more[0]):
            if goes_on:
                out.append(tuple(np.array([x]) for x in held))
            held = None
        if not more[-1] and not (goes_on and group[-1] == 0):
            i = int(np.nonzero(new_key)[0][-1])
            held = (key[i], did[i], pos[i])
        last_key, last_content, several = int(key[-1]), int(content[-1]), bool(more[-1])
        arrays = [
            pa.concat_arrays([pa.nulls(len(d), pa.int64()) if k is None else pa.array(k) for k, d, _ in out]),
            pa.concat_arrays([pa.array(d) for _, d, _ in out]),
            pa.concat_arrays([pa.array(p) for _, _, p in out]),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names=["key", "did", "pos"])


def _fetched(marked: DataFrame, firsts: DataFrame) -> DataFrame:
    """(key, did, pos, data): the bytes of stretches."""
    version = F.shiftright("pos", 40)
    wanted = firsts.groupBy("did", version.alias("version")).agg(F.collect_list(F.struct("key", "pos")).alias("stretches"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.int64()), ("did", pa.int64()), ("pos", pa.int64()), ("data", pa.binary())])
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                data = r["text"].encode()
                for x in r["stretches"]:
                    start, count = x["pos"] >> 8 & 0xFFFFFFFF, x["pos"] & 0xFF
                    rows.append({"key": x["key"], "did": r["did"], "pos": x["pos"], "data": data[start : start + count + SPAN - 1]})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return marked.join(wanted, ["did", "version"]).select("did", "text", "stretches").mapInArrow(run, "key long, did long, pos long, data binary").dropDuplicates(["did", "pos"])


def stable_order(x: np.ndarray) -> np.ndarray:
    """Stable order of numbers from 0 on, sixteen bits at a time from the lowest."""
    order = np.argsort((x & 0xFFFF).astype(np.uint16), kind="stable")
    most, shift = int(x.max(initial=0)), 16
    while most >> shift:
        order = order[np.argsort((x[order] >> shift & 0xFFFF).astype(np.uint16), kind="stable")]
        shift += 16
    return order


class Shard:
    """Burrows-Wheeler transform of some strings of symbols, each string closed by its own end.

    ``succession`` chains positions SYMBOL bytes apart; the rows are sorted by doubling ranks.
    """

    def __init__(self, symbols: np.ndarray, following: np.ndarray, before: np.ndarray, string: np.ndarray) -> None:
        rank = symbols.astype(np.int64)
        ahead = following  # the row a doubled distance on, -1 behind the end
        n = len(symbols)
        while (ahead >= 0).any():
            second = np.where(ahead >= 0, rank[ahead], -1) + 1
            order = stable_order(second)
            order = order[stable_order(rank[order])]
            first, second = rank[order], second[order]
            border = np.zeros(n, dtype=bool)
            border[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
            rank[order] = np.cumsum(border)
            ahead = np.where(ahead >= 0, ahead[ahead], -1)
        order = stable_order(string)
        self.rows = order[stable_order(rank[order])]
        self.transform = symbols_before(symbols, before)[self.rows]


def symbols_before(symbols: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The symbol that precedes each row; the end mark (0) before a string's first."""
    return np.where(before >= 0, symbols[before], 0)


def merge(shards: list[Shard], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of the shards' rows, and the interval each merged row is in: equal first ``rounds`` symbols.

    One round deals the interleave out by the symbols before its rows, in order.  That makes an order that
    is right for one symbol more; a border stands where the symbol or the former interval changes.
    """
    sizes = [len(s.rows) for s in shards]
    lies = np.repeat(np.arange(len(shards), dtype=np.int16), sizes)
    interval = np.zeros(len(lies), dtype=np.int64)
    symbol = np.empty(len(lies), dtype=np.int64)
    for _ in range(rounds):
        for k, shard in enumerate(shards):
            symbol[lies == k] = shard.transform
        order = stable_order(symbol)
        dealt, former = symbol[order], interval[order]
        border = np.ones(len(order), dtype=bool)
        border[1:] = (dealt[1:] != dealt[:-1]) | (former[1:] != former[:-1])
        lies, interval = lies[order], np.cumsum(border)
    return lies, interval


def repeated_windows(texts: list[bytes], counts: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For every window of every text, in turn: does an equal window stand in a text of smaller ``order``?

    Texts have ``counts`` windows each, and no two equal ones.
    """
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    data = np.frombuffer(b"".join(texts) + b"\0" * SYMBOL, dtype=np.uint8)
    begins = np.cumsum(sizes) - sizes
    # Symbols: exact numbers for the SYMBOL (10) bytes from each position on.
    eight = np.lib.stride_tricks.sliding_window_view(data, 8).copy().view(np.uint64)[:, 0]
    _, high = np.unique(eight, return_inverse=True)
    low = data[8:].astype(np.int64)[:-1] << 8 | data[9:]
    n = int(sizes.sum())
    _, symbol_at = np.unique(high[:n] << 16 | low[:n], return_inverse=True)
    # A row for each position with a whole symbol, and one for the end of each of the SYMBOL strings of a text.
    text_of = np.repeat(np.arange(len(texts)), sizes)
    offset = np.arange(n) - begins[text_of]
    room = sizes[text_of] - offset
    inner = room >= SYMBOL  # others begin no whole symbol: they are the ends of the strings
    symbols = np.where(inner, symbol_at + 1, 0)
    following = np.where(inner & (room > SYMBOL), np.arange(n) + SYMBOL, -1)
    # A string that fills the text to its last byte ends one position behind it; it gets an extra row.
    full = np.nonzero(inner & (room == SYMBOL))[0]
    following[full] = n + np.arange(len(full))
    symbols = np.concatenate([symbols, np.zeros(len(full), dtype=np.int64)])
    following = np.concatenate([following, np.full(len(full), -1)])
    text_of = np.concatenate([text_of, text_of[full]])
    offset = np.concatenate([offset, offset[full] + SYMBOL])
    before = np.where(offset >= SYMBOL, np.concatenate([np.arange(n) - SYMBOL, full]), -1)
    string = text_of * SYMBOL + offset % SYMBOL
    shard_of = (begins // SHARD)[text_of]
    shards, members = [], []
    for k in np.unique(shard_of):
        own = np.nonzero(shard_of == k)[0]
        local = np.full(len(symbols), -1, dtype=np.int64)
        local[own] = np.arange(len(own))
        within = lambda x: np.where(x >= 0, local[x], -1)  # noqa: B023, E731
        shards.append(Shard(symbols[own], within(following[own]), within(before[own]), string[own]))
        members.append(own[shards[-1].rows])
    lies, interval = merge(shards, SPAN // SYMBOL)
    merged = np.empty(len(lies), dtype=np.int64)
    for k, rows in enumerate(members):
        merged[lies == k] = rows
    # Whole windows only, then the earliest text of each interval.
    window = (offset[merged] < counts[text_of[merged]]) & (merged < n)
    merged, interval = merged[window], interval[window]
    first = np.nonzero(np.diff(interval, prepend=-1))[0]
    least = np.minimum.reduceat(order[text_of[merged]], first)
    later = order[text_of[merged]] > np.repeat(least, np.diff(first, append=len(merged)))
    flags = np.zeros(n, dtype=bool)
    flags[merged] = later
    return flags[np.concatenate([np.arange(b, b + c) for b, c in zip(begins, counts, strict=True)])] if len(texts) else flags


def _intervals(portion: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    """(did, pos) of the repeats within a portion of stretches (did, pos, data)."""
    portion.sort(key=lambda x: (x[0], x[1]))
    counts = np.array([x[1] & 0xFF for x in portion], dtype=np.int64)
    flags = repeated_windows([x[2] for x in portion], counts, np.arange(len(portion)))
    dids, places, at = [], [], 0
    for (did, pos, _), count in zip(portion, counts.tolist(), strict=True):
        edges = np.diff(flags[at : at + count].astype(np.int8), prepend=0, append=0)
        at += count
        for low, high in zip(np.nonzero(edges == 1)[0].tolist(), np.nonzero(edges == -1)[0].tolist(), strict=True):
            dids.append(did)
            places.append((pos >> 40 << 40) | ((pos >> 8 & 0xFFFFFFFF) + low) << 8 | (high - low))
    return pa.RecordBatch.from_arrays([pa.array(dids, pa.int64()), pa.array(places, pa.int64())], names=["did", "pos"])


def _by_transforms(fetched: DataFrame) -> DataFrame:
    """Repeats among stretches of the same anchor, portion by portion."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        portion, size, last = [], 0, None
        for batch in batches:
            for key, *row in zip(*(batch.column(c).to_pylist() for c in ("key", "did", "pos", "data")), strict=True):
                if key != last and size >= PORTION:
                    yield _intervals(portion)
                    portion, size = [], 0
                last = key
                portion.append(tuple(row))
                size += len(row[2])
        if portion:
            yield _intervals(portion)

    return fetched.repartition("key").sortWithinPartitions("key").mapInArrow(run, "did long, pos long")


def _by_hashes(fetched: DataFrame) -> DataFrame:
    """Repeats among stretches of very common anchors: windows grouped by hash, the first of a group stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2, ids, places = [], [], [], []
            for did, pos, data in zip(*(batch.column(c).to_pylist() for c in ("did", "pos", "data")), strict=True):
                for i in range(pos & 0xFF):
                    h = xxhash.xxh3_128_intdigest(data[i : i + SPAN])
                    h1.append((h >> 64) - (1 << 63)), h2.append((h & (1 << 64) - 1) - (1 << 63)), ids.append(did)
                    places.append((pos >> 40 << 40) | ((pos >> 8 & 0xFFFFFFFF) + i) << 8 | 1)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (h1, h2, ids, places)], names=["h1", "h2", "did", "pos"])

    windows = written(fetched.mapInArrow(run, "h1 long, h2 long, did long, pos long"), "substrings-windows")
    first = windows.groupBy("h1", "h2").agg(F.min(F.struct("did", "pos")).alias("first"), F.count("*").alias("n")).where("n > 1")
    return windows.join(first, ["h1", "h2"]).where(F.struct("did", "pos") != F.col("first")).select("did", "pos")


def dedupe_bytes(docs: DataFrame) -> DataFrame:
    """(doc_id, kept, n_bytes, n_removed, n_spans): every document's bytes without the repeated ones.

    Texts are UTF-8 bytes; matches do not cross documents and are judged on the input.  Defined cases:
    null text counts as empty; texts under SPAN bytes lose nothing; rows that repeat both doc_id and text
    are judged as one document; of rows that repeat only the doc_id each is a document, in an order of their
    own; a row without doc_id comes last; an empty table gives no rows; other columns are ignored.
    """
    prepare(docs.sparkSession, 64)
    marked = _documents(docs)
    rows = _rows(marked)
    # Rows with a null key only pass through; they are spread, not gathered.
    spread = F.when(F.col("key").isNull(), F.xxhash64("did", "pos")).otherwise(F.col("key"))
    ordered = rows.repartition(spread).sortWithinPartitions("key", "content", "did", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def keyed() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                free = batch.column("key").is_null()
                if batch.column("key").null_count:
                    gone.append(batch.filter(free).select(["key", "did", "pos"]))
                yield batch.filter(pa.compute.invert(free))

        gone: list[pa.RecordBatch] = []
        for out in _sorted_out(keyed()):
            yield from gone
            gone.clear()
            yield out
        yield from gone

    prepare(docs.sparkSession, 4_000)  # small rows; _rows cuts its batches of documents itself
    found = written(ordered.mapInArrow(run, "key long, did long, pos long"), "substrings-repeats")
    prepare(docs.sparkSession, 64)
    firsts = found.where("key is not null")
    hot = written(firsts.groupBy("key").count().where(F.col("count") > HOT).select("key"), "substrings-hot")
    fetched = written(_fetched(marked, firsts), "substrings-stretches")  # both ways below read it
    gone = found.where("key is null").select("did", "pos").unionByName(_by_transforms(fetched.join(hot, "key", "left_anti")))
    if not hot.isEmpty():
        gone = gone.unionByName(_by_hashes(fetched.join(hot, "key", "left_semi")))
    per_document = gone.groupBy("did", F.shiftright("pos", 40).alias("version")).agg(F.collect_list("pos").alias("gone"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, kepts, counts = [], [], []
            for did, text, gone in zip(*(batch.column(c) for c in ("did", "text", "gone")), strict=True):
                data = text.as_py().encode()
                ids.append(None if did.as_py() == LAST else did.as_py())
                if not gone.is_valid:
                    kepts.append(data), counts.append((len(data), 0, 0))
                    continue
                pos = np.sort(gone.values.to_numpy() & ((1 << 40) - 1))
                start = pos >> 8
                stop = np.maximum.accumulate(start + (pos & 0xFF) + SPAN - 1)
                opens = np.ones(len(start), dtype=bool)
                opens[1:] = start[1:] > stop[:-1]
                first = np.nonzero(opens)[0]
                spans = list(zip(start[first].tolist(), stop[np.append(first[1:], len(stop)) - 1].tolist(), strict=True))
                edges = [0, *(x for s in spans for x in s), len(data)]
                kepts.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                counts.append((len(data), sum(b - a for a, b in spans), len(spans)))
            columns = list(zip(*counts, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(kepts, pa.binary()), *(pa.array(c, pa.int64()) for c in columns)],
                names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"],
            )

    joined = marked.join(per_document, ["did", "version"], "left").select("did", "text", "gone")
    return joined.mapInArrow(cut, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")


def digests(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

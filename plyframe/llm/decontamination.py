"""Benchmark decontamination by latent semantic retrieval.

Passages (PASSAGE words of a document) are TF-IDF rows over the words of the benchmark items.  Their
term-by-term product with a random matrix is summed over the whole corpus, from which the driver,
holding one small matrix, takes the leading right singular vectors (single-pass randomised SVD).
Items and document windows of about an item's length are folded into that space, and their cosine is
given with each finding; it drops none.  Candidates are the windows that hold enough of an item's rarest
words, which loses nothing that the next test accepts: a candidate counts if the longest common subsequence of
words covers COPIED of the item, or PARAPHRASED of it with the answer in the window: all of the item's ANSWER_WORDS
rarest words, or ANSWERED of the weight of those looked up.

Items are handled in blocks of ITEMS, so what is broadcast is bounded whatever the benchmark's size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plyframe.llm.shared import prepare, written

PASSAGE = 32
RANK = 48
COPIED = 0.8
PARAPHRASED = 0.5
ANSWER_WORDS = 3
ANSWERED = 0.5
ITEMS = 2000
LONGEST_ITEM = 64  # longer items are searched as pieces of this many words
WINDOWS = (16, 24, 32, 48, 64)  # words
STRETCH = 16_384  # words of a document held at once


# Lower-cased UTF-8 with every ASCII character that is no letter or digit as a space.
_PLAIN = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    """Lower-cased words between white space and ASCII punctuation."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_PLAIN).split()


def common_subsequence(a: list, b: list) -> int:
    """Length of the longest common subsequence, by whole rows of bits."""
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    row, mask = (1 << len(a)) - 1, (1 << len(a)) - 1
    for y in b:
        hit = row & places.get(y, 0)
        row = ((row + hit) | (row - hit)) & mask
    return len(a) - row.bit_count()


@dataclass
class Space:
    """Vocabulary, TF-IDF weighted word vectors (last row: other words, zero) and the folded items."""

    vocabulary: dict[bytes, int]
    vectors: np.ndarray
    items: list[tuple[int, list[int], frozenset[int], dict[int, float], int]]  # item_id, words, answer words, weights of the rarest words, how many of those are needed
    by_window: dict[int, tuple[list[int], np.ndarray, dict[int, list[int]]]]  # window -> items, unit vectors, items by word they need


def number(words: list[bytes], vocabulary: dict[bytes, int]) -> np.ndarray:
    """Each word's number in the vocabulary, its size for others."""
    return np.fromiter(map(vocabulary.get, words, repeat(len(vocabulary))), dtype=np.int32, count=len(words))


def _numbered(texts: list[str | None], vocabulary: dict[bytes, int]) -> Iterator[np.ndarray]:
    """Word numbers of each whole text, in stretches."""
    for text in texts:
        found = words_of(text or "")
        for at in range(0, len(found), STRETCH):
            yield number(found[at : at + STRETCH], vocabulary)


def _spread(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())


def corpus_sketch(docs: DataFrame, vocabulary: dict[bytes, int], drawn: np.ndarray) -> tuple[np.ndarray, int, np.ndarray]:
    """Passages that hold each word, number of passages, and A'A times ``drawn`` for their term counts A.

    One scan; a task sums over its passages and sends one row per word of the vocabulary.
    """
    size, width = drawn.shape
    padded = np.vstack([drawn, np.zeros((1, width))]).astype(np.float32)
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, padded))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, padded = shared.value
        seen, total, passages = np.zeros(size, dtype=np.int64), np.zeros((size, width)), 0
        held: list[np.ndarray] = []
        count = 0

        def add() -> None:
            nonlocal passages
            numbers = np.concatenate(held)
            sizes = np.array([(len(x) + PASSAGE - 1) // PASSAGE for x in held])
            firsts = np.cumsum(sizes) - sizes
            passage = np.concatenate([np.arange(len(x)) // PASSAGE + e for x, e in zip(held, firsts, strict=True)])
            passages += int(sizes.sum())
            known = numbers < size
            numbers, passage = numbers[known], passage[known]
            held.clear()
            if not len(numbers):
                return
            # Passages that hold the word, each once, grouped by word; tf within a passage is its repeats.
            starts = np.nonzero(np.diff(passage, prepend=-1))[0]
            projected = np.add.reduceat(padded[numbers], starts, axis=0)
            row = np.cumsum(np.diff(passage, prepend=passage[0]) > 0)
            order = np.argsort(numbers.astype(np.uint16) if size < 65536 else numbers, kind="stable")
            sorted_words = numbers[order]
            groups = np.nonzero(np.diff(sorted_words, prepend=-1))[0]
            total[sorted_words[groups]] += np.add.reduceat(projected[row[order]], groups, axis=0)
            once = np.ones(len(order), dtype=bool)
            once[1:] = (np.diff(sorted_words) != 0) | (np.diff(passage[order]) != 0)
            seen[:] += np.bincount(sorted_words[once], minlength=size)

        for batch in batches:
            for numbers in _numbered(batch.column("text").to_pylist(), vocabulary):
                held.append(numbers)
                count += len(numbers)
                if count >= 4 * STRETCH:
                    add()
                    count = 0
        if held:
            add()
        at = np.nonzero(seen)[0]
        values = pa.FixedSizeListArray.from_arrays(pa.array(total[at].ravel()), width).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(seen[at]), values], names=["word", "n", "z"])
        yield pa.RecordBatch.from_pydict({"word": pa.array([size], pa.int32()), "n": pa.array([passages], pa.int64()), "z": pa.array([[0.0] * width], pa.list_(pa.float64()))})

    summed = (
        _spread(docs)
        .mapInArrow(run, "word int, n long, z array<double>")
        .groupBy("word")
        .agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("z")[i]) for i in range(width))).alias("z"))
    )
    seen, z, passages = np.zeros(size), np.zeros((size, width)), 0
    for r in summed.toLocalIterator():  # a row per word of the items, in order of partitions
        if r["word"] == size:
            passages = r["n"]
        else:
            seen[r["word"]], z[r["word"]] = r["n"], r["z"]
    return seen, passages, z


def singular_vectors(z: np.ndarray, drawn: np.ndarray, weights: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Leading right singular vectors (words x rank) of the passages' TF-IDF rows A D, from A'A ``drawn``.

    With D on both sides the sketch is D A'A D times D^-1 ``drawn``, random all the same.
    """
    drawn, z = drawn / weights[:, None], z * weights[:, None]
    basis, _ = np.linalg.qr(z)
    inner = np.linalg.lstsq((basis.T @ drawn).T, (basis.T @ z).T, rcond=None)[0].T
    values, turned = np.linalg.eigh((inner + inner.T) / 2)
    return basis @ turned[:, np.argsort(-values)[:rank]]


def build_space(docs: DataFrame, items: list[tuple[int, str]]) -> Space | None:
    pieces = []
    for item_id, text in items:
        found = words_of(text or "")
        cuts = max(1, -(-len(found) // LONGEST_ITEM))
        size = -(-len(found) // cuts) if found else 0
        pieces += [(item_id, found[i : i + size]) for i in range(0, len(found), size or 1)]
    vocabulary = {w: i for i, w in enumerate(sorted({w for _, p in pieces for w in p}))}
    if not vocabulary:
        return None
    size = len(vocabulary)
    drawn = np.random.default_rng(7).standard_normal((size, min(size, RANK + 8)))
    seen, passages, z = corpus_sketch(docs, vocabulary, drawn)
    weights = np.log((passages + 1) / (seen + 1)) + 1
    vectors = weights[:, None] * singular_vectors(z, drawn, weights)
    vectors = np.vstack([vectors, np.zeros((1, vectors.shape[1]))]).astype(np.float32)
    kept, by_window = [], {}
    for item_id, piece in pieces:
        numbers = [vocabulary[w] for w in piece]
        ordered = sorted(set(numbers), key=lambda w: (seen[w], w))
        # Who shares COPIED of the words in order misses few, who has the answer has its words: so of the
        # rarest words some number must be there.
        spare = int((1 - COPIED) * len(numbers))
        needed = ordered[: spare + ANSWER_WORDS]
        least = max(1, min(ANSWER_WORDS, len(needed) - spare))
        rare = ordered[:ANSWER_WORDS]
        # Nor does the lookup miss a window with ANSWERED of their weight.
        heaviest = np.cumsum(np.sort(weights[needed])[::-1])
        least = min(least, int(np.searchsorted(heaviest, ANSWERED * heaviest[-1])) + 1 if needed else 1)
        heavy = {w: float(weights[w]) for w in needed}
        window = next((w for w in WINDOWS if w >= len(numbers)), WINDOWS[-1])
        by_window.setdefault(window, []).append(len(kept))
        kept.append((item_id, numbers, frozenset(rare), heavy, least))
    folded = {}
    for window, which in by_window.items():
        v = np.array([vectors[kept[i][1]].sum(axis=0) for i in which])
        owners: dict[int, list[int]] = {}
        for j, i in enumerate(which):
            for w in kept[i][3]:
                owners.setdefault(w, []).append(j)
        folded[window] = (which, (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)).astype(np.float32), owners)
    return Space(vocabulary, vectors, kept, folded)


def matches(space: Space, numbers: np.ndarray) -> dict[int, tuple[float, float, bool]]:
    """item_id -> (share of the item in common order, cosine, answer found) of one stretch of words.

    Windows begin every quarter of their length.  One without any word that an item needs is passed over.
    """
    found: dict[int, tuple[float, float, bool]] = {}
    n = len(numbers)
    if not n:
        return found
    for window, (which, unit, owners) in space.by_window.items():
        step = reach = window // 4
        count = max(1, -(-(n - window) // step) + 1)
        wanted = np.zeros(len(space.vocabulary) + 1, dtype=bool)
        wanted[list(owners)] = True
        # The words around a window count too: an item lies in it but for an eighth at either end.
        pairs: dict[tuple[int, int], int] = {}
        for place in np.nonzero(wanted[numbers])[0].tolist():
            items = owners[int(numbers[place])]
            for i in range(max(0, (place - window - reach) // step + 1), min(count - 1, (place + reach) // step) + 1):
                for j in items:
                    pairs[i, j] = pairs.get((i, j), 0) + 1
        windows: dict[int, list[int]] = {}
        for (i, j), n_words in pairs.items():
            if n_words >= space.items[which[j]][4]:
                windows.setdefault(i, []).append(j)
        for i, chosen in windows.items():
            at, stop = i * step, min(n, i * step + window)
            v = space.vectors[numbers[at:stop]].sum(axis=0)
            cosines = unit[chosen] @ v / max(1e-9, float(np.sqrt(v @ v)))
            near = numbers[max(0, at - reach) : stop + reach].tolist()
            held = set(near)
            for j, cosine in zip(chosen, cosines.tolist(), strict=True):
                item_id, words, answer, heavy, _ = space.items[which[j]]
                if sum(map(held.__contains__, words)) < PARAPHRASED * len(words):
                    continue
                share = common_subsequence(words, near) / len(words)
                answered = answer <= held or sum(x for w, x in heavy.items() if w in held) >= ANSWERED * sum(heavy.values())
                if share >= COPIED or (share >= PARAPHRASED and answered):
                    found[item_id] = max(found.get(item_id, (0.0, 0.0, False)), (share, cosine, answered))
    return found


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, share, cosine, answered): every document that holds a benchmark item; see ``findings``."""
    return findings(docs, benchmark).drop("version")


def without_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, by doc_id, which may be null, and hash of the text."""
    held = findings(docs, benchmark).select("doc_id", "version").distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(held["doc_id"]) & (_version(docs["text"]).eqNullSafe(held["version"]))
    return docs.join(held, same, "left_anti")


def _version(text: Column) -> Column:
    return F.xxhash64(text.cast("string"))


def findings(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The columns of ``contaminated`` and version, the hash of the document's text.

    Texts are searched whole.  Defined cases: null or wordless items and texts match nothing; an item that
    occurs several times in a document gives one row, its best; repeated rows of documents give
    repeated rows; a null doc_id or item_id stays null; an empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    types = "doc_id long, version long, item_id long, share double, cosine double, answered boolean"
    schema = pa.schema([("doc_id", pa.int64()), ("version", pa.int64()), ("item_id", pa.int64()), ("share", pa.float64()), ("cosine", pa.float64()), ("answered", pa.bool_())])
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _version(F.col("text")).alias("version"), F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())
    parts = max(1, -(-benchmark.count() // ITEMS))
    out = spark.createDataFrame([], types)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    for k in range(parts):
        block = benchmark.where(part == k) if parts > 1 else benchmark
        items = [(r["item_id"], r["text"]) for r in block.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).orderBy("item_id", "text").collect()]  # about ITEMS rows
        space = build_space(own, items)
        if space is None:
            continue
        shared = spark.sparkContext.broadcast(space)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            space = shared.value
            reach = 2 * WINDOWS[-1]
            for batch in batches:
                rows = []
                for doc_id, version, text in zip(batch.column("doc_id").to_pylist(), batch.column("version").to_pylist(), batch.column("text").to_pylist(), strict=True):
                    found = words_of(text)
                    best: dict[int, tuple[float, float, bool]] = {}
                    for at in range(0, max(1, len(found)), STRETCH):  # stretches overlap by more than a window
                        numbers = number(found[at : at + STRETCH + reach], space.vocabulary)
                        for item_id, x in matches(space, numbers).items():
                            best[item_id] = max(x, best.get(item_id, x))
                    rows += [{"doc_id": doc_id, "version": version, "item_id": i, "share": x[0], "cosine": x[1], "answered": x[2]} for i, x in best.items()]
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

        out = out.unionByName(own.mapInArrow(run, types))
    return written(out, "contaminated")

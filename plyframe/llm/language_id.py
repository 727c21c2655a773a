"""Language identification by interpolated Kneser-Ney character models.

One model of ORDER characters per language, over lower-cased letters with every run of other
characters as one space.  All languages share sorted arrays of n-gram hashes, one per order,
with a column of log probabilities per language; a text is looked up by binary search.  The
language of lowest mean cross-entropy wins.  A text is rejected when its cross-entropy lies
further above that of its language's calibration rows than any but a tiny share of those rows did,
measured in standard errors, which grow for short texts.

The classifier is fitted on a bounded sample: about ``rows_per_language`` labelled rows of each
language, chosen by a hash of doc_id, of at most LONGEST characters each.  That bounds the model
that is broadcast; everything predicted is predicted from whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plyframe.llm.shared import prepare

ORDER = 4
ROWS_PER_LANGUAGE = 1500
LONGEST = 20_000
PIECE = 400_000
UNDETERMINED = "und"
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_letters: dict[str, np.ndarray] = {}


def _is_letter(points: np.ndarray) -> np.ndarray:
    if "all" not in _letters:
        _letters["all"] = np.array([chr(i).isalpha() for i in range(0x110000)])
    return _letters["all"][points]


def symbols(text: str) -> tuple[np.ndarray, int]:
    """Code points of the letters, one space for each run of anything else; the number of letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _is_letter(points)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    return np.where(letter, points, 32)[keep].astype(np.uint64), int(letter.sum())


def gram_hashes(points: np.ndarray, order: int) -> np.ndarray:
    """64-bit hashes of the ``order`` characters ending at each position; the start is padded."""
    padded = np.concatenate([np.full(order - 1, 1, dtype=np.uint64), points])
    out = np.full(len(points), order, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(order):
            part = padded[i : i + len(points)]
            out = (out ^ part) * np.uint64(_MIX[i])
            out ^= out >> np.uint64(29)
    return out


@dataclass
class Model:
    """Sorted hash arrays; index 0 holds single characters.  Rows of ``logs`` are languages' log2 p."""

    languages: list[str]
    keys: list[np.ndarray]
    logs: list[np.ndarray]
    contexts: list[np.ndarray]
    backoff: list[np.ndarray]
    floor: float
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None
    noise: np.ndarray | None = None
    cut: float = 6.0

    def log_probabilities(self, points: np.ndarray) -> np.ndarray:
        """log2 p of every character under every language (characters x languages)."""
        return self._level(points, np.arange(len(points)), ORDER)

    def _level(self, points: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
        out = np.full((len(at), len(self.languages)), self.floor, dtype=np.float32)
        if not order or not len(at):
            return out
        hashes = gram_hashes(points, order)[at]
        place, hit = _find(self.keys[order - 1], hashes)
        out[hit] = self.logs[order - 1][place[hit]]
        if not hit.all():
            rest = at[~hit]
            lower = self._level(points, rest, order - 1)
            if order > 1:
                before = np.concatenate([[np.uint64(0)], gram_hashes(points, order - 1)])[rest]
                place, known = _find(self.contexts[order - 1], before)
                lower[known] += self.backoff[order - 1][place[known]]
            out[~hit] = lower
        return out


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return place, keys[place] == wanted


def _hash_of(grams: pd.Series, order: int) -> np.ndarray:
    points = np.frombuffer("".join(grams).encode("utf-32-le"), dtype=np.uint32).reshape(-1, order)
    out = np.full(len(points), order, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(order):
            out = (out ^ points[:, i].astype(np.uint64)) * np.uint64(_MIX[i])
            out ^= out >> np.uint64(29)
    return out


def train(counts: pd.DataFrame) -> Model:
    """Model from (lang, gram, n): counts of ORDER-character grams per language.

    The top order uses counts; each lower one the number of different characters that precede its
    grams.  p(c|h) = max(n - D, 0)/N(h) + D T(h)/N(h) p(c|shorter h), T the kinds of c after h,
    D = n1 / (n1 + 2 n2) of that order.  A single character's remainder is spread evenly.
    """
    languages = sorted(counts["lang"].unique())
    per_order: list[dict[str, pd.DataFrame]] = [{} for _ in range(ORDER)]
    for lang, own in counts.groupby("lang"):
        grams = own[["gram", "n"]].reset_index(drop=True)
        for order in range(ORDER, 0, -1):
            per_order[order - 1][lang] = grams
            shorter = grams["gram"].str[1:]
            grams = shorter.value_counts().rename_axis("gram").reset_index(name="n")
    alphabet = len(set().union(*(set(t["gram"]) for t in per_order[0].values()))) + 1
    floor = float(-np.log2(alphabet + 1))
    model = Model(languages, [], [], [], [], floor)
    lower: dict[str, pd.Series] = {}
    for order in range(1, ORDER + 1):
        tables = per_order[order - 1]
        union = pd.Index(sorted(set().union(*(set(t["gram"]) for t in tables.values()))))
        contexts = pd.Index(sorted(set(union.str[:-1]))) if order > 1 else pd.Index([""])
        logs = np.zeros((len(union), len(languages)))
        weights = np.zeros((len(contexts), len(languages)))
        for k, lang in enumerate(languages):
            own = tables[lang]
            n1, n2 = (own["n"] == 1).sum(), (own["n"] == 2).sum()
            discount = min(0.95, max(0.1, n1 / (n1 + 2 * n2))) if n1 + n2 else 0.5
            head = own["gram"].str[:-1]
            total = own["n"].groupby(head).sum()
            kinds = own["n"].groupby(head).size()
            left = (discount * kinds / total).reindex(contexts).fillna(1.0)
            weights[:, k] = left.to_numpy()
            direct = own.set_index("gram")["n"].sub(discount).clip(lower=0).reindex(union).fillna(0.0)
            of = union.str[:-1]
            base = total.reindex(of).to_numpy()
            below = lower[lang].reindex(union.str[1:]).to_numpy() if order > 1 else np.full(len(union), 1 / (alphabet + 1))
            logs[:, k] = np.where(np.isnan(base), 0, direct.to_numpy() / np.nan_to_num(base, nan=1.0)) + left.reindex(of).to_numpy() * below
        lower = {lang: pd.Series(logs[:, k], index=union) for k, lang in enumerate(languages)}
        if order == 1:
            floors = weights[0] / (alphabet + 1)  # an unknown character
            model.floor = float(np.log2(floors.min()))
        hashed = _hash_of(union.to_series(), order)
        place = np.argsort(hashed)
        model.keys.append(hashed[place])
        model.logs.append(np.log2(logs[place]).astype(np.float32))
        if order > 1:
            known = _hash_of(contexts.to_series(), order - 1)
            place = np.argsort(known)
            model.contexts.append(known[place])
            model.backoff.append(np.log2(weights[place]).astype(np.float32))
        else:
            model.contexts.append(np.zeros(0, dtype=np.uint64))
            model.backoff.append(np.zeros((0, len(languages)), dtype=np.float32))
    return model


def entropies(model: Model, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: summed bits per language, characters, letters.  Texts are read whole, in pieces."""
    bits = np.zeros((len(texts), len(model.languages)))
    chars, letters = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
    held: list[tuple[int, np.ndarray]] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if held:
            gap = np.full(ORDER - 1, 1, dtype=np.uint64)
            joined = np.concatenate([x for _, p in held for x in (gap, p)])
            logs = model.log_probabilities(joined)
            start = 0
            for i, p in held:
                start += len(gap)
                bits[i] -= logs[start : start + len(p)].sum(axis=0, dtype=np.float64)
                start += len(p)
        held.clear()
        size = 0

    for i, text in enumerate(texts):
        for start in range(0, len(text or ""), PIECE):
            points, n = symbols(text[start : start + PIECE])
            letters[i] += n
            if len(points):
                chars[i] += len(points)
                held.append((i, points))
                size += len(points)
                if size >= PIECE:
                    flush()
    flush()
    return bits, chars, letters


def _sample(docs: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` labelled rows of each language, by a hash of doc_id."""
    sized = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") <= LONGEST))
    each = {r["lang"]: r["n"] for r in sized.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row per language
    if not each:
        return sized.where(F.lit(False))
    shares = F.create_map(*(x for k, n in each.items() for x in (F.lit(k), F.lit(min(1.0, rows / n)))))
    drawn = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(17)), F.lit(1_000_003)) / 1_000_003.0
    return sized.where(drawn < shares[F.col("lang")])


def fit(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> Model | None:
    """Model of the labelled rows of ``docs`` (doc_id, text, lang); None if there are none.

    A fifth of the sample is kept from the counts and calibrates the rejection, as far as its rows
    are given their own language (a wrong label says nothing about typical entropies).
    """
    prepare(docs.sparkSession)
    sample = _sample(docs, rows_per_language).select("doc_id", "text", "lang")
    apart = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(23)), F.lit(5)) == 0

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for lang, own in batch.select(["lang", "text"]).to_pandas().groupby("lang"):
                parts = []
                for text in own["text"]:
                    p, _ = symbols(text)
                    padded = np.concatenate([np.full(ORDER - 1, 1, dtype=np.uint64), p]).astype(np.uint32)
                    if len(p):
                        parts.append(np.lib.stride_tricks.sliding_window_view(padded, ORDER))
                if parts:
                    text = np.ascontiguousarray(np.concatenate(parts)).view(f"<U{ORDER}")[:, 0]
                    kinds, n = np.unique(text, return_counts=True)
                    found.append(pd.DataFrame({"lang": lang, "gram": kinds.astype(object), "n": n.astype(np.int64)}))
            if found:
                yield pa.RecordBatch.from_pandas(pd.concat(found), preserve_index=False)

    kept = sample.where(~apart).mapInArrow(grams, "lang string, gram string, n long")
    counts = kept.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()  # bounded by the sample
    if counts.empty:
        return None
    model = train(counts)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, chars, letters = entropies(shared.value, batch.column("text").to_pylist())
            index = {x: i for i, x in enumerate(shared.value.languages)}
            langs = [index.get(x, -1) for x in batch.column("lang").to_pylist()]
            rows = [(k, bits[i, k] / chars[i], int(chars[i])) for i, k in enumerate(langs) if k >= 0 and letters[i] and bits[i].argmin() == k]
            yield pa.RecordBatch.from_pydict(
                {"k": pa.array([r[0] for r in rows], pa.int32()), "x": pa.array([r[1] for r in rows], pa.float64()), "n": pa.array([r[2] for r in rows], pa.int64())}
            )

    held = sample.where(apart).mapInArrow(measured, "k int, x double, n long").toPandas()  # bounded by the sample
    size = len(model.languages)
    model.mean, model.spread, model.noise = np.full(size, 4.0), np.full(size, 0.5), np.full(size, 4.0)
    for k, own in held.groupby("k"):
        middle = own["x"].median()
        model.mean[k] = middle
        long = own[own["n"] >= 200]
        model.spread[k] = max(0.05, 1.4826 * (long["x"] - middle).abs().median()) if len(long) >= 5 else 0.2
        model.noise[k] = max(1.0, 1.4826 * ((own["x"] - middle).abs() * np.sqrt(own["n"])).median())
    if len(held):
        k = held["k"].to_numpy()
        z = (held["x"] - model.mean[k]) / np.sqrt(model.spread[k] ** 2 + model.noise[k] ** 2 / held["n"])
        model.cut = float(max(6.0, 1.5 * np.quantile(z, 0.999)))
    return model


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` plus lang_pred, score (0 to 1), bits_per_char and rejected; columns of those names are replaced.

    The prediction reads ``text`` alone, whole.  Defined cases: a text that is null or has no letter
    gets ``und``, score 0, is rejected; without a model every text does; ties go to the language
    first in the alphabet; repeated rows are judged alike; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = ["lang_pred", "score", "bits_per_char", "rejected"]
    kept = [c for c in docs.columns if c not in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            langs, scores, rates, outs = [], [], [], []
            if m is not None:
                bits, chars, letters = entropies(m, texts)
            for i in range(len(texts)):
                if m is None or not letters[i]:
                    langs.append(UNDETERMINED), scores.append(0.0), rates.append(None), outs.append(True)
                    continue
                rate = bits[i] / chars[i]
                k = int(rate.argmin())
                lead = np.exp2(-np.minimum(60.0, (rate - rate[k]) * min(int(chars[i]), 40)))
                z = (rate[k] - m.mean[k]) / np.sqrt(m.spread[k] ** 2 + m.noise[k] ** 2 / chars[i])
                langs.append(m.languages[k]), scores.append(float(1 / lead.sum())), rates.append(float(rate[k])), outs.append(bool(z > m.cut))
            columns = [batch.column(c) for c in kept] + [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rates, pa.float64()), pa.array(outs, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *added])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)
    return docs.select(*kept).mapInArrow(run, f"{types}, lang_pred string, score double, bits_per_char double, rejected boolean")


def training_rows(docs: DataFrame) -> DataFrame:
    """The rows models may be learned from: crc32 of the doc_id's digits is no multiple of five."""
    return docs.where(~held_out()).select("doc_id", "text", "lang")


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))

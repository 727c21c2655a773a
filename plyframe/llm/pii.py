"""Personal data by weak supervision.

Base spans (email, ip, card, phone) follow fixed patterns.  Looser detectors propose further
spans beside them; labelers (shape, gazetteer, context words, surroundings) vote on every proposal
and on the base spans, which anchor the votes.  Votes are counted per pattern over all documents;
expectation-maximisation estimates each labeler's reliability per kind and a posterior per pattern; a
logistic classifier of the votes and coarse form is trained on those and decides which proposals
stay.  Base spans stay whatever it says.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plyframe.llm.shared import prepare, written

# Kinds in the order of the result, and the character classes of the base patterns.
KINDS = ["email", "ip", "card", "phone", "secret"]
BASE_KINDS = KINDS[:4]
LOCAL_PART = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)+")
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
DIALLED = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Own values: what the labelers know.
CUES = {
    "email": {"email", "mail", "e-mail", "contact", "correo", "courriel"},
    "ip": {"ip", "host", "server", "address", "addr", "login"},
    "card": {"card", "visa", "mastercard", "credit", "carte", "karte", "tarjeta", "account"},
    "phone": {"phone", "tel", "call", "mobile", "fax", "telefon", "telefono", "téléphone", "teléfono"},
    "secret": {"token", "secret", "key", "password", "passwd", "api_key", "apikey", "auth", "bearer"},
}
ENDINGS = {"com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "info", "eu"}
KEY_STARTS = ("sk_", "pk_", "ghp_", "AKIA", "xoxb", "eyJ")
SPELT = re.compile(
    r"(?<![A-Za-z0-9._%+-])[.%+-]*+([A-Za-z0-9_][A-Za-z0-9._%+-]*+ ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]++(?: ?(?:\(dot\)|\[dot\]|\.) ?[A-Za-z0-9-]++)+)"
)
SIXES = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
NUMBER = re.compile(r"(?<![\w.+-])\(?[0-9](?:[ ().-]*+[0-9]){6,18}(?![\w-])")  # as many digits as are looked for
OPAQUE = re.compile(r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{20,}+(?![A-Za-z0-9_+/=-])")
SHOWN = 0.9  # a proposal stays from this probability on


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the four base kinds, each kind leftmost and without overlap, by kind, then start.

    Every scan is linear: an email is looked for around each @, dotted numbers are read as whole chains of
    which each four parts are one match.
    """
    spans: list[tuple[str, int, int]] = []
    low, at = 0, text.find("@")
    while at >= 0:
        start = low + len(text[low:at].rstrip(LOCAL_PART))
        low = at + 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            spans.append(("email", start, m.end()))
            low = m.end()
        at = text.find("@", low)
    for m in DOTTED.finditer(text):
        at, parts = m.start(), m.group().split(".")
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                spans.append(("ip", at, end))
            at = end + 1
    for m in DIGITS.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and passes_luhn(digits):
                spans.append(("card", *m.span()))
    if "+" in text:
        for m in DIALLED.finditer(text):
            if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                spans.append(("phone", *m.span()))
    return spans


def proposals(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans of looser detectors that touch no base span and, from left to right, not each other."""
    found = []
    if "at" in text and ("(at)" in text or "[at]" in text):
        found += [("email", *m.span(1)) for m in SPELT.finditer(text)]
    if ":" in text:
        found += [("ip", *m.span()) for m in SIXES.finditer(text)]
    for m in NUMBER.finditer(text):
        n = sum(c.isdigit() for c in m.group())
        if 7 <= n <= 19:
            found.append(("card" if n >= 13 else "phone", *m.span()))
    for m in OPAQUE.finditer(text):
        word = m.group()
        if any(c.isdigit() for c in word) and any(c.isalpha() for c in word):
            found.append(("secret", *m.span()))
    out, blocked = [], sorted((s, e) for _, s, e in taken)
    found.sort(key=lambda x: (x[1], -x[2]))
    i, end = 0, -1
    for kind, s, e in found:
        while i < len(blocked) and blocked[i][1] <= s:
            i += 1
        if s >= end and not (i < len(blocked) and blocked[i][0] < e):
            out.append((kind, s, e))
            end = e
    return out


def votes(text: str, kind: str, start: int, end: int) -> tuple[int, ...]:
    """Shape, gazetteer, context, surroundings: 1 for, -1 against, 0 no opinion; then a length class."""
    span = text[start:end]
    digits = [c for c in span if "0" <= c <= "9"]
    before = text[max(0, start - 24) : start].lower()
    words = set(re.findall(r"[^\W\d_][\w-]*", before)[-3:])
    if kind == "email":
        shape = 1 if "." in span else -1
        known = 1 if span.rsplit(".", 1)[-1].lower().strip(" )]") in ENDINGS else 0
    elif kind == "ip":
        shape, known = (1, 0) if len(span) >= 7 else (-1, 0)
    elif kind == "card":
        shape = 1 if passes_luhn("".join(digits)) else -1
        known = 1 if digits[0] in "3456" else -1
    elif kind == "phone":
        shape = 1 if span[0] in "+(" or re.search(r"[0-9][ .-][0-9]{3}", span) else -1
        known = 1 if span.startswith("+") or digits[0] == "0" else 0
    else:
        spread = -sum(n / len(span) * math.log2(n / len(span)) for n in Counter(span).values())
        shape = 1 if spread >= 3.0 else -1
        known = 1 if span.startswith(KEY_STARTS) or re.fullmatch(r"[0-9a-f]{32,64}", span) else 0
    context = 1 if words & CUES[kind] else (-1 if any(words & c for k, c in CUES.items() if k != kind) else 0)
    edge = text[start - 1 : start] + text[end : end + 1]
    around = 1 if edge.strip(" \t\r\n\"'.,;:()") == "" else -1
    return shape, known, context, around, min(7, len(span) // 8)


def pattern(kind: str, base: bool, v: tuple[int, ...]) -> int:
    """One number of kind, origin, votes and length class: 5 x 2 x 81 x 8 at most."""
    code = KINDS.index(kind) * 2 + base
    for x in v[:4]:
        code = code * 3 + x + 1
    return code * 8 + v[4]


def unpacked(code: int) -> tuple[int, int, tuple[int, ...], int]:
    code, length = divmod(code, 8)
    v = []
    for _ in range(4):
        code, x = divmod(code, 3)
        v.append(x - 1)
    return code // 2, code % 2, tuple(reversed(v)), length


def reliabilities(counts: dict[int, int], rounds: int = 50) -> dict[int, float]:
    """Posterior of each vote pattern by expectation-maximisation per kind.

    Each labeler has a chance of each vote given a true and a false span; origin in the base
    patterns is one more labeler.  Starts from the majority of the votes.
    """
    posterior: dict[int, float] = {}
    for kind in range(len(KINDS)):
        codes = [c for c in counts if unpacked(c)[0] == kind]
        if not codes:
            continue
        n = np.array([counts[c] for c in codes], dtype=float)
        v = np.array([[*unpacked(c)[2], unpacked(c)[1] or -1] for c in codes])
        p = 1 / (1 + np.exp(-v.sum(axis=1).astype(float)))
        for _ in range(rounds):
            prior = (1 + (n * p).sum()) / (2 + n.sum())
            log = np.full(len(codes), math.log(prior) - math.log(1 - prior))
            for j in range(v.shape[1]):
                for x in (-1, 0, 1):
                    at = v[:, j] == x
                    # A vote for a span is never taken as evidence against it, nor the other way round.
                    yes = (0.5 + (n * p)[at].sum()) / (1.5 + (n * p).sum())
                    no = (0.5 + (n * (1 - p))[at].sum()) / (1.5 + (n * (1 - p)).sum())
                    weight = math.log(yes / no)
                    log[at] += max(0.0, weight) if x > 0 else min(0.0, weight) if x < 0 else 0.0
            p = 1 / (1 + np.exp(-np.clip(log, -30, 30)))
        posterior |= dict(zip(codes, p.tolist(), strict=True))
    return posterior


def classifier(counts: dict[int, int], posterior: dict[int, float], steps: int = 400) -> dict[int, float]:
    """Probability of each pattern under a logistic model of kind, votes and length, fitted to the posteriors."""
    codes = list(counts)
    if not codes:
        return {}
    rows = []
    for c in codes:
        kind, _, v, length = unpacked(c)
        x = np.zeros(1 + len(KINDS) * 14)
        x[0] = 1
        own = x[1 + kind * 14 : 15 + kind * 14]
        own[0], own[1:5], own[5 + length] = 1, v, 1
        own[13] = v[0] * max(v[1], v[2])
        rows.append(x)
    x, y = np.array(rows), np.array([posterior[c] for c in codes])
    n = np.array([counts[c] for c in codes], dtype=float)
    n = np.sqrt(n) / np.sqrt(n).sum()  # common patterns do not drown rare ones
    w = np.zeros(x.shape[1])
    for _ in range(steps):  # Newton steps with a ridge
        p = 1 / (1 + np.exp(-x @ w))
        step = np.linalg.solve((x.T * (n * p * (1 - p))) @ x + 1e-3 * np.eye(len(w)), x.T @ (n * (y - p)) - 1e-3 * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return dict(zip(codes, (1 / (1 + np.exp(-x @ w))).tolist(), strict=True))


def candidate_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): base spans and proposals of every whole text, by kind, then start."""
    prepare(docs.sparkSession)
    one = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("base", pa.bool_()), ("pattern", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = {k: i for i, k in enumerate(KINDS)}
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                text = text or ""
                base = base_spans(text)
                every = [(k, s, e, True) for k, s, e in base] + [(k, s, e, False) for k, s, e in proposals(text, base)]
                every.sort(key=lambda x: (order[x[0]], x[1], x[2]))
                out.append([{"kind": k, "start": s, "stop": e, "base": b, "pattern": pattern(k, b, votes(text, k, s, e))} for k, s, e, b in every])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.list_(one))], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, spans array<struct<kind:string,start:bigint,stop:bigint,base:boolean,pattern:int>>"
    )


def find_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) of every row: all base spans and the proposals the classifier keeps.

    Offsets count code points, ends are exclusive.  Defined cases: null text counts as empty and has
    no spans; texts are read whole; repeated rows are judged alike; an empty table gives no rows;
    other columns are ignored.
    """
    found = written(candidate_spans(docs), "pii-candidates")
    counted = found.select(F.explode("spans.pattern").alias("pattern")).groupBy("pattern").count()
    counts = {r["pattern"]: r["count"] for r in counted.collect()}  # at most 6480 patterns
    chance = classifier(counts, reliabilities(counts))
    kept = [c for c, p in chance.items() if p >= SHOWN]
    stays = F.array(*map(F.lit, kept)) if kept else F.array().cast("array<int>")
    return found.select("doc_id", F.filter("spans", lambda s: s["base"] | F.array_contains(stays, s["pattern"])).alias("spans"))


def digests(found: DataFrame) -> DataFrame:
    """Counts of the base spans per kind, their digest, and all spans as text."""
    said = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> F.Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    counted = [count(k) for k in BASE_KINDS]
    return found.select(
        "doc_id",
        *counted,
        F.sha2(F.array_join(F.transform(base, said), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", said), ",").alias("spans"),
    )

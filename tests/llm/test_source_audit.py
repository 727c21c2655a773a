"""Source audit against a direct count, with small tiles and blocks, and on odd tables."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from plyframe.llm import source_audit

DOCS = "doc_id long, text string, lang string, source string"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute(rows, least, top):
    low = lambda w: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
    rows = [(t or "", lang or "", s or "") for _, t, lang, s in rows]
    out = set()
    for lang in {x[1] for x in rows}:
        found = [(s, Counter(low(w) for w in TERM.findall(t))) for t, x, s in rows if x == lang]
        kept = [w for w, n in Counter(w for _, c in found for w in c).items() if n >= least]
        groups = {s: Counter() for s, _ in found}
        for s, c in found:
            groups[s].update({w: c[w] for w in kept if w in c})
        whole = sum(groups.values(), Counter())
        share = lambda c, w: 1 + 10**9 * (c[w] + 5) // (sum(c.values()) + 5 * len(kept))
        for s, c in groups.items():
            pairs = sorted(((-sum(abs(share(c, w) - share(d, w)) for w in kept), t.encode(), t) for t, d in groups.items() if t != s))
            terms = sorted(((share(whole, w) - share(c, w), w.encode(), w) for w in kept if c[w] and share(c, w) > share(whole, w)))[:top]
            out |= {(lang, s, part, x[2], -x[0], i) for part, held in (("pair", pairs), ("term", terms)) for i, x in enumerate(held, 1)}
    return out


def rows_of(seed, n, sources):
    r = random.Random(seed)
    words = [f"{a}{b}" for a in ("Stone", "ÜBER", "éau", "x", "light", "字") for b in "abcdefgh"]
    return [(i, " ".join(r.choice(words[: 8 + 5 * (i % 8)]) + r.choice([" ", ", ", "1", "\n"]) for _ in range(r.randrange(40))), r.choice(["de", "en", "en"]), f"s{r.randrange(sources)}") for i in range(n)]


@pytest.mark.parametrize(("size", "block"), [(source_audit.TILE, source_audit.BLOCK), (7, 2)])
def test_counts_of_all_terms(spark, size, block):
    rows = rows_of(3, 160, 6) + [(None, None, "en", "s1"), (1, "", None, None), (1, "only here", "xx", None), (2, "and there", "xx", "b"), (2, "and there", "xx", "b")]
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(1) for c in ("term", "n", "docs", "v", "total", "tile", "part", "rank")})
    got = {tuple(x) for x in source_audit.audit(docs, least=5, top=4, size=size, block=block).collect()}
    assert got == brute(rows, 5, 4)


def test_flushes_and_long_texts(spark, monkeypatch):
    """Counts do not depend on how much a task holds or at how many bytes a text is cut."""
    text = ("Aa bb ÉÉ " * 50).encode()
    whole = source_audit.term_counts(text)
    for piece in (1, 3, 10, 64):
        monkeypatch.setattr(source_audit, "PIECE", piece)
        assert source_audit.term_counts(text) == whole == Counter({b"aa": 50, b"bb": 50, "ÉÉ".encode(): 50})
    assert source_audit.term_counts(b"a" * 500) == Counter({b"a" * 500: 1})


def test_large_counts_are_exact(spark):
    """Counts whose product with the scale is beyond 64 bits."""
    df = spark.createDataFrame([(10**12 + 7, 3 * 10**12 + 1, 10**6)], "c long, n long, v long")
    got = df.select(source_audit.share(F.col("c"), F.col("n"), F.col("v")).alias("p")).first().p
    assert got == 1 + 10**9 * (10**12 + 12) // (3 * 10**12 + 1 + 5 * 10**6)


def test_empty_table(spark):
    assert source_audit.audit(spark.createDataFrame([], DOCS)).count() == 0

"""The operators against brute force, on small texts and odd tables."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer as Library

from plyframe.llm import bpe, decontamination, html_text, language_id, line_dedup, pii, shared, simhash, substring_dedup, topk, warc
from plyframe.llm.queries import VOCABULARY

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and with stone river morning light over under water bright field home letter".split()


def prose(seed, words):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", ",", "."]) for _ in range(words))


def frame(spark, texts, **extra):
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumns({k: F.lit(v) for k, v in extra.items()})


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty and long texts, copies, near copies, clashing column names."""
    base = prose(1, 400)
    lines = "\n".join(prose(i, 12) for i in range(2, 9))
    texts = [None, "", " \n\t", base, base, base.replace("stone", "stonE", 1), "x " + base, lines, lines.replace("river", "rivers", 1),
             "aaaa" * 200, prose(3, 6000), "Ünï ✓ " * 60, "short"]
    return frame(spark, texts, ids=1, key="k", score=2.0, gone=3, n_lines=9, fp=0, version=5)


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_components(spark):
    r = random.Random(5)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(100, i) for i in range(101, 160)]
    roots = {i: i for e in edges for i in e}

    def find(x):
        while roots[x] != x:
            x = roots[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        roots[max(x, y)] = min(x, y)
    got = {x.node: x.root for x in shared.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: find(i) for i in roots if find(i) != i}
    assert shared.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- SimHash


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words)] if len(words) < 3 else [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_fingerprints(spark, odd):
    got = by_id(simhash.near_duplicates(odd))
    for row in odd.collect():
        assert got[row.doc_id].fingerprint == format(plain_fingerprint(row.text), "016x")
    assert got[3].component_id == got[4].component_id == 3
    assert got[0].component_id == got[1].component_id == got[2].component_id == 0
    assert simhash.near_duplicates(odd.limit(0)).count() == 0


@pytest.mark.parametrize("crowd", [64, 1])
def test_simhash_links(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    r = random.Random(9)
    numbers = [r.getrandbits(64) for _ in range(40)]
    numbers += [n ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for n in numbers[:20]] + [n ^ 7 for n in numbers[:10]]
    signed = sorted({n - (1 << 64) if n >> 63 else n for n in numbers})
    edges = simhash.links(spark.createDataFrame([(n,) for n in signed], "fp long"))
    got = {x.node: x.root for x in shared.connected_components(edges).collect()}
    far = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count()
    seen, want = set(), {}
    for n in signed:
        if n not in seen:
            group, stack = {n}, [n]
            while stack:
                x = stack.pop()
                new = {y for y in signed if y not in group and far(x, y) <= 2}
                group |= new
                stack += new
            seen |= group
            want |= {y: n for y in group if y != n}
    assert got == want


def test_without_near_copies(spark, odd):
    kept = simhash.without_near_copies(odd)
    assert kept.columns == odd.columns
    assert {3, 4} & {r.doc_id for r in kept.collect()} == {3}


# --- language


def test_language(spark):
    letters = {"en": "the and with river stone light over", "de": "der und mit über straße größe licht"}
    rows = []
    for i in range(240):
        lang = ["en", "de"][i % 2]
        r = random.Random(i)
        rows.append((i, " ".join(r.choice(letters[lang].split()) for _ in range(30)), lang, "s", 1))
    docs = spark.createDataFrame(rows, DOCS)
    model = language_id.fit(language_id.training_rows(docs))
    held = language_id.identify(docs.where(language_id.held_out()), model).collect()
    assert len(held) > 20 and all(r.lang == r.lang_pred and 0 <= r.score <= 1 and not r.rejected for r in held)
    odd = frame(spark, [None, "", "123 !?", "the river", "κόσμος " * 200]).select("doc_id", "text", F.lit(1).alias("score"))
    got = by_id(language_id.identify(odd, model))
    assert [got[i].lang_pred for i in range(3)] == ["und"] * 3 and got[3].lang_pred == "en" and got[4].rejected
    assert language_id.fit(docs.where("lang is null")) is None
    assert {r.lang_pred for r in language_id.identify(docs, None).collect()} == {"und"}


def test_language_probabilities_sum_to_one():
    import pandas as pd

    text = "abracadabra abba cadabra bad cab " * 3
    points, _ = language_id.symbols(text)
    padded = "\x01\x01\x01" + "".join(map(chr, points))
    grams = pd.Series([padded[i : i + 4] for i in range(len(points))]).value_counts()
    model = language_id.train(pd.DataFrame({"lang": "x", "gram": grams.index, "n": grams.to_numpy()}))
    alphabet = sorted(set(map(chr, points)))
    for history in ("abr", "zzz", " ab"):
        total = sum(2.0 ** float(model.log_probabilities(np.array([ord(c) for c in history + a], dtype=np.uint64))[-1, 0]) for a in alphabet)
        assert 0.85 < total <= 1.0001  # the rest is for characters never seen


# --- BPE


def test_bpe_equals_library(spark, odd):
    library = Library.from_file(VOCABULARY)
    library.no_truncation(), library.no_padding()
    mine = bpe.Tokenizer(bpe.read_file(VOCABULARY))
    r = random.Random(3)
    cases = ["", "  ", "<|startoftext|>a<|endoftext|>", "ΑΣ Σ", "don't I'LL", "a\x1cb\x85c", "x" * 300, "日本語 ١٢ 😀"]
    cases += ["".join(r.choice("abcdeinorst'!.,01 éñ\n") for _ in range(r.randrange(60))) for _ in range(2000)]
    for text in cases:
        ids = library.encode(text, add_special_tokens=False).ids
        assert mine.encode(text) == ids
        assert mine.decode(ids) == library.decode(ids, skip_special_tokens=False)
    got = by_id(bpe.digests(bpe.encode_decode(odd, public_tokenizers.path("word_bpe_49k.json"))))
    for row in odd.collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        assert got[row.doc_id].n_tokens == len(ids)
        assert got[row.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert bpe.encode_decode(odd.limit(0), VOCABULARY).count() == 0


# --- personal data


def plain_spans(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"\D", "", m.group())
        if 16 <= len(digits) <= 19 and pii.passes_luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub(r"\D", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_base_spans():
    r = random.Random(4)
    for alphabet in ("a.@-+%1 2(05)é9", "411 -0.", "@a.1"):
        for _ in range(4000):
            text = "".join(r.choice(alphabet) for _ in range(r.randrange(50)))
            assert pii.base_spans(text) == plain_spans(text)


def test_found_spans(spark):
    texts = [None, "", "mail a.b@c.org now"] + [f'the token = "{hashlib.sha1(str(i).encode()).hexdigest()}" and x{i}@y.com' for i in range(30)]
    got = by_id(pii.digests(pii.find_spans(frame(spark, texts, spans="x"))))
    assert got[0].spans == got[1].spans == "" and got[0].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[2].spans == "email:5:14" and got[2].n_email == 1
    assert got[5].spans.startswith("email:") and ",secret:13:53" in got[5].spans
    assert pii.find_spans(frame(spark, ["a"]).limit(0)).count() == 0


# --- byte strings


def plain_bytes(docs):
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        data = (text or "").encode()
        gone = np.zeros(len(data), dtype=bool)
        for i in range(len(data) - 99):
            window = data[i : i + 100]
            gone[i : i + 100] |= window in seen
            seen.add(window)
        kept = bytes(np.frombuffer(data, dtype=np.uint8)[~gone])
        out[doc_id] = (len(data), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot, portion, shard", [(8000, 1_000_000, 250_000), (0, 3000, 700), (8000, 3000, 700)])
def test_substrings(spark, odd, monkeypatch, hot, portion, shard):
    for name, value in (("HOT", hot), ("PORTION", portion), ("SHARD", shard), ("PIECE", 1 << 12)):
        monkeypatch.setattr(substring_dedup, name, value)
    r = random.Random(8)
    passage = prose(99, 40)
    more = frame(spark, [prose(50 + i, r.randrange(5, 80)) + passage[r.randrange(60) :] + prose(80 + i, 20) for i in range(30)])
    docs = odd.select(*more.columns).union(more.withColumn("doc_id", F.col("doc_id") + 100))
    got = by_id(substring_dedup.digests(substring_dedup.dedupe_bytes(docs)))
    want = plain_bytes([(x.doc_id, x.text) for x in docs.collect()])
    assert {k: (v.n_bytes, v.n_removed, v.n_spans, v.kept_sha256) for k, v in got.items()} == want
    assert substring_dedup.dedupe_bytes(docs.limit(0)).count() == 0


def test_substrings_of_repeated_rows(spark, odd):
    """Rows that repeat doc_id and text lose what the document would lose alone."""
    for parts in (1, 3):
        doubled = odd.union(odd).repartition(parts, F.rand(1))
        got = substring_dedup.digests(substring_dedup.dedupe_bytes(doubled)).collect()
        want = plain_bytes([(x.doc_id, x.text) for x in odd.collect()])
        assert len(got) == 2 * len(want)
        assert all((v.n_bytes, v.n_removed, v.n_spans, v.kept_sha256) == want[v.doc_id] for v in got)


@pytest.mark.parametrize("known", [20_000, 2])
def test_met_stretches(monkeypatch, known):
    """What a task calls repeats are later places of equal stretches, whichever order it meets them in."""
    monkeypatch.setattr(substring_dedup, "KNOWN", known)
    r, met, all_rows = np.random.default_rng(3), substring_dedup.Met(), []
    found = []
    for _ in range(12):
        rows = np.stack([r.integers(0, 3, 40), r.integers(0, 4, 40), r.integers(0, 50, 40), r.integers(1, 9, 40)])
        found.append(met.repeats(*rows))
        all_rows.append(rows)
    rows, found = np.concatenate(all_rows, axis=1).T.tolist(), np.concatenate(found)
    least = {}
    for k, c, *place in rows:
        least[k, c] = min(least.get((k, c), place), place)
    assert found.any() and not any(f and least[x[0], x[1]] == x[2:] for f, x in zip(found, rows, strict=True))
    kept = {tuple(x) for f, x in zip(found, rows, strict=True) if not f}
    assert all((k, c, *place) in kept for (k, c), place in least.items())


# --- lines


def distance_at_most_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_lines(spark, odd):
    r = random.Random(2)
    lines = [prose(i, 8) for i in range(25)]
    texts = []
    for _ in range(40):
        own = [r.choice(lines) for _ in range(5)]
        for k in range(2):
            at = r.randrange(len(own[k]))
            own[k] = own[k][:at] + r.choice(["", "q", own[k][at] + "z"]) + own[k][at + 1 :]
        texts.append("\n".join([*own, "tiny", "tiny"]))
    docs = frame(spark, [None, "", *texts], n_removed=7, place=1)
    got = by_id(line_dedup.dedupe_lines(docs))
    seen = []
    for row in docs.orderBy("doc_id").collect():
        kept = []
        for line in (row.text or "").split("\n"):
            text = line.strip()
            if len(text) >= line_dedup.MIN_CHARS:
                again = any(distance_at_most_one(text, x) for x in seen)
                seen.append(text)
                if again:
                    continue
            kept.append(line)
        assert got[row.doc_id].text == (None if row.text is None else "\n".join(kept))
    assert line_dedup.dedupe_lines(docs.limit(0)).count() == 0
    assert line_dedup.dedupe_lines(odd).count() == odd.count()


# --- codes


def test_topk(spark):
    r = random.Random(6)
    centres = [[r.gauss(0, 1) for _ in range(64)] for _ in range(5)]
    rows = [(i, [x + r.gauss(0, 0.4) for x in centres[i % 5]]) for i in range(150)]
    rows += [(150 + i, rows[0][1]) for i in range(30)] + [(None, rows[0][1]), (500, None), (150, rows[0][1])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    codes = topk.sign_codes(vectors)
    got = topk.search(codes, codes.where("vec_id % 10 = 0"), k=7).collect()
    bits = {i: [x > 0 for x in v] for i, v in rows if i is not None and v is not None}
    for q in (i for i in bits if i % 10 == 0):
        order = sorted((sum(a != b for a, b in zip(bits[q], bits[i], strict=True)), i) for i in bits if i != q)[:7]
        assert sorted((x.rank, x.distance, x.vec_id) for x in got if x.query_id == q) == [(n + 1, *o) for n, o in enumerate(order)]
    assert topk.search(codes.limit(0), codes, k=3).count() == 0
    assert topk.search(codes.limit(0), codes.limit(0), k=3).count() == 0


# --- pages


def test_warc(spark):
    big = "<p>" + "é" * 800
    rows = [(1, "http://a.b.org/x?y=1", big), (7, "http://a.b.org/x?y=1", big), (3, None, big), (4, "u\r\nv", ""), (5, "https://c.de:81/", None), (6, "http://[bad", "s"), (None, "http://z.org", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    got = {r.page_id: r for r in warc.archive_and_read(pages, shared.scratch(spark, "warc")).collect()}
    assert len(got) == len(rows)
    for page_id, _, page in rows:
        data = (page or "").encode()
        assert (got[page_id].payload_bytes, got[page_id].payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
    assert [got[i].refers_to for i in (1, 3, 7, None)] == [7, 7, None, 7]
    assert got[7].payload == big.encode() and got[1].payload is None and got[4].record_type == "response"
    empty = shared.scratch(spark, "warc")
    assert warc.archive_and_read(pages.limit(0), empty).count() == 0
    assert warc.reversed_key("http://www.a.org:80/x?y") == "org,a,www:80)/x?y"


def test_warc_lookup(spark, monkeypatch):
    rows = [(i, f"http://h{i % 13}.org/p{i % 40}", f"text {i}") for i in range(900)]
    folder = shared.scratch(spark, "warc")
    captures = warc.write_records(spark.createDataFrame(rows, "page_id long, url string, html string"), folder)
    ranges = warc.write_index(captures, folder)
    keys = spark.createDataFrame([("org,h3)/p3",), ("org,nobody)/",)], "key string")
    found = {r.page_id for r in warc.lookup(spark, folder, ranges, keys).collect()}
    assert found == {i for i, url, _ in rows if url == "http://h3.org/p3"}


def test_main_text(spark):
    page = (
        "<html><head><title>no</title><style>p{}</style></head><body><header>Site</header><nav><ul><li><a>menu</a></ul></nav>"
        "<div class='cookie-notice'>We use cookies, really.</div><article><h1>A &amp; B</h1><p>First <b>bold\n  text<br>on.<p>Second; "
        "<script>var a='</p>';</script>part.</p><aside>side</aside><form>Name</form><div class=comments><p>Nice, very nice.</p></div></article>"
        "<footer>&copy; x</footer>"
    )
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "plain < text &lt;b"), (5, "u", "<p>cut <a href='x"), (6, "u", "<" * 50 + "<!-- x")]
    got = {r.page_id: r for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1].text == "A & B\n\nFirst bold text on.\n\nSecond; part."
    assert got[2].text == got[3].text == "" and got[2].n_chars == 0
    assert got[4].text == "plain < text <b" and got[5].text == "cut"
    unnamed = "<body><div id=w><div><a>Home</a> <a>News</a></div><div><p>A long text, with marks; and more of it, so that it counts.</p><p>Another one, no less long, and with marks as well.</p></div></div>"
    assert html_text.main_text(unnamed).startswith("A long text") and "Home" not in html_text.main_text(unnamed)


# --- benchmark


def test_contaminated(spark):
    r = random.Random(1)
    rare = ["w%03d" % i for i in range(400)]
    item = lambda i: " ".join(random.Random(i).sample(rare, 30)) + "."
    items = [item(i) for i in range(6)] + ["", None]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    clean = [" ".join(r.choice(rare[:200] + WORDS * 10) for _ in range(300)) for _ in range(60)]
    words = items[1].split()
    swapped = " ".join([*words[:10], "really", *words[12:]])
    texts = [*clean, clean[0] + " " + items[0].upper() + " " + clean[1], swapped, "Intro. " + items[2], None, "", prose(1, 20_000) + " " + items[3]]
    got = {(x.doc_id, x.item_id) for x in decontamination.contaminated(frame(spark, texts, share=1), benchmark).collect()}
    assert got == {(60, 0), (61, 1), (62, 2), (65, 3)}
    assert decontamination.contaminated(frame(spark, texts), benchmark.limit(0)).count() == 0
    assert decontamination.contaminated(frame(spark, texts).limit(0), benchmark).count() == 0


def test_common_subsequence():
    r = random.Random(0)
    for _ in range(300):
        a, b = ([r.randrange(4) for _ in range(r.randrange(12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontamination.common_subsequence(a, b) == table[-1][-1]

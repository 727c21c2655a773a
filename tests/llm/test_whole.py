"""Cases that a cut would lose: short and rare items, short lines, long secrets, rows without id."""

import random

import corpus_pipeline
from plyframe.llm import decontamination, html_text, language_id, pii

COMMON = "the of and with a to in is it on for as at by from that this was are be".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in enumerate(texts)], DOCS)


def test_rare_items_among_frequent_words(spark):
    """A verbatim copy counts, whatever the words around it make of its window's vector."""
    topics = [[f"topic{i}x{k}" for k in range(5)] for i in range(200)]
    items = [" ".join(f"rare{i}x{k}" for k in range(3)) for i in range(5)] + [" ".join([*t, *COMMON]) for t in topics]
    r = random.Random(3)
    about = lambda n: " ".join(r.choice([*t, *COMMON]) for t in [r.choice(topics)] for _ in range(n))
    texts = [f"{about(37)} {items[i]} {about(41)}" for i in range(5)] + [about(150) for _ in range(600)]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in decontamination.contaminated(frame(spark, texts), benchmark).collect()}
    assert {(i, i) for i in range(5)} <= got


def test_stage_of_near_copies(spark):
    """Components of all pairs of similarity 0.8 on five-word shingles."""
    r = random.Random(11)
    texts = [None, "", "a b", "A  b"]
    for i in range(12):
        words = [f"w{r.randrange(500)}" for _ in range(200)]
        for _ in range(8):
            texts.append(" ".join(words))
            for _ in range(r.randrange(1, 5)):
                words[r.randrange(200)] = f"v{r.randrange(500)}"
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in ((t or "").lower().split() for t in texts)]
    root = list(range(len(texts)))
    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if len(x & y) >= 0.8 * len(x | y):
                a, b = sorted((root[i], root[j]))
                root = [a if k == b else k for k in root]
    kept = corpus_pipeline.keep_one_of_near_copies(spark, frame(spark, texts), "")
    assert sorted(x.doc_id for x in kept.collect()) == sorted(set(root))


def test_short_lines(spark):
    """The stage removes exact repeats of short lines, not short lines one edit away, nor blank ones."""
    docs = frame(spark, ["Menu\n\nAdd\nMenu\n\nAdd ", "Ad\nMenu\nown"])
    got = {x.doc_id: x.text for x in corpus_pipeline.remove_repeated_lines(spark, docs, "").collect()}
    assert got == {0: "Menu\n\nAdd\n", 1: "Ad\nown"}


def test_article_cards_beside_an_unnamed_body():
    """Short named articles do not displace a long body without a name."""
    body = "".join(f"<p>Paragraph {i} of the text, which is long, has marks, and goes on; so that it counts, as a body does, for the page.</p>" for i in range(6))
    cards = "".join(f"<article class=card><h3>Card {i}</h3><p>Read on.</p></article>" for i in range(4))
    got = html_text.main_text(f"<body><div class=w><div class=text>{body}</div><div class=more>{cards}</div></div></body>")
    assert got.startswith("Paragraph 0") and "Paragraph 5" in got and "Card" not in got
    alone = html_text.main_text(f"<body><div><p>Elsewhere.</p></div><article><h1>Head</h1>{body}</article></body>")
    assert alone.startswith("Head") and "Paragraph 5" in alone and "Elsewhere" not in alone


def test_paraphrase_without_one_rare_word(spark):
    """Most of an item in order counts, though one of its three rarest words is another."""
    items = [" ".join(f"w{i}x{k}" for k in range(24)) for i in range(8)]
    changed = [" ".join(w if k % 4 else "other" for k, w in enumerate(x.split())) for x in items]
    r = random.Random(2)
    texts = [" ".join([*r.choices(COMMON, k=50), x, *r.choices(COMMON, k=50)]) for x in changed]
    texts += [" ".join(f"{w} {' '.join(r.choices(COMMON, k=6))}" for w in x.split()[4::4]) for x in items * 2]  # leaves the first word the rarest
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in decontamination.contaminated(frame(spark, texts), benchmark).collect()}
    assert got == {(i, i) for i in range(8)}


def test_rows_without_id_and_shared_ids(spark):
    """What goes is the document that holds the item, whether its doc_id is null or another's too."""
    item = " ".join(f"q{k}" for k in range(20))
    rows = [(None, f"so {item} on", "a"), (None, "clean", "b"), (7, f"so {item} on", "c"), (7, "clean", "d"), (None, None, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = decontamination.without_items(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert sorted(x.source for x in kept.collect()) == ["b", "d", "e"]


def test_long_secrets_and_spelt_names():
    """Proposals cover whole runs, however long."""
    key, name = "a1B2" * 200, "first.last" * 20
    text = f"token {key} or {name} (at) {'host' * 30} (dot) org, 1 . 2 . 3 . 4 . 5 . 6 . 7 . 8 . 9 . 0"
    got = [(k, text[s:e]) for k, s, e in pii.proposals(text, [])]
    assert got == [("secret", key), ("email", f"{name} (at) {'host' * 30} (dot) org"), ("phone", text[text.index("1 . 2") :])]


def test_letters_beyond_the_first_plane():
    """Emoji are no letters, ideographs of the second plane are."""
    assert language_id.symbols("\U0001f600\U0001f680")[1] == 0
    points, letters = language_id.symbols("a\U0001f600b\U00020000")
    assert letters == 3 and points.tolist() == [97, 32, 98, 0x20000]

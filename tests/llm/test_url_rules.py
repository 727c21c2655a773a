"""URL rules: parts of urls, fixed rules, mined rules against all subsets, odd tables."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from plyframe.llm import url_rules

PAGES = "page_id long, url string, html string"


def pages_of(spark, urls):
    return spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], PAGES)


def judged(spark, urls, learned=None):
    learned = learned if learned is not None else spark.createDataFrame([], "tokens array<string>, held long, unwanted long, confidence double")
    return {x.page_id: x for x in url_rules.judge(pages_of(spark, urls), learned).collect()}


def test_parts_and_fixed_rules(spark):
    cases = [
        ("https://WWW.Example.com/en/1?x=/es/#t", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        ("http://example.com/en/", "example.com", "/en/", "example.com/en/", "block"),
        ("http://a.example.com/en/9", "a.example.com", "/en/9", "example.com/en/", "block"),
        ("http://notexample.com/en/9", "notexample.com", "/en/9", "com/", "allow"),
        ("http://example.com/EN/", "example.com", "/EN/", "com/", "allow"),
        ("http://example.com", "example.com", "", None, "allow"),
        ("http://example.com?/en/", "example.com", "", None, "allow"),
        ("http://x.net/es/1", "x.net", "/es/1", "net/es/", "block"),
        ("http://net/fr/", "net", "/fr/", "net/fr/", "block"),
        ("http://x.net/fr", "x.net", "/fr", None, "allow"),
        ("x.net/es/", "", "", None, "allow"),
        ("a\nb://x.net/es/\n1", "x.net", "/es/\n1", "net/es/", "block"),
        ("p://q://x.net/es/", "q:", "//x.net/es/", None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
    ]
    got = judged(spark, [c[0] for c in cases])
    assert [(got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in range(len(cases))] == [c[1:] for c in cases]


def test_tokens(spark):
    df = pages_of(spark, ["https://m.free-bets.org/de/963/x.html?page=2&ref=x&&page#top", None, "no host?k=1"])
    got = [x.t for x in df.orderBy("page_id").select(url_rules.tokens_of(F.col("url")).alias("t")).collect()]
    assert got == [["h:free-bets", "h:m", "h:org", "p:0", "p:de", "p:html", "p:x", "q:page", "q:ref"], [], ["q:k"]]


def random_urls(n, seed):
    r = random.Random(seed)
    return [f"http://{r.choice(['www', 'm', 'blog'])}.{r.choice(['win', 'news', 'shop'])}{r.choice(['', '-x'])}.org/{r.choice(['en', 'de', 'fr'])}/{r.choice(['bet', 'art', ''])}" for _ in range(n)]


def test_mined_rules_are_those_of_all_subsets(spark):
    urls = random_urls(400, 4)
    r = random.Random(9)
    bad = [("bet" in u and "//m." in u) or ("win" in u and "/fr/" in u and r.random() < 0.8) or r.random() < 0.05 for u in urls]
    labelled = spark.createDataFrame(list(zip(urls, bad, strict=True)), "url string, unwanted boolean")
    got = {tuple(x.tokens): (x.held, x.unwanted) for x in url_rules.mine(labelled, support=0.01, least=8, confidence=0.6).collect()}
    sets = [set(x.t) for x in labelled.select(url_rules.tokens_of(F.col("url")).alias("t")).collect()]
    counts = {}
    for tokens, b in zip(sets, bad, strict=True):
        for k in range(1, len(tokens) + 1):
            for part in itertools.combinations(sorted(tokens), k):
                held, unwanted = counts.get(part, (0, 0))
                counts[part] = (held + 1, unwanted + b)
    rules = {p: c for p, c in counts.items() if c[0] >= 8 and c[1] / c[0] >= 0.6}
    least = {p for p in rules if not any(set(q) < set(p) and rules[q][1] / rules[q][0] >= rules[p][1] / rules[p][0] for q in rules)}
    assert got == {p: rules[p] for p in least} and ("h:m", "p:bet") in got


def rules_of_all_subsets(sets, bad, least, confidence):
    counts = {}
    for tokens, b in zip(sets, bad, strict=True):
        for k in range(1, len(tokens) + 1):
            for part in itertools.combinations(sorted(tokens), k):
                held, unwanted = counts.get(part, (0, 0))
                counts[part] = (held + 1, unwanted + b)
    rules = {p: c for p, c in counts.items() if c[0] >= least and c[1] / c[0] >= confidence}
    sure = {p: c[1] / c[0] for p, c in rules.items()}
    needless = {p for p in rules for k in range(1, len(p)) for q in itertools.combinations(p, k) if sure.get(q, -1) >= sure[p]}
    return {p: c for p, c in rules.items() if p not in needless}


def mined(labelled, **limits):
    rows = url_rules.mine(labelled, **limits).collect()
    got = {tuple(x.tokens): (x.held, x.unwanted) for x in rows}
    assert len(got) == len(rows)
    return got


def labelled_of(spark, paths, bad):
    urls = ["http://a.org/" + "/".join(p) for p in paths]
    return spark.createDataFrame(list(zip(urls, bad, strict=True)), "url string, unwanted boolean")


def test_long_urls_are_mined_whole(spark):
    """More than twelve tokens a url, and a rule of those that tell least on their own."""
    r = random.Random(3)
    pool = [f"w{chr(97 + i)}" for i in range(14)]
    paths = [sorted(r.sample(pool, r.choice([11, 12, 13]))) for _ in range(60)]
    bad = [("wa" in p) != ("wb" in p) or r.random() < 0.2 for p in paths]
    want = rules_of_all_subsets([{"h:a", "h:org", *(f"p:{w}" for w in p)} for p in paths], bad, 9, 0.55)
    got = mined(labelled_of(spark, paths, bad), support=0.0, least=9, confidence=0.55)
    assert got == want and any(len(p) > 2 for p in want)


@pytest.mark.parametrize("size", [1, 2, 4])
def test_rules_do_not_depend_on_what_fp_growth_gets(spark, size):
    urls = random_urls(300, 6)
    r = random.Random(2)
    bad = [("bet" in u and "//m." in u) or r.random() < 0.3 for u in urls]
    labelled = spark.createDataFrame(list(zip(urls, bad, strict=True)), "url string, unwanted boolean")
    limits = {"support": 0.0, "least": 5, "confidence": 0.4}
    sets = [set(x.t) for x in labelled.select(url_rules.tokens_of(F.col("url")).alias("t")).collect()]
    got = mined(labelled, size=size, **limits)
    assert got == rules_of_all_subsets(sets, bad, 5, 0.4) and any(len(p) > 2 for p in got)


def test_every_token_of_repeated_long_urls_is_a_rule(spark):
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(8) for j in range(8)]
    paths = [words] * 30 + [[*words[:-1], "x"]] * 10 + [["y"]] * 60
    got = mined(labelled_of(spark, paths, [True] * 25 + [False] * 5 + [True] * 3 + [False] * 67))
    assert got == {(f"p:{words[-1]}",): (30, 25), **{(f"p:{w}",): (40, 28) for w in words[:-1]}}


def test_rules_decide_on_open_urls_only(spark):
    urls = ["http://m.win.org/en/bet", "http://m.win.org/en/bet", "http://m.win.com/en/bet", "http://m.win.org/en/art", None]
    learned = spark.createDataFrame([(["h:m", "p:bet"], 20, 15, 0.75), (["h:m", "h:win", "p:bet"], 10, 9, 0.9), (["h:absent"], 9, 9, 1.0)],
                                    "tokens array<string>, held long, unwanted long, confidence double")
    got = judged(spark, urls, learned)
    assert [got[i].verdict for i in range(5)] == ["block", "block", "allow", "allow", "allow"]
    assert [got[i].matched for i in range(5)] == ["h:m h:win p:bet"] * 2 + [None] * 3


def test_long_urls_have_bounded_transactions(spark):
    """A url of many tokens, repeated, does not make the miner list all its subsets."""
    long_url = "http://a.org/" + "/".join(f"w{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12))
    labelled = spark.createDataFrame([(long_url, True)] * 40 + [("http://b.org/x", False)] * 60, "url string, unwanted boolean")
    rules = url_rules.mine(labelled).collect()
    assert rules and all(len(x.tokens) == 1 and x.confidence == 1.0 for x in rules)


def test_odd_tables(spark):
    empty = pages_of(spark, []).limit(0)
    labels = spark.createDataFrame([(1, 0, None), (2, None, 1), (3, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    assert url_rules.mine(url_rules.labelled_urls(empty, labels)).count() == 0
    rows = [(1, "http://a.org/x"), (2, None), (3, "http://a.org/x"), (None, "http://a.org/x"), (1, "http://a.org/x")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({c: F.lit("z") for c in ("host", "path", "rule", "verdict", "tokens", "fit", "matched", "token")})
    found = url_rules.labelled_urls(pages, labels)
    assert sorted((x.url or "", x.unwanted) for x in found.collect()) == [("", True), ("http://a.org/x", False), ("http://a.org/x", True), ("http://a.org/x", True)]
    learned = url_rules.mine(found, least=1, confidence=0.6)
    got = url_rules.judge(pages, learned).collect()
    assert sorted((x.page_id or -1, x.verdict) for x in got) == [(-1, "block"), (1, "block"), (1, "block"), (2, "allow"), (3, "block")]
    assert url_rules.judge(empty, learned).count() == 0


@pytest.mark.parametrize("rules", [(), (url_rules.Rule("a.b", "/", "block"), url_rules.Rule("b", "/xx", "allow"))])
def test_other_rules(spark, rules):
    df = pages_of(spark, ["http://a.b/xxy", "http://b/xx"]).select(url_rules.fitting(url_rules.host_of(F.col("url")), url_rules.path_of(F.col("url")), rules).alias("f"))
    got = [x.f and x.f.verdict for x in df.collect()]
    assert got == ([None, None] if not rules else ["block", "allow"])

"""URL filter: fixed host and path rules first, association rules for the rest.

Unwanted urls are learned from labels.  A url is a set of tokens: the labels of its host, the words of its
path (digits as ``0``) and the names of its parameters.  Spark's FP-growth mines the token sets that are
frequent among labelled urls, together with the mark of an unwanted one; a set is a rule if it is
held by at least ``SUPPORT`` of the labelled urls and ``LEAST`` of them, at least ``CONFIDENCE`` of those are unwanted, and no
smaller set of its tokens does as well.  Rules are kept in an inverted index under their rarest token: a url
looks up its own tokens there and tests only the rules it finds.

A set of n tokens has 2^n subsets, so FP-growth gets urls of at most ``TOKENS`` tokens.  Where urls are longer, each of their
tokens is taken in turn: the urls that hold it, with their tokens more common than it, are mined on their own, again
without tokens that can add no rule, and so on until all are short.  No token of a url is left out.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plyframe.llm.shared import written

SUPPORT = 0.002
LEAST = 10
CONFIDENCE = 0.5
TOKENS = 12  # of a url, that FP-growth takes whole
UNWANTED = "!"
SETS = "tokens array<string>, held long, unwanted long"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str


# The rules of the filter.
RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)


def _lower(text: Column) -> Column:
    """A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or end; empty without ``://``."""
    return _lower(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, null if none does.

    A rule fits its host and that host's subdomains if the path begins with the rule's path.  Longest is by the
    characters of host and path together, then by those of the host.  ``rules`` is a parameter, not data.
    """
    best = None
    for rule in sorted(rules, key=lambda r: (len(r.host + r.path), len(r.host), r.host), reverse=True):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        held = F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        best = F.when(fits, held) if best is None else best.when(fits, held)
    return F.lit(None).cast("struct<rule:string,verdict:string>") if best is None else best


def tokens_of(url: Column) -> Column:
    """The different tokens of a url, sorted."""
    words = F.regexp_replace(_lower(path_of(url)), "[0-9]+", "0")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^?#]*\?([^#]*)", 1)
    marked = (
        F.transform(F.split(host_of(url), r"\."), lambda x: F.when(x != "", F.concat(F.lit("h:"), x))),
        F.transform(F.split(words, r"[/._~-]+"), lambda x: F.when(x != "", F.concat(F.lit("p:"), x))),
        F.transform(F.split(query, "&"), lambda x: F.when(x != "", F.concat(F.lit("q:"), F.regexp_extract(x, "^[^=]*", 0)))),
    )
    return F.array_sort(F.array_compact(F.array_distinct(F.concat(*marked))))


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, unwanted) of the pages that have labels under their page_id: unwanted if toxic or of quality 0.

    Equal ids join as often as they occur; a null id joins none; a null label is no reason.
    """
    bad = (F.coalesce(F.col("toxic"), F.lit(0)) == 1) | (F.coalesce(F.col("quality"), F.lit(1)) == 0)
    own = labels.select(F.col("doc_id").alias("page_id"), bad.alias("unwanted"))
    return pages.select("page_id", "url").join(own, "page_id").select("url", "unwanted")


def _telling(rows: DataFrame, enough: float) -> tuple[DataFrame, DataFrame]:
    """Rows (row, prefix, tokens, unwanted) without the tokens that add no rule, and the sets of prefix and one token.

    The rows of a prefix are all urls that hold it.  A token goes if too few unwanted urls hold it, or if all rows do,
    as the prefix alone is as sure; so does one that is sure by itself, once it is listed.  Without a prefix, what all urls hold is
    listed first.  Tokens stand by their urls, most first.
    """
    whole = rows.groupBy("prefix").agg(F.count("*").alias("n"))
    each = rows.select("row", "prefix", "unwanted", F.explode("tokens").alias("token"))
    counts = each.groupBy("prefix", "token").agg(F.count("*").alias("held"), F.count_if("unwanted").alias("bad")).where(F.col("bad") >= enough)
    counts = written(counts.join(whole, "prefix").where((F.col("held") < F.col("n")) | (F.size("prefix") == 0)), "url-tokens")
    found = counts.select(F.array_sort(F.array_append("prefix", F.col("token"))).alias("tokens"), "held", F.col("bad").alias("unwanted"))
    open_ = counts.where("held < n AND bad < held").select("prefix", "token", "held")
    place = F.struct((-F.col("held")).alias("rarity"), "token")
    kept = each.join(open_, ["prefix", "token"]).groupBy("row", "prefix", "unwanted").agg(F.sort_array(F.collect_list(place))["token"].alias("tokens"))
    return written(kept, "url-rows"), found


def _narrower(rows: DataFrame) -> DataFrame:
    """The rows under each of their tokens in turn, with the tokens before it; those without such count among the prefix's."""
    each = rows.select("row", "prefix", "tokens", "unwanted", F.posexplode("tokens").alias("place", "token"))
    return each.select("row", F.array_append("prefix", F.col("token")).alias("prefix"), F.slice("tokens", F.lit(1), F.col("place")).alias("tokens"), "unwanted")


def _item(token: Column) -> Column:
    """A token under its row's prefix, as text: sets of different prefixes share no item."""
    return F.to_json(F.array_append("prefix", token))


def _frequent(rows: DataFrame, enough: float) -> DataFrame:
    """(tokens, held, unwanted): by FP-growth, the sets of a prefix and two or more tokens."""
    items = F.transform("tokens", _item)
    held = written(rows.select(F.when(F.col("unwanted"), F.array_append(items, _item(F.lit(UNWANTED)))).otherwise(items).alias("items")), "url-transactions")
    n = held.count()
    if not n:
        return rows.sparkSession.createDataFrame([], SETS)
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, enough / n * (1 - 1e-9))).fit(held)
    many = model.freqItemsets.where(F.size("items") > 1)
    tokens = F.array_sort(F.array_distinct(F.flatten(F.transform("items", lambda x: F.from_json(x, "array<string>")))))
    sets = written(many.select(tokens.alias("tokens"), F.size("items").alias("long"), "freq"), "url-sets")
    both = sets.where(F.array_contains("tokens", UNWANTED) & (F.col("long") > 2))
    both = both.select(F.array_remove("tokens", UNWANTED).alias("tokens"), F.col("freq").alias("unwanted"))
    alone = sets.where(~F.array_contains("tokens", UNWANTED)).select("tokens", F.col("freq").alias("held"))
    return alone.join(both, "tokens")


def mine(labelled: DataFrame, support: float = SUPPORT, least: int = LEAST, confidence: float = CONFIDENCE, size: int = TOKENS) -> DataFrame:
    """(tokens, held, unwanted, confidence): the rules, tokens sorted.

    ``held`` urls have all the tokens, ``unwanted`` of them are unwanted.  Without labelled urls there are none.
    ``size`` is how many tokens of a url FP-growth gets at most; the rules are the same for any.

    A set whose urls are those of a smaller set is no surer, so neither it nor any set that holds it is listed.
    Urls with many common tokens in ever new mixtures still have many sets, which takes time.
    """
    rows = labelled.select(F.monotonically_increasing_id().alias("row"), F.array().cast("array<string>").alias("prefix"), tokens_of(F.col("url")).alias("tokens"), "unwanted")
    rows = written(rows.where(F.size("tokens") > 0), "url-rows")
    # A rule's urls must number ``need``; its unwanted ones alone may be as few as ``need`` times the confidence.
    need = max(least, support * rows.count())
    enough = need * confidence * (1 - 1e-9)
    sets, short = [], []
    while True:
        rows, found = _telling(rows, enough)
        sets.append(found)
        long = rows.where(F.size("tokens") > size).select("prefix").distinct()
        short.append(rows.join(long, "prefix", "left_anti"))
        if long.isEmpty():
            break
        rows = written(_narrower(rows.join(long, "prefix", "left_semi")), "url-rows")
    sets.append(_frequent(reduce(DataFrame.unionByName, short), enough))
    rules = reduce(DataFrame.unionByName, sets).withColumn("confidence", F.col("unwanted") / F.col("held"))
    rules = written(rules.where((F.col("held") >= need) & (F.col("confidence") >= confidence)).select("tokens", "held", "unwanted", "confidence"), "url-rules")
    # A rule goes if leaving out tokens of it gives one at least as sure: its subsets are looked up by equality,
    # or for a long one the rules whose first token it has.
    part = F.transform(F.sequence(F.lit(1), F.call_function("shiftleft", F.lit(1), F.size("tokens")) - 2), _subset)
    parts = rules.where(F.size("tokens").between(2, TOKENS)).select("tokens", "confidence", F.explode(part).alias("part"))
    smaller = rules.select(F.col("tokens").alias("part"), F.col("confidence").alias("sure"))
    needless = parts.join(smaller, "part").where("sure >= confidence").select("tokens")
    long = rules.where(F.size("tokens") > TOKENS).select("tokens", "confidence", F.explode("tokens").alias("first"))
    within = (F.size(F.array_except("part", "tokens")) == 0) & (F.size("part") < F.size("tokens"))
    held = long.join(smaller.withColumn("first", F.element_at("part", 1)), "first").where(within & F.expr("sure >= confidence"))
    return rules.join(needless.unionByName(held.select("tokens")).distinct(), "tokens", "left_anti")


def _subset(mask: Column) -> Column:
    return F.filter("tokens", lambda x, i: F.call_function("shiftright", mask, i).bitwiseAND(F.lit(1)) == 1)


def inverted(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """The rules under their rarest token among ``urls`` (url, tokens): one row (token, rule...) each."""
    each = rules.withColumn("token", F.explode("tokens"))
    common = urls.select(F.explode("tokens").alias("token")).join(each.select("token").distinct(), "token", "left_semi")
    rarity = common.groupBy("token").agg(F.count("*").alias("urls"))
    key = F.min(F.struct("urls", "token"))["token"].alias("token")
    return each.join(rarity, "token").groupBy("tokens", "held", "unwanted", "confidence").agg(key)


def matches(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, matched) of the urls that hold all tokens of a rule: the surest, then most frequent, then smallest rule."""
    own = urls.select("url", tokens_of(F.col("url")).alias("tokens"))
    index = inverted(rules, own).withColumnRenamed("tokens", "needed")
    met = own.withColumn("token", F.explode("tokens")).join(index, "token")
    met = met.where(F.size(F.array_except("needed", "tokens")) == 0)
    order = F.struct(-F.col("confidence"), -F.col("held"), F.concat_ws(" ", "needed").alias("words"))
    return met.groupBy("url").agg(F.min(order)["words"].alias("matched"))


def judge(pages: DataFrame, learned: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, matched) for every row of ``pages``.

    ``rule`` and its verdict come from the fixed rules; where none fits, a url that holds a learned rule is blocked, and
    ``matched`` has that rule's tokens.  Each different url is judged once, so copies cost no more than their join.

    Defined cases: a url that is null or without ``://`` has neither host nor path nor tokens of them, and is
    allowed unless a rule on its parameters says otherwise; repeated rows give repeated rows; a null page_id
    stays null; an empty table gives no rows; no learned rules block nothing; other columns are ignored.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    own = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    own = own.withColumn("fit", fitting(F.col("host"), F.col("path"), rules))
    open_urls = own.where("fit IS NULL AND url IS NOT NULL").select("url").distinct()
    found = matches(open_urls, learned)
    verdict = F.coalesce(F.col("fit.verdict"), F.when(F.col("matched").isNotNull(), "block").otherwise("allow"))
    return own.join(found, "url", "left").select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"),
        F.when(F.col("fit").isNull(), F.col("matched")).alias("matched"),
    )

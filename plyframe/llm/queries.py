"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from plyframe.llm import bpe, conversation_repair, decontamination, html_text, language_id, line_dedup, pii, simhash, source_audit, substring_dedup, topk, url_rules, warc
from plyframe.llm.shared import scratch, table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(language_id.training_rows(docs))
    own = docs.select("doc_id", "text", language_id.held_out().alias("held_out"))
    return language_id.identify(own, model).select("doc_id", "held_out", "lang_pred", "score", "bits_per_char", "rejected")


def op2_nearest_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest sign codes of every hundredth vector, against all vectors."""
    codes = topk.sign_codes(table(spark, sf_dir, "embeddings"))
    return topk.search(codes, codes.where("vec_id % 100 = 0"), k=10)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to web archives and read back through the capture index."""
    read = warc.archive_and_read(table(spark, sf_dir, "pages"), scratch(spark, "warc"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded; counts and digests."""
    return bpe.digests(bpe.encode_decode(table(spark, sf_dir, "documents").select("doc_id", "text"), VOCABULARY))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item."""
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without repeated or nearly repeated lines."""
    return line_dedup.dedupe_lines(table(spark, sf_dir, "documents"), least=1).select("doc_id", "n_lines", "n_removed", "text")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return pii.digests(pii.find_spans(table(spark, sf_dir, "documents")))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without bytes of 100-byte strings that start earlier too."""
    return substring_dedup.digests(substring_dedup.dedupe_bytes(table(spark, sf_dir, "documents")))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of every document and the component it belongs to."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the fixed rules, else by rules learned from the labels."""
    pages = table(spark, sf_dir, "pages")
    learned = url_rules.mine(url_rules.labelled_urls(pages, table(spark, sf_dir, "labels")))
    return url_rules.judge(pages, learned)


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far every source's words are from the others' and from its language's."""
    return source_audit.audit(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest repair of every damaged conversation."""
    return conversation_repair.repair(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of corpus_pipeline.py."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_language_id, op2_nearest_codes, op3_warc, op4_bpe, op5_main_text, op6_decontamination,
        op7_line_dedup, op8_pii, op9_substring_dedup, op10_simhash, op11_url_rules, op12_source_audit, op13_conversation_repair, pipeline,
    )
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_HOST = _LOWER.format("coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), '')")
_PATH = "coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '')"
_FITS = " ".join(
    f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.host}{r.path}'"
    for r in sorted(url_rules.RULES, key=lambda r: -len(r.host + r.path))
)
_BLOCKING = ", ".join(f"'{r.host}{r.path}'" for r in url_rules.RULES if r.verdict == "block")
_PAYLOAD = "encode(coalesce(html, ''))"
SQL: dict[str, str] = {
    "op2_nearest_codes": """
        WITH codes AS (SELECT DISTINCT vec_id, [x > 0 FOR x IN embedding] AS code FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
        pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   CAST(len(list_filter(list_zip(q.code, c.code), lambda x: x[1] <> x[2])) AS INTEGER) AS distance
            FROM codes q, codes c WHERE q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
        ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS rank FROM pairs)
        SELECT query_id, rank, vec_id, distance FROM ranked WHERE rank <= 10""",
    "op3_warc": f"""
        WITH own AS (
            SELECT page_id, CAST(octet_length({_PAYLOAD}) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
        kept AS (SELECT payload_digest, max(page_id) AS last FROM own WHERE payload_bytes >= 1000 GROUP BY payload_digest)
        SELECT page_id, payload_bytes, own.payload_digest AS payload_digest,
               CASE WHEN last IS NOT NULL AND page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN last IS NOT NULL AND page_id IS DISTINCT FROM last THEN last END AS refers_to
        FROM own LEFT JOIN kept ON own.payload_digest = kept.payload_digest AND own.payload_bytes >= 1000""",
    "op11_url_rules": f"""
        WITH parts AS (SELECT page_id, url, {_HOST} AS host, {_PATH} AS path FROM pages),
        urls AS (
            SELECT page_id, url, host, path, CASE {_FITS} END AS rule, list_sort(list_distinct(list_concat(
                list_transform(list_filter(string_split(host, '.'), lambda x: x <> ''), lambda x: 'h:' || x),
                list_transform(list_filter(string_split_regex(regexp_replace({_LOWER.format("path")}, '[0-9]+', '0', 'g'), '[/._~-]+'), lambda x: x <> ''), lambda x: 'p:' || x),
                list_transform(list_filter(string_split(regexp_extract(coalesce(url, ''), '^[^?#]*[?]([^#]*)', 1), '&'), lambda x: x <> ''),
                               lambda x: 'q:' || regexp_extract(x, '^[^=]*'))))) AS tokens FROM parts),
        labelled AS (
            SELECT row_number() OVER () AS r, tokens, coalesce(toxic, 0) = 1 OR coalesce(quality, 1) = 0 AS unwanted
            FROM urls JOIN labels ON doc_id = page_id),
        whole AS (SELECT count(*) AS n, count(*) FILTER (unwanted) AS bad FROM labelled),
        each AS (SELECT r, unwanted, unnest(tokens) AS token FROM labelled),
        telling AS (
            SELECT token, abs(CAST(count(*) FILTER (unwanted) AS HUGEINT) * any_value(n) - CAST(count(*) AS HUGEINT) * any_value(bad)) AS off
            FROM each, whole GROUP BY token),
        chosen AS (
            SELECT r, unwanted, token, row_number() OVER (PARTITION BY r ORDER BY off DESC, token) AS place FROM each JOIN telling USING (token)),
        items AS (SELECT unwanted, list(token ORDER BY token) AS tokens FROM chosen WHERE place <= {url_rules.TOKENS} GROUP BY r, unwanted),
        subsets AS (
            SELECT unwanted, list_filter(tokens, lambda x, i: (m >> (i - 1)) & 1 = 1) AS tokens
            FROM items, range(1, {1 << url_rules.TOKENS}) AS masks(m) WHERE m < (1 << len(tokens))),
        sets AS (SELECT tokens, count(*) AS held, count(*) FILTER (unwanted) / count(*) AS confidence FROM subsets GROUP BY tokens),
        enough AS (
            SELECT tokens, held, confidence FROM sets, (SELECT count(*) AS n FROM items)
            WHERE held >= greatest({url_rules.LEAST}, {url_rules.SUPPORT} * n) AND confidence >= {url_rules.CONFIDENCE}),
        rules AS (
            SELECT * FROM enough AS r WHERE NOT EXISTS (
                SELECT 1 FROM enough AS s WHERE len(s.tokens) < len(r.tokens) AND list_has_all(r.tokens, s.tokens) AND s.confidence >= r.confidence)),
        found AS (
            SELECT url, first(array_to_string(rules.tokens, ' ') ORDER BY confidence DESC, held DESC, array_to_string(rules.tokens, ' ')) AS matched
            FROM (SELECT DISTINCT url, tokens FROM urls WHERE rule IS NULL AND url IS NOT NULL) AS u JOIN rules ON list_has_all(u.tokens, rules.tokens) GROUP BY url)
        SELECT page_id, host, path, rule, CASE WHEN rule IN ({_BLOCKING}) THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
                    WHEN matched IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
               CASE WHEN rule IS NULL THEN matched END AS matched
        FROM urls LEFT JOIN found USING (url)""",
    "op12_source_audit": f"""
        WITH docs AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
        words AS (
            SELECT r, lang, source, {_LOWER.format("w")} AS term
            FROM (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS w FROM docs)),
        kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= {source_audit.LEAST}),
        langs AS (
            SELECT lang, count(term) AS v, coalesce(sum(n), 0) AS total FROM (SELECT DISTINCT lang FROM docs) LEFT JOIN kept USING (lang) GROUP BY lang),
        counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
        sizes AS (
            SELECT lang, source, coalesce(sum(n), 0) AS total FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN counts USING (lang, source) GROUP BY ALL),
        shares AS (
            SELECT s.lang AS lang, s.source AS source, k.term AS term, coalesce(c.n, 0) AS n,
                   CAST(1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 5) // (s.total + 5 * l.v) AS BIGINT) AS p,
                   CAST(1 + CAST(1000000000 AS HUGEINT) * (k.n + 5) // (l.total + 5 * l.v) AS BIGINT) AS q
            FROM sizes AS s JOIN langs AS l ON l.lang = s.lang JOIN kept AS k ON k.lang = s.lang
            LEFT JOIN counts AS c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
        pairs AS (
            SELECT x.lang AS lang, x.source AS source, y.source AS item,
                   coalesce((SELECT sum(abs(a.p - b.p)) FROM shares AS a JOIN shares AS b ON a.lang = b.lang AND a.term = b.term
                             WHERE a.lang = x.lang AND a.source = x.source AND b.source = y.source), 0) AS value
            FROM sizes AS x JOIN sizes AS y ON x.lang = y.lang AND x.source <> y.source),
        parts AS (
            SELECT lang, source, 'pair' AS part, item, value FROM pairs
            UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS place FROM parts)
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INTEGER) AS rank
        FROM ranked WHERE part = 'pair' OR place <= {source_audit.TOP}""",
    "op13_conversation_repair": r"""
        WITH RECURSIVE own AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
        kinds AS (
            SELECT *, xor(list_reduce(
                list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(key, ''), lambda c: CAST(ascii(c) AS BIGINT))),
                lambda crc, b: list_reduce(list_prepend(xor(crc, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
                                           lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295) % 20 AS kind FROM own),
        damaged AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                   unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM kinds WHERE kind <> 0),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
                   row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS again, left(role, 1) AS initial FROM damaged),
        messages AS (
            SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN again > 1 THEN 'd'
                           WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE ' ' END AS fault,
                   lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS former FROM placed),
        inserts(s, t, cost, word) AS (
            VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 2, 'I'), (1, 2, 2, 'I'), (2, 3, 2, 'I'), (3, 2, 2, 'I'),
                   (0, 3, 4, 'II'), (1, 3, 4, 'II'), (3, 3, 4, 'II')),
        says(s, t, initial) AS (VALUES (0, 1, 's'), (0, 2, 'u'), (1, 2, 'u'), (3, 2, 'u'), (2, 3, 'a')),
        steps AS (
            SELECT i.s AS s, i.t AS t, i.cost + 3 AS cost, i.word || 'D' AS word, CAST(NULL AS VARCHAR) AS initial, 3 AS least FROM inserts AS i
            UNION ALL SELECT i.s, e.t, i.cost + 2, i.word || 'R', CAST(NULL AS VARCHAR), 2 FROM inserts AS i JOIN says AS e ON e.s = i.t AND e.initial <> 's'
            UNION ALL SELECT i.s, e.t, i.cost, i.word || 'K', e.initial, 1 FROM inserts AS i JOIN says AS e ON e.s = i.t),
        best AS (
            SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS s, '000000000' AS found FROM (SELECT DISTINCT conv_id FROM messages)
            UNION ALL
            SELECT b.conv_id, b.i + 1, e.t,
                   min(lpad(CAST(CAST(left(found, 9) AS BIGINT) + e.cost + CASE WHEN m.fault = 't' AND e.least < 3 THEN 1 ELSE 0 END AS VARCHAR), 9, '0') || substr(found, 10) || e.word)
            FROM best AS b JOIN messages AS m ON m.conv_id IS NOT DISTINCT FROM b.conv_id AND m.i = b.i + 1
            JOIN steps AS e ON e.s = b.s AND (e.initial IS NULL OR e.initial = m.initial) AND (e.least = 3 OR m.fault NOT IN ('b', 'd'))
            GROUP BY b.conv_id, b.i, e.t),
        counted AS (
            SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
                   count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
                   count(*) FILTER (former IS NOT NULL AND former || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM messages GROUP BY conv_id),
        repaired AS (
            SELECT c.conv_id AS conv_id,
                   min(lpad(CAST(CAST(left(found, 9) AS BIGINT) + e.cost AS VARCHAR), 9, '0') || substr(found, 10) || e.word) AS found
            FROM counted AS c JOIN best AS b ON b.conv_id IS NOT DISTINCT FROM c.conv_id AND b.i = c.n JOIN inserts AS e ON e.s = b.s AND e.t IN (0, 3)
            GROUP BY c.conv_id),
        edits AS (
            SELECT conv_id, x, substr(found, 9 + x, 1) AS edit
            FROM (SELECT conv_id, found, unnest(range(1, length(found) - 8)) AS x FROM repaired)),
        numbered AS (
            SELECT *, count(*) FILTER (edit <> 'I') OVER (PARTITION BY conv_id ORDER BY x) AS i,
                   count(*) FILTER (edit <> 'D') OVER (PARTITION BY conv_id ORDER BY x) AS kept FROM edits),
        spoken AS (
            SELECT n.conv_id AS conv_id, x, edit, kept, m.role AS role, CASE edit WHEN 'I' THEN '' ELSE m.text END AS text,
                   max(CASE WHEN kept = 1 AND edit = 'K' AND m.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY n.conv_id) AS led
            FROM numbered AS n LEFT JOIN messages AS m ON m.conv_id IS NOT DISTINCT FROM n.conv_id AND m.i = n.i WHERE edit <> 'D'),
        texts AS (
            SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (kept - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY x) AS whole
            FROM spoken GROUP BY conv_id)
        SELECT o.conv_id AS conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
               coalesce(illegal, 0) AS illegal, coalesce(CAST(left(found, 9) AS BIGINT), 0) AS cost, coalesce(substr(found, 10), '') AS audit,
               sha256(coalesce(whole, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) AS o LEFT JOIN counted AS c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
        LEFT JOIN repaired AS r ON r.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN texts AS t ON t.conv_id IS NOT DISTINCT FROM o.conv_id""",
}

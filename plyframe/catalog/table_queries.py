"""Each operator on its own, over the given tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plyframe.catalog import store
from plyframe.catalog.archive import table
from plyframe.functions import numbers as nb
from plyframe.functions import positions as ps
from plyframe.functions import text as tx
from plyframe.functions import timing as tm
from plyframe.operators import aggregates as ag
from plyframe.operators import perspective as pv
from plyframe.operators import quality, ranking, windows
from plyframe.plans import analyses as an
from plyframe.session import configure
from plyframe.sources import contract, landing, tables

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(source: str | None, sql: str | None = None):
    """Register ``function(df)`` over table ``source`` (or ``function(spark, sf_dir)`` for None)."""

    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            if source is None:
                return function(spark, sf_dir)
            return function(table(spark, sf_dir, source))

        QUERIES[function.__name__] = run
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


# --- sources, contracts, tables ---------------------------------------------------------


@query(
    None,
    """SELECT CASE WHEN o_custkey % 25 = 0 THEN 'chess960' ELSE 'chess' END AS rules, year(o_orderdate)::INT AS year,
      count(*) AS games FROM orders GROUP BY ALL""",
)
def landing_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written as month folders of JSON documents, then read back as an archive."""
    ended = F.timestamp_seconds("end_time")
    root = store.folder(spark, sf_dir, "landing")
    records = store.records(spark, sf_dir)
    documents = records.select(
        F.array(F.struct(*records.columns)).alias("games"),
        F.lit("archivist").alias("username"),
        F.year(ended).alias("year"),
        F.month(ended).alias("month"),
    )
    # A task keeps a file open for each month, so the wide documents are neither shuffled nor sorted; a month's records are spread over several files.
    writers = "spark.sql.maxConcurrentOutputFileWriters"
    former = spark.conf.get(writers)
    spark.conf.set(writers, "200")
    try:
        documents.write.mode("overwrite").partitionBy("username", "year", "month").option("compression", "gzip").json(root)
    finally:
        spark.conf.set(writers, former)
    games = landing.read_games(spark, root, "archivist")
    return games.groupBy("rules", F.year(F.timestamp_seconds("end_time")).alias("year")).agg(
        F.count(F.lit(1)).alias("games")
    )


EVENT = T.StructType(
    [
        T.StructField("event_id", T.LongType(), False),
        T.StructField("event_type", T.StringType(), False),
        T.StructField("value", T.DoubleType(), False),
        T.StructField("props", T.StringType(), True),
    ]
)


@query(
    "events",
    """SELECT concat_ws('; ', CASE WHEN value < 5 THEN 'value is required' END,
        CASE WHEN event_type = 'signup' AND user_id % 2 = 0 THEN 'a signup needs an odd user' END) AS problems, count(*) AS records
    FROM events GROUP BY 1""",
)
def contract_split(events: DataFrame) -> DataFrame:
    """Required fields and a rule across fields, split into valid and rejected rows."""
    gaps = events.withColumn("value", F.when(F.col("value") >= 5, F.col("value")))
    odd = contract.rule(
        (F.col("event_type") == "signup") & (F.col("user_id") % 2 == 0), "a signup needs an odd user"
    )
    good, bad = contract.split_valid(contract.with_problems(gaps, EVENT, odd))
    kept = good.agg(F.lit("").alias("problems"), F.count(F.lit(1)).alias("records"))
    rejected = bad.groupBy("problems").agg(F.count(F.lit(1)).alias("records"))
    return kept.unionAll(rejected)


@query(
    "events",
    """SELECT event_id, event_type, (props->>'$.k')::INT AS props__k, props->>'$.k' AS k_text FROM events""",
)
def json_flatten(events: DataFrame) -> DataFrame:
    """A nested column flattened to ``parent__child``, and a field read from JSON text."""
    nested = events.select(
        "event_id",
        "event_type",
        F.from_json("props", "k int").alias("props"),
        F.get_json_object("props", "$.k").alias("k_text"),
    )
    return contract.flatten(nested)


@query(
    None,
    """SELECT o_orderstatus, count(*) AS orders FROM orders WHERE o_custkey > 700 GROUP BY 1""",
)
def table_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over a frame by its name with a bound parameter."""
    return tables.query(
        spark,
        "SELECT o_orderstatus, count(*) AS orders FROM {orders} WHERE o_custkey > :least GROUP BY ALL",
        {"least": 700},
        orders=table(spark, sf_dir, "orders"),
    )


@query(
    None,
    """SELECT o_orderpriority, count(*) AS orders, min(o_orderkey) AS first_key FROM orders
    WHERE o_orderstatus = 'F' GROUP BY 1""",
)
def replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full-replace write, partitioned by the column readers filter on, and a read-only scan."""
    path = store.folder(spark, sf_dir, "orders")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    tables.replace_files(orders, path, ["o_orderstatus"])
    return (
        tables.read_files(spark, path)
        .filter(F.col("o_orderstatus") == "F")
        .groupBy("o_orderpriority")
        .agg(F.count(F.lit(1)).alias("orders"), F.min("o_orderkey").alias("first_key"))
    )


# --- projections and scalar functions ---------------------------------------------------


@query(
    "orders",
    """SELECT o_orderkey::VARCHAR AS order_id, o_custkey::INT AS customer, round_even(o_totalprice, 0)::INT AS price,
      o_orderdate::DATE AS ordered FROM orders WHERE o_orderstatus = 'F'""",
)
def typed_projection(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("int").alias("customer"),
        nb.whole_number(F.col("o_totalprice")).alias("price"),
        F.col("o_orderdate").cast("date").alias("ordered"),
    )


@query(
    "orders",
    """SELECT o_orderkey, split_part(o_orderpriority, '-', 1)::INT AS level,
      string_split(o_orderpriority, '-')[-1] AS name,
      coalesce(nullif(split_part(o_orderpriority, ' ', 2), ''), 'NONE') AS second_word FROM orders""",
)
def split_index_default(orders: DataFrame) -> DataFrame:
    priority = F.col("o_orderpriority")
    return orders.select(
        "o_orderkey",
        tx.part(priority, "-", 1).cast("int").alias("level"),
        tx.part(priority, "-", -1).alias("name"),
        F.coalesce(tx.part(priority, " ", 2), F.lit("NONE")).alias("second_word"),
    )


@query(
    "orders",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'daily ' || (o_custkey * 43200 / 3600 / 24)::INT || ' days'
        ELSE 'rapid ' || o_custkey END AS mode FROM orders""",
)
def round_cast_label(orders: DataFrame) -> DataFrame:
    """Half days round to even, as a division turns them into doubles."""
    kind = F.when(F.col("o_orderstatus") == "P", "daily").otherwise("rapid")
    return orders.select(
        "o_orderkey",
        tx.game_mode(kind, F.col("o_custkey").cast("string"), F.col("o_custkey") * 43200).alias("mode"),
    )


@query(
    "orders",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN o_custkey * 60 ELSE o_custkey END::INT AS base,
      CASE WHEN o_orderstatus = 'O' THEN o_orderkey % 30 ELSE 0 END::INT AS added FROM orders""",
)
def time_control_parts(orders: DataFrame) -> DataFrame:
    """``1/seconds``, ``base+increment`` and ``base`` texts taken apart."""
    status = F.col("o_orderstatus")
    customer = F.col("o_custkey").cast("string")
    kind = F.when(status == "P", "daily").otherwise("rapid")
    control = (
        F.when(status == "P", F.concat(F.lit("1/"), (F.col("o_custkey") * 60).cast("string")))
        .when(status == "O", F.concat(customer, F.lit("+"), (F.col("o_orderkey") % 30).cast("string")))
        .otherwise(customer)
    )
    return orders.select(
        "o_orderkey",
        tx.time_control_base(kind, control).alias("base"),
        tx.time_control_increment(kind, control).alias("added"),
    )


@query(
    "pages",
    """SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
      regexp_extract(url, '://([^/]+)/', 1) AS host, string_split(regexp_replace(url, '[?#].*', ''), '/')[-1] AS last_part,
      len(string_split(html, '<p>')) AS paragraphs, regexp_extract(html, 'lang="([^"]*)"', 1) AS lang FROM pages""",
)
def regex_headers(pages: DataFrame) -> DataFrame:
    return pages.select(
        "page_id",
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        F.regexp_extract("url", "://([^/]+)/", 1).alias("host"),
        tx.part(F.regexp_replace("url", "[?#].*", ""), "/", -1).alias("last_part"),
        F.size(F.split("html", "<p>")).cast("long").alias("paragraphs"),
        F.regexp_extract("html", 'lang="([^"]*)"', 1).alias("lang"),
    )


@query(
    "documents",
    """SELECT doc_id, array_to_string(regexp_extract_all(text, 'th[a-z]+'), ' ') AS words,
      len(regexp_extract_all(text, 'th[a-z]+'))::INT AS found, len(regexp_extract_all(text, '[rnbqRNBQ]'))::INT AS letters
    FROM documents""",
)
def regex_lists(documents: DataFrame) -> DataFrame:
    words = tx.all_matches(F.col("text"), "th[a-z]+")
    return documents.select(
        "doc_id",
        tx.list_text(words).alias("words"),
        F.size(words).alias("found"),
        tx.match_count(F.col("text"), "[rnbqRNBQ]").alias("letters"),
    )


@query(
    "conversations",
    """SELECT conv_id, turn, 'https://lichess.org/analysis/pgn/' || replace(replace(text, ' ', '%20'), '#', '')
      || '?color=' || lower(upper(role)) AS url FROM conversations""",
)
def url_builder(conversations: DataFrame) -> DataFrame:
    words = F.split("text", " ")
    return conversations.select(
        "conv_id", "turn", tx.analysis_url(tx.list_text(words), F.upper("role")).alias("url")
    )


@query(
    "orders",
    """SELECT o_orderkey, o_orderdate::DATE AS day, o_orderdate + to_seconds(o_orderkey % 86400) AS at FROM orders""",
)
def time_parts(orders: DataFrame) -> DataFrame:
    """Dotted date and time texts back to a date and a timestamp."""
    second = F.col("o_orderkey") % 86400
    clock = F.format_string("%02d:%02d:%02d", F.floor(second / 3600), F.floor(second / 60) % 60, second % 60)
    texts = orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy.MM.dd").alias("d"), clock.alias("t"))
    day = tm.dotted_date(F.col("d"))
    return texts.select("o_orderkey", day.alias("day"), tm.timestamp_from(day, F.col("t")).alias("at"))


@query(
    "orders",
    """SELECT o_orderkey, epoch(age(TIMESTAMP '1998-03-01 01:00:30.5', t)) AS since, epoch(age(t, TIMESTAMP '1998-03-31 12:00:00')) AS until
    FROM (SELECT o_orderkey, o_orderdate + to_seconds(o_orderkey * 37 % 86400) AS t FROM orders)""",
)
def calendar_age(orders: DataFrame) -> DataFrame:
    at = F.timestamp_seconds(
        F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") * 37 % 86400
    ).cast("timestamp_ntz")
    first = F.lit("1998-03-01 01:00:30.5").cast("timestamp_ntz")
    second = F.lit("1998-03-31 12:00:00").cast("timestamp_ntz")
    return orders.select(
        "o_orderkey",
        tm.calendar_age(first, at).total_seconds().alias("since"),
        tm.calendar_age(at, second).total_seconds().alias("until"),
    )


@query(
    "events",
    """SELECT event_id, CASE WHEN user_id % 10 <> 0 THEN floor(floor(value * 1000) / 10) / 10.0::DOUBLE END AS seconds FROM events""",
)
def clock_seconds(events: DataFrame) -> DataFrame:
    """Seconds written as a clock note and read back; notes without a clock give NULL."""
    tenths = F.floor(F.floor(F.col("value") * 1000) / 10)
    clock = F.format_string(
        "{[%%clk %d:%02d:%02d.%d]}",
        F.floor(tenths / 36000), F.floor(tenths / 600) % 60, F.floor(tenths / 10) % 60, tenths % 10,
    )
    note = F.when(F.col("user_id") % 10 != 0, clock).otherwise("{[%eval 0:24]}")
    return events.select("event_id", tm.clock_seconds(note).alias("seconds"))


@query(
    "events",
    """SELECT hour(local)::INT AS local_hour, dayofweek(local)::INT AS day_number, dayname(local) AS day_name, count(*) AS events
    FROM (SELECT ts + INTERVAL 330 MINUTE AS local FROM events) GROUP BY ALL""",
)
def local_hour_weekday(events: DataFrame) -> DataFrame:
    local = tm.in_zone(F.col("ts"), "Asia/Kolkata")
    day = tm.weekday_number(local)
    return ag.counts(
        events.select(
            F.hour(local).alias("local_hour"), day.alias("day_number"), tm.weekday_name(day).alias("day_name")
        ),
        ["local_hour", "day_number", "day_name"],
        "events",
    )


# --- lists ------------------------------------------------------------------------------


@query(
    "conversations",
    """SELECT conv_id, turn, CASE WHEN i <= len(w) THEN i END::BIGINT AS word_index, w[i] AS word, l[i] AS long_word
    FROM (SELECT *, unnest(range(1, greatest(len(w), len(l)) + 1)) AS i
      FROM (SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN whole ELSE longer END AS w, CASE WHEN turn % 2 = 0 THEN longer ELSE whole END AS l
        FROM (SELECT conv_id, turn, string_split(text, ' ') AS whole, list_filter(string_split(text, ' '), lambda x: len(x) > 4) AS longer
          FROM conversations)))""",
)
def zip_unnest(conversations: DataFrame) -> DataFrame:
    """Two lists side by side, the shorter padded; the index counts the first list only.

    Odd turns swap the lists, so that either side is padded.
    """
    words = F.split("text", " ")
    longer = F.filter(words, lambda x: F.length(x) > 4)
    even = F.col("turn") % 2 == 0
    lists = conversations.select(
        "conv_id",
        "turn",
        F.when(even, words).otherwise(longer).alias("w"),
        F.when(even, longer).otherwise(words).alias("l"),
    )
    place = F.col("place")
    return lists.select(
        "conv_id", "turn", F.size("w").alias("n"), F.posexplode(F.arrays_zip("w", "l")).alias("place", "pair")
    ).select(
        "conv_id",
        "turn",
        F.when(place < F.col("n"), (place + 1).cast("long")).alias("word_index"),
        F.col("pair.w").alias("word"),
        F.col("pair.l").alias("long_word"),
    )


@query(
    "events",
    """SELECT types, count(*) AS users FROM (SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types
      FROM events GROUP BY user_id) GROUP BY types""",
)
def group_by_list(events: DataFrame) -> DataFrame:
    """Groups keyed by a sorted list; the list holds distinct types, a handful at most."""
    per_user = (
        events.groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("types"))
    )
    grouped = ag.counts(per_user, ["types"], "users").orderBy(F.desc("users"), "types")
    return grouped.withColumn("types", F.array_join("types", ","))


# --- windows ----------------------------------------------------------------------------


@query(
    "conversations",
    """SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS role_index FROM conversations""",
)
def running_index(conversations: DataFrame) -> DataFrame:
    """Row number per conversation and role; a conversation of any length is split by turns."""
    chunk = F.floor(F.col("turn") / 10_000)
    return windows.running_index_in_chunks(
        conversations.select("conv_id", "turn", "role"), ["conv_id", "role"], ["turn"], chunk, "role_index"
    )


@query(
    "events",
    """SELECT event_id, user_id, value, coalesce(lag(value) OVER w, 1500) AS previous,
      round(CASE WHEN event_type = 'signup' THEN 0 ELSE coalesce(lag(value) OVER w, 1500) - value END, 1) AS spent
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def prev_value_default(events: DataFrame) -> DataFrame:
    """Value of the user's event before, carried from day to day; signups spend nothing."""
    rows = windows.previous_in_chunks(
        events, "value", ["user_id"], ["ts", "event_id"], F.date_trunc("day", "ts"), F.lit(1500.0), "previous"
    )
    spent = F.when(F.col("event_type") == "signup", F.lit(0.0)).otherwise(F.col("previous") - F.col("value"))
    return rows.select("event_id", "user_id", "value", "previous", nb.round_to(spent, 1).alias("spent"))


@query(
    "conversations",
    """WITH t AS (SELECT conv_id, turn, text, coalesce(lag(text) OVER (PARTITION BY conv_id ORDER BY turn), '') AS before FROM conversations),
    lost AS (SELECT conv_id, turn, l, strpos(before, l) AS place FROM t, unnest(string_split('PNBRQpnbrq', '')) AS u(l)
      WHERE len(before) - len(replace(before, l, '')) > len(text) - len(replace(text, l, '')))
    SELECT t.conv_id, t.turn, min_by(l, place) AS lost FROM t LEFT JOIN lost ON lost.conv_id = t.conv_id AND lost.turn = t.turn
    GROUP BY ALL""",
)
def lost_letters(conversations: DataFrame) -> DataFrame:
    """First letter that became rarer from one turn to the next."""
    rows = windows.previous_in_chunks(
        conversations, "text", ["conv_id"], ["turn"], F.floor(F.col("turn") / 10_000), F.lit(""), "before"
    )
    return rows.select("conv_id", "turn", ps.lost_letter(F.col("before"), F.col("text")).alias("lost"))


@query(
    "events",
    """SELECT ts::DATE AS day, arg_max(value, (ts, event_id)) AS last_value, count(*) AS events FROM events GROUP BY 1""",
)
def daily_last(events: DataFrame) -> DataFrame:
    return events.groupBy(F.to_date("ts").alias("day")).agg(
        ag.last_value(F.col("value"), F.struct("ts", "event_id")).alias("last_value"),
        F.count(F.lit(1)).alias("events"),
    )


@query(
    "events",
    """SELECT user_id, arg_max(CASE WHEN event_type <> 'error' THEN event_type END, (ts, event_id)) AS last_type
    FROM events GROUP BY 1""",
)
def last_value(events: DataFrame) -> DataFrame:
    """Last known type per user: rows without one do not count."""
    known = F.when(F.col("event_type") != "error", F.col("event_type"))
    return events.groupBy("user_id").agg(ag.last_value(known, F.struct("ts", "event_id")).alias("last_type"))


# --- aggregates -------------------------------------------------------------------------


@query(
    "conversations",
    """SELECT conv_id, sum(len(text)) FILTER (role = 'user')::BIGINT AS user_chars, count(*) FILTER (role = 'user') AS user_turns,
      sum(len(text)) FILTER (role = 'assistant')::BIGINT AS assistant_chars, count(*) FILTER (role = 'assistant') AS assistant_turns,
      sum(len(text)) FILTER (role = 'system')::BIGINT AS system_chars, count(*) FILTER (role = 'system') AS system_turns
    FROM conversations GROUP BY 1""",
)
def pivot_two_aggs(conversations: DataFrame) -> DataFrame:
    columns = ag.pivot_columns(
        F.col("role"), ["user", "assistant", "system"], F.length("text"), "chars", "turns"
    )
    return conversations.groupBy("conv_id").agg(*columns)


@query(
    None,
    """SELECT o_orderkey, o_custkey, n.total_qty, coalesce(n.f_lines, 0) AS f_lines, coalesce(n.o_lines, 0) AS o_lines, n.last_ship,
      (floor(o_totalprice / 10000) * 10000)::DOUBLE AS price_bin
    FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS total_qty, count(*) FILTER (l_linestatus = 'F') AS f_lines,
      count(*) FILTER (l_linestatus = 'O') AS o_lines, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1) n ON l_orderkey = o_orderkey""",
)
def mart_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals, aggregated before the join, attached to every order and binned."""
    lines = table(spark, sf_dir, "lineitem")
    totals = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("total_qty"),
        F.count_if(F.col("l_linestatus") == "F").alias("f_lines"),
        F.count_if(F.col("l_linestatus") == "O").alias("o_lines"),
        F.max("l_shipdate").alias("last_ship"),
    )
    price_bin = nb.binned(F.col("o_totalprice"), 10000)
    return (
        table(spark, sf_dir, "orders")
        .join(totals, "o_orderkey", "left")
        .select(
            "o_orderkey", "o_custkey", "total_qty",
            F.coalesce("f_lines", F.lit(0)).alias("f_lines"),
            F.coalesce("o_lines", F.lit(0)).alias("o_lines"),
            "last_ship", price_bin.alias("price_bin"),
        )
    )


@query(
    None,
    """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice ELSE c_acctbal END AS player_money,
      CASE WHEN o_orderkey % 2 = 0 THEN c_acctbal ELSE o_totalprice END AS opponent_money,
      CASE o_orderstatus WHEN 'P' THEN 'draw' ELSE CASE WHEN (o_orderstatus = 'F') = (o_orderkey % 2 = 0) THEN 'win' ELSE 'lose' END END AS outcome,
      CASE o_orderstatus WHEN 'P' THEN 'agreed' ELSE 'lost' END AS reason
    FROM orders JOIN customer ON c_custkey = o_custkey""",
)
def perspective(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order against customer, seen from one side, with outcome and reason."""
    pairs = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    status = F.col("o_orderstatus")
    result = lambda won: F.when(status == won, "win").when(status == "P", "agreed").otherwise("lost")
    sides = pairs.select(
        "o_orderkey",
        F.col("o_totalprice").alias("order__money"),
        F.col("c_acctbal").alias("customer__money"),
        result("F").alias("order__result"),
        result("O").alias("customer__result"),
    )
    is_order = F.col("o_orderkey") % 2 == 0
    seen = sides.withColumns(
        pv.both_sides(is_order, "order__", "customer__", {"money": "money", "result": "result"})
    )
    own, other = F.col("player_result"), F.col("opponent_result")
    return seen.select(
        "o_orderkey", "player_money", "opponent_money",
        pv.outcome(own, other).alias("outcome"), pv.outcome_reason(own, other).alias("reason"),
    )


@query(
    "conversations",
    """SELECT conv_id, CASE WHEN total <= 6 AND (total <= 10 OR sparse) THEN 'Endgame' WHEN total <= 10 OR sparse THEN 'Midgame' ELSE 'Opening' END AS phase
    FROM (SELECT conv_id, sum(q) AS total, min(q) < 4 OR min(n) < 4 AS sparse FROM (SELECT conv_id, len(regexp_extract_all(text, '[qQ]')) AS q,
      len(regexp_extract_all(text, '[nN]')) AS n FROM conversations) GROUP BY 1)""",
)
def phase_ladder(conversations: DataFrame) -> DataFrame:
    """Thresholds on counted letters, rung by rung."""
    counted = conversations.select(
        "conv_id",
        tx.match_count(F.col("text"), "[qQ]").alias("q"),
        tx.match_count(F.col("text"), "[nN]").alias("n"),
    )
    grouped = counted.groupBy("conv_id").agg(
        F.sum("q").alias("total"), F.min("q").alias("a"), F.min("n").alias("b")
    )
    ladder = ps.phase_ladder(F.col("total"), F.col("a"), F.col("b"))
    return grouped.select("conv_id", ladder["game_phase"].alias("phase"))


@query("orders", "SELECT DISTINCT o_orderpriority FROM orders ORDER BY 1")
def distinct_sorted(orders: DataFrame) -> DataFrame:
    return ranking.distinct_sorted(orders, "o_orderpriority")


@query(
    "orders",
    """SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
      AND o_orderdate::DATE BETWEEN DATE '1996-05-01' AND DATE '1997-05-01'""",
)
def order_filter(orders: DataFrame) -> DataFrame:
    return orders.filter(
        (F.col("o_orderstatus") == "F")
        & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
        & F.to_date("o_orderdate").between(F.lit(date(1996, 5, 1)), F.lit(date(1997, 5, 1)))
    ).select("o_orderkey")


@query(
    "orders",
    """SELECT min(o_orderdate) AS first_date, max(o_orderdate) AS last_date FROM orders WHERE o_orderstatus IN ('F', 'O')""",
)
def order_date_bounds(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("o_orderstatus").isin("F", "O")).agg(
        F.min("o_orderdate").alias("first_date"), F.max("o_orderdate").alias("last_date")
    )


@query(
    "orders",
    """SELECT orders, won, most, (s // 86400)::BIGINT || ' days, ' || (s // 3600 % 24) || strftime(TIMESTAMP '2000-01-01' + to_seconds(s), ':%M:%S') AS spent
    FROM (SELECT count(*) AS orders, avg((o_orderstatus = 'F')::INT) AS won, max(o_totalprice) AS most, sum(o_orderkey % 3600)::BIGINT AS s FROM orders)""",
)
def kpi_row(orders: DataFrame) -> DataFrame:
    return orders.agg(
        F.count(F.lit(1)).alias("orders"),
        ag.ratio(F.col("o_orderstatus") == "F").alias("won"),
        F.max("o_totalprice").alias("most"),
        tm.duration_text(F.sum(F.col("o_orderkey") % 3600)).alias("spent"),
    )


@query(
    "orders",
    """SELECT o_orderstatus, count(*) AS num_games, 100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS win_perc
    FROM orders GROUP BY o_orderstatus""",
)
def share_of_total(orders: DataFrame) -> DataFrame:
    return ag.share_of_total(orders, ["o_orderstatus"])


@query(
    "orders",
    """SELECT o_orderstatus, o_orderpriority, count(*) AS num_games, 100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS win_perc
    FROM orders GROUP BY o_orderstatus, o_orderpriority""",
)
def share_two_keys(orders: DataFrame) -> DataFrame:
    return ag.share_of_total(orders, ["o_orderstatus", "o_orderpriority"])


@query(
    "orders",
    """SELECT o_orderstatus, o_orderpriority, count(*) AS num_games, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY o_orderstatus) AS share
    FROM orders GROUP BY o_orderstatus, o_orderpriority""",
)
def normalized_share(orders: DataFrame) -> DataFrame:
    return ag.share_within(orders, ["o_orderstatus"], ["o_orderpriority"])


@query(
    "events",
    """SELECT dayname(ts) AS day_name, hour(ts)::INT AS at_hour, 100.0::DOUBLE * count(*) FILTER (event_type = 'purchase') / count(*) AS perc,
      count(*) AS events FROM events GROUP BY ALL""",
)
def weekday_hour_rate(events: DataFrame) -> DataFrame:
    day = tm.weekday_name(tm.weekday_number(F.col("ts")))
    return events.groupBy(day.alias("day_name"), F.hour("ts").alias("at_hour")).agg(
        ag.percent_where(F.col("event_type") == "purchase").alias("perc"),
        F.count(F.lit(1)).alias("events"),
    )


# --- ranks, samples ---------------------------------------------------------------------

_PREFIX = """pre AS (SELECT lang, source, array_to_string(string_split(text, ' ')[1:1], ' ') AS first_words FROM documents),
g AS (SELECT lang, source, first_words, count(*) AS n FROM pre GROUP BY ALL),
t AS (SELECT lang, first_words, sum(n)::BIGINT AS num_games FROM g GROUP BY ALL),
r AS (SELECT *, dense_rank() OVER (PARTITION BY lang ORDER BY num_games DESC)::INT AS rn FROM t),
top AS (SELECT g.lang AS player_color, g.source AS player_wdl, g.first_words AS starting_moves, n AS wdl_num_games, r.num_games, r.rn,
  100.0::DOUBLE * n / r.num_games AS perc FROM g JOIN r ON r.lang = g.lang AND r.first_words = g.first_words WHERE rn <= 5)"""


def _as_games(documents: DataFrame) -> DataFrame:
    """Documents as games: language for colour, source for outcome, words for moves."""
    return documents.select(
        F.col("lang").alias("player_color"),
        F.col("source").alias("player_wdl"),
        F.split("text", " ").alias("pgn_move_extract"),
        F.col("doc_id").cast("string").alias("game_analysis_url"),
    )


@query("documents", f"WITH {_PREFIX} SELECT * FROM top")
def top_prefixes(documents: DataFrame) -> DataFrame:
    return an.top_openings(_as_games(documents), 1)


@query(
    "documents",
    f"""WITH {_PREFIX} SELECT *, row_number() OVER (ORDER BY perc DESC, starting_moves)::INT AS place FROM top
    WHERE player_color = 'en' AND player_wdl = 'src1' ORDER BY place LIMIT 3""",
)
def best_worst(documents: DataFrame) -> DataFrame:
    return an.best_openings(an.top_openings(_as_games(documents), 1), "en", "src1", 3, "place")


@query(
    "documents",
    """SELECT doc_id::VARCHAR AS game_analysis_url FROM documents
    WHERE lang = 'en' AND source = 'src1' AND array_to_string(string_split(text, ' ')[1:1], ' ') = 'The'""",
)
def prefix_drill(documents: DataFrame) -> DataFrame:
    return an.games_of_opening(_as_games(documents), "The", 1, "en", "src1")


@query(
    "orders",
    """SELECT o_orderkey, o_orderdate FROM orders ORDER BY md5(concat_ws('|', o_orderkey::VARCHAR, '11')), o_orderkey LIMIT 5""",
)
def sample_rows(orders: DataFrame) -> DataFrame:
    """Five orders drawn by hash."""
    return ranking.sample_rows(orders.select("o_orderkey", "o_orderdate"), 5, "o_orderkey", seed=11)


@query(
    "orders",
    """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 20""",
)
def latest_n(orders: DataFrame) -> DataFrame:
    return ranking.top_rows(
        orders.select("o_orderkey", "o_orderdate", "o_totalprice"),
        20,
        F.desc_nulls_last("o_orderdate"),
        F.asc("o_orderkey"),
    )


@query(
    "customer",
    """SELECT c_custkey, c_mktsegment, c_acctbal, dense_rank AS place FROM (SELECT *, dense_rank() OVER (PARTITION BY c_mktsegment
      ORDER BY floor(c_acctbal / 100) DESC)::INT AS dense_rank FROM customer) WHERE dense_rank <= 3""",
)
def top_ties(customer: DataFrame) -> DataFrame:
    """Top three places per segment, ties included."""
    binned = customer.withColumn("bin", F.floor(F.col("c_acctbal") / 100))
    return ranking.top_dense_ranks(binned, ["c_mktsegment"], "bin", 3, "place").select(
        "c_custkey", "c_mktsegment", "c_acctbal", "place"
    )


# --- checks -----------------------------------------------------------------------------


@query(
    None,
    """SELECT 'quality' AS column_name, count(*) FILTER (quality IS NULL) AS nulls FROM documents LEFT JOIN labels USING (doc_id)
    UNION ALL SELECT 'toxic', count(*) FILTER (toxic IS NULL) FROM documents LEFT JOIN labels USING (doc_id)""",
)
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return quality.null_counts(joined, joined.columns)


@query(
    "lineitem",
    """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
)
def dq_unique(lineitem: DataFrame) -> DataFrame:
    return quality.duplicates(lineitem, "l_orderkey", "l_linenumber")


@query(
    "orders",
    """SELECT o_orderpriority, count(*) AS occurrences FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY 1""",
)
def dq_accepted(orders: DataFrame) -> DataFrame:
    return quality.unaccepted(orders, "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])


@query(
    "orders",
    "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice < 5000",
)
def dq_assert(orders: DataFrame) -> DataFrame:
    cheap = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") < 5000)
    return quality.violations(orders, cheap, "o_orderkey")


@query(
    "customer",
    """SELECT neg_time, num_rows, neg_time / num_rows * 100.0::DOUBLE AS perc FROM (SELECT count(*) FILTER (c_acctbal < 0)::DOUBLE AS n,
      count(*) FILTER (c_acctbal < 0) AS neg_time, count(*) AS num_rows FROM customer) WHERE n / num_rows * 100 > 1""",
)
def dq_negative_share(customer: DataFrame) -> DataFrame:
    return quality.negative_share(customer, "c_acctbal", 1.0)

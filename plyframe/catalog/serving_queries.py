"""Queries on what a refresh leaves beside the mart: its versions, its checks, the cube and the tree of openings."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyframe.catalog import game_queries, store, table_queries
from plyframe.catalog.archive import table
from plyframe.catalog.game_oracle import URL, on_games, on_mart, on_moves
from plyframe.catalog.game_queries import FIRST, LAST, SELECTED, ZONE, selected
from plyframe.functions import named
from plyframe.operators import ranking
from plyframe.plans import analyses as an
from plyframe.plans import checks, cube, openings
from plyframe.session import configure
from plyframe.sources import drift, versions

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def register(function):
        QUERIES[function.__name__] = function
        SQL[function.__name__] = sql
        return function

    return register


# --- versions and checks ----------------------------------------------------------------


@query(
    """WITH v AS (SELECT 1 AS version, DATE '1995-06-01' AS upto UNION ALL SELECT 2, DATE '2100-01-01')
    SELECT version::INT AS version, o_orderstatus, count(*) AS orders, count(*) AS counted
    FROM v JOIN orders ON o_orderdate::DATE < upto GROUP BY ALL"""
)
def versioned_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of two tables that must agree; each version is read as a whole through its manifest."""
    configure(spark)
    root = f"{store.folder(spark, sf_dir, 'versions')}-{uuid.uuid4().hex}"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("ordered"))
    for number, upto in enumerate(("1995-06-01", "2100-01-01"), start=1):
        own = orders.where(F.col("ordered") < F.lit(upto).cast("date"))
        entries = {name: {"path": f"{root}/{name}/{number}"} for name in ("orders", "totals")}
        own.write.parquet(entries["orders"]["path"])
        written = spark.read.parquet(entries["orders"]["path"])
        written.groupBy("o_orderstatus").agg(F.count("*").alias("counted")).write.parquet(entries["totals"]["path"])
        versions.commit(spark, root, f"run{number}", entries, number - 1 or None)
    out = []
    for number in versions.numbers(spark, root):
        version = versions.version(spark, root, number)
        sums = version.read(spark, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("orders"))
        out.append(sums.join(version.read(spark, "totals"), "o_orderstatus").select(F.lit(number).alias("version"), "o_orderstatus", "orders", "counted"))
    return out[0].unionByName(out[1])


@query(
    on_games(
        """, damaged AS (SELECT k FROM facts UNION ALL SELECT k FROM facts WHERE k % 7 = 0)
        SELECT 'not_null:pgn_moves' AS check_name, count(*) AS broken FROM damaged WHERE k % 5 = 0
        UNION ALL SELECT 'accepted_outcomes', count(*) FROM damaged WHERE k % 3 = 0
        UNION ALL SELECT 'unique', count(*) FROM facts WHERE k % 7 = 0"""
    )
)
def checks_while_writing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults in the per-game table, found in the one pass that writes it; repeated keys in the key column of what was written."""
    games = store.games(spark, sf_dir)
    key = F.substring("game_uuid", 2, 20).cast("long")
    copies = F.explode(F.array_repeat(F.lit(1), F.when(key % 7 == 0, 2).otherwise(1)))
    damaged = games.withColumn("copies", copies).drop("copies").withColumns(
        {
            "pgn_moves": F.when(key % 5 != 0, F.col("pgn_moves")),
            "player_wdl": F.when(key % 3 == 0, "abandoned").otherwise(F.col("player_wdl")),
        }
    )
    # The wide rows are written where they are; only their keys are hashed, read back from the written table.
    passing, watch = checks.watched("prep_player_games", damaged, unique=False)
    path = f"{store.folder(spark, sf_dir, 'watched')}-{uuid.uuid4().hex}"
    passing.write.mode("overwrite").option("compression", "zstd").parquet(path)
    counts = {**watch.counts(), "unique": checks.repeated_keys("prep_player_games", spark.read.parquet(path))}
    found = [(name, n) for name, n in counts.items() if n]
    return spark.createDataFrame(found, "check_name string, broken long")


# --- cube -------------------------------------------------------------------------------


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube.select_cells(store.cube(spark, sf_dir), "chess", "rapid", an.colors_for("All"), FIRST, LAST)


@query(game_queries.SQL["key_figures"])
def cube_key_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube.key_figures(cells(spark, sf_dir), "rapid").withColumn("total_seconds", F.round("total_seconds", 1))


@query(game_queries.SQL["date_bounds"])
def cube_date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube.date_bounds(store.cube(spark, sf_dir), "blitz", ["Black"])


@query(game_queries.SQL["daily_rating"])
def cube_daily_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube.daily_rating(cells(spark, sf_dir))


@query(game_queries.SQL["outcome_reason_share"])
def cube_outcome_reason_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube.outcome_reason_share(cells(spark, sf_dir))


@query(game_queries.SQL["outcome_reason_stack"])
def cube_outcome_reason_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube.outcome_reason_stack(cells(spark, sf_dir))


@query(game_queries.SQL["outcomes_by_weekday"])
def cube_outcomes_by_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube.outcomes_by_weekday(cells(spark, sf_dir), ZONE)


@query(game_queries.SQL["outcomes_by_hour"])
def cube_outcomes_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube.outcomes_by_hour(cells(spark, sf_dir), ZONE)


@query(game_queries.SQL["win_rate_by_weekday_hour"])
def cube_win_rate_by_weekday_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube.win_rate_by_weekday_hour(cells(spark, sf_dir), ZONE)


@query(game_queries.SQL["end_phases"])
def cube_end_phases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube.end_phases(cells(spark, sf_dir))


# --- openings ---------------------------------------------------------------------------

# All moves of a game as they are numbered in its text.
_LISTS = """lists AS (
  SELECT k, list(CASE WHEN white_move THEN pair || '. ' || san ELSE pair || '... ' || san END ORDER BY ply)
    FILTER (white_move OR time_class <> 'daily') AS listed FROM timed GROUP BY k)"""


@query(
    on_mart(
        f""", {_LISTS},
        opening AS (
          SELECT moves, player_color, player_wdl, array_to_string(listed[1:moves], ' ') AS starting_moves, count(*) AS wdl_num_games
          FROM mart JOIN lists USING (k), (SELECT unnest(range(1, 8))::INT AS moves) WHERE {SELECTED} AND len(listed) > 0 GROUP BY ALL),
        total AS (SELECT moves, player_color, starting_moves, sum(wdl_num_games)::BIGINT AS num_games FROM opening GROUP BY ALL),
        placed AS (SELECT *, dense_rank() OVER (PARTITION BY moves, player_color ORDER BY num_games DESC)::INT AS rn FROM total)
        SELECT o.moves AS moves, o.player_color AS player_color, o.starting_moves AS starting_moves, player_wdl, wdl_num_games, num_games, rn,
          100.0::DOUBLE * wdl_num_games / num_games AS perc
        FROM opening o JOIN placed p ON p.moves = o.moves AND p.player_color = o.player_color AND p.starting_moves = o.starting_moves WHERE rn <= 5"""
    )
)
def top_openings_of_all_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most played first one to seven moves, all from one tree."""
    return openings.top_openings(openings.build_tree(selected(spark, sf_dir)), list(range(1, 8)))


@query(game_queries.SQL["games_of_opening"])
def games_of_opening_by_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drill-through on the games laid out by their openings."""
    drill = store.drill(spark, sf_dir, lambda mart: an.select_games(mart, "chess", "rapid", an.colors_for("All"), FIRST, LAST), "drill-rapid")
    return openings.games_of(drill, "1. e4 1... e5 2. d3", 3, "White", "win")


# --- ranks and last values --------------------------------------------------------------


@query(
    """SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS place,
      rank() OVER (ORDER BY l_extendedprice DESC) AS standing, dense_rank() OVER (ORDER BY l_extendedprice DESC) AS level FROM lineitem"""
)
def ranks_of_all_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Global ranks of every line item, with ties, without a window over all rows."""
    configure(spark)
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    ranked = ranking.global_ranks(items, "l_extendedprice", [F.asc("l_orderkey"), F.asc("l_linenumber")], store.folder(spark, sf_dir, "ranks"))
    return ranked.select("l_orderkey", "l_linenumber", "place", "standing", "level")


@query(
    on_mart(
        f"""SELECT player_color, player_wdl, first_three AS starting_moves, {URL} AS game_analysis_url FROM mart WHERE {SELECTED}
        QUALIFY row_number() OVER (PARTITION BY player_color, player_wdl, first_three ORDER BY md5(concat_ws('|', {URL}, '7')), {URL}) <= 5"""
    )
)
def sample_games_of_every_opening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five games of every opening of three moves and outcome, in one shuffle."""
    own = selected(spark, sf_dir).where(F.size("pgn_move_extract") > 0)
    own = own.select("player_color", "player_wdl", an.starting_moves(3).alias("starting_moves"), "game_analysis_url")
    return ranking.samples_per_group(own, ["player_color", "player_wdl", "starting_moves"], 5, "game_analysis_url", seed=7)


# --- functions by name ------------------------------------------------------------------


@query(table_queries.SQL["lost_letters"])
def captured_letters_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    named.register(spark)
    return spark.sql(
        """SELECT conv_id, turn, captured_letter(former, text) AS lost
        FROM (SELECT conv_id, turn, text, coalesce(lag(text) OVER (PARTITION BY conv_id ORDER BY turn), '') AS former FROM {conversations})""",
        conversations=table(spark, sf_dir, "conversations"),
    )


@query(
    on_moves(
        """SELECT game_uuid, count(*) AS moves, string_agg(san, ' ' ORDER BY ply) AS played FROM (SELECT * FROM timed WHERE white_move OR time_class <> 'daily') GROUP BY game_uuid"""
    )
)
def move_rows_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moves of every game through the table function."""
    named.register(spark)
    return spark.sql(
        """SELECT game_uuid, count(*) AS moves, listagg(game_move, ' ') WITHIN GROUP (ORDER BY move_index) AS played
        FROM {games}, LATERAL move_rows(pgn_moves) GROUP BY game_uuid""",
        games=store.games(spark, sf_dir),
    )


@query(table_queries.SQL["calendar_age"])
def calendar_age_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    named.register(spark)
    return spark.sql(
        """SELECT o_orderkey, calendar_age_seconds(TIMESTAMP_NTZ '1998-03-01 01:00:30.5', at) AS since,
          calendar_age_seconds(at, TIMESTAMP_NTZ '1998-03-31 12:00:00') AS until
        FROM (SELECT o_orderkey, CAST(timestamp_seconds(unix_timestamp(CAST(o_orderdate AS TIMESTAMP)) + o_orderkey * 37 % 86400) AS TIMESTAMP_NTZ) AS at FROM {orders})""",
        orders=table(spark, sf_dir, "orders"),
    )


# --- records that drift -----------------------------------------------------------------

PROPS = [drift.Path("k", "$.k", "bigint", required=True), drift.Path("w", "$.w", "double")]
_DRIFTED = """e AS (SELECT event_id, CASE WHEN event_id % 13 = 0 THEN '{"k": ' WHEN event_id % 11 = 0 THEN '{"k": "v' || user_id || '"}'
  WHEN event_id % 7 = 0 THEN replace(props, '}', ', "src": "app", "w": 1.5}') WHEN event_id % 5 = 0 THEN '{"w": null}' ELSE props END AS text FROM events),
j AS (SELECT event_id, text::JSON AS doc FROM e WHERE json_valid(text))"""


def drifted(events: DataFrame) -> DataFrame:
    """Events whose records changed shape: cut off, of another type, with new fields, without a required one."""
    key = F.col("event_id")
    text = (
        F.when(key % 13 == 0, '{"k": ')
        .when(key % 11 == 0, F.concat(F.lit('{"k": "v'), F.col("user_id").cast("string"), F.lit('"}')))
        .when(key % 7 == 0, F.replace("props", F.lit("}"), F.lit(', "src": "app", "w": 1.5}')))
        .when(key % 5 == 0, '{"w": null}')
        .otherwise(F.col("props"))
    )
    return events.select("event_id", text.alias("text"))


@query(
    f"""WITH {_DRIFTED}, f AS (SELECT unnest(json_keys(doc)) AS field, doc FROM j)
    SELECT field, CASE json_type(doc, field) WHEN 'VARCHAR' THEN 'STRING' WHEN 'DOUBLE' THEN 'DECIMAL(2,1)' WHEN 'NULL' THEN 'VOID' ELSE 'BIGINT' END AS found,
      CASE field WHEN 'k' THEN 'bigint' WHEN 'w' THEN 'double' END AS expected, count(*) AS records FROM f GROUP BY ALL"""
)
def drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return drift.report(drifted(table(spark, sf_dir, "events")), "text", PROPS)


@query(
    f"""WITH {_DRIFTED}, c AS (
      SELECT CASE WHEN NOT json_valid(text) THEN 'unreadable' WHEN json_type(text, 'k') IS NULL THEN 'k: missing'
                  WHEN json_type(text, 'k') = 'VARCHAR' THEN 'k: STRING for bigint' ELSE '' END AS problems,
             CASE WHEN json_valid(text) THEN try_cast(text->>'$.k' AS BIGINT) END AS k, CASE WHEN json_valid(text) THEN (text->>'$.w')::DOUBLE END AS w FROM e)
    SELECT problems, count(*) AS records, coalesce(sum(k) FILTER (problems = ''), 0)::BIGINT AS k_total, count(w) FILTER (problems = '') AS with_w FROM c GROUP BY 1"""
)
def drift_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    sound, aside = drift.split(drifted(table(spark, sf_dir, "events")), "text", PROPS)
    kept = sound.agg(F.lit("").alias("problems"), F.count("*").alias("records"), F.coalesce(F.sum("k"), F.lit(0)).alias("k_total"), F.count("w").alias("with_w"))
    gone = aside.groupBy(F.array_join("problems", "; ").alias("problems")).agg(F.count("*").alias("records"), F.lit(0).cast("long").alias("k_total"), F.lit(0).cast("long").alias("with_w"))
    return kept.unionByName(gone)

"""The game tables and the analyses on them, over the archive derived from ``orders``."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyframe.catalog import archive, store
from plyframe.catalog.game_oracle import (
    OPENING,
    PLAYER_NAME,
    URL,
    on_games,
    on_mart,
    on_moves,
)
from plyframe.operators import quality
from plyframe.operators.attacks import attack_graph, mating_pieces
from plyframe.plans import analyses as an
from plyframe.plans.checks import RULES
from plyframe.plans.game_moves import prepare_moves
from plyframe.plans.games import build_games, game_totals
from plyframe.plans.player_games import describe_games, prepare_games
from plyframe.sources import contract

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with the SQL that checks it."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


# --- tables -----------------------------------------------------------------------------


@query(
    """WITH o AS (SELECT *, o_custkey % 25 = 0 AS shuffled FROM orders)
    SELECT CASE WHEN shuffled THEN 'chess960' ELSE 'chess' END AS rules, count(*) AS records,
      count(*) FILTER (o_orderkey % 3 = 0) AS with_accuracies,
      count(*) FILTER (o_orderkey % 6 = 0) AS with_black_accuracy,
      sum(1000 + (o_custkey * 13) % 1500)::BIGINT AS white_ratings, count(DISTINCT o_orderkey) AS ids
    FROM o GROUP BY shuffled"""
)
def raw_player_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract check, flattening and lineage of the nested records."""
    valid, _ = contract.split_valid(store.checked(spark, sf_dir))
    raw = contract.with_lineage(contract.flatten(valid), 1.0)
    return raw.groupBy("rules").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("accuracies__white").isNotNull()).alias("with_accuracies"),
        F.count_if(F.col("accuracies__black").isNotNull()).alias("with_black_accuracy"),
        F.sum("white__rating").alias("white_ratings"),
        F.count_distinct("_dlt_id").alias("ids"),
    )


@query(
    """SELECT CASE WHEN o_orderkey % 7 = 0 AND o_custkey % 25 <> 0 THEN 'pgn is required for non-bughouse games'
        ELSE 'valid' END AS problem, count(*) AS records
    FROM orders GROUP BY 1"""
)
def contract_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh text removed, variants declared bughouse: who breaks the contract?"""
    records = store.records(spark, sf_dir).withColumns(
        {
            "pgn": F.when(F.substring("uuid", 2, 20).cast("long") % 7 != 0, F.col("pgn")),
            "rules": F.when(F.col("rules") == "chess", "chess").otherwise("bughouse"),
        }
    )
    problems = contract.with_problems(records, contract.RECORD, contract.text_rule())
    problem = F.coalesce(F.nullif("problems", F.lit("")), F.lit("valid"))
    return problems.groupBy(problem.alias("problem")).agg(F.count(F.lit(1)).alias("records"))


@query(
    on_games(
        f"""SELECT game_uuid, ended AS end_time, time_control, status <> 'P' AS rated, time_class, 'chess' AS rules,
          white_rating::INT AS white__rating, black_rating::INT AS black__rating,
          CASE WHEN player_white THEN {PLAYER_NAME} ELSE guest END AS white__username,
          CASE WHEN player_white THEN guest ELSE {PLAYER_NAME} END AS black__username,
          CASE WHEN k % 3 = 0 THEN (50 + k % 50)::DOUBLE END AS accuracies__white
        FROM facts"""
    )
)
def stg_player_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.staged(spark, sf_dir).select(
        "game_uuid", "end_time", "time_control", "rated", "time_class", "rules", "white__rating",
        "black__rating", "white__username", "black__username", "accuracies__white",
    )


@query(
    on_mart(
        f"""SELECT game_uuid, base::INT AS time_control_base, added::INT AS time_control_add_seconds,
          CASE WHEN time_class = 'daily' THEN 'daily 3 days' ELSE time_class || ' ' || time_control END AS game_mode,
          player_color, player_rating::INT AS player_rating, opponent_rating::INT AS opponent_rating,
          CASE player_wdl WHEN 'win' THEN 'win' WHEN 'draw' THEN 'agreed' ELSE player_wdl_reason END AS player_result,
          CASE player_wdl WHEN 'lose' THEN 'win' WHEN 'draw' THEN 'agreed' ELSE player_wdl_reason END AS opponent_result,
          opponent_rating > player_rating AS is_stronger_opponent, player_wdl, player_wdl_reason,
          numbered AS pgn_move_extract_string, {URL} AS game_analysis_url,
          CASE WHEN time_class = 'daily' THEN 0 ELSE white_moves + black_moves END::INT AS clocks,
          eco, {OPENING} || 'Line-' || eco AS eco_url, 'Line-' || eco AS eco_name,
          started::DATE AS game_start_date, strftime(started, '%H:%M:%S') AS game_start_time,
          started AS game_start_timestamp, ended AS game_end_timestamp,
          epoch(age(ended, started)) AS time_played_seconds, coalesce(pieces, '') AS checkmate_pieces
        FROM mart"""
    )
)
def prep_player_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per game, from the staged table: parsing, perspective, mating pieces."""
    return prepare_games(store.staged(spark, sf_dir), archive.PLAYER).select(
        "game_uuid", "time_control_base", "time_control_add_seconds", "game_mode", "player_color",
        "player_rating", "opponent_rating", "player_result", "opponent_result",
        "is_stronger_opponent", "player_wdl", "player_wdl_reason", "pgn_move_extract_string",
        "game_analysis_url", F.size("pgn_clock_extract").alias("clocks"), "eco", "eco_url", "eco_name",
        "game_start_date", "game_start_time", "game_start_timestamp", "game_end_timestamp",
        "time_played_seconds", F.array_join("checkmate_pieces", ",").alias("checkmate_pieces"),
    )


@query(
    on_moves(
        """SELECT game_uuid || '_' || (t.ply + 1) AS id, game_uuid, time_class, base::INT AS time_control_base,
          added::INT AS time_control_add_seconds, player_color, t.ply + 1 AS game_move_index,
          string_agg(pair || CASE WHEN white_move THEN '. ' ELSE '... ' END || san, ' ') OVER (PARTITION BY k ORDER BY t.ply) AS pgn_cum_move,
          CASE WHEN white_move THEN 'White' ELSE 'Black' END AS color_move, pair AS color_move_index, san AS game_move,
          NULL::VARCHAR AS captured_piece, clock - added AS clock_interval_move, clock AS clock_interval_post_move,
          prev_clock AS prev_clock_interval, move_time AS move_time_seconds, NULL::VARCHAR AS fen,
          NULL::BIGINT AS major_minor_cnt, NULL::BIGINT AS black_major_minor, NULL::BIGINT AS white_major_minor,
          NULL::BOOLEAN AS is_backrank_sparse, NULL::BOOLEAN AS is_midgame, NULL::BOOLEAN AS is_endgame, NULL::VARCHAR AS game_phase
        FROM timed t"""
    )
)
def prep_game_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per move: clocks and running text; no positions are given, so what needs a board is NULL."""
    return prepare_moves(store.games(spark, sf_dir)).drop("pgn_header", "rules")


@query(
    on_mart(
        """SELECT game_uuid, time_class, player_color, player_wdl, white_time AS white_total_move_time,
          white_moves AS white_num_moves, black_time AS black_total_move_time, black_moves AS black_num_moves,
          player_time AS player_total_move_time, player_moves AS player_num_moves,
          opponent_time AS opponent_total_move_time, opponent_moves AS opponent_num_moves,
          ended_phase AS ended_game_phase, (opponent_rating // 100 * 100)::DOUBLE AS opponent_rating_bin
        FROM mart"""
    )
)
def games_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals per game joined to the games and swapped to the player's view."""
    total = lambda c: F.round(c, 1).alias(c)
    return build_games(store.games(spark, sf_dir), store.moves(spark, sf_dir)).select(
        "game_uuid", "time_class", "player_color", "player_wdl",
        total("white_total_move_time"), "white_num_moves", total("black_total_move_time"), "black_num_moves",
        total("player_total_move_time"), "player_num_moves",
        total("opponent_total_move_time"), "opponent_num_moves", "ended_game_phase", "opponent_rating_bin",
    )


@query(
    on_mart(
        """SELECT game_uuid, white_time AS white_total_move_time, white_moves AS white_num_moves,
          black_time AS black_total_move_time, black_moves AS black_num_moves FROM mart"""
    )
)
def move_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two-aggregate pivot, in one group per game."""
    return (
        game_totals(store.moves(spark, sf_dir))
        .withColumn("white_total_move_time", F.round("white_total_move_time", 1))
        .withColumn("black_total_move_time", F.round("black_total_move_time", 1))
    )


# --- attacks ----------------------------------------------------------------------------


@query(
    on_games("SELECT game_uuid, pieces AS checkmate_pieces FROM facts WHERE mate"),
)
def checkmate_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces that hold the mated king, by the attack graph."""
    games = describe_games(store.staged(spark, sf_dir), archive.PLAYER)
    return mating_pieces(games, ["game_uuid"]).select(
        "game_uuid", F.array_join("checkmate_pieces", ",").alias("checkmate_pieces")
    )


_STEPS = {
    "n": "(1,2),(2,1),(-1,2),(-2,1),(1,-2),(2,-1),(-1,-2),(-2,-1)",
    "k": "(0,1),(0,-1),(1,0),(-1,0),(1,1),(1,-1),(-1,1),(-1,-1)",
}


@query(
    f"""WITH RECURSIVE p(fen, games) AS (
      SELECT fen, count(*) FROM (SELECT coalesce(CASE WHEN o_orderkey % 5 = 0 THEN t.position END, e.position) AS fen
        FROM orders LEFT JOIN (VALUES {", ".join(f"({n}, '{t[2]}')" for n, t in enumerate(archive.TACTICS) if t[2])}) t(no, position)
          ON t.no = (o_orderkey // 5) % {len(archive.TACTICS)}
        JOIN (VALUES {", ".join(f"({n}, '{f}')" for n, f in enumerate(archive.FINALS))}) e(no, position) ON e.no = o_orderkey % {len(archive.FINALS)} WHERE o_custkey % 25 <> 0) WHERE fen IS NOT NULL GROUP BY fen),
    step(kind, dr, dc, far) AS (
      SELECT 'n', dr, dc, 1 FROM (VALUES {_STEPS["n"]}) v(dr, dc)
      UNION ALL SELECT kind, dr, dc, far FROM (VALUES {_STEPS["k"]}) v(dr, dc),
        (VALUES ('k', 1), ('q', 7), ('r', 7), ('b', 7)) f(kind, far)
        WHERE kind IN ('k', 'q') OR (kind = 'r') = (dr = 0 OR dc = 0)
      UNION ALL SELECT kind, dr, dc, 1 FROM (VALUES ('P', -1, -1), ('P', -1, 1), ('p', 1, -1), ('p', 1, 1)) v(kind, dr, dc)),
    sq AS (
      SELECT fen, games, list_transform(range(64), lambda i: board[i + 1]) AS board FROM (
        SELECT fen, games, string_split(replace(replace(replace(replace(replace(replace(replace(replace(replace(
          split_part(fen, ' ', 1), '/', ''), '8', '........'), '7', '.......'), '6', '......'), '5', '.....'), '4', '....'),
          '3', '...'), '2', '..'), '1', '.'), '') AS board FROM p)),
    piece AS (SELECT fen, games, board, i, board[i + 1] AS c FROM sq, range(64) r(i) WHERE board[i + 1] <> '.'),
    ray AS (
      SELECT fen, games, board, c, i, i // 8 + dr AS r, i % 8 + dc AS f, dr, dc, far - 1 AS far
      FROM piece JOIN step ON kind = CASE WHEN lower(c) = 'p' THEN c ELSE lower(c) END
      WHERE i // 8 + dr BETWEEN 0 AND 7 AND i % 8 + dc BETWEEN 0 AND 7
      UNION ALL
      SELECT fen, games, board, c, i, r + dr, f + dc, dr, dc, far - 1 FROM ray
      WHERE far > 0 AND board[r * 8 + f + 1] = '.' AND r + dr BETWEEN 0 AND 7 AND f + dc BETWEEN 0 AND 7)
    SELECT c AS piece, i::INT AS from_square, (r * 8 + f)::INT AS to_square,
      nullif(board[r * 8 + f + 1], '.') AS held_by, sum(games)::BIGINT AS games
    FROM ray GROUP BY ALL"""
)
def attack_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attack graph of all final positions, edges counted over the games."""
    edges = attack_graph(store.staged(spark, sf_dir), ["game_uuid"])
    return edges.groupBy("piece", "from_square", "to_square", "held_by").agg(
        F.count(F.lit(1)).alias("games")
    )


# --- analyses ---------------------------------------------------------------------------

FIRST, LAST = date(1996, 1, 1), date(2000, 12, 31)
SELECTED = "time_class = 'rapid' AND started::DATE BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'"
ZONE = "America/New_York"


def selected(spark: SparkSession, sf_dir: str, time_class: str = "rapid", color: str = "All") -> DataFrame:
    return an.select_games(
        store.mart(spark, sf_dir), "chess", time_class, an.colors_for(color), FIRST, LAST
    )


@query(
    on_games(
        """SELECT 'rules' AS filter, 'chess' AS choice WHERE EXISTS (SELECT 1 FROM facts)
        UNION ALL SELECT DISTINCT 'time_class', time_class FROM facts
        UNION ALL SELECT DISTINCT 'player_color', player_color FROM facts"""
    )
)
def filter_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = an.filter_options(store.mart(spark, sf_dir))
    tables = [t.select(F.lit(c).alias("filter"), F.col(c).alias("choice")) for c, t in options.items()]
    return tables[0].unionAll(tables[1]).unionAll(tables[2])


@query(
    on_games(
        """SELECT min(started::DATE) AS first_date, max(started::DATE) AS last_date FROM facts
        WHERE time_class = 'blitz' AND player_color = 'Black'"""
    )
)
def date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.date_bounds(store.mart(spark, sf_dir), "blitz", ["Black"])


@query(on_games(f"SELECT game_uuid FROM facts WHERE {SELECTED} AND player_color = 'White'"))
def base_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selected(spark, sf_dir, color="White").select("game_uuid")


@query(
    on_mart(
        f"""SELECT num_games, win_perc, highest_rating, num_moves, round(seconds, 1) AS total_seconds,
          CASE floor(seconds / 86400) WHEN 0 THEN '' WHEN 1 THEN '1 day, ' ELSE floor(seconds / 86400)::BIGINT || ' days, ' END
            || floor(seconds / 3600 % 24)::BIGINT || strftime(TIMESTAMP '2000-01-01' + to_seconds(floor(seconds)::BIGINT), ':%M:%S') AS total_move_time
        FROM (SELECT count(*) AS num_games, avg((player_wdl = 'win')::INT) AS win_perc, max(player_rating)::INT AS highest_rating,
          sum(player_moves)::BIGINT AS num_moves, round(sum(player_time), 1) AS seconds FROM mart WHERE {SELECTED})"""
    )
)
def key_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.key_figures(selected(spark, sf_dir), "rapid").withColumn(
        "total_seconds", F.round("total_seconds", 1)
    )


@query(
    on_games(
        f"""SELECT started::DATE AS game_start_date, max(player_rating) FILTER (rn = 1)::INT AS player_rating, count(*) AS num_games
        FROM (SELECT *, row_number() OVER (PARTITION BY started::DATE ORDER BY started DESC, game_uuid DESC) AS rn
          FROM facts WHERE {SELECTED}) GROUP BY 1"""
    )
)
def daily_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.daily_rating(selected(spark, sf_dir))


@query(
    on_games(
        f"""SELECT player_wdl, count(*) AS num_games, 100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS win_perc
        FROM facts WHERE {SELECTED} GROUP BY player_wdl"""
    )
)
def outcome_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.outcome_share(selected(spark, sf_dir))


@query(
    on_games(
        f"""SELECT player_wdl, player_wdl_reason, count(*) AS num_games,
          100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS win_perc
        FROM facts WHERE {SELECTED} GROUP BY ALL"""
    )
)
def outcome_reason_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.outcome_reason_share(selected(spark, sf_dir))


@query(
    on_games(
        f"""SELECT player_wdl, player_wdl_reason, count(*) AS num_games,
          count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY player_wdl) AS share
        FROM facts WHERE {SELECTED} GROUP BY player_wdl, player_wdl_reason"""
    )
)
def outcome_reason_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.outcome_reason_stack(selected(spark, sf_dir))


# The US rule of the years in question: first Sunday of April to last Sunday of October, 2 a.m.
_LOCAL = f"""local AS (
  SELECT *, started - CASE WHEN started >= spring AND started < autumn THEN INTERVAL 4 HOUR ELSE INTERVAL 5 HOUR END AS ts
  FROM (SELECT *,
    make_date(year(started), 4, 1) + ((7 - dayofweek(make_date(year(started), 4, 1))) % 7)::INT + INTERVAL 7 HOUR AS spring,
    make_date(year(started), 10, 31) - dayofweek(make_date(year(started), 10, 31))::INT + INTERVAL 6 HOUR AS autumn
    FROM facts WHERE {SELECTED}))"""


@query(on_games(f", {_LOCAL} SELECT dayname(ts) AS ts_day_of_week_name, count(*) AS num_games FROM local GROUP BY 1"))
def games_by_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    weekdays = an.games_by_weekday(selected(spark, sf_dir), ZONE)
    return an.in_display_order(weekdays, "ts_day_of_week_name", an.DISPLAY_WEEK)


@query(
    on_games(
        f""", {_LOCAL} SELECT dayname(ts) AS ts_day_of_week_name, player_wdl, count(*) AS num_games,
          count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY dayname(ts)) AS share FROM local GROUP BY dayname(ts), player_wdl"""
    )
)
def outcomes_by_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.outcomes_by_weekday(selected(spark, sf_dir), ZONE)


@query(on_games(f", {_LOCAL} SELECT hour(ts)::INT AS ts_hour, count(*) AS num_games FROM local GROUP BY 1"))
def games_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.games_by_hour(selected(spark, sf_dir), ZONE)


@query(
    on_games(
        f""", {_LOCAL} SELECT hour(ts)::INT AS ts_hour, player_wdl, count(*) AS num_games,
          count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY hour(ts)) AS share FROM local GROUP BY hour(ts), player_wdl"""
    )
)
def outcomes_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.outcomes_by_hour(selected(spark, sf_dir), ZONE)


@query(
    on_games(
        f""", {_LOCAL} SELECT dayname(ts) AS ts_day_of_week_name, hour(ts)::INT AS ts_hour,
          100.0::DOUBLE * count(*) FILTER (player_wdl = 'win') / count(*) AS perc, count(*) AS num_games
        FROM local GROUP BY ALL"""
    )
)
def win_rate_by_weekday_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.win_rate_by_weekday_hour(selected(spark, sf_dir), ZONE)


@query(
    on_games(
        f"""SELECT player_wdl, pieces AS checkmate_pieces, count(*) AS num_games
        FROM facts WHERE {SELECTED} AND player_wdl_reason = 'checkmated' GROUP BY ALL"""
    )
)
def mating_combinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.mating_combinations(selected(spark, sf_dir)).withColumn(
        "checkmate_pieces", F.array_join("checkmate_pieces", ",")
    )


@query(
    on_mart(
        f"""SELECT ended_phase AS ended_game_phase, player_wdl, count(*) AS num_games,
          sum(count(*)) OVER ()::BIGINT AS total_games FROM mart WHERE {SELECTED} GROUP BY ALL"""
    )
)
def end_phases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.end_phases(selected(spark, sf_dir))


@query(on_mart(f"SELECT ended_phase AS ended_game_phase, count(*) AS num_games FROM mart WHERE {SELECTED} GROUP BY ALL"))
def games_by_end_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    phases = an.games_by_end_phase(an.end_phases(selected(spark, sf_dir)))
    return an.in_display_order(phases, "ended_game_phase", an.PHASES)


@query(
    on_mart(
        f"""SELECT ended_phase AS ended_game_phase, player_wdl, count(*) AS num_games,
          count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY ended_phase) AS share FROM mart WHERE {SELECTED} GROUP BY ended_phase, player_wdl"""
    )
)
def outcomes_by_end_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.outcomes_by_end_phase(selected(spark, sf_dir))


# All openings with their totals, and the places of the totals within a colour.
_OPENINGS = f"""opening AS (
  SELECT player_color, player_wdl, first_three AS starting_moves, count(*) AS wdl_num_games
  FROM mart WHERE {SELECTED} GROUP BY ALL),
total AS (SELECT player_color, starting_moves, sum(wdl_num_games)::BIGINT AS num_games FROM opening GROUP BY ALL),
top AS (
  SELECT o.*, t.num_games, 100.0::DOUBLE * wdl_num_games / t.num_games AS perc,
    (SELECT count(DISTINCT u.num_games) FROM total u WHERE u.player_color = o.player_color AND u.num_games >= t.num_games)::INT AS rn
  FROM opening o JOIN total t ON t.player_color = o.player_color AND t.starting_moves = o.starting_moves)"""


@query(on_mart(f", {_OPENINGS} SELECT * FROM top WHERE rn <= 5"))
def top_openings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.top_openings(selected(spark, sf_dir), 3)


def _best(color: str, wdl: str) -> str:
    return on_mart(
        f""", {_OPENINGS} SELECT *, row_number() OVER (ORDER BY perc DESC, starting_moves)::INT AS place FROM top
        WHERE rn <= 5 AND player_color = '{color}' AND player_wdl = '{wdl}' ORDER BY place LIMIT 3"""
    )


@query(_best("White", "win"))
def best_openings_white(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.best_openings(an.top_openings(selected(spark, sf_dir), 3), "White", "win", alias="place")


@query(_best("White", "lose"))
def worst_openings_white(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.best_openings(an.top_openings(selected(spark, sf_dir), 3), "White", "lose", alias="place")


@query(_best("Black", "win"))
def best_openings_black(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.best_openings(an.top_openings(selected(spark, sf_dir), 3), "Black", "win", alias="place")


@query(_best("Black", "lose"))
def worst_openings_black(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.best_openings(an.top_openings(selected(spark, sf_dir), 3), "Black", "lose", alias="place")


@query(
    on_mart(
        f"""SELECT {URL} AS game_analysis_url FROM mart WHERE {SELECTED} AND player_color = 'White'
        AND player_wdl = 'win' AND first_three = '1. e4 1... e5 2. d3'"""
    )
)
def games_of_opening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.games_of_opening(selected(spark, sf_dir), "1. e4 1... e5 2. d3", 3, "White", "win")


@query(
    on_mart(
        f"""SELECT {URL} AS game_analysis_url FROM mart WHERE {SELECTED} AND player_color = 'White'
        AND player_wdl = 'win' AND first_three = '1. e4 1... e5 2. d3'
        ORDER BY md5(concat_ws('|', {URL}, '7')), {URL} LIMIT 5"""
    )
)
def sample_games_of_opening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five of the rows of ``games_of_opening``, drawn by hash."""
    return an.sample_games_of_opening(
        selected(spark, sf_dir), "1. e4 1... e5 2. d3", 3, "White", "win", 5, seed=7
    )


@query(
    on_mart(
        f"""SELECT CASE WHEN player_white THEN {PLAYER_NAME} ELSE guest END AS white__username,
          CASE WHEN player_white THEN guest ELSE {PLAYER_NAME} END AS black__username, player_color, player_wdl,
          player_wdl_reason, opponent_rating::INT AS opponent_rating, {URL} AS game_analysis_url
        FROM mart WHERE {SELECTED} ORDER BY started DESC, game_uuid LIMIT 20"""
    )
)
def latest_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.latest_games(selected(spark, sf_dir))


# --- checks -----------------------------------------------------------------------------


@query(
    """SELECT 'accuracies__black' AS column_name, count(*) AS nulls FROM orders WHERE o_custkey % 25 <> 0 AND o_orderkey % 6 <> 0
    UNION ALL SELECT 'accuracies__white', count(*) FROM orders WHERE o_custkey % 25 <> 0 AND o_orderkey % 3 <> 0"""
)
def nulls_in_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = store.staged(spark, sf_dir)
    return quality.null_counts(staged, staged.columns)


@query(
    """SELECT CASE WHEN o_custkey % 25 = 0 THEN 'chess960' END AS rules, count(*) AS occurrences
    FROM orders WHERE o_custkey % 25 = 0 GROUP BY 1"""
)
def variants_beside_chess(spark: SparkSession, sf_dir: str) -> DataFrame:
    allowed = [r for r in RULES if r != "chess960"]
    return quality.unaccepted(store.raw(spark, sf_dir), "rules", allowed)


@query(on_games("SELECT game_uuid FROM facts WHERE mate AND k % 3 = 0"))
def unexplained_mates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mates without pieces, after every third game has lost its pieces."""
    third = F.substring("game_uuid", 2, 20).cast("long") % 3 == 0
    kept = F.when(~third, F.col("checkmate_pieces")).otherwise(F.array().cast("array<string>"))
    return quality.unexplained_mates(
        store.games(spark, sf_dir).withColumn("checkmate_pieces", kept)
    )


@query(on_games("SELECT game_uuid FROM facts WHERE mate AND k % 3 = 0"))
def unexpected_mates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces without a mate, after the results of every third game were called drawn."""
    third = F.substring("game_uuid", 2, 20).cast("long") % 3 == 0
    drawn = {c: F.when(third, "agreed").otherwise(F.col(c)) for c in ("player_result", "opponent_result")}
    return quality.unexpected_mates(store.games(spark, sf_dir).withColumns(drawn))


@query(
    on_moves(
        """SELECT count(*) FILTER (clock - added - 58 < 0) AS neg_time, count(*) AS num_rows,
          count(*) FILTER (clock - added - 58 < 0)::DOUBLE / count(*) * 100.0::DOUBLE AS perc FROM timed"""
    )
)
def negative_share_of_clocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of moves made with less than 58 seconds left, if above 0.1 %."""
    left = store.moves(spark, sf_dir).withColumn("left", F.col("clock_interval_move") - 58)
    return quality.negative_share(left, "left", 0.1)

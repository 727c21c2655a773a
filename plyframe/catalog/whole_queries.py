"""The tables of the pipeline with all their columns, lists as text, against SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plyframe.catalog import archive, store
from plyframe.catalog.game_oracle import OPENING, PLAYER_NAME, URL, on_mart
from plyframe.plans.game_moves import prepare_moves
from plyframe.plans.games import build_games
from plyframe.plans.player_games import prepare_games

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def register(function):
        QUERIES[function.__name__] = function
        SQL[function.__name__] = sql
        return function

    return register


# Texts of a game, from its moves; then every column of the records.
_WHOLE = f"""spelt AS (
  SELECT k, string_agg(san, '' ORDER BY ply) AS tcn, string_agg(CASE
      WHEN time_class <> 'daily' THEN pair || CASE WHEN white_move THEN '. ' ELSE '... ' END || san || ' ' || note
      WHEN white_move THEN pair || '. ' || san ELSE san END, ' ' ORDER BY ply) AS body,
    coalesce(string_agg(note, ' ' ORDER BY ply) FILTER (time_class <> 'daily'), '') AS notes
  FROM (SELECT *, '{{[%clk ' || tenths // 36000 || ':' || lpad((tenths // 600 % 60)::VARCHAR, 2, '0') || ':' || lpad((tenths // 10 % 60)::VARCHAR, 2, '0') || '.' || tenths % 10 || ']}}' AS note
    FROM (SELECT *, base * 10 - pair * (k % 7 + 1) * 3 AS tenths FROM timed)) GROUP BY k),
whole AS (
  SELECT m.*, tcn, notes, 'game/' || k AS url, status <> 'P' AS rated, sides.white AS white, sides.black AS black,
    CASE WHEN winner = 'White' THEN 'win' WHEN winner IS NOT NULL THEN lost ELSE 'agreed' END AS white_result,
    CASE WHEN winner = 'Black' THEN 'win' WHEN winner IS NOT NULL THEN lost ELSE 'agreed' END AS black_result,
    CASE WHEN k % 3 = 0 THEN (50 + k % 50)::DOUBLE END AS accuracy_white, CASE WHEN k % 6 = 0 THEN (40 + cust % 60)::DOUBLE END AS accuracy_black,
    concat('[Event "Archive"]', chr(10), '[White "', sides.white, '"]', chr(10), '[Black "', sides.black, '"]', chr(10), '[Result "', score, '"]', chr(10),
      '[ECO "', eco, '"]', chr(10), '[ECOUrl "', {OPENING}, 'Line-', eco, '"]', chr(10), '[UTCDate "', strftime(started, '%Y.%m.%d'), '"]', chr(10),
      '[StartTime "', strftime(started, '%H:%M:%S'), '"]') AS header,
    body || ' ' || score || chr(10) AS block
  FROM mart m JOIN spelt USING (k) JOIN (
    SELECT k, CASE WHEN player_white THEN {PLAYER_NAME} ELSE guest END AS white, CASE WHEN player_white THEN guest ELSE {PLAYER_NAME} END AS black,
      CASE WHEN winner = 'White' THEN '1-0' WHEN winner = 'Black' THEN '0-1' ELSE '1/2-1/2' END AS score,
      CASE WHEN mate THEN 'checkmated' WHEN winner = 'White' THEN 'resigned' ELSE 'timeout' END AS lost FROM facts) sides USING (k))"""
_RECORD = f"""url, header || chr(10) || chr(10) || block AS pgn, time_control, rated, accuracy_white AS accuracies__white, accuracy_black AS accuracies__black, tcn,
  game_uuid, '{archive.START}' AS initial_setup, position AS fen, time_class, 'chess' AS rules,
  white_rating::INT AS white__rating, white_result AS white__result, 'player/' || lower(white) AS white__aid, white AS white__username, sha1(lower(white)) AS white__uuid,
  black_rating::INT AS black__rating, black_result AS black__result, 'player/' || lower(black) AS black__aid, black AS black__username, sha1(lower(black)) AS black__uuid"""
_LINEAGE = "1.0::DOUBLE AS _dlt_load_id, sha256(url || '|' || game_uuid || '|' || epoch(ended)::BIGINT) AS _dlt_id"
_DERIVED = f"""base::INT AS time_control_base, added::INT AS time_control_add_seconds,
  CASE WHEN time_class = 'daily' THEN 'daily 3 days' ELSE time_class || ' ' || time_control END AS game_mode, player_color,
  player_rating::INT AS player_rating, opponent_rating::INT AS opponent_rating,
  CASE WHEN player_white THEN white_result ELSE black_result END AS player_result, CASE WHEN player_white THEN black_result ELSE white_result END AS opponent_result,
  opponent_rating > player_rating AS is_stronger_opponent, player_wdl, player_wdl_reason, block AS pgn_moves,
  numbered AS pgn_move_extract, notes AS pgn_clock_extract, {URL} AS game_analysis_url, eco, {OPENING} || 'Line-' || eco AS eco_url, 'Line-' || eco AS eco_name,
  started::DATE AS game_start_date, strftime(started, '%H:%M:%S') AS game_start_time, started AS game_start_timestamp, ended AS game_end_timestamp,
  epoch(age(ended, started)) AS time_played_seconds, coalesce(pieces, '') AS checkmate_pieces"""
_LISTS = ("pgn_move_extract", "pgn_clock_extract")


def as_text(df: DataFrame) -> DataFrame:
    """Lists as text, so that any engine compares them."""
    lists = {c: F.array_join(c, " ") for c in _LISTS}
    return df.withColumns({**lists, "checkmate_pieces": F.array_join("checkmate_pieces", ",")})


@query(on_mart(f", {_WHOLE} SELECT ended AS end_time, {_RECORD}, {_LINEAGE} FROM whole"))
def staged_games_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 25 columns of the staging table, lineage included."""
    return store.staged(spark, sf_dir)


@query(
    on_mart(
        f""", {_WHOLE} SELECT ended AS end_time, {_RECORD}, {_LINEAGE}, {_DERIVED}, header AS pgn_header, numbered AS pgn_move_extract_string,
        epoch(ended - started) AS interval_seconds FROM whole"""
    )
)
def player_games_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 52 columns of the per-game table; the interval as its seconds."""
    games = as_text(prepare_games(store.staged(spark, sf_dir), archive.PLAYER))
    seconds = (F.extract(F.lit("DAY"), "time_played_interval") * 86400 + F.extract(F.lit("HOUR"), "time_played_interval") * 3600
               + F.extract(F.lit("MINUTE"), "time_played_interval") * 60 + F.extract(F.lit("SECOND"), "time_played_interval"))
    return games.withColumn("interval_seconds", seconds.cast("double")).drop("time_played_interval")


@query(
    on_mart(
        f""", {_WHOLE} SELECT {_RECORD}, {_DERIVED}, white_time AS white_total_move_time, white_moves AS white_num_moves, black_time AS black_total_move_time,
        black_moves AS black_num_moves, player_time AS player_total_move_time, player_moves AS player_num_moves, opponent_time AS opponent_total_move_time,
        opponent_moves AS opponent_num_moves, ended_phase AS ended_game_phase, (opponent_rating // 100 * 100)::DOUBLE AS opponent_rating_bin FROM whole"""
    )
)
def games_mart_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 56 columns of the mart."""
    mart = as_text(build_games(store.games(spark, sf_dir), store.moves(spark, sf_dir)))
    return mart.withColumns({c: F.round(c, 1) for c in mart.columns if c.endswith("_total_move_time")})


@query(
    on_mart(
        f""", {_WHOLE} SELECT game_uuid || '_' || (t.ply + 1) AS id, t.game_uuid AS game_uuid, t.time_class AS time_class, t.base::INT AS time_control_base,
          t.added::INT AS time_control_add_seconds, t.player_color AS player_color, 'chess' AS rules, header AS pgn_header, t.ply + 1 AS game_move_index,
          string_agg(pair || CASE WHEN white_move THEN '. ' ELSE '... ' END || san, ' ') OVER (PARTITION BY t.k ORDER BY t.ply) AS pgn_cum_move,
          CASE WHEN white_move THEN 'White' ELSE 'Black' END AS color_move, pair AS color_move_index, san AS game_move,
          clock - t.added AS clock_interval_move, clock AS clock_interval_post_move, prev_clock AS prev_clock_interval, move_time AS move_time_seconds
        FROM timed t JOIN (SELECT k, header FROM whole) USING (k)"""
    )
)
def game_moves_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of the per-move table but those about the board, which are NULL without positions."""
    moves = prepare_moves(store.games(spark, sf_dir))
    board = ["captured_piece", "fen", "major_minor_cnt", "black_major_minor", "white_major_minor", "is_backrank_sparse", "is_midgame", "is_endgame", "game_phase"]
    return moves.drop(*board)

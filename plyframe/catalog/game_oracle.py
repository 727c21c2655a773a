"""SQL that answers the game queries without reading any game text.

It starts from the same columns the archive is derived from and computes moves, clocks, results
and totals from their rules, so it shares no parsing with the Spark jobs it checks.
"""

from __future__ import annotations

from plyframe.catalog.archive import BLACK_SETUPS, FINALS, PLAYER, TACTICS, WHITE_SETUPS
from plyframe.functions.text import ANALYSIS_SITE, OPENING_SITE


def _text(value: str | None) -> str:
    return "NULL" if value is None else f"'{value}'"


def _rows(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(str(v) for v in row) + ")" for row in rows)


SETUPS = _rows([("'w'", n, _text(s)) for n, s in enumerate(WHITE_SETUPS)]) + ", " + _rows(
    [("'b'", n, _text(s)) for n, s in enumerate(BLACK_SETUPS)]
)
FINAL_ROWS = _rows([(n, _text(f)) for n, f in enumerate(FINALS)])
TACTIC_ROWS = _rows([(n, *map(_text, t)) for n, t in enumerate(TACTICS)])

# One row per order that is a standard game.
GAME = f"""
setups(side, no, moves) AS (VALUES {SETUPS}),
tactics(no, moves, winner, mate_position, pieces) AS (VALUES {TACTIC_ROWS}),
finals(no, final_position) AS (VALUES {FINAL_ROWS}),
chosen AS (
  SELECT o_orderkey AS k, o_custkey AS cust, o_orderstatus AS status,
         left(o_orderpriority, 1) AS priority, o_orderkey % 2 = 0 AS player_white,
         CASE WHEN o_orderkey % 5 = 0 THEN (o_orderkey // 5) % {len(TACTICS)} END AS tactic,
         o_orderdate + to_seconds(o_orderkey % 86400) AS ended
  FROM orders WHERE o_custkey % 25 <> 0
),
game AS (
  SELECT c.*, 'g' || k AS game_uuid,
    coalesce('t' || tactic, (k % 6) || '-' || (cust % 6)) AS line,
    CASE priority WHEN '1' THEN 'bullet' WHEN '2' THEN 'blitz' WHEN '4' THEN 'daily' ELSE 'rapid' END AS time_class,
    CASE priority WHEN '1' THEN '60' WHEN '2' THEN '180+2' WHEN '3' THEN '1500+25' WHEN '4' THEN '1/259200' ELSE '600' END AS time_control,
    CASE priority WHEN '1' THEN 60 WHEN '2' THEN 180 WHEN '3' THEN 1500 WHEN '4' THEN 259200 ELSE 600 END AS base,
    CASE priority WHEN '2' THEN 2 WHEN '3' THEN 25 ELSE 0 END AS added,
    coalesce(t.winner, CASE status WHEN 'F' THEN 'White' WHEN 'O' THEN 'Black' END) AS winner,
    t.winner IS NOT NULL AS mate, t.pieces, coalesce(t.mate_position, e.final_position) AS position,
    CASE WHEN player_white THEN 'White' ELSE 'Black' END AS player_color,
    1000 + (cust * 13) % 1500 AS white_rating, 1000 + (k * 7) % 1500 AS black_rating,
    'guest' || cust AS guest, 'A' || lpad((cust % 100)::VARCHAR, 2, '0') AS eco,
    ended - to_seconds(CASE WHEN priority = '4' THEN (k % 50) * 86400 + k % 1000 ELSE 600 + k % 3000 END) AS started
  FROM chosen c LEFT JOIN tactics t ON t.no = c.tactic JOIN finals e ON e.no = c.k % {len(FINALS)}
),
facts AS (
  SELECT g.*,
    CASE WHEN winner IS NULL THEN 'draw' WHEN winner = player_color THEN 'win' ELSE 'lose' END AS player_wdl,
    CASE WHEN winner IS NULL THEN 'agreed' WHEN mate THEN 'checkmated' WHEN winner = 'White' THEN 'resigned' ELSE 'timeout' END AS player_wdl_reason,
    CASE WHEN player_white THEN white_rating ELSE black_rating END AS player_rating,
    CASE WHEN player_white THEN black_rating ELSE white_rating END AS opponent_rating
  FROM game g
)"""

# Moves of every line, and of every game.
PLY = """
line AS (
  SELECT 't' || no AS line, moves FROM tactics
  UNION ALL
  SELECT w.no || '-' || b.no, array_to_string(flatten(list_transform(
      list_zip(string_split(w.moves, ' '), string_split(b.moves, ' ')), lambda p: [p[1], p[2]])), ' ')
  FROM setups w JOIN setups b ON w.side = 'w' AND b.side = 'b'
),
line_move AS (
  SELECT line, unnest(range(len(string_split(moves, ' ')))) AS ply, unnest(string_split(moves, ' ')) AS move FROM line
),
step AS (
  SELECT line, ply, split_part(move, ':', 1) AS san FROM line_move
),
item AS (
  SELECT l_orderkey AS k, 2 * (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) - 1) AS n,
    l_linenumber AS no, l_partkey AS p, l_suppkey AS s, l_quantity::BIGINT AS q FROM lineitem
),
item_pair AS (
  SELECT k, 20 + n AS ply, p AS a, s AS b FROM item UNION ALL SELECT k, 21 + n, s + no, p + q FROM item
),
game_ply AS (
  SELECT f.k AS of_game, s.ply, s.san FROM facts f JOIN step s ON s.line = f.line
  UNION ALL
  SELECT f.k, i.ply, (['', 'N', 'B', 'R', 'Q'])[a % 5 + 1] || substr('abcdefgh', (b % 8 + 1)::INT, 1) || (a % 8 + 1)
  FROM facts f JOIN item_pair i ON i.k = f.k WHERE f.tactic IS NULL
),
played AS (
  SELECT g.*, s.ply, s.san, (s.ply // 2) + 1 AS pair, s.ply % 2 = 0 AS white_move,
    CASE WHEN g.time_class <> 'daily' THEN (base * 10 - ((s.ply // 2) + 1) * (k % 7 + 1) * 3) / 10.0::DOUBLE END AS clock,
    CASE WHEN g.time_class = 'daily' THEN 0.0 WHEN s.ply < 2 THEN base ELSE (base * 10 - (s.ply // 2) * (k % 7 + 1) * 3) / 10.0::DOUBLE END::DOUBLE AS prev_clock
  FROM facts g JOIN game_ply s ON s.of_game = g.k
),
timed AS (
  SELECT p.*, CASE WHEN time_class = 'daily' THEN 0.0::DOUBLE ELSE round(prev_clock - (clock - added), 1) END AS move_time FROM played p
)"""

# One row per game with the totals of its moves.
MART = """
counted AS (
  SELECT k, len(regexp_replace(board, '[^rnbqRNBQ]', '', 'g')) AS men,
    len(regexp_replace(split_part(board, '/', 1), '[^rnbq]', '', 'g')) AS black_men,
    len(regexp_replace(split_part(board, '/', 8), '[^RNBQ]', '', 'g')) AS white_men
  FROM (SELECT k, split_part(position, ' ', 1) AS board FROM facts)
),
phased AS (
  SELECT k, CASE WHEN men <= 6 THEN 'Endgame' WHEN men <= 10 OR least(black_men, white_men) < 4 THEN 'Midgame' ELSE 'Opening' END AS phase
  FROM counted
),
totals AS (
  SELECT k,
    round(sum(move_time) FILTER (white_move), 1) AS white_time, count(*) FILTER (white_move) AS white_moves,
    round(sum(move_time) FILTER (NOT white_move), 1) AS black_time, count(*) FILTER (NOT white_move) AS black_moves,
    string_agg(CASE WHEN white_move THEN pair || '. ' || san WHEN time_class <> 'daily' THEN pair || '... ' || san END, ' ' ORDER BY ply) AS numbered,
    array_to_string((list(CASE WHEN white_move THEN pair || '. ' || san ELSE pair || '... ' || san END ORDER BY ply)
      FILTER (white_move OR time_class <> 'daily'))[1:3], ' ') AS first_three
  FROM timed GROUP BY k
),
mart AS (
  SELECT f.*, t.white_time, t.white_moves, t.black_time, t.black_moves, t.numbered, t.first_three, p.phase AS ended_phase,
    CASE WHEN player_white THEN t.white_time ELSE t.black_time END AS player_time,
    CASE WHEN player_white THEN t.white_moves ELSE t.black_moves END AS player_moves,
    CASE WHEN player_white THEN t.black_time ELSE t.white_time END AS opponent_time,
    CASE WHEN player_white THEN t.black_moves ELSE t.white_moves END AS opponent_moves
  FROM facts f JOIN totals t USING (k) JOIN phased p USING (k)
)"""

URL = (
    f"'{ANALYSIS_SITE}' || replace(replace(numbered, ' ', '%20'), '#', '') || '?color=' || lower(player_color)"
)
OPENING = f"'{OPENING_SITE}'"
PLAYER_NAME = f"'{PLAYER.title()}'"


def on_games(body: str) -> str:
    return f"WITH {GAME} {body}"


def on_moves(body: str) -> str:
    return f"WITH {GAME}, {PLY} {body}"


def on_mart(body: str) -> str:
    return f"WITH {GAME}, {PLY}, {MART} {body}"

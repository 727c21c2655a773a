"""Functions by name, for SQL: scalar ones and a table function, with the NULL rules of the expressions they stand for.

They are SQL functions, so calls are inlined into the plan of the query and stay in the JVM; no Python runs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from plyframe.functions.positions import PIECES
from plyframe.functions.text import NUMBERED_MOVE
from plyframe.functions.timing import DAY, MONTH, YEAR

_TWO = "late TIMESTAMP_NTZ, early TIMESTAMP_NTZ"


def _captured() -> str:
    """First letter of ``former`` that became rarer by more than the whole became shorter."""
    lost = "length(replace(former, '{0}', '')) - length(replace(later, '{0}', '')) < length(former) - length(later)"
    places = ", ".join(f"CASE WHEN {lost.format(x)} THEN instr(former, '{x}') END" for x in PIECES)
    return f"CASE WHEN former <> '' THEN substring(former, least({places}), 1) END"


_PLAIN = f"datediff(finish, start) * {DAY}D + time_of_day(finish) - time_of_day(start)"
# name, parameters, result, body; later ones may call earlier ones.
SCALARS = [
    ("clock_part", "clock STRING, place INT", "DOUBLE", "CAST(split_part(nullif(clock, ''), ':', place) AS DOUBLE)"),
    ("clock_text", "note STRING", "STRING", r"regexp_extract(note, r'\d+:\d+:\d+(\.\d+)?', 0)"),
    ("clock_seconds", "note STRING", "DOUBLE", "clock_part(clock_text(note), 1) * 3600 + clock_part(clock_text(note), 2) * 60 + clock_part(clock_text(note), 3)"),
    ("captured_letter", "former STRING, later STRING", "STRING", _captured()),
    ("opening", "moves ARRAY<STRING>, many INT", "STRING", "CASE WHEN size(moves) > 0 THEN array_join(slice(moves, 1, many), ' ') END"),
    ("time_of_day", "ts TIMESTAMP_NTZ", "DOUBLE", "hour(ts) * 3600 + minute(ts) * 60 + CAST(extract(SECOND FROM ts) AS DOUBLE)"),
    ("borrowed_day", _TWO, "INT", "CAST(time_of_day(late) < time_of_day(early) AS INT)"),
    ("borrowed_month", _TWO, "INT", "CAST(day(late) - day(early) - borrowed_day(late, early) < 0 AS INT)"),
    ("whole_months", _TWO, "INT", "(year(late) - year(early)) * 12 + month(late) - month(early) - borrowed_month(late, early)"),
    ("odd_days", _TWO, "INT", "day(late) - day(early) - borrowed_day(late, early) + borrowed_month(late, early) * day(last_day(early))"),
    ("odd_seconds", _TWO, "DOUBLE", f"time_of_day(late) - time_of_day(early) + borrowed_day(late, early) * {DAY}"),
    (
        "age_in_order", _TWO, "DOUBLE",
        f"floor(whole_months(late, early) / 12) * {YEAR} + whole_months(late, early) % 12 * {MONTH} + odd_days(late, early) * {DAY} + odd_seconds(late, early)",
    ),
    (
        "calendar_age_seconds", "finish TIMESTAMP_NTZ, start TIMESTAMP_NTZ", "DOUBLE",
        f"CASE WHEN abs({_PLAIN}) < {28 * DAY} THEN {_PLAIN} ELSE sign({_PLAIN}) * age_in_order(greatest(finish, start), least(finish, start)) END",
    ),
]
TABLES = [
    (
        "move_rows", "moves STRING", "move_index BIGINT, game_move STRING",
        f"SELECT pos + 1, split_part(col, ' ', 2) FROM posexplode(regexp_extract_all(moves, r'{NUMBERED_MOVE}', 0))",
    ),
]


def register(spark: SparkSession, temporary: bool = True) -> None:
    """Create or replace all functions: for this session, or in the catalog's current schema.

    A lasting function may not call a temporary one, so this session's own make way for lasting ones.
    """
    kind = "TEMPORARY FUNCTION" if temporary else "FUNCTION"
    for name, *_ in [] if temporary else SCALARS + TABLES:
        spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {name}")
    for name, takes, gives, body in SCALARS:
        spark.sql(f"CREATE OR REPLACE {kind} {name}({takes}) RETURNS {gives} RETURN {body}")
    for name, takes, gives, body in TABLES:
        spark.sql(f"CREATE OR REPLACE {kind} {name}({takes}) RETURNS TABLE ({gives}) RETURN {body}")

"""Expressions: the traps where a naive translation gives another result."""

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from plyframe.functions import numbers as nb
from plyframe.functions import positions as ps
from plyframe.functions import text as tx
from plyframe.functions import timing as tm


def value(spark, column, **inputs):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in inputs.items()], F.lit(1).alias("one"))
    return row.select(column.alias("v")).first().v


def test_part_is_one_based_and_null_out_of_range(spark):
    assert value(spark, tx.part(F.lit("180+2"), r"\+", 2)) == "2"
    assert value(spark, tx.part(F.lit("180"), r"\+", 2)) is None
    assert value(spark, tx.part(F.lit("a/b/c"), "/", -1)) == "c"


def test_time_controls(spark):
    rows = spark.createDataFrame(
        # Formats of time controls.
        [("daily", "1/259200"), ("daily", "1/216000"), ("blitz", "180+2"), ("rapid", "600")], "k string, c string"
    )
    k, c = F.col("k"), F.col("c")
    base = tx.time_control_base(k, c)
    got = [tuple(r) for r in rows.select(base, tx.time_control_increment(k, c), tx.game_mode(k, c, base)).collect()]
    assert got == [
        (259200, 0, "daily 3 days"),
        (216000, 0, "daily 2 days"),  # two and a half days, half to even
        (180, 2, "blitz 180+2"),
        (600, 0, "rapid 600"),
    ]


def test_rounding_matches_duckdb(spark):
    values = [0.5, 1.5, 2.5, -2.5, 15.549999999999999, 16.65 - 1.1, 29.5, 0.25, 0.35, 113.0, -0.05]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    got = [tuple(r) for r in rows.select(nb.whole_number(F.col("v")), nb.round_to(F.col("v"), 1)).collect()]
    want = [duckdb.execute("SELECT ?::DOUBLE::INT, round(?::DOUBLE, 1)", [v, v]).fetchone() for v in values]
    assert got == want


def test_binned(spark):
    assert value(spark, nb.binned(F.lit(1299), 100)) == 1200.0
    assert value(spark, nb.binned(F.lit(-1), 100)) == -100.0


def test_moves_and_clocks_by_pattern(spark):
    # Fixed value: the golden game's beginning.
    moves = F.lit("1. e4 {[%clk 0:24:55.5]} 1... g6 {[%clk 0:24:03.5]} 2. Nf3 1-0")
    assert value(spark, tx.all_matches(moves, tx.NUMBERED_MOVE)) == ["1. e4", "1... g6", "2. Nf3"]
    assert value(spark, tx.all_matches(moves, tx.CLOCK_NOTE)) == ["{[%clk 0:24:55.5]}", "{[%clk 0:24:03.5]}"]


def test_header_stops_at_line_end_and_is_empty_if_missing(spark):
    text = F.lit('[ECO "B06"]\n[ECOUrl "https://www.chess.com/openings/Modern"]\n\n1. e4')
    assert value(spark, tx.header(text, "ECO")) == "B06"
    assert value(spark, tx.header(text, "ECOUrl")).endswith("/Modern")
    assert value(spark, tx.header(text, "UTCDate")) == ""
    assert value(spark, tx.move_block(text)) == "1. e4"


def test_analysis_url(spark):
    url = value(spark, tx.analysis_url(F.lit("1. e4 1... e5 2. Qh5#"), F.lit("White")))
    assert url == "https://lichess.org/analysis/pgn/1.%20e4%201...%20e5%202.%20Qh5?color=white"


def test_prefix_text(spark):
    items = F.array(F.lit("1. e4"), F.lit("1... e5"))
    assert value(spark, tx.prefix_text(items, 1)) == "1. e4"
    assert value(spark, tx.prefix_text(items, 7)) == "1. e4 1... e5"
    assert value(spark, tx.prefix_text(F.array().cast("array<string>"), 2)) is None
    assert value(spark, tx.list_text(F.array().cast("array<string>"))) == ""


@pytest.mark.parametrize(
    "text, seconds",
    [("{[%clk 0:24:55.5]}", 1495.5), ("30:00:01", 108001.0), ("0:24:57", 1497.0), ("0:24]", None), (None, None)],
)
def test_clock_seconds(spark, text, seconds):
    assert value(spark, tm.clock_seconds(F.lit(text).cast("string"))) == seconds


AGES = [
    ("2024-03-01 00:00:00", "2024-02-01 00:00:00"),
    ("2024-03-01 01:00:00", "2024-01-31 00:00:00"),
    ("2024-03-01 00:00:00", "2024-01-31 12:00:00"),
    ("2025-02-28 23:00:00.5", "2023-11-30 23:30:00"),
    ("2023-03-01 00:00:00", "2023-02-28 00:00:01"),
    ("2024-01-01 00:00:00", "2024-01-01 00:00:00"),
    ("2020-02-29 00:00:00", "2021-03-01 06:00:00"),
]


@pytest.mark.parametrize("end, start", AGES + [(b, a) for a, b in AGES])
def test_calendar_age_matches_duckdb(spark, end, start):
    ts = lambda t: F.lit(t).cast("timestamp_ntz")
    want = duckdb.execute("SELECT epoch(age(?::TIMESTAMP, ?::TIMESTAMP))", [end, start]).fetchone()[0]
    assert value(spark, tm.calendar_age(ts(end), ts(start)).total_seconds()) == want


def test_known_ages(spark):
    ts = lambda t: F.lit(t).cast("timestamp_ntz")
    month = tm.calendar_age(ts("2024-03-01 00:00:00"), ts("2024-02-01 00:00:00"))
    assert value(spark, month.total_seconds()) == 2592000.0
    borrowed = tm.calendar_age(ts("2024-03-01 01:00:00"), ts("2024-01-31 00:00:00"))
    assert value(spark, borrowed.total_seconds()) == 2682000.0
    assert [value(spark, c) for c in (borrowed.months, borrowed.days, borrowed.seconds)] == [1, 1, 3600.0]


def test_dates_are_strict_by_default(spark):
    assert value(spark, tm.dotted_date(F.lit("2014.12.14"))) == dt.date(2014, 12, 14)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        value(spark, tm.dotted_date(F.col("d")), d="")
    assert value(spark, tm.dotted_date(F.lit(""), strict=False)) is None
    at = tm.timestamp_from(F.lit(dt.date(2014, 12, 14)), F.lit("18:13:04"))
    assert value(spark, at) == dt.datetime(2014, 12, 14, 18, 13, 4)


def test_zone_follows_daylight_saving(spark):
    hour = lambda t: value(spark, F.hour(tm.in_zone(F.lit(t).cast("timestamp_ntz"), "America/New_York")))
    assert hour("2024-01-15 12:00:00") == 7
    assert hour("2024-07-15 12:00:00") == 8


def test_sunday_is_zero(spark):
    sunday = F.lit("2024-01-07").cast("date")
    assert value(spark, tm.weekday_number(sunday)) == 0
    assert value(spark, tm.weekday_name(tm.weekday_number(sunday))) == "Sunday"
    assert value(spark, tm.weekday_name(F.lit(None).cast("int"))) == "Unknown"


@pytest.mark.parametrize(
    "seconds", [0, 59.9, 3600, 86399, 86400, 2 * 86400 + 3661.25, 40 * 86400 + 5]
)
def test_duration_text(spark, seconds):
    whole = dt.timedelta(seconds=seconds)
    want = str(dt.timedelta(days=whole.days, seconds=whole.seconds))
    assert value(spark, tm.duration_text(F.lit(float(seconds)))) == want


@pytest.mark.parametrize(
    "before, after, lost",
    [
        ("", "rnbqkbnr/8", None),  # start of the game
        ("rnbqkbnr/pppp", "rnbqkbnr/pppp", None),
        ("8/3p4/4P3/8", "8/3P4/8/8", "p"),
        ("8/P6k/8/K7", "Q7/7k/8/K7", "P"),  # a quiet promotion looks like a lost pawn
        ("1r5k/P7/8/K7", "1Q5k/8/8/K7", "r"),  # capturing promotion: first one in the board text
        ("7k/P7/8/1r6", "7k/8/8/1Q6", "P"),
        ("k6K/8", "7K/8", None),  # kings are not counted
    ],
)
def test_lost_letter(spark, before, after, lost):
    assert value(spark, ps.lost_letter(F.lit(before), F.lit(after))) == lost


def test_phase_counts_own_back_rank_only(spark):
    start = "rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR w KQkq - 0 1"
    counts = {k: value(spark, c) for k, c in ps.piece_counts(F.lit(start)).items()}
    assert counts == {"major_minor_cnt": 14, "black_major_minor": 7, "white_major_minor": 7}
    moved = "4k3/rnbqrnbq/8/8/8/8/RNBQRNBQ/4K3 w - - 0 1"
    assert value(spark, ps.piece_counts(F.lit(moved))["white_major_minor"]) == 0


@pytest.mark.parametrize(
    "total, black, white, phase",
    [(14, 7, 7, "Opening"), (14, 3, 7, "Midgame"), (10, 4, 4, "Midgame"), (6, 4, 4, "Endgame"), (11, 4, 4, "Opening")],
)
def test_phase_ladder(spark, total, black, white, phase):
    ladder = ps.phase_ladder(F.lit(total), F.lit(black), F.lit(white))
    assert value(spark, ladder["game_phase"]) == phase


def test_squares_spell_out_the_board(spark):
    board = value(spark, ps.squares(F.lit("r6k/pq3pQp/1p6/3bPN2/8/8/1PP3PP/3RR1K1 b - - 0 27")))
    assert len(board) == 64 and board[0] == "r" and board[63] == "." and board[62] == "K"
    assert value(spark, ps.square_name(F.lit(0))) == "a1"
    assert value(spark, ps.square_name(F.lit(63))) == "h8"

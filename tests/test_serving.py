"""Checks taken while writing, the cube, the tree of openings and global ranks, each against the direct way."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from plyframe.operators import ranking
from plyframe.plans import analyses as an
from plyframe.plans import checks, cube, openings
from plyframe.plans.game_moves import prepare_moves
from plyframe.plans.refresh import refresh
from plyframe.sources import versions
from test_tables import archive, games, records  # noqa: F401

GAME = (
    "game_uuid string, rules string, time_class string, player_color string, game_start_date date, game_start_timestamp timestamp_ntz, player_wdl string, "
    "player_wdl_reason string, ended_game_phase string, player_rating int, player_num_moves long, player_total_move_time double, pgn_move_extract array<string>, game_analysis_url string"
)


@pytest.fixture(scope="module")
def mart(spark):
    r = random.Random(8)
    rows = []
    for i in range(600):
        at = dt.datetime(2024, 3, 1) + dt.timedelta(minutes=r.randrange(0, 60 * 24 * 40), seconds=r.choice([0, 0, 59]), microseconds=r.choice([0, 999_999]))
        moves = [f"{k // 2 + 1}{'.' if k % 2 == 0 else '...'} {r.choice(['e4', 'e4+', 'd4'])}" for k in range(r.choice([0, 1, 2, 5, 12]))]
        wdl = r.choice(["win", "draw", "lose"])
        rows.append((f"g{i:04d}", r.choice(["chess", "chess960"]), r.choice(["rapid", "daily"]), r.choice(["White", "Black"]), at.date(), at, wdl, r.choice(["agreed", "checkmated", None]),
                     r.choice(["Opening", "Endgame", None]), r.choice([None, 1000 + i]), r.choice([None, r.randrange(90)]), r.choice([None, r.randrange(9000) / 10]), moves, f"u{i}"))
    rows[0] = ("g0000", "chess", "rapid", "White", None, None, "win", None, None, 1, 1, 0.1, None, "u0")
    return spark.createDataFrame(rows, GAME).cache()


def same(x, y):
    order = sorted(y.columns)
    plain = lambda df: sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*order).collect()), key=repr)
    assert sorted(x.columns) == order and plain(x) == plain(y)


def formatted(df):
    """The plan with its whole filters."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kathmandu"])
@pytest.mark.parametrize("colors", [["White"], ["White", "Black"]])
def test_cube_equals_the_mart(spark, mart, tmp_path, zone, colors):
    cube.write_cube(mart, str(tmp_path / "cube"))
    whole = spark.read.parquet(str(tmp_path / "cube"))
    same(cube.date_bounds(whole, "rapid", colors), an.date_bounds(mart, "rapid", colors))
    for name, options in cube.filter_options(whole).items():
        same(options, an.filter_options(mart)[name])
    for first, last in ((dt.date(2024, 3, 5), dt.date(2024, 3, 25)), (dt.date(1999, 1, 1), dt.date(1999, 1, 2))):
        cells = cube.select_cells(whole, "chess", "rapid", colors, first, last)
        rows = an.select_games(mart, "chess", "rapid", colors, first, last)
        same(cube.key_figures(cells, "rapid"), an.key_figures(rows, "rapid"))
        same(cube.key_figures(cells, "daily"), an.key_figures(rows, "daily"))
        for f in ("daily_rating", "outcome_share", "outcome_reason_share", "outcome_reason_stack", "end_phases", "outcomes_by_end_phase"):
            same(getattr(cube, f)(cells), getattr(an, f)(rows))
        for f in ("games_by_weekday", "games_by_hour", "outcomes_by_weekday", "outcomes_by_hour", "win_rate_by_weekday_hour"):
            same(getattr(cube, f)(cells, zone), getattr(an, f)(rows, zone))
    plan = formatted(cube.select_cells(whole, "chess", "rapid", colors, first, last))
    assert "PartitionFilters: [isnotnull(time_class" in plan and "GreaterThanOrEqual(game_start_date" in plan


def test_tree_equals_each_length(spark, mart, tmp_path):
    tree = openings.build_tree(mart).cache()
    every = openings.top_openings(tree, list(range(1, 8)), places=3)
    for n in range(1, 8):
        same(every.where(F.col("moves") == n).drop("moves"), an.top_openings(mart, n, places=3))
    assert tree.join(tree.select(F.col("node").alias("parent")), "parent", "left_semi").count() == tree.where("depth > 1").count()
    below = openings.continuations(tree, "White", "1. e4").select("starting_moves").collect()
    assert {r.starting_moves for r in below} == {f"1. e4 1... {m}" for m in ("e4", "e4+", "d4")}
    openings.write_drill(mart, str(tmp_path / "drill"))
    drill = spark.read.parquet(str(tmp_path / "drill"))
    for opening, n in (("1. e4", 1), ("1. e4", 3), ("1. e4 1... d4", 2), ("1. e4+ 1... d4 2. e4", 3), ("1. e4 1... d4", 7)):
        same(openings.games_of(drill, opening, n, "White", "win"), an.games_of_opening(mart, opening, n, "White", "win"))
    assert "StringStartsWith(line" in formatted(openings.games_of(drill, "1. e4", 1, "White", "win"))
    assert openings.build_tree(mart.limit(0)).count() == 0


def test_ranks_across_borders(spark, tmp_path):
    r = random.Random(2)
    for values in ([r.choice([1, 2, 2, 2, 3, 9, None]) for _ in range(500)], [5] * 200, [None] * 30, [], [r.random() for _ in range(100)]):
        df = spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate(values)], "id long, v double")
        got = ranking.global_ranks(df.repartition(5), "v", [F.asc("id")], str(tmp_path / "ranks"))
        assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
        ordered = sorted(enumerate(values), key=lambda x: (x[1] is None, -(x[1] or 0), x[0]))
        want, standing, level, last = {}, 0, 0, object()
        for place, (i, v) in enumerate(ordered, 1):
            if v != last:
                standing, level, last = place, level + 1, v
            want[i] = (place, standing, level)
        assert {x.id: (x.place, x.standing, x.level) for x in got.collect()} == want


def test_checks_while_writing_find_what_the_exact_ones_find(spark, archive, tmp_path):  # noqa: F811
    own = games(spark, archive)
    bad = own.unionByName(own.where("game_uuid = 'g1'")).withColumns(
        {"pgn_moves": F.when(F.col("game_uuid") != "g2", F.col("pgn_moves")), "player_wdl": F.when(F.col("game_uuid") == "g1", "lost").otherwise(F.col("player_wdl")),
         "checkmate_pieces": F.array(F.lit("Qh5"))}
    )
    passing, watch = checks.watched("prep_player_games", bad.repartition("game_uuid"))
    passing.write.parquet(str(tmp_path / "bad"))
    table = spark.read.parquet(str(tmp_path / "bad"))
    assert table.columns == own.columns
    exact = {name: rows.collect() for name, rows in checks.offending("prep_player_games", table).items()}
    assert {name for name, n in watch.counts().items() if n} == {f"not_null:{r.column_name}" for r in exact.pop("not_null")} | {n for n, rows in exact.items() if rows}
    assert watch.counts()["accepted_outcomes"] == 2 and watch.counts()["unique"] == 1
    with pytest.raises(checks.quality.CheckFailed, match="prep_player_games: not_null"):
        watch.require_sound(table)


def test_one_scan_a_stage(spark, archive, tmp_path, monkeypatch):  # noqa: F811
    """A sound refresh runs no exact pass, and the checks add no exchange where rows are hashed by the key."""
    monkeypatch.setattr(checks, "offending", None)
    refresh(spark, archive, str(tmp_path / "out"), "magnus", 1.0, buckets=3)
    own = spark.table("prep_player_games")
    passing, _ = checks.watched("prep_game_moves", prepare_moves(own))
    plan = passing._jdf.queryExecution().executedPlan().toString()
    assert "CollectMetrics" in plan and "Exchange" not in plan and plan.count("FileScan") == 1


def test_refresh_is_one_version(spark, archive, tmp_path, monkeypatch):  # noqa: F811
    out = str(tmp_path / "out")
    refresh(spark, archive, out, "magnus", 1.0, buckets=3)
    first = versions.version(spark, out)
    assert first.number == 1 and first.read(spark, "games").count() == 3

    def dying(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(versions, "_move", dying)
    with pytest.raises(RuntimeError, match="lost"):
        refresh(spark, archive, out, "magnus", 2.0, buckets=3)
    monkeypatch.undo()
    assert versions.version(spark, out) == first
    refresh(spark, archive, out, "magnus", 3.0, buckets=3)
    now = versions.version(spark, out)
    assert now.number == 2 and {r._dlt_load_id for r in now.read(spark, "chess_data_raw.player_games").collect()} == {3.0}
    assert versions.expire(spark, out, keep=1) == [1] and spark.table("games").count() == 3


def test_samples_of_every_group(spark, mart):
    own = mart.where(F.size("pgn_move_extract") > 0).withColumn("opening", an.starting_moves(1))
    got = ranking.samples_per_group(own, ["player_color", "opening"], 5, "game_uuid", seed=3)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Partial" in plan  # each task sends the smallest of its own
    for group in own.select("player_color", "opening").distinct().collect():
        mine = (F.col("player_color") == group.player_color) & (F.col("opening") == group.opening)
        one = ranking.sample_rows(own.where(mine), 5, "game_uuid", seed=3)
        assert {r.game_uuid for r in got.where(mine).collect()} == {r.game_uuid for r in one.collect()}


def test_functions_by_name(spark):
    """Called from SQL only, they equal the expressions, NULLs included."""
    from plyframe.functions import named, positions, timing

    named.register(spark)
    rows = [(a, b) for a in ("rnbq/P", "", None, "kK", "PPp") for b in ("rnb/P", "", None, "Kk", "Pp")]
    df = spark.createDataFrame(rows, "a string, b string")
    got = spark.sql("SELECT a, b, captured_letter(a, b) AS x FROM {df}", df=df)
    same(got, df.select("a", "b", positions.lost_letter(F.col("a"), F.col("b")).alias("x")))
    notes = spark.createDataFrame([("{[%clk 0:24:55.5]}",), ("{[%clk 100:00:01]}",), ("none",), (None,)], "n string")
    same(spark.sql("SELECT n, clock_seconds(n) AS x FROM {df}", df=notes), notes.select("n", timing.clock_seconds(F.col("n")).alias("x")))
    r = random.Random(6)
    times = [(dt.datetime(2020, 1, 1) + dt.timedelta(seconds=r.randrange(3 * 10**8)), dt.datetime(2020, 1, 31, 5) + dt.timedelta(seconds=r.choice([1, 40 * 86400]) * r.randrange(90))) for _ in range(80)] + [(None, dt.datetime(2020, 1, 1))]
    ages = spark.createDataFrame(times, "e timestamp_ntz, s timestamp_ntz")
    same(spark.sql("SELECT e, s, calendar_age_seconds(e, s) AS x FROM {df}", df=ages), ages.select("e", "s", timing.calendar_age(F.col("e"), F.col("s")).total_seconds().alias("x")))
    moves = spark.sql("SELECT i, m.* FROM VALUES (1, '1. e4 1... e5 {[%clk 1]} 2. d4 1-0'), (2, ''), (3, NULL) AS t(i, s), LATERAL move_rows(s) m ORDER BY i, move_index")
    assert [tuple(x) for x in moves.collect()] == [(1, 1, "e4"), (1, 2, "e5"), (1, 3, "d4")]
    assert spark.sql("SELECT opening(array('1. e4', '1... e5'), 1) AS x, opening(array(), 1) AS y").first() == ("1. e4", None)
    named.register(spark, temporary=False)
    assert spark.catalog.functionExists("captured_letter")

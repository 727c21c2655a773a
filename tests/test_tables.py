"""Landing folder, contract, and the tables built from it."""

import json

import pytest
from games import GOLDEN_MOVES, MATED, game_text
from pyspark.sql import functions as F

from plyframe.operators.quality import CheckFailed
from plyframe.plans import analyses as an
from plyframe.plans.checks import offending
from plyframe.plans.game_moves import COLUMNS as MOVE_COLUMNS
from plyframe.plans.game_moves import prepare_moves
from plyframe.plans.games import COLUMNS as MART_COLUMNS
from plyframe.plans.games import build_games
from plyframe.plans.player_games import prepare_games
from plyframe.plans.refresh import refresh
from plyframe.plans.staging import COLUMNS as STAGED
from plyframe.plans.staging import stage_games
from plyframe.sources import contract, landing, tables

# Final position and headers of the golden game.
FINAL = "8/pp5p/1k1pN1pB/1Q1P4/3q2n1/2N5/PPP2PPP/6K1 b - - 2 28"


def side(name, result, rating=1500):
    return {"rating": rating, "result": result, "@id": f"player/{name}", "username": name, "uuid": f"u-{name}"}


def record(uuid, pgn, white, black, **changes):
    return {
        "url": f"game/{uuid}", "rules": "chess", "pgn": pgn, "time_control": "1500+25", "end_time": 1418582233,
        "rated": True, "accuracies": {"white": 91.5}, "tcn": "mC", "uuid": uuid, "initial_setup": "", "fen": FINAL,
        "time_class": "rapid", "white": white, "black": black, **changes,
    }


HEADERS = [
    ("ECO", "B06"),
    ("ECOUrl", "https://www.chess.com/openings/Modern-Defense"),
    ("UTCDate", "2014.12.14"),
    ("StartTime", "18:11:36"),
]
GOLDEN_TEXT = game_text([m[0] for m in GOLDEN_MOVES], [m[1] for m in GOLDEN_MOVES], HEADERS)


@pytest.fixture
def records():
    mated = game_text(MATED.split(), headers=HEADERS)
    return [
        record("g1", GOLDEN_TEXT, side("Magnus", "win", 2862), side("rain", "checkmated", 1200)),
        record("g2", mated, side("rain", "resigned"), side("magnus", "win"), time_class="daily",
               time_control="1/259200", accuracies=None, end_time=1418600000),
        record("g3", mated, side("x", "agreed"), side("magnus", "agreed"), time_control="600", fen="8/8/8/8/8/8/8/8 w - - 0 1"),
        record("g4", None, side("magnus", "win"), side("x", "lose"), rules="bughouse"),
    ]


def land(root, user, documents):
    for (year, month), text in documents.items():
        folder = root / f"username={user}" / f"year={year}" / f"month={month}"
        folder.mkdir(parents=True)
        (folder / "archive.json").write_text(text)


@pytest.fixture
def archive(tmp_path, records):
    root = tmp_path / "landing"
    land(
        root,
        "magnus",
        {
            (2014, 11): json.dumps({"games": records[:2]}),
            (2014, 12): json.dumps({"games": records[2:]}),
            (2015, 1): json.dumps({}),
        },
    )
    return str(root)


def test_read_games(spark, archive):
    games = landing.read_games(spark, archive, "magnus")
    assert sorted(r.uuid for r in games.collect()) == ["g1", "g2", "g3", "g4"]
    assert landing.read_games(spark, archive, "nobody").count() == 0
    months = landing.list_archives(spark, archive, "magnus")
    assert [m.rsplit("/", 2)[-2:] for m in months] == [
        ["year=2014", "month=11"], ["year=2014", "month=12"], ["year=2015", "month=1"],
    ]
    missing = [months[0], months[0].replace("month=11", "month=7")]
    assert landing.read_games(spark, archive, "magnus", missing).count() == 2


def test_unreadable_archive_fails(spark, tmp_path):
    land(tmp_path, "magnus", {(2014, 11): '{"games": [{"url": '})
    with pytest.raises(Exception, match="unreadable archive"):
        landing.read_games(spark, str(tmp_path), "magnus").collect()


def checked(spark, archive):
    games = landing.read_games(spark, archive, "magnus")
    return contract.with_problems(games, contract.RECORD, contract.text_rule())


def test_contract(spark, tmp_path, records):
    del records[0]["fen"], records[0]["black"]["username"]
    records[1]["pgn"] = None
    land(tmp_path, "magnus", {(2014, 11): json.dumps({"games": records})})
    good, bad = contract.split_valid(checked(spark, str(tmp_path)))
    assert sorted(r.uuid for r in good.collect()) == ["g3", "g4"]
    assert {r.uuid: r.problems for r in bad.collect()} == {
        "g1": "fen is required; black.username is required",
        "g2": "pgn is required for non-bughouse games",
    }
    with pytest.raises(Exception, match="record breaks the contract"):
        contract.require_valid(checked(spark, str(tmp_path))).collect()


def raw(spark, archive):
    return contract.with_lineage(contract.flatten(contract.require_valid(checked(spark, archive))), 7)


def test_flatten_and_lineage(spark, archive):
    flat = raw(spark, archive)
    for name in ("white__aid", "black__rating", "accuracies__white", "_dlt_load_id", "_dlt_id"):
        assert name in flat.columns
    ids = [r._dlt_id for r in flat.orderBy("uuid").collect()]
    assert len(set(ids)) == 4
    assert ids == [r._dlt_id for r in flat.orderBy("uuid").collect()]


def test_staging(spark, archive):
    staged = stage_games(raw(spark, archive))
    assert staged.columns == [c[0] for c in STAGED] and len(staged.columns) == 25
    assert staged.count() == 3
    first = staged.filter("game_uuid = 'g1'").first()
    assert str(first.end_time) == "2014-12-14 18:37:13"
    assert first.accuracies__white == 91.5 and first.accuracies__black is None


def games(spark, archive):
    return prepare_games(stage_games(raw(spark, archive)), "magnus")


def test_player_games(spark, archive):
    rows = {r.game_uuid: r for r in games(spark, archive).collect()}
    g1, g2, g3 = rows["g1"], rows["g2"], rows["g3"]
    assert (g1.player_color, g1.player_wdl, g1.player_wdl_reason) == ("White", "win", "checkmated")
    assert (g1.player_rating, g1.opponent_rating, g1.is_stronger_opponent) == (2862, 1200, False)
    assert (g1.time_control_base, g1.time_control_add_seconds, g1.game_mode) == (1500, 25, "rapid 1500+25")
    assert (g1.eco, g1.eco_name) == ("B06", "Modern-Defense")
    assert len(g1.pgn_move_extract) == len(g1.pgn_clock_extract) == 55
    assert g1.checkmate_pieces == ["knight", "knight", "pawn", "queen"]
    assert g1.time_played_seconds == 25 * 60 + 37
    assert (g2.player_color, g2.player_wdl, g2.player_wdl_reason) == ("Black", "win", "resigned")
    assert (g2.game_mode, g2.time_control_base, g2.time_control_add_seconds) == ("daily 3 days", 259200, 0)
    assert g2.checkmate_pieces == []
    assert g3.player_wdl == "draw"
    # the name is compared as given: in capitals nobody matches, and everybody is Black
    loud = prepare_games(stage_games(raw(spark, archive)), "MAGNUS")
    assert {r.player_color for r in loud.collect()} == {"Black"}


def test_golden_moves(spark, archive):
    moves = prepare_moves(games(spark, archive).filter("game_uuid = 'g1'"))
    assert moves.columns == MOVE_COLUMNS and len(MOVE_COLUMNS) == 26
    rows = moves.orderBy("game_move_index").collect()
    assert len(rows) == 55
    previous = {"White": 1500.0, "Black": 1500.0}
    for i, (row, (san, clock, spent)) in enumerate(zip(rows, GOLDEN_MOVES)):
        h, m, s = clock.split(":")
        after = int(h) * 3600 + int(m) * 60 + float(s)
        color = "White" if i % 2 == 0 else "Black"
        assert (row.game_move_index, row.color_move, row.color_move_index) == (i + 1, color, i // 2 + 1)
        assert (row.game_move, row.id) == (san, f"g1_{i + 1}")
        assert row.prev_clock_interval == pytest.approx(previous[color])
        assert row.clock_interval_post_move == pytest.approx(after)
        assert row.clock_interval_move == pytest.approx(after - 25)
        assert row.move_time_seconds == float(spent)
        previous[color] = after
    assert rows[3].pgn_cum_move == "1. e4 1... g6 2. Nf3 2... d6"
    assert {r.fen for r in rows} == {r.captured_piece for r in rows} == {r.game_phase for r in rows} == {None}
    assert "EvalPython" not in moves._jdf.queryExecution().executedPlan().toString()


def test_positions_fill_the_board_columns(spark, archive):
    boards = [("g1", 1, "q6k/8/8/8/8/8/8/RQ5K b - - 0 1"), ("g1", 2, "7k/8/8/8/8/8/8/RQ5K w - - 0 1")]
    positions = spark.createDataFrame(boards, "game_uuid string, game_move_index long, fen string")
    rows = prepare_moves(games(spark, archive).filter("game_uuid = 'g1'"), positions=positions).orderBy("game_move_index").take(3)
    assert [r.captured_piece for r in rows] == [None, "q", None]
    assert [(r.major_minor_cnt, r.game_phase) for r in rows] == [(3, "Endgame"), (2, "Endgame"), (None, None)]


def test_daily_games_keep_raw_clocks(spark, archive, records):
    clocked = games(spark, archive).filter("game_uuid = 'g1'").withColumn("time_class", F.lit("daily"))
    row = prepare_moves(clocked).orderBy("game_move_index").first()
    assert (row.prev_clock_interval, row.move_time_seconds) == (0.0, 0.0)
    assert (row.clock_interval_move, row.clock_interval_post_move) == (1470.5, 1495.5)


def test_more_clocks_than_moves(spark, archive):
    extra = games(spark, archive).filter("game_uuid = 'g1'").withColumn(
        "pgn_clock_extract", F.concat("pgn_clock_extract", F.array(F.lit("{[%clk 0:00:01]}")))
    )
    moves = prepare_moves(extra)
    assert moves.count() == 56
    padding = moves.filter("game_move_index is null").collect()
    assert len(padding) == 1 and padding[0].game_move is None and padding[0].fen is None
    assert padding[0].clock_interval_post_move == 1.0


def test_mart_and_analyses(spark, archive):
    prepared = games(spark, archive).cache()
    moves = prepare_moves(prepared).cache()
    mart = build_games(prepared, moves).cache()
    assert mart.columns == MART_COLUMNS
    rows = {r.game_uuid: r for r in mart.collect()}
    assert (rows["g1"].white_num_moves, rows["g1"].black_num_moves) == (28, 27)
    assert rows["g1"].player_total_move_time == pytest.approx(
        sum(float(m[2]) for m in GOLDEN_MOVES[::2])
    )
    assert rows["g2"].player_total_move_time == 0.0 and rows["g2"].player_num_moves == 26
    assert rows["g1"].opponent_rating_bin == 1200.0
    assert an.key_figures(mart.filter("time_class = 'daily'"), "daily").first().total_move_time == "NA"
    assert an.key_figures(mart.limit(0), "rapid").first().win_perc is None
    without = build_games(prepared, moves.filter("game_uuid = 'g1'")).filter("game_uuid = 'g2'").first()
    assert without.white_num_moves is None and without.ended_game_phase == "Endgame"
    opening = an.top_openings(mart, 1).filter("player_color = 'White'").collect()
    assert [(r.starting_moves, r.num_games, r.perc) for r in opening] == [("1. e4", 1, 100.0)]
    latest = an.latest_games(mart, 1).first()
    assert latest.white__username in ("Magnus", "rain", "x")


def test_refresh(spark, archive, tmp_path):
    paths = refresh(spark, archive, str(tmp_path / "out"), "magnus", 1.0, buckets=3, checks=False)
    assert set(paths) == {"chess_data_raw.player_games", "prep_player_games", "prep_game_moves", "games"}
    mart = tables.read_files(spark, paths["games"])
    assert mart.count() == 3 and spark.table("prep_game_moves").count() == 55 + 53 + 53
    found = offending("prep_player_games", spark.table("prep_player_games"))
    assert {name: rows.count() for name, rows in found.items() if rows.count()} == {}
    plan = build_games(spark.table("prep_player_games"), spark.table("prep_game_moves"))
    assert "Exchange hashpartitioning" not in plan._jdf.queryExecution().executedPlan().toString()
    # a second run replaces everything
    refresh(spark, archive, str(tmp_path / "out"), "magnus", 2.0, buckets=3)
    assert spark.table("games").count() == 3


def test_failing_refresh_leaves_the_old_tables(spark, archive, records, tmp_path):
    refresh(spark, archive, str(tmp_path / "out"), "magnus", 1.0, buckets=3)
    before = {t.name for t in spark.catalog.listTables()}
    land(tmp_path / "twice", "magnus", {(2014, 11): json.dumps({"games": [records[0], records[0]]})})
    with pytest.raises(CheckFailed, match="unique"):
        refresh(spark, str(tmp_path / "twice"), str(tmp_path / "out"), "magnus", 2.0, buckets=3)
    assert {t.name for t in spark.catalog.listTables()} == before
    assert spark.table("games").count() == 3 and spark.table("chess_data_raw.player_games").count() == 4
    assert spark.table("stg_player_games").count() == 3

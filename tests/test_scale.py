"""What the game queries shuffle, sort and write: nothing as wide as the games themselves."""

import os

from pyspark.sql import functions as F

from plyframe.catalog import archive, game_queries, store
from plyframe.functions.text import header_block, move_block
from plyframe.functions.timing import clock_seconds, clocks_seconds
from plyframe.operators.attacks import king_zones, with_mating_pieces
from plyframe.plans import checks, openings
from plyframe.plans.game_moves import prepare_moves
from plyframe.plans.games import build_games

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_games_and_moves_are_read_through(spark):
    mart = game_queries.games_mart(spark, FOLDER)
    assert mart.count() > 1000
    for name in ("records", "raw", "prep_player_games", "prep_game_moves"):
        assert not os.path.exists(store.folder(spark, FOLDER, name))


def test_moves_expand_without_shuffle_or_sort(spark):
    staged = spark.createDataFrame([], store.games(spark, FOLDER).schema)
    steps = plan(prepare_moves(staged))
    assert not any(step in steps for step in ("Exchange", "Window", "Sort "))


def test_mating_pieces_move_no_game(spark):
    staged = spark.createDataFrame([], store.games(spark, FOLDER).schema).drop("checkmate_pieces")
    assert "Exchange hashpartitioning(game_uuid" not in plan(with_mating_pieces(staged, ["game_uuid"]))


def test_only_orders_and_items_are_hashed(spark):
    steps = plan(game_queries.games_mart(spark, FOLDER))
    hashed = [line for line in steps.split("\n") if "Exchange hashpartitioning" in line]
    assert hashed and all("hashpartitioning(uuid#" in line or "white_won" in line for line in hashed)


def test_analysed_mart_has_no_texts(spark):
    assert not {"pgn", "pgn_moves", "tcn"} & set(store.mart(spark, FOLDER).columns)


def test_written_mart_holds_each_text_once(spark):
    """The link repeats the moves: it is not written, but read as the whole mart has it."""
    mart = store.mart(spark, FOLDER)
    written = spark.read.parquet(store.folder(spark, FOLDER, "games"))
    assert "pgn_move_extract" in written.columns and not {"game_analysis_url", "game_end_timestamp"} & set(written.columns)
    whole = build_games(store.games(spark, FOLDER), store.moves(spark, FOLDER))
    columns = mart.columns
    assert mart.count() == whole.count() and whole.select(*columns).exceptAll(mart).isEmpty()


def test_shuffled_rows_are_narrow(spark):
    """Items cross the shuffle as two numbers beside the id, orders with their key as that id only."""
    steps = plan(store.records(spark, FOLDER))
    below = [steps.split("\n")[i + 1] for i, line in enumerate(steps.split("\n")) if "Exchange hashpartitioning(uuid#" in line]
    items, orders = (next(p for p in below if name in p.split("Project [")[1]) for name in ("l_partkey", "o_custkey"))
    assert "AS parts#" in items and "AS counts#" in items and "AS whole#" in items
    sent = orders.split("Project [")[1].split(", ")
    assert not any(x.startswith("o_orderkey#") for x in sent) and "substring(o_orderpriority" in orders


def test_narrow_items_are_widened_to_themselves(spark):
    edge = [0, 1, -1, 2**31 - 1, 2**31, -(2**31), 2**63 - 1, -(2**63), None]
    rows = [("g1", None if n is None else max(-(2**31), min(n, 2**31 - 1)), a, b, q) for n in edge for a in edge for b in edge for q in (5, -5, 2**40, None)]
    items = spark.createDataFrame(rows, "uuid string, l_linenumber int, l_partkey long, l_suppkey long, q long")
    narrow = archive._narrow(items)
    back = archive._widened(narrow)
    assert back.dtypes == items.dtypes and sorted(map(repr, back.collect())) == sorted(map(repr, items.collect()))
    assert narrow.where("whole IS NULL").count() == 5 * 3 * 3 * 1  # all four numbers fit a half


def test_records_of_odd_keys(spark):
    """Numbers beyond a half, below zero or missing give the moves that the plain columns give."""
    orders = spark.createDataFrame(
        [(k, 7, "F", "2-HIGH") for k in (1, 2**40 + 1, 11, 4)] + [(None, 7, "F", None)], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string"
    ).withColumn("o_orderdate", F.lit("1996-02-03").cast("timestamp"))
    items = [(1, 1, 2**33 + 3, 4, 5.0), (1, 2, None, 4, 5.0), (2**40 + 1, 1, 3, 2**35 + 1, 2.0**41), (11, 1, 3, 4, -7.0), (4, 2, 9, 8, 7.0), (4, 1, 3, 4, 5.0), (4, 1, 3, 2, 5.0)]
    lineitem = spark.createDataFrame(items, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double")
    part, supplier, number, q = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber"), F.col("l_quantity").cast("long")
    move = F.concat_ws("", archive._move(part, supplier), archive._move(supplier + number, part + q))
    rows = lineitem.select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", q.alias("q"), move.alias("m")).alias("x"))
    want = {f"g{r.l_orderkey}": "".join(r.m) for r in rows.groupBy("l_orderkey").agg(F.sort_array(F.collect_list("x"))["m"].alias("m")).collect()}
    got = {r.uuid: (r.tcn, r.url) for r in archive.raw_records(orders, lineitem).collect()}
    assert len(got) == 5 and all(got[k][0].endswith(m) and got[k][1] == f"game/{k[1:]}" for k, m in want.items())


def test_drill_is_compressed_like_the_mart(spark, tmp_path):
    openings.write_drill(store.mart(spark, FOLDER), str(tmp_path / "drill"))
    files = list((tmp_path / "drill").rglob("part-*"))
    assert files and all(".zstd." in f.name for f in files)


def test_repeated_keys(spark):
    rows = [("a",), ("a",), ("a",), ("b",), (None,), (None,)]
    assert checks.repeated_keys("prep_player_games", spark.createDataFrame(rows, "game_uuid string")) == 1


def test_fixed_lines_are_those_of_the_setups(spark):
    rows = archive._line_rows()
    assert len(rows) == (36 + len(archive.TACTICS)) * archive.VARIANTS
    assert rows[0][1].startswith("1. e4 e5 2. d3 d6") and rows[1][1].startswith("1. e4 {[%clk 0:00:59.7]} 1... e5 {[%clk 0:00:59.7]} 2. d3 {[%clk 0:00:59.4]}")


def test_spelt_moves_are_no_function_of_a_list(spark):
    records = store.records(spark, FOLDER)
    steps = records._jdf.queryExecution().optimizedPlan().toString()
    lists = [line for line in steps.split("\n") if "transform(" in line]
    assert lists and not any("[,N,B,R,Q]" in line for line in lists)


def test_threats_carry_the_bit_of_their_square(spark):
    threats = king_zones(spark).first()["threats"]
    assert threats and all(t["needed"] % (1 << 64) == 1 << (63 - t["from_square"]) for t in threats)


def test_clocks_of_a_list_are_those_of_its_texts(spark):
    texts = ["{[%clk 1:02:03.5]}", "{[%clk 100:00:00]}", "none", "", None, "0:00:59.9 1:00:00"]
    df = spark.createDataFrame([(texts,), ([],), (None,)], "t array<string>")
    got = [x.s for x in df.select(clocks_seconds(F.col("t")).alias("s")).collect()]
    each = df.limit(1).select(F.explode("t").alias("x")).select(clock_seconds(F.col("x")).alias("s"))
    assert got == [[x.s for x in each.collect()], [], None] and got[0][2:5] == [None] * 3


def test_blocks_of_a_text(spark):
    texts = ["a\n\nb\n\nc", "a\n\nb", "a", "", None, "\n\nb", "a\n\n", "é\n\nü\n\n", "a\n\n\nb"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    got = [tuple(x) for x in df.select(header_block(F.col("t")), move_block(F.col("t"))).collect()]
    assert got == [("a", "b"), ("a", "b"), ("a", None), ("", None), (None, None), ("", "b"), ("a", ""), ("é", "ü"), ("a", "\nb")]

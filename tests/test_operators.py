"""Windows, aggregates, ranks, perspective and checks."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from plyframe.operators import aggregates as ag
from plyframe.operators import perspective as pv
from plyframe.operators import quality, ranking, windows


@pytest.fixture(scope="module")
def log(spark):
    """Rows of few keys, one of them holding most rows; some values and one key NULL."""
    rng = random.Random(3)
    rows = []
    for i in range(600):
        key = rng.choice(["hot"] * 6 + ["a", "b", None])
        rows.append((key, i, rng.choice(["x", "y"]), None if rng.random() < 0.2 else float(i)))
    return spark.createDataFrame(rows, "k string, at int, kind string, v double").repartition(3).cache()


@pytest.mark.parametrize("width", [1, 7, 50, 10_000])
def test_running_index_in_chunks_equals_one_window(log, width):
    want = log.withColumn("n", windows.running_index(["k", "kind"], ["at"]))
    got = windows.running_index_in_chunks(log, ["k", "kind"], ["at"], F.floor(F.col("at") / width), "n")
    assertDataFrameEqual(
        got.select("k", "at", F.col("n").cast("int")), want.select("k", "at", F.col("n").cast("int"))
    )


@pytest.mark.parametrize("width", [1, 7, 50, 10_000])
def test_previous_in_chunks_equals_one_window(log, width):
    default = F.lit(-1.0)
    want = log.withColumn("p", windows.previous("v", ["k"], ["at"], default))
    got = windows.previous_in_chunks(log, "v", ["k"], ["at"], F.floor(F.col("at") / width), default, "p")
    assertDataFrameEqual(got.select("k", "at", "p"), want.select("k", "at", "p"))


def test_previous_takes_the_default_after_a_null(spark):
    rows = spark.createDataFrame([(1, None), (2, 5.0), (3, 6.0)], "at int, v double")
    got = rows.withColumn("k", F.lit(1)).select("at", windows.previous("v", ["k"], ["at"], F.lit(9.0)).alias("p"))
    assert [r.p for r in got.orderBy("at").collect()] == [9.0, 9.0, 5.0]


def test_running_text(spark):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 1, "z")], "k int, at int, t string")
    got = rows.select("k", "at", windows.running_text("t", ["k"], F.col("at")).alias("s"))
    assert [tuple(r) for r in got.orderBy("k", "at").collect()] == [
        (1, 1, "a"), (1, 2, "a b"), (1, 3, "a b c"), (2, 1, "z"),
    ]


def test_pivot_counts_zero_and_sums_null_for_a_missing_value(spark):
    rows = spark.createDataFrame([(1, "White", 2.0), (1, "White", 3.0)], "g int, c string, t double")
    columns = ag.pivot_columns(F.col("c"), ["White", "Black"], F.col("t"), "time", "moves")
    assert rows.groupBy("g").agg(*columns).first().asDict() == {
        "g": 1, "white_time": 5.0, "white_moves": 2, "black_time": None, "black_moves": 0,
    }


def test_last_value_skips_unknown_values_and_places(spark):
    rows = spark.createDataFrame([(1, "a", 1), (1, None, 2), (1, "z", None), (2, None, 1)], "g int, v string, at int")
    got = rows.groupBy("g").agg(ag.last_value(F.col("v"), F.col("at")).alias("v")).orderBy("g").collect()
    assert [r.v for r in got] == ["a", None]


def test_ratio_of_no_rows_is_null(spark):
    assert spark.range(0).agg(ag.ratio(F.col("id") > 1).alias("r")).first().r is None
    assert spark.range(4).agg(ag.ratio(F.col("id") > 2).alias("r")).first().r == 0.25


def test_shares(log):
    shares = ag.share_of_total(log, ["kind"]).collect()
    assert sum(r.win_perc for r in shares) == pytest.approx(100)
    within = ag.share_within(log, ["k"], ["kind"])
    sums = within.groupBy("k").agg(F.sum("share").alias("s")).collect()
    assert len(sums) == 4 and all(r.s == pytest.approx(1) for r in sums)


def test_top_dense_ranks_keep_ties_and_nulls(log):
    measured = log.withColumn("m", F.col("at") % 9)
    rank = F.dense_rank().over(Window.partitionBy("k").orderBy(F.desc_nulls_last("m")))
    want = measured.withColumn("rn", rank).filter("rn <= 2")
    got = ranking.top_dense_ranks(measured, ["k"], "m", 2, "rn")
    assertDataFrameEqual(got.select("k", "at", "m", "rn"), want.select("k", "at", "m", "rn"))


def test_sample_has_the_asked_size(spark):
    assert ranking.sample_rows(spark.range(100), 5, "id").count() == 5
    assert ranking.sample_rows(spark.range(3), 5, "id").count() == 3


def test_distinct_sorted_puts_null_last(log):
    assert [r.k for r in ranking.distinct_sorted(log, "k").collect()] == ["a", "b", "hot", None]


def test_display_order(spark):
    rows = spark.createDataFrame([("Endgame",), ("Other",), ("Opening",)], "p string")
    got = rows.orderBy(ranking.place_in(["Opening", "Midgame", "Endgame"], F.col("p"))).collect()
    assert [r.p for r in got] == ["Opening", "Endgame", "Other"]


def test_perspective_and_outcome(spark):
    rows = spark.createDataFrame(
        [
            (True, 1, 2, "win", "checkmated"),
            (False, 1, 2, "win", "checkmated"),
            (None, 1, 2, "agreed", "agreed"),
            (True, 1, 2, None, "agreed"),
        ],
        "first boolean, a__n int, b__n int, a__r string, b__r string",
    )
    seen = rows.withColumns(pv.both_sides(F.col("first"), "a__", "b__", {"n": "n", "r": "r"}))
    own, other = F.col("player_r"), F.col("opponent_r")
    got = seen.select("player_n", "opponent_n", pv.outcome(own, other), pv.outcome_reason(own, other))
    assert [tuple(r) for r in got.collect()] == [
        (1, 2, "win", "checkmated"),
        (2, 1, "lose", "checkmated"),
        (2, 1, "draw", "agreed"),
        (1, 2, "unknown", None),
    ]


def test_checks(spark):
    rows = spark.createDataFrame([(1, "a", -1.0), (1, "b", 2.0), (None, None, 3.0)], "k int, c string, v double")
    assert [tuple(r) for r in quality.null_counts(rows, ["k", "c", "v"]).collect()] == [("k", 1), ("c", 1)]
    assert [tuple(r) for r in quality.duplicates(rows, "k").collect()] == [(1, 2)]
    assert [tuple(r) for r in quality.unaccepted(rows, "c", ["a"]).collect()] == [("b", 1)]
    assert quality.negative_share(rows, "v", 30).first().neg_time == 1
    assert quality.negative_share(rows, "v", 40).count() == 0
    with pytest.raises(quality.CheckFailed, match="dup"):
        quality.require_empty("dup", quality.duplicates(rows, "k"))

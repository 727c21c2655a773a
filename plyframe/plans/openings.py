"""Openings of every length as a prefix tree, built in one pass over the games.

A node is a colour and the first ``depth`` moves; its key is a hash of colour and moves, and it knows its parent's.  For each outcome it counts the games
that pass through it and those that end in it.  The opening of length n of a game is its first n moves, or all
of them if it has fewer: the nodes of depth n by the games through them, and the shallower nodes by the games
that end there.  So any length, its top places and the share of each outcome are read from the tree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plyframe.functions.text import prefix_text
from plyframe.operators.ranking import top_dense_ranks

LENGTHS = 7
OUTCOMES = ["win", "draw", "lose"]  # fixed values
MOVES = "pgn_move_extract"


def node_key(color: Column, moves: Column) -> Column:
    """Hash of a colour and a list of moves; moves have no blanks of their own beyond the number's."""
    return F.xxhash64(color, F.array_join(moves, "\n"))


def build_tree(games: DataFrame, lengths: int = LENGTHS) -> DataFrame:
    """(player_color, depth, node, parent, starting_moves, through_*, ended_*), one row per node.

    A game gives one row for each of its first ``lengths`` moves; they are counted map-side, so the shuffle
    has a row per node and task.  Games without moves are in no node.  An outcome that is none of the three counts nowhere.
    """
    long = F.size(MOVES)
    own = games.where(long > 0).select("player_color", "player_wdl", F.slice(MOVES, 1, lengths).alias(MOVES), long.alias("long"))
    step = own.withColumn("depth", F.explode(F.sequence(F.lit(1), F.least(F.lit(lengths), "long"))))
    path = F.slice(MOVES, F.lit(1), F.col("depth"))
    nodes = step.select(
        "player_color", "player_wdl", "depth", path.alias("path"), (F.col("depth") == F.col("long")).alias("ends"),
    )
    states = []
    for wdl in OUTCOMES:
        own_outcome = F.col("player_wdl") == wdl
        states += [F.count_if(own_outcome).alias(f"through_{wdl}"), F.count_if(own_outcome & F.col("ends")).alias(f"ended_{wdl}")]
    up = F.when(F.col("depth") > 1, node_key(F.col("player_color"), F.slice("path", F.lit(1), F.col("depth") - 1)))
    return nodes.groupBy("player_color", "depth", "path").agg(*states).select(
        "player_color", "depth", node_key(F.col("player_color"), F.col("path")).alias("node"), up.alias("parent"),
        F.array_join("path", " ").alias("starting_moves"), *[f"{k}_{w}" for w in OUTCOMES for k in ("through", "ended")],
    )


def openings(tree: DataFrame, lengths: list[int]) -> DataFrame:
    """(moves, player_color, starting_moves, player_wdl, wdl_num_games, num_games): all openings of the given lengths."""
    wanted = F.explode(F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n >= F.col("depth")))
    each = tree.where(F.col("depth") <= max(lengths)).withColumn("moves", wanted)
    passing = F.col("moves") == F.col("depth")
    counted = [F.when(passing, F.col(f"through_{w}")).otherwise(F.col(f"ended_{w}")) for w in OUTCOMES]
    total = counted[0] + counted[1] + counted[2]
    pairs = F.filter(F.array(*[F.struct(F.lit(w).alias("wdl"), n.alias("n")) for w, n in zip(OUTCOMES, counted, strict=True)]), lambda p: p["n"] > 0)
    return each.select("moves", "player_color", "starting_moves", total.alias("num_games"), F.explode(pairs).alias("p")).select(
        "moves", "player_color", "starting_moves", F.col("p.wdl").alias("player_wdl"), F.col("p.n").alias("wdl_num_games"), "num_games"
    )


def top_openings(tree: DataFrame, lengths: list[int], places: int = 5) -> DataFrame:
    """The most played openings of each length and colour by outcome; equal totals share a place."""
    ranked = top_dense_ranks(openings(tree, lengths), ["moves", "player_color"], "num_games", places, "rn")
    return ranked.withColumn("perc", F.lit(100.0) * F.col("wdl_num_games") / F.col("num_games"))


def continuations(tree: DataFrame, color: str, starting_moves: str) -> DataFrame:
    """The nodes one move further than an opening, found by its key."""
    own = tree.where((F.col("player_color") == color) & (F.col("starting_moves") == starting_moves))
    return tree.join(own.select(F.col("node").alias("parent")), "parent", "left_semi")


def write_drill(games: DataFrame, path: str, lengths: int = LENGTHS) -> None:
    """The games in the order of their openings: a lookup by first moves reads the row groups that can hold them."""
    own = games.where(F.size(MOVES) > 0).select(
        "player_color", "player_wdl", F.concat(prefix_text(F.col(MOVES), lengths), F.lit(" ")).alias("line"), F.size(MOVES).alias("long"), "game_analysis_url"
    )
    ordered = own.repartitionByRange("player_color", "line").sortWithinPartitions("player_color", "line")
    ordered.write.mode("overwrite").option("compression", "zstd").partitionBy("player_color").parquet(path)


def games_of(drill: DataFrame, opening: str, count: int, color: str, wdl: str) -> DataFrame:
    """Games of one colour and outcome whose opening of ``count`` moves is ``opening``.

    The prefix ends in a blank, so ``e4`` is none of ``e4+``; an opening shorter than ``count`` is a whole game.
    """
    begins = F.startswith("line", F.lit(opening + " "))
    moves = opening.count(" ") // 2 + 1  # number and move
    whole = F.lit(True) if moves >= count else F.col("long") == moves
    return drill.where((F.col("player_color") == color) & (F.col("player_wdl") == wdl) & begins & whole).select("game_analysis_url")

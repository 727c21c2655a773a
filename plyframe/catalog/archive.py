"""A game archive derived from ``orders``: one raw record per order.

The given tables hold no games, so each order is read as one: its key, customer, status,
priority, price and date decide players, ratings, result, time control, start and moves.
White and Black each follow one of six set-ups, then every line item of the order adds a move for
each of them, named after its part and supplier (the texts need not be playable); every fifth
order plays a short tactical game instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plyframe.functions.text import OPENING_SITE

PLAYER = "archivist"

# Move, and its from/to squares for the check queries (which play boards by squares).
WHITE_SETUPS = [
    "e4:e2e4 d3:d2d3 Nf3:g1f3 g3:g2g3 Bg2:f1g2 O-O:e1g1 Nbd2:b1d2 Re1:f1e1 h3:h2h3 Qe2:d1e2",
    "d4:d2d4 Nf3:g1f3 e3:e2e3 Be2:f1e2 O-O:e1g1 b3:b2b3 Bb2:c1b2 Nbd2:b1d2 c4:c2c4 Qc2:d1c2",
    "c4:c2c4 Nc3:b1c3 g3:g2g3 Bg2:f1g2 Nf3:g1f3 O-O:e1g1 d3:d2d3 Bd2:c1d2 Rc1:a1c1 a3:a2a3",
    "Nf3:g1f3 d3:d2d3 Nbd2:b1d2 e3:e2e3 Be2:f1e2 O-O:e1g1 c3:c2c3 Re1:f1e1 Nf1:d2f1 Ng3:f1g3",
    "b3:b2b3 Bb2:c1b2 e3:e2e3 Nf3:g1f3 d3:d2d3 Nbd2:b1d2 Be2:f1e2 Qc1:d1c1 Rb1:a1b1 O-O:e1g1",
    "d4:d2d4 Nc3:b1c3 Bf4:c1f4 Qd3:d1d3 O-O-O:e1c1 e3:e2e3 Kb1:c1b1 f3:f2f3 Nge2:g1e2 g4:g2g4",
]
BLACK_SETUPS = [
    "e5:e7e5 d6:d7d6 Nf6:g8f6 g6:g7g6 Bg7:f8g7 O-O:e8g8 Nbd7:b8d7 Re8:f8e8 h6:h7h6 Qe7:d8e7",
    "d5:d7d5 Nf6:g8f6 e6:e7e6 Be7:f8e7 O-O:e8g8 b6:b7b6 Bb7:c8b7 Nbd7:b8d7 c5:c7c5 Qc7:d8c7",
    "c5:c7c5 Nc6:b8c6 g6:g7g6 Bg7:f8g7 Nf6:g8f6 O-O:e8g8 d6:d7d6 Bd7:c8d7 Rc8:a8c8 a6:a7a6",
    "Nf6:g8f6 d6:d7d6 Nbd7:b8d7 e6:e7e6 Be7:f8e7 O-O:e8g8 c6:c7c6 Re8:f8e8 Nf8:d7f8 Ng6:f8g6",
    "b6:b7b6 Bb7:c8b7 e6:e7e6 Nf6:g8f6 d6:d7d6 Nbd7:b8d7 Be7:f8e7 Qc8:d8c8 Rb8:a8b8 O-O:e8g8",
    "d5:d7d5 Nc6:b8c6 Bf5:c8f5 Qd6:d8d6 O-O-O:e8c8 e6:e7e6 Kb8:c8b8 f6:f7f6 Nge7:g8e7 g5:g7g5",
]
# (moves, winner if it ends in mate, final position of a mate, its mating pieces)
TACTICS = [
    (
        "e4:e2e4 e5:e7e5 Bc4:f1c4 Nc6:b8c6 Qh5:d1h5 Nf6:g8f6 Qxf7#:h5f7",
        "White",
        "r1bqkb1r/pppp1Qpp/2n2n2/4p3/2B1P3/8/PPPP1PPP/RNB1K1NR b KQkq - 0 4",
        "bishop,queen",
    ),
    (
        "f3:f2f3 e5:e7e5 g4:g2g4 Qh4#:d8h4",
        "Black",
        "rnb1kbnr/pppp1ppp/8/4p3/6Pq/5P2/PPPPP2P/RNBQKBNR w KQkq - 1 3",
        "queen",
    ),
    (
        "e4:e2e4 e5:e7e5 Nf3:g1f3 d6:d7d6 Bc4:f1c4 Bg4:c8g4 Nc3:b1c3 g6:g7g6 Nxe5:f3e5 "
        "Bxd1:g4d1 Bxf7+:c4f7 Ke7:e8e7 Nd5#:c3d5",
        "White",
        "rn1q1bnr/ppp1kB1p/3p2p1/3NN3/4P3/8/PPPP1PPP/R1BbK2R b KQ - 2 7",
        "bishop,knight,knight",
    ),
    (
        "e4:e2e4 c6:c7c6 d4:d2d4 d5:d7d5 Nc3:b1c3 dxe4:d5e4 Nxe4:c3e4 Nd7:b8d7 Qe2:d1e2 "
        "Ngf6:g8f6 Nd6#:e4d6",
        "White",
        "r1bqkb1r/pp1npppp/2pN1n2/8/3P4/8/PPP1QPPP/R1B1KBNR b KQkq - 4 6",
        "knight",
    ),
    (
        "e4:e2e4 d5:d7d5 e5:e4e5 f5:f7f5 exf6:e5f6 Nh6:g8h6 fxg7:f6g7 Nc6:b8c6 gxh8=Q:g7h8q "
        "Be6:c8e6",
        None,
        None,
        None,
    ),
    (
        "h4:h2h4 g5:g7g5 hxg5:h4g5 h6:h7h6 gxh6:g5h6 Nf6:g8f6 h7:h6h7 Rg8:h8g8 h8=N:h7h8n Rg6:g8g6",
        None,
        None,
        None,
    ),
    (
        "d4:d2d4 e6:e7e6 c4:c2c4 Bb4+:f8b4 Nc3:b1c3 Nf6:g8f6 e3:e2e3 O-O:e8g8 Ne2:g1e2 d5:d7d5 "
        "a3:a2a3 Bxc3+:b4c3 Nxc3:e2c3",
        None,
        None,
        None,
    ),
    (
        "a4:a2a4 a5:a7a5 h4:h2h4 h5:h7h5 Ra3:a1a3 Ra6:a8a6 Rhh3:h1h3 Rhh6:h8h6 Rhg3:h3g3 Rag6:a6g6",
        None,
        None,
        None,
    ),
]
# Final positions of games without a mate.
FINALS = [
    "r1b2rk1/pp3ppp/2n2n2/3q4/3P4/2N2N2/PP3PPP/R1BQ1RK1 w - - 0 12",
    "rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR w KQkq - 0 1",
    "2r3k1/5ppp/8/3p4/3P4/8/5PPP/2R3K1 w - - 4 30",
    "r3kb1r/ppp2ppp/2n2n2/8/8/2N2N2/PPP2PPP/R3KB1R w KQkq - 2 9",
    "8/5k2/4n3/8/8/3B4/5K2/8 b - - 8 60",
    "q3r1k1/8/1b6/8/8/6N1/8/1R2Q1K1 b - - 1 41",
    "1r1qk2r/p4p1p/8/2b5/5B2/8/P4P1P/R2QK1R1 w - - 0 22",
]
START = "rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR w KQkq - 0 1"


def sans(line: str) -> list[str]:
    return [pair.split(":")[0] for pair in line.split()]


def _pick(values: list, index: Column) -> Column:
    """Entry of a fixed list by 0-based index."""
    lists = [F.array(*[F.lit(x) for x in v]) if isinstance(v, list) else F.lit(v) for v in values]
    return F.element_at(F.array(*lists), (index + 1).cast("int"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _move(a: Column, b: Column) -> Column:
    """A move text of two numbers."""
    return F.concat(
        _pick(["", "N", "B", "R", "Q"], a % 5), _pick(list("abcdefgh"), b % 8), (a % 8 + 1).cast("string")
    )


HALF = 2**31 - 1


def _pair(a: Column, b: Column) -> Column:
    """Two numbers as halves of one; NULL unless both are from 0 to HALF."""
    return F.when(a.between(0, HALF) & b.between(0, HALF), F.shiftleft(a.cast("long"), 32).bitwiseOR(b.cast("long")))


def _narrow(items: DataFrame) -> DataFrame:
    """Line items as they are shuffled: numbers two by two, or as they are (``whole``) where a row has one that no half holds."""
    c = F.col
    pairs = {"parts": _pair(c("l_partkey"), c("l_suppkey")), "counts": _pair(c("l_linenumber"), c("q"))}
    whole = F.when(pairs["parts"].isNull() | pairs["counts"].isNull(), F.struct("l_linenumber", "l_partkey", "l_suppkey", "q"))
    return items.select("uuid", *[pair.alias(name) for name, pair in pairs.items()], whole.alias("whole"))


def _widened(narrow: DataFrame) -> DataFrame:
    """The line items that :func:`_narrow` was given."""
    kinds = {f.name: f.dataType for f in narrow.schema["whole"].dataType.fields}
    high, low = (lambda pair: F.shiftright(pair, 32)), (lambda pair: F.col(pair).bitwiseAND(F.lit(HALF)))
    halves = {"l_linenumber": high("counts"), "l_partkey": high("parts"), "l_suppkey": low("parts"), "q": low("counts")}
    own = [F.when(F.col("whole").isNull(), half.cast(kinds[name])).otherwise(F.col("whole")[name]).alias(name) for name, half in halves.items()]
    return narrow.select("uuid", *own)


def _items(lineitem: DataFrame) -> DataFrame:
    """Each order's line items, a handful each, in full order, under the id of its game."""
    part, supplier, q = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_quantity").cast("long").alias("q")
    own = lineitem.select(_game_id(F.col("l_orderkey")).alias("uuid"), "l_linenumber", "l_partkey", "l_suppkey", q)
    # Hashed as plain rows: lists made before the shuffle would join no two items that do not already adjoin.
    # The moves are spelt in compiled code, row by row; a list's functions are interpreted.
    own = _widened(_narrow(own).repartition("uuid")).withColumns({"w": _move(part, supplier), "b": _move(supplier + F.col("l_linenumber"), part + F.col("q"))})
    item = F.struct("l_linenumber", "l_partkey", "l_suppkey", "q", "w", "b", F.concat_ws("", "w", "b").alias("tcn"))
    return own.groupBy("uuid").agg(F.sort_array(F.collect_list(item)).alias("items"))


def _game_id(key: Column) -> Column:
    return F.concat(F.lit("g"), key.cast("string"))


BASES = [60, 180, 600, 1500]
SPEEDS = 7  # a clock runs down by three times 1 to 7 tenths a move
VARIANTS = 1 + len(BASES) * SPEEDS  # how a line is noted: without clocks, or by base and speed


def _note(tenths: int) -> str:
    return f"{{[%clk {tenths // 36000}:{tenths // 600 % 60:02d}:{tenths // 10 % 60:02d}.{tenths % 10}]}}"


def _line_rows() -> list[tuple[int, str, str]]:
    """(code, text, tcn) of every fixed line in every variant; a code is line * VARIANTS + variant."""
    lines = [[x for pair in zip(sans(w), sans(b), strict=True) for x in pair] for w in WHITE_SETUPS for b in BLACK_SETUPS]
    rows = []
    for no, line in enumerate([*lines, *(sans(t[0]) for t in TACTICS)]):
        bare = " ".join(f"{i // 2 + 1}. {san}" if i % 2 == 0 else san for i, san in enumerate(line))
        rows.append((no * VARIANTS, bare, "".join(line)))
        for way in range(VARIANTS - 1):
            base, speed = BASES[way // SPEEDS], way % SPEEDS + 1
            noted = (f"{i // 2 + 1}{'. ' if i % 2 == 0 else '... '}{san} {_note(base * 10 - (i // 2 + 1) * speed * 3)}" for i, san in enumerate(line))
            rows.append((no * VARIANTS + 1 + way, " ".join(noted), "".join(line)))
    return rows


def _lines(spark: SparkSession) -> DataFrame:
    """The fixed lines (1 276 rows whatever the data), safe to broadcast."""
    return spark.createDataFrame(_line_rows(), "code bigint, line_text string, line_tcn string")


def _parameters(orders: DataFrame) -> DataFrame:
    """What the order decides, as plain columns."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    priority = F.substring("o_orderpriority", 1, 1)
    daily = priority == "4"
    tactic = F.when(key % 5 == 0, F.floor(key / 5) % len(TACTICS))
    line = F.when(tactic.isNotNull(), len(WHITE_SETUPS) * len(BLACK_SETUPS) + tactic).otherwise(key % 6 * len(BLACK_SETUPS) + customer % 6)
    kind = F.when(priority == "1", 0).when(priority == "2", 1).when(priority == "3", 3).otherwise(2)
    variant = F.when(daily, 0).otherwise(1 + kind * SPEEDS + key % SPEEDS)
    seconds = F.when(daily, (key % 50) * 86400 + key % 1000).otherwise(600 + key % 3000)
    return orders.withColumns(
        {
            "daily": daily,
            "time_class": F.when(priority == "1", "bullet")
            .when(priority == "2", "blitz")
            .when(daily, "daily")
            .otherwise("rapid"),
            "time_control": F.when(priority == "1", "60")
            .when(priority == "2", "180+2")
            .when(priority == "3", "1500+25")
            .when(daily, "1/259200")
            .otherwise("600"),
            "base": F.when(priority == "1", 60)
            .when(priority == "2", 180)
            .when(priority == "3", 1500)
            .otherwise(600),
            "tactic": tactic,
            "code": line * VARIANTS + variant,
            "winner": F.coalesce(
                _pick([t[1] for t in TACTICS], tactic),
                F.when(F.col("o_orderstatus") == "F", "White").when(F.col("o_orderstatus") == "O", "Black"),
            ),
            "mate": _pick([t[1] for t in TACTICS], tactic).isNotNull(),
            "ended": F.timestamp_seconds(F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) + key % 86400),
            "seconds": seconds,
        }
    ).withColumn("started", F.timestamp_seconds(F.unix_timestamp("ended") - F.col("seconds")))


def _both(white: Column, black: Column) -> Column:
    """Two moves as one text; NULL where both are."""
    return F.when(white.isNotNull() | black.isNotNull(), F.concat_ws(" ", white, black))


def _clock(tenths: Column) -> Column:
    """Clock note of tenths of a second."""
    hours, minutes, seconds = F.floor(tenths / 36000), F.floor(tenths / 600) % 60, F.floor(tenths / 10) % 60
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    plain = F.concat(F.lit("{[%clk "), hours.cast("string"), F.lit(":"), two(minutes), F.lit(":"), two(seconds), F.lit("."), (tenths % 10).cast("string"), F.lit("]}"))
    return F.when(tenths >= 0, plain).otherwise(F.format_string("{[%%clk %d:%02d:%02d.%d]}", hours, minutes, seconds, tenths % 10))


def raw_records(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Nested raw records, as the archive's contract has them."""
    c = F.col
    # Orders and items meet under the id of the game, by which all later tables are grouped and joined.
    # The key is shuffled once, as that id; of the priority only its first letter is read.
    own = orders.withColumns({"uuid": _game_id(c("o_orderkey")), "o_orderpriority": F.substring("o_orderpriority", 1, 1)}).drop("o_orderkey")
    own = own.repartition("uuid").withColumn("o_orderkey", F.substring("uuid", 2, 20).cast(orders.schema["o_orderkey"].dataType))
    games = _parameters(own.join(_items(lineitem), "uuid", "left"))
    games = games.join(F.broadcast(_lines(orders.sparkSession)), "code", "left")
    # Each line item adds a move of both; the clock is noted after the setups' ten pairs, none in a daily game.
    tenths = lambda n: c("base") * 10 - (n + 11) * (c("o_orderkey") % SPEEDS + 1) * 3
    # Daily games carry no clock notes and number White's moves only.
    added = F.when(c("tactic").isNull(), c("items"))
    bare = F.transform(added, lambda x, n: _both(F.concat((n + 11).cast("string"), F.lit(". "), x["w"]), x["b"]))
    clocks = F.transform(added, lambda x, n: F.struct((n + 11).cast("string").alias("number"), _clock(tenths(n)).alias("clock"), x["w"].alias("w"), x["b"].alias("b")))
    noted = F.transform(
        clocks,
        lambda p: _both(
            F.concat(p["number"], F.lit(". "), p["w"], F.lit(" "), p["clock"]),
            F.concat(p["number"], F.lit("... "), p["b"], F.lit(" "), p["clock"]),
        ),
    )
    more = F.when(c("daily"), bare).otherwise(noted)
    spelt = F.coalesce(F.concat(F.lit(" "), F.nullif(F.array_join(more, " "), F.lit(""))), F.lit(""))
    added_tcn = F.coalesce(F.array_join(added["tcn"], ""), F.lit(""))
    score = F.when(c("winner") == "White", "1-0").when(c("winner") == "Black", "0-1").otherwise("1/2-1/2")
    player_white = c("o_orderkey") % 2 == 0
    guest = F.concat(F.lit("guest"), c("o_custkey").cast("string"))
    white = F.when(player_white, F.lit(PLAYER.title())).otherwise(guest)
    black = F.when(player_white, guest).otherwise(F.lit(PLAYER.title()))
    eco = F.concat(F.lit("A"), F.lpad((c("o_custkey") % 100).cast("string"), 2, "0"))
    lines = {
        "Event": F.lit("Archive"),
        "White": white,
        "Black": black,
        "Result": score,
        "ECO": eco,
        "ECOUrl": F.concat(F.lit(OPENING_SITE + "Line-"), eco),
        "UTCDate": F.date_format("started", "yyyy.MM.dd"),
        "StartTime": F.date_format("started", "HH:mm:ss"),
    }
    header = F.concat_ws(
        "\n", *[F.concat(F.lit(f'[{name} "'), value, F.lit('"]')) for name, value in lines.items()]
    )
    moves = F.concat("line_text", spelt)
    lost = F.when(c("mate"), "checkmated").when(c("winner") == "White", "resigned").otherwise("timeout")

    def side(color: str, name: Column, rating: Column) -> Column:
        result = F.when(c("winner") == color, "win").when(c("winner").isNotNull(), lost).otherwise("agreed")
        return F.struct(
            rating.cast("int").alias("rating"),
            result.alias("result"),
            F.concat(F.lit("player/"), F.lower(name)).alias("@id"),
            name.alias("username"),
            F.sha1(F.lower(name)).alias("uuid"),
        )

    return games.select(
        F.concat(F.lit("game/"), c("o_orderkey").cast("string")).alias("url"),
        F.when(c("o_custkey") % 25 == 0, "chess960").otherwise("chess").alias("rules"),
        F.concat(header, F.lit("\n\n"), moves, F.lit(" "), score, F.lit("\n")).alias("pgn"),
        "time_control",
        F.unix_timestamp("ended").alias("end_time"),
        (c("o_orderstatus") != "P").alias("rated"),
        F.when(
            c("o_orderkey") % 3 == 0,
            F.struct(
                (50 + c("o_orderkey") % 50).cast("double").alias("white"),
                F.when(c("o_orderkey") % 2 == 0, (40 + c("o_custkey") % 60).cast("double")).alias("black"),
            ),
        ).alias("accuracies"),
        F.concat("line_tcn", added_tcn).alias("tcn"),
        "uuid",
        F.lit(START).alias("initial_setup"),
        F.coalesce(_pick([t[2] for t in TACTICS], c("tactic")), _pick(FINALS, c("o_orderkey") % len(FINALS))).alias("fen"),
        "time_class",
        side("White", white, 1000 + (c("o_custkey") * 13) % 1500).alias("white"),
        side("Black", black, 1000 + (c("o_orderkey") * 7) % 1500).alias("black"),
    )

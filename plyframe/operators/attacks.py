"""Attack graph of positions: pieces joined to a static table of board geometry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plyframe.functions.positions import squares

NAMES = {"p": "pawn", "n": "knight", "b": "bishop", "r": "rook", "q": "queen", "k": "king"}

STRAIGHT = [(-1, 0), (1, 0), (0, -1), (0, 1)]
DIAGONAL = [(-1, -1), (-1, 1), (1, -1), (1, 1)]
JUMPS = [(r, c) for r in (-2, -1, 1, 2) for c in (-2, -1, 1, 2) if abs(r) != abs(c)]
# letter -> (directions, steps); white pawns look up the board (towards row 0)
REACH = {
    "P": ([(-1, -1), (-1, 1)], 1),
    "p": ([(1, -1), (1, 1)], 1),
    "n": (JUMPS, 1),
    "b": (DIAGONAL, 7),
    "r": (STRAIGHT, 7),
    "q": (STRAIGHT + DIAGONAL, 7),
    "k": (STRAIGHT + DIAGONAL, 1),
}


def _bit(square: int) -> int:
    return 1 << (63 - square)


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def geometry_rows() -> list[tuple[str, int, int, int]]:
    """(piece, from, to, squares between as bits); squares 0..63 in position-text order."""
    rows = []
    for piece in "PNBRQKpnbrqk":
        directions, steps = REACH.get(piece, REACH[piece.lower()])
        for start in range(64):
            for dr, dc in directions:
                between = 0
                for step in range(1, steps + 1):
                    r, c = start // 8 + dr * step, start % 8 + dc * step
                    if not (0 <= r < 8 and 0 <= c < 8):
                        break
                    rows.append((piece, start, r * 8 + c, _signed(between)))
                    between |= _bit(r * 8 + c)
    return rows


def geometry(spark: SparkSession) -> DataFrame:
    """The static table (7 532 rows whatever the data), safe to broadcast."""
    return spark.createDataFrame(
        geometry_rows(), "piece string, from_square int, to_square int, between bigint"
    )


def occupied_bits(board: Column) -> Column:
    """Occupied squares of a 64-character board as a bit set (first square = top bit)."""
    ones = F.translate(board, "PNBRQKpnbrqk.", "1111111111110")
    return F.conv(ones, 2, -10).cast("long")


def attack_graph(positions: DataFrame, keys: list[str], position: str = "fen") -> DataFrame:
    """One row per (position, attacking piece, attacked square), blockers respected.

    A position has at most 64 pieces and 27 targets per piece, so a row expands by a
    bounded factor; the geometry side is broadcast and nothing is shuffled.
    """
    boards = positions.select(*keys, squares(F.col(position)).alias("board")).select(
        *keys, "board", occupied_bits(F.col("board")).alias("occupied")
    )
    pieces = boards.select(
        "*", F.posexplode(F.split("board", "")).alias("from_square", "piece")
    ).filter(F.col("piece") != ".")
    spark = positions.sparkSession
    return (
        pieces.join(F.broadcast(geometry(spark)), ["piece", "from_square"])
        .filter(F.col("between").bitwiseAND(F.col("occupied")) == 0)
        .withColumn(
            "held_by",
            F.nullif(F.substring("board", F.col("to_square") + 1, F.lit(1)), F.lit(".")),
        )
        .select(*keys, "piece", "from_square", "to_square", "held_by")
    )


def winner_color(player_color: Column, player_result: Column) -> Column:
    """The player's colour if they won, else the other one."""
    other = F.when(player_color == "White", "Black").otherwise("White")
    return F.when(player_result == "win", player_color).otherwise(other)


def king_zones(spark: SparkSession) -> DataFrame:
    """(white_won, king, threats): per colour and square of the mated king, the winner's edges to it and its neighbours.

    128 rows whatever the data, safe to broadcast; a threat is (piece, from_square, to_square, between, needed),
    ``needed`` the bit of the square the piece stands on.
    """
    edges = geometry(spark).withColumn("white_won", F.col("piece") == F.upper("piece"))
    target, king = F.col("to_square"), F.col("king")
    beside = (F.abs(F.floor(target / 8) - F.floor(king / 8)) <= 1) & (F.abs(target % 8 - king % 8) <= 1)
    bits = F.array(*[F.lit(_signed(_bit(square))) for square in range(64)])
    threat = F.struct("piece", "from_square", "to_square", "between", F.get(bits, "from_square").alias("needed"))
    near = edges.withColumn("king", F.explode(F.sequence(F.lit(0), F.lit(63)))).where(beside)
    return near.groupBy("white_won", "king").agg(F.collect_list(threat).alias("threats"))


def _mated(games: DataFrame, position: str) -> DataFrame:
    """``games`` with ``found``: sorted names of the pieces that hold a mated king, NULL if none is attacked.

    The attack graph of one position is looked up in the row itself, in the edges that end at or beside the
    king, so games are neither shuffled nor joined back, however wide.
    """
    winner = winner_color(F.col("player_color"), F.col("player_result"))
    mated = (F.col("player_result") == "checkmated") | (F.col("opponent_result") == "checkmated")
    king = F.instr("__board", F.when(F.col("__white_won"), "k").otherwise("K")) - 1
    own = games.withColumns({"__board": F.when(mated, squares(F.col(position))), "__white_won": winner == "White"})
    own = own.withColumns({"__king": king, "__occupied": occupied_bits(F.col("__board"))})
    men = F.when(F.col("__white_won"), F.translate("__board", "pnbrqk", "......")).otherwise(F.translate("__board", "PNBRQK", "......"))
    own = own.withColumn("__men", occupied_bits(men))
    zones = king_zones(games.sparkSession).select(F.col("white_won").alias("__white_won"), F.col("king").alias("__king"), F.col("threats").alias("__threats"))
    own = own.join(F.broadcast(zones), ["__white_won", "__king"], "left")

    def holds(edge: Column) -> Column:
        """The piece stands there, its way is free, and it reaches the king or a square not held by one of his men."""
        holder = F.substring("__board", edge["to_square"] + 1, F.lit(1))
        free = (holder == ".") | ((holder == F.upper(holder)) == F.col("__white_won"))
        stands = F.substring("__board", edge["from_square"] + 1, F.lit(1)) == edge["piece"]
        # Bits first: most threats start from a square without a man of the winner and end there.
        near = (edge["needed"].bitwiseAND(F.col("__men")) != 0) & (edge["between"].bitwiseAND(F.col("__occupied")) == 0)
        return near & stands & ((edge["to_square"] == F.col("__king")) | free)

    own = own.withColumn("__edges", F.filter("__threats", holds))
    names = F.create_map(*[F.lit(x) for p in NAMES.items() for x in p])
    pieces = F.array_distinct(F.transform("__edges", lambda e: F.struct(e["piece"], e["from_square"])))
    found = F.array_sort(F.transform(pieces, lambda p: F.element_at(names, F.lower(p["piece"]))))
    attacked = F.exists("__edges", lambda e: e["to_square"] == F.col("__king"))
    return own.withColumn("found", F.when(attacked, found))


def mating_pieces(games: DataFrame, keys: list[str], position: str = "fen") -> DataFrame:
    """``checkmate_pieces`` per mated game: sorted names of the pieces that hold the king.

    Those are the winner's attackers of the mated king's square, or of a neighbouring
    square not held by one of his own men.  A game not flagged as mated, or whose king is
    not attacked, gives no row.
    """
    flagged = (F.col("player_result") == "checkmated") | (F.col("opponent_result") == "checkmated")
    facts = games.filter(flagged).select(*keys, position, "player_color", "player_result", "opponent_result")
    return _mated(facts, position).where(F.col("found").isNotNull()).select(*keys, F.col("found").alias("checkmate_pieces"))


def with_mating_pieces(games: DataFrame, keys: list[str], position: str = "fen") -> DataFrame:
    """Add the mating pieces; ``[]`` where there are none, NULL where an input is NULL."""
    known = F.lit(True)
    for column in (position, "player_color", "player_result", "opponent_result"):
        known = known & F.col(column).isNotNull()
    pieces = F.when(known, F.coalesce("found", F.array().cast("array<string>")))
    return _mated(games, position).select(*games.columns, pieces.alias("checkmate_pieces"))

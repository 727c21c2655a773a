"""Attack graph and mating pieces."""

import pytest

from plyframe.operators.attacks import attack_graph, geometry_rows, mating_pieces, with_mating_pieces

COLUMNS = "game_uuid string, fen string, player_color string, player_result string, opponent_result string"


def pieces(spark, *rows):
    games = spark.createDataFrame([(str(i), *r) for i, r in enumerate(rows)], COLUMNS)
    found = with_mating_pieces(games, ["game_uuid"]).collect()
    return [r.checkmate_pieces for r in sorted(found, key=lambda r: int(r.game_uuid))]


# Fixed value: a mate position.
MATE = "8/8/4R2p/3P2pk/8/5r1K/3r4/8 w - -"


def test_geometry_is_bounded():
    rows = geometry_rows()
    assert len(rows) == len({r[:3] for r in rows}) == 7532


def test_mating_pieces(spark):
    assert pieces(
        spark,
        (MATE, "Black", "win", "checkmated"),
        (MATE, "White", "checkmated", "win"),
        (MATE, "Black", "win", "resigned"),
        (MATE, "White", "agreed", "agreed"),
        (None, "White", "win", "checkmated"),
        (MATE, None, "win", "checkmated"),
    ) == [["king", "pawn", "rook", "rook"]] * 2 + [[], [], None, None]


@pytest.mark.parametrize(
    "fen, color, names",
    [
        ("rnb1kbnr/pppp1ppp/8/4p3/6Pq/5P2/PPPPP2P/RNBQKBNR w KQkq - 1 3", "Black", ["queen"]),
        ("r1bqkb1r/pppp1Qpp/2n2n2/4p3/2B1P3/8/PPPP1PPP/RNB1K1NR b KQkq - 0 4", "White", ["bishop", "queen"]),
        # back-rank mate: the squares behind the king are shielded by the king himself
        ("3R2k1/5ppp/8/8/8/8/8/6K1 b - - 0 1", "White", ["rook"]),
        # not even check, though flagged: nothing
        ("6k1/5ppp/8/8/8/8/8/3R2K1 b - - 0 1", "White", []),
    ],
)
def test_classic_mates(spark, fen, color, names):
    assert pieces(spark, (fen, color, "win", "checkmated")) == [names]


def brute_force(fen):
    """Attacked squares by walking every ray, the slow and plain way."""
    board = []
    for mark in fen.split(" ")[0].replace("/", ""):
        board += ["."] * int(mark) if mark.isdigit() else [mark]
    edges = set()
    for start, piece in enumerate(board):
        kind = piece.lower()
        if kind == "p":
            steps, far = [(-1 if piece == "P" else 1, c) for c in (-1, 1)], 1
        elif kind == "n":
            steps, far = [(r, c) for r in (-2, -1, 1, 2) for c in (-2, -1, 1, 2) if abs(r) + abs(c) == 3], 1
        elif kind in "bqrk":
            steps = [(r, c) for r in (-1, 0, 1) for c in (-1, 0, 1) if (r or c)]
            steps = [s for s in steps if kind in "qk" or (kind == "b") == (s[0] != 0 and s[1] != 0)]
            far = 1 if kind == "k" else 7
        else:
            continue
        for dr, dc in steps:
            r, c = divmod(start, 8)
            for _ in range(far):
                r, c = r + dr, c + dc
                if not (0 <= r < 8 and 0 <= c < 8):
                    break
                edges.add((piece, start, r * 8 + c))
                if board[r * 8 + c] != ".":
                    break
    return edges


def test_graph_equals_brute_force(spark):
    fens = [
        MATE,
        "r6k/pq3pQp/1p6/3bPN2/8/8/1PP3PP/3RR1K1 b - - 0 27",
        "r1bqkb1r/pp1npppp/2pN1n2/8/3P4/8/PPP1QPPP/R1B1KBNR b KQkq - 4 6",
    ]
    rows = attack_graph(spark.createDataFrame(list(enumerate(fens)), "id int, fen string"), ["id"]).collect()
    for i, fen in enumerate(fens):
        assert {(r.piece, r.from_square, r.to_square) for r in rows if r.id == i} == brute_force(fen)


def test_nothing_is_collected_for_other_games(spark):
    games = spark.createDataFrame([("a", MATE, "White", "win", "resigned")], COLUMNS)
    assert mating_pieces(games, ["game_uuid"]).count() == 0

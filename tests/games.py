"""Literal games used by several tests."""

# Golden game: move, clock after it, and the seconds it took (fixed values).
GOLDEN = """
    e4 0:24:55.5 29.5; g6 0:24:03.5 81.5; Nf3 0:25:13.7 6.8; d6 0:23:55.1 33.4;
    d4 0:24:57.4 41.3; Bg7 0:24:13.6 6.5; Bc4 0:25:02 20.4; Bg4 0:24:22.4 16.2;
    Bxf7+ 0:25:12.6 14.4; Kxf7 0:24:40.3 7.1; Ng5+ 0:25:07.5 30.1; Ke8 0:24:53.8 11.5;
    Qxg4 0:24:49.9 42.6; Nh6 0:24:53.9 24.9; Qh3 0:25:05.4 9.5; Nd7 0:24:57.3 21.6;
    Ne6 0:25:17 13.4; Qc8 0:24:21.8 60.5; Nxg7+ 0:25:35.8 6.2; Kd8 0:24:34.8 12;
    Ne6+ 0:25:29.2 31.6; Ke8 0:24:51.9 7.9; Bxh6 0:25:01.9 52.3; Nf6 0:25:06.9 10;
    Nc3 0:25:11.6 15.3; Kf7 0:23:58 93.9; d5 0:25:33.1 3.5; c6 0:23:30.4 52.6;
    O-O 0:25:50.5 7.6; cxd5 0:23:46.8 8.6; exd5 0:26:06.7 8.8; Qc4 0:22:18.8 113;
    Ng5+ 0:25:59.8 31.9; Ke8 0:22:33.3 10.5; Qe6 0:26:20.3 4.5; Qg4 0:21:43.4 74.9;
    Qf7+ 0:26:03.6 41.7; Kd7 0:21:58 10.4; Rae1 0:25:44.4 44.2; Rae8 0:21:51.8 31.2;
    Re6 0:25:49.2 20.2; Qd4 0:20:58.7 78.1; Rfe1 0:26:06.1 8.1; Ng4 0:20:26.8 56.9;
    Rxe7+ 0:26:24.7 6.4; Rxe7 0:20:43.4 8.4; Rxe7+ 0:26:28.9 20.8; Kc8 0:20:50 18.4;
    Re8+ 0:26:35.4 18.5; Rxe8 0:21:03.5 11.5; Qxe8+ 0:26:16 44.4; Kc7 0:21:21.3 7.2;
    Ne6+ 0:26:03.6 37.4; Kb6 0:21:30 16.3; Qb5# 0:26:01.9 26.7;
"""
GOLDEN_MOVES = [tuple(item.split()) for item in GOLDEN.replace("\n", " ").split(";") if item.strip()]
GOLDEN_FINAL = "8/pp5p/1k1pN1pB/1Q1P4/3q2n1/2N5/PPP2PPP/6K1"

# A mated game, moves only (fixed values).
MATED = (
    "e4 e5 Nf3 Nc6 Bb5 Nf6 O-O Nxe4 d4 Nd6 Bg5 Be7 Bxe7 Nxe7 dxe5 Nxb5 a4 O-O axb5 Ng6 Nc3 b6 "
    "Qd5 c6 bxc6 dxc6 Qxc6 Be6 Rad1 Qc8 Qe4 Bf5 Qe3 Qb7 Nd4 Be6 f4 Bc4 Rfe1 Ne7 f5 Nd5 Nxd5 "
    "Bxd5 f6 gxf6 Nf5 Kh8 Qh6 Rg8 Qxf6+ Rg7 Qxg7#"
)

def numbered(moves, clocks=None):
    """Move text, each move numbered, with clock notes if given."""
    parts = []
    for i, san in enumerate(moves):
        parts.append(f"{i // 2 + 1}{'.' if i % 2 == 0 else '...'} {san}")
        if clocks and clocks[i]:
            parts.append("{[%clk " + clocks[i] + "]}")
    return " ".join(parts)


def game_text(moves, clocks=None, headers=(), score="1-0"):
    lines = [f'[{name} "{value}"]' for name, value in headers]
    return "\n".join(lines or ['[Event "Test"]']) + "\n\n" + numbered(moves, clocks) + f" {score}\n"

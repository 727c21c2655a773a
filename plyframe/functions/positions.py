"""Expressions over position texts (``board side castling en-passant clocks``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plyframe.functions.text import letter_count, part

# Thresholds of the phase ladder.
SPARSE_BACK_RANK = 4
MIDGAME_PIECES = 10
ENDGAME_PIECES = 6

PIECES = "PNBRQpnbrq"  # kings never leave the board


def square_name(number: Column) -> Column:
    """0..63 (a1 = 0) to its name, '-' for -1."""
    return F.when(number < 0, F.lit("-")).otherwise(
        F.concat(
            F.substring(F.lit("abcdefgh"), number % 8 + 1, F.lit(1)),
            F.floor(number / 8 + 1).cast("string"),
        )
    )


def squares(position: Column) -> Column:
    """The board field spelled out: 64 characters, '.' for an empty square."""
    board = F.replace(part(position, " ", 1), F.lit("/"), F.lit(""))
    for run in range(1, 9):
        board = F.replace(board, F.lit(str(run)), F.lit("." * run))
    return board


def lost_letter(before: Column, after: Column, letters: str = PIECES) -> Column:
    """First letter of ``before`` that occurs less often in ``after``; NULL if none.

    The set difference of the letters, counted: a pawn that promotes is lost too.
    """

    def without(text: Column, letter: str) -> Column:
        return F.length(F.replace(text, F.lit(letter), F.lit("")))

    shrunk = F.length(before) - F.length(after)
    places = [
        F.when(
            without(before, letter) - without(after, letter) < shrunk, F.instr(before, letter)
        )
        for letter in letters
    ]
    return F.when(before != "", F.substring(before, F.least(*places), F.lit(1)))


def piece_counts(position: Column) -> dict[str, Column]:
    """Pieces (no pawns, no kings) on the board, and on each side's own back rank."""
    board = part(position, " ", 1)
    return rank_counts(board, part(board, "/", 1), part(board, "/", -1))


def rank_counts(board: Column, black_rank: Column, white_rank: Column) -> dict[str, Column]:
    return {
        "major_minor_cnt": letter_count(board, "rnbqRNBQ").cast("long"),
        "black_major_minor": letter_count(black_rank, "rnbq").cast("long"),
        "white_major_minor": letter_count(white_rank, "RNBQ").cast("long"),
    }


def phase_ladder(total: Column, black: Column, white: Column) -> dict[str, Column]:
    """Sparse back rank -> midgame -> endgame, and the label of the last rung reached."""
    sparse = (black < SPARSE_BACK_RANK) | (white < SPARSE_BACK_RANK)
    midgame = (total <= MIDGAME_PIECES) | sparse
    endgame = midgame & (total <= ENDGAME_PIECES)
    return {
        "is_backrank_sparse": sparse,
        "is_midgame": midgame,
        "is_endgame": endgame,
        "game_phase": F.when(endgame, "Endgame").when(midgame, "Midgame").when(total.isNotNull(), "Opening"),
    }

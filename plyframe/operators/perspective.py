"""Two-sided rows seen from one side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pick(first_side: Column, first: Column, second: Column) -> Column:
    """``first`` where the condition holds, else (also when it is unknown) ``second``."""
    return F.when(first_side, first).otherwise(second)


def both_sides(first_side: Column, first: str, second: str, fields: dict[str, str]) -> dict[str, Column]:
    """``player_<name>`` / ``opponent_<name>`` from ``<first><field>`` / ``<second><field>``."""
    columns = {}
    for name, field in fields.items():
        a, b = F.col(first + field), F.col(second + field)
        columns[f"player_{name}"] = pick(first_side, a, b)
        columns[f"opponent_{name}"] = pick(first_side, b, a)
    return columns


def outcome(own: Column, other: Column) -> Column:
    """win / lose / draw; 'unknown' only where a result is NULL."""
    return (
        F.when(own == "win", "win")
        .when(other == "win", "lose")
        .when((own != "win") & (other != "win"), "draw")
        .otherwise("unknown")
    )


def outcome_reason(own: Column, other: Column) -> Column:
    """What ended it: the loser's (or, in a draw, the own) result."""
    return pick(own == "win", other, own)

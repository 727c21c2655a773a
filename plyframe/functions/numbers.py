"""Rounding and binning with the results a SQL engine on doubles gives."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_number(number: Column) -> Column:
    """Double to int, half to even (a plain cast would cut the fraction off)."""
    return F.rint(number).cast("int")


def round_to(number: Column, digits: int) -> Column:
    """Half away from zero on the scaled double (``F.round`` rounds its decimal text instead)."""
    return F.round(number * 10**digits) / 10**digits


def binned(number: Column, width: int) -> Column:
    """Lower edge of the bin, as a double."""
    return (F.floor(number / width) * width).cast("double")

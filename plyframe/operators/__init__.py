"""Operators over any table: windows, rankings, shares, pivots, attacks, checks."""

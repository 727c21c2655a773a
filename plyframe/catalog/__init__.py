"""Queries over the given tables: every operator on its own, and the game tables end to end."""

"""The data checks that go with each table of the pipeline."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from plyframe.operators import quality

# Columns that must be filled, keys, and accepted values, per table.
NOT_NULL = {
    "stg_player_games": [
        "end_time", "pgn", "time_control", "game_uuid", "time_class", "rules",
        "white__result", "white__username", "black__result", "black__username",
    ],
    "prep_player_games": [
        "game_uuid", "time_control_base", "time_control_add_seconds", "pgn_moves",
        "pgn_move_extract", "pgn_clock_extract", "pgn_move_extract_string",
        "game_analysis_url", "player_color", "player_result",
        "player_wdl_reason", "game_start_timestamp",
    ],
    "prep_game_moves": ["id", "game_uuid"],  # and fen, game_phase where positions are given
    "games": ["game_uuid", "time_control"],
}
UNIQUE = {
    "stg_player_games": "game_uuid",
    "prep_player_games": "game_uuid",
    "prep_game_moves": "id",
    "games": "game_uuid",
}
RULES = ["chess", "chess960", "bughouse", "kingofthehill", "threecheck", "crazyhouse", "oddschess"]
OUTCOMES = ["win", "draw", "lose"]


def offending(name: str, table: DataFrame) -> dict[str, DataFrame]:
    """Every check of table ``name``; all results empty means the table is sound."""
    found = {
        "not_null": quality.null_counts(table, NOT_NULL[name]),
        "unique": quality.duplicates(table, UNIQUE[name]),
    }
    if name == "stg_player_games":
        found["accepted_rules"] = quality.unaccepted(table, "rules", RULES)
    if name == "prep_player_games":
        found["accepted_outcomes"] = quality.unaccepted(table, "player_wdl", OUTCOMES)
        found["mate_without_pieces"] = quality.unexplained_mates(table)
        found["pieces_without_mate"] = quality.unexpected_mates(table)
    return found


def check_table(name: str, table: DataFrame) -> None:
    """Run the checks; the first that finds something fails the run."""
    for check, rows in offending(name, table).items():
        quality.require_empty(f"{name}: {check}", rows)


# Rows with the same key adjoin wherever a table is hashed by these columns, as it is when it is written.
WITHIN = {
    "stg_player_games": ["game_uuid"],
    "prep_player_games": ["game_uuid"],
    "prep_game_moves": ["game_uuid", "id"],
    "games": ["game_uuid"],
}


def metrics(name: str, copies: str | None = None) -> dict[str, Column]:
    """Every check of table ``name`` as the number of rows that break it; ``copies`` numbers the rows of a key."""
    found = {f"not_null:{c}": F.count_if(F.col(c).isNull()) for c in NOT_NULL[name]}
    if copies:
        found["unique"] = F.count_if((F.col(copies) == 2) & F.col(UNIQUE[name]).isNotNull())
    if name == "stg_player_games":
        found["accepted_rules"] = F.count_if(~F.col("rules").isin(RULES))
    if name == "prep_player_games":
        mated = (F.col("player_result") == "checkmated") | (F.col("opponent_result") == "checkmated")
        plain = (F.col("player_result") != "checkmated") & (F.col("opponent_result") != "checkmated")
        found["accepted_outcomes"] = F.count_if(~F.col("player_wdl").isin(OUTCOMES))
        found["mate_without_pieces"] = F.count_if(mated & (F.size("checkmate_pieces") == 0))
        found["pieces_without_mate"] = F.count_if(plain & (F.size("checkmate_pieces") > 0))
    return found


@dataclass
class Watch:
    """What a table's checks find while its rows pass on to where they are written."""

    name: str
    seen: Observation

    def counts(self) -> dict[str, int]:
        """Rows that break each check.  Asked for after the write; a repeated task may count a row twice, never a sound one."""
        return {check: n or 0 for check, n in self.seen.get.items()}

    def require_sound(self, table: DataFrame) -> None:
        """Fail with examples if anything was found; only then is ``table`` read again, by the check in question."""
        found = [check for check, n in self.counts().items() if n]
        if found:
            exact = offending(self.name, table)
            for check in found:
                quality.require_empty(f"{self.name}: {check.split(':')[0]}", exact[check.split(":")[0]])
            raise quality.CheckFailed(f"{self.name}: {found}")


def repeated_keys(name: str, table: DataFrame) -> int:
    """Keys of table ``name`` that occur more than once; only the key column is read and hashed."""
    return quality.duplicates(table, UNIQUE[name]).count()


def watched(name: str, table: DataFrame, unique: bool = True) -> tuple[DataFrame, Watch]:
    """``table`` with its checks taken on the way, in the pass that writes it.

    Uniqueness numbers the rows of each key: where the rows are already hashed by the key (or, for moves, by their game)
    that is a sort inside each task and no exchange.  Without ``unique`` it is left to a later table of the same rows.
    """
    seen = Observation(f"{name}_checks")
    if not unique:
        return table.observe(seen, *[c.alias(n) for n, c in metrics(name).items()]), Watch(name, seen)
    keys = WITHIN[name]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    numbered = table.withColumn("__copy", place)
    return numbered.observe(seen, *[c.alias(n) for n, c in metrics(name, "__copy").items()]).drop("__copy"), Watch(name, seen)

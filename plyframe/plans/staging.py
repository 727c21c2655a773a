"""Typed view of the raw games."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns of the staging table, in order: (name, type, raw column if renamed).
COLUMNS = [
    ("end_time", "timestamp_ntz"),
    ("url", "string"),
    ("pgn", "string"),
    ("time_control", "string"),
    ("rated", "boolean"),
    ("accuracies__white", "double"),
    ("accuracies__black", "double"),
    ("tcn", "string"),
    ("game_uuid", "string", "uuid"),
    ("initial_setup", "string"),
    ("fen", "string"),
    ("time_class", "string"),
    ("rules", "string"),
    ("white__rating", "int"),
    ("white__result", "string"),
    ("white__aid", "string"),
    ("white__username", "string"),
    ("white__uuid", "string"),
    ("black__rating", "int"),
    ("black__result", "string"),
    ("black__aid", "string"),
    ("black__username", "string"),
    ("black__uuid", "string"),
    ("_dlt_load_id", "double"),
    ("_dlt_id", "string"),
]


def stage_games(raw: DataFrame) -> DataFrame:
    """Cast and rename; standard games only.

    Columns that need neither pass through as they are: an alias per column would make
    the optimizer restate every constraint on them in all combinations.
    """
    if dict(raw.dtypes)["end_time"] == "bigint":
        raw = raw.withColumn("end_time", F.timestamp_seconds("end_time"))
    kinds = dict(raw.dtypes)
    columns = []
    for name, kind, *renamed in COLUMNS:
        source = renamed[0] if renamed else name
        plain = kinds[source] == kind and not renamed
        columns.append(F.col(name) if plain else F.col(source).cast(kind).alias(name))
    return raw.filter(F.col("rules") == "chess").select(*columns)

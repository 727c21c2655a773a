"""Landing folder of raw archives: ``<root>/username=<u>/year=<y>/month=<m>/*.json``.

Each document holds the games of one player and month: ``{"games": [...]}``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plyframe.sources.contract import CORRUPT, RECORD

ARCHIVE = T.StructType(
    [
        T.StructField("games", T.ArrayType(RECORD), True),
        T.StructField(CORRUPT, T.StringType(), True),
    ]
)


def _filesystem(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def list_archives(spark: SparkSession, root: str, username: str) -> list[str]:
    """A player's month folders, oldest first; none if there is no such player."""
    fs, folder = _filesystem(spark, f"{root}/username={username}")
    if not fs.exists(folder):
        return []
    months = fs.globStatus(
        spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, "year=*/month=*")
    )
    return sorted(str(status.getPath().toString()) for status in months)


def existing(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """Drop archives that are not there; a path that cannot be checked still fails."""
    found = []
    for path in paths:
        fs, jpath = _filesystem(spark, path)
        if fs.exists(jpath):
            found.append(path)
    return found


def read_documents(
    spark: SparkSession, paths: list[str] | str, base: str | None = None, multi_line: bool = False
) -> DataFrame:
    """Archive documents, one per line (or one per file); the folders give username, year, month."""
    reader = (
        spark.read.schema(ARCHIVE)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", multi_line)
        .option("recursiveFileLookup", False)
        .option("ignoreMissingFiles", True)
    )
    if base is not None:
        reader = reader.option("basePath", base)
    return reader.json(paths)


def games_of(documents: DataFrame) -> DataFrame:
    """One row per game; a document without games gives none, an unreadable one fails."""
    readable = F.when(
        F.col(CORRUPT).isNotNull(),
        F.raise_error(F.concat(F.lit("unreadable archive: "), F.substring(CORRUPT, 1, 200))).cast("boolean"),
    ).otherwise(True)
    games = F.coalesce("games", F.array().cast(documents.schema["games"].dataType))
    return documents.filter(readable).select(F.explode(games).alias("game")).select("game.*")


def read_games(
    spark: SparkSession,
    root: str,
    username: str,
    paths: Iterable[str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """All games of a player's archives (or of the given ones that exist)."""
    folders = existing(spark, paths) if paths is not None else list_archives(spark, root, username)
    if not folders:
        return spark.createDataFrame([], RECORD)
    return games_of(read_documents(spark, folders, root, multi_line))

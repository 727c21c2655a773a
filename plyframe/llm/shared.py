"""Small helpers of the operators: tables, shared scratch tables, components of a graph."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship(context: SparkContext) -> None:
    """Send this package to the executors once per application, as ``--py-files`` would."""
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp()) / f"{package.name}-{uuid.uuid4().hex[:8]}.zip"
    with zipfile.ZipFile(path, "w") as out:
        for module in sorted(package.rglob("*.py")):
            out.write(module, module.relative_to(package.parent))
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)


def prepare(spark: SparkSession, rows: int = 256) -> None:
    """Before Python runs on executors: the package is there, and Arrow batches are small.

    Documents can be long, and a batch of them must fit a Python worker many times.
    """
    ship(spark.sparkContext)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder; below the warehouse where none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir") + "/_scratch"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage, survives lost executors."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Components of the graph with edges (a, b): one row (node, root) per node that isn't its root.

    Alternates large-star and small-star steps until nothing changes; the root is the smallest
    node.  Each round is two grouped minima and two joins on written tables; a node of high degree
    is grouped map-side and its rows can be split in the joins.  Self loops and repeated edges
    are ignored; a graph without edges gives no rows.
    """
    tidy = edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
    stars = written(tidy.where("lo < hi").distinct(), name)
    seen = None
    while True:
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()
        if state == seen:
            return stars.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        seen = state
        if not state[0]:
            return stars.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        both = stars.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            stars.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct()
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        near = large.join(lowest, "hi")
        small = near.select(F.col("m").alias("lo"), F.col("lo").alias("hi")).where("lo < hi").unionByName(
            lowest.select(F.col("m").alias("lo"), "hi")
        )
        stars = written(small.distinct(), name)

"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Naive timestamps are read and shown in UTC everywhere.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Methods above this size are not compiled by the JVM; split such stages instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "plyframe", **options: str) -> SparkSession:
    """A session with the library's settings; ``options`` override them."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **options}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; where it names none, one below the warehouse, which is shared too."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"

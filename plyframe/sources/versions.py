"""Tables that are replaced together: one manifest a version, committed by one atomic move.

Every version is a file ``_versions/<number>.json`` below the root; it names each table's folder and, where there
is one, the catalog table over it.  A writer fills new folders, writes its manifest under a name that readers do not look
at, and moves it to the next number.  The move either happens or not, and fails if the number is taken: whatever a writer
dies in, readers find the old version or the new one, whole, and of two writers that began at the same version one
is told so.  A reader takes a version once and reads all its tables through it; later versions do not touch their files until
``expire`` removes them.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

FOLDER = "_versions"


class Conflict(RuntimeError):
    """Another writer committed since this one looked."""


@dataclass(frozen=True)
class Version:
    number: int
    run: str
    tables: dict[str, dict[str, str]] = field(default_factory=dict)  # name -> path, table

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """One table of this version; through the catalog where that knows it, which keeps its buckets."""
        entry = self.tables[name]
        known = entry.get("table")
        return spark.table(known) if known and spark.catalog.tableExists(known) else spark.read.parquet(entry["path"])

    def publish(self, spark: SparkSession) -> None:
        """All tables as temporary views of this session, under their names without schema."""
        for name in self.tables:
            self.read(spark, name).createOrReplaceTempView(name.rsplit(".", 1)[-1])


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, root: str):
    return _path(spark, root).getFileSystem(spark._jsc.hadoopConfiguration())


def _write(spark: SparkSession, path: str, text: str) -> None:
    out = _files(spark, path).create(_path(spark, path), False)
    try:
        out.write(bytearray(text.encode()))
        out.hsync()
    finally:
        out.close()


def _move(spark: SparkSession, source: str, target: str) -> bool:
    """Atomic; False if the target is there already."""
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, target).toUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(_path(spark, source), _path(spark, target), none)
    except Exception:
        if _files(spark, target).exists(_path(spark, target)):
            return False
        raise
    return True


def _manifest(root: str, number: int) -> str:
    return f"{root}/{FOLDER}/{number:012d}.json"


def numbers(spark: SparkSession, root: str) -> list[int]:
    """All committed versions, oldest first; unfinished manifests are not among them."""
    files, folder = _files(spark, root), _path(spark, f"{root}/{FOLDER}")
    if not files.exists(folder):
        return []
    names = (status.getPath().getName() for status in files.listStatus(folder))
    return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())


def version(spark: SparkSession, root: str, number: int | None = None) -> Version | None:
    """The latest version, or that of ``number``; None if there is none."""
    known = numbers(spark, root)
    number = number if number is not None else (known[-1] if known else None)
    if number is None or number not in known:
        return None
    text = "\n".join(r.value for r in spark.read.text(_manifest(root, number), wholetext=True).collect())  # one small file
    held = json.loads(text)
    return Version(held["version"], held["run"], held["tables"])


def commit(spark: SparkSession, root: str, run: str, tables: dict[str, dict[str, str]], after: int | None) -> Version:
    """Make ``tables`` the version that follows ``after`` (None: the first); ``Conflict`` if that exists already."""
    number = (after or 0) + 1
    body = json.dumps({"version": number, "run": run, "tables": tables}, indent=1, sort_keys=True)
    draft = f"{root}/{FOLDER}/_{run}-{uuid.uuid4().hex[:8]}"
    _write(spark, draft, body)
    if not _move(spark, draft, _manifest(root, number)):
        raise Conflict(f"version {number} of {root} was committed by another run")
    return Version(number, run, tables)


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Remove all but the latest ``keep`` versions: first the manifest, so that no reader finds it, then what only it names."""
    known = numbers(spark, root)
    old, kept = known[: -keep or len(known)] if keep else known, known[-keep:] if keep else []
    still = {entry["path"] for n in kept for entry in version(spark, root, n).tables.values()}
    files = _files(spark, root)
    for n in old:
        gone = version(spark, root, n)
        files.delete(_path(spark, _manifest(root, n)), False)
        for entry in gone.tables.values():
            if entry["path"] not in still:
                if entry.get("table"):
                    spark.sql(f"DROP TABLE IF EXISTS {entry['table']}")
                files.delete(_path(spark, entry["path"]), True)
    return old

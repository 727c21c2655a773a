"""Versions of tables: whatever a writer dies in, a reader has one whole version."""

import pytest

from plyframe.sources import versions


class Killed(Exception):
    pass


def write(spark, root, run, rows):
    """A run of three tables that must agree, committed together."""
    former = versions.version(spark, root)
    entries = {}
    for name in ("a", "b", "s.c"):
        path = f"{root}/{name}/{run}"
        spark.range(rows).withColumn("run", __import__("pyspark").sql.functions.lit(run)).write.parquet(path)
        entries[name] = {"path": path}
    return versions.commit(spark, root, run, entries, former.number if former else None)


def whole(spark, root):
    """(run, rows) that all tables of the current version agree on."""
    now = versions.version(spark, root)
    if now is None:
        return None
    seen = {(r.run, now.read(spark, n).count()) for n in now.tables for r in now.read(spark, n).select("run").distinct().collect()}
    assert len(seen) == 1 and len(now.tables) == 3
    return seen.pop()


@pytest.mark.parametrize("first", [False, True])
@pytest.mark.parametrize("step", ["_write", "_move"])
@pytest.mark.parametrize("when", ["before", "half", "after"])
def test_a_killed_switch(spark, tmp_path, monkeypatch, first, step, when):
    root = str(tmp_path / "t")
    if not first:
        write(spark, root, "old", 3)
    before = whole(spark, root)
    plain = getattr(versions, step)

    def dying(session, path, more):
        if when == "after":
            plain(session, path, more)
        if when == "half" and step == "_write":
            plain(session, path, more[: len(more) // 2])  # a manifest cut off in the middle
        raise Killed

    monkeypatch.setattr(versions, step, dying)
    with pytest.raises(Killed):
        write(spark, root, "new", 5)
    monkeypatch.undo()
    moved = step == "_move" and when == "after"
    assert whole(spark, root) == (("new", 5) if moved else before)
    # What the dead writer left does not stop the next one.
    write(spark, root, "next", 7)
    assert whole(spark, root) == ("next", 7)


def test_pinned_readers_conflicts_and_expiry(spark, tmp_path):
    root = str(tmp_path / "t")
    assert versions.version(spark, root) is None and versions.expire(spark, root) == []
    first = write(spark, root, "r1", 1)
    pinned = versions.version(spark, root)
    write(spark, root, "r2", 2)
    assert pinned == first and pinned.read(spark, "a").count() == 1
    with pytest.raises(versions.Conflict):
        versions.commit(spark, root, "late", {}, 1)
    assert whole(spark, root) == ("r2", 2)
    write(spark, root, "r3", 3)
    assert versions.expire(spark, root, keep=2) == [1] and versions.numbers(spark, root) == [2, 3]
    assert versions.version(spark, root, 1) is None and versions.version(spark, root, 2).read(spark, "s.c").count() == 2
    assert not (tmp_path / "t/a/r1").exists() and (tmp_path / "t/a/r2").exists()
    versions.version(spark, root).publish(spark)
    assert spark.sql("SELECT count(*) AS n FROM c JOIN a USING (id)").first().n == 3

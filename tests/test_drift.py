"""Records that drift: fields, problems and the report, on odd texts."""

from pyspark.sql import functions as F

from plyframe.sources import drift

CONTRACT = [drift.Path("id", "$.id", "bigint", required=True), drift.Path("city", "$.at.city", "string"), drift.Path("tags", "$.tags", "array<string>")]
TEXTS = [
    ('{"id": 1, "at": {"city": "x"}, "tags": ["a"]}', []),
    ('{"id": "7"}', []),  # castable
    ('{"id": "seven", "tags": 3}', ["id: STRING for bigint", "tags: BIGINT for array<string>"]),
    ('{"id": null, "new": {"deep": 1}}', ["id: missing"]),
    ("{}", ["id: missing"]),
    ("[1]", ["no object"]),
    ('{"id": ', ["unreadable"]),
    ("", ["unreadable"]),
    (None, ["unreadable"]),
]


def test_split_and_report(spark):
    df = spark.createDataFrame([(i, t, "z") for i, (t, _) in enumerate(TEXTS)], "n int, text string, extra string")
    checked = {r.n: r for r in drift.conformed(df, "text", CONTRACT).collect()}
    assert [list(checked[i].problems) for i in range(len(TEXTS))] == [p for _, p in TEXTS]
    assert (checked[0].id, checked[0].city, checked[0].tags) == (1, "x", ["a"]) and checked[1].id == 7
    sound, aside = drift.split(df, "text", CONTRACT)
    assert sorted(r.n for r in sound.collect()) == [0, 1] and aside.columns == ["n", "text", "extra", "problems"] and aside.count() == 7
    got = {(r.field, r.found): (r.expected, r.records) for r in drift.report(df, "text", CONTRACT).collect()}
    assert got[("id", "BIGINT")] == ("bigint", 1) and got[("id", "STRING")] == ("bigint", 2) and got[("id", "VOID")] == ("bigint", 1)
    assert got[("new", "OBJECT<deep: BIGINT>")] == (None, 1) and got[("tags", "BIGINT")] == ("array<string>", 1)
    merged = drift.merged_schema(df.where(F.col("n") < 2), "text").first().schema
    assert merged.startswith("OBJECT<") and "tags: ARRAY<STRING>" in merged
    assert drift.report(df.limit(0), "text", CONTRACT).count() == 0

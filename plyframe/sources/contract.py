"""Record contract of the archive: schema, row rules, flattening and lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Field names and kinds of the archive's records.
SIDE = T.StructType(
    [
        T.StructField("rating", T.IntegerType(), False),
        T.StructField("result", T.StringType(), False),
        T.StructField("@id", T.StringType(), False),
        T.StructField("username", T.StringType(), False),
        T.StructField("uuid", T.StringType(), False),
    ]
)
RECORD = T.StructType(
    [
        T.StructField("url", T.StringType(), False),
        T.StructField("rules", T.StringType(), False),
        T.StructField("pgn", T.StringType(), True),
        T.StructField("time_control", T.StringType(), False),
        T.StructField("end_time", T.LongType(), False),  # seconds since 1970, UTC
        T.StructField("rated", T.BooleanType(), False),
        T.StructField(
            "accuracies",
            T.StructType(
                [
                    T.StructField("white", T.DoubleType(), True),
                    T.StructField("black", T.DoubleType(), True),
                ]
            ),
            True,
        ),
        T.StructField("tcn", T.StringType(), False),
        T.StructField("uuid", T.StringType(), False),
        T.StructField("initial_setup", T.StringType(), False),
        T.StructField("fen", T.StringType(), False),
        T.StructField("time_class", T.StringType(), False),
        T.StructField("white", SIDE, False),
        T.StructField("black", SIDE, False),
    ]
)
CORRUPT = "_corrupt_record"


def required_paths(schema: T.StructType, prefix: str = "") -> list[str]:
    """Dotted paths of the non-nullable fields, nested ones included."""
    paths = []
    for field in schema.fields:
        name = f"{prefix}`{field.name}`"
        if not field.nullable:
            paths.append(name)
            if isinstance(field.dataType, T.StructType):
                paths += required_paths(field.dataType, f"{name}.")
    return paths


def rule(broken: Column, message: str) -> Column:
    """A rule: its message where it is broken, else NULL."""
    return F.when(broken, F.lit(message))


def required(schema: T.StructType) -> list[Column]:
    """One rule per required field."""
    return [
        rule(F.col(path).isNull(), f"{path.replace('`', '')} is required")
        for path in required_paths(schema)
    ]


def text_rule(rules: str = "rules", text: str = "pgn") -> Column:
    """Only bughouse games may lack their text."""
    return rule(
        ~F.col(rules).eqNullSafe("bughouse") & F.col(text).isNull(),
        f"{text} is required for non-bughouse games",
    )


def with_problems(records: DataFrame, schema: T.StructType, *rules: Column) -> DataFrame:
    """Add ``problems``: what a record breaks, '' for a valid one."""
    return records.withColumn("problems", F.concat_ws("; ", *required(schema), *rules))


def kept_here(condition: Column) -> Column:
    """Keep a wide condition out of constraint inference.

    The optimizer rewrites a filter's condition for every later alias of a column in it:
    with some twenty columns renamed by ``flatten`` that is 2^20 variants.  A condition
    that is not deterministic is left where it stands.
    """
    return F.when(F.monotonically_increasing_id() >= 0, condition)


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records that keep the contract, rejected records with their problems)."""
    good = F.col("problems") == ""
    return checked.filter(kept_here(good)).drop("problems"), checked.filter(kept_here(~good))


def require_valid(checked: DataFrame) -> DataFrame:
    """Fail the job at the first record that breaks the contract."""
    message = F.concat(F.lit("record breaks the contract: "), F.col("problems"))
    valid = F.when(F.col("problems") == "", True).otherwise(F.raise_error(message).cast("boolean"))
    return checked.filter(kept_here(valid)).drop("problems")


def flatten(records: DataFrame) -> DataFrame:
    """Nested structs to ``parent__child`` columns (``@id`` becomes ``aid``)."""

    def leaves(schema: T.StructType, path: str, name: str) -> list[Column]:
        columns = []
        for field in schema.fields:
            inner = f"{path}`{field.name}`"
            label = name + field.name.replace("@", "a")
            if isinstance(field.dataType, T.StructType):
                columns += leaves(field.dataType, f"{inner}.", f"{label}__")
            else:
                columns.append(F.col(inner).alias(label))
        return columns

    return records.select(*leaves(records.schema, "", ""))


def with_lineage(
    records: DataFrame, load_id: float, identity: tuple[str, ...] = ("url", "uuid", "end_time")
) -> DataFrame:
    """Load id and a hash of what identifies a record, the same when a lost task is run again."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in identity])
    return records.withColumns({"_dlt_load_id": F.lit(float(load_id)), "_dlt_id": F.sha2(text, 256)})

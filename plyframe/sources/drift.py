"""Semi-structured records whose shape drifts: parsed once, read under a contract, the rest told and set aside.

A record's text is parsed once into a VARIANT.  Fields of the contract are cut out by path and type; records that
cannot be read, lack a required field or hold a value that is not of the field's type are set aside with the
reasons; fields that the contract does not know, and types beside the expected one, are counted in a report.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DOC = "__doc"
PROBLEMS = "problems"


@dataclass(frozen=True)
class Path:
    """A field of the contract: where it is, what it becomes."""

    name: str
    path: str
    type: str
    required: bool = False

    def typed(self) -> Column:
        return F.try_variant_get(DOC, self.path, self.type)

    def raw(self) -> Column:
        return F.try_variant_get(DOC, self.path, "variant")

    def problem(self) -> Column:
        """NULL if the field is in order; a value that is JSON's null counts as missing."""
        there = self.raw().isNotNull() & ~F.is_variant_null(self.raw())
        wrong = F.concat(F.lit(f"{self.name}: "), F.schema_of_variant(self.raw()), F.lit(f" for {self.type}"))
        missing = F.lit(f"{self.name}: missing") if self.required else F.lit(None).cast("string")
        return F.when(there & self.typed().isNull(), wrong).when(~there, missing)


def parsed(df: DataFrame, text: str) -> DataFrame:
    """Adds the record as a VARIANT, NULL where the text is none."""
    return df.withColumn(DOC, F.try_parse_json(text))


def conformed(df: DataFrame, text: str, contract: Sequence[Path]) -> DataFrame:
    """Adds the contract's fields and ``problems``, an empty list for a sound record; a NULL text is an unreadable one."""
    own = parsed(df, text)
    is_object = F.startswith(F.schema_of_variant(DOC), F.lit("OBJECT"))
    whole = F.when(F.col(DOC).isNull(), "unreadable").when(~is_object, "no object")
    fields = F.array_compact(F.array(*[f.problem() for f in contract])) if contract else F.array().cast("array<string>")
    return own.withColumns({**{f.name: f.typed() for f in contract}, PROBLEMS: F.when(whole.isNotNull(), F.array(whole)).otherwise(fields)}).drop(DOC)


def split(df: DataFrame, text: str, contract: Sequence[Path]) -> tuple[DataFrame, DataFrame]:
    """Sound records with their fields, and the others as they came, with their problems."""
    checked = conformed(df, text, contract)
    sound = F.size(PROBLEMS) == 0
    return checked.where(sound).drop(PROBLEMS), checked.where(~sound).select(*df.columns, PROBLEMS)


def merged_schema(df: DataFrame, text: str) -> DataFrame:
    """One row (schema): the least common schema of all records, merged map-side."""
    return parsed(df, text).agg(F.schema_of_variant_agg(DOC).alias("schema"))


def report(df: DataFrame, text: str, contract: Sequence[Path]) -> DataFrame:
    """(field, found, expected, records): every top-level field by the type it was found with.

    ``expected`` is the contract's type, NULL for a field it does not know.  Grouped before the shuffle, so it has a row per field, type and task.
    """
    known = F.lit(None).cast("string")
    for f in contract:
        known = F.when(F.col("field") == f.path.removeprefix("$."), f.type).otherwise(known)
    docs = parsed(df, text).select(DOC).where(F.col(DOC).isNotNull())
    docs = docs.where(F.startswith(F.schema_of_variant(DOC), F.lit("OBJECT")))
    each = docs.lateralJoin(df.sparkSession.tvf.variant_explode(F.col(DOC).outer()))
    counted = each.groupBy(F.col("key").alias("field"), F.schema_of_variant("value").alias("found")).agg(F.count(F.lit(1)).alias("records"))
    return counted.select("field", "found", known.alias("expected"), "records")

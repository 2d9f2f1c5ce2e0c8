"""What items really look like, beside the schema that is declared for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, NumericType, StructType

# First word of what Spark calls a variant's type, and the kind of JSON value it is.
KINDS = {
    "OBJECT": "object",
    "ARRAY": "array",
    "STRING": "string",
    "BOOLEAN": "boolean",
    "BIGINT": "number",
    "DECIMAL": "number",
    "DOUBLE": "number",
    "VOID": "null",
}


def _kind(declared: DataType) -> str:
    for kind, types in (("object", StructType), ("array", ArrayType), ("boolean", BooleanType), ("number", NumericType)):
        if isinstance(declared, types):
            return kind
    return "string"


def _levels(declared: StructType, path: str = "$") -> dict[str, dict[str, str]]:
    """Every object in the schema by its JSON path, with the kinds of its fields."""
    found = {path: {field.name: _kind(field.dataType) for field in declared.fields}}
    for field in declared.fields:
        if isinstance(field.dataType, StructType):
            found |= _levels(field.dataType, f"{path}.{field.name}")
    return found


def merged_type(items: DataFrame, text: str = "item_text") -> DataFrame:
    """One row: the type that holds every item, as Spark merges their types. Combined map-side."""
    return items.agg(F.schema_of_variant_agg(F.try_parse_json(text)).alias("merged_type"))


def field_kinds(items: DataFrame, declared: str, text: str = "item_text") -> DataFrame:
    """(path, field, kind, items) for every field found in an object that the schema knows.

    One pass; every item gives a row per field, counted before they are shuffled. An item that is no JSON object
    has no fields.
    """
    levels = _levels(StructType.fromDDL(f"item {declared}")["item"].dataType)
    whole = items.select(F.try_parse_json(text).alias("item"))
    objects = F.array(
        *(
            F.struct(F.lit(path).alias("path"), F.try_variant_get("item", path, "map<string, variant>").alias("fields"))
            for path in levels
        )
    )
    fields = whole.select(F.inline(objects)).select("path", F.explode("fields").alias("field", "value"))
    return fields.groupBy("path", "field", _kind_of(F.col("value")).alias("kind")).agg(F.count("*").alias("items"))


def _kind_of(value: Column) -> Column:
    """A JSON null comes out of a map as a variant that is null, or as null."""
    names = F.create_map(*(F.lit(x) for pair in KINDS.items() for x in pair))
    word = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    return F.coalesce(names[word], F.when(value.isNull(), "null").otherwise(F.lower(word)))


def schema_drift(items: DataFrame, declared: str, text: str = "item_text") -> DataFrame:
    """Fields that the declared schema lacks or has as another kind: (path, field, kind, declared_kind, items).

    ``declared_kind`` is null for a field that is not declared. A null fits every kind.
    """
    levels = _levels(StructType.fromDDL(f"item {declared}")["item"].dataType)
    known = F.create_map(
        *(F.lit(x) for path, fields in levels.items() for name, kind in fields.items() for x in (f"{path}.{name}", kind))
    )
    found = field_kinds(items, declared, text).withColumn("declared_kind", known[F.concat_ws(".", "path", "field")])
    fits = F.col("declared_kind").isNotNull() & F.col("kind").isin("null", F.col("declared_kind"))
    return found.filter(~fits).select("path", "field", "kind", "declared_kind", "items")

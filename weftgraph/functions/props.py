"""Property maps, type names and stable document ids as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The property type names of the data model.
TYPE_NAMES = ("INT64", "FLOAT64", "STRING", "BOOL", "BYTES", "TIMESTAMP", "VECTOR", "LIST", "MAP")
UNKNOWN_TYPE = "UNSPECIFIED"

INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATS = (T.FloatType, T.DoubleType)


def type_name(data_type: T.DataType) -> str:
    """Model type of a column; a list of numbers is a vector, any other list a list."""
    if isinstance(data_type, T.ArrayType):
        return "VECTOR" if isinstance(data_type.elementType, INTEGERS + FLOATS) else "LIST"
    if isinstance(data_type, (T.MapType, T.StructType)):
        return "MAP"
    groups = (
        (INTEGERS, "INT64"),
        (FLOATS, "FLOAT64"),
        ((T.StringType,), "STRING"),
        ((T.BooleanType,), "BOOL"),
        ((T.BinaryType,), "BYTES"),
        ((T.TimestampType, T.TimestampNTZType), "TIMESTAMP"),
    )
    for kinds, name in groups:
        if isinstance(data_type, kinds):
            return name
    return UNKNOWN_TYPE


def variant_type_name(value: Column) -> Column:
    """Model type of each VARIANT value, NULL for a missing or null one."""
    kind = F.schema_of_variant(value)
    numbers = kind.rlike(r"^ARRAY<(BIGINT|DOUBLE|FLOAT|DECIMAL.*)>$")
    return (
        F.when(kind.isNull() | (kind == "VOID"), F.lit(None).cast("string"))
        .when(kind == "BIGINT", "INT64")
        .when(kind.isin("DOUBLE", "FLOAT") | kind.startswith("DECIMAL"), "FLOAT64")
        .when(kind == "STRING", "STRING")
        .when(kind == "BOOLEAN", "BOOL")
        .when(kind == "BINARY", "BYTES")
        .when(kind.startswith("TIMESTAMP"), "TIMESTAMP")
        .when(numbers, "VECTOR")
        .when(kind.startswith("ARRAY"), "LIST")
        .when(kind.startswith("OBJECT"), "MAP")
        .otherwise(UNKNOWN_TYPE)
    )


def merge_props(old: Column | str, new: Column | str) -> Column:
    """``SET n += map``: the new value wins, a NULL one removes the property."""
    old = F.col(old) if isinstance(old, str) else old
    new = F.col(new) if isinstance(new, str) else new
    both = F.map_zip_with(old, new, lambda k, a, b: F.when(F.map_contains_key(new, k), b).otherwise(a))
    merged = F.when(new.isNull(), old).when(old.isNull(), new).otherwise(both)
    return F.map_filter(merged, lambda k, v: v.isNotNull())


def document_hash(content: Column | str, metadata: Column | None = None) -> Column:
    """First 32 hex digits of SHA-256 over canonical JSON of content and metadata."""
    content = F.col(content) if isinstance(content, str) else content
    if metadata is None:
        metadata = F.create_map().cast("map<string,string>")
    ordered = F.map_from_entries(F.array_sort(F.map_entries(metadata)))
    # Named explicitly: aliases inside struct() are lost in a select that also explodes.
    body = F.to_json(F.named_struct(F.lit("content"), F.coalesce(content, F.lit("")), F.lit("metadata"), ordered))
    return F.left(F.sha2(body, 256), F.lit(32))

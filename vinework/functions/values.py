"""Property values: JSON access, sanitising, excerpts, tagged-text ingest."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Lengths used for result texts and source excerpts.
MAX_TEXT = 1000
EXCERPT = 500

# Type tags that may follow a serialised value.
TYPE_TAGS = ("vertex", "edge", "path", "agtype", "integer", "float", "numeric", "boolean", "string")


def parse_bag(metadata: Column) -> Column:
    """JSON object text to a map of value texts; JSON null becomes null."""
    return F.from_json(metadata, "map<string,string>")


def json_value(metadata: Column, key: str) -> Column:
    """Text of one key; null when the key is absent or JSON null."""
    return F.try_element_at(parse_bag(metadata), F.lit(key))


def bag_keys(metadata: Column) -> Column:
    """Sorted keys of a JSON object text."""
    return F.array_sort(F.json_object_keys(metadata))


def excerpt(text: Column, length: int = EXCERPT) -> Column:
    return F.substring(text, 1, length)


def sanitise(value: Column, dtype: T.DataType, max_text: int = MAX_TEXT) -> Column:
    """Shorten long texts and drop ``_``-prefixed keys at every level."""
    if isinstance(dtype, T.StringType):
        cut = F.concat(F.substring(value, 1, max_text), F.lit("…"))
        return F.when(F.char_length(value) > max_text, cut).otherwise(value)
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda v: sanitise(v, dtype.elementType, max_text))
    if isinstance(dtype, T.MapType):
        kept = value
        if isinstance(dtype.keyType, T.StringType):
            kept = F.map_filter(value, lambda k, _: ~k.startswith("_"))
        return F.transform_values(kept, lambda _, v: sanitise(v, dtype.valueType, max_text))
    if isinstance(dtype, T.StructType):
        fields = [
            sanitise(value.getField(f.name), f.dataType, max_text).alias(f.name)
            for f in dtype.fields
            if not f.name.startswith("_")
        ]
        return F.when(value.isNotNull(), F.struct(*fields)) if fields else F.lit(None)
    return value


def sanitise_frame(df, max_text: int = MAX_TEXT):
    """Apply :func:`sanitise` to every column of a result."""
    kept = [f for f in df.schema.fields if not f.name.startswith("_")]
    return df.select(*(sanitise(F.col(f"`{f.name}`"), f.dataType, max_text).alias(f.name) for f in kept))


def untag(text: Column) -> Column:
    """Serialised value without surrounding blanks and trailing type tag."""
    pattern = "(?i)::(" + "|".join(TYPE_TAGS) + ")$"
    return F.regexp_replace(F.trim(text), pattern, "")


def parse_tagged(text: Column) -> Column:
    """Tagged text as ``struct<raw, value, kind>``.

    ``value`` is a VARIANT, null when the text is not JSON; ``raw`` is then
    the result and ``kind`` is ``text``.
    """
    raw = untag(text)
    value = F.try_parse_json(raw)
    shape = F.schema_of_variant(value)
    kind = (
        F.when(raw.isNull(), F.lit(None))
        .when(value.isNull(), "text")
        .when(shape.startswith("OBJECT"), "object")
        .when(shape.startswith("ARRAY"), "array")
        .when(shape == "BOOLEAN", "boolean")
        .when(shape == "STRING", "string")
        .when(shape == "VOID", "null")
        .otherwise("number")
    )
    return F.struct(raw.alias("raw"), value.alias("value"), kind.alias("kind"))

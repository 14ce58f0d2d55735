"""JSON in the JVM, by VARIANT. Invalid text and missing paths give NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_kind(v: Column) -> Column:
    """Kind of a VARIANT: OBJECT, ARRAY, STRING, NUMBER, BOOLEAN or VOID."""
    s = F.schema_of_variant(v)
    return (
        F.when(s.startswith("OBJECT"), "OBJECT").when(s.startswith("ARRAY"), "ARRAY")
        .when(s.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), "NUMBER").otherwise(s)
    )


def number_of(v: Column) -> Column:
    """Numbers, and booleans as 1 and 0; strings never become numbers."""
    return F.when(json_kind(v).isin("NUMBER", "BOOLEAN"), F.try_variant_get(v, "$", "double"))


def string_of(v: Column) -> Column:
    """The text of a JSON string, else NULL."""
    return F.when(json_kind(v) == "STRING", F.try_variant_get(v, "$", "string"))


def object_size(text: Column, path: str) -> Column:
    """Number of keys of an object at a path (repeated keys each count); NULL for
    anything that is no object."""
    return F.size(F.json_object_keys(F.get_json_object(text, path)))


def has_keys(text: Column, path: str) -> Column:
    """Whether there is an object with a key at a path; never NULL."""
    return F.coalesce(object_size(text, path) > 0, F.lit(False))


def is_valid_json(text: Column) -> Column:
    return F.try_parse_json(text).isNotNull()

"""Scalar functions: JSON typing, time and text conversions."""
from .jsons import has_keys, is_valid_json, json_kind, number_of, object_size, string_of
from .times import cast_naive, floor_naive, iso_micros, local_time, seconds_between, utc_text

__all__ = [
    "cast_naive", "floor_naive", "has_keys", "is_valid_json", "iso_micros", "json_kind", "local_time", "number_of",
    "object_size", "seconds_between", "string_of", "utc_text",
]

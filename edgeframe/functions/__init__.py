"""Column-expression helpers (all JVM built-ins; no Python UDFs)."""

from edgeframe.functions.scalar import (  # noqa: F401
    field, last_field, first_char, tail, pair_key, is_empty_flag, whitespace_fields,
    abs_diff, idiv, ratio, pick_larger, joined, sorted_join, append_value, contains_value,
    nearest_value,
)

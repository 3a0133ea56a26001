"""Column-level helpers (the scalar functions F1-F21).

All of them build JVM-side expressions; none is a Python UDF.
"""

from traitmatch.functions.scalar import (
    array_member,
    array_overlap_count,
    array_to_json,
    as_float,
    clamp,
    code_prefix,
    display_label,
    first_item,
    join_items,
    json_to_array,
    label_to_id,
    map_value,
    norm,
    null_if_zero,
    num_to_text,
    round_numeric,
    run_date_text,
    to_double,
)

__all__ = [
    "array_member", "array_overlap_count", "first_item", "array_to_json", "as_float", "clamp", "code_prefix", "display_label",
    "join_items", "json_to_array", "label_to_id", "map_value", "norm",
    "null_if_zero", "num_to_text", "round_numeric", "run_date_text", "to_double",
]

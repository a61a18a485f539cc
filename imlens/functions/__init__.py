"""Column expressions. Everything here compiles to JVM built-ins (whole-stage codegen)."""

from imlens.functions.paths import (
    bucket_and_key,
    decode_path,
    label_from_parent,
    label_from_set,
    label_under,
    set_name,
)
from imlens.functions.vectors import (
    as_array,
    as_vector,
    length_distribution,
    length_summary,
    long_form,
    vector_size,
)

__all__ = [
    "as_array",
    "as_vector",
    "bucket_and_key",
    "decode_path",
    "label_from_parent",
    "label_from_set",
    "label_under",
    "length_distribution",
    "length_summary",
    "long_form",
    "set_name",
    "vector_size",
]

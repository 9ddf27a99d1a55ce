"""Column expressions (all JVM-side, codegen-friendly)."""

from countwise.functions.hashing import (
    PRIME,
    BucketParams,
    LinearParams,
    SketchRow,
    bucket_params,
    color_params,
    edge_bucket,
    family_struct_array,
    hash_family,
    linear_hash,
    sign_hash,
    vertex_color,
)
from countwise.functions.stats import int_median
from countwise.functions.text import lines_of, space_tokens

__all__ = [
    "PRIME", "BucketParams", "LinearParams", "SketchRow", "bucket_params", "color_params",
    "edge_bucket", "family_struct_array", "hash_family", "linear_hash", "sign_hash",
    "vertex_color", "int_median", "lines_of", "space_tokens",
]

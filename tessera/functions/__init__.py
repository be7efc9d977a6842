"""Column expressions shared by the operators (all JVM-side built-ins)."""

from tessera.functions.columns import (
    fixed_field,
    hash_key,
    bucket_weight,
    one_vs_rest,
    positive_probability,
    safe_ratio,
    top_k_by_score,
    unquote,
    uniform,
    uniform_at,
)

__all__ = [
    "fixed_field",
    "hash_key",
    "bucket_weight",
    "one_vs_rest",
    "positive_probability",
    "safe_ratio",
    "top_k_by_score",
    "unquote",
    "uniform",
    "uniform_at",
]

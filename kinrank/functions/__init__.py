"""Column expressions shared by the operators (all JVM-side built-ins)."""

from kinrank.functions.columns import (  # noqa: F401
    clip,
    guarded_ratio,
    hash_bucket,
    in_train,
    overlap_from_sums,
    pearson_from_sums,
    cosine_from_sums,
    round6,
)

from pulsekit.functions.core import (
    as_col,
    clip_keep_null,
    ks_pvalue,
    nan_to_null,
    round_half_up,
    safe_ratio,
    secret,
    semver_key,
)

__all__ = [
    "as_col",
    "clip_keep_null",
    "ks_pvalue",
    "nan_to_null",
    "round_half_up",
    "safe_ratio",
    "secret",
    "semver_key",
]

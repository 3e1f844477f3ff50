"""What the two vector operators share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vec: str) -> Column:
    """Vectors that are not null, not zero and hold finite numbers only."""
    c = F.col(vec)
    fine = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(c, lambda x: x != 0), F.lit(False))


def unit(v: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; first by the largest component, so that squares neither overflow nor vanish."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))

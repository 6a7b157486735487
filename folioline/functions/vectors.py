"""Vector columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def has_width(vector: Column, width: int) -> Column:
    """True only for a vector of ``width`` elements, none of them NULL or NaN."""
    full = (F.size(vector) == width) & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x))
    return F.coalesce(vector.isNotNull() & full, F.lit(False))

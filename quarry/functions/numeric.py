"""Numeric expressions with engine-independent results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quantise(c: Column, digits: int = 2) -> Column:
    """Round half up to ``digits`` decimals using plain IEEE arithmetic
    (floor(x * 10^d + 0.5) / 10^d), so every engine gets the same value."""
    scale = 10 ** digits
    return F.floor(c * scale + 0.5) / scale

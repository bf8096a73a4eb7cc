"""Reproducible pseudo-random numbers: a function of the row key, not of the partitioning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def hash_key(key: str | Column, seed: int | str) -> Column:
    """32 hex digits that order the rows at random, the same way on every run."""
    col = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(col.cast("string"), F.lit(f"|{seed}")))


def unit_interval(hex_digits: Column, start: int = 1) -> Column:
    """Eight of the hex digits, from the 1-based position `start`, as a number in [0, 1)."""
    return F.conv(F.substring(hex_digits, start, 8), 16, 10).cast("double") / F.lit(4294967296.0)

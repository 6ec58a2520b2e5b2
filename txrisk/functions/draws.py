"""Deterministic, partition-independent pseudo-random draws (deviation D3).

A draw is the first 32 bits of ``md5("<key>|<seed>[|<stream>]")`` as a
non-negative integer, so every engine (Spark, DuckDB, pandas) reproduces it,
and it does not depend on partitioning, task order or retries.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEED = 42
TWO_32 = 4294967296.0


def draw(key: Column, stream: str | None = None, seed: int = SEED) -> Column:
    parts = [key.cast("string"), F.lit(str(seed))]
    if stream:
        parts.append(F.lit(stream))
    h = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long")


def uniform(key: Column, stream: str | None = None, seed: int = SEED) -> Column:
    """Draw scaled to [0, 1)."""
    return draw(key, stream, seed) / F.lit(TWO_32)

"""A seeded order that depends on the key alone, not on partitions or file layout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_hash(key: Column | str, seed: int) -> Column:
    """Hex md5 of ``seed:key``; sorting by it is the seeded shuffle."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))

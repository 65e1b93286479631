"""Seeded orderings and hash slots, equal on every engine that has md5."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_key(seed: int, purpose: str, *parts: Column | str) -> Column:
    """md5 of `seed:purpose:part:...`; sorting by it is the seeded shuffle."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(purpose), *[c.cast("string") for c in cols]))


def hash_slot(text: Column, size: Column | int) -> Column:
    """First 60 bits of md5(text), modulo `size`."""
    first, digits = 1, 15
    if isinstance(size, int) and size & (size - 1) == 0:
        # Modulo a power of two only the last hex digits count.
        digits = max(1, -(-(size.bit_length() - 1) // 4))
        first = 16 - digits
    n = F.lit(size) if isinstance(size, int) else size
    return F.conv(F.substring(F.md5(text), first, digits), 16, 10).cast("bigint") % n.cast("bigint")

"""A space-filling curve over small whole numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def curve_key(dims: list[tuple[Column, int]]) -> Column:
    """The place of a point on a Z-curve: the dimensions' bits, the highest first, taken in turn.

    Each dimension is a whole number and the number of bits that hold it. Rows close in every dimension
    get close keys, so a range of keys spans few values of each, and a file that holds such a range has narrow
    minima and maxima in all of them. NULL and negative values count as 0, larger ones as the largest. At most 62 bits in all.
    """
    if sum(bits for _, bits in dims) > 62:
        raise ValueError("the bits of all dimensions must fit in 62")
    values = [F.greatest(F.least(F.coalesce(c.cast("bigint"), F.lit(0)), F.lit(2 ** bits - 1)), F.lit(0)) for c, bits in dims]
    key, place = F.lit(0).cast("bigint"), 0
    for level in range(max(bits for _, bits in dims)):  # from the lowest bit up
        for value, (_, bits) in reversed(list(zip(values, dims, strict=True))):
            if level < bits:
                key = key + F.shiftleft(F.shiftright(value, level).bitwiseAND(F.lit(1)), place)
                place += 1
    return key

"""Sums of doubles that do not depend on the order or the grouping of the rows.

Every finite double is an integer multiple of a power of two. One narrow pass finds the smallest and the
largest magnitude of a column; between the last bit of the first and the first bit of the second lie a few
limbs of ``BITS`` bits. A value becomes one bigint per limb (exact: remainders of doubles by powers of two
are), limbs are added as bigints, and the sums become one double at the end, always in the same way. So
running, partial and merged sums agree in every bit. Limbs leave room for 2**39 rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 24
INF = float("inf")


@dataclass(frozen=True)
class Limbs:
    """How a column of doubles is cut: the exponent of its last bit, the number of limbs, and whether some are not finite."""

    low: int
    count: int
    special: bool

    def parts(self, value: Column) -> list[Column]:
        """One bigint per limb, the lowest first; then counts of NaN, inf and -inf if there are any. NULL gives NULLs."""
        x = value.cast("double")
        finite = F.abs(x) < INF
        found = []
        for k in range(self.count):
            unit = 2.0 ** (self.low + BITS * k)
            above = x if k == self.count - 1 else x % F.lit(2.0 ** (self.low + BITS * (k + 1)))
            below = x % F.lit(unit) if k else F.lit(0.0)
            found.append(F.when(finite, (above - below) / F.lit(unit)).cast("bigint"))
        if self.special:
            found += [F.when(x.isNotNull(), is_it.cast("bigint")) for is_it in (F.isnan(x), x == INF, x == -INF)]
        return found

    def total(self, sums: list[Column]) -> Column:
        """The double that sums of the parts stand for."""
        # Halves of 32 bits are exact as doubles. From the highest on, a sum that has to be rounded is so much
        # larger than all that follows that they can't cancel it.
        result = F.lit(0.0)
        for k in reversed(range(self.count)):
            high = F.shiftright(sums[k] + F.lit(2**31), 32)
            for half, bits in ((high, 32), (sums[k] - F.shiftleft(high, 32), 0)):
                exponent = self.low + BITS * k + bits
                term = half.cast("double") * F.lit(2.0 ** min(exponent, 1023))
                result = result + (term * F.lit(2.0 ** (exponent - 1023)) if exponent > 1023 else term)
        if not self.special:
            return result
        nan, plus, minus = (F.coalesce(s, F.lit(0)) for s in sums[self.count :])
        return (
            F.when((nan > 0) | ((plus > 0) & (minus > 0)), float("nan")).when(plus > 0, INF).when(minus > 0, -INF).otherwise(result)
        )


def measure(df: DataFrame, values: dict[str, Column]) -> dict[str, Limbs]:
    """The limbs of each column of doubles, from one pass over ``df`` without a shuffle of rows."""
    asked = []
    for name, value in values.items():
        size = F.abs(value.cast("double"))
        asked += [
            F.min(F.when((size > 0) & (size < INF), size)).alias(f"least_{name}"),
            F.max(F.when(size < INF, size)).alias(f"most_{name}"),
            F.count(F.when(~(size < INF), True)).alias(f"special_{name}"),
        ]
    row = df.agg(*asked).first() if values else {}
    found = {}
    for name in values:
        least, most = row[f"least_{name}"] or 1.0, row[f"most_{name}"] or 1.0
        low = max(-1074, math.frexp(least)[1] - 53)
        count = max(1, -(-(math.frexp(most)[1] - low) // BITS))
        found[name] = Limbs(low, count, row[f"special_{name}"] > 0)
    return found

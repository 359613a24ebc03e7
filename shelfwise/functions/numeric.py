"""Exact rounded means.

``round(avg(x), d)`` over doubles depends on the order in which partial
sums are combined; when the true mean sits on a rounding boundary (x.xx5)
the result can flip between runs, partitionings and engines. Where the inputs
carry at most ``in_decimals`` decimals (minutes, scores), the mean is
computed on exact integers instead: the sum of ``x * 10^in_decimals`` as a
bigint, then rounded half away from zero to ``out_decimals`` by integer
division - the same answer for any partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def scaled_sum(col: str | Column, in_decimals: int = 2) -> Column:
    """Aggregate: the exact integer sum of ``col * 10^in_decimals``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(F.round(c * F.lit(10 ** in_decimals)).cast("bigint"))


def mean_from_sums(s: Column, n: Column, in_decimals: int = 2, out_decimals: int = 2) -> Column:
    """Mean of values whose scaled integer sum is ``s`` and count ``n``,
    rounded half away from zero to ``out_decimals`` (a double). Sums and
    counts add up exactly, so partial results can be merged in any order."""
    num = (F.abs(s) * F.lit(2 * 10 ** (out_decimals - in_decimals)) + n).cast("decimal(38,0)")
    den = (n * F.lit(2)).cast("decimal(38,0)")
    units = ((num - F.pmod(num, den)) / den).cast("bigint")   # floor(num / den), exact
    return F.when(n > 0, F.signum(s).cast("bigint") * units / F.lit(float(10 ** out_decimals)))


def exact_mean(col: str | Column, in_decimals: int = 2, out_decimals: int = 2) -> Column:
    """Aggregate: mean of ``col`` rounded half away from zero to
    ``out_decimals`` (``>= in_decimals``), as a double. NULLs are ignored; no
    value gives NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return mean_from_sums(scaled_sum(c, in_decimals), F.count(c), in_decimals, out_decimals)

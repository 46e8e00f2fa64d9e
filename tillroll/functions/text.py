"""Text formatting helpers that print numbers the way Python's format()
does, using built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = 134217729.0  # 2**27 + 1, splits a double into two 26-bit halves


def round_binary_half_even(x, places: int) -> Column:
    """Round a double half-to-even *on its exact binary value* (Python's
    ``format(x, '.Nf')`` rule; e.g. 0.15 is stored just below 0.15 and
    becomes 0.1).

    p = x * 10^N is rounded once; the exact product is p + e, where the
    error e comes from an error-free (Dekker) product.  Only when p lands
    exactly on .5 does e decide the direction; otherwise rounding p is
    already right.
    """
    c = F.col(x) if isinstance(x, str) else x
    scale = float(10 ** places)
    p = c * F.lit(scale)
    hi = F.lit(_SPLIT) * c
    dh = hi - (hi - c)
    dl = c - dh
    err = (dh * F.lit(scale) - p) + dl * F.lit(scale)
    fl = F.floor(p).cast("double")
    tie = (p - fl) == F.lit(0.5)
    even = F.bround(p, 0)
    rounded = F.when(tie & (err > 0), fl + 1).when(tie & (err < 0), fl).otherwise(even)
    return rounded / F.lit(scale)


def fixed(x, places: int) -> Column:
    """``format(x, '.Nf')``."""
    return F.format_string(f"%.{places}f", round_binary_half_even(x, places))


def grouped(x, places: int) -> Column:
    """``format(x, ',.Nf')`` (thousands separators)."""
    return F.format_number(round_binary_half_even(x, places), places)


def grouped_int(x) -> Column:
    """``format(n, ',')`` for integers."""
    c = F.col(x) if isinstance(x, str) else x
    return F.format_number(c.cast("bigint"), 0)

"""Exact money arithmetic on integer cents.

Quotients of money (averages, shares, per-order values) are rounded with
integer arithmetic so that the result does not depend on floating-point
noise: half-up mirrors SQL ``ROUND``; half-even mirrors numpy/pandas
``round`` on exact decimal ties.  Money leaves the pipeline as a double
computed as ``cents / 100`` (one correctly rounded division), so every
engine that follows the same recipe produces the same bits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"
WIDE = "decimal(38,0)"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def idiv(a, b) -> Column:
    """Exact integral division (truncating) of integral operands; long result."""
    return _div(_c(a).cast(WIDE), _c(b).cast(WIDE))


def _div(a: Column, b: Column) -> Column:
    # ``div`` on decimal(38,0) operands is exact and returns a long.
    return F.call_function("div", a, b)


def to_cents(money) -> Column:
    """Exact integer cents of a scale-2 decimal money column (decimal(38,0))."""
    return (_c(money) * F.lit(100)).cast(WIDE)


def div_round(num, den, mode: str = "half_up") -> Column:
    """Round ``num / den`` to an integer exactly; ``den`` must be > 0.

    ``half_up`` rounds ties away from zero, ``half_even`` to the even
    neighbour.  Inputs are integral (long or decimal(p,0)); result is long.
    """
    n, d = _c(num).cast(WIDE), _c(den).cast(WIDE)
    a = F.abs(n)
    if mode == "half_up":
        mag = _div(a * 2 + d, d * 2)
    elif mode == "half_even":
        base = _div(a, d)
        twice_rem = (a - base.cast(WIDE) * d) * 2
        bump = (F.when(twice_rem > d, 1)
                .when((twice_rem == d) & (base % 2 == 1), 1)
                .otherwise(0))
        mag = base + bump
    else:
        raise ValueError(f"unknown rounding mode {mode!r}")
    return F.when(n < 0, -mag).otherwise(mag).cast("bigint")


def cents_to_double(cents) -> Column:
    """Integer cents as a double amount (cents / 100, correctly rounded)."""
    return _c(cents).cast("double") / F.lit(100.0)


def round_money_avg(sum_money, count, mode: str = "half_up") -> Column:
    """``round(sum / count, 2)`` for a decimal money sum, as double."""
    return cents_to_double(div_round(to_cents(sum_money), count, mode))


def round_ratio(num, den, scale: int, mode: str = "half_up") -> Column:
    """``round(num / den, scale)`` for integral ``num``/``den``, as double."""
    scaled = div_round(_c(num).cast(WIDE) * F.lit(10 ** scale), den, mode)
    return scaled.cast("double") / F.lit(float(10 ** scale))


def money_double(money) -> Column:
    """Decimal money to double at the presentation edge."""
    return _c(money).cast("double")


def np_round(x, places: int) -> Column:
    """numpy's ``round(x, places)`` on doubles: scale, round half-even, unscale."""
    scale = float(10 ** places)
    return F.bround(_c(x) * F.lit(scale), 0) / F.lit(scale)

"""Aggregate expressions with the null/zero-variance rules of the analyses."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_corr(x, y) -> Column:
    """Pearson r over rows where both are non-null; NULL (never an error or
    NaN) when either side has zero variance or fewer than two pairs.

    ``corr`` raises DIVIDE_BY_ZERO under ANSI for constant input, so the
    coefficient is assembled from population moments with ``try_divide``.
    """
    xc, yc = _c(x), _c(y)
    both = xc.isNotNull() & yc.isNotNull()
    xs = F.when(both, xc.cast("double"))
    ys = F.when(both, yc.cast("double"))
    return F.try_divide(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))


# ---- exact rounding ---------------------------------------------------
# Rounded means and ratios are computed from exact integer sums so the
# result does not depend on summation order (partial aggregation order
# differs between runs and engines) and ties round half away from zero.
def _dec(c) -> Column:
    return _c(c).cast("decimal(38,0)")


def round_div(num, den, digits: int = 6) -> Column:
    """num / den (integer-valued columns) rounded half-up to ``digits``."""
    scale = 10 ** digits
    n = _dec(num) * F.lit(scale).cast("decimal(38,0)")
    d = _dec(den)
    a = F.abs(n) * 2 + F.abs(d)
    b = F.abs(d) * 2
    q = ((a - F.pmod(a, b)) / b).cast("double")   # exact floor(a / b)
    return F.when(d != 0, F.signum(n) * F.signum(d) * q / F.lit(float(scale)))


def units(c, scale: int = 0) -> Column:
    """Value as an integer count of 10^-scale units (exact for values with at
    most ``scale`` decimals, e.g. 4-decimal sentiment)."""
    x = _c(c)
    return (F.round(x * F.lit(10 ** scale)) if scale else x).cast("bigint")


def exact_mean(c, scale: int = 0, digits: int = 6) -> Column:
    """Mean of a column with at most ``scale`` decimals, rounded half-up."""
    x = _c(c)
    return round_div(F.sum(units(x, scale)), F.count(x) * F.lit(10 ** scale), digits)


def round_decimal(c, digits: int, exact_scale: int = 6) -> Column:
    """Half-up rounding of a value known to have at most ``exact_scale``
    decimals (done in DECIMAL, so no binary tie ambiguity)."""
    return F.round(_c(c).cast(f"decimal(38,{exact_scale})"), digits).cast("double")

"""Statistical expressions and small numeric helpers."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


#: A side is constant when so small a share of its squares about the column's mean is left about its own: rounding leaves 1e-16.
FLAT = 1e-14


def pearson(x: Column, y: Column) -> Column:
    """Pearson correlation over rows where both sides are present; NULL when one side is constant."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)

    def flat(side: Column, column: Column) -> Column:
        away = F.avg(side) - F.avg(column)
        return F.var_pop(side) <= FLAT * (F.var_pop(side) + away * away)

    return F.when(~(flat(a, x) | flat(b, y)), F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)))


def _beta_continued_fraction(a: float, b: float, x: float) -> float:
    """Lentz evaluation of the continued fraction of the incomplete beta function."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 500):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1.0) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1.0)),
        ):
            d = 1.0 + numerator * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + numerator / c
            c = c if abs(c) > tiny else tiny
            value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return value


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    log_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(log_front) * _beta_continued_fraction(a, b, x) / a
    return 1.0 - math.exp(log_front) * _beta_continued_fraction(b, a, 1.0 - x) / b


def correlation_p_value(r: float | None, n: int) -> float | None:
    """Two-sided p-value of a correlation under Student's t with n - 2 degrees of freedom."""
    if r is None or n is None or n < 3:
        return None
    if abs(r) >= 1.0:
        return 0.0
    dof = n - 2
    t_squared = r * r * dof / (1.0 - r * r)
    return incomplete_beta(dof / 2.0, 0.5, dof / (dof + t_squared))

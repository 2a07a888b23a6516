"""Statistical column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def chi_squared_yates(yy, yb, ya, t) -> Column:
    """2x2 chi-squared with Yates' continuity correction.

    yy: documents with both topics; yb, ya: documents with each topic;
    t: all documents. Null when a margin is zero (a topic in no or every
    document) instead of a division error.
    """
    yy, yb, ya, t = (_c(x).cast("double") for x in (yy, yb, ya, t))
    nb = t - yb
    na = t - ya
    yn = ya - yy
    ny = yb - yy
    nn = t - ny - yn - yy
    inner = F.abs(yy * nn - yn * ny) - t / F.lit(2.0)
    denom = ya * na * yb * nb
    return F.when(denom != 0, t * inner * inner / denom)


CHI_SQL = ("({t} * POWER(ABS({yy} * ({t} - ({yb} - {yy}) - ({ya} - {yy}) - {yy}) - ({ya} - {yy}) * ({yb} - {yy})) - {t} / 2.0, 2)"
           " / ({ya} * ({t} - {ya}) * {yb} * ({t} - {yb})))")


def signed_square(x) -> Column:
    x = _c(x)
    return F.signum(x) * x * x


def signed_sqrt(x) -> Column:
    x = _c(x)
    return F.signum(x) * F.sqrt(F.abs(x))

"""Column-expression helpers shared by every operator.

All helpers return ``pyspark.sql.Column`` objects, so they stay inside
Catalyst (whole-stage codegen, no Python in the hot path).

The reference runs on a SQL dialect whose GREATEST/LEAST propagate NULL,
whose SAFE_DIVIDE returns NULL on a zero divisor and whose weeks may start on
Sunday.  Spark differs on all three, so every operator goes through the
helpers below instead of calling the Spark builtins directly.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def r(c, k: int) -> Column:
    """Portable rounding: floor(x * 10^k + 0.5) / 10^k as DOUBLE.

    ``round()`` differs between engines at near ties; this form is
    bit-identical wherever the floor argument agrees.
    """
    scale = float(10 ** k)
    return F.floor(col(c).cast("double") * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def safe_div(a, b) -> Column:
    """SAFE_DIVIDE: NULL when the divisor is 0 or NULL (Spark 4 is ANSI)."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def clamp(c, lo: float, hi: float) -> Column:
    """LEAST(hi, GREATEST(lo, x)) with NULL propagation (NULL in, NULL out)."""
    x = col(c)
    return F.when(x.isNotNull(), F.least(F.lit(float(hi)), F.greatest(F.lit(float(lo)), x)))


def greatest_strict(*cols) -> Column:
    """GREATEST that returns NULL if any argument is NULL."""
    cs = [col(c) for c in cols]
    cond = cs[0].isNotNull()
    for c in cs[1:]:
        cond = cond & c.isNotNull()
    return F.when(cond, F.greatest(*cs))


def least_strict(*cols) -> Column:
    cs = [col(c) for c in cols]
    cond = cs[0].isNotNull()
    for c in cs[1:]:
        cond = cond & c.isNotNull()
    return F.when(cond, F.least(*cs))


def sunday_week(d) -> Column:
    """Start of the week containing ``d`` when weeks start on Sunday."""
    dc = col(d)
    return F.date_sub(dc, F.dayofweek(dc) - 1)


def sign_long(c) -> Column:
    """SIGN() as BIGINT (Spark's signum returns DOUBLE)."""
    return F.signum(col(c)).cast("long")


def u01(*parts) -> Column:
    """Deterministic uniform in [0, 1): first 8 hex digits of md5 / 2^32.

    Used instead of RAND() so that results do not depend on partitioning and
    can be reproduced by any SQL engine with md5.
    """
    pieces = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    key = F.concat_ws("|", *pieces)
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long").cast("double") / F.lit(4294967296.0)


def symbol_window(order: str = "date") -> Window:
    return Window.partitionBy("symbol").orderBy(order)


def trailing(n: int, order: str = "date", part=("symbol",)) -> Window:
    """ROWS BETWEEN n-1 PRECEDING AND CURRENT ROW."""
    return Window.partitionBy(*part).orderBy(order).rowsBetween(-(n - 1), 0)


def running(order: str = "date", part=("symbol",)) -> Window:
    return Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)

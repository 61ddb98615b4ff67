"""Null-exact column helpers (the N1-N13 rules of the survey).

All return native Catalyst expressions so they stay inside whole-stage
codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip_lower(c, lo) -> Column:
    """``x.clip(lower=lo)`` keeping NULL (N1): greatest() would turn NULL into lo."""
    x = col(c)
    return F.when(x < lo, F.lit(lo)).otherwise(x)


def clip_upper(c, hi) -> Column:
    x = col(c)
    return F.when(x > hi, F.lit(hi)).otherwise(x)


def clip(c, lo, hi) -> Column:
    x = col(c)
    return F.when(x < lo, F.lit(lo)).when(x > hi, F.lit(hi)).otherwise(x)


def nz(c) -> Column:
    """``den.replace(0, 1)`` (N2): only exact zero becomes one."""
    x = col(c)
    return F.when(x == 0, F.lit(1)).otherwise(x)


def flag(cond: Column) -> Column:
    """``(cond).astype(int)`` (N3): NULL comparison counts as 0."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def sign0(c) -> Column:
    """``np.sign(x).fillna(0)``."""
    return F.coalesce(F.signum(col(c)), F.lit(0.0))


def safe_div(num, den) -> Column:
    """Division that yields NULL on a zero denominator instead of an ANSI error."""
    return F.try_divide(col(num), col(den))


def months_floor(c) -> Column:
    """``MonthsInService.clip(lower=1)``."""
    return clip_lower(c, 1)


def rnd(c, places: int = 6) -> Column:
    """Round half away from zero as ``round(x * 10^p) / 10^p``.

    Both Spark and DuckDB evaluate this with the same IEEE operations, so the
    result is bit-identical across engines (Spark's ``round(x, p)`` rounds the
    shortest decimal string instead and can differ at a trailing 5).
    """
    m = float(10 ** places)
    return F.round(col(c).cast("double") * m) / m


def r6(c) -> Column:
    """Round to six places: the precision both engines agree on."""
    return rnd(c, 6)


def to_double(c) -> Column:
    """``pd.to_numeric(errors='coerce')`` (N12): non-numeric text becomes NULL."""
    return F.expr(f"try_cast(`{c}` as double)") if isinstance(c, str) else c.try_cast("double")

"""Column-expression helpers shared by every operator.

All helpers return ``Column`` objects built from ``pyspark.sql.functions`` so
they stay inside whole-stage codegen; none of them is a UDF.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_missing(c: ColumnOrName) -> Column:
    """True for SQL NULL and for floating NaN (pandas treats both as missing)."""
    c = col(c)
    return c.isNull() | F.isnan(c)


def clip(c: ColumnOrName, lower: float | None = None, upper: float | None = None) -> Column:
    """pandas ``Series.clip``: bounds applied, missing values stay missing.

    ``greatest``/``least`` alone would turn NULL into the bound.
    """
    c = col(c)
    out = c
    if lower is not None:
        out = F.when(out < F.lit(lower), F.lit(lower)).otherwise(out)
    if upper is not None:
        out = F.when(out > F.lit(upper), F.lit(upper)).otherwise(out)
    return F.when(is_missing(c), F.lit(None).cast("double")).otherwise(out.cast("double"))


def safe_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Division that yields NULL for a zero or NULL denominator (ANSI-safe)."""
    return F.try_divide(col(num), col(den))



def snap(c: ColumnOrName, digits: int, mode: str = "half_even") -> Column:
    """Round to ``digits`` decimals through an exact decimal.

    The double is first fixed to 10 decimals so that floating noise from
    summation order cannot move a value across a rounding tie; the decimal is
    then rounded (``half_even`` = pandas/numpy rounding, ``half_up`` = SQL
    NUMERIC rounding) and returned as a double.  NaN and overflow become NULL.
    """
    d = col(c).try_cast("decimal(38,10)")
    r = F.bround(d, digits) if mode == "half_even" else F.round(d, digits)
    return r.cast("double")


def exact(c: ColumnOrName) -> Column:
    """Unrounded measure normalised to 10 decimals (removes last-ulp noise)."""
    return col(c).try_cast("decimal(38,10)").cast("double")


def row_sum(cols: list[ColumnOrName]) -> Column:
    return reduce(add, [col(c) for c in cols])


def pct_change(c: ColumnOrName, prev: ColumnOrName) -> Column:
    """(x / previous - 1) * 100; NULL when the predecessor is 0 or NULL."""
    return (safe_div(col(c), col(prev)) - F.lit(1)) * F.lit(100)


def present(df, wanted: list[str]) -> list[str]:
    """Wanted columns that exist in ``df`` (the reference's dynamic projections)."""
    have = set(df.columns)
    return [c for c in wanted if c in have]

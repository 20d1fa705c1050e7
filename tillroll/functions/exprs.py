"""Small reusable Column expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rnd(c: Column | str, digits: int = 2) -> Column:
    """Round half away from zero on the scaled double: ``round(x*10^d)/10^d``.

    Written this way (rather than ``round(x, d)``) so that the result is the
    same in engines that round the scaled double, which keeps published money
    columns stable across engines and summation orders.
    """
    scale = float(10 ** digits)
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col * F.lit(scale)) / F.lit(scale)


def pct_change(cur: Column, prev: Column) -> Column:
    """(cur - prev) / prev * 100, null when prev is null or zero (ANSI safe)."""
    return F.try_divide(cur - prev, prev) * F.lit(100.0)


def ratio_pct(part: Column, whole: Column) -> Column:
    """part / whole * 100, null on a zero or null denominator."""
    return F.try_divide(part.cast("double"), whole) * F.lit(100.0)


def free_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores added until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def first_match(pairs: list[tuple[Column, object]], default: object) -> Column:
    """A CASE WHEN chain: first matching condition wins."""
    out = None
    for cond, value in pairs:
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out.otherwise(default)


# Money is summed exactly at micro-unit (1e-6) resolution, so totals do not
# change with summation order, partitioning or executor count. Each value is
# split into whole units and rounded micro-units, both summed as 64-bit
# integers (fast, fixed-width aggregation buffers); the two sums meet in one
# DECIMAL per group. The result equals summing DECIMAL(20,6) casts of the
# values, without per-row BigDecimal arithmetic.
MONEY = "decimal(38,6)"


def finite(c: Column | str) -> Column:
    """The value, or null where it is NaN or infinite."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(F.abs(col) < F.lit(float("inf")), col)


def money_parts(c: Column | str) -> tuple[Column, Column]:
    """A value's whole part and its millionths, as longs: their sums are cheap and
    can be summed again (``money_of``). NaN and infinite values are null."""
    col = finite(c)
    whole = F.floor(col)
    return whole, F.round((col - whole) * F.lit(1e6)).cast("long")


def money_of(whole: Column, micros: Column) -> Column:
    """The DECIMAL(38,6) of a sum of whole parts and one of millionths."""
    return (whole.cast(MONEY)
            + micros.cast("decimal(38,0)") * F.lit(0.000001).cast("decimal(7,6)")).cast(MONEY)


def money_sum_exact(c: Column | str) -> Column:
    """Exact DECIMAL(38,6) sum (also for partial sums that are summed again).
    NaN and infinite values are left out, like nulls."""
    whole, micros = money_parts(c)
    return money_of(F.sum(whole), F.sum(micros))


def money_sum(c: Column | str) -> Column:
    return money_sum_exact(c).cast("double")


def money_avg(c: Column | str) -> Column:
    col = finite(c)
    return F.try_divide(money_sum(col), F.count(col).cast("double"))


def lit_value(v) -> Column:
    """A literal for a value read from a one-row aggregate. Datetimes go through
    their ISO text into TIMESTAMP_NTZ, so no time zone is applied; lists
    become typed arrays; None stays a null literal."""
    import datetime as _dt

    if v is None:
        return F.lit(None)
    if isinstance(v, _dt.datetime):
        return F.lit(v.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")
    if isinstance(v, (list, tuple)):
        return F.array(*[lit_value(x) for x in v])
    return F.lit(v)


def one_row(df):
    """Read a one-row aggregate (a handful of scalars) on the driver."""
    return df.first()

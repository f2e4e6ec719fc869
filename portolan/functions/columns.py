"""Scalar and aggregate column helpers.

All of them compose ``pyspark.sql.functions`` built-ins, so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _q(name: str) -> str:
    """Backtick-quote a column name for SQL expression text."""
    return "`" + name.replace("`", "``") + "`"


# --------------------------------------------------------------------------
# data quality
# --------------------------------------------------------------------------
def missing(c, dtype: T.DataType) -> Column:
    """Type-aware "missing" predicate.

    strings: null or blank after trim; floating / decimal: null or NaN;
    everything else: null.
    """
    col = as_col(c)
    if isinstance(dtype, T.StringType):
        return col.isNull() | (F.trim(col) == "")
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


# --------------------------------------------------------------------------
# ratios
# --------------------------------------------------------------------------
def guarded_ratio(num, den, default: float = 0.0) -> Column:
    """``num / den`` when ``den > 0`` else ``default``.

    A null denominator therefore yields ``default`` while a null numerator
    over a positive denominator yields null.  Fill NaN denominators before
    calling: ``NaN > 0`` is true in Spark.
    """
    if isinstance(num, str) and isinstance(den, str):
        # one expression, one driver round trip
        return F.expr(f"CASE WHEN {_q(den)} > 0 THEN try_divide({_q(num)}, {_q(den)}) "
                      f"ELSE CAST({float(default)!r} AS DOUBLE) END")
    n, d = as_col(num), as_col(den)
    return F.when(d > 0, F.try_divide(n, d)).otherwise(F.lit(float(default)))


# --------------------------------------------------------------------------
# periods and dates
# --------------------------------------------------------------------------
def period_year(period) -> Column:
    """Year of a ``YYYYMM`` / ``YYYY`` period (text or integer)."""
    p = as_col(period).cast("string")
    return F.substring(p, 1, 4).try_cast("int")


def period_month(period) -> Column:
    """Month of a 6-character period; any other length (annual) is month 1."""
    p = as_col(period).cast("string")
    return (F.when(F.length(p) == 6, F.substring(p, 5, 2).try_cast("int"))
            .otherwise(F.lit(1)))


def quarter_of(month) -> Column:
    """``ceil(month / 3)`` as int."""
    return F.ceil(as_col(month) / F.lit(3)).cast("int")


def quarter_label(quarter) -> Column:
    return F.concat(F.lit("Q"), as_col(quarter).cast("string"))


def month_label(year, month) -> Column:
    """Zero-padded ``YYYY-MM``."""
    return F.format_string("%d-%02d", as_col(year), as_col(month))


def text_head(c, sep: str = ";") -> Column:
    """Text before the first separator (null stays null, '' stays '')."""
    return F.split_part(as_col(c), F.lit(sep), F.lit(1))


def log_scale(c) -> Column:
    """``log10(x + 1)``; null stays null."""
    return F.log10(as_col(c) + F.lit(1.0))


# --------------------------------------------------------------------------
# sums and means, plain or exact
# --------------------------------------------------------------------------
_EXACT: ContextVar[tuple[int, int] | None] = ContextVar("portolan_exact_digits", default=None)


@contextmanager
def exact_digits(money: int = 2, rates: int = 8) -> Iterator[None]:
    """Within this block measures are summed as long counts of 10^-money
    units and rates averaged at 10^-rates, independent of partitioning and
    retries, and the views round their means.  A value with more digits, or
    out of range, fails the query: nothing is rounded away or left out.
    Outside it every sum and mean is Spark's plain ``sum`` / ``avg``."""
    token = _EXACT.set((money, rates))
    try:
        yield
    finally:
        _EXACT.reset(token)


def exact_mode() -> bool:
    return _EXACT.get() is not None


def rate_scale() -> int | None:
    """Decimals of rates within `exact_digits`, else None."""
    return _EXACT.get()[1] if exact_mode() else None


def fixed_units(c, scale: int) -> Column:
    """Value as a long count of ``10^-scale`` units; a value that is not such
    a count (more digits, NaN, infinite, beyond 9e18 units) raises."""
    value = as_col(c).cast("double")
    scaled = value * F.lit(float(10 ** scale))
    units = F.floor(scaled + F.lit(0.5))
    off = F.abs(scaled - units) > F.lit(1e-3) + F.abs(scaled) * F.lit(1e-12)
    bad = F.isnan(scaled) | (F.abs(scaled) >= F.lit(9.0e18)) | off
    return F.when(value.isNull(), F.lit(None).cast("long")).when(
        bad, F.raise_error(F.concat(F.lit(f"not a number of {scale} decimals: "), value.cast("string"))).cast("long")
    ).otherwise(units.cast("long"))


def fixed_sum(c, scale: int | None = None, over=None) -> Column:
    """Sum of a measure: plain, or exact at ``scale`` decimals (given here or
    by `exact_digits`).  All-null input gives null.  ``over`` turns it into a
    window sum."""
    if scale is None and exact_mode():
        scale = _EXACT.get()[0]
    total = F.sum(as_col(c)) if scale is None else F.sum(fixed_units(c, scale))
    if over is not None:
        total = total.over(over)
    return total if scale is None else total.cast("double") / F.lit(float(10 ** scale))


def partial_sum(c, scale: int | None = None):
    """(aggregate, finish): a sum in two steps, as `fixed_sum` in one.  The sum of
    the aggregate's parts, passed through ``finish``, is the total."""
    if scale is None and exact_mode():
        scale = _EXACT.get()[0]
    if scale is None:
        return F.sum(as_col(c)), lambda total: total
    return F.sum(fixed_units(c, scale)), lambda total: total.cast("double") / F.lit(float(10 ** scale))


def fixed_mean(c, scale: int | None = None) -> Column:
    """Mean of a measure: plain, or exact at ``scale`` decimals (given here or
    by `exact_digits`) as fixed-point sum / non-null count.  The units are
    summed as decimals: at 8 digits a long holds a total of 9e10 only."""
    if scale is None and exact_mode():
        scale = _EXACT.get()[1]
    if scale is None:
        return F.avg(as_col(c))
    units = fixed_units(c, scale)
    total = F.sum(units.cast(T.DecimalType(19, 0)))
    return (total.cast("double") / F.lit(float(10 ** scale))) / F.count(units).cast("double")


# --------------------------------------------------------------------------
# doubles as whole numbers in the same order
# --------------------------------------------------------------------------
def with_order_key(df: DataFrame, value: str, out: str) -> DataFrame:
    """``df`` with ``out``, a long that sorts as the double ``value`` does; equal
    doubles have equal keys.

    It is the IEEE-754 bit pattern (biased exponent, then the 52 bits of the
    mantissa), built from exact operations: powers of two, division by one, and
    whole numbers below 2^53.  Negative values mirror positive ones below zero,
    -0.0 is 0.0.  Null and NaN give null.  The steps are columns of their own,
    as one nested expression would compute each of them many times."""
    x, a, g, p, e = F.col(value), F.col("__abs"), F.col("__guess"), F.col("__power"), F.col("__exponent")
    steps = (df.withColumn("__abs", F.abs(x.cast("double")))
             # off by one at most, next to a power of two
             .withColumn("__guess", F.least(F.greatest(F.floor(F.log2(a)), F.lit(-1022)), F.lit(1023)).cast("int"))
             .withColumn("__power", F.pow(F.lit(2.0), g))
             .withColumn("__exponent", g + F.when((g < 1023) & (a >= p * 2.0), 1)
                         .when((g > -1022) & (a < p), -1).otherwise(0)))
    exact = p * F.when(e > g, 2.0).when(e < g, 0.5).otherwise(1.0)
    normal = F.shiftleft((e + 1023).cast("long"), 52) + ((a / exact - 1.0) * F.lit(2.0 ** 52)).cast("long")
    # in two steps, as 2^1074 is no double
    small = (a * F.lit(2.0 ** 537) * F.lit(2.0 ** 537)).cast("long")
    key = F.when(a == F.lit(float("inf")), F.lit(2047 << 52)).when(a < F.lit(2.0 ** -1022), small).otherwise(normal)
    signed = F.when(x.isNull() | F.isnan(x.cast("double")), F.lit(None).cast("long")).when(x < 0, -key).otherwise(key)
    return steps.withColumn(out, signed).drop("__abs", "__guess", "__power", "__exponent")


def from_order_key(c) -> Column:
    """The double of a key of ``with_order_key``."""
    key = as_col(c)
    a = F.abs(key)
    exponent, mantissa = F.shiftright(a, 52), a.bitwiseAND(F.lit((1 << 52) - 1))
    normal = (mantissa.cast("double") / F.lit(2.0 ** 52) + 1.0) * F.pow(F.lit(2.0), exponent - 1023)
    small = mantissa.cast("double") * F.lit(2.0 ** -537) * F.lit(2.0 ** -537)
    value = (F.when(exponent == 2047, F.lit(float("inf"))).when(exponent == 0, small).otherwise(normal))
    return F.when(key < 0, -value).otherwise(value)


# --------------------------------------------------------------------------
# serving text
# --------------------------------------------------------------------------
def cell_text(c, scale: int | None = None) -> Column:
    """Plain text for a serving cell.

    Integers and strings are cast directly; doubles go through
    ``decimal(38, scale)`` so the text never has an exponent.  NaN, infinity
    and overflow become null, and null cells are omitted by the caller.
    """
    col = as_col(c)
    if scale is None:
        return col.cast("string")
    return col.try_cast(T.DecimalType(38, scale)).cast("string")

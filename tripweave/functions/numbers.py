"""Rounding, missing numbers and number formatting."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Exact sums count billionths, the finer digits of each term are rounded off.
_UNITS = 1_000_000_000
# Below the first bound a term's billionths are exact as a double and split into two whole
# numbers of 26 bits. Terms up to the second are summed as decimals, those beyond, infinities
# among them, as doubles.
_NEAR, _FAR = float(1 << 22), 1e15
_LOW_BITS = 26
_LARGE = "decimal(28,9)"
def round2(x: Column) -> Column:
    """Two decimals, ties to even on the scaled double (not Spark's half-up `round`)."""
    return F.rint(x * F.lit(100.0)) / F.lit(100.0)


def _carried(high: Column, low: Column, large: Column, far: Column) -> Column:
    """The struct of an exact sum, with what the low part holds too much carried over."""
    carry = F.shiftright(low, _LOW_BITS)
    return F.struct(
        (high + carry).alias("high"),
        low.bitwiseAND(F.lit((1 << _LOW_BITS) - 1)).alias("low"),
        large.alias("large"),
        far.alias("far"),
    )


def exact_sum(x: Column) -> Column:
    """Sum of doubles that does not depend on the order of its terms, as a struct.

    See `total_of` and `add_up`. The low parts of 1e11 terms fit into their sum; after that
    they are below 2^26 again, and the high parts hold 6e17 in all.
    """
    size = F.abs(x)
    units = F.when(size < F.lit(_NEAR), F.rint(x * F.lit(float(_UNITS))).cast("bigint"))
    large = F.when((size >= F.lit(_NEAR)) & (size < F.lit(_FAR)), x.cast(_LARGE))
    return _carried(
        F.sum(F.shiftright(units, _LOW_BITS)),
        F.sum(units.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))),
        F.sum(large),
        F.sum(F.when(~(size < F.lit(_FAR)), x)),
    )


#: What Spark keeps of an exact sum between batches of a stream.
SUM_STATE = "high:bigint,low:bigint,large:decimal(38,9),no_large:boolean,far:double"


def sum_from_state(state: Column) -> Column:
    """The exact sum in a state of the form `SUM_STATE`."""
    large = F.when(~state["no_large"], state["large"])
    return _carried(state["high"], state["low"], large, state["far"])


def add_up(sums: Column) -> Column:
    """The sum of exact sums, again exact."""
    high, low, far = (F.sum(sums[f]) for f in ("high", "low", "far"))
    return _carried(high, low, F.sum(sums["large"].cast(_LARGE)), far)


def total_of(sums: Column) -> Column:
    """The value of an exact sum; NULL if it has no terms."""
    wide = "decimal(38,0)"
    units = sums["high"].cast(wide) * F.lit(1 << _LOW_BITS).cast("decimal(8,0)") + sums["low"].cast(wide)
    whole = F.floor(units / F.lit(_UNITS).cast("decimal(10,0)"))
    rest = (units - whole * F.lit(_UNITS).cast("decimal(10,0)")).cast("decimal(10,0)")
    billionth = F.lit(Decimal("0.000000001"))
    near = whole.cast("decimal(36,9)") + rest * billionth
    large = sums["large"].cast("decimal(36,9)")
    exactly = F.coalesce(near + large, near, large).cast("double")
    return F.coalesce(sums["far"] + exactly, exactly, sums["far"])


def mean_of(total: Column, n: Column) -> Column:
    """Mean from a sum and a count; NULL when there is nothing to average."""
    return F.try_divide(total, n.cast("double"))


def pct_change(current: Column, previous: Column) -> Column:
    """Rounded percentage change; NULL unless the previous value is above zero."""
    change = F.try_divide((current - previous).cast("double"), previous.cast("double"))
    return F.when(previous > 0, round2(change * F.lit(100.0)))


def exact(name: str) -> Column:
    """A column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_float(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


def known(df: DataFrame, name: str) -> Column:
    """The column with NaN turned into NULL, so that aggregates skip it."""
    c = exact(name)
    return F.when(~F.isnan(c), c) if is_float(df, name) else c


def above(df: DataFrame, name: str, limit: float) -> Column:
    """`name > limit` where NULL and NaN fail.

    The comparison stays on the bare column so that it still reaches the Parquet
    reader; Spark alone would order NaN above every number.
    """
    c = exact(name)
    test = c > F.lit(limit)
    return test & ~F.isnan(c) if is_float(df, name) else test


def format_count(x: Column) -> Column:
    """Whole number with thousands separators; fractions are cut off."""
    return F.format_number(x.cast("bigint"), 0)


def format_money(x: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(x.cast("double"), 2))

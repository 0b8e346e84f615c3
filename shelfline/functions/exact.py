"""Sums, means and rounding whose result does not depend on the order in which rows arrive.

A sum of doubles changes in its last digits with the partitioning, and with it everything that is compared or
ranked by that sum. Amounts have two decimals, a net amount (price times one minus discount) four. So an amount
is split into whole units of 1/10000, which are summed as integers, and a rest, which is summed as double. The
rest is exactly zero for an amount of at most four decimals; finer amounts keep what the units leave over. An
amount without room in a bigint, and one that is no finite number, is all rest: it adds up as a double does.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = 10_000
_LOW_BITS = 20
_MOST = 9e14


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _in_range(col: Column) -> Column:
    """NaN is larger than any number, so it is out of range."""
    return F.abs(col) <= _MOST


def to_units(col: Column | str) -> Column:
    """The amount in units of 1/10000 as bigint, rounded half away from zero; 0 where it is all rest."""
    col = _col(col).cast("double")
    units = (F.when(_in_range(col), col).otherwise(0.0) * _UNITS + F.signum(col) * 0.5).try_cast("bigint")
    return F.when(_in_range(col), units).when(col.isNotNull(), F.lit(0).cast("bigint"))


def from_units(units: Column | str) -> Column:
    return _col(units).cast("double") / _UNITS


def amount_parts(col: Column | str, prefix: str) -> dict[str, Column]:
    """The amount as three columns that can be summed, again and again, in any order: ``sum_of_parts`` joins them.

    A bigint of units would overflow at about 9e14, which a year of a large company can reach. So the high and
    the low bits are columns of their own.
    """
    col = _col(col).cast("double")
    units = to_units(col)
    rest = F.when(_in_range(col), col - from_units(units)).otherwise(col)
    return {
        f"{prefix}_high": F.shiftright(units, _LOW_BITS),
        f"{prefix}_low": units.bitwiseAND((1 << _LOW_BITS) - 1),
        f"{prefix}_rest": rest,
    }


def sum_of_parts(high: Column, low: Column, rest: Column) -> Column:
    """The amount of summed parts as double. Put together in decimal once per group, not for every row."""
    return from_units(high.cast("decimal(20,0)") * (1 << _LOW_BITS) + low.cast("decimal(20,0)")) + rest


def exact_sum(col: Column | str) -> Column:
    """Sum of amounts, for groups of any size."""
    return sum_of_parts(*(F.sum(part) for part in amount_parts(col, "amount").values()))


def exact_avg(col: Column | str) -> Column:
    """Mean of the non-NULL values; NULL when there are none."""
    return F.try_divide(exact_sum(col), F.count(_col(col)))


def portable_round(col: Column, places: int = 2) -> Column:
    """Round the double half away from zero as stored: 1.005 gives 1.0. What is no finite number stays.

    ``F.round`` works on the printed decimal digits (1.005 gives 1.01), unlike other SQL engines. From 2**52 on
    a double has no places to round.
    """
    unit = float(10**places)
    rounded = F.signum(col) * F.floor(F.abs(col) * unit + 0.5) / unit
    return F.when(F.abs(col) * unit < float(1 << 52), rounded).otherwise(col)

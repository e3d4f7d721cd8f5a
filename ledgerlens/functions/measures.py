"""Exact sums and plain half-up rounding, shared by the reports.

Doubles added in another order differ in their last bits, which shows where a
rounded value is a tie. So values are counted in whole units of 10^-digits, their
sums are whole numbers of any size, and a quotient is rounded from its exact
numerator and denominator. The results are the same for every plan and order.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Decimals that money keeps in sums.
MONEY_DIGITS = 4
#: Decimals that model scores keep in sums.
SCORE_DIGITS = 9
WIDE = "decimal(38,0)"


def units(value: Column, digits: int = MONEY_DIGITS) -> Column:
    """The nearest whole number of units of 10^-digits; one beyond 64 bits, and what is no number, fails the job."""
    return F.rint(value.cast("double") * F.lit(float(10**digits))).cast("bigint")


def exact_total(whole: Column) -> Column:
    """Sum of 64-bit numbers as a whole decimal: high and low halves are summed apart, so neither overflows."""
    high, low = F.sum(F.shiftright(whole, 32)), F.sum(whole.bitwiseAND(F.lit(2**32 - 1)))
    return high.cast(WIDE) * F.lit(2**32).cast("decimal(10,0)") + low.cast(WIDE)


def half_up(numerator: Column, denominator: Column | int, digits: int) -> Column:
    """Quotient of whole numbers rounded to ``digits`` decimals, ties away from zero; NULL over zero."""
    over = F.nullif((denominator if isinstance(denominator, Column) else F.lit(denominator)).cast(WIDE), F.lit(0).cast(WIDE))
    number = numerator.cast(WIDE) * F.lit(10**digits).cast("decimal(10,0)")
    two = F.lit(2).cast("decimal(1,0)")
    size = F.call_function("div", F.abs(number) * two + over, over * two)
    return F.when(number < 0, -size).otherwise(size) / F.lit(float(10**digits))


def rounded_total(value: Column, digits: int = 2, kept: int = MONEY_DIGITS) -> Column:
    return half_up(exact_total(units(value, kept)), 10**kept, digits)


def rounded_mean(value: Column, digits: int = 2, kept: int = MONEY_DIGITS) -> Column:
    return half_up(exact_total(units(value, kept)), F.count(value).cast(WIDE) * F.lit(10**kept).cast("decimal(10,0)"), digits)


def row_count() -> Column:
    return F.count(F.lit(1))


def rate_pct(part: Column, whole: Column, digits: int = 4) -> Column:
    """Share of two counts in percent; NULL when the whole is zero."""
    return half_up(part.cast(WIDE) * F.lit(100).cast("decimal(3,0)"), whole, digits)


def where(predicate: Column, value: Column) -> Column:
    """The value on rows meeting the predicate; other rows do not count."""
    return F.when(predicate, value)

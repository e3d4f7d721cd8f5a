"""Expressions that turn raw text into typed values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerlens.contract import TIMESTAMP_FORMAT

#: A sign, digits with at most one point, an exponent: no NaN, Infinity or type suffix.
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def parse_currency(text: Column) -> Column:
    """``$-1,234.50`` -> -1234.5; text that is no number becomes NULL."""
    plain = F.trim(F.translate(text, "$,", ""))
    return F.when(plain.rlike(NUMBER), plain.try_cast("double"))


def parse_timestamp(text: Column, fmt: str = TIMESTAMP_FORMAT) -> Column:
    """Timestamp, or NULL when the text does not follow ``fmt``."""
    return F.try_to_timestamp(text, F.lit(fmt))


def blank_to_null(text: Column) -> Column:
    """NULL for empty or all-space text, otherwise the text untouched."""
    return F.when(F.trim(text) != "", text)


def encode_label(text: Column, strict: bool = False) -> Column:
    """Yes -> 1, anything else -> 0. ``strict`` keeps an absent label value NULL."""
    encoded = F.coalesce(text == "Yes", F.lit(False)).cast("int")
    return F.when(text.isNotNull(), encoded) if strict else encoded


def to_number(value: Column) -> Column:
    """Double, or NULL when the value (taken as text) is no number."""
    text = F.trim(value.cast("string"))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def flag(predicate: Column) -> Column:
    """1 / 0 flag; an unknown predicate stays NULL."""
    return predicate.cast("int")


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio where the denominator is positive, NULL elsewhere."""
    return F.when(denominator > 0, numerator / denominator)


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970, rounded down; accepts zoned and zoneless timestamps."""
    return F.unix_seconds(ts.cast("timestamp"))

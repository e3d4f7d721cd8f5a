"""Row filters. Predicates stay on bare columns so that they reach the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def present(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def equal_to(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) == value)


def not_blank(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull() & (F.col(column) != ""))


def one_of(df: DataFrame, column: str, values) -> DataFrame:
    return df.filter(F.col(column).isin(list(values)))


def with_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return df.filter(F.col(column).startswith(prefix))


def month_of(ts: str) -> str:
    """Name of the column that holds the first day of the month of ``ts``, by which tables are laid out."""
    return f"{ts}_month"


def with_month(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumn(month_of(ts), F.trunc(F.col(ts), "MM"))


def _in_months(df: DataFrame, ts: str, start: Column | None, end: Column | None) -> DataFrame:
    """Limits a table laid out by month to the months of a time range, so that the others are not listed or read.

    A day's margin allows for a table written in another time zone.
    """
    month = month_of(ts)
    if month not in df.columns:
        return df
    if start is not None:
        df = df.filter(F.col(month) >= F.trunc(F.date_sub(start.cast("date"), 1), "MM"))
    if end is not None:
        df = df.filter(F.col(month) <= F.trunc(F.date_add(end.cast("date"), 1), "MM"))
    return df


def between_times(df: DataFrame, ts: str, start: str | None, end: str | None) -> DataFrame:
    """Half-open range ``start <= ts < end``; an open end is given as None.

    Of a table laid out by month only the months of the range are read.
    """
    # Casting the bound, never the column, keeps the comparison eligible for pushdown.
    column_type = df.schema[ts].dataType
    first, last = (None if bound is None else F.lit(bound).cast(column_type) for bound in (start, end))
    kept = _in_months(df, ts, first, last)
    if first is not None:
        kept = kept.filter(F.col(ts) >= first)
    if last is not None:
        kept = kept.filter(F.col(ts) < last)
    return kept


def trailing(df: DataFrame, ts: str, days: int, as_of: str | Column | None = None) -> DataFrame:
    """Rows of the last ``days`` days before ``as_of`` (now, unless given)."""
    if as_of is None:
        moment = F.current_timestamp()
    elif isinstance(as_of, str):
        moment = F.lit(as_of).cast("timestamp")
    else:
        moment = as_of
    start = (moment - F.make_dt_interval(days=F.lit(days))).cast(df.schema[ts].dataType)
    return _in_months(df, ts, start, None).filter(F.col(ts) >= start)

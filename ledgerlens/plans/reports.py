"""Fraud reports over the labelled gold table.

Every aggregate combines before its shuffle, so a group holding most rows costs
no more than a small one. Reports with a limit break ties by their group key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.functions.measures import (
    MONEY_DIGITS,
    WIDE,
    half_up,
    rate_pct,
    rounded_mean,
    rounded_total,
    row_count,
    units,
    where,
)
from ledgerlens.operators.distribution import beside, percentile_ends, rounded_between_ends, value_counts
from ledgerlens.operators.filters import between_times, equal_to, not_blank


def _fraud_by(df: DataFrame, *keys: str | Column, digits: int = 4, **more: Column) -> DataFrame:
    """Transactions, frauds and fraud rate per group, then any further measures."""
    fraud = F.sum("is_fraud")
    return df.groupBy(*keys).agg(
        row_count().alias("total_tx"),
        fraud.alias("fraud_count"),
        rate_pct(fraud, row_count(), digits).alias("fraud_rate_pct"),
        *[measure.alias(name) for name, measure in more.items()],
    )


def _mean_amount() -> Column:
    return rounded_mean(F.col("abs_amount"))


def fraud_by_month(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """By month, of all times or of ``start <= ts < end``."""
    df = between_times(df, "ts", start, end)
    month = F.date_format("ts", "yyyy-MM").alias("year_month")
    total = rounded_total(F.col("abs_amount"))
    return _fraud_by(df, month, total_amount=total, avg_amount=_mean_amount()).orderBy("year_month")


def fraud_by_type(df: DataFrame) -> DataFrame:
    return _fraud_by(df, "use_chip", avg_amount=_mean_amount()).orderBy(
        F.desc("fraud_rate_pct"), "use_chip"
    )


def top_mcc_fraud(df: DataFrame, k: int = 20) -> DataFrame:
    """Categories with most frauds. Only frauds are counted, so every rate is 100."""
    mean_fraud = rounded_mean(where(F.col("is_fraud") == 1, F.col("abs_amount")))
    frauds = equal_to(df, "is_fraud", 1)
    return (
        _fraud_by(frauds, "mcc", "mcc_name", avg_fraud_amount=mean_fraud)
        .orderBy(F.desc("fraud_count"), "mcc", "mcc_name")
        .limit(k)
    )


def mcc_fraud_rate(df: DataFrame, k: int = 20) -> DataFrame:
    """The same categories with their rate among all their transactions."""
    mean_fraud = rounded_mean(where(F.col("is_fraud") == 1, F.col("abs_amount")))
    return (
        _fraud_by(df, "mcc", "mcc_name", avg_fraud_amount=mean_fraud)
        .orderBy(F.desc("fraud_count"), "mcc", "mcc_name")
        .limit(k)
    )


def fraud_by_hour(df: DataFrame) -> DataFrame:
    return _fraud_by(df, "hour_of_day").orderBy("hour_of_day")


def fraud_by_state(df: DataFrame, k: int = 15) -> DataFrame:
    known = not_blank(df, "merchant_state")
    return _fraud_by(known, "merchant_state").orderBy(F.desc("fraud_count"), "merchant_state").limit(k)


def amount_distribution(df: DataFrame, exact: bool = True) -> DataFrame:
    """Spread of amounts per class.

    All measures follow from the counts of each distinct amount, so the table is
    read once. ``exact=False`` approximates the percentiles and stores nothing.
    """
    points = {"median_amount": 0.5, "p95_amount": 0.95}
    if exact:
        amount = units(F.col("abs_amount"))
        counted = value_counts(df, ["is_fraud"], amount, _rows=row_count())
        money = F.lit(10**MONEY_DIGITS).cast("decimal(5,0)")
        known = F.sum(F.when(F.col("_value").isNotNull(), F.col("_rows")))
        total = F.sum(F.col("_value").cast("decimal(19,0)") * F.col("_rows").cast("decimal(19,0)"))
        basics = counted.groupBy("is_fraud").agg(
            F.sum("_rows").alias("count"),
            half_up(F.min("_value"), money, 2).alias("min_amount"),
            half_up(total, known.cast(WIDE) * money, 2).alias("avg_amount"),
            half_up(F.max("_value"), money, 2).alias("max_amount"),
        )
        ends = percentile_ends(counted, ["is_fraud"], points)
        spread = ends.select("is_fraud", *[rounded_between_ends(p, 2, MONEY_DIGITS).alias(p) for p in points])
        report = beside(basics, spread, ["is_fraud"])
    else:
        report = df.groupBy("is_fraud").agg(
            row_count().alias("count"),
            F.round(F.min("abs_amount"), 2).alias("min_amount"),
            _mean_amount().alias("avg_amount"),
            F.round(F.max("abs_amount"), 2).alias("max_amount"),
            *[F.round(F.percentile_approx("abs_amount", share), 2).alias(name) for name, share in points.items()],
        )
    return report.select(
        "is_fraud", "count", "min_amount", "avg_amount", "median_amount", "p95_amount", "max_amount"
    )


def error_vs_fraud(df: DataFrame) -> DataFrame:
    kind = F.coalesce(F.col("errors"), F.lit("No Error")).alias("error_type")
    return _fraud_by(df, kind).orderBy(F.desc("fraud_rate_pct"), "error_type")


def high_risk_customers(df: DataFrame, k: int = 20) -> DataFrame:
    lost = F.coalesce(rounded_total(where(F.col("is_fraud") == 1, F.col("abs_amount"))), F.lit(0.0))
    return (
        _fraud_by(df, "client_id", digits=2, total_fraud_amount=lost)
        .filter(F.col("fraud_count") > 0)
        .orderBy(F.desc("fraud_count"), "client_id")
        .limit(k)
    )


def fraud_by_brand(df: DataFrame) -> DataFrame:
    return _fraud_by(df, "card_brand", "card_type").orderBy(
        F.desc("fraud_rate_pct"), "card_brand", "card_type"
    )


def refund_vs_fraud(df: DataFrame) -> DataFrame:
    return _fraud_by(df, "is_refund")

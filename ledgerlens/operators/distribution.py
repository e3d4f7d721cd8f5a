"""Exact order statistics without sorting a group in one task.

Values are counted per group (combined before the shuffle) and the counts are dealt
out by range of (group, value). A value's rank is the total of the ranges before its
own, plus a running count inside its range. No step holds more than one range, or
the totals of a group's ranges, and ranges follow the partitions of the shuffle: more
data, more ranges. Values keep their own type; nothing is cast to double on the way.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, FloatType

from ledgerlens.functions.measures import WIDE, half_up
from ledgerlens.session import cut_lineage

_ALL = "_all"
#: Percentile shares have at most so many decimals, so ranks are exact.
SHARE_DIGITS = 6


def value_counts(
    df: DataFrame, by: Sequence[str], column: str | Column, partitions: int | None = None, **counts: Column
) -> DataFrame:
    """One stored row per (group, value) with its range ``_part``; the value is in ``_value``, NULL included.

    Without ``partitions`` there are as many ranges as shuffle partitions, of which
    adaptive execution joins small ones.
    """
    keys = list(by) or [_ALL]
    source = df if by else df.withColumn(_ALL, F.lit(0))
    value = F.col(column) if isinstance(column, str) else column
    counted = source.groupBy(*keys, value.alias("_value")).agg(*[expr.alias(name) for name, expr in counts.items()])
    order = [*keys, "_value"]
    ranged = counted.repartitionByRange(partitions, *order) if partitions else counted.repartitionByRange(*order)
    return cut_lineage(ranged.withColumn("_part", F.spark_partition_id()))


def _same(columns: Sequence[str], others: Sequence[str]) -> Column:
    """Equality of key columns pair by pair, NULL keys included."""
    condition = F.lit(True)
    for column, other in zip(columns, others):
        condition = condition & F.col(column).eqNullSafe(F.col(other))
    return condition


def with_running_totals(counted: DataFrame, keys: Sequence[str], columns: Sequence[str], descending: bool = False) -> DataFrame:
    """``counted`` with ``<column>_upto``, the total of the group's values up to this one, and ``<column>_all``."""
    turn = F.desc if descending else F.asc
    totals = counted.groupBy(*keys, "_part").agg(*[F.sum(c).alias(f"_in{c}") for c in columns])
    group = Window.partitionBy(*keys)
    earlier = group.orderBy(turn("_part")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"_t{k}") for k in keys],
        F.col("_part").alias("_tpart"),
        *[F.coalesce(F.sum(f"_in{c}").over(earlier), F.lit(0)).alias(f"_before{c}") for c in columns],
        *[F.sum(f"_in{c}").over(group).alias(f"{c}_all") for c in columns],
    )
    inside = Window.partitionBy(*keys, "_part").orderBy(turn("_value")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    matched = (F.col("_part") == F.col("_tpart")) & _same(keys, [f"_t{key}" for key in keys])
    upto = [(F.col(f"_before{c}") + F.sum(c).over(inside)).alias(f"{c}_upto") for c in columns]
    return counted.join(offsets, matched).select(*counted.columns, *[f"{c}_all" for c in columns], *upto)


def percentile_ends(counts: DataFrame, by: Sequence[str], points: Mapping[str, float]) -> DataFrame:
    """Per group and point the values around its rank: ``<point>_low``, ``<point>_high`` and ``<point>_rest``.

    The percentile lies ``rest / 10^6`` of the way from low to high. ``counts`` is a
    ``value_counts`` table with row counts ``_rows``.
    """
    keys = list(by) or [_ALL]
    ranked = with_running_totals(counts.filter(F.col("_value").isNotNull()), keys, ["_rows"])
    whole = 10**SHARE_DIGITS
    first, after = F.col("_rows_upto") - F.col("_rows"), F.col("_rows_upto")
    found = []
    for name, share in points.items():
        part = Fraction(str(share)) * whole
        if part.denominator != 1 or not 0 <= share <= 1:
            raise ValueError(f"{share} is no share with {SHARE_DIGITS} decimals")
        position = (F.col("_rows_all") - 1) * F.lit(int(part))
        rest = position % whole
        low = F.call_function("div", position, F.lit(whole))
        for end, rank in (("low", low), ("high", low + F.when(rest > 0, 1).otherwise(0))):
            found.append(F.max(F.when((rank >= first) & (rank < after), F.col("_value"))).alias(f"{name}_{end}"))
        found.append(F.max(rest).alias(f"{name}_rest"))
    return ranked.groupBy(*keys).agg(*found).drop(_ALL)


def between_ends(name: str, floating: bool) -> Column:
    """The interpolated percentile: a double, or six exact decimals for whole numbers and decimals."""
    low, high, rest = (F.col(f"{name}_{end}") for end in ("low", "high", "rest"))
    if floating:
        part = rest / F.lit(float(10**SHARE_DIGITS))
        return F.when(low == high, low).otherwise(low * (1 - part) + high * part).cast("double")
    low, high = (end.cast("decimal(30,6)") for end in (low, high))
    return (low + ((high - low) * rest / 10**SHARE_DIGITS).cast("decimal(30,6)")).cast("decimal(30,6)")


def rounded_between_ends(name: str, digits: int, kept: int) -> Column:
    """The percentile of a column of units of 10^-kept, rounded once, from exact numbers."""
    low, high, rest = (F.col(f"{name}_{end}").cast(WIDE) for end in ("low", "high", "rest"))
    whole = F.lit(10**SHARE_DIGITS).cast("decimal(7,0)")
    return half_up(low * whole + (high - low) * rest, 10 ** (SHARE_DIGITS + kept), digits)


def exact_percentiles(
    df: DataFrame, by: Sequence[str], column: str, points: Mapping[str, float], partitions: int | None = None
) -> DataFrame:
    """Interpolated percentiles per group: columns ``by`` plus one per entry of ``points``.

    Same values as ``percentile(column, p)``, whose per-group map of all distinct
    values must fit one task, and which casts whole numbers to double.
    """
    known = df.filter(F.col(column).isNotNull())
    counts = value_counts(known, by, column, partitions, _rows=F.count(F.lit(1)))
    floating = isinstance(df.schema[column].dataType, (DoubleType, FloatType))
    ends = percentile_ends(counts, by, points)
    return ends.select(*by, *[between_ends(name, floating).alias(name) for name in points])


def beside(groups: DataFrame, spread: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per group with the other table's columns, NULL groups matching too."""
    others = [f"_other_{key}" for key in by]
    right = spread.select(
        *[F.col(key).alias(other) for key, other in zip(by, others)], *[c for c in spread.columns if c not in by]
    )
    return groups.join(right, _same(by, others), "left").drop(*others)


def with_exact_percentiles(
    df: DataFrame,
    by: Sequence[str],
    column: str,
    measures: Sequence[Column],
    points: Mapping[str, float],
    digits: int,
    exact: bool = True,
) -> DataFrame:
    """Aggregates per group next to rounded percentiles of one column.

    ``exact=False`` takes approximate percentiles in the same pass instead.
    """
    if not exact:
        quick = [F.round(F.percentile_approx(column, share), digits).alias(name) for name, share in points.items()]
        return df.groupBy(*by).agg(*measures, *quick)
    spread = exact_percentiles(df, by, column, points)
    rounded = spread.select(*by, *[F.round(name, digits).alias(name) for name in points])
    return beside(df.groupBy(*by).agg(*measures), rounded, by)


def ranking_quality(
    df: DataFrame, score: str, label: str, by: Sequence[str] = (), partitions: int | None = None
) -> DataFrame:
    """ROC-AUC and average precision per group, with the class counts.

    ROC-AUC is the share of (positive, negative) pairs ranked right, ties one
    half, from whole numbers; average precision is the sum of precision times recall
    gain over the distinct scores. Both are NULL where a class they need is absent.
    Rows without score or label are left out.
    """
    keys = list(by) or [_ALL]
    counted = value_counts(
        df.filter(F.col(score).isNotNull() & F.col(label).isNotNull()),
        by,
        score,
        partitions,
        _pos=F.count_if(F.col(label) == 1),
        _neg=F.count_if(F.col(label) == 0),
    )
    ranked = with_running_totals(counted, keys, ["_pos", "_neg"], descending=True)
    pos, neg = F.col("_pos"), F.col("_neg")
    tp, seen = F.col("_pos_upto"), (F.col("_pos_upto") + F.col("_neg_upto")).cast("double")
    # Twice the pairs ranked right: a tied pair counts once.
    pairs = F.sum(neg.cast("decimal(19,0)") * (2 * tp - pos).cast("decimal(19,0)")).cast("double")
    all_pos, all_neg = F.max("_pos_all").cast("double"), F.max("_neg_all").cast("double")
    gain = F.sum(F.when(seen > 0, pos.cast("double") * tp / seen))
    return (
        ranked.groupBy(*keys)
        .agg(
            F.sum(pos).alias("positives"),
            F.sum(neg).alias("negatives"),
            (pairs / F.nullif(2 * all_pos * all_neg, F.lit(0.0))).alias("roc_auc"),
            (gain / F.nullif(all_pos, F.lit(0.0))).alias("pr_auc"),
        )
        .drop(_ALL)
    )

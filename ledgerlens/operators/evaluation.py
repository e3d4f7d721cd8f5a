"""Data preparation and quality measures for classification."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.contract import LABEL_COLUMN, TEST_START, VALIDATION_START
from ledgerlens.functions.scores import over_threshold
from ledgerlens.operators.filters import between_times


def time_split(
    df: DataFrame,
    ts: str = "ts",
    validation_start: str = VALIDATION_START,
    test_start: str = TEST_START,
    column: str = "split",
) -> DataFrame:
    """Adds train / val / test by time, so that no later row informs an earlier one.

    A row without a time belongs to no split (NULL).
    """
    moment = F.col(ts)
    kind = df.schema[ts].dataType
    chosen = (
        F.when(moment < F.lit(validation_start).cast(kind), "train")
        .when(moment < F.lit(test_start).cast(kind), "val")
        .when(moment.isNotNull(), "test")
    )
    return df.withColumn(column, chosen)


def in_split(
    df: DataFrame,
    name: Literal["train", "val", "test"],
    ts: str = "ts",
    validation_start: str = VALIDATION_START,
    test_start: str = TEST_START,
) -> DataFrame:
    """The rows of one split as a time range, which a table laid out by month answers from the range's months."""
    bounds = {"train": (None, validation_start), "val": (validation_start, test_start), "test": (test_start, None)}
    return between_times(df, ts, *bounds[name])


def class_balance(df: DataFrame, label: str = LABEL_COLUMN) -> DataFrame:
    """One row: all rows, both classes, their shares in percent, and negatives per positive."""
    target = F.col(label)
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(target == 1).alias("fraud"),
        F.count_if(target == 0).alias("normal"),
    )
    whole = F.nullif(F.col("total"), F.lit(0))
    return counts.select(
        "*",
        (F.col("fraud") / whole * 100).alias("fraud_pct"),
        (F.col("normal") / whole * 100).alias("normal_pct"),
        (F.col("normal") / F.nullif(F.col("fraud"), F.lit(0))).alias("neg_per_pos"),
    )


def class_weights(
    df: DataFrame, label: str = LABEL_COLUMN, scheme: Literal["ratio", "balanced"] = "ratio"
) -> DataFrame:
    """Two rows ``(label, rows, weight)``; pass training rows only.

    ``ratio``: positives weigh negatives / positives, negatives 1.
    ``balanced``: each class weighs rows / (2 * its rows).
    A weight is NULL where its class is empty.
    """
    neg, pos = F.col("neg"), F.col("pos")
    some_neg, some_pos = F.nullif(neg, F.lit(0)), F.nullif(pos, F.lit(0))
    if scheme == "ratio":
        weights = (F.lit(1.0), neg / some_pos)
    elif scheme == "balanced":
        weights = ((neg + pos) / (2 * some_neg), (neg + pos) / (2 * some_pos))
    else:
        raise ValueError(f"unknown scheme {scheme!r}")
    counts = df.agg(
        F.count_if(F.col(label) == 0).alias("neg"), F.count_if(F.col(label) == 1).alias("pos")
    )
    entries = [
        F.struct(F.lit(value).alias("label"), rows.alias("rows"), weight.cast("double").alias("weight"))
        for value, rows, weight in zip((0, 1), (neg, pos), weights)
    ]
    return counts.select(F.inline(F.array(*entries)))


def with_class_weight(
    df: DataFrame, weights: DataFrame, label: str = LABEL_COLUMN, column: str = "weight"
) -> DataFrame:
    """``df`` with the weight of each row's class; ``weights`` has two rows by construction."""
    small = weights.select(F.col("label").alias("_class"), F.col("weight").alias(column))
    return df.join(F.broadcast(small), F.col(label) == F.col("_class"), "left").drop("_class")


def classification_report(
    df: DataFrame,
    score: str,
    label: str = LABEL_COLUMN,
    threshold: float = 0.5,
    inclusive: bool = True,
    by: Sequence[str] = (),
    names: tuple[str, str] = ("normal", "fraud"),
) -> DataFrame:
    """Precision, recall, F1 and support per class, plus the usual averages.

    One pass over the data counts the confusion matrix. A measure whose
    denominator is zero is 0.0. Rows without score or label are left out.
    """
    predicted = over_threshold(F.col(score), threshold, inclusive)
    actual = F.col(label) == 1
    rated = df.filter(F.col(score).isNotNull() & F.col(label).isin(0, 1))
    cells = rated.groupBy(*by).agg(
        F.count_if(actual & predicted).alias("tp"),
        F.count_if(~actual & predicted).alias("fp"),
        F.count_if(actual & ~predicted).alias("fn"),
        F.count_if(~actual & ~predicted).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(cell) for cell in ("tp", "fp", "fn", "tn"))
    total = tp + fp + fn + tn

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(part / F.nullif(whole.cast("double"), F.lit(0.0)), F.lit(0.0))

    def row(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            support.alias("support"),
        )

    # A class's own measures: hits, all predictions of it, all its members.
    per_class = [
        (share(hit, said), share(hit, members), share(2 * hit, said + members), members)
        for hit, said, members in ((tn, tn + fn, tn + fp), (tp, tp + fp, tp + fn))
    ]
    macro = [(a + b) / 2 for a, b in zip(per_class[0][:3], per_class[1][:3])]
    weighted = [
        share(a * per_class[0][3] + b * per_class[1][3], total)
        for a, b in zip(per_class[0][:3], per_class[1][:3])
    ]
    accuracy = share(tp + tn, total)
    rows = [row(name, *measures) for name, measures in zip(names, per_class)]
    rows += [
        row("accuracy", accuracy, accuracy, accuracy, total),
        row("macro avg", *macro, total),
        row("weighted avg", *weighted, total),
    ]
    return cells.select(*by, F.inline(F.array(*rows)))

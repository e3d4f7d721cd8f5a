"""Column selection operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerlens.contract import FEATURE_COLUMNS, LABEL_COLUMN, NON_MODEL_COLUMNS
from ledgerlens.functions.cleaning import to_number


def minimise(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Only the named columns leave; a missing one is an error, not a silent gap."""
    return df.select(*keep)


def exclude(df: DataFrame, columns: Iterable[str] = tuple(NON_MODEL_COLUMNS)) -> DataFrame:
    """All columns but the named ones; names that are absent are ignored."""
    return df.drop(*columns)


def numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns as doubles; values that are no number become NULL."""
    return df.withColumns({name: to_number(F.col(name)) for name in columns})


def feature_projection(
    df: DataFrame,
    features: Sequence[str] = FEATURE_COLUMNS,
    label: str | None = LABEL_COLUMN,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Model inputs as doubles in contract order, then the label, then carried columns."""
    inputs = [to_number(F.col(name)).alias(name) for name in features]
    target = [F.col(label)] if label else []
    return df.select(*inputs, *target, *carry)


def tagged(df: DataFrame, name: str, column: str = "tbl") -> DataFrame:
    """Adds a constant column naming where the rows came from."""
    return df.withColumn(column, F.lit(name))

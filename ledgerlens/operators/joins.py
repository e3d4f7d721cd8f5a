"""Left lookups of a fact table in its dimensions.

No join is hinted. Spark broadcasts a dimension whose measured size is below
``spark.sql.autoBroadcastJoinThreshold`` (at planning from file sizes, again at
run time under AQE); a larger one is sort-merged, and AQE splits the partition
of a foreign key that holds a large share of the fact rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


class DuplicateKeyError(ValueError):
    """A dimension key occurs more than once, so a lookup would multiply fact rows."""


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Non-NULL keys that occur more than once, with their row counts."""
    present = df
    for key in keys:
        present = present.filter(F.col(key).isNotNull())
    return (
        present.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > 1)
    )


def assert_unique_key(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` itself, once its key is known to be unique."""
    offender = duplicate_keys(df, *keys).first()
    if offender is not None:
        raise DuplicateKeyError(f"key {keys} is not unique: {offender.asDict()}")
    return df


def left_lookup(fact: DataFrame, dimension: DataFrame, fact_key: str, key: str) -> DataFrame:
    """All fact rows, with the dimension's other columns or NULLs where nothing matches."""
    clash = (set(fact.columns) & set(dimension.columns)) - {key}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    own = f"_{key}_looked_up"
    renamed = dimension.withColumnRenamed(key, own)
    return fact.join(renamed, F.col(fact_key) == F.col(own), "left").drop(own)


def enrich(
    fact: DataFrame,
    labels: DataFrame,
    cards: DataFrame,
    users: DataFrame,
    codes: DataFrame,
    verify_keys: bool = True,
) -> DataFrame:
    """Star enrichment: labels, cards, users and category names around the fact rows.

    ``labels(transaction_id, is_fraud)``, ``cards(id, …)``, ``users(id, …)`` and
    ``codes(mcc_code, mcc_name)`` must each be unique in their first column for
    the fact row count to be preserved; ``verify_keys`` checks that up front.
    """
    sides = [
        (labels, "transaction_id", "transaction_id"),
        (codes, "mcc", "mcc_code"),
        (users, "client_id", "id"),
        # Last, so that rows shuffled by card can go on into per-card windows.
        (cards, "card_id", "id"),
    ]
    for dimension, fact_key, key in sides:
        if verify_keys:
            assert_unique_key(dimension, key)
        fact = left_lookup(fact, dimension, fact_key, key)
    return fact

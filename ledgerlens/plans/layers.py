"""Bronze, silver and gold tables."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlens.contract import (
    CARD_COLUMNS,
    CARDS_SCHEMA,
    SILVER_COLUMNS,
    TABLE_TAGS,
    TRANSACTIONS_SCHEMA,
    USER_COLUMNS,
    USERS_SCHEMA,
)
from ledgerlens.functions.cleaning import (
    blank_to_null,
    encode_label,
    flag,
    guarded_ratio,
    parse_currency,
    parse_timestamp,
)
from ledgerlens.operators.columns import minimise
from ledgerlens.operators.filters import month_of, present, with_month
from ledgerlens.operators.joins import enrich
from ledgerlens.operators.quality import Rule, apply_rules, stored_metrics, with_outcomes
from ledgerlens.operators.rolling import CARD_FEATURES, rolling_features
from ledgerlens.sources.readers import read_csv, read_json_dict, with_ingest_columns
from ledgerlens.sources.store import TableStore


#: How silver and gold tables are partitioned.
LAYOUT = [month_of("ts")]


#: The keys that lookups need to be unique.
LOOKUP_KEYS = {"labels": "transaction_id", "cards": "id", "users": "id", "codes": "mcc_code"}


class Bronze(NamedTuple):
    transactions: DataFrame
    cards: DataFrame
    users: DataFrame
    labels: DataFrame
    codes: DataFrame


# The rules see the raw id under the name it has in the silver table.
SILVER_RULES = [
    Rule("valid_transaction_id", "transaction_id IS NOT NULL", "drop"),
    Rule("valid_card_id", "card_id IS NOT NULL", "drop"),
    Rule("valid_client_id", "client_id IS NOT NULL", "drop"),
    Rule("valid_amount", "amount IS NOT NULL", "warn"),
]

TRAINING_RULES = [
    Rule("has_label", "is_fraud IS NOT NULL", "drop"),
    Rule("valid_label", "is_fraud IN (0, 1)", "drop"),
]


def build_bronze(spark: SparkSession, paths: Mapping[str, str]) -> Bronze:
    """Raw files as they are, with ingestion metadata.

    ``paths`` holds transactions, cards, users, labels and codes.
    """
    labels = read_json_dict(
        spark, paths["labels"], "transaction_id", "label", "bigint", root="target", splittable=True
    )
    codes = read_json_dict(spark, paths["codes"], "mcc_code", "mcc_name", "int")
    return Bronze(
        with_ingest_columns(read_csv(spark, paths["transactions"], TRANSACTIONS_SCHEMA), source_file=True),
        with_ingest_columns(read_csv(spark, paths["cards"], CARDS_SCHEMA)),
        with_ingest_columns(read_csv(spark, paths["users"], USERS_SCHEMA)),
        with_ingest_columns(labels),
        with_ingest_columns(codes),
    )


def clean_transactions(raw: DataFrame) -> DataFrame:
    return raw.withColumnRenamed("id", "transaction_id").withColumns(
        {
            "amount": parse_currency(F.col("amount")),
            "ts": parse_timestamp(F.col("date")),
            "errors": blank_to_null(F.col("errors")),
        }
    )


def clean_cards(raw: DataFrame) -> DataFrame:
    """Card attributes without number, expiry and check code."""
    cleaned = raw.withColumn("credit_limit", parse_currency(F.col("credit_limit")))
    return minimise(cleaned, ["id", *CARD_COLUMNS])


def clean_users(raw: DataFrame) -> DataFrame:
    """User attributes without address and birth date."""
    money = ["yearly_income", "total_debt", "per_capita_income"]
    cleaned = raw.withColumns({name: parse_currency(F.col(name)) for name in money})
    return minimise(cleaned, ["id", *USER_COLUMNS])


def clean_labels(raw: DataFrame) -> DataFrame:
    return raw.select("transaction_id", encode_label(F.col("label")).alias("is_fraud"))


def clean_codes(raw: DataFrame) -> DataFrame:
    return raw.select("mcc_code", "mcc_name")


def build_silver(bronze: Bronze, verify_keys: bool = True) -> DataFrame:
    """Cleaned transactions that pass the rules, with all lookups; unlabelled rows stay."""
    # Dropping rows without ids first keeps NULL keys out of the label join.
    fact = apply_rules(clean_transactions(bronze.transactions), SILVER_RULES)
    star = enrich(
        fact,
        clean_labels(bronze.labels),
        clean_cards(bronze.cards),
        clean_users(bronze.users),
        clean_codes(bronze.codes),
        verify_keys=verify_keys,
    )
    return star.select(*SILVER_COLUMNS)


def with_time_features(df: DataFrame) -> DataFrame:
    ts = F.col("ts")
    return df.withColumns(
        {"hour_of_day": F.hour(ts), "day_of_week": F.dayofweek(ts), "month": F.month(ts)}
    )


def with_type_flags(df: DataFrame) -> DataFrame:
    kinds = {"is_online": "Online Transaction", "is_chip": "Chip Transaction", "is_swipe": "Swipe Transaction"}
    return df.withColumns({name: flag(F.col("use_chip") == kind) for name, kind in kinds.items()})


def with_amount_features(df: DataFrame) -> DataFrame:
    amount = F.col("amount")
    return df.withColumns({"is_refund": flag(amount < 0), "abs_amount": F.abs(amount)})


def with_risk_features(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "has_error": flag(F.col("errors").isNotNull()),
            "is_dark_web": flag(F.col("card_on_dark_web") == "Yes"),
            "has_chip_flag": flag(F.col("has_chip") == "YES"),
            "debt_to_income": guarded_ratio(F.col("total_debt"), F.col("yearly_income")),
        }
    )


def with_row_features(df: DataFrame) -> DataFrame:
    """All features that need only the row itself."""
    for step in (with_time_features, with_type_flags, with_amount_features, with_risk_features):
        df = step(df)
    return df


def build_gold_features(silver: DataFrame, **rolling_options) -> DataFrame:
    """Silver rows with row features and each card's rolling history.

    Options go to ``rolling_features``; pass ``key_source`` when ``silver`` is
    not a stored table.
    """
    return rolling_features(with_row_features(silver), "card_id", "ts", CARD_FEATURES, **rolling_options)


def build_gold_training(features: DataFrame) -> DataFrame:
    """Labelled rows. Comes after the features: unlabelled rows are part of every history."""
    return apply_rules(present(features, "is_fraud"), TRAINING_RULES)


def build_lakehouse(spark: SparkSession, paths: Mapping[str, str], store: TableStore) -> TableStore:
    """Raw files to stored bronze, silver and gold tables, each read back from storage.

    Silver and gold are laid out by month (``ts_month``), which ``between_times``,
    ``trailing`` and ``in_split`` turn into a choice of folders. Bronze transactions
    keep the outcomes of the silver rules (``_rules``).
    """
    raw = build_bronze(spark, paths)
    raw = raw._replace(transactions=with_outcomes(raw.transactions, SILVER_RULES, prepare=clean_transactions))
    names = {
        "transactions": "Raw card transactions",
        "cards": "Raw card profiles",
        "users": "Raw user profiles",
        "labels": "Raw fraud labels",
        "codes": "Merchant category names",
    }
    bronze = Bronze(
        *[
            store.write(frame, "bronze", name, names[name], sources=[paths[name]], unique_key=LOOKUP_KEYS.get(name))
            for name, frame in raw._asdict().items()
        ]
    )
    silver = store.write(
        with_month(build_silver(bronze, verify_keys=False)),  # checked when they were written
        "silver",
        "transactions",
        "Cleaned transactions with labels, cards, users and categories",
        sources=[store.full_name("bronze", name) for name in names],
        partition_by=LAYOUT,
    )
    # Counted from the bits stored with the rows, not observed during the write:
    # tasks repeated after a lost executor would be observed twice.
    store.record_quality("silver", "transactions", stored_metrics(bronze.transactions, SILVER_RULES))
    features = store.write(
        build_gold_features(silver),
        "gold",
        "fraud_features",
        "Model-ready features with 1h, 24h and 7d card history",
        tags=TABLE_TAGS["fraud_features"],
        sources=[store.full_name("silver", "transactions")],
        partition_by=LAYOUT,
    )
    store.write(
        build_gold_training(features),
        "gold",
        "fraud_training",
        "Labelled rows of the features",
        tags=TABLE_TAGS["fraud_training"],
        sources=[store.full_name("gold", "fraud_features")],
        partition_by=LAYOUT,
    )
    return store

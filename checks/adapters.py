"""The raw inputs, rebuilt by Spark from the driver's test tables.

``events`` play the transactions (their user is both card and client),
``customer`` the cards and users, ``labels`` the fraud labels and ``nation`` the
category names. Everything has the schema and text formats of the raw files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlens.plans.layers import (
    Bronze,
    build_gold_features,
    build_gold_training,
    build_silver,
    with_row_features,
)

AS_OF = "2024-01-31 00:00:00"
ENDPOINT = "fraud-endpoint"

# The labelled events span the first three days.
VALIDATION_START = "2024-01-02 12:00:00"
TEST_START = "2024-01-03 06:00:00"


# Declared, so that no load has to open files for their schema.
SCHEMAS = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def money(value: str) -> str:
    """SQL for the currency text of a numeric expression."""
    return f"concat('$', format_number({value}, 2))"


K = "cast(get_json_object(props, '$.k') as int)"


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").selectExpr("*", f"{K} AS k").selectExpr(
        "event_id AS id",
        "date_format(ts, 'yyyy-MM-dd HH:mm:ss') AS date",
        "user_id AS client_id",
        "user_id AS card_id",
        money("CASE WHEN event_type = 'signup' THEN -value ELSE value END") + " AS amount",
        """CASE event_type WHEN 'purchase' THEN 'Online Transaction' WHEN 'click' THEN 'Chip Transaction'
            WHEN 'signup' THEN 'Chip Transaction' ELSE 'Swipe Transaction' END AS use_chip""",
        "cast(k AS bigint) AS merchant_id",
        "concat('City ', k) AS merchant_city",
        "CASE WHEN event_type = 'purchase' THEN '' ELSE concat('NATION_', k % 25) END AS merchant_state",
        "lpad(cast(k AS string), 5, '0') AS zip",
        "k AS mcc",
        """CASE WHEN event_type = 'error' AND k % 2 = 0 THEN 'Bad PIN'
            WHEN event_type = 'error' THEN 'Insufficient Balance' WHEN k % 7 = 0 THEN '' END AS errors""",
    )


def raw_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id",
        "c_custkey AS client_id",
        "array('Visa', 'Mastercard', 'Discover', 'Amex')[cast(c_custkey % 4 AS int)] AS card_brand",
        "array('Debit', 'Credit', 'Debit (Prepaid)')[c_nationkey % 3] AS card_type",
        "lpad(cast(c_custkey AS string), 16, '4') AS card_number",
        "'12/2030' AS expires",
        "'123' AS cvv",
        "CASE WHEN c_custkey % 2 = 0 THEN 'YES' ELSE 'NO' END AS has_chip",
        "c_nationkey % 3 + 1 AS num_cards_issued",
        f"{money('c_acctbal')} AS credit_limit",
        "'01/2010' AS acct_open_date",
        "c_nationkey % 15 + 2005 AS year_pin_last_changed",
        "CASE WHEN c_custkey % 10 = 0 THEN 'Yes' ELSE 'No' END AS card_on_dark_web",
    )


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id",
        "cast(c_custkey % 60 + 18 AS int) AS current_age",
        "65 AS retirement_age",
        "cast(c_custkey % 60 + 1940 AS int) AS birth_year",
        "cast(c_custkey % 12 + 1 AS int) AS birth_month",
        "CASE WHEN c_nationkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender",
        "c_name AS address",
        "cast(c_nationkey * 1.5 AS double) AS latitude",
        "cast(c_nationkey * -2.5 AS double) AS longitude",
        money("cast(c_nationkey * 1000 AS double)") + " AS per_capita_income",
        money("greatest(c_acctbal, 0D)") + " AS yearly_income",
        money("cast(c_custkey * 7 % 100000 AS double)") + " AS total_debt",
        "cast(c_custkey % 371 + 480 AS int) AS credit_score",
        "c_nationkey % 5 + 1 AS num_credit_cards",
    )


def raw_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "labels").selectExpr(
        "doc_id AS transaction_id", "CASE WHEN toxic = 1 THEN 'Yes' ELSE 'No' END AS label"
    )


def raw_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "nation").selectExpr("n_nationkey AS mcc_code", "n_name AS mcc_name")


def bronze(spark: SparkSession, sf_dir: str) -> Bronze:
    return Bronze(*[make(spark, sf_dir) for make in (raw_transactions, raw_cards, raw_users, raw_labels, raw_codes)])


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_silver(bronze(spark, sf_dir), verify_keys=False)


def card_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card and time of every transaction, for the count of crowded frames, without the joins of silver."""
    return load(spark, sf_dir, "events").select(F.col("user_id").alias("card_id"), "ts")


def row_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_row_features(silver(spark, sf_dir))


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_gold_features(silver(spark, sf_dir), key_source=card_keys(spark, sf_dir))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled rows as far as the reports need them (no rolling features)."""
    return build_gold_training(row_features(spark, sf_dir))


def dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as labelled amounts over several years; events span one month only."""
    status = F.col("o_orderstatus")
    return load(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.col("o_totalprice").alias("abs_amount"),
        F.when(status == "F", 1).when(status == "O", 0).alias("is_fraud"),
    )


def request_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inference log: plain and named predictions, some empty; two versions, two endpoints."""
    key, score = F.col("event_id"), F.col("value") / 500
    response = (
        F.when(key % 17 == 0, F.lit('{"predictions":[]}'))
        .when(key % 3 == 0, F.concat(F.lit('{"predictions":[{"fraud_probability":'), score, F.lit("}]}")))
        .otherwise(F.concat(F.lit('{"predictions":['), score, F.lit("]}")))
    )
    return load(spark, sf_dir, "events").select(
        key.alias("transaction_id"),
        F.lit("card_model").alias("model_name"),
        F.concat(F.lit("v"), key % 2 + 1).alias("model_version"),
        F.when(key % 10 == 0, "other").otherwise(ENDPOINT).alias("endpoint_name"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        response.alias("response"),
        F.col("value").alias("execution_duration_ms"),
    )


def scored_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled events with ``value / 500`` as their score."""
    events = load(spark, sf_dir, "events").select(
        F.col("event_id").alias("transaction_id"), (F.col("value") / 500).alias("score")
    )
    known = load(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("transaction_id"), F.col("toxic").alias("is_fraud")
    )
    return events.join(known, "transaction_id")


def lineage_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").selectExpr("*", f"{K} AS k").selectExpr(
        "concat('lake.silver.', event_type) AS source_table_full_name",
        "concat(CASE WHEN k % 2 = 0 THEN 'lake.gold.' ELSE 'archive.gold.' END, 't', k % 5) AS target_table_full_name",
        "ts AS created_at",
    )

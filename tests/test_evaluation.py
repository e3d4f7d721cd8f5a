import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.evaluation import (
    class_balance,
    class_weights,
    classification_report,
    time_split,
    with_class_weight,
)
from ledgerlens.plans import model_reports, reports


def test_split_is_disjoint_and_complete(spark):
    df = spark.sql("SELECT CAST(d AS timestamp) ts FROM VALUES ('2017-12-31 23:59:59'), ('2018-01-01'), ('2018-12-31'), ('2019-01-01'), (NULL) t(d)")
    assert [r.split for r in time_split(df).collect()] == ["train", "val", "val", "test", None]
    zoneless = df.select(F.col("ts").cast("timestamp_ntz").alias("ts"))
    assert [r.split for r in time_split(zoneless).collect()] == ["train", "val", "val", "test", None]


def labels(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "is_fraud int")


def test_class_balance(spark):
    row = class_balance(labels(spark, 0, 0, 0, 1)).first()
    assert (row.total, row.fraud, row.normal, row.fraud_pct, row.neg_per_pos) == (4, 1, 3, 25.0, 3.0)


def test_class_without_rows_has_no_ratio(spark):
    assert class_balance(labels(spark, 0, 0)).first().neg_per_pos is None
    assert class_balance(labels(spark)).first().fraud_pct is None
    assert {r.label: r.weight for r in class_weights(labels(spark, 0, 0)).collect()} == {0: 1.0, 1: None}
    assert {r.label: r.weight for r in class_weights(labels(spark, 0), scheme="balanced").collect()} == {0: 0.5, 1: None}


def test_class_weights(spark):
    df = labels(spark, 0, 0, 0, 1)
    assert {r.label: r.weight for r in class_weights(df).collect()} == {0: 1.0, 1: 3.0}
    balanced = class_weights(df, scheme="balanced")
    assert {r.label: r.weight for r in balanced.collect()} == {0: pytest.approx(4 / 6), 1: 2.0}
    weighted = with_class_weight(df, balanced)
    assert weighted.agg(F.sum("weight")).first()[0] == pytest.approx(4.0)  # balanced weights keep the total
    with pytest.raises(ValueError):
        class_weights(df, scheme="other")


def test_report_at_the_threshold(spark):
    df = spark.createDataFrame(
        [(0.5, 1), (0.9, 1), (0.1, 1), (0.5, 0), (0.2, 0), (None, 1), (0.9, None)], "score double, is_fraud int"
    )
    at = {r["class"]: r for r in classification_report(df, "score").collect()}
    assert (at["fraud"].precision, at["fraud"].recall, at["fraud"].support) == (pytest.approx(2 / 3), pytest.approx(2 / 3), 3)
    assert (at["normal"].precision, at["normal"].recall, at["normal"].support) == (0.5, 0.5, 2)
    assert at["accuracy"].f1 == 0.6 and at["macro avg"].recall == pytest.approx((2 / 3 + 0.5) / 2)
    assert at["weighted avg"].precision == pytest.approx((0.5 * 2 + 2 / 3 * 3) / 5)
    above = {r["class"]: r for r in classification_report(df, "score", inclusive=False).collect()}
    assert (above["fraud"].precision, above["fraud"].recall) == (1.0, pytest.approx(1 / 3))


def test_report_without_predictions(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0)], "score double, is_fraud int")
    fraud = classification_report(df, "score").filter("class = 'fraud'").first()
    assert (fraud.precision, fraud.recall, fraud.f1, fraud.support) == (0.0, 0.0, 0.0, 0)


LOG = "transaction_id long, model_name string, model_version string, endpoint_name string, timestamp timestamp, response string, execution_duration_ms double"


def test_model_reports(spark):
    def log(i, version, response, ms, when="2024-01-30 00:00:00", endpoint="ep"):
        return (i, "m", version, endpoint, when, response, ms)

    rows = [
        log(1, "v1", '{"predictions":[0.5]}', 10.0),
        log(2, "v1", '{"predictions":[{"fraud_probability":0.95}]}', 30.0),
        log(3, "v1", "{}", 20.0),
        log(4, "v2", '{"predictions":[0.3]}', 5.0),
        log(5, "v1", '{"predictions":[0.9]}', 9.0, when="2024-01-01 00:00:00"),
        log(6, "v1", '{"predictions":[0.9]}', 9.0, endpoint="other"),
    ]
    logs = spark.createDataFrame(rows, LOG.replace("timestamp timestamp", "timestamp string")).withColumn(
        "timestamp", F.col("timestamp").cast("timestamp")
    )
    args = {"endpoint": "ep", "as_of": "2024-01-31 00:00:00"}
    first, second = model_reports.model_comparison(logs, **args).collect()
    assert (first.model_version, first.total_requests, first.avg_fraud_score, first.fraud_flagged) == ("v1", 3, 0.725, 1)
    assert (first.fraud_flag_rate_pct, first.avg_latency_ms, first.p95_latency_ms) == (33.3333, 20.0, 29.0)
    assert (second.model_version, second.total_requests, second.fraud_flagged) == ("v2", 1, 0)
    buckets = [tuple(r) for r in model_reports.score_distribution(logs, **args).collect()]
    assert buckets == [("v1", "0.5–0.7", 1), ("v1", "0.9–1.0", 1), ("v1", "unscored", 1), ("v2", "0.3–0.5", 1)]
    outcomes = spark.createDataFrame([(1, 0), (2, 1)], "transaction_id long, is_fraud int")
    v1, v2 = model_reports.ab_evaluation(logs, outcomes, record_id="transaction_id", **args).collect()
    assert (v1.total_requests, v1.precision, v1.recall, v1.roc_auc, v1.pr_auc) == (3, 0.5, 1.0, 1.0, 1.0)
    assert v2.total_requests == 1 and v2.roc_auc is None


def test_report_edges(spark):
    df = spark.createDataFrame(
        [
            (1, 1, "a", 1, 10.0, "CA", None, 0),
            (1, 0, "a", 2, 20.0, "", "Bad PIN", 0),
            (2, 1, "b", 1, 30.0, None, None, 1),
            (3, 0, None, None, 40.0, "NY", None, None),
        ],
        "client_id long, is_fraud int, use_chip string, mcc int, abs_amount double, merchant_state string, errors string, is_refund int",
    ).withColumn("mcc_name", F.lit(None).cast("string"))
    assert [(r.mcc, r.fraud_rate_pct, r.avg_fraud_amount) for r in reports.top_mcc_fraud(df).collect()] == [(1, 100.0, 20.0)]
    assert [(r.mcc, r.fraud_rate_pct) for r in reports.mcc_fraud_rate(df).collect()] == [(1, 100.0), (None, 0.0), (2, 0.0)]
    assert [r.merchant_state for r in reports.fraud_by_state(df).collect()] == ["CA", "NY"]
    assert [(r.error_type, r.total_tx) for r in reports.error_vs_fraud(df).collect()] == [("No Error", 3), ("Bad PIN", 1)]
    # Ties are ordered by the customer, customers without fraud are left out.
    assert [(r.client_id, r.total_fraud_amount) for r in reports.high_risk_customers(df).collect()] == [(1, 10.0), (2, 30.0)]
    assert reports.high_risk_customers(df, k=1).count() == 1
    spread = {r.is_fraud: r for r in reports.amount_distribution(df).collect()}
    assert (spread[0].median_amount, spread[0].p95_amount, spread[1].max_amount) == (30.0, 39.0, 30.0)
    unknown = df.withColumn("abs_amount", F.when(F.col("client_id") < 3, F.col("abs_amount")))
    spread = {r.is_fraud: r for r in reports.amount_distribution(unknown).collect()}
    assert (spread[0]["count"], spread[0].avg_amount, spread[0].max_amount) == (2, 20.0, 20.0)
    unknown = df.withColumn("abs_amount", F.when(F.col("is_fraud") == 1, F.col("abs_amount")))
    spread = {r.is_fraud: r for r in reports.amount_distribution(unknown).collect()}
    assert (spread[0]["count"], spread[0].avg_amount, spread[0].median_amount) == (2, None, None)
    assert reports.amount_distribution(df, exact=False).columns == reports.amount_distribution(df).columns
    assert {r.is_refund: r.total_tx for r in reports.refund_vs_fraud(df).collect()} == {0: 2, 1: 1, None: 1}

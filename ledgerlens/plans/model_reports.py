"""Comparison of model versions over inference logs and labelled outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.functions.measures import (
    MONEY_DIGITS,
    SCORE_DIGITS,
    WIDE,
    exact_total,
    half_up,
    rate_pct,
    rounded_mean,
    row_count,
    units,
)
from ledgerlens.functions.scores import bucketize, over_threshold, score_from_response
from ledgerlens.operators.distribution import (
    beside,
    percentile_ends,
    ranking_quality,
    rounded_between_ends,
    value_counts,
)
from ledgerlens.operators.evaluation import classification_report
from ledgerlens.operators.filters import equal_to, trailing
from ledgerlens.session import cut_lineage


def recent_requests(
    logs: DataFrame, endpoint: str, days: int = 7, as_of: str | Column | None = None
) -> DataFrame:
    """Requests to an endpoint in the last ``days`` days, with their score."""
    recent = trailing(equal_to(logs, "endpoint_name", endpoint), "timestamp", days, as_of)
    return recent.withColumn("score", score_from_response(F.col("response")))


def model_comparison(
    logs: DataFrame,
    endpoint: str,
    days: int = 7,
    as_of: str | Column | None = None,
    threshold: float = 0.5,
    exact: bool = True,
) -> DataFrame:
    """Volume, scores, flags and latency per model version.

    The log is read once: everything follows from one row per version and latency.
    """
    requests = recent_requests(logs, endpoint, days, as_of)
    flagged = F.count_if(over_threshold(F.col("score"), threshold))
    keys, points = ["model_name", "model_version"], {"p95_latency_ms": 0.95}
    order = ["model_version", "model_name"]
    if not exact:
        return requests.groupBy(*keys).agg(
            row_count().alias("total_requests"),
            rounded_mean(F.col("score"), 4, SCORE_DIGITS).alias("avg_fraud_score"),
            flagged.alias("fraud_flagged"),
            rate_pct(flagged, row_count()).alias("fraud_flag_rate_pct"),
            rounded_mean(F.col("execution_duration_ms"), 1).alias("avg_latency_ms"),
            *[F.round(F.percentile_approx("execution_duration_ms", p), 1).alias(name) for name, p in points.items()],
        ).orderBy(*order)
    counted = value_counts(
        requests,
        keys,
        units(F.col("execution_duration_ms")),
        _rows=row_count(),
        _scored=F.count("score"),
        _score=exact_total(units(F.col("score"), SCORE_DIGITS)),
        _flagged=flagged,
    )
    known = F.sum(F.when(F.col("_value").isNotNull(), F.col("_rows"))).cast(WIDE)
    latency = F.sum(F.col("_value").cast("decimal(19,0)") * F.col("_rows").cast("decimal(19,0)"))
    scored = F.sum("_scored").cast(WIDE) * F.lit(10**SCORE_DIGITS).cast("decimal(10,0)")
    basics = counted.groupBy(*keys).agg(
        F.sum("_rows").alias("total_requests"),
        half_up(F.sum("_score"), scored, 4).alias("avg_fraud_score"),
        F.sum("_flagged").alias("fraud_flagged"),
        rate_pct(F.sum("_flagged"), F.sum("_rows")).alias("fraud_flag_rate_pct"),
        half_up(latency, known * F.lit(10**MONEY_DIGITS).cast("decimal(5,0)"), 1).alias("avg_latency_ms"),
    )
    ends = percentile_ends(counted, keys, points)
    spread = ends.select(*keys, *[rounded_between_ends(p, 1, MONEY_DIGITS).alias(p) for p in points])
    return beside(basics, spread, keys).orderBy(*order)


def score_distribution(
    logs: DataFrame, endpoint: str, days: int = 7, as_of: str | Column | None = None
) -> DataFrame:
    """Requests per model version and score interval; absent scores are ``unscored``."""
    requests = recent_requests(logs, endpoint, days, as_of)
    return (
        requests.groupBy("model_version", bucketize(F.col("score")).alias("score_bucket"))
        .agg(row_count().alias("count"))
        .orderBy("model_version", "score_bucket")
    )


def ab_evaluation(
    logs: DataFrame,
    outcomes: DataFrame,
    endpoint: str,
    record_id: str,
    days: int = 7,
    as_of: str | Column | None = None,
    threshold: float = 0.5,
) -> DataFrame:
    """Traffic and quality per model version, side by side.

    ``logs`` carries ``record_id``; ``outcomes(record_id, is_fraud)`` holds the
    labels known so far. Quality covers the labelled requests only.
    """
    requests = recent_requests(logs, endpoint, days, as_of)
    flagged = F.count_if(over_threshold(F.col("score"), threshold))
    traffic = requests.groupBy("model_version").agg(
        row_count().alias("total_requests"),
        flagged.alias("fraud_flagged"),
        rounded_mean(F.col("score"), 4, SCORE_DIGITS).alias("avg_fraud_score"),
    )
    labelled = requests.select(record_id, "model_version", "score").join(
        outcomes.select(record_id, "is_fraud"), record_id
    )
    known = cut_lineage(labelled.drop(record_id))  # read by both measures below
    fraud = (
        classification_report(known, "score", threshold=threshold, inclusive=True, by=["model_version"])
        .filter(F.col("class") == "fraud")
        .drop("class")
    )
    ranking = ranking_quality(known, "score", "is_fraud", by=["model_version"])
    quality = fraud.join(ranking, "model_version", "left")
    return traffic.join(quality, "model_version", "left").orderBy("model_version")

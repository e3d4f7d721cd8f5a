"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and
BENCH_RUNS (default 3) steer it. Every query is run to completion with all its
columns (``noop`` sink); the best run counts. Timing includes the jobs a query
starts while it is being built. Named queries run instead of the headline ones,
e.g. ``bench.py hot_card_windows`` for the plan that hot cards are kept from.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from checks import adapters as a  # noqa: E402
from checks.registry import QUERIES  # noqa: E402
from ledgerlens.operators.rolling import CARD_FEATURES, rolling_features, rolling_windows  # noqa: E402
from ledgerlens.plans.layers import clean_transactions, with_amount_features  # noqa: E402
from ledgerlens.session import get_session  # noqa: E402

HEADLINE = [
    "star_enrich", "roll_1h", "roll_24h", "roll_24h_distinct", "roll_7d", "roll_sliced",
    "gold_features", "gold_training",
    "fraud_by_month", "fraud_by_type", "top_mcc_fraud", "fraud_by_hour", "fraud_by_state",
    "amount_distribution", "error_vs_fraud", "high_risk_customers", "fraud_by_brand", "refund_vs_fraud",
    "model_comparison", "score_distribution", "roc_auc", "pr_auc", "classification_report", "rules_metrics",
]


def skewed(spark, sf_dir):
    """Transactions of which every third is moved to one card."""
    rows = with_amount_features(clean_transactions(a.raw_transactions(spark, sf_dir)))
    hot = F.when(F.col("transaction_id") % 3 == 0, -1).otherwise(F.col("card_id"))
    return rows.withColumn("card_id", hot)


def hot_card_windows(spark, sf_dir):
    return rolling_windows(skewed(spark, sf_dir), "card_id", "ts", CARD_FEATURES)


def hot_card_routed(spark, sf_dir):
    return rolling_features(skewed(spark, sf_dir), "card_id", "ts", CARD_FEATURES)


def largest_group(spark, sf_dir) -> int:
    cards = a.card_keys(spark, sf_dir).groupBy("card_id").count()
    return cards.agg(F.max("count")).first()[0]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = sys.argv[1:]
    spark = get_session(
        "bench", master=f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = {**QUERIES, "hot_card_routed": hot_card_routed, "hot_card_windows": hot_card_windows}
    todo = {name: known[name] for name in chosen or [*HEADLINE, "hot_card_routed"]}
    timings = {}
    for name, run in todo.items():
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        timings[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "total_headline_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": int(cpus),
                "max_rows_per_card": largest_group(spark, sf_dir),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

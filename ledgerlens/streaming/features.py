"""Gold features kept up to date while transactions arrive.

A micro-batch adds its rows to silver and recomputes the features of the rows that
it can change: those of its cards from its first time on until a week after its last
(the longest frame), with a week of history before. Late rows therefore correct the
features of rows that came earlier. Work follows the cards and times of the batch,
never the tables.

Every row carries the number of the batch that wrote it, and a batch replaces its own
partitions only, so a batch that is repeated after a failure changes nothing. A row
computed again is a newer version; ``retired`` lists which rows have one. Readers
see versions up to the last finished batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.operators.filters import between_times, with_month
from ledgerlens.operators.rolling import CARD_FEATURES
from ledgerlens.plans.layers import LAYOUT, Bronze, build_gold_features, build_silver
from ledgerlens.session import cut_lineage
from ledgerlens.sources.store import TableStore

LONGEST = max(spec.seconds for spec in CARD_FEATURES)
VERSIONS = [*LAYOUT, "batch"]
#: Months of a micro-batch, with the week after it, that are written without a shuffle by month.
FEW_MONTHS = 3
#: What tells rows apart in ``retired``.
ROW = ["transaction_id", "card_id"]


def drain_features(
    stream: DataFrame, store: TableStore, cards: DataFrame, users: DataFrame, labels: DataFrame, codes: DataFrame, checkpoint: str
) -> StreamingQuery:
    """Takes all arrived transactions into silver and gold and returns when done."""

    def take(arrived: DataFrame, number: int) -> None:
        apply_batch(store, Bronze(arrived, cards, users, labels, codes), number)

    query = (
        stream.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def apply_batch(store: TableStore, arrived: Bronze, number: int) -> None:
    """One micro-batch; may be repeated."""
    rows = with_month(build_silver(arrived, verify_keys=False)).withColumn("batch", F.lit(number))
    silver = store.write(
        rows, "silver", "transactions", "Cleaned transactions by batch", partition_by=VERSIONS, replace="partitions"
    )
    touched = cut_lineage(
        silver.filter(F.col("batch") == number)
        .groupBy("card_id")
        .agg(
            F.min("ts").alias("_from"),
            (F.max("ts") + F.make_dt_interval(secs=F.lit(LONGEST))).alias("_to"),
            (F.count_if(F.col("ts").isNull()) > 0).alias("_untimed"),
        )
    )
    span = touched.agg(F.min("_from").alias("first"), F.max("_to").alias("last"), F.max("_untimed").alias("untimed")).first()
    if span.untimed is not None:
        recompute(store, silver, touched, span, number)
    store.finish_batch(number)


def recompute(store: TableStore, silver: DataFrame, touched: DataFrame, span, number: int) -> None:
    seen = silver.filter(F.col("batch") <= number)
    week = F.make_dt_interval(secs=F.lit(LONGEST))
    timed = F.col("ts").between(F.col("_from"), F.col("_to")) | (F.col("ts").isNull() & F.col("_untimed"))
    near = F.col("ts").between(F.col("_from") - week, F.col("_to")) | (F.col("ts").isNull() & F.col("_untimed"))
    parts: list[DataFrame] = []
    if span.first is not None:
        bounds = silver.sparkSession.range(1).select(
            (F.lit(span.first) - week).cast("string").alias("first"),
            (F.lit(span.last) + F.make_dt_interval(secs=F.lit(1))).cast("string").alias("last"),
        ).first()
        parts.append(between_times(seen, "ts", bounds.first, bounds.last))
    if span.untimed:
        parts.append(seen.filter(F.col("ts").isNull() & F.col(LAYOUT[0]).isNull()))
    context = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    context = context.join(touched, "card_id").filter(near).withColumnRenamed("batch", "_came")
    # From the ids alone, so the features need not be stored before they are written.
    older = context.filter(timed & (F.col("_came") < number)).select(*ROW).distinct().withColumn("batch", F.lit(number))
    store.write(older, "gold", "retired", "Rows with a newer version", partition_by=["batch"], replace="partitions", rebalance=False)
    # Dealt by card already; in a few months that makes a few files per task.
    months = 0 if span.first is None else (span.last.year - span.first.year) * 12 + span.last.month - span.first.month + 1
    changed = build_gold_features(context).filter(timed).drop("_from", "_to", "_untimed", "_came")
    store.write(
        changed.withColumn("batch", F.lit(number)),
        "gold",
        "fraud_features",
        "Features by the batch that computed them",
        sources=[store.full_name("silver", "transactions")],
        partition_by=VERSIONS,
        replace="partitions",
        rebalance=months > FEW_MONTHS,
    )


def current_features(store: TableStore, columns: Sequence[str] | None = None) -> DataFrame:
    """The newest version of every row, as of the last finished batch.

    Only rows computed again are listed in ``retired``, so the join's other side is
    small as long as transactions mostly arrive in order.
    """
    done = store.finished_batch()
    features = store.read("gold", "fraud_features").filter(F.col("batch") <= done)
    retired = store.read("gold", "retired").filter(F.col("batch") <= done)
    last = retired.agg(F.max("batch")).first()[0]
    if last is not None:
        # Nothing replaces rows of the last batch that replaced any, so only earlier ones need the join.
        newest = retired.groupBy(*[F.col(c).alias(f"_{c}") for c in ROW]).agg(F.max("batch").alias("_newest"))
        same = [F.col(c) == F.col(f"_{c}") for c in ROW]
        earlier = features.filter(F.col("batch") < last).join(newest, [*same, F.col("batch") < F.col("_newest")], "left_anti")
        features = earlier.unionByName(features.filter(F.col("batch") >= last))
    kept = features.drop("batch")
    return kept.select(*columns) if columns else kept

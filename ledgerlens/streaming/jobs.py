"""Structured Streaming jobs over arriving files.

Each job drains what has arrived and stops (``availableNow``), so it can run on
a schedule; progress is kept in the checkpoint, which makes a restart after any
failure continue without loss or repetition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.contract import FEATURE_COLUMNS, FEATURE_RECORD_SCHEMA, TRANSACTIONS_SCHEMA
from ledgerlens.functions.scores import traffic_arm
from ledgerlens.operators.quality import Rule, apply_rules, rule_metrics
from ledgerlens.plans.training import batch_score
from ledgerlens.session import cut_lineage
from ledgerlens.sources.readers import with_ingest_columns


def stream_transactions(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Arriving transaction files, with the columns of the bronze table."""
    reader = spark.readStream.schema(TRANSACTIONS_SCHEMA).option("header", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return with_ingest_columns(reader.csv(path), source_file=True)


def stream_records(spark: SparkSession, path: str, extra: str = "transaction_id BIGINT") -> DataFrame:
    """Arriving feature records, with an id and the time their file landed."""
    reader = spark.readStream.schema(f"{extra}, {FEATURE_RECORD_SCHEMA}")
    return reader.json(path).withColumn("_arrived", F.col("_metadata.file_modification_time"))


def drain(stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Appends everything available to a parquet folder and returns when done."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def watch_rules(stream: DataFrame, rules: Sequence[Rule], name: str = "rules") -> DataFrame:
    """Stream without the rows the rules drop.

    Failures of each micro-batch appear under ``name`` in the query's progress
    (``observedMetrics``), of which Spark keeps the latest only. Totals come from
    ``drain_checked``.
    """
    counts = [F.count_if(~rule.passes()).alias(rule.name) for rule in rules]
    watched = stream.observe(name, F.count(F.lit(1)).alias("evaluated"), *counts)
    return apply_rules(watched, rules)


def drain_checked(stream: DataFrame, rules: Sequence[Rule], path: str, checkpoint: str) -> tuple[DataFrame, DataFrame]:
    """Drains a stream and returns the stored rows the rules keep and the rule outcomes.

    Every row is stored, in a folder of its own where a rule drops it, so the outcomes
    are exact over all micro-batches there ever were: the file sink stores a row once,
    however often its batch is repeated.
    """
    dropped = F.lit(False)
    for rule in rules:
        if rule.action == "drop":
            dropped = dropped | ~rule.passes()
    drain(stream.withColumn("_dropped", dropped), path, checkpoint, partition_by=["_dropped"])
    stored = stream.sparkSession.read.schema(f"{stream._jdf.schema().toDDL()}, _dropped BOOLEAN").parquet(path)
    return stored.filter(~F.col("_dropped")).drop("_dropped"), rule_metrics(stored.drop("_dropped"), rules)


def scored_log(
    records: DataFrame,
    models: Mapping[str, tuple[PipelineModel, str]],
    endpoint: str,
    champion_share: int = 90,
    threshold: float = 0.5,
    record_id: str = "transaction_id",
) -> DataFrame:
    """Inference log of arrived records; each is scored by the model that its id decides."""
    if "champion" not in models or not set(models) <= {"champion", "challenger"}:
        raise ValueError("models are champion and, if wanted, challenger")
    challenger = "challenger" if "challenger" in models else None
    routed = records.withColumn("model_name", traffic_arm(F.col(record_id), champion_share, challenger=challenger))
    logs = None
    for arm, (model, version) in models.items():
        share = routed.filter(F.col("model_name") == arm)
        scored = batch_score(model, share, threshold, carry=[record_id, "model_name", "_arrived"])
        waited = (F.unix_micros(F.current_timestamp()) - F.unix_micros("_arrived")) / 1000
        log = scored.select(
            record_id,
            "model_name",
            F.lit(version).alias("model_version"),
            F.lit(endpoint).alias("endpoint_name"),
            F.current_timestamp().alias("timestamp"),
            F.to_json(F.struct(F.array("fraud_score").alias("predictions"))).alias("response"),
            waited.alias("execution_duration_ms"),
        )
        logs = log if logs is None else logs.unionByName(log)
    return logs


def drain_scores(
    records: DataFrame,
    models: Mapping[str, tuple[PipelineModel, str]],
    endpoint: str,
    path: str,
    checkpoint: str,
    champion_share: int = 90,
    threshold: float = 0.5,
    record_id: str = "transaction_id",
) -> StreamingQuery:
    """Scores everything that has arrived into the inference log below ``path`` and returns when done.

    The files of a micro-batch are read once, into the shared folder, whatever the
    number of models. A batch has a folder of its own in the log and replaces it, so
    repeating a batch after a failure changes nothing.
    """
    kept = [record_id, *FEATURE_COLUMNS, "_arrived"]
    scored_log(records.select(*kept), models, endpoint, champion_share, threshold, record_id)  # refuses wrong models early

    def take(arrived: DataFrame, number: int) -> None:
        once = cut_lineage(arrived.select(*kept))
        log = scored_log(once, models, endpoint, champion_share, threshold, record_id)
        log.write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = (
        records.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def score_stream(
    records: DataFrame,
    models: Mapping[str, tuple[PipelineModel, str]],
    endpoint: str,
    champion_share: int = 90,
    threshold: float = 0.5,
    record_id: str = "transaction_id",
) -> DataFrame:
    """Scores arriving records as a stream in the shape of the inference log, for any sink.

    ``models`` maps ``champion`` and optionally ``challenger`` to a model and its
    version. A record's id decides its model. The duration is the time from the
    landing of a record's file to the micro-batch that scored it. With two models
    the files are read once per model; ``drain_scores`` reads them once.
    """
    return scored_log(records, models, endpoint, champion_share, threshold, record_id)

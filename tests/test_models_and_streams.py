import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ledgerlens.contract import FEATURE_COLUMNS, FEATURE_RECORD_SCHEMA
from ledgerlens.operators.evaluation import classification_report
from ledgerlens.operators.quality import Rule
from ledgerlens.plans.model_reports import score_distribution
from ledgerlens.plans.training import (
    RATIO_WEIGHTED,
    batch_score,
    evaluate_splits,
    fit,
    in_bins,
    model_search,
    prepare,
    thresholds,
    train_boosted_trees,
    trees_wanted,
)
from ledgerlens.sources.readers import read_request_logs
from ledgerlens.streaming import jobs

SMALL = {**RATIO_WEIGHTED, "maxIter": 3, "maxDepth": 3}


@pytest.fixture(scope="module")
def rows(spark):
    """Fraud is where the amount is large; one feature is empty, one has gaps."""
    base = spark.range(600).withColumn("noise", F.abs(F.hash("id")) % 100)
    values = {name: F.lit(1) for name in FEATURE_COLUMNS}
    values["abs_amount"] = F.col("noise").cast("double")
    values["std_amount_24h"] = F.when(F.col("id") % 3 > 0, F.col("noise") / 7)
    values["debt_to_income"] = F.lit(None).cast("double")
    split = F.when(F.col("id") < 400, "train").when(F.col("id") < 500, "val").otherwise("test")
    return base.select(
        F.col("id").alias("transaction_id"),
        *[expr.alias(name) for name, expr in values.items()],
        (F.col("noise") > 85).cast("int").alias("is_fraud"),
        split.alias("split"),
    ).cache()


@pytest.fixture(scope="module")
def model(rows):
    return train_boosted_trees(rows, SMALL).model


def test_model_learns_and_scores(rows, model):
    scored = batch_score(model, rows.filter("split = 'test'"), carry=["transaction_id", "is_fraud"])
    assert scored.columns == ["transaction_id", "is_fraud", "fraud_score", "flagged"] and scored.count() == 100
    assert scored.filter("fraud_score NOT BETWEEN 0 AND 1 OR flagged <> int(fraud_score > 0.5)").count() == 0
    fraud = classification_report(scored, "fraud_score").filter("class = 'fraud'").first()
    assert fraud.f1 > 0.9


def test_training_needs_both_classes_and_validation_rows(rows):
    with pytest.raises(ValueError, match="positives"):
        train_boosted_trees(rows.filter("is_fraud = 0"), SMALL)
    with pytest.raises(ValueError, match="validation"):
        train_boosted_trees(rows.filter("split = 'train'"), SMALL)


def test_search_prefers_the_better_candidate(rows):
    weak = {**SMALL, "maxIter": 1, "maxDepth": 0}
    best, results = model_search(rows, [weak, SMALL])
    scores = [r.f1 for r in results.orderBy("candidate").collect()]
    assert best.params["maxDepth"] == 3 and scores[1] > scores[0]


HEADER = "id,date,client_id,card_id,amount,use_chip,merchant_id,merchant_city,merchant_state,zip,mcc,errors\n"


def test_stream_ingest_continues_where_it_stopped(spark, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    (tmp_path / "in").mkdir()

    def arrive(name, *ids):
        lines = "".join(f"{i},2018-01-01 00:00:00,1,1,$1.00,Chip Transaction,1,X,CA,1,1,\n" for i in ids)
        (tmp_path / "in" / name).write_text(HEADER + lines)

    def run():
        jobs.drain(jobs.stream_transactions(spark, source, files_per_batch=1), target, progress)
        return sorted(r.id for r in spark.read.parquet(target).select("id").collect())

    arrive("a.csv", 1, 2)
    arrive("b.csv", 3)
    assert run() == [1, 2, 3]
    assert run() == [1, 2, 3]
    arrive("c.csv", 4)
    assert run() == [1, 2, 3, 4]
    stored = spark.read.parquet(target)
    assert {r._source_file.split("/")[-1] for r in stored.collect()} == {"a.csv", "b.csv", "c.csv"}


def test_stream_rules_drop_and_report(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(HEADER + "1,x,1,1,$1.00,,1,X,CA,1,1,\n,x,1,1,$1.00,,1,X,CA,1,1,\n3,x,1,1,,,1,X,CA,1,1,\n")
    rules = [Rule("has_id", "id IS NOT NULL"), Rule("has_amount", "amount IS NOT NULL", "warn")]
    stream = jobs.stream_transactions(spark, str(tmp_path / "in"))
    kept, outcomes = jobs.drain_checked(stream, rules, str(tmp_path / "out"), str(tmp_path / "progress"))
    assert sorted(r.id for r in kept.collect()) == [1, 3]
    assert {r.rule: (r.evaluated, r.failed) for r in outcomes.collect()} == {"has_id": (3, 1), "has_amount": (3, 1)}


def test_stream_outcomes_cover_more_batches_than_spark_remembers(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(105):
        (tmp_path / "in" / f"{i}.csv").write_text(HEADER + f"{i},x,1,1,,,1,X,CA,1,1,\n,x,1,1,,,1,X,CA,1,1,\n")
    stream = jobs.stream_transactions(spark, str(tmp_path / "in"), files_per_batch=1)
    rules = [Rule("has_id", "id IS NOT NULL")]
    kept, outcomes = jobs.drain_checked(stream, rules, str(tmp_path / "out"), str(tmp_path / "progress"))
    total = outcomes.first()
    assert (kept.count(), total.evaluated, total.failed) == (105, 210, 105)


def test_stream_scoring_needs_a_champion(rows, model):
    with pytest.raises(ValueError, match="champion"):
        jobs.score_stream(rows, {"challenger": (model, "v2")}, "ep")


def test_number_of_trees_follows_the_validation_loss():
    assert trees_wanted([0.9, 0.5, 0.6, 0.4, 0.7, 0.7, 0.1], patience=2) == 4
    assert trees_wanted([0.9, 0.5, 0.6, 0.4, 0.7, 0.7, 0.1], patience=3) == 7
    assert trees_wanted([0.3], patience=1) == 1


def test_training_keeps_more_than_one_tree(rows):
    trained = train_boosted_trees(rows, {**SMALL, "maxIter": 8})
    assert trained.model.stages[-1].getNumTrees > 1


@pytest.mark.parametrize("arms", [1, 2])
def test_stream_scoring_writes_the_inference_log(spark, rows, model, tmp_path, arms):
    source, target = str(tmp_path / "in"), str(tmp_path / "logs")
    rows.select("transaction_id", *FEATURE_COLUMNS).write.json(source)
    models = {"champion": (model, "v1"), "challenger": (model, "v2")}
    models = dict(list(models.items())[:arms])
    logs = jobs.score_stream(jobs.stream_records(spark, source), models, "ep")
    jobs.drain(logs, target, str(tmp_path / "progress"))
    log = read_request_logs(spark, target)
    counts = {r.model_version: r["count"] for r in log.groupBy("model_version").count().collect()}
    assert sum(counts.values()) == 600 and len(counts) == arms
    now = log.agg(F.max("timestamp")).first()[0]
    assert score_distribution(log, "ep", as_of=F.lit(now)).agg(F.sum("count")).first()[0] == 600
    direct = batch_score(model, rows, carry=["transaction_id"])
    both = spark.read.parquet(target).join(direct, "transaction_id")
    wrong = both.filter(F.abs(F.get_json_object("response", "$.predictions[0]").cast("double") - F.col("fraud_score")) > 1e-12)
    assert both.count() == 600 and wrong.count() == 0


def test_search_equals_separate_fits_and_prepares_once(rows, monkeypatch):
    from ledgerlens.plans import training

    grid = [SMALL, {**SMALL, "maxDepth": 2, "scheme": "balanced"}, {**SMALL, "maxIter": 2}]
    calls = []
    monkeypatch.setattr(training, "prepare", lambda *args: calls.append(1) or prepare(*args))
    _, results = model_search(rows, grid)
    assert len(calls) == 1
    monkeypatch.undo()
    for number, row in enumerate(results.orderBy("candidate").collect()):
        scored = batch_score(train_boosted_trees(rows, grid[number]).model, rows.filter("split = 'val'"), carry=["is_fraud"])
        fraud = classification_report(scored, "fraud_score").filter("class = 'fraud'").first()
        assert (row.precision, row.recall, row.f1, row.support) == (fraud.precision, fraud.recall, fraud.f1, fraud.support)


def test_trees_grown_in_rounds_are_those_of_one_fit(rows):
    # One telling feature: between two that split alike, the order of sums may choose.
    prepared = prepare(rows.withColumn("std_amount_24h", F.lit(None).cast("double")))
    rounds = fit(prepared, {**SMALL, "maxIter": 9, "patience": 2}).model.stages[-1]
    whole = fit(prepared, {**SMALL, "maxIter": 9, "patience": 9}).model.stages[-1]
    n = rounds.getNumTrees
    assert n <= whole.getNumTrees
    inputs = prepared.inputs.withColumn("weight", F.lit(1.0))
    losses = [m.evaluateEachIteration(inputs)[:n] for m in (rounds, whole)]
    assert losses[0] == pytest.approx(losses[1], rel=1e-9)


def test_bounded_training_rows(rows):
    few = prepare(rows, train_rows=100)
    assert 50 < few.negatives + few.positives < 180 and few.inputs.filter("_validation").count() == 100
    assert prepare(rows, train_rows=400).negatives == prepare(rows).negatives


def test_splits_are_evaluated_in_one_call(rows, model):
    measures, report = evaluate_splits(model, rows)
    assert {r.split for r in measures.collect()} == {"val", "test"}
    for r in measures.collect():
        scored = batch_score(model, rows.filter(F.col("split") == r.split), carry=["is_fraud"])
        alone = classification_report(scored, "fraud_score").filter("class = 'fraud'").first()
        assert (r.precision, r.recall, r.f1, r.support) == (alone.precision, alone.recall, alone.f1, alone.support)
        assert 0 < r.roc_auc <= 1 and 0 < r.pr_auc <= 1
    assert report.groupBy("split").count().collect() and report.count() == 10


def test_two_arms_read_once_equal_batch_scoring(spark, rows, model, tmp_path):
    source, target, progress = (str(tmp_path / n) for n in ("in", "logs", "progress"))
    rows.select("transaction_id", *FEATURE_COLUMNS).write.json(source)
    models = {"champion": (model, "v1"), "challenger": (model, "v2")}
    for _ in range(2):  # nothing new the second time
        jobs.drain_scores(jobs.stream_records(spark, source), models, "ep", target, progress)
    log = spark.read.parquet(target)
    direct = batch_score(model, rows, carry=["transaction_id"])
    both = log.join(direct, "transaction_id")
    wrong = both.filter(F.get_json_object("response", "$.predictions[0]").cast("double") != F.col("fraud_score"))
    assert log.count() == both.count() == 600 and wrong.count() == 0
    assert {r.model_version for r in log.collect()} == {"v1", "v2"} and {r.batch for r in log.collect()} == {0}
    with pytest.raises(ValueError, match="champion"):
        jobs.drain_scores(jobs.stream_records(spark, source), {"challenger": models["challenger"]}, "ep", target, progress)


def test_record_schema_matches_the_contract(spark):
    assert spark.createDataFrame([], FEATURE_RECORD_SCHEMA).columns == FEATURE_COLUMNS


def test_training_rows_are_computed_once(spark, rows):
    """The joins behind a table would otherwise run again for each step of the preparation."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    usable = rows.filter("split IN ('train', 'val') AND is_fraud IN (0, 1)")
    prepare(usable.mapInArrow(counted, usable.schema))
    assert read.value == usable.count()


class TrainingBegins(Exception):
    """Ends a query where its training would begin."""


@pytest.fixture(scope="module")
def many_labels(spark, tmp_path_factory):
    """Raw tables with 24,000 labelled training events and 1,000 validation events."""
    to = tmp_path_factory.mktemp("many")
    first = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    events = spark.range(25_000).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") < 24_000, first + F.make_dt_interval(secs=F.col("id") * 5))
        .otherwise(first + F.make_dt_interval(days=F.lit(2), secs=F.col("id") - 24_000)).alias("ts"),
        (F.col("id") % 50).alias("user_id"),
        F.when(F.col("id") % 7 == 0, "signup").otherwise("click").alias("event_type"),
        (F.col("id") / 8).alias("value"),
        F.concat(F.lit('{"k":'), F.col("id") % 100, F.lit("}")).alias("props"),
    )
    customers = spark.range(50).selectExpr(
        "id AS c_custkey", "'x' AS c_name", "int(id % 25) AS c_nationkey", "double(id) AS c_acctbal", "'y' AS c_mktsegment"
    )
    tables = {
        "events": events,
        "customer": customers,
        "labels": spark.range(25_000).selectExpr("id AS doc_id", "1 AS quality", "int(id % 5 = 0) AS toxic"),
        "nation": spark.range(25).selectExpr("int(id) AS n_nationkey", "concat('N', id) AS n_name", "1 AS n_regionkey"),
    }
    for name, table in tables.items():
        table.write.parquet(str(to / f"{name}.parquet"))
    return str(to)


@pytest.mark.parametrize("name", ["train_decisive", "train_score"])
def test_query_trains_on_every_labelled_row(spark, many_labels, monkeypatch, name):
    from checks.registry import QUERIES
    from ledgerlens.plans import training

    def ended(prepared, *args):
        raise TrainingBegins(prepared)

    monkeypatch.setattr(training, "fit", ended)
    with pytest.raises(TrainingBegins) as caught:
        QUERIES[name](spark, many_labels)
    prepared = caught.value.args[0]
    assert prepared.negatives + prepared.positives == 24_000
    assert prepared.inputs.filter("NOT _validation").count() == 24_000


def test_thresholds_come_from_every_row(spark):
    """A value that 4 of 400,000 rows have decides the label; a sample of 10,000 rows seldom has one of them."""
    many = spark.range(400_000).select(
        F.col("id").alias("transaction_id"),
        *[F.lit(1).alias(name) for name in FEATURE_COLUMNS if name != "is_refund"],
        *[(F.col("id") % 100_000 == 7).cast("int").alias(name) for name in ("is_refund", "is_fraud")],
        F.when(F.col("id") % 10 == 0, "val").otherwise("train").alias("split"),
    )
    whole = {**SMALL, "featureSubsetStrategy": "all", "subsamplingRate": 1.0, "minInstancesPerNode": 1}
    scored = batch_score(train_boosted_trees(many, whole).model, many, carry=["is_fraud"])
    assert scored.filter("flagged <> is_fraud").count() == 0


def test_thresholds_by_value_or_equal_shares(spark):
    few = F.col("id") % 3
    skewed = F.when(F.col("id") < 600, 0).otherwise(F.col("id"))
    columns = [F.lit(5), few, F.col("id"), skewed, F.when(F.col("id") == 0, float("inf")).otherwise(F.col("id") % 2)]
    vectors = spark.range(1000).select(array_to_vector(F.array(*[c.cast("double") for c in columns])).alias("features"))
    one, three, all_rows, heavy, endless = thresholds(vectors, 4)
    assert one == [] and three == [0.5, 1.5] and all_rows == [249.5, 499.5, 749.5]
    assert heavy == [300.0, 749.5] and endless[0] == 0.5 and len(endless) == 2


def test_binned_features_give_the_model_of_all_values(rows, monkeypatch):
    """Where every value has its own bin, trees on bin numbers are those on values; few rows are left as they are."""
    from ledgerlens.plans import training

    few = rows.withColumns({"abs_amount": F.floor(F.col("abs_amount") / 8), "std_amount_24h": F.lit(None).cast("double")})
    params = {**SMALL, "maxBins": 16, "subsamplingRate": 1.0, "featureSubsetStrategy": "all"}
    prepared = prepare(few)
    assert in_bins(prepared, 16) is prepared
    before = batch_score(fit(prepared, params).model, few, carry=["transaction_id"]).collect()
    assert len({r.fraud_score for r in before}) > 2
    monkeypatch.setattr(training, "SPLIT_ROWS", 100)
    assert in_bins(prepared, 20) is prepared
    trained = fit(prepared, params)
    assert len(trained.model.stages) == 4 and "ml_attr" not in trained.inputs.schema["features"].metadata
    after = {r.transaction_id: r.fraud_score for r in batch_score(trained.model, few, carry=["transaction_id"]).collect()}
    assert all(after[r.transaction_id] == pytest.approx(r.fraud_score, rel=1e-9) for r in before)
    _, results = model_search(few, [params])
    scored = batch_score(trained.model, few.filter("split = 'val'"), carry=["is_fraud"])
    assert results.first().f1 == classification_report(scored, "fraud_score").filter("class = 'fraud'").first().f1

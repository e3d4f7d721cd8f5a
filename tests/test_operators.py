import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from ledgerlens.contract import FEATURE_COLUMNS, NON_MODEL_COLUMNS
from ledgerlens.operators import columns, filters
from ledgerlens.operators.joins import DuplicateKeyError, assert_unique_key, duplicate_keys, enrich, left_lookup
from ledgerlens.operators.quality import Rule, apply_rules, check_rules, observe_rules, passing, rule_metrics, stored_metrics, with_outcomes


def values(df, name):
    return [row[name] for row in df.collect()]


# --- columns ---


def test_feature_contract(spark):
    assert len(FEATURE_COLUMNS) == len(set(FEATURE_COLUMNS)) == 32
    text = spark.range(1).select(*[F.lit("7" if n != "mcc" else "x").alias(n) for n in FEATURE_COLUMNS], F.lit(1).alias("is_fraud"))
    projected = columns.feature_projection(text)
    assert projected.columns == [*FEATURE_COLUMNS, "is_fraud"]
    row = projected.first()
    assert row.mcc is None and row.month == 7.0


def test_minimise_and_exclude(spark):
    df = spark.range(1).select("id", F.lit(1).alias("cvv"), F.lit("x").alias("gender"))
    assert columns.minimise(df, ["id"]).columns == ["id"]
    assert columns.exclude(df).columns == ["id", "cvv"]
    assert len(NON_MODEL_COLUMNS) == 17
    with pytest.raises(Exception):
        columns.minimise(df, ["absent"]).count()


# --- filters ---


def test_filters(spark):
    df = spark.createDataFrame([(1, "a"), (2, ""), (3, None), (None, "ab")], "n int, s string")
    assert values(filters.present(df, "n"), "n") == [1, 2, 3]
    assert values(filters.equal_to(df, "s", "a"), "n") == [1]
    assert values(filters.not_blank(df, "s"), "s") == ["a", "ab"]
    assert values(filters.one_of(df, "n", [1, 3, 9]), "n") == [1, 3]
    assert values(filters.with_prefix(df, "s", "a"), "n") == [1, None]


def test_time_ranges(spark):
    df = spark.sql("SELECT n, TIMESTAMP '2018-01-01 00:00:00' + n * INTERVAL '1' HOUR AS ts FROM VALUES (-1), (0), (1), (24), (NULL) t(n)")
    assert values(filters.between_times(df, "ts", "2018-01-01", "2018-01-02"), "n") == [0, 1]
    assert values(filters.between_times(df, "ts", None, "2018-01-01"), "n") == [-1]
    assert values(filters.trailing(df, "ts", 1, "2018-01-02 01:00:00"), "n") == [1, 24]


def test_time_range_reaches_the_scan(spark, tmp_path):
    spark.range(10).select(F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"), "id").write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    plan = plan_of(filters.between_times(stored, "ts", "1970-01-01 00:00:03", None).select("ts"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan


# --- rules ---

RULES = [Rule("has_id", "id IS NOT NULL"), Rule("positive", "v > 0"), Rule("small", "v < 10", "warn")]


@pytest.fixture
def checked(spark):
    return spark.createDataFrame([(1, 5), (2, 50), (3, -1), (4, None), (None, 5)], "id int, v int")


def test_rules_drop_and_measure(checked):
    kept, metrics = check_rules(checked, RULES)
    assert values(kept, "id") == [1, 2]  # an unknown predicate fails; a warning removes nothing
    assert [tuple(r) for r in metrics.collect()] == [
        ("has_id", "drop", 5, 4, 1),
        ("positive", "drop", 5, 3, 2),
        ("small", "warn", 5, 3, 2),
    ]
    assert kept.count() + checked.subtract(kept).count() == checked.count()


def test_observed_rules_cost_no_extra_pass(checked, tmp_path):
    kept, seen = observe_rules(checked, RULES)
    kept.write.parquet(str(tmp_path / "kept"))
    assert seen.get == {"evaluated": 5, "has_id": 1, "positive": 2, "small": 2}


def test_outcomes_stored_with_the_rows(checked, tmp_path):
    with_outcomes(checked, RULES).write.parquet(str(tmp_path / "judged"))
    judged = checked.sparkSession.read.parquet(str(tmp_path / "judged"))
    assert stored_metrics(judged, RULES).collect() == rule_metrics(checked, RULES).collect()
    assert values(passing(judged, RULES), "id") == [1, 2] and passing(judged, RULES).columns == checked.columns
    doubled = with_outcomes(checked, RULES, prepare=lambda rows: rows.withColumn("v", F.col("v") * 2))
    assert doubled.columns == [*checked.columns, "_rules"] and {r.v for r in doubled.collect()} == {5, 50, -1, None}
    assert [r.passed for r in stored_metrics(doubled, RULES).collect()] == [4, 3, 1]
    assert with_outcomes(checked, []).select("_rules").distinct().collect() == [(0,)]
    many = [Rule(f"r{i}", "v > 0") for i in range(63)]
    assert [r.passed for r in stored_metrics(with_outcomes(checked, many), many).collect()] == [3] * 63
    with pytest.raises(ValueError):
        with_outcomes(checked, [*many, RULES[0]])


def test_no_rules(checked):
    assert apply_rules(checked, []).count() == 5


# --- joins ---


def test_lookup_keeps_every_row(spark):
    fact = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id int, k int")
    dim = spark.createDataFrame([(10, "ten")], "k int, name string")
    assert sorted(map(tuple, left_lookup(fact, dim, "k", "k").collect())) == [(1, 10, "ten"), (2, 99, None), (3, None, None)]


def test_lookup_refuses_shared_columns(spark):
    df = spark.range(1).withColumn("name", F.lit("x"))
    with pytest.raises(ValueError):
        left_lookup(df, df, "id", "id")


def test_duplicate_dimension_key(spark):
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "id int, name string")
    assert [tuple(r) for r in duplicate_keys(dim, "id").collect()] == [(1, 2)]
    with pytest.raises(DuplicateKeyError):
        assert_unique_key(dim, "id")
    assert assert_unique_key(dim.filter("id = 2"), "id").count() == 1


def star(spark, rows=1000):
    fact = spark.range(rows).select(
        F.col("id").alias("transaction_id"),
        F.when(F.col("id") % 3 != 0, 1).otherwise(F.col("id") % 50).alias("card_id"),  # one hot card
        (F.col("id") % 20).alias("client_id"),
        F.when(F.col("id") % 7 > 0, (F.col("id") % 9).cast("int")).alias("mcc"),
    )
    labels = spark.range(0, rows, 2).select(F.col("id").alias("transaction_id"), F.lit(0).alias("is_fraud"))
    cards = spark.range(40).withColumn("card_brand", F.lit("Visa"))
    users = spark.range(20).withColumn("gender", F.lit("F"))
    codes = spark.range(5).select(F.col("id").cast("int").alias("mcc_code"), F.lit("shop").alias("mcc_name"))
    return fact, labels, cards, users, codes


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_enrich_same_result_with_and_without_broadcast(spark, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        joined = enrich(*star(spark))
        counted = joined.agg(
            F.count("*"), F.count("is_fraud"), F.count("card_brand"), F.count("gender"), F.count("mcc_name")
        ).first()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    rows = star(spark)[0].collect()
    assert tuple(counted) == (
        1000,
        500,
        sum(r.card_id < 40 for r in rows),
        1000,
        sum(r.mcc is not None and r.mcc < 5 for r in rows),
    )


def test_enrich_checks_keys(spark):
    fact, labels, cards, users, codes = star(spark, 10)
    with pytest.raises(DuplicateKeyError):
        enrich(fact, labels, cards.unionAll(cards), users, codes)


def test_oversized_foreign_key_is_split(spark, tmp_path):
    """Without broadcasts, AQE splits the partition of a card holding two thirds of the rows."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        fact, _, cards, _, _ = star(spark, 60_000)
        # Several map outputs, so that a partition can be cut between them.
        joined = left_lookup(fact.repartition(8), cards, "card_id", "id")
        assert len(joined.collect()) == 60_000
        plan = plan_of(joined).split("Initial Plan")[0]
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert "SortMergeJoin(skew=true)" in plan

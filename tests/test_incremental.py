"""Tables laid out by month, replaced in parts, and features that follow arriving transactions."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from ledgerlens.operators.evaluation import in_split, time_split
from ledgerlens.operators.filters import between_times, trailing, with_month
from ledgerlens.plans.layers import LAYOUT, Bronze, build_gold_features, build_silver
from ledgerlens.plans.reports import fraud_by_month
from ledgerlens.session import cut_lineage, scratch_path
from ledgerlens.sources.store import TableStore
from ledgerlens.streaming import jobs
from ledgerlens.streaming.features import apply_batch, current_features, drain_features


@pytest.fixture
def store(spark):
    root = scratch_path(spark, "store")
    return TableStore(spark, root, name=f"inc_{root[-8:]}")


@pytest.fixture
def dated(spark, store):
    days = [datetime(2016, 1, 1) + timedelta(days=11 * i) for i in range(130)]
    rows = [(i, day, float(i), i % 2) for i, day in enumerate(days)] + [(999, None, 1.0, 1)]
    df = spark.createDataFrame(rows, "transaction_id long, ts timestamp, abs_amount double, is_fraud int")
    return store.write(with_month(df), "gold", "dated", partition_by=LAYOUT)


def months_read(df):
    """Partition filters of the scan, and the folders that it reads."""
    plan = plan_of(df)
    found = plan.split("PartitionFilters: [")[1].split("]")[0]
    return found, {part for f in df.inputFiles() for part in f.split("/") if part.startswith("ts_month=")}


def test_time_ranges_choose_folders(dated):
    assert len(months_read(dated)[1]) > 40
    for part in (
        in_split(dated, "train"), in_split(dated, "val"), in_split(dated, "test"),
        trailing(dated, "ts", 7, "2018-05-20"), trailing(dated, "ts", 7, F.lit("2018-05-20").cast("timestamp")),
        between_times(dated, "ts", "2018-05-02", "2018-05-20"), fraud_by_month(dated, "2018-05-02", "2018-05-20"),
    ):
        assert "ts_month" in months_read(part)[0]
    assert months_read(between_times(dated, "ts", "2018-05-02", "2018-05-20"))[1] <= {"ts_month=2018-05-01"}


def test_ranges_keep_exactly_their_rows(dated):
    plain = dated.drop("ts_month")
    for start, end in (("2018-01-01", "2019-01-01"), (None, "2017-02-01"), ("2019-03-31 23:00:00", None)):
        rows = [sorted(r.transaction_id for r in between_times(d, "ts", start, end).collect()) for d in (dated, plain)]
        assert rows[0] == rows[1] and rows[0]
    named = {r.transaction_id: r.split for r in time_split(plain).collect()}
    for name in ("train", "val", "test"):
        assert {r.transaction_id for r in in_split(dated, name).collect()} == {i for i, s in named.items() if s == name}


def test_only_given_partitions_are_replaced(spark, store, dated):
    before = {r.transaction_id: r.abs_amount for r in dated.collect()}
    late = between_times(dated, "ts", "2018-05-01", "2018-06-01").withColumn("abs_amount", F.lit(-1.0))
    new = dated.filter("transaction_id = 5").withColumn("ts", F.lit("2030-01-05").cast("timestamp"))
    changed = cut_lineage(late.unionByName(with_month(new.drop("ts_month")).select(*late.columns)))
    for _ in range(2):  # repeating the write changes nothing
        table = store.write(changed, "gold", "dated", partition_by=LAYOUT, replace="partitions")
        after = [(r.transaction_id, r.abs_amount) for r in table.collect()]
        assert len(after) == len(before) + 1
        assert {i for i, x in after if x == -1.0} == {r.transaction_id for r in changed.filter("ts < '2020-01-01'").collect()}
        assert all(x in (before[i], -1.0) for i, x in after)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    with pytest.raises(ValueError):
        store.write(dated, "gold", "dated", replace="partitions")
    again = TableStore(spark, store.root, store.name).read("gold", "dated")
    assert again.count() == len(before) + 1


def transactions(n, seed):
    draw = random.Random(seed)
    start = datetime(2019, 12, 20)
    out = []
    for i in range(n):
        when = start + timedelta(seconds=draw.choice([draw.randrange(3_000_000), draw.randrange(90) * 3600]))
        date = draw.choice([when.strftime("%Y-%m-%d %H:%M:%S")] * 9 + [None, "no date"])
        card = draw.choice([1, 2, 3, 4, 5, None]) if i % 40 == 0 else draw.randint(1, 5)
        out.append((i, date, card, card, f"${draw.randint(1, 9999) / 100:.2f}", "Chip Transaction", draw.randint(1, 6), "X", "CA", "1", 1, None))
    return out


TX = "id long, date string, client_id long, card_id long, amount string, use_chip string, merchant_id long, merchant_city string, merchant_state string, zip string, mcc int, errors string"


@pytest.fixture(scope="module")
def sides(spark):
    cards = spark.range(1, 6).selectExpr(
        "id", "id client_id", "'B' card_brand", "'T' card_type", "'1' card_number", "'x' expires", "'1' cvv", "'YES' has_chip",
        "1 num_cards_issued", "'$10.00' credit_limit", "'x' acct_open_date", "2010 year_pin_last_changed", "'No' card_on_dark_web",
    )
    users = spark.range(1, 6).selectExpr(
        "id", "30 current_age", "65 retirement_age", "1990 birth_year", "1 birth_month", "'F' gender", "'a' address",
        "cast(1 as double) latitude", "cast(1 as double) longitude", "'$5.00' per_capita_income", "'$9.00' yearly_income",
        "'$3.00' total_debt", "600 credit_score", "1 num_credit_cards",
    )
    labels = spark.range(0, 300, 7).selectExpr("id transaction_id", "if(id % 2 = 0, 'Yes', 'No') label")
    return cards, users, labels, spark.createDataFrame([(1, "Shop")], "mcc_code int, mcc_name string")


def features_of(rows):
    names = sorted(c for c in rows.columns if not c.startswith("_"))
    return sorted((tuple(str(r[c]) for c in names) for r in rows.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_in_any_order_equal_the_whole(spark, store, sides, seed):
    rows = transactions(240, seed)
    whole = build_gold_features(with_month(build_silver(Bronze(spark.createDataFrame(rows, TX), *sides), verify_keys=False)))
    random.Random(seed).shuffle(rows)
    pieces = [rows[:100], [], rows[100:110], rows[110:]]
    for number, piece in enumerate(pieces):
        arrived = Bronze(spark.createDataFrame(piece, TX), *sides)
        for _ in range(2 if number == 2 else 1):  # a batch repeated after a failure
            apply_batch(store, arrived, number)
    assert store.finished_batch() == 3
    assert features_of(current_features(store)) == features_of(whole)


def test_unfinished_batch_is_not_seen(spark, store, sides, monkeypatch):
    rows = transactions(60, 5)
    apply_batch(store, Bronze(spark.createDataFrame(rows[:30], TX), *sides), 0)
    seen = features_of(current_features(store))
    monkeypatch.setattr(TableStore, "finish_batch", lambda self, number: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        apply_batch(store, Bronze(spark.createDataFrame(rows[30:], TX), *sides), 1)
    assert features_of(current_features(store)) == seen


def test_stream_of_files(spark, store, sides, tmp_path):
    rows = spark.createDataFrame(transactions(90, 9), TX)
    source, progress = str(tmp_path / "in"), str(tmp_path / "progress")
    for part in range(2):
        rows.filter(F.col("id") % 2 == part).coalesce(1).write.mode("append").csv(source, header=True)
        drain_features(jobs.stream_transactions(spark, source), store, *sides, progress)
    drain_features(jobs.stream_transactions(spark, source), store, *sides, progress)  # nothing new
    whole = build_gold_features(with_month(build_silver(Bronze(rows, *sides), verify_keys=False)))
    assert features_of(current_features(store)) == features_of(whole)


def test_features_are_stored_once(spark, store, sides, monkeypatch):
    from ledgerlens.streaming import features

    stored, rebalanced, write = [], {}, TableStore.write

    def noted(self, df, layer, table, *args, **options):
        rebalanced[table] = options.get("rebalance", True)
        return write(self, df, layer, table, *args, **options)

    monkeypatch.setattr(features, "cut_lineage", lambda df: stored.append(df.columns) or cut_lineage(df))
    monkeypatch.setattr(TableStore, "write", noted)
    rows = transactions(60, 3)
    for number in range(2):
        apply_batch(store, Bronze(spark.createDataFrame(rows[number::2], TX), *sides), number)
    assert not any("tx_count_7d" in columns for columns in stored)
    assert rebalanced == {"transactions": True, "retired": False, "fraud_features": False}
    # Only versions before the last batch that replaced rows go through the join.
    plan = plan_of(current_features(store))
    assert "Union" in plan and plan.count("Scan parquet") == 3
    whole = build_gold_features(with_month(build_silver(Bronze(spark.createDataFrame(rows, TX), *sides), verify_keys=False)))
    assert features_of(current_features(store)) == features_of(whole)

"""Raw files to gold on hand-made rows covering every edge case."""

import json

import pytest

from conftest import plan_of
from ledgerlens.contract import FEATURE_COLUMNS, SILVER_COLUMNS
from ledgerlens.operators.quality import OUTCOMES, passing, rule_metrics, stored_metrics
from ledgerlens.plans.governance import latest_lineage, table_counts
from ledgerlens.plans.layers import (
    LAYOUT,
    SILVER_RULES,
    build_bronze,
    build_gold_training,
    build_lakehouse,
    build_silver,
    clean_transactions,
)
from ledgerlens.sources.store import TableStore

TX = """id,date,client_id,card_id,amount,use_chip,merchant_id,merchant_city,merchant_state,zip,mcc,errors
1,2018-05-05 10:00:00,100,10,$50.00,Chip Transaction,7,Reno,NV,1,5812,
2,2018-05-05 11:00:00,100,10,$-77.00,Swipe Transaction,7,Reno,NV,1,5812,Bad PIN
3,2018-05-05 11:00:00,100,10,"$1,200.50",Online Transaction,8,ONLINE,,,5999,"  "
4,2018-13-05 11:00:00,101,11,abc,,9,Reno,NV,1,,
5,2018-05-06 11:00:01,999,99,$1.00,Chip Transaction,9,Reno,CA,1,5812,
,2018-05-06 11:00:00,100,10,$1.00,Chip Transaction,9,Reno,CA,1,5812,
7,2018-05-06 11:00:00,100,,$1.00,Chip Transaction,9,Reno,CA,1,5812,
8,2018-05-06 11:00:00,,10,$1.00,Chip Transaction,9,Reno,CA,1,5812,
"""
CARDS = """id,client_id,card_brand,card_type,card_number,expires,cvv,has_chip,num_cards_issued,credit_limit,acct_open_date,year_pin_last_changed,card_on_dark_web
10,100,Visa,Debit,4000,02/2031,901,YES,3,"$12,340",05/2011,2013,No
11,101,Amex,Credit,4001,02/2031,902,NO,1,$0,06/2012,2014,Yes
"""
USERS = """id,current_age,retirement_age,birth_year,birth_month,gender,address,latitude,longitude,per_capita_income,yearly_income,total_debt,credit_score,num_credit_cards
100,37,68,1987,3,Female,8 Quarry Street,12.5,-45.25,"$21,050","$43,210","$97,531",655,2
101,29,68,1995,4,Male,9 Quarry Street,12.5,-45.25,$0,$0,$246,620,1
"""


@pytest.fixture(scope="module")
def paths(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    contents = {
        "transactions": TX,
        "cards": CARDS,
        "users": USERS,
        "labels": json.dumps({"target": {"1": "No", "2": "Yes", "4": "No"}}),
        "codes": json.dumps({"5812": "Eating Places, Restaurants"}),
    }
    for name, text in contents.items():
        (root / name).mkdir()
        (root / name / "part").write_text(text)
    return {name: str(root / name) for name in contents}


@pytest.fixture(scope="module")
def store(spark, paths, tmp_path_factory):
    store = TableStore(spark, str(tmp_path_factory.mktemp("lake")), name="layers_test")
    return build_lakehouse(spark, paths, store)


def by_id(df):
    return {r.transaction_id: r for r in df.collect()}


def test_bronze_counts(store):
    counts = {name: store.read("bronze", name).count() for name in store.tables("bronze")}
    assert counts == {"transactions": 8, "cards": 2, "users": 2, "labels": 3, "codes": 1}
    assert "_source_file" in store.read("bronze", "transactions").columns
    assert "_ingestion_timestamp" in store.read("bronze", "codes").columns


def test_silver_rows_and_columns(store):
    silver = store.read("silver", "transactions")
    assert silver.columns == [*SILVER_COLUMNS, *LAYOUT] and len(SILVER_COLUMNS) == 30
    rows = by_id(silver)
    assert sorted(rows) == [1, 2, 3, 4, 5]
    assert rows[2].amount == -77.0 and rows[3].amount == 1200.5 and rows[4].amount is None
    assert rows[4].ts is None and rows[3].errors is None and rows[2].errors == "Bad PIN"
    assert rows[1].mcc_name == "Eating Places, Restaurants" and rows[3].mcc_name is None
    assert rows[5].card_brand is None and rows[5].gender is None
    assert rows[1].credit_limit == 12340.0 and rows[1].total_debt == 97531.0
    assert [rows[i].is_fraud for i in (1, 2, 3, 4, 5)] == [0, 1, None, 0, None]


def test_sensitive_columns_stay_in_bronze(store):
    hidden = {"card_number", "expires", "cvv", "address", "birth_year", "birth_month"}
    assert hidden <= set(store.read("bronze", "cards").columns) | set(store.read("bronze", "users").columns)
    for layer, table in (("silver", "transactions"), ("gold", "fraud_features"), ("gold", "fraud_training")):
        assert not hidden & set(store.read(layer, table).columns)


def test_rule_metrics_on_raw_rows(spark, paths):
    cleaned = clean_transactions(build_bronze(spark, paths).transactions)
    failed = {r.rule: r.failed for r in rule_metrics(cleaned, SILVER_RULES).collect()}
    assert failed == {"valid_transaction_id": 1, "valid_card_id": 1, "valid_client_id": 1, "valid_amount": 1}


def test_rule_outcomes_are_counted_from_one_stored_column(spark, paths, store):
    stored = store.read("bronze", "transactions")
    raw = build_bronze(spark, paths).transactions
    assert stored.columns == [*raw.columns, OUTCOMES]
    assert sorted(map(str, stored.drop(OUTCOMES, "_ingestion_timestamp").collect())) == sorted(
        map(str, raw.drop("_ingestion_timestamp").collect())
    )
    metrics = stored_metrics(stored, SILVER_RULES)
    assert metrics.collect() == rule_metrics(clean_transactions(raw), SILVER_RULES).collect()
    assert f"ReadSchema: struct<{OUTCOMES}:bigint>" in plan_of(metrics)
    assert passing(stored, SILVER_RULES).count() == 5


def test_rule_outcomes_are_recorded(store):
    log = {r.rule: (r.action, r.evaluated, r.failed) for r in store.quality().collect()}
    assert {r.table_full_name for r in store.quality().collect()} == {"layers_test_silver.transactions"}
    assert log == {
        "valid_transaction_id": ("drop", 8, 1),
        "valid_card_id": ("drop", 8, 1),
        "valid_client_id": ("drop", 8, 1),
        "valid_amount": ("warn", 8, 1),
    }


def test_gold_features(store):
    gold = store.read("gold", "fraud_features")
    assert len(gold.columns) == 52 + len(LAYOUT) and set(FEATURE_COLUMNS) <= set(gold.columns)
    rows = by_id(gold)
    assert (rows[2].is_refund, rows[2].abs_amount, rows[1].is_refund, rows[4].is_refund) == (1, 77.0, 0, None)
    assert (rows[4].is_online, rows[4].is_chip, rows[4].is_swipe, rows[4].has_error) == (None, None, None, 0)
    assert (rows[1].hour_of_day, rows[1].day_of_week, rows[1].month) == (10, 7, 5)  # a Saturday
    assert (rows[3].is_online, rows[2].has_error, rows[4].is_dark_web, rows[1].has_chip_flag) == (1, 1, 1, 1)
    assert rows[1].debt_to_income == pytest.approx(97531 / 43210) and rows[4].debt_to_income is None
    assert [rows[i].tx_count_1h for i in (1, 2, 3, 4, 5)] == [1, 3, 3, 1, 1]
    assert rows[2].tx_amount_1h == 50.0 + 77.0 + 1200.5  # refunds and unlabelled rows are part of the history
    assert rows[2].unique_merchants_24h == 2 and rows[1].std_amount_24h is None


def test_training_rows_keep_the_features_of_the_full_history(store):
    training = by_id(store.read("gold", "fraud_training"))
    assert sorted(training) == [1, 2, 4] and training[2].tx_count_1h == 3


def test_training_drops_labels_out_of_range(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (None,)], "is_fraud int")
    assert sorted(r.is_fraud for r in build_gold_training(df).collect()) == [0, 1]


def test_lineage_and_tags(spark, store):
    latest = latest_lineage(store.lineage(), "layers_test_")
    assert latest.count() == 12
    assert latest.first().target_table_full_name == "layers_test_gold.fraud_training"
    assert latest_lineage(store.lineage(), "other.").count() == 0
    tags = {r.key: r.value for r in store.tags("gold", "fraud_training").collect()}
    assert tags["use"] == "ml-training" and tags["domain"] == "card-risk"


def test_counts(store):
    tables = {f"{layer}_{name}": store.read(layer, name) for layer in ("silver", "gold") for name in store.tables(layer)}
    assert {r.tbl: r.rows for r in table_counts(tables).collect()} == {
        "silver_transactions": 5, "gold_fraud_features": 5, "gold_fraud_training": 3,
    }


def test_duplicate_card_is_refused(spark, paths):
    bronze = build_bronze(spark, paths)
    twice = bronze._replace(cards=bronze.cards.unionAll(bronze.cards))
    with pytest.raises(ValueError, match="not unique"):
        build_silver(twice)
    assert build_silver(twice, verify_keys=False).count() > 5  # what the check protects from

import json

import pytest
from pyspark.sql import functions as F

from ledgerlens.contract import CARDS_SCHEMA, FEATURE_COLUMNS, TRANSACTIONS_SCHEMA, USERS_SCHEMA
from ledgerlens.session import cut_lineage, scratch_path, shared_root
from ledgerlens.sources.readers import read_csv, read_feature_records, read_json_dict, with_ingest_columns
from ledgerlens.sources.store import TableStore


def test_csv_keeps_rows_with_bad_fields(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        "id,date,client_id,card_id,amount,use_chip,merchant_id,merchant_city,merchant_state,zip,mcc,errors\n"
        '1,2010-01-01 00:01:00,5,6,$-77.00,Swipe Transaction,7,"Los Angeles, CA",CA,90001,5812,\n'
        "x,2010-13-01 00:00:00,5,6,abc,Online Transaction,7,ONLINE,,,many,Bad PIN\n"
    )
    rows = read_csv(spark, str(tmp_path), TRANSACTIONS_SCHEMA)
    first, second = rows.orderBy(F.desc("id")).collect()
    assert (first.amount, first.merchant_city, first.mcc, first.errors) == ("$-77.00", "Los Angeles, CA", 5812, None)
    assert (second.id, second.mcc, second.client_id, second.errors) == (None, None, 5, "Bad PIN")
    stamped = with_ingest_columns(rows, source_file=True).first()
    assert stamped._source_file.endswith("t.csv") and stamped._ingestion_timestamp is not None


def test_declared_schemas(spark):
    sizes = [len(spark.createDataFrame([], s).columns) for s in (TRANSACTIONS_SCHEMA, CARDS_SCHEMA, USERS_SCHEMA)]
    assert sizes == [12, 13, 14]


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("split_bytes", ["1024", "134217728"])
def test_json_dict_in_one_document(spark, tmp_path, indent, split_bytes):
    entries = {str(i): "Yes" if i % 50 == 0 else "No" for i in range(-20, 6000)}
    (tmp_path / "labels.json").write_text(json.dumps({"target": entries}, indent=indent))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        split = read_json_dict(spark, str(tmp_path), "id", "label", "bigint", root="target", splittable=True)
        tasks = split.rdd.getNumPartitions()
        got = sorted(map(tuple, split.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == sorted((int(k), v) for k, v in entries.items())
    assert tasks > 1 if split_bytes == "1024" else tasks == 1
    whole = read_json_dict(spark, str(tmp_path), "id", "label", "bigint", root="target")
    assert sorted(map(tuple, whole.collect())) == got


def test_json_dict_edge_values(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"target": {"1": "Yes", "2": null, "3":"" , "1": "No"}}\n')
    (tmp_path / "b.json").write_text('{"target": {"4": "No"}}\n{"target": {"5": "Yes", "6": "No"}}\n')
    got = read_json_dict(spark, str(tmp_path), "id", "label", "bigint", root="target", splittable=True)
    assert sorted(map(tuple, got.collect()), key=str) == [
        (1, "No"), (1, "Yes"), (2, None), (3, ""), (4, "No"), (5, "Yes"), (6, "No"),
    ]


@pytest.mark.parametrize(
    "text",
    [
        '{"target": {"1": "Yes, confirmed"}}',
        '{"target": {"x5": "Yes"}}',
        '{"target": {"1": 4}}',
        '{"target": {"1": "say \\"Yes\\""}}',
        '{"other": {"1": "Yes"}, "target": {"2": "No"}}',
    ],
)
def test_split_json_dict_loses_nothing_silently(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    split = read_json_dict(spark, str(tmp_path), "id", "label", "bigint", root="target", splittable=True)
    with pytest.raises(Exception, match="no entry of the dictionary"):
        split.collect()


def test_split_json_dict_words_and_large_keys(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"1": true, "2": false, "99999999999999999999": "No"}')
    got = read_json_dict(spark, str(tmp_path), "id", "label", "bigint", splittable=True)
    whole = read_json_dict(spark, str(tmp_path), "id", "label", "bigint")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)


ANY_TEXT = ["Yes, confirmed", 'say "Yes"', "back\\slash\\", "\\", '"', "", "{}", ": null, ", "é \U0001f600", "tab\tnew\nline", "a\\\"b", None, True, 4, -2.5]


@pytest.mark.parametrize("split_bytes", ["64", "1000", "134217728"])
@pytest.mark.parametrize("root,indent", [("target", None), ("target", 2), (None, None)])
def test_json_dict_with_any_text(spark, tmp_path, monkeypatch, split_bytes, root, indent):
    from ledgerlens.sources import readers

    monkeypatch.setattr(readers, "_CHUNK", 16)
    entries = {str(i): ANY_TEXT[i % len(ANY_TEXT)] for i in range(150)}
    for name in ("a.json", "b.json"):
        (tmp_path / name).write_text(json.dumps({root: entries} if root else entries, indent=indent, ensure_ascii=False))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        split = read_json_dict(spark, str(tmp_path), "id", "text", "bigint", root=root, splittable="quotes")
        got = sorted(map(tuple, split.collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    whole = read_json_dict(spark, str(tmp_path), "id", "text", "bigint", root=root)
    assert got == sorted(map(tuple, whole.collect()), key=str) and len(got) == 300


@pytest.mark.parametrize("text", ['{"target": {"1": ["Yes"]}}', '{"target": {"1": {"a": "b"}}}', '{"target": {"1": }}'])
def test_what_is_no_entry_fails(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="no entry of the dictionary"):
        read_json_dict(spark, str(tmp_path), "id", "text", "bigint", root="target", splittable="quotes").collect()


def test_flat_json_dict_with_commas_and_bad_key(spark, tmp_path):
    (tmp_path / "codes.json").write_text('{"5812": "Eating Places, Restaurants", "x": "bad"}')
    got = read_json_dict(spark, str(tmp_path), "mcc_code", "mcc_name", "int")
    assert sorted(map(tuple, got.collect()), key=str) == [(5812, "Eating Places, Restaurants"), (None, "bad")]


def test_feature_records(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"abs_amount": 28.99, "mcc": 5411, "debt_to_income": 0.2, "unknown": 1}\n')
    records = read_feature_records(spark, str(tmp_path))
    assert records.columns == FEATURE_COLUMNS
    row = records.first()
    assert (row.abs_amount, row.mcc, row.tx_count_7d) == (28.99, 5411, None)


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "lake"), name=f"lake_{abs(hash(str(tmp_path))) % 10**8}")


def test_store_replaces_tables_and_keeps_properties(spark, store):
    store.write(spark.range(3), "gold", "t", comment="it's a table", tags={"domain": "fraud"})
    again = store.write(spark.range(5), "gold", "t", tags={"use": "ml-training"})
    assert again.count() == 5 and store.tables("gold") == ["t"] and store.tables("ml") == []
    tags = {r.key: r.value for r in store.tags("gold", "t").collect()}
    assert tags["quality"] == "gold" and tags["use"] == "ml-training"
    with pytest.raises(ValueError):
        store.read("platinum", "t")


def test_store_comment(spark, store):
    store.write(spark.range(1), "gold", "t", comment="it's a table")
    described = spark.sql(f"DESCRIBE EXTENDED {store.full_name('gold', 't')}").collect()
    assert {r.col_name: r.data_type for r in described}["Comment"] == "it's a table"


def test_store_partitioned_write_makes_one_file_per_small_partition(spark, store, tmp_path):
    df = spark.range(4000, numPartitions=8).withColumn("month", F.col("id") % 5)
    stored = store.write(df, "gold", "parts", partition_by=["month"])
    assert stored.count() == 4000
    assert len(list((tmp_path / "lake/gold/parts").glob("month=*/*.parquet"))) == 5


def test_lineage_grows_with_writes(spark, store):
    assert store.lineage().count() == 0
    store.write(spark.range(1), "silver", "s", sources=["raw.a", "raw.b"])
    store.write(spark.range(1), "gold", "g", sources=[store.full_name("silver", "s")])
    edges = [(r.source_table_full_name, r.target_table_full_name) for r in store.lineage().orderBy("created_at").collect()]
    assert sorted(edges[:2]) == [("raw.a", store.full_name("silver", "s")), ("raw.b", store.full_name("silver", "s"))]
    assert edges[2] == (store.full_name("silver", "s"), store.full_name("gold", "g"))


def test_store_is_found_again_without_its_catalog(spark, store):
    months = spark.range(40).withColumn("month", F.col("id") % 4)
    store.write(months, "gold", "parts", comment="it's a table", tags={"domain": "fraud"}, partition_by=["month"])
    store.write(spark.range(3), "bronze", "plain")
    store.tag("bronze", "plain", {"use": "tests"})
    for layer, table in (("gold", "parts"), ("bronze", "plain")):
        spark.sql(f"DROP TABLE {store.full_name(layer, table)}")  # external: the files stay
    again = TableStore(spark, store.root, store.name)
    assert again.read("gold", "parts").filter("month = 1").count() == 10 and again.read("bronze", "plain").count() == 3
    assert again.tables("gold") == ["parts"]
    tags = {r.key: r.value for r in again.tags("bronze", "plain").collect()}
    assert (tags["quality"], tags["use"]) == ("bronze", "tests")


def test_role_views_of_equal_names(spark, store):
    store.write(spark.range(3), "bronze", "t")
    store.write(spark.range(7), "silver", "t")
    store.role_views("data-engineers")
    assert [spark.table(f"data_engineers_{layer}_t").count() for layer in ("bronze", "silver")] == [3, 7]


def test_role_views(spark, store):
    store.write(spark.range(2).withColumn("cvv", F.lit("1")), "bronze", "cards")
    store.write(spark.range(3), "gold", "features")
    assert set(store.role_views("analysts")) == {"gold.features"}
    engineers = store.role_views("data-engineers", {"cards": ["id"]})
    assert engineers["bronze.cards"].columns == ["id"]
    assert spark.table("data_engineers_bronze_cards").columns == ["id"]
    assert store.role_views("model-serving") == {}


def test_stages_are_stored_below_the_shared_folder(spark):
    root = shared_root(spark)
    assert scratch_path(spark, "x").startswith(root) and scratch_path(spark, "x") != scratch_path(spark, "x")
    staged = cut_lineage(spark.range(5).withColumn("r", F.rand()))
    assert staged.collect() == staged.collect()
    assert all(root.replace("file:", "") in f for f in staged.inputFiles())


def test_cluster_without_shared_folder_is_refused():
    class Conf:
        def get(self, name, default):
            return default

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(Session())


def test_roles_read_and_write_their_layers_only(spark, store):
    df = spark.createDataFrame([(1,)], "id int")
    store.write(df, "gold", "rights")
    team = store.for_role("ml-team")
    assert team.read("gold", "rights").count() == 1 and team.write(df, "ml", "scores_of_team").count() == 1
    for refused in (lambda: team.write(df, "gold", "rights"), lambda: team.read("silver", "x"), lambda: store.for_role("analysts").write(df, "gold", "x")):
        with pytest.raises(PermissionError):
            refused()
    with pytest.raises(ValueError):
        store.for_role("nobody")


def test_unique_key_is_checked_when_written(spark, store):
    from ledgerlens.operators.joins import DuplicateKeyError

    good = spark.createDataFrame([(1,), (2,), (None,), (None,)], "id int")
    assert store.write(good, "bronze", "unique", unique_key="id").count() == 4
    with pytest.raises(DuplicateKeyError):
        store.write(good.unionAll(good), "bronze", "unique", unique_key="id")

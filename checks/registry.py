"""Every query of the check set: name -> callable(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import adapters as a
from ledgerlens.contract import (
    CARDS_SCHEMA,
    FEATURE_COLUMNS,
    LAYERS,
    ROLE_LAYERS,
    TABLE_TAGS,
    TRANSACTIONS_SCHEMA,
    USERS_SCHEMA,
)
from ledgerlens.functions.cleaning import (
    blank_to_null,
    encode_label,
    parse_currency,
    parse_timestamp,
)
from ledgerlens.functions.measures import row_count
from ledgerlens.functions.scores import traffic_arm
from ledgerlens.operators import columns, filters
from ledgerlens.operators.distribution import ranking_quality
from ledgerlens.operators.evaluation import (
    class_balance,
    class_weights,
    classification_report,
    time_split,
)
from ledgerlens.operators.joins import left_lookup
from ledgerlens.operators.quality import Rule, apply_rules, passing, rule_metrics, stored_metrics, with_outcomes
from ledgerlens.operators.rolling import CARD_FEATURES, rolling_features, rolling_sliced
from ledgerlens.plans import governance, layers, model_reports, reports, training
from ledgerlens.session import scratch_path
from ledgerlens.sources import readers
from ledgerlens.sources.store import TableStore
from ledgerlens.streaming import features, jobs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    """Registers the function below under ``name``."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        return run

    return register


# Digits to which quotients and roots of doubles are compared; sums and means of money are exact.
ROUNDED = {"debt_to_income": 6, "std_amount_24h": 4}


def presented(df: DataFrame) -> DataFrame:
    """Zoneless times and rounded quotients, as the comparison needs them."""
    changes = {n: F.round(F.col(n), digits) for n, digits in ROUNDED.items() if n in df.columns}
    for field in df.schema.fields:
        if field.dataType.typeName() == "timestamp":
            changes[field.name] = F.col(field.name).cast("timestamp_ntz")
    return df.withColumns(changes) if changes else df


def stored_csv(spark: SparkSession, df: DataFrame, name: str) -> str:
    path = scratch_path(spark, name)
    df.write.csv(path, header=True)
    return path


def new_store(spark: SparkSession) -> TableStore:
    root = scratch_path(spark, "store")
    return TableStore(spark, root, name=f"lake_{root[-8:]}")


# --- sources and sinks ---------------------------------------------------------------


@query("csv_scan_tx")
def csv_scan_tx(spark, sf_dir):
    path = stored_csv(spark, a.raw_transactions(spark, sf_dir), "transactions")
    return readers.read_csv(spark, path, TRANSACTIONS_SCHEMA)


@query("csv_scan_cards")
def csv_scan_cards(spark, sf_dir):
    path = stored_csv(spark, a.raw_cards(spark, sf_dir), "cards")
    return readers.read_csv(spark, path, CARDS_SCHEMA)


@query("csv_scan_users")
def csv_scan_users(spark, sf_dir):
    path = stored_csv(spark, a.raw_users(spark, sf_dir), "users")
    return readers.read_csv(spark, path, USERS_SCHEMA)


@query("ingest_metadata")
def ingest_metadata(spark, sf_dir):
    path = stored_csv(spark, a.raw_transactions(spark, sf_dir), "transactions")
    rows = readers.with_ingest_columns(readers.read_csv(spark, path, TRANSACTIONS_SCHEMA), source_file=True)
    return rows.groupBy("use_chip").agg(
        row_count().alias("total"),
        F.count("_ingestion_timestamp").alias("stamped"),
        F.count_if(F.col("_source_file").endswith(".csv")).alias("traced"),
    )


def stored_dicts(spark, entries, key, value, size, name, root=None):
    """JSON dictionaries of at most ``size`` consecutive keys, one document per file."""
    path = scratch_path(spark, name)
    pair = F.struct(F.col(key).cast("string"), F.col(value))
    document = F.col("entries") if root is None else F.struct(F.col("entries").alias(root))
    (
        entries.groupBy(F.floor(F.col(key) / size).alias("document"))
        .agg(F.map_from_entries(F.collect_list(pair)).alias("entries"))
        .select(F.to_json(document).alias("value"), "document")
        .write.partitionBy("document")
        .text(path)
    )
    return path


@query("json_dict_labels")
def json_dict_labels(spark, sf_dir):
    labels = a.raw_labels(spark, sf_dir)
    path = stored_dicts(spark, labels, "transaction_id", "label", 10_000, "labels", root="target")
    return readers.read_json_dict(
        spark, path, "transaction_id", "label", "bigint", root="target", splittable=True
    )


@query("json_dict_quoted")
def json_dict_quoted(spark, sf_dir):
    """Names with commas, quotes and backslashes, read in parallel pieces."""
    parts = a.load(spark, sf_dir, "part").selectExpr("p_partkey", """concat(p_name, ', "', p_brand, '" \\\\', p_type) AS p_name""")
    path = stored_dicts(spark, parts, "p_partkey", "p_name", 10_000, "names", root="target")
    return readers.read_json_dict(spark, path, "part", "name", "bigint", root="target", splittable="quotes")


@query("json_dict_codes")
def json_dict_codes(spark, sf_dir):
    parts = a.load(spark, sf_dir, "part")
    path = stored_dicts(spark, parts, "p_partkey", "p_name", 10_000, "codes")
    return readers.read_json_dict(spark, path, "mcc_code", "mcc_name", "int")


@query("table_roundtrip")
def table_roundtrip(spark, sf_dir):
    cards = layers.clean_cards(a.raw_cards(spark, sf_dir))
    return new_store(spark).write(cards, "silver", "cards", comment="Cleaned cards")


@query("feature_records_scan")
def feature_records_scan(spark, sf_dir):
    path = scratch_path(spark, "records")
    a.gold(spark, sf_dir).select(*FEATURE_COLUMNS).write.json(path)
    return presented(readers.read_feature_records(spark, path))


@query("table_tags")
def table_tags(spark, sf_dir):
    store = new_store(spark)
    tags = TABLE_TAGS["fraud_training"]
    table = store.write(a.labelled(spark, sf_dir), "gold", "fraud_training", tags=tags)
    rows = table.count()
    listed = store.tags("gold", "fraud_training").filter(F.col("key").isin("quality", *tags))
    return listed.select("key", "value", F.lit(rows).cast("bigint").alias("rows"))


# --- cleaning ------------------------------------------------------------------------


@query("parse_currency")
def currency_parse(spark, sf_dir):
    text = a.load(spark, sf_dir, "customer").selectExpr("c_custkey", f"{a.money('c_acctbal')} AS text")
    return text.select("c_custkey", parse_currency(F.col("text")).alias("amount"))


@query("parse_timestamp")
def timestamp_parse(spark, sf_dir):
    raw = a.raw_transactions(spark, sf_dir)
    return presented(raw.select("id", parse_timestamp(F.col("date")).alias("ts")))


@query("blank_to_null")
def blank_errors(spark, sf_dir):
    return a.raw_transactions(spark, sf_dir).select("id", blank_to_null(F.col("errors")).alias("errors"))


@query("label_encode")
def label_encode(spark, sf_dir):
    raw = a.raw_labels(spark, sf_dir)
    return raw.select("transaction_id", encode_label(F.col("label")).alias("is_fraud"))


@query("numeric_coerce")
def numeric_coerce(spark, sf_dir):
    raw = a.raw_transactions(spark, sf_dir).select("id", "zip", "use_chip")
    return columns.numeric(raw, ["zip", "use_chip"])


@query("minimise_columns")
def minimise_columns(spark, sf_dir):
    return layers.clean_users(a.raw_users(spark, sf_dir))


@query("feature_projection")
def feature_projection(spark, sf_dir):
    return presented(columns.feature_projection(a.gold(spark, sf_dir), carry=["transaction_id"]))


@query("exclude_columns")
def exclude_columns(spark, sf_dir):
    return columns.exclude(a.row_features(spark, sf_dir)).withColumn(
        "debt_to_income", F.round(F.col("debt_to_income"), 6)
    )


@query("rename_tag")
def rename_tag(spark, sf_dir):
    codes = a.raw_codes(spark, sf_dir).withColumnRenamed("mcc_code", "code")
    used = a.raw_transactions(spark, sf_dir).groupBy("mcc").agg(row_count().alias("uses"))
    return columns.tagged(left_lookup(used, codes, "mcc", "code"), "mcc_codes")


# --- filters -------------------------------------------------------------------------


@query("filter_labelled")
def filter_labelled(spark, sf_dir):
    return filters.present(a.silver(spark, sf_dir), "is_fraud").select("transaction_id", "is_fraud")


@query("filter_equal")
def filter_equal(spark, sf_dir):
    return filters.equal_to(a.silver(spark, sf_dir), "is_fraud", 1).select("transaction_id", "amount")


@query("filter_nonblank")
def filter_nonblank(spark, sf_dir):
    kept = filters.not_blank(a.silver(spark, sf_dir), "merchant_state")
    return kept.select("transaction_id", "merchant_state")


@query("filter_time_range")
def filter_time_range(spark, sf_dir):
    orders = a.load(spark, sf_dir, "orders")
    kept = filters.between_times(orders, "o_orderdate", "1999-01-01", "2000-01-01")
    return kept.select("o_orderkey", "o_orderdate")


@query("filter_trailing")
def filter_trailing(spark, sf_dir):
    kept = filters.trailing(a.request_logs(spark, sf_dir), "timestamp", 7, a.AS_OF)
    return presented(kept.select("transaction_id", "timestamp"))


@query("filter_prefix")
def filter_prefix(spark, sf_dir):
    return filters.with_prefix(a.lineage_edges(spark, sf_dir), "target_table_full_name", "lake.")


@query("filter_in")
def filter_in(spark, sf_dir):
    return filters.one_of(a.silver(spark, sf_dir), "is_fraud", [0, 1]).select("transaction_id", "is_fraud")


# --- rules ---------------------------------------------------------------------------

CHECKED = [
    Rule("known_category", "mcc_name IS NOT NULL", "drop"),
    Rule("known_state", "merchant_state <> ''", "drop"),
    Rule("error_is_pin", "errors = 'Bad PIN'", "warn"),
]


@query("rules_drop")
def rules_drop(spark, sf_dir):
    return apply_rules(a.silver(spark, sf_dir), CHECKED).select("transaction_id", "mcc_name", "merchant_state")


@query("rules_metrics")
def rules_metrics(spark, sf_dir):
    return rule_metrics(a.silver(spark, sf_dir), CHECKED)


def judged(spark, sf_dir):
    """Silver rows, dropped ones too, stored with the outcomes of the rules."""
    return new_store(spark).write(with_outcomes(a.silver(spark, sf_dir), CHECKED), "silver", "judged", "Judged rows")


@query("rules_stored_metrics")
def rules_stored_metrics(spark, sf_dir):
    return stored_metrics(judged(spark, sf_dir), CHECKED)


@query("rules_stored_drop")
def rules_stored_drop(spark, sf_dir):
    return passing(judged(spark, sf_dir), CHECKED).select("transaction_id", "mcc_name", "merchant_state")


# --- joins ---------------------------------------------------------------------------


def fact(spark, sf_dir):
    return layers.clean_transactions(a.raw_transactions(spark, sf_dir))


@query("join_labels")
def join_labels(spark, sf_dir):
    labels = layers.clean_labels(a.raw_labels(spark, sf_dir))
    joined = left_lookup(fact(spark, sf_dir), labels, "transaction_id", "transaction_id")
    return joined.select("transaction_id", "is_fraud")


@query("join_cards")
def join_cards(spark, sf_dir):
    cards = layers.clean_cards(a.raw_cards(spark, sf_dir))
    joined = left_lookup(fact(spark, sf_dir), cards, "card_id", "id")
    return joined.select("transaction_id", "card_brand", "credit_limit")


@query("join_users")
def join_users(spark, sf_dir):
    users = layers.clean_users(a.raw_users(spark, sf_dir))
    joined = left_lookup(fact(spark, sf_dir), users, "client_id", "id")
    return joined.select("transaction_id", "current_age", "yearly_income")


@query("join_codes")
def join_codes(spark, sf_dir):
    codes = layers.clean_codes(a.raw_codes(spark, sf_dir))
    return left_lookup(fact(spark, sf_dir), codes, "mcc", "mcc_code").select("transaction_id", "mcc", "mcc_name")


@query("star_enrich")
def star_enrich(spark, sf_dir):
    return presented(layers.build_silver(a.bronze(spark, sf_dir), verify_keys=True))


# --- row features --------------------------------------------------------------------


@query("time_features")
def time_features(spark, sf_dir):
    return layers.with_time_features(a.silver(spark, sf_dir)).select(
        "transaction_id", "hour_of_day", "day_of_week", "month"
    )


@query("type_flags")
def type_flags(spark, sf_dir):
    return layers.with_type_flags(a.silver(spark, sf_dir)).select(
        "transaction_id", "is_online", "is_chip", "is_swipe"
    )


@query("amount_features")
def amount_features(spark, sf_dir):
    return layers.with_amount_features(a.silver(spark, sf_dir)).select(
        "transaction_id", "is_refund", "abs_amount"
    )


@query("risk_ratio")
def risk_ratio(spark, sf_dir):
    flags = layers.with_risk_features(a.silver(spark, sf_dir))
    return presented(
        flags.select("transaction_id", "has_error", "is_dark_web", "has_chip_flag", "debt_to_income")
    )


# --- rolling features ----------------------------------------------------------------


def rolled(spark, sf_dir, *names):
    specs = [spec for spec in CARD_FEATURES if spec.name in names]
    rows = layers.with_amount_features(fact(spark, sf_dir))
    done = rolling_features(rows, "card_id", "ts", specs, key_source=a.card_keys(spark, sf_dir))
    return presented(done.select("transaction_id", *names))


@query("roll_1h")
def roll_1h(spark, sf_dir):
    return rolled(spark, sf_dir, "tx_count_1h", "tx_amount_1h")


@query("roll_24h")
def roll_24h(spark, sf_dir):
    return rolled(spark, sf_dir, "tx_count_24h", "tx_amount_24h", "avg_amount_24h", "std_amount_24h")


@query("roll_24h_distinct")
def roll_24h_distinct(spark, sf_dir):
    return rolled(spark, sf_dir, "unique_merchants_24h", "unique_states_24h")


@query("roll_7d")
def roll_7d(spark, sf_dir):
    return rolled(spark, sf_dir, "tx_count_7d", "tx_amount_7d")


@query("roll_sliced")
def roll_sliced(spark, sf_dir):
    """The plan for hot cards, here taken for every card."""
    rows = layers.with_amount_features(fact(spark, sf_dir))
    done = rolling_sliced(rows, "card_id", "ts", CARD_FEATURES)
    return presented(done.select("transaction_id", *[spec.name for spec in CARD_FEATURES]))


def rolled_when(rows, frame_rows=100):
    """All rolling features, with cards of more than ``frame_rows`` rows a frame on slices."""
    done = rolling_features(rows, "card_id", "ts", CARD_FEATURES, frame_rows=frame_rows)
    return presented(done.select("transaction_id", *[spec.name for spec in CARD_FEATURES]))


@query("roll_hot_routed")
def roll_hot_routed(spark, sf_dir):
    """A third of all transactions on one card."""
    rows = layers.with_amount_features(fact(spark, sf_dir))
    hot = F.when(F.col("transaction_id") % 3 == 0, F.lit(-1)).otherwise(F.col("card_id"))
    return rolled_when(rows.withColumn("card_id", hot))


@query("roll_dense_cards")
def roll_dense_cards(spark, sf_dir):
    """All transactions within one day, on twenty cards."""
    rows = layers.with_amount_features(fact(spark, sf_dir))
    moment = F.timestamp_seconds(F.col("transaction_id") * 7919 % 86_400)
    return rolled_when(rows.withColumns({"card_id": F.col("transaction_id") % 20, "ts": moment}))


@query("gold_features")
def gold_features(spark, sf_dir):
    return presented(a.gold(spark, sf_dir))


@query("gold_training")
def gold_training(spark, sf_dir):
    return presented(layers.build_gold_training(a.gold(spark, sf_dir)))


# --- fraud reports -------------------------------------------------------------------


@query("fraud_by_month")
def fraud_by_month(spark, sf_dir):
    return reports.fraud_by_month(filters.present(a.dated_orders(spark, sf_dir), "is_fraud"))


def on_labelled(report):
    return lambda spark, sf_dir: report(a.labelled(spark, sf_dir))


for report in (
    reports.fraud_by_type,
    reports.top_mcc_fraud,
    reports.mcc_fraud_rate,
    reports.fraud_by_hour,
    reports.fraud_by_state,
    reports.amount_distribution,
    reports.error_vs_fraud,
    reports.high_risk_customers,
    reports.fraud_by_brand,
    reports.refund_vs_fraud,
):
    query(report.__name__)(on_labelled(report))


# --- model reports -------------------------------------------------------------------


@query("model_comparison")
def model_comparison(spark, sf_dir):
    return model_reports.model_comparison(a.request_logs(spark, sf_dir), a.ENDPOINT, as_of=a.AS_OF)


@query("score_distribution")
def score_distribution(spark, sf_dir):
    return model_reports.score_distribution(a.request_logs(spark, sf_dir), a.ENDPOINT, as_of=a.AS_OF)


@query("request_log_scan")
def request_log_scan(spark, sf_dir):
    path = scratch_path(spark, "request_logs")
    a.request_logs(spark, sf_dir).drop("transaction_id").write.parquet(path)
    return readers.read_request_logs(spark, path).groupBy("endpoint_name", "model_version").agg(
        row_count().alias("requests"), F.min("execution_duration_ms").alias("fastest_ms")
    )


@query("ab_evaluation")
def ab_evaluation(spark, sf_dir):
    outcomes = layers.clean_labels(a.raw_labels(spark, sf_dir))
    table = model_reports.ab_evaluation(
        a.request_logs(spark, sf_dir), outcomes, a.ENDPOINT, "transaction_id", days=31, as_of=a.AS_OF, threshold=0.1
    )
    rounded = {n: F.round(F.col(n), 6) for n in ("precision", "recall", "f1", "roc_auc", "pr_auc")}
    return table.withColumns(rounded)


# --- governance ----------------------------------------------------------------------


def built_lake(spark, sf_dir):
    """Raw CSV and JSON files through bronze and silver to the stored gold tables."""
    raw = a.bronze(spark, sf_dir)
    paths = {name: stored_csv(spark, getattr(raw, name), name) for name in ("transactions", "cards", "users")}
    paths["labels"] = stored_dicts(spark, raw.labels, "transaction_id", "label", 10_000, "labels", root="target")
    paths["codes"] = stored_dicts(spark, raw.codes, "mcc_code", "mcc_name", 10_000, "codes")
    return layers.build_lakehouse(spark, paths, new_store(spark))


@query("lakehouse_build")
def lakehouse_build(spark, sf_dir):
    return presented(built_lake(spark, sf_dir).read("gold", "fraud_features").drop("ts_month"))


@query("lineage_captured")
def lineage_captured(spark, sf_dir):
    """Edges recorded while the lake was built, without the names that differ from run to run."""
    store = built_lake(spark, sf_dir)

    def plain(name):
        known = F.regexp_replace(name, f"^{store.name}_", "")
        return F.regexp_replace(known, r"^.*/([a-z]+)-[0-9a-f]{32}$", "file $1").alias(name)

    return store.lineage().select(plain("source_table_full_name"), plain("target_table_full_name"))


@query("table_counts")
def table_counts(spark, sf_dir):
    store = built_lake(spark, sf_dir)
    stored = [(layer, table) for layer in ("bronze", "silver", "gold") for table in store.tables(layer)]
    return governance.table_counts({f"{layer}_{table}": store.read(layer, table) for layer, table in stored})


@query("lineage_latest")
def lineage_latest(spark, sf_dir):
    return governance.latest_lineage(a.lineage_edges(spark, sf_dir), "lake.")


@query("role_views")
def role_views(spark, sf_dir):
    store = new_store(spark)
    store.write(a.raw_cards(spark, sf_dir), "bronze", "cards")
    store.write(a.raw_transactions(spark, sf_dir), "bronze", "transactions")
    store.write(a.silver(spark, sf_dir), "silver", "transactions")
    store.write(a.labelled(spark, sf_dir), "gold", "fraud_training")
    narrowed = {"cards": ["id", "card_brand", "card_type"]}
    store.write(a.scored_labels(spark, sf_dir).select("score"), "ml", "scores")
    store = TableStore(spark, store.root, store.name)
    return governance.visible_counts({role: store.role_views(role, narrowed) for role in ROLE_LAYERS})


@query("role_rights")
def role_rights(spark, sf_dir):
    """What each role may do to each layer, found by trying it on a table of category names."""
    store, codes = new_store(spark), a.raw_codes(spark, sf_dir)
    for layer in LAYERS:
        store.write(codes, layer, "names")

    def allowed(attempt):
        try:
            attempt()
        except PermissionError:
            return False
        return True

    rights = []
    for role in ROLE_LAYERS:
        own = store.for_role(role)
        for layer in LAYERS:
            can_write = allowed(lambda: own.write(codes, layer, f"by_{role}".replace("-", "_")))
            rights.append((role, layer, allowed(lambda: own.read(layer, "names")), can_write))
    tried = spark.createDataFrame(rights, "role STRING, layer STRING, reads BOOLEAN, writes BOOLEAN")
    return tried.withColumn("rows", F.lit(store.read("gold", "names").count()).cast("bigint"))


@query("class_balance")
def label_balance(spark, sf_dir):
    shares = ("fraud_pct", "normal_pct", "neg_per_pos")
    balance = class_balance(a.labelled(spark, sf_dir))
    return balance.withColumns({name: F.round(F.col(name), 6) for name in shares})


# --- models --------------------------------------------------------------------------


@query("time_split")
def split_by_time(spark, sf_dir):
    split = time_split(a.dated_orders(spark, sf_dir), "ts", "1999-01-01", "2000-01-01")
    return split.select("o_orderkey", "split")


@query("class_weight")
def class_weight(spark, sf_dir):
    train = filters.between_times(a.labelled(spark, sf_dir), "ts", None, a.VALIDATION_START)
    parts = [
        columns.tagged(class_weights(train, scheme=scheme), scheme, "scheme") for scheme in ("ratio", "balanced")
    ]
    both = parts[0].unionAll(parts[1])
    return both.withColumn("weight", F.round(F.col("weight"), 6))


@query("classification_report")
def quality_report(spark, sf_dir):
    report = classification_report(a.scored_labels(spark, sf_dir), "score", threshold=0.1)
    return report.withColumns({n: F.round(F.col(n), 6) for n in ("precision", "recall", "f1")})


@query("roc_auc")
def roc_auc(spark, sf_dir):
    ranked = ranking_quality(a.scored_labels(spark, sf_dir), "score", "is_fraud")
    return ranked.select("positives", "negatives", F.round(F.col("roc_auc"), 8).alias("roc_auc"))


@query("pr_auc")
def pr_auc(spark, sf_dir):
    ranked = ranking_quality(a.scored_labels(spark, sf_dir), "score", "is_fraud")
    return ranked.select("positives", F.round(F.col("pr_auc"), 8).alias("pr_auc"))


@query("traffic_split")
def traffic_split(spark, sf_dir):
    return a.load(spark, sf_dir, "events").select("event_id", traffic_arm(F.col("event_id")).alias("model"))


def split_training(spark, sf_dir):
    store = new_store(spark)
    table = store.write(filters.with_month(a.gold(spark, sf_dir)), "gold", "fraud_features", partition_by=layers.LAYOUT)
    return table, time_split(layers.build_gold_training(table), "ts", a.VALIDATION_START, a.TEST_START)


@query("train_score")
def train_score(spark, sf_dir):
    table, rows = split_training(spark, sf_dir)
    trained = training.train_boosted_trees(rows, training.RATIO_WEIGHTED)
    return training.batch_score(trained.model, table, carry=["transaction_id", "is_fraud"])


#: Labelled training rows of ``model_search`` and ``stream_score`` at most.
TRAIN_ROWS = 20_000
EVERY_FEATURE = {"featureSubsetStrategy": "all", "subsamplingRate": 1.0}


def decisive_model(spark, sf_dir, params):
    """Rows whose label is whether they are refunds, which one split of one tree tells, and a model of them."""
    table = a.row_features(spark, sf_dir)
    blank = [name for name in FEATURE_COLUMNS if name not in table.columns]
    table = table.withColumns({name: F.lit(None).cast("double") for name in blank} | {"is_fraud": F.col("is_refund")})
    rows = time_split(table, "ts", a.VALIDATION_START, a.TEST_START)
    return rows, training.train_boosted_trees(rows, params).model


@query("train_decisive")
def train_decisive(spark, sf_dir):
    """Every tree may use the telling feature. The loss falls with each, so the rule on patience never stops."""
    rows, model = decisive_model(spark, sf_dir, {**training.RATIO_WEIGHTED, "maxIter": 40, **EVERY_FEATURE})
    return training.batch_score(model, rows, carry=["transaction_id"]).select("transaction_id", "flagged")


@query("evaluate_splits")
def evaluate_splits(spark, sf_dir):
    """The measures are checked here, not the learner, so the trees are few."""
    rows, model = decisive_model(spark, sf_dir, {**training.RATIO_WEIGHTED, "maxIter": 5, **EVERY_FEATURE})
    return training.evaluate_splits(model, rows)[0]


@query("model_search")
def model_search(spark, sf_dir):
    _, rows = split_training(spark, sf_dir)
    return training.model_search(rows, [training.RATIO_WEIGHTED, training.BALANCED], train_rows=TRAIN_ROWS)[1]


# --- streams -------------------------------------------------------------------------


@query("stream_ingest")
def stream_ingest(spark, sf_dir):
    source = stored_csv(spark, a.raw_transactions(spark, sf_dir), "arriving")
    target = scratch_path(spark, "ingested")
    jobs.drain(jobs.stream_transactions(spark, source), target, scratch_path(spark, "progress"))
    return spark.read.parquet(target).drop("_ingestion_timestamp", "_source_file")


@query("incremental_features")
def incremental_features(spark, sf_dir):
    """Three drops of files, every third transaction each, so that later drops change earlier features."""
    raw, store = a.bronze(spark, sf_dir), new_store(spark)
    arriving, progress = scratch_path(spark, "arriving"), scratch_path(spark, "progress")
    for drop in range(3):
        raw.transactions.filter(F.col("id") % 3 == drop).write.mode("append").csv(arriving, header=True)
        stream = jobs.stream_transactions(spark, arriving)
        features.drain_features(stream, store, raw.cards, raw.users, raw.labels, raw.codes, progress)
    return presented(features.current_features(store).drop("ts_month"))


@query("late_months_only")
def late_months_only(spark, sf_dir):
    """Orders laid out by month, then the rows of one year written again with half their amount: other months stay."""
    store, orders = new_store(spark), filters.with_month(a.dated_orders(spark, sf_dir))
    store.write(orders, "silver", "orders", partition_by=["ts_month"])
    late = filters.between_times(orders, "ts", "1997-01-01", "1998-01-01")
    halved = late.withColumn("abs_amount", F.col("abs_amount") / 2)
    table = store.write(halved, "silver", "orders", partition_by=["ts_month"], replace="partitions")
    return reports.fraud_by_month(filters.present(table, "is_fraud"), "1996-01-01", "1999-01-01")


@query("stream_rules")
def stream_rules(spark, sf_dir):
    source = stored_csv(spark, a.raw_transactions(spark, sf_dir), "arriving")
    target = scratch_path(spark, "checked")
    rules = [Rule("in_store", "merchant_state <> ''", "drop"), Rule("no_refund", "amount NOT LIKE '$-%'", "warn")]
    stream = jobs.stream_transactions(spark, source)
    kept, outcomes = jobs.drain_checked(stream, rules, target, scratch_path(spark, "progress"))
    counted = outcomes.select(F.col("rule").alias("part"), "evaluated", "passed", "failed")
    stored = kept.agg(F.lit("kept").alias("part"), row_count().alias("evaluated"), F.count("merchant_state").alias("passed"))
    return counted.unionByName(stored.withColumn("failed", F.col("evaluated") - F.col("passed")))


@query("stream_score")
def stream_score(spark, sf_dir):
    table, rows = split_training(spark, sf_dir)
    prepared = training.prepare(rows, train_rows=TRAIN_ROWS)
    model = training.fit(prepared, training.RATIO_WEIGHTED).model
    other = training.fit(prepared, {**training.RATIO_WEIGHTED, "scheme": "balanced"}).model
    source, target = scratch_path(spark, "to_score"), scratch_path(spark, "logs")
    table.select("transaction_id", *FEATURE_COLUMNS).write.json(source)
    models = {"champion": (model, "v1"), "challenger": (other, "v2")}
    records = jobs.stream_records(spark, source)
    jobs.drain_scores(records, models, a.ENDPOINT, target, scratch_path(spark, "progress"))
    return (
        readers.read_request_logs(spark, target)
        .withColumn("score", model_reports.score_from_response(F.col("response")))
        .groupBy("model_name", "model_version", "endpoint_name")
        .agg(
            row_count().alias("requests"),
            F.count_if(F.col("score").between(0, 1)).alias("scored"),
            F.count_if(F.col("execution_duration_ms") >= 0).alias("timed"),
        )
    )

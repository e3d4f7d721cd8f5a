"""The same queries as SQL for DuckDB over the test tables.

Conventions: times are zoneless, seconds are floored, sums are cast to the type
Spark gives them. Money is summed as whole numbers of 1/10000, and its rounded sums, means
and percentiles come from the exact numerator and denominator; other doubles are rounded plainly.
"""

from __future__ import annotations

from checks.adapters import AS_OF, ENDPOINT, TEST_START, VALIDATION_START


def rounded(value: str, digits: int) -> str:
    return f"round({value}, {digits})"


def half_up(numerator: str, denominator: str, digits: int) -> str:
    """Quotient of whole numbers, ties away from zero."""
    top, over = f"CAST({numerator} AS HUGEINT) * {10**digits}", f"nullif(CAST({denominator} AS HUGEINT), 0)"
    return f"CAST(sign({numerator}) * ((2 * abs({top}) + {over}) // (2 * {over})) AS DOUBLE) / {10**digits}"


def rate(part: str, whole: str, digits: int = 4) -> str:
    return half_up(f"({part}) * 100", whole, digits)


def whole(value: str, kept: int = 4) -> str:
    return f"CAST(round(({value}) * {10**kept}) AS HUGEINT)"


def total(value: str, digits: int = 2) -> str:
    return half_up(f"sum({whole(value)})", "10000", digits)


def mean(value: str, digits: int = 2, kept: int = 4) -> str:
    return half_up(f"sum({whole(value, kept)})", f"count({value}) * {10**kept}", digits)


def percentile(value: str, percent: int, digits: int) -> str:
    """Interpolated percentile of money from the sorted list of its whole units."""
    values, place = f"list_sort(list({whole(value)}) FILTER ({value} IS NOT NULL))", f"{percent} * (count({value}) - 1)"
    low, high = f"{values}[{place} // 100 + 1]", f"{values}[({place} + 99) // 100 + 1]"
    return half_up(f"({low} * 100 + ({high} - {low}) * ({place} % 100))", "1000000", digits)


RAW_TX = """raw_tx AS (
    SELECT event_id AS id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS date,
        user_id AS client_id, user_id AS card_id,
        '$' || format('{:,.2f}', CASE WHEN event_type = 'signup' THEN -value ELSE value END) AS amount,
        CASE event_type WHEN 'purchase' THEN 'Online Transaction'
            WHEN 'click' THEN 'Chip Transaction' WHEN 'signup' THEN 'Chip Transaction'
            ELSE 'Swipe Transaction' END AS use_chip,
        CAST(k AS BIGINT) AS merchant_id, 'City ' || k AS merchant_city,
        CASE WHEN event_type = 'purchase' THEN '' ELSE 'NATION_' || (k % 25) END AS merchant_state,
        lpad(CAST(k AS VARCHAR), 5, '0') AS zip, k AS mcc,
        CASE WHEN event_type = 'error' AND k % 2 = 0 THEN 'Bad PIN'
            WHEN event_type = 'error' THEN 'Insufficient Balance'
            WHEN k % 7 = 0 THEN '' END AS errors
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))"""

# A CSV reader with default options takes a blank field for NULL.
SCANNED_TX = """SELECT * REPLACE (nullif(merchant_state, '') AS merchant_state, nullif(errors, '') AS errors) FROM raw_tx"""

RAW_TX_SCANNED = RAW_TX.replace("THEN '' ELSE 'NATION_'", "THEN NULL ELSE 'NATION_'")

CARDS = """cards AS (
    SELECT c_custkey AS id,
        ['Visa', 'Mastercard', 'Discover', 'Amex'][CAST(c_custkey % 4 AS INTEGER) + 1] AS card_brand,
        ['Debit', 'Credit', 'Debit (Prepaid)'][c_nationkey % 3 + 1] AS card_type,
        CASE WHEN c_custkey % 2 = 0 THEN 'YES' ELSE 'NO' END AS has_chip,
        c_acctbal AS credit_limit, CAST(c_nationkey % 3 + 1 AS INTEGER) AS num_cards_issued,
        CAST(c_nationkey % 15 + 2005 AS INTEGER) AS year_pin_last_changed,
        CASE WHEN c_custkey % 10 = 0 THEN 'Yes' ELSE 'No' END AS card_on_dark_web
    FROM customer)"""

USERS = """users AS (
    SELECT c_custkey AS id, CAST(c_custkey % 60 + 18 AS INTEGER) AS current_age,
        CASE WHEN c_nationkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
        CAST(c_nationkey * 1.5 AS DOUBLE) AS latitude, CAST(c_nationkey * -2.5 AS DOUBLE) AS longitude,
        greatest(c_acctbal, 0.0::DOUBLE) AS yearly_income,
        CAST(c_custkey * 7 % 100000 AS DOUBLE) AS total_debt,
        CAST(c_nationkey * 1000 AS DOUBLE) AS per_capita_income,
        CAST(c_custkey % 371 + 480 AS INTEGER) AS credit_score,
        CAST(c_nationkey % 5 + 1 AS INTEGER) AS num_credit_cards
    FROM customer)"""

SILVER = f"""{RAW_TX}, {CARDS}, {USERS}, silver AS (
    SELECT e.event_id AS transaction_id, date_trunc('second', e.ts) AS ts,
        r.client_id, r.card_id,
        CASE WHEN e.event_type = 'signup' THEN -e.value ELSE e.value END AS amount,
        r.use_chip, r.merchant_id, r.merchant_city, r.merchant_state, r.zip, r.mcc,
        n.n_name AS mcc_name, CASE WHEN trim(r.errors) <> '' THEN r.errors END AS errors,
        c.* EXCLUDE (id), u.* EXCLUDE (id), l.toxic AS is_fraud
    FROM events e JOIN raw_tx r ON e.event_id = r.id
    LEFT JOIN labels l ON e.event_id = l.doc_id
    LEFT JOIN cards c ON r.card_id = c.id
    LEFT JOIN users u ON r.client_id = u.id
    LEFT JOIN nation n ON r.mcc = n.n_nationkey)"""

FEATURES = f"""{SILVER}, features AS (
    SELECT *, CAST(hour(ts) AS INTEGER) AS hour_of_day, CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week,
        CAST(month(ts) AS INTEGER) AS month,
        CAST(use_chip = 'Online Transaction' AS INTEGER) AS is_online,
        CAST(use_chip = 'Chip Transaction' AS INTEGER) AS is_chip,
        CAST(use_chip = 'Swipe Transaction' AS INTEGER) AS is_swipe,
        CAST(amount < 0 AS INTEGER) AS is_refund, abs(amount) AS abs_amount,
        CAST(errors IS NOT NULL AS INTEGER) AS has_error,
        CAST(card_on_dark_web = 'Yes' AS INTEGER) AS is_dark_web,
        CAST(has_chip = 'YES' AS INTEGER) AS has_chip_flag,
        {rounded("CASE WHEN yearly_income > 0 THEN total_debt / yearly_income END", 6)} AS debt_to_income
    FROM silver), labelled AS (SELECT * FROM features WHERE is_fraud IS NOT NULL)"""

def rolled_sum(frame: str) -> str:
    return f"CAST(sum({whole('abs_amount')}) OVER {frame} AS DOUBLE) / 10000"


def rolled_deviation(frame: str) -> str:
    n, s = f"count(abs_amount) OVER {frame}", f"sum({whole('abs_amount')}) OVER {frame}"
    q = f"sum({whole('abs_amount')} * {whole('abs_amount')}) OVER {frame}"
    square = f"CAST(({n}) * ({q}) - ({s}) * ({s}) AS DOUBLE) / CAST(({n}) * ({n} - 1) AS DOUBLE)"
    return f"CASE WHEN ({n}) > 1 THEN round(sqrt({square}) / 10000, 4) END"


ROLLING = f"""
        count(transaction_id) OVER h AS tx_count_1h,
        {rolled_sum("h")} AS tx_amount_1h,
        count(transaction_id) OVER d AS tx_count_24h,
        {rolled_sum("d")} AS tx_amount_24h,
        CAST(sum({whole('abs_amount')}) OVER d AS DOUBLE) / CAST((count(abs_amount) OVER d) * 10000 AS DOUBLE) AS avg_amount_24h,
        {rolled_deviation("d")} AS std_amount_24h,
        count(DISTINCT merchant_id) OVER d AS unique_merchants_24h,
        count(DISTINCT merchant_state) OVER d AS unique_states_24h,
        count(transaction_id) OVER w AS tx_count_7d,
        {rolled_sum("w")} AS tx_amount_7d"""

GOLD = f"""{FEATURES}, gold AS (
    SELECT * EXCLUDE (sec), {ROLLING}
    FROM (SELECT *, epoch_us(ts) // 1000000 AS sec FROM features)
    WINDOW h AS (PARTITION BY card_id ORDER BY sec RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW),
        d AS (PARTITION BY card_id ORDER BY sec RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW),
        w AS (PARTITION BY card_id ORDER BY sec RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW))"""



def rolled_sql(card: str, sec: str) -> str:
    """Rolling features after moving transactions to another card and second."""
    return f"""WITH {FEATURES}, moved AS (SELECT * REPLACE ({card} AS card_id), {sec} AS sec FROM features)
        SELECT transaction_id, {ROLLING} FROM moved
        WINDOW h AS (PARTITION BY card_id ORDER BY sec RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW),
            d AS (PARTITION BY card_id ORDER BY sec RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW),
            w AS (PARTITION BY card_id ORDER BY sec RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW)"""


ORDERS = """dated AS (
    SELECT o_orderkey, o_orderdate AS ts, o_totalprice AS abs_amount,
        CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS is_fraud
    FROM orders)"""

LOGS = f"""logs AS (
    SELECT event_id AS transaction_id, 'card_model' AS model_name,
        'v' || (event_id % 2 + 1) AS model_version,
        CASE WHEN event_id % 10 = 0 THEN 'other' ELSE '{ENDPOINT}' END AS endpoint_name,
        ts AS timestamp, CASE WHEN event_id % 17 <> 0 THEN value / 500 END AS score,
        value AS execution_duration_ms
    FROM events), recent AS (
    SELECT * FROM logs WHERE endpoint_name = '{ENDPOINT}'
        AND timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY)"""

EDGES = """edges AS (
    SELECT 'lake.silver.' || event_type AS source_table_full_name,
        CASE WHEN k % 2 = 0 THEN 'lake.gold.' ELSE 'archive.gold.' END || 't' || (k % 5) AS target_table_full_name,
        ts AS created_at
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))"""

SCORED = """scored AS (
    SELECT event_id AS transaction_id, value / 500 AS score, toxic AS is_fraud
    FROM events JOIN labels ON event_id = doc_id)"""

TRAFFIC = """arms AS (
    SELECT event_id, CASE WHEN CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 90
        THEN 'champion' ELSE 'challenger' END AS model FROM events)"""


def fraud_by(
    *keys: str, extra: str = "", digits: int = 4, source: str = "labelled", having: str = ""
) -> str:
    positions = ", ".join(str(i + 1) for i in range(len(keys)))
    return f"""SELECT {", ".join(keys)}, count(*) AS total_tx, CAST(sum(is_fraud) AS BIGINT) AS fraud_count,
        {rate("sum(is_fraud)", "count(*)", digits)} AS fraud_rate_pct {extra}
        FROM {source} GROUP BY {positions} {having}"""


MEAN_AMOUNT = f", {mean('abs_amount')} AS avg_amount"
MEAN_FRAUD = f", {mean('CASE WHEN is_fraud = 1 THEN abs_amount END')} AS avg_fraud_amount"


def _class_rows(threshold: float) -> str:
    """Classification report over ``scored``."""
    def share(part: str, whole: str) -> str:
        return f"coalesce(({part}) / nullif(CAST({whole} AS DOUBLE), 0), 0.0)"

    return f"""{SCORED}, cells AS (
        SELECT count_if(is_fraud = 1 AND score >= {threshold}) AS tp, count_if(is_fraud = 0 AND score >= {threshold}) AS fp,
            count_if(is_fraud = 1 AND score < {threshold}) AS fn, count_if(is_fraud = 0 AND score < {threshold}) AS tn
        FROM scored),
    classes AS (
        SELECT 'normal' AS class, {share("tn", "tn + fn")} AS precision, {share("tn", "tn + fp")} AS recall,
            {share("2 * tn", "2 * tn + fn + fp")} AS f1, tn + fp AS support FROM cells
        UNION ALL
        SELECT 'fraud', {share("tp", "tp + fp")}, {share("tp", "tp + fn")},
            {share("2 * tp", "2 * tp + fn + fp")}, tp + fn FROM cells),
    report AS (
        SELECT * FROM classes
        UNION ALL
        SELECT 'accuracy', {share("tp + tn", "tp + tn + fp + fn")}, {share("tp + tn", "tp + tn + fp + fn")},
            {share("tp + tn", "tp + tn + fp + fn")}, tp + tn + fp + fn FROM cells
        UNION ALL
        SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM classes
        UNION ALL
        SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
            sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM classes)"""


def _ranking(source: str, by: str) -> str:
    """ROC-AUC and average precision per group, over each distinct score."""
    return f"""points AS (
        SELECT {by} AS grp, score, CAST(count_if(is_fraud = 1) AS DOUBLE) AS pos, CAST(count_if(is_fraud = 0) AS DOUBLE) AS neg
        FROM {source} WHERE score IS NOT NULL GROUP BY ALL),
    curve AS (
        SELECT *, sum(pos) OVER s AS tp, sum(neg) OVER s AS fp,
            sum(pos) OVER (PARTITION BY grp) AS all_pos, sum(neg) OVER (PARTITION BY grp) AS all_neg
        FROM points WINDOW s AS (PARTITION BY grp ORDER BY score DESC)),
    ranking AS (
        SELECT grp, CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives,
            sum(neg * (tp - pos + pos / 2)) / max(all_pos * all_neg) AS roc_auc,
            sum(pos * tp / (tp + fp)) / max(all_pos) AS pr_auc
        FROM curve GROUP BY grp)"""


RECORDS_DOUBLE = (
    "abs_amount", "credit_limit", "yearly_income", "total_debt", "per_capita_income", "debt_to_income",
    "tx_amount_1h", "tx_amount_24h", "avg_amount_24h", "std_amount_24h", "tx_amount_7d",
)


def _records(kind: str) -> str:
    from ledgerlens.contract import FEATURE_COLUMNS

    return ", ".join(f"CAST({n} AS {'DOUBLE' if n in RECORDS_DOUBLE else kind}) AS {n}" for n in FEATURE_COLUMNS)


ORACLES: dict[str, str] = {
    # --- sources and sinks ---
    "csv_scan_tx": f"WITH {RAW_TX} {SCANNED_TX}",
    "csv_scan_cards": f"""WITH {CARDS} SELECT id, id AS client_id, card_brand, card_type,
        lpad(CAST(id AS VARCHAR), 16, '4') AS card_number, '12/2030' AS expires, '123' AS cvv, has_chip,
        num_cards_issued, '$' || format('{{:,.2f}}', credit_limit) AS credit_limit, '01/2010' AS acct_open_date,
        year_pin_last_changed, card_on_dark_web FROM cards""",
    "csv_scan_users": f"""WITH {USERS} SELECT id, current_age, 65 AS retirement_age,
        CAST(id % 60 + 1940 AS INTEGER) AS birth_year, CAST(id % 12 + 1 AS INTEGER) AS birth_month, gender,
        c_name AS address, latitude, longitude,
        '$' || format('{{:,.2f}}', per_capita_income) AS per_capita_income,
        '$' || format('{{:,.2f}}', yearly_income) AS yearly_income,
        '$' || format('{{:,.2f}}', total_debt) AS total_debt, credit_score, num_credit_cards
        FROM users JOIN customer ON id = c_custkey""",
    "ingest_metadata": f"""WITH {RAW_TX} SELECT use_chip, count(*) AS total, count(*) AS stamped, count(*) AS traced
        FROM raw_tx GROUP BY use_chip""",
    "json_dict_labels": "SELECT doc_id AS transaction_id, CASE WHEN toxic = 1 THEN 'Yes' ELSE 'No' END AS label FROM labels",
    "json_dict_quoted": """SELECT p_partkey AS part, p_name || ', "' || p_brand || '" ' || chr(92) || p_type AS name FROM part""",
    "json_dict_codes": "SELECT CAST(p_partkey AS INTEGER) AS mcc_code, p_name AS mcc_name FROM part",
    "table_roundtrip": f"WITH {CARDS} SELECT * FROM cards",
    "feature_records_scan": f"WITH {GOLD} SELECT {_records('BIGINT')} FROM gold",
    "table_tags": f"""WITH {FEATURES} SELECT t.key, t.value, (SELECT count(*) FROM labelled) AS rows
        FROM (VALUES ('domain', 'card-risk'), ('layer', 'gold'), ('use', 'ml-training'), ('quality', 'gold')) t(key, value)""",
    # --- cleaning ---
    "parse_currency": "SELECT c_custkey, c_acctbal AS amount FROM customer",
    "parse_timestamp": "SELECT event_id AS id, date_trunc('second', ts) AS ts FROM events",
    "blank_to_null": f"WITH {RAW_TX} SELECT id, CASE WHEN errors <> '' THEN errors END AS errors FROM raw_tx",
    "label_encode": "SELECT doc_id AS transaction_id, CASE WHEN toxic = 1 THEN 1 ELSE 0 END AS is_fraud FROM labels",
    "numeric_coerce": f"""WITH {RAW_TX} SELECT id, try_cast(zip AS DOUBLE) AS zip,
        try_cast(use_chip AS DOUBLE) AS use_chip FROM raw_tx""",
    "minimise_columns": f"WITH {USERS} SELECT * FROM users",
    "feature_projection": f"WITH {GOLD} SELECT {_records('DOUBLE')}, is_fraud, transaction_id FROM gold",
    "exclude_columns": f"""WITH {FEATURES} SELECT * EXCLUDE (transaction_id, ts, client_id, card_id, merchant_id,
        use_chip, amount, errors, has_chip, card_on_dark_web, mcc_name, merchant_city, merchant_state, zip,
        gender, latitude, longitude) FROM features""",
    "rename_tag": f"""WITH {RAW_TX} SELECT mcc, count(*) AS uses, max(n_name) AS mcc_name, 'mcc_codes' AS tbl
        FROM raw_tx LEFT JOIN nation ON mcc = n_nationkey GROUP BY mcc""",
    # --- filters ---
    "filter_labelled": f"WITH {SILVER} SELECT transaction_id, is_fraud FROM silver WHERE is_fraud IS NOT NULL",
    "filter_equal": f"WITH {SILVER} SELECT transaction_id, amount FROM silver WHERE is_fraud = 1",
    "filter_nonblank": f"""WITH {SILVER} SELECT transaction_id, merchant_state FROM silver
        WHERE merchant_state IS NOT NULL AND merchant_state <> ''""",
    "filter_time_range": """SELECT o_orderkey, o_orderdate FROM orders
        WHERE o_orderdate >= TIMESTAMP '1999-01-01' AND o_orderdate < TIMESTAMP '2000-01-01'""",
    "filter_trailing": f"""SELECT event_id AS transaction_id, ts AS timestamp FROM events
        WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY""",
    "filter_prefix": f"WITH {EDGES} SELECT * FROM edges WHERE target_table_full_name LIKE 'lake.%'",
    "filter_in": f"WITH {SILVER} SELECT transaction_id, is_fraud FROM silver WHERE is_fraud IN (0, 1)",
    # --- rules ---
    "rules_drop": f"""WITH {SILVER} SELECT transaction_id, mcc_name, merchant_state FROM silver
        WHERE mcc_name IS NOT NULL AND merchant_state <> ''""",
    "rules_metrics": f"""WITH {SILVER}, passes AS (
        SELECT 'known_category' AS rule, 'drop' AS action, mcc_name IS NOT NULL AS ok FROM silver
        UNION ALL SELECT 'known_state', 'drop', merchant_state <> '' FROM silver
        UNION ALL SELECT 'error_is_pin', 'warn', coalesce(errors = 'Bad PIN', false) FROM silver)
        SELECT rule, action, count(*) AS evaluated, CAST(count_if(ok) AS BIGINT) AS passed,
            CAST(count_if(NOT ok) AS BIGINT) AS failed FROM passes GROUP BY rule, action""",
    # --- joins ---
    "join_labels": "SELECT event_id AS transaction_id, toxic AS is_fraud FROM events LEFT JOIN labels ON event_id = doc_id",
    "join_cards": f"""WITH {CARDS} SELECT event_id AS transaction_id, card_brand, credit_limit
        FROM events LEFT JOIN cards ON user_id = id""",
    "join_users": f"""WITH {USERS} SELECT event_id AS transaction_id, current_age, yearly_income
        FROM events LEFT JOIN users ON user_id = id""",
    "join_codes": f"""WITH {RAW_TX} SELECT id AS transaction_id, mcc, n_name AS mcc_name
        FROM raw_tx LEFT JOIN nation ON mcc = n_nationkey""",
    "star_enrich": f"WITH {SILVER} SELECT * FROM silver",
    # --- row features ---
    "time_features": f"WITH {FEATURES} SELECT transaction_id, hour_of_day, day_of_week, month FROM features",
    "type_flags": f"WITH {FEATURES} SELECT transaction_id, is_online, is_chip, is_swipe FROM features",
    "amount_features": f"WITH {FEATURES} SELECT transaction_id, is_refund, abs_amount FROM features",
    "risk_ratio": f"""WITH {FEATURES} SELECT transaction_id, has_error, is_dark_web, has_chip_flag, debt_to_income
        FROM features""",
    # --- rolling features ---
    "roll_1h": f"WITH {GOLD} SELECT transaction_id, tx_count_1h, tx_amount_1h FROM gold",
    "roll_24h": f"""WITH {GOLD} SELECT transaction_id, tx_count_24h, tx_amount_24h, avg_amount_24h, std_amount_24h
        FROM gold""",
    "roll_24h_distinct": f"WITH {GOLD} SELECT transaction_id, unique_merchants_24h, unique_states_24h FROM gold",
    "roll_7d": f"WITH {GOLD} SELECT transaction_id, tx_count_7d, tx_amount_7d FROM gold",
    "roll_sliced": f"""WITH {GOLD} SELECT transaction_id, tx_count_1h, tx_amount_1h, tx_count_24h, tx_amount_24h,
        avg_amount_24h, std_amount_24h, unique_merchants_24h, unique_states_24h, tx_count_7d, tx_amount_7d FROM gold""",
    "roll_hot_routed": rolled_sql(
        "CASE WHEN transaction_id % 3 = 0 THEN -1 ELSE card_id END", "epoch_us(ts) // 1000000"
    ),
    "roll_dense_cards": rolled_sql("transaction_id % 20", "transaction_id * 7919 % 86400"),
    "gold_features": f"WITH {GOLD} SELECT * FROM gold",
    "gold_training": f"WITH {GOLD} SELECT * FROM gold WHERE is_fraud IS NOT NULL",
    # --- fraud reports ---
    "fraud_by_month": f"WITH {ORDERS} "
    + fraud_by(
        "strftime(ts, '%Y-%m') AS year_month",
        extra=f", {total('abs_amount')} AS total_amount {MEAN_AMOUNT}",
        source="dated WHERE is_fraud IS NOT NULL",
    ),
    "fraud_by_type": f"WITH {FEATURES} " + fraud_by("use_chip", extra=MEAN_AMOUNT),
    "top_mcc_fraud": f"WITH {FEATURES} "
    + fraud_by("mcc", "mcc_name", extra=MEAN_FRAUD, source="labelled WHERE is_fraud = 1")
    + " ORDER BY fraud_count DESC, mcc, mcc_name LIMIT 20",
    "mcc_fraud_rate": f"WITH {FEATURES} "
    + fraud_by("mcc", "mcc_name", extra=MEAN_FRAUD)
    + " ORDER BY fraud_count DESC, mcc, mcc_name LIMIT 20",
    "fraud_by_hour": f"WITH {FEATURES} " + fraud_by("hour_of_day"),
    "fraud_by_state": f"WITH {FEATURES} "
    + fraud_by("merchant_state", source="labelled WHERE merchant_state IS NOT NULL AND merchant_state <> ''")
    + " ORDER BY fraud_count DESC, merchant_state LIMIT 15",
    "amount_distribution": f"""WITH {FEATURES} SELECT is_fraud, count(*) AS count,
        {rounded("min(abs_amount)", 2)} AS min_amount, {mean("abs_amount")} AS avg_amount,
        {percentile("abs_amount", 50, 2)} AS median_amount, {percentile("abs_amount", 95, 2)} AS p95_amount,
        {rounded("max(abs_amount)", 2)} AS max_amount FROM labelled GROUP BY is_fraud""",
    "error_vs_fraud": f"WITH {FEATURES}, named AS (SELECT *, coalesce(errors, 'No Error') AS error_type FROM labelled) "
    + fraud_by("error_type", source="named"),
    "high_risk_customers": f"WITH {FEATURES} "
    + fraud_by(
        "client_id",
        extra=f", {total('CASE WHEN is_fraud = 1 THEN abs_amount ELSE 0 END')} AS total_fraud_amount",
        digits=2,
        having="HAVING sum(is_fraud) > 0",
    )
    + " ORDER BY fraud_count DESC, client_id LIMIT 20",
    "fraud_by_brand": f"WITH {FEATURES} " + fraud_by("card_brand", "card_type"),
    "refund_vs_fraud": f"WITH {FEATURES} " + fraud_by("is_refund"),
    # --- model reports ---
    "model_comparison": f"""WITH {LOGS} SELECT model_name, model_version, count(*) AS total_requests,
        {mean("score", 4, 9)} AS avg_fraud_score, CAST(count_if(score > 0.5) AS BIGINT) AS fraud_flagged,
        {rate("count_if(score > 0.5)", "count(*)")} AS fraud_flag_rate_pct,
        {mean("execution_duration_ms", 1)} AS avg_latency_ms,
        {percentile("execution_duration_ms", 95, 1)} AS p95_latency_ms
        FROM recent GROUP BY model_name, model_version""",
    "score_distribution": f"""WITH {LOGS} SELECT model_version,
        CASE WHEN score IS NULL THEN 'unscored' WHEN score < 0.1 THEN '0.0–0.1' WHEN score < 0.3 THEN '0.1–0.3'
            WHEN score < 0.5 THEN '0.3–0.5' WHEN score < 0.7 THEN '0.5–0.7' WHEN score < 0.9 THEN '0.7–0.9'
            ELSE '0.9–1.0' END AS score_bucket, count(*) AS count
        FROM recent GROUP BY ALL""",
    "request_log_scan": f"""WITH {LOGS} SELECT endpoint_name, model_version, count(*) AS requests,
        min(execution_duration_ms) AS fastest_ms FROM logs GROUP BY ALL""",
    "ab_evaluation": f"""WITH {LOGS}, month_logs AS (SELECT * FROM logs WHERE endpoint_name = '{ENDPOINT}'
            AND timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 31 DAY),
        traffic AS (SELECT model_version, count(*) AS total_requests,
            CAST(count_if(score > 0.1) AS BIGINT) AS fraud_flagged, {mean("score", 4, 9)} AS avg_fraud_score
            FROM month_logs GROUP BY model_version),
        known AS (SELECT m.*, toxic AS is_fraud FROM month_logs m JOIN labels ON transaction_id = doc_id),
        cells AS (SELECT model_version, CAST(count_if(is_fraud = 1 AND score >= 0.1) AS DOUBLE) AS tp,
            count_if(is_fraud = 0 AND score >= 0.1) AS fp, count_if(is_fraud = 1 AND score < 0.1) AS fn
            FROM known GROUP BY model_version), {_ranking("known", "model_version")}
        SELECT model_version, total_requests, fraud_flagged, avg_fraud_score,
            {rounded("tp / nullif(tp + fp, 0)", 6)} AS precision, {rounded("tp / nullif(tp + fn, 0)", 6)} AS recall,
            {rounded("2 * tp / nullif(2 * tp + fp + fn, 0)", 6)} AS f1, CAST(tp + fn AS BIGINT) AS support,
            positives, negatives, {rounded("roc_auc", 6)} AS roc_auc, {rounded("pr_auc", 6)} AS pr_auc
        FROM traffic LEFT JOIN cells USING (model_version) LEFT JOIN ranking ON grp = model_version""",
    # --- governance ---
    "lakehouse_build": f"WITH {GOLD.replace(RAW_TX, RAW_TX_SCANNED)} SELECT * FROM gold",
    "table_counts": """SELECT 'bronze_transactions' AS tbl, count(*) AS rows FROM events
        UNION ALL SELECT 'bronze_cards', count(*) FROM customer
        UNION ALL SELECT 'bronze_users', count(*) FROM customer
        UNION ALL SELECT 'bronze_labels', count(*) FROM labels
        UNION ALL SELECT 'bronze_codes', count(*) FROM nation
        UNION ALL SELECT 'silver_transactions', count(*) FROM events
        UNION ALL SELECT 'gold_fraud_features', count(*) FROM events
        UNION ALL SELECT 'gold_fraud_training', count(*) FROM events JOIN labels ON event_id = doc_id""",
    "lineage_latest": f"""WITH {EDGES} SELECT * FROM edges WHERE target_table_full_name LIKE 'lake.%'
        ORDER BY created_at DESC, target_table_full_name, source_table_full_name LIMIT 20""",
    "lineage_captured": """SELECT 'file ' || name AS source_table_full_name, 'bronze.' || name AS target_table_full_name
            FROM (SELECT unnest(['transactions', 'cards', 'users', 'labels', 'codes']) AS name)
        UNION ALL SELECT 'bronze.' || name, 'silver.transactions'
            FROM (SELECT unnest(['transactions', 'cards', 'users', 'labels', 'codes']) AS name)
        UNION ALL SELECT 'silver.transactions', 'gold.fraud_features'
        UNION ALL SELECT 'gold.fraud_features', 'gold.fraud_training'""",
    "role_views": """WITH training AS (SELECT count(*) AS n FROM events JOIN labels ON event_id = doc_id)
        SELECT 'data-engineers' AS role, 'bronze.cards' AS tbl, count(*) AS rows, 3 AS columns FROM customer
        UNION ALL SELECT 'data-engineers', 'bronze.transactions', count(*), 12 FROM events
        UNION ALL SELECT 'ml-team', 'ml.scores', n, 1 FROM training
        UNION ALL SELECT 'model-serving', 'ml.scores', n, 1 FROM training
        UNION ALL SELECT 'data-engineers', 'silver.transactions', count(*), 30 FROM events
        UNION ALL SELECT 'ml-team', 'gold.fraud_training', n, 42 FROM training
        UNION ALL SELECT 'analysts', 'gold.fraud_training', n, 42 FROM training""",
    "role_rights": """WITH r AS (SELECT unnest([
            {'role': 'data-engineers', 'read': ['bronze', 'silver'], 'write': ['bronze', 'silver']},
            {'role': 'ml-team', 'read': ['gold', 'ml'], 'write': ['ml']},
            {'role': 'analysts', 'read': ['gold'], 'write': []::VARCHAR[]},
            {'role': 'model-serving', 'read': ['ml'], 'write': []::VARCHAR[]}]) AS x),
        l AS (SELECT unnest(['bronze', 'silver', 'gold', 'ml']) AS layer)
        SELECT x.role AS role, layer, list_contains(x.read, layer) AS reads, list_contains(x.write, layer) AS writes,
            (SELECT count(*) FROM nation) AS rows FROM r CROSS JOIN l""",
    "class_balance": f"""WITH {FEATURES}, c AS (SELECT count(*) AS total, CAST(count_if(is_fraud = 1) AS BIGINT) AS fraud,
        CAST(count_if(is_fraud = 0) AS BIGINT) AS normal FROM labelled)
        SELECT total, fraud, normal, {rounded("fraud / total * 100", 6)} AS fraud_pct,
            {rounded("normal / total * 100", 6)} AS normal_pct,
            {rounded("normal / nullif(fraud, 0)", 6)} AS neg_per_pos FROM c""",
    # --- models ---
    "time_split": f"""WITH {ORDERS} SELECT o_orderkey, CASE WHEN ts < TIMESTAMP '1999-01-01' THEN 'train'
        WHEN ts < TIMESTAMP '2000-01-01' THEN 'val' ELSE 'test' END AS split FROM dated""",
    "class_weight": f"""WITH {FEATURES}, c AS (SELECT CAST(count_if(is_fraud = 1) AS BIGINT) AS pos,
        CAST(count_if(is_fraud = 0) AS BIGINT) AS neg FROM labelled WHERE ts < TIMESTAMP '{VALIDATION_START}')
        SELECT 0 AS label, neg AS rows, CAST(1.0 AS DOUBLE) AS weight, 'ratio' AS scheme FROM c
        UNION ALL SELECT 1, pos, {rounded("neg / nullif(pos, 0)", 6)}, 'ratio' FROM c
        UNION ALL SELECT 0, neg, {rounded("(neg + pos) / nullif(2 * neg, 0)", 6)}, 'balanced' FROM c
        UNION ALL SELECT 1, pos, {rounded("(neg + pos) / nullif(2 * pos, 0)", 6)}, 'balanced' FROM c""",
    "classification_report": f"""WITH {_class_rows(0.1)} SELECT class, {rounded("precision", 6)} AS precision,
        {rounded("recall", 6)} AS recall, {rounded("f1", 6)} AS f1, CAST(support AS BIGINT) AS support FROM report""",
    "roc_auc": f"""WITH {SCORED}, {_ranking("scored", "0")} SELECT positives, negatives,
        {rounded("roc_auc", 8)} AS roc_auc FROM ranking""",
    "pr_auc": f"""WITH {SCORED}, {_ranking("scored", "0")} SELECT positives, {rounded("pr_auc", 8)} AS pr_auc
        FROM ranking""",
    "traffic_split": f"WITH {TRAFFIC} SELECT event_id, model FROM arms",
    "train_decisive": f"WITH {FEATURES} SELECT transaction_id, is_refund AS flagged FROM features",
    "evaluate_splits": f"""WITH {FEATURES}, held AS (SELECT is_refund = 1 AS fraud,
            CASE WHEN ts < TIMESTAMP '{VALIDATION_START}' THEN 'train' WHEN ts < TIMESTAMP '{TEST_START}' THEN 'val'
                ELSE 'test' END AS split FROM features)
        SELECT split, CAST(1.0 AS DOUBLE) AS precision, CAST(1.0 AS DOUBLE) AS recall, CAST(1.0 AS DOUBLE) AS f1,
            CAST(count_if(fraud) AS BIGINT) AS support, CAST(1.0 AS DOUBLE) AS roc_auc, CAST(1.0 AS DOUBLE) AS pr_auc
        FROM held WHERE split <> 'train' GROUP BY split""",
    # --- streams ---
    "incremental_features": f"WITH {GOLD.replace(RAW_TX, RAW_TX_SCANNED)} SELECT * FROM gold",
    "late_months_only": f"WITH {ORDERS}, changed AS (SELECT * REPLACE ("
    "CASE WHEN year(ts) = 1997 THEN abs_amount / 2 ELSE abs_amount END AS abs_amount) FROM dated) "
    + fraud_by(
        "strftime(ts, '%Y-%m') AS year_month",
        extra=f", {total('abs_amount')} AS total_amount {MEAN_AMOUNT}",
        source="changed WHERE is_fraud IS NOT NULL AND year(ts) BETWEEN 1996 AND 1998",
    ),
    "stream_ingest": f"WITH {RAW_TX} {SCANNED_TX}",
    "stream_rules": f"""WITH {RAW_TX}, n AS (SELECT count(*) AS total,
            CAST(count_if(merchant_state <> '') AS BIGINT) AS known,
            CAST(count_if(amount NOT LIKE '$-%') AS BIGINT) AS paid FROM raw_tx)
        SELECT 'in_store' AS part, total AS evaluated, known AS passed, total - known AS failed FROM n
        UNION ALL SELECT 'no_refund', total, paid, total - paid FROM n
        UNION ALL SELECT 'kept', known, known, CAST(0 AS BIGINT) FROM n""",
    "stream_score": f"""WITH {TRAFFIC} SELECT model AS model_name,
        CASE model WHEN 'champion' THEN 'v1' ELSE 'v2' END AS model_version, '{ENDPOINT}' AS endpoint_name,
        count(*) AS requests, count(*) AS scored, count(*) AS timed FROM arms GROUP BY model""",
}

# Rules judged once and stored with the rows give what rules give at once.
ORACLES |= {f"rules_stored_{name}": ORACLES[f"rules_{name}"] for name in ("metrics", "drop")}

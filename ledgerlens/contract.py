"""Fixed names and values that define the data contract."""

from __future__ import annotations

# --- Fixed values: raw file schemas -------------------------------------------------

TRANSACTIONS_SCHEMA = """
    id BIGINT, date STRING, client_id BIGINT, card_id BIGINT, amount STRING,
    use_chip STRING, merchant_id BIGINT, merchant_city STRING, merchant_state STRING,
    zip STRING, mcc INT, errors STRING
"""

CARDS_SCHEMA = """
    id BIGINT, client_id BIGINT, card_brand STRING, card_type STRING, card_number STRING,
    expires STRING, cvv STRING, has_chip STRING, num_cards_issued INT, credit_limit STRING,
    acct_open_date STRING, year_pin_last_changed INT, card_on_dark_web STRING
"""

USERS_SCHEMA = """
    id BIGINT, current_age INT, retirement_age INT, birth_year INT, birth_month INT,
    gender STRING, address STRING, latitude DOUBLE, longitude DOUBLE,
    per_capita_income STRING, yearly_income STRING, total_debt STRING,
    credit_score INT, num_credit_cards INT
"""

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

# --- Fixed values: columns a cleaned dimension may expose ---------------------------

CARD_COLUMNS = [
    "card_brand", "card_type", "has_chip", "credit_limit",
    "num_cards_issued", "year_pin_last_changed", "card_on_dark_web",
]

USER_COLUMNS = [
    "current_age", "gender", "latitude", "longitude",
    "yearly_income", "total_debt", "per_capita_income",
    "credit_score", "num_credit_cards",
]

SILVER_COLUMNS = [
    "transaction_id", "ts", "client_id", "card_id", "amount", "use_chip",
    "merchant_id", "merchant_city", "merchant_state", "zip", "mcc", "mcc_name", "errors",
    *CARD_COLUMNS, *USER_COLUMNS, "is_fraud",
]

# --- Fixed values: model inputs, in training and serving order ----------------------

FEATURE_COLUMNS = [
    "abs_amount", "is_refund", "is_online", "is_chip", "is_swipe",
    "mcc", "has_error", "hour_of_day", "day_of_week", "month",
    "has_chip_flag", "credit_limit", "num_cards_issued", "year_pin_last_changed", "is_dark_web",
    "current_age", "yearly_income", "total_debt", "per_capita_income",
    "credit_score", "num_credit_cards", "debt_to_income",
    "tx_count_1h", "tx_amount_1h",
    "tx_count_24h", "tx_amount_24h", "avg_amount_24h", "std_amount_24h",
    "unique_merchants_24h", "unique_states_24h",
    "tx_count_7d", "tx_amount_7d",
]

LABEL_COLUMN = "is_fraud"

# Identifiers, raw text already encoded as flags, and columns no model may use.
NON_MODEL_COLUMNS = [
    "transaction_id", "ts", "client_id", "card_id", "merchant_id",
    "use_chip", "amount", "errors", "has_chip", "card_on_dark_web",
    "mcc_name", "merchant_city", "merchant_state", "zip",
    "gender", "latitude", "longitude",
]

# --- Fixed values: shape of records to score and of the inference log ---------------

FRACTIONAL_FEATURES = [
    "abs_amount", "credit_limit", "yearly_income", "total_debt", "per_capita_income",
    "debt_to_income", "tx_amount_1h", "tx_amount_24h", "avg_amount_24h", "std_amount_24h",
    "tx_amount_7d",
]

FEATURE_RECORD_SCHEMA = ", ".join(
    f"{name} {'DOUBLE' if name in FRACTIONAL_FEATURES else 'BIGINT'}" for name in FEATURE_COLUMNS
)

REQUEST_LOG_SCHEMA = """
    model_name STRING, model_version STRING, endpoint_name STRING, timestamp TIMESTAMP,
    response STRING, execution_duration_ms DOUBLE
"""

LINEAGE_SCHEMA = """
    source_table_full_name STRING, target_table_full_name STRING, created_at TIMESTAMP
"""

QUALITY_SCHEMA = """
    table_full_name STRING, rule STRING, action STRING,
    evaluated BIGINT, passed BIGINT, failed BIGINT, created_at TIMESTAMP
"""

# --- Fixed values: score histogram ---------------------------------------------------

SCORE_EDGES = [0.1, 0.3, 0.5, 0.7, 0.9]
SCORE_LABELS = ["0.0–0.1", "0.1–0.3", "0.3–0.5", "0.5–0.7", "0.7–0.9", "0.9–1.0"]
UNSCORED = "unscored"

# --- Fixed values: layers, tags and who may read what --------------------------------

LAYERS = ["bronze", "silver", "gold", "ml"]

TABLE_TAGS = {
    "fraud_features": {"domain": "card-risk", "layer": "gold", "use": "analytics"},
    "fraud_training": {"domain": "card-risk", "layer": "gold", "use": "ml-training"},
}

ROLE_LAYERS = {
    "data-engineers": ["bronze", "silver"],
    "ml-team": ["gold", "ml"],
    "analysts": ["gold"],
    "model-serving": ["ml"],
}

ROLE_WRITES = {
    "data-engineers": ["bronze", "silver"],
    "ml-team": ["ml"],
    "analysts": [],
    "model-serving": [],
}

# --- Fixed values: time-based split ---------------------------------------------------

VALIDATION_START = "2018-01-01"
TEST_START = "2019-01-01"

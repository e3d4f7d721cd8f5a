import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerlens.functions import cleaning, measures, scores

col = F.col


@pytest.mark.parametrize(
    "text, value",
    [
        ("$42.98", 42.98),
        ("$-77.00", -77.0),
        ("$127,613", 127613.0),
        ("$1,234,567.89", 1234567.89),
        ("abc", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_currency(one, text, value):
    assert one(lambda c: cleaning.parse_currency(col(c)), text) == value


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-10**11, 10**11), min_size=1, max_size=200))
def test_currency_round_trip(spark, cents):
    amounts = [c / 100 for c in cents]
    rows = spark.createDataFrame([(a, f"${a:,.2f}") for a in amounts], "amount double, text string")
    wrong = rows.filter(cleaning.parse_currency(col("text")) != col("amount"))
    assert wrong.count() == 0


@pytest.mark.parametrize(
    "text, value",
    [
        ("2010-01-01 00:01:00", dt.datetime(2010, 1, 1, 0, 1)),
        ("2010-13-01 00:00:00", None),
        ("yesterday", None),
        (None, None),
    ],
)
def test_parse_timestamp(one, text, value):
    assert one(lambda c: cleaning.parse_timestamp(col(c)).cast("timestamp_ntz"), text) == value


@pytest.mark.parametrize("text, value", [("  ", None), ("", None), (None, None), (" Bad PIN ", " Bad PIN ")])
def test_blank_to_null(one, text, value):
    assert one(lambda c: cleaning.blank_to_null(col(c)), text) == value


@pytest.mark.parametrize("text, loose, strict", [("Yes", 1, 1), ("No", 0, 0), ("maybe", 0, 0), (None, 0, None)])
def test_encode_label(one, text, loose, strict):
    assert one(lambda c: cleaning.encode_label(col(c)), text) == loose
    assert one(lambda c: cleaning.encode_label(col(c), strict=True), text) == strict


def test_flags_keep_unknown(one):
    flagged = lambda c: cleaning.flag(col(c) == "Chip Transaction")
    assert [one(flagged, v) for v in ("Chip Transaction", "Online Transaction", None)] == [1, 0, None]


def test_guarded_ratio(spark):
    rows = spark.createDataFrame([(10.0, 4.0), (10.0, 0.0), (10.0, -1.0), (10.0, None), (None, 4.0)], "d double, i double")
    got = [r[0] for r in rows.select(cleaning.guarded_ratio(col("d"), col("i"))).collect()]
    assert got == [2.5, None, None, None, None]


def test_epoch_seconds_rounds_down(spark):
    rows = spark.sql("SELECT TIMESTAMP_NTZ '1969-12-31 23:59:58.5' AS a, TIMESTAMP '2024-01-01 00:00:00.9 UTC' AS b")
    assert tuple(rows.select(cleaning.epoch_seconds(col("a")), cleaning.epoch_seconds(col("b"))).first()) == (-2, 1704067200)


@pytest.mark.parametrize(
    "top, over, digits, rounded",
    [(10115, 1000, 2, 10.12), (-10115, 1000, 2, -10.12), (10114, 1000, 2, 10.11), (5, 2, 0, 3.0), (-5, 2, 0, -3.0),
     (0, 7, 2, 0.0), (1, 0, 2, None), (None, 3, 2, None), (2, 3, 4, 0.6667), (2**62, 3, 0, 1537228672809129301.0)],
)
def test_quotients_are_rounded_half_up(spark, top, over, digits, rounded):
    row = spark.createDataFrame([(top, over)], "a long, b long")
    assert row.select(measures.half_up(col("a"), col("b"), digits)).first()[0] == rounded


def test_sums_and_means_do_not_depend_on_order(spark):
    """Ties at the last digit, and doubles that add up differently in another order."""
    values = [0.1, 0.2, 0.3, 1e15 / 1024, 10.115, -10.115, 0.005, 0.045] * 50 + [None] * 5
    seen = set()
    for parts in (1, 3, 8):
        df = spark.createDataFrame([(i % 2, v) for i, v in enumerate(values)], "g int, x double").repartition(parts)
        rows = df.groupBy("g").agg(measures.rounded_total(col("x")), measures.rounded_mean(col("x"))).collect()
        seen.add(tuple(sorted(map(tuple, rows))))
    assert len(seen) == 1
    half = spark.createDataFrame([(10.11,), (10.12,)], "x double").agg(measures.rounded_mean(col("x"))).first()[0]
    assert half == 10.12


def test_totals_pass_64_bits(spark):
    wide = spark.range(6).select(F.lit(2**62).alias("u")).agg(measures.exact_total(col("u")).alias("t")).first().t
    assert int(wide) == 6 * 2**62
    low = spark.range(6).select(F.lit(-(2**62) - 1).alias("u")).agg(measures.exact_total(col("u")).alias("t")).first().t
    assert int(low) == -6 * (2**62 + 1)


def test_rate_of_nothing_is_null(spark):
    row = spark.range(0).agg(measures.rate_pct(F.sum("id"), measures.row_count()).alias("rate")).first()
    assert row.rate is None


@pytest.mark.parametrize(
    "response, score",
    [
        ('{"predictions":[0.7]}', 0.7),
        ('{"predictions":[{"fraud_probability":0.3}]}', 0.3),
        ('{"predictions":[]}', None),
        ('{"predictions":["high"]}', None),
        ("not json", None),
        (None, None),
    ],
)
def test_score_from_response(one, response, score):
    assert one(lambda c: scores.score_from_response(col(c)), response) == score


@pytest.mark.parametrize(
    "score, label",
    [
        (0.0, "0.0–0.1"), (0.1, "0.1–0.3"), (0.3, "0.3–0.5"), (0.5, "0.5–0.7"), (0.7, "0.7–0.9"),
        (0.9, "0.9–1.0"), (1.0, "0.9–1.0"), (0.0999, "0.0–0.1"), (None, "unscored"),
    ],
)
def test_bucketize(one, score, label):
    assert one(lambda c: scores.bucketize(col(c)), score, "double") == label


def test_bucketize_needs_matching_labels(spark):
    with pytest.raises(ValueError):
        scores.bucketize(col("v"), [0.5], ["only"])


def test_threshold_edges(one):
    assert one(lambda c: scores.over_threshold(col(c)), 0.5, "double") is False
    assert one(lambda c: scores.over_threshold(col(c), inclusive=True), 0.5, "double") is True


def test_traffic_arm(spark):
    ids = spark.range(10_000)
    arms = {r.arm: r.n for r in ids.groupBy(scores.traffic_arm(col("id")).alias("arm")).agg(F.count("*").alias("n")).collect()}
    assert sum(arms.values()) == 10_000 and 8_800 < arms["champion"] < 9_200
    again = ids.repartition(7).filter(scores.traffic_arm(col("id")) == "champion").count()
    assert again == arms["champion"]
    assert ids.filter(scores.traffic_arm(col("id"), challenger=None) != "champion").count() == 0


def test_currency_takes_plain_numbers_only(one):
    from ledgerlens.functions.cleaning import parse_currency

    for text in ("$NaN", "$Infinity", "5d", "1f", "-", ".", "1.2.3"):
        assert one(parse_currency, text) is None
    assert one(parse_currency, "$-1,234.50") == -1234.5 and one(parse_currency, "1e3") == 1000.0

"""Both rolling plans against a direct computation, with edges, gaps and hot keys."""

import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import plan_of
from ledgerlens.operators.rolling import (
    CARD_FEATURES,
    DAY,
    HOUR,
    Rolling,
    crowded_keys,
    rolling_features,
    rolling_sliced,
    rolling_windows,
)

SCHEMA = "transaction_id long, card_id long, sec long, abs_amount double, merchant_id long, merchant_state string"


def make(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.timestamp_seconds("sec"))


def direct(rows, spec):
    """Feature of every row, straight from the definition."""
    at = SCHEMA.replace(" long", "").replace(" double", "").replace(" string", "").split(", ").index(spec.column)
    out = []
    for row in rows:
        card, sec = row[1], row[2]
        frame = [
            other[at]
            for other in rows
            if other[1] == card
            and other[at] is not None
            and (other[2] is None if sec is None else other[2] is not None and sec - spec.seconds <= other[2] <= sec)
        ]
        out.append(
            {
                "count": lambda: len(frame),
                "distinct": lambda: len(set(frame)),
                "sum": lambda: sum(frame) if frame else None,
                "avg": lambda: sum(frame) / len(frame) if frame else None,
                "std": lambda: statistics.stdev(frame) if len(frame) > 1 else None,
            }[spec.agg]()
        )
    return out


def check(df, rows, specs=CARD_FEATURES):
    got = {r.transaction_id: r for r in df.collect()}
    assert len(got) == len(rows)
    for spec in specs:
        for row, want in zip(rows, direct(rows, spec)):
            have = got[row[0]][spec.name]
            if isinstance(want, float):
                assert have == pytest.approx(want, rel=1e-9, abs=1e-5), (spec.name, row)
            else:
                assert have == want, (spec.name, row)


def history(n=250, seed=7):
    chance = random.Random(seed)
    moments = [
        lambda: chance.randint(-400_000, 2_000_000),
        lambda: chance.randint(0, 9_000),
        lambda: HOUR * chance.randint(0, 60),
        lambda: DAY * chance.randint(-3, 20) + chance.randint(-1, 1),
        lambda: None,
    ]
    return [
        (
            i,
            chance.choice([1, 1, 1, 2, None]),
            chance.choice(moments)(),
            chance.choice([None, 5.0, 5.0, chance.randint(1, 90_000) / 100]),
            chance.choice([None, 1, 2, 3, chance.randint(4, 40)]),
            chance.choice([None, "CA", "NY", "TX"]),
        )
        for i in range(n)
    ]


PLANS = {
    "windows": rolling_windows,
    "sliced": rolling_sliced,
    "mixed": lambda *args: rolling_features(*args, frame_rows=60),
    "all crowded": lambda *args: rolling_features(*args, frame_rows=0),
    "none crowded": rolling_features,
}


@pytest.mark.parametrize("plan", PLANS)
def test_every_plan_matches_the_definition(spark, plan):
    rows = history()
    check(PLANS[plan](make(spark, rows), "card_id", "ts", CARD_FEATURES), rows)


@pytest.mark.parametrize("plan", [rolling_windows, rolling_sliced])
def test_frame_edges(spark, plan):
    t = 1_000_000
    rows = [
        (1, 1, t - 3601, 1.0, 1, "A"),  # just outside the hour
        (2, 1, t - 3600, 2.0, 1, None),  # exactly an hour earlier counts
        (3, 1, t, 4.0, 2, "B"),
        (4, 1, t, 8.0, 2, "B"),  # same second: each sees the other
        (5, 2, t, 16.0, 3, None),  # another card, first event
    ]
    specs = CARD_FEATURES
    got = {r.transaction_id: r for r in plan(make(spark, rows), "card_id", "ts", specs).collect()}
    assert [got[i].tx_count_1h for i in (1, 2, 3, 4, 5)] == [1, 2, 3, 3, 1]
    assert got[3].tx_amount_1h == 14.0 and got[4].tx_amount_24h == 15.0
    assert got[3].unique_merchants_24h == 2 and got[3].unique_states_24h == 2
    assert got[5].std_amount_24h is None and got[5].unique_states_24h == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.integers(1, 2), st.integers(0, 40), st.integers(0, 3)), min_size=1, max_size=60
    ),
    st.integers(1, 12),
)
def test_sliced_plan_on_dense_small_frames(spark, events, seconds):
    rows = [(i, card, sec, float(m), m or None, None) for i, (card, sec, m) in enumerate(events)]
    specs = [
        Rolling("n", "count", "transaction_id", seconds),
        Rolling("s", "sum", "abs_amount", seconds),
        Rolling("d", "distinct", "merchant_id", seconds),
        Rolling("d2", "distinct", "merchant_id", 2 * seconds + 1),
    ]
    check(rolling_sliced(make(spark, rows), "card_id", "ts", specs), rows, specs)


def test_longer_frames_never_count_less(spark):
    df = rolling_features(make(spark, history(120, 3)), "card_id", "ts", CARD_FEATURES)
    bad = df.filter("tx_count_1h < 1 OR tx_count_1h > tx_count_24h OR tx_count_24h > tx_count_7d")
    assert bad.count() == 0


def test_windows_share_one_shuffle_and_sort(spark):
    plan = plan_of(rolling_windows(make(spark, history(10)), "card_id", "ts", CARD_FEATURES))
    initial = plan.split("Initial Plan")[-1]
    assert initial.count("Exchange") == initial.count("Sort") == initial.count("Window [") == 1
    assert "Python" not in plan


def test_crowded_keys_are_those_of_full_frames(spark):
    """Key 0 has ten rows in two slices, key 1 ten rows far apart, NULL ten rows without a time."""
    rows = [(0, 95 + i) for i in range(10)] + [(1, 1000 * i) for i in range(10)] + [(None, None)] * 10
    df = spark.createDataFrame(rows, "k long, sec long").withColumn("ts", F.timestamp_seconds("sec"))
    assert {r.k for r in crowded_keys(df, "k", "ts", 100, 9).collect()} == {0, None}
    assert crowded_keys(df, "k", "ts", 100, 10).count() == 0


def test_plans_agree_on_nan_infinity_zero_signs_and_nulls(spark):
    odd = [None, 0.0, -0.0, 1.5, 1.5, float("nan"), 7.25, float("inf"), 2.0, 3.0]
    rows = [(i, i % 2, (i * 7919) % 5_000, odd[(i * i + i // 3) % 10], i % 4, None) for i in range(120)]
    specs = [Rolling(agg, agg, "abs_amount", 600) for agg in ("count", "sum", "avg", "std", "distinct")]
    df = make(spark, rows)
    both = []
    for plan in (rolling_windows, rolling_sliced):
        got = plan(df, "card_id", "ts", specs).select("transaction_id", *[s.name for s in specs]).collect()
        both.append({r.transaction_id: [None if x is None else x if x == x else "nan" for x in r[1:]] for r in got})
    assert set(both[0]) == set(both[1]) == set(range(120))
    for number, want in both[0].items():
        for have, expected in zip(both[1][number], want):
            if isinstance(expected, float):
                assert have == pytest.approx(expected, rel=1e-9, abs=1e-6), number
            else:
                assert have == expected, number
    assert {"nan"} & {x for row in both[0].values() for x in row} and any(row[3] not in (None, "nan") for row in both[0].values())


def test_money_is_bit_equal_in_both_plans(spark):
    """Amounts whose doubles add up differently in another order."""
    df = make(spark, [(i, i % 3, (i * 7919) % 300_000, (i * 37 % 1000) / 100 + 0.1, i % 5, None) for i in range(400)])
    names = [s.name for s in CARD_FEATURES]
    got = [
        {tuple(r) for r in plan(df.repartition(n), "card_id", "ts", CARD_FEATURES).select("transaction_id", *names).collect()}
        for plan, n in ((rolling_windows, 1), (rolling_windows, 7), (rolling_sliced, 3), (rolling_sliced, 5))
    ]
    assert len(got[0]) == 400 and got[0] == got[1] == got[2] == got[3]


def test_sliced_plan_never_groups_by_the_key_alone(spark):
    """Rows arriving hash-partitioned by key must still be spread further."""
    df = make(spark, history(10)).repartition(4, "card_id")
    plan = plan_of(rolling_sliced(df, "card_id", "ts", CARD_FEATURES)).split("Initial Plan")[-1]
    alone = 0
    for line in plan.splitlines():
        if "hashpartitioning(" in line and "REPARTITION_BY_COL, [plan_id" not in line.split("card_id")[0]:
            keys = line.split("hashpartitioning(")[1].split(")")[0]
            if "card_id" in keys:
                continue
            assert "_who" in keys, line
            alone += keys.count("#") == 1
    assert alone == 1  # the totals of a key's days, a row each
    assert plan.count("hashpartitioning(_who") >= 5


def test_a_third_of_all_rows_on_one_card(spark):
    """A dense hot card: 20,000 rows within a day, against the plain windows."""
    rows = spark.range(60_000).select(
        F.col("id").alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 4000).alias("card_id"),
        F.timestamp_seconds((F.col("id") * 7919) % 86_400).alias("ts"),
        ((F.col("id") * 31 % 5000) / 100).alias("abs_amount"),
        (F.col("id") * 17 % 300).alias("merchant_id"),
        F.concat(F.lit("S"), F.col("id") % 50).alias("merchant_state"),
    )
    specs = [s for s in CARD_FEATURES if s.seconds == HOUR] + [
        Rolling("merchants_1h", "distinct", "merchant_id", HOUR),
        Rolling("std_1h", "std", "abs_amount", HOUR),
    ]
    a = rolling_features(rows, "card_id", "ts", specs, frame_rows=1_000)
    b = rolling_windows(rows, "card_id", "ts", specs)
    names = [s.name for s in specs]
    joined = a.select("transaction_id", *names).join(
        b.select("transaction_id", *[F.col(n).alias(f"w_{n}") for n in names]), "transaction_id"
    )
    same = F.lit(True)
    for n in names:
        near = F.abs(F.col(n) - F.col(f"w_{n}")) < 1e-6
        same = same & (near | (F.col(n).isNull() & F.col(f"w_{n}").isNull()))
    assert joined.count() == 60_000
    assert joined.filter(~same).count() == 0

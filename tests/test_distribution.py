import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerlens.operators.distribution import exact_percentiles, ranking_quality, with_exact_percentiles

POINTS = {"low": 0.0, "median": 0.5, "p95": 0.95, "high": 1.0}


def builtin(df, keys):
    return df.groupBy(*keys).agg(*[F.percentile("x", p).alias(n) for n, p in POINTS.items()])


def table(df, *names):
    return {tuple(r[n] for n in names): [r[p] for p in POINTS] for r in df.collect()}


def test_percentiles_match_the_builtin(spark):
    # Two thirds of the rows in one group, a NULL group, ties, and NULL values.
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 > 0, "big").when(F.col("id") % 9 > 0, "small").alias("g"),
        F.when(F.col("id") % 11 > 0, F.round(F.rand(5) * 40, 1)).alias("x"),
    )
    df = spark.createDataFrame(df.collect(), df.schema)
    ours, theirs = table(exact_percentiles(df, ["g"], "x", POINTS), "g"), table(builtin(df, ["g"]), "g")
    assert ours.keys() == theirs.keys() == {("big",), ("small",), (None,)}
    for key, values in ours.items():
        assert values == pytest.approx(theirs[key], rel=1e-12)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(-20, 20)), min_size=1, max_size=50))
def test_percentiles_of_small_groups(spark, rows):
    df = spark.createDataFrame([(g, float(v)) for g, v in rows], "g int, x double")
    ours, theirs = table(exact_percentiles(df, ["g"], "x", POINTS), "g"), table(builtin(df, ["g"]), "g")
    assert ours.keys() == theirs.keys()
    for key in theirs:
        assert ours[key] == pytest.approx(theirs[key])


def test_percentiles_without_groups_and_of_nothing(spark):
    df = spark.range(1, 102).select(F.col("id").cast("double").alias("x"))
    assert tuple(exact_percentiles(df, [], "x", {"p": 0.95}).first()) == (96.0,)
    assert exact_percentiles(df.filter("x < 0"), [], "x", {"p": 0.5}).count() == 0


def test_group_without_values_keeps_its_row(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 4.0), (2, None)], "g int, x double")
    got = with_exact_percentiles(df, ["g"], "x", [F.count(F.lit(1)).alias("n")], {"m": 0.5}, 2)
    assert sorted(map(tuple, got.collect())) == [(1, 2, 3.0), (2, 1, None)]
    quick = with_exact_percentiles(df, ["g"], "x", [F.count(F.lit(1)).alias("n")], {"m": 0.5}, 2, exact=False)
    assert sorted(r.n for r in quick.collect()) == [1, 2]


def direct_quality(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    auc = ap = None
    if pos and neg:
        auc = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    if pos:
        ap = 0.0
        for score in sorted({s for s, _ in rows}, reverse=True):
            above = [y for s, y in rows if s >= score]
            ap += sum(s == score for s in pos) / len(pos) * sum(above) / len(above)
    return auc, ap


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 10), st.integers(0, 1)), min_size=1, max_size=60))
def test_ranking_quality_small(spark, pairs):
    rows = [(s / 10, y) for s, y in pairs]
    got = ranking_quality(spark.createDataFrame(rows, "s double, y int"), "s", "y").first()
    auc, ap = direct_quality(rows)
    assert got.roc_auc == (None if auc is None else pytest.approx(auc))
    assert got.pr_auc == (None if ap is None else pytest.approx(ap))


def test_ranking_quality_across_buckets_and_groups(spark):
    df = spark.range(1500).select(
        (F.col("id") % 4 == 0).cast("int").alias("g"),
        (F.hash("id") % 700 / 700.0).alias("s"),
        (F.hash(F.col("id") + 5) % 5 == 0).cast("int").alias("y"),
    )
    rows = df.collect()
    got = {r.g: r for r in ranking_quality(df, "s", "y", by=["g"]).collect()}
    for g in (0, 1):
        auc, ap = direct_quality([(r.s, r.y) for r in rows if r.g == g])
        assert got[g].roc_auc == pytest.approx(auc) and got[g].pr_auc == pytest.approx(ap)


def test_tied_scores_count_half(spark):
    df = spark.createDataFrame([(0.4, 1), (0.4, 0)], "s double, y int")
    got = ranking_quality(df, "s", "y").first()
    assert got.roc_auc == 0.5 and got.pr_auc == 0.5


def largest_group(df, partitions):
    """Rows of the largest range that a running total sees."""
    from ledgerlens.operators.distribution import value_counts

    counts = value_counts(df, [], "s", partitions, n=F.count(F.lit(1)))
    return counts.groupBy("_part").count().agg(F.max("count")).first()[0]


def test_ranges_shrink_as_partitions_grow(spark):
    """A million distinct scores: no step holds more than a range of them."""
    df = spark.range(1_000_000).select((F.col("id") * 7919 % 1_000_003).alias("s"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    assert largest_group(df, 4) > 3 * largest_group(df, 40) and largest_group(df, 40) < 50_000
    got = [ranking_quality(df, "s", "y", partitions=n).first() for n in (4, 40)]
    assert got[0].roc_auc == got[1].roc_auc and got[0].pr_auc == pytest.approx(got[1].pr_auc, rel=1e-12)
    ranks = df.toPandas().sort_values("s").reset_index(drop=True)
    positives = ranks.index[ranks.y == 1]
    p, n = len(positives), len(ranks) - len(positives)
    assert got[0].roc_auc == pytest.approx((positives.to_series().add(1).sum() - p * (p + 1) / 2) / (p * n), rel=1e-12)


def test_whole_numbers_beyond_doubles_stay_exact(spark):
    from decimal import Decimal

    base = 2**53
    df = spark.createDataFrame([(base + i,) for i in (1, 3, 5, 7)], "x long")
    got = exact_percentiles(df, [], "x", {"a": 0.0, "m": 0.5, "p": 0.95, "z": 1.0}, partitions=3).first()
    assert (got.a, got.m, got.z) == (base + 1, base + 4, base + 7) and got.p == Decimal(base) + Decimal("6.7")
    money = spark.createDataFrame([("0.01",), ("0.02",), (None,)], "t string").selectExpr("cast(t as decimal(20,2)) x")
    assert exact_percentiles(money, [], "x", {"m": 0.5}).first().m == Decimal("0.015")
    with pytest.raises(ValueError):
        exact_percentiles(df, [], "x", {"m": 1 / 3})


def test_percentiles_are_the_same_for_any_number_of_ranges(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), (F.hash("id") % 997 / 8.0).alias("x"))
    seen = {tuple(sorted(map(tuple, exact_percentiles(df, ["g"], "x", POINTS, n).collect()))) for n in (1, 5, 17)}
    assert len(seen) == 1

"""Distributed training, model search and batch scoring."""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from math import inf, isqrt
from typing import NamedTuple

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Bucketizer, Imputer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.contract import FEATURE_COLUMNS, LABEL_COLUMN
from ledgerlens.functions.scores import over_threshold
from ledgerlens.operators.columns import feature_projection
from ledgerlens.operators.distribution import ranking_quality, value_counts, with_running_totals
from ledgerlens.operators.evaluation import classification_report
from ledgerlens.session import cut_lineage, shared_root

# The two training set-ups, as far as Spark's boosted trees share
# their parameters. ``scheme`` is the class weighting.
RATIO_WEIGHTED = {
    "scheme": "ratio", "maxDepth": 6, "stepSize": 0.05, "maxIter": 500,
    "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8", "minInstancesPerNode": 10, "seed": 42,
    "patience": 20,
}
BALANCED = {
    "scheme": "balanced", "maxDepth": 7, "stepSize": 0.05, "maxIter": 400, "maxBins": 511,
    "subsamplingRate": 0.8, "featureSubsetStrategy": "0.5", "minInstancesPerNode": 20, "seed": 42,
    "patience": 50,
}


#: Up to so many training rows, or the square of ``maxBins``, Spark's trees look for thresholds in all rows; beyond, in a sample.
SPLIT_ROWS = 10_000
#: Spark squares ``maxBins`` in 32 bits.
MOST_BINS = 46_340


class Trained(NamedTuple):
    """A fitted model, its parameters, and the prepared rows as the trees take them."""

    model: PipelineModel
    params: dict
    inputs: DataFrame


class Prepared(NamedTuple):
    """Training inputs, stored once for any number of fits: features, label and whether a row validates."""

    stages: list
    inputs: DataFrame
    negatives: int
    positives: int
    binned: bool = False


def prepare(
    rows: DataFrame, features: Sequence[str] = FEATURE_COLUMNS, split: str = "split", train_rows: int | None = None
) -> Prepared:
    """Counts, fills and assembles the labelled ``train`` and ``val`` rows.

    Features no training row has are left out; other gaps take the training median,
    so that validation rows inform nothing. All labelled training rows are kept unless a caller
    sets ``train_rows``: then they are thinned by the hash of their features, equal rows together,
    to about that number.
    """
    shared_root(rows.sparkSession)
    usable = rows.filter(F.col(split).isin("train", "val") & F.col(LABEL_COLUMN).isin(0, 1))
    known = feature_projection(usable, features, LABEL_COLUMN, carry=[split])
    # Stored before anything is counted: every later step would compute the rows and their joins again.
    known = cut_lineage(known.select(*features, LABEL_COLUMN, (F.col(split) != "train").alias("_validation")))
    trained_on = known.filter(~F.col("_validation"))
    counts = trained_on.agg(*[F.count(name).alias(name) for name in features]).first()
    present = [name for name in features if counts[name] > 0]
    sizes = _class_sizes(known)
    for needed, n in (("negatives", sizes[False, 0]), ("positives", sizes[False, 1]), ("validation", sizes[True, 0] + sizes[True, 1])):
        if n == 0:
            raise ValueError(f"cannot train: no {needed} rows in split column {split!r}")
    imputer = Imputer(strategy="median", inputCols=present, outputCols=[f"{n}_filled" for n in present])
    assembler = VectorAssembler(inputCols=imputer.getOutputCols(), outputCol="features")
    preparation = Pipeline(stages=[imputer, assembler]).fit(trained_on)
    stored = preparation.transform(known).select("features", LABEL_COLUMN, "_validation")
    total = sizes[False, 0] + sizes[False, 1]
    if train_rows is not None and total > train_rows:
        draw = F.pmod(F.xxhash64("features"), F.lit(1 << 32)) / float(1 << 32)
        stored = cut_lineage(stored.filter(F.col("_validation") | (draw < train_rows / total)))
        sizes = _class_sizes(stored)
    else:
        stored = cut_lineage(stored)
    return Prepared(preparation.stages, stored, sizes[False, 0], sizes[False, 1])


def _class_sizes(rows: DataFrame) -> dict[tuple[bool, int], int]:
    """Rows by (validates, label)."""
    counted = rows.groupBy("_validation", LABEL_COLUMN).agg(F.count(F.lit(1)).alias("rows")).collect()  # four rows at most
    return {(v, y): 0 for v in (False, True) for y in (0, 1)} | {(r["_validation"], r[LABEL_COLUMN]): r["rows"] for r in counted}


def weight_of(prepared: Prepared, scheme: str) -> Column:
    """The weight of a row's class from the counts of the training rows."""
    neg, pos = prepared.negatives, prepared.positives
    weights = {"ratio": (1.0, neg / pos), "balanced": ((neg + pos) / (2 * neg), (neg + pos) / (2 * pos))}[scheme]
    return F.when(F.col(LABEL_COLUMN) == 1, F.lit(weights[1])).otherwise(F.lit(weights[0]))


def thresholds(rows: DataFrame, bins: int) -> list[list[float]]:
    """Per feature where to cut it into at most ``bins`` bins, from the counts of all values of all rows.

    A feature of at most ``bins`` values gets a bin for each; another is cut at equal shares
    of the rows. Bins meet half-way between neighbouring values.
    """
    width = len(rows.select("features").first()[0])
    each = rows.select(F.posexplode(vector_to_array("features")).alias("_feature", "_v"))
    counts = value_counts(each, ["_feature"], "_v", _rows=F.count(F.lit(1)), _values=F.max(F.lit(1)))
    ranked = with_running_totals(counts, ["_feature"], ["_rows", "_values"])
    share = F.call_function("div", (F.col("_rows_upto") - F.col("_rows")) * bins, F.col("_rows_all"))
    number = F.when(F.col("_values_all") <= bins, F.col("_values_upto") - 1).otherwise(share)
    ends = ranked.groupBy("_feature", number.alias("_bin")).agg(F.min("_value").alias("low"), F.max("_value").alias("high"))
    cuts: list[list[float]] = [[] for _ in range(width)]
    last: dict[int, float] = {}
    for end in sorted(ends.collect(), key=lambda r: (r["_feature"], r["_bin"])):  # a row per bin and feature at most
        feature = end["_feature"]
        if feature in last:
            half = last[feature] / 2 + end["low"] / 2
            cuts[feature].append(min(half if last[feature] < half <= end["low"] else end["low"], sys.float_info.max))
        last[feature] = end["high"]
    return cuts


def in_bins(prepared: Prepared, bins: int) -> Prepared:
    """Features as numbers of bins where Spark would look for its thresholds in a sample; others as they are."""
    if prepared.binned or prepared.negatives + prepared.positives <= max(SPLIT_ROWS, bins * bins):
        return prepared
    filled = prepared.stages[-1].getInputCols()
    cuts = thresholds(prepared.inputs.filter(~F.col("_validation")), bins)
    bucketizer = Bucketizer(
        inputCols=filled, outputCols=[f"{n}_bin" for n in filled],
        splitsArray=[[-inf, *(at or [0.0]), inf] for at in cuts],  # a feature of one value keeps one
    )
    assembler = VectorAssembler(inputCols=bucketizer.getOutputCols(), outputCol="features")
    values = vector_to_array("features")
    single = prepared.inputs.select(*[values[i].alias(n) for i, n in enumerate(filled)], LABEL_COLUMN, "_validation")
    # Without the metadata of the bins, which would make them categories without an order.
    numbers = array_to_vector(F.array(*bucketizer.getOutputCols())).alias("features")
    stored = bucketizer.transform(single).select(numbers, LABEL_COLUMN, "_validation")
    stages = [*prepared.stages[:-1], bucketizer, assembler]
    return prepared._replace(stages=stages, inputs=cut_lineage(stored), binned=True)


def fit(prepared: Prepared, params: Mapping = RATIO_WEIGHTED) -> Trained:
    """Boosted trees, as many as the validation rows call for.

    The number of trees is the one of least validation loss before ``patience`` trees
    in a row brought no better one. Spark's own early stopping ends at the first tree
    without progress, so trees are grown in rounds of twice as many, from the same seed
    and the same stored rows, until the rule has stopped or ``maxIter`` is reached: at
    most about three times the work of the trees that the rule looks at.

    Candidate thresholds come from all training rows: where Spark would draw a sample for them,
    features are cut into ``maxBins`` bins first, and the learner's own ``maxBins`` is only raised
    so far that it looks at every row.
    """
    settings = {"checkpointInterval": 10, **params}
    scheme, patience = settings.pop("scheme", "ratio"), settings.pop("patience", 20)
    most = settings.pop("maxIter", 20)
    learner = GBTClassifier(labelCol=LABEL_COLUMN, featuresCol="features", weightCol="weight", **settings)
    prepared = in_bins(prepared, learner.getMaxBins())
    if prepared.binned:
        learner.setMaxBins(min(MOST_BINS, isqrt(prepared.negatives + prepared.positives - 1) + 1))
    weighted = prepared.inputs.withColumn("weight", weight_of(prepared, scheme))
    train, validation = weighted.filter(~F.col("_validation")), weighted.filter("_validation")
    grown = min(most, 2 * patience)
    while True:
        booster = learner.copy({learner.maxIter: grown}).fit(train)
        losses = booster.evaluateEachIteration(validation)
        wanted = trees_wanted(losses, patience)
        if grown >= most or len(losses) - wanted >= patience:
            break
        grown = min(most, 2 * grown)
    if wanted < booster.getNumTrees:
        booster = learner.copy({learner.maxIter: wanted}).fit(train)
    return Trained(PipelineModel(stages=[*prepared.stages, booster]), dict(params), prepared.inputs)


def train_boosted_trees(
    rows: DataFrame,
    params: Mapping = RATIO_WEIGHTED,
    features: Sequence[str] = FEATURE_COLUMNS,
    split: str = "split",
    train_rows: int | None = None,
) -> Trained:
    """``fit`` on what ``prepare`` makes of a labelled table with the split column.

    Spark grows every tree over the distributed rows; nothing is collected.
    """
    return fit(prepare(rows, features, split, train_rows), params)


def trees_wanted(losses: Sequence[float], patience: int) -> int:
    """How many trees give the least loss before ``patience`` trees in a row bring no better one."""
    best = 0
    for number, loss in enumerate(losses):
        if loss < losses[best]:
            best = number
        elif number - best >= patience:
            break
    return best + 1


def batch_score(
    model: PipelineModel,
    rows: DataFrame,
    threshold: float = 0.5,
    features: Sequence[str] = FEATURE_COLUMNS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Carried columns with ``fraud_score`` and ``flagged`` (strictly above the threshold).

    Works on batch and streaming rows alike.
    """
    inputs = feature_projection(rows, features, label=None, carry=carry)
    scored = model.transform(inputs).withColumn(
        "fraud_score", vector_to_array("probability")[1]
    )
    flagged = over_threshold(F.col("fraud_score"), threshold).cast("int")
    return scored.select(*carry, "fraud_score", flagged.alias("flagged"))


def model_search(
    rows: DataFrame,
    grid: Sequence[Mapping],
    features: Sequence[str] = FEATURE_COLUMNS,
    split: str = "split",
    train_rows: int | None = None,
    at_once: int = 4,
) -> tuple[Trained, DataFrame]:
    """Trains every candidate and picks the best F1 on the ``val`` rows.

    The split is by time, so no random validation split is involved. Inputs are
    prepared once; candidates are fitted as concurrent jobs, ``at_once`` at a time,
    each in a scheduler pool of its own, so with ``spark.scheduler.mode=FAIR`` they
    share the executors evenly. Returns the winner and one row of measures per candidate.
    """
    prepared = prepare(rows, features, split, train_rows)
    spark = rows.sparkSession

    def measured(number: int) -> tuple[Trained, tuple]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"candidate-{number}")
        candidate = fit(prepared, grid[number])
        scored = candidate.model.stages[-1].transform(candidate.inputs.filter("_validation"))
        scored = scored.withColumn("fraud_score", vector_to_array("probability")[1])
        fraud = classification_report(scored, "fraud_score").filter(F.col("class") == "fraud").first()
        return candidate, (number, str(dict(grid[number])), fraud["precision"], fraud["recall"], fraud["f1"], fraud["support"])

    with ThreadPoolExecutor(max_workers=max(1, min(at_once, len(grid)))) as pool:
        done = list(pool.map(inheritable_thread_target(spark)(measured), range(len(grid))))
    results = spark.createDataFrame(
        [row for _, row in done], "candidate INT, params STRING, precision DOUBLE, recall DOUBLE, f1 DOUBLE, support BIGINT"
    )
    best = max((row for _, row in done), key=lambda row: (row[4], -row[0]))[0]
    return done[best][0], results


def evaluate_splits(
    model: PipelineModel,
    rows: DataFrame,
    splits: Sequence[str] = ("val", "test"),
    features: Sequence[str] = FEATURE_COLUMNS,
    split: str = "split",
    threshold: float = 0.5,
) -> tuple[DataFrame, DataFrame]:
    """Hold-out measures of a fitted model in one call, from rows that are scored and stored once.

    First a row per split: precision, recall, F1, ROC-AUC and average precision of the
    fraud class. Then the class report per split.
    """
    held = rows.filter(F.col(split).isin(list(splits)) & F.col(LABEL_COLUMN).isin(0, 1))
    scored = cut_lineage(batch_score(model, held, threshold, features, carry=[split, LABEL_COLUMN]).drop("flagged"))
    report = classification_report(scored, "fraud_score", threshold=threshold, by=[split])
    fraud = report.filter(F.col("class") == "fraud").select(split, "precision", "recall", "f1", "support")
    ranking = ranking_quality(scored, "fraud_score", LABEL_COLUMN, by=[split]).select(split, "roc_auc", "pr_auc")
    return fraud.join(ranking, split, "left"), report

"""Mixing sources to target weights (operator 1); DataFrame operations only.

Sizes are summed per source, a source's rate is its target over its size, and a
document is taken floor(rate) times plus once more with a probability equal to
the rate's fraction, drawn from a hash of its id, its text and a seed.

* Sources stand in code point order, an absent source last, and weigh
  ``WEIGHTS`` in turn. They share the size of the whole corpus; a target ends at
  ``LIMIT`` times its source's size, and the rest goes to the others by weight.
* A null text has size 0 and a source without words has target 0; its documents
  are taken 0 times in ``taken`` and, being free, once in ``copies``.
* Rows that share doc_id and text draw alike. A null doc_id stands as the text
  ``null``, so different texts without id draw apart.
* An empty table gives no rows. ``mix_plan`` reads doc_id, source and text only;
  ``mixed`` returns the columns it was given, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.words import WORD, quoted, unused
from ledgerlens.session import cut_lineage

WEIGHTS = (5, 2, 1)
LIMIT = 3
SEED = "mix-1"
#: Hexadecimal digits of the draw: 48 bits, exact in a double.
DIGITS = 12


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(seed: str = SEED) -> Column:
    """Number in [0, 1) that depends on doc_id, text and the seed alone."""
    doc_id, text = F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce("text", F.lit(""))
    key = F.concat(F.lit(f"{seed}:"), doc_id, F.lit(":"), text)
    return F.conv(F.substring(F.md5(key), 1, DIGITS), 16, 10).cast("long") / F.lit(float(16**DIGITS))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """Target of each source: ``min(limit * size, level * weight)`` with the level that spends the total.

    ``sizes`` has (source, source_size), a row per source; the windows below hold
    one row per source, never documents. In order of the level at which a source
    reaches its limit, the first source whose limit lies above the level left for
    it and its successors fixes the level.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy("full_at", "place")
    so_far = by_level.rowsBetween(Window.unboundedPreceding, -1)
    to_come = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    place = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    steps = (
        sizes.withColumn("place", place)
        .withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * limit)
        .withColumn("full_at", F.col("most") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("most").over(so_far), F.lit(0)))
        .withColumn("level", F.col("left") / F.sum("weight").over(to_come))
        .withColumn("fixed", F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(everything))
    )
    return steps.select(
        "source",
        "source_size",
        F.least(F.col("most").cast("double"), F.col("fixed") * F.col("weight")).alias("target"),
    )


def mix_plan(
    documents: DataFrame,
    size: Column,
    seed: str = SEED,
    weights: tuple[int, ...] = WEIGHTS,
    limit: int = LIMIT,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies) for every row of ``documents``."""
    sized = cut_lineage(documents.select("doc_id", "source", size.alias("size"), draw(seed).alias("drawn")))
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = cut_lineage(source_targets(sums, weights, limit)).withColumnRenamed("source", "of_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(1.0)
    whole = F.floor("rate")
    return (
        sized.join(targets, F.col("source").eqNullSafe(F.col("of_source")))
        .withColumn("rate", rate)
        .withColumn("copies", whole + (F.col("drawn") < F.col("rate") - whole).cast("long"))
        .drop("of_source", "drawn")
    )


def mixed(
    documents: DataFrame,
    seed: str = SEED,
    weights: tuple[int, ...] = WEIGHTS,
    limit: int = LIMIT,
) -> DataFrame:
    """Every document as often as the mix takes it, with the columns of ``documents``."""
    sums = documents.groupBy("source").agg(F.sum(word_count(F.col("text"))).alias("source_size"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(1.0)
    of, at, copies, copy = (unused(name, documents.columns) for name in ("_of", "_rate", "_copies", "_copy"))
    rates = cut_lineage(source_targets(sums, weights, limit).select(F.col("source").alias(of), rate.alias(at)))
    whole = F.floor(at)
    taken = whole + (draw(seed) < F.col(at) - whole).cast("long")
    return (
        documents.join(rates, F.col("source").eqNullSafe(F.col(of)))
        .withColumn(copies, taken)
        .where(F.col(copies) > 0)
        .withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))))
        .select(*[F.col(quoted(c)) for c in documents.columns])
    )


def op1_mixing(spark, sf_dir) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = mix_plan(documents, word_count(F.col("text")))
    return plan.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


OP1_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(text, '')), 1, 12))::BIGINT
           / 281474976710656.0::DOUBLE AS u,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
placed AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sums),
weighed AS (
  SELECT *, [5, 2, 1][place % 3 + 1] AS weight, source_size * 3 AS most FROM placed),
levels AS (
  SELECT *, most / weight AS full_at, sum(source_size) OVER () AS total FROM weighed),
steps AS (
  SELECT *,
    (total - coalesce(sum(most) OVER (ORDER BY full_at, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY full_at, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM levels),
targets AS (
  SELECT source, source_size,
    least(most::DOUBLE, max(CASE WHEN level <= full_at THEN level END) OVER () * weight) AS target
  FROM steps),
rated AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 1.0 END::DOUBLE AS rate, d.u
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  ((floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT * size)::BIGINT AS taken,
  (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies
FROM rated
"""

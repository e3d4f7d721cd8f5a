"""Sharding by a Feistel permutation over global row numbers (operator 10).

Rows are numbered in order of (doc_id, checksum, size); a keyed Feistel network
with cycle walking maps the numbers 0..n-1 onto themselves, and a permuted
number p lies in shard ``p % shards`` at slot ``p // shards``. Law ``rows``:
shard sizes differ by one row at most, slots have no gap, and anyone can compute
a row's shard from its number, n, the seed and the number of shards.

* Null doc_id comes first; a null text has no bytes and the checksum of none, 0.
* Rows equal in all three values are told apart by where they were read; they
  swap places only among themselves, so the result as a whole repeats.
* Law ``rows`` spreads equal texts over shards; it keeps no groups together.
* An empty table gives no rows. Columns not named here are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.words import mix
from ledgerlens.session import cut_lineage

SHARDS = 24
SEED = 20_240_901
ROUNDS = 6
_ROW_BITS = 33


def numbered(rows: DataFrame, *order: str, name: str = "row_number") -> DataFrame:
    """``rows`` with global numbers from 0 in the given order.

    Range partitions are sorted and stored with each row's place; the offsets
    come from one count per partition, so no task sees more than its range. The
    reading position is the last key: a value that many rows share is split.
    """
    placed = rows.withColumn("_read", F.monotonically_increasing_id())
    keys = [*order, "_read"]
    ranged = placed.repartitionByRange(*keys).sortWithinPartitions(*keys)
    stored = cut_lineage(ranged.withColumn("_place", F.monotonically_increasing_id()).drop("_read"))
    part, inside = F.shiftright("_place", _ROW_BITS), F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1)
    counts = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut_lineage(counts.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset")))
    joined = stored.withColumn("_part", part).join(offsets, "_part")
    return joined.withColumn(name, F.col("_offset") + inside).drop("_part", "_offset", "_place")


def feistel(numbers: np.ndarray, total: int, seed: int = SEED, rounds: int = ROUNDS) -> np.ndarray:
    """Permutation of 0..total-1; values that leave the range walk on along their cycle."""
    half = max(1, (max(total - 1, 1).bit_length() + 1) // 2)
    low, width = np.uint64((1 << half) - 1), np.uint64(half)
    keys = mix(np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
    out = numbers.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> width, out[walking] & low
        for key in keys:
            left, right = right, left ^ (mix(right + key) & low)
        out[walking] = (left << width) | right
        walking = walking[out[walking] >= np.uint64(total)]
    return out.astype(np.int64)


def permuted(number: Column, total: int, seed: int = SEED) -> Column:
    @F.pandas_udf("long")
    def permute(values: pd.Series) -> pd.Series:
        return pd.Series(feistel(values.to_numpy(), total, seed))

    return permute(number)


def sharded(documents: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, row_number, shard, slot) of every row."""
    text = F.coalesce("text", F.lit(""))
    narrow = documents.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    rows = numbered(narrow, "doc_id", "text_crc32", "size")
    total = rows.count()
    place = permuted(F.col("row_number"), total, seed)
    return (
        rows.withColumn("_p", place)
        .withColumn("shard", (F.col("_p") % shards).cast("int"))
        .withColumn("slot", F.floor(F.col("_p") / shards).cast("long"))
        .drop("_p")
    )


def op10_sharding(spark, sf_dir) -> DataFrame:
    rows = sharded(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number",
    )

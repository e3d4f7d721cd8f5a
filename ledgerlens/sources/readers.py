"""Readers of the raw inputs, always with a declared schema."""

from __future__ import annotations

import re
from typing import Literal

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ledgerlens.contract import FEATURE_RECORD_SCHEMA, REQUEST_LOG_SCHEMA


def with_ingest_columns(df: DataFrame, source_file: bool = False) -> DataFrame:
    """Adds the ingestion time, and for a file scan the file each row came from."""
    extra = {"_ingestion_timestamp": F.current_timestamp()}
    if source_file:
        extra["_source_file"] = F.col("_metadata.file_path")
    return df.withColumns(extra)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header row; a field that does not fit its type becomes NULL."""
    return spark.read.schema(schema).csv(path, header=True)


def read_json_dict(
    spark: SparkSession,
    path: str,
    key: str,
    value: str,
    key_type: str,
    root: str | None = None,
    splittable: bool | Literal["quotes"] = False,
) -> DataFrame:
    """Rows ``(key, value)`` from JSON objects used as dictionaries.

    By default each file is one document and becomes one row, which allows any
    content but binds a file to one task: right for small lookups.

    ``splittable`` reads byte ranges of a file in parallel, cut at commas, and
    picks ``"key": "value"`` (or ``null``, ``true``, ``false``) pairs out of the
    pieces. Keys are digits, values hold no comma, quote or backslash, and documents
    nothing but the one dictionary below ``root``. Whatever else a piece holds
    makes the job fail; nothing is skipped.

    ``splittable="quotes"`` reads byte ranges in parallel too, with any text in keys and
    values (commas, quotes, escapes): the parity of the quotes before a piece tells
    whether it lies inside a text. It shuffles the entries.
    """
    if splittable == "quotes":
        return _read_between_quotes(spark, path, key, value, key_type, root)
    if splittable:
        pieces = spark.read.text(path, lineSep=",")
        entry = r'"(-?[0-9]+)"\s*:\s*(?:"([^"\\]*)"|null|(true|false))'
        opening = r"^\s*\{|\}\s*\{" if root is None else rf'\{{\s*"{re.escape(root)}"\s*:\s*\{{'
        rest = F.regexp_replace(F.regexp_replace("value", F.lit(entry), F.lit("")), F.lit(opening), F.lit(""))
        strange = F.concat(F.lit("no entry of the dictionary, read it without splittable: "), F.substring(rest, 1, 80))
        checked = pieces.filter(F.when(rest.rlike(r"^[\s{}]*$"), F.lit(True)).otherwise(F.raise_error(strange)))
        entries = checked.select(F.explode(F.regexp_extract_all("value", F.lit(entry), F.lit(0))).alias("_entry"))
        raw_key, text, word = (F.regexp_extract("_entry", entry, group) for group in (1, 2, 3))
        raw_value = F.when(F.col("_entry").endswith('"'), text).when(word != "", word)
        return entries.select(raw_key.try_cast(key_type).alias(key), raw_value.alias(value))
    document = F.col("value") if root is None else F.get_json_object("value", f"$.{root}")
    return (
        spark.read.text(path, wholetext=True)
        .select(F.explode(F.from_json(document, "map<string,string>")).alias(key, value))
        .withColumn(key, F.col(key).try_cast(key_type))
    )


#: Entries that are paired in one group.
_CHUNK = 1 << 16


def _tokens(spark: SparkSession, path: str) -> DataFrame:
    """(file, number, text) of the texts between unescaped quotes; odd numbers lie inside quotes.

    A file is cut at every quote, in parallel. A piece that ends in an odd number of
    backslashes is followed by an escaped quote and goes on in the next one. Quotes are
    counted within each byte range; the ranges' totals, a row each, give the number before.
    """
    pieces = spark.read.text(path, lineSep='"').select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
        F.col("value").alias("_text"),
    )
    slashes = F.length(F.regexp_extract("_text", r"(\\*)$", 1))
    pieces = pieces.withColumn("_ends", (slashes % 2 == 0).cast("bigint"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = pieces.groupBy("_file", "_block").agg(F.sum("_ends").alias("_ends"))
    ranges = ranges.select("_file", "_block", F.coalesce(F.sum("_ends").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_file", "_block").orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
    counted = pieces.withColumn("_so_far", F.coalesce(F.sum("_ends").over(inside), F.lit(0)))
    parts = F.array_sort(F.collect_list(F.struct("_block", "_id", "_text")))
    return (
        counted.join(ranges, ["_file", "_block"])
        .groupBy("_file", (F.col("_before") + F.col("_so_far")).alias("_number"))
        .agg(F.array_join(F.transform(parts, lambda p: p["_text"]), '"').alias("_text"))
    )


def _read_between_quotes(spark, path: str, key: str, value: str, key_type: str, root: str | None) -> DataFrame:
    """Entries from the tokens: a text is a key if a colon follows; its value is the next text or a plain word."""
    chunk = F.call_function("div", F.col("_number"), F.lit(_CHUNK))
    # The two tokens after a chunk's last one are dealt to it as well.
    peeked = F.when((F.col("_number") % _CHUNK < 2) & (F.col("_number") >= _CHUNK), chunk - 1)
    dealt = _tokens(spark, path).select("*", chunk.alias("_home"), F.explode(F.array(chunk, peeked)).alias("_chunk"))
    order = Window.partitionBy("_file", "_chunk").orderBy("_number")
    seen = (
        dealt.filter(F.col("_chunk").isNotNull())
        .withColumns({"_after": F.lead("_text").over(order), "_next": F.lead("_text", 2).over(order)})
        .filter("_home = _chunk")
    )
    word = r"^\s*:\s*(null|true|false|-?[0-9][0-9.eE+-]*)\s*[,}][\s,{}]*$"
    is_text, after = F.col("_number") % 2 == 1, F.coalesce("_after", F.lit(""))
    opens = after.rlike(r"^\s*:\s*\{\s*$")
    opens = opens & (F.col("_text") == root) if root is not None else F.lit(False)
    known = ~is_text | opens | after.rlike(r"^\s*:\s*$") | after.rlike(word) | after.rlike(r"^[\s,{}]*$")
    strange = F.concat(F.lit("no entry of the dictionary: "), F.substring(after, 1, 80))
    checked = seen.filter(F.when(known, F.lit(True)).otherwise(F.raise_error(strange)))
    keys = checked.filter(is_text & ~opens & F.col("_after").rlike(r"^\s*:"))

    def plain(text: Column) -> Column:
        return F.get_json_object(F.concat(F.lit('{"v":"'), text, F.lit('"}')), "$.v")

    found = F.regexp_extract("_after", word, 1)
    raw_value = F.when(found == "", plain(F.col("_next"))).when(found != "null", found)
    return keys.select(plain(F.col("_text")).try_cast(key_type).alias(key), raw_value.alias(value))


def read_feature_records(spark: SparkSession, path: str) -> DataFrame:
    """JSON records to be scored, in contract order; absent fields are NULL."""
    return spark.read.schema(FEATURE_RECORD_SCHEMA).json(path)


def read_request_logs(spark: SparkSession, path: str) -> DataFrame:
    """Inference log written by the scoring jobs."""
    return spark.read.schema(REQUEST_LOG_SCHEMA).parquet(path)

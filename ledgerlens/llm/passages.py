"""Removal of repeated passages by relative Lempel-Ziv factors (operator 3).

A factor is a maximal run of words in which every window of ``WINDOW`` words
also begins earlier (smaller doc_id, or earlier in the same text).

1. The texts of a batch are a reference block, indexed by the hashes of their
   windows in order of (doc_id, row, place). Each text is factored against its
   own block at once: windows that the block holds earlier need no further look.
2. What is left is cut where the smallest 5-gram hash of the window changes.
   Equal windows have equal smallest hashes, so these factor boundaries bring
   together, in one shuffle, what any other block holds of the same window.
   There the first of each window stays and the others end up in factors.
3. The factors of a text, joined, are the words to remove.

* A null text has no words; texts under ``WINDOW`` words stay whole.
* Rows that repeat a doc_id are texts of their own, in reading order; of equal
  ones the first stays. Null doc_id comes before all numbers.
* A passage however frequent crosses the network once per block, not per copy.
* An empty table gives no rows. Columns other than doc_id and text are not read.
* Windows are compared by their full 64-bit hash, within a block and across
  blocks. The key (smallest 5-gram) only deals them out: windows of one key
  share it, so it tells none of them apart.
* A key of many different windows is dealt over several tasks by a second part
  of the window hash; a pass before counts the windows of frequent keys.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.words import (
    SLICE_BYTES,
    find_words,
    mix,
    slices,
    span_hashes,
    string_buffers,
    window_hashes,
    window_inside,
)

WINDOW = 20
GRAM = 5
#: Text bytes of a reference block.
BLOCK_BYTES = 24 << 20
#: New windows of one key that a task takes, and those in one block from which the key is counted.
KEY_WINDOWS, COUNTED = 4096, 32

PHRASES = "key long, doc_id long, row long, start int, n int, windows binary"
FACTORS = "row long, start int, n int"


def runs(breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of every run; ``breaks`` marks where a run begins."""
    first = np.flatnonzero(breaks)
    return first, np.diff(first, append=len(breaks))


def smallest_ahead(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    out, reach = values, 1
    while reach < width:
        step = min(reach, width - reach)
        out = np.minimum(out[: len(out) - step], out[step:])
        reach += step
    return out


def block_windows(column: pa.Array) -> tuple[np.ndarray, ...]:
    """Hash, smallest 5-gram, text number and start of every window of a block, text by text."""
    parts = []
    for texts in slices(column, SLICE_BYTES):
        words = find_words(texts)
        hashes = span_hashes(texts.data, words.starts, words.ends)
        inside = np.flatnonzero(window_inside(words, WINDOW))
        if not len(inside):
            continue
        full = window_hashes(hashes, WINDOW)[inside]
        key = smallest_ahead(window_hashes(hashes, GRAM), WINDOW - GRAM + 1)[inside]
        text = words.text_of_word()[inside]
        parts.append((full, key, (text + texts.first).astype(np.int32), (inside - words.of_text[text]).astype(np.int32)))
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def text_order(doc_ids: pa.Array, rows: np.ndarray) -> np.ndarray:
    """Rank of each text by (doc_id, row), nulls first."""
    known = np.array(doc_ids.is_valid())
    values = doc_ids.fill_null(0).to_numpy(zero_copy_only=False)
    order = np.lexsort([rows, values, known])
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank


def dealt_keys(key: np.ndarray, full: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Where each window goes: its key, or one of a frequent key's parts by the window hash."""
    keys, parts = frequent
    if not len(keys):
        return key
    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    part = mix(full + np.uint64(1)) % np.where(keys[at] == key, parts[at], np.uint64(1))
    return np.where(part > 0, mix(key + part), key)


def factor_block(
    doc_ids: pa.Array, rows: np.ndarray, column: pa.Array, frequent: tuple[np.ndarray, np.ndarray]
) -> pa.RecordBatch | None:
    """Phrases of a block: what no earlier place of the block holds, and factors found within it (no windows)."""
    full, key, text, start = block_windows(column)
    if not len(full):
        return None
    order = np.argsort(text_order(doc_ids, rows)[text], kind="stable")
    full, key, text, start = full[order], key[order], text[order], start[order]
    new = np.zeros(len(full), bool)
    new[np.unique(full, return_index=True)[1]] = True
    key = dealt_keys(key, full, frequent)
    breaks = np.ones(len(full), bool)
    breaks[1:] = (text[1:] != text[:-1]) | (new[1:] != new[:-1]) | (new[1:] & (key[1:] != key[:-1]))
    first, length = runs(breaks)
    hashes = full.astype("<u8").tobytes()
    packed = [
        hashes[8 * i : 8 * (i + n)] if fresh else None
        for i, n, fresh in zip(first.tolist(), length.tolist(), new[first].tolist(), strict=True)
    ]
    row = rows[text[first]]
    # factors that are complete already may go to any task
    to = np.where(new[first], key[first], mix(row.astype(np.uint64) + start[first].astype(np.uint64)))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(to.view(np.int64)), doc_ids.take(pa.array(text[first])), pa.array(row),
            pa.array(start[first]), pa.array(length.astype(np.int32)), pa.array(packed, pa.binary()),
        ],
        ["key", "doc_id", "row", "start", "n", "windows"],
    )


def frequent_keys(rows: DataFrame, block_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys, ascending, that have over ``KEY_WINDOWS`` different windows, and into how many parts each goes.

    A block reports the keys of ``COUNTED`` of its windows or more, so the list
    is at most a ``KEY_WINDOWS``-th of all windows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            for part in slices(text, block_bytes):
                full, key, _, _ = block_windows(text[part.first : part.first + len(part)])
                keys, times = np.unique(key[np.unique(full, return_index=True)[1]], return_counts=True)
                many = times >= COUNTED
                yield pa.RecordBatch.from_arrays([pa.array(keys[many].view(np.int64)), pa.array(times[many].astype(np.int64))], ["key", "n"])

    found = rows.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    got = found.where(F.col("n") > KEY_WINDOWS).toArrow()
    keys = got.column("key").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], (got.column("n").to_numpy()[order] // KEY_WINDOWS + 1).astype(np.uint64)


def phrases(rows: DataFrame, block_bytes: int) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(frequent_keys(rows, block_bytes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, numbers = batch.column("text"), batch.column("row").to_numpy()
            doc_ids = batch.column("doc_id").cast(pa.int64())
            for part in slices(text, block_bytes):
                i, j = part.first, part.first + len(part)
                found = factor_block(doc_ids[i:j], numbers[i:j], text[i:j], shared.value)
                if found is not None:
                    yield found

    return rows.mapInArrow(run, PHRASES)


def later_windows(rows: pa.Table) -> pa.RecordBatch:
    """Factors of whole key groups that are sorted by (key, doc_id, row, start)."""
    start, n, row = (rows.column(c).to_numpy() for c in ("start", "n", "row"))
    done = np.array(rows.column("windows").combine_chunks().is_null())
    data, offsets = string_buffers(rows.column("windows"))
    lengths = np.where(done, 0, n).astype(np.int64)
    windows = np.frombuffer(data[offsets[0] : offsets[-1]].tobytes(), "<u8")
    of_row = np.repeat(np.arange(len(n)), lengths)
    place = np.arange(len(windows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    later = np.ones(len(windows), bool)
    later[np.unique(windows, return_index=True)[1]] = False  # equal windows have one key, so groups need not be told apart
    of_row, place = of_row[later], place[later]
    breaks = np.ones(len(of_row), bool)
    breaks[1:] = (of_row[1:] != of_row[:-1]) | (place[1:] != place[:-1] + 1)
    first, length = runs(breaks)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([row[done], row[of_row[first]]])),
            pa.array(np.concatenate([start[done], (start[of_row[first]] + place[first]).astype(np.int32)])),
            pa.array(np.concatenate([n[done], length]).astype(np.int32)),
        ],
        ["row", "start", "n"],
    )


def factors(parts: DataFrame) -> DataFrame:
    """(row, start, n): runs of windows that begin earlier elsewhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column("key").to_numpy()
            whole = int(np.searchsorted(key, key[-1]))  # the last key may go on in the next batch
            if whole:
                yield later_windows(pa.Table.from_batches([*held, batch.slice(0, whole)]))
                held = []
            elif held and held[-1].column("key")[-1].as_py() != key[0]:
                yield later_windows(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(whole))
        if held:
            yield later_windows(pa.Table.from_batches(held))

    dealt = parts.repartition("key").sortWithinPartitions("key", F.col("doc_id").asc_nulls_first(), "row", "start")
    return dealt.mapInArrow(run, FACTORS)


def cleaned(documents: DataFrame, block_bytes: int = BLOCK_BYTES, digest: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): ``kept`` is the text left over, or its SHA-256 with ``digest``."""
    rows = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    spans = factors(phrases(rows, block_bytes)).groupBy("row")
    spans = spans.agg(F.collect_list("start").alias("starts"), F.collect_list("n").alias("counts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text").to_pylist()
            starts, counts = batch.column("starts").to_pylist(), batch.column("counts").to_pylist()
            totals, gone, kept = [], [], []
            for value, begin, n in zip(text, starts, counts, strict=True):
                words = (value or "").encode().split()
                if begin:
                    begin, n = np.array(begin), np.array(n)
                    change = np.zeros(len(words) + 1, np.int32)
                    np.add.at(change, begin, 1)
                    np.add.at(change, begin + n + WINDOW - 1, -1)
                    keep = np.cumsum(change[:-1]) == 0
                    left = list(compress(words, keep.tolist()))
                else:
                    left = words
                totals.append(len(words))
                gone.append(len(words) - len(left))
                joined = b" ".join(left)
                kept.append(hashlib.sha256(joined).hexdigest() if digest else joined.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(totals, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", name],
            )

    name = "kept_sha256" if digest else "kept"
    joined = rows.join(spans, "row", "left").select("doc_id", "text", "starts", "counts")
    return joined.mapInArrow(run, f"doc_id long, n_words long, n_removed long, {name} string")


def op3_passages(spark, sf_dir) -> DataFrame:
    return cleaned(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest=True)

"""Quality rules from repetition coverage (operator 4).

Rolling 64-bit hashes of word n-grams and of lines tell which n-grams and lines
occur twice or more in a text; the verdict limits the share of the text's word
characters that lie inside them (every occurrence counts, overlaps once).

* Words are runs of bytes other than space and 0x09-0x0D; a null text has none
  and fails the base rule, as does an empty one.
* Lines are parts between ``\\n`` that hold a word; a line repeats if it equals
  an earlier one byte by byte. Its characters are those of its words.
* Every row is judged by itself, so ties, repeated rows and empty tables need no
  rule. ``quality`` keeps doc_id and adds its own columns; ``keep_good`` returns
  the columns it was given, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlens.llm.stored import giving_back
from ledgerlens.llm.words import Texts, covered_by, find_words, slices, span_hashes, window_hashes, window_inside

MIN_WORDS = 10
BASE_WINDOW = 5
#: Percent of words in repeated five-word windows that the base rule allows.
BASE_PERCENT = 20
#: Largest share of word characters inside repeated n-grams, by length, and inside repeated lines.
#: Long repeats count as worse, so limits fall with the length and lie below the base rule's 20%.
#: Of the texts of ``check_s`` that pass the base rule, 99.5% have n-gram shares of at most 0.14.
COVERAGE = {5: 0.18, 7: 0.16, 10: 0.14}
LINE_COVERAGE = 0.18

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    + "".join(f"share_{n} double, " for n in COVERAGE)
    + "share_lines double, base_failed boolean, kept boolean"
)


def table_of(values: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


#: The symbols that are counted.
SYMBOLS = table_of(b"#*$%&|<>")
#: Bytes that begin a character.
LEADING = np.array([(b & 0xC0) != 0x80 for b in range(256)])


def repeated(keys: np.ndarray) -> np.ndarray:
    """Mask of the values that occur more than once."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def repeats_earlier(keys: np.ndarray) -> np.ndarray:
    """Mask of the values that an earlier one equals."""
    out = np.ones(len(keys), bool)
    out[np.unique(keys, return_index=True)[1]] = False
    return out


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of each text's part of ``values``."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def of_text_keys(hashes: np.ndarray, text_no: np.ndarray) -> np.ndarray:
    """Hashes that are equal within a text only."""
    return hashes ^ (text_no.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)


def line_spans(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every line, empty ones included."""
    breaks = np.flatnonzero(texts.data == 0x0A)
    starts = np.concatenate([breaks + 1, texts.offsets[:-1]])
    text_no = np.concatenate([np.searchsorted(texts.offsets, breaks, side="right") - 1, np.arange(len(texts))])
    order = np.lexsort([starts, text_no])
    starts, text_no = starts[order], text_no[order]
    ends = np.concatenate([breaks, texts.offsets[1:]])
    ends_no = np.concatenate([np.searchsorted(texts.offsets, breaks, side="right") - 1, np.arange(len(texts))])
    return starts, ends[np.lexsort([ends, ends_no])], text_no


def measure(texts: Texts) -> dict[str, np.ndarray]:
    words = find_words(texts)
    counts, text_no = words.counts(), words.text_of_word()
    hashes = span_hashes(texts.data, words.starts, words.ends)
    characters = np.concatenate([[0], np.cumsum(LEADING[texts.data], dtype=np.int64)])
    chars = characters[words.ends] - characters[words.starts]
    out = {"n_words": counts, "word_chars": sums(chars, words.of_text)}
    out["n_symbols"] = sums(SYMBOLS[texts.data], texts.offsets)

    starts, ends, line_text = line_spans(texts)
    first, last = np.searchsorted(words.starts, starts), np.searchsorted(words.starts, ends)
    full = last > first
    starts, ends, line_text, first, last = (x[full] for x in (starts, ends, line_text, first, last))
    lines = of_text_keys(span_hashes(texts.data, starts, ends), line_text)
    out["n_dup_lines"] = np.bincount(line_text[repeats_earlier(lines)], minlength=len(texts))
    char_sum = np.concatenate([[0], np.cumsum(chars)])
    again = repeated(lines)
    in_lines = np.bincount(
        line_text[again], weights=(char_sum[last] - char_sum[first])[again], minlength=len(texts)
    )

    share = np.maximum(out["word_chars"], 1)
    for n in sorted({BASE_WINDOW, *COVERAGE}):
        inside = np.flatnonzero(window_inside(words, n))
        keys = of_text_keys(window_hashes(hashes, n)[inside], text_no[inside])
        covered = covered_by(inside[repeated(keys)], n, len(hashes))
        if n == BASE_WINDOW:
            out["n_repeat_words"] = sums(covered, words.of_text)
        if n in COVERAGE:
            out[f"share_{n}"] = sums(covered * chars, words.of_text) / share
    out["share_lines"] = in_lines / share
    out["base_failed"] = (counts < MIN_WORDS) | (100 * out["n_repeat_words"] > BASE_PERCENT * counts)
    good = ~out["base_failed"] & (out["share_lines"] <= LINE_COVERAGE)
    for n, most in COVERAGE.items():
        good &= out[f"share_{n}"] <= most
    out["kept"] = good
    return out


def measured(column: pa.Array) -> dict[str, np.ndarray]:
    parts = [measure(texts) for texts in slices(column)]
    return {name: np.concatenate([p[name] for p in parts]) for name in parts[0]} if parts else {}


def quality(documents: DataFrame) -> DataFrame:
    """Measures and verdict of every row; see ``SCHEMA``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in giving_back(batches):
            found = measured(batch.column("text"))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *[pa.array(v) for v in found.values()]], ["doc_id", *found]
                ).select(names)

    names = [part.split()[0] for part in SCHEMA.split(", ")]
    return documents.select("doc_id", "text").mapInArrow(run, SCHEMA)


def keep_good(documents: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in giving_back(batches):
            found = measured(batch.column("text"))
            if found:
                yield batch.filter(pa.array(found["kept"]))

    return documents.mapInArrow(run, documents.schema)


def op4_quality(spark, sf_dir) -> DataFrame:
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))

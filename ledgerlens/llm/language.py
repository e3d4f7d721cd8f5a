"""Language identification by prediction by partial matching (operator 5).

Each language has a tree of byte contexts of up to ``ORDER`` bytes with the
counts of the bytes that follow. A byte is coded in the longest context seen in
training; a byte that did not follow there costs the escape probability
(distinct / (total + distinct), method C) and goes on in the next shorter
context without the bytes already refused, down to a uniform code. Statistics
are frozen, so the code length of a text is a sum of table entries, looked up
with numpy. The language with the shortest code wins.

* Training: about ``SAMPLE`` documents of each language (all, where it has no
  more), drawn by a checksum of the id and read as whole texts. Counts are summed by Spark;
  the driver gets one row per (language, context, byte) of this sample.
* Null texts, texts without a letter and a model without languages give ``und``
  and score 0. Ties go to the language that sorts first. The score is the
  posterior of the winner under equal priors.
* Rows are judged by themselves; other columns are not read. An empty table
  gives no rows. A null doc_id is not held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.words import Texts, slices
from ledgerlens.session import cut_lineage

ORDER = 3
SAMPLE = 400
FOLDS, HELD_OUT = 4, 2
#: Stands before the first byte of a text.
PAD = 0x0A
UNKNOWN = "und"
SLICE_BYTES = 1 << 18

RESULT = "doc_id long, held_out boolean, lang_pred string, score double"


def fold(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS, F.lit(0))


def previous(texts: Texts, symbols: np.ndarray, pad: int) -> list[np.ndarray]:
    """For k = 1..ORDER the symbol k places before each position, ``pad`` before a text's start."""
    lengths = np.diff(texts.offsets)
    out = []
    for k in range(1, ORDER + 1):
        before = np.empty_like(symbols)
        before[:k] = pad
        before[k:] = symbols[:-k] if len(symbols) > k else symbols[:0]
        for j in range(k):
            begins = texts.offsets[:-1][lengths > j] + j
            before[begins] = pad
        out.append(before)
    return out


def gram_counts(rows: DataFrame) -> DataFrame:
    """(lang, gram, n): ORDER bytes of context and the byte after them, as one number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for lang in sorted(set(langs)):
                for texts in slices(batch.column("text").filter(pa.array(langs == lang))):
                    if not len(texts.data):
                        continue
                    key = texts.data.astype(np.int64)
                    for k, before in enumerate(previous(texts, texts.data, PAD), 1):
                        key += before.astype(np.int64) << (8 * k)
                    grams, n = np.unique(key, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n)], ["lang", "gram", "n"]
                    )

    counted = rows.select("lang", "text").mapInArrow(run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def training_sample(documents: DataFrame, per_language: int = SAMPLE) -> DataFrame:
    """Labelled documents whose checksum lies below the share that gives ``per_language`` of each language."""
    usable = F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT)
    labelled = documents.where(usable)
    share = F.lit(float(per_language)) / F.count(F.lit(1))
    shares = cut_lineage(labelled.groupBy("lang").agg(share.alias("share")))
    draw = F.crc32(F.concat(F.lit("sample:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    return labelled.select("doc_id", "lang", "text").join(shares, "lang").where(draw < F.col("share") * 2.0**32)


@dataclass
class Model:
    """Languages, the symbol of each byte, and per language context -> node and (node, symbol) -> bits."""

    languages: list[str]
    symbols: np.ndarray
    nodes: list[np.ndarray]
    bits: list[np.ndarray]

    @property
    def width(self) -> int:
        return self.bits[0].shape[1]


def context_tree(grams: np.ndarray, n: np.ndarray, symbols: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Node of every context and the code lengths at every node."""
    digits = [symbols[(grams >> (8 * k)) & 0xFF].astype(np.int64) for k in range(ORDER + 1)]
    node = np.zeros(width**ORDER, np.int32)
    rows = []
    shape = (width,) * ORDER
    shorter_nodes, shorter = np.zeros(1, np.int64), np.full((1, width), 1.0 / width)
    made = 0
    for order in range(ORDER + 1):
        context = np.zeros(len(grams), np.int64)
        for k in range(order, 0, -1):
            context = context * width + digits[k]
        seen, where = np.unique(context, return_inverse=True)
        counts = np.zeros((len(seen), width))
        np.add.at(counts, (where, digits[0]), n)
        total, kinds = counts.sum(1, keepdims=True), (counts > 0).sum(1, keepdims=True)
        parent = shorter[shorter_nodes[seen % width ** max(0, order - 1)]] if order else np.broadcast_to(shorter, counts.shape)
        left = np.where(counts > 0, 0.0, parent)
        spare = left.sum(1, keepdims=True)
        escape = np.where(spare > 0, kinds / (total + kinds), 0.0)
        known = counts / np.where(spare > 0, total + kinds, total)
        chance = np.where(counts > 0, known, escape * left / np.where(spare > 0, spare, 1.0))
        shorter_nodes = np.zeros(width**order, np.int64)
        shorter_nodes[seen] = np.arange(len(seen))
        shorter = chance
        rows.append(-np.log2(np.maximum(chance, 1e-300)))
        # contexts that end in one of these have it as their longest known ending so far
        view = node.reshape(-1, width**order)
        view[:, seen] = made + np.arange(len(seen), dtype=np.int32)
        made += len(seen)
    assert shape and node.max() < made
    return node, np.concatenate(rows).astype(np.float32)


def fit(documents: DataFrame, per_language: int = SAMPLE) -> Model:
    table = gram_counts(training_sample(documents, per_language)).toPandas()
    languages = sorted(table["lang"].unique())
    used = np.unique((table["gram"].to_numpy() & 0xFF).astype(np.int64)) if len(table) else np.zeros(0, np.int64)
    used = np.union1d(used, [PAD])
    symbols = np.full(256, len(used), np.uint8)
    symbols[used] = np.arange(len(used))
    width = len(used) + 1
    nodes, bits = [], []
    for lang in languages:
        mine = table[table["lang"] == lang]
        node, cost = context_tree(mine["gram"].to_numpy(), mine["n"].to_numpy(), symbols, width)
        nodes.append(node)
        bits.append(cost)
    return Model(languages, symbols, nodes, bits)


def code_lengths(texts: Texts, model: Model) -> np.ndarray:
    """Bits of every text under every language."""
    out = np.zeros((len(texts), len(model.languages)))
    if not len(texts.data):
        return out
    symbols, width = model.symbols[texts.data], model.width
    context = np.zeros(len(symbols), np.int32)
    for k, before in reversed(list(enumerate(previous(texts, symbols, int(model.symbols[PAD])), 1))):
        context = context * width + before
    full = np.diff(texts.offsets) > 0
    begins = texts.offsets[:-1][full]
    for i, (node, bits) in enumerate(zip(model.nodes, model.bits, strict=True)):
        cost = bits.ravel()[node[context].astype(np.int64) * width + symbols]
        out[full, i] = np.add.reduceat(cost, begins, dtype=np.float64)
    return out


ASCII_LETTER = np.array([chr(b).isalpha() and b < 128 for b in range(256)])


def with_letter(texts: Texts) -> np.ndarray:
    seen = np.concatenate([[0], np.cumsum(ASCII_LETTER[texts.data])])
    out = seen[texts.offsets[1:]] > seen[texts.offsets[:-1]]
    for i in np.flatnonzero(~out):
        raw = texts.data[texts.offsets[i] : texts.offsets[i + 1]].tobytes()
        out[i] = any(c.isalpha() for c in raw.decode("utf-8", "replace"))
    return out


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            best, scores = [], []
            for texts in slices(batch.column("text"), SLICE_BYTES):
                known = with_letter(texts) if model.languages else np.zeros(len(texts), bool)
                if not known.any():
                    best += [UNKNOWN] * len(texts)
                    scores.append(np.zeros(len(texts)))
                    continue
                bits = code_lengths(texts, model)
                first = bits.argmin(1)
                ahead = bits[np.arange(len(bits)), first][:, None] - bits
                scores.append(np.where(known, 1.0 / np.exp2(np.maximum(ahead, -1000.0)).sum(1), 0.0))
                best += [model.languages[j] if ok else UNKNOWN for j, ok in zip(first, known, strict=True)]
            score = pa.array(np.concatenate(scores) if scores else np.zeros(0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(best, pa.string()), score],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    held_out = (fold(F.col("doc_id")) == HELD_OUT).alias("held_out")
    return documents.select("doc_id", held_out, "text").mapInArrow(run, RESULT)


def op5_language(spark, sf_dir) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return predict(documents, fit(documents))

"""Context-triggered piecewise hashing of documents (operator 11).

A rolling hash over the last seven bytes decides where a chunk ends, so an
insertion moves the boundaries near it and no others. A chunk becomes a symbol of
12 bits; the symbols at block size b and at 2b are a text's fingerprint
``b:symbols:symbols``. A boundary at 2b is one at b too. Two fingerprints compare
where their block sizes meet, by the edit distance of the symbols (insertions and
deletions cost 1, a change is one of each), as a likeness from 0 to 1.

The block size follows the length (64 chunks at most are expected). It is halved
up to three times where the content gives too few boundaries, and doubled where
it gives too many, so signatures stay bounded whatever the text. Texts are
hashed in segments of bounded size; memory follows the longest text.

* A null text is empty. An empty text has no symbols; it is like another empty
  one (1.0) and unlike any other (0.0).
* ``compare_edited`` orders rows by doc_id descending, null ids last, then by
  ``xxhash64`` of the text and the text. Equal rows may stand for one another, so
  ties change no result. The row after the last is the first; a single row is its
  own next.
* Equal ids or texts are spread over partitions by row, so neither a repeated
  id nor a group of copies lands in one task. Empty tables give no rows.
* Only doc_id and text are read; other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.words import Texts, constants, mix, powers, slices
from ledgerlens.session import cut_lineage

#: Bytes that the rolling hash sees.
REACH = 7
SMALLEST_BLOCK = 4
#: Chunks that the block size aims at, at most; fewest before it is halved; most before it is doubled.
EXPECTED, FEWEST, MOST = 64, 16, 128
HALVINGS = 3
LEVELS = 40
SEGMENT = 1 << 20
DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
SYMBOLS = np.array([a + b for a in DIGITS for b in DIGITS])

ROLLING = constants(110_001, 256)
CHUNK = constants(110_002, 256)
STEP, ROOT = (int(x) | 1 for x in constants(110_003, 2))
UNROOT = pow(ROOT, -1, 2**64)
#: A position is a boundary of level k (block size 4 * 2^k) if its rolling hash reaches this value.
BOUNDS = np.array([2**64 - 2**64 // (SMALLEST_BLOCK << k) for k in range(LEVELS)], np.uint64)
LEADING = np.array([(b & 0xC0) != 0x80 for b in range(256)])


@dataclass
class Cuts:
    """Boundaries of consecutive texts (byte after each), their level, and running hashes at them."""

    ends: np.ndarray
    level: np.ndarray
    sums: np.ndarray
    text_sums: np.ndarray


class Powers:
    """Powers of the chunk hash's base and of its inverse, up to any exponent."""

    def __init__(self) -> None:
        self.up, self.down = powers(ROOT, SEGMENT), powers(UNROOT, SEGMENT)

    def shifts(self, places: np.ndarray) -> np.ndarray:
        """Inverse of the base to the power of each place."""
        far = int(places.max(initial=0)) // SEGMENT
        return self.down[places % SEGMENT] * powers(pow(UNROOT, SEGMENT, 2**64), far + 1)[places // SEGMENT]


def first_level(length: np.ndarray) -> np.ndarray:
    """Smallest level at which a text of so many bytes gives 64 chunks or fewer on average."""
    blocks = np.maximum(length, 1) / (EXPECTED * SMALLEST_BLOCK)
    return np.maximum(np.ceil(np.log2(blocks)), 0).astype(np.int64)


def rolling(data: np.ndarray) -> np.ndarray:
    """Hash of each position's last seven bytes (fewer at the start of ``data``)."""
    values = ROLLING[data]
    out = values.copy()
    scale = 1
    for back in range(1, min(REACH, len(data))):
        scale = scale * STEP % 2**64
        out[back:] += values[:-back] * np.uint64(scale)
    return mix(out)


def cut(texts: Texts, table: Powers) -> Cuts:
    """Every boundary at or above the lowest level that a text may use.

    A text's first six bytes end no chunk, as the rolling hash would see the text before.
    """
    lengths = np.diff(texts.offsets)
    lowest = BOUNDS[np.maximum(first_level(lengths) - HALVINGS, 0)]
    ends, hashes, sums = [], [], []
    text_sums = np.zeros(len(texts.offsets), np.uint64)
    total, scale = np.uint64(0), 1
    for begin in range(0, len(texts.data), SEGMENT):
        stop = min(begin + SEGMENT, len(texts.data))
        seen = min(begin, REACH - 1)
        rolled = rolling(texts.data[begin - seen : stop])[seen:]
        running = CHUNK[texts.data[begin:stop]] * (table.up[: stop - begin] * np.uint64(scale))
        running = np.cumsum(running, dtype=np.uint64) + total
        total, scale = running[-1], scale * pow(ROOT, stop - begin, 2**64) % 2**64
        first = np.searchsorted(texts.offsets, begin, side="right") - 1
        last = np.searchsorted(texts.offsets, stop, side="left")
        covered = np.minimum(texts.offsets[first + 1 : last + 1], stop) - np.maximum(texts.offsets[first:last], begin)
        found = np.flatnonzero(rolled >= np.repeat(lowest[first:last], covered))
        own = texts.offsets[np.searchsorted(texts.offsets, found + begin, side="right") - 1]
        found = found[found + begin - own >= REACH - 1]
        ends.append(found + begin + 1)
        hashes.append(rolled[found])
        sums.append(running[found])
        inside = np.flatnonzero((texts.offsets > begin) & (texts.offsets <= stop))
        text_sums[inside] = running[texts.offsets[inside] - begin - 1]
    if not ends:
        return Cuts(*(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64)), text_sums)
    level = np.searchsorted(BOUNDS, np.concatenate(hashes), side="right") - 1
    return Cuts(np.concatenate(ends), level, np.concatenate(sums), text_sums)


def chosen_level(counts: np.ndarray, start: int) -> int:
    """Level for a text with ``counts[k]`` boundaries at level k or above."""
    level = start
    while level > max(0, start - HALVINGS) and counts[level] < FEWEST and counts[level - 1] <= MOST:
        level -= 1
    while level < LEVELS - 2 and counts[level] > MOST:
        level += 1
    return level


def symbols(ends: np.ndarray, sums: np.ndarray, edges: tuple, table: Powers) -> str:
    """Symbols of the chunks of a text cut at ``ends``; ``edges``: its begin and end, each with the hash so far."""
    begin, before, end, after = edges
    if end == begin:
        return ""
    if not len(ends) or ends[-1] != end:
        ends, sums = np.append(ends, end), np.append(sums, after)
    starts = np.concatenate([[begin], ends[:-1]])
    inner = sums - np.concatenate([np.array([before], np.uint64), sums[:-1]])
    hashes = mix(inner * table.shifts(starts) + (ends - starts).astype(np.uint64))
    return "".join(SYMBOLS[(hashes >> np.uint64(52)).astype(np.int64)].tolist())


def fingerprints(texts: Texts, table: Powers) -> list[str]:
    """Fingerprint of each text."""
    cuts = cut(texts, table)
    lengths = np.diff(texts.offsets)
    starts_at = first_level(lengths)
    bounds = np.searchsorted(cuts.ends, texts.offsets, side="right")
    out = []
    for i in range(len(texts)):
        low, high = bounds[i], bounds[i + 1]
        ends, level, sums = cuts.ends[low:high], cuts.level[low:high], cuts.sums[low:high]
        counts = np.cumsum(np.bincount(level, minlength=LEVELS)[::-1])[::-1]
        chosen = chosen_level(counts, int(starts_at[i]))
        edges = (int(texts.offsets[i]), cuts.text_sums[i], int(texts.offsets[i + 1]), cuts.text_sums[i + 1])
        one, two = (symbols(ends[level >= k], sums[level >= k], edges, table) for k in (chosen, chosen + 1))
        out.append(f"{SMALLEST_BLOCK << chosen}:{one}:{two}")
    return out


def parsed(fingerprint: str) -> tuple[int, list[str], list[str]]:
    block, one, two = fingerprint.split(":")
    pairs = lambda s: [s[i : i + 2] for i in range(0, len(s), 2)]
    return int(block), pairs(one), pairs(two)


def common(x: list[str], y: list[str]) -> int:
    """Length of the longest common subsequence, a row of the table at a time as bits of one number."""
    places: dict[str, int] = {}
    for i, symbol in enumerate(x):
        places[symbol] = places.get(symbol, 0) | 1 << i
    row = full = (1 << len(x)) - 1
    for symbol in y:
        here = row & places.get(symbol, 0)
        row = (row + here | row - here) & full
    return len(x) - row.bit_count()


def alike(x: list[str], y: list[str]) -> float:
    """1 - edit distance / both lengths."""
    return 2 * common(x, y) / (len(x) + len(y)) if x or y else 1.0


def likeness(a: str, b: str) -> float:
    """0 to 1 at the block size that both have, 0 where they have none; the larger where they have two."""
    if a == b:
        return 1.0
    (size_a, *parts_a), (size_b, *parts_b) = parsed(a), parsed(b)
    if not (parts_a[0] and parts_b[0]):
        return 0.0
    if size_a == size_b:
        return max(map(alike, parts_a, parts_b))
    if size_a == 2 * size_b:
        return alike(parts_a[0], parts_b[1])
    if size_b == 2 * size_a:
        return alike(parts_a[1], parts_b[0])
    return 0.0


def likeness_of(a: Column, b: Column) -> Column:
    """``likeness`` of two columns of fingerprints; null where one is null."""

    @F.pandas_udf("double")
    def rated(x: pd.Series, y: pd.Series) -> pd.Series:
        known = x.notna() & y.notna()
        return pd.Series([likeness(p, q) if k else None for p, q, k in zip(x, y, known, strict=True)], dtype="float64")

    return rated(a, b)


def fingerprinted(documents: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Powers()
        for batch in batches:
            prints = [p for texts in slices(batch.column("text")) for p in fingerprints(texts, table)]
            if prints:
                ids = batch.column("doc_id").cast(pa.int64())
                yield pa.RecordBatch.from_arrays([ids, pa.array(prints, pa.string())], ["doc_id", "fingerprint"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, fingerprint string")


@dataclass
class Item:
    """A document on its way past its successor."""

    doc_id: int | None
    text: bytes
    n_chars: int
    fingerprint: str


def head_bytes(text: bytes, chars: int, n_chars: int) -> bytes:
    """The first ``chars`` code points (all, if there are fewer)."""
    if chars >= n_chars:
        return text
    leading = np.flatnonzero(LEADING[np.frombuffer(text, np.uint8)])
    return text[: int(leading[chars])]


def edited(item: Item, following: Item) -> bytes:
    """The text with its last third replaced by the start of the following one."""
    third = item.n_chars // 3
    return head_bytes(item.text, item.n_chars - third, item.n_chars) + head_bytes(
        following.text, third, following.n_chars
    )


def items(batch: pa.RecordBatch, table: Powers) -> Iterator[list[Item]]:
    ids = batch.column("doc_id").to_pylist()
    for texts in slices(batch.column("text")):
        chars = np.concatenate([[0], np.cumsum(LEADING[texts.data], dtype=np.int64)])[texts.offsets]
        raw, at = texts.data.tobytes(), texts.offsets.tolist()
        yield [
            Item(ids[texts.first + i], raw[at[i] : at[i + 1]], int(chars[i + 1] - chars[i]), p)
            for i, p in enumerate(fingerprints(texts, table))
        ]


COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
COMPARED_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
     ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)


def compared(chain: list[Item], table: Powers) -> pa.RecordBatch:
    """Rows of all but the last item, each compared with the one after it."""
    changed = [edited(item, after) for item, after in zip(chain, chain[1:])]
    prints = [p for texts in slices(pa.array(changed, pa.large_binary())) for p in fingerprints(texts, table)]
    rows = zip(chain, chain[1:], changed, prints)
    columns = zip(
        *(
            (x.doc_id, x.n_chars, hashlib.sha256(text).hexdigest(), x.fingerprint, p,
             likeness(x.fingerprint, p), likeness(x.fingerprint, after.fingerprint))
            for x, after, text, p in rows
        )
    )
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, COMPARED_ARROW)], schema=COMPARED_ARROW)


EDGE = "part int, place string, edge_n_chars long, edge_text binary, "
EDGE_ARROW = pa.schema(
    [("part", pa.int32()), ("place", pa.string()), ("edge_n_chars", pa.int64()), ("edge_text", pa.binary()), *COMPARED_ARROW]
)


def edge(part: int, place: str, item: Item) -> pa.RecordBatch:
    row = {
        "part": part, "place": place, "edge_n_chars": item.n_chars, "edge_text": item.text,
        "doc_id": item.doc_id, "n_chars": item.n_chars, "fingerprint": item.fingerprint,
    }
    return pa.RecordBatch.from_arrays([pa.array([row.get(f.name)], f.type) for f in EDGE_ARROW], schema=EDGE_ARROW)


def in_order(documents: DataFrame) -> DataFrame:
    """Rows sorted over all partitions; equal ids and equal texts still spread by row."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumns({"order": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    order = [F.desc_nulls_last("doc_id"), F.asc("order"), F.asc("text"), F.asc("row")]
    return rows.repartitionByRange(*order[:2], order[3]).sortWithinPartitions(*order).select("doc_id", "text")


def within_parts(documents: DataFrame) -> DataFrame:
    """Comparisons inside each sorted partition, with its first and last document as ``edge`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, table = TaskContext.get().partitionId(), None, Powers()
        for batch in batches:
            for some in items(batch, table):
                if last is None:
                    yield edge(part, "first", some[0])
                chain = some if last is None else [last, *some]
                last = chain[-1]
                if len(chain) > 1:
                    done = compared(chain, table)
                    blank = [pa.array([part] * len(done), pa.int32()), *(pa.nulls(len(done), f.type) for f in list(EDGE_ARROW)[1:4])]
                    yield pa.RecordBatch.from_arrays([*blank, *done.columns], schema=EDGE_ARROW)
        if last is not None:
            yield edge(part, "last", last)

    return in_order(documents).mapInArrow(run, EDGE + COMPARED)


def compare_edited(documents: DataFrame) -> DataFrame:
    """Each row with its fingerprint, that of its text edited with the next row, and both likenesses.

    The texts cross the network once. Only the last row of a partition needs the
    next partition; these rows, two a partition, are joined afterwards.
    """
    stored = cut_lineage(within_parts(documents))
    names = COMPARED_ARROW.names
    first, last = (stored.where(F.col("place") == place) for place in ("first", "last"))
    # One row of two numbers per partition of the shuffle.
    everywhere = Window.orderBy("part")
    follows = first.select("part").select(
        "part",
        F.coalesce(
            F.lead("part").over(everywhere),
            F.min("part").over(everywhere.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        ).alias("next"),
    )
    after = first.select(
        F.col("part").alias("next"), F.col("edge_text").alias("next_text"),
        F.col("edge_n_chars").alias("next_chars"), F.col("fingerprint").alias("next_print"),
    )
    pairs = last.join(follows, "part").join(after, "next").select(
        "doc_id", "n_chars", "fingerprint", "edge_text", "next_text", "next_chars", "next_print"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Powers()
        for batch in batches:
            for row in batch.to_pylist():
                item = Item(row["doc_id"], row["edge_text"], row["n_chars"], row["fingerprint"])
                following = Item(None, row["next_text"], row["next_chars"], row["next_print"])
                yield compared([item, following], table)

    inner = stored.where(F.col("place").isNull()).select(*names)
    return inner.unionByName(pairs.mapInArrow(run, COMPARED))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edited(spark.read.parquet(f"{sf_dir}/documents.parquet"))

"""Phrases whose words keep together, from an FM-index per shard (operator 13).

Texts of one language are cut into shards of bounded size. Their words are
numbered, and an FM-index over the numbers gives all n-grams with their counts by
extending intervals word by word, to the left and to the right. Counts are summed
over the shards. Shards are read three times, and each pass keeps only what can
still be frequent, so rare n-grams never leave their shard:

1. words and their counts; words of fewer than ``least`` occurrences cut the sequence;
2. pairs of the words left; rarer pairs cut the sequence;
3. what is left is extended to n-grams of three and of four words.

Words and n-grams are compared as such, never by hash. A word's number over all
shards is its place in the first shard that has it. N-grams travel sorted and packed, a row
per shard and bucket of their hash; a bucket's counts are summed in one group, and there are
as many buckets as shuffle partitions.

An n-gram lies in a longer one of nearly its count only if an n-gram of one word
more does, as counts never grow with length; so the largest count among its left
and right extensions decides whether it is dropped.

* A null text is empty; a null language is ``und``. Texts without words give nothing.
* Every occurrence counts, in repeated rows too. Ties end with the phrase's bytes.
* Shards hold ``shard_bytes`` of words; a text is never split, so memory follows
  the longest text. No group is larger than a shard, a bucket's n-grams, or one row per shard.
* An empty table gives no rows. Columns other than text and lang are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.bpe import expand_numbers, squeeze_numbers
from ledgerlens.llm.fmindex import BiIndex
from ledgerlens.llm.stored import bucketed, expand, squeeze
from ledgerlens.llm.words import Texts, constants, mix, slices
from ledgerlens.session import cut_lineage

LEAST = 30
MOST = 2000
#: An n-gram goes if one that holds it has at least 4 of 5 of its count.
PART, WHOLE = 4, 5
SHARD_BYTES = 16 << 20
#: Shards' worth of words that wait in a task, of all languages.
WAITING = 3
#: Bits of a word's place in its shard and of a shard's number in its partition.
PLACE_BITS, SHARD_BITS, PART_BITS = 28, 14, 21


def table_of(values: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


#: Bytes that end a piece, and bytes that end a word.
BREAK = table_of(b".,;:!?\n\v\f\r")
GAP = BREAK | table_of(b" \t")
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def cut_words(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case bytes of all words end to end, their lengths, which begin a piece, and each one's text."""
    n = len(texts.data)
    inside = ~GAP[texts.data]
    edge = np.zeros(n + 1, bool)
    edge[texts.offsets] = True
    starts = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]])))
    ends = np.flatnonzero(inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
    text_no = np.searchsorted(texts.offsets, starts, side="right") - 1
    breaks = np.concatenate([[0], np.cumsum(BREAK[texts.data], dtype=np.int64)])
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (breaks[starts[1:]] > breaks[ends[:-1]]) | (text_no[1:] != text_no[:-1])
    return LOWER[texts.data[inside]], ends - starts, fresh, text_no


class Shard:
    """Words of one language that wait for their shard to fill."""

    def __init__(self) -> None:
        self.size, self.parts = 0, []

    def add(self, data: np.ndarray, lengths: np.ndarray, fresh: np.ndarray) -> None:
        self.parts.append((data, lengths, fresh))
        self.size += len(data) + 5 * len(lengths)

    def numbered(self) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """The sequence of word numbers, commonest first, 0 between pieces and at the end; counts; words."""
        data, lengths, fresh = (np.concatenate(x) for x in zip(*self.parts))
        offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
        ).dictionary_encode()
        numbers = words.indices.to_numpy()
        counts = np.bincount(numbers, minlength=len(words.dictionary))
        common = np.argsort(-counts, kind="stable")
        place = np.empty(len(common), np.int64)
        place[common] = np.arange(1, len(common) + 1)
        sequence = np.zeros(len(numbers) + int(fresh.sum()) + 1, np.uint32)
        sequence[np.arange(len(numbers)) + np.cumsum(fresh)] = place[numbers]
        return sequence, counts[common], words.dictionary.take(pa.array(common)).cast(pa.large_string()).cast(pa.string())


SHARDS = "shard long, lang string, place int, word string, count long, packed binary"
SHARDS_ARROW = pa.schema(
    [("shard", pa.int64()), ("lang", pa.string()), ("place", pa.int32()), ("word", pa.string()),
     ("count", pa.int64()), ("packed", pa.binary())]
)


def shard_rows(shard: int, lang: str, full: Shard) -> Iterator[pa.RecordBatch]:
    """Place 0: the sequence and how many words it has. Other places: the shard's words and their counts."""
    sequence, counts, words = full.numbered()
    if len(counts) >= 1 << PLACE_BITS:
        raise ValueError("a shard has too many words; a text is too long")
    for first in range(0, len(counts), 1 << 16):
        some = slice(first, min(first + (1 << 16), len(counts)))
        n = some.stop - first
        columns = [np.full(n, shard), [lang] * n, np.arange(first + 1, some.stop + 1), words[some], counts[some], [None] * n]
        yield batch_of(columns, SHARDS_ARROW)
    yield batch_of([[shard], [lang], [0], [None], [int(counts.sum())], [squeeze_numbers(sequence)]], SHARDS_ARROW)


def batch_of(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def shards_of(documents: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Texts as shards of word numbers with their words; see ``SHARDS``."""
    rows = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, step = TaskContext.get().partitionId(), 0
        open_shards: dict[str, Shard] = {}

        def closed(lang: str) -> Iterator[pa.RecordBatch]:
            nonlocal step
            if step >= 1 << SHARD_BITS or part >= 1 << PART_BITS:
                raise ValueError("too many shards; read the table in smaller partitions, or in larger shards")
            yield from shard_rows((part << SHARD_BITS) + step, lang, open_shards.pop(lang))
            step += 1

        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for texts in slices(batch.column("text")):
                data, lengths, fresh, text_no = cut_words(texts)
                byte_ends = np.concatenate([[0], np.cumsum(lengths)])
                of_text = np.searchsorted(text_no, np.arange(len(texts) + 1))
                for i in range(len(texts)):
                    low, high = of_text[i], of_text[i + 1]
                    if low == high:
                        continue
                    lang = langs[texts.first + i]
                    shard = open_shards.setdefault(lang, Shard())
                    shard.add(data[byte_ends[low] : byte_ends[high]].copy(), lengths[low:high].astype(np.int32), fresh[low:high])
                    if shard.size >= shard_bytes:
                        yield from closed(lang)
                while sum(s.size for s in open_shards.values()) > WAITING * shard_bytes:
                    yield from closed(max(open_shards, key=lambda x: open_shards[x].size))
        for lang in list(open_shards):
            yield from closed(lang)

    return rows.mapInArrow(run, SHARDS)


def low_bits(name: str) -> Column:
    """What follows the shard's number."""
    return F.col(name).bitwiseAND((1 << PLACE_BITS) - 1)


def frequent_words(shards: DataFrame, least: int) -> DataFrame:
    """(shard, place, id, total, own, lang, word) of the words with ``least`` occurrences over all shards of a language."""
    same = Window.partitionBy("lang", "word")
    here = (F.shiftleft("shard", PLACE_BITS) + F.col("place")).alias("here")
    rows = shards.where("place > 0").select(here, "lang", "word", "count")
    rows = rows.select("*", F.sum("count").over(same).alias("total"), F.min("here").over(same).alias("id"))
    is_own = F.col("here") == F.col("id")
    return rows.where(F.col("total") >= least).select(
        F.shiftright("here", PLACE_BITS).alias("shard"),
        low_bits("here").cast("int").alias("place"),
        "id", "total", is_own.alias("own"), "lang", F.when(is_own, F.col("word")).alias("word"),
    )


class Sequence:
    """A shard's sequence cut at rare words; words are renumbered from 1, with their ids."""

    def __init__(self, packed: bytes, place: np.ndarray, ids: np.ndarray):
        order = np.argsort(place)
        self.ids = ids[order]
        self.n_words = len(place) + 1
        sequence = expand_numbers(packed)
        number = np.zeros(max(int(sequence.max(initial=0)), int(place.max(initial=0))) + 1, np.int32)
        number[place[order]] = np.arange(1, self.n_words)
        sequence = number[sequence]
        before = np.concatenate([[0], sequence[:-1]])
        self.words = np.append(sequence[(sequence > 0) | (before > 0)], 0).astype(np.int32)

    def keys(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return first.astype(np.int64) * self.n_words + second

    def numbers_of(self, ids: np.ndarray) -> np.ndarray:
        order = np.argsort(self.ids)
        return order[np.searchsorted(self.ids, ids, sorter=order)] + 1

    def cut_between(self, frequent: np.ndarray) -> np.ndarray:
        """The sequence with a separator between two words whose pair is not among the sorted ``frequent`` keys."""
        keys = self.keys(self.words[:-1], self.words[1:])
        at = np.minimum(np.searchsorted(frequent, keys), max(len(frequent) - 1, 0))
        joined = frequent[at] == keys if len(frequent) else np.zeros(len(keys), bool)
        joined &= (self.words[:-1] > 0) & (self.words[1:] > 0)
        after, before = np.append(joined, False), np.concatenate([[False], joined])
        kept = np.flatnonzero(after | before)
        out = np.zeros(len(kept) + int((~before[kept]).sum()) + 1, np.int32)
        out[np.arange(len(kept)) + np.cumsum(~before[kept])] = self.words[kept]
        return out


def sequence_of(shard: pa.Table, words: pa.Table) -> Sequence | None:
    """The one sequence of a shard, cut at all but its frequent ``words``; none where it has no such word."""
    if not len(shard) or not len(words):
        return None
    packed = shard.column("packed")[0].as_py()
    return Sequence(packed, *(words.column(c).to_numpy() for c in ("place", "id")))


PACKED = "bucket int, shard long, n int, packed binary"
PACKED_ARROW = pa.schema([("bucket", pa.int32()), ("shard", pa.int64()), ("n", pa.int32()), ("packed", pa.binary())])
MIXERS = [int(x) | 1 for x in constants(13_013, 4)]


def squeeze_rows(keys: list[np.ndarray], counts: np.ndarray) -> bytes:
    """Sorted keys of several columns and a number each: a column holds steps where those before it stay the same."""
    same, columns = np.ones(len(counts), bool), []
    same[:1] = False
    for key in keys:
        step = np.diff(key, prepend=0)
        columns.append(np.where(same, step, key))
        same &= step == 0
    planes = np.stack([*columns, counts]).astype("<i8").view(np.uint8).reshape(len(keys) + 1, -1, 8)
    return squeeze(planes.transpose(0, 2, 1).tobytes())


def expand_rows(packed: bytes, n: int) -> list[np.ndarray]:
    """The key columns and the numbers of ``squeeze_rows``."""
    planes = np.frombuffer(expand(packed), np.uint8).reshape(-1, 8, n)
    *columns, counts = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<i8").reshape(-1, n)
    same, keys = np.ones(n, bool), []
    same[:1] = False
    for column in columns:
        sums, begins = np.cumsum(column), np.flatnonzero(~same)
        lengths = np.diff(begins, append=n)
        key = sums - np.repeat(sums[begins] - column[begins], lengths)
        keys.append(key)
        same &= np.diff(key, prepend=0) == 0
    return [*keys, counts]


def dealt(keys: list[np.ndarray], counts: np.ndarray, shard: int, buckets: int) -> pa.Table:
    """Distinct n-grams of a shard, a row per bucket of their hash; see ``PACKED``."""
    if not len(counts):
        return PACKED_ARROW.empty_table()
    hashes = np.zeros(len(counts), np.uint64)
    for key, mixer in zip(keys, MIXERS, strict=False):
        hashes = mix(hashes + key.astype(np.uint64) * np.uint64(mixer))
    bucket = (hashes % np.uint64(buckets)).astype(np.int32)
    order = np.lexsort((*keys[::-1], bucket))
    keys, counts, bucket = [k[order] for k in keys], counts[order], bucket[order]
    begins = np.flatnonzero(np.diff(bucket, prepend=-1))
    rows = [
        (int(bucket[i]), shard, int(j - i), squeeze_rows([k[i:j] for k in keys], counts[i:j]))
        for i, j in zip(begins, np.append(begins, len(bucket))[1:], strict=True)
    ]
    return pa.Table.from_batches([batch_of(list(zip(*rows, strict=True)), PACKED_ARROW)])


def summed(rows: pa.Table, least: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """N-grams of a bucket with ``least`` occurrences over all shards: key columns, shards, totals, and which is the first of equals.

    There is an entry per n-gram and shard.
    """
    sizes = rows.column("n").to_pylist()
    parts = [expand_rows(p, n) for p, n in zip(rows.column("packed").to_pylist(), sizes, strict=True)]
    *keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    shards = np.repeat(rows.column("shard").to_numpy(), sizes)
    del parts
    order = np.lexsort((shards, *keys[::-1]))
    keys = [k[order] for k in keys]
    fresh = np.ones(len(order), bool)
    fresh[1:] = reduce(np.logical_or, [k[1:] != k[:-1] for k in keys])
    begins = np.flatnonzero(fresh)
    totals = np.repeat(np.add.reduceat(counts[order], begins), np.diff(begins, append=len(order)))
    kept = totals >= least
    return [k[kept] for k in keys], shards[order][kept], totals[kept], fresh[kept]


def pairs_of(sequences: DataFrame, words: DataFrame, buckets: int) -> DataFrame:
    """Pairs of frequent words in every shard, packed by bucket: single rows would be most of what moves."""

    def run(shard: pa.Table, words: pa.Table) -> pa.Table:
        sequence = sequence_of(shard, words)
        if sequence is None:
            return PACKED_ARROW.empty_table()
        index = BiIndex(sequence.words, sequence.n_words, 2)
        found = index.left(index.words())
        return dealt([sequence.ids[w - 1] for w in found.words.T], found.count, shard.column("shard")[0].as_py(), buckets)

    known = words.select("shard", "place", "id").groupBy("shard")
    return sequences.groupBy("shard").cogroup(known).applyInArrow(run, PACKED)


PAIRS = "shard long, n int, packed binary, g1 long, g2 long, total long"
PAIRS_ARROW = pa.schema(
    [("shard", pa.int64()), ("n", pa.int32()), ("packed", pa.binary()),
     ("g1", pa.int64()), ("g2", pa.int64()), ("total", pa.int64())]
)


def frequent_pairs(pairs: DataFrame, least: int) -> DataFrame:
    """Pairs with ``least`` occurrences over all shards: (g1, g2, total) of each, and (shard, n, packed) for the shards that hold them."""

    def run(rows: pa.Table) -> pa.Table:
        keys, shards, totals, first = summed(rows, least)
        own = [*(k[first] for k in keys), totals[first]]
        parts = [pa.table(dict(zip(["g1", "g2", "total"], own, strict=True)))]
        order = np.argsort(shards, kind="stable")
        shards, totals, keys = shards[order], totals[order], [k[order] for k in keys]
        begins = np.flatnonzero(np.diff(shards, prepend=-1))
        held = [
            {"shard": int(shards[i]), "n": int(j - i), "packed": squeeze_rows([k[i:j] for k in keys], totals[i:j])}
            for i, j in zip(begins, np.append(begins, len(shards))[1:], strict=True)
        ]
        parts.append(pa.Table.from_pylist(held, PAIRS_ARROW))
        return pa.concat_tables(parts, promote_options="default").select(PAIRS_ARROW.names)

    return pairs.groupBy("bucket").applyInArrow(run, PAIRS)


GRAMS = ["g1", "g2", "g3", "g4"]


def longer_of(sequences: DataFrame, words: DataFrame, pairs: DataFrame, buckets: int) -> DataFrame:
    """N-grams of three (the fourth word is 0) and four words in every shard, made of frequent pairs, packed by bucket."""
    held = pairs.where("shard is not null").select("shard", "n", "packed")
    known = words.select("shard", "place", "id").unionByName(held, allowMissingColumns=True)

    def run(shard: pa.Table, known: pa.Table) -> pa.Table:
        is_word = known.column("place").is_valid()
        sequence = sequence_of(shard, known.filter(is_word))
        found = known.filter(known.column("place").is_null())
        if sequence is None or not len(found):
            return PACKED_ARROW.empty_table()
        found = [expand_rows(p, n) for p, n in zip(found.column("packed").to_pylist(), found.column("n").to_pylist(), strict=True)]
        first, second, _ = (np.concatenate(x) for x in zip(*found, strict=True))
        keys = sequence.keys(sequence.numbers_of(first), sequence.numbers_of(second))
        index = BiIndex(sequence.cut_between(np.sort(keys)), sequence.n_words, 4)
        three = index.right(index.left(index.words()))
        four = index.left(three)
        none = np.zeros(len(three.count), np.int64)
        ids = [[*(sequence.ids[w - 1] for w in three.words.T), none], [sequence.ids[w - 1] for w in four.words.T]]
        columns = [np.concatenate(x) for x in zip(*ids, strict=True)]
        return dealt(columns, np.concatenate([three.count, four.count]), shard.column("shard")[0].as_py(), buckets)

    return sequences.groupBy("shard").cogroup(known.groupBy("shard")).applyInArrow(run, PACKED)


def frequent_longer(longer: DataFrame, least: int) -> DataFrame:
    """(g1, g2, g3, g4, a) of the n-grams with ``least`` occurrences over all shards; g4 is null in those of three words."""

    def run(rows: pa.Table) -> pa.Table:
        keys, _, totals, first = summed(rows, least)
        *keys, last = (k[first] for k in keys)
        columns = [*keys, pa.array(last, mask=last == 0), totals[first]]
        return pa.table(dict(zip([*GRAMS, "a"], columns, strict=True)))

    return longer.groupBy("bucket").applyInArrow(run, ", ".join(f"{c} long" for c in [*GRAMS, "a"]))


def score(l: Column, r: Column) -> Column:  # noqa: E741
    """floor(2000000 a / (l + r)), exactly."""
    wide = "decimal(20,0)"
    l, r = l.cast(wide), r.cast(wide)  # noqa: E741
    return F.call_function("div", F.col("a").cast(wide) * F.lit(2_000_000).cast("decimal(7,0)"), l + r)


def lowest_cut(*cuts: tuple[Column, Column]) -> Column:
    """(score, k, l, r) of the cut with the lowest score, the smallest k of equals."""
    entries = [
        F.struct(score(l, r).alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r"))
        for k, (l, r) in enumerate(cuts, 1)
    ]
    return (F.least(*entries) if len(entries) > 1 else entries[0]).alias("cut")


def not_inside(grams: DataFrame, longer: DataFrame, n: int) -> DataFrame:
    """N-grams of ``n`` words without those that a longer one holds with nearly their count."""
    names = numbered(1, n)
    held = [
        longer.select(*[F.col(g).alias(name) for g, name in zip(numbered(first, n), names)], F.col("a").alias("around"))
        for first in (1, 2)
    ]
    largest = held[0].unionByName(held[1]).groupBy(*names).agg(F.max("around").alias("around"))
    joined = grams.join(largest, names, "left")
    return joined.where(F.col("around").isNull() | (F.col("around") * WHOLE < F.col("a") * PART)).drop("around")


def numbered(first: int, n: int) -> list[str]:
    return [f"g{i}" for i in range(first, first + n)]


def with_cut(grams: DataFrame, n: int, counts: dict[int, DataFrame]) -> DataFrame:
    """N-grams of ``n`` words as (ids, a, score, k, l, r); the counts of all their parts are joined."""
    for k in range(1, n):
        for side, first, size in (("l", 1, k), ("r", k + 1, n - k)):
            names = numbered(first, size)
            renamed = [F.col(own).alias(name) for own, name in zip(numbered(1, size), names)]
            grams = grams.join(counts[size].select(*renamed, F.col("a").alias(f"{side}{k}")), names)
    cut = lowest_cut(*[(F.col(f"l{k}"), F.col(f"r{k}")) for k in range(1, n)])
    return grams.select(F.array(*numbered(1, n)).alias("ids"), "a", cut).select("ids", "a", "cut.*")


def collocations(
    documents: DataFrame, least: int = LEAST, most: int = MOST, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``most`` phrases."""
    partitions = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # In buckets of the shard, the sequences stay where they are while words and pairs come to them.
    shards = bucketed(shards_of(documents, shard_bytes), partitions, "shard")
    sequences = shards.where("place = 0").select("shard", "packed")
    words = cut_lineage(frequent_words(shards, least))
    pairs = cut_lineage(frequent_pairs(pairs_of(sequences, words, partitions), least))
    longer = cut_lineage(frequent_longer(longer_of(sequences, words, pairs, partitions), least))

    known = words.where("own").select("id", "lang", "word", "total")
    one = known.select(F.col("id").alias("g1"), F.col("total").alias("a"))
    two = pairs.where("total is not null").select("g1", "g2", F.col("total").alias("a"))
    three, four = longer.where("g4 is null").drop("g4"), longer.where("g4 is not null")
    counts = {1: one, 2: two, 3: three}
    kept = {2: not_inside(two, three, 2), 3: not_inside(three, four, 3), 4: four}
    phrases = reduce(DataFrame.unionAll, [with_cut(grams, n, counts) for n, grams in kept.items()]).drop("k")
    langs = known.select(F.col("id").alias("first"), "lang")
    phrases = phrases.withColumn("first", F.col("ids")[0]).join(langs, "first").drop("first")

    # The first of every salt, then of all, ties included: no task ranks all phrases of a language.
    order = [F.desc("score"), F.desc("a")]
    phrases = phrases.withColumn("salt", F.pmod(F.hash("ids"), F.lit(partitions)))
    for group in (["lang", "salt"], ["lang"]):
        place = F.rank().over(Window.partitionBy(*group).orderBy(*order))
        phrases = phrases.withColumn("place", place).where(F.col("place") <= most).drop("place")

    spelled = (
        phrases.select("lang", "ids", "a", "l", "r", "score", F.posexplode("ids").alias("at", "id"))
        .join(known.select("id", "word"), "id")
        .groupBy("lang", "ids", "a", "l", "r", "score")
        .agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("spelled"))
        .withColumn("phrase", F.array_join(F.col("spelled.word"), " "))
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")).cast("long")
    sizes = shards.where("place = 0").groupBy("lang").agg(F.sum("count").alias("n"))
    first = spelled.withColumn("rank", rank).where(F.col("rank") <= most)
    return first.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents WHERE text IS NOT NULL),
p AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM t),
g AS (
  SELECT lang, k, list_slice(w, i, i + k - 1) AS g
  FROM (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM p), (VALUES (1), (2), (3), (4)) AS s(k)
  WHERE i + k - 1 <= len(w)),
f AS MATERIALIZED (SELECT lang, g, k, count(*) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT * FROM f WHERE k > 1 AND a >= 30),
inside AS (
  SELECT DISTINCT c.lang, c.g
  FROM (SELECT lang, k, a, unnest(generate_series(2, k - 1)) AS m, g FROM c) b,
    LATERAL (SELECT unnest(generate_series(1, b.k - b.m + 1)) AS i), c
  WHERE c.lang = b.lang AND c.k = b.m AND c.g = list_slice(b.g, i, i + b.m - 1) AND 100::HUGEINT * b.a >= 80::HUGEINT * c.a),
cut AS (
  SELECT c.lang, c.g, c.a, x.a AS l, y.a AS r, (2000000::HUGEINT * c.a // (x.a + y.a))::BIGINT AS score
  FROM (SELECT *, unnest(generate_series(1, k - 1)) AS m FROM c ANTI JOIN inside USING (lang, g)) c
  JOIN f x ON x.lang = c.lang AND x.g = list_slice(c.g, 1, c.m)
  JOIN f y ON y.lang = c.lang AND y.g = list_slice(c.g, c.m + 1, c.k)
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.g ORDER BY score, c.m) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank,
  array_to_string(g, ' ') AS phrase, a, l, r, n, score
FROM cut JOIN n USING (lang) QUALIFY rank <= 2000
"""

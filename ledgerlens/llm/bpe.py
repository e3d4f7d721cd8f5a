"""Byte-level BPE over distinct words (operator 8).

1. Every chunk of texts (the work of one task step) is cut into pre-tokens; the
   chunk's distinct pre-tokens get local numbers. Stored are each text's local
   numbers in order (the positions) and, per bucket of the word hash, the chunk's
   distinct words: a word crosses the network once per chunk, not per occurrence.
2. Buckets meet: each distinct word of the corpus is encoded once, and its ids go
   back to the chunks that asked.
3. Each chunk joins ids to positions, which gives every text's ids in order.

Decoding looks every id up in the token-byte table, whose size is fixed by the
vocabulary file. Cutting and reassembling are numpy over whole chunks; the cut
follows the pattern ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+|
?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.

* Null and empty texts have no ids; their bytes are empty.
* Rows are told apart by chunk and place, so repeated doc_ids keep their own rows.
* Unknown ids in decoding raise KeyError; null id lists give empty bytes.
* An empty table gives no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm.stored import bucketed, expand, give_back, giving_back, squeeze
from ledgerlens.llm.words import Texts, slices, span_hashes, string_buffers

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Text bytes of a chunk; its positions and its dictionary are in memory together.
CHUNK_BYTES = 8 << 20

OTHER, LETTER, NUMBER, WHITE = 0, 1, 2, 3


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def character_classes() -> np.ndarray:
    """Class of every code point, by the properties that the pattern names."""
    table = np.zeros(0x110000, np.uint8)
    kinds = [(kind, regex.compile(p)) for kind, p in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (WHITE, r"\s+"))]
    for block in range(0, 0x110000, 0x800):
        if 0xD800 <= block < 0xE000:  # surrogates are no characters
            continue
        text = "".join(map(chr, range(block, block + 0x800)))
        for kind, pattern in kinds:
            for found in pattern.finditer(text):
                table[block + found.start() : block + found.end()] = kind
    return table


#: After an apostrophe that begins a pre-token, these letters end it.
CONTRACTIONS = (("s",), ("t",), ("r", "e"), ("v", "e"), ("m",), ("l", "l"), ("d",))


def pretokens(texts: Texts, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all pre-tokens, and the first pre-token of each text."""
    data = texts.data
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    begins = np.flatnonzero((data & 0xC0) != 0x80)
    code = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(code)
    kind = classes[code]
    cut = np.zeros(n + 1, bool)
    cut[np.searchsorted(begins, texts.offsets)] = True
    # a run of one class ends where the class changes; white space stays one run here
    start = cut[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    # the last white character before a visible one stands alone, or with it if it is a plain space
    visible_next = np.zeros(n, bool)
    visible_next[:-1] = (kind[1:] != WHITE) & ~cut[1:n]
    tail = (kind == WHITE) & visible_next
    start |= tail
    joined = np.flatnonzero(tail & (code == 0x20)) + 1
    start[joined] = False
    # contractions: a lone apostrophe that begins a pre-token takes letters with it
    quote = (code == 0x27) & start
    quote[:-1] &= kind[1:] == LETTER
    quote[-1:] = False
    for i in np.flatnonzero(quote):
        for letters in CONTRACTIONS:
            end = i + 1 + len(letters)
            if end <= n and not cut[i + 1 : end].any() and all(code[i + 1 + k] == ord(c) for k, c in enumerate(letters)):
                start[i + 1] = False
                if end < n:
                    start[end] = True
                break
    first = np.flatnonzero(start)
    bounds = np.append(begins, len(data))
    starts = bounds[first]
    return starts, np.append(starts[1:], len(data)), np.searchsorted(starts, texts.offsets)


def merged(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of lowest rank merges first, the leftmost on ties."""
    if word in ranks:
        return [ranks[word]]
    parts = [word[i : i + 1] for i in range(len(word))]
    if len(parts) > 64:
        return merged_long(parts, ranks)
    none = len(ranks) + 256
    pairs = [ranks.get(parts[i] + parts[i + 1], none) for i in range(len(parts) - 1)]
    while pairs:
        best = min(pairs)
        if best == none:
            break
        i = pairs.index(best)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
    return [ranks[p] for p in parts]


def merged_long(parts: list[bytes], ranks: dict[bytes, int]) -> list[int]:
    """The same by a heap over linked parts, for words of any length."""
    import heapq

    size = len(parts)
    after, before = [*range(1, size), -1], [-1, *range(size - 1)]
    heap = [(ranks[p], i, p) for i in range(size - 1) if (p := parts[i] + parts[i + 1]) in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, pair = heapq.heappop(heap)
        j = after[i] if parts[i] is not None else -1
        if j < 0 or parts[i] + parts[j] != pair:
            continue
        parts[i], parts[j] = pair, None
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b >= 0 and (p := parts[a] + parts[b]) in ranks:
                heapq.heappush(heap, (ranks[p], a, p))
    return [ranks[p] for p in parts if p is not None]


def squeeze_numbers(numbers: np.ndarray) -> bytes:
    """Numbers, most of them small, as four planes of bytes."""
    return squeeze(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def expand_numbers(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(expand(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``values[start : start + length]`` of every pair, one after the other."""
    ends = np.cumsum(lengths)
    index = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)
    return values[index]


PARTS = "chunk long, bucket int, place int, doc_id long, n int, packed binary"
PARTS_ARROW = pa.schema(
    [("chunk", pa.int64()), ("bucket", pa.int32()), ("place", pa.int32()), ("doc_id", pa.int64()),
     ("n", pa.int32()), ("packed", pa.binary())]
)


def batch_chunks(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    for texts in slices(column, most):
        yield texts.first, texts.first + len(texts)


def chunk_rows(chunk: int, doc_ids: pa.Array, column: pa.Array, buckets: int, classes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of one chunk. Bucket -1: a text's words, numbered from the commonest of the chunk, and at
    place -1 the place of each of these in order of the hash. Others: the chunk's words in that order."""
    data, offsets = string_buffers(column)
    hashes, begins, stops, sizes = [], [], [], []
    for texts in slices(column):
        starts, ends, of_text = pretokens(texts, classes)
        base = offsets[texts.first]
        hashes.append(span_hashes(texts.data, starts, ends))
        begins.append((starts + base).astype(np.uint32))
        stops.append((ends + base).astype(np.uint32))
        sizes.append(np.diff(of_text))
    hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    distinct, where, numbers, times = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
    del hashes
    begins, stops = (np.concatenate(x)[where].tolist() if x else [] for x in (begins, stops))
    commonest = np.argsort(-times, kind="stable").astype(np.uint32)
    by_count = np.empty(len(distinct), np.uint32)
    by_count[commonest] = np.arange(len(distinct), dtype=np.uint32)
    numbers = by_count[numbers]
    bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]) if sizes else np.zeros(1, np.int64)
    n_texts = len(column)
    packed = [squeeze_numbers(numbers[bounds[i] : bounds[i + 1]]) for i in range(n_texts)]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n_texts, chunk)), pa.array(np.full(n_texts, -1, np.int32)),
            pa.array(np.arange(n_texts, dtype=np.int32)), doc_ids, pa.array(np.diff(bounds).astype(np.int32)),
            pa.array(packed, pa.binary()),
        ],
        schema=PARTS_ARROW,
    )
    edges = np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)
    edges = [0, *np.searchsorted(distinct, edges).tolist(), len(distinct)]
    rows = [(chunk, -1, -1, None, len(commonest), squeeze_numbers(commonest))]
    for bucket in range(buckets):
        low, high = edges[bucket], edges[bucket + 1]
        if high > low:
            mine = [data[i:j].tobytes() for i, j in zip(begins[low:high], stops[low:high], strict=True)]
            lengths = np.array([len(w) for w in mine], np.uint32).tobytes()
            rows.append((chunk, bucket, low, None, high - low, squeeze(lengths + b"".join(mine))))
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), PARTS_ARROW, strict=True)]
    yield pa.RecordBatch.from_arrays(columns, schema=PARTS_ARROW)


def cut_documents(documents: DataFrame, buckets: int, chunk_bytes: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, part, step = character_classes(), TaskContext.get().partitionId(), 0
        for batch in giving_back(batches):
            text, doc_ids = batch.column("text"), batch.column("doc_id").cast(pa.int64())
            for first, end in batch_chunks(text, chunk_bytes):
                chunk = (part << 32) + step
                yield from chunk_rows(chunk, doc_ids[first:end], text[first:end], buckets, classes)
                give_back()
                step += 1

    return documents.select("doc_id", "text").mapInArrow(run, PARTS)


def encode_words(parts: DataFrame, ranks_path: str) -> DataFrame:
    """(chunk, place, n, packed ids) for every list of words; a word is encoded once per bucket."""

    def run(rows: pa.Table) -> pa.Table:
        ranks, known = load_ranks(ranks_path), {}
        out = []
        for packed, n in zip(rows.column("packed").to_pylist(), rows.column("n").to_pylist(), strict=True):
            raw = expand(packed)
            ends = (4 * n + np.cumsum(np.frombuffer(raw[: 4 * n], np.uint32), dtype=np.int64)).tolist()
            ids, lengths, begin = array("I"), array("I"), 4 * n
            for end in ends:
                word = raw[begin:end]
                begin = end
                found = known.get(word)
                if found is None:
                    found = known[word] = array("I", merged(word, ranks))
                ids += found
                lengths.append(len(found))
            out.append(squeeze(lengths.tobytes() + ids.tobytes()))
        del known
        give_back()
        return rows.select(["chunk", "place", "n"]).append_column("packed", pa.array(out, pa.binary()))

    words = parts.where("bucket >= 0").select("bucket", "chunk", "place", "n", "packed")
    return words.groupBy("bucket").applyInArrow(run, "chunk long, place int, n int, packed binary")


def chunk_ids(texts: list[bytes], commonest: np.ndarray, words: pa.Table) -> Iterator[np.ndarray]:
    """Ids of every text of a chunk."""
    order = np.argsort(words.column("place").to_numpy())
    packed, counts = words.column("packed").to_pylist(), words.column("n").to_pylist()
    lengths, ids = [], []
    for i in order.tolist():
        raw = expand(packed[i])
        lengths.append(np.frombuffer(raw[: 4 * counts[i]], np.uint32))
        ids.append(np.frombuffer(raw[4 * counts[i] :], np.uint32))
    lengths = np.concatenate(lengths).astype(np.int64) if lengths else np.zeros(0, np.int64)
    ids = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    starts = (np.cumsum(lengths) - lengths)[commonest]
    lengths = lengths[commonest]
    for text in texts:
        numbers = expand_numbers(text)
        yield ragged(ids, starts[numbers], lengths[numbers])


def dealt(documents: DataFrame, ranks_path: str, buckets: int | None, chunk_bytes: int):
    """Positions and encoded words of all chunks, grouped by chunk to be put together."""
    if buckets is None:
        buckets = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = bucketed(cut_documents(documents, buckets, chunk_bytes), buckets, "chunk")
    positions = parts.where("bucket < 0").select("chunk", "place", "doc_id", "packed")
    return positions.groupBy("chunk").cogroup(encode_words(parts, ranks_path).groupBy("chunk"))


def put_together(positions: pa.Table, words: pa.Table) -> tuple[pa.ChunkedArray, Iterator[np.ndarray]]:
    """The doc_ids of a chunk and each text's ids."""
    positions = positions.sort_by("place")
    order, *texts = positions.column("packed").to_pylist()
    return positions.column("doc_id")[1:], chunk_ids(texts, expand_numbers(order), words)


def encode(
    documents: DataFrame, ranks_path: str, buckets: int | None = None, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """(doc_id, n_tokens, ids array<int>) of every row."""

    def run(positions: pa.Table, words: pa.Table) -> pa.Table:
        doc_ids, texts = put_together(positions, words)
        lists = list(texts)
        ends = np.cumsum([0, *map(len, lists)], dtype=np.int64)
        values = np.concatenate(lists) if lists else np.zeros(0, np.uint32)
        if ends[-1] >= 2**31:
            raise ValueError("a chunk has too many ids; use a smaller chunk_bytes")
        column = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values.view(np.int32)))
        return pa.table({"doc_id": doc_ids, "n_tokens": np.diff(ends), "ids": column})

    both = dealt(documents, ranks_path, buckets, chunk_bytes)
    return both.applyInArrow(run, "doc_id long, n_tokens long, ids array<int>")


def digests(
    documents: DataFrame, ranks_path: str, buckets: int | None = None, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encoded, decoded and digested where a chunk is put together.

    The ids never leave the task, which needs one Python worker instead of two.
    """

    def run(positions: pa.Table, words: pa.Table) -> pa.Table:
        tokens = Tokens(load_ranks(ranks_path))
        doc_ids, texts = put_together(positions, words)
        sizes, id_hashes, hashes = [], [], []
        for ids in texts:
            sizes.append(len(ids))
            id_hashes.append(tokens.digest_of_ids(ids))
            hashes.append(hashlib.sha256(tokens.text_of(ids)).hexdigest())
        give_back()
        return pa.table(
            {"doc_id": doc_ids, "n_tokens": pa.array(sizes, pa.int64()),
             "ids_sha256": pa.array(id_hashes, pa.string()), "decoded_sha256": pa.array(hashes, pa.string())}
        )

    both = dealt(documents, ranks_path, buckets, chunk_bytes)
    return both.applyInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def token_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all tokens end to end, with start and length by id."""
    size = max(ranks.values()) + 1
    tokens = [b""] * size
    for token, rank in ranks.items():
        tokens[rank] = token
    lengths = np.array([len(t) for t in tokens])
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(lengths) - lengths, lengths


class Tokens:
    """The token-byte table, joined to ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.values, self.starts, self.lengths = token_table(ranks)
        self.names = np.array([str(i) for i in range(len(self.lengths))], object)

    def text_of(self, ids: np.ndarray) -> bytes:
        return ragged(self.values, self.starts[ids], self.lengths[ids]).tobytes()

    def digest_of_ids(self, ids: np.ndarray) -> str:
        return hashlib.sha256(",".join(self.names[ids]).encode()).hexdigest()

    def check(self, ids: np.ndarray) -> None:
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.lengths) or not self.lengths[ids].all()):
            raise KeyError("an id is not in the vocabulary")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` with the column ``bytes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(load_ranks(ranks_path))
        for batch in batches:
            column = batch.column("ids")
            flat, bounds = column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(_list_sizes(column))])
            tokens.check(flat)
            texts = [tokens.text_of(flat[bounds[i] : bounds[i + 1]]) for i in range(len(column))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], [*batch.schema.names, "bytes"])

    types = {f.name: f.dataType.simpleString() for f in encoded.schema.fields}
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in encoded.columns), "`bytes` binary"])
    return encoded.mapInArrow(run, schema)


def _list_sizes(column: pa.ListArray) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary_path())

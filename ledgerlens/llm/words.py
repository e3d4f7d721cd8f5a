"""Words and their hashes, computed with numpy over the buffers of Arrow batches.

A word is a maximal run of bytes other than space and 0x09-0x0D. These bytes
never occur inside a multi-byte UTF-8 character, so words of the encoded text
are the encoded words of the text. Texts of a batch are handled in slices of
bounded size (one text at least), so memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Pattern of one word, as SQL functions of Spark and DuckDB take it.
WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 1 << 20


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def unused(name: str, columns: Iterable[str]) -> str:
    """``name``, or a longer one where a column has it, in whatever case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def constants(seed: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(1, 2**64 - 1, n, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit over all others (a bijection on 64-bit numbers)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


@dataclass
class Texts:
    """Consecutive texts of a batch: bytes, and where each text begins and ends."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; nulls become empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null(b"" if "binary" in str(column.type) else "")
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64 if large else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[Texts]:
    """The texts of a column in order, up to ``most`` bytes at a time (one text at least)."""
    data, offsets = string_buffers(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = min(n, max(j, i + 1))
        yield Texts(i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        i = j


@dataclass
class Words:
    """Words of consecutive texts: byte ranges, and the first word of each text."""

    starts: np.ndarray
    ends: np.ndarray
    of_text: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.of_text)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.of_text) - 1), self.counts())


def space_table() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


SPACE = space_table()


def find_words(texts: Texts) -> Words:
    n = len(texts.data)
    inside = ~SPACE[texts.data]
    cut = np.zeros(n + 1, bool)
    cut[texts.offsets] = True
    cut[0] = cut[n] = True
    before = np.empty(n, bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.empty(n, bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return Words(starts, ends, np.searchsorted(starts, texts.offsets))


BYTE_VALUES = constants(20_240_611, 256)
BASE, STEP, LENGTHS = (int(x) | 1 for x in constants(77_001, 3))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range; ranges are ascending and do not overlap."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    values = BYTE_VALUES[data]
    covered = np.zeros(len(data) + 1, np.int8)
    covered[starts] += 1
    covered[ends] -= 1
    values[np.cumsum(covered[:-1], dtype=np.int8) == 0] = 0
    begin = starts[0]
    place = np.arange(begin, len(data)) - np.repeat(starts, np.diff(starts, append=len(data)))
    place = np.minimum(place, int((ends - starts).max()))
    values = values[begin:] * powers(BASE, int(place.max()) + 1)[place]
    total = np.add.reduceat(values, starts - begin)
    return mix(total + (ends - starts).astype(np.uint64) * np.uint64(LENGTHS))


def window_hashes(hashes: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of each ``n`` consecutive values; those that cross a text's end are the caller's to mask."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    m = len(hashes) - n + 1
    out = np.zeros(m, np.uint64)
    for k in range(n):
        out = out * np.uint64(STEP) + hashes[k : k + m]
    return mix(out + np.uint64(n * 0x9E3779B97F4A7C15 + seed & 2**64 - 1))


def window_inside(words: Words, n: int) -> np.ndarray:
    """For each window start, whether all its ``n`` words are of one text."""
    total = words.of_text[-1]
    if total < n:
        return np.zeros(0, bool)
    last = np.repeat(words.of_text[1:], words.counts())
    return np.arange(total - n + 1) + n <= last[: total - n + 1]


def covered_by(starts: np.ndarray, length: int, total: int) -> np.ndarray:
    """Mask of the positions inside any window of ``length`` that begins at ``starts``."""
    change = np.zeros(total + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + length, -1)
    return np.cumsum(change[:-1]) > 0


def arrow_column(values: np.ndarray | list, kind: pa.DataType) -> pa.Array:
    return pa.array(values, kind)


def binary_rows(pieces: list[bytes | None]) -> pa.Array:
    return pa.array(pieces, pa.binary())

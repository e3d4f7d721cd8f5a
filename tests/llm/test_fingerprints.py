"""Piecewise hashing against a version that goes byte by byte, and likeness against the table of edit distances."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import fingerprints as fp
from ledgerlens.llm.words import slices

M = 2**64


def spread(h):
    h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 % M
    h = (h ^ h >> 27) * 0x94D049BB133111EB % M
    return h ^ h >> 31


def by_bytes(text):
    """The fingerprint of a text, a byte at a time."""
    rolled, chunk = fp.ROLLING.tolist(), fp.CHUNK.tolist()
    hashes = {
        i: spread(sum(rolled[text[i - k]] * pow(fp.STEP, k, M) for k in range(fp.REACH)) % M)
        for i in range(fp.REACH - 1, len(text))
    }

    def ends(level):
        limit = M - M // (fp.SMALLEST_BLOCK << level)
        return [i + 1 for i, h in hashes.items() if h >= limit]

    start = 0
    while len(text) > fp.EXPECTED * (fp.SMALLEST_BLOCK << start):
        start += 1
    level = start
    while level > max(0, start - fp.HALVINGS) and len(ends(level)) < fp.FEWEST and len(ends(level - 1)) <= fp.MOST:
        level -= 1
    while len(ends(level)) > fp.MOST:
        level += 1

    def signature(k):
        cuts = [0, *ends(k)]
        cuts += [len(text)] if cuts[-1] != len(text) else []
        out = ""
        for a, b in zip(cuts, cuts[1:]):
            total = sum(chunk[text[j]] * pow(fp.ROOT, j - a, M) for j in range(a, b)) % M
            symbol = spread((total + b - a) % M) >> 52
            out += fp.DIGITS[symbol >> 6] + fp.DIGITS[symbol & 63]
        return out

    return f"{fp.SMALLEST_BLOCK << level}:{signature(level)}:{signature(level + 1)}"


def distance(x, y):
    """Edit distance with insertions and deletions, from its table."""
    row = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        before, row = row, [i]
        for j, b in enumerate(y, 1):
            row.append(before[j - 1] if a == b else 1 + min(before[j], row[-1]))
    return row[-1]


def prints(texts):
    table = fp.Powers()
    return [p for some in slices(pa.array(texts, pa.binary())) for p in fp.fingerprints(some, table)]


RANDOM = random.Random(5)
WORDS = ["".join(RANDOM.choices("abcdefgh", k=RANDOM.randint(2, 7))) for _ in range(60)]


def prose(n):
    return " ".join(RANDOM.choices(WORDS, k=n))


TEXTS = [
    None, "", "a", "abcdef", "abcdefg", "é" * 40, prose(12), prose(300), prose(300), "same line again\n" * 400,
    prose(3000), "z" * 9000, "\U0001f600 " + prose(50), prose(12),
]


def test_fingerprints_equal_a_byte_by_byte_version():
    raw = [(t or "").encode() for t in TEXTS]
    assert prints(raw) == [by_bytes(t) for t in raw]


def test_fingerprint_does_not_depend_on_segments_or_neighbours(monkeypatch):
    raw = [(t or "").encode() for t in TEXTS]
    alone = [prints([t])[0] for t in raw]
    monkeypatch.setattr(fp, "SEGMENT", 1000)
    assert prints(raw) == alone and prints(raw[::-1]) == alone[::-1]


def test_signature_of_a_degenerate_text_is_bounded():
    for text in (b"z" * 200_000, b"0123456789" * 30_000, b"\x00" * 50_000, (b"a" * 31 + b"\n") * 5000):
        assert len(prints([text])[0].split(":")[1]) <= 2 * (fp.MOST + 1)


def test_likeness_is_that_of_the_table_of_distances():
    for _ in range(60):
        x, y = (RANDOM.choices(["AA", "Ab", "cD", "9+"], k=RANDOM.randint(0, 90)) for _ in range(2))
        expected = 1 - distance(x, y) / (len(x) + len(y)) if x or y else 1.0
        assert fp.alike(x, y) == pytest.approx(expected, abs=1e-12)
    assert fp.likeness("8:AAAb:cD", "16:cD:AA") == 1.0 and fp.likeness("16:cD:AA", "8:AAAb:cD") == 1.0
    assert fp.likeness("8:AAAb:cD", "32:AAAb:cD") == 0.0 and fp.likeness("4::", "4:AA:AA") == 0.0


def expected_rows(rows):
    """Rows as the operator orders them, each compared with the next."""
    out = []
    chars = {i: (t or "") for i, (_, t) in enumerate(rows)}
    for i, (doc_id, _) in enumerate(rows):
        own, after = chars[i], chars[(i + 1) % len(rows)]
        third = len(own) // 3
        changed = own[: len(own) - third] + after[:third]
        a, b, c = (by_bytes(x.encode()) for x in (own, changed, after))
        out.append((doc_id, len(own), hashlib.sha256(changed.encode()).hexdigest(), a, b, fp.likeness(a, b), fp.likeness(a, c)))
    return out


@pytest.mark.parametrize("parts", [1, 7])
def test_compare_edited_equals_brute_force(spark, parts):
    rows = [(i * 3, t, "extra") for i, t in enumerate(TEXTS)] + [(None, "no id here", "x"), (None, None, None), (9, prose(40), "x")]
    rows += [(30, TEXTS[10], "x")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string").repartition(parts)
    text = F.coalesce("text", F.lit(""))
    ordered = docs.orderBy(F.desc_nulls_last("doc_id"), F.xxhash64(text), text).select("doc_id", "text").collect()
    got = fp.compare_edited(docs).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[1])
    assert sorted(map(tuple, got), key=key) == sorted(expected_rows([tuple(r) for r in ordered]), key=key)


def test_single_row_and_empty_table(spark):
    docs = spark.createDataFrame([(5, "abcdefghi")], "doc_id long, text string")
    (row,) = fp.compare_edited(docs).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abcdefabc").hexdigest() and row.near_next == 1.0
    assert fp.compare_edited(docs.where("false")).count() == 0 and fp.fingerprinted(docs.where("false")).count() == 0


def test_fingerprints_and_likeness_of_columns(spark):
    docs = spark.createDataFrame([(1, TEXTS[7]), (2, TEXTS[7] + " end"), (3, TEXTS[8]), (4, None)], "doc_id long, text string")
    found = fp.fingerprinted(docs)
    other = found.select(F.col("doc_id").alias("other"), F.col("fingerprint").alias("p"))
    near = {
        (r.doc_id, r.other): r.near
        for r in found.join(other, F.col("doc_id") < F.col("other")).withColumn("near", fp.likeness_of(F.col("fingerprint"), F.col("p"))).collect()
    }
    assert near[1, 2] > 0.9 > 0.3 > near[1, 3] and near[1, 4] == 0.0


def test_edited_text_is_nearer_than_the_next(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = fp.op11_fingerprints(spark, "/root/testdata/sf0.001").toPandas()
    assert len(got) == docs.count() and got.fingerprint.notna().all()
    long = got[got.n_chars > 300]
    assert (long.near_edited > 0.4).mean() > 0.95 and np.median(long.near_edited) > np.median(long.near_next) + 0.3

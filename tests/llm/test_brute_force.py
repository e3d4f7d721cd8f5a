"""Operators without SQL against plain versions of their definitions."""

import collections
import itertools
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import language, personal, sharding, vptree, warc
from ledgerlens.llm.words import slices

WORD64 = (1 << 64) - 1


# --- sharding ---


def mixed_bits(h):
    h ^= h >> 30
    h = h * 0xBF58476D1CE4E5B9 & WORD64
    h ^= h >> 27
    h = h * 0x94D049BB133111EB & WORD64
    return h ^ h >> 31


def place_of(number, total):
    """One number through the network, again and again until it lies in range."""
    half = max(1, (max(total - 1, 1).bit_length() + 1) // 2)
    low = (1 << half) - 1
    while True:
        left, right = number >> half, number & low
        for r in range(1, sharding.ROUNDS + 1):
            key = mixed_bits((r * 0x9E3779B97F4A7C15 + sharding.SEED) & WORD64)
            left, right = right, left ^ mixed_bits((right + key) & WORD64) & low
        number = left << half | right
        if number < total:
            return number


@pytest.mark.parametrize("total", [1, 2, 3, 24, 65, 1000])
def test_feistel_equals_one_number_at_a_time(total):
    got = sharding.feistel(np.arange(total), total).tolist()
    assert got == [place_of(i, total) for i in range(total)]


def test_shards_equal_plain_python(spark):
    texts = [None, "", "é", "a", "a", "x" * 100_000, *[f"text {i}" for i in range(60)], "text 1", "text 1"]
    rows = [(i if i % 9 else None, t, "clash") for i, t in enumerate(texts)] + [(5, "x", None)] * 3
    table = spark.createDataFrame(rows, "doc_id long, text string, size string").repartition(5)
    plain = sorted(
        ((i is not None, i or 0), zlib.crc32((t or "").encode()), len((t or "").encode()) + 8, i) for i, t, _ in rows
    )
    places = [place_of(k, len(rows)) for k in range(len(rows))]
    want = collections.Counter((i, n, crc, p % 24, p // 24) for (_, crc, n, i), p in zip(plain, places, strict=True))
    got = sharding.sharded(table).select("doc_id", "size", "text_crc32", "shard", "slot").collect()
    assert collections.Counter(map(tuple, got)) == want


# --- language ---


def chances(context, table, alphabet):
    """Probability of every symbol after a context that was seen."""
    parent = chances(context[1:], table, alphabet) if context else {s: 1 / len(alphabet) for s in alphabet}
    counts = table[context]
    total, kinds = sum(counts.values()), len(counts)
    left = sum(p for s, p in parent.items() if s not in counts)
    if not left:
        return {s: counts[s] / total for s in alphabet}
    escape = kinds / (total + kinds)
    return {s: counts[s] / (total + kinds) if s in counts else escape * p / left for s, p in parent.items()}


def test_code_lengths_equal_a_byte_by_byte_coder(spark):
    draw = random.Random(3)
    stock = {"en": "the that and of in ion", "fr": "le la é les et que ion"}
    rows = [(i, " ".join(draw.choices(stock[g].split(), k=draw.randint(1, 12))), g) for i, g in enumerate(["en", "fr"] * 20)]
    rows += [(100, None, "en"), (101, "", "fr"), (102, "no label", None), (103, "1 2 3", "en")]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(documents, per_language=10**6)
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    learned = [(t.encode(), g) for i, t, g in rows if t is not None and g and not held(i)]
    pad = bytes([language.PAD]) * language.ORDER
    alphabet = [*sorted({b for t, _ in learned for b in t} | {language.PAD}), "other"]
    tables = {g: collections.defaultdict(collections.Counter) for g in stock}
    for text, g in learned:
        for k, byte in enumerate(text):
            for order in range(language.ORDER + 1):
                tables[g][tuple((pad + text)[k + 3 - order : k + 3])][byte] += 1

    def bits(text, table):
        known = [b if b in alphabet else "other" for b in pad + text]
        out = 0.0
        for k in range(3, len(known)):
            context = next(c for n in (3, 2, 1, 0) if (c := tuple(known[k - n : k])) in table)
            out -= math.log2(chances(context, table, alphabet)[known[k]])
        return out

    texts = ["the lion", "les lions et", "", "é", "zebra 中 the", "\n\nand", "that " * 50]
    got = np.concatenate([language.code_lengths(part, model) for part in slices(pa.array(texts))])
    want = np.array([[bits(t.encode(), tables[g]) for g in model.languages] for t in texts])
    assert model.languages == ["en", "fr"] and got == pytest.approx(want, rel=1e-4, abs=1e-3)

    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in language.predict(table, model).collect():
        best = int(want[row.doc_id].argmin())
        if any(c.isalpha() for c in texts[row.doc_id]):
            share = 1 / sum(2 ** max(-1000.0, want[row.doc_id][best] - b) for b in want[row.doc_id])
            assert (row.lang_pred, row.score) == (model.languages[best], pytest.approx(share, abs=1e-2))
        else:
            assert (row.lang_pred, row.score) == ("und", 0.0)
        assert row.held_out == held(row.doc_id)


# --- personal data ---


def all_segmentations(n, longest):
    for cuts in itertools.product([False, True], repeat=n - 1):
        ends = [k + 1 for k, cut in enumerate(cuts) if cut] + [n]
        parts = list(zip([0, *ends[:-1]], ends, strict=True))
        if all(j - i <= longest for i, j in parts):
            yield parts


@pytest.mark.parametrize("seed", range(6))
def test_field_equals_all_segmentations(seed):
    rng = np.random.default_rng(seed)
    words = [["call", "+1", "456", "555-2186", "now"], ["jane(at)corp.com", "or", "10.0.0.1"], ["x"], ["1", "1", "1", "1"]][seed % 4]
    n, kinds = len(words), personal.OUTSIDE + 1
    names = sorted({f for i in range(n) for j in range(i + 1, n + 1) for f in personal.features(words, i, j)})
    weights = {name: rng.normal(size=kinds) for name in names}

    def score(i, j, kind):
        if kind == personal.OUTSIDE and j - i > 1:
            return -math.inf
        tie = personal.TIE if kind == personal.OUTSIDE else 0.0
        return tie + sum(weights[f][kind] for f in personal.features(words, i, j))

    paths = {}
    for parts in all_segmentations(n, personal.LONGEST):
        for labels in itertools.product(range(kinds), repeat=len(parts)):
            path = tuple((i, j, kind) for (i, j), kind in zip(parts, labels, strict=True))
            value = sum(score(*step) for step in path)
            if value > -math.inf:
                paths[path] = value
    best = max(paths, key=paths.get)
    assert personal.best_path(words, weights) == [step for step in best if step[2] != personal.OUTSIDE]

    total = sum(math.exp(v) for v in paths.values())
    want = collections.Counter()
    for path, value in paths.items():
        for step in path:
            want[step] += math.exp(value) / total
    got = personal.expectations(personal.chart(words, weights), n)
    for (i, j), chance in got.items():
        assert chance == pytest.approx([want[i, j, kind] for kind in range(kinds)], abs=1e-9)


# --- nearest neighbours ---


class Counting(vptree.Search):
    compared = 0

    def take(self, rows, active):
        Counting.compared += len(rows) * len(active)
        super().take(rows, active)


def test_smaller_factors_compare_less_and_lose_little():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 16)) * 4
    vectors = centres[rng.integers(40, size=4000)] + rng.normal(size=(4000, 16)) * 0.4
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    ids = np.arange(4000)
    tree = vptree.Tree(ids, vectors, float(np.einsum("ij,ij->i", vectors, vectors).max()))
    asked = ids[::20]
    exact = vectors[asked] @ vectors.T
    exact[np.arange(len(asked)), asked] = -np.inf
    best = np.argsort(-exact, axis=1, kind="stable")[:, :20]
    compared, recall = {}, {}
    for factor in (1.0, 0.5, 0.25):
        Counting.compared = 0
        search = Counting(tree, asked, vectors[asked], 20, factor)
        search.run()
        compared[factor] = Counting.compared / (len(asked) * len(ids))
        recall[factor] = np.mean([len(set(a) & set(b)) / 20 for a, b in zip(best, search.found, strict=True)])
    assert recall[1.0] == 1.0 and compared[1.0] < 0.5
    assert compared[0.25] < compared[0.5] < compared[1.0] and recall[0.5] >= 0.9


def test_vectors_of_different_length_are_refused(spark):
    table = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError):
        vptree.nearest(table, F.col("vec_id") == 1)


# --- archives ---


def test_paths_get_the_scheme_of_the_session(spark, tmp_path):
    assert warc.qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    assert warc.file_system(f"file:{tmp_path}")[1] == warc.file_system(f"file://{tmp_path}")[1] == str(tmp_path)
    pages = spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string")
    warc.write_warc(pages, str(tmp_path / "a folder"))
    assert warc.read_warc(spark, str(tmp_path / "a folder")).count() == 1

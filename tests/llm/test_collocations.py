"""FM-index against plain counting, and phrases against a version with dictionaries."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import collocations
from ledgerlens.llm.fmindex import BiIndex

PIECE, WORD = re.compile(r"[.,;:!?\x0A-\x0D]"), re.compile(r"[^\x20\x09]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def grams_of(sequence, n):
    windows = zip(*(sequence[i:] for i in range(n)))
    return collections.Counter(tuple(int(x) for x in w) for w in windows if all(w))


@pytest.mark.parametrize("n_words,size", [(3, 200), (9, 3000), (400, 3000), (2, 1)])
def test_extensions_of_both_directions_count_every_ngram(n_words, size):
    draw = np.random.default_rng(n_words)
    sequence = np.append(draw.integers(0, n_words, size), 0).astype(np.int32)
    index = BiIndex(sequence, n_words, 4)
    grown = {1: index.words()}
    grown[2] = index.right(grown[1])
    grown[3] = index.left(grown[2])
    grown[4] = index.right(grown[3])
    for n, found in grown.items():
        assert dict(zip(map(tuple, found.words.tolist()), found.count.tolist())) == grams_of(sequence, n)
    # An interval reached from the left is the one reached from the right.
    other = index.right(index.left(index.words()))
    key = lambda p: sorted(zip(map(tuple, p.words.tolist()), p.here.tolist(), p.there.tolist()))
    assert key(index.left(index.right(index.words()))) == key(other)


def by_dictionaries(rows, least, most):
    counts, sizes = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        for piece in PIECE.split((text or "").translate(LOWER)):
            words = WORD.findall(piece)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    counts[lang or ("und" if lang is None else lang)][tuple(words[i : i + n])] += 1
            sizes["und" if lang is None else lang] += len(words)
    out = []
    for lang, f in counts.items():
        candidates = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        inside = {
            g[i : i + n]
            for g, b in candidates.items()
            for n in range(2, len(g))
            for i in range(len(g) - n + 1)
            if 100 * b >= 80 * f[g[i : i + n]]
        }
        ranked = []
        for g, a in candidates.items():
            if g not in inside:
                cuts = [(2_000_000 * a // (f[g[:k]] + f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g))]
                score, _, l, r = min(cuts)  # noqa: E741
                ranked.append((-score, -a, " ".join(g).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(ranked)[:most], 1):  # noqa: E741
            out.append((lang, rank, phrase.decode(), -a, l, r, sizes[lang], -score))
    return sorted(out)


def corpus():
    draw = random.Random(3)
    words = ["a", "B", "c", "dé", "É", "ff", "g-h", "\x0bi", "j k", "l"]
    rows = []
    for i in range(120):
        text = "".join(draw.choice(words) + draw.choice([" ", " ", "\t", "  ", ". ", "\n", ",", "\r\n", "?!"]) for _ in range(draw.randint(0, 60)))
        rows.append((draw.choice(["en", "en", "de", None, ""]), text))
    rows += [("en", "the very same words stand here, again and again")] * 40 + [("de", None), (None, ""), ("fr", " .,\n")]
    return rows + [("en", "x " * 3000), (None, "no break " * 500)]


@pytest.mark.parametrize("least,most,shard_bytes", [(30, 2000, 1 << 20), (3, 25, 300), (2, 2000, 5000)])
def test_phrases_equal_dictionaries(spark, least, most, shard_bytes):
    rows = corpus()
    docs = spark.createDataFrame([(i, lang, text, 1) for i, (lang, text) in enumerate(rows)], "doc_id long, lang string, text string, n long")
    got = collocations.collocations(docs.repartition(5), least, most, shard_bytes)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == by_dictionaries(rows, least, most)


def test_empty_tables(spark):
    docs = spark.createDataFrame([("en", None), (None, " ")], "lang string, text string")
    assert collocations.collocations(docs).count() == 0 and collocations.collocations(docs.where("false")).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    a, l, r = 9 * 10**15 + 1, 9 * 10**15 + 7, 10**16 + 3  # noqa: E741
    row = spark.range(1).select(F.lit(a).alias("a"), F.lit(l).alias("l"), F.lit(r).alias("r"))
    got = row.select(collocations.score(F.col("l"), F.col("r"))).first()[0]
    assert got == 2_000_000 * a // (l + r)


def test_ngrams_travel_packed_by_bucket(spark):
    draw = np.random.default_rng(5)
    grams = np.unique(draw.integers(1, 40, (900, 3)) << 30, axis=0)
    counts = draw.integers(1, 9, len(grams))
    rows = collocations.dealt(list(grams.T), counts, 7, 4)
    assert len(rows) == 4 and set(rows.column("shard").to_pylist()) == {7}
    back = [collocations.expand_rows(p, n) for p, n in zip(rows.column("packed").to_pylist(), rows.column("n").to_pylist())]
    assert sorted(np.concatenate([np.stack(x).T for x in back]).tolist()) == np.column_stack([grams, counts]).tolist()
    # Pairs of all shards cross the network in a row per shard and bucket, whatever their number.
    words = [f"w{draw.integers(0, 60)}" for _ in range(9000)]
    docs = spark.createDataFrame([("en", " ".join(words[i : i + 300])) for i in range(0, 9000, 300)], "lang string, text string")
    shards = collocations.shards_of(docs.repartition(3)).localCheckpoint()
    known = collocations.frequent_words(shards, 2)
    pairs = collocations.pairs_of(shards.where("place = 0").select("shard", "packed"), known, 4).localCheckpoint()
    assert pairs.count() <= 3 * 4 and pairs.agg(F.sum("n")).first()[0] > 1000
    frequent = collocations.frequent_pairs(pairs, 2).where("total is not null")
    expected = collections.Counter(p for i in range(0, 9000, 300) for p in zip(words[i : i + 299], words[i + 1 : i + 300]))
    assert frequent.count() == sum(a >= 2 for a in expected.values())
    assert frequent.agg(F.sum("total")).first()[0] == sum(a for a in expected.values() if a >= 2)

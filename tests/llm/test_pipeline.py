"""The five stages against plain Python, row by row."""

import collections
import hashlib
import random
import re

import pytest

from ledgerlens.llm import bpe, personal, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, _row string, _rate double, copies long"


def good(text):
    words = WORD.findall(text or "")
    size = max(1, sum(map(len, words)))
    share, covered = {}, set()
    for n in {quality.BASE_WINDOW, *quality.COVERAGE}:
        times = collections.Counter(tuple(words[k : k + n]) for k in range(len(words) - n + 1))
        inside = {k + d for k in range(len(words) - n + 1) if times[tuple(words[k : k + n])] > 1 for d in range(n)}
        share[n] = sum(len(words[k]) for k in inside) / size
        covered = inside if n == quality.BASE_WINDOW else covered
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    again = collections.Counter(lines)
    in_lines = sum(len(w) for x in lines if again[x] > 1 for w in WORD.findall(x)) / size
    base = len(words) < quality.MIN_WORDS or 100 * len(covered) > quality.BASE_PERCENT * len(words)
    return not base and in_lines <= quality.LINE_COVERAGE and all(share[n] <= m for n, m in quality.COVERAGE.items())


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def one_of_each(rows):
    sets, group = [shingles(r["text"]) for r in rows], list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                group = [group[j] if g == group[i] else g for g in group]
    first = {}
    for r, g in zip(rows, group, strict=True):
        key = (r["doc_id"] is None, r["doc_id"] or 0)
        if g not in first or key < first[g][0]:
            first[g] = (key, r)
    return [r for _, r in first.values()]


def levels(sizes, weights, limit):
    """Shares by weight; what passes a source's limit is shared again among the others."""
    target, free, rest = {}, set(sizes), float(sum(sizes.values()))
    while True:
        unit = rest / sum(weights[s] for s in free) if free else 0
        over = {s for s in free if unit * weights[s] > limit * sizes[s]}
        if not over:
            return {**target, **{s: unit * weights[s] for s in free}}
        target |= {s: float(limit * sizes[s]) for s in over}
        rest -= sum(target[s] for s in over)
        free -= over


def mixed(rows):
    sizes = collections.Counter()
    for r in rows:
        sizes[r["source"]] += len(WORD.findall(r["text"]))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = levels(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 3)
    out = []
    for r in rows:
        rate = target[r["source"]] / sizes[r["source"]]
        key = "null" if r["doc_id"] is None else str(r["doc_id"])
        drawn = int(hashlib.md5(f"mix-1:{key}:{r['text'] or ''}".encode()).hexdigest()[:12], 16) / 16**12
        out += [r] * (int(rate) + (drawn < rate - int(rate)))
    return out


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(11)
    words = ["".join(draw.choices("abcdeghilmnoprstu", k=draw.randint(2, 9))) for _ in range(400)]
    prose = lambda n: " ".join(draw.choices(words, k=n))
    texts = [prose(draw.randint(5, 120)) for _ in range(40)]
    texts += [texts[0], texts[0], texts[1] + " end", "Start " + texts[2].upper(), "again and again\n" * 30, "", None, "a b c"]
    texts += [f"{prose(9)} mail jane.doe@example.com or +1 (456) 555-2186 {prose(9)} 10.0.0.1 and bob(at)corp.com {prose(5)}" for _ in range(3)]
    texts += [prose(20) + " é 中文 \U0001f600 " + prose(4), prose(3000), "x" * 20_000 + " " + prose(30)]
    out = [
        dict(doc_id=i, text=t, lang="en", source=("a", "a", "b", None, "c")[i % 5], n_chars=len(t or ""), _row="mine", _rate=0.5, copies=7)
        for i, t in enumerate(texts)
    ]
    return out + [dict(out[3], doc_id=None), dict(out[5], doc_id=None, text=prose(40)), dict(out[7], text=prose(50), source=None)]


def test_pipeline_equals_plain_python(spark, rows, tmp_path):
    import public_tokenizers
    import tiktoken

    import corpus_pipeline

    names = [part.split()[0] for part in SCHEMA.split(", ")]
    spark.createDataFrame([tuple(r[n] for n in names) for r in rows], SCHEMA).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    kept = [r for r in rows if good(r["text"])]
    single = one_of_each(kept)
    assert 0 < len(single) < len(kept) < len(rows)

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:2]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == names, name
    key = lambda r: (str(r["doc_id"]), r["text"])
    assert sorted((key(r) for r in docs.collect())) == sorted(key(r) for r in single)

    weights = personal.fit(docs)
    masked = []
    for r in single:
        base = personal.base_spans(r["text"])
        masked.append(dict(r, text=personal.mask(r["text"], base + personal.added_spans(r["text"], base, weights))))
    assert sum("<EMAIL>" in r["text"] for r in masked) == 3

    ranks = bpe.load_ranks(bpe.vocabulary_path())
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    wanted = collections.Counter()
    for r in mixed(masked):
        ids = library.encode_ordinary(r["text"])
        digests = (",".join(map(str, ids)).encode(), r["text"].encode())
        wanted[r["doc_id"], len(ids), *(hashlib.sha256(d).hexdigest() for d in digests)] += 1
    assert collections.Counter(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == wanted

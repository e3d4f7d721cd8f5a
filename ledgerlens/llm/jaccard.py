"""Near duplicates by n-gram Jaccard similarity over count-vector R-trees (operator 2).

Documents are sets of 5-word shingles; two link at a Jaccard similarity of 0.8.

1. One pass gives each set's size and a 64-bit id (equal sets are one from here
   on) and counts of shingles in a sketch of fixed size over the whole corpus.
2. Sets that link share at least ceil(0.8 n) members, so their n - ceil(0.8 n) + 1
   first members in any fixed order have one in common. The order is rarest first
   by the sketch. These members are the cells in which sets meet: one shuffle.
3. In every cell the set with fewest members is compared with the others (where
   sizes differ too much, each with the next smaller one); the pairs are verified
   on the shingles of the texts. What is linked is contracted, and neighbours in
   order of size that are still apart are compared likewise.
4. Cells that still hold several components are dealt out as bounded bundles
   (large cells as pairs of blocks). Each bundle indexes its sets' count vectors
   in an R-tree, which lets pairs of different components through whose bounded
   overlap reaches the threshold. First a bundle gives a spanning forest of them
   (near copies nearly always link, so a large group falls together at once);
   after verifying and contracting, the trees give all pairs that are left.

The contraction loses no link between components, emits no pairs within a group
of copies, and steps 3 and 4 bound every task.

* Null texts and texts without a word have the empty set and link with nothing;
  texts under five words have one shingle, all their words. Only A-Z are lowered.
* Rows that repeat a doc_id are sets of their own and may link; a null doc_id is
  never a component's id unless all its ids are null.
* An empty table gives no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.graph import components
from ledgerlens.llm.rtree import RTree, group_counts
from ledgerlens.llm.stored import bucketed, expand, giving_back, squeeze
from ledgerlens.llm.words import (
    constants,
    find_words,
    mix,
    quoted,
    slices,
    span_hashes,
    unused,
    window_hashes,
    window_inside,
)
from ledgerlens.session import cut_lineage

SHINGLE = 5
PERCENT = 80
#: Counters of the sketch (4 bytes each, the size of the broadcast) and the parts in which tasks are summed.
SKETCH, SLICES = 1 << 22, 64
GROUPS = 1024
#: Rows of a bundle of cells, and of a block of one large cell.
BUNDLE = 2048
#: A member whose sketch cell has this share of all documents is dealt over several tasks.
HOT_SHARE, SALTS = 1 / 64, 32
#: Rows that may be broadcast: 8 bytes each.
BROADCAST_ROWS = 1_000_000

SALT_A, SALT_B = (np.uint64(x) for x in constants(5_551, 2))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def shingle_sets(column: pa.Array) -> Iterator[list[np.ndarray]]:
    """The sorted distinct shingle hashes of every text, a slice of texts at a time."""
    for texts in slices(column):
        texts.data = LOWER[texts.data]
        words = find_words(texts)
        hashes = span_hashes(texts.data, words.starts, words.ends)
        counts = words.counts()
        inside = np.flatnonzero(window_inside(words, SHINGLE))
        windows = window_hashes(hashes, SHINGLE)[inside]
        bounds = np.searchsorted(inside, words.of_text)
        out = []
        for i, n in enumerate(counts.tolist()):
            if n >= SHINGLE:
                out.append(np.unique(windows[bounds[i] : bounds[i + 1]]))
            else:
                first = words.of_text[i]
                out.append(window_hashes(hashes[first : first + n], n) if n else np.zeros(0, np.uint64))
        yield out


def set_id(members: np.ndarray) -> int:
    """Number of a set, whatever the order of its members; 0 stands for the empty set."""
    if not len(members):
        return 0
    first, second = mix(members ^ SALT_A).sum(dtype=np.uint64), mix(members + SALT_B).sum(dtype=np.uint64)
    whole = mix(np.array([first]) + mix(np.array([second]) + np.uint64(len(members))))
    return int(whole.view(np.int64)[0]) or 1


def numbered(documents: DataFrame, row: str) -> DataFrame:
    """``documents`` with a number of its own for every row, as column ``row``.

    Numbers follow the order of reading, which only a plain scan of files repeats
    whatever columns are read; anything else is stored first.
    """
    node = documents._jdf.queryExecution().optimizedPlan()
    while node.nodeName() in ("Project", "Filter"):
        node = node.children().head()
    if node.nodeName() != "LogicalRelation":
        documents = cut_lineage(documents)
    return documents.withColumn(row, F.monotonically_increasing_id())


def set_facts(documents: DataFrame, row: str) -> DataFrame:
    """(row, doc_id, n, set) of every row; rows with a ``slice`` hold that part of a task's sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(SKETCH, np.uint32)
        for batch in giving_back(batches):
            sizes, numbers = [], []
            for sets in shingle_sets(batch.column("text")):
                for members in sets:
                    sizes.append(len(members))
                    numbers.append(set_id(members))
                cells, times = np.unique(np.concatenate(sets) % np.uint64(SKETCH), return_counts=True)
                sketch[cells.astype(np.int64)] += times.astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(row), batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(numbers, pa.int64()),
                 pa.nulls(len(sizes), pa.int32()), pa.nulls(len(sizes), pa.int32()), pa.nulls(len(sizes), pa.binary())],
                names,
            )
        none, part = pa.nulls(SLICES, pa.int64()), TaskContext.get().partitionId() % SLICES
        yield pa.RecordBatch.from_arrays(
            [none, none, none, none, pa.array(np.arange(SLICES, dtype=np.int32)), pa.array(np.full(SLICES, part, np.int32)),
             pa.array([squeeze(x.tobytes()) for x in np.split(sketch, SLICES)], pa.binary())],
            names,
        )

    names = ["row", "doc_id", "n", "set", "slice", "part", "counts"]
    schema = "row long, doc_id long, n long, set long, slice int, part int, counts binary"
    return documents.select(row, "doc_id", "text").mapInArrow(run, schema)


def sketch_ranks(facts: DataFrame) -> np.ndarray:
    """Total of every sketch cell: ``SKETCH`` numbers, whatever the corpus. Tasks are summed in two steps."""

    def add(rows: pa.Table) -> pa.Table:
        total = np.zeros(SKETCH // SLICES, np.uint32)
        for packed in rows.column("counts"):
            more = np.frombuffer(expand(packed.as_py()), np.uint32)
            total = np.minimum(total.astype(np.uint64) + more, 2**32 - 1).astype(np.uint32)
        return rows.slice(0, 1).select(["slice", "part"]).append_column("counts", pa.array([squeeze(total.tobytes())], pa.binary()))

    schema = "slice int, part int, counts binary"
    parts = facts.where("slice IS NOT NULL").select("slice", "part", "counts")
    totals = parts.groupBy("slice", "part").applyInArrow(add, schema).groupBy("slice").applyInArrow(add, schema)
    rows = sorted(totals.select("slice", "counts").collect())
    return np.concatenate([np.frombuffer(expand(r["counts"]), np.uint32) for r in rows]) if rows else np.zeros(SKETCH, np.uint32)


def prefix(members: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The first n - ceil(0.8 n) + 1 members, rarest first."""
    n = len(members)
    keep = n - -(-PERCENT * n // 100) + 1
    order = np.lexsort([members, ranks[(members % np.uint64(SKETCH)).astype(np.int64)]])
    return members[order[:keep]]


def cell_rows(documents: DataFrame, ranks: np.ndarray, hot: int) -> DataFrame:
    """(key, salt, set, n): every set at each of its cells; ``salt`` spreads cells that may be large."""
    shared = documents.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = shared.value
        for batch in giving_back(batches):
            seen: set[int] = set()
            for sets in shingle_sets(batch.column("text")):
                keys, numbers, sizes = [], [], []
                for members in sets:
                    number = set_id(members)
                    if number and number not in seen:  # copies in one batch send their cells once
                        seen.add(number)
                        keys.append(prefix(members, ranks))
                        numbers.append(number)
                        sizes.append(len(members))
                if not keys:
                    continue
                times = [len(k) for k in keys]
                keys = np.concatenate(keys)
                number = np.repeat(np.array(numbers, np.int64), times)
                large = ranks[(keys % np.uint64(SKETCH)).astype(np.int64)] >= hot
                salt = np.where(large, number % SALTS + 1, 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(salt.astype(np.int32)), pa.array(number),
                     pa.array(np.repeat(np.array(sizes, np.int32), times))],
                    ["key", "salt", "set", "n"],
                )

    return documents.select("doc_id", "text").mapInArrow(run, "key long, salt int, set long, n int")


def similar_sizes(a, b):
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def meeting(rows: DataFrame) -> DataFrame:
    """The cell rows that meet another set of a size that allows a link, with a ``partner`` to compare first.

    In order of size a neighbour is the likeliest partner, so one shuffle by cell
    and one pass tell who has none. The partner is the cell's smallest set or,
    where sizes differ too much, the next smaller one. Salted cells keep all rows.
    """
    here = Window.partitionBy("key", "salt")
    ordered = here.orderBy("n", "set")
    near = lambda other: F.col(other).isNotNull() & similar_sizes(F.col("n"), F.col(f"{other}.n"))
    seen = (
        rows.repartition("key", "salt")
        .distinct()
        .withColumn("lead", F.first(F.struct("n", "set")).over(ordered))
        .withColumn("before", F.lag(F.struct("n", "set")).over(ordered))
        .withColumn("after", F.lead(F.struct("n", "set")).over(ordered))
    )
    some = seen.where(near("before") | near("after") | (F.col("salt") > 0))
    partner = F.when(near("lead"), F.col("lead.set")).when(near("before"), F.col("before.set")).otherwise(F.col("set"))
    return some.select("key", "salt", "set", "n", partner.alias("partner"), F.col("lead.set").alias("lead"), F.col("lead.n").alias("lead_n"))


def texts_of(documents: DataFrame, row: str, facts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(set, text): the text of one document of each wanted set, stored in buckets of ``set``.

    Every later join by ``set`` then moves the other side only.
    """
    first = facts.where("n > 0").groupBy("set").agg(F.min("row").alias("of"))
    ids = cut_lineage(wanted.select("set").distinct().join(first, "set").select("set", "of"))
    if ids.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    texts = documents.select(F.col(row).alias("of"), "text")
    found = texts.join(ids, "of").select("set", "text")
    buckets = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return bucketed(found.repartition(buckets, "set"), buckets, "set")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose shingle sets reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple[int | None, np.ndarray] = (None, np.zeros(0, np.uint64))
        for batch in giving_back(batches):
            good = []
            seconds = (m for sets in shingle_sets(batch.column("text_b")) for m in sets)
            firsts = batch.column("text_a")
            for i, (a, second) in enumerate(zip(batch.column("a").to_pylist(), seconds, strict=True)):
                if known[0] != a:
                    known = (a, next(shingle_sets(firsts[i : i + 1].take(pa.array([0]))))[0])
                first = known[1]
                shared = int(np.isin(second, first, assume_unique=True).sum())
                good.append(100 * shared >= PERCENT * (len(first) + len(second) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    side = lambda x: texts.select(F.col("set").alias(x), F.col("text").alias(f"text_{x}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(run, "a long, b long")


def packed_point(counts: np.ndarray) -> bytes:
    """Counts in as many bytes each as the largest needs."""
    width = 1 if counts.max() < 1 << 8 else 2 if counts.max() < 1 << 16 else 4
    return counts.astype(f"<u{width}").tobytes()


def point_of(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, f"<u{len(packed) // GROUPS}").astype(np.uint32)


def vectors(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(set, point): count vectors of the wanted sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in giving_back(batches):
            points = [packed_point(group_counts(m, GROUPS)) for sets in shingle_sets(batch.column("text")) for m in sets]
            yield pa.RecordBatch.from_arrays([batch.column("set"), pa.array(points, pa.binary())], ["set", "point"])

    return texts.join(wanted.select("set").distinct(), "set", "left_semi").mapInArrow(run, "set long, point binary")


def bundled(rows: DataFrame) -> DataFrame:
    """``rows`` with bundle numbers ``one`` and ``two``: small cells together, large ones as pairs of blocks."""
    cells = rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
    total = rows.count()
    bundles = max(1, -(-total // (BUNDLE // 2)))
    blocks = F.ceil(F.col("rows") / BUNDLE).cast("int")
    block = F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int")
    with_blocks = rows.join(cells.withColumn("blocks", blocks), "key").withColumn("block", block)
    small = with_blocks.where("blocks = 1").select(
        "set", "n", "component", F.lit(None).cast("long").alias("cell"), F.pmod("key", F.lit(bundles)).alias("one"), F.lit(0).alias("two")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    large = with_blocks.where("blocks > 1").withColumn("other", other).select(
        "set", "n", "component", F.col("key").alias("cell"), F.least("block", "other").cast("long").alias("one"), F.greatest("block", "other").alias("two")
    )
    return small.union(large).distinct()


def forest(labels: np.ndarray, i: np.ndarray, j: np.ndarray, likeness: np.ndarray) -> list[int]:
    """Places of pairs that join what ``labels`` (changed here) keep apart, the likeliest first."""
    chosen = []
    while len(apart := np.flatnonzero(labels[i] != labels[j])):
        best = int(apart[likeness[apart].argmax()])
        chosen.append(best)
        labels[labels == labels[i[best]]] = labels[j[best]]
    return chosen


def tree_pairs(rows: DataFrame, points: DataFrame, spanning: bool) -> DataFrame:
    """Pairs (a, b) of sets of different components that a bundle's R-tree lets through.

    ``spanning`` keeps of each bundle's pairs a forest that joins the same components.
    """

    def run(bundle: pa.Table) -> pa.Table:
        numbers, first = np.unique(bundle.column("set").to_numpy(), return_index=True)
        bundle = bundle.take(pa.array(first))
        sizes, component = bundle.column("n").to_numpy().astype(np.int64), bundle.column("component").to_numpy()
        points = np.stack([point_of(p) for p in bundle.column("point").to_pylist()])
        tree, out = RTree(points, sizes), [np.zeros((0, 2), np.int64)]
        labels = np.unique(component, return_inverse=True)[1].reshape(-1)
        for i, j in tree.pairs(PERCENT):
            i, j = tree.order[i], tree.order[j]
            apart = np.flatnonzero(labels[i] != labels[j])
            if spanning and len(apart):
                both = sizes[i[apart]] + sizes[j[apart]]
                shared = np.array([np.minimum(points[x], points[y]).sum() for x, y in zip(i[apart], j[apart], strict=True)])
                apart = apart[forest(labels, i[apart], j[apart], shared / both)]
            out.append(np.stack([numbers[i[apart]], numbers[j[apart]]], 1))
        pairs = np.concatenate(out)
        return pa.table({"a": np.minimum(*pairs.T), "b": np.maximum(*pairs.T)})

    dealt = bundled(rows).join(points, "set")
    return dealt.groupBy("cell", "one", "two").applyInArrow(run, "a long, b long").distinct()


def linked_sets(documents: DataFrame, row: str, facts: DataFrame) -> DataFrame | None:
    """(set, component) of the sets that link with another; None where none can."""
    docs = facts.where("slice IS NULL").count()
    ranks = sketch_ranks(facts)
    hot = int(ranks.mean() + max(1, docs * HOT_SHARE)) + 1
    rows = cut_lineage(meeting(cell_rows(documents, ranks, hot)))
    if rows.isEmpty():
        return None
    facts = facts.where("slice IS NULL")
    texts = texts_of(documents, row, facts, rows)
    leads = rows.where("salt > 0").groupBy("key").agg(F.min(F.struct("n", "set")).alias("low"), F.max(F.struct("n", "set")).alias("high"))
    leads = leads.where(F.col("low") != F.col("high")).select("key", F.col("low.set").alias("first"), F.col("low.n").alias("first_n"))
    stars = rows.select(F.col("partner").alias("a"), F.col("set").alias("b"))
    across = rows.where("salt > 0").select("key", "lead", "lead_n").distinct().join(leads, "key")
    across = across.where(similar_sizes(F.col("lead_n"), F.col("first_n"))).select(F.col("first").alias("a"), F.col("lead").alias("b"))
    pairs = stars.union(across).where("a <> b").distinct()
    links = cut_lineage(verified(pairs, texts))
    parts = cut_lineage(components(links))
    more = verified(neighbour_pairs(several(rows, parts)), texts)
    parts = joined_by(parts, more)
    left = several(rows, parts)
    points = cut_lineage(vectors(texts, left))
    parts = joined_by(parts, verified(tree_pairs(left, points, spanning=True), texts))
    return joined_by(parts, verified(tree_pairs(several(rows, parts), points, spanning=False), texts))


def joined_by(parts: DataFrame, links: DataFrame) -> DataFrame:
    """The components of ``parts`` after ``links`` join some of them, stored."""
    return cut_lineage(components(as_links(parts).union(cut_lineage(links))))


def as_links(parts: DataFrame) -> DataFrame:
    """One link for every set of a component but its smallest: fewer and shorter paths than the links found."""
    return parts.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))


def several(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """(key, set, n, component) of the cells that hold more than one component, stored.

    Cells with the same sets (the members of a shared passage) are one.
    """
    placed = rows.select("key", "set", "n").join(parts.withColumnRenamed("node", "set"), "set", "left")
    placed = placed.withColumn("component", F.coalesce("component", "set"))
    content = [F.count(F.lit(1)).alias("rows"), F.bit_xor("set").alias("x"), F.bit_xor(F.xxhash64("set")).alias("y")]
    cells = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), *content)
    one = cells.where("low <> high").groupBy("rows", "x", "y").agg(F.min("key").alias("key"))
    return cut_lineage(placed.join(one.select("key"), "key", "left_semi"))


def neighbour_pairs(left: DataFrame) -> DataFrame:
    """Pairs of neighbours in order of size within a cell that are in different components."""
    salt = F.pmod(F.xxhash64("set"), F.lit(SALTS))
    size = F.count(F.lit(1))
    large = left.groupBy("key").agg(size.alias("rows")).where(F.col("rows") > BUNDLE).select("key", F.lit(True).alias("large"))
    dealt = left.join(large, "key", "left").withColumn("salt", F.when(F.col("large"), salt).otherwise(0))
    here = Window.partitionBy("key", "salt").orderBy("n", "set")
    before = F.lag(F.struct("n", "set", "component")).over(here)
    near = dealt.withColumn("before", before).where(F.col("before").isNotNull())
    near = near.where((F.col("before.component") != F.col("component")) & similar_sizes(F.col("n"), F.col("before.n")))
    return near.select(F.least("set", "before.set").alias("a"), F.greatest("set", "before.set").alias("b")).distinct()


def grouped(documents: DataFrame, row: str) -> DataFrame:
    """(row, doc_id, n, component) of every row of ``documents``, which are ``numbered`` in column ``row``."""
    facts = cut_lineage(set_facts(documents, row))
    sets = linked_sets(documents, row, facts)
    docs = facts.where("slice IS NULL").select("row", "doc_id", "n", "set")
    if sets is None:
        found = docs.withColumn("component", F.col("set"))
    else:
        found = docs.join(sets.withColumnRenamed("node", "set"), "set", "left")
        found = found.withColumn("component", F.coalesce("component", "set"))
    return found.select("row", "doc_id", "n", "component")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    row = unused("_row", documents.columns)
    found = grouped(numbered(documents, row), row)
    names = found.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    joined = found.join(names, "component", "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def one_of_each(documents: DataFrame) -> DataFrame:
    """One row of each group, the first by (doc_id, row) with null ids last; the columns stay.

    Rows are told apart by number, so rows that repeat a doc_id or have none are
    documents of their own. Those without a word link with nothing and stay all.
    """
    row = unused("_row", documents.columns)
    rows = numbered(documents, row)
    found = grouped(rows, row)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    first = found.where("n > 0").groupBy("component").agg(F.min(order).alias("first")).select(F.col("first.row").alias(row))
    names = cut_lineage(first.union(found.where("n = 0").select("row")))
    if names.count() <= BROADCAST_ROWS:
        names = F.broadcast(names)
    return rows.join(names, row, "left_semi").select(*[F.col(quoted(c)) for c in documents.columns])


def op2_jaccard(spark, sf_dir) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP2_SQL = r"""
WITH w AS (
  SELECT doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'),
    lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS ws
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh
  FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS i
  FROM e x JOIN e y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p WHERE 100 * i >= 80 * (na + nb - i)),
r AS (
  WITH RECURSIVE t AS (
    SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT t.a, l.b FROM t JOIN l ON t.b = l.a)
  SELECT a, min(b) AS component_id FROM t GROUP BY a)
SELECT doc_id, len(sh)::BIGINT AS n_shingles, component_id FROM s JOIN r ON doc_id = a
"""

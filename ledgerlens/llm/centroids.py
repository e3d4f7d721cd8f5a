"""Clustering of integer vectors around centroids with scalar lookup tables (operator 12).

Components become integers, so every sum and distance is exact and reruns agree.
In each round a task tabulates, for every dimension, the squared difference of
each integer that occurs there to each centroid; a vector's distances are the sum
of one table row per dimension. Per cluster and task one row of sums leaves, and
the next centroids are k rows of integers on the driver, whatever the table's size.

* Vectors take part that have exactly ``dimensions`` components, none null or
  non-finite. Others give no row.
* Integers beyond 2**27 either way raise ValueError: their squared distances would
  pass 64 bits, as ANSI arithmetic would report.
* Rows without vec_id are clustered but start no centroid. Rows that share a
  vec_id are separate vectors; among their equal hashes the smaller vector starts
  first. Equal start vectors give equal centroids, of which the smaller number wins
  ties and the others stay as they are.
* Fewer vectors than ``k`` give as many centroids. With no vector that has an id
  there is none: cluster, distance and the rest are null. Empty tables give no
  rows. Columns other than vec_id and embedding are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import cut_lineage

CLUSTERS = 40
ROUNDS = 5
DIMENSIONS = 64
SCALE = 256
SEED = 2
LARGEST = 1 << 27
#: Vectors whose distances are computed at once.
BLOCK = 4096


def whole_vectors(vectors: DataFrame, dimensions: int, scale: int) -> DataFrame:
    """(vec_id, packed): components as 32-bit integers floor(scale * x), little-endian."""
    known = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.coalesce((F.size("embedding") == dimensions) & known, F.lit(False))
    rows = vectors.where(good).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.floor(batch.column("embedding").flatten().to_numpy(zero_copy_only=False) * scale)
            if len(values) and np.abs(values).max() > LARGEST:
                raise ValueError(f"a component times {scale} is beyond {LARGEST}; squared distances would pass 64 bits")
            raw = values.astype("<i4").tobytes()
            width = 4 * dimensions
            packed = [raw[i : i + width] for i in range(0, len(raw), width)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(packed, pa.binary())], ["vec_id", "packed"])

    return rows.mapInArrow(run, "vec_id long, packed binary")


def unpacked(column: pa.Array, dimensions: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, dimensions)


def first_centroids(rows: DataFrame, k: int, seed: int, dimensions: int) -> np.ndarray:
    """The ``k`` vectors with the smallest hash of seed and vec_id; k rows come to the driver."""
    hashed = rows.where(F.col("vec_id").isNotNull()).select(
        F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).alias("hash"), "vec_id", "packed"
    )
    # Among rows of one id the components decide, compared as numbers.
    first = hashed.orderBy("hash").limit(k).agg(F.max("hash")).first()[0]
    if first is None:
        return np.zeros((0, dimensions), np.int64)
    tied = sorted_by_vector(hashed.where(F.col("hash") <= first), dimensions).limit(k).collect()
    return np.array([np.frombuffer(bytes(row.packed), "<i4") for row in tied], np.int64)


def sorted_by_vector(hashed: DataFrame, dimensions: int) -> DataFrame:
    """By hash, then by the vector. Flipping the sign bit makes big-endian bytes sort as the numbers do."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = unpacked(batch.column("packed"), dimensions).view("<u4") ^ np.uint32(1 << 31)
            raw, width = numbers.astype(">u4").tobytes(), 4 * dimensions
            keys = [raw[i : i + width] for i in range(0, len(raw), width)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], [*batch.schema.names, "key"])

    keyed = hashed.mapInArrow(run, "hash string, vec_id long, packed binary, key binary")
    return keyed.orderBy("hash", "key")


def assigned(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid (smallest number of equals) and squared distance of each vector, from lookup tables."""
    n, dimensions = vectors.shape
    codes, tables = [], []
    for j in range(dimensions):
        occurring, code = np.unique(vectors[:, j], return_inverse=True)
        gap = occurring[:, None].astype(np.int64) - centroids[None, :, j]
        codes.append(code)
        tables.append(gap * gap)
    cluster, distance = np.empty(n, np.int32), np.empty(n, np.int64)
    for i in range(0, n, BLOCK):
        block = slice(i, min(i + BLOCK, n))
        total = np.zeros((block.stop - i, len(centroids)), np.int64)
        for code, table in zip(codes, tables, strict=True):
            total += table[code[block]]
        cluster[block] = total.argmin(1)
        distance[block] = total[np.arange(len(total)), cluster[block]]
    return cluster, distance


def sums_of(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Per task and non-empty cluster: how many vectors, and the sums of their components."""
    k, dimensions = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dimensions), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            if len(batch):
                vectors = unpacked(batch.column("packed"), dimensions)
                cluster, _ = assigned(vectors, centroids)
                order = np.argsort(cluster, kind="stable")
                present, first = np.unique(cluster[order], return_index=True)
                sums[present] += np.add.reduceat(vectors[order], first, axis=0, dtype=np.int64)
                counts += np.bincount(cluster, minlength=k)
        some = np.flatnonzero(counts)
        columns = [some.astype(np.int32), counts[some], pa.array(list(sums[some]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["cluster", "rows", "sums"])

    return rows.mapInArrow(run, "cluster int, rows long, sums array<long>")


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids replaced by floor(sum / count) of their vectors; empty ones stay."""
    wide = "decimal(38,0)"
    totals = (
        sums_of(rows, centroids)
        .select("cluster", "rows", F.posexplode("sums").alias("place", "sum"))
        .groupBy("cluster", "place")
        .agg(F.sum(F.col("rows").cast(wide)).alias("rows"), F.sum(F.col("sum").cast(wide)).alias("sum"))
    )
    out = centroids.copy()
    for row in totals.collect():  # k times dimensions rows
        out[row.cluster, row.place] = int(row["sum"]) // int(row.rows)
    return out


def clustered(
    vectors: DataFrame,
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: int = SEED,
) -> DataFrame:
    """Each vector's cluster and distance after ``rounds``, with sums of distances and the centroid's digest."""
    spark = vectors.sparkSession
    rows = cut_lineage(whole_vectors(vectors, dimensions, scale))
    centroids = first_centroids(rows, k, seed, dimensions)
    if not len(centroids):
        blank = {"cluster": "int", "distance": "long", "cluster_inertia": "long", "inertia": "long", "centroid_sha256": "string"}
        return rows.select("vec_id", *[F.lit(None).cast(kind).alias(name) for name, kind in blank.items()])
    for _ in range(rounds):
        centroids = moved(rows, centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                cluster, distance = assigned(unpacked(batch.column("packed"), dimensions), centroids)
                columns = [batch.column("vec_id"), pa.array(cluster), pa.array(distance)]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    found = cut_lineage(rows.mapInArrow(run, "vec_id long, cluster int, distance long"))
    # k rows at most.
    inertia = {r.cluster: r.inertia for r in found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    about = [
        (cluster, part, sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[cluster].tolist())).encode()).hexdigest())
        for cluster, part in inertia.items()
    ]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    facts = F.broadcast(spark.createDataFrame(about, schema))
    return found.join(facts, "cluster").select("vec_id", "cluster", "distance", *facts.columns[1:])


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _sql() -> str:
    parts = [
        f"""WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding::DOUBLE[], lambda x: floor({SCALE} * x)::BIGINT) AS e
  FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT r, generate_subscripts(e, 1) AS j, unnest(e) AS x FROM v),
s AS (
  SELECT r, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id::VARCHAR), e) - 1 AS c
  FROM v WHERE vec_id IS NOT NULL QUALIFY c < {CLUSTERS}),
c0 AS MATERIALIZED (SELECT c, j, x FROM s JOIN x USING (r))"""
    ]
    for n in range(ROUNDS + 1):
        parts.append(
            f"""d{n} AS (SELECT x.r, c.c, sum((x.x - c.x) * (x.x - c.x))::BIGINT AS d FROM x JOIN c{n} c USING (j) GROUP BY ALL),
a{n} AS MATERIALIZED (SELECT r, c, d FROM d{n} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)"""
        )
        if n < ROUNDS:
            parts.append(
                f"""m{n} AS (
  SELECT a.c, x.j, floor_div(sum(x.x), count(*)) AS x FROM a{n} a JOIN x USING (r) GROUP BY ALL),
c{n + 1} AS MATERIALIZED (SELECT c, j, coalesce(m.x, o.x) AS x FROM c{n} o LEFT JOIN m{n} m USING (c, j))"""
            )
    # Integer division drops the fraction; below zero the floor is one less.
    sql = ",\n".join(parts).replace(
        "floor_div(sum(x.x), count(*))",
        "(sum(x.x) // count(*) - CASE WHEN sum(x.x) < 0 AND sum(x.x) % count(*) <> 0 THEN 1 ELSE 0 END)::BIGINT",
    )
    return f"""{sql},
h AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY j)) AS h FROM c{ROUNDS} GROUP BY c)
SELECT vec_id, a.c::INT AS cluster, d AS distance, sum(d) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia,
  sum(d) OVER ()::BIGINT AS inertia, h AS centroid_sha256
FROM v LEFT JOIN a{ROUNDS} a USING (r) LEFT JOIN h ON h.c = a.c"""


OP12_SQL = _sql()

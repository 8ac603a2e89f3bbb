"""Operator 13: centroid clustering over a vector-approximation file."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barstream.llm.common import stored, work_folder
from barstream.llm.vectors import SUMS, integers, matrix, means, per_task, squared, total, usable

DIMS, CENTROIDS, ROUNDS = 64, 8, 10
#: Bits of a cell.  Any number gives the same clusters; more bits fetch fewer vectors.
BITS = 6
#: Vectors (those of smallest hash) that the cell borders are read from, and vectors of a bucket of the stored file.
BORDER_ROWS, BUCKET_ROWS = 4_096, 1 << 20


@dataclass
class VectorFile:
    """Full vectors (ident, key, _x), bucketed by ident, and their cells (ident, cells) in a table of its own.

    ``low`` and ``high`` hold, per dimension and cell, the least and greatest
    component less ``origin``.
    """

    vectors: DataFrame
    cells: DataFrame | None
    dims: int
    origin: np.ndarray
    low: list[np.ndarray]
    high: list[np.ndarray]

    def intervals(self, centroids: np.ndarray) -> list[np.ndarray]:
        """Per dimension a lookup table (cell, 2 * centroid): what the cell adds, at least and at most.

        The squared distance of x and c, both taken from the origin, is
        ``|x|**2 + |c|**2 - 2 x c``.  The first term is the same for all
        centroids, so the tables bound the rest, which makes them narrower.
        """
        c = centroids - self.origin
        tables = []
        for j, (low, high) in enumerate(zip(self.low, self.high)):
            a, b = -2 * np.outer(low, c[:, j]), -2 * np.outer(high, c[:, j])
            tables.append(np.hstack([np.minimum(a, b) + c[:, j] ** 2, np.maximum(a, b) + c[:, j] ** 2]))
        return tables


def decided(cells: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    """Nearest centroid by the intervals alone; -1 where that of another reaches below the least upper end."""
    n, k = len(cells), tables[0].shape[1] // 2
    ends = np.zeros((n, 2 * k), np.int64)
    for j, table in enumerate(tables):
        ends += table[cells[:, j]]
    lower, upper = ends[:, :k], ends[:, k:]
    best, rows = upper.argmin(axis=1), np.arange(n)
    least = upper[rows, best]
    lower[rows, best] = np.iinfo(np.int64).max
    return np.where((lower > least[:, None]).all(axis=1), best, -1)


def write_file(df: DataFrame, key: str, vector: str, dims: int = DIMS, bits: int = BITS) -> VectorFile:
    """Write the usable vectors of ``dims`` components and their cells."""
    if not 0 < bits <= 7:
        raise ValueError("a cell takes 1 to 7 bits")
    spark = df.sparkSession
    rows = df.where((F.size(vector) == dims) & usable(vector)).select(F.col(key).alias("key"), integers(vector).alias("_x"))
    rows = stored(rows.withColumn("ident", F.monotonically_increasing_id()), "vectors")
    # as many buckets as a shuffle has partitions at least: else Spark would shuffle the vectors to join them
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // BUCKET_ROWS))
    name, schema = f"vectors_{uuid.uuid4().hex}", rows.schema
    rows.repartition(buckets, "ident").write.bucketBy(buckets, "ident").option("path", work_folder(spark, "bucketed")).saveAsTable(name)
    vectors = spark.table(name)
    sample = rows.orderBy(F.xxhash64("ident"), "ident").select("_x").limit(BORDER_ROWS).collect()
    if not sample:
        return VectorFile(spark.createDataFrame([], schema), None, dims, np.zeros(dims, np.int64), [], [])

    sample = np.array([r["_x"] for r in sample], np.int64)
    shares = np.arange(1, 1 << bits) / (1 << bits)
    borders = [np.unique(np.quantile(sample[:, j], shares, method="higher").astype(np.int64)) for j in range(dims)]
    low, high = _limits(rows, dims)
    origin = sample.sum(axis=0) // len(sample)

    def cells_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), dims)
            cells = np.stack([np.searchsorted(b, x[:, j], side="right") for j, b in enumerate(borders)], axis=1).astype(np.int8)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * dims), pa.array(cells.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["ident", "cells"])

    cells = stored(rows.select("ident", "_x").mapInArrow(cells_of, "ident bigint, cells array<tinyint>"), "cells")
    lows = [np.r_[min(low[j], b[0]), b] - origin[j] for j, b in enumerate(borders)]
    highs = [np.r_[b - 1, max(high[j], b[-1])] - origin[j] for j, b in enumerate(borders)]
    return VectorFile(vectors, cells, dims, origin, lows, highs)


def _limits(rows: DataFrame, dims: int) -> tuple[list[int], list[int]]:
    """Least and greatest component of every dimension over all vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(x.min(axis=0), x.max(axis=0)) for x in (matrix(b.column(0), dims) for b in batches if b.num_rows)]
        if parts:
            low, high = np.min([a for a, _ in parts], axis=0), np.max([b for _, b in parts], axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims)), pa.array(low), pa.array(high)], ["dim", "low", "high"])

    found = rows.select("_x").mapInArrow(run, "dim bigint, low bigint, high bigint")
    every = found.groupBy("dim").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("dim").collect()
    return [r["low"] for r in every], [r["high"] for r in every]


def start(file: VectorFile, k: int = CENTROIDS, seed: str = "3:") -> np.ndarray:
    """The vectors whose keys have the smallest sha256, null keys last, of equal keys the smaller components first."""
    digest = F.sha2(F.concat(F.lit(seed), F.col("key").cast("string")), 256)
    first = file.vectors.orderBy(F.asc_nulls_last(digest), "_x").select("_x").limit(k).collect()
    return np.array([r["_x"] for r in first], np.int64).reshape(-1, file.dims)


def undecided(file: VectorFile, old: np.ndarray, new: np.ndarray) -> DataFrame:
    """(ident, before, now) of the vectors that the cells leave open or that change their centroid; -1: open."""
    before_tables, now_tables = file.intervals(old), file.intervals(new)
    dims = file.dims

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = matrix(batch.column(1), dims)
                before, now = decided(cells, before_tables), decided(cells, now_tables)
                rows = np.flatnonzero((before < 0) | (now < 0) | (before != now))
                ident = batch.column(0).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([ident, pa.array(before[rows].astype(np.int32)), pa.array(now[rows].astype(np.int32))], ["ident", "before", "now"])

    return file.cells.mapInArrow(run, "ident bigint, before int, now int")


def cluster(file: VectorFile, centroids: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The centroids after ``rounds`` rounds of assignment and floor means.

    The first round reads every vector.  A later one starts from the sums of
    the one before: the cells say which vectors surely stay where they are, and
    only the others are fetched, by a join that shuffles their numbers to the
    buckets of the vectors, and moved from sum to sum.  A round without change
    ends the search, as all further ones would repeat it.
    """
    k, dims = len(centroids), file.dims
    if not k:
        return centroids

    def first(sums, batch):
        x = matrix(batch.column(0), dims)
        sums.add(squared(x, centroids).argmin(axis=1), x)

    n, totals = total(file.vectors.select("_x").mapInArrow(per_task(dims, k, first), SUMS), k, dims)
    old, new = centroids, means(centroids, n, totals)
    for _ in range(rounds - 1):
        if (old == new).all():
            break

        def moved(sums, batch, old=old, new=new):
            x = matrix(batch.column(0), dims)
            before, now = (batch.column(i).to_numpy(zero_copy_only=False).copy() for i in (1, 2))
            for known, among in ((before, old), (now, new)):
                rows = np.flatnonzero(known < 0)
                known[rows] = squared(x[rows], among).argmin(axis=1)
            rows = np.flatnonzero(before != now)
            sums.add(before[rows], x[rows], -1)
            sums.add(now[rows], x[rows])

        fetched = file.vectors.select("ident", "_x").join(undecided(file, old, new).hint("shuffle_hash"), "ident")
        more_n, more = total(fetched.select("_x", "before", "now").mapInArrow(per_task(dims, k, moved), SUMS), k, dims)
        n = [a + b for a, b in zip(n, more_n)]
        totals = [[a + b for a, b in zip(x, y)] for x, y in zip(totals, more)]
        old, new = new, means(new, n, totals)
    return new


def assign(file: VectorFile, centroids: np.ndarray) -> DataFrame:
    """key, cluster and squared distance of every vector.  Every distance is asked for, so every vector is read."""
    dims = file.dims

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = squared(matrix(batch.column(1), dims), centroids)
            near = d.argmin(axis=1) if d.size else np.empty(0, np.int64)
            columns = [batch.column(0), pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near])]
            yield pa.RecordBatch.from_arrays(columns, ["key", "cluster", "distance"])

    kind = file.vectors.schema["key"].dataType.simpleString()
    return file.vectors.select("key", "_x").mapInArrow(run, f"key {kind}, cluster int, distance bigint")


def centroid_clusters(df: DataFrame, key: str = "vec_id", vector: str = "embedding", dims: int = DIMS, k: int = CENTROIDS, rounds: int = ROUNDS, bits: int = BITS) -> DataFrame:
    """key, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every usable vector.

    A vector is left out if it is null, has another length than ``dims``, or a
    component that is null, not finite or LIMIT or more.  Repeated rows each
    come back and count each.  Fewer vectors than centroids make fewer
    clusters; an empty table gives no rows.  Of equally near centroids the one
    of the smaller number is taken.  Other columns are not read.
    """
    columns = df.select(F.col(key).alias("_key"), F.col(vector).alias("_vector"))
    file = write_file(columns, "_key", "_vector", dims, bits)
    centroids = cluster(file, start(file, k), rounds)
    rows = stored(assign(file, centroids), "clusters")
    inertia = rows.groupBy(F.col("cluster").alias("_of")).agg(F.sum("distance").alias("cluster_inertia")).collect()
    text = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    facts = [(r["_of"], r["cluster_inertia"], sum(x["cluster_inertia"] for x in inertia), text[r["_of"]]) for r in inertia]
    small = df.sparkSession.createDataFrame(facts, "_of int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    # one row a centroid
    out = rows.join(F.broadcast(small), F.col("cluster") == F.col("_of"))
    return out.select(F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

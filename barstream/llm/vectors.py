"""Integer vectors, exact distances and sums per group: what the vector operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Components become floor(SCALE * x); beyond LIMIT a component counts as non-finite (squared distances fit 64 bits).
SCALE, LIMIT = 1024, 32_768.0
#: Groups are broadcast up to this count and joined by shuffle beyond it.
BROADCAST_GROUPS = 500_000


def usable(vector: str) -> Column:
    """True where the vector is there and every component is a number below LIMIT."""
    good = F.forall(F.col(vector), lambda x: F.coalesce(F.abs(x.cast("double")) < LIMIT, F.lit(False)))
    return F.coalesce(good, F.lit(False))


def integers(vector: str) -> Column:
    return F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * SCALE).cast("int"))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """An Arrow list column of equal lengths as integers, a row a vector."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row of ``x`` to every row of ``y``."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(y).max(initial=0)))
    if 4 * x.shape[1] * most * most < 2**53:  # every sum is exact in doubles
        a, b = x.astype(np.float64), y.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * a @ b.T + (b * b).sum(axis=1)).astype(np.int64)
    return np.stack([((x - e) ** 2).sum(axis=1) for e in y], axis=1)


class Sums:
    """Counts and sums of vectors by group number, gathered over a task."""

    def __init__(self, groups: int, dims: int):
        self.n, self.sums = np.zeros(groups, np.int64), np.zeros((groups, dims), np.int64)

    def add(self, groups: np.ndarray, x: np.ndarray, sign: int = 1) -> None:
        if len(groups):
            order = np.argsort(groups, kind="stable")
            found, starts = np.unique(groups[order], return_index=True)
            self.n[found] += sign * np.diff(np.r_[starts, len(order)])
            self.sums[found] += sign * np.add.reduceat(x[order], starts, axis=0)

    def batch(self) -> pa.RecordBatch:
        met = np.flatnonzero((self.n != 0) | (self.sums != 0).any(axis=1))
        columns = [pa.array(met.astype(np.int32)), pa.array(self.n[met]), pa.array(self.sums[met].tolist(), pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, ["slot", "n", "sums"])


SUMS = "slot int, n bigint, sums array<bigint>"


def total(partial: DataFrame, groups: int, dims: int) -> tuple[list[int], list[list[int]]]:
    """Counts and sums per group of all tasks, as unbounded integers: a number per group and component comes to the driver."""
    n, sums = [0] * groups, [[0] * dims for _ in range(groups)]
    each = partial.select("slot", "n", F.posexplode("sums").alias("place", "s")).groupBy("slot", "place")
    for row in each.agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():
        n[row["slot"]], sums[row["slot"]][row["place"]] = row["n"], int(row["s"])
    return n, sums


def means(old: np.ndarray, n: list[int], sums: list[list[int]]) -> np.ndarray:
    """Componentwise floor(sum / count); a group without vectors keeps its old one."""
    return np.array([[s // k for s in row] if k else list(e) for e, k, row in zip(old, n, sums)], np.int64).reshape(old.shape)


def per_task(dims: int, groups: int, add) -> callable:
    """An Arrow function that lets ``add(sums, batch)`` gather a task's batches and yields the sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(groups, dims)
        for batch in batches:
            if batch.num_rows:
                add(sums, batch)
        yield sums.batch()

    return run


def small(groups: DataFrame) -> DataFrame:
    """Broadcast, if counted small."""
    return F.broadcast(groups) if groups.count() <= BROADCAST_GROUPS else groups


def with_group_sum(rows: DataFrame, by: str, value: str, name: str) -> DataFrame:
    """Add the value summed over equal ``by``, nulls being equal; ``rows`` is a stored table."""
    groups = rows.groupBy(F.col(by).alias("__by")).agg(F.sum(value).alias(name))
    return rows.join(small(groups), rows[by].eqNullSafe(groups["__by"]), "left").drop("__by")

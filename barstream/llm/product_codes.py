"""Operator 11: vectors as codes of their parts, by equal-average search of the codebooks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barstream.llm.common import stored
from barstream.llm.vectors import SUMS, integers, matrix, means, per_task, squared, total, usable, with_group_sum

PARTS, ENTRIES, ROUNDS = 4, 256, 4
#: Parts that are searched together, neighbours by their sums, and entries by which their window grows on a side.
BLOCK, STEP = 256, 16


class SortedBook:
    """A codebook in the order of its entries' component sums.

    The squared gap of two sums, over the dimension, is at most the squared
    distance.  So the search expands outward from a part's own sum, and a side
    is done when that bound strictly exceeds the best distance; at equality an
    entry of a lower index may still follow.
    """

    def __init__(self, entries: np.ndarray):
        sums = entries.sum(axis=1)
        self.index = np.argsort(sums, kind="stable")
        self.entries, self.sums = entries[self.index], sums[self.index]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index (the lower of equals) and squared distance of every part's nearest entry."""
        sums = parts.sum(axis=1)
        order = np.argsort(sums, kind="stable")
        index, distance = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
        for at in range(0, len(parts), BLOCK):
            rows = order[at : at + BLOCK]
            index[rows], distance[rows] = self._expand(parts[rows], sums[rows])
        return index, distance

    def _expand(self, parts: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size, dims = self.entries.shape
        best, index = np.full(len(parts), np.iinfo(np.int64).max // dims, np.int64), np.full(len(parts), size, np.int64)

        def look(rows, begin, end):
            d = squared(parts[rows], self.entries[begin:end])
            least = d.min(axis=1)
            first = np.where(d == least[:, None], self.index[begin:end], size).min(axis=1)
            better = (least < best[rows]) | ((least == best[rows]) & (first < index[rows]))
            best[rows[better]], index[rows[better]] = least[better], first[better]

        left = right = int(np.searchsorted(self.sums, sums[len(sums) // 2]))
        while True:
            gap_below = np.maximum(sums - self.sums[left - 1], 0) if left else None
            gap_above = np.maximum(self.sums[right] - sums, 0) if right < size else None
            below = np.flatnonzero(gap_below**2 <= dims * best) if left else np.empty(0, np.int64)
            above = np.flatnonzero(gap_above**2 <= dims * best) if right < size else np.empty(0, np.int64)
            if not len(below) and not len(above):
                return index, best
            if len(below):
                look(below, max(0, left - STEP), left)
                left = max(0, left - STEP)
            if len(above):
                look(above, right, min(size, right + STEP))
                right = min(size, right + STEP)


def _cut(x: np.ndarray, parts: int) -> list[np.ndarray]:
    return np.split(x, parts, axis=1)


def kept_vectors(df: DataFrame, key: str, vector: str, parts: int, *columns: str) -> tuple[DataFrame, int]:
    """Stored rows (key, columns, ``_x``: integer components) of the vectors to encode, and their dimension."""
    rows = df.where((F.size(vector) > 0) & (F.size(vector) % parts == 0) & usable(vector))
    rows = stored(rows.select(key, *columns, integers(vector).alias("_x")), "vectors")
    common = rows.groupBy(F.size("_x").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    return rows.where(F.size("_x") == common["dims"]) if common else rows, common["dims"] if common else parts


def fit(rows: DataFrame, key: str, dims: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks, one a part: the first vectors by key (then by components), refined in ``rounds``."""
    first = rows.orderBy(F.asc_nulls_last(key), "_x").select("_x").limit(entries).collect()
    books = _cut(np.array([r["_x"] for r in first], np.int64).reshape(-1, dims), parts)
    size = len(first)
    for _ in range(rounds if size else 0):
        sorted_books = [SortedBook(b) for b in books]

        def add(sums, batch, searched=sorted_books):
            for part, (x, book) in enumerate(zip(_cut(matrix(batch.column(0), dims), parts), searched)):
                sums.add(part * size + book.nearest(x)[0], x)

        gathered = rows.select("_x").mapInArrow(per_task(dims // parts, parts * size, add), SUMS)
        n, sums = total(gathered, parts * size, dims // parts)
        books = [means(b, n[p * size : (p + 1) * size], sums[p * size : (p + 1) * size]) for p, b in enumerate(books)]
    return books


def encode(rows: DataFrame, books: list[np.ndarray], dims: int) -> DataFrame:
    """The rows without ``_x``, with ``code`` (two hex digits a part) and ``error`` (squared distance to the entries)."""
    columns = [c for c in rows.columns if c != "_x"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searched = [SortedBook(b) for b in books]
        for batch in batches:
            x = matrix(batch.column(batch.num_columns - 1), dims)
            found = [book.nearest(part) for book, part in zip(searched, _cut(x, len(books)))]
            codes = np.stack([i for i, _ in found], axis=1).astype(np.uint8)
            error = sum(d for _, d in found)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(columns))), pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(error, pa.int64())],
                [*columns, "code", "error"],
            )

    schema = T.StructType([rows.schema[c] for c in columns] + T._parse_datatype_string("code string, error bigint").fields)
    return rows.select(*columns, "_x").mapInArrow(run, schema)


def digest(books: list[np.ndarray]) -> str:
    """sha256 of all components by part, entry and position."""
    return hashlib.sha256(",".join(str(int(v)) for b in books for e in b for v in e).encode()).hexdigest()


def product_codes(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """key, code, error, label_error and codebooks_sha256 of every usable vector; at most 256 entries a part.

    A vector is left out if it is null or has a component that is null, not
    finite or LIMIT or more, if its length is not that of most vectors (the
    shorter of equals), or if ``parts`` doesn't divide its length.  Repeated
    rows each come back.  Null keys come after all others when the codebooks
    start; of equal keys the smaller components come first.  Fewer vectors than
    entries make a smaller codebook; an empty table gives no rows.  Equal
    labels, nulls among them, share ``label_error``.  Other columns are not
    read.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    columns = df.select(F.col(key).alias("_key"), F.col(label).alias("_label"), F.col(vector).alias("_vector"))
    rows, dims = kept_vectors(columns, "_key", "_vector", parts, "_label")
    books = fit(rows, "_key", dims, parts, entries, rounds)
    coded = stored(encode(rows, books, dims), "codes")
    out = with_group_sum(coded, "_label", "error", "label_error")
    return out.select(F.col("_key").alias(key), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))

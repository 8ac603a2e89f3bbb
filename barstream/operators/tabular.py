"""Tabular preparation: scaling, correlation, selection, class balance."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barstream.functions.columns import DIGESTS, hash_digest, ratio


def standardize(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace columns by (x - mean) / population deviation (0 if constant).

    Mean and deviation come from one aggregation used as a scalar subquery.
    """
    stats = [F.avg(c).alias(f"m_{c}") for c in columns] + [F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    row = df.agg(F.struct(*stats).alias("stats")).scalar()
    scaled = {
        c: F.when(F.col(c).isNotNull(), ratio(F.col(c) - row[f"m_{c}"], row[f"s_{c}"])) for c in columns
    }
    return df.withColumns(scaled)


def _centred(rows: DataFrame, columns: list[str]) -> tuple[DataFrame, set[str]]:
    """Rows with each column's mean taken off, and the constant columns: one aggregation, two numbers a column."""
    facts = [f(c).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("m", F.avg), ("lo", F.min), ("hi", F.max))]
    one = rows.agg(*facts).first()
    constant = {c for i, c in enumerate(columns) if one[f"lo{i}"] == one[f"hi{i}"]}
    means = {c: F.col(c) - F.lit(one[f"m{i}"]) for i, c in enumerate(columns) if one[f"m{i}"] is not None}
    return rows.withColumns(means), constant


def _products(rows: DataFrame, left: list[str], right: list[str]) -> dict[tuple[str, str], float]:
    """Sums of products of centred columns, left x right: tasks sum up their rows as matrices, Spark adds the sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(left), len(right)))
        for batch in batches:
            values = np.column_stack([batch.column(i).to_numpy() for i in range(batch.num_columns)])
            total += values[:, : len(left)].T @ values[:, len(left) :]
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], ["i", "j", "s"])

    wide = rows.select(*[F.col(c).alias(f"l{i}") for i, c in enumerate(left)], *[F.col(c).alias(f"r{i}") for i, c in enumerate(right)])
    sums = wide.mapInArrow(run, "i bigint, j bigint, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    return {(left[r["i"]], right[r["j"]]): r["s"] for r in sums.collect()}


def _pearson(product: float, a: float, b: float) -> float | None:
    """NULL where a spread is nil."""
    if not (a > 0 and b > 0):
        return None
    scale = math.sqrt(a * b)
    if not 0 < scale < math.inf:  # the product of very small or large spreads is no double
        scale = math.sqrt(a) * math.sqrt(b)
    return max(-1.0, min(1.0, product / scale))


def _complete(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) for c in columns]).na.drop()


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson matrix in long form: (x, y, correlation), by one definition for any number of columns.

    Rows with a missing value are left out; a constant column has NULL.  Only
    columns x columns numbers come back from the tasks.
    """
    columns = list(columns)
    rows, constant = _centred(_complete(df, columns), columns)
    sums = _products(rows, columns, columns)
    spread = {c: 0.0 if c in constant else sums.get((c, c), 0.0) for c in columns}
    cells = [(x, y, _pearson(sums.get((x, y), 0.0), spread[x], spread[y])) for x in columns for y in columns]
    return df.sparkSession.createDataFrame(cells, "x string, y string, correlation double")


def select_features(
    df: DataFrame, columns: list[str], label: str, k: int | None = None, threshold: float | None = None
) -> DataFrame:
    """(feature, correlation) of the k features nearest to the label by
    absolute correlation, or of all that reach ``threshold``.

    Each feature meets the label alone, in one aggregation; a constant column has NULL.
    The division is left to the driver: Spark's own ``corr`` fails on a constant column.
    """
    columns = list(columns)
    rows = _complete(df, [*columns, label])
    facts = [f(c).alias(f"{n}{i}") for i, c in enumerate([*columns, label]) for n, f in (("lo", F.min), ("hi", F.max), ("v", F.var_pop))]
    one = rows.agg(*facts, *[F.covar_pop(c, label).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    varied = [one[f"lo{i}"] is not None and one[f"lo{i}"] < one[f"hi{i}"] for i in range(len(columns) + 1)]
    last = one[f"v{len(columns)}"]
    cells = [(c, _pearson(one[f"c{i}"], one[f"v{i}"], last) if varied[i] and varied[-1] else None) for i, c in enumerate(columns)]
    table = df.sparkSession.createDataFrame(cells, "feature string, correlation double")
    strength = F.abs("correlation")
    if threshold is not None:
        table = table.where(strength >= threshold)
    table = table.orderBy(F.desc_nulls_last(strength), "feature")
    return table.limit(k) if k is not None else table


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weight per class: rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    facts = counts.agg(F.struct(F.sum("n").alias("rows"), F.count("*").alias("classes")).alias("f")).scalar()
    weight = facts["rows"].cast("double") / (facts["classes"] * F.col("n"))
    return counts.withColumn("weight", weight)


def with_class_weights(df: DataFrame, label: str = "label", output: str = "weight") -> DataFrame:
    """Add the balanced weight of a 0/1 label, without a join."""
    facts = df.agg(
        F.struct(F.count("*").alias("n"), F.count_if(F.col(label) == 1).alias("pos")).alias("f")
    ).scalar()
    own = F.when(F.col(label) == 1, facts["pos"]).otherwise(facts["n"] - facts["pos"])
    return df.withColumn(output, facts["n"].cast("double") / (2 * own))


def downsample(df: DataFrame, keys: list[str], label: str = "label", seed: int = 42) -> DataFrame:
    """All rows of the rarer class of a 0/1 label and a hash-picked share of
    the other, about equally many.  The pick depends on the row key only."""
    facts = df.agg(
        F.struct(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")).alias("f")
    ).scalar()
    own = F.when(F.col(label) == 1, facts["pos"]).otherwise(facts["neg"])
    rare = F.least(facts["pos"], facts["neg"])
    digest = hash_digest(*keys, seed=seed).cast("double")
    return df.where(digest * own.cast("double") < DIGESTS * rare.cast("double"))

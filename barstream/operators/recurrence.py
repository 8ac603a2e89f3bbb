"""Exponential smoothing per key: y_t = (1 - a) * y_{t-1} + a * u_t, y_0 = u_0.

No window aggregate expresses a recurrence, so rows are shuffled once by key,
sorted by the JVM (which spills) and streamed through an Arrow function that
keeps only the running state: its memory does not grow with the key.  Within a
batch the recurrence is an associative scan over numpy arrays.

Of an ordered table (see slicing) each part is scanned by itself.  A key that
lies in several parts is scanned from state zero first, for its end states;
because the recurrence is linear, the true state entering each part follows
from those few numbers, and a second scan starts from it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barstream.operators.slicing import Ordered, attach
from barstream.sources.tables import overwrite_table, work_dir


@dataclass(frozen=True)
class Smooth:
    """Smoothing of a weighted sum of terms.

    A term is a column, an earlier smoothing, or ``+column`` / ``-column`` for
    the rise / fall of a column since its last value.
    """

    name: str
    terms: tuple[tuple[str, float], ...]
    alpha: float


def _inputs(steps: list[Smooth]) -> list[str]:
    """Columns that the steps read."""
    made = {s.name for s in steps}
    return list(dict.fromkeys(t.lstrip("+-") for s in steps for t, _ in s.terms if t not in made))


def _moving(steps: list[Smooth]) -> list[str]:
    """Columns of which the steps read the change."""
    return list(dict.fromkeys(t[1:] for s in steps for t, _ in s.terms if t[0] in "+-"))


def linear_scan(keep: np.ndarray, add: np.ndarray) -> np.ndarray:
    """y_t = keep_t * y_{t-1} + add_t with keep_0 = 0, in log2(n) array passes."""
    keep, y, width = keep.copy(), add.copy(), 1
    while width < len(y):
        y[width:] += keep[width:] * y[:-width]
        keep[width:] = keep[width:] * keep[:-width]
        keep[:width] = 0.0
        keep[keep < 1e-290] = 0.0
        if not keep.any():
            break
        width *= 2
    return y


class _Scanner:
    """Carries the smoothing states from batch to batch of a sorted partition."""

    def __init__(self, ids: list[str], steps: list[Smooth], carried: bool):
        self.ids, self.steps, self.carried = ids, steps, carried
        self.inputs, self.moving = _inputs(steps), _moving(steps)
        self.last = None  # ids of the row before the batch
        self.state = {}  # entering values by name, NaN if there is none yet

    def _entering(self, batch, name: str, column: str, starts, fresh: bool) -> np.ndarray:
        """Value of ``name`` before each segment of the batch."""
        begin = np.full(len(starts), np.nan)
        if self.carried:
            at = batch.schema.get_field_index(column)
            begin = batch.column(at).to_numpy(zero_copy_only=False).astype(float)[starts]
        if not fresh:
            begin[0] = self.state[name]
        return begin

    def push(self, batch: pa.RecordBatch):
        """-> (segment start rows, values and valid mask per step, new first segment?)."""
        n = batch.num_rows
        column = lambda name: batch.column(batch.schema.get_field_index(name))
        first = np.zeros(n, dtype=bool)
        first[0] = True
        for name in self.ids:
            codes = column(name).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            first[1:] |= codes[1:] != codes[:-1]
        starts = np.flatnonzero(first)
        segment = np.cumsum(first) - 1
        fresh = tuple(column(c)[0].as_py() for c in self.ids) != self.last
        self.last = tuple(column(c)[n - 1].as_py() for c in self.ids)

        values, valid, state = {}, {}, {}
        for name in self.inputs:
            x = column(name).cast(pa.float64())
            valid[name] = x.is_valid().to_numpy(zero_copy_only=False)
            values[name] = x.fill_null(0.0).to_numpy(zero_copy_only=False)
        for name in self.moving:
            x, there = values[name], valid[name]
            before = self._entering(batch, name, f"_prev_{name}", starts, fresh)
            newest = np.maximum.accumulate(np.where(there, np.arange(n), -1))
            at = np.append(-1, newest[:-1])
            previous = np.where(at >= starts[segment], x[at], before[segment])
            moved = there & ~np.isnan(previous)
            change = np.where(moved, x - previous, 0.0)
            values[f"+{name}"], values[f"-{name}"] = np.maximum(change, 0.0), np.maximum(-change, 0.0)
            valid[f"+{name}"] = valid[f"-{name}"] = moved
            state[name] = x[newest[-1]] if newest[-1] >= starts[-1] else before[-1]

        results = []
        for i, step in enumerate(self.steps):
            given = np.logical_and.reduce([valid[t] for t, _ in step.terms])
            u = sum(weight * values[t] for t, weight in step.terms)
            begin = self._entering(batch, step.name, f"_carry_{i}", starts, fresh)
            known = ~np.isnan(begin)
            seen = np.cumsum(given)
            nth = seen - (seen[starts] - given[starts])[segment]
            seed = given & (nth == 1) & ~known[segment]
            keep = np.where(given, 1.0 - step.alpha, 1.0)
            add = np.where(given, step.alpha * u, 0.0)
            keep[seed], add[seed] = 0.0, u[seed]
            add[starts] += keep[starts] * np.where(known, begin, 0.0)
            keep[starts] = 0.0
            y = linear_scan(keep, add)
            values[step.name], valid[step.name] = y, given
            state[step.name] = y[-1] if known[-1] or nth[-1] >= 1 else np.nan
            results.append((y, given))
        self.state = state
        return starts, results, fresh


def _smooth_rows(ids, steps, carried, drop):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _Scanner(ids, steps, carried)
        for batch in batches:
            if not batch.num_rows:
                continue
            _, results, _ = scanner.push(batch)
            kept = [i for i, f in enumerate(batch.schema) if f.name not in drop]
            arrays = [batch.column(i) for i in kept] + [pa.array(y, mask=~given) for y, given in results]
            names = [batch.schema.field(i).name for i in kept] + [s.name for s in steps]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def _end_states(ids, steps):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, open_row = _Scanner(ids, steps, True), None
        names = [*ids, *[f"_end_{i}" for i in range(len(steps))]]
        for batch in batches:
            if not batch.num_rows:
                continue
            starts, results, fresh = scanner.push(batch)
            ends = np.append(starts[1:], batch.num_rows) - 1
            done = [open_row] if fresh and open_row is not None else []
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ids]
            ended = [(*[c[int(e)].as_py() for c in columns], *[float(y[e]) for y, _ in results]) for e in ends]
            open_row = ended.pop()
            done += ended
            if done:
                types = [c.type for c in columns] + [pa.float64()] * len(steps)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(zip(*done), types)], names=names
                )
        if open_row is not None:
            types = [c.type for c in columns] + [pa.float64()] * len(steps)
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(open_row, types)], names=names)

    return run


def transition(steps: list[Smooth]) -> np.ndarray:
    """Matrix that carries the states over one row with input zero."""
    place = {s.name: i for i, s in enumerate(steps)}
    a = np.zeros((len(steps), len(steps)))
    for i, s in enumerate(steps):
        for name, weight in s.terms:
            if name in place:
                a[i] += s.alpha * weight * a[place[name]]
        a[i, i] += 1.0 - s.alpha
    return a


def _warm_rows(steps: list[Smooth]) -> int:
    """Rows of a key after which every state exists: one, or two for changes."""
    return 2 if _moving(steps) else 1


def _entering_states(key: str, steps: list[Smooth]):
    a, size, warm = transition(steps), len(steps), _warm_rows(steps)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_slice")
        ends = group[[f"_end_{i}" for i in range(size)]].to_numpy()
        carry, state, before = np.full((len(group), size), np.nan), None, 0
        for j, rows in enumerate(group["_rows"].tolist()):
            if before < warm:
                state = ends[j]
            else:
                carry[j] = state
                state = np.linalg.matrix_power(a, int(rows)) @ state + ends[j]
            before += rows
        out = group[[key, "_slice"]].rename(columns={key: "_key", "_slice": "_at"})
        for i in range(size):
            out[f"_carry_{i}"] = pd.Series(carry[:, i], index=out.index)
        return out

    return run


def _previous_values(cut: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Last values of a key's part before, per part (bounded like the runs)."""
    per_key = Window.partitionBy("_key").orderBy("_at")
    return (
        cut.groupBy(F.col(key).alias("_key"), F.col("_slice").alias("_at"))
        .agg(*[F.max_by(F.col(c).cast("double"), "_row").alias(c) for c in columns])
        .select("_key", "_at", *[F.lag(c).over(per_key).alias(f"_prev_{c}") for c in columns])
    )


def _with(schema: T.StructType, fields: list[T.StructField]) -> T.StructType:
    return T.StructType(list(schema.fields) + fields)


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = work_dir(df.sparkSession, name)
    overwrite_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def smooth(df: DataFrame | Ordered, steps: list[Smooth], key: str, order: str | list[str]) -> DataFrame:
    """Add one double column per step.  Rows with a NULL input get NULL and
    leave the state as it is.

    On an ordered table no key is hot, and its own key and order hold; on any
    other frame no job runs while the frame is built.
    """
    made = [T.StructField(s.name, T.DoubleType()) for s in steps]
    if not isinstance(df, Ordered):
        order = [order] if isinstance(order, str) else list(order)
        return df.repartition(key).sortWithinPartitions(key, *order).mapInArrow(
            _smooth_rows([key], steps, False, ()), _with(df.schema, made)
        )

    key, inputs, moving = df.key, _inputs(steps), _moving(steps)
    whole = F.lit(True)
    for c in inputs:
        whole = whole & F.col(c).isNotNull()
    given = df.rows.where(whole)
    ids, size, warm = [key, "_slice"], len(steps), _warm_rows(steps)
    carries, previous = [f"_carry_{i}" for i in range(size)], [f"_prev_{c}" for c in moving]
    in_order = lambda rows: rows.repartition(df.parts, "_slice").sortWithinPartitions("_row")

    # the parts of cut keys, with the rows that count; a key's first part starts from nothing, the others from zero
    cut = attach(given, df.runs.select("_key", "_at"), key, "inner")
    counts = cut.groupBy(F.col(key).alias("_key"), F.col("_slice").alias("_at")).agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy("_key").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.when(F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) >= warm, F.lit(0.0))
    facts = _stored(counts.withColumn("_zero", zero), "parts")

    slim = attach(cut.select(*dict.fromkeys([*ids, "_row", *inputs])), facts, key, "inner")
    if moving:
        before = _stored(_previous_values(cut, key, moving), "previous")
        slim = attach(slim, before, key, "left")
    ready = in_order(slim.select("*", *[F.col("_zero").alias(c) for c in carries]))
    ends_schema = _with(
        T.StructType([df.rows.schema[key], T.StructField("_slice", T.IntegerType())]),
        [T.StructField(f"_end_{i}", T.DoubleType()) for i in range(size)],
    )
    ends = attach(ready.mapInArrow(_end_states(ids, steps), ends_schema), facts, key, "inner").select(
        key, F.col("_slice"), *[f"_end_{i}" for i in range(size)], "_rows"
    )
    carry_schema = T.StructType(
        [T.StructField("_key", df.rows.schema[key].dataType), T.StructField("_at", T.IntegerType())]
        + [T.StructField(c, T.DoubleType()) for c in carries]
    )
    entering = ends.groupBy(key).applyInPandas(_entering_states(key, steps), carry_schema)
    entering = _stored(entering.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in carries}), "carries")  # pandas has no NULL double
    rows = attach(given, entering, key, "left")
    if moving:
        rows = attach(rows, before, key, "left")
    helpers = {"_slice", "_row", *carries, *previous}
    plain = T.StructType([df.rows.schema[c] for c in df.columns])
    done = in_order(rows).mapInArrow(_smooth_rows(ids, steps, True, helpers), _with(plain, made))
    missing = df.rows.where(~whole).select(*df.columns, *[F.lit(None).cast("double").alias(s.name) for s in steps])
    return done.unionByName(missing)

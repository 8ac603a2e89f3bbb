"""Indicators of appended rows alone: a stored state per symbol takes the place of its history.

``advance`` computes SMA, Bollinger band, EMA, MACD and RSI of the rows that
are new, and the state after them.  The state holds, per symbol, the values of
its recurrences and its newest 19 rows, so a day costs what the day's rows
cost, whatever lies before it, and the results are those of a full recompute.

New rows are put in order and cut into parts (``slicing.order_table``), so a
symbol that holds a third of them is spread like in the full recompute: its
parts are scanned from zero, and what enters each follows from the state and
the parts before.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barstream.functions.columns import ratio
from barstream.operators.indicators import SPANS
from barstream.operators.ranking import latest_per_key
from barstream.operators.recurrence import Smooth, _end_states, _inputs, _moving, _smooth_rows, _stored, _warm_rows, _with, transition
from barstream.operators.slicing import Ordered, order_table, windowed
from barstream.sources.tables import overwrite_table, read_table

KEY, TIME = "symbol", "trade_time"
#: Rows before a row that its frames reach.
REACH = max(SPANS) - 1
X = "_x"  # the price of new rows; NULL in those of the state, which recurrences pass over
AVERAGES = [
    Smooth("ema_12", ((X, 1.0),), 2.0 / 13),
    Smooth("_slow", ((X, 1.0),), 2.0 / 27),
    Smooth("dea", (("ema_12", 1.0), ("_slow", -1.0)), 2.0 / 10),
]
STRENGTH = [Smooth("_up", ((f"+{X}", 1.0),), 1.0 / 14), Smooth("_down", ((f"-{X}", 1.0),), 1.0 / 14)]
STEPS = [s.name for s in AVERAGES + STRENGTH]


@dataclass(frozen=True)
class State:
    """What later rows need of the earlier ones.

    ``values``: one row a symbol, with its newest time, the number of its
    prices, the last of them and the recurrences' values.  ``tail``: its newest
    19 rows.
    """

    values: DataFrame
    tail: DataFrame

    def save(self, path: str) -> None:
        overwrite_table(self.values, f"{path}/values")
        overwrite_table(self.tail, f"{path}/tail")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> State:
        return cls(read_table(spark, f"{path}/values"), read_table(spark, f"{path}/tail"))


def _no_state(prices: DataFrame) -> State:
    spark, schema = prices.sparkSession, prices.select(KEY, TIME, "close", "volume").schema
    numbers = [T.StructField("rows", T.LongType()), *[T.StructField(n, T.DoubleType()) for n in ("last", *STEPS)]]
    values = T.StructType([schema[KEY], T.StructField("newest", schema[TIME].dataType), *numbers])
    return State(spark.createDataFrame([], values), spark.createDataFrame([], schema))


def _same(a: DataFrame, b: DataFrame, name: str) -> Column:
    return a[KEY].eqNullSafe(b[name])


def timely(prices: DataFrame, state: State) -> DataFrame:
    """Rows after their symbol's newest time in the state; only these can be appended."""
    newest = state.values.select(F.col(KEY).alias("_key"), "newest")
    met = prices.join(newest, _same(prices, newest, "_key"), "left")
    return met.where(F.col("newest").isNull() | (F.col(TIME) > F.col("newest"))).drop("_key", "newest")


def late(prices: DataFrame, state: State) -> DataFrame:
    """The rows that ``advance`` leaves out: at or before their symbol's newest time, or without a time."""
    newest = state.values.select(F.col(KEY).alias("_key"), "newest")
    met = prices.join(newest, _same(prices, newest, "_key"), "inner")
    return met.where(F.col("newest").isNotNull() & ~F.coalesce(F.col(TIME) > F.col("newest"), F.lit(False))).drop("_key", "newest")


def advance(prices: DataFrame, state: State | None = None) -> tuple[DataFrame, State]:
    """Indicators of new rows, and the state after them.

    Without a state the rows are the history.  Rows that come at or before the
    newest time of their symbol would change what is stored: they are left out
    (see ``late``).  Rows without a close get no recurrence and leave it as it
    is.  Rows of one symbol and one time are put in order by their content, as
    in an ordered table; they must come in one call, or are late in the next.
    Symbols without new rows keep their state.  No rows give no rows.
    """
    state = state or _no_state(prices)
    new = timely(prices.select(KEY, TIME, "close", "volume"), state).withColumn("_old", F.lit(False))
    table = order_table(new.unionByName(state.tail.withColumn("_old", F.lit(True))), KEY, TIME)
    price = F.when(~F.col("_old"), F.col("close").cast("double"))
    table = replace(table, rows=table.rows.withColumn(X, price))
    rows = _resumed(table, table.rows, AVERAGES, state.values)
    rows = _stored(_resumed(table, rows, STRENGTH, state.values), "resumed")

    def frames(w):
        of = lambda n: w.rowsBetween(1 - n, 0)
        averages = {f"sma_{n}": F.avg("close").over(of(n)) for n in SPANS}
        return averages | {"boll_mid": F.avg("close").over(of(20)), "_dev": F.stddev_pop("close").over(of(20))}

    framed = windowed(replace(table, rows=rows), frames, KEY, TIME, before=REACH).where("NOT _old")
    dif, up, down = F.col("ema_12") - F.col("_slow"), F.col("_up"), F.col("_down")
    done = framed.select(
        KEY, TIME, "close", "volume", *[f"sma_{n}" for n in SPANS], "ema_12",
        dif.alias("dif"), "dea", (2 * (dif - F.col("dea"))).alias("macd"),
        F.when(up.isNotNull(), ratio(100 * up, up + down, 50.0)).alias("rsi_14"),
        "boll_mid", (F.col("boll_mid") + 2 * F.col("_dev")).alias("boll_upper"), (F.col("boll_mid") - 2 * F.col("_dev")).alias("boll_lower"),
    )
    return done, _after(rows, state)


def _after(rows: DataFrame, state: State) -> State:
    """The state once the rows have passed."""
    own = ~F.col("_old")
    counted = rows.where(own).groupBy(KEY).agg(
        F.max(TIME).alias("newest"),
        F.count(X).alias("rows"),
        F.max_by(F.struct(F.col(X).alias("last"), *STEPS), F.when(F.col(X).isNotNull(), F.col("_row"))).alias("end"),
    )
    old = state.values.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(state.values.columns)])
    at = {c: F.col(f"_{i}") for i, c in enumerate(state.values.columns)}
    both = counted.join(old, _same(counted, old, "_0"), "full")
    moved = F.col("end").isNotNull()
    values = both.select(
        F.coalesce(F.col(KEY), at[KEY]).alias(KEY),
        F.coalesce("newest", at["newest"]).alias("newest"),
        (F.coalesce("rows", F.lit(0)) + F.coalesce(at["rows"], F.lit(0))).alias("rows"),
        *[F.when(moved, F.col(f"end.{n}")).otherwise(at[n]).alias(n) for n in ("last", *STEPS)],
    )
    tail = latest_per_key(rows.select(KEY, TIME, "close", "volume", "_row"), KEY, "_row", n=REACH).drop("_row")
    return State(_stored(values, "values"), _stored(tail, "tail"))


def _entering(key: str, steps: list[Smooth]):
    """What enters each part of a cut key, from the state before the first and the parts' ends."""
    a, size, warm = transition(steps), len(steps), _warm_rows(steps)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_at")
        ends = group[[f"_end_{i}" for i in range(size)]].to_numpy(float)
        state, carry = group[[f"_state_{i}" for i in range(size)]].to_numpy(float)[0], np.full((len(group), size), np.nan)
        for j, (before, rows) in enumerate(zip(group["_before"].tolist(), group["_rows"].tolist())):
            if before < warm:
                state = ends[j]  # scanned from its true beginning
            else:
                carry[j] = state
                state = np.linalg.matrix_power(a, int(rows)) @ state + ends[j]
        out = group[["_key", "_at"]].copy()
        for i in range(size):
            out[f"_carry_{i}"] = pd.Series(carry[:, i], index=out.index)
        return out

    return run


def _resumed(table: Ordered, rows: DataFrame, steps: list[Smooth], values: DataFrame) -> DataFrame:
    """``rows`` (the table's, maybe with further columns) with one column per step, its state entered first.

    What parts get is joined by symbol and part, without a broadcast: there is
    a row for every symbol.
    """
    size, warm, moving, inputs = len(steps), _warm_rows(steps), _moving(steps), _inputs(steps)
    carries, previous = [f"_carry_{i}" for i in range(size)], [f"_prev_{c}" for c in moving]
    states = [F.col(s.name).alias(f"_state_{i}") for i, s in enumerate(steps)]
    given = table.rows.where(F.col(X).isNotNull())
    in_order = lambda df: df.repartition(table.parts, "_slice").sortWithinPartitions("_row")

    per = given.groupBy(F.col(KEY).alias("_key"), F.col("_slice").alias("_at")).agg(F.count("*").alias("_rows"), F.max_by(X, "_row").alias("_end"))
    known = values.select(KEY, F.col("rows").alias("_known"), F.col("last").alias("_last"), *states)
    by_key = Window.partitionBy("_key").orderBy("_at")
    earlier = F.coalesce(F.sum("_rows").over(by_key.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    facts = per.join(known, _same(known, per, "_key"), "left").drop(KEY).withColumns(
        {
            "_before": earlier + F.coalesce("_known", F.lit(0)),
            "_prev": F.coalesce(F.lag("_end").over(by_key), "_last"),
            "_cut": F.count("*").over(Window.partitionBy("_key")) > 1,
        }
    )
    facts = _stored(facts.drop("_end", "_last", "_known"), "facts")

    def attached(df, small):
        return df.join(small, _same(df, small, "_key") & (df["_slice"] == small["_at"]), "inner").drop("_key", "_at")

    # the parts of cut symbols: from nothing where nothing comes before, else from zero
    zero = F.when(F.col("_before") >= warm, F.lit(0.0))
    start = facts.where("_cut").select("_key", "_at", *[zero.alias(c) for c in carries], *[F.col("_prev").alias(p) for p in previous])
    ready = in_order(attached(given.select(KEY, "_slice", "_row", *inputs), start))
    ends_schema = _with(T.StructType([table.rows.schema[KEY], T.StructField("_slice", T.IntegerType())]), [T.StructField(f"_end_{i}", T.DoubleType()) for i in range(size)])
    ends = ready.mapInArrow(_end_states([KEY, "_slice"], steps), ends_schema)
    ends = attached(ends, facts.withColumns({"_key2": F.col("_key"), "_at2": F.col("_at")})).drop(KEY, "_slice").withColumnsRenamed({"_key2": "_key", "_at2": "_at"})
    carry_schema = T.StructType([T.StructField("_key", table.rows.schema[KEY].dataType), T.StructField("_at", T.IntegerType()), *[T.StructField(c, T.DoubleType()) for c in carries]])
    cut = ends.groupBy("_key").applyInPandas(_entering(KEY, steps), carry_schema)
    cut = cut.select("_key", "_at", *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in carries])  # pandas has no NULL double
    whole = facts.where("NOT _cut").select("_key", "_at", *[F.col(f"_state_{i}").alias(c) for i, c in enumerate(carries)])
    entering = cut.unionByName(whole)
    if previous:
        prev = facts.select(F.col("_key").alias("_k"), F.col("_at").alias("_a"), *[F.col("_prev").alias(p) for p in previous])
        entering = entering.join(prev, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_at") == F.col("_a"))).drop("_k", "_a")
    entering = _stored(entering, "entering")

    made = [T.StructField(s.name, T.DoubleType()) for s in steps]
    with_state = in_order(attached(rows.where(F.col(X).isNotNull()), entering))
    done = with_state.mapInArrow(_smooth_rows([KEY, "_slice"], steps, True, {*carries, *previous}), _with(rows.schema, made))
    rest = rows.where(F.col(X).isNull()).select("*", *[F.lit(None).cast("double").alias(s.name) for s in steps])
    return done.unionByName(rest)

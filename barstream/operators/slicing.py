"""Ordered per-key work, cut into parts of equal size whatever the keys are.

``Window.partitionBy(symbol)`` puts every row of a symbol into one task.
``order_table`` sorts a table by key and order instead, by ranges, and stores
it with every row's place: a key that holds a third of the rows lies in a third
of the parts, and rows with one and the same time are cut as well.  Windows
then run per (part, key); the few rows that a frame needs from the parts before
or after are copied in first, so that results are those of the plain window.

What a part needs to know of the others is in ``runs``, one row for every part
of a key that lies in several: at most two rows a part.  It is a stored table;
nothing of it goes through the driver, and neither keys nor parts are capped.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barstream.sources.tables import overwrite_table, work_dir

ROWS_PER_PART = 2_000_000


def order_axis(df: DataFrame, name: str) -> Column:
    """The order column as a double that grows with it."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        # by calendar fields: a cast to timestamp is not monotone where clocks change
        day = F.unix_date(F.to_date(c)).cast("double")
        seconds = F.hour(c) * 3600 + F.minute(c) * 60 + F.date_part(F.lit("SECOND"), c)
        return day * 86_400e6 + seconds.cast("double") * 1e6
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    return c.cast("double")


@dataclass(frozen=True)
class Ordered:
    """A stored table in the order of ``key`` and ``order``.

    ``rows`` has its columns, ``_slice`` (the part) and ``_row`` (the place in
    the whole order).  ``runs`` has ``_key``, ``_at`` (a part), ``_first`` and
    ``_last`` (places) of every part of a key that lies in several parts; a
    key's rows in a part have consecutive places.
    """

    rows: DataFrame
    runs: DataFrame
    key: str
    order: tuple[str, ...]
    parts: int

    @property
    def columns(self) -> list[str]:
        return [c for c in self.rows.columns if c not in ("_slice", "_row")]


def _part_of(row: str) -> Column:
    return F.shiftright(row, 33).cast("int")


def _store_parts(rows: DataFrame, parts: int) -> DataFrame:
    """Rows that lie in their part's task, stored in buckets by part and read back."""
    spark, name = rows.sparkSession, f"ordered_{uuid.uuid4().hex}"
    rows.write.bucketBy(parts, "_slice").option("path", work_dir(spark, name)).saveAsTable(name)
    return spark.table(name)


def order_table(df: DataFrame, key: str, order: str | list[str], rows_per_part: int | None = None) -> Ordered:
    """Sort a table into parts of about ``rows_per_part`` rows and store it; once for all operators on it.

    One count, one shuffle by ranges of (key, order, content).  Rows that agree
    in key and order are put in order by a hash of their columns, equal rows by
    where they come from, so any of them can be cut apart.  NULL keys and NULL
    times come first.
    """
    spark, columns = df.sparkSession, df.columns
    order = [order] if isinstance(order, str) else list(order)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-df.count() // (rows_per_part or ROWS_PER_PART)))
    ties = df.withColumns({"_tie": F.xxhash64(*[F.col(f"`{c}`") for c in columns]), "_from": F.monotonically_increasing_id()})
    by = [key, *order, "_tie", "_from"]
    placed = ties.repartitionByRange(parts, *by).sortWithinPartitions(*by).drop("_tie", "_from")
    numbered = placed.withColumn("_row", F.monotonically_increasing_id())  # the part, then the place in it
    numbered = numbered.withColumn("_slice", _part_of("_row"))
    rows = _store_parts(numbered, parts)

    per = rows.groupBy(F.col(key).alias("_key"), F.col("_slice").alias("_at")).agg(F.min("_row").alias("_first"), F.max("_row").alias("_last"))
    per = per.withColumn("_of", F.count("*").over(Window.partitionBy("_key"))).where("_of > 1").drop("_of")
    path = work_dir(spark, "runs")
    overwrite_table(per, path)
    return Ordered(rows, spark.read.schema(per.schema).parquet(path), key, tuple(order), parts)


def attach(df: DataFrame, small: DataFrame, key: str, how: str) -> DataFrame:
    """Join runs (at most two rows a part) by key, NULL keys too, and part."""
    condition = df[key].eqNullSafe(small["_key"]) & (df["_slice"] == small["_at"])
    return df.join(F.broadcast(small), condition, how).drop("_key", "_at")


def _copies(table: Ordered, reach: int, forward: bool) -> DataFrame:
    """The last (or first) ``reach`` rows of the runs before (or after), with the part that needs them as ``_slice``.

    Edge rows of a key are numbered towards the parts that need them; a part
    needs the ``reach`` numbers below its own.  Those lie in at most two blocks
    of ``reach`` numbers, so the match is a join by equal key and block.
    """
    towards = Window.partitionBy("_key").orderBy(F.asc("_at") if forward else F.desc("_at"))
    size = F.least(F.col("_last") - F.col("_first") + 1, F.lit(reach))
    runs = table.runs.withColumn("_size", size)
    runs = runs.withColumn("_start", F.sum("_size").over(towards.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_size"))
    near = F.col("_row") - F.col("_last") + F.col("_size") if forward else F.col("_first") + F.col("_size") - F.col("_row")
    edge = attach(table.rows, runs, table.key, "inner").where(near > 0)
    edge = edge.withColumn("_number", F.col("_start") + near).withColumn("_block", F.floor((F.col("_number") - 1) / reach))
    edge = edge.drop("_first", "_last", "_size", "_start", "_slice")
    lowest = F.greatest(F.col("_start") - reach, F.lit(0))
    blocks = F.array_distinct(F.array(F.floor(lowest / reach), F.floor((F.col("_start") - 1) / reach)))
    asking = runs.where("_start > 0").select("_key", F.col("_at").alias("_slice"), lowest.alias("_above"), F.col("_start").alias("_upto"), F.explode(blocks).alias("_in"))
    same = edge[table.key].eqNullSafe(asking["_key"]) & (edge["_block"] == asking["_in"])
    met = edge.join(asking, same & (F.col("_number") > F.col("_above")) & (F.col("_number") <= F.col("_upto")))
    return met.select(*table.rows.columns)


def windowed(
    df: DataFrame | Ordered,
    build: Callable[[WindowSpec], dict[str, Column]],
    key: str,
    order: str | list[str],
    before: int = 0,
    after: int = 0,
) -> DataFrame:
    """Add window columns whose frames reach ``before`` / ``after`` rows.

    ``build`` gets the window (per key, in order) and returns named columns.
    On an ordered table (see order_table) no key is hot, and its own key and
    order hold; on any other frame this is the plain window, and no job runs
    while the frame is built.
    """
    if not isinstance(df, Ordered):
        order = [order] if isinstance(order, str) else list(order)
        return df.withColumns(build(Window.partitionBy(key).orderBy(*order)))
    return _with_windows(df, build, before, after).drop("_slice", "_row")


def extended(table: Ordered, build: Callable[[WindowSpec], dict[str, Column]], before: int = 0, after: int = 0) -> Ordered:
    """An ordered table with window columns added (see windowed), stored in the same parts.

    What works on the result finds its rows in order already: neither the
    table's count nor its shuffle by ranges is done again.
    """
    return replace(table, rows=_store_parts(_with_windows(table, build, before, after), table.parts))


def _with_windows(df: Ordered, build: Callable[[WindowSpec], dict[str, Column]], before: int, after: int) -> DataFrame:
    """The rows of an ordered table with their places and window columns."""
    rows = df.rows
    for reach, forward in ((before, True), (after, False)):
        if reach:
            rows = rows.unionByName(_copies(df, reach, forward).repartition(df.parts, "_slice"))
    window = Window.partitionBy("_slice", df.key).orderBy("_row")
    # a copied row's place lies in another part; null-safe, as a filter below the union would hide the buckets
    own = _part_of("_row").eqNullSafe(F.col("_slice"))
    return rows.withColumns(build(window)).where(own)


def running_totals(df: DataFrame | Ordered, columns: list[str], key: str, order: str) -> DataFrame:
    """Add ``<column>_upto``: the sum of the column up to and with this row.

    (key, order) must be unique.  An ordered table has running sums per part,
    plus the totals of a key's parts before it.
    """
    upto = lambda w: {
        f"{c}_upto": F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, 0)) for c in columns
    }
    if not isinstance(df, Ordered):
        return df.withColumns(upto(Window.partitionBy(key).orderBy(order)))
    earlier = Window.partitionBy("_key").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    cut = attach(df.rows, df.runs.select("_key", "_at"), df.key, "inner")
    totals = cut.groupBy(F.col(df.key).alias("_key"), F.col("_slice").alias("_at")).agg(*[F.sum(c).alias(c) for c in columns])
    totals = totals.select("_key", "_at", *[F.sum(c).over(earlier).alias(f"_{c}_base") for c in columns])
    joined = attach(df.rows.withColumns(upto(Window.partitionBy("_slice", df.key).orderBy("_row"))), totals, df.key, "left")
    fixed = {f"{c}_upto": F.col(f"{c}_upto") + F.coalesce(F.col(f"_{c}_base"), F.lit(0)) for c in columns}
    return joined.withColumns(fixed).drop("_slice", "_row", *[f"_{c}_base" for c in columns])

"""Helpers that several operators share."""

from __future__ import annotations

import hashlib
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What separates words (ASCII white space), as a character class.
SPACE = r"\x20\x09-\x0D"


#: Rows of an Arrow batch that are Python objects at one time.
SLICE = 500


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder that driver and executors share.

    Below ``spark.checkpoint.dir``; where a session has none, below its
    warehouse, which is shared as well.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/work/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to a shared folder and read back: a cut in the plan that survives lost executors."""
    path = work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def held_out(doc_id: Column) -> Column:
    """True for the rows that no model may learn from; false for a null id, which is not learned from either."""
    return F.coalesce(remainder(doc_id) == 2, F.lit(False))


def text_rows(
    df: DataFrame, keep: list[str], fields: list[T.StructField], per_text: Callable[[], Callable], text: str = "text", kept: tuple | None = None
) -> DataFrame:
    """Columns computed from whole texts, batch by batch, beside the kept columns.

    ``per_text()`` runs once per task and returns a function from a text (or
    None) to a tuple of the new columns' values.  ``kept`` is the key of the
    object that it keeps by per_process, if any.  A text that is kept as well
    goes to Python once.
    """
    at = keep.index(text) if text in keep else len(keep)
    schema = T.StructType([df.schema[c] for c in keep] + fields)
    arrow = [pa.field(f.name, _arrow(f.dataType)) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task_begins(kept)
        one = per_text()
        for batch in (b.slice(first, SLICE) for b in batches for first in range(0, max(b.num_rows, 1), SLICE)):
            new = list(zip(*map(one, batch.column(at).to_pylist()))) or [()] * len(arrow)
            arrays = [batch.column(i) for i in range(len(keep))]
            arrays += [pa.array(values, field.type) for values, field in zip(new, arrow)]
            yield pa.RecordBatch.from_arrays(arrays, keep + [f.name for f in arrow])

    sent = [F.col(f"`{c}`") for c in keep] + ([] if text in keep else [F.col(text).alias("__text")])
    return df.select(*sent).mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow(kind.elementType))
    plain = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64()}
    return (plain | {"boolean": pa.bool_(), "binary": pa.binary()})[kind.simpleString()]


def long(name: str) -> T.StructField:
    return T.StructField(name, T.LongType())


def double(name: str) -> T.StructField:
    return T.StructField(name, T.DoubleType())


def string(name: str) -> T.StructField:
    return T.StructField(name, T.StringType())


def flag(name: str) -> T.StructField:
    return T.StructField(name, T.BooleanType())


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Bounded(dict):
    """A cache that starts anew when it is full."""

    def __init__(self, make: Callable, size: int = 300_000):
        super().__init__()
        self.make, self.size = make, size

    def __missing__(self, key):
        if len(self) >= self.size:
            self.clear()
        value = self[key] = self.make(key)
        return value


def _kept() -> dict:
    return sys.modules.setdefault("_kept_object", types.ModuleType("_kept_object")).__dict__


def per_process(key: tuple, make: Callable):
    """An object that a worker process keeps for its next tasks: a tokenizer, an automaton, a model.

    One at a time; a task that asks for none lets it go (see task_begins), so
    that a long-lived worker doesn't gather those of earlier stages.
    """
    kept = _kept()
    if kept.get("key") != key:
        kept.pop("value", None)
        kept["value"], kept["key"] = make(), key
    return kept["value"]


def task_begins(key: tuple | None = None) -> None:
    """Let go of what earlier tasks kept, unless it is this, and of memory that Arrow holds in reserve."""
    kept = _kept()
    if kept.get("key") != key:
        kept.pop("value", None)
        kept.pop("key", None)
    pa.default_memory_pool().release_unused()

"""Tables stored by the hash of a key, so that joins on it need no exchange."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def store_colocated(df: DataFrame, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Write a table to a new folder in ``buckets`` parts by ``keys``, one sorted file each; returns it read back.

    Tables stored by keys of one type in the same number of buckets are joined
    on these keys without an exchange, as often as they are read: the shuffle
    is paid once, when the table is written.  With the time among the keys a
    hot symbol lies in all buckets.  NULL keys share a bucket.  An empty table
    is stored as one.
    """
    rows = df.repartition(buckets, *keys)
    name = f"colocated_{uuid.uuid4().hex}"
    rows.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def open_colocated(spark: SparkSession, path: str, keys: list[str], buckets: int) -> DataFrame:
    """A table that ``store_colocated`` wrote, in any session; keys and number of buckets are those it was written with."""
    schema = spark.read.parquet(path).schema
    name, by = f"colocated_{uuid.uuid4().hex}", ", ".join(f"`{k}`" for k in keys)
    location = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({schema.toDDL()}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {int(buckets)} BUCKETS LOCATION '{location}'")
    return spark.table(name)

"""Stored tables, views, JDBC and message sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barstream.functions.columns import MESSAGE_TIME


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables.

    Below ``spark.checkpoint.dir`` (the folder all executors share) when the
    session names one; below the warehouse otherwise, in local mode only.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = spark.conf.get("spark.sql.warehouse.dir", None)
    return f"{shared.rstrip('/')}/barstream/{uuid.uuid4().hex}/{name}"


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A stored table by path (``fmt="delta"`` where that source is installed)."""
    return spark.read.format(fmt).load(path)


def overwrite_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = None, sort_by: tuple[str, ...] = ()
) -> None:
    """Replace a stored table.

    ``sort_by`` orders rows inside each file, so that filters on those columns
    skip row groups.
    """
    rows = df.sortWithinPartitions(*sort_by) if sort_by else df
    writer = rows.write.format(fmt).mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).save(path)


def remove_table(spark: SparkSession, path: str) -> None:
    """Remove a stored intermediate table."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def register_views(spark: SparkSession, views: dict[str, DataFrame]) -> None:
    """Make frames available to SQL text."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def sql_indicators(spark: SparkSession, view: str = "indicators") -> DataFrame:
    """The SMA columns by SQL over a registered view."""
    return spark.sql(f"SELECT symbol, trade_time, close, volume, sma_5, sma_10, sma_20 FROM {view}")


def to_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as JSON text in ``value`` (NULL fields kept), ready for any sink."""
    options = {"ignoreNullFields": "false", "timestampFormat": MESSAGE_TIME, "timestampNTZFormat": MESSAGE_TIME}
    value = F.to_json(F.struct("*"), options).alias("value")
    return df.select(F.col(key).alias("key"), value) if key else df.select(value)


def write_messages(df: DataFrame, target: str, fmt: str = "kafka", mode: str = "append", **options) -> None:
    """Send messages to a topic (``fmt="kafka"``) or to files (``"text"``, ``"json"``)."""
    if fmt == "kafka":
        df.write.format("kafka").options(topic=target, **options).save()
    else:
        df.write.format(fmt).options(**options).mode(mode).save(target)


def write_jdbc(
    df: DataFrame, url: str, table: str, mode: str = "append", max_connections: int | None = None, **options
) -> None:
    """Append rows to a database table, one connection per partition.

    ``max_connections`` merges partitions without a shuffle.  User, password
    and driver go into ``options``; nothing is built in.
    """
    rows = df.coalesce(max_connections) if max_connections else df
    rows.write.format("jdbc").options(url=url, dbtable=table, **options).mode(mode).save()


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """A database table; pass partitionColumn and bounds for parallel reads."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()

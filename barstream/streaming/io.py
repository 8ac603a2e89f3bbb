"""Message streams in, micro-batch tables out."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barstream.sources.tables import to_messages

# Topics and trigger intervals.
PRICE_TOPIC, NEWS_TOPIC = "stock-prices", "stock-news"
PRICE_INTERVAL, NEWS_INTERVAL = "10 seconds", "30 seconds"
# What a micro-batch takes at most unless told otherwise; the rest waits for the next one.
OFFSETS_PER_TRIGGER, BYTES_PER_TRIGGER = 5_000_000, 2_000_000_000


def _read(spark: SparkSession, fmt: str, topic: str, kafka: dict, path: str | None, options: dict) -> DataFrame:
    if fmt == "kafka":
        settings = {"subscribe": topic, "startingOffsets": "earliest", "maxOffsetsPerTrigger": OFFSETS_PER_TRIGGER, **kafka, **options}
        return spark.readStream.format("kafka").options(**settings).load()
    settings = options if "maxFilesPerTrigger" in options else {"maxBytesPerTrigger": BYTES_PER_TRIGGER, **options}
    return spark.readStream.format(fmt).schema("value string").options(**settings).load(path)


def read_price_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None, **options) -> DataFrame:
    """Price messages from the start of the topic; lost data does not stop the query.

    Kafka needs ``kafka.bootstrap.servers`` in ``options``.  File formats
    (``parquet``, ``text``, ``json``) read ``value`` from ``path``.
    """
    return _read(spark, fmt, PRICE_TOPIC, {"failOnDataLoss": "false"}, path, options)


def read_news_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None, **options) -> DataFrame:
    """News messages from the start of the topic; lost data stops the query."""
    return _read(spark, fmt, NEWS_TOPIC, {}, path, options)


def append_batches(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Append every non-empty micro-batch to a Parquet table.

    A batch writes its own ``batch_id=<n>`` folder and replaces it when it is
    run again, so a restart adds no row twice.  ``transform`` is applied to
    each batch as an ordinary frame.  Without ``interval`` the query works off
    what is there and stops.  ``max_files`` merges partitions of small batches.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{path}/batch_id={batch_id}"
        out = transform(batch) if transform else batch
        out = out.coalesce(max_files) if max_files else out
        out.write.mode("overwrite").option("compression", "zstd").parquet(folder)
        # looked at in the written files, so that no batch is cached or run twice
        if batch.sparkSession.read.schema(out.schema).parquet(folder).isEmpty():
            _remove(batch.sparkSession, folder)

    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def append_messages(
    stream: DataFrame, target: str, checkpoint: str, fmt: str = "kafka", key: str | None = None, interval: str | None = None, **options
) -> StreamingQuery:
    """Send a stream's rows as JSON messages to a topic (``kafka``) or a folder (``text``, ``parquet``, ``json``).

    The sinks' own logs keep a restart from sending a batch twice to files; a
    topic may get one again.
    """
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    writer = to_messages(stream, key).writeStream.format(fmt).option("checkpointLocation", checkpoint).trigger(**trigger)
    if fmt == "kafka":
        return writer.options(topic=target, **options).start()
    return writer.options(**options).start(target)


def _remove(spark: SparkSession, folder: str) -> None:
    """A folder, and the one above it if nothing is left there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    files.delete(path, True)
    if not len(files.listStatus(path.getParent())):
        files.delete(path.getParent(), False)


def compact_batches(spark: SparkSession, path: str, target: str, day: str, files_per_day: int = 1) -> None:
    """Rewrite the folders of a stopped or quiet stream as one table of days at ``target``.

    ``day`` names the time column.  Reading ``target`` lists days instead of
    every batch; ``path`` stays for the stream and its restarts.
    """
    rows = read_batches(spark, path).withColumn("day", F.to_date(day))
    dealt = rows.repartition("day") if files_per_day == 1 else rows.repartition("day", F.pmod(F.xxhash64(*rows.columns), F.lit(files_per_day)))
    dealt.write.mode("overwrite").partitionBy("day").parquet(target)


def run_until_done(query: StreamingQuery, timeout: float | None = None) -> bool:
    """Wait for the query; with a timeout, stop it and return False when it runs out."""
    done = query.awaitTermination(timeout) if timeout else query.awaitTermination()
    if done is False:
        query.stop()
        return False
    return True


@contextmanager
def bounded_state(spark: SparkSession) -> Iterator[None]:
    """Streams that are started inside keep their state in RocksDB, on disk, with a log of changes per batch."""
    settings = {
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def late_rows(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """(batch_id, late): rows that each batch of a query dropped for coming after its watermark.

    From the query's newest progress reports
    (``spark.sql.streaming.numRecentProgressUpdates``); batches without late
    rows are left out.
    """
    found: dict[int, int] = {}
    for report in query.recentProgress:
        late = sum(op.numRowsDroppedByWatermark for op in report.stateOperators)
        if late:
            found[report.batchId] = found.get(report.batchId, 0) + late
    return spark.createDataFrame(sorted(found.items()), "batch_id bigint, late bigint")


def kept_keys(query: StreamingQuery) -> int:
    """Rows in a query's state after its last batch."""
    reports = query.recentProgress
    return sum(op.numRowsTotal for op in reports[-1].stateOperators) if reports else 0


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The table written by append_batches."""
    return spark.read.option("basePath", path).parquet(path).drop("batch_id")

"""Streaming queries: run over what is there, then read the written table."""

from __future__ import annotations

from pyspark.sql import functions as F

from barstream.operators.text import fit_sentiment
from barstream.sources.tables import read_table, overwrite_table, to_messages, work_dir
from barstream.operators.clean import parse_prices
from barstream.streaming.io import append_messages, compact_batches, late_rows, read_batches, read_news_stream, read_price_stream, run_until_done
from barstream.streaming.jobs import store_news, store_prices
from checks import fixtures as X
from checks import sql as S
from checks.learning import _labelled

Q, O = {}, {}
TIMEOUT = 900


def query(name, oracle=None):
    def add(fn):
        Q[name] = fn
        if oracle:
            O[name] = oracle
        return fn

    return add


def _message_files(spark, sf_dir, path, parts=4):
    """Price messages with copies of all clicks, spread over files."""
    rows = X.unique_ticks(spark, sf_dir)
    copies = rows.where("event_type = 'click'").withColumn("arrival", F.col("arrival") + 10**9)
    both = rows.unionByName(copies)
    both.repartition(parts, F.xxhash64("arrival")).select(_value()).write.parquet(path)


def _value():
    """The same text as to_messages, for the message columns only."""
    options = {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}
    return F.to_json(F.struct(*X.TICK), options).alias("value")


def _run(query):
    if not run_until_done(query, TIMEOUT):
        raise TimeoutError("stream did not finish")


STREAMED = f"WITH {S.UNIQUE} {S.CLEAN} FROM uniq WHERE close > 0 AND volume >= 0"


@query("stream_clean_prices", STREAMED)
def stream_clean_prices(spark, sf_dir):
    root = work_dir(spark, "price_stream")
    _message_files(spark, sf_dir, f"{root}/in")
    messages = read_price_stream(spark, "parquet", f"{root}/in", maxFilesPerTrigger=2)
    _run(store_prices(messages, f"{root}/out", f"{root}/checkpoint", ntz=True))
    return read_batches(spark, f"{root}/out")


@query("stream_messages", f"WITH {S.UNIQUE} SELECT symbol, trade_time, open, high, low, close, volume, data_type FROM uniq")
def stream_messages(spark, sf_dir):
    """Messages parsed and sent on as messages."""
    root = work_dir(spark, "sent_messages")
    X.unique_ticks(spark, sf_dir).select(_value()).write.parquet(f"{root}/in")
    parsed = parse_prices(read_price_stream(spark, "parquet", f"{root}/in"), ntz=True)
    _run(append_messages(parsed, f"{root}/out", f"{root}/checkpoint", "text"))
    return parse_prices(spark.read.text(f"{root}/out"), ntz=True).select(*X.TICK)


@query("stream_compacted", STREAMED)
def stream_compacted(spark, sf_dir):
    """Batch folders rewritten as days."""
    root = work_dir(spark, "compacted_stream")
    _message_files(spark, sf_dir, f"{root}/in")
    _run(store_prices(read_price_stream(spark, "parquet", f"{root}/in", maxFilesPerTrigger=1), f"{root}/out", f"{root}/checkpoint", ntz=True))
    compact_batches(spark, f"{root}/out", f"{root}/days", "trade_time")
    return spark.read.parquet(f"{root}/days").drop("day")


@query("stream_restart", STREAMED)
def stream_restart(spark, sf_dir):
    """Stop after the first files; more files and copies arrive; start again."""
    root = work_dir(spark, "restarted_stream")
    rows = X.unique_ticks(spark, sf_dir)
    early = F.pmod(F.xxhash64("arrival"), F.lit(2)) == 0
    rows.where(early).repartition(2).select(_value()).write.parquet(f"{root}/in")
    start = lambda: store_prices(
        read_price_stream(spark, "parquet", f"{root}/in"), f"{root}/out", f"{root}/checkpoint", ntz=True
    )
    _run(start())
    # the rest, and every click once more
    later = rows.where(~early).unionByName(rows.where("event_type = 'click'"))
    later.repartition(2).select(_value()).write.mode("append").parquet(f"{root}/in")
    _run(start())
    return read_batches(spark, f"{root}/out")


# Messages by arrival: three days a file; clicks once more in the next file, every fiftieth row four files late.
BLOCK = "CAST(date_diff('day', DATE '2024-01-01', CAST(trade_time AS DATE)) // 3 AS INTEGER)"
ARRIVED = f"""{S.UNIQUE}, sent AS (
  SELECT *, {BLOCK} AS file FROM uniq WHERE arrival % 50 <> 0
  UNION ALL SELECT *, {BLOCK} + 1 FROM uniq WHERE arrival % 50 <> 0 AND event_type = 'click'
  UNION ALL SELECT *, {BLOCK} + 4 FROM uniq WHERE arrival % 50 = 0),
numbered AS (SELECT *, dense_rank() OVER (ORDER BY file) AS batch FROM sent),
tops AS (SELECT batch, max(trade_time) AS top FROM numbered GROUP BY batch),
marks AS (
  SELECT batch, max(top) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - INTERVAL 2 DAY AS mark FROM tops),
met AS (SELECT n.*, coalesce(trade_time <= mark, FALSE) AS late FROM numbered n JOIN marks USING (batch))"""


def _arriving(spark, sf_dir, path):
    """Those messages, a file a batch, in the order of their times of writing."""
    rows = X.unique_ticks(spark, sf_dir)
    block = F.floor(F.date_diff("trade_time", F.lit("2024-01-01")) / 3).cast("int")
    kept = rows.where("arrival % 50 <> 0")
    sent = kept.withColumn("file", block)
    sent = sent.unionByName(kept.where("event_type = 'click'").withColumn("file", block + 1))
    sent = sent.unionByName(rows.where("arrival % 50 = 0").withColumn("file", block + 4))
    sent.select(_value(), "file").repartition("file").write.partitionBy("file").parquet(path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for status in files.globStatus(hadoop.Path(f"{path}/file=*/*.parquet")):
        number = int(status.getPath().getParent().getName().split("=")[1])
        files.setTimes(status.getPath(), 1_700_000_000_000 + 1_000 * number, -1)


def _deduplicated(spark, sf_dir):
    """The stream's folder and the finished query: keys are kept for two days past the newest time."""
    root = work_dir(spark, "windowed_stream")
    _arriving(spark, sf_dir, f"{root}/in")
    messages = read_price_stream(spark, "parquet", f"{root}/in/*", maxFilesPerTrigger=1)
    stream = store_prices(messages, f"{root}/out", f"{root}/checkpoint", dedup_window="2 days")
    _run(stream)
    return f"{root}/out", stream


@query("stream_dedup_window", f"WITH {ARRIVED} SELECT DISTINCT * FROM ({S.CLEAN} FROM met WHERE NOT late AND close > 0 AND volume >= 0)")
def stream_dedup_window(spark, sf_dir):
    """Keys forgotten once they are older than the window past the newest time; what comes later than that is dropped."""
    out = read_batches(spark, _deduplicated(spark, sf_dir)[0])
    return out.withColumn("trade_time", F.col("trade_time").cast("timestamp_ntz"))


@query("stream_late_rows", f"WITH {ARRIVED}, ids AS (SELECT DISTINCT batch FROM numbered) SELECT CAST(batch - 1 AS BIGINT) AS batch_id, count(*) FILTER (late) AS late FROM met GROUP BY batch HAVING count(*) FILTER (late) > 0")
def stream_late_rows(spark, sf_dir):
    """Rows that came too late, by the batch that dropped them."""
    return late_rows(spark, _deduplicated(spark, sf_dir)[1])


@query(
    "stream_news_sentiment",
    f"""WITH {S.MODEL}, {S.scored('text')}
    SELECT source AS symbol, TIMESTAMP '2024-01-01' + doc_id * INTERVAL 1 MINUTE AS publish_time, {S.r('sentiment_score')}
    FROM sentiment JOIN documents USING (doc_id)""",
)
def stream_news_sentiment(spark, sf_dir):
    root = work_dir(spark, "news_stream")
    overwrite_table(fit_sentiment(_labelled(spark, sf_dir)), f"{root}/model")
    to_messages(X.news(spark, sf_dir).drop("doc_id")).write.option("compression", "zstd").parquet(f"{root}/in")
    _run(
        store_news(
            read_news_stream(spark, "parquet", f"{root}/in"), read_table(spark, f"{root}/model"),
            f"{root}/out", f"{root}/checkpoint", max_chars=None, ntz=True,
        )
    )
    return X.rounded(read_batches(spark, f"{root}/out").select("symbol", "publish_time", "sentiment_score"))

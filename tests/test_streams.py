"""Streams give what the batch operators give, also after restarts."""

import json

import pytest

from barstream.operators.clean import clean_prices, parse_prices
from barstream.operators.text import fit_sentiment, sentiment_score
from barstream.streaming import io
from barstream.streaming.jobs import store_news, store_prices


def message(i, close=None, volume=1):
    return json.dumps(
        {"symbol": f"{i % 7:06d}", "trade_time": f"2024-01-01 {i // 3600:02d}:{i // 60 % 60:02d}:{i % 60:02d}", "open": 1.0,
         "high": None, "low": 0.5, "close": i + 1.0 if close is None else close, "volume": volume, "data_type": "daily"}
    )


def _write(folder, name, texts):
    # hidden until complete, as a file source expects
    folder.mkdir(exist_ok=True)
    (folder / f".{name}").write_text("\n".join(texts))
    (folder / f".{name}").rename(folder / name)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _start(spark, tmp_path, **options):
    messages = io.read_price_stream(spark, "text", str(tmp_path / "in"), maxFilesPerTrigger=1)
    return store_prices(messages, str(tmp_path / "out"), str(tmp_path / "checkpoint"), **options)


def _batch(spark, texts):
    return clean_prices(parse_prices(spark.createDataFrame([(t,) for t in texts], "value string")))


@pytest.mark.parametrize("window", [None, "2 days"])
def test_stream_equals_batch_with_restart(spark, tmp_path, window):
    first = [message(i) for i in range(100)] + [message(i) for i in range(0, 100, 3)] + ["{broken", message(200, close=-1.0)]
    second = [message(i) for i in range(50, 150)] + [message(201, volume=None)]
    _write(tmp_path / "in", "a.txt", first[:60])
    _write(tmp_path / "in", "b.txt", first[60:])
    assert io.run_until_done(_start(spark, tmp_path, dedup_window=window), 120)
    assert io.run_until_done(_start(spark, tmp_path, dedup_window=window), 120)  # nothing new
    _write(tmp_path / "in", "c.txt", second)
    assert io.run_until_done(_start(spark, tmp_path, dedup_window=window), 120)
    assert _rows(io.read_batches(spark, str(tmp_path / "out"))) == _rows(_batch(spark, first + second))


def test_a_batch_that_is_run_again_adds_nothing(spark, tmp_path):
    """Fail after the write of a batch; the restart repeats it."""
    texts = [message(i) for i in range(30)]
    _write(tmp_path / "in", "a.txt", texts)

    messages = io.read_price_stream(spark, "text", str(tmp_path / "in"))
    cleaned = clean_prices(parse_prices(messages))
    calls = []

    class Stop(Exception):
        pass

    def failing(batch):
        calls.append(1)
        batch.write.mode("overwrite").parquet(str(tmp_path / "out" / "batch_id=0"))
        raise Stop

    query = io.append_batches(cleaned, str(tmp_path / "out"), str(tmp_path / "checkpoint"), transform=failing)
    with pytest.raises(Exception):
        query.awaitTermination(120)
    assert calls and spark.read.parquet(str(tmp_path / "out")).count() == 30
    query = io.append_batches(cleaned, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    assert io.run_until_done(query, 120)
    assert _rows(io.read_batches(spark, str(tmp_path / "out"))) == _rows(_batch(spark, texts))


def test_empty_batches_write_nothing(spark, tmp_path):
    _write(tmp_path / "in", "a.txt", ["{broken", message(1, close=-1.0)])
    assert io.run_until_done(_start(spark, tmp_path), 120)
    assert not (tmp_path / "out").exists()


def test_snapshots_are_dropped_unless_accepted(spark, tmp_path):
    snap = json.dumps({"symbol": "000001", "trade_time": "2024-01-01T09:00:00.5", "price": 2.0, "volume": 3, "turnover": 6.0, "data_type": "realtime"})
    snap = snap.replace("00.5", "00.500000")
    _write(tmp_path / "in", "a.txt", [message(1), snap])
    assert io.run_until_done(_start(spark, tmp_path, accept_snapshots=True), 120)
    assert io.read_batches(spark, str(tmp_path / "out")).where("data_type = 'realtime' AND close = 2").count() == 1


def test_news_stream(spark, tmp_path):
    model = fit_sentiment(spark.createDataFrame([("good day", 1), ("bad day", 0)], "text string, label int"))
    model.write.parquet(str(tmp_path / "model"))
    model = spark.read.parquet(str(tmp_path / "model"))
    news = [{"symbol": "a", "title": t, "content": "c", "publish_time": f"2024-01-01 00:00:{i:02d}", "source": "s", "data_type": "news"} for i, t in enumerate(["good news", "bad news", None, "bad news", "ab"])]
    _write(tmp_path / "in", "a.txt", [json.dumps(n, ensure_ascii=False) for n in news])
    stream = io.read_news_stream(spark, "text", str(tmp_path / "in"))
    assert io.run_until_done(store_news(stream, model, str(tmp_path / "out"), str(tmp_path / "checkpoint")), 120)
    got = io.read_batches(spark, str(tmp_path / "out")).orderBy("publish_time").collect()
    want = sentiment_score(spark.createDataFrame([(i, n["title"]) for i, n in enumerate(news)], "id int, title string"), model).orderBy("id").collect()
    assert [r["sentiment_score"] for r in got] == [r["sentiment_score"] for r in want]
    assert len(got) == 5


def test_batches_of_files_are_bounded_by_their_bytes(spark, tmp_path):
    """However large the files are, a batch's texts and their sums stay bounded; a stated number of files goes before."""
    for i in range(4):
        _write(tmp_path / "in", f"{i}.txt", [message(i)])
    for options, batches in (({"maxBytesPerTrigger": 100}, 4), ({}, 1), ({"maxFilesPerTrigger": 2}, 2)):
        name = "-".join(options)
        stream = io.read_news_stream(spark, "text", str(tmp_path / "in"), **options)
        query = io.append_batches(stream, str(tmp_path / f"out{name}"), str(tmp_path / f"checkpoint{name}"))
        assert io.run_until_done(query, 120)
        assert len(list((tmp_path / f"out{name}").glob("batch_id=*"))) == batches
        assert all(f.name.endswith(".zstd.parquet") for f in (tmp_path / f"out{name}").glob("batch_id=*/*.parquet"))


def test_kafka_settings():
    """No broker here: check what the sources ask for."""

    class Reader:
        def __init__(self):
            self.seen = {}

        readStream = property(lambda self: self)

        def format(self, name):
            self.seen["format"] = name
            return self

        def options(self, **options):
            self.seen.update(options)
            return self

        def load(self):
            return self.seen

    prices = io.read_price_stream(Reader(), **{"kafka.bootstrap.servers": "b:9092"})
    assert prices == {"format": "kafka", "subscribe": "stock-prices", "startingOffsets": "earliest", "failOnDataLoss": "false", "maxOffsetsPerTrigger": 5_000_000, "kafka.bootstrap.servers": "b:9092"}
    assert "failOnDataLoss" not in io.read_news_stream(Reader())


def test_dedup_window_frees_its_state(spark):
    """Keys that the window has left are gone from the state, and what comes late is counted."""
    from barstream.streaming.io import kept_keys, late_rows, read_batches
    from checks import streams

    provider = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    folder, query = streams._deduplicated(spark, "/root/testdata/sf0.001")
    keys = read_batches(spark, folder).select("symbol", "trade_time").distinct().count()
    assert 0 < kept_keys(query) < 0.35 * keys
    late = late_rows(spark, query).collect()
    dropped = sum(op.numRowsDroppedByWatermark for report in query.recentProgress for op in report.stateOperators)
    assert late and sum(r["late"] for r in late) == dropped
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == provider

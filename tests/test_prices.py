"""Cleaning, bars, indicators, ranking and normalisers on hand-made rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from barstream.operators import bars as B
from barstream.operators import features as FE
from barstream.operators import indicators as I
from barstream.operators.clean import assert_unique_key, clean_prices, parse_news, parse_prices
from barstream.operators.ranking import first_per_key, latest_per_key, of_codes
from barstream.sources import normalize as N
from barstream.sources.tables import to_messages, write_jdbc, work_dir
from barstream.sources.watchlist import watchlist

PRICE = "symbol string, trade_time timestamp, open double, high double, low double, close double, volume bigint, data_type string, arrival int"


def t(hour, minute=0, day=1):
    return datetime(2024, 1, day, hour, minute)


def test_dedup_comes_before_the_filters(spark):
    rows = [
        ("000001", t(9), 1.0, 1.0, 1.0, -5.0, 10, "daily", 1),  # invalid, arrives first
        ("000001", t(9), 1.0, 1.0, 1.0, 5.0, 10, "daily", 2),  # valid, must not survive
        ("000001", t(10), None, 2.0, None, 6.0, 0, "daily", 3),
        ("000001", t(11), 1.0, 1.0, 1.0, 5.0, None, "daily", 4),
        ("000001", t(12), 1.0, 1.0, 1.0, None, 5, "daily", 5),
        ("000001", t(13), 1.0, 1.0, 1.0, 7.0, -1, "daily", 6),
        ("000001", None, 1.0, 1.0, 1.0, 7.0, 1, "daily", 8),
        ("000001", None, 1.0, 1.0, 1.0, 9.0, 1, "daily", 7),  # equal NULL times are one key
    ]
    out = clean_prices(spark.createDataFrame(rows, PRICE), arrival="arrival").orderBy("close").collect()
    assert [(r["trade_time"], r["close"]) for r in out] == [(t(10), 6.0), (None, 9.0)]
    assert (out[0]["symbol"], out[0]["open"], out[0]["low"], out[0]["volume"]) == ("000001", 0.0, 0.0, 0)
    assert "arrival" not in out[0].asDict()


def test_copies_are_cut_before_the_shuffle(spark, capsys):
    df = spark.createDataFrame([], PRICE)
    clean_prices(df, arrival="arrival").explain()
    plan = capsys.readouterr().out
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_messages(spark):
    texts = [
        '{"symbol":"000001","trade_time":"2024-01-01 15:00:00","open":1,"high":2,"low":0.5,"close":1.5,"volume":7,"data_type":"daily","more":1}',
        '{"symbol":"000001","trade_time":"2024-01-01T15:00:00.123456","price":1.5,"volume":7,"turnover":10.5,"data_type":"realtime"}',
        '{"symbol":"000001","trade_time":"never","close":1.5,"volume":3.5}',
        "{broken",
        None,
    ]
    df = spark.createDataFrame([(x,) for x in texts], "value string")
    for frame in (df, df.select(F.col("value").cast("binary").alias("value"))):
        rows = parse_prices(frame).collect()
        assert rows[0]["close"] == 1.5 and rows[0]["trade_time"] == t(15) and rows[0]["volume"] == 7
        assert rows[1]["close"] is None and rows[1]["trade_time"] is None
        assert rows[2]["trade_time"] is None and rows[2]["volume"] is None and rows[2]["close"] == 1.5
        assert all(v is None for v in rows[3]) and all(v is None for v in rows[4])
    taken = parse_prices(df, accept_snapshots=True).collect()[1]
    assert taken["close"] == 1.5 and taken["trade_time"] == datetime(2024, 1, 1, 15, 0, 0, 123456)


def test_news_round_trip_keeps_text_and_nulls(spark):
    news = spark.createDataFrame(
        [("000001", "涨停 é \"quoted\"", None, "2024-01-01 08:00:00", "新浪", "news")],
        "symbol string, title string, content string, publish_time string, source string, data_type string",
    )
    message = to_messages(news, key="symbol").first()
    assert message["key"] == "000001" and "涨停" in message["value"] and '"content":null' in message["value"]
    back = parse_news(to_messages(news)).first()
    assert back["title"] == news.first()["title"] and back["content"] is None and back["publish_time"] == t(8)


def test_daily_bars(spark):
    rows = [
        ("a", t(15), 3.0, 4.0, 0.0, 3.5, 10, "daily", 1),
        ("a", t(9), 1.0, 5.0, 2.0, 1.5, 20, "daily", 2),
        ("a", t(9, day=2), 7.0, 7.0, 7.0, 7.0, 1, "daily", 3),
    ]
    df = spark.createDataFrame(rows, PRICE)
    bar = B.daily_bars(df).orderBy("start_time").first()
    assert bar.asDict() == {
        "stock_code": "a", "start_time": t(0), "end_time": datetime(2024, 1, 1, 23, 59, 59),
        "open_price": 1.0, "high_price": 5.0, "low_price": 0.0, "close_price": 3.5, "volume": 30,
    }
    assert B.daily_bars(df, ignore_zero=True).orderBy("start_time").first()["low_price"] == 2.0


def test_kline_is_ascending_and_cut_to_the_newest(spark):
    rows = [("a", t(9, day=d), 1.0 * d, 2.0 * d, 0.5, 1.0 * d, d, "daily", d) for d in range(1, 6)]
    bars = B.daily_bars(spark.createDataFrame(rows, PRICE))
    got = B.kline(bars, "a", 3).collect()
    assert [r["time"] for r in got] == [f"2024-01-0{d}T00:00:00" for d in (3, 4, 5)]
    assert got == B.kline(bars, ["a", "zz"], 3).collect()
    candle = B.candles(B.kline(bars, "a", 1)).first()
    assert candle["candle"] == [5.0, 5.0, 0.5, 10.0]
    assert of_codes(bars, "none").count() == 0


def _closes(spark, values, symbol="a"):
    rows = [(symbol, datetime(2024, 1, 1, 0, i // 60, i % 60), v, i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "symbol string, trade_time timestamp, close double, volume bigint")


def _column(df, name):
    return [r[name] for r in df.orderBy("trade_time").collect()]


def test_short_prefix_averages_what_exists(spark):
    assert _column(I.sma(_closes(spark, [1.0, 2.0, 3.0, 6.0])), "sma_5") == [1.0, 1.5, 2.0, 3.0]


def test_constant_rising_and_single_series(spark):
    flat = _closes(spark, [5.0] * 25)
    assert _column(I.rsi(flat), "rsi_14") == [None] + [50.0] * 24
    assert set(_column(I.boll(flat), "boll_upper")) == {5.0} == set(_column(I.boll(flat), "boll_lower"))
    assert {round(x, 12) for x in _column(I.macd(flat), "macd")} == {0.0}
    rising = _closes(spark, [float(i) for i in range(1, 30)])
    assert _column(I.rsi(rising), "rsi_14")[1:] == [100.0] * 28
    one = _closes(spark, [3.0])
    assert _column(I.ema(one, 12), "ema_12") == [3.0] and _column(I.rsi(one), "rsi_14") == [None]
    assert _column(I.ema(_closes(spark, [1.0, 2.0, 4.0]), 1), "ema_1") == [1.0, 2.0, 4.0]


def test_label_at_the_end(spark):
    df = _closes(spark, [1.0, 5.0, 3.0, 4.0, 2.0, 9.0, 1.0])
    assert _column(FE.label_direction(df), "label") == [1, 0, 0, 0, 0, 0, 0]
    kept = FE.label_direction(df, drop_unlabelled=True)
    assert _column(kept, "future_close") == [9.0, 1.0]


def test_training_frame_multiplies_duplicate_keys(spark):
    df = _closes(spark, [1.0, 2.0])
    double = df.unionByName(df.where("close = 1"))
    frame = FE.training_frame(double, I.indicator_table(double))
    assert frame.count() == 5
    with pytest.raises(ValueError, match="duplicate key"):
        assert_unique_key(double)
    assert assert_unique_key(df) is df


def test_splits(spark):
    df = spark.range(2000).select(F.col("id").alias("k"), F.timestamp_seconds("id").alias("trade_time"))
    train, test = FE.split(df, ["k"])
    assert train.count() + test.count() == 2000 and 300 < test.count() < 500
    again = FE.split(df.repartition(7), ["k"])[1]
    assert sorted(r["k"] for r in again.collect()) == sorted(r["k"] for r in test.collect())
    train, test = FE.split(df, ["k"], mode="time")
    assert abs(test.count() - 400) <= 2
    assert train.agg(F.max("trade_time")).first()[0] < test.agg(F.min("trade_time")).first()[0]
    folds = FE.add_folds(df, ["k"], 4).groupBy("fold").count().collect()
    assert {r["fold"] for r in folds} == {0, 1, 2, 3}


def test_first_and_latest(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 5, "w")], "k string, n int, v string")
    assert sorted(r["v"] for r in latest_per_key(df, "k", ["n", "v"]).collect()) == ["w", "z"]
    assert sorted(r["v"] for r in first_per_key(df, "k", "n", 2).collect())[:2] == ["w", "x"]


def test_normalisers(spark):
    raw = spark.createDataFrame(
        [("000001", "2025-06-03", "11.1", "11.3", "bad", "11.2", "100")],
        "symbol string, date string, open string, high string, low string, close string, volume string",
    )
    row = N.normalize_daily(raw).first()
    assert row["symbol"] == "000001" and row["trade_time"] == "2025-06-03 15:00:00"
    assert row["low"] is None and row["volume"] == 100 and row["data_type"] == "daily"

    quotes = spark.createDataFrame(
        [("000001", 1.0, 5, 5.0, 2), ("000001", 9.0, 5, 5.0, 1), ("999999", 3.0, 1, 3.0, 3)],
        "`代码` string, `最新价` double, `成交量` bigint, `成交额` double, o int",
    )
    got = N.normalize_snapshot(quotes, watchlist(spark), datetime(2024, 1, 1, 10), order="o").collect()
    assert [(r["symbol"], r["price"], r["trade_time"]) for r in got] == [("000001", 9.0, "2024-01-01T10:00:00")]

    news = spark.createDataFrame([("a", f"t{i}", "2024-01-01 00:00:00", i) for i in range(40)], "symbol string, `新闻标题` string, `发布时间` string, o int")
    out = N.normalize_news(news, "o", 30).collect()
    assert len(out) == 30 and {r["source"] for r in out} == {"eastmoney"} and {r["content"] for r in out} == {""}


def test_history_days_are_inclusive_and_reach_the_scan(spark, tmp_path, capsys):
    df = spark.createDataFrame([(datetime(2024, 1, d, 23, 59),) for d in range(1, 6)], "trade_time timestamp")
    df.write.parquet(str(tmp_path / "h"))
    out = N.history(spark.read.parquet(str(tmp_path / "h")), date(2024, 1, 2), "2024-01-04")
    assert out.count() == 3
    out.explain("formatted")
    assert "GreaterThanOrEqual(trade_time" in capsys.readouterr().out


def test_ingest_counts_totals(spark):
    df = spark.createDataFrame([("a", "daily"), ("a", "news"), ("b", "daily")], "symbol string, data_type string")
    got = {(r["symbol"], r["data_type"], r["level"]): r["n"] for r in N.ingest_counts(df).collect()}
    assert got[(None, None, 3)] == 3 and got[("a", None, 1)] == 2 and got[("b", "daily", 0)] == 1


def test_watchlist(spark):
    rows = watchlist(spark).collect()
    assert len(rows) == 20 and rows[0].asDict() == {"code": "000001", "baostock_code": "sz.000001", "name": "平安银行"}
    assert {r["baostock_code"] for r in rows if r["code"] == "600036"} == {"sh.600036"}


def test_jdbc_sink_settings():
    """No database here: check what is handed to the writer."""

    class Recorder:
        def __init__(self):
            self.calls = []

        def __getattr__(self, name):
            if name == "write":
                return self
            def call(*args, **kwargs):
                self.calls.append((name, args, kwargs))
                return self
            return call

    frame = Recorder()
    write_jdbc(frame, "jdbc:x://h/db", "realtime_klines", max_connections=4, user="u", password="p")
    assert frame.calls == [
        ("coalesce", (4,), {}), ("format", ("jdbc",), {}),
        ("options", (), {"url": "jdbc:x://h/db", "dbtable": "realtime_klines", "user": "u", "password": "p"}),
        ("mode", ("append",), {}), ("save", (), {}),
    ]


def test_work_dir_uses_the_shared_folder():
    class Session:
        def __init__(self, master="local[2]", **settings):
            self.conf = self.sparkContext = self
            self.master = master
            self.settings = settings

        def get(self, key, default):
            return self.settings.get(key.replace(".", "_"), default)

    assert work_dir(Session(spark_sql_warehouse_dir="file:/w"), "x").startswith("file:/w/barstream/")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_dir(Session("spark://host:7077"), "x")
    shared = Session(spark_checkpoint_dir="hdfs://n/shared/")
    a, b = work_dir(shared, "x"), work_dir(shared, "x")
    assert a.startswith("hdfs://n/shared/barstream/") and a.endswith("/x") and a != b

"""A key that holds a large part of the rows: results over parts equal the plain ones."""

import math
import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from barstream.operators import features, indicators, metrics
from barstream.operators.recurrence import Smooth, linear_scan, smooth, transition
from barstream.operators.slicing import order_table, running_totals, windowed

START = datetime(2024, 1, 1)


def _ticks(seed=1, hot_rows=700, gaps=0.0):
    """One hot symbol with bunched times, two middling ones, many small, a NULL key."""
    rng = random.Random(seed)
    rows = []
    for symbol, count in [("hot", hot_rows), ("mid", 90), ("mid2", 61), (None, 40)] + [(f"s{i}", 1 + i % 4) for i in range(20)]:
        t = START
        for i in range(count):
            # most rows lie within a few seconds, a few are far away
            t += timedelta(microseconds=rng.choice([1, 7, 1000, 50_000]) if i % 50 else rng.randint(1, 10**11))
            close = None if rng.random() < gaps else round(rng.uniform(1, 500), 2)
            rows.append((symbol, t, close, rng.randint(0, 100)))
    rng.shuffle(rows)
    return rows


@pytest.fixture(params=["timestamp", "timestamp_ntz"])
def ticks(spark, request):
    df = spark.createDataFrame(_ticks(), "symbol string, trade_time timestamp, close double, volume bigint")
    return df.withColumn("trade_time", F.col("trade_time").cast(request.param)).cache()


def _same(a, b, columns, keys=("symbol", "trade_time")):
    def table(df):
        return {tuple(r[k] for k in keys): [r[c] for c in columns] for r in df.collect()}

    left, right = table(a), table(b)
    assert left.keys() == right.keys()
    for key in left:
        for x, y in zip(left[key], right[key]):
            assert (x is None) == (y is None), key
            assert x is None or math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9), (key, x, y)


@pytest.mark.parametrize("rows_per_part", [25, 100])
def test_parts_are_bounded_ordered_and_complete(ticks, rows_per_part):
    table = order_table(ticks, "symbol", "trade_time", rows_per_part)
    rows = [r.asDict() for r in table.rows.orderBy("_row").collect()]
    assert len(rows) == ticks.count() and table.columns == ticks.columns
    want = sorted(_ticks(), key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert [(r["symbol"], r["trade_time"]) for r in rows] == [r[:2] for r in want]
    assert [r["_slice"] for r in rows] == sorted(r["_slice"] for r in rows)
    sizes = Counter(r["_slice"] for r in rows)
    assert max(sizes.values()) <= 2 * rows_per_part + 2
    # every part of every key that lies in several, and no other
    places = {}
    for r in rows:
        places.setdefault((r["symbol"], r["_slice"]), []).append(r["_row"])
    cut = {k for k, n in Counter(k for k, _ in places).items() if n > 1}
    runs = {(r["_key"], r["_at"]): (r["_first"], r["_last"]) for r in table.runs.collect()}
    assert runs == {k: (v[0], v[-1]) for k, v in places.items() if k[0] in cut} and "hot" in cut
    assert all(v == list(range(v[0], v[-1] + 1)) for v in places.values())


@pytest.mark.parametrize("rows_per_part", [12, 60])
def test_windows_over_parts(ticks, rows_per_part):
    table = order_table(ticks, "symbol", "trade_time", rows_per_part)
    _same(indicators.sma(ticks), indicators.sma(table), ["sma_5", "sma_10", "sma_20"])
    _same(indicators.boll(ticks), indicators.boll(table), ["boll_mid", "boll_upper", "boll_lower"])
    a, b = features.label_direction(ticks), features.label_direction(table)
    _same(a, b, ["future_close", "label"])
    w = lambda w: {"back": F.lag("close", 4).over(w), "on": F.lead("close", 3).over(w)}
    plain = ticks.withColumns(w(Window.partitionBy("symbol").orderBy("trade_time")))
    _same(plain, windowed(table, w, "symbol", "trade_time", before=4, after=3), ["back", "on"])


@pytest.mark.parametrize("rows_per_part", [25])
def test_recurrences_over_parts(ticks, rows_per_part):
    table = order_table(ticks, "symbol", "trade_time", rows_per_part)
    _same(indicators.ema(ticks, 12), indicators.ema(table, 12), ["ema_12"])
    _same(indicators.ema(ticks, 400), indicators.ema(table, 400), ["ema_400"])
    _same(indicators.macd(ticks), indicators.macd(table), ["dif", "dea", "macd"])
    _same(indicators.rsi(ticks), indicators.rsi(table), ["rsi_14"])


def test_a_million_rows_of_one_time_spread_over_tasks(spark):
    """One symbol, one time, equal and unequal closes: parts of equal size, and each row averaged once."""
    n = 1_000_000
    df = spark.range(n).select(F.lit("x").alias("symbol"), F.lit(START).alias("trade_time"), (F.col("id") % 3).cast("double").alias("close"))
    table = order_table(df, "symbol", "trade_time", 50_000)
    sizes = [r["count"] for r in table.rows.groupBy("_slice").count().collect()]
    assert sum(sizes) == n and len(sizes) >= 16 and max(sizes) <= 100_000
    got = indicators.sma(table, spans=(2,)).agg(F.count("*"), F.sum("sma_2")).first()
    firsts = {0: n - 2 * (n // 3), 1: n // 3, 2: n // 3}  # rows of one close lie together: each mean but three is the close itself
    total = sum(k * v for k, v in firsts.items())
    assert got[0] == n and abs(got[1] - total) <= 3


def test_windows_on_ordered_tables_exchange_no_rows(ticks):
    """The stored parts are read as they lie; only copied edge rows and runs are exchanged."""
    table = order_table(ticks, "symbol", "trade_time", 25)
    wanted = [indicators.boll(table), running_totals(table, ["volume"], "symbol", "trade_time")]
    for plan in (df._jdf.queryExecution().executedPlan().toString() for df in wanted):
        assert "Bucketed: true" in plan and "hashpartitioning(_slice" not in plan.replace("REPARTITION_BY_NUM", "").split("Union")[0]


def test_extended_tables_stay_in_order(ticks):
    """Indicators stored in the prices' order: the label equals the one of the plain frame, and nothing is sorted anew."""
    plain = features.training_frame(None, indicators.indicator_table(ticks.na.drop(subset=["symbol"])))
    table = indicators.ordered_indicators(order_table(ticks.na.drop(subset=["symbol"]), "symbol", "trade_time", 25))
    assert table.parts > 20 and table.rows.count() == plain.count()
    frame = features.training_frame(None, table)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "rangepartitioning" not in plan
    rounded = lambda df: Counter(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())
    assert rounded(frame) == rounded(plain)
    with pytest.raises(ValueError, match="hold the prices"):
        features.training_frame(ticks, table)


def _rsi(rows):
    want = {}
    for symbol in {r[0] for r in rows}:
        last = up = down = None
        for _, t, x, _ in sorted((r for r in rows if r[0] == symbol), key=lambda r: r[1]):
            want[(symbol, t)] = None
            if x is None:
                continue
            if last is not None:
                gain, loss = max(x - last, 0.0), max(last - x, 0.0)
                up = gain if up is None else up * 13 / 14 + gain / 14
                down = loss if down is None else down * 13 / 14 + loss / 14
                want[(symbol, t)] = 100 * up / (up + down) if up + down else 50.0
            last = x
    return want


def test_recurrence_equals_a_loop(spark):
    """Also with missing prices, and with batches smaller than a key."""
    rows = _ticks(seed=5, gaps=0.2)
    df = spark.createDataFrame(rows, "symbol string, trade_time timestamp, close double, volume bigint")
    want = {}
    for symbol in {r[0] for r in rows}:
        e = None
        for _, t, x, _ in sorted((r for r in rows if r[0] == symbol), key=lambda r: r[1]):
            if x is not None:
                e = x if e is None else e + 2 / 13 * (x - e)
            want[(symbol, t)] = e if x is not None else None
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
        for table in (df, order_table(df, "symbol", "trade_time", 30)):
            got = {(r["symbol"], r["trade_time"]): r["ema_12"] for r in indicators.ema(table, 12).collect()}
            assert got.keys() == want.keys()
            for key, value in want.items():
                assert (value is None) == (got[key] is None)
                assert value is None or math.isclose(value, got[key], rel_tol=1e-12)
            strength = {(r["symbol"], r["trade_time"]): r["rsi_14"] for r in indicators.rsi(table).collect()}
            for key, value in _rsi(rows).items():
                assert (value is None) == (strength[key] is None), key
                assert value is None or math.isclose(value, strength[key], rel_tol=1e-9)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)


def test_running_totals_and_auc_over_parts(spark):
    rng = random.Random(3)
    rows = [("a" if rng.random() < 0.8 else "b", round(rng.random(), 2), rng.randint(0, 1)) for _ in range(900)]
    df = spark.createDataFrame(rows, "model string, score double, label int")
    levels = df.groupBy("model", "score").agg(F.sum("label").alias("n"))
    table = order_table(levels, "model", "score", 10)
    assert table.runs.count()
    plain = running_totals(levels, ["n"], "model", "score")
    _same(plain, running_totals(table, ["n"], "model", "score"), ["n_upto"], ("model", "score"))
    exact = {r["model"]: r["auc"] for r in metrics.auc(df, by="model", rows_per_task=10).collect()}
    for model in "ab":
        pos = [s for m, s, y in rows if m == model and y == 1]
        neg = [s for m, s, y in rows if m == model and y == 0]
        wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
        assert math.isclose(exact[model], wins / len(pos) / len(neg), rel_tol=1e-12)


def test_rows_of_one_time_go_by_the_further_columns(spark):
    df = spark.createDataFrame([("x", START, float(i), i) for i in range(50)], "symbol string, trade_time timestamp, close double, volume bigint")
    out = indicators.sma(order_table(df, "symbol", ["trade_time", "volume"], 10))
    got = [r["sma_5"] for r in out.orderBy("volume").collect()]
    assert got == [sum(range(max(0, i - 4), i + 1)) / min(i + 1, 5) for i in range(50)]


def test_scan_and_transition():
    import numpy as np

    rng = np.random.default_rng(0)
    keep, add = rng.random(1000), rng.random(1000)
    keep[0], y, want = 0.0, 0.0, []
    for k, a in zip(keep, add):
        y = k * y + a
        want.append(y)
    assert np.allclose(linear_scan(keep, add), want, rtol=1e-12)
    steps = [Smooth("a", (("x", 1.0),), 0.5), Smooth("b", (("a", 1.0),), 0.25)]
    assert transition(steps).tolist() == [[0.5, 0.0], [0.125, 0.75]]


def test_empty_input(spark):
    df = spark.createDataFrame([], "symbol string, trade_time timestamp, close double, volume bigint")
    for out in (indicators.sma(df), indicators.ema(df, 12), indicators.macd(df), indicators.rsi(df), features.label_direction(df)):
        assert out.count() == 0
    table = order_table(df, "symbol", "trade_time")
    for out in (indicators.sma(table), indicators.ema(table, 12), indicators.macd(table), indicators.rsi(table), features.label_direction(table)):
        assert out.count() == 0


def test_building_starts_no_job(spark):
    """On plain frames the window and recurrence operators only describe what to do."""
    df = spark.createDataFrame(_ticks(seed=2), "symbol string, trade_time timestamp, close double, volume bigint")
    context = spark.sparkContext
    context.setJobGroup("building", "building")
    try:
        for build in (indicators.sma, lambda d: indicators.ema(d, 12), indicators.macd, indicators.rsi, indicators.boll):
            build(df)
        from barstream.operators.features import label_direction

        label_direction(df)
        assert not context.statusTracker().getJobIdsForGroup("building")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)

"""Appended rows continue the stored state: equal to the full recompute."""

import random
from datetime import datetime, timedelta

import pytest

from barstream.operators import incremental, slicing
from barstream.operators import indicators as I

START = datetime(2024, 1, 1)
SCHEMA = "symbol string, trade_time timestamp_ntz, close double, volume bigint"


def prices(seed=1):
    """A symbol with most rows, small ones, gaps, one that begins late and one without a name."""
    rnd, rows = random.Random(seed), []
    for symbol, begin, end in (("hot", 0, 300), ("a", 0, 40), ("b", 0, 1), ("b", 95, 99), ("late", 100, 130), ("ends", 0, 30), (None, 0, 120)):
        for i in range(begin, end):
            close = None if rnd.random() < 0.05 else round(rnd.uniform(5, 50), 2)
            rows.append((symbol, START + timedelta(hours=i), close, i))
    return rows


def full(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    found = {}
    for part in (I.sma(df), I.ema(df, 12), I.macd(df), I.rsi(df), I.boll(df)):
        for r in part.collect():
            found.setdefault((r["symbol"], r["trade_time"]), {}).update(r.asDict())
    return found


def run(spark, rows, cuts):
    """{key: row} of the appended pieces."""
    state, found = None, {}
    for low, high in zip([START - timedelta(days=1), *cuts], [*cuts, START + timedelta(days=99)]):
        piece = [r for r in rows if low <= r[1] < high]
        done, state = incremental.advance(spark.createDataFrame(piece, SCHEMA), state)
        for r in done.collect():
            assert (r["symbol"], r["trade_time"]) not in found
            found[r["symbol"], r["trade_time"]] = r.asDict()
    return found, state


@pytest.mark.parametrize("rows_per_part", [2_000_000, 7])
def test_equals_the_full_recompute(spark, monkeypatch, rows_per_part):
    monkeypatch.setattr(slicing, "ROWS_PER_PART", rows_per_part)
    rows = prices()
    got, state = run(spark, rows, [START + timedelta(hours=h) for h in (1, 97, 101)])
    want = full(spark, rows)
    assert got.keys() == want.keys()
    for key, row in got.items():
        for name, value in row.items():
            expected = want[key][name]
            close = pytest.approx(expected, rel=1e-9, abs=1e-9) if isinstance(expected, float) else expected
            assert value == close, (key, name)
    assert {r["symbol"] for r in state.values.collect()} == {r[0] for r in rows}
    assert state.tail.groupBy("symbol").count().agg({"count": "max"}).first()[0] == 19


def test_late_rows_and_empty_pieces(spark, tmp_path):
    rows = [("a", START + timedelta(hours=i), float(i), 0) for i in range(30)]
    _, state = incremental.advance(spark.createDataFrame(rows, SCHEMA))
    state.save(str(tmp_path / "state"))
    state = incremental.State.load(spark, str(tmp_path / "state"))
    again = spark.createDataFrame(rows[10:] + [("a", START + timedelta(hours=30), 30.0, 0)], SCHEMA)
    done, after = incremental.advance(again, state)
    assert [r["trade_time"] for r in done.collect()] == [START + timedelta(hours=30)]
    assert incremental.late(again, state).count() == 20
    none, same = incremental.advance(again.limit(0), after)
    assert none.count() == 0 and same.values.collect() == after.values.collect()

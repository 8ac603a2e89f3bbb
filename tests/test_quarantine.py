"""Messages that cannot be used go to a table by reason."""

import json

from barstream.operators.clean import USABLE, parse_prices, quarantine, read_sorted, sort_messages

GOOD = {"symbol": "s", "trade_time": "2024-01-02 10:00:00", "open": 1.5, "high": 2, "low": 1, "close": 1.25, "volume": 10, "data_type": "daily"}
CASES = [
    (json.dumps(GOOD), None), (json.dumps(GOOD | {"low": None}), None), (json.dumps(GOOD | {"more": [1]}), None), (json.dumps(GOOD | {"open": "1.5"}), None),
    (None, "empty"), ("  ", "empty"), ('{"symbol": "s"', "malformed"), ("plain", "malformed"), ("[1, 2]", "no_object"), ("7", "no_object"), ("null", "no_object"),
    (json.dumps({"symbol": "s"}), "missing"), (json.dumps(GOOD | {"symbol": None}), "missing"),
    (json.dumps(GOOD | {"close": "much"}), "mistyped"), (json.dumps(GOOD | {"volume": {"n": 1}}), "mistyped"), (json.dumps(GOOD | {"symbol": 7}), "mistyped"),
    (json.dumps(GOOD | {"close": True}), "mistyped"), (json.dumps(GOOD | {"trade_time": "yesterday"}), "bad_time"),
]


def messages(spark):
    return spark.createDataFrame([(i, v) for i, (v, _) in enumerate(CASES)], "id int, value string")


def test_reasons(spark):
    got = {r["id"]: r["reason"] for r in sort_messages(messages(spark)).collect()}
    assert got == {i: reason for i, (_, reason) in enumerate(CASES)}
    assert sort_messages(messages(spark).limit(0)).count() == 0


def test_nothing_is_lost(spark, tmp_path):
    path = str(tmp_path / "rejects")
    good = quarantine(messages(spark), path)
    rejects = read_sorted(spark, path, good.schema).where(f"reason <> '{USABLE}'")
    assert good.columns == ["id", "value"] and good.count() + rejects.count() == len(CASES)
    assert {r["id"]: r["value"] for r in rejects.collect()} == {i: v for i, (v, reason) in enumerate(CASES) if reason}
    assert parse_prices(good).where("symbol IS NULL OR trade_time IS NULL").count() == 0

"""The whole path: messages, clean table, indicators, model, served predictions."""

import json
from datetime import datetime, timedelta

from barstream.plans import jobs
from barstream.streaming import io
from barstream.streaming.jobs import store_prices


def test_from_messages_to_served_tables(spark, tmp_path, monkeypatch):
    start = datetime(2024, 1, 1, 9)
    texts = []
    for symbol in range(6):
        for i in range(60):
            close = 100 + 10 * ((i + 3 * symbol) % 12) + symbol
            texts.append(json.dumps({
                "symbol": f"{symbol:06d}", "trade_time": (start + timedelta(hours=i)).strftime("%Y-%m-%d %H:%M:%S"),
                "open": close, "high": close + 1, "low": close - 1, "close": close, "volume": i, "data_type": "daily",
            }))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join(texts))
    paths = {name: str(tmp_path / name) for name in ("prices", "indicators", "model", "checkpoint")}
    messages = io.read_price_stream(spark, "text", str(tmp_path / "in"))
    assert io.run_until_done(store_prices(messages, paths["prices"], paths["checkpoint"]), 120)

    jobs.build_indicators(spark, paths["prices"], paths["indicators"])
    model, measured = jobs.train_direction(spark, paths["indicators"], paths["model"], maxIter=5)
    assert measured["metrics"].first()["accuracy"] > 0.7
    assert sum(r["pred_0"] + r["pred_1"] for r in measured["confusion"].collect()) == measured["metrics"].first()["n_rows"]

    served = {}
    monkeypatch.setattr(jobs, "write_jdbc", lambda df, url, table, **options: served.update({table: df}))
    jobs.publish_bars(spark, paths["prices"], "jdbc:x")
    jobs.publish_predictions(spark, paths["indicators"], paths["model"], "jdbc:x")
    assert served["realtime_klines"].count() == 6 * 3
    rows = served["predictions"].collect()
    assert served["predictions"].columns == ["stock_code", "predict_time", "predicted_direction", "confidence"]
    assert len(rows) == 6 and {r["predicted_direction"] for r in rows} <= {"UP", "DOWN"}
    assert all(0 <= r["confidence"] <= 1 for r in rows)

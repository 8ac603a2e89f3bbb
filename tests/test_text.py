"""Sentiment contract and both ways of looking tokens up."""

import math

import pytest
from pyspark.sql import functions as F

from barstream.functions.columns import fixed_text, is_blank, parse_time, strip_blank
from barstream.functions.scorers import make_scorer
from barstream.operators.text import fit_sentiment, sentiment_score, tokens

TITLES = [
    (1, "good good news today"),
    (2, "bad loss and bad news"),
    (3, "good"),  # four characters
    (4, "goods"),  # five characters, unknown token
    (5, None),
    (6, ""),
    (7, "\n 　\n\n\n\n\n"),
    (8, "   good  "),  # four after stripping Unicode blanks
    (9, "中国平安大涨"),
    (10, "x" * 300 + " bad bad bad"),
    (11, "good news " * 400),
]


@pytest.fixture(scope="module")
def model(spark):
    labelled = [("good news up", 1), ("GOOD day", 1), ("大涨 好", 1), ("bad news", 0), ("bad loss", 0), ("ignored", None)]
    return fit_sentiment(spark.createDataFrame(labelled, "text string, label int")).cache()


def _expected(model, text, max_chars=300):
    import regex

    llr = {r["token"]: r["llr"] for r in model.collect()}
    if text is None or len(text.strip()) < 5:
        return 0.5
    words = regex.findall(r"\p{Han}|[^\P{L}\p{Han}]+", text[:max_chars].lower())
    total = sum(llr[w] for w in words if w in llr)
    return 1 / (1 + math.exp(-total)) if any(w in llr for w in words) else 0.5


def test_model_counts(spark, model):
    llr = {r["token"]: r["llr"] for r in model.collect()}
    # 8 positive tokens (2 of them "good"), 4 negative, 9 distinct
    assert set(llr) == {"good", "news", "up", "day", "大", "涨", "好", "bad", "loss"}
    assert math.isclose(llr["good"], math.log(3 / 17) - math.log(1 / 13))
    assert math.isclose(llr["bad"], math.log(1 / 17) - math.log(3 / 13))


@pytest.mark.parametrize("broadcast_rows", [1000, 2])
@pytest.mark.parametrize("max_chars", [300, None])
def test_scores(spark, model, broadcast_rows, max_chars):
    df = spark.createDataFrame(TITLES, "id int, title string")
    out = sentiment_score(df, model, max_chars=max_chars, broadcast_rows=broadcast_rows)
    got = {r["id"]: r["sentiment_score"] for r in out.collect()}
    assert len(got) == len(TITLES)
    for key, text in TITLES:
        assert math.isclose(got[key], _expected(model, text, max_chars), rel_tol=1e-9), key
    assert got[3] == got[4] == got[5] == got[6] == got[7] == got[8] == 0.5
    assert got[9] > 0.5
    assert (got[10] == 0.5) == (max_chars == 300)


def test_keys_play_no_part(spark, model):
    """Copies, texts under one key and NULL keys: scores by text, on both sides of the switch."""
    df = spark.createDataFrame([("k", "bad bad news")] * 50 + [("z", "good news")], "id string, title string")
    for rows in (1000, 2):
        out = sentiment_score(df, model, broadcast_rows=rows).collect()
        assert len(out) == 51
        assert len({r["sentiment_score"] for r in out if r["id"] == "k"}) == 1
        assert math.isclose(out[0]["sentiment_score"], _expected(model, out[0]["title"]))
    odd = spark.createDataFrame([(None, "good news"), ("k", "bad loss"), ("k", "good day"), (None, None)], "id string, title string")
    both = [sorted((r["title"] or "", r["sentiment_score"]) for r in sentiment_score(odd, model, broadcast_rows=n).collect()) for n in (1000, 2)]
    assert [t for t, _ in both[0]] == [t for t, _ in both[1]] and all(math.isclose(a, b) for (_, a), (_, b) in zip(*both))
    assert all(math.isclose(s, _expected(model, t or None)) for t, s in both[0])


def test_tokens(spark):
    row = spark.createDataFrame([("Über-Preis 3x 中国A股",)], "t string").select(tokens("t").alias("t")).first()
    assert row["t"] == ["über", "preis", "x", "中", "国", "a", "股"]


def test_scorer_hook(spark):
    def fragile(text):
        if "boom" in text:
            raise RuntimeError("no score")
        return len(text) / 1000

    df = spark.createDataFrame([("a" * 400,), ("boom boom",), ("abc",), (None,), ("  ab   ",)], "t string")
    got = [r[0] for r in df.select(make_scorer(fragile, max_chars=300)("t")).collect()]
    assert got == [0.3, 0.5, 0.5, 0.5, 0.5]
    assert df.select(make_scorer(fragile)("t")).first()[0] == 0.4


def test_batch_scorer(spark):
    df = spark.createDataFrame([("good day",), ("abc",), (None,), ("boom today",)], "t string")
    share = make_scorer(lambda texts: texts.str.count("o") / 10, batches=True)
    assert [r[0] for r in df.select(share("t")).collect()] == [0.2, 0.5, 0.5, 0.3]
    broken = make_scorer(lambda texts: 1 / 0, batches=True)
    assert {r[0] for r in df.select(broken("t")).collect()} == {0.5}


def test_time_patterns(spark):
    texts = ["2024-01-05 10:00:00", "2024-01-05T10:00:00", "2024-01-05T10:00:00.123456", "junk", "", None, "2024-13-01 00:00:00"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] is not None for r in df.select(parse_time("t")).collect()] == [True] + [False] * 6
    from barstream.functions.columns import ISO_TIME_FRACTION, MESSAGE_TIME

    got = [r[0] for r in df.select(parse_time("t", MESSAGE_TIME, ISO_TIME_FRACTION)).collect()]
    assert [g is not None for g in got] == [True, True, True] + [False] * 4
    assert got[2].microsecond == 123456


def test_blank(spark):
    texts = [None, "", " ", "　 \n\t", " a ", " b"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(is_blank("t"), strip_blank("t")).collect()
    assert [r[0] for r in rows] == [True, True, True, True, False, False]
    assert [r[1] for r in rows][4:] == ["a", "b"]


def test_fixed_text_rounds_by_exact_value(spark):
    from decimal import ROUND_HALF_UP, Decimal

    values = [0.15, 0.25, 0.35, 0.45, 0.44999999999999996, 1.005, 2.5, 99.95, 99.96, 0.0, 1.0, 12.345, -0.25, 123456.05, 0.05]
    values += [i / 1000 for i in range(0, 1000, 7)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (1, 2):
        got = [r[0] for r in df.select(fixed_text("v", digits)).collect()]
        step = Decimal(1).scaleb(-digits)
        assert got == [str(Decimal(v).quantize(step, ROUND_HALF_UP)) for v in values]


def test_a_bad_text_spoils_no_other(spark):
    """A batch scorer that raises is asked again text by text; failures are counted."""
    from barstream.functions.scorers import make_scorer

    def share(texts):
        if texts.str.contains("boom").any():
            raise ValueError("boom")
        return texts.str.count("e") / texts.str.len()

    errors = spark.sparkContext.accumulator(0)
    df = spark.createDataFrame([("eeeee",), ("boom boom",), ("eeaaaaaaaa",), (None,), ("e",)], "text string").coalesce(1)
    score = make_scorer(share, batches=True, errors=errors)
    got = [r[0] for r in df.select(score("text")).collect()]
    assert got == [1.0, 0.5, 0.2, 0.5, 0.5] and errors.value == 1


@pytest.mark.parametrize("sum_rows", [2_000_000, 1])
def test_a_large_model_leaves_texts_where_they_lie(spark, monkeypatch, sum_rows):
    """Beyond what is broadcast only digests and rare tokens are shuffled; scores are those of a small model."""
    from barstream.operators import text as module

    monkeypatch.setattr(module, "SUM_ROWS", sum_rows)
    words = ["good", "bad", "day", "news", *("w" + chr(97 + i) + chr(97 + j) for i in range(20) for j in range(20))]
    texts = [(i, " ".join(words[(i * j) % len(words)] for j in range(1, 9))) for i in range(500)]
    df = spark.createDataFrame([*texts, (600, texts[3][1]), (601, None), (602, "unknownword only"), (603, "ab")], "id int, title string")
    model = fit_sentiment(df.select(F.col("title").alias("text"), (F.col("id") % 2).alias("label"))).cache()
    small = {r["id"]: r["sentiment_score"] for r in sentiment_score(df, model).collect()}
    for table in (model, model.drop("n")):
        out = sentiment_score(df, table, broadcast_rows=100)
        got = {r["id"]: r["sentiment_score"] for r in out.collect()}
        assert got.keys() == small.keys() and all(math.isclose(got[i], small[i], rel_tol=1e-12) for i in small)
        assert sum_rows == 1 or "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert 0 < module._frequent(model, 100).where("_head").count() <= 100
    heads = module._frequent(model, 100).groupBy("_head").agg(F.min("n").alias("lo"), F.max("n").alias("hi")).collect()
    by = {r["_head"]: r for r in heads}
    assert by[True]["lo"] > by[False]["hi"]

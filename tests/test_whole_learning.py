"""Learner queries over whole tables, with all result rows."""

from barstream.operators import features as FE
from checks import fixtures as X
from checks import learning

SF = "/root/testdata/sf0.001"


def test_classifier_lr_whole(spark):
    got = learning.Q["classifier_lr_whole"](spark, SF).toPandas()
    _, test = FE.split(X.tab_class(spark, SF, learning.CUT), X.LINE_KEYS)
    want = test.select(*X.LINE_KEYS, "label").toPandas()
    assert sorted(map(tuple, got[[*X.LINE_KEYS, "label"]].values)) == sorted(map(tuple, want.values))
    assert (got.label == got.prediction).mean() > 0.95


def test_whole_results(spark):
    grid = learning.Q["tune_grid"](spark, SF).collect()
    assert {r["params"] for r in grid} == {"maxDepth=1", "maxDepth=4"}
    study = learning.Q["model_study_whole"](spark, SF).collect()
    assert {r["model"] for r in study} == {"lr", "knn", "dt", "rf"} and all(r["accuracy"] > 0.8 for r in study)


def test_gbt_latest(spark):
    got = learning.Q["gbt_latest"](spark, SF).toPandas()
    assert len(got) == X.ticks(spark, SF).select("symbol").distinct().count() and {"predicted_direction", "confidence"} <= set(got.columns)
    assert set(got.predicted_direction) <= {"UP", "DOWN"} and got.confidence.between(0, 1).all()

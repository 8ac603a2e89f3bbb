"""Metrics, tabular preparation, neighbours and learners."""

import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barstream.operators import metrics as M
from barstream.operators import tabular as T
from barstream.operators.neighbors import knn
from barstream.plans import learners as L
from barstream.plans.study import study


def _frame(spark, rows):
    return spark.createDataFrame(rows, "label int, prediction int, score double")


def test_report_with_a_class_never_predicted(spark):
    df = _frame(spark, [(1, 0, 0.1), (0, 0, 0.2), (0, 0, 0.3)])
    rows = {r["name"]: r for r in M.classification_report(df).collect()}
    assert (rows["1"]["precision"], rows["1"]["recall"], rows["1"]["f1"], rows["1"]["support"]) == (0, 0, 0, 1)
    assert math.isclose(rows["0"]["precision"], 2 / 3) and rows["0"]["recall"] == 1
    assert math.isclose(rows["accuracy"]["f1"], 2 / 3) and rows["macro avg"]["support"] == 3
    matrix = {r["label"]: (r["pred_0"], r["pred_1"]) for r in M.confusion_matrix(df).collect()}
    assert matrix == {0: (2, 0), 1: (1, 0)}


def test_auc_edges(spark):
    value = lambda rows: M.auc(_frame(spark, rows)).first()["auc"]
    assert value([(1, 1, 0.9), (0, 0, 0.1)]) == 1.0
    assert value([(1, 1, 0.5), (0, 0, 0.5)]) == 0.5
    assert value([(1, 1, 0.5), (1, 0, 0.7)]) is None
    one = M.binary_metrics(_frame(spark, [(1, 1, 0.9), (1, 0, 0.2), (0, 0, 0.1)])).first()
    assert one["recall"] == 0.5 and one["miss_rate"] == 0.5 and one["auc"] == 1.0


def test_metric_invariants(spark):
    rng = random.Random(7)
    rows = [(rng.randint(0, 1), rng.randint(0, 1), round(rng.random(), 1)) for _ in range(300)]
    df = _frame(spark, rows)
    matrix = M.confusion_matrix(df).collect()
    assert sum(r["pred_0"] + r["pred_1"] for r in matrix) == 300
    one = M.binary_metrics(df).first()
    assert math.isclose(one["recall"] + one["miss_rate"], 1.0) and 0 <= one["auc"] <= 1
    sweep = {r["threshold"]: r for r in M.threshold_sweep(df, [0.0, 0.5, 1.1]).collect()}
    assert sweep[0.0]["recall"] == 1.0 and sweep[1.1]["recall"] == 0.0 and sweep[1.1]["precision"] == 0.0
    ranked = M.compare_models(df.withColumn("model", F.lit("a")).unionByName(df.withColumn("prediction", F.lit(1)).withColumn("model", F.lit("b"))))
    assert [r["model"] for r in ranked.collect()] == ["b", "a"]


def test_tabular(spark):
    df = spark.createDataFrame([(1.0, 5.0, 0), (2.0, 5.0, 0), (3.0, 5.0, 1), (None, 5.0, 0)], "a double, b double, label int")
    rows = T.standardize(df, ["a", "b"]).collect()
    assert math.isclose(rows[0]["a"], -math.sqrt(1.5)) and rows[3]["a"] is None and rows[0]["b"] == 0.0
    cells = {(r["x"], r["y"]): r["correlation"] for r in T.correlations(df, ["a", "b", "label"]).collect()}
    assert math.isclose(cells[("a", "a")], 1.0) and cells[("a", "label")] == cells[("label", "a")]
    assert math.isclose(cells[("a", "label")], math.sqrt(3) / 2) and cells[("a", "b")] is None
    picked = T.select_features(df, ["a", "b"], "label", threshold=0.5).collect()
    assert [r["feature"] for r in picked] == ["a"]
    weights = {r["label"]: r["weight"] for r in T.class_weights(df).collect()}
    assert weights == {0: 4 / 6, 1: 2.0}
    own = T.with_class_weights(df).collect()
    assert {(r["label"], r["weight"]) for r in own} == {(0, 4 / 6), (1, 2.0)}


def test_downsample_keeps_the_rare_class(spark):
    df = spark.range(5000).withColumn("label", (F.col("id") % 10 == 0).cast("int"))
    out = {r["label"]: r["count"] for r in T.downsample(df, ["id"]).groupBy("label").count().collect()}
    assert out[1] == 500 and 350 < out[0] < 650


@pytest.mark.parametrize("block", [20_000, 40])
def test_knn_equals_brute_force(spark, block):
    """With a third of the training rows at one point, and with tiny blocks."""
    rng = np.random.default_rng(4)
    points = np.vstack([np.zeros((100, 3)), rng.normal(0, 1, (200, 3)), rng.normal(6, 0.1, (40, 3))])
    labels = rng.integers(0, 3, len(points))
    asked = np.vstack([rng.normal(0, 2, (60, 3)), np.zeros((5, 3))])
    schema = "id bigint, features array<double>, label int"
    train = spark.createDataFrame([(i, p.tolist(), int(y)) for i, (p, y) in enumerate(zip(points, labels))], schema)
    test = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(asked)], "id bigint, features array<double>")
    got = {r["id"]: (r["prediction"], r["votes"]) for r in knn(train, test, k=7, block=block).collect()}
    for i, q in enumerate(asked):
        near = np.lexsort((np.arange(len(points)), ((points - q) ** 2).sum(axis=1)))[:7]
        votes = np.bincount(labels[near], minlength=3)
        assert got[i] == (votes.argmax(), votes.max()), i
    few = knn(train.limit(3), test, k=7, block=block)
    assert few.agg(F.max("votes")).first()[0] <= 3 and few.count() == len(asked)


def test_knn_odd_vectors_and_own_votes(spark):
    schema = "id bigint, features array<double>, label int"
    train = spark.createDataFrame([(i, [float(i), 0.0], i % 2) for i in range(8)], schema)
    test = spark.createDataFrame([(3, [3.0, 0.0]), (10, None), (11, [1.0]), (12, [1.0, None]), (13, [1.0, 2.0, 3.0])], "id bigint, features array<double>")
    got = {r["id"]: (r["prediction"], r["votes"]) for r in knn(train, test, k=2, others_only=True).collect()}
    assert got == {3: (0, 2), 10: (None, 0), 11: (None, 0), 12: (None, 0), 13: (None, 0)}
    with pytest.raises(ValueError):
        knn(train.union(spark.createDataFrame([(9, [1.0], 1)], schema)), test)


def test_knn_fetches_few_pairs_in_many_dimensions(spark):
    """Among 64 random numbers no cell falls away, but the approximations leave few exact distances, and the right ones."""
    import numpy as np
    from barstream.operators import neighbors

    n, k = 1200, 5
    x = np.random.default_rng(4).normal(0, 1, (n, 64)).round(3)
    x[100] = x[7]  # equal vectors
    frame = spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(x)], "id int, features array<double>, label int")
    points = frame.select(F.col("id").alias("_point"), F.col("features").alias("_vec"))
    pairs = neighbors.candidates(points, points.withColumnRenamed("_point", "_query"), 64, k, 400, False)
    found = {(r["_query"], r["_point"]) for r in pairs.collect()}
    assert len(found) < 0.02 * n * n
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    nearest = np.lexsort((np.broadcast_to(np.arange(n), d.shape), d), axis=1)[:, :k]
    assert all((q, int(p)) in found for q in range(n) for p in nearest[q])


@pytest.mark.parametrize("scale, shift", [(1e-9, 0.0), (1e6, 0.0), (1e-3, 1e6)])
def test_knn_bounds_hold_at_any_scale(scale, shift):
    import numpy as np
    import pyarrow as pa
    from barstream.operators import neighbors

    rng = np.random.default_rng(1)
    y, x = rng.normal(0, scale, (300, 8)) + shift, rng.normal(0, scale, (50, 8)) + shift
    grid = neighbors.Grid(y[:40])
    codes, off = grid.code(y)
    column = lambda m, t: pa.array(m.tolist(), pa.list_(t))
    queries = pa.table([pa.array(range(50)), column(x, pa.float64())], names=["_query", "_vec"])
    points = pa.table([pa.array(range(300)), column(codes.view(np.int8), pa.int8()), pa.array(off)], names=["_point", "_codes", "_off"])
    for r in neighbors._compare(grid, 300, 8, False)(queries, points).to_pylist():
        exact = float(np.sqrt(((x[r["_query"]] - y[r["_point"]]) ** 2).sum()))
        assert r["_low"] <= exact <= r["_high"]


def test_knn_compares_few_pairs_of_clustered_data(spark, monkeypatch):
    """Ten times the rows make far fewer than a hundred times the compared pairs."""
    from barstream.operators import neighbors

    asked = {}

    def counted(left, placed, sizes, *rest, real=neighbors._in_blocks):
        for r in left.groupBy("_cell").count().collect():
            asked[n] = asked.get(n, 0) + r["count"] * sizes[r["_cell"]]
        return real(left, placed, sizes, *rest)

    monkeypatch.setattr(neighbors, "_in_blocks", counted)
    rng = np.random.default_rng(2)
    for n in (400, 4000):
        points = rng.integers(0, 20, (n, 1)) * 100.0 + rng.normal(0, 1, (n, 2))
        frame = spark.createDataFrame([(i, p.tolist(), i % 2) for i, p in enumerate(points)], "id bigint, features array<double>, label int")
        assert knn(frame, frame, k=3).count() == n
    assert asked[4000] < 60 * asked[400] and asked[4000] < 4000**2 / 15


@pytest.fixture(scope="module")
def separable(spark):
    df = spark.range(3000).select(
        "id", ((F.col("id") * 37) % 101).cast("double").alias("a"), ((F.col("id") * 53) % 97).cast("double").alias("b")
    )
    return df.withColumn("label", (F.col("a") + F.col("b") > 110).cast("int")).cache()


@pytest.mark.parametrize("kind,params", [("lr", {}), ("dt", {}), ("rf", {"numTrees": 10}), ("gbt", {"maxIter": 5})])
def test_learners_beat_the_majority(separable, kind, params):
    model = L.fit_classifier(kind, separable, ["a", "b"], **params)
    scored = L.score(model, separable)
    assert scored.where("score < 0 OR score > 1").isEmpty()
    base = max(r["count"] for r in separable.groupBy("label").count().collect()) / 3000
    assert L.evaluate(scored)["metrics"].first()["accuracy"] > base + 0.1


def test_study_compares_all_four(separable):
    rows = study(separable.where("id < 600"), ["a", "b"], ["id"], params={"rf": {"numTrees": 5}}).collect()
    assert {r["model"] for r in rows} == {"lr", "knn", "dt", "rf"}
    assert [r["recall"] for r in rows] == sorted((r["recall"] for r in rows), reverse=True)
    assert all(r["accuracy"] > 0.8 and r["auc"] > 0.8 for r in rows)


def test_weights_raise_recall(separable):
    rare = separable.where("label = 0 OR a > 95").withColumn("a", F.col("a") + 20 * F.rand(1))
    plain = M.binary_metrics(L.score(L.fit_classifier("lr", rare, ["b"]), rare)).first()["recall"]
    weighted = T.with_class_weights(rare)
    heavy = M.binary_metrics(L.score(L.fit_classifier("lr", weighted, ["b"], weight="weight"), rare)).first()["recall"]
    assert heavy > plain


def test_cross_validation_and_tuning(separable):
    row = L.cross_validate(separable, "lr", ["a", "b"], ["id"], k=3, metric="auc").first()
    assert row["metric"] == "auc" and row["mean"] > 0.95
    best, table = L.tune(separable, "dt", ["a", "b"], ["id"], {"maxDepth": [1, 5]}, k=2, metric="accuracy")
    rows = table.collect()
    assert rows[0]["params"] == "maxDepth=5" and rows[0]["mean"] > rows[1]["mean"]
    assert best.stages[1].getMaxDepth() == 5


def test_model_store_and_empty_input(spark, separable, tmp_path):
    model = L.fit_classifier("dt", separable, ["a", "b"])
    L.save_model(model, str(tmp_path / "m"))
    again = L.load_model(str(tmp_path / "m"))
    assert L.score(again, separable).collect() == L.score(model, separable).collect()
    assert L.load_model(str(tmp_path / "none")) is None
    with pytest.raises(ValueError, match="no training rows"):
        L.fit_gbt(separable.where("a < 0"), ["a", "b"])


def test_direction_keeps_p_up_as_confidence(spark):
    df = spark.createDataFrame([("a", 0.7), ("b", 0.5), ("c", 0.2)], "symbol string, score double")
    rows = {r["stock_code"]: r for r in L.direction_columns(df).collect()}
    assert [rows[k]["predicted_direction"] for k in "abc"] == ["UP", "DOWN", "DOWN"]
    assert rows["c"]["confidence"] == 0.2 and rows["c"]["direction_confidence"] == 0.8
    assert rows["a"]["predict_time"] is not None


@pytest.mark.parametrize("columns", [3, 10, 11, 14])
def test_correlations_know_no_width(spark, columns):
    """Constant, tiny and ordinary columns have the same cells in any company."""
    rng = np.random.default_rng(1)
    names = [f"c{i}" for i in range(columns)]
    values = rng.normal(0, 1, (400, columns))
    values[:, 0], values[:, 1] = 7.1, values[:, 2] * 1e-9 + rng.normal(0, 1e-9, 400)
    df = spark.createDataFrame(values.tolist(), ", ".join(f"{n} double" for n in names))
    cells = {(r["x"], r["y"]): r["correlation"] for r in T.correlations(df, names).collect()}
    want = np.corrcoef(values[:, 1:].T)
    assert all(cells["c0", n] is None for n in names)
    assert all(math.isclose(cells[f"c{i}", f"c{j}"], want[i - 1, j - 1], abs_tol=1e-9) for i in range(1, columns) for j in range(1, columns))
    nearest = T.select_features(df, names[:1] + names[2:], "c1").collect()
    assert nearest[0]["feature"] == "c2" and nearest[-1]["correlation"] is None


def test_features_of_constant_and_extreme_columns(spark):
    """Constant columns, a constant label and no rows have NULL; very small and very large spreads their correlation."""
    rows = [(7.1, x * 1e-90, x * 1e90, -x, x, 1) for x in (1.0, 2.0, 4.0)]
    df = spark.createDataFrame(rows, "c double, small double, large double, minus double, label double, one int")
    names = ["c", "small", "large", "minus"]
    got = {r["feature"]: r["correlation"] for r in T.select_features(df, names, "label").collect()}
    assert got["c"] is None and math.isclose(got["minus"], -1.0)
    assert math.isclose(got["small"], 1.0) and math.isclose(got["large"], 1.0)
    got = {r["feature"]: r["correlation"] for r in T.select_features(df, ["large", "minus"], "small").collect()}
    assert math.isclose(got["large"], 1.0) and math.isclose(got["minus"], -1.0)
    cells = {(r["x"], r["y"]): r["correlation"] for r in T.correlations(df, names).collect()}
    assert math.isclose(cells["small", "small"], 1.0) and math.isclose(cells["large", "large"], 1.0)
    for frame, label in ((df, "one"), (df.limit(0), "label")):
        assert [r["correlation"] for r in T.select_features(frame, names, label).collect()] == [None] * 4


@pytest.mark.parametrize("test", [0.004, 0.025, 0.2])
def test_split_takes_small_shares(spark, test):
    from barstream.operators.features import mark_split

    n = mark_split(spark.range(200_000), ["id"], test).where("is_test").count()
    assert abs(n - 200_000 * test) < 5 * math.sqrt(200_000 * test)


def test_downsample_of_very_rare_rows(spark):
    df = spark.range(1_000_000).withColumn("label", (F.col("id") < 20).cast("int"))
    out = {r["label"]: r["count"] for r in T.downsample(df, ["id"]).groupBy("label").count().collect()}
    assert out[1] == 20 and 5 <= out[0] <= 45


def test_classes_come_from_the_data(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (2, 2), (2, 1)], "label int, prediction int")
    matrix = {r["label"]: r for r in M.confusion_matrix(df).collect()}
    assert sorted(matrix) == [0, 1, 2] and (matrix[1]["pred_0"], matrix[2]["pred_1"], matrix[2]["pred_2"]) == (0, 1, 1)
    report = {r["name"]: r for r in M.classification_report(df).collect()}
    assert report["1"]["support"] == 0 and report["accuracy"]["precision"] == 0.5 and report["weighted avg"]["recall"] == 0.5
    given = {r["label"]: r for r in M.confusion_matrix(df, classes=(0, 1)).collect()}
    assert (given[2]["pred_1"], given[2]["pred_other"], given[1]["pred_0"]) == (1, 1, 0)


def test_every_symbol_is_predicted(spark):
    from barstream.operators.features import FEATURES
    from barstream.plans import learners as L

    rows = [(s, t, *[float(t + len(s))] * 5, int(t >= 10)) for s in ("a", "bb") for t in range(20)]
    rows += [("bb", 99, None, *[1.0] * 4, 0), ("ccc", 1, *[None] * 5, 0)]
    df = spark.createDataFrame(rows, "symbol string, trade_time int, " + ", ".join(f"{c} double" for c in FEATURES) + ", label int")
    got = {r["stock_code"]: r for r in L.predict_latest(df, L.fit_classifier("dt", df, FEATURES), "now").collect()}
    assert sorted(got) == ["a", "bb", "ccc"] and got["ccc"]["predicted_direction"] is None
    assert got["bb"]["predicted_direction"] == got["a"]["predicted_direction"] == "UP"


@pytest.mark.parametrize("dense", [-1, 1e9])
@pytest.mark.parametrize("others_only", [False, True])
def test_knn_either_way(spark, monkeypatch, dense, others_only):
    """Ties, copies and text keys, by broadcast parts and by cells; no more than k neighbours of a query are stored."""
    from barstream.operators import neighbors

    monkeypatch.setattr(neighbors, "DENSE", dense)
    monkeypatch.setattr(neighbors, "PART_BYTES", 3_000)  # several parts
    monkeypatch.setattr(neighbors, "TASK_QUERIES", 100)
    monkeypatch.setattr(neighbors, "TILE_POINTS", 16)
    removed = []
    monkeypatch.setattr(neighbors, "remove_table", lambda spark, path, real=neighbors.remove_table: removed.append(path) or real(spark, path))
    rng, n, k = np.random.default_rng(6), 500, 5
    x = rng.integers(0, 4, (n, 4)).astype(float) * 1e3 + 1e5  # 256 places: many equal vectors and equal distances
    x[:60] = x[0]
    labels, ids = rng.integers(0, 3, n), [f"{i * 7919 % n:x}" for i in range(n)]
    frame = spark.createDataFrame([(i, v.tolist(), int(y)) for i, v, y in zip(ids, x, labels)], "id string, features array<double>, label int")
    got = {r["id"]: (r["prediction"], r["votes"], r["neighbours"]) for r in knn(frame, frame, k, block=100, others_only=others_only).collect()}
    rank = np.argsort(np.argsort(np.array(ids)))
    for i in range(n):
        d = ((x - x[i]) ** 2).sum(axis=1)
        d[i] = np.inf if others_only else d[i]
        votes = np.bincount(labels[np.lexsort((rank, d))[:k]], minlength=3)
        assert got[ids[i]] == (votes.argmax(), votes.max(), k), i
    points = frame.select(F.col("id").alias("_point"), F.col("features").alias("_vec"))
    found = neighbors.candidates(points, points.withColumnRenamed("_point", "_query"), 4, k, 100, others_only)
    assert found.count() == n * k
    assert (len(removed) > 2) == (dense < 0) and not any(os.path.exists(path) for path in removed)


def test_knn_copies_are_compared_once(spark, monkeypatch):
    """Of equal training rows only the first k can be neighbours, and equal queries ask once."""
    from barstream.operators import neighbors

    seen = []
    real = neighbors.candidates
    monkeypatch.setattr(neighbors, "candidates", lambda points, queries, *rest: seen.append((points.count(), queries.count())) or real(points, queries, *rest))
    frame = spark.range(6_000).select("id", F.array((F.col("id") % 10).cast("double"), F.lit(0.0)).alias("features"), (F.col("id") % 10 > 4).cast("int").alias("label"))
    rows = knn(frame, frame, 5).collect()
    assert seen == [(50, 10)] and len(rows) == 6_000
    assert all(r["prediction"] == (r["id"] % 10 > 4) and r["votes"] == 5 for r in rows)


def test_knn_places_many_dimensions_without_copies_of_queries(spark, monkeypatch):
    """Where no cell falls away queries are not shuffled to cells."""
    from barstream.operators import neighbors

    def refused(*_):
        raise AssertionError("queries were copied to cells")

    monkeypatch.setattr(neighbors, "_in_blocks", refused)
    x = np.random.default_rng(8).normal(0, 1, (900, 32)).round(3)
    frame = spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(x)], "id int, features array<float>, label int")
    assert knn(frame, frame, 3).count() == 900

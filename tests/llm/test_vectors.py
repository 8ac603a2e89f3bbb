"""Product codes and clusters against plain versions, odd rows and the bounds that the searches rest on."""

import random

import numpy as np
import plain
import plain_vectors
import pytest

from barstream.llm import product_codes, queries, vector_file, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, error string, `a.b` int, _x int, ident long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, 2, 3) for r in rows], SCHEMA)


def out(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def random_rows(n, dims, seed=0, levels=None, far=1.0, centres=0):
    rng = random.Random(seed)
    middles = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(centres)]
    rows = []
    for i in range(n):
        v = [far * rng.choice(levels) if levels else rng.gauss(0, 0.125) * far for _ in range(dims)]
        if centres:
            v = [a / 20 + b for a, b in zip(v, middles[i % centres])]
        rows.append((i, [float(np.float32(x)) for x in v], rng.choice([None, 0, 1, 2])))
    return rows


def odd_rows(dims):
    rows = random_rows(40, dims, seed=5)
    nan, inf = float("nan"), float("inf")
    broken = [None, [], [None] * dims, [nan] + [0.0] * (dims - 1), [inf] * dims, [-inf] * dims, [0.0] * (dims - 1), [0.0] * (2 * dims), [40_000.0] * dims]
    rows += [(100 + i, v, 1) for i, v in enumerate(broken)]
    rows += [(3, rows[3][1], rows[3][2])] * 2 + [(4, rows[7][1], None), (None, rows[8][1], 2), (None, [0.5] * dims, None)]
    return rows


@pytest.mark.parametrize("levels, far", [(None, 1.0), ([0.0, 1 / 1024, 2 / 1024], 1.0), (None, 60_000.0)])
def test_sorted_book_is_exact(levels, far):
    """Ties everywhere; and components so large that doubles would round."""
    rows = [v for _, v, _ in random_rows(400, 16, seed=2, levels=levels, far=far)]
    x = np.array([plain_vectors.integer(v) for v in rows], np.int64)
    entries, parts = x[:100], x[100:]
    index, distance = product_codes.SortedBook(entries).nearest(parts)
    for part, i, d in zip(parts.tolist(), index.tolist(), distance.tolist()):
        assert (i, d) == plain_vectors.nearest(entries.tolist(), part)


def test_sorted_book_expands_only_as_far_as_needed(monkeypatch):
    looked = []
    whole = product_codes.squared
    monkeypatch.setattr(product_codes, "squared", lambda x, y: looked.append(len(x) * len(y)) or whole(x, y))
    rng = np.random.default_rng(0)
    entries = rng.integers(-50, 50, (256, 4)) + np.arange(256)[:, None] * 100
    product_codes.SortedBook(entries).nearest(np.repeat(entries, 20, axis=0) + rng.integers(-20, 20, (5120, 4)))
    assert sum(looked) < 0.3 * 256 * 5120


@pytest.mark.parametrize("rows", [random_rows(300, 8, levels=[0.0, 0.001, 0.002, 0.5]), random_rows(60, 8, far=100.0), odd_rows(8)], ids=["ties", "far", "odd"])
def test_product_codes(spark, rows):
    df = frame(spark, rows)
    for entries in (16, 256):
        assert out(product_codes.product_codes(df, entries=entries)) == plain_vectors.product_codes(rows, 8, entries=entries)


def test_product_codes_of_nothing(spark):
    empty = product_codes.product_codes(frame(spark, []))
    assert out(empty) == [] and empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert out(product_codes.product_codes(frame(spark, [(1, None, 1), (2, [0.0], 1)]))) == []


def test_group_sums_joined_by_shuffle(spark, monkeypatch):
    """More labels than are broadcast, nulls among them."""
    rows = odd_rows(8)
    want = plain_vectors.product_codes(rows, 8)
    monkeypatch.setattr(vectors, "BROADCAST_GROUPS", 1)
    assert out(product_codes.product_codes(frame(spark, rows))) == want


@pytest.mark.parametrize("bits", [1, 4, 6])
def test_intervals_hold_every_distance(bits):
    rng = np.random.default_rng(bits)
    x = rng.integers(-600, 600, (500, 8))
    borders = [np.unique(np.quantile(x[:, j], np.arange(1, 1 << bits) / (1 << bits), method="higher").astype(int)) for j in range(8)]
    origin, c = x.mean(axis=0).astype(int), x[:5] + 3
    low = [np.r_[min(x[:, j].min(), b[0]), b] - origin[j] for j, b in enumerate(borders)]
    high = [np.r_[b - 1, max(x[:, j].max(), b[-1])] - origin[j] for j, b in enumerate(borders)]
    tables = vector_file.VectorFile(None, None, 8, origin, low, high).intervals(c)
    cells = np.stack([np.searchsorted(b, x[:, j], side="right") for j, b in enumerate(borders)], axis=1)
    ends = sum(t[cells[:, j]] for j, t in enumerate(tables)) + ((x - origin) ** 2).sum(axis=1)[:, None]
    exact = vectors.squared(x, c)
    assert (ends[:, :5] <= exact).all() and (exact <= ends[:, 5:]).all()
    near = vector_file.decided(cells, tables)
    assert ((near < 0) | (near == exact.argmin(axis=1))).all()


@pytest.mark.parametrize("rows", [odd_rows(8), random_rows(200, 8, levels=[0.0, 0.25]), random_rows(5, 8)], ids=["odd", "ties", "few"])
@pytest.mark.parametrize("bits", [1, 6])
def test_clusters(spark, rows, bits):
    got = out(vector_file.centroid_clusters(frame(spark, rows), dims=8, bits=bits))
    assert got == plain_vectors.clusters([r[:2] for r in rows], dims=8)


def test_clusters_of_nothing(spark):
    empty = vector_file.centroid_clusters(frame(spark, [(1, None, 1)]))
    assert out(empty) == [] and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_cells_decide_clustered_vectors(spark):
    """Where clusters lie apart, few vectors are fetched; the vectors are never shuffled."""
    rows = random_rows(2000, 16, seed=9, centres=8)
    file = vector_file.write_file(frame(spark, rows), "vec_id", "embedding", 16)
    before = vector_file.start(file)
    after = vector_file.cluster(file, before, 9)
    rest = vector_file.undecided(file, after, vector_file.cluster(file, before, 10))
    assert rest.count() < 0.3 * len(rows)  # two centroids may share a cluster
    plan = file.vectors.select("ident", "_x").join(rest.hint("shuffle_hash"), "ident")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan


@pytest.mark.parametrize("name", ["op11_product_codes", "op13_clusters"])
def test_registered(spark, name):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{plain.SF}/embeddings.parquet").collect()]
    want = plain_vectors.product_codes(rows, 64) if name.startswith("op11") else plain_vectors.clusters([r[:2] for r in rows])
    assert out(queries.Q[name](spark, plain.SF)) == want

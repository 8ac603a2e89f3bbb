"""Registered queries against plain versions, over whole tables."""

import hashlib

import plain
import pytest

from barstream.llm import queries


def by_id(spark, name, key="doc_id"):
    return {r[key]: r for r in queries.Q[name](spark, plain.SF).collect()}


def test_op2_base(spark, rows):
    got = by_id(spark, "op2_fertility")
    assert len(got) == len(rows)
    for doc_id, text in rows:
        r, want = got[doc_id], plain.base_measures(text)
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"])


def test_op2_keeps_clean_texts(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{plain.SF}/labels.parquet").collect()}
    got = by_id(spark, "op2_fertility")
    good = [got[i]["kept"] for i, q in labels.items() if q == 1 and not got[i]["base_failed"]]
    assert sum(good) >= 0.98 * len(good)


def test_op3_held_out(spark, documents):
    got = by_id(spark, "op3_language")
    lang = {r["doc_id"]: r["lang"] for r in documents.select("doc_id", "lang").collect()}
    assert len(got) == len(lang) and all(r["held_out"] == (plain.remainder(i) == 2) for i, r in got.items())
    held = [(r["lang_pred"], lang[i]) for i, r in got.items() if r["held_out"] and lang[i]]
    assert sum(a == b for a, b in held) >= 0.95 * len(held) and all(0 <= r["score"] <= 1 for r in got.values())


def test_op4_base(spark, rows):
    got = by_id(spark, "op4_secrets")
    for doc_id, text in rows:
        *want, listed = plain.base_secrets(text)
        assert [got[doc_id][c] for c in ("n_assign", "n_access", "n_hex", "base_sha256")] == want
        assert set(filter(None, listed.split(","))) <= set(got[doc_id]["spans"].split(","))


def test_op5_ids(spark, rows):
    want, got = plain.token_rows(rows), by_id(spark, "op5_token_codes")
    assert {i: (r["start"], r["n_tokens"], r["ids_crc32"]) for i, r in got.items()} == want


def test_op6_components(spark, rows):
    want, got = plain.components(rows, 3, 85), by_id(spark, "op6_minhash")
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(got[i]["n_shingles"] == len(plain.shingles(t, 3)) and got[i]["kept"] == (i == want[i]) for i, t in rows)


def test_op7_held_out(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    got = {r["doc_id"]: r for r in queries.Q["op7_rules"](spark, "/root/testdata/sf0.01").collect()}
    held = [(got[i]["predicted"], q) for i, q in labels.items() if got[i]["held_out"]]
    assert sum(a == b for a, b in held) >= 0.93 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got.values())


def test_op8_hits(spark, rows):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{plain.SF}/benchmark.parquet").collect()]
    got = by_id(spark, "op8_decontaminate")
    for doc_id, text in rows:
        n_words, n_hit, found = plain.contamination(text, items)
        r = got[doc_id]
        digest = hashlib.sha256(",".join(found).encode()).hexdigest()
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == (n_words, n_hit, len(found), digest, n_hit > 0)


def test_op10_rules(spark):
    got = by_id(spark, "op10_url_filter", "page_id")
    pages = spark.read.parquet(f"{plain.SF}/pages.parquet").select("page_id", "url").collect()
    assert len(got) == len(pages)
    for page_id, url in pages:
        host, path = plain.address(url)
        fits = [(len(h + p), h + p, v) for v, h, p in queries.urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits)[1:] if fits else (None, None)
        r = got[page_id]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and verdict in (None, r["verdict"])


def test_op1_templates(spark, rows):
    from barstream.llm import templates

    want = plain.templates(rows, 4, 3, 3, 0.5)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in templates.drop_recurring(frame, min_docs=3).collect()}
    for doc_id, text in rows:
        gone = want.get((doc_id, text), set())
        kept = "\n".join(x for n, x in enumerate(text.split("\n")) if n not in gone) if text else text
        assert (got[doc_id]["n_dropped"], got[doc_id]["text"]) == (len(gone), kept)


def test_op9_budget(spark, documents):
    got = queries.Q["op9_mixing"](spark, plain.SF).toPandas()
    assert len(got) == documents.count()
    total = got.n_tokens.sum()
    taken = (got.n_tokens * got.copies).groupby(got.source).sum()
    weight = got.groupby("source").weight.first()
    longest = got.groupby("source").n_tokens.max()
    assert abs(weight.sum() - 1) < 1e-9
    assert all(0 <= taken[s] - weight[s] * total < longest[s] + 1 for s in weight.index)


@pytest.mark.parametrize("name", sorted(queries.Q))
def test_whole_tables(spark, name):
    others = {"op10_url_filter": ("pages", "page_id"), "op11_product_codes": ("embeddings", "vec_id"), "op13_clusters": ("embeddings", "vec_id")}
    table, key = others.get(name, ("documents", "doc_id"))
    want = spark.read.parquet(f"{plain.SF}/{table}.parquet").select(key)
    got = queries.Q[name](spark, plain.SF).select(key)
    assert sorted(got.toPandas()[key]) == sorted(want.toPandas()[key])

"""Every stage against a plain version of what it decides, on its own input."""

import plain
import pytest

import corpus_pipeline
from barstream.llm import common
from barstream.llm.common import stored


@pytest.fixture(scope="module")
def inputs(spark, documents):
    """Each stage's input and output."""
    out, docs = {}, documents
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, plain.SF), name.replace(" ", "-"))
        out[name], docs = (docs, after), after
    return out


def test_stages_keep_columns(inputs, documents):
    for name in list(inputs)[:-1]:
        assert inputs[name][1].columns == documents.columns


def pairs(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]


def test_quality(spark, inputs):
    before, after = inputs["quality classifier"]
    kept = {i for i, _ in pairs(after)}
    labels = spark.read.parquet(f"{plain.SF}/labels.parquet").collect()
    known = {i for i, _ in pairs(before)}
    good = [r["doc_id"] in kept for r in labels if r["quality"] == 1 and r["doc_id"] in known]
    bad = [r["doc_id"] in kept for r in labels if r["quality"] == 0 and r["doc_id"] in known]
    assert sum(good) >= 0.9 * len(good) and sum(bad) < 0.5 * len(bad)


def test_near_duplicates(inputs):
    before, after = inputs["near-duplicates"]
    found = plain.components(pairs(before), 5, 80)
    assert sorted(i for i, _ in pairs(after)) == sorted(i for i, c in found.items() if i == c)


def test_decontamination(spark, inputs):
    before, after = inputs["benchmark decontamination"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{plain.SF}/benchmark.parquet").collect()]
    assert sorted(pairs(after)) == sorted(p for p in pairs(before) if not plain.contamination(p[1], items)[1])


def test_tokens(inputs):
    before, after = inputs["token ids"]
    got = sorted((r["start"], r["doc_id"], r["n_tokens"]) for r in after.collect())
    n = {i: plain.token_rows([(i, t)])[i][1] for i, t in set(pairs(before))}
    start = 0
    for (at, doc_id, size), want in zip(got, sorted(i for i, _ in pairs(before))):
        assert (at, doc_id, size) == (start, want, n[want])
        start += size


def test_odd_rows(spark, documents):
    odd = plain.odd(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, odd, plain.SF)
        assert after.columns == odd.columns and after.count() >= 0
        assert stage(spark, odd.limit(0), plain.SF).count() == 0


def test_quality_without_labels(spark, documents, tmp_path):
    """No labels: no rule is learned, and every document stays."""
    spark.read.parquet(f"{plain.SF}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.quality(spark, documents, str(tmp_path)).count() == documents.count()


def test_near_duplicates_of_equal_rows(spark):
    """Equal rows go but for one, also without a doc_id; a column's name may have a dot."""
    text = "one two three four five six seven eight nine ten"
    rows = [(1, text, 0), (1, text, 0), (None, text, 0), (None, text, 0), (2, text, 0), (3, None, 0), (3, None, 0), (4, "other words", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `a.b` int")
    after = corpus_pipeline.near_duplicates(spark, docs, plain.SF)
    assert after.columns == docs.columns
    assert sorted(pairs(after), key=repr) == sorted([(1, text), (None, text), (3, None), (4, "other words")], key=repr)


def test_session_settings_come_back(spark, documents):
    before = spark.conf.get(corpus_pipeline.BATCH_SETTING)
    corpus_pipeline.mixed(spark, documents, plain.SF)
    assert spark.conf.get(corpus_pipeline.BATCH_SETTING) == before


def test_stages_write_no_texts_and_the_pipeline_each_once(spark, documents, monkeypatch, tmp_path):
    """The caller writes a stage's rows: its own work tables hold no texts, the pipeline's one table of each stage does."""
    folders = iter(range(10_000))
    monkeypatch.setattr(common, "work_folder", lambda spark, name: f"{tmp_path}/{next(folders)}-{name}")
    docs = documents.limit(300)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, plain.SF).columns == docs.columns
    texts = [f.name for f in tmp_path.iterdir() if "text" in spark.read.parquet(str(f)).columns]
    assert texts == []

    written = []
    monkeypatch.setattr(corpus_pipeline, "stored", lambda df, name: written.append((name, spark.conf.get(corpus_pipeline.BATCH_SETTING))) or stored(df, name))
    before = spark.conf.get(corpus_pipeline.BATCH_SETTING)
    corpus_pipeline.run(spark, plain.SF)
    names = [stage.__name__ for _, stage in corpus_pipeline.STAGES]
    assert [w for w in written if w[0] in names] == [(n, str(corpus_pipeline.BATCH_ROWS)) for n in names]
    assert spark.conf.get(corpus_pipeline.BATCH_SETTING) == before


def test_a_kept_text_goes_to_python_once(spark):
    """Also beside columns whose names have dots or are those of statistics, which come back in their order."""
    docs = spark.createDataFrame([("x", "one two", 1, 0.5), (None, None, 2, 1.5)], "`a.b` string, text string, doc_id long, log_words double")
    out = common.text_rows(docs, ["doc_id", "text"], [common.long("n")], lambda: lambda t: (len(t or ""),))
    assert sorted(map(tuple, out.collect())) == [(1, "one two", 7), (2, None, 0)]
    after = corpus_pipeline.decontaminated(spark, docs, plain.SF)
    assert after.columns == docs.columns and sorted(map(tuple, after.collect()), key=repr) == sorted(map(tuple, docs.collect()), key=repr)
    for frame in (out, after):
        assert "__text" not in frame._jdf.queryExecution().analyzed().toString()

"""The corpus pipeline: from raw documents to token ids, one numbered operator a stage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barstream.llm import dac, decontaminate, minhash, mixing, rules
from barstream.llm.common import read, stored, work_folder
from barstream.llm.queries import vocabulary_path

#: A document goes if its score is below this.
QUALITY = 0.7
VOCABULARY, END_ID = "word_bpe_49k.json", 2


#: Rows of the batches that go to Python, in place of Spark's 10,000: whole texts are long.
BATCH_ROWS = 1_000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


#: Words and pieces whose ids a worker of the last stage keeps: fewer than by default, as it has run the other stages too.
REMEMBERED = (150_000, 80_000)


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """The pipeline's setting for batches; the session's own comes back after it."""
    before = spark.conf.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, before)


def _staged(stage):
    """A stage that prepares its rows under the pipeline's setting for batches.

    The rows themselves are written by the caller, and only there: a stage that
    stored them as well would hold every text on disk twice.
    """

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with _small_batches(spark):
            return stage(spark, docs, sf_dir)

    return run_stage


def _packed(docs: DataFrame) -> DataFrame:
    """Every column of a document but its text in one, beside its id and text, so that no name can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"), "doc_id", "text")


def _unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in columns])


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


@_staged
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from all labels.

    Where it has learned no rule (no labels, none of these documents, or of one
    class only) all documents stay.  Null and empty texts are judged by their
    statistics, all 0; repeated rows alike; an empty table stays empty.
    """
    model = rules.fit(docs, read(spark, sf_dir, "labels"))
    if not model.rules:
        return docs
    return _unpacked(rules.text_statistics(_packed(docs), ["row", "text"]).where(model.score() >= QUALITY), docs.columns)


@_staged
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five words, a similarity of 0.8.

    Rows that agree in every column go but for one.  Other rows that share a
    doc_id stay or go together; those without a doc_id stay, as do null and
    empty texts, which have no words in common with anything.
    """
    gone = stored(minhash.near_duplicates(docs, words=5, percent=80).where("NOT kept").select("doc_id").distinct(), "gone")
    columns = _columns(docs)
    rows = docs.join(gone, "doc_id", "left_anti").select(columns).withColumn("__row", F.xxhash64(*columns))
    again = stored(rows.groupBy("__row").count().where("count > 1").select("__row"), "again")
    once = rows.join(again, "__row", "left_anti").select(columns)
    return once.unionByName(rows.join(again, "__row", "left_semi").select(columns).distinct())


@_staged
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of a benchmark item, items without an id among them.

    Null and empty texts stay; rows are judged one by one.
    """
    found = decontaminate.find_items(_packed(docs), read(spark, sf_dir, "benchmark"), keep=["row", "text"])
    return _unpacked(found.where("n_hit = 0"), docs.columns)


@_staged
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents of large ones may go, of small ones recur.

    A null source is a source of its own; documents of no tokens, and sources
    of such documents alone, come once.
    """
    return mixing.realised(docs)


@_staged
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids written as directly addressable codes, and what the files hold of each document.

    Null and empty texts are their end id alone; repeated rows each have their own ids.
    """
    folder = work_folder(spark, "tokens")
    dac.write_tokens(docs, folder, vocabulary_path(VOCABULARY), END_ID, remembered=REMEMBERED)
    return dac.read_documents(spark, folder)


STAGES = [
    ("quality classifier", quality),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("mixing sources", mixed),
    ("token ids", tokens),
]

# The classifier is fitted and the sketches are hashed: no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written once, under the setting for batches, before the next one reads it."""
    docs = read(spark, sf_dir, "documents")
    with _small_batches(spark):
        for _, stage in STAGES:
            docs = stored(stage(spark, docs, sf_dir), stage.__name__)
    return docs


Q, O = {"pipeline": run}, {}  # noqa: E741

"""The serving table: a repeated task, a failed job and a repeated job add nothing."""

import os

import pytest
from pyspark.sql import functions as F

from barstream.sources import serving


def frame(spark, n=1000):
    return spark.range(0, n, 1, 4).select("id", F.lit("x").alias("name"), F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("at"))


def test_a_run_is_added_once(spark, tmp_path):
    path, df = str(tmp_path / "served"), frame(spark)
    assert serving.read_runs(spark, path, df.schema).count() == 0
    assert serving.add_run(df, path, "2024-01-01") and not serving.add_run(df, path, "2024-01-01")
    assert serving.add_run(df.where("id < 10"), path, "2024-01-02")
    got = serving.read_runs(spark, path, df.schema)
    assert {r["run_id"]: r["n"] for r in got.groupBy("run_id").agg(F.count("*").alias("n")).collect()} == {"2024-01-01": 1000, "2024-01-02": 10}
    assert got.where("run_id = '2024-01-01'").drop("run_id").exceptAll(df).count() == 0
    assert got.first()["at"].isoformat() == "2024-01-01T00:00:00"
    # a writer that missed the first job's end publishes nothing more
    df.write.format(serving.FORMAT).option("run_id", "2024-01-01").mode("append").save(path)
    assert serving.read_runs(spark, path, df.schema).count() == 1010


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    path, df = str(tmp_path / "served"), frame(spark)
    broken = df.withColumn("id", F.when(F.col("id") == 999, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("bigint"))
    with pytest.raises(Exception):
        serving.add_run(broken, path, "r1")
    assert not serving.has_run(path, "r1") and serving.read_runs(spark, path, df.schema).count() == 0
    assert serving.add_run(df, path, "r1") and serving.read_runs(spark, path, df.schema).count() == 1000


def test_files_of_repeated_tasks_and_half_moves_are_not_read(spark, tmp_path):
    path, df = str(tmp_path / "served"), frame(spark)
    writer = serving.ServingWriter(path, "r1", df.schema)
    batch = df.toArrow().to_batches()
    writer.write(iter(batch))  # a task whose end the driver never heard of
    kept = writer.write(iter(batch))
    half = tmp_path / "served" / "run_id=r1"
    half.mkdir(parents=True)
    (half / "moved.parquet").write_bytes(b"an earlier job ended here")
    writer.commit([kept, None, writer.write(iter([]))])
    assert serving.read_runs(spark, path, df.schema).count() == 1000
    assert os.listdir(half) == [kept.file] and not os.listdir(tmp_path / "served" / "_staging" / "r1")


@pytest.mark.parametrize("run_id", ["", "a/b", "_x", "a=b"])
def test_run_ids(spark, tmp_path, run_id):
    with pytest.raises(Exception, match="a run needs an id"):
        serving.add_run(frame(spark), str(tmp_path), run_id)

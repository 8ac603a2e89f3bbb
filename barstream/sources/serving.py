"""A serving table of files to which a job adds its rows once, however often it or its tasks are run.

A run is named by its id, such as the day it is for.  Every task writes a file
of its own below ``_staging`` of the table; files of tasks that were repeated
or lost are never read.  When all tasks have ended, the driver moves the files
they named into ``run_id=<id>`` and writes the run's manifest last: a run is
part of the table if it has one.  A job that fails before that leaves nothing
that a reader sees, and a run with a manifest is not written again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

FORMAT = "serving_files"
STAGING, MANIFESTS = "_staging", "_runs"


@dataclass
class Written(WriterCommitMessage):
    """What a task has staged; no file if it had no rows."""

    file: str | None
    rows: int


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that driver and executors share."""
    system, path = fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)
    return system, path.rstrip("/")


def _exists(system: fs.FileSystem, path: str) -> bool:
    return system.get_file_info(path).type != fs.FileType.NotFound


class ServingFiles(DataSource):
    """``df.write.format("serving_files").option("run_id", ...).mode("append").save(path)``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("runs are added; none is overwritten")
        run_id = self.options.get("run_id", "")
        if not run_id or any(c in run_id for c in "/=%") or run_id.startswith((".", "_")):
            raise ValueError(f"a run needs an id that can name a folder, not {run_id!r}")
        return ServingWriter(self.options["path"], run_id, schema)


class ServingWriter(DataSourceArrowWriter):
    def __init__(self, path: str, run_id: str, schema: T.StructType):
        self.path, self.run_id = path, run_id
        self.arrow = to_arrow_schema(schema)  # timestamps in UTC
        self.attempt = uuid.uuid4().hex  # of the job, so that two of one run do not share a folder

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """Stage a task's rows, batch by batch, in a file that no other attempt writes."""
        system, root = _open(self.path)
        folder = f"{root}/{STAGING}/{self.run_id}/{self.attempt}"
        name, writer, rows = f"{uuid.uuid4().hex}.parquet", None, 0
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if writer is None:
                    system.create_dir(folder, recursive=True)
                    writer = pq.ParquetWriter(f"{folder}/{name}", self.arrow, filesystem=system)
                writer.write_table(pa.Table.from_batches([batch]).cast(self.arrow))
                rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
        return Written(name if rows else None, rows)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = _open(self.path)
        manifest = f"{root}/{MANIFESTS}/{self.run_id}.json"
        if not _exists(system, manifest):
            target = f"{root}/run_id={self.run_id}"
            if _exists(system, target):  # an earlier job ended between its moves and its manifest
                system.delete_dir(target)
            system.create_dir(target, recursive=True)
            done = [m for m in messages if m is not None]
            files = [m.file for m in done if m.file]
            for file in files:
                system.move(f"{root}/{STAGING}/{self.run_id}/{self.attempt}/{file}", f"{target}/{file}")
            self._publish(system, manifest, {"run_id": self.run_id, "files": len(files), "rows": sum(m.rows for m in done)})
        self._clear(system, root)

    def _publish(self, system: fs.FileSystem, manifest: str, content: dict) -> None:
        """Write the manifest aside and rename it, so that it is there whole or not at all."""
        system.create_dir(manifest.rsplit("/", 1)[0], recursive=True)
        aside = f"{manifest}.{self.attempt}"
        with system.open_output_stream(aside) as out:
            out.write(json.dumps(content).encode())
        system.move(aside, manifest)

    def abort(self, messages: list[Written | None]) -> None:
        system, root = _open(self.path)
        self._clear(system, root)

    def _clear(self, system: fs.FileSystem, root: str) -> None:
        folder = f"{root}/{STAGING}/{self.run_id}/{self.attempt}"
        if _exists(system, folder):
            system.delete_dir(folder)


def has_run(path: str, run_id: str) -> bool:
    """Whether a run is part of the table."""
    system, root = _open(path)
    return _exists(system, f"{root}/{MANIFESTS}/{run_id}.json")


def add_run(df: DataFrame, path: str, run_id: str) -> bool:
    """Add a run's rows to the table; False, and no work, if it has them already.

    One job at a time may add one run; jobs of different runs may go side by side.
    """
    if has_run(path, run_id):
        return False
    df.sparkSession.dataSource.register(ServingFiles)
    df.write.format(FORMAT).option("run_id", run_id).mode("append").save(path)
    return True


def read_runs(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table's rows of all runs that have ended, with their ``run_id``.

    Runs are matched by name with the manifests, one small row a run; folders
    of other runs are not read.
    """
    system, root = _open(path)
    listed = system.get_file_info(fs.FileSelector(f"{root}/{MANIFESTS}", allow_not_found=True))
    runs = sorted(i.base_name.removesuffix(".json") for i in listed if i.base_name.endswith(".json"))
    if not runs:
        return spark.createDataFrame([], schema).withColumn("run_id", F.lit(None).cast("string"))
    whole = T.StructType([*schema.fields, T.StructField("run_id", T.StringType())])
    return spark.read.schema(whole).option("basePath", path).parquet(path).where(F.col("run_id").isin(runs))

"""Landing a stream in several tables, each batch once.

A micro-batch is written to every table under its own number, replacing what an earlier try of
that batch left, and then recorded in a commit table. Readers take only recorded batches. So a
stream that is killed anywhere in a batch and started again has no row twice, none missing, and
never shows one table's part of a batch without the others'.

The number of a batch is that of the stream's checkpoint. A folder belongs to one checkpoint:
another one, or the same one emptied, would count from 0 again and replace what was landed, so
``land`` refuses it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from fleetlens.sources.readers import SNAPSHOT_LINES, LineFormat, rejects_of, rows_of, typed_lines

COMMITS = "_commits"
COMMIT_SCHEMA = "batch bigint, checkpoint string, counts map<string,bigint>"

Split = Mapping[str, Callable[[DataFrame], DataFrame]]


def commits(spark: SparkSession, folder: str) -> DataFrame:
    """The recorded batches with the rows of every table; empty before the first one."""
    try:
        return spark.read.schema(COMMIT_SCHEMA).json(f"{folder}/{COMMITS}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMIT_SCHEMA)


def read_landed(spark: SparkSession, folder: str, table: str, schema: str) -> DataFrame:
    """What recorded batches have landed in a table."""
    recorded = commits(spark, folder).select("batch").distinct()
    if recorded.isEmpty():
        return spark.createDataFrame([], schema)
    stored = spark.read.schema(f"{schema}, batch bigint").parquet(f"{folder}/{table}")
    return stored.join(recorded, "batch", "left_semi").drop("batch")


def _same_checkpoint(spark: SparkSession, folder: str, checkpoint: str) -> None:
    last = commits(spark, folder).agg(F.max("batch").alias("batch"), F.max("checkpoint").alias("of"), F.min("checkpoint").alias("first")).first()
    if last["batch"] is None:
        return
    if {last["of"], last["first"]} != {checkpoint}:
        raise ValueError(f"{folder} was landed from the checkpoint {last['first']}, not from {checkpoint}")
    try:
        spark.read.text(f"{checkpoint}/offsets/{last['batch']}").first()
    except AnalysisException as missing:
        raise ValueError(f"the checkpoint {checkpoint} does not know batch {last['batch']}, which {folder} holds") from missing


def write_batch(batch: DataFrame, batch_id: int, folder: str, tables: Split, checkpoint: str) -> None:
    """Writes one batch to all tables and records it; doing it again gives the same tables.

    The batch is computed once: it is kept while the tables are written, on disk where it
    doesn't fit in memory. Rows are counted as they are written.
    """
    counted = {name: Observation(f"{name}-{batch_id}") for name in tables}
    kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for name, part in tables.items():
            rows = part(kept).observe(counted[name], F.count(F.lit(1)).alias("rows"))
            rows.write.mode("overwrite").parquet(f"{folder}/{name}/batch={batch_id}")
    finally:
        kept.unpersist()
    record = [(batch_id, checkpoint, {name: seen.get["rows"] for name, seen in counted.items()})]
    done = batch.sparkSession.createDataFrame(record, COMMIT_SCHEMA)
    done.coalesce(1).write.mode("overwrite").json(f"{folder}/{COMMITS}/number={batch_id}")


def land(stream: DataFrame, folder: str, checkpoint: str, tables: Split) -> DataStreamWriter:
    """A writer that lands a stream in the named tables of a folder.

    ``tables`` tells for each name which part of a batch it takes.
    """
    _same_checkpoint(stream.sparkSession, folder, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, folder, tables, checkpoint)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def line_stream(
    spark: SparkSession, path: str, fmt: LineFormat = SNAPSHOT_LINES, max_files_per_trigger: int = 1_000
) -> DataFrame:
    """Stream of ``typed_lines`` of the dumps that land in a folder: rows and rejects together."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(path)
    return typed_lines(lines, fmt)


def land_lines(typed: DataFrame, folder: str, checkpoint: str) -> DataStreamWriter:
    """Lands a stream of ``typed_lines``: its rows in the table ``rows``, its rejects in ``rejects``."""
    return land(typed, folder, checkpoint, {"rows": rows_of, "rejects": rejects_of})


def land_view(stream: DataFrame, folder: str, checkpoint: str) -> DataStreamWriter:
    """Lands a stream in the one table ``rows``."""
    return land(stream, folder, checkpoint, {"rows": lambda batch: batch})

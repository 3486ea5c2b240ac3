"""Readers of JSON dumps. Dumps are line-delimited, so large files split across tasks.

A line of a typed dump is a row or a reject, never both and never neither (blank lines
aside). It is a reject if it is no JSON object, has a field of a wrong type, or lacks what
names the thing it describes. Rows and rejects come from one parse (``typed_lines``), which
``landed`` writes in one pass and ``streaming.landing`` lands batch by batch.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens import schemas
from fleetlens.functions.columns import blank_to_null

CORRUPT = "_corrupt_record"


def parse_resources(
    dump: DataFrame, kind: str, text: str = "value", status_only: bool = False
) -> DataFrame:
    """Resource documents from a column of JSON text.

    Each text is one document or a list wrapper ``{"items": [...]}``. The raw text
    of a document is kept in ``raw``, so unknown fields survive, and its place in
    its list (0 outside of one) in ``pos``. ``status_only``
    parses no more than status rows need. Blank lines are skipped, and what is no
    document of the kind goes to ``rejected_resources``.
    """
    parsed = _parsed(dump, kind, text, status_only)
    return parsed.where(F.col(f"doc.{CORRUPT}").isNull()).select("doc.*", "raw", "pos").drop(CORRUPT)


def rejected_resources(dump: DataFrame, kind: str, text: str = "value", status_only: bool = False) -> DataFrame:
    """The documents that ``parse_resources`` leaves out, as ``raw`` text: no JSON object, or a field of a wrong type."""
    return _parsed(dump, kind, text, status_only).where(F.col(f"doc.{CORRUPT}").isNotNull()).select("raw")


def _parsed(dump: DataFrame, kind: str, text: str, status_only: bool) -> DataFrame:
    # Only a text that mentions items can be a wrapper; the others are parsed once.
    items = F.when(
        F.col(text).contains('"items"'), F.from_json(F.col(text), "items array<string>")["items"]
    )
    written = dump.where(F.trim(text) != "")
    documents = written.select(F.posexplode(F.coalesce(items, F.array(F.col(text)))).alias("pos", "raw"))
    schema = f"{schemas.resource_schema(kind, status_only)[:-1]}, {CORRUPT}: string>"
    return documents.select("raw", "pos", F.from_json("raw", schema, {"columnNameOfCorruptRecord": CORRUPT}).alias("doc"))


def read_resources(
    spark: SparkSession, path: str, kind: str, whole_file: bool = False, status_only: bool = False
) -> DataFrame:
    """Resource documents of a dump, one row each.

    ``whole_file`` reads a pretty-printed list as one text; such a file cannot be
    split, so large dumps should hold one document or list per line.
    """
    return parse_resources(spark.read.text(path, wholetext=whole_file), kind, status_only=status_only)


def routes_of(documents: DataFrame) -> DataFrame:
    """Route documents as ``(namespace, pos, to_name, host, tls)``, an input of ``resolve_endpoints``."""
    return documents.select(
        F.coalesce("metadata.namespace", F.lit("default")).alias("namespace"),
        "pos",
        F.col("spec.to.name").alias("to_name"),
        F.col("spec.host").alias("host"),
        F.coalesce(F.size(F.map_keys("spec.tls")) > 0, F.lit(False)).alias("tls"),
    )


def ingresses_of(documents: DataFrame) -> DataFrame:
    """Ingress documents as ``(namespace, pos, rules, tls_hosts)``, an input of ``resolve_endpoints``."""
    rules = F.transform(
        "spec.rules",
        lambda rule: F.struct(
            rule["host"].alias("host"),
            F.transform(rule["http"]["paths"], lambda path: path["backend"]["service"]["name"]).alias("backends"),
        ),
    )
    hosts = F.transform("spec.tls", lambda tls: F.coalesce(tls["hosts"], F.array().cast("array<string>")))
    return documents.select(
        F.coalesce("metadata.namespace", F.lit("default")).alias("namespace"),
        "pos",
        rules.alias("rules"),
        F.flatten(hosts).alias("tls_hosts"),
    )


@dataclass(frozen=True)
class LineFormat:
    """What a typed dump holds: its schema, and the fields of which a line must name one each.

    ``named`` is a list of choices; of each at least one field must be neither missing nor empty.
    """

    schema: str
    named: Sequence[Sequence[str]] = ()


SUBMISSION_LINES = LineFormat(schemas.SUBMISSION, [("job_id", "submission_id")])
NODE_LINES = LineFormat(schemas.NODES, [("cluster",)])
API_TYPE_LINES = LineFormat(schemas.API_TYPES, [("cluster",)])
METRIC_LINES = LineFormat(schemas.METRICS, [("cluster",), ("observed_at",)])
SNAPSHOT_LINES = LineFormat(schemas.SNAPSHOTS, [("name",), ("observed_at",), ("seq",)])

NO_OBJECT, WRONG_TYPE, UNNAMED = "NO_OBJECT", "WRONG_TYPE", "UNNAMED"


def typed_lines(lines: DataFrame, fmt: LineFormat, text: str = "value") -> DataFrame:
    """``(raw, row, reason)`` of every line that is not blank; ``reason`` is NULL for a row.

    Works on batches and on streams. The reasons: ``NO_OBJECT`` (no JSON, or none that is
    an object), ``WRONG_TYPE`` (a field of another type) and ``UNNAMED`` (a name is missing).
    """
    schema = f"{fmt.schema}, {CORRUPT} string"
    parsed = lines.where(F.trim(text) != "").select(
        F.col(text).alias("raw"), F.from_json(text, schema, {"columnNameOfCorruptRecord": CORRUPT}).alias("row")
    )

    def missing(choice: Sequence[str]) -> Column:
        return F.coalesce(*[blank_to_null(F.col(f"row.{name}").cast("string")) for name in choice]).isNull()

    unnamed = F.lit(False)
    for choice in fmt.named:
        unnamed = unnamed | missing(choice)
    # Only a line that failed is parsed again, to tell why.
    is_object = F.coalesce(F.schema_of_variant(F.try_parse_json("raw")).startswith("OBJECT"), F.lit(False))
    failed = F.col("row").isNull() | F.col(f"row.{CORRUPT}").isNotNull()
    reason = F.when(failed, F.when(is_object, WRONG_TYPE).otherwise(NO_OBJECT)).when(unnamed, UNNAMED)
    return parsed.select("raw", F.col("row").dropFields(CORRUPT).alias("row"), reason.alias("reason"))


def rows_of(typed: DataFrame) -> DataFrame:
    """The rows of ``typed_lines``."""
    return typed.where("reason IS NULL").select("row.*")


def rejects_of(typed: DataFrame) -> DataFrame:
    """The rejects of ``typed_lines``: ``(raw, reason)``."""
    return typed.where("reason IS NOT NULL").select("raw", "reason")


def landed(spark: SparkSession, path: str, fmt: LineFormat, folder: str) -> tuple[DataFrame, DataFrame]:
    """Rows and rejects of a dump, read and parsed once: both are written to ``folder`` in one pass."""
    typed = typed_lines(spark.read.text(path), fmt).withColumn("rejected", F.col("reason").isNotNull())
    typed.write.partitionBy("rejected").parquet(folder)
    stored = spark.read.schema(typed.schema).parquet(folder)
    return rows_of(stored.where("NOT rejected")), rejects_of(stored.where("rejected"))


def read_rejected(spark: SparkSession, path: str, fmt: LineFormat) -> DataFrame:
    """``(raw, reason)`` of the lines that the reader of this format leaves out."""
    return rejects_of(typed_lines(spark.read.text(path), fmt))


def _read_rows(spark: SparkSession, path: str, fmt: LineFormat) -> DataFrame:
    return rows_of(typed_lines(spark.read.text(path), fmt))


def submission_times(rows: DataFrame) -> DataFrame:
    """Submissions with their times; the id falls back to the submission id, and time 0 means none."""
    return rows.withColumns(
        {
            "job_id": F.coalesce(blank_to_null("job_id"), F.col("submission_id")),
            "started_at": F.timestamp_millis(F.nullif("start_time", F.lit(0))),
            "ended_at": F.timestamp_millis(F.nullif("end_time", F.lit(0))),
        }
    )


def read_submissions(spark: SparkSession, path: str) -> DataFrame:
    """Dashboard job records with an id."""
    return submission_times(_read_rows(spark, path, SUBMISSION_LINES))


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    """Node inventory as ``(cluster, node, resource, quantity, http_status)``.

    Failed listings and nodes without resources keep one row with a NULL resource.
    """
    return _read_rows(spark, path, NODE_LINES).select(
        "cluster", "node", F.explode_outer("allocatable").alias("resource", "quantity"), "http_status"
    )


def read_api_types(spark: SparkSession, path: str) -> DataFrame:
    """API types of each fleet member, or the status of a listing that failed."""
    return _read_rows(spark, path, API_TYPE_LINES)


def available_resources(metrics: DataFrame, payload: str = "payload") -> DataFrame:
    """Available CPUs and GPUs out of cluster-metrics documents."""
    report = "$.data.clusterStatus.loadMetricsReport."
    return metrics.withColumns(
        {
            "available_cpus": F.get_json_object(payload, report + "numAvailableCpus").try_cast("double"),
            "available_gpus": F.get_json_object(payload, report + "numAvailableGpus").try_cast("double"),
        }
    ).drop(payload)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Cluster metrics with their available CPUs and GPUs."""
    return available_resources(_read_rows(spark, path, METRIC_LINES))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Numbered lines ``(file, line_no, line)`` of log files of any size, as ``log_lines`` numbers those of a text.

    A big file is read by many tasks, each a range of its bytes; a line belongs to the range it
    begins in. Lines are numbered within their range, and the counts of the ranges before it tell
    where it starts. So no task needs more than one range, whose size is
    ``spark.sql.files.maxPartitionBytes``. Only a line feed ends a line. After a trailing one comes
    a last empty line; a file without a byte has none.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("range"),
        F.col("_metadata.file_size").alias("bytes"),
        F.col("value").alias("line"),
        # Follows the order of the lines within a range, which one task reads.
        F.monotonically_increasing_id().alias("at"),
    )
    ranges = lines.groupBy("file", "range").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("line").cast("bigint") + 1).alias("ended"), F.max("bytes").alias("bytes")
    )
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("file", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    in_range = F.row_number().over(Window.partitionBy("file", "range").orderBy("at")) - 1
    numbered = lines.select("file", "range", "line", in_range.alias("within")).join(starts, ["file", "range"])
    # The lines with a line feed each are as long as a file only if its last byte is one.
    whole = ranges.groupBy("file").agg(F.sum("n").alias("line_no"), F.sum("ended").alias("ended"), F.max("bytes").alias("bytes"))
    last = whole.where("ended = bytes").select("file", "line_no", F.lit("").alias("line"))
    return numbered.select("file", (F.col("start") + F.col("within")).alias("line_no"), "line").unionByName(last)

"""The driver tables read as fleet telemetry.

Orders stand for jobs and clusters, events for polls, line items for worker
groups and services, documents for logs. Every binding covers the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.operators.series import Polls
from fleetlens.sources.readers import parse_resources

INPUT_PARTITIONS = "spark.fleetlens.inputPartitions"

AS_OF = "2002-01-01T00:00:00Z"
AS_OF_US = "epoch_us(TIMESTAMP '2002-01-01 00:00:00')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Times are zoneless and mean UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table for queries that do much work per row.

    It is read by the splits of its files. A session whose tables are single row groups,
    which can't be split, names in ``INPUT_PARTITIONS`` how many parts to deal them into.
    """
    rows = table(spark, sf_dir, name)
    parts = spark.conf.get(INPUT_PARTITIONS, None)
    return rows.repartition(int(parts)) if parts else rows


# Rows that a task sorts at most, about: some hundred megabytes.
SORTED_ROWS = 1_000_000


def parts_for(rows: DataFrame, per_row: int = 1) -> int | None:
    """Parts for a sort of ``per_row`` rows for each row, None where the session's shuffle partitions do.

    Counts the rows, which for a parquet table takes its footers only.
    """
    spark = rows.sparkSession
    parts = -(-rows.count() * per_row // SORTED_ROWS)
    return parts if parts > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def as_documents(rows: DataFrame, kind: str, **parts: Column) -> DataFrame:
    """Rows rendered as JSON resource documents and parsed again, as a dump would be."""
    dump = rows.select(F.to_json(F.struct(*[c.alias(n) for n, c in parts.items()])).alias("value"))
    return parse_resources(dump, kind, status_only=True)


EVENT_POLLS = Polls(
    keys=("user_id",), ts="ts", seq="event_id", state="state", head_ready="head_ready", message="event_type"
)

CLUSTER_STATES = """CASE event_type WHEN 'signup' THEN 'CREATING' WHEN 'view' THEN 'RUNNING'
  WHEN 'click' THEN 'RUNNING' WHEN 'purchase' THEN 'SUSPENDED' ELSE 'FAILED' END"""

JOB_STATES = """CASE event_type WHEN 'signup' THEN 'PENDING' WHEN 'view' THEN 'RUNNING'
  WHEN 'click' THEN 'RUNNING' WHEN 'purchase' THEN 'SUCCEEDED' ELSE 'FAILED' END"""


def cluster_polls(events: DataFrame) -> DataFrame:
    """Events as polls of clusters, one cluster per user."""
    return events.selectExpr(
        "user_id", "event_id", "ts", "event_type", "value",
        f"{CLUSTER_STATES} AS state", "value >= 60 AS head_ready",
    )


def job_polls(events: DataFrame) -> DataFrame:
    """Events as polls of jobs, one job per user."""
    return events.selectExpr(
        "user_id", "event_id", "ts", "event_type", f"{JOB_STATES} AS state", "false AS head_ready"
    )


CLUSTER_POLLS_SQL = f"""polls AS (
  SELECT user_id, event_id, event_type, epoch_us(ts) AS us, ts, value,
         {CLUSTER_STATES} AS state, value >= 60 AS head_ready FROM events)"""

JOB_POLLS_SQL = f"""polls AS (
  SELECT user_id, event_id, event_type, epoch_us(ts) AS us, ts, {JOB_STATES} AS state FROM events)"""


def iso(ts: str, suffix: str = "Z") -> str:
    """Spark SQL for the ISO text of a zoneless time."""
    return f"concat(date_format({ts}, \"yyyy-MM-dd'T'HH:mm:ss\"), '{suffix}')"


JOB_NAMESPACES = "lower(o_orderpriority)"

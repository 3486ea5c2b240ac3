"""Readers and sinks over JSON dumps that Spark writes from the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.operators import inventory, series, status, summary
from fleetlens.plans import inventory_queries, status_queries
from fleetlens.plans.bindings import AS_OF, EVENT_POLLS, cluster_polls, iso, spread_table, table
from fleetlens.plans.registry import query
from fleetlens.sources import readers
from fleetlens.sources.scratch import shared_folder
from fleetlens.sources.sinks import write_view


def _json_dump(rows: DataFrame, *others: DataFrame) -> str:
    """Rows written as JSON lines into a new shared folder, with other lines among them; returns its path."""
    folder = shared_folder(rows.sparkSession)
    lines = rows.select(F.to_json(F.struct("*")).alias("value"))
    for other in others:
        lines = lines.unionByName(other)
    lines.write.text(folder)
    return folder


# One line a supplier that is no row of any typed dump, in four ways: cut off, no object,
# a field of a wrong type, and without the name of what it describes.
SPOILED = """CASE s_suppkey % 4 WHEN 0 THEN concat('{{"cluster": "', s_suppkey) WHEN 1 THEN concat('[', s_suppkey, ']')
  WHEN 2 THEN concat('{{"cluster": "c", "job_id": "', s_suppkey, '", "{field}": "soon"}}')
  ELSE concat('{{"note": ', s_suppkey, '}}') END"""
REASONS = "CASE s_suppkey % 4 WHEN 2 THEN 'WRONG_TYPE' WHEN 3 THEN 'UNNAMED' ELSE 'NO_OBJECT' END"


def _spoiled(spark, sf_dir, field):
    return table(spark, sf_dir, "supplier").selectExpr(f"{SPOILED.format(field=field)} AS value")


def rejected_sql(field):
    return f"SELECT {SPOILED.format(field=field)} AS raw, {REASONS} AS reason FROM supplier"


RESOURCES_SQL = """SELECT 'c' || c_custkey AS name, lower(c_mktsegment) AS namespace,
      CASE WHEN c_acctbal >= 0 THEN 'RUNNING' ELSE 'UNKNOWN' END AS state, c_nationkey AS workers_ready FROM customer
    UNION ALL
    SELECT 's' || s_suppkey, 'default', 'FAILED', s_nationkey FROM supplier"""


def _resource_dump(spark, sf_dir):
    """Customers as single documents, suppliers inside list wrappers, in one dump."""
    single = spread_table(spark, sf_dir, "customer").select(
        F.expr("""to_json(named_struct('metadata', named_struct('name', concat('c', CAST(c_custkey AS STRING)),
          'namespace', lower(c_mktsegment)), 'status', named_struct('state', if(c_acctbal >= 0, 'Ready', 'Pending'),
          'readyWorkerReplicas', c_nationkey)))""").alias("value")
    )
    wrapped = table(spark, sf_dir, "supplier").select(
        F.expr("""to_json(named_struct('kind', 'List', 'items', array(named_struct(
          'metadata', named_struct('name', concat('s', CAST(s_suppkey AS STRING))),
          'status', named_struct('state', 'failed', 'readyWorkerReplicas', s_nationkey)))))""").alias("value")
    )
    # Blank lines, broken ones and documents with a field of a wrong type are no resources.
    spoiled = table(spark, sf_dir, "nation").select(
        F.expr("""CASE n_nationkey % 3 WHEN 0 THEN '  ' WHEN 1 THEN '{"metadata": {"name": '
          ELSE '{"metadata": {"name": "x"}, "status": {"readyWorkerReplicas": "three"}}' END""").alias("value")
    )
    folder = shared_folder(spark)
    single.union(wrapped).union(spoiled).write.text(folder)
    return folder


@query("read_resources", RESOURCES_SQL)
def read_resources(spark, sf_dir):
    documents = readers.read_resources(spark, _resource_dump(spark, sf_dir), "cluster", status_only=True)
    return status.cluster_status(documents, AS_OF).select("name", "namespace", "state", "workers_ready")


@query(
    "read_rejected",
    """SELECT CASE n_nationkey % 3 WHEN 1 THEN 'no JSON' ELSE 'wrong type' END AS reason, count(*) AS lines
    FROM nation WHERE n_nationkey % 3 <> 0 GROUP BY 1""",
)
def read_rejected(spark, sf_dir):
    """What the same dump holds besides resources."""
    dump = spark.read.text(_resource_dump(spark, sf_dir))
    rejects = readers.rejected_resources(dump, "cluster", status_only=True)
    reason = F.when(F.try_parse_json("raw").isNull(), "no JSON").otherwise("wrong type")
    return rejects.groupBy(reason.alias("reason")).agg(F.count("*").alias("lines"))


def _submission_dump(spark, sf_dir):
    return _json_dump(status_queries.submissions(spark, sf_dir), _spoiled(spark, sf_dir, "start_time"))


def _submission_rows(rows):
    return status.submission_status(rows).select(
        "name", "state", "terminal", "entrypoint", "message",
        F.unix_millis("started_at").alias("started_ms"), F.unix_millis("ended_at").alias("ended_ms"),
    )


@query("read_submissions", status_queries.SUBMISSION_SQL)
def read_submissions(spark, sf_dir):
    return _submission_rows(readers.read_submissions(spark, _submission_dump(spark, sf_dir)))


@query("read_submissions_rejected", rejected_sql("start_time"))
def read_submissions_rejected(spark, sf_dir):
    return readers.read_rejected(spark, _submission_dump(spark, sf_dir), readers.SUBMISSION_LINES)


@query(
    "landed_submissions",
    f"""SELECT 'row' AS part, name, state FROM ({status_queries.SUBMISSION_SQL})
    UNION ALL SELECT 'reject', raw, reason FROM ({rejected_sql("start_time")})""",
)
def landed_submissions(spark, sf_dir):
    """Rows and rejects of one dump out of one pass."""
    rows, rejects = readers.landed(
        spark, _submission_dump(spark, sf_dir), readers.SUBMISSION_LINES, shared_folder(spark)
    )
    found = _submission_rows(readers.submission_times(rows)).select(F.lit("row").alias("part"), "name", "state")
    return found.union(rejects.select(F.lit("reject"), "raw", "reason"))


def _node_dump(spark, sf_dir):
    listed = inventory_queries.nodes(spark, sf_dir).select(
        "cluster", "node", F.create_map("resource", "quantity").alias("allocatable"), "http_status"
    )
    return _json_dump(listed, _spoiled(spark, sf_dir, "http_status"))


@query("read_nodes", inventory_queries.GPU_SQL)
def read_nodes(spark, sf_dir):
    found = inventory.gpu_types(readers.read_nodes(spark, _node_dump(spark, sf_dir)))
    return found.withColumn("gpu_types", F.array_join("gpu_types", ","))


@query("read_nodes_rejected", rejected_sql("http_status"))
def read_nodes_rejected(spark, sf_dir):
    return readers.read_rejected(spark, _node_dump(spark, sf_dir), readers.NODE_LINES)


def _api_type_dump(spark, sf_dir):
    return _json_dump(inventory_queries.api_types(spark, sf_dir), _spoiled(spark, sf_dir, "http_status"))


@query(
    "read_api_types",
    f"""SELECT p_brand || '/' || p_size AS cluster, {inventory_queries.TYPE_NAME} AS crd_name,
      CASE WHEN p_retailprice < 1000 THEN 'v' || p_name END AS version, 'a' || p_name AS noted,
      {inventory_queries.TYPE_STATUS} AS http_status
    FROM part""",
)
def read_api_types(spark, sf_dir):
    types = readers.read_api_types(spark, _api_type_dump(spark, sf_dir))
    version = F.col("labels")[inventory.VERSION_LABEL].alias("version")
    noted = F.col("annotations")[inventory.VERSION_ANNOTATION].alias("noted")
    return types.select("cluster", "crd_name", version, noted, "http_status")


@query("read_api_types_rejected", rejected_sql("http_status"))
def read_api_types_rejected(spark, sf_dir):
    return readers.read_rejected(spark, _api_type_dump(spark, sf_dir), readers.API_TYPE_LINES)


def _metrics_dump(spark, sf_dir):
    payload = """to_json(named_struct('data', named_struct('clusterStatus', named_struct('loadMetricsReport',
      named_struct('numAvailableCpus', user_id, 'numAvailableGpus', event_id)))))"""
    dump = table(spark, sf_dir, "events").selectExpr(
        "CAST(user_id AS STRING) AS cluster", f"{iso('ts')} AS observed_at", f"{payload} AS payload"
    )
    return _json_dump(dump, _spoiled(spark, sf_dir, "observed_at"))


@query(
    "read_metrics",
    """SELECT user_id, epoch_us(date_trunc('hour', ts)) AS hour_us, min(user_id)::DOUBLE AS min_available_cpus,
      max(event_id)::DOUBLE AS max_available_gpus FROM events GROUP BY 1, 2""",
)
def read_metrics(spark, sf_dir):
    hours = summary.utilization(readers.read_metrics(spark, _metrics_dump(spark, sf_dir)))
    return hours.select(
        F.col("cluster").cast("bigint").alias("user_id"), F.unix_micros("period").alias("hour_us"),
        "min_available_cpus", "max_available_gpus",
    )


@query("read_metrics_rejected", rejected_sql("observed_at"))
def read_metrics_rejected(spark, sf_dir):
    return readers.read_rejected(spark, _metrics_dump(spark, sf_dir), readers.METRIC_LINES)


# Sixteen log files, each the texts of the documents of one remainder, one after the other.
LOG_FILES_SQL = """logs AS (
  SELECT doc_id % 16 AS log, row_number() OVER (PARTITION BY doc_id % 16 ORDER BY doc_id, pos) - 1 AS line_no, line
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos
    FROM documents)
  UNION ALL SELECT doc_id % 16, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT), '' FROM documents GROUP BY 1)"""


def _log_lines(spark, sf_dir):
    folder = shared_folder(spark)
    logs = table(spark, sf_dir, "documents").selectExpr("doc_id % 16 AS log", "doc_id", "text AS value")
    ordered = logs.repartition("log").sortWithinPartitions("log", "doc_id").select("log", "value")
    ordered.write.partitionBy("log").option("lineSep", "\n").text(folder)
    log = F.regexp_extract("file", "/log=([0-9]+)/", 1).cast("bigint")
    return readers.read_log(spark, f"{folder}/*/*.txt").select(log.alias("log"), "line_no", "line")


@query("read_log", f"WITH {LOG_FILES_SQL} SELECT log, line_no, line FROM logs")
def read_log(spark, sf_dir):
    """Lines of log files numbered by the ranges that tasks read."""
    return _log_lines(spark, sf_dir)


@query(
    "read_log_tail",
    f"""WITH {LOG_FILES_SQL} SELECT log, line_no, line FROM
      (SELECT *, row_number() OVER (PARTITION BY log ORDER BY line_no DESC) AS n FROM logs) WHERE n <= 100""",
)
def read_log_tail(spark, sf_dir):
    return series.log_tail(_log_lines(spark, sf_dir), 100, "log")


@query("write_view", status_queries.CLUSTER_LIST_SQL)
def write_views(spark, sf_dir):
    view = status_queries.list_view_clusters(spark, sf_dir)
    folder = shared_folder(spark)
    write_view(view, folder, "json")
    return spark.read.schema(view.schema).json(folder)


@query(
    "write_view_partitioned",
    """SELECT user_id, event_id, state FROM (SELECT user_id, event_id, CASE event_type WHEN 'signup' THEN 'CREATING'
      WHEN 'view' THEN 'RUNNING' WHEN 'click' THEN 'RUNNING' WHEN 'purchase' THEN 'SUSPENDED' ELSE 'FAILED' END AS state,
      row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events)
    WHERE n = 1""",
)
def write_view_partitioned(spark, sf_dir):
    """A view laid out by state, read back."""
    polls = cluster_polls(table(spark, sf_dir, "events"))
    view = series.latest_snapshot(polls, EVENT_POLLS).select("user_id", "event_id", "state")
    folder = shared_folder(spark)
    write_view(view, folder, "parquet", ["state"])
    return spark.read.parquet(folder).select("user_id", "event_id", "state")

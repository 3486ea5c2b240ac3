"""Status rows, predicates and summaries over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.functions.clock import age_label, age_us
from fleetlens.functions.documents import service_ip_url
from fleetlens.functions.states import condition_true, is_active, is_terminal, map_state
from fleetlens.operators import status, summary
from fleetlens.operators.joins import effective_namespaces
from fleetlens.plans.bindings import AS_OF, AS_OF_US, JOB_NAMESPACES, as_documents, iso, spread_table, table
from fleetlens.plans.registry import query

JOB_WORDS = "CASE o_orderstatus WHEN 'O' THEN 'Running' WHEN 'F' THEN 'SUCCEEDED' ELSE 'pending' END"


@query(
    "fleet_summary",
    """SELECT n_name AS namespace,
      CASE o_orderstatus WHEN 'O' THEN 'RUNNING' WHEN 'F' THEN 'SUCCEEDED' ELSE 'PENDING' END AS state,
      count(*) AS resources, CAST(sum(c_nationkey) AS BIGINT) AS workers_ready,
      CAST(sum(c_custkey) AS BIGINT) AS workers_desired
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY ROLLUP (1, 2)""",
)
def fleet_summary(spark, sf_dir):
    jobs = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
        .select(
            F.col("n_name").alias("namespace"),
            map_state(F.expr(JOB_WORDS), "job").alias("state"),
            F.col("c_nationkey").alias("workers_ready"),
            F.col("c_custkey").alias("workers_desired"),
        )
    )
    return summary.fleet_summary(jobs)


# Orders as cluster documents. The priority chooses how the creation time is written.
CLUSTER_WORDS = """CASE o_orderpriority WHEN '1-URGENT' THEN 'Ready' WHEN '2-HIGH' THEN 'creating'
  WHEN '3-MEDIUM' THEN 'pending' WHEN '5-LOW' THEN 'FAILED' ELSE NULL END"""
CREATED = f"""CASE o_orderpriority WHEN '1-URGENT' THEN {iso('o_orderdate')}
  WHEN '2-HIGH' THEN {iso('o_orderdate', '+02:00')} WHEN '3-MEDIUM' THEN {iso('o_orderdate', '')}
  WHEN '5-LOW' THEN 'not a time' ELSE NULL END"""
SERVICE_IP = """CASE o_orderstatus WHEN 'O' THEN concat('10.0.0.', CAST(o_custkey AS STRING))
  WHEN 'P' THEN '' ELSE NULL END"""


def _cluster_documents(spark, sf_dir):
    orders = spread_table(spark, sf_dir, "orders")
    condition = """array(named_struct('type', 'HeadPodReady', 'status', if(o_totalprice >= 150000, 'True', 'False')),
      named_struct('type', 'Other', 'status', 'True'))"""
    return as_documents(
        orders,
        "cluster",
        apiVersion=F.lit("ray.io/v1"),
        metadata=F.expr(
            f"""named_struct('name', concat('c', CAST(o_orderkey AS STRING)),
              'namespace', if(o_orderstatus = 'F', NULL, {JOB_NAMESPACES}), 'creationTimestamp', {CREATED})"""
        ),
        spec=F.expr("named_struct('rayVersion', if(o_orderstatus = 'P', NULL, '2.41.0'))"),
        status=F.expr(
            f"""named_struct('state', {CLUSTER_WORDS}, 'head', named_struct('serviceIP', {SERVICE_IP}),
              'readyWorkerReplicas', CAST(o_custkey AS INT),
              'desiredWorkerReplicas', if(o_orderstatus = 'F', NULL, CAST(o_custkey + 1 AS INT)),
              'conditions', if(o_orderstatus = 'P', NULL, {condition}))"""
        ),
    )


CLUSTER_STATUS_SQL = f"""SELECT 'c' || o_orderkey AS name,
  CASE WHEN o_orderstatus = 'F' THEN 'default' ELSE {JOB_NAMESPACES} END AS namespace,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'RUNNING' WHEN '2-HIGH' THEN 'CREATING'
    WHEN '5-LOW' THEN 'FAILED' ELSE 'UNKNOWN' END AS state,
  o_orderstatus <> 'P' AND o_totalprice >= 150000 AS head_ready,
  CAST(o_custkey AS INTEGER) AS workers_ready,
  CAST(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_custkey + 1 END AS INTEGER) AS workers_desired,
  CASE WHEN o_orderstatus = 'P' THEN '' ELSE '2.41.0' END AS version,
  CASE WHEN o_orderstatus = 'O' THEN 'http://10.0.0.' || o_custkey || ':8265' END AS dashboard_url,
  CASE o_orderpriority WHEN '1-URGENT' THEN {AS_OF_US} - epoch_us(o_orderdate)
    WHEN '2-HIGH' THEN {AS_OF_US} - epoch_us(o_orderdate) + 7200000000 ELSE 0 END AS age_us,
  CASE WHEN o_orderstatus = 'P' THEN '[]' ELSE '[{{"type":"HeadPodReady","status":"' ||
    CASE WHEN o_totalprice >= 150000 THEN 'True' ELSE 'False' END || '"}},{{"type":"Other","status":"True"}}]' END AS conditions
FROM orders"""


@query("cluster_status", CLUSTER_STATUS_SQL)
def cluster_status(spark, sf_dir):
    found = status.cluster_status(_cluster_documents(spark, sf_dir), AS_OF)
    return found.withColumn("conditions", F.to_json("conditions"))


AGE_LABEL = """CASE WHEN {0} // 1000000 < 60 THEN {0} // 1000000 || 's'
  WHEN {0} // 1000000 < 3600 THEN {0} // 60000000 || 'm'
  WHEN {0} // 1000000 < 86400 THEN {0} // 3600000000 || 'h' ELSE {0} // 86400000000 || 'd' END"""


CLUSTER_LIST_SQL = f"""SELECT name, state, workers_ready AS workers, {AGE_LABEL.format('age_us')} AS age
FROM ({CLUSTER_STATUS_SQL})"""


@query("list_view_clusters", CLUSTER_LIST_SQL)
def list_view_clusters(spark, sf_dir):
    return status.list_view(status.cluster_status(_cluster_documents(spark, sf_dir), AS_OF), "cluster")


@query(
    "in_namespace",
    f"SELECT name, state FROM ({CLUSTER_STATUS_SQL}) WHERE namespace = 'default'",
)
def in_namespace(spark, sf_dir):
    rows = status.cluster_status(_cluster_documents(spark, sf_dir), AS_OF)
    return status.in_namespace(rows, "default").select("name", "state")


def _job_documents(spark, sf_dir):
    """Orders as job documents that end with the last shipment of a finished line."""
    ends = (
        table(spark, sf_dir, "lineitem")
        .where("l_linestatus = 'F'")
        .groupBy("l_orderkey")
        .agg(F.max("l_shipdate").alias("ended"))
    )
    jobs = spread_table(spark, sf_dir, "orders").join(ends, F.expr("o_orderkey = l_orderkey"), "left")
    return as_documents(
        jobs,
        "job",
        metadata=F.expr(
            f"""named_struct('name', concat('j', CAST(o_orderkey AS STRING)), 'namespace', {JOB_NAMESPACES},
              'creationTimestamp', if(o_orderpriority = '5-LOW', NULL, {iso('o_orderdate')}))"""
        ),
        spec=F.expr("named_struct('entrypoint', if(o_orderpriority = '2-HIGH', NULL, concat('run ', o_orderstatus)))"),
        status=F.expr(
            f"""named_struct('jobStatus', {JOB_WORDS},
              'startTime', if(o_orderpriority = '4-NOT SPECIFIED', NULL, {iso('o_orderdate')}),
              'endTime', if(o_orderpriority = '3-MEDIUM', {iso('ended', '')}, {iso('ended')}),
              'message', if(o_orderstatus = 'F', '', o_orderstatus),
              'rayClusterName', concat('c', CAST(o_custkey AS STRING)))"""
        ),
    )


JOB_STATUS_SQL = f"""SELECT 'j' || o_orderkey AS name, {JOB_NAMESPACES} AS namespace,
  upper({JOB_WORDS}) AS state, 'CRD' AS mode,
  CASE WHEN o_orderpriority = '2-HIGH' THEN '' ELSE 'run ' || o_orderstatus END AS entrypoint,
  CASE WHEN o_orderpriority = '5-LOW' THEN {AS_OF_US} ELSE epoch_us(o_orderdate) END AS submitted_us,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
    WHEN ended IS NOT NULL AND o_orderpriority = '3-MEDIUM' THEN NULL
    WHEN ended IS NOT NULL THEN epoch_us(ended) - epoch_us(o_orderdate)
    WHEN o_orderstatus IN ('O', 'P') THEN {AS_OF_US} - epoch_us(o_orderdate) END AS duration_us,
  CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderstatus END AS error_message,
  'c' || o_custkey AS cluster_name
FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS ended FROM lineitem WHERE l_linestatus = 'F'
  GROUP BY l_orderkey) ON o_orderkey = l_orderkey"""


@query("job_status", JOB_STATUS_SQL)
def job_status(spark, sf_dir):
    rows = status.job_status(_job_documents(spark, sf_dir), AS_OF)
    return rows.withColumn("submitted_us", F.unix_micros("submitted_at")).drop("submitted_at")


@query(
    "list_view_jobs",
    f"""SELECT name, state, entrypoint, {AGE_LABEL.format('age_us')} AS age
    FROM (SELECT *, {AS_OF_US} - submitted_us AS age_us FROM ({JOB_STATUS_SQL}))""",
)
def list_view_jobs(spark, sf_dir):
    return status.list_view(status.job_status(_job_documents(spark, sf_dir), AS_OF), "job", AS_OF)


# Line items as service documents with two deployments each.
SERVE_CONFIG = """concat('applications:\\n- name: a\\n  deployments:\\n  - name: d\\n    num_replicas: ',
  CAST(l_linenumber AS STRING), '\\n  - name: e\\n')"""
SERVE_DECLARED = """CASE WHEN l_returnflag = 'N' THEN 0 ELSE l_linenumber + 1 END"""
SERVICE_WORDS = """CASE l_returnflag WHEN 'A' THEN 'Running' WHEN 'R' THEN 'WaitForFailOver' ELSE 'odd' END"""


def _service_documents(spark, sf_dir):
    deployments = """array(named_struct('healthyReplicas', l_linenumber, 'desiredReplicas', l_linenumber + 2),
      named_struct('healthyReplicas', NULL, 'desiredReplicas', 1))"""
    return as_documents(
        spread_table(spark, sf_dir, "lineitem"),
        "service",
        metadata=F.expr(
            f"""named_struct('name', concat('s', CAST(l_orderkey AS STRING)), 'namespace', lower(l_returnflag),
              'creationTimestamp', {iso('l_shipdate')})"""
        ),
        spec=F.expr(f"named_struct('serveConfigV2', if(l_returnflag = 'N', ': [', {SERVE_CONFIG}))"),
        status=F.expr(
            f"""named_struct('serviceStatus', {SERVICE_WORDS},
              'activeServiceStatus', named_struct('applicationStatuses', map('main',
                named_struct('serveDeploymentStatuses', if(l_linestatus = 'F', {deployments}, NULL)))),
              'dashboardStatus', named_struct('isHealthy', l_returnflag = 'A', 'dashboardUrl', 'http://dash'))"""
        ),
    )


SERVICE_STATUS_SQL = f"""SELECT 's' || l_orderkey AS name, lower(l_returnflag) AS namespace,
  CASE l_returnflag WHEN 'A' THEN 'RUNNING' WHEN 'R' THEN 'DEPLOYING' ELSE 'UNKNOWN' END AS state,
  CASE WHEN l_returnflag = 'A' THEN 'http://dash' END AS endpoint_url, CAST(NULL AS VARCHAR) AS route_url,
  CAST(CASE WHEN l_linestatus = 'F' THEN l_linenumber ELSE 0 END AS INTEGER) AS replicas_ready,
  CAST(CASE WHEN l_linestatus = 'F' THEN l_linenumber + 3 ELSE {SERVE_DECLARED} END AS INTEGER)
    AS replicas_desired,
  {AS_OF_US} - epoch_us(l_shipdate) AS age_us FROM lineitem"""


@query("service_status", SERVICE_STATUS_SQL)
def service_status(spark, sf_dir):
    return status.service_status(_service_documents(spark, sf_dir), AS_OF)


@query(
    "list_view_services",
    f"SELECT name, state, replicas_ready AS replicas, {AGE_LABEL.format('age_us')} AS age FROM ({SERVICE_STATUS_SQL})",
)
def list_view_services(spark, sf_dir):
    return status.list_view(status.service_status(_service_documents(spark, sf_dir), AS_OF), "service")


@query(
    "service_replicas",
    f"""SELECT state, sum(replicas_ready)::BIGINT AS ready, sum(replicas_desired)::BIGINT AS desired
    FROM ({SERVICE_STATUS_SQL}) GROUP BY state""",
)
def service_replicas(spark, sf_dir):
    docs = _service_documents(spark, sf_dir)
    rows = docs.select(
        map_state("status.serviceStatus", "service").alias("state"),
        F.col("status.activeServiceStatus.applicationStatuses").alias("applications"),
        F.col("spec.serveConfigV2").alias("config"),
    )
    counted = status.with_replicas(rows, "applications", "config")
    return counted.groupBy("state").agg(F.sum("replicas_ready").alias("ready"), F.sum("replicas_desired").alias("desired"))


# Events as dashboard submissions.
SUBMISSION_COLUMNS = (
    "if(value < 60, '', concat('raysubmit_', CAST(event_id AS STRING))) AS job_id",
    "concat('s', CAST(event_id AS STRING)) AS submission_id",
    """CASE event_type WHEN 'signup' THEN 'pending' WHEN 'view' THEN 'Running' WHEN 'click' THEN 'STOPPED'
      WHEN 'purchase' THEN 'succeeded' ELSE 'failed' END AS status""",
    "if(event_type = 'view', NULL, concat('python ', event_type)) AS entrypoint",
    "if(event_type = 'error', 'boom', NULL) AS message",
    "unix_millis(CAST(ts AS TIMESTAMP)) AS start_time",
    "if(event_type IN ('signup', 'view'), 0, unix_millis(CAST(ts AS TIMESTAMP)) + user_id) AS end_time",
)

SUBMISSION_SQL = """SELECT
  CASE WHEN value < 60 THEN 's' || event_id ELSE 'raysubmit_' || event_id END AS name,
  CASE event_type WHEN 'signup' THEN 'PENDING' WHEN 'view' THEN 'RUNNING' WHEN 'click' THEN 'STOPPED'
    WHEN 'purchase' THEN 'SUCCEEDED' ELSE 'FAILED' END AS state,
  event_type NOT IN ('signup', 'view') AS terminal,
  CASE WHEN event_type = 'view' THEN '' ELSE 'python ' || event_type END AS entrypoint,
  CASE WHEN event_type = 'error' THEN 'boom' ELSE '' END AS message,
  epoch_us(ts) // 1000 AS started_ms,
  CASE WHEN event_type NOT IN ('signup', 'view') THEN epoch_us(ts) // 1000 + user_id END AS ended_ms
FROM events"""


def submissions(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(*SUBMISSION_COLUMNS)


@query("submission_status", SUBMISSION_SQL)
def submission_status(spark, sf_dir):
    return status.submission_status(submissions(spark, sf_dir)).select(
        "name", "state", "terminal", "entrypoint", "message",
        F.unix_millis("started_at").alias("started_ms"), F.unix_millis("ended_at").alias("ended_ms"),
    )


@query(
    "unify_jobs",
    f"""SELECT name, namespace, mode, state, entrypoint, duration_us, message, cluster_name FROM (
      SELECT name, namespace, mode, state, entrypoint, duration_us, error_message AS message, cluster_name
        FROM ({JOB_STATUS_SQL})
      UNION ALL
      SELECT name, NULL, 'DASHBOARD', state, entrypoint, (ended_ms - started_ms) * 1000, message, NULL
        FROM ({SUBMISSION_SQL}))""",
)
def unify_jobs(spark, sf_dir):
    jobs = status.job_status(_job_documents(spark, sf_dir), AS_OF)
    return status.unify_jobs(jobs, status.submission_status(submissions(spark, sf_dir))).drop("submitted_at")


@query(
    "map_state",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'RUNNING' WHEN '2-HIGH' THEN 'CREATING'
        WHEN '5-LOW' THEN 'FAILED' ELSE 'UNKNOWN' END AS cluster_state,
      CASE o_orderpriority WHEN '3-MEDIUM' THEN 'PENDING' WHEN '5-LOW' THEN 'FAILED' ELSE 'UNKNOWN' END AS job_state,
      CASE o_orderpriority WHEN '5-LOW' THEN 'FAILED' ELSE 'UNKNOWN' END AS service_state FROM orders""",
)
def map_states(spark, sf_dir):
    words = table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{CLUSTER_WORDS} AS word")
    kinds = [map_state("word", kind).alias(f"{kind}_state") for kind in ("cluster", "job", "service")]
    return words.select("o_orderkey", *kinds)


@query(
    "condition_true",
    """SELECT doc_id, CASE WHEN toxic IS NULL THEN false ELSE toxic = 1 AND quality = 1 END AS ready
    FROM documents LEFT JOIN labels USING (doc_id)""",
)
def conditions(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    held = F.expr(
        """if(toxic IS NULL, NULL, array(
          named_struct('type', if(toxic = 1, 'HeadPodReady', 'Other'), 'status', if(quality = 1, 'True', 'true')),
          named_struct('type', 'HeadPodReady', 'status', 'False')))"""
    )
    return rows.select("doc_id", condition_true(held, "HeadPodReady").alias("ready"))


EVENT_AGE = "epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(ts)"


@query(
    "age_label",
    f"""SELECT event_id, age_us, {AGE_LABEL.format('age_us')} AS age
    FROM (SELECT event_id, {EVENT_AGE} AS age_us FROM events)""",
)
def age_labels(spark, sf_dir):
    created = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    ages = table(spark, sf_dir, "events").select(
        "event_id", age_us(created, "2024-01-31T00:00:00Z").alias("age_us")
    )
    return ages.withColumn("age", age_label("age_us"))


@query(
    "service_ip_url",
    """SELECT s_suppkey, CASE WHEN s_acctbal >= 0 THEN 'http://10.1.' || s_nationkey || '.1:8265' END AS url
    FROM supplier""",
)
def service_ip_urls(spark, sf_dir):
    address = F.expr("if(s_acctbal >= 0, concat('10.1.', CAST(s_nationkey AS STRING), '.1'), '')")
    return table(spark, sf_dir, "supplier").select("s_suppkey", service_ip_url(address).alias("url"))


@query(
    "resolve_namespace",
    """SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN lower(c_mktsegment) WHEN c_nationkey > 12 THEN 'team'
      WHEN c_mktsegment = 'BUILDING' THEN 'ctx' ELSE 'default' END AS namespace FROM customer""",
)
def resolve_namespaces(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "if(c_acctbal > 5000, lower(c_mktsegment), '') AS override",
        "if(c_nationkey > 12, 'team', NULL) AS config",
        "if(c_mktsegment = 'BUILDING', 'ctx', '') AS context",
    )
    return effective_namespaces(rows).select("c_custkey", "namespace")


@query(
    "active_and_terminal",
    """SELECT o_orderkey, o_orderstatus IN ('O', 'P') AS active, o_orderstatus = 'F' AS terminal FROM orders""",
)
def active_and_terminal(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{JOB_WORDS} AS word")
    state = map_state("word", "job")
    return rows.select("o_orderkey", is_active("word").alias("active"), is_terminal(state).alias("terminal"))

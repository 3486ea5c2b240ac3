"""Joins of requests, resources, profiles and addresses over the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fleetlens.operators import joins, overlay
from fleetlens.operators.validation import validate
from fleetlens.plans.bindings import as_documents, parts_for, spread_table, table
from fleetlens.plans.registry import query
from fleetlens.sources.readers import ingresses_of, parse_resources, routes_of
from fleetlens.sources.scratch import shared_folder
from fleetlens.sources.sinks import write_bucketed

# Orders as desired clusters; every order that is not pending exists already. Existing
# documents write keys in another order and numbers as decimals; finished ones differ
# where the order is urgent.
DESIRED = """concat('{"workers": ', CAST(o_custkey AS STRING), ', "head": {"cpus": 2, "memory": "4Gi"}, "name": "',
  o_orderpriority, '"}')"""
EXISTING = """concat('{"name": "', if(o_orderstatus = 'F' AND o_orderpriority = '1-URGENT', 'other', o_orderpriority),
  '", "head": {"memory": "4Gi", "cpus": 2.0}, "workers": ', CAST(o_custkey AS STRING), '.0}')"""


RECONCILE_SQL = """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'CREATE'
      WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'CONFLICT' ELSE 'UNCHANGED' END AS outcome
    FROM orders"""


def _sides(spark, sf_dir):
    orders = spread_table(spark, sf_dir, "orders")
    desired = orders.selectExpr("o_orderkey", f"{DESIRED} AS spec")
    return desired, orders.where("o_orderstatus <> 'P'").selectExpr("o_orderkey", f"{EXISTING} AS spec")


@query("reconcile", RECONCILE_SQL)
def reconcile(spark, sf_dir):
    return joins.reconcile(*_sides(spark, sf_dir), ["o_orderkey"])


def _bucketed(rows, keys):
    """The rows as a bucketed table of their own in the shared folder."""
    spark = rows.sparkSession
    return write_bucketed(rows, f"landed_{uuid.uuid4().hex}", shared_folder(spark), keys, 16)


@query("reconcile_bucketed", RECONCILE_SQL)
def reconcile_bucketed(spark, sf_dir):
    """Both sides landed in buckets first; the join shuffles nothing."""
    desired, existing = (_bucketed(side, ["o_orderkey"]) for side in _sides(spark, sf_dir))
    return joins.reconcile(desired, existing, ["o_orderkey"])


LOOKUP_SQL = """SELECT o_orderkey AS name, o_orderpriority AS namespace, lines,
      CASE WHEN lines IS NULL THEN 'JOB_NOT_FOUND' END AS error
    FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS lines FROM lineitem WHERE l_returnflag = 'R'
      GROUP BY l_orderkey) ON o_orderkey = l_orderkey"""


def _requests_and_resources(spark, sf_dir):
    requests = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS name", "o_orderpriority AS namespace")
    counted = (
        table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
        .groupBy(F.col("l_orderkey").alias("name")).agg(F.count(F.lit(1)).alias("lines"))
    )
    return requests, requests.join(counted, "name")


@query("lookup", LOOKUP_SQL)
def lookup(spark, sf_dir):
    return joins.lookup(*_requests_and_resources(spark, sf_dir), "job")


@query("lookup_bucketed", LOOKUP_SQL)
def lookup_bucketed(spark, sf_dir):
    """Requests and resources landed in buckets first; the join shuffles nothing."""
    requests, resources = (_bucketed(side, ["namespace", "name"]) for side in _requests_and_resources(spark, sf_dir))
    return joins.lookup(requests, resources, "job")


# Customers as clusters and orders as jobs, both in the namespace of the customer's nation.
JOB_STATE = "CASE o_orderstatus WHEN 'O' THEN 'Running' WHEN 'P' THEN 'PENDING' ELSE 'SUCCEEDED' END"
JOBS_SQL = """jobs AS (SELECT c_nationkey AS namespace, c_custkey AS cluster_name, o_orderkey AS job, o_orderstatus
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus IN ('O', 'P'))"""


def _clusters(spark, sf_dir):
    return table(spark, sf_dir, "customer").selectExpr("c_nationkey AS namespace", "c_custkey AS name")


def _jobs(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.join(table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey")).selectExpr(
        "c_nationkey AS namespace", "c_custkey AS cluster_name", "o_orderkey AS job", f"{JOB_STATE} AS state"
    )


@query(
    "delete_blockers",
    f"""WITH {JOBS_SQL}, active AS (SELECT namespace, count(*) FILTER (WHERE o_orderstatus = 'O') AS running_jobs,
      count(*) FILTER (WHERE o_orderstatus = 'P') AS pending_jobs FROM jobs GROUP BY namespace)
    SELECT namespace, c_custkey AS name, running_jobs, pending_jobs
    FROM customer JOIN active ON namespace = c_nationkey""",
)
def delete_blockers(spark, sf_dir):
    return joins.delete_blockers(_clusters(spark, sf_dir), _jobs(spark, sf_dir))


@query(
    "delete_blockers_scoped",
    f"""WITH {JOBS_SQL} SELECT namespace, cluster_name AS name, count(*) FILTER (WHERE o_orderstatus = 'O')
      AS running_jobs, count(*) FILTER (WHERE o_orderstatus = 'P') AS pending_jobs FROM jobs GROUP BY ALL""",
)
def delete_blockers_scoped(spark, sf_dir):
    return joins.delete_blockers(_clusters(spark, sf_dir), _jobs(spark, sf_dir), scoped=True)


@query(
    "blocking_jobs",
    f"""WITH {JOBS_SQL} SELECT namespace, cluster_name, job FROM jobs
    WHERE namespace IN (SELECT c_nationkey FROM customer)""",
)
def blocking_jobs(spark, sf_dir):
    return joins.blocking_jobs(_clusters(spark, sf_dir), _jobs(spark, sf_dir)).drop("state")


# Pages as routes (https) and ingress rules (http); two pages each point at one document's cluster.
HOST = "split_part(url, '/', 3)"
SERVICE = "concat('d', CAST(page_id DIV 2 AS STRING), '-head-svc')"
ENDPOINTS_SQL = f"""candidates AS (
    SELECT 'd' || (page_id // 2) AS name, CASE WHEN url LIKE 'https:%' THEN 0 ELSE 1 END AS source, page_id,
      {HOST} AS host, {HOST} LIKE '%.net' AS tls FROM pages WHERE {HOST} <> ''),
  firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY source, page_id) AS n
    FROM candidates) WHERE n = 1),
  endpoints AS (
    SELECT 'fleet' AS namespace, 'd' || doc_id AS name, doc_id, lang,
      CASE WHEN host IS NOT NULL THEN CASE WHEN tls THEN 'https://' ELSE 'http://' END || host END AS dashboard_url
    FROM documents LEFT JOIN firsts ON firsts.name = 'd' || doc_id)"""


def _endpoints(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    routes = pages.where("url LIKE 'https:%'").selectExpr(
        "'fleet' AS namespace", "page_id AS pos", f"{SERVICE} AS to_name", f"{HOST} AS host",
        f"{HOST} LIKE '%.net' AS tls",
    )
    ingresses = pages.where("url NOT LIKE 'https:%'").selectExpr(
        "'fleet' AS namespace", "page_id AS pos",
        f"array(named_struct('host', {HOST}, 'backends', array('other', {SERVICE}))) AS rules",
        f"if({HOST} LIKE '%.net', array({HOST}), NULL) AS tls_hosts",
    )
    clusters = table(spark, sf_dir, "documents").selectExpr(
        "'fleet' AS namespace", "concat('d', CAST(doc_id AS STRING)) AS name", "doc_id", "lang"
    )
    return joins.resolve_endpoints(clusters, routes, ingresses)


@query("resolve_endpoints", f"WITH {ENDPOINTS_SQL} SELECT * FROM endpoints")
def resolve_endpoints(spark, sf_dir):
    return _endpoints(spark, sf_dir)


@query("resolve_endpoints_from_dumps", f"WITH {ENDPOINTS_SQL} SELECT * FROM endpoints")
def resolve_endpoints_from_dumps(spark, sf_dir):
    """Pages as route and ingress documents in lists of two; the order in a list decides."""
    tls = f"{HOST} LIKE '%.net'"
    route = f"""to_json(named_struct('metadata', named_struct('namespace', 'fleet'), 'spec', named_struct('host', {HOST},
      'to', named_struct('name', {SERVICE}), 'tls', if({tls}, map('termination', 'edge'), map()))))"""
    ingress = f"""to_json(named_struct('metadata', named_struct('namespace', 'fleet'), 'spec', named_struct(
      'tls', if({tls}, array(named_struct('hosts', array({HOST}))), NULL), 'rules', array(
        named_struct('host', '', 'http', NULL), named_struct('host', {HOST}, 'http', named_struct('paths', array(
          named_struct('backend', named_struct('service', named_struct('name', 'other'))),
          named_struct('backend', named_struct('service', named_struct('name', {SERVICE}))))))))))"""

    def documents(kind: str, text: str, which: str):
        pages = table(spark, sf_dir, "pages").where(which)
        pairs = pages.selectExpr("page_id DIV 2 AS list", "page_id", f"{text} AS raw").groupBy("list")
        listed = pairs.agg(F.sort_array(F.collect_list(F.struct("page_id", "raw"))).alias("docs"))
        items = F.array_join("docs.raw", ",")
        return parse_resources(listed.select(F.concat(F.lit('{"items":['), items, F.lit("]}")).alias("value")), kind)

    clusters = table(spark, sf_dir, "documents").selectExpr(
        "'fleet' AS namespace", "concat('d', CAST(doc_id AS STRING)) AS name", "doc_id", "lang"
    )
    return joins.resolve_endpoints(
        clusters,
        routes_of(documents("route", route, "url LIKE 'https:%'")),
        ingresses_of(documents("ingress", ingress, "url NOT LIKE 'https:%'")),
    )


@query(
    "endpoint_of_jobs",
    f"""WITH {ENDPOINTS_SQL} SELECT 'fleet' AS namespace, conv_id, turn,
      CASE WHEN role = 'system' THEN '' ELSE 'd' || conv_id END AS cluster_name, dashboard_url,
      CASE WHEN role = 'system' THEN 'job has no cluster name' END AS error
    FROM conversations LEFT JOIN endpoints ON name = CASE WHEN role = 'system' THEN '' ELSE 'd' || conv_id END""",
)
def endpoint_of_jobs(spark, sf_dir):
    jobs = table(spark, sf_dir, "conversations").selectExpr(
        "'fleet' AS namespace", "conv_id", "turn",
        "if(role = 'system', '', concat('d', CAST(conv_id AS STRING))) AS cluster_name",
    )
    return joins.endpoint_of_jobs(jobs, _endpoints(spark, sf_dir))


# Parts as hardware profiles of line items; returned lines name a profile that does not exist.
@query(
    "hardware_profiles",
    """SELECT l_orderkey, l_linenumber, l_partkey,
      CASE WHEN found THEN CAST(p_size + 1 AS VARCHAR) END AS cpu,
      CASE WHEN found AND p_size >= 10 THEN p_size || 'Gi' END AS memory,
      CASE WHEN found AND p_type = 'ECONOMY' THEN p_brand END AS brand,
      CASE WHEN found THEN CASE WHEN p_type = 'ECONOMY' THEN '[{"key":"ECONOMY"}]' ELSE '[]' END END AS tolerations,
      CASE WHEN found AND p_type = 'PROMO' THEN 'q-' || p_brand END AS queue,
      CASE WHEN found AND p_type = 'PROMO' AND p_size > 25 THEN 'high' END AS priority_class,
      CASE WHEN NOT found THEN 'hardware profile not found: gone' END AS profile_error
    FROM (SELECT *, l_returnflag <> 'R' AS found FROM lineitem) JOIN part ON l_partkey = p_partkey""",
)
def hardware_profiles(spark, sf_dir):
    identifiers = """array(named_struct('identifier', 'cpu', 'defaultCount', CAST(p_size AS STRING)),
      named_struct('identifier', 'memory', 'defaultCount', if(p_size < 10, '', concat(CAST(p_size AS STRING), 'Gi'))),
      named_struct('identifier', '', 'defaultCount', '1'),
      named_struct('identifier', 'cpu', 'defaultCount', CAST(p_size + 1 AS STRING)))"""
    scheduling = """named_struct('schedulingType',
        CASE p_type WHEN 'ECONOMY' THEN 'Node' WHEN 'PROMO' THEN 'Queue' ELSE 'Other' END,
      'node', named_struct('nodeSelector', map('brand', p_brand), 'tolerations', array(map('key', p_type))),
      'kueue', named_struct('localQueueName', concat('q-', p_brand), 'priorityClass', if(p_size > 25, 'high', NULL)))"""
    profiles = as_documents(
        spread_table(spark, sf_dir, "part"),
        "hardware_profile",
        metadata=F.expr("named_struct('name', CAST(p_partkey AS STRING))"),
        spec=F.expr(f"named_struct('identifiers', {identifiers}, 'scheduling', {scheduling})"),
    )
    requests = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey",
        "if(l_returnflag = 'R', 'gone', CAST(l_partkey AS STRING)) AS hardware_profile",
    )
    parts = parts_for(table(spark, sf_dir, "lineitem"))
    return joins.apply_hardware_profiles(requests, profiles, partitions=parts).selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "resources['cpu'] AS cpu", "resources['memory'] AS memory",
        "node_selector['brand'] AS brand", "to_json(tolerations) AS tolerations", "queue", "priority_class",
        "profile_error",
    )


# Customers as cluster requests with a preset by market segment.
PRESET = """CASE c_mktsegment WHEN 'MACHINERY' THEN 'dev' WHEN 'BUILDING' THEN 'gpu-single'
  WHEN 'AUTOMOBILE' THEN 'data-processing' WHEN 'HOUSEHOLD' THEN 'nope' ELSE NULL END"""


@query(
    "apply_presets",
    f"""WITH presets(name, w, hc, hm, wc, wm, wg) AS (VALUES ('dev', 1, 1.0, '2Gi', 1.0, '2Gi', 0),
      ('gpu-single', 1, 2.0, '4Gi', 4.0, '8Gi', 1), ('data-processing', 4, 2.0, '4Gi', 2.0, '4Gi', 0)),
    requests AS (SELECT *, {PRESET} AS preset, CASE WHEN c_nationkey < 13 THEN 1 ELSE c_nationkey END AS given,
      CASE WHEN c_acctbal < 0 THEN 3.5 ELSE 1.0 END AS cpus FROM customer)
    SELECT c_custkey, preset,
      CASE WHEN name IS NOT NULL AND given = 1 THEN w ELSE given END AS workers,
      CAST(CASE WHEN name IS NOT NULL AND cpus = 1 THEN wc ELSE cpus END AS DOUBLE) AS cpus_per_worker,
      coalesce(wg, 0) AS gpus_per_worker,
      CASE WHEN c_nationkey = 3 THEN '3Gi' ELSE coalesce(wm, '2Gi') END AS memory_per_worker,
      CAST(hc AS DOUBLE) AS head_cpus, hm AS head_memory,
      CASE WHEN c_nationkey = 5 THEN '2.9.0' WHEN name IS NOT NULL THEN '2.41.0' END AS ray_version,
      CASE WHEN preset = 'nope' THEN 'unknown preset: nope' END AS preset_error
    FROM requests LEFT JOIN presets ON preset = name""",
)
def apply_presets(spark, sf_dir):
    requests = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", f"{PRESET} AS preset", "if(c_nationkey < 13, 1, c_nationkey) AS workers",
        "CAST(if(c_acctbal < 0, 3.5, NULL) AS DOUBLE) AS cpus_per_worker", "0 AS gpus_per_worker",
        "if(c_nationkey = 3, '3Gi', '2Gi') AS memory_per_worker",
        """CAST(NULL AS struct<cpus:double,memory:string,gpus:int,ray_start_params:map<string,string>>) AS head""",
        "if(c_nationkey = 5, '2.9.0', NULL) AS ray_version",
    )
    filled = joins.apply_presets(requests, joins.builtin_presets(spark))
    return filled.select(
        "c_custkey", "preset", "workers", "cpus_per_worker", "gpus_per_worker", "memory_per_worker",
        F.col("head.cpus").alias("head_cpus"), F.col("head.memory").alias("head_memory"),
        "ray_version", "preset_error",
    )


# Customers as clusters with as many worker groups as a fifth of their nation number.
@query(
    "plan_scale",
    """WITH requests AS (SELECT c_custkey AS name, lower(c_mktsegment) AS namespace,
      CAST(floor(c_acctbal / 1000) AS INTEGER) AS workers, c_nationkey // 5 AS n FROM customer),
    grouped AS (SELECT *, CAST(unnest(range(n)) AS INTEGER) AS pos FROM requests)
    SELECT namespace, name, pos, 'g' || pos AS group_name,
      CAST(CASE WHEN pos = 0 THEN workers ELSE n END AS INTEGER) AS replicas,
      CAST(CASE WHEN pos = 0 THEN workers ELSE n END AS INTEGER) AS min_replicas,
      CAST(CASE WHEN pos = 0 THEN workers ELSE n + 1 END AS INTEGER) AS max_replicas,
      CAST(NULL AS VARCHAR) AS error
    FROM grouped WHERE workers >= 1
    UNION ALL
    SELECT namespace, name, 0, 'default-workers', workers, workers, workers, NULL
    FROM requests WHERE workers >= 1 AND n = 0
    UNION ALL
    SELECT namespace, name, NULL, NULL, NULL, NULL, NULL, 'workers must be at least 1'
    FROM requests WHERE workers < 1""",
)
def plan_scale(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    key = ["c_custkey AS name", "lower(c_mktsegment) AS namespace"]
    requests = customers.selectExpr(*key, "CAST(floor(c_acctbal / 1000) AS INT) AS workers")
    groups = (
        customers.where("c_nationkey >= 5")
        .selectExpr(*key, "CAST(c_nationkey DIV 5 AS INT) AS n")
        .selectExpr("name", "namespace", "n", "explode(sequence(0, n - 1)) AS pos")
        .selectExpr(
            "name", "namespace", "pos", "concat('g', CAST(pos AS STRING)) AS group_name",
            "n AS replicas", "n AS min_replicas", "n + 1 AS max_replicas",
        )
    )
    return joins.plan_scale(requests, groups)


# Customers as requests from preset to outcome. Names of one nation are invalid; clusters of the
# first ten nations exist already, with one worker more where the account is overdrawn.
@query(
    "deployment_outcomes",
    """SELECT lower(c_mktsegment) AS namespace, 'c' || c_custkey AS name,
      CASE WHEN c_nationkey >= 10 THEN 'CREATE' WHEN c_acctbal < 0 THEN 'CONFLICT' ELSE 'UNCHANGED' END AS outcome
    FROM customer WHERE c_nationkey <> 7 AND c_mktsegment <> 'HOUSEHOLD'""",
)
def deployment_outcomes(spark, sf_dir):
    """Presets, validation, desired state with overrides, and reconciliation in one plan."""
    customers = table(spark, sf_dir, "customer").selectExpr(
        "lower(c_mktsegment) AS namespace", "concat(if(c_nationkey = 7, 'C-', 'c'), CAST(c_custkey AS STRING)) AS name",
        "c_nationkey", "c_acctbal", f"{PRESET} AS preset", "2 + c_nationkey % 3 AS workers", "1.0D AS cpus_per_worker",
        "0 AS gpus_per_worker", "'2Gi' AS memory_per_worker",
        "CAST(NULL AS struct<cpus:double,memory:string,gpus:int,ray_start_params:map<string,string>>) AS head",
        "CAST(NULL AS STRING) AS ray_version",
        """if(c_nationkey % 2 = 0, '{"spec": {"suspend": true}}', NULL) AS raw_overrides""",
    )
    # The documents of few bytes take long to render and merge: dealt over all cores, however the table is cut.
    parts = 2 * spark.sparkContext.defaultParallelism
    customers = customers.repartition(parts)
    requests = joins.apply_presets(customers, joins.builtin_presets(spark)).where("preset_error IS NULL")
    keys = ["namespace", "name"]
    valid = requests.join(validate(requests, "cluster").select(*keys).distinct(), keys, "left_anti").repartition(parts)
    present = valid.where("c_nationkey < 10").withColumn("workers", F.expr("workers + if(c_acctbal < 0, 1, 0)"))
    return joins.reconcile(overlay.desired_state(valid, "cluster"), overlay.desired_state(present, "cluster"))

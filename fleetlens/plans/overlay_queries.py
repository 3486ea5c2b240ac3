"""Overlays, layered settings, desired-state tables and validation over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.functions.documents import merge_env, queue_labels, tracking_env
from fleetlens.operators import overlay
from fleetlens.operators.validation import RULES, validate
from fleetlens.plans.bindings import parts_for, spread_table, table
from fleetlens.plans.registry import query

# Orders as documents in leaf form, and overrides chosen by their status and priority.
BASE_LEAVES = """array(
  named_struct('path', 'spec/workers', 'value', CAST(o_custkey AS STRING)),
  named_struct('path', 'spec/head/cpu', 'value', '1'),
  named_struct('path', 'spec/head/memory', 'value', '2Gi'),
  named_struct('path', 'spec/labels', 'value', '{}'),
  named_struct('path', 'metadata/owner', 'value', o_orderpriority))"""
OVERRIDE_LEAVES = """CASE o_orderpriority
  WHEN '1-URGENT' THEN array(named_struct('path', 'spec/head', 'value', '[]'),
    named_struct('path', 'spec/labels/tier', 'value', o_orderstatus))
  WHEN '2-HIGH' THEN array(named_struct('path', 'spec/workers/max', 'value', '9'),
    named_struct('path', 'spec/head', 'value', '{}'))
  WHEN '3-MEDIUM' THEN array(named_struct('path', 'metadata/owner', 'value', '{}'),
    named_struct('path', 'spec/labels', 'value', '{}'))
  WHEN '4-NOT SPECIFIED' THEN array(named_struct('path', 'spec/head/cpu', 'value', 'null'),
    named_struct('path', 'extra', 'value', '{}'))
  ELSE CAST(array() AS array<struct<path: string, value: string>>) END"""

MERGED_SQL = """SELECT o_orderkey AS id, path, value FROM (
  SELECT o_orderkey, o_custkey, o_orderpriority AS p, o_orderstatus, unnest([
    {'path': 'spec/workers', 'value': CASE WHEN p <> '2-HIGH' THEN CAST(o_custkey AS VARCHAR) END},
    {'path': 'spec/workers/max', 'value': CASE WHEN p = '2-HIGH' THEN '9' END},
    {'path': 'spec/head/cpu', 'value': CASE WHEN p = '1-URGENT' THEN NULL
        WHEN p = '4-NOT SPECIFIED' THEN 'null' ELSE '1' END},
    {'path': 'spec/head/memory', 'value': CASE WHEN p <> '1-URGENT' THEN '2Gi' END},
    {'path': 'spec/head', 'value': CASE WHEN p = '1-URGENT' THEN '[]' END},
    {'path': 'spec/labels', 'value': CASE WHEN p <> '1-URGENT' THEN '{}' END},
    {'path': 'spec/labels/tier', 'value': CASE WHEN p = '1-URGENT' THEN o_orderstatus END},
    {'path': 'metadata/owner', 'value': CASE WHEN p = '3-MEDIUM' THEN '{}' ELSE p END},
    {'path': 'extra', 'value': CASE WHEN p = '4-NOT SPECIFIED' THEN '{}' END}], recursive := true)
  FROM orders) WHERE value IS NOT NULL"""


@query("deep_merge", MERGED_SQL)
def deep_merge(spark, sf_dir):
    orders = spread_table(spark, sf_dir, "orders")
    base = orders.selectExpr("o_orderkey AS id", f"inline({BASE_LEAVES})")
    override = orders.selectExpr("o_orderkey AS id", f"inline({OVERRIDE_LEAVES})")
    return overlay.deep_merge(base, override, partitions=parts_for(table(spark, sf_dir, "orders"), 7))


@query("deep_merge_cut", MERGED_SQL)
def deep_merge_cut(spark, sf_dir):
    """The same documents, each cut by the first two steps of its paths."""
    orders = spread_table(spark, sf_dir, "orders")
    base = orders.selectExpr("o_orderkey AS id", f"inline({BASE_LEAVES})")
    override = orders.selectExpr("o_orderkey AS id", f"inline({OVERRIDE_LEAVES})")
    return overlay.deep_merge(base, override, steps=2, partitions=parts_for(table(spark, sf_dir, "orders"), 7))


@query("merge_leaves", MERGED_SQL)
def merge_leaves(spark, sf_dir):
    docs = spread_table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS id", f"{BASE_LEAVES} AS base", f"{OVERRIDE_LEAVES} AS override"
    )
    merged = overlay.merge_leaves(F.col("base"), F.col("override"))
    return docs.select("id", F.inline(merged))


# Customers as settings records: defaults for all, file and environment values for some,
# an explicit record for one market segment.
@query(
    "resolve_settings",
    """WITH layers AS (
      SELECT c_custkey AS id, 0 AS precedence, 'default' AS layer, 'retry_timeout' AS key, '60.0' AS value FROM customer
      UNION ALL SELECT c_custkey, 0, 'default', 'namespace', NULL FROM customer
      UNION ALL SELECT c_custkey, 1, 'file', 'retry_timeout', CAST(c_nationkey AS VARCHAR) FROM customer
        WHERE c_nationkey > 9
      UNION ALL SELECT c_custkey, 1, 'file', 'namespace', 'from-file' FROM customer WHERE c_acctbal > 0
      UNION ALL SELECT c_custkey, 2, 'env', 'namespace', CASE WHEN c_nationkey > 4 THEN 'from-env' END FROM customer
      UNION ALL SELECT c_custkey, 3, 'explicit', 'namespace', CASE WHEN c_nationkey > 14 THEN 'given' END
        FROM customer WHERE c_mktsegment = 'BUILDING'),
    counted AS (SELECT * FROM layers WHERE value IS NOT NULL AND (layer IN ('explicit', 'default')
      OR id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')))
    SELECT id, key, max_by(value, precedence) AS value, max_by(layer, precedence) AS layer
    FROM counted GROUP BY id, key""",
)
def resolve_settings(spark, sf_dir):
    given = F.expr(
        """array(
          named_struct('precedence', 0, 'layer', 'default', 'key', 'retry_timeout', 'value', '60.0'),
          named_struct('precedence', 0, 'layer', 'default', 'key', 'namespace', 'value', NULL),
          if(c_nationkey > 9, named_struct('precedence', 1, 'layer', 'file', 'key', 'retry_timeout',
            'value', CAST(c_nationkey AS STRING)), NULL),
          if(c_acctbal > 0, named_struct('precedence', 1, 'layer', 'file', 'key', 'namespace',
            'value', 'from-file'), NULL),
          named_struct('precedence', 2, 'layer', 'env', 'key', 'namespace',
            'value', if(c_nationkey > 4, 'from-env', NULL)),
          if(c_mktsegment = 'BUILDING', named_struct('precedence', 3, 'layer', 'explicit', 'key', 'namespace',
            'value', if(c_nationkey > 14, 'given', NULL)), NULL))"""
    )
    layers = (
        table(spark, sf_dir, "customer")
        .select(F.col("c_custkey").alias("id"), F.explode(given).alias("layer"))
        .where("layer IS NOT NULL")
        .select("id", "layer.*")
    )
    return overlay.resolve_settings(layers)


@query(
    "merge_env",
    """SELECT p_partkey, 'type' AS key, CASE WHEN p_size > 20 THEN p_brand ELSE p_type END AS value FROM part
    UNION ALL SELECT p_partkey, 'size', CAST(p_size AS VARCHAR) FROM part
    UNION ALL SELECT p_partkey, 'name', p_name FROM part WHERE p_size > 20""",
)
def merge_envs(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    base = F.expr("map('type', p_type, 'size', CAST(p_size AS STRING))")
    extra = F.expr("if(p_size > 20, map('name', p_name, 'type', p_brand), NULL)")
    return part.select("p_partkey", F.explode(merge_env(base, extra)))


@query(
    "tracking_env",
    """SELECT c_custkey, 'MLFLOW_TRACKING_URI' AS key,
      CASE WHEN c_acctbal > 5000 THEN 'override' ELSE 'http://t/' || c_nationkey END AS value FROM customer
    UNION ALL SELECT c_custkey, 'MLFLOW_EXPERIMENT_NAME', c_mktsegment FROM customer WHERE c_nationkey > 6
    UNION ALL SELECT c_custkey, 'EXTRA', c_name FROM customer""",
)
def tracking_envs(spark, sf_dir):
    env = tracking_env(
        F.expr("concat('http://t/', CAST(c_nationkey AS STRING))"),
        F.expr("if(c_nationkey > 6, c_mktsegment, '')"),
        F.expr("if(c_acctbal > 5000, map('EXTRA', c_name, 'MLFLOW_TRACKING_URI', 'override'), map('EXTRA', c_name))"),
    )
    return table(spark, sf_dir, "customer").select("c_custkey", F.explode(env))


@query(
    "queue_labels",
    """SELECT s_suppkey, 'app' AS key, 'fleet' AS value FROM supplier
    UNION ALL SELECT s_suppkey, 'kueue.x-k8s.io/queue-name', 'q' || s_nationkey FROM supplier
    UNION ALL SELECT s_suppkey, 'kueue.x-k8s.io/priority-class', 'high' FROM supplier WHERE s_acctbal > 0""",
)
def labels_of_queues(spark, sf_dir):
    labels = queue_labels(
        F.expr("map('app', 'fleet', 'kueue.x-k8s.io/queue-name', 'old')"),
        F.expr("concat('q', CAST(s_nationkey AS STRING))"),
        F.expr("if(s_acctbal > 0, 'high', NULL)"),
    )
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.explode(labels))


# Line items as cluster requests: those not returned are flat, the rest list two groups.
GROUPS = """if(l_returnflag = 'N', NULL, array(
  named_struct('name', 'a', 'replicas', l_linenumber, 'cpus', CAST(l_quantity AS DOUBLE) / 4, 'gpus', NULL,
    'memory', '4Gi', 'min_replicas', NULL, 'max_replicas', if(l_linestatus = 'F', CAST(l_quantity AS INT), NULL),
    'gpu_type', NULL, 'ray_start_params', NULL),
  named_struct('name', if(l_linestatus = 'F', 'a', 'b'), 'replicas', CAST(l_quantity AS INT) - 1, 'cpus', NULL,
    'gpus', l_linenumber, 'memory', NULL, 'min_replicas', 1, 'max_replicas', 40,
    'gpu_type', if(l_linestatus = 'F', 'amd.com/gpu', NULL), 'ray_start_params', map('k', 'v'))))"""


def _requests(spark, sf_dir):
    return spread_table(spark, sf_dir, "lineitem").selectExpr(
        "CAST(l_orderkey AS STRING) AS namespace", "concat('r', CAST(l_partkey AS STRING)) AS name",
        "if(l_returnflag = 'N', l_linenumber, NULL) AS workers", "CAST(NULL AS DOUBLE) AS cpus_per_worker",
        "if(l_returnflag = 'N', 2, NULL) AS gpus_per_worker", "CAST(NULL AS STRING) AS memory_per_worker",
        f"{GROUPS} AS worker_groups", "if(l_linestatus = 'F', '2.9.0', NULL) AS ray_version",
        "if(l_returnflag = 'A', 'img:1', NULL) AS image",
    )


GROUPS_SQL = """groups AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS namespace, 'r' || l_partkey AS name, 0 AS pos,
      CASE WHEN l_returnflag = 'N' THEN 'default-workers' ELSE 'a' END AS group_name, l_linenumber AS replicas,
      l_linenumber AS min_replicas,
      CASE WHEN l_returnflag <> 'N' AND l_linestatus = 'F' THEN CAST(l_quantity AS INTEGER) ELSE l_linenumber END
        AS max_replicas,
      CASE WHEN l_returnflag = 'N' THEN 1.0::DOUBLE ELSE l_quantity / 4 END AS cpus,
      CASE WHEN l_returnflag = 'N' THEN 2 ELSE 0 END AS gpus,
      CASE WHEN l_returnflag = 'N' THEN '2Gi' ELSE '4Gi' END AS memory, CAST(NULL AS VARCHAR) AS gpu_type
    FROM lineitem
    UNION ALL
    SELECT CAST(l_orderkey AS VARCHAR), 'r' || l_partkey, 1, CASE WHEN l_linestatus = 'F' THEN 'a' ELSE 'b' END,
      CAST(l_quantity AS INTEGER) - 1, 1, 40, 1.0, l_linenumber, '2Gi',
      CASE WHEN l_linestatus = 'F' THEN 'amd.com/gpu' END
    FROM lineitem WHERE l_returnflag <> 'N')"""


@query("normalize_worker_groups", f"WITH {GROUPS_SQL} SELECT * FROM groups")
def normalize_worker_groups(spark, sf_dir):
    return overlay.normalize_worker_groups(_requests(spark, sf_dir))


@query(
    "desired_state",
    """SELECT CAST(l_orderkey AS VARCHAR) AS namespace, 'r' || l_partkey AS name,
      CASE WHEN l_linestatus = 'F' THEN '2.9.0' ELSE '2.41.0' END AS version,
      CASE WHEN l_returnflag = 'A' THEN 'img:1' WHEN l_linestatus = 'F' THEN 'rayproject/ray:2.9.0'
        ELSE 'rayproject/ray:2.41.0' END AS image,
      '{"cpu":"1","memory":"2Gi"}' AS head_resources,
      CASE WHEN l_returnflag = 'N' THEN '1' WHEN l_quantity % 4 = 0 THEN CAST(CAST(l_quantity // 4 AS BIGINT) AS VARCHAR)
        ELSE CAST(l_quantity / 4 AS VARCHAR) END AS worker_cpu,
      CASE WHEN l_returnflag = 'N' THEN '{"cpu":"1","memory":"2Gi","nvidia.com/gpu":"2"}' END AS flat_limits,
      CASE WHEN l_returnflag = 'N' THEN NULL
        ELSE '{"cpu":"1","memory":"2Gi","' || CASE WHEN l_linestatus = 'F' THEN 'amd.com/gpu' ELSE 'nvidia.com/gpu' END
          || '":"' || l_linenumber || '"}' END AS second_limits,
      l_linenumber AS replicas FROM lineitem""",
)
def desired_state(spark, sf_dir):
    rows = overlay.desired_state(_requests(spark, sf_dir), "cluster")
    # Only the parts that are shown: a part read as text is written anew by the parser.
    pod = "struct<spec:struct<containers:array<struct<{0}>>>>"
    read = f"""struct<rayVersion:string,headGroupSpec:struct<template:{pod.format('resources:struct<requests:string>')}>,
      workerGroupSpecs:array<struct<groupName:string,replicas:int,
        template:{pod.format('image:string,resources:struct<limits:string>')}>>>"""
    group = "spec.workerGroupSpecs[{0}]"
    box = group + ".template.spec.containers[0]"
    return rows.select("namespace", "name", F.from_json("spec", read).alias("spec")).selectExpr(
        "namespace", "name", "spec.rayVersion AS version", f"{box.format(0)}.image AS image",
        "spec.headGroupSpec.template.spec.containers[0].resources.requests AS head_resources",
        f"get_json_object({box.format(0)}.resources.limits, '$.cpu') AS worker_cpu",
        f"if({group.format(0)}.groupName = 'default-workers', {box.format(0)}.resources.limits, NULL) AS flat_limits",
        "get(spec.workerGroupSpecs, 1).template.spec.containers[0].resources.limits AS second_limits",
        f"{group.format(0)}.replicas AS replicas",
    )


@query(
    "desired_state_jobs",
    """WITH requests AS (SELECT *, o_orderstatus = 'O' AND o_orderpriority = '5-LOW' AS broken FROM orders)
    SELECT CASE WHEN o_orderstatus = 'P' THEN 'moved' ELSE o_orderpriority END AS namespace, 'j' || o_orderkey AS name,
      CASE WHEN NOT broken THEN 'run ' || o_orderstatus END AS entrypoint,
      CASE WHEN o_orderstatus = 'F' THEN 'q' END AS queue_label, CASE WHEN NOT broken THEN 'true' END AS shutdown,
      CASE WHEN o_orderstatus = 'F' THEN '{"TOKEN":"old","MLFLOW_TRACKING_URI":"http://t"}'
        WHEN o_orderstatus = 'O' AND NOT broken THEN '{"TOKEN":"old"}' END AS env,
      CASE WHEN o_orderstatus = 'P' THEN '7' WHEN NOT broken THEN '1' END AS replicas,
      CASE WHEN o_orderstatus = 'P' THEN 'x' END AS label, CASE WHEN o_orderstatus = 'P' THEN 'y' END AS note,
      CASE WHEN o_orderstatus = 'P' THEN '["keep"]' END AS finalizers,
      CASE WHEN o_orderstatus = 'P' THEN 'v2' WHEN NOT broken THEN 'ray.io/v1' END AS version,
      CASE WHEN broken THEN 'raw_overrides is no JSON object' END AS override_error
    FROM requests""",
)
def desired_state_jobs(spark, sf_dir):
    requests = spread_table(spark, sf_dir, "orders").selectExpr(
        "o_orderpriority AS namespace", "concat('j', CAST(o_orderkey AS STRING)) AS name",
        "concat('run ', o_orderstatus) AS entrypoint", "if(o_orderstatus = 'F', 'q', '') AS queue",
        "1 AS workers", "1.0D AS cpus_per_worker", "0 AS gpus_per_worker", "'2Gi' AS memory_per_worker",
        f"""if(o_orderstatus = 'P', NULL, named_struct('pip', CAST(NULL AS array<string>), 'conda', CAST(NULL AS STRING),
          'env_vars', map('TOKEN', 'old'), 'working_dir', '', 'py_modules', CAST(NULL AS array<string>))) AS runtime_env""",
        """if(o_orderstatus = 'F', named_struct('provider', 'mlflow', 'tracking_uri', 'http://t',
          'experiment_name', CAST(NULL AS STRING), 'env_vars', CAST(NULL AS map<string,string>)), NULL)
          AS experiment_tracking""",
        """CASE WHEN o_orderstatus = 'P' THEN '{"apiVersion": "v2", "metadata": {"namespace": "moved", "labels":
          {"label": "x"}, "annotations": {"note": "y"}, "finalizers": ["keep"]}, "spec": {"rayClusterSpec":
          {"workerGroupSpecs": [{"replicas": 7}]}}}'
          WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN '{"spec": ' END AS raw_overrides""",
    )
    rows = overlay.desired_state(requests, "job")
    env = F.get_json_object(F.get_json_object("spec", "$.runtimeEnvYAML"), "$.env_vars")
    return rows.select(
        "namespace", "name", F.get_json_object("spec", "$.entrypoint").alias("entrypoint"),
        F.col("labels")["kueue.x-k8s.io/queue-name"].alias("queue_label"),
        F.get_json_object("spec", "$.shutdownAfterJobFinishes").alias("shutdown"), env.alias("env"),
        F.get_json_object("spec", "$.rayClusterSpec.workerGroupSpecs[0].replicas").alias("replicas"),
        F.col("labels")["label"].alias("label"), F.col("annotations")["note"].alias("note"),
        F.get_json_object("document", "$.metadata.finalizers").alias("finalizers"),
        F.get_json_object("document", "$.apiVersion").alias("version"), "override_error",
    )


@query(
    "desired_state_services",
    """SELECT lower(p_brand) AS namespace, 's' || p_partkey AS name,
      CASE WHEN p_size > 25 THEN 'applications: []' ELSE '{"applications":[{"name":"default","import_path":"' || p_name
        || '","deployments":[{"name":"default","num_replicas":' || p_size || '}]}]}' END AS serve_config,
      CAST(p_size AS INTEGER) AS replicas FROM part""",
)
def desired_state_services(spark, sf_dir):
    requests = table(spark, sf_dir, "part").selectExpr(
        "lower(p_brand) AS namespace", "concat('s', CAST(p_partkey AS STRING)) AS name",
        "if(p_size > 25, NULL, p_name) AS import_path", "p_size AS num_replicas",
        "if(p_size > 25, 'applications: []', NULL) AS serve_config_v2", "p_size AS workers",
        "1.0D AS cpus_per_worker", "0 AS gpus_per_worker", "'2Gi' AS memory_per_worker",
    )
    rows = overlay.desired_state(requests, "service")
    return rows.select(
        "namespace", "name", F.get_json_object("spec", "$.serveConfigV2").alias("serve_config"),
        F.get_json_object("spec", "$.rayClusterConfig.workerGroupSpecs[0].replicas").cast("int").alias("replicas"),
    )


# Parts as requests with one or two volumes.
VOLUMES = """array(
  named_struct('name', p_name, 'mount_path', if(p_size > 45, 'data', '/data'),
    'size', if(p_type = 'PROMO', NULL, concat(CAST(p_size AS STRING), 'Gi')),
    'existing_claim', if(p_type IN ('PROMO', 'LARGE'), p_brand, if(p_type = 'SMALL', '', NULL)),
    'access_mode', if(p_size < 5, 'WriteOnly', 'ReadWriteMany'),
    'storage_class', if(p_brand = 'Brand#1', 'fast', '')))"""


@query(
    "claims",
    """SELECT lower(p_type) AS namespace, p_name AS claim_name,
      CASE WHEN p_size < 5 THEN 'WriteOnly' ELSE 'ReadWriteMany' END AS access_mode, p_size || 'Gi' AS size,
      CASE WHEN p_brand = 'Brand#1' THEN 'fast' END AS storage_class
    FROM part WHERE p_type NOT IN ('PROMO', 'LARGE')""",
)
def claims(spark, sf_dir):
    requests = table(spark, sf_dir, "part").selectExpr("lower(p_type) AS namespace", f"{VOLUMES} AS storage")
    return overlay.claims(requests)


MESSAGES = {rule.rule_id: "'" + rule.message.replace("'", "''") + "'" for rule in RULES}


def _rule_rows(source: str, kind: str, key: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, {key} AS name, '{rule}' AS rule_id, {MESSAGES[rule]} AS message FROM {source} WHERE {broken}"
        for rule, broken in rules.items()
    )


def _violations(requests, kind):
    return validate(requests, kind, ("name",))


@query(
    "validate_clusters",
    _rule_rows(
        "(SELECT *, CAST(l_quantity AS INTEGER) AS q, l_returnflag <> 'N' AS g FROM lineitem)", "cluster",
        "CASE WHEN l_linenumber % 2 = 0 THEN 'C-' ELSE 'c-' END || l_partkey",
        {
            "V01": "l_linenumber % 2 = 0",
            "V02": "g AND q - 1 < 1",
            "V03": "g AND ((l_linestatus = 'F' AND q < l_linenumber) OR q - 1 < 1 OR q - 1 > 40)",
            "V04": "l_linenumber - 1 < 1",
            "V05": "l_tax > 0.05 AND l_discount <= 0",
            "V06": "l_tax = 0.02 AND 2 - l_linenumber < 0",
            "V07": "g AND (l_tax > 0.05 OR l_tax = 0.02 OR l_linestatus <> 'F')",
            "V18": "false",
            "V22": "g AND l_linestatus = 'F'",
        },
    ),
)
def validate_clusters(spark, sf_dir):
    requests = spread_table(spark, sf_dir, "lineitem").selectExpr(
        "concat(if(l_linenumber % 2 = 0, 'C-', 'c-'), CAST(l_partkey AS STRING)) AS name", "CAST(NULL AS STRING) AS namespace",
        "l_linenumber - 1 AS workers", "if(l_tax > 0.05, l_discount, NULL) AS cpus_per_worker",
        "if(l_tax = 0.02, 2 - l_linenumber, NULL) AS gpus_per_worker", "CAST(NULL AS STRING) AS memory_per_worker",
        f"{GROUPS} AS worker_groups", "if(l_linestatus = 'F', '2.9.0', NULL) AS ray_version", "'q' AS queue",
    )
    return _violations(requests, "cluster")


@query(
    "validate_jobs",
    _rule_rows(
        "orders JOIN customer ON o_custkey = c_custkey", "job", "'j-' || o_orderkey",
        {
            "V08": "c_nationkey > 3 AND o_orderstatus = 'F'",
            "V09": "o_orderstatus = 'O'",
            "V10": "o_orderpriority = '1-URGENT' AND c_nationkey < 9",
            "V16": "c_nationkey > 20",
            "V17": "c_mktsegment <> 'BUILDING'",
            "V18": "o_orderpriority = '1-URGENT' AND c_nationkey > 7",
            "V22": "c_nationkey > 3",
        },
    ),
)
def validate_jobs(spark, sf_dir):
    group = "named_struct('name', 'g', 'replicas', 1, 'min_replicas', CAST(NULL AS INT), 'max_replicas', 1)"
    requests = (
        table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
    ).selectExpr(
        "concat('j-', CAST(o_orderkey AS STRING)) AS name", "'ns' AS namespace", "'2.9.0' AS ray_version",
        "if(o_orderstatus = 'O', ' ', 'run') AS entrypoint", "1 AS workers",
        "if(o_orderstatus = 'F', 1.0D, NULL) AS cpus_per_worker", "CAST(NULL AS INT) AS gpus_per_worker",
        "CAST(NULL AS STRING) AS memory_per_worker",
        f"if(c_nationkey > 3, array_repeat({group}, c_nationkey), NULL) AS worker_groups",
        "if(o_orderpriority = '1-URGENT', 'q', '') AS queue", "c_nationkey >= 9 AS shutdown_after_finish",
        "named_struct('pip', if(c_nationkey > 20, array('torch'), array()), 'conda', 'env') AS runtime_env",
        "named_struct('provider', if(c_mktsegment = 'BUILDING', 'mlflow', 'other')) AS experiment_tracking",
    )
    return _violations(requests, "job")


@query(
    "validate_services",
    _rule_rows(
        "part", "service", "CASE WHEN p_size > 25 THEN 'S ' ELSE 's' END || p_partkey",
        {
            "V01": "p_size > 25",
            "V11": "p_type IN ('PROMO', 'LARGE')",
            "V12": "p_size - 5 < 1",
            "V13": "p_type = 'LARGE'",
            "V14": "p_size > 45",
            "V15": "p_size < 5",
        },
    ),
)
def validate_services(spark, sf_dir):
    requests = table(spark, sf_dir, "part").selectExpr(
        "concat(if(p_size > 25, 'S ', 's'), CAST(p_partkey AS STRING)) AS name",
        "if(p_type = 'PROMO', '', 'app:main') AS import_path",
        "if(p_type = 'LARGE', 'applications: []', NULL) AS serve_config_v2", "p_size - 5 AS num_replicas",
        f"{VOLUMES} AS storage",
    )
    return _violations(requests, "service")


@query(
    "validate_settings",
    _rule_rows("supplier", "settings", "s_name",
               {"V19": "s_nationkey - 3 < 0 OR s_acctbal <= 0 OR s_acctbal - 1000 <= 0"})
    + " UNION ALL "
    + _rule_rows("supplier", "settings_text", "s_name", {"V20": "s_nationkey > 11 OR s_acctbal < 0"}),
)
def validate_settings(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier")
    typed = suppliers.selectExpr(
        "s_name AS name", "s_nationkey - 3 AS retry_max_attempts", "s_acctbal AS retry_backoff_factor",
        "s_acctbal - 1000 AS retry_timeout",
    )
    texts = suppliers.selectExpr(
        "s_name AS name", "if(s_nationkey > 11, '1.5', '3') AS retry_max_attempts",
        "if(s_acctbal < 0, 'fast', '0.5') AS retry_backoff_factor", "CAST(NULL AS STRING) AS retry_timeout",
    )
    return _violations(typed, "settings").unionByName(_violations(texts, "settings_text"))


@query(
    "validate_manifests",
    _rule_rows("events", "manifest", "event_id", {"V21": "event_type NOT IN ('view', 'click')"}),
)
def validate_manifests(spark, sf_dir):
    manifest = """CASE event_type
      WHEN 'view' THEN '{"apiVersion": "v1", "kind": "k", "metadata": {}, "spec": {}}'
      WHEN 'click' THEN '{"spec": null, "kind": "k", "metadata": {}, "apiVersion": "v1", "status": 1}'
      WHEN 'error' THEN 'no json' ELSE '{"apiVersion": "v1", "kind": "k", "metadata": {}}' END"""
    requests = table(spark, sf_dir, "events").selectExpr("event_id AS name", f"{manifest} AS manifest")
    return _violations(requests, "manifest")

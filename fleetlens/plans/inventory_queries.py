"""Inventory, capability, error and utilisation queries over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.operators import errors, inventory, series, summary
from fleetlens.plans.bindings import as_documents, table
from fleetlens.plans.registry import query
from fleetlens.sources.readers import available_resources

# Parts as node resources and API types of the brands' fleets. Some fleets fail to list.
RESOURCE = "if(p_type IN ('ECONOMY', 'PROMO'), concat(lower(p_type), '.com/GPU-', CAST(p_size AS STRING)), p_type)"
RESOURCE_SQL = "CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN lower(p_type) || '.com/GPU-' || p_size ELSE p_type END"
QUANTITY = "CASE WHEN p_size < 10 THEN '0' WHEN p_size < 15 THEN '' ELSE '4' END"
NODE_STATUS = "CASE p_brand WHEN 'Brand#3' THEN 403 WHEN 'Brand#4' THEN 500 ELSE NULL END"
TYPE_NAME = """CASE p_type WHEN 'ECONOMY' THEN 'rayclusters.ray.io' WHEN 'PROMO' THEN 'rayjobs.ray.io'
  WHEN 'LARGE' THEN 'rayservices.ray.io' WHEN 'SMALL' THEN 'workloads.kueue.x-k8s.io'
  WHEN 'MEDIUM' THEN 'routes.route.openshift.io' ELSE 'other.example.io' END"""
TYPE_STATUS = "CASE p_brand WHEN 'Brand#5' THEN 401 WHEN 'Brand#6' THEN 503 ELSE NULL END"


def nodes(spark, sf_dir):
    return table(spark, sf_dir, "part").selectExpr(
        "p_brand AS cluster", "CAST(p_partkey AS STRING) AS node", f"{RESOURCE} AS resource",
        f"{QUANTITY} AS quantity", f"{NODE_STATUS} AS http_status",
    )


def api_types(spark, sf_dir):
    """Fleets are finer than brands here, so that some lack API types."""
    return table(spark, sf_dir, "part").selectExpr(
        "concat(p_brand, '/', CAST(p_size AS STRING)) AS cluster",
        f"{TYPE_NAME} AS crd_name",
        "if(p_retailprice < 1000, map('app.kubernetes.io/version', concat('v', p_name)), NULL) AS labels",
        "map('controller-gen.kubebuilder.io/version', concat('a', p_name)) AS annotations",
        f"{TYPE_STATUS} AS http_status",
    )


GPU_SQL = f"""SELECT cluster,
  CASE WHEN bool_or(failed) THEN '' ELSE coalesce(string_agg(DISTINCT gpu, ',' ORDER BY gpu), '') END AS gpu_types,
  CASE WHEN bool_or(failed) THEN NULL ELSE count(gpu) > 0 END AS gpu_available
FROM (SELECT p_brand AS cluster, {NODE_STATUS} IS NOT NULL AS failed,
  CASE WHEN p_type IN ('ECONOMY', 'PROMO') AND {QUANTITY} = '4' THEN {RESOURCE_SQL} END AS gpu FROM part)
GROUP BY cluster"""


@query("gpu_types", GPU_SQL)
def gpu_types(spark, sf_dir):
    found = inventory.gpu_types(nodes(spark, sf_dir))
    return found.withColumn("gpu_types", F.array_join("gpu_types", ","))


@query(
    "gpu_resources",
    f"""SELECT CAST(p_partkey AS VARCHAR) AS node, {RESOURCE_SQL} AS resource FROM part
    WHERE p_type IN ('ECONOMY', 'PROMO') AND {QUANTITY} = '4'""",
)
def gpu_resources(spark, sf_dir):
    rows = nodes(spark, sf_dir).where(inventory.is_gpu_resource("resource", "quantity"))
    return rows.select("node", "resource")


CAPABILITIES_SQL = f"""SELECT cluster, listed AND installed AS installed,
  CASE WHEN listed THEN version END AS version,
  CASE WHEN ok THEN gpu_available END AS gpu_available,
  CASE WHEN ok THEN gpus ELSE '' END AS gpu_types,
  CASE WHEN listed THEN queueing END AS queueing, CASE WHEN listed THEN platform END AS platform,
  CASE WHEN NOT ok THEN 'capability discovery failed with status ' || status END AS error
FROM (SELECT *, status IS NULL OR status = 401 AS ok, status IS NULL AS listed FROM (
  SELECT p_brand || '/' || p_size AS cluster, max({TYPE_STATUS}) AS status,
    bool_or(p_type = 'ECONOMY') AS installed,
    max(CASE WHEN p_type = 'ECONOMY' THEN CASE WHEN p_retailprice < 1000 THEN 'v' ELSE 'a' END || p_name END)
      AS version,
    bool_or(p_type = 'SMALL') AS queueing, bool_or(p_type = 'MEDIUM') AS platform,
    CASE WHEN max({NODE_STATUS}) IS NULL THEN bool_or(p_type IN ('ECONOMY', 'PROMO') AND {QUANTITY} = '4') END
      AS gpu_available,
    CASE WHEN max({NODE_STATUS}) IS NULL THEN
      coalesce(string_agg(DISTINCT CASE WHEN p_type IN ('ECONOMY', 'PROMO') AND {QUANTITY} = '4'
        THEN {RESOURCE_SQL} END, ',' ORDER BY CASE WHEN p_type IN ('ECONOMY', 'PROMO') AND {QUANTITY} = '4'
        THEN {RESOURCE_SQL} END), '') ELSE '' END AS gpus
  FROM part GROUP BY 1))"""


def _capabilities(spark, sf_dir):
    fleet_nodes = table(spark, sf_dir, "part").selectExpr(
        "concat(p_brand, '/', CAST(p_size AS STRING)) AS cluster", f"{RESOURCE} AS resource",
        f"{QUANTITY} AS quantity", f"{NODE_STATUS} AS http_status",
    )
    return inventory.capabilities(api_types(spark, sf_dir), fleet_nodes)


@query("capabilities", CAPABILITIES_SQL)
def capabilities(spark, sf_dir):
    return _capabilities(spark, sf_dir).withColumn("gpu_types", F.array_join("gpu_types", ","))


@query(
    "capability_view",
    f"""WITH caps AS ({CAPABILITIES_SQL})
    SELECT cluster, 'operator' AS capability, coalesce(version, 'not installed') AS status FROM caps
    UNION ALL SELECT cluster, 'gpu', CASE WHEN gpu_available THEN replace(gpu_types, ',', ', ')
      WHEN NOT gpu_available THEN 'not available' ELSE 'unknown' END FROM caps
    UNION ALL SELECT cluster, 'queueing', CASE WHEN queueing THEN 'available' ELSE 'not installed' END FROM caps
    UNION ALL SELECT cluster, 'platform', CASE WHEN platform THEN 'detected' ELSE 'not detected' END FROM caps""",
)
def capability_view(spark, sf_dir):
    return inventory.capability_view(_capabilities(spark, sf_dir))


# Parts as queue documents; every fifth has no status yet.
@query(
    "queue_view",
    """SELECT lower(p_brand) AS namespace, p_name AS name, p_type AS cluster_queue,
      CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE p_size END AS pending_workloads FROM part""",
)
def queue_view(spark, sf_dir):
    queues = as_documents(
        table(spark, sf_dir, "part"),
        "queue",
        metadata=F.expr("named_struct('namespace', lower(p_brand), 'name', p_name)"),
        spec=F.expr("named_struct('clusterQueue', p_type)"),
        status=F.expr("if(p_partkey % 5 = 0, NULL, named_struct('pendingWorkloads', p_size))"),
    )
    return inventory.queue_view(queues)


GROUP_NAME = """CASE p_type WHEN 'ECONOMY' THEN 'route.openshift.io' WHEN 'PROMO' THEN 'kueue.x-k8s.io'
  WHEN 'LARGE' THEN 'infrastructure.opendatahub.io' WHEN 'SMALL' THEN NULL ELSE 'apps' END"""


@query(
    "platform_flags",
    """SELECT p_brand || '/' || p_size AS cluster, bool_or(p_type = 'ECONOMY') AS platform,
      bool_or(p_type = 'PROMO') AS queueing, bool_or(p_type = 'LARGE') AS hardware_profiles
    FROM part GROUP BY 1""",
)
def platform_flags(spark, sf_dir):
    groups = table(spark, sf_dir, "part").selectExpr(
        "concat(p_brand, '/', CAST(p_size AS STRING)) AS cluster", f"{GROUP_NAME} AS group_name"
    )
    return inventory.platform_flags(groups)


@query(
    "missing_api_types",
    f"""WITH types AS (SELECT p_brand || '/' || p_size AS cluster, {TYPE_NAME} AS crd_name FROM part)
    SELECT cluster, crd_name FROM (SELECT DISTINCT cluster FROM types),
      (VALUES ('rayclusters.ray.io'), ('rayjobs.ray.io'), ('rayservices.ray.io')) AS required(crd_name)
    EXCEPT SELECT cluster, crd_name FROM types""",
)
def missing_api_types(spark, sf_dir):
    return inventory.missing_api_types(api_types(spark, sf_dir))


@query(
    "podset_counts",
    """SELECT l_orderkey, count(*) + 1 AS podsets, count(*) + 1 > 8 AS violation
    FROM lineitem GROUP BY l_orderkey""",
)
def podset_counts(spark, sf_dir):
    return inventory.podset_counts(table(spark, sf_dir, "lineitem"), ["l_orderkey"])


# Events as cluster-metrics documents; CPUs are whole hundredths, so sums are exact.
@query(
    "utilization",
    """SELECT user_id, epoch_us(date_trunc('hour', ts)) AS hour_us,
      min(cpus) AS min_available_cpus, sum(cpus) / count(cpus) AS mean_available_cpus,
      max(cpus) AS max_available_cpus, min(gpus) AS min_available_gpus,
      CASE WHEN count(gpus) > 0 THEN sum(gpus) / count(gpus) END AS mean_available_gpus,
      max(gpus) AS max_available_gpus
    FROM (SELECT user_id, ts, round(value * 100) AS cpus,
      CASE WHEN event_type = 'error' THEN NULL ELSE CAST(user_id AS DOUBLE) END AS gpus FROM events)
    GROUP BY 1, 2""",
)
def utilization(spark, sf_dir):
    payload = F.expr(
        """to_json(named_struct('data', named_struct('clusterStatus', named_struct('loadMetricsReport',
          named_struct('numAvailableCpus', CAST(round(value * 100) AS BIGINT),
            'numAvailableGpus', if(event_type = 'error', NULL, user_id))))))"""
    )
    metrics = table(spark, sf_dir, "events").select(
        "user_id", F.col("ts").cast("timestamp").alias("observed_at"), payload.alias("payload")
    )
    hours = summary.utilization(available_resources(metrics), ("user_id",))
    return hours.withColumn("hour_us", F.unix_micros("period")).drop("period")


# Events as API errors: the number in the properties chooses the status.
K_SPARK = "CAST(get_json_object(props, '$.k') AS INT)"
K_SQL = "CAST(props ->> 'k' AS INTEGER)"
STATUS = """CASE WHEN {k} < 10 THEN 404 WHEN {k} < 20 THEN 401 WHEN {k} < 30 THEN 403 WHEN {k} < 40 THEN 409
  WHEN {k} < 50 THEN 422 WHEN {k} < 60 THEN 501 WHEN {k} < 70 THEN 503 WHEN {k} < 80 THEN 429
  WHEN {k} < 90 THEN 418 ELSE NULL END"""
KIND = """CASE event_type WHEN 'signup' THEN 'RayCluster' WHEN 'view' THEN 'RayJob'
  WHEN 'click' THEN 'RayService' ELSE 'Route' END"""
EXCEPTION = """CASE event_type WHEN 'error' THEN 'ReadTimeoutError' WHEN 'purchase' THEN 'BrokenPipeError'
  WHEN 'click' THEN 'ValueError' ELSE NULL END"""
ERRORS_SQL = f"""errors AS (
  SELECT event_id, kind, http_status,
    CASE WHEN http_status = 404 THEN CASE kind WHEN 'RayCluster' THEN 'CLUSTER_NOT_FOUND'
        WHEN 'RayJob' THEN 'JOB_NOT_FOUND' WHEN 'RayService' THEN 'SERVICE_NOT_FOUND' ELSE 'NOT_FOUND' END
      WHEN http_status IN (401, 403) THEN 'AUTHENTICATION' WHEN http_status = 409 THEN 'CONFLICT'
      WHEN http_status = 422 THEN 'VALIDATION' WHEN http_status BETWEEN 500 AND 599 THEN 'SERVER_ERROR'
      ELSE 'GENERIC' END AS category,
    coalesce(http_status IN (429, 503), false) OR event_type IN ('error', 'purchase') AS transient
  FROM (SELECT event_id, event_type, {KIND} AS kind, {STATUS.format(k=K_SQL)} AS http_status FROM events))"""


def _errors(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr(
        "event_id", f"{KIND} AS kind", f"{STATUS.format(k=K_SPARK)} AS http_status", f"{EXCEPTION} AS exception"
    )
    return errors.classify_errors(rows, exception="exception")


@query(
    "classify_errors",
    f"""WITH {ERRORS_SQL} SELECT event_id, kind, http_status, category, transient,
      CASE category {" ".join(f"WHEN '{name}' THEN '{text}'" for name, text in errors.REMEDIATION.items())} END
        AS remediation FROM errors""",
)
def classify_errors(spark, sf_dir):
    return _errors(spark, sf_dir).drop("exception")


@query(
    "error_summary",
    f"""WITH {ERRORS_SQL} SELECT category, kind, count(*) AS errors, count(*) FILTER (WHERE transient)
      AS transient_errors FROM errors GROUP BY ALL""",
)
def error_summary(spark, sf_dir):
    return errors.error_summary(_errors(spark, sf_dir))


@query(
    "is_transient",
    f"""WITH {ERRORS_SQL} SELECT event_id, transient FROM errors""",
)
def is_transient(spark, sf_dir):
    return _errors(spark, sf_dir).select("event_id", "transient")


@query(
    "number_attempts",
    """SELECT user_id, event_id, attempt FROM (SELECT user_id, event_id,
      CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS attempt FROM events)
    WHERE attempt <= 4""",
)
def number_attempts(spark, sf_dir):
    calls = table(spark, sf_dir, "events")
    return series.number_attempts(calls, ["user_id"], ["ts", "event_id"], 4).select("user_id", "event_id", "attempt")

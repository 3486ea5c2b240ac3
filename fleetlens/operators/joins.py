"""Operators that relate tables: reconcile, look up, resolve, apply profiles and presets.

No side carries a broadcast hint unless it is a constant of this library:
Spark broadcasts a side when its measured size allows it and splits skewed
partitions of the rest at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.functions.columns import blank_to_null
from fleetlens.functions.documents import resolve_namespace, spec_digest
from fleetlens.functions.states import is_active
from fleetlens.operators.skew import slice_hot_groups, with_repeated

# Library defaults of a cluster request.
# Requests of one profile that a task takes, about.
HOT_REQUESTS = 1_000_000
DEFAULT_WORKERS = 1
DEFAULT_CPUS = 1.0
DEFAULT_GPUS = 0
DEFAULT_MEMORY = "2Gi"
DEFAULT_VERSION = "2.41.0"
DEFAULT_GROUP = "default-workers"
HEAD_SERVICE_SUFFIX = "-head-svc"

# Built-in presets.
PRESET_SCHEMA = """name string, workers int, head_cpu string, head_memory string, worker_cpu string,
  worker_memory string, worker_gpu int, ray_version string"""
BUILTIN_PRESETS = (
    ("dev", 1, "1", "2Gi", "1", "2Gi", 0, "2.41.0"),
    ("gpu-single", 1, "2", "4Gi", "4", "8Gi", 1, "2.41.0"),
    ("data-processing", 4, "2", "4Gi", "2", "4Gi", 0, "2.41.0"),
)

NOT_FOUND = {"cluster": "CLUSTER_NOT_FOUND", "job": "JOB_NOT_FOUND", "service": "SERVICE_NOT_FOUND"}


def builtin_presets(spark: SparkSession) -> DataFrame:
    """The built-in preset table."""
    return spark.createDataFrame(list(BUILTIN_PRESETS), PRESET_SCHEMA)


def lookup(requests: DataFrame, resources: DataFrame, kind: str) -> DataFrame:
    """Get resources by namespace and name; an absent one gives a row with an error."""
    found = resources.withColumn("_found", F.lit(True))
    joined = requests.join(found, ["namespace", "name"], "left")
    error = F.when(F.col("_found").isNull(), NOT_FOUND.get(kind, "NOT_FOUND"))
    return joined.withColumn("error", error).drop("_found")


def reconcile(
    desired: DataFrame,
    existing: DataFrame,
    keys: Sequence[str] = ("namespace", "name"),
    spec: str = "spec",
) -> DataFrame:
    """What creating each desired resource would do: CREATE, UNCHANGED or CONFLICT.

    Only the specification counts; labels and annotations do not. Both sides
    send a digest of the canonical text through the join, never the document.
    """
    wanted = desired.select(*keys, spec_digest(spec).alias("_wanted"))
    present = existing.select(*keys, spec_digest(spec).alias("_present"), F.lit(True).alias("_exists"))
    outcome = (
        F.when(F.col("_exists").isNull(), "CREATE")
        .when(F.col("_wanted").eqNullSafe(F.col("_present")), "UNCHANGED")
        .otherwise("CONFLICT")
    )
    return wanted.join(present, list(keys), "left").select(*keys, outcome.alias("outcome"))


def delete_blockers(
    clusters: DataFrame,
    jobs: DataFrame,
    scoped: bool = False,
    state: str = "state",
) -> DataFrame:
    """Active jobs that a deletion of each cluster would warn about, as counts.

    Any active job in the cluster's namespace counts; with ``scoped`` it must
    name the cluster. Jobs are counted before the join, so a namespace with
    very many jobs and clusters costs one row per cluster and never a row per
    pair. ``blocking_jobs`` lists the jobs themselves.
    """
    keys = ["namespace", "name"] if scoped else ["namespace"]
    scope = jobs.withColumn("name", F.col("cluster_name")) if scoped else jobs
    word = F.lower(F.col(state))
    active = (
        scope.where(is_active(state))
        .groupBy(*keys)
        .agg(
            F.count_if(word == "running").alias("running_jobs"),
            F.count_if(word == "pending").alias("pending_jobs"),
        )
    )
    return clusters.select("namespace", "name").join(active, keys)


def blocking_jobs(
    clusters: DataFrame, jobs: DataFrame, scoped: bool = False, state: str = "state"
) -> DataFrame:
    """The active jobs behind ``delete_blockers``, each listed once.

    The clusters are reduced to distinct keys first; the result grows with the
    jobs, not with jobs times clusters.
    """
    if scoped:
        targets = clusters.select("namespace", F.col("name").alias("cluster_name")).distinct()
        return jobs.where(is_active(state)).join(targets, ["namespace", "cluster_name"], "left_semi")
    targets = clusters.select("namespace").distinct()
    return jobs.where(is_active(state)).join(targets, "namespace", "left_semi")


def resolve_endpoints(clusters: DataFrame, routes: DataFrame, ingresses: DataFrame) -> DataFrame:
    """Dashboard address of each cluster: first matching route, else first matching ingress rule.

    ``routes`` has ``(namespace, pos, to_name, host, tls)`` and ``ingresses``
    ``(namespace, pos, rules, tls_hosts)``, where ``pos`` is the list order and a
    rule has ``host`` and ``backends``. A match targets ``{name}-head-svc`` and
    has a host. The scheme is https if the route has TLS or the ingress lists
    the host for TLS. Candidates are reduced to the first per target before the
    join.
    """
    by_route = routes.select(
        "namespace",
        F.col("to_name").alias("service"),
        F.struct(
            F.lit(0).alias("source"),
            F.col("pos").cast("bigint").alias("pos"),
            F.lit(0).alias("rule"),
            F.col("host").alias("host"),
            F.coalesce(F.col("tls"), F.lit(False)).alias("tls"),
        ).alias("candidate"),
    )
    rules = ingresses.select(
        "namespace", "pos", "tls_hosts", F.posexplode("rules").alias("rule_pos", "rule")
    ).select("*", F.explode(F.array_distinct("rule.backends")).alias("service"))
    by_ingress = rules.select(
        "namespace",
        "service",
        F.struct(
            F.lit(1).alias("source"),
            F.col("pos").cast("bigint").alias("pos"),
            F.col("rule_pos").alias("rule"),
            F.col("rule.host").alias("host"),
            F.coalesce(F.array_contains("tls_hosts", F.col("rule.host")), F.lit(False)).alias("tls"),
        ).alias("candidate"),
    )
    first = (
        by_route.unionByName(by_ingress)
        .where(blank_to_null("candidate.host").isNotNull())
        .groupBy("namespace", "service")
        .agg(F.min("candidate").alias("candidate"))
    )
    scheme = F.when(F.col("candidate.tls"), "https://").otherwise("http://")
    url = F.when(F.col("candidate").isNotNull(), F.concat(scheme, F.col("candidate.host")))
    return (
        clusters.withColumn("service", F.concat(F.col("name"), F.lit(HEAD_SERVICE_SUFFIX)))
        .join(first, ["namespace", "service"], "left")
        .withColumn("dashboard_url", url)
        .drop("service", "candidate")
    )


def profile_resources(identifiers: Column) -> Column:
    """Resource map of a profile: complete identifiers only, and the last of a name wins."""
    complete = F.filter(
        identifiers,
        lambda i: blank_to_null(i["identifier"]).isNotNull() & blank_to_null(i["defaultCount"]).isNotNull(),
    )
    names = F.transform(complete, lambda i: i["identifier"])
    last = F.filter(
        complete,
        lambda i, at: at == F.size(names) - F.array_position(F.reverse(names), i["identifier"]),
    )
    pairs = F.transform(last, lambda i: F.struct(i["identifier"], i["defaultCount"]))
    return F.coalesce(F.map_from_entries(pairs), F.create_map().cast("map<string,string>"))


def hardware_profile_settings(profiles: DataFrame) -> DataFrame:
    """Resources and scheduling of each profile document.

    Node scheduling gives selector and tolerations, Queue scheduling gives
    queue and priority class, anything else gives neither.
    """
    scheduling = F.col("spec.scheduling")
    by_node = F.coalesce(scheduling["schedulingType"] == "Node", F.lit(False))
    by_queue = F.coalesce(scheduling["schedulingType"] == "Queue", F.lit(False))
    no_labels = F.create_map().cast("map<string,string>")
    return profiles.select(
        F.coalesce("metadata.namespace", F.lit("default")).alias("profile_namespace"),
        F.col("metadata.name").alias("profile"),
        profile_resources(F.col("spec.identifiers")).alias("resources"),
        F.coalesce(F.when(by_node, scheduling["node"]["nodeSelector"]), no_labels).alias("node_selector"),
        F.coalesce(
            F.when(by_node, scheduling["node"]["tolerations"]), F.array().cast("array<map<string,string>>")
        ).alias("tolerations"),
        F.when(by_queue, scheduling["kueue"]["localQueueName"]).alias("queue"),
        F.when(by_queue, scheduling["kueue"]["priorityClass"]).alias("priority_class"),
    )


def apply_hardware_profiles(
    requests: DataFrame,
    profiles: DataFrame,
    profile: str = "hardware_profile",
    namespace: str | None = None,
    hot_rows: int = HOT_REQUESTS,
    partitions: int | None = None,
) -> DataFrame:
    """Requests with the settings of the profile they name; an unknown profile gives an error.

    ``namespace`` is the column of the requests that says in which namespace the profile
    is. Without it ``profiles`` are documents of one namespace, one per profile name.

    Requests of a profile, or of none, that more than ``hot_rows`` of them name are dealt over
    several tasks, and its settings are repeated for each. ``partitions`` says over how many parts
    both sides are dealt; without it, it is the session's shuffle partitions.
    """
    settings = hardware_profile_settings(profiles).withColumnRenamed("profile", profile)
    keys = [profile]
    if namespace is None:
        settings = settings.drop("profile_namespace")
    else:
        settings, keys = settings.withColumnRenamed("profile_namespace", namespace), [namespace, profile]
    # A name that is missing finds nothing, so only named profiles have to be there.
    named = settings.dropna(subset=keys).withColumn("_found", F.lit(True))
    plain = [name for name, kind in requests.dtypes if "map<" not in kind and "variant" not in kind]
    joined = with_repeated(slice_hot_groups(requests, keys, None, plain, hot_rows), named, partitions)
    missing = F.col("_found").isNull() & F.col(profile).isNotNull()
    return joined.withColumn(
        "profile_error", F.when(missing, F.concat(F.lit("hardware profile not found: "), F.col(profile)))
    ).drop("_found")


def apply_presets(requests: DataFrame, presets: DataFrame, preset: str = "preset") -> DataFrame:
    """Fill request fields from the named preset.

    A preset fills a field wherever the request still has the library default,
    even if that value was given explicitly; head and version only where they
    are NULL. An unknown preset name gives an error.
    """
    # Names of this library's own columns, so that requests may use the preset's.
    fields = {field: f"_preset_{field}" for field in presets.columns if field != "name"}
    side = presets.withColumnsRenamed({**fields, "name": preset}).withColumn("_found", F.lit(True))
    found = F.col("_found").isNotNull()
    joined = requests.join(side, preset, "left")
    given = {
        "workers": F.coalesce(F.col("workers"), F.lit(DEFAULT_WORKERS)),
        "cpus_per_worker": F.coalesce(F.col("cpus_per_worker"), F.lit(DEFAULT_CPUS)),
        "gpus_per_worker": F.coalesce(F.col("gpus_per_worker"), F.lit(DEFAULT_GPUS)),
        "memory_per_worker": F.coalesce(F.col("memory_per_worker"), F.lit(DEFAULT_MEMORY)),
    }

    def fill(name: str, default, value: Column) -> Column:
        return F.when(found & (given[name] == default), value).otherwise(given[name])

    filled = {
        "workers": fill("workers", DEFAULT_WORKERS, F.col("_preset_workers")),
        "cpus_per_worker": fill("cpus_per_worker", DEFAULT_CPUS, F.col("_preset_worker_cpu").cast("double")),
        "gpus_per_worker": fill("gpus_per_worker", DEFAULT_GPUS, F.col("_preset_worker_gpu")),
        "memory_per_worker": fill("memory_per_worker", DEFAULT_MEMORY, F.col("_preset_worker_memory")),
        "head": F.coalesce(
            F.col("head"),
            F.when(
                found,
                F.struct(
                    F.col("_preset_head_cpu").cast("double").alias("cpus"),
                    F.col("_preset_head_memory").alias("memory"),
                    F.lit(DEFAULT_GPUS).alias("gpus"),
                    F.lit(None).cast("map<string,string>").alias("ray_start_params"),
                ),
            ),
        ),
        "ray_version": F.coalesce(F.col("ray_version"), F.col("_preset_ray_version")),
        "preset_error": F.when(
            ~found & F.col(preset).isNotNull(), F.concat(F.lit("unknown preset: "), F.col(preset))
        ),
    }
    return joined.withColumns(filled).drop("_found", *fields.values())


def plan_scale(requests: DataFrame, worker_groups: DataFrame) -> DataFrame:
    """Worker groups as they would be after scaling each requested cluster.

    The group at position 0 gets the new size as replicas, minimum and maximum;
    the others stay. A cluster without groups gets the default group. A size
    below 1 gives one row with an error. Requests are one per cluster.
    """
    keys = ["namespace", "name"]
    columns = ["pos", "group_name", "replicas", "min_replicas", "max_replicas"]
    valid = requests.where(F.col("workers") >= 1).select(*keys, "workers")
    first = F.col("pos") == 0

    def resized(name: str) -> Column:
        return F.when(first, F.col("workers")).otherwise(F.col(name)).cast("int").alias(name)

    known = worker_groups.join(valid, keys).select(
        *keys, F.col("pos").cast("int").alias("pos"), "group_name",
        *[resized(c) for c in columns[2:]], F.lit(None).cast("string").alias("error"),
    )
    # Distinct keys first: a cluster with very many groups counts once here.
    unknown = valid.join(worker_groups.select(*keys).distinct(), keys, "left_anti").select(
        *keys, F.lit(0).alias("pos"), F.lit(DEFAULT_GROUP).alias("group_name"),
        *[F.col("workers").cast("int").alias(c) for c in columns[2:]],
        F.lit(None).cast("string").alias("error"),
    )
    refused = requests.where(~F.coalesce(F.col("workers") >= 1, F.lit(False))).select(
        *keys, *[F.lit(None).cast("string" if c == "group_name" else "int").alias(c) for c in columns],
        F.lit("workers must be at least 1").alias("error"),
    )
    return known.unionByName(unknown).unionByName(refused)


def endpoint_of_jobs(jobs: DataFrame, endpoints: DataFrame) -> DataFrame:
    """Dashboard address of each job through its cluster; a job without one gets an error."""
    side = endpoints.select("namespace", F.col("name").alias("cluster_name"), "dashboard_url")
    unnamed = blank_to_null("cluster_name").isNull()
    # Jobs without a name have one key, maybe a hot one, and nothing to find in the join.
    found = jobs.where(~unnamed).join(side, ["namespace", "cluster_name"], "left")
    absent = jobs.where(unnamed).withColumn("dashboard_url", F.lit(None).cast("string"))
    return (
        found.withColumn("error", F.lit(None).cast("string"))
        .unionByName(absent.withColumn("error", F.lit("job has no cluster name")))
    )


def effective_namespaces(
    df: DataFrame, override: str = "override", config: str = "config", context: str = "context"
) -> DataFrame:
    """Rows with the namespace they resolve to: first non-empty of call, settings and context."""
    return df.withColumn("namespace", resolve_namespace(override, config, context))

"""Fleet inventory: GPU types, capabilities, platform flags, API types, pod sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.columns import ColumnLike, blank_to_null, col

# API type names, API groups and version keys that are looked for.
CLUSTER_TYPE = "rayclusters.ray.io"
REQUIRED_TYPES = ("rayclusters.ray.io", "rayjobs.ray.io", "rayservices.ray.io")
QUEUEING_TYPE = "workloads.kueue.x-k8s.io"
PLATFORM_TYPE = "routes.route.openshift.io"
VERSION_LABEL = "app.kubernetes.io/version"
VERSION_ANNOTATION = "controller-gen.kubebuilder.io/version"
PLATFORM_GROUP = "route.openshift.io"
QUEUEING_GROUP = "kueue.x-k8s.io"
PROFILE_GROUP = "infrastructure.opendatahub.io"
MAX_POD_SETS = 8


def is_gpu_resource(resource: ColumnLike, quantity: ColumnLike) -> Column:
    """True for a resource named after a GPU with a quantity that is neither empty nor 0."""
    named = F.lower(col(resource)).contains("gpu")
    return F.coalesce(named & ~col(quantity).isin("", "0"), F.lit(False))


def _failed(http_status: Column) -> Column:
    return F.coalesce(http_status >= 400, F.lit(False))


def _denied(http_status: Column) -> Column:
    return F.coalesce(http_status.isin(401, 403), F.lit(False))


def gpu_types(nodes: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Sorted GPU resource names per fleet member, and whether it has any.

    Input rows are ``(cluster, node, resource, quantity, http_status)``. A failed
    listing gives a NULL flag and no names. The set holds distinct resource
    names only, so it stays small however many nodes a member has.
    """
    gpu = F.when(is_gpu_resource("resource", "quantity"), F.col("resource"))
    failed = F.max(_failed(F.col("http_status")))
    names = F.when(failed, F.array().cast("array<string>")).otherwise(F.sort_array(F.collect_set(gpu)))
    return nodes.groupBy(cluster).agg(
        names.alias("gpu_types"), F.when(~failed, F.size(names) > 0).alias("gpu_available")
    )


def capabilities(api_types: DataFrame, nodes: DataFrame, cluster: str = "cluster") -> DataFrame:
    """What each fleet member can do, from its API types and its nodes.

    A denied listing (401, 403) leaves the flags it would have given NULL; any
    other failed listing of API types gives an error text and no findings.
    """
    name, status = F.col("crd_name"), F.col("http_status")
    version = F.coalesce(
        blank_to_null(F.col("labels")[VERSION_LABEL]),
        blank_to_null(F.col("annotations")[VERSION_ANNOTATION]),
    )
    found = api_types.groupBy(cluster).agg(
        F.max(F.coalesce(name == CLUSTER_TYPE, F.lit(False))).alias("_installed"),
        F.max(F.when(name == CLUSTER_TYPE, version)).alias("_version"),
        F.max(F.coalesce(name == QUEUEING_TYPE, F.lit(False))).alias("_queueing"),
        F.max(F.coalesce(name == PLATFORM_TYPE, F.lit(False))).alias("_platform"),
        F.max(_denied(status)).alias("_denied"),
        F.max(F.when(_failed(status) & ~_denied(status), status)).alias("_error"),
    )
    # NULL-safe: a member without a name meets itself too.
    listed_nodes = gpu_types(nodes, cluster).withColumnRenamed(cluster, "_node_cluster")
    same = F.col(cluster).eqNullSafe(F.col("_node_cluster"))
    joined = found.join(listed_nodes, same, "full").withColumn(cluster, F.coalesce(cluster, "_node_cluster")).fillna(
        False, ["_installed", "_queueing", "_platform", "_denied"]
    )
    ok = F.col("_error").isNull()
    listed = ok & ~F.col("_denied")
    return joined.select(
        cluster,
        (F.col("_installed") & listed).alias("installed"),
        F.when(listed, F.col("_version")).alias("version"),
        F.when(ok, F.col("gpu_available")).alias("gpu_available"),
        F.when(ok, F.coalesce("gpu_types", F.array().cast("array<string>")))
        .otherwise(F.array().cast("array<string>")).alias("gpu_types"),
        F.when(listed, F.col("_queueing")).alias("queueing"),
        F.when(listed, F.col("_platform")).alias("platform"),
        F.when(~ok, F.concat(F.lit("capability discovery failed with status "), F.col("_error").cast("string")))
        .alias("error"),
    )


def capability_view(caps: DataFrame, cluster: str = "cluster") -> DataFrame:
    """One ``(cluster, capability, status)`` row per capability, in words."""
    gpu = (
        F.when(F.col("gpu_available") & (F.size("gpu_types") > 0), F.array_join("gpu_types", ", "))
        .when(~F.col("gpu_available"), "not available")
        .otherwise("unknown")
    )
    texts = caps.select(
        cluster,
        F.coalesce(blank_to_null("version"), F.lit("not installed")).alias("operator"),
        gpu.alias("gpu"),
        F.when(F.col("queueing"), "available").otherwise("not installed").alias("queueing"),
        F.when(F.col("platform"), "detected").otherwise("not detected").alias("platform"),
    )
    return texts.unpivot(cluster, ["operator", "gpu", "queueing", "platform"], "capability", "status")


def queue_view(queues: DataFrame) -> DataFrame:
    """Queue documents as ``(namespace, name, cluster_queue, pending_workloads)``; no status means nothing pending."""
    return queues.select(
        F.coalesce("metadata.namespace", F.lit("default")).alias("namespace"),
        F.col("metadata.name").alias("name"),
        F.col("spec.clusterQueue").alias("cluster_queue"),
        F.coalesce("status.pendingWorkloads", F.lit(0)).alias("pending_workloads"),
    )


def platform_flags(api_groups: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Three platform flags per fleet member by API group; failed discovery reads as false."""

    def present(group: str) -> Column:
        return F.coalesce(F.max(F.col("group_name") == group), F.lit(False))

    return api_groups.groupBy(cluster).agg(
        present(PLATFORM_GROUP).alias("platform"),
        present(QUEUEING_GROUP).alias("queueing"),
        present(PROFILE_GROUP).alias("hardware_profiles"),
    )


def missing_api_types(
    api_types: DataFrame, required: tuple[str, ...] = REQUIRED_TYPES, cluster: str = "cluster"
) -> DataFrame:
    """Required API types each fleet member lacks.

    One grouped pass collects which of the required names are present (a set no
    larger than the requirement), and the rest of the requirement is unnested.
    """
    wanted = F.array(*[F.lit(name) for name in required])
    present = F.collect_set(F.when(F.col("crd_name").isin(*required), F.col("crd_name")))
    return (
        api_types.groupBy(cluster)
        .agg(present.alias("present"))
        .select(cluster, F.explode(F.array_except(wanted, "present")).alias("crd_name"))
    )


def podset_counts(worker_groups: DataFrame, keys: list[str]) -> DataFrame:
    """Pod sets per workload (one for the head plus one per group) and whether a queue admits them.

    Rows are groups; a workload without groups has no rows and is not listed.
    For groups held in an array use ``podsets_of``.
    """
    total = F.count(F.lit(1)) + 1
    return worker_groups.groupBy(*keys).agg(
        total.alias("podsets"), (total > MAX_POD_SETS).alias("violation")
    )


def podsets_of(groups: ColumnLike) -> Column:
    """Pod sets of a workload whose groups are an array."""
    return F.coalesce(F.size(col(groups)), F.lit(0)) + 1

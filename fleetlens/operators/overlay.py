"""Layered settings, document overlays and desired-state tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.columns import ColumnLike, blank_to_null, col
from fleetlens.functions.documents import map_or_empty, merge_env, merge_json, queue_labels, tracking_env
from fleetlens.operators.joins import (
    DEFAULT_CPUS,
    DEFAULT_GPUS,
    DEFAULT_GROUP,
    DEFAULT_MEMORY,
    DEFAULT_VERSION,
    DEFAULT_WORKERS,
)

EMPTY_OBJECT = "{}"
PATH_SEPARATOR = "/"

# Names and defaults that a rendered specification carries.
IMAGE_REPOSITORY = "rayproject/ray"
DEFAULT_GPU_RESOURCE = "nvidia.com/gpu"
HEAD_DEFAULT_PARAMS = {"dashboard-host": "0.0.0.0"}
HEAD_CONTAINER = "ray-head"
WORKER_CONTAINER = "ray-worker"

# Layers of settings, lowest precedence first; an explicit record stands alone over the defaults.
LAYERS = ("default", "file", "env", "explicit")


def escape_key(key: ColumnLike) -> Column:
    """A document key as a path step (the escapes of JSON pointers)."""
    return F.replace(F.replace(col(key), F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))


# Sorts before everything that a path code can hold besides.
_BELOW = "\x00"


def path_code(path: ColumnLike) -> Column:
    """A path as a text that sorts before all paths below it, and those before any other.

    Steps end with the smallest character; where a key holds it, it is escaped.
    """
    escaped = F.replace(F.replace(col(path), F.lit("\x01"), F.lit("\x01\x02")), F.lit(_BELOW), F.lit("\x01\x01"))
    return F.replace(escaped, F.lit(PATH_SEPARATOR), F.lit(_BELOW))


def deep_merge(
    base: DataFrame, override: DataFrame, id_column: str = "id", steps: int = 1, partitions: int | None = None
) -> DataFrame:
    """Overlay documents held as leaf rows ``(id, path, value)``.

    Objects merge key by key; anything else in the override replaces what is in
    the base: scalars, lists and nulls whole. An empty object is a leaf with the
    value ``{}``. Paths are joined with ``/`` and escaped by ``escape_key``. No leaf
    of one document lies below another.

    The leaves of both sides are put in the order of their path codes, in which what
    lies below a path follows it at once. So the last override leaf up to a base leaf
    is the only one that can be at or above it, and the next one the only one that need
    be looked at below it: two running values decide, and nothing is joined or exploded.

    Leaves meet only below the same first step, so a document is cut by it. One too big
    for that is cut by its first ``steps`` steps; then a row for each cut carries the
    running values on.

    A task sorts the leaves of its part. ``partitions`` says how many parts the leaves are
    dealt over; without it, it is the session's shuffle partitions.
    """
    if steps < 1:
        raise ValueError("documents are cut by at least one step")
    is_empty = F.coalesce(F.col("value") == EMPTY_OBJECT, F.lit(False))
    sides = base.select(id_column, "path", "value", F.lit(False).alias("_over")).unionByName(
        override.select(id_column, "path", "value", F.lit(True).alias("_over"))
    )
    coded = sides.withColumn("_code", path_code("path")).withColumn("_cell", F.substring_index("_code", _BELOW, steps))
    over, code = F.col("_over"), F.col("_code")
    place = [id_column, "_cell"]
    if partitions:
        coded = coded.repartition(partitions, *place)
    # An override leaf stands before the base leaf of its path.
    onwards = Window.partitionBy(*place).orderBy("_code", over.desc())
    backwards = Window.partitionBy(*place).orderBy(code.desc(), over)
    running = coded.withColumns(
        {
            "_above": F.last(F.when(over, F.struct(code.alias("code"), (~is_empty).alias("replaces"))), True).over(onwards),
            "_over_below": F.last(F.when(over, code), True).over(backwards),
            "_base_below": F.last(F.when(~over, code), True).over(backwards),
        }
    )
    if steps > 1:
        running = _carried_on(running, coded, id_column, partitions)

    def below(inner: ColumnLike, top: ColumnLike) -> Column:
        return F.coalesce(F.startswith(col(inner), F.concat(col(top), F.lit(_BELOW))), F.lit(False))

    same = F.coalesce(F.col("_above.code") == code, F.lit(False))
    hidden = F.coalesce(F.col("_above.replaces"), F.lit(False)) & below("_code", "_above.code")
    gone = F.when(over, is_empty & below("_base_below", "_code")).otherwise(same | hidden | below("_over_below", "_code"))
    return running.where(~gone).select(id_column, "path", "value")


def _carried_on(running: DataFrame, coded: DataFrame, id_column: str, partitions: int | None) -> DataFrame:
    """The running values across the cuts of a document."""
    over, code = F.col("_over"), F.col("_code")
    is_empty = F.coalesce(F.col("value") == EMPTY_OBJECT, F.lit(False))
    cuts = coded.groupBy(F.struct(id_column).alias("_id"), "_cell").agg(
        F.max(F.when(over, F.struct(code.alias("code"), (~is_empty).alias("replaces")))).alias("above"),
        F.min(F.when(over, code)).alias("over_below"),
        F.min(F.when(~over, code)).alias("base_below"),
    )
    if partitions:
        cuts = cuts.repartition(partitions, "_id")
    before = Window.partitionBy("_id").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("_id").orderBy(F.col("_cell").desc()).rowsBetween(Window.unboundedPreceding, -1)
    told = cuts.select(
        "_id", "_cell",
        F.last("above", True).over(before).alias("_far_above"),
        F.last("over_below", True).over(after).alias("_far_over"),
        F.last("base_below", True).over(after).alias("_far_base"),
    )
    running = running.withColumn("_id", F.struct(id_column))
    if partitions:
        running, told = (side.repartition(partitions, "_id", "_cell") for side in (running, told))
    joined = running.join(told, ["_id", "_cell"])
    return joined.withColumns(
        {
            "_above": F.coalesce("_above", "_far_above"),
            "_over_below": F.coalesce("_over_below", "_far_over"),
            "_base_below": F.coalesce("_base_below", "_far_base"),
        }
    )


def merge_leaves(base: Column, override: Column) -> Column:
    """``deep_merge`` of two leaf arrays that already lie in one row; needs no shuffle."""

    def at_or_below(path: Column, top: Column) -> Column:
        return (path == top) | path.startswith(F.concat(top, F.lit(PATH_SEPARATOR)))

    def replaces(o: Column) -> Column:
        return ~F.coalesce(o["value"] == EMPTY_OBJECT, F.lit(False))

    kept = F.filter(
        base,
        lambda b: ~F.exists(
            override,
            lambda o: (replaces(o) & at_or_below(b["path"], o["path"])) | at_or_below(o["path"], b["path"]),
        ),
    )
    added = F.filter(
        override,
        lambda o: replaces(o)
        | ~F.exists(base, lambda b: b["path"].startswith(F.concat(o["path"], F.lit(PATH_SEPARATOR)))),
    )
    return F.concat(kept, added)


def resolve_settings(layers: DataFrame, id_column: str = "id") -> DataFrame:
    """The value of every setting after layering: environment over file over default.

    An explicit record is taken whole: where an id has one, its file and
    environment rows do not count. A NULL value counts as not set.
    """
    explicit = F.col("layer") == "explicit"
    default = F.col("layer") == "default"
    given = F.when(F.col("value").isNotNull(), F.struct("precedence", "layer", "value"))
    # One row per id and key before the per-id step, so that step stays small.
    per_key = layers.groupBy(id_column, "key").agg(
        F.max(F.when(explicit, given)).alias("explicit"),
        F.max(F.when(default, given)).alias("default"),
        F.max(F.when(~explicit, given)).alias("layered"),
        F.max(explicit).alias("is_explicit"),
    )
    has_explicit = F.max("is_explicit").over(Window.partitionBy(id_column))
    chosen = F.when(
        has_explicit, F.coalesce(F.col("explicit"), F.col("default"))
    ).otherwise(F.col("layered"))
    return (
        per_key.select(id_column, "key", chosen.alias("chosen"))
        .where(F.col("chosen").isNotNull())
        .select(id_column, "key", F.col("chosen.value").alias("value"), F.col("chosen.layer").alias("layer"))
    )


def _effective_groups(requests: DataFrame) -> Column:
    """Worker groups of a request, or its flat fields as the single default group."""
    workers = F.coalesce(F.col("workers"), F.lit(DEFAULT_WORKERS))
    flat = F.array(
        F.struct(
            F.lit(DEFAULT_GROUP).alias("name"),
            workers.alias("replicas"),
            F.coalesce(F.col("cpus_per_worker"), F.lit(DEFAULT_CPUS)).alias("cpus"),
            F.coalesce(F.col("gpus_per_worker"), F.lit(DEFAULT_GPUS)).alias("gpus"),
            F.coalesce(F.col("memory_per_worker"), F.lit(DEFAULT_MEMORY)).alias("memory"),
            workers.alias("min_replicas"),
            workers.alias("max_replicas"),
            F.lit(None).cast("string").alias("gpu_type"),
            F.lit(None).cast("map<string,string>").alias("ray_start_params"),
        )
    )
    if "worker_groups" not in requests.columns:
        return flat
    given = F.transform(
        F.col("worker_groups"),
        lambda g: F.struct(
            g["name"].alias("name"),
            g["replicas"].alias("replicas"),
            F.coalesce(g["cpus"], F.lit(DEFAULT_CPUS)).alias("cpus"),
            F.coalesce(g["gpus"], F.lit(DEFAULT_GPUS)).alias("gpus"),
            F.coalesce(g["memory"], F.lit(DEFAULT_MEMORY)).alias("memory"),
            F.coalesce(g["min_replicas"], g["replicas"]).alias("min_replicas"),
            F.coalesce(g["max_replicas"], g["replicas"]).alias("max_replicas"),
            g["gpu_type"].alias("gpu_type"),
            g["ray_start_params"].alias("ray_start_params"),
        ),
    )
    return F.when(F.size("worker_groups") > 0, given).otherwise(flat)


def normalize_worker_groups(requests: DataFrame, keys: Sequence[str] = ("namespace", "name")) -> DataFrame:
    """One row per worker group of each request, with effective minimum and maximum."""
    rows = requests.select(*keys, F.posexplode(_effective_groups(requests)).alias("pos", "group"))
    return rows.select(
        *keys,
        "pos",
        F.col("group.name").alias("group_name"),
        *[F.col(f"group.{c}").alias(c) for c in ("replicas", "min_replicas", "max_replicas")],
        *[F.col(f"group.{c}").alias(c) for c in ("cpus", "gpus", "memory", "gpu_type")],
    )


def cpu_text(cpus: ColumnLike) -> Column:
    """CPU count as text, without a fraction when it is whole."""
    whole = col(cpus).cast("bigint")
    return F.when(col(cpus) == whole, whole.cast("string")).otherwise(col(cpus).cast("string"))


def resource_map(cpus: Column, memory: Column, gpus: Column, gpu_type: Column) -> Column:
    """Requested resources of a container; the GPU entry only for a count other than 0."""
    count = F.coalesce(gpus, F.lit(0))
    gpu_name = F.coalesce(blank_to_null(gpu_type), F.lit(DEFAULT_GPU_RESOURCE))
    base = [F.lit("cpu"), cpu_text(cpus), F.lit("memory"), memory]
    gpu = [gpu_name, count.cast("string")]
    return (
        F.when(count == 0, F.create_map(*base))
        .when(gpu_name.isin("cpu", "memory"), merge_env(F.create_map(*base), F.create_map(*gpu)))
        .otherwise(F.create_map(*base, *gpu))
    )


def _optional(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def _non_empty(value: Column) -> Column:
    return F.when(F.size(value) > 0, value)


def cluster_spec(requests: DataFrame) -> Column:
    """Normalised cluster specification of each request, as a struct.

    Runtime environment and hardware profile are accepted in requests but are
    no part of the specification. Absent parts are NULL and vanish in JSON.
    """
    storage = _optional(
        requests, "storage",
        "array<struct<name:string,mount_path:string,size:string,existing_claim:string,"
        "access_mode:string,storage_class:string>>",
    )
    volumes = F.transform(
        _non_empty(storage),
        lambda v: F.struct(
            v["name"].alias("name"),
            F.struct(
                F.coalesce(blank_to_null(v["existing_claim"]), v["name"]).alias("claimName")
            ).alias("persistentVolumeClaim"),
        ),
    )
    mounts = F.transform(
        _non_empty(storage),
        lambda v: F.struct(v["name"].alias("name"), v["mount_path"].alias("mountPath")),
    )
    version = F.coalesce(
        blank_to_null(_optional(requests, "ray_version", "string")), F.lit(DEFAULT_VERSION)
    )
    image = F.coalesce(
        blank_to_null(_optional(requests, "image", "string")),
        F.concat(F.lit(f"{IMAGE_REPOSITORY}:"), version),
    )
    selector = _non_empty(_optional(requests, "node_selector", "map<string,string>"))
    tolerations = _non_empty(_optional(requests, "tolerations", "array<map<string,string>>"))

    def pod(container: str, resources: Column) -> Column:
        return F.struct(
            F.struct(
                F.array(
                    F.struct(
                        F.lit(container).alias("name"),
                        image.alias("image"),
                        F.struct(resources.alias("requests"), resources.alias("limits")).alias("resources"),
                        mounts.alias("volumeMounts"),
                    )
                ).alias("containers"),
                volumes.alias("volumes"),
                selector.alias("nodeSelector"),
                tolerations.alias("tolerations"),
            ).alias("spec")
        )

    head = _optional(
        requests, "head",
        "struct<cpus:double,memory:string,gpus:int,ray_start_params:map<string,string>>",
    )
    head_params = merge_env(
        F.create_map(*[F.lit(part) for pair in HEAD_DEFAULT_PARAMS.items() for part in pair]),
        head["ray_start_params"],
    )
    head_resources = resource_map(
        F.coalesce(head["cpus"], F.lit(DEFAULT_CPUS)),
        F.coalesce(head["memory"], F.lit(DEFAULT_MEMORY)),
        F.coalesce(head["gpus"], F.lit(DEFAULT_GPUS)),
        F.lit(None).cast("string"),
    )
    head_pod = pod(HEAD_CONTAINER, head_resources)
    # Two steps, so that the resources of a group are built once and used twice.
    sized = F.transform(
        _effective_groups(requests),
        lambda g: F.struct(
            g.alias("group"), resource_map(g["cpus"], g["memory"], g["gpus"], g["gpu_type"]).alias("resources")
        ),
    )
    groups = F.transform(
        sized,
        lambda s: F.struct(
            s["group"]["name"].alias("groupName"),
            s["group"]["replicas"].alias("replicas"),
            s["group"]["min_replicas"].alias("minReplicas"),
            s["group"]["max_replicas"].alias("maxReplicas"),
            map_or_empty(s["group"]["ray_start_params"]).alias("rayStartParams"),
            pod(WORKER_CONTAINER, s["resources"]).alias("template"),
        ),
    )
    autoscaling = _optional(requests, "enable_autoscaling", "boolean")
    return F.struct(
        version.alias("rayVersion"),
        F.struct(head_params.alias("rayStartParams"), head_pod.alias("template")).alias("headGroupSpec"),
        groups.alias("workerGroupSpecs"),
        F.when(autoscaling, F.lit(True)).alias("enableInTreeAutoscaling"),
    )


def _embedded(requests: DataFrame) -> DataFrame:
    """Requests without the fields that an embedded cluster does not take over.

    Flat worker fields do not pass where a group list is given, even an empty one.
    """
    taken = requests.drop("node_selector", "tolerations", "enable_autoscaling")
    if "worker_groups" not in requests.columns:
        return taken
    flat = ("workers", "cpus_per_worker", "gpus_per_worker", "memory_per_worker")
    return taken.withColumns(
        {name: F.when(F.col("worker_groups").isNull(), F.col(name)) for name in flat}
    )


RUNTIME_ENV = """struct<pip:array<string>,conda:string,env_vars:map<string,string>,
  working_dir:string,py_modules:array<string>>"""


def effective_runtime_env(requests: DataFrame) -> Column:
    """Runtime environment of a job with its tracking variables merged in, NULL when it is empty."""
    env = _optional(requests, "runtime_env", RUNTIME_ENV)
    tracking = _optional(
        requests, "experiment_tracking",
        "struct<provider:string,tracking_uri:string,experiment_name:string,env_vars:map<string,string>>",
    )
    tracked = F.when(
        tracking.isNotNull(),
        tracking_env(tracking["tracking_uri"], tracking["experiment_name"], tracking["env_vars"]),
    )
    merged = F.struct(
        _non_empty(env["pip"]).alias("pip"),
        blank_to_null(env["conda"]).alias("conda"),
        _non_empty(merge_env(env["env_vars"], tracked)).alias("env_vars"),
        blank_to_null(env["working_dir"]).alias("working_dir"),
        _non_empty(env["py_modules"]).alias("py_modules"),
    )
    parts = [merged[c].isNotNull() for c in ("pip", "conda", "env_vars", "working_dir", "py_modules")]
    some = parts[0]
    for part in parts[1:]:
        some = some | part
    return F.when(some, merged)


def desired_state(requests: DataFrame, kind: str) -> DataFrame:
    """Request table to ``(kind, namespace, name, labels, annotations, spec)``, spec as JSON.

    This is the left side of ``reconcile``. The runtime environment of a job and
    the serve configuration of a service are given as JSON, which is also YAML.
    With a column ``raw_overrides`` the whole manifest is overlaid last and given as
    ``document``; overrides that are no JSON object, or leave no metadata or spec,
    give NULL for both and are named in ``override_error``.
    """
    namespace = F.coalesce(blank_to_null(_optional(requests, "namespace", "string")), F.lit("default"))
    labels = map_or_empty(_optional(requests, "labels", "map<string,string>"))
    queue = blank_to_null(_optional(requests, "queue", "string"))
    queued = F.when(queue.isNotNull(), queue_labels(labels, queue)).otherwise(labels)
    if kind in ("job", "service"):
        embedded = _embedded(requests)
        requests = embedded.withColumn("_cluster", cluster_spec(embedded))
    if kind == "cluster":
        spec = cluster_spec(requests)
    elif kind == "job":
        spec = F.struct(
            F.col("entrypoint").alias("entrypoint"),
            F.coalesce(_optional(requests, "shutdown_after_finish", "boolean"), F.lit(True)).alias(
                "shutdownAfterJobFinishes"
            ),
            F.col("_cluster").alias("rayClusterSpec"),
            F.to_json(effective_runtime_env(requests)).alias("runtimeEnvYAML"),
        )
    elif kind == "service":
        queued = labels
        env = effective_runtime_env(requests.drop("experiment_tracking"))
        deployment = F.struct(
            F.lit("default").alias("name"),
            F.coalesce(_optional(requests, "num_replicas", "int"), F.lit(1)).alias("num_replicas"),
        )
        application = F.struct(
            F.lit("default").alias("name"),
            F.col("import_path").alias("import_path"),
            F.array(deployment).alias("deployments"),
            env.alias("runtime_env"),
        )
        built = F.to_json(F.struct(F.array(application).alias("applications")))
        raw = blank_to_null(_optional(requests, "serve_config_v2", "string"))
        spec = F.struct(
            F.coalesce(raw, built).alias("serveConfigV2"),
            F.col("_cluster").alias("rayClusterConfig"),
        )
    else:
        raise ValueError(f"unknown request kind {kind!r}")
    rendered = requests.select(
        F.lit(kind).alias("kind"),
        namespace.alias("namespace"),
        "name",
        queued.alias("labels"),
        map_or_empty(_optional(requests, "annotations", "map<string,string>")).alias("annotations"),
        F.to_json(spec).alias("spec"),
        *(["raw_overrides"] if "raw_overrides" in requests.columns else []),
    )
    if "raw_overrides" not in requests.columns:
        return rendered
    return _overridden(rendered, kind)


# How a manifest names its version and kind.
API_VERSION = "ray.io/v1"
MANIFEST_KINDS = {"cluster": "RayCluster", "job": "RayJob", "service": "RayService"}


def _overridden(rendered: DataFrame, kind: str) -> DataFrame:
    """Whole manifests overlaid with ``raw_overrides``, and the columns picked out of them again."""
    head = f'{{"apiVersion":"{API_VERSION}","kind":"{MANIFEST_KINDS[kind]}","metadata":'
    metadata = F.to_json(F.struct("name", "namespace", "labels", "annotations"))
    manifest = F.concat(F.lit(head), metadata, F.lit(',"spec":'), F.col("spec"), F.lit("}"))
    given = blank_to_null("raw_overrides").isNotNull()
    read = """metadata struct<name: string, namespace: string, labels: map<string,string>,
      annotations: map<string,string>>, spec string"""
    merged = rendered.withColumn("document", merge_json(manifest, "raw_overrides")).withColumn(
        "_read", F.when(given, F.from_json("document", read))
    )
    metadata = F.col("_read.metadata")
    unread = given & F.col("document").isNull()
    failed = unread | (given & (metadata.isNull() | F.col("_read.spec").isNull()))

    def picked(name: str, value: Column) -> Column:
        return F.when(given & ~failed, value).otherwise(F.col(name)).alias(name)

    return merged.select(
        "kind",
        picked("namespace", F.coalesce(metadata["namespace"], F.col("namespace"))),
        picked("name", F.coalesce(metadata["name"], F.col("name"))),
        picked("labels", map_or_empty(metadata["labels"])),
        picked("annotations", map_or_empty(metadata["annotations"])),
        F.when(~given, F.col("spec")).when(~failed, F.col("_read.spec")).alias("spec"),
        F.when(~failed, F.col("document")).alias("document"),
        F.when(unread, "raw_overrides is no JSON object")
        .when(failed, "the overridden manifest has no readable metadata and spec")
        .alias("override_error"),
    )


def claims(requests: DataFrame) -> DataFrame:
    """New volume claims the requests need; volumes with an existing claim need none."""
    volumes = requests.select("namespace", F.explode("storage").alias("volume"))
    return volumes.where(blank_to_null("volume.existing_claim").isNull()).select(
        "namespace",
        F.col("volume.name").alias("claim_name"),
        F.coalesce(F.col("volume.access_mode"), F.lit("ReadWriteOnce")).alias("access_mode"),
        F.col("volume.size").alias("size"),
        blank_to_null("volume.storage_class").alias("storage_class"),
    )

import json

from pyspark.sql import functions as F

from fleetlens.functions.documents import canonical_json
from fleetlens.operators import errors, inventory, joins
from fleetlens.sources.readers import parse_resources


def specs(spark, **documents):
    return spark.createDataFrame([("ns", n, s) for n, s in documents.items()], "namespace string, name string, spec string")


def test_reconcile(spark, rows):
    desired = specs(
        spark, new='{"a": 1}', same='{"a": 1, "b": {"c": [1, 2]}}', number='{"a": 1}', list='{"a": [1, 2]}',
        changed='{"a": 1}', broken="not json",
    )
    existing = specs(
        spark, same='{"b": {"c": [1, 2]}, "a": 1}', number='{"a": 1.0}', list='{"a": [2, 1]}',
        changed='{"a": 2}', broken="not json", other="{}",
    )
    assert rows(joins.reconcile(desired, existing), "name", "outcome") == [
        ("broken", "UNCHANGED"), ("changed", "CONFLICT"), ("list", "CONFLICT"), ("new", "CREATE"),
        ("number", "UNCHANGED"), ("same", "UNCHANGED"),
    ]


def test_canonical_json_keeps_large_numbers_and_repeated_keys(one):
    assert one(canonical_json("a"), values=['{"b":12345678901234567890,"a":null}']) == '{"a":null,"b":12345678901234567890}'
    assert one(canonical_json("a"), values=['[1e2, 1.0, 0.50, "1e2"]']) == '[100,1,0.5,"1e2"]'
    repeated = '{"a":1,"a":2}'
    assert one(canonical_json("a"), values=[repeated]) == repeated


def fleet(spark):
    clusters = spark.createDataFrame([("n1", "a"), ("n1", "b"), ("n2", "c")], "namespace string, name string")
    jobs = spark.createDataFrame(
        [("n1", "a", "j1", "Running"), ("n1", "x", "j2", "PENDING"), ("n1", "b", "j3", "FAILED"),
         ("n3", "c", "j4", "RUNNING"), ("n2", "c", "j5", None)],
        "namespace string, cluster_name string, job string, state string",
    )
    return clusters, jobs


def test_delete_blockers_ignore_the_cluster_name(spark, rows):
    clusters, jobs = fleet(spark)
    assert rows(joins.delete_blockers(clusters, jobs)) == [("n1", "a", 1, 1), ("n1", "b", 1, 1)]
    assert rows(joins.delete_blockers(clusters, jobs, scoped=True)) == [("n1", "a", 1, 0)]
    assert rows(joins.blocking_jobs(clusters, jobs), "job") == [("j1",), ("j2",)]
    assert rows(joins.blocking_jobs(clusters, jobs, scoped=True), "job") == [("j1",)]


def test_resolve_endpoints(spark, rows):
    clusters = spark.createDataFrame([("n", c) for c in "abcde"], "namespace string, name string")
    routes = spark.createDataFrame(
        [("n", 2, "a-head-svc", "late", True), ("n", 0, "a-head-svc", "", True), ("n", 1, "a-head-svc", "first", None),
         ("m", 0, "b-head-svc", "elsewhere", False)],
        "namespace string, pos int, to_name string, host string, tls boolean",
    )
    ingresses = spark.createDataFrame(
        [("n", 0, [(None, ["b-head-svc"]), ("rule2", ["x", "b-head-svc"])], ["rule2"]),
         ("n", 1, [("rule3", ["b-head-svc", "c-head-svc"]), ("a-rule", ["a-head-svc"])], None),
         ("n", 2, [("rule4", None)], [])],
        "namespace string, pos int, rules array<struct<host:string,backends:array<string>>>, tls_hosts array<string>",
    )
    got = rows(joins.resolve_endpoints(clusters, routes, ingresses), "name", "dashboard_url")
    assert got == [("a", "http://first"), ("b", "https://rule2"), ("c", "http://rule3"), ("d", None), ("e", None)]


def test_endpoint_of_jobs(spark, rows):
    jobs = spark.createDataFrame([("n", "a", 1), ("n", "", 2), ("n", "z", 3)], "namespace string, cluster_name string, job int")
    ends = spark.createDataFrame([("n", "a", "u")], "namespace string, name string, dashboard_url string")
    assert rows(joins.endpoint_of_jobs(jobs, ends), "job", "dashboard_url", "error") == [
        (1, "u", None), (2, None, "job has no cluster name"), (3, None, None),
    ]


def test_hardware_profiles(spark):
    def profile(name, scheduling):
        identifiers = [
            {"identifier": "cpu", "defaultCount": "1"}, {"identifier": "memory", "defaultCount": ""},
            {"identifier": "cpu", "defaultCount": "4"}, {"defaultCount": "9"},
        ]
        return {"metadata": {"name": name}, "spec": {"identifiers": identifiers, "scheduling": scheduling}}

    both = {
        "node": {"nodeSelector": {"gpu": "yes"}, "tolerations": [{"key": "k"}]},
        "kueue": {"localQueueName": "q", "priorityClass": "high"},
    }
    docs = [profile("node", {"schedulingType": "Node", **both}), profile("queue", {"schedulingType": "Queue", **both}),
            profile("odd", {"schedulingType": "Odd", **both}), {"metadata": {"name": "bare"}, "spec": {}}]
    profiles = parse_resources(spark.createDataFrame([(json.dumps(d),) for d in docs], "value string"), "hardware_profile")
    names = ["node", "queue", "odd", "bare", "gone", None]
    requests = spark.createDataFrame([(n,) for n in names], "hardware_profile string")
    got = {r.hardware_profile: r for r in joins.apply_hardware_profiles(requests, profiles).collect()}
    assert len(got) == len(names)
    assert got["node"].resources == {"cpu": "4"} and got["node"].node_selector == {"gpu": "yes"}
    assert got["node"].tolerations == [{"key": "k"}] and got["node"].queue is None
    assert (got["queue"].queue, got["queue"].priority_class) == ("q", "high")
    assert got["queue"].node_selector == {} and got["queue"].tolerations == []
    assert got["odd"].queue is None and got["odd"].node_selector == {}
    assert got["bare"].resources == {} and got["bare"].profile_error is None
    assert got["gone"].profile_error == "hardware profile not found: gone" and got[None].profile_error is None
    named = [{**profile("p", {}), "metadata": {"name": "p", "namespace": n}} for n in ("n", "m")]
    both = parse_resources(spark.createDataFrame([(json.dumps(d),) for d in named], "value string"), "hardware_profile")
    asked = spark.createDataFrame([("n", "p"), ("o", "p")], "namespace string, hardware_profile string")
    placed = joins.apply_hardware_profiles(asked, both, namespace="namespace").collect()
    assert sorted((r.namespace, r.profile_error) for r in placed) == [("n", None), ("o", "hardware profile not found: p")]


def test_presets_override_values_equal_to_the_default(spark):
    requests = spark.createDataFrame(
        [("data-processing", 1, 1.0, 0, "2Gi", None), ("data-processing", 3, 2.5, 2, "9Gi", "2.0"),
         ("nope", 1, 1.0, 0, "2Gi", None), (None, None, None, None, None, None)],
        "preset string, workers int, cpus_per_worker double, gpus_per_worker int, memory_per_worker string, ray_version string",
    ).withColumn("head", F.lit(None).cast("struct<cpus:double,memory:string,gpus:int,ray_start_params:map<string,string>>"))
    got = joins.apply_presets(requests, joins.builtin_presets(spark)).collect()
    by = {(r.preset, r.workers): r for r in got}
    filled = by["data-processing", 4]
    assert (filled.cpus_per_worker, filled.memory_per_worker, filled.ray_version) == (2.0, "4Gi", "2.41.0")
    assert (filled.head.cpus, filled.head.memory) == (2.0, "4Gi")
    kept = by["data-processing", 3]
    assert (kept.cpus_per_worker, kept.gpus_per_worker, kept.memory_per_worker, kept.ray_version) == (2.5, 2, "9Gi", "2.0")
    assert by["nope", 1].preset_error == "unknown preset: nope" and by["nope", 1].head is None
    assert by[None, 1].preset_error is None and by[None, 1].memory_per_worker == "2Gi"


def test_plan_scale(spark, rows):
    requests = spark.createDataFrame(
        [("n", "a", 5), ("n", "b", 2), ("n", "c", 0)], "namespace string, name string, workers int"
    )
    groups = spark.createDataFrame(
        [("n", "a", 0, "g0", 1, 1, 2), ("n", "a", 1, "g1", 7, 6, 8), ("n", "z", 0, "g", 1, 1, 1), ("n", "c", 0, "g", 1, 1, 1)],
        "namespace string, name string, pos int, group_name string, replicas int, min_replicas int, max_replicas int",
    )
    assert rows(joins.plan_scale(requests, groups).drop("namespace")) == [
        ("a", 0, "g0", 5, 5, 5, None), ("a", 1, "g1", 7, 6, 8, None), ("b", 0, "default-workers", 2, 2, 2, None),
        ("c", None, None, None, None, None, "workers must be at least 1"),
    ]


def test_lookup(spark, rows):
    requests = spark.createDataFrame([("n", "a"), ("n", "b")], "namespace string, name string")
    found = spark.createDataFrame([("n", "a", "RUNNING")], "namespace string, name string, state string")
    assert rows(joins.lookup(requests, found, "cluster"), "name", "error") == [("a", None), ("b", "CLUSTER_NOT_FOUND")]
    assert rows(joins.lookup(requests, found, "queue"), "name", "error") == [("a", None), ("b", "NOT_FOUND")]


NODES = "cluster string, node string, resource string, quantity string, http_status int"
TYPES = "cluster string, crd_name string, labels map<string,string>, annotations map<string,string>, http_status int"


def test_gpu_types_and_capabilities(spark):
    nodes = spark.createDataFrame(
        [("ok", "n1", "nvidia.com/GPU", "2", None), ("ok", "n2", "amd.com/gpu", "1", None), ("ok", "n2", "cpu", "8", None),
         ("ok", "n3", "intel.com/gpu", "0", None), ("none", "n", "gpu", "", None), ("denied", None, None, None, 403),
         ("broken", "n", "nvidia.com/gpu", "1", None), ("types", "n", "nvidia.com/gpu", "1", None)],
        NODES,
    )
    gpus = {r.cluster: (r.gpu_types, r.gpu_available) for r in inventory.gpu_types(nodes).collect()}
    assert gpus["ok"] == (["amd.com/gpu", "nvidia.com/GPU"], True)
    assert gpus["none"] == ([], False) and gpus["denied"] == ([], None)
    label, note = inventory.VERSION_LABEL, inventory.VERSION_ANNOTATION
    types = spark.createDataFrame(
        [("ok", inventory.CLUSTER_TYPE, {label: "v1"}, {note: "v0"}, None), ("ok", inventory.QUEUEING_TYPE, None, None, None),
         ("none", inventory.CLUSTER_TYPE, {label: ""}, {note: "v0"}, None), ("none", inventory.PLATFORM_TYPE, None, None, None),
         ("denied", "other", None, None, None), ("types", None, None, None, 403), ("broken", None, None, None, 500)],
        TYPES,
    )
    caps = inventory.capabilities(types, nodes)
    got = {r.cluster: r for r in caps.collect()}
    assert (got["ok"].installed, got["ok"].version, got["ok"].queueing, got["ok"].platform) == (True, "v1", True, False)
    assert got["none"].version == "v0" and got["none"].platform is True and got["none"].gpu_available is False
    assert got["denied"].gpu_available is None and got["denied"].queueing is False
    denied = got["types"]
    assert (denied.installed, denied.version, denied.queueing, denied.platform) == (False, None, None, None)
    assert denied.gpu_available is True
    assert got["broken"].error and got["broken"].gpu_available is None and got["broken"].queueing is None
    view = {(r.cluster, r.capability): r.status for r in inventory.capability_view(caps).collect()}
    assert view["ok", "gpu"] == "amd.com/gpu, nvidia.com/GPU" and view["none", "gpu"] == "not available"
    assert view["denied", "gpu"] == "unknown" and view["ok", "operator"] == "v1"
    assert view["types", "queueing"] == "not installed" and view["none", "platform"] == "detected"


def test_platform_flags_and_missing_types(spark, rows):
    groups = spark.createDataFrame(
        [("a", "route.openshift.io"), ("a", "apps"), ("b", None)], "cluster string, group_name string"
    )
    assert rows(inventory.platform_flags(groups)) == [("a", True, False, False), ("b", False, False, False)]
    types = spark.createDataFrame([("a", t) for t in inventory.REQUIRED_TYPES] + [("b", "rayjobs.ray.io"), ("c", None)],
                                  "cluster string, crd_name string")
    assert rows(inventory.missing_api_types(types)) == [
        ("b", "rayclusters.ray.io"), ("b", "rayservices.ray.io"), ("c", "rayclusters.ray.io"),
        ("c", "rayjobs.ray.io"), ("c", "rayservices.ray.io"),
    ]


def test_podsets(spark, rows, one):
    groups = spark.createDataFrame([("a", i) for i in range(7)] + [("b", i) for i in range(8)], "name string, i int")
    assert rows(inventory.podset_counts(groups, ["name"])) == [("a", 8, False), ("b", 9, True)]
    assert one(inventory.podsets_of("a"), "a array<int>", [[]]) == 1 and one(inventory.podsets_of("a"), "a array<int>") == 1


def test_error_classes(spark):
    cases = [
        (404, "RayCluster", "CLUSTER_NOT_FOUND"), (404, "RayJob", "JOB_NOT_FOUND"), (404, "RayService", "SERVICE_NOT_FOUND"),
        (404, "Pod", "NOT_FOUND"), (404, None, "NOT_FOUND"), (401, "Pod", "AUTHENTICATION"), (403, "Pod", "AUTHENTICATION"),
        (409, "Pod", "CONFLICT"), (422, "Pod", "VALIDATION"), (500, "Pod", "SERVER_ERROR"), (599, "Pod", "SERVER_ERROR"),
        (429, "Pod", "GENERIC"), (600, "Pod", "GENERIC"), (None, "Pod", "GENERIC"),
    ]
    df = spark.createDataFrame(cases, "http_status int, kind string, expected string")
    got = errors.classify_errors(df).collect()
    assert all(r.category == r.expected and r.remediation for r in got)
    assert {r.http_status for r in got if r.transient} == {429, 500}


def test_transient(one):
    def test(status, name):
        return one(errors.is_transient("a", "b"), "a int, b string", [status, name])

    assert all(test(s, None) for s in (429, 500, 502, 503, 504))
    assert not any(test(s, None) for s in (400, 401, 404, 409, 422, 501, None))
    assert test(None, "ReadTimeoutError") and test(400, "ConnectionError") and test(None, "BrokenPipe")
    assert not test(None, "ValueError")


def test_requests_of_one_profile_are_dealt_over_tasks(spark, rows):
    """Hot names, known, unknown and missing, give what they give undealt, from several tasks."""
    docs = [{"metadata": {"name": n}, "spec": {"identifiers": [{"identifier": "cpu", "defaultCount": n}]}} for n in ("1", "2")]
    docs.append({"metadata": {}, "spec": {"identifiers": [{"identifier": "cpu", "defaultCount": "9"}]}})
    profiles = parse_resources(spark.createDataFrame([(json.dumps(d),) for d in docs], "value string"), "hardware_profile")
    asked = [(i, name) for i, name in enumerate(["gone"] * 40 + ["1"] * 40 + [None] * 40 + ["2"])]
    requests = spark.createDataFrame(asked, "i int, hardware_profile string")

    def shown(**how):
        joined = joins.apply_hardware_profiles(requests, profiles, **how)
        return joined.selectExpr("i", "hardware_profile", "resources['cpu'] AS cpu", "profile_error", "spark_partition_id() AS part")

    got = shown(hot_rows=5, partitions=6)
    error = "hardware profile not found: gone"
    expected = [(i, n, n if n in ("1", "2") else None, error if n == "gone" else None) for i, n in asked]
    assert sorted(tuple(r)[:4] for r in got.collect()) == expected == sorted(tuple(r)[:4] for r in shown().collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tasks = {(r.hardware_profile, r.part) for r in shown(hot_rows=5, partitions=6).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert all(len({p for n, p in tasks if n == name}) > 1 for name in ("gone", "1", None))

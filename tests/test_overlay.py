import json
import random

import pytest
from pyspark.sql import functions as F

from fleetlens.functions import documents
from fleetlens.operators import overlay
from fleetlens.operators.validation import RULES, validate

LEAVES = "id int, path string, value string"


def merged(base, override):
    out = dict(base)
    for key, value in override.items():
        both = isinstance(out.get(key), dict) and isinstance(value, dict)
        out[key] = merged(out[key], value) if both else value
    return out


def leaves(document, path=()):
    if isinstance(document, dict) and (document or not path):
        return [leaf for key, value in document.items() for leaf in leaves(value, (*path, key))]
    escaped = "/".join(step.replace("~", "~0").replace("/", "~1") for step in path)
    return [(escaped, json.dumps(document))]


def random_document(rng, depth=3):
    kinds = ["number", "list", "null", "empty"] + ["object"] * (3 if depth else 0)
    out = {}
    for key in rng.sample(["a", "b", "c", "d/e"], rng.randint(0, 3)):
        kind = rng.choice(kinds)
        out[key] = {
            "number": rng.randrange(9), "list": [rng.randrange(3)], "null": None, "empty": {},
            "object": random_document(rng, depth - 1) if depth else {},
        }[kind]
    return out


def pairs(count=300):
    rng = random.Random(11)
    fixed = [
        ({"a": 1}, {"a": {"b": 2}}), ({"a": {"b": 1}}, {"a": 2}), ({"a": [1, 2]}, {"a": [3]}), ({"a": {"b": 1}}, {"a": None}),
        ({"a": {"b": 1}}, {"a": {}}), ({"a": 1}, {"a": {}}), ({"a": {}}, {"a": {"b": {}}}), ({"a": {}}, {"a": {}}),
        ({}, {"a": {}}), ({"ab": 1, "a": {"b": 1}}, {"a": 5}), ({"a": {"b": {"c": 1}}}, {"a": {"b": {}}}),
    ]
    return fixed + [(random_document(rng), random_document(rng)) for _ in range(count)]


def test_path_codes_keep_what_lies_below_together(spark):
    """Whatever characters keys hold: a path is followed at once by all that lies below it."""
    parts = ["a", "a!", "a\x00", "a\x01", "a\x01\x02", "\x00", "b", "ä", "a~1b", " "]
    paths = [*parts, *(f"{x}/{y}" for x in parts for y in parts), *(f"{x}/{y}/z" for x in parts for y in parts)]
    rows = spark.createDataFrame([(p,) for p in paths], "path string").orderBy(overlay.path_code("path")).collect()
    found = [r.path for r in rows]
    assert sorted(found) == sorted(paths)
    for k, top in enumerate(found):
        inner = [p.startswith(top + "/") for p in found]
        assert inner[k + 1 :] == sorted(inner[k + 1 :], reverse=True) and not any(inner[:k])


@pytest.mark.parametrize("steps", [1, 2, 3])
def test_deep_merge_equals_recursive_merge(spark, steps):
    documents_ = pairs()
    base = spark.createDataFrame([(i, *leaf) for i, (b, _) in enumerate(documents_) for leaf in leaves(b)], LEAVES)
    override = spark.createDataFrame([(i, *leaf) for i, (_, o) in enumerate(documents_) for leaf in leaves(o)], LEAVES)
    expected = sorted((i, *leaf) for i, (b, o) in enumerate(documents_) for leaf in leaves(merged(b, o)))
    assert sorted(tuple(r) for r in overlay.deep_merge(base, override, steps=steps).collect()) == expected


def test_merge_leaves_equals_recursive_merge(spark):
    documents_ = pairs()
    kind = "array<struct<path:string,value:string>>"
    df = spark.createDataFrame([(i, leaves(b), leaves(o)) for i, (b, o) in enumerate(documents_)],
                               f"id int, base {kind}, override {kind}")
    got = df.select("id", overlay.merge_leaves(F.col("base"), F.col("override")).alias("m")).collect()
    for row in got:
        b, o = documents_[row.id]
        assert sorted(tuple(leaf) for leaf in row.m) == sorted(leaves(merged(b, o))), (b, o)


def test_merge_json_equals_recursive_merge(spark):
    documents_ = pairs(40)
    df = spark.createDataFrame([(i, json.dumps(b), json.dumps(o)) for i, (b, o) in enumerate(documents_)],
                               "id int, b string, o string")
    for row in df.select("id", documents.merge_json("b", "o").alias("m")).collect():
        assert json.loads(row.m) == merged(*documents_[row.id])
    untouched = spark.createDataFrame([('{"a":1}', None), ('{"a":1}', "")], "b string, o string")
    assert {r.m for r in untouched.select(documents.merge_json("b", "o").alias("m")).collect()} == {'{"a":1}'}


def test_escape_key(one):
    assert one(overlay.escape_key("a"), values=["a/b~c"]) == "a~1b~0c"


def test_resolve_settings(spark, rows):
    layers = spark.createDataFrame(
        [("a", "default", 0, "timeout", "60"), ("a", "file", 1, "timeout", "10"), ("a", "env", 2, "timeout", "5"),
         ("b", "default", 0, "timeout", "60"), ("b", "file", 1, "timeout", "10"), ("b", "env", 2, "timeout", None),
         ("c", "default", 0, "timeout", "60"), ("c", "env", 2, "timeout", "5"), ("c", "env", 2, "namespace", "e"),
         ("c", "explicit", 3, "namespace", "x"), ("d", "env", 2, "namespace", "")],
        "id string, layer string, precedence int, key string, value string",
    )
    assert rows(overlay.resolve_settings(layers)) == [
        ("a", "timeout", "5", "env"), ("b", "timeout", "10", "file"), ("c", "namespace", "x", "explicit"),
        ("c", "timeout", "60", "default"), ("d", "namespace", "", "env"),
    ]


MAPS = "a map<string,string>, b map<string,string>"


def test_merge_env(one):
    env = documents.merge_env("a", "b")
    assert one(env, MAPS, [{"x": "1", "y": "1"}, {"y": "2", "z": "2"}]) == {"x": "1", "y": "2", "z": "2"}
    assert one(env, MAPS, [None, None]) == {} and one(env, MAPS, [{"x": "1"}, None]) == {"x": "1"}


def test_tracking_env_and_queue_labels(one):
    env = documents.tracking_env(F.lit("u"), F.lit(""), F.col("b"))
    assert one(env, MAPS, [None, {"MLFLOW_TRACKING_URI": "v", "k": "1"}]) == {"MLFLOW_TRACKING_URI": "v", "k": "1"}
    named = documents.tracking_env(F.lit("u"), F.lit("e"), F.col("b"))
    assert one(named, MAPS, [None, None]) == {"MLFLOW_TRACKING_URI": "u", "MLFLOW_EXPERIMENT_NAME": "e"}
    labels = documents.queue_labels("a", F.lit("q"), F.lit(None).cast("string"))
    assert one(labels, MAPS, [{documents.QUEUE_LABEL: "old", "x": "1"}, None]) == {documents.QUEUE_LABEL: "q", "x": "1"}
    ranked = documents.queue_labels("a", F.lit("q"), F.lit("high"))
    assert one(ranked, MAPS, [None, None]) == {documents.QUEUE_LABEL: "q", documents.PRIORITY_LABEL: "high"}


GROUP = """array<struct<name:string,replicas:int,cpus:double,gpus:int,memory:string,min_replicas:int,
  max_replicas:int,gpu_type:string,ray_start_params:map<string,string>>>"""
VOLUME = """array<struct<name:string,mount_path:string,size:string,existing_claim:string,access_mode:string,
  storage_class:string>>"""
REQUEST = f"""namespace string, name string, workers int, cpus_per_worker double, gpus_per_worker int,
  memory_per_worker string, worker_groups {GROUP}, ray_version string, image string, storage {VOLUME},
  labels map<string,string>, node_selector map<string,string>, tolerations array<map<string,string>>, queue string,
  enable_autoscaling boolean, raw_overrides string, entrypoint string, import_path string, serve_config_v2 string,
  num_replicas int,
  runtime_env struct<pip:array<string>,conda:string,env_vars:map<string,string>,working_dir:string,py_modules:array<string>>"""


def requests(spark, *given):
    names = spark.createDataFrame([], REQUEST).columns
    return spark.createDataFrame([tuple(g.get(n) for n in names) for g in given], REQUEST)


def spec(spark, kind="cluster", **given):
    row = overlay.desired_state(requests(spark, {"name": "x", **given}), kind).first()
    return row, json.loads(row.spec)


def test_cluster_spec_defaults(spark):
    row, got = spec(spark)
    limits = {"cpu": "1", "memory": "2Gi"}

    def pod(name):
        container = {"name": name, "image": "rayproject/ray:2.41.0", "resources": {"requests": limits, "limits": limits}}
        return {"spec": {"containers": [container]}}

    assert row.namespace == "default" and row.labels == {} and row.annotations == {}
    assert got == {
        "rayVersion": "2.41.0",
        "headGroupSpec": {"rayStartParams": {"dashboard-host": "0.0.0.0"}, "template": pod("ray-head")},
        "workerGroupSpecs": [{
            "groupName": "default-workers", "replicas": 1, "minReplicas": 1, "maxReplicas": 1, "rayStartParams": {},
            "template": pod("ray-worker"),
        }],
    }


def test_cluster_spec_of_full_request(spark):
    group = ("g", 2, 0.5, 1, None, 1, None, "amd.com/gpu", {"k": "v"})
    row, got = spec(
        spark, namespace="n", worker_groups=[group], workers=9, ray_version="2.9.0", queue="q", labels={"l": "1"},
        storage=[("data", "/d", "1Gi", None, None, None), ("old", "/o", None, "claim", None, None)],
        node_selector={"s": "1"}, tolerations=[{"key": "t"}], enable_autoscaling=True,
        raw_overrides='{"metadata": {"labels": {"o": "2"}}, "spec": {"rayVersion": null, "extra": {"a": 1}}}',
    )
    assert row.labels == {"l": "1", "kueue.x-k8s.io/queue-name": "q", "o": "2"}
    worker = got["workerGroupSpecs"][0]
    assert (worker["groupName"], worker["replicas"], worker["minReplicas"], worker["maxReplicas"]) == ("g", 2, 1, 2)
    pod = worker["template"]["spec"]
    assert pod["containers"][0]["resources"]["limits"] == {"cpu": "0.5", "memory": "2Gi", "amd.com/gpu": "1"}
    assert pod["containers"][0]["volumeMounts"] == [{"name": "data", "mountPath": "/d"}, {"name": "old", "mountPath": "/o"}]
    assert [v["persistentVolumeClaim"]["claimName"] for v in pod["volumes"]] == ["data", "claim"]
    assert pod["nodeSelector"] == {"s": "1"} and pod["tolerations"] == [{"key": "t"}]
    assert got["enableInTreeAutoscaling"] is True and got["rayVersion"] is None and got["extra"] == {"a": 1}


def test_overrides_reach_the_whole_manifest(spark):
    over = {"apiVersion": "v9", "extra": [1], "metadata": {"namespace": "m", "name": "y", "finalizers": ["f"],
            "labels": {"o": None}}, "spec": {"rayVersion": {"a": 1.50}}}
    row, got = spec(spark, namespace="n", labels={"l": "1"}, raw_overrides=json.dumps(over))
    assert (row.namespace, row.name, row.labels, row.override_error) == ("m", "y", {"l": "1", "o": None}, None)
    document = json.loads(row.document)
    assert (document["apiVersion"], document["kind"], document["extra"]) == ("v9", "RayCluster", [1])
    assert document["metadata"]["finalizers"] == ["f"] and document["spec"] == got and got["rayVersion"] == {"a": 1.5}
    deep = '{"a":' * 5000 + "1" + "}" * 5000
    bad = ['{"spec": ', "[1]", "null", '"x"', '{"a": NaN}', deep, '{"spec": null}', '{"metadata": 1}']
    asked = requests(spark, *[{"name": str(i), "raw_overrides": text} for i, text in enumerate([*bad, None, " "])])
    rows = {r.name: r for r in overlay.desired_state(asked, "cluster").collect()}
    for i in range(len(bad)):
        assert rows[str(i)].override_error and rows[str(i)].spec is rows[str(i)].document is None
    plain = rows[str(len(bad))]
    assert plain.override_error is None and json.loads(plain.document)["spec"] == json.loads(plain.spec)


def test_job_spec(spark):
    env = (["torch"], None, {"A": "1"}, "", None)
    row, got = spec(spark, "job", entrypoint="run", queue="q", runtime_env=env, node_selector={"s": "1"}, workers=3,
                    worker_groups=[])
    assert got["entrypoint"] == "run" and got["shutdownAfterJobFinishes"] is True
    assert json.loads(got["runtimeEnvYAML"]) == {"pip": ["torch"], "env_vars": {"A": "1"}}
    assert "nodeSelector" not in got["rayClusterSpec"]["headGroupSpec"]["template"]["spec"]
    # An empty group list hides the flat fields, so the default size counts.
    assert got["rayClusterSpec"]["workerGroupSpecs"][0]["replicas"] == 1
    assert "runtimeEnvYAML" not in spec(spark, "job", entrypoint="run")[1]


def test_service_spec(spark):
    row, got = spec(spark, "service", import_path="a:b", num_replicas=2, queue="q", workers=3)
    assert row.labels == {}
    assert json.loads(got["serveConfigV2"])["applications"][0]["deployments"] == [{"name": "default", "num_replicas": 2}]
    assert got["rayClusterConfig"]["workerGroupSpecs"][0]["replicas"] == 3
    assert spec(spark, "service", serve_config_v2="applications: []")[1]["serveConfigV2"] == "applications: []"


def test_normalize_and_claims(spark, rows):
    group = ("g", 2, None, None, None, None, 5, None, None)
    df = requests(spark, {"name": "a", "namespace": "n", "workers": 3}, {"name": "b", "namespace": "n", "worker_groups": [group, group]})
    got = rows(overlay.normalize_worker_groups(df), "name", "pos", "group_name", "replicas", "min_replicas", "max_replicas")
    assert got == [("a", 0, "default-workers", 3, 3, 3), ("b", 0, "g", 2, 2, 5), ("b", 1, "g", 2, 2, 5)]
    volumes = [("data", "/d", "1Gi", None, None, ""), ("old", "/o", None, "claim", None, None), ("new", "/n", "2Gi", "", "X", "fast")]
    claims = overlay.claims(requests(spark, {"name": "a", "namespace": "n", "storage": volumes}))
    assert rows(claims) == [("n", "data", "ReadWriteOnce", "1Gi", None), ("n", "new", "X", "2Gi", "fast")]


def broken(spark, kind, **given):
    df = requests(spark, {"name": "ok", "namespace": "n", **given})
    extra = {"shutdown_after_finish": F.lit(given.get("shutdown", True)),
             "experiment_tracking": F.struct(F.lit(given.get("provider", "mlflow")).alias("provider"))}
    return {r.rule_id for r in validate(df.withColumns(extra), kind).collect()}


def volume(size="1Gi", claim=None, path="/d", mode="ReadWriteOnce"):
    return [("v", path, size, claim, mode, None)]


def group(replicas=1, low=None, high=None, name="g"):
    return (name, replicas, None, None, None, low, high, None, None)


@pytest.mark.parametrize(
    "kind, given, rules",
    [
        ("cluster", {}, set()),
        ("cluster", {"name": "a" * 63}, set()), ("cluster", {"name": "a" * 64}, {"V01"}), ("cluster", {"name": "-a"}, {"V01"}),
        ("cluster", {"name": "a-"}, {"V01"}), ("cluster", {"name": "Aa"}, {"V01"}), ("cluster", {"name": ""}, {"V01"}),
        ("cluster", {"worker_groups": [group(0)]}, {"V02"}),
        ("cluster", {"worker_groups": [group(2, 1, 3)]}, set()), ("cluster", {"worker_groups": [group(2, 3, None)]}, {"V03"}),
        ("cluster", {"worker_groups": [group(2, None, 1)]}, {"V03"}), ("cluster", {"worker_groups": [group(2, 2, 2)]}, set()),
        ("cluster", {"workers": 0, "cpus_per_worker": 0.0, "gpus_per_worker": -1}, {"V04", "V05", "V06"}),
        ("cluster", {"workers": 1, "worker_groups": [group()]}, set()),
        ("cluster", {"workers": 1, "worker_groups": [group()], "namespace": None}, {"V07"}),
        ("cluster", {"workers": 1, "worker_groups": [group()], "memory_per_worker": "1Gi"}, {"V07"}),
        ("cluster", {"worker_groups": [group()], "memory_per_worker": "1Gi"}, set()),
        ("job", {"entrypoint": "x", "workers": 1, "worker_groups": [group()]}, set()),
        ("job", {"entrypoint": "x", "workers": 1, "worker_groups": [group()], "gpus_per_worker": 1}, {"V08"}),
        ("job", {"entrypoint": " \t"}, {"V09"}), ("job", {}, {"V09"}),
        ("job", {"entrypoint": "x", "queue": "q", "shutdown": False}, {"V10"}),
        ("job", {"entrypoint": "x", "shutdown": False}, set()),
        ("job", {"entrypoint": "x", "provider": "other"}, {"V17"}),
        ("service", {"import_path": "a", "num_replicas": 1}, set()), ("service", {}, {"V11"}),
        ("service", {"import_path": "a", "serve_config_v2": "b"}, {"V11"}),
        ("service", {"import_path": "a", "num_replicas": 0}, {"V12"}),
        ("cluster", {"storage": volume()}, set()), ("cluster", {"storage": volume(claim="c")}, {"V13"}),
        ("cluster", {"storage": volume(size=None)}, {"V13"}), ("cluster", {"storage": volume(path="d")}, {"V14"}),
        ("cluster", {"storage": volume(mode="X")}, {"V15"}),
        ("cluster", {"runtime_env": (["a"], "env", None, None, None)}, {"V16"}),
        ("cluster", {"runtime_env": ([], "env", None, None, None)}, set()),
        ("cluster", {"queue": "q", "worker_groups": [group(name=f"g{i}") for i in range(7)]}, set()),
        ("cluster", {"queue": "q", "worker_groups": [group(name=f"g{i}") for i in range(8)]}, {"V18"}),
        ("cluster", {"worker_groups": [group(name=f"g{i}") for i in range(8)]}, set()),
        ("cluster", {"worker_groups": [group(), group()]}, {"V22"}),
        ("service", {"import_path": "a", "workers": 1, "worker_groups": [group()], "gpus_per_worker": 1}, set()),
    ],
)
def test_rules(spark, kind, given, rules):
    assert broken(spark, kind, **given) == rules


def test_other_records(spark):
    settings = spark.createDataFrame([("a", -1, 0.5, 60.0), ("b", 0, 0.5, 60.0), ("c", 3, 0.0, 1.0)],
                                     "name string, retry_max_attempts int, retry_backoff_factor double, retry_timeout double")
    assert sorted(r.name for r in validate(settings, "settings", ("name",)).collect()) == ["a", "c"]
    texts = spark.createDataFrame([("a", "3", "0.5", "x"), ("b", "3.5", "1", "1"), ("c", None, None, "1e3")],
                                  "name string, retry_max_attempts string, retry_backoff_factor string, retry_timeout string")
    assert sorted(r.name for r in validate(texts, "settings_text", ("name",)).collect()) == ["a", "b"]
    numbers = {"1": True, " -1.5e3 ": True, "1_000.5": True, ".5": True, "5.": True, "Inf": True, "nan": True,
               "1.0d": False, "": False, "1,5": False, "0x1": False, "1__0": False, ".": False}
    given = spark.createDataFrame([(n, None, n, None) for n in numbers], texts.schema)
    assert {r.name for r in validate(given, "settings_text", ("name",)).collect()} == {n for n, ok in numbers.items() if not ok}
    manifests = spark.createDataFrame(
        [("a", '{"apiVersion":1,"kind":1,"metadata":1,"spec":1}'), ("b", '{"kind":1}'), ("c", None), ("d", "[]")],
        "name string, manifest string")
    assert sorted(r.name for r in validate(manifests, "manifest", ("name",)).collect()) == ["b", "c", "d"]


def test_all_rules_are_there():
    assert [r.rule_id for r in RULES] == [f"V{i:02d}" for i in range(1, 23)]


def test_merge_json_equals_recursive_merge(spark):
    from fleetlens.functions.documents import merge_json

    documents_ = pairs()
    df = spark.createDataFrame([(i, json.dumps(b), json.dumps(o)) for i, (b, o) in enumerate(documents_)], "i int, b string, o string")
    got = {r.i: json.loads(r.m) for r in df.select("i", merge_json("b", "o").alias("m")).collect()}
    assert got == {i: merged(b, o) for i, (b, o) in enumerate(documents_)}


def test_merge_json_gives_up_what_it_cannot_merge(spark):
    from fleetlens.functions.documents import merge_json

    def deep(levels, value):
        return json.dumps(value) if not levels else '{"k": ' + deep(levels - 1, value) + "}"

    cases = [
        (deep(32, 1), deep(32, 2), json.loads(deep(32, 2))), (deep(33, 1), deep(33, 2), None), (deep(3, 1), deep(200, 2), json.loads(deep(200, 2))),
        ('{"a": 1}', '{"a": 1, "a": 2}', None), ('{"a": 1}', "[1]", None), ('{"a": 1}', '{"a": NaN}', None), ('{"a": 1}', "", {"a": 1}),
        ('{"a": 1}', None, {"a": 1}), (None, "{}", None), ('{"a": {"b": null}}', '{"a": {"c": null}}', {"a": {"b": None, "c": None}}),
        ('{"a": "x"}', '{"b": "\\u0000"}', {"a": "x", "b": "\x00"}),
    ]
    df = spark.createDataFrame([(i, b, o) for i, (b, o, _) in enumerate(cases)], "i int, b string, o string")
    got = {r.i: r.m and json.loads(r.m) for r in df.select("i", merge_json("b", "o").alias("m")).collect()}
    assert got == {i: want for i, (_, _, want) in enumerate(cases)}


def test_deep_merge_dealt_over_parts(spark, rows):
    schema = "id int, path string, value string"
    base = spark.createDataFrame([(i, p, "1") for i in range(20) for p in ("a/b/c", "a/b/d", "e", "f/g")], schema)
    over = spark.createDataFrame([(i, p, v) for i in range(0, 20, 2) for p, v in (("a/b", "2"), ("f", "{}"), ("e/x", "3"))], schema)
    for steps in (1, 2):
        dealt = overlay.deep_merge(base, over, steps=steps, partitions=7)
        assert dealt.rdd.getNumPartitions() == 7
        assert rows(dealt) == rows(overlay.deep_merge(base, over, steps=steps))

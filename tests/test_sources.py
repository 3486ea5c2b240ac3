import json

import pytest

from fleetlens.operators import status
from fleetlens.sources import readers
from fleetlens.sources.scratch import shared_folder
from fleetlens.sources.sinks import write_view


def dump(path, *documents):
    path.write_text("\n".join(json.dumps(d) for d in documents))
    return str(path)


def test_read_resources_takes_lists_and_single_documents(spark, tmp_path):
    def named(name):
        return {"metadata": {"name": name}}

    note = {"metadata": {"name": "d", "annotations": {"a": 'has "items" inside'}}}
    path = dump(tmp_path / "d.json", {"items": [named("a"), named("b")]}, named("c"), {"items": []}, note)
    got = readers.read_resources(spark, path, "queue")
    assert sorted(r.metadata.name for r in got.collect()) == ["a", "b", "c", "d"]


def test_read_resources_whole_file(spark, tmp_path):
    path = tmp_path / "d.json"
    path.write_text(json.dumps({"items": [{"metadata": {"name": "a"}}, {"metadata": {"name": "b"}}]}, indent=2))
    assert readers.read_resources(spark, str(path), "route", whole_file=True).count() == 2


@pytest.mark.parametrize("status_only", [True, False])
def test_status_does_not_need_the_pod_templates(spark, tmp_path, status_only):
    document = {"metadata": {"name": "a"}, "spec": {"rayVersion": "2", "headGroupSpec": {"template": {"spec": {}}}},
                "status": {"state": "ready"}}
    got = readers.read_resources(spark, dump(tmp_path / "d.json", document), "cluster", status_only=status_only)
    row = status.cluster_status(got, "2024-01-01T00:00:00Z").first()
    assert (row.state, row.version) == ("RUNNING", "2")


def test_routes_and_ingresses_keep_list_order_and_tls(spark, tmp_path):
    def route(name, tls):
        return {"metadata": {"name": name}, "spec": {"host": name, "to": {"name": "s"}, "tls": tls}}

    path = dump(tmp_path / "r.json", {"items": [route("a", None), route("b", {}), route("c", {"key": "k"})]})
    got = readers.routes_of(readers.read_resources(spark, path, "route")).collect()
    assert [(r.namespace, r.pos, r.host, r.tls) for r in got] == [
        ("default", 0, "a", False), ("default", 1, "b", False), ("default", 2, "c", True)]
    backend = {"backend": {"service": {"name": "s"}}}
    path = dump(tmp_path / "i.json", {"items": [
        {"metadata": {"name": "x"}, "spec": {"tls": [{"hosts": ["h"]}, {}], "rules": [{"host": "h", "http": {"paths": [backend]}}, {}]}},
        {"metadata": {"name": "y", "namespace": "n"}}]})
    first, second = readers.ingresses_of(readers.read_resources(spark, path, "ingress")).collect()
    assert [(r.host, r.backends) for r in first.rules] == [("h", ["s"]), (None, None)] and first.tls_hosts == ["h"]
    assert (second.namespace, second.pos, second.rules, second.tls_hosts) == ("n", 1, None, None)


def test_unknown_kind():
    with pytest.raises(ValueError):
        readers.schemas.resource_schema("pod")


def test_read_submissions(spark, tmp_path, rows):
    path = dump(
        tmp_path / "d.json",
        {"job_id": "j", "submission_id": "s", "status": "running", "start_time": 1500, "end_time": 0},
        {"job_id": "", "submission_id": "s2", "status": "FAILED", "start_time": 0, "end_time": 2500},
        {"submission_id": "s3"},
    )
    df = readers.read_submissions(spark, path)
    assert rows(df.selectExpr("job_id", "unix_millis(started_at) a", "unix_millis(ended_at) b")) == [
        ("j", 1500, None), ("s2", None, 2500), ("s3", None, None),
    ]


def test_read_inventory_and_metrics(spark, tmp_path, rows):
    nodes = dump(tmp_path / "n.json", {"cluster": "a", "node": "n", "allocatable": {"cpu": "4", "nvidia.com/gpu": "1"}},
                 {"cluster": "b", "http_status": 403})
    assert rows(readers.read_nodes(spark, nodes)) == [
        ("a", "n", "cpu", "4", None), ("a", "n", "nvidia.com/gpu", "1", None), ("b", None, None, None, 403),
    ]
    types = dump(tmp_path / "t.json", {"cluster": "a", "crd_name": "x", "labels": {"k": "v"}})
    assert rows(readers.read_api_types(spark, types), "crd_name", "labels.k", "http_status") == [("x", "v", None)]
    report = {"data": {"clusterStatus": {"loadMetricsReport": {"numAvailableCpus": 4.5, "numAvailableGpus": 1}}}}
    metrics = dump(
        tmp_path / "m.json",
        {"cluster": "a", "observed_at": "2024-01-01T00:00:00Z", "payload": json.dumps(report)},
        {"cluster": "b", "observed_at": "2024-01-01T00:00:00Z", "payload": "{}"},
        {"cluster": "c", "observed_at": "2024-01-01T00:00:00Z", "payload": "broken"},
    )
    got = rows(readers.read_metrics(spark, metrics), "cluster", "available_cpus", "available_gpus")
    assert got == [("a", 4.5, 1.0), ("b", None, None), ("c", None, None)]


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_write_view(spark, tmp_path, rows, fmt):
    view = spark.createDataFrame([("a", "RUNNING"), ("b", "FAILED")], "name string, state string")
    path = str(tmp_path / fmt)
    write_view(view, path, fmt, ["state"])
    assert rows(spark.read.format(fmt).load(path), "name", "state") == [("a", "RUNNING"), ("b", "FAILED")]
    with pytest.raises(ValueError):
        write_view(view, path, "csv")


def test_shared_folder_is_below_the_named_one(spark):
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    first, second = shared_folder(spark), shared_folder(spark)
    assert first.startswith(root) and first != second


def test_broken_lines_are_no_resources(spark):
    from fleetlens.sources.readers import parse_resources, rejected_resources

    lines = [
        "", "   ", "not json", '{"metadata": {"name": "a"', '{"metadata": {"name": "b"}, "status": {"readyWorkerReplicas": "three"}}',
        '{"metadata": {"name": "c"}}', '{"items": [{"metadata": {"name": "d"}}, {"metadata": 5}]}', None,
    ]
    dump = spark.createDataFrame([(x,) for x in lines], "value string")
    for status_only in (False, True):
        kept = parse_resources(dump, "cluster", status_only=status_only)
        assert sorted(r.metadata.name for r in kept.collect()) == ["c", "d"]
        assert rejected_resources(dump, "cluster", status_only=status_only).count() == 4


def test_log_files_are_numbered_across_ranges(spark, tmp_path):
    """Files cut into ranges of 64 bytes give the lines of the whole text, with their numbers."""
    import random

    rng = random.Random(6)
    texts = {
        "plain": "a\nb\nc", "ended": "a\nb\n", "blank": "\n\n\n", "one": "no line feed", "long": "x" * 1000 + "\n" + "y" * 300 + "\nz",
        "other": "a\rb\r\nc\u2028d\n", "wide": "äöü😀" * 50 + "\n" + "é\n" * 90, "many": "".join("w" * rng.randrange(40) + "\n" for _ in range(500)),
        "border": ("q" * 63 + "\n") * 20, "after": "\n" + ("q" * 63 + "\n") * 9 + "r",
    }
    (tmp_path / "logs").mkdir()
    for name, text in texts.items():
        (tmp_path / "logs" / name).write_bytes(text.encode())
    settings = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "0"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        found = readers.read_log(spark, str(tmp_path / "logs"))
        assert spark.read.text(str(tmp_path / "logs")).rdd.getNumPartitions() > 100
        got = sorted((r.file.rsplit("/", 1)[1], r.line_no, r.line) for r in found.collect())
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert got == sorted((name, k, line) for name, text in texts.items() for k, line in enumerate(text.split("\n")))

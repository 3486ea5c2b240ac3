"""Typed lines split into rows and rejects, and streams landed batch by batch."""

import json

import pytest

from fleetlens.operators import inventory, validation
from fleetlens.sources import readers
from fleetlens.streaming import landing

LINES = [
    ('{"job_id": "a", "status": "RUNNING", "start_time": 5}', None),
    ('{"submission_id": "b", "unknown": [1, {"x": 2}]}', None),
    ("   ", "blank"),
    ("", "blank"),
    ('{"job_id": ', readers.NO_OBJECT),
    ('[{"job_id": "in a list"}]', readers.NO_OBJECT),
    ("3", readers.NO_OBJECT),
    ("null", readers.NO_OBJECT),
    ('{"job_id": "c", "start_time": "soon"}', readers.WRONG_TYPE),
    ('{"job_id": "c", "metadata": 7}', readers.WRONG_TYPE),
    ('{"job_id": "", "submission_id": null}', readers.UNNAMED),
    ("{}", readers.UNNAMED),
]


def test_every_line_is_a_row_or_a_reject(spark):
    lines = spark.createDataFrame([(text,) for text, _ in LINES] + [(None,)], "value string")
    typed = readers.typed_lines(lines, readers.SUBMISSION_LINES)
    assert {r.raw: r.reason for r in typed.collect()} == {t: why for t, why in LINES if why != "blank"}
    assert sorted(str(r.job_id) for r in readers.rows_of(typed).collect()) == ["None", "a"]
    assert readers.rejects_of(typed).count() == 8


def test_landed_parses_once(spark, tmp_path):
    (tmp_path / "dump").mkdir()
    (tmp_path / "dump" / "d.json").write_text("\n".join(t for t, _ in LINES))
    rows, rejects = readers.landed(spark, str(tmp_path / "dump"), readers.SUBMISSION_LINES, str(tmp_path / "out"))
    assert rows.count() == 2 and rejects.count() == 8
    assert sorted(p.name for p in (tmp_path / "out").glob("rejected=*")) == ["rejected=false", "rejected=true"]


@pytest.mark.parametrize(
    "fmt, good, wrong",
    [
        (readers.NODE_LINES, {"cluster": "c", "node": "n"}, {"cluster": "c", "allocatable": "many"}),
        (readers.API_TYPE_LINES, {"cluster": "c"}, {"cluster": "c", "http_status": "soon"}),
        (readers.METRIC_LINES, {"cluster": "c", "observed_at": "2024-01-01T00:00:00Z"}, {"cluster": "c", "observed_at": "later"}),
        (readers.SNAPSHOT_LINES, {"name": "n", "seq": 1, "observed_at": "2024-01-01T00:00:00Z"}, {"name": "n", "seq": "first"}),
    ],
)
def test_formats(spark, fmt, good, wrong):
    lines = spark.createDataFrame([(json.dumps(x),) for x in (good, wrong, {"other": 1})] + [("{",)], "value string")
    found = readers.typed_lines(lines, fmt).collect()
    assert [r.reason for r in found] == [None, readers.WRONG_TYPE, readers.UNNAMED, readers.NO_OBJECT]


def test_members_without_a_name_meet_themselves(spark):
    types = spark.createDataFrame([(None, inventory.CLUSTER_TYPE), ("a", inventory.CLUSTER_TYPE)], "cluster string, crd_name string")
    types = types.selectExpr("*", "map('x', 'y') AS labels", "map('x', 'y') AS annotations", "CAST(NULL AS int) AS http_status")
    nodes = spark.createDataFrame([(None, "nvidia.com/gpu", "1", None), ("b", None, None, 403)], "cluster string, resource string, quantity string, http_status int")
    found = {r.cluster: r for r in inventory.capabilities(types, nodes).collect()}
    assert set(found) == {None, "a", "b"} and len(found) == 3
    assert found[None].installed and found[None].gpu_available
    assert found["a"].gpu_available is None and found["a"].gpu_types == []
    assert not found["b"].installed and found["b"].gpu_available is None


def test_rules_that_cannot_be_checked_are_named(spark):
    requests = spark.createDataFrame([("ns", "a", 0)], "namespace string, name string, workers int")
    missing = {r.rule_id: r.missing for r in validation.unchecked(requests, "job").collect()}
    assert missing["V10"] == ["queue", "shutdown_after_finish"] and "V04" not in missing and "V12" not in missing
    checked = {rule.rule_id for rule in validation.rules_for("job", requests.columns)}
    assert checked.isdisjoint(missing) and checked | set(missing) == {r.rule_id for r in validation.RULES if "job" in r.kinds}


def batches(folder, *files):
    folder.mkdir(exist_ok=True)
    for name, lines in files:
        (folder / name).write_text("\n".join(lines))


def line(name, seq):
    return json.dumps({"name": name, "seq": seq, "observed_at": "2024-01-01T00:00:00Z"})


def names(spark, out):
    rows = landing.read_landed(spark, out, "rows", "name string, seq bigint")
    rejects = landing.read_landed(spark, out, "rejects", "raw string, reason string")
    return sorted(r.name for r in rows.collect()), sorted(r.raw for r in rejects.collect())


def run(spark, source, out, checkpoint):
    typed = landing.line_stream(spark, str(source), max_files_per_trigger=1)
    landing.land_lines(typed, out, checkpoint).trigger(availableNow=True).start().awaitTermination()


def test_replayed_batch_replaces_itself(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    assert names(spark, out) == ([], [])
    batches(source, ("1.json", [line("a", 1), "{"]), ("2.json", [line("b", 2)]))
    run(spark, source, out, checkpoint)
    assert names(spark, out) == (["a", "b"], ["{"])
    # The last batch again, as after a crash before the checkpoint knew of it.
    typed = readers.typed_lines(spark.createDataFrame([(line("b", 2),)], "value string"), readers.SNAPSHOT_LINES)
    landing.write_batch(typed, 1, out, {"rows": readers.rows_of, "rejects": readers.rejects_of}, checkpoint)
    assert names(spark, out) == (["a", "b"], ["{"])
    # A part of a batch that was not recorded is not seen, and replaced by its next try.
    readers.rows_of(typed).write.parquet(f"{out}/rows/batch=2")
    assert names(spark, out) == (["a", "b"], ["{"])
    batches(source, ("3.json", [line("c", 3), "[]"]))
    run(spark, source, out, checkpoint)
    assert names(spark, out) == (["a", "b", "c"], ["[]", "{"])
    counts = {r.batch: r.counts for r in landing.commits(spark, out).collect()}
    assert sum(c["rows"] for c in counts.values()) == 3 and sum(c["rejects"] for c in counts.values()) == 2


def test_folder_belongs_to_one_checkpoint(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    batches(source, ("1.json", [line("a", 1)]))
    run(spark, source, out, str(tmp_path / "one"))
    with pytest.raises(ValueError, match="landed from the checkpoint"):
        run(spark, source, out, str(tmp_path / "two"))
    (tmp_path / "one" / "offsets" / "0").unlink()
    with pytest.raises(ValueError, match="does not know batch"):
        run(spark, source, out, str(tmp_path / "one"))

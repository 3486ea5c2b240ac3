import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from fleetlens.operators import series
from fleetlens.operators.series import Polls
from fleetlens.sources.scratch import shared_folder
from fleetlens.streaming import flows, stateful

POLLS = Polls(keys=("namespace", "name"), ts="at", seq="seq", state="state", head_ready="head_ready")
SCHEMA = "namespace string, name string, at timestamp, seq bigint, state string, head_ready boolean"
START = dt.datetime(2024, 1, 1)
SECOND = 1_000_000


def poll(i, name, seconds, state, ready=False):
    return ("n", name, START + dt.timedelta(seconds=seconds), i, state, ready)


def random_polls(states, count=160, resources=8):
    rng = random.Random(5)
    seconds = sorted(rng.randrange(300) for _ in range(count))
    return [
        poll(i, f"r{rng.randrange(resources)}", at, rng.choice(states), rng.random() < 0.2)
        for i, at in enumerate(seconds)
    ]


def as_stream(spark, polls, batches=4, per_trigger=1):
    """Polls in time order as one file per micro-batch."""
    folder = shared_folder(spark)
    size = -(-len(polls) // batches)
    for number in range(batches):
        part = spark.createDataFrame(polls[number * size:(number + 1) * size], SCHEMA)
        path = f"{folder}/batch-{number}.json"
        text = "\n".join(part.toJSON().collect())
        os.makedirs(folder, exist_ok=True)
        with open(path, "w") as f:
            f.write(text)
        os.utime(path, (1_700_000_000 + number * 10,) * 2)
    return flows.snapshot_stream(spark, folder, SCHEMA, max_files_per_trigger=per_trigger)


def drain(stream):
    folder = shared_folder(stream.sparkSession)
    query = flows.write_stream_view(stream, f"{folder}/rows", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.exception() is None
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/rows")


# Another resource polled much later moves the watermark past every timeout.
CLOSING = poll(10_000, "closing", 100_000, "CREATING")


@pytest.mark.parametrize("batches", [1, 4])
def test_wait_ready_stream_equals_batch(spark, rows, batches):
    polls = random_polls(["CREATING", "RUNNING", "FAILED"])
    polls.append(poll(900, "edge", 301, "CREATING"))
    polls.append(poll(901, "edge", 401, "RUNNING", True))
    stream = as_stream(spark, [*polls, CLOSING], batches)
    got = rows(drain(stateful.wait_ready_stream(stream, 100 * SECOND, POLLS)).where("name <> 'closing'"))
    batch = series.wait_ready(spark.createDataFrame(polls, SCHEMA), 100 * SECOND, POLLS)
    assert got == rows(batch)
    assert {r[2] for r in got} == {"READY", "TIMEOUT"}


def test_streams_do_not_depend_on_the_size_of_python_batches(spark, rows):
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "3")
    try:
        polls = random_polls(["CREATING", "RUNNING", "FAILED"])
        batch = spark.createDataFrame(polls, SCHEMA)
        stream = as_stream(spark, [*polls, CLOSING], 2)
        waits = drain(stateful.wait_ready_stream(stream, 100 * SECOND, POLLS)).where("name <> 'closing'")
        assert rows(waits) == rows(series.wait_ready(batch, 100 * SECOND, POLLS))
        edges = drain(stateful.transitions_stream(as_stream(spark, [*polls, CLOSING], 2), "cluster", POLLS)).drop("at_us")
        assert rows(edges) == rows(series.transitions(batch, F.lit("cluster"), POLLS).drop("at"))
    finally:
        spark.conf.set(setting, before)


def test_wait_terminal_stream_equals_batch(spark, rows):
    polls = random_polls(["pending", "running", "suspended", "running", "running", "failed"])
    stream = as_stream(spark, [*polls, CLOSING])
    got = rows(drain(stateful.wait_terminal_stream(stream, 20 * SECOND, "DASHBOARD", POLLS)).where("name <> 'closing'"))
    batch = series.wait_terminal(spark.createDataFrame(polls, SCHEMA), 20 * SECOND, "DASHBOARD", POLLS)
    assert got == rows(batch) and {r[2] for r in got} == {"TERMINAL", "TIMEOUT"}


@pytest.mark.parametrize("batches", [1, 4])
def test_streams_do_not_depend_on_the_order_of_arrival(spark, rows, batches):
    polls = random_polls(["CREATING", "RUNNING", "SUSPENDED", None])
    arriving = random.Random(3).sample(polls, len(polls))
    batch = spark.createDataFrame(polls, SCHEMA)
    stream = as_stream(spark, [*arriving, CLOSING], batches)
    edges = drain(stateful.transitions_stream(stream, "cluster", POLLS, "10 minutes")).drop("at_us")
    assert rows(edges) == rows(series.transitions(batch, F.lit("cluster"), POLLS).drop("at"))
    stream = as_stream(spark, [*arriving, CLOSING], batches)
    waits = drain(stateful.wait_ready_stream(stream, 100 * SECOND, POLLS, "10 minutes")).where("name <> 'closing'")
    assert rows(waits) == rows(series.wait_ready(batch, 100 * SECOND, POLLS))


def test_one_resource_fills_a_batch(spark, rows):
    states = ["CREATING", "RUNNING", "SUSPENDED"]
    polls = [poll(i, "hot" if i % 50 else "cold", i, states[i // 7 % 3]) for i in range(3000)]
    stream = as_stream(spark, [*reversed(polls), CLOSING], 1)
    got = drain(stateful.transitions_stream(stream, "cluster", POLLS)).drop("at_us")
    assert rows(got) == rows(series.transitions(spark.createDataFrame(polls, SCHEMA), F.lit("cluster"), POLLS).drop("at"))


def test_late_polls_count_within_the_delay_only(spark, rows):
    polls = [poll(0, "a", 0, "CREATING"), poll(1, "a", 100, "RUNNING"), poll(2, "b", 101, "RUNNING"),
             poll(3, "b", 102, "RUNNING"), poll(4, "a", 50, "FAILED"), CLOSING]

    def edges(delay):
        stream = as_stream(spark, polls, 3)
        return rows(drain(stateful.transitions_stream(stream, "cluster", POLLS, delay)), "from_state", "to_state", "dwell_us")
    assert edges("1 minute") == [("CREATING", "FAILED", 50 * SECOND), ("FAILED", "RUNNING", 50 * SECOND)]
    assert edges("1 second") == [("CREATING", "RUNNING", 100 * SECOND)]


def test_a_session_without_rocksdb_is_refused(spark):
    before = spark.conf.get(stateful.STATE_STORE_SETTING)
    spark.conf.unset(stateful.STATE_STORE_SETTING)
    try:
        with pytest.raises(ValueError, match="RocksDB"):
            stateful.transitions_stream(as_stream(spark, [CLOSING], 1), "cluster", POLLS)
    finally:
        spark.conf.set(stateful.STATE_STORE_SETTING, before)


def test_log_follow_keeps_blank_but_not_empty_lines(spark, rows):
    lines = spark.createDataFrame([("j", 0, "a"), ("j", 1, ""), ("j", 2, " "), ("j", 3, None)], "job_id string, line_no int, line string")
    assert rows(flows.log_follow(lines), "line") == [(" ",), ("a",)]


def test_heartbeat_and_counts(spark, rows):
    polls = [poll(0, "a", 1, "CREATING"), poll(1, "a", 3, "RUNNING"), poll(2, "b", 12, "FAILED"), CLOSING]
    beats = drain(flows.progress_heartbeat(as_stream(spark, polls, 2), "10 seconds", POLLS, "0 seconds"))
    assert rows(beats, "name", "state", "polls") == [("a", "RUNNING", 2), ("b", "FAILED", 1)]
    counts = drain(flows.state_counts_stream(as_stream(spark, polls, 2), "10 seconds", None, POLLS))
    assert rows(counts, "state", "polls") == [("CREATING", 1), ("FAILED", 1), ("RUNNING", 1)]
    sliding = drain(flows.state_counts_stream(as_stream(spark, polls, 2), "10 seconds", "5 seconds", POLLS))
    assert sum(r.polls for r in sliding.collect()) == 6


def test_on_progress_survives_a_failing_callback(spark):
    seen = []

    def callback(batch, number):
        seen.append(batch.count())
        if number == 1:
            raise RuntimeError("callback failed")

    polls = random_polls(["RUNNING"], 40)
    writer = flows.on_progress(as_stream(spark, polls, 4), callback)
    query = writer.option("checkpointLocation", shared_folder(spark)).trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.exception() is None and seen == [10, 10, 10, 10]

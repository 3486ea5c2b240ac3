"""What streams hold of a resource: paged buckets, NULL keys, and state that is dropped in time."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fleetlens.operators import series
from fleetlens.operators.series import Polls
from fleetlens.streaming import stateful
from tests.test_streams import CLOSING, POLLS, SCHEMA, SECOND, START, as_stream, drain, poll, random_polls


@pytest.mark.parametrize("bucket_us", [1000, 7 * SECOND, 3600 * SECOND])
@pytest.mark.parametrize("batches", [1, 5])
def test_width_of_buckets_does_not_matter(spark, rows, bucket_us, batches):
    """Polls at, and just before, the borders of buckets, in any order of arrival."""
    rng = random.Random(8)
    polls = random_polls(["CREATING", "RUNNING", "FAILED"], 120, 4)
    for k in range(30):
        at = START + dt.timedelta(seconds=7 * k) - dt.timedelta(milliseconds=k % 3)
        polls.append(("n", f"r{k % 3}", at, 500 + k, rng.choice(["CREATING", "RUNNING"]), k % 5 == 0))
    batch = spark.createDataFrame(polls, SCHEMA)
    rng.shuffle(polls)
    stream = as_stream(spark, [*polls, CLOSING], batches)
    edges = drain(stateful.transitions_stream(stream, "cluster", POLLS, "10 minutes", bucket_us)).drop("at_us")
    assert rows(edges) == rows(series.transitions(batch, F.lit("cluster"), POLLS).drop("at"))
    stream = as_stream(spark, [*polls, CLOSING], batches)
    waits = drain(stateful.wait_ready_stream(stream, 100 * SECOND, POLLS, "10 minutes", bucket_us))
    assert rows(waits.where("name <> 'closing'")) == rows(series.wait_ready(batch, 100 * SECOND, POLLS))


def test_null_keys_equal_batch(spark, rows):
    polls = [
        (None if i % 2 else "n", None if i % 5 == 0 else f"r{i % 3}", at, seq, state, ready)
        for i, (_, _, at, seq, state, ready) in enumerate(random_polls(["pending", "running", "failed"]))
    ]
    batch = spark.createDataFrame(polls, SCHEMA)
    got = drain(stateful.wait_terminal_stream(as_stream(spark, [*polls, CLOSING]), 60 * SECOND, "DASHBOARD", POLLS))
    assert rows(got.where("NOT name <=> 'closing'")) == rows(series.wait_terminal(batch, 60 * SECOND, "DASHBOARD", POLLS))
    got = drain(stateful.transitions_stream(as_stream(spark, [*polls, CLOSING]), "job", POLLS)).drop("at_us")
    assert rows(got) == rows(series.transitions(batch, F.lit("job"), POLLS).drop("at"))


def test_keys_keep_their_types(spark, rows):
    names = Polls(keys=("day", "price", "id"), ts="at", seq="seq", state="state")
    schema = "day timestamp, price decimal(9,2), id long, at timestamp, seq long, state string"
    day = dt.datetime(2024, 2, 3, 4, 5, 6, 789012)
    polls = [(day, 12, 1 << 60, START + dt.timedelta(seconds=s), s, state) for s, state in enumerate("ABBA")]
    typed = spark.createDataFrame([(d, None, *rest) for d, _, *rest in polls], schema)
    from fleetlens.sources.scratch import shared_folder

    folder = shared_folder(spark)
    typed.unionByName(spark.createDataFrame([(None, None, 2, START + dt.timedelta(days=1), 9, "A")], schema)).write.parquet(folder)
    stream = spark.readStream.schema(schema).parquet(folder)
    got = drain(stateful.transitions_stream(stream, "cluster", names))
    assert [r[:6] for r in rows(got.drop("at_us"))] == [(day, None, 1 << 60, 1, "A", "B"), (day, None, 1 << 60, 3, "B", "A")]


def test_a_hot_resource_is_held_bucket_by_bucket(spark, rows, monkeypatch):
    """A batch with 40,000 polls of one resource: the folds see one bucket at a time."""
    states = ["CREATING", "RUNNING", "SUSPENDED"]
    polls = [poll(i, "hot", i, states[i // 7 % 3]) for i in range(40_000)]

    class Narrow(stateful.EdgeProcessor):
        def fold(self, key, polls, passed):
            if len(polls) > 600:
                raise MemoryError(f"{len(polls)} polls at once")
            yield from super().fold(key, polls, passed)

    monkeypatch.setattr(stateful, "EdgeProcessor", Narrow)
    later = poll(50_000, "closing", 1_000_000, "CREATING")
    got = drain(stateful.transitions_stream(as_stream(spark, [*polls, later], 1), "cluster", POLLS)).drop("at_us")
    assert rows(got) == rows(series.transitions(spark.createDataFrame(polls, SCHEMA), F.lit("cluster"), POLLS).drop("at"))


def test_ended_waits_are_forgotten(spark, rows):
    """A mark is dropped so long after the wait's limit; then a resource of that name is a new one."""
    polls = [poll(0, "a", 0, "CREATING"), poll(1, "a", 10, "RUNNING", True), poll(2, "a", 150, "RUNNING", True)]
    later = [poll(3, "x", 5000, "CREATING"), poll(4, "x", 5001, "CREATING"), poll(5, "a", 9000, "CREATING"), poll(6, "a", 9005, "RUNNING", True)]

    def outcomes(forget_us):
        stream = as_stream(spark, [*polls, *later, CLOSING], 4)
        found = drain(stateful.wait_ready_stream(stream, 100 * SECOND, POLLS, "1 second", forget_us=forget_us))
        return sorted((r.outcome, r.elapsed_us) for r in found.where("name = 'a'").collect())

    assert outcomes(None) == [("READY", 10 * SECOND)]
    assert outcomes(1000 * SECOND) == [("READY", 5 * SECOND), ("READY", 10 * SECOND)]


def test_idle_resources_are_forgotten(spark, rows):
    polls = [poll(0, "a", 0, "CREATING"), poll(1, "a", 10, "RUNNING"), poll(2, "x", 5000, "A"), poll(3, "x", 5001, "A"),
             poll(4, "a", 9000, "FAILED"), poll(5, "a", 9010, "RUNNING"), CLOSING]

    def edges(forget_us):
        found = drain(stateful.transitions_stream(as_stream(spark, polls, 3), "cluster", POLLS, "1 second", forget_us=forget_us))
        return sorted((r.from_state, r.to_state) for r in found.collect())

    assert edges(None) == [("CREATING", "RUNNING"), ("FAILED", "RUNNING"), ("RUNNING", "FAILED")]
    assert edges(1000 * SECOND) == [("CREATING", "RUNNING"), ("FAILED", "RUNNING")]


def test_polls_far_apart_cost_few_calls_to_the_store(spark, rows, monkeypatch):
    """Polls of one resource that lie in a bucket each are held in one value, up to so many."""
    polls = [poll(i, "r", 700 * i, "AB"[i // 3 % 2]) for i in range(60)]
    closing = poll(10_000, "closing", 1_000_000, "CREATING")

    class Unpaged(stateful.EdgeProcessor):
        def hold(self, bucket, polls):
            raise MemoryError("a page for every bucket")

    expected = rows(series.transitions(spark.createDataFrame(polls, SCHEMA), F.lit("cluster"), POLLS).drop("at"))
    with monkeypatch.context() as patched:
        patched.setattr(stateful, "EdgeProcessor", Unpaged)
        got = drain(stateful.transitions_stream(as_stream(spark, [*polls, closing], 3), "cluster", POLLS)).drop("at_us")
        assert rows(got) == expected


@pytest.mark.parametrize("batches", [1, 5])
def test_one_value_or_pages_does_not_matter(spark, rows, monkeypatch, batches):
    polls = random_polls(["CREATING", "RUNNING", "FAILED"], 160, 2)
    expected = rows(series.transitions(spark.createDataFrame(polls, SCHEMA), F.lit("cluster"), POLLS).drop("at"))

    class Small(stateful.EdgeProcessor):
        held_polls = 7

    monkeypatch.setattr(stateful, "EdgeProcessor", Small)
    stream = as_stream(spark, [*polls, CLOSING], batches)
    got = drain(stateful.transitions_stream(stream, "cluster", POLLS, "20 seconds", 7 * SECOND)).drop("at_us")
    assert rows(got) == expected

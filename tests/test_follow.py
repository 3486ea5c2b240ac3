"""Heartbeats of silent resources, and logs followed until their job ends."""

import datetime as dt
import json
import os
import random
from collections import defaultdict

import pytest

from fleetlens.operators.series import Polls
from fleetlens.sources.scratch import shared_folder
from fleetlens.streaming import flows, following, stateful
from tests.test_streams import POLLS, SECOND, START, as_stream, drain, poll, random_polls

START_US = int(START.replace(tzinfo=dt.UTC).timestamp()) * SECOND


def brute_beats(polls, interval, passed, silent=None):
    """(name, end second, state, polls) of every closed interval, poll by poll."""
    own = defaultdict(list)
    for _, name, at, seq, state, _ in polls:
        own[name].append((int((at - START).total_seconds()), seq, state))
    out = []
    for name, rows in own.items():
        rows.sort()
        for end in range(interval, passed + 1, interval):
            before = [r for r in rows if r[0] < end]
            if before and (silent is None or end <= before[-1][0] + silent + interval):
                out.append((name, end, before[-1][2], sum(r[0] >= end - interval for r in before)))
    return sorted(out, key=str)


@pytest.mark.parametrize("batches", [1, 5])
@pytest.mark.parametrize("silent", [None, 60])
@pytest.mark.parametrize("bucket", [7, 3600])
def test_heartbeats_equal_brute_force(spark, batches, silent, bucket):
    polls = random_polls(["CREATING", "RUNNING", None], 60, 5)
    polls += [poll(900 + k, "quiet", at, "RUNNING") for k, at in enumerate((3, 20, 21, 290))]
    arriving = [*random.Random(2).sample(polls, len(polls)), poll(999, "closing", 1000, "CREATING")]
    stream = as_stream(spark, arriving, batches)
    found = drain(
        stateful.heartbeat_stream(stream, 20 * SECOND, POLLS, "5 minutes", bucket * SECOND, silent and silent * SECOND)
    )
    got = [(r.name, int((r.window_end - START).total_seconds()), r.state, r.polls) for r in found.collect()]
    assert sorted(got, key=str) == brute_beats(polls, 20, 700, silent)


def test_a_long_silence_is_many_rows(spark):
    stream = as_stream(spark, [poll(0, "a", 0, "RUNNING"), poll(1, "b", 50_000, "RUNNING"), poll(2, "b", 50_001, "RUNNING")], 3)
    found = drain(stateful.heartbeat_stream(stream, 2 * SECOND, POLLS, "1 second"))
    assert found.where("name = 'a'").count() == 25_000 and found.where("name = 'a' AND polls > 0").count() == 1


LINES = "job string, at timestamp, n int, line string"


def test_lines_after_the_end_are_left_out(spark):
    rng = random.Random(4)
    second = lambda s: START + dt.timedelta(seconds=s)
    jobs = [None, "a", "b", "c"]
    lines = [(rng.choice(jobs), second(rng.randrange(200)), k, rng.choice(["x", "y", ""])) for k in range(120)]
    states = [(job, second(at), k, state) for k, (job, at, state) in enumerate([
        ("a", 50, "RUNNING"), ("a", 80, "SUCCEEDED"), ("a", 120, "FAILED"), (None, 100, "FAILED"), ("b", 10, "SUSPENDED"), ("gone", 1, "FAILED"),
    ])]
    closing = [("z", second(1000), 999, "x")], [("z", second(1000), 999, "RUNNING"), ("z", second(1000), 998, "SUCCEEDED")]
    folder = shared_folder(spark)
    spark.createDataFrame(lines + closing[0], LINES).repartition(3).write.json(f"{folder}/lines")
    spark.createDataFrame(states + closing[1], "job string, at timestamp, seq int, state string").write.json(f"{folder}/states")
    polls = Polls(keys=("job",), ts="at", seq="seq", state="state")
    followed = flows.log_follow_until_end(
        flows.snapshot_stream(spark, f"{folder}/lines", LINES),
        flows.snapshot_stream(spark, f"{folder}/states", "job string, at timestamp, seq int, state string"),
        ["job"], "at", polls=polls, delay="5 minutes",
    )
    got = sorted(r.n for r in drain(followed).collect())
    ends = {"a": second(80), None: second(100)}
    assert got == sorted(n for job, at, n, line in lines if line and not (job in ends and at > ends[job]))
    assert any(job == "a" and at > second(80) and line for job, at, _, line in lines)


def in_batches(spark, rows, schema, batches):
    """Rows of JSON texts as one file per micro-batch."""
    folder = shared_folder(spark)
    os.makedirs(folder)
    size = -(-len(rows) // batches)
    for number in range(batches):
        path = f"{folder}/batch-{number}.json"
        with open(path, "w") as f:
            f.write("\n".join(json.dumps(row) for row in rows[number * size:(number + 1) * size]))
        os.utime(path, (1_700_000_000 + number * 10,) * 2)
    return flows.snapshot_stream(spark, folder, schema, max_files_per_trigger=1)


FOLLOWED = Polls(keys=("job", "part"), ts="seen", seq="seq", state="state")
LINE_ROWS = "job string, part int, logged_at timestamp, n bigint, share double, time string, line string"
POLL_ROWS = "job string, part bigint, seen timestamp, seq int, state string"


def text_of(second):
    return (START + dt.timedelta(seconds=second)).isoformat() + ".000Z"


@pytest.mark.parametrize("batches, page_rows", [(1, 10_000), (1, 3), (6, 3)])
def test_ends_count_for_the_horizon_in_any_order_of_arrival(spark, monkeypatch, batches, page_rows):
    monkeypatch.setattr(following, "PAGE_ROWS", page_rows)
    rng = random.Random(11)
    jobs = [(None, 1), ("a", 1), ("a", None), ("b", 2), ("c", 3)]
    lines = [(*rng.choice(jobs), rng.randrange(600), k, rng.choice(["x", "", " "])) for k in range(300)]
    ends = [(*rng.choice(jobs[:4]), rng.randrange(600), rng.choice(["SUCCEEDED", "FAILED", "RUNNING"])) for _ in range(24)]
    ends += [(*jobs[3], at, "STOPPED") for at in range(200, 260)]
    lines, ends = (sorted(rows, key=lambda r: r[2] + rng.randrange(200)) for rows in (lines, ends))
    big = 2**53 + 1
    rows = [{"job": j, "part": p, "logged_at": text_of(at), "n": big + k, "time": "t", "line": line} for j, p, at, k, line in lines]
    rows.append({"job": "z", "logged_at": text_of(5000), "n": 0, "line": "x"})
    rows.insert(0, {"job": "z", "logged_at": None, "n": 0, "line": "x"})
    polls = [{"job": j, "part": p, "seen": text_of(at), "state": state} for j, p, at, state in ends]
    polls.append({"job": "z", "seen": text_of(5000), "state": "FAILED"})
    followed = flows.log_follow_until_end(
        in_batches(spark, rows, LINE_ROWS, batches), in_batches(spark, polls, POLL_ROWS, batches),
        ["job", "part"], polls=FOLLOWED, delay="10 minutes", horizon="40 seconds", groups=3,
    )
    assert followed.columns == [c.split()[0] for c in LINE_ROWS.split(", ")]
    got = sorted(((r.job, r.part, int((r.logged_at - START).total_seconds()), r.n - big, r.line) for r in drain(followed).collect()), key=str)

    def left_out(job, part, at):
        return any((j, p) == (job, part) and end < at <= end + 40 for j, p, end, state in ends if state != "RUNNING")

    assert got == sorted((r for r in lines if r[4] and not left_out(*r[:3])), key=str)
    assert 50 < len(got) < len([r for r in lines if r[4]]) - 20


def test_polls_after_the_end_hold_no_state_of_their_own(spark):
    lines = [{"job": "a", "part": 1, "logged_at": text_of(at), "n": at, "line": "x"} for at in range(1000)]
    polls = [{"job": "a", "part": 1, "seen": text_of(at), "state": "FAILED"} for at in range(500, 1500)]
    followed = flows.log_follow_until_end(
        in_batches(spark, lines, LINE_ROWS, 1), in_batches(spark, polls, POLL_ROWS, 1), ["job", "part"], polls=FOLLOWED
    )
    folder = shared_folder(spark)
    query = flows.write_stream_view(followed, f"{folder}/rows", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.read.parquet(f"{folder}/rows").count() == 501
    held = [state.numRowsTotal for p in query.recentProgress for state in p.stateOperators]
    assert held and max(held) < 20


def test_tables_are_followed_without_a_watermark(spark):
    lines = spark.createDataFrame([("a", START + dt.timedelta(seconds=s), s, "x") for s in range(10)], LINES)
    polls = spark.createDataFrame([("a", START + dt.timedelta(seconds=4), 0, "FAILED")], "job string, at timestamp, seq int, state string")
    followed = flows.log_follow_until_end(lines, polls, ["job"], "at", polls=Polls(keys=("job",), ts="at", seq="seq", state="state"))
    assert sorted(r.n for r in followed.collect()) == [0, 1, 2, 3, 4]

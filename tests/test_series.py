import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fleetlens.operators import series
from fleetlens.operators.series import Polls

POLLS = Polls(keys=("name",), ts="at", seq="seq", state="state", head_ready="head_ready", message="message")
SCHEMA = "name string, at timestamp, seq bigint, state string, head_ready boolean, message string"
START = dt.datetime(2024, 1, 1)
SECOND = 1_000_000


def snaps(spark, *polls):
    """Polls given as (name, seconds, state, head ready)."""
    data = [
        (name, START + dt.timedelta(seconds=at), i, state, ready, "m")
        for i, (name, at, state, ready) in enumerate(polls)
    ]
    return spark.createDataFrame(data, SCHEMA)


def test_latest_breaks_ties_by_sequence(spark, rows):
    df = snaps(spark, ("a", 0, "CREATING", False), ("a", 5, "RUNNING", True), ("a", 5, "FAILED", False))
    assert rows(series.latest_snapshot(df, POLLS), "name", "state") == [("a", "FAILED")]


WAITS = [
    ("first", 0, "RUNNING", True),
    ("edge", 0, "CREATING", False), ("edge", 10, "RUNNING", True),
    ("head", 0, "CREATING", False), ("head", 5, "RUNNING", False), ("head", 20, "RUNNING", True),
    ("failed", 0, "FAILED", False), ("failed", 9, "RUNNING", True),
    ("null", 0, "RUNNING", None),
]


@pytest.mark.parametrize("hot_rows", [10, 1])
def test_wait_ready(spark, rows, hot_rows):
    got = series.wait_ready(snaps(spark, *WAITS), 10 * SECOND, POLLS, hot_rows=hot_rows)
    assert rows(got) == [
        ("edge", "TIMEOUT", None, "CREATING", False),
        ("failed", "READY", 9 * SECOND, "RUNNING", True),
        ("first", "READY", 0, "RUNNING", True),
        ("head", "TIMEOUT", None, "RUNNING", False),
        ("null", "TIMEOUT", None, "RUNNING", None),
    ]


def test_wait_with_a_given_start_keeps_resources_without_polls_in_time(spark, rows):
    df = snaps(spark, ("late", 100, "RUNNING", True), ("soon", 3, "RUNNING", True)).withColumn(
        "started", F.lit(START)
    )
    got = series.wait_ready(df, 10 * SECOND, POLLS, started_at="started")
    assert rows(got) == [("late", "TIMEOUT", None, None, None), ("soon", "READY", 3 * SECOND, "RUNNING", True)]


def test_wait_terminal(spark, rows):
    df = snaps(
        spark, ("a", 0, "running", False), ("a", 4, "succeeded", False), ("a", 6, "failed", False),
        ("b", 0, "suspended", False), ("b", 2, "unknown", False),
    )
    got = series.wait_terminal(df, 10 * SECOND, "DASHBOARD", POLLS, ["message"])
    assert rows(got) == [
        ("a", "TERMINAL", 4 * SECOND, "SUCCEEDED", "m"), ("b", "TIMEOUT", None, "UNKNOWN", "m"),
    ]
    plain = series.wait_terminal(df, 10 * SECOND, "CRD", POLLS)
    assert {r.outcome for r in plain.collect()} == {"TIMEOUT"}
    with pytest.raises(ValueError):
        series.wait_terminal(df, 1, "OTHER", POLLS)


def random_polls(seed, resources=5, polls=120):
    rng = random.Random(seed)
    times = [(f"r{rng.randrange(resources)}", rng.randrange(400)) for _ in range(polls)]
    return [(n, at, rng.choice(["CREATING", "RUNNING", "SUSPENDED"]), rng.random() < 0.5) for n, at in times]


def brute_transitions(polls):
    out = []
    for name in {p[0] for p in polls}:
        own = sorted((at, i, state) for i, (n, at, state, _) in enumerate(polls) if n == name)
        entered = own[0][0]
        for (_, _, before), (at, i, state) in zip(own, own[1:]):
            if state != before:
                out.append((name, i, before, state, (at - entered) * SECOND))
                entered = at
    return sorted(out, key=lambda r: [str(v) for v in r])


@pytest.mark.parametrize("cell", [(1, 1), (1, 3), (1, None), (10 * SECOND, None), (series.CELL_US, None)])
def test_transitions_do_not_depend_on_cells(spark, rows, cell):
    """Cells of an instant, cut by sequence or not, of some polls, and of all."""
    polls = random_polls(cell[0] % 1000)
    got = series.transitions(snaps(spark, *polls), F.lit("cluster"), POLLS, *cell)
    assert rows(got, "name", "seq", "from_state", "to_state", "dwell_us") == brute_transitions(polls)


def test_transitions_flag_illegal_edges(spark, rows):
    df = snaps(spark, ("a", 0, "CREATING", False), ("a", 1, "RUNNING", True), ("a", 2, "CREATING", False))
    got = series.transitions(df, F.lit("cluster"), POLLS)
    assert rows(got, "to_state", "legal") == [("CREATING", False), ("RUNNING", True)]


@pytest.mark.parametrize("hot_rows", [4, 1000])
def test_progress_trace(spark, hot_rows):
    polls = random_polls(7)
    got = series.progress_trace(snaps(spark, *polls), "cluster", POLLS, hot_rows=hot_rows).collect()
    assert len(got) == len(polls)
    first = {n: min(p[1] for p in polls if p[0] == n) for n in {p[0] for p in polls}}
    for row in got:
        name, at, state, ready = polls[row.seq]
        assert row.elapsed_us == (at - first[name]) * SECOND
        assert row.message == f"State: {state}, head_ready: {ready}"


@pytest.mark.parametrize(
    "text, n, tail",
    [("a\nb\nc", 2, "b\nc"), ("a\nb", 5, "a\nb"), ("a\nb", 0, "a\nb"), ("a\nb", None, "a\nb"), ("a\nb\n", 1, ""),
     ("a\nb\n", 2, "b\n"), ("", 3, ""), ("a", -1, "a")],
)
def test_log_tail(spark, text, n, tail):
    df = spark.createDataFrame([("j", text)], "job_id string, text string")
    assert df.select(series.log_tail_text("text", n)).first()[0] == tail
    lines = series.log_tail(series.log_lines(df, "job_id", "text"), n)
    assert "\n".join(r.line for r in lines.orderBy("line_no").collect()) == tail


def test_long_log_tail(spark):
    lines = spark.range(50).selectExpr("if(id < 40, 'a', 'b') AS job_id", "id AS line_no", "'x' AS line")
    got = {(r.job_id, r.line_no) for r in series.log_tail(lines, 11).collect()}
    assert got == {("a", n) for n in range(29, 40)} | {("b", n) for n in range(40, 50)}


def test_log_metrics(spark, rows):
    lines = ["Epoch 1/10 — loss: 0.1234, train_acc: 0.9000, test_acc: 0.8000", "Training complete!", ""]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    assert rows(series.log_metrics(df).drop("line")) == [(1, 10, 0.1234, 0.9, 0.8)]


ATTEMPTS = "op_id string, attempt int, at bigint, http_status int, exception string"


@pytest.mark.parametrize(
    "tries, expected",
    [
        ([(0, 200, None)], ("SUCCESS", 1, 200)),
        ([(0, 503, None), (1, None, None)], ("SUCCESS", 2, None)),
        ([(0, 404, None), (1, 200, None)], ("NON_TRANSIENT", 1, 404)),
        ([(0, 503, None), (1, 429, None), (2, 500, None), (3, 200, None)], ("EXHAUSTED", 3, 500)),
        ([(0, 503, None), (60, 200, None)], ("TIMEOUT", 1, None)),
        ([(0, None, "ReadTimeoutError"), (2, None, "ValueError")], ("NON_TRANSIENT", 2, None)),
        ([(0, 503, None)], ("INCOMPLETE", 1, 503)),
        ([(0, 501, None)], ("NON_TRANSIENT", 1, 501)),
    ],
)
def test_retry_outcome(spark, tries, expected):
    data = [("o", i + 1, at, status, name) for i, (at, status, name) in enumerate(tries)]
    df = spark.createDataFrame(data, ATTEMPTS).withColumn("started_at", F.timestamp_seconds("at"))
    row = series.retry_outcome(df).first()
    assert (row.outcome, row.attempts, row.last_status) == expected


def test_retry_delay_ceiling_and_no_time_left(spark):
    data = [("a", 1, 0, 503, None), ("a", 2, 10, 503, None), ("b", 1, 0, 503, None), ("b", 2, 59, 503, None)]
    df = spark.createDataFrame(data, ATTEMPTS).withColumn("started_at", F.timestamp_seconds("at"))
    got = {r.op_id: r.delay_ceiling_us for r in series.retry_outcome(df, max_attempts=5, backoff=2.0).collect()}
    assert got == {"a": 4_000_000, "b": 1_000_000}
    ended = df.withColumn("ended", F.col("started_at") + F.expr("INTERVAL 1 SECOND"))
    done = {r.op_id: r.outcome for r in series.retry_outcome(ended, max_attempts=5, finished_at="ended").collect()}
    assert done == {"a": "INCOMPLETE", "b": "EXHAUSTED"}


def test_waits_and_traces_take_null_keys(spark):
    polls = [(None, "j", k, 1000 + k * 60, "SUCCEEDED" if k == 1 else "RUNNING") for k in range(3)]
    polls += [("n", "j", k, 1000 + k * 30, "RUNNING") for k in range(5)]
    df = spark.createDataFrame(polls, "namespace string, name string, seq long, t long, state string").selectExpr(
        "namespace", "name", "seq", "timestamp_seconds(t) AS observed_at", "state", "false AS head_ready", "'' AS message"
    )
    keyed = series.Polls(("namespace", "name"), "observed_at", "seq", "state", "head_ready", "message")
    for hot_rows in (1, 1000):
        got = {r.namespace: (r.outcome, r.elapsed_us) for r in series.wait_terminal(df, 3600 * SECOND, "DASHBOARD", keyed, hot_rows=hot_rows).collect()}
        assert got == {None: ("TERMINAL", 60 * SECOND), "n": ("TIMEOUT", None)}
        trace = series.progress_trace(df, "job", keyed, hot_rows=hot_rows).collect()
        assert len(trace) == 8 and all(r.elapsed_us is not None for r in trace)
        edges = series.transitions(df, F.lit("job"), keyed, 60 * SECOND * hot_rows).collect()
        assert [(r.namespace, r.from_state, r.to_state) for r in edges if r.seq == 1] == [(None, "RUNNING", "SUCCEEDED")]


def test_ties_and_hot_resources_are_cut(spark, rows):
    """Twenty thousand polls of one resource at one instant: groups of a hundred, and the same changes."""
    crowd = spark.range(20_000).selectExpr(
        "0L AS name", "id AS seq", "timestamp_seconds(1700000000) AS at", "IF(id % 7 = 0, 'RUNNING', 'SUSPENDED') AS state", "false AS head_ready"
    )
    polls = series.Polls(("name",), "at", "seq", "state", "head_ready")
    got = series.transitions(crowd, F.lit("cluster"), polls, 1, 100)
    assert got.count() == 2 * (20_000 // 7) and got.where("dwell_us <> 0").isEmpty()
    sizes = crowd.groupBy(F.expr("seq DIV 100")).count().agg(F.max("count")).first()[0]
    assert sizes == 100
    with pytest.raises(ValueError):
        series.transitions(crowd, F.lit("cluster"), polls, 1000, 100)


def test_polls_without_a_time_come_first(spark, rows):
    df = spark.createDataFrame(
        [("a", None, 5, "CREATING"), ("a", 3, 1, "RUNNING"), ("a", 7200, None, "FAILED"), (None, 1, 1, "RUNNING"), (None, 9000, 2, "FAILED")],
        "name string, t long, seq long, state string",
    ).selectExpr("name", "timestamp_seconds(t) AS at", "seq", "state", "false AS head_ready")
    polls = series.Polls(("name",), "at", "seq", "state", "head_ready")
    whole = rows(series.transitions(df, F.lit("cluster"), polls))
    assert len(whole) == 3 and whole == rows(series.transitions(df, F.lit("cluster"), polls, 3600 * SECOND))


def test_many_hot_keys_are_dealt_out(spark):
    from fleetlens.operators.skew import slice_hot_groups

    many = spark.range(12_000).selectExpr("id % 1200 AS k", "id AS seq", "timestamp_seconds(id) AS ts")
    stats = slice_hot_groups(many, ["k"], "ts", ["seq"], hot_rows=5).stats
    assert stats.where("_slices = 2").count() == 1200


def test_retry_attempts_give_every_wait(spark):
    """The backoff doubles, is cut by what is left of the time, and nothing follows the deciding attempt."""
    data = [("a", 1, 0, 503, None), ("a", 2, 10, 200, None), ("a", 3, 11, 503, None),
            ("b", 1, 0, 503, None), ("b", 2, 59, None, "ReadTimeoutError"), ("b", 3, 61, 200, None), ("c", 1, 0, 404, None)]
    df = spark.createDataFrame(data, ATTEMPTS).withColumn("started_at", F.timestamp_seconds("at"))
    rows = series.retry_attempts(df, max_attempts=5, backoff=2.0).collect()
    assert sorted((r.op_id, r.attempt, r.verdict, r.delay_ceiling_us) for r in rows) == [
        ("a", 1, "RETRY", 2_000_000), ("a", 2, "SUCCESS", None),
        ("b", 1, "RETRY", 2_000_000), ("b", 2, "RETRY", 1_000_000), ("b", 3, "TIMEOUT", None), ("c", 1, "NON_TRANSIENT", None),
    ]
    outcomes = {r.op_id: r.outcome for r in series.retry_outcome(df, max_attempts=5, backoff=2.0).collect()}
    assert outcomes == {"a": "SUCCESS", "b": "TIMEOUT", "c": "NON_TRANSIENT"}

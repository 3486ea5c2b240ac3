"""Poll series, logs and retries over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.operators import series
from fleetlens.plans.bindings import (
    CLUSTER_POLLS_SQL,
    EVENT_POLLS,
    JOB_POLLS_SQL,
    cluster_polls,
    job_polls,
    table,
)
from fleetlens.plans.registry import query

READY_TIMEOUT_US = 7_200_000_000
JOB_TIMEOUT_US = 86_400_000_000
# Small enough that ordinary test groups are cut into slices.
SMALL_HOT_ROWS = 16

LATEST_SQL = f"""WITH {CLUSTER_POLLS_SQL}
SELECT user_id, event_id, state, head_ready FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY us DESC, event_id DESC) AS n FROM polls)
WHERE n = 1"""


@query("latest_snapshot", LATEST_SQL)
def latest_snapshot(spark, sf_dir):
    polls = cluster_polls(table(spark, sf_dir, "events"))
    return series.latest_snapshot(polls, EVENT_POLLS).select("user_id", "event_id", "state", "head_ready")


WAIT_READY_SQL = f"""WITH {CLUSTER_POLLS_SQL},
starts AS (SELECT user_id, min(us) AS t0 FROM polls GROUP BY user_id),
verdicts AS (
  SELECT p.user_id,
    min(us - t0) FILTER (WHERE state = 'RUNNING' AND head_ready AND us - t0 < {READY_TIMEOUT_US}) AS ready_us,
    max_by(state, (us, event_id)) FILTER (WHERE us - t0 < {READY_TIMEOUT_US}) AS last_state,
    max_by(head_ready, (us, event_id)) FILTER (WHERE us - t0 < {READY_TIMEOUT_US}) AS last_head_ready
  FROM polls p JOIN starts s ON p.user_id = s.user_id GROUP BY p.user_id)
SELECT user_id, CASE WHEN ready_us IS NULL THEN 'TIMEOUT' ELSE 'READY' END AS outcome, ready_us AS elapsed_us,
  CASE WHEN ready_us IS NULL THEN last_state ELSE 'RUNNING' END AS last_state,
  CASE WHEN ready_us IS NULL THEN last_head_ready ELSE true END AS last_head_ready
FROM verdicts"""


@query("wait_ready", WAIT_READY_SQL)
def wait_ready(spark, sf_dir):
    polls = cluster_polls(table(spark, sf_dir, "events"))
    return series.wait_ready(polls, READY_TIMEOUT_US, EVENT_POLLS)


@query("wait_ready_hot_keys", WAIT_READY_SQL)
def wait_ready_hot_keys(spark, sf_dir):
    polls = cluster_polls(table(spark, sf_dir, "events"))
    return series.wait_ready(polls, READY_TIMEOUT_US, EVENT_POLLS, hot_rows=SMALL_HOT_ROWS)


WAIT_TERMINAL_SQL = f"""WITH {JOB_POLLS_SQL},
starts AS (SELECT user_id, min(us) AS t0 FROM polls GROUP BY user_id),
inside AS (SELECT p.*, us - t0 AS elapsed, state IN ('SUCCEEDED', 'FAILED', 'STOPPED') AS ended
  FROM polls p JOIN starts s ON p.user_id = s.user_id WHERE us - t0 < {JOB_TIMEOUT_US}),
verdicts AS (
  SELECT user_id, min(elapsed) FILTER (WHERE ended) AS elapsed_us,
    min_by(state, (us, event_id)) FILTER (WHERE ended) AS end_state,
    min_by(event_id, (us, event_id)) FILTER (WHERE ended) AS end_id,
    max_by(state, (us, event_id)) AS open_state, max_by(event_id, (us, event_id)) AS open_id
  FROM inside GROUP BY user_id)
SELECT user_id, CASE WHEN elapsed_us IS NULL THEN 'TIMEOUT' ELSE 'TERMINAL' END AS outcome, elapsed_us,
  coalesce(end_state, open_state) AS last_state, coalesce(end_id, open_id) AS last_event_id
FROM verdicts"""


@query("wait_terminal", WAIT_TERMINAL_SQL)
def wait_terminal(spark, sf_dir):
    polls = job_polls(table(spark, sf_dir, "events"))
    return series.wait_terminal(polls, JOB_TIMEOUT_US, "CRD", EVENT_POLLS, ["event_id"])


@query("wait_terminal_submissions", WAIT_TERMINAL_SQL)
def wait_terminal_submissions(spark, sf_dir):
    polls = job_polls(table(spark, sf_dir, "events")).withColumn("state", F.lower("state"))
    return series.wait_terminal(polls, JOB_TIMEOUT_US, "DASHBOARD", EVENT_POLLS, ["event_id"])


@query(
    "wait_terminal_without_namespace",
    f"""SELECT CAST(NULL AS VARCHAR) AS namespace, CAST(user_id AS VARCHAR) AS name, outcome, elapsed_us, last_state
    FROM ({WAIT_TERMINAL_SQL})""",
)
def wait_terminal_without_namespace(spark, sf_dir):
    """Submissions have no namespace: NULL is a part of the key like any other."""
    polls = job_polls(table(spark, sf_dir, "events")).selectExpr(
        "CAST(user_id AS STRING) AS job_id", "event_id", "ts", "lower(state) AS status"
    )
    submissions = polls.selectExpr(
        "CAST(NULL AS STRING) AS namespace", "job_id AS name", "event_id", "ts", "status AS state"
    )
    keyed = series.Polls(keys=("namespace", "name"), ts="ts", seq="event_id", state="state")
    return series.wait_terminal(submissions, JOB_TIMEOUT_US, "DASHBOARD", keyed)


TRANSITIONS_SQL = f"""WITH {CLUSTER_POLLS_SQL},
lagged AS (SELECT *, lag(state) OVER (PARTITION BY user_id ORDER BY us, event_id) AS before FROM polls),
points AS (SELECT * FROM lagged WHERE before IS NULL OR before <> state),
dwells AS (SELECT *, us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id) AS dwell_us FROM points)
SELECT user_id, event_id, before AS from_state, state AS to_state, dwell_us,
  (before, state) IN (('CREATING', 'RUNNING'), ('CREATING', 'FAILED'), ('RUNNING', 'DELETING'),
    ('RUNNING', 'SUSPENDED'), ('SUSPENDED', 'RUNNING')) AS legal
FROM dwells WHERE before IS NOT NULL"""


def _transitions(spark, sf_dir, **options):
    polls = cluster_polls(table(spark, sf_dir, "events"))
    return series.transitions(polls, F.lit("cluster"), EVENT_POLLS, **options).drop("ts")


@query("transitions", TRANSITIONS_SQL)
def transitions(spark, sf_dir):
    return _transitions(spark, sf_dir)


@query("transitions_hot_keys", TRANSITIONS_SQL)
def transitions_hot_keys(spark, sf_dir):
    """Cells of an hour, so that every resource has many."""
    return _transitions(spark, sf_dir, cell_us=3_600_000_000)


@query("transitions_ties", TRANSITIONS_SQL)
def transitions_ties(spark, sf_dir):
    """Cells of one instant, cut by sequence numbers."""
    return _transitions(spark, sf_dir, cell_us=1, seq_block=2)


PROGRESS_SQL = f"""WITH {CLUSTER_POLLS_SQL}
SELECT user_id, event_id, state, us - min(us) OVER (PARTITION BY user_id) AS elapsed_us,
  'State: ' || state || ', head_ready: ' || CASE WHEN head_ready THEN 'True' ELSE 'False' END AS message
FROM polls"""


@query("progress_trace", PROGRESS_SQL)
def progress_trace(spark, sf_dir):
    polls = cluster_polls(table(spark, sf_dir, "events"))
    return series.progress_trace(polls, "cluster", EVENT_POLLS).drop("ts")


@query("progress_trace_hot_keys", PROGRESS_SQL)
def progress_trace_hot_keys(spark, sf_dir):
    polls = cluster_polls(table(spark, sf_dir, "events"))
    return series.progress_trace(polls, "cluster", EVENT_POLLS, hot_rows=SMALL_HOT_ROWS).drop("ts")


LOG_LINES_SQL = """SELECT doc_id, CAST(unnest(range(len(parts))) AS INTEGER) AS line_no, unnest(parts) AS line
FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)"""


@query("log_lines", LOG_LINES_SQL)
def log_lines(spark, sf_dir):
    return series.log_lines(table(spark, sf_dir, "documents"), "doc_id", "text")


LOG_TAIL_SQL = f"""SELECT doc_id, line_no, line FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no DESC) AS n FROM ({LOG_LINES_SQL}))
WHERE n <= 3"""


@query("log_tail", LOG_TAIL_SQL)
def log_tail(spark, sf_dir):
    lines = series.log_lines(table(spark, sf_dir, "documents"), "doc_id", "text")
    return series.log_tail(lines, 3, "doc_id")


LOG_TAIL_TEXT_SQL = """SELECT doc_id, array_to_string(parts[greatest(len(parts) - 2, 1):], chr(10)) AS tail
FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)"""


@query("log_tail_text", LOG_TAIL_TEXT_SQL)
def log_tail_text(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", series.log_tail_text("text", 3).alias("tail"))


# A training log line per event; other event types write other lines.
METRIC_LINE = """CASE WHEN event_type IN ('view', 'click') THEN concat(
    'Epoch ', CAST(user_id AS STRING), '/', CAST(event_id AS STRING),
    ' — loss: ', CAST(CAST(value AS DECIMAL(12, 2)) AS STRING),
    ', train_acc: ', CAST(CAST(event_id AS DECIMAL(12, 1)) AS STRING),
    ', test_acc: ', CAST(CAST(user_id AS DECIMAL(12, 1)) AS STRING))
  ELSE concat('step ', event_type) END"""

LOG_METRICS_SQL = """SELECT event_id, CAST(user_id AS INTEGER) AS epoch, CAST(event_id AS INTEGER) AS epochs,
  value AS loss, CAST(event_id AS DOUBLE) AS train_acc, CAST(user_id AS DOUBLE) AS test_acc
FROM events WHERE event_type IN ('view', 'click')"""


@query("log_metrics", LOG_METRICS_SQL)
def log_metrics(spark, sf_dir):
    lines = table(spark, sf_dir, "events").selectExpr("event_id", f"{METRIC_LINE} AS line")
    return series.log_metrics(lines).drop("line")


# Every call of a user on one day is one retried operation.
CALL_COLUMNS = (
    """CASE event_type WHEN 'error' THEN 503 WHEN 'purchase' THEN 404 WHEN 'signup' THEN 429
      WHEN 'view' THEN 200 ELSE NULL END AS http_status""",
    "CASE WHEN event_type = 'click' THEN 'ReadTimeoutError' ELSE NULL END AS exception",
)

JUDGED_SQL = f"""WITH calls AS (
  SELECT user_id, CAST(ts AS DATE) AS day, epoch_us(ts) AS us, {', '.join(CALL_COLUMNS)},
    row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS attempt FROM events),
timed AS (
  SELECT *, us - min(us) OVER (PARTITION BY user_id, day) AS elapsed FROM calls WHERE attempt <= 3),
judged AS (
  SELECT *, CASE WHEN elapsed >= 21600000000 THEN 'TIMEOUT'
      WHEN http_status = 200 THEN 'SUCCESS'
      WHEN http_status = 404 THEN 'NON_TRANSIENT'
      WHEN attempt >= 3 THEN 'EXHAUSTED' END AS verdict FROM timed),
ceilings AS (SELECT *, least(CAST(500000 * pow(2, attempt - 1) AS BIGINT), 21600000000 - elapsed) AS ceiling FROM judged)"""

RETRY_SQL = f"""{JUDGED_SQL}, decided AS (
  SELECT user_id, day, min(attempt) FILTER (WHERE verdict IS NOT NULL) AS hit, max(attempt) AS latest
  FROM judged GROUP BY user_id, day)
SELECT d.user_id, d.day, coalesce(verdict, 'INCOMPLETE') AS outcome,
  CAST(CASE WHEN verdict = 'TIMEOUT' THEN attempt - 1 ELSE attempt END AS INTEGER) AS attempts,
  elapsed AS elapsed_us,
  CASE WHEN verdict = 'TIMEOUT' THEN NULL ELSE http_status END AS last_status,
  CASE WHEN verdict IS NULL THEN ceiling END AS delay_ceiling_us
FROM decided d JOIN ceilings j ON j.user_id = d.user_id AND j.day = d.day AND j.attempt = coalesce(hit, latest)"""


def _calls(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(
        "user_id", "event_id", "ts", "CAST(ts AS DATE) AS day", *CALL_COLUMNS
    )


@query(
    "retry_attempts",
    f"""{JUDGED_SQL}, reached AS (
      SELECT *, min(attempt) FILTER (WHERE verdict IS NOT NULL) OVER (PARTITION BY user_id, day) AS hit FROM ceilings)
    SELECT user_id, day, CAST(attempt AS INTEGER) AS attempt, coalesce(verdict, 'RETRY') AS verdict, elapsed AS elapsed_us,
      CASE WHEN verdict IS NULL THEN ceiling END AS delay_ceiling_us
    FROM reached WHERE hit IS NULL OR attempt <= hit""",
)
def retry_attempts(spark, sf_dir):
    op = ("user_id", "day")
    attempts = series.number_attempts(_calls(spark, sf_dir), op, ("ts", "event_id"), 3)
    return series.retry_attempts(attempts, 3, 0.5, 21_600_000_000, op, started_at="ts")


@query("retry_outcome", RETRY_SQL)
def retry_outcome(spark, sf_dir):
    op = ("user_id", "day")
    attempts = series.number_attempts(_calls(spark, sf_dir), op, ("ts", "event_id"), 3)
    return series.retry_outcome(attempts, 3, 0.5, 21_600_000_000, op, started_at="ts")


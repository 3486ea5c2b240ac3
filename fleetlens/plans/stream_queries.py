"""Streams over the driver tables, run until everything that is there has been read.

Each stream writes to a table in the shared folder, with its checkpoint beside
it; the query result is that table.
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.operators.series import Polls, progress_message
from fleetlens.plans.bindings import (
    CLUSTER_POLLS_SQL,
    EVENT_POLLS,
    JOB_POLLS_SQL,
    cluster_polls,
    job_polls,
    table,
)
from fleetlens.plans.registry import query
from fleetlens.plans.series_queries import (
    JOB_TIMEOUT_US,
    LOG_LINES_SQL,
    READY_TIMEOUT_US,
    TRANSITIONS_SQL,
    WAIT_READY_SQL,
    WAIT_TERMINAL_SQL,
)
from fleetlens.schemas import SNAPSHOTS
from fleetlens.sources.scratch import shared_folder
from fleetlens.streaming import flows, landing, stateful


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as a stream of its files."""
    schema = table(spark, sf_dir, name).schema
    spark.conf.set(stateful.STATE_STORE_SETTING, stateful.ROCKSDB)
    return flows.snapshot_stream(spark, f"{sf_dir}/{name}.parquet*", schema, "parquet")


def drained(stream: DataFrame) -> DataFrame:
    """What a stream has written after reading all there is."""
    spark, folder = stream.sparkSession, shared_folder(stream.sparkSession)
    writer = flows.write_stream_view(stream, f"{folder}/rows", f"{folder}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


# What the streams decide is final, and written, once the watermark has passed it.
DELAY_US = 60_000_000
PASSED = f"((SELECT max(epoch_us(ts)) FROM events) // 1000 * 1000 - {DELAY_US})"
DECIDED = f"""(SELECT min(epoch_us(ts)) FROM events e WHERE e.user_id = w.user_id) + coalesce(elapsed_us, {{0}}) <= {PASSED}"""


@query("wait_ready_stream", f"SELECT * FROM ({WAIT_READY_SQL}) w WHERE {DECIDED.format(READY_TIMEOUT_US)}")
def wait_ready_stream(spark, sf_dir):
    polls = cluster_polls(table_stream(spark, sf_dir, "events"))
    return drained(stateful.wait_ready_stream(polls, READY_TIMEOUT_US, EVENT_POLLS))


@query(
    "wait_terminal_stream",
    f"SELECT user_id, outcome, elapsed_us, last_state FROM ({WAIT_TERMINAL_SQL}) w "
    f"WHERE {DECIDED.format(JOB_TIMEOUT_US)}",
)
def wait_terminal_stream(spark, sf_dir):
    polls = job_polls(table_stream(spark, sf_dir, "events"))
    return drained(stateful.wait_terminal_stream(polls, JOB_TIMEOUT_US, "CRD", EVENT_POLLS))


@query(
    "wait_terminal_stream_null_keys",
    f"SELECT CASE WHEN user_id % 3 <> 0 THEN 'n' || user_id % 3 END AS namespace, user_id, outcome, elapsed_us, last_state "
    f"FROM ({WAIT_TERMINAL_SQL}) w WHERE {DECIDED.format(JOB_TIMEOUT_US)}",
)
def wait_terminal_stream_null_keys(spark, sf_dir):
    """Dashboard submissions have no namespace: a third of the keys has a NULL in it."""
    polls = job_polls(table_stream(spark, sf_dir, "events"))
    keyed = polls.withColumn("namespace", F.expr("CASE WHEN user_id % 3 <> 0 THEN concat('n', user_id % 3) END"))
    names = Polls(keys=("namespace", "user_id"), ts="ts", seq="event_id", state="state", head_ready="head_ready")
    return drained(stateful.wait_terminal_stream(keyed, JOB_TIMEOUT_US, "DASHBOARD", names))


TRANSITIONS_STREAM_SQL = f"""SELECT user_id, event_id AS seq, from_state, to_state, dwell_us, legal
FROM ({TRANSITIONS_SQL}) t JOIN (SELECT event_id AS id, epoch_us(ts) AS at_us FROM events) e ON event_id = id
WHERE at_us <= {PASSED}"""


@query("transitions_stream", TRANSITIONS_STREAM_SQL)
def transitions_stream(spark, sf_dir):
    polls = cluster_polls(table_stream(spark, sf_dir, "events"))
    return drained(stateful.transitions_stream(polls, "cluster", EVENT_POLLS)).drop("at_us")


@query("transitions_stream_shuffled", TRANSITIONS_STREAM_SQL)
def transitions_stream_shuffled(spark, sf_dir):
    """The polls as JSON snapshots, dealt to files without order, with a malformed line in every file."""
    polls = cluster_polls(table(spark, sf_dir, "events")).select(
        "user_id", "event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ts"), "state"
    )
    lines = polls.select(F.to_json(F.struct("*")).alias("value"))
    broken = polls.where("event_id % 97 = 0").select(F.lit('{"user_id": 1, "ts": "').alias("value"))
    spark.conf.set(stateful.STATE_STORE_SETTING, stateful.ROCKSDB)
    folder = shared_folder(spark)
    lines.unionByName(broken).repartition(4, F.xxhash64("value")).write.text(folder)
    stream = flows.snapshot_stream(spark, folder, polls.schema, max_files_per_trigger=4)
    stream = stream.withColumn("ts", F.col("ts").cast("timestamp"))
    return drained(stateful.transitions_stream(stream, "cluster", EVENT_POLLS)).drop("at_us")


@query("log_follow", f"SELECT * FROM ({LOG_LINES_SQL}) WHERE line <> ''")
def log_follow(spark, sf_dir):
    docs = table_stream(spark, sf_dir, "documents")
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    return drained(flows.log_follow(lines))


@query(
    "log_follow_until_end",
    f"""WITH {JOB_POLLS_SQL}, ends AS (
      SELECT user_id, min(us) AS end_us FROM polls WHERE state IN ('SUCCEEDED', 'FAILED', 'STOPPED') GROUP BY 1)
    SELECT user_id, event_id, event_type AS line FROM polls LEFT JOIN ends USING (user_id)
    WHERE (end_us IS NULL OR us <= end_us) AND us <= {PASSED}""",
)
def log_follow_until_end(spark, sf_dir):
    """Every event is a line of its user's log and a poll of its user's job."""
    lines = table_stream(spark, sf_dir, "events").select("user_id", "event_id", F.col("ts").alias("logged_at"), F.col("event_type").alias("line"))
    polls = job_polls(table_stream(spark, sf_dir, "events"))
    followed = flows.log_follow_until_end(lines, polls, ["user_id"], polls=EVENT_POLLS, horizon="1000 days")
    return drained(followed).drop("logged_at")


BEAT_US = 6 * 3_600_000_000


@query(
    "heartbeat_stream",
    f"""WITH {CLUSTER_POLLS_SQL}, cells AS (
      SELECT user_id, us // {BEAT_US} AS k, max_by(state, (us, event_id)) AS state, count(*) AS polls FROM polls GROUP BY 1, 2),
    spans AS (SELECT user_id, unnest(range(min(k), {PASSED} // {BEAT_US})) AS k FROM cells GROUP BY 1)
    SELECT user_id, k * {BEAT_US} AS start_us, coalesce(polls, 0) AS polls,
      last_value(state IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY k) AS state
    FROM spans LEFT JOIN cells USING (user_id, k)""",
)
def heartbeat_stream(spark, sf_dir):
    """A row per user and quarter of a day, silent ones included."""
    polls = cluster_polls(table_stream(spark, sf_dir, "events"))
    beats = drained(stateful.heartbeat_stream(polls, BEAT_US, EVENT_POLLS))
    return beats.select("user_id", F.unix_micros("window_start").alias("start_us"), "polls", "state")


# An append-mode window is final once the latest event passes its end by the delay.
CLOSED = "epoch_us(window_end) <= (SELECT max(epoch_us(ts)) FROM events) - {0}"


@query(
    "progress_heartbeat",
    f"""WITH {CLUSTER_POLLS_SQL}, beats AS (
      SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
        user_id, max_by(state, (us, event_id)) AS state, count(*) AS polls FROM polls GROUP BY 1, 2, 3)
    SELECT epoch_us(window_start) AS start_us, user_id, state, polls FROM beats WHERE {CLOSED.format(10_000_000)}""",
)
def progress_heartbeat(spark, sf_dir):
    polls = cluster_polls(table_stream(spark, sf_dir, "events"))
    beats = drained(flows.progress_heartbeat(polls, "1 hour", EVENT_POLLS))
    return beats.select(F.unix_micros("window_start").alias("start_us"), "user_id", "state", "polls")


@query(
    "state_counts_stream",
    f"""WITH {CLUSTER_POLLS_SQL}, counts AS (
      SELECT w AS window_start, w + INTERVAL 2 HOUR AS window_end, state, count(*) AS polls
      FROM (SELECT state, unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS w FROM polls)
      GROUP BY ALL)
    SELECT epoch_us(window_start) AS start_us, state, polls FROM counts WHERE {CLOSED.format(0)}""",
)
def state_counts_stream(spark, sf_dir):
    polls = cluster_polls(table_stream(spark, sf_dir, "events"))
    counts = drained(flows.state_counts_stream(polls, "2 hours", "1 hour", EVENT_POLLS))
    return counts.select(F.unix_micros("window_start").alias("start_us"), "state", "polls")


@query(
    "on_progress",
    f"""WITH {JOB_POLLS_SQL} SELECT user_id, event_id, state, 'Job state: ' || state AS message FROM polls""",
)
def on_progress(spark, sf_dir):
    """A callback that stores each batch of progress rows under its batch number."""
    polls = job_polls(table_stream(spark, sf_dir, "events"))
    rows = polls.select(
        "user_id", "event_id", "state",
        progress_message("job", "state", "head_ready", "event_type").alias("message"),
    )
    folder = shared_folder(spark)

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/rows/batch={batch_id}")

    writer = flows.on_progress(rows, store).option("checkpointLocation", f"{folder}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{folder}/rows").select(*rows.columns)


def _snapshot_lines(spark, sf_dir):
    """Events as JSON snapshots in files of their own, among them lines that are none; the folder."""
    polls = cluster_polls(table(spark, sf_dir, "events")).selectExpr(
        "'cluster' AS kind", "CAST(user_id AS STRING) AS name", "event_id AS seq", "state", "head_ready",
        """date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") AS observed_at""",
    )
    broken = """CASE WHEN event_id % 3 = 0 THEN concat('{"name": "', event_id) WHEN event_id % 3 = 1
      THEN concat('{"name": "n", "seq": "', event_id, 'th"}') ELSE concat('{"seq": ', event_id, '}') END"""
    spoiled = table(spark, sf_dir, "events").where("event_id % 10 = 7").selectExpr(f"{broken} AS value")
    folder = shared_folder(spark)
    lines = polls.select(F.to_json(F.struct("*")).alias("value")).unionByName(spoiled)
    lines.repartition(6, F.xxhash64("value")).write.text(folder)
    return folder


LANDED_SQL = """SELECT 'row' AS part, CAST(user_id AS VARCHAR) AS name, event_id AS seq FROM events
UNION ALL
SELECT 'reject', CASE event_id % 3 WHEN 0 THEN 'NO_OBJECT' WHEN 1 THEN 'WRONG_TYPE' ELSE 'UNNAMED' END, CASE WHEN event_id % 3 = 2 THEN event_id END
FROM events WHERE event_id % 10 = 7"""


def _landed(spark, folder):
    rows = landing.read_landed(spark, folder, "rows", SNAPSHOTS)
    rejects = landing.read_landed(spark, folder, "rejects", "raw string, reason string")
    seq = F.get_json_object("raw", "$.seq").try_cast("bigint")
    return rows.select(F.lit("row").alias("part"), "name", "seq").union(rejects.select(F.lit("reject"), "reason", seq))


@query("snapshots_landed", LANDED_SQL)
def snapshots_landed(spark, sf_dir):
    """A stream of snapshot lines landed in a table of rows and one of rejects."""
    typed = landing.line_stream(spark, _snapshot_lines(spark, sf_dir), max_files_per_trigger=2)
    folder = shared_folder(spark)
    landing.land_lines(typed, f"{folder}/out", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return _landed(spark, f"{folder}/out")


@query("snapshots_landed_replayed", LANDED_SQL)
def snapshots_landed_replayed(spark, sf_dir):
    """The same stream, killed in its second batch between the two tables, and started again."""
    typed = landing.line_stream(spark, _snapshot_lines(spark, sf_dir), max_files_per_trigger=2)
    folder = shared_folder(spark)
    out, checkpoint = f"{folder}/out", f"{folder}/checkpoint"

    def dies(batch: DataFrame, batch_id: int) -> None:
        if batch_id == 1:
            landing.rows_of(batch).write.parquet(f"{out}/rows/batch={batch_id}")
            raise RuntimeError("killed")
        landing.write_batch(batch, batch_id, out, {"rows": landing.rows_of, "rejects": landing.rejects_of}, checkpoint)

    first = typed.writeStream.foreachBatch(dies).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        first.awaitTermination()
    except StreamingQueryException:
        landing.land_lines(typed, out, checkpoint).trigger(availableNow=True).start().awaitTermination()
    return _landed(spark, out)

"""Stream sources and built-in streaming aggregates."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import BinaryType, DataType, StringType, StructField, StructType

from fleetlens import schemas
from fleetlens.functions.states import is_terminal
from fleetlens.operators.series import DEFAULT_POLLS, Polls
from fleetlens.streaming import following, stateful

log = logging.getLogger(__name__)


def snapshot_stream(
    spark: SparkSession,
    path: str,
    schema: str = schemas.SNAPSHOTS,
    fmt: str = "json",
    max_files_per_trigger: int = 1_000,
) -> DataFrame:
    """Stream of the status dumps that land in a folder."""
    reader = spark.readStream.schema(schema).format(fmt)
    return reader.option("maxFilesPerTrigger", max_files_per_trigger).load(path)


def log_follow(lines: DataFrame, line: str = "line") -> DataFrame:
    """Log lines as they come, without the empty ones."""
    return lines.where(F.col(line) != "")


_ROW_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "ignoreNullFields": "false",
}


def _as_json(row: Column | str, columns: Sequence[str], schema: StructType) -> Column:
    """Fields of a struct as one JSON text. Texts go in as bytes, so that those that are no UTF-8 come out as they were."""
    fields = row if isinstance(row, Column) else F.col(row)
    return F.to_json(F.struct(*[fields[c].cast(_json_type(schema, c)).alias(c) for c in columns]), _ROW_OPTIONS)


def _json_type(schema: StructType, column: str) -> DataType:
    kind = schema[column].dataType
    return BinaryType() if isinstance(kind, StringType) else kind


def _joined_until_end(
    lines: DataFrame, snaps: DataFrame, keys: Sequence[str], at: str, line: str, polls: Polls, delay: str, horizon: str
) -> DataFrame:
    """``log_follow_until_end`` where lines or polls are a table."""
    ended = snaps.where(is_terminal(polls.state)).select(
        *[F.col(key).alias(f"ended_{key}") for key in keys], F.col(polls.ts).cast("timestamp").alias("ended_at")
    ).withWatermark("ended_at", delay)
    timed = log_follow(lines, line).withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay)
    after_end = F.expr(f"ended_at < `{at}` AND ended_at >= `{at}` - INTERVAL {horizon}")
    for key in keys:
        after_end = F.col(key).eqNullSafe(F.col(f"ended_{key}")) & after_end
    joined = timed.join(ended, after_end, "left_outer")
    return joined.where("ended_at IS NULL").select(*lines.columns)


def log_follow_until_end(
    lines: DataFrame,
    snaps: DataFrame,
    keys: Sequence[str] = ("job_id",),
    at: str = "logged_at",
    line: str = "line",
    polls: Polls = DEFAULT_POLLS,
    delay: str = "1 minute",
    horizon: str = "1 day",
    groups: int = 256,
) -> DataFrame:
    """Log lines as they come until their job has ended, without the empty ones.

    A line is left out if a poll before its time shows the job in a terminal state; such a
    poll counts for ``horizon``, in which a log should have ended too. Both streams may be
    ``delay`` late: a line is given once the watermark has passed its time, because a poll
    before it could come until then. Only lines not yet given are held, and of the terminal
    polls the spans of time that they cover together, dealt over ``groups`` by their job. A
    checkpoint belongs to one number of groups. Needs the RocksDB state store. What comes out
    has no watermark. Tables in place of a stream are joined, and wait for no watermark.
    """
    if not (lines.isStreaming and snaps.isStreaming):
        return _joined_until_end(lines, snaps, keys, at, line, polls, delay, horizon)
    stateful.require_rocksdb(lines)
    schema = lines.schema
    others = [c for c in lines.columns if c != at]

    def timed(rows: DataFrame, time: str, until: str, is_span: bool, row: Column) -> DataFrame:
        as_lines = [F.col(f"`{key}`").cast(schema[key].dataType).alias(key) for key in keys]
        own = rows.select(F.col(time).cast("timestamp").alias("time"), F.struct(*as_lines).alias("job"), row.alias(following.ROW))
        return own.withWatermark("time", delay).select(
            "time", _as_json("job", keys, schema).alias(following.KEY), F.unix_micros("time").alias(following.AT),
            F.unix_micros(F.expr(until)).alias(following.UNTIL), F.lit(is_span).alias(following.IS_SPAN), following.ROW,
        )

    row = F.struct(*[F.col(f"`{c}`") for c in others])
    held = timed(log_follow(lines, line), at, "time", False, _as_json(row, others, schema))
    spans = timed(snaps.where(is_terminal(polls.state)), polls.ts, f"time + INTERVAL {horizon}", True, F.lit(""))
    rows = held.unionByName(spans).dropna(subset=[following.AT])
    dealt = rows.withColumn(following.GROUP, F.pmod(F.xxhash64(following.KEY), F.lit(groups))).groupBy(following.GROUP)
    given = dealt.transformWithStateInPandas(
        statefulProcessor=following.Following(following.PAGE_ROWS), outputStructType=following.OUTPUT,
        outputMode="Append", timeMode="EventTime",
    )
    packed = StructType([StructField(c, _json_type(schema, c)) for c in others])
    row = F.from_json(following.ROW, packed, _ROW_OPTIONS)
    fields = {c: row[c].cast(schema[c].dataType).alias(c) for c in others} | {at: F.timestamp_micros(following.AT).alias(at)}
    return given.select(*[fields[c] for c in lines.columns])


def progress_heartbeat(
    snaps: DataFrame,
    interval: str = "10 seconds",
    polls: Polls = DEFAULT_POLLS,
    delay: str = "10 seconds",
) -> DataFrame:
    """Latest status per interval of the resources polled in it; ``heartbeat_stream`` has silent ones too."""
    newest = F.struct(*polls.order)
    timed = snaps.withColumn(polls.ts, F.col(polls.ts).cast("timestamp")).withWatermark(polls.ts, delay)
    beats = timed.groupBy(F.window(polls.ts, interval), *polls.keys).agg(
        F.max_by(polls.state, newest).alias("state"), F.count(F.lit(1)).alias("polls")
    )
    return beats.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        *polls.keys, "state", "polls",
    )


def state_counts_stream(
    snaps: DataFrame,
    window: str,
    slide: str | None = None,
    polls: Polls = DEFAULT_POLLS,
    delay: str = "0 seconds",
) -> DataFrame:
    """Polls per state in tumbling or sliding windows."""
    timed = snaps.withColumn(polls.ts, F.col(polls.ts).cast("timestamp")).withWatermark(polls.ts, delay)
    counts = timed.groupBy(F.window(polls.ts, window, slide), polls.state).agg(
        F.count(F.lit(1)).alias("polls")
    )
    return counts.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        F.col(polls.state).alias("state"), "polls",
    )


def on_progress(stream: DataFrame, fn: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    """Run a callback on every micro-batch; its failure is logged and never stops the stream."""

    def guarded(batch: DataFrame, batch_id: int) -> None:
        try:
            fn(batch, batch_id)
        except Exception:
            log.warning("progress callback failed on batch %d", batch_id, exc_info=True)

    return stream.writeStream.foreachBatch(guarded)


def write_stream_view(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> DataStreamWriter:
    """A writer that appends a stream to a folder, exactly once per row."""
    return (
        stream.writeStream.format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )

"""Operators over time-ordered status polls, log lines and call attempts.

A poll table has one row per observation of a resource. Polls of a resource
are ordered by ``(ts, seq)``; the sequence number breaks ties.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.functions.columns import ColumnLike, col, whole_div
from fleetlens.functions.states import is_legal_edge, is_terminal
from fleetlens.operators.errors import is_transient
from fleetlens.operators.skew import HOT_ROWS, SLICE, slice_hot_groups, with_stats


@dataclass(frozen=True)
class Polls:
    """Names of the columns of a poll table."""

    keys: Sequence[str] = ("kind", "namespace", "name")
    ts: str = "observed_at"
    seq: str = "seq"
    state: str = "state"
    head_ready: str = "head_ready"
    message: str = "message"
    order: list[str] = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "keys", list(self.keys))
        object.__setattr__(self, "order", [self.ts, self.seq])


DEFAULT_POLLS = Polls()

# Polls of one resource are put in order within cells of this length: thirty days, a million
# polls at one every two or three seconds.
CELL_US = 30 * 86_400_000_000
# The cell of polls without a time, before all others.
NO_CELL = -(1 << 63)


def micros(ts: ColumnLike) -> Column:
    return F.unix_micros(col(ts).cast("timestamp"))


def latest_snapshot(snaps: DataFrame, polls: Polls = DEFAULT_POLLS) -> DataFrame:
    """The newest row of every resource.

    The rank filter is pushed below the shuffle, so each input task sends at
    most one row per resource.
    """
    newest = Window.partitionBy(*polls.keys).orderBy(*[F.col(c).desc() for c in polls.order])
    return snaps.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def _wait(
    snaps: DataFrame,
    polls: Polls,
    done: Column,
    outcome: str,
    timeout_us: int,
    payload: Sequence[str],
    started_at: str | None,
    hot_rows: int,
) -> DataFrame:
    poll = F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate([*polls.order, *payload])])
    at = micros(polls.ts)

    def verdicts(start: Column) -> list[Column]:
        below = (at >= start) & (at < start + F.lit(timeout_us))
        return [
            F.min(start).alias("_start"),
            F.min(F.when(below & done, poll)).alias("_done"),
            F.max(F.when(below, poll)).alias("_last"),
        ]

    if started_at is None:
        sliced = slice_hot_groups(snaps, polls.keys, polls.ts, polls.order, hot_rows)
        rows = with_stats(sliced, ["_from"])
        partial = rows.groupBy(*polls.keys, SLICE).agg(*verdicts(F.col("_from")))
        merged = partial.groupBy(*polls.keys).agg(
            F.min("_start").alias("_start"), F.min("_done").alias("_done"), F.max("_last").alias("_last")
        )
    else:
        merged = snaps.groupBy(*polls.keys).agg(*verdicts(micros(started_at)))

    shown = F.coalesce(F.col("_done"), F.col("_last"))
    elapsed = F.when(
        F.col("_done").isNotNull(), micros(F.col("_done")["f0"]) - F.col("_start")
    )
    return merged.select(
        *polls.keys,
        F.when(F.col("_done").isNotNull(), outcome).otherwise("TIMEOUT").alias("outcome"),
        elapsed.alias("elapsed_us"),
        *[shown[f"f{i + 2}"].alias(f"last_{c}") for i, c in enumerate(payload)],
    )


def wait_ready(
    snaps: DataFrame,
    timeout_us: int,
    polls: Polls = DEFAULT_POLLS,
    started_at: str | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Outcome of waiting for each cluster: READY with the time it took, or TIMEOUT.

    Ready means running with a ready head, at an elapsed time strictly below
    the timeout. A failed cluster does not end the wait. ``last_*`` describe
    the deciding poll, or the last poll below the timeout (NULL when none is).
    The clock starts at ``started_at``, by default at the first poll.
    """
    done = F.coalesce((F.col(polls.state) == "RUNNING") & F.col(polls.head_ready), F.lit(False))
    payload = [polls.state, polls.head_ready]
    return _wait(snaps, polls, done, "READY", timeout_us, payload, started_at, hot_rows)


def wait_terminal(
    snaps: DataFrame,
    timeout_us: int,
    mode: str = "CRD",
    polls: Polls = DEFAULT_POLLS,
    payload: Sequence[str] = (),
    started_at: str | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Outcome of waiting for each job to end, with the columns of the deciding poll.

    ``mode`` CRD compares states as they are, DASHBOARD in upper case.
    """
    if mode not in ("CRD", "DASHBOARD"):
        raise ValueError(f"unknown job mode {mode!r}")
    if mode == "DASHBOARD":
        snaps = snaps.withColumn(polls.state, F.upper(F.coalesce(F.col(polls.state), F.lit(""))))
    return _wait(
        snaps, polls, is_terminal(polls.state), "TERMINAL", timeout_us,
        [polls.state, *payload], started_at, hot_rows,
    )


def transitions(
    snaps: DataFrame,
    kind: ColumnLike,
    polls: Polls = DEFAULT_POLLS,
    cell_us: int = CELL_US,
    seq_block: int | None = None,
) -> DataFrame:
    """State changes between consecutive polls of a resource.

    ``dwell_us`` is the time since the previous change (or the first poll), and
    ``legal`` tells whether the edge is in the table of legal edges.

    The polls of a resource are cut into cells of time, whatever their number, and each
    cell is put in order by itself. One row per cell goes on: its first and last state and
    its last change. Those rows, in order, tell every cell what came before it. So a
    resource that holds most of all polls is as many groups as it has cells. With cells of
    one microsecond, polls of one instant are cut too, by ``seq_block`` sequence numbers.
    """
    if seq_block is not None and cell_us != 1:
        raise ValueError("only cells of one instant are in the order of their sequence numbers")
    at = micros(polls.ts)
    cell = [F.coalesce(whole_div(at, cell_us), F.lit(NO_CELL)).alias("_cell")]
    if seq_block is not None:
        cell.append(F.coalesce(whole_div(F.col(polls.seq).cast("bigint"), seq_block), F.lit(NO_CELL)).alias("_block"))
    cells_in_order = ["_cell", "_block"][: len(cell)]
    place = ["_key", *cells_in_order]
    needed = snaps.select(
        # NULLs inside a struct are equal, and the struct itself is never NULL.
        F.struct(*polls.keys).alias("_key"),
        *cell,
        polls.ts, polls.seq, at.alias("_us"), F.col(polls.state).alias("_state"), col(kind).alias("_kind"),
    )
    in_cell = Window.partitionBy(*place).orderBy(*polls.order)
    before = in_cell.rowsBetween(Window.unboundedPreceding, -1)
    rows = needed.withColumn("_prev", F.lag(F.struct("_state")).over(in_cell))

    def differs(other: str) -> Column:
        return ~F.col(f"{other}._state").eqNullSafe(F.col("_state"))

    order = F.struct(*polls.order)
    cells = rows.groupBy(*place).agg(
        F.min_by(F.struct("_state", "_us"), order).alias("_first"),
        F.max_by(F.struct("_state"), order).alias("_last"),
        F.max(F.when(F.col("_prev").isNotNull() & differs("_prev"), F.col("_us"))).alias("_moved"),
    )
    in_order = Window.partitionBy("_key").orderBy(*cells_in_order)
    told = cells.withColumn("_carried", F.lag("_last").over(in_order))
    opens = F.col("_carried").isNull() | ~F.col("_carried._state").eqNullSafe(F.col("_first._state"))
    entered = F.coalesce("_moved", F.when(opens, F.col("_first._us")))
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    told = told.withColumn("_since", F.last(entered, ignorenulls=True).over(earlier)).select(*place, "_carried", "_since")

    stated = rows.join(told, place).withColumn("_prev", F.coalesce("_prev", "_carried"))
    opened = F.when(F.col("_prev").isNull() | differs("_prev"), F.col("_us"))
    since = F.coalesce(F.last(opened, ignorenulls=True).over(before), F.col("_since"))
    changes = stated.withColumn("_since", since).where(F.col("_prev").isNotNull() & differs("_prev"))
    return changes.select(
        *[F.col(f"_key.`{key}`").alias(key) for key in polls.keys],
        polls.ts,
        polls.seq,
        F.col("_prev._state").alias("from_state"),
        F.col("_state").alias("to_state"),
        (F.col("_us") - F.col("_since")).alias("dwell_us"),
        F.coalesce(is_legal_edge("_kind", "_prev._state", "_state"), F.lit(False)).alias("legal"),
    )


def progress_message(kind: str, state: ColumnLike, head_ready: ColumnLike, message: ColumnLike) -> Column:
    """Progress text of one poll of a cluster, a job or a dashboard submission."""
    if kind == "cluster":
        ready = F.when(F.coalesce(col(head_ready), F.lit(False)), "True").otherwise("False")
        return F.concat(F.lit("State: "), col(state), F.lit(", head_ready: "), ready)
    if kind == "job":
        return F.concat(F.lit("Job state: "), col(state))
    return F.coalesce(col(message), F.lit(""))


def progress_trace(
    snaps: DataFrame,
    kind: str = "cluster",
    polls: Polls = DEFAULT_POLLS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One progress row per poll: state, time since the first poll, message text."""
    sliced = slice_hot_groups(snaps, polls.keys, polls.ts, polls.order, hot_rows)
    return with_stats(sliced, ["_from"]).select(
        *polls.keys,
        polls.ts,
        polls.seq,
        F.col(polls.state).alias("state"),
        (micros(polls.ts) - F.col("_from")).alias("elapsed_us"),
        progress_message(kind, polls.state, polls.head_ready, polls.message).alias("message"),
    )


def log_lines(df: DataFrame, id_column: str, text: str) -> DataFrame:
    """Log text as numbered lines; a trailing newline gives a last empty line."""
    return df.select(id_column, F.posexplode(F.split(F.col(text), "\n", -1)).alias("line_no", "line"))


def _last_lines(lines: DataFrame, n: int, groups: Sequence[str], line_no: str) -> DataFrame:
    from_end = Window.partitionBy(*groups).orderBy(F.col(line_no).desc())
    return lines.withColumn("_rank", F.row_number().over(from_end)).where(F.col("_rank") <= n).drop("_rank")


def log_tail(
    lines: DataFrame, n: int | None, id_column: str = "job_id", line_no: str = "line_no"
) -> DataFrame:
    """The last ``n`` lines of every log; no ``n``, or one below 1, keeps all lines.

    Each input task sends at most ``n`` lines of a log.
    """
    if n is None or n <= 0:
        return lines
    return _last_lines(lines, n, [id_column], line_no)


def log_tail_text(text: ColumnLike, n: int | None) -> Column:
    """The last ``n`` lines of a log held as one text."""
    if n is None or n <= 0:
        return col(text)
    lines = F.split(col(text), "\n", -1)
    start = F.greatest(F.size(lines) - n, F.lit(0)) + 1
    return F.array_join(F.slice(lines, start, F.lit(n)), "\n")


def log_metrics(lines: DataFrame, line: str = "line") -> DataFrame:
    """Epoch, loss and accuracies of training log lines; other lines are left out."""
    # Fixed value: the line format written by the training loop.
    pattern = r"Epoch (\d+)/(\d+) — loss: ([0-9.]+), train_acc: ([0-9.]+), test_acc: ([0-9.]+)"
    typed = [
        ("epoch", "int"), ("epochs", "int"), ("loss", "double"),
        ("train_acc", "double"), ("test_acc", "double"),
    ]
    found = lines.where(F.col(line).rlike(pattern))
    return found.withColumns(
        {
            name: F.regexp_extract(line, pattern, group).try_cast(kind)
            for group, (name, kind) in enumerate(typed, start=1)
        }
    )


def number_attempts(
    calls: DataFrame, op: Sequence[str], order: Sequence[str], max_attempts: int
) -> DataFrame:
    """Number the calls of each operation and keep those an attempt limit allows.

    The limit is pushed below the shuffle, so a hot operation sends at most
    ``max_attempts`` rows per input task.
    """
    in_order = Window.partitionBy(*op).orderBy(*order)
    return calls.withColumn("attempt", F.row_number().over(in_order)).where(
        F.col("attempt") <= max_attempts
    )


def _judged_attempts(
    attempts: DataFrame, max_attempts: int, backoff: float, timeout_us: int, keys: list[str],
    started_at: str, status: str, exception: str, finished_at: str | None,
) -> DataFrame:
    """One row per attempt: what would end the operation there, if anything, and the bound of the wait after it."""
    if max_attempts < 1:
        raise ValueError("max_attempts must be at least 1: with none, no call is ever made")
    ended = micros(finished_at) if finished_at else F.lit(None).cast("bigint")
    tries = (
        attempts.where(F.col("attempt") <= max_attempts)
        .groupBy(*keys, "attempt")
        .agg(
            F.min(
                F.struct(
                    micros(started_at).alias("at"),
                    F.col(status).alias("status"),
                    F.col(exception).alias("exception"),
                    ended.alias("ended"),
                )
            ).alias("call")
        )
    )
    start = F.min("call.at").over(Window.partitionBy(*keys))
    elapsed = F.col("call.at") - start
    failed = F.coalesce(F.col("call.status") >= 400, F.lit(False)) | F.col("call.exception").isNotNull()
    verdict = (
        F.when(elapsed >= timeout_us, "TIMEOUT")
        .when(~failed, "SUCCESS")
        .when(~is_transient("call.status", "call.exception"), "NON_TRANSIENT")
        .when(F.col("attempt") >= max_attempts, "EXHAUSTED")
        .when(F.col("call.ended") - start >= timeout_us, "EXHAUSTED")
    )
    ceiling = F.least(
        (F.lit(backoff * 1_000_000) * F.pow(F.lit(2.0), F.col("attempt") - 1)).cast("bigint"),
        F.lit(timeout_us) - elapsed,
    )
    return tries.select(
        *keys, "attempt", "call", verdict.alias("verdict"), elapsed.alias("elapsed"), ceiling.alias("ceiling")
    )


def retry_attempts(
    attempts: DataFrame,
    max_attempts: int = 3,
    backoff: float = 0.5,
    timeout_us: int = 60_000_000,
    op: Sequence[str] = ("op_id",),
    started_at: str = "started_at",
    status: str = "http_status",
    exception: str = "exception",
    finished_at: str | None = None,
) -> DataFrame:
    """Every attempt up to the one that ends its operation: ``(*op, attempt, verdict, elapsed_us, delay_ceiling_us)``.

    The verdict is that of ``retry_outcome``, or RETRY; after those ``delay_ceiling_us`` bounds the
    wait before the next attempt: the backoff doubled with every attempt, or what is left of the time.
    """
    keys = list(op)
    judged = _judged_attempts(attempts, max_attempts, backoff, timeout_us, keys, started_at, status, exception, finished_at)
    ending = F.min(F.when(F.col("verdict").isNotNull(), F.col("attempt"))).over(Window.partitionBy(*keys))
    reached = judged.withColumn("_ending", ending).where(F.col("_ending").isNull() | (F.col("attempt") <= F.col("_ending")))
    return reached.select(
        *keys,
        "attempt",
        F.coalesce("verdict", F.lit("RETRY")).alias("verdict"),
        F.col("elapsed").alias("elapsed_us"),
        F.when(F.col("verdict").isNull(), F.col("ceiling")).alias("delay_ceiling_us"),
    )


def retry_outcome(
    attempts: DataFrame,
    max_attempts: int = 3,
    backoff: float = 0.5,
    timeout_us: int = 60_000_000,
    op: Sequence[str] = ("op_id",),
    started_at: str = "started_at",
    status: str = "http_status",
    exception: str = "exception",
    finished_at: str | None = None,
) -> DataFrame:
    """How each retried operation ended.

    SUCCESS, NON_TRANSIENT (the first such error ends it), TIMEOUT (time was up
    before an attempt started), EXHAUSTED (attempts used up, or no time left
    after a failure, seen when ``finished_at`` is given) or INCOMPLETE (the
    record stops after a transient error). A call succeeded when it has neither
    an exception nor an error status. ``delay_ceiling_us`` bounds the wait
    before the next attempt; the jitter itself is random.
    """
    keys = list(op)
    judged = _judged_attempts(attempts, max_attempts, backoff, timeout_us, keys, started_at, status, exception, finished_at)
    ending = F.struct("attempt", "verdict", "elapsed", "call", F.lit(0).cast("bigint").alias("ceiling"))
    running = F.struct("attempt", F.lit("INCOMPLETE").alias("verdict"), "elapsed", "call", "ceiling")
    decided = judged.groupBy(*keys).agg(
        F.min_by(ending, F.when(F.col("verdict").isNotNull(), F.col("attempt"))).alias("ending"),
        F.max_by(running, "attempt").alias("running"),
    )
    final = decided.select(*keys, F.coalesce("ending", "running").alias("final"))
    outcome = F.col("final.verdict")
    return final.select(
        *keys,
        outcome.alias("outcome"),
        F.when(outcome == "TIMEOUT", F.col("final.attempt") - 1)
        .otherwise(F.col("final.attempt")).cast("int").alias("attempts"),
        F.col("final.elapsed").alias("elapsed_us"),
        F.when(outcome != "TIMEOUT", F.col("final.call.status")).alias("last_status"),
        F.when(outcome == "INCOMPLETE", F.col("final.ceiling")).alias("delay_ceiling_us"),
    )

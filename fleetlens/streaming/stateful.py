"""Waits, state changes and heartbeats over a stream of polls, in the order of their times.

These rules need ordered state per resource and a timer, which no built-in
streaming aggregate has. Polls are held in RocksDB until the watermark has passed
them, so they are folded in order of time and sequence however they arrive within
``delay``; later ones are left out by Spark.

Up to ``HELD_POLLS`` polls of a resource are held in one value with one timer, so that a
resource costs a few calls to the store a batch, however its polls are spread over time.
Beyond that they lie in pages by time bucket, and each bucket has its own timer. Polls that
arrive are then appended as a page, without reading what is held. The first timer that the
watermark passes takes the due buckets of its resource, one after the other; of the last
one, what is not due stays. When all buckets are empty the resource is held in one value
again. A task thus holds ``HELD_POLLS`` or one bucket of one resource at a time, beside the
rows that Arrow brings at once, however many polls of it a batch brings.

A poll without a time or a sequence has no place in an order and is left out. NULL in
a key is a value like any other.

Beside the held polls the state is one row per resource: where it stands, or that its
wait has ended. With ``forget_us`` a poll so long after the limit of an ended wait, or
after the poll before it, starts anew, and the row is dropped once the watermark is there.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fleetlens.functions.states import is_legal_edge, is_terminal
from fleetlens.operators.series import DEFAULT_POLLS, Polls, micros

STATE_STORE_SETTING = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DELAY = "1 minute"

# Python sees columns whose names start with an underscore under other names, so these do not.
POLL_COLUMNS = ["poll_us", "poll_seq", "poll_state", "poll_ready", "poll_done"]
PAGE_KEY = "bucket bigint, page int"
PAGE_STATE = "polls array<struct<at: bigint, seq: bigint, state: string, ready: boolean, done: boolean>>"
HELD_STATE = f"paged boolean, first bigint, {PAGE_STATE}"
BUCKET_KEY = "bucket bigint"
BUCKET_STATE = "pages int, first bigint"
WAIT_STATE = "start bigint, state string, ready boolean, closed boolean"
EDGE_STATE = "state string, entered bigint, last bigint"
BEAT_STATE = "state string, close bigint, polls bigint, last bigint"
FRAME_ROWS = 10_000
BUCKET_US = 600_000_000
# Appending rewrites what is held in one value, so it stays small.
HELD_POLLS = 512


def require_rocksdb(df: DataFrame) -> None:
    if df.sparkSession.conf.get(STATE_STORE_SETTING) != ROCKSDB:
        raise ValueError(f"set {STATE_STORE_SETTING} to {ROCKSDB}: these streams use timers and several state columns")


KEY = "poll_key"
_KEY_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}


def _polls(snaps: DataFrame, polls: Polls, ready: Column, done: Column, delay: str) -> DataFrame:
    """Polls with a time and a sequence, under one text that stands for their key, NULLs included."""
    slim = snaps.select(
        F.to_json(F.struct(*polls.keys), _KEY_OPTIONS).alias(KEY),
        F.col(polls.ts).cast("timestamp").alias("poll_time"),
        micros(polls.ts).alias("poll_us"),
        F.col(polls.seq).cast("bigint").alias("poll_seq"),
        F.col(polls.state).alias("poll_state"),
        ready.alias("poll_ready"),
        done.alias("poll_done"),
    ).withWatermark("poll_time", delay)
    return slim.dropna(subset=["poll_us", "poll_seq"])


def _with_keys(found: DataFrame, snaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The key columns in place of the text that stands for them."""
    schema = ", ".join(f"`{key}` {snaps.schema[key].dataType.simpleString()}" for key in keys)
    others = [F.col(name) for name in found.columns if name != KEY]
    return found.withColumn(KEY, F.from_json(KEY, schema, _KEY_OPTIONS)).select(
        *[F.col(f"{KEY}.`{key}`").alias(key) for key in keys], *others
    )


def _milliseconds(us: int) -> int:
    """Timers count milliseconds: rounded up, so that none fires before its time."""
    return -(-us // 1000)


class InOrder(StatefulProcessor):
    """Holds the polls of a resource until the watermark has passed them, then folds them in order."""

    state_schema: str
    held_polls = HELD_POLLS

    def __init__(self, bucket_us: int = BUCKET_US, forget_us: int | None = None):
        if bucket_us % 1000:
            raise ValueError("a bucket is whole milliseconds long, as timers are")
        self.bucket_us = bucket_us
        self.forget_us = forget_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", HELD_STATE)
        self.pages = handle.getMapState("pages", PAGE_KEY, PAGE_STATE)
        self.buckets = handle.getMapState("buckets", BUCKET_KEY, BUCKET_STATE)
        self.seen = handle.getValueState("seen", "passed bigint")
        self.state = handle.getValueState("state", self.state_schema)

    def fold(self, key: tuple, polls: list[tuple], passed: int) -> Iterator[pd.DataFrame]:
        """Takes polls in order; none at or before the time ``passed`` is still to come."""
        raise TypeError(f"{type(self).__name__} folds nothing")

    def finished(self) -> bool:
        """Whether no poll can matter any more."""
        return False

    def kept_until(self) -> int | None:
        """The time beyond which a poll starts anew; None while there is none."""
        raise TypeError(f"{type(self).__name__} keeps nothing")

    def stored(self) -> tuple | None:
        return self.state.get()

    def timer(self, us: int) -> None:
        self.handle.registerTimer(_milliseconds(us))

    def hold(self, bucket: int, polls: list[tuple]) -> None:
        """Appends a page to a bucket; its timer is that of its earliest poll."""
        pages, first = self.buckets.getValue((bucket,)) if self.buckets.containsKey((bucket,)) else (0, None)
        earliest = min(poll[0] for poll in polls)
        self.pages.updateValue((bucket, pages), (polls,))
        if first is None or earliest < first:
            self.timer(earliest)
            first = earliest
        self.buckets.updateValue((bucket,), (pages + 1, first))

    def due(self, bucket: int, passed: int) -> list[tuple]:
        """Takes the polls of a bucket that the watermark has passed, in order."""
        if not self.buckets.containsKey((bucket,)):
            return []
        pages, _ = self.buckets.getValue((bucket,))
        ready, later = [], []
        for page in range(pages):
            for poll in self.pages.getValue((bucket, page))[0]:
                (ready if poll[0] <= passed else later).append(tuple(poll))
            self.pages.removeKey((bucket, page))
        self.buckets.removeKey((bucket,))
        if later:
            self.hold(bucket, later)
        return sorted(ready, key=lambda poll: poll[:2])

    def hold_by_bucket(self, polls: list[tuple]) -> None:
        """Appends polls to the buckets of their times."""
        by_bucket: dict[int, list[tuple]] = {}
        for poll in polls:
            by_bucket.setdefault(poll[0] // self.bucket_us, []).append(poll)
        for bucket, inside in by_bucket.items():
            self.hold(bucket, inside)

    def hold_together(self, polls: list[tuple], first: int | None) -> None:
        """Holds all polls in one value; ``first`` is the time of its timer, if there is one."""
        earliest = min(poll[0] for poll in polls)
        if first is None or earliest < first:
            self.timer(earliest)
            first = earliest
        self.held.update((False, first, polls))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if self.finished():
            return
        paged, first, held = self.held.get() or (False, None, [])
        polls = [tuple(poll) for poll in held]
        was_paged = paged
        for chunk in rows:
            numbers = [chunk[name].astype(int).tolist() for name in POLL_COLUMNS[:2]]
            flags = [chunk[name].astype(bool).tolist() for name in POLL_COLUMNS[3:]]
            # A missing state is None, also where pandas has NaN for it.
            states = [state if isinstance(state, str) else None for state in chunk["poll_state"]]
            polls.extend(zip(*numbers, states, *flags, strict=True))
            if paged or len(polls) > self.held_polls:
                paged = True
                self.hold_by_bucket(polls)
                polls = []
        if paged:
            self.seen.clear()
            if not was_paged:
                self.held.update((True, None, []))
        elif polls:
            self.hold_together(polls, first)
        yield from ()

    def fold_buckets(self, key: tuple, passed: int) -> Iterator[pd.DataFrame]:
        """Folds the due buckets, one after the other."""
        held = [(bucket[0], first) for bucket, (_, first) in self.buckets.iterator()]
        for bucket in sorted(bucket for bucket, first in held if first <= passed):
            polls = self.due(bucket, passed)
            yield from self.fold(key, polls, min(passed, (bucket + 1) * self.bucket_us - 1))
        yield from self.fold(key, [], passed)
        if not any(True for _ in self.buckets.keys()):
            self.held.clear()

    def fold_together(self, key: tuple, held: tuple | None, passed: int) -> Iterator[pd.DataFrame]:
        """Folds what is due of the polls held in one value."""
        polls = [tuple(poll) for poll in held[2]] if held else []
        ready = sorted((poll for poll in polls if poll[0] <= passed), key=lambda poll: poll[:2])
        if ready:
            later = [poll for poll in polls if poll[0] > passed]
            if later:
                self.hold_together(later, None)
            else:
                self.held.clear()
        yield from self.fold(key, ready, passed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Folds all that is due; further timers of the same watermark find nothing new."""
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        held = self.held.get()
        if held is None or not held[0]:
            yield from self.fold_together(key, held, passed)
        else:
            seen = self.seen.get()
            if seen is not None and seen[0] == passed:
                return
            self.seen.update((passed,))
            yield from self.fold_buckets(key, passed)
        until = self.kept_until()
        if until is not None and until <= passed:
            self.state.clear()
            self.seen.clear()
        elif until is not None:
            self.timer(until)

    def rows(self, key: tuple, columns: dict[str, list]) -> pd.DataFrame:
        """A frame whose rows all belong to one key; missing values stay missing in every type."""
        size = len(next(iter(columns.values())))
        return pd.DataFrame({KEY: [key[0]] * size, **columns}, dtype=object)

    def close(self) -> None:
        pass


class WaitProcessor(InOrder):
    """Emits one outcome row per resource: when it is done, or when its time is up."""

    state_schema = WAIT_STATE

    def __init__(self, outcome: str, timeout_us: int, bucket_us: int = BUCKET_US, forget_us: int | None = None):
        super().__init__(bucket_us, forget_us)
        self.outcome = outcome
        self.timeout_us = timeout_us

    def finished(self) -> bool:
        stored = self.stored()
        return stored is not None and stored[3] and self.forget_us is None

    def kept_until(self) -> int | None:
        stored = self.stored()
        if self.forget_us is None or stored is None or not stored[3]:
            return None
        return stored[0] + self.timeout_us + self.forget_us

    def _closed(self, key: tuple, start: int, outcome: str, elapsed, state, ready) -> pd.DataFrame:
        """The outcome row; of the wait no more than a mark stays, so that later polls don't open it again."""
        self.state.update((start, None, None, True))
        if self.forget_us is None:
            self.held.clear()
            self.pages.clear()
            self.buckets.clear()
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
        return self.rows(
            key, {"outcome": [outcome], "elapsed_us": [elapsed], "last_state": [state], "last_head_ready": [ready]}
        )

    def fold(self, key, polls, passed):
        while True:
            stored = self.stored()
            if stored is not None and stored[3]:
                until = self.kept_until()
                polls = [poll for poll in polls if until is not None and poll[0] > until]
                stored = None
            if stored is None and not polls:
                return
            start, state, ready, _ = stored or (polls[0][0], None, None, False)
            closing = self._closing(key, polls, passed, start, state, ready)
            if closing is None:
                return
            yield closing

    def _closing(self, key, polls, passed, start, state, ready) -> pd.DataFrame | None:
        """The outcome row of a wait, or None if it goes on."""
        limit = start + self.timeout_us
        for at, _, now, ready_now, done in polls:
            if at >= limit:
                break
            state, ready = now, ready_now
            if done:
                return self._closed(key, start, self.outcome, at - start, state, ready)
        if limit <= passed:
            return self._closed(key, start, "TIMEOUT", None, state, ready)
        self.state.update((start, state, ready, False))
        self.timer(limit)
        return None


class EdgeProcessor(InOrder):
    """Emits state changes once no earlier poll can come any more."""

    state_schema = EDGE_STATE

    def kept_until(self) -> int | None:
        stored = self.stored()
        return None if self.forget_us is None or stored is None else stored[2] + self.forget_us

    def fold(self, key, polls, passed):
        if not polls:
            return
        state, entered, last = self.stored() or (polls[0][2], polls[0][0], polls[0][0])
        found = {name: [] for name in ("at_us", "seq", "from_state", "to_state", "dwell_us")}
        for at, seq, now, _, _ in polls:
            if self.forget_us is not None and at - last > self.forget_us:
                state, entered = now, at
            if now != state:
                for name, value in zip(found, (at, seq, state, now, at - entered), strict=True):
                    found[name].append(value)
                state, entered = now, at
            last = at
        self.state.update((state, entered, last))
        if found["seq"]:
            yield self.rows(key, found)


class BeatProcessor(InOrder):
    """Emits the status of a resource at the end of every interval since its first poll."""

    state_schema = BEAT_STATE

    def __init__(self, interval_us: int, bucket_us: int = BUCKET_US, silent_us: int | None = None):
        super().__init__(bucket_us, silent_us)
        self.interval_us = interval_us

    def kept_until(self) -> int | None:
        stored = self.stored()
        return None if self.forget_us is None or stored is None else stored[3] + self.forget_us + self.interval_us

    def fold(self, key, polls, passed):
        stored = self.stored()
        if stored is None and not polls:
            return
        state, close, count, last = stored or (None, None, 0, None)
        found: dict[str, list] = {"close_us": [], "state": [], "polls": []}

        def beats(until: int) -> Iterator[pd.DataFrame]:
            """Closes the intervals that end by then, as long as the resource isn't given up."""
            nonlocal close, count
            while close <= until and (self.forget_us is None or close <= last + self.forget_us + self.interval_us):
                for name, value in zip(found, (close, state, count), strict=True):
                    found[name].append(value)
                close, count = close + self.interval_us, 0
                if len(found["polls"]) == FRAME_ROWS:
                    yield self.rows(key, found)
                    for values in found.values():
                        values.clear()

        for at, _, now, _, _ in polls:
            if close is not None:
                yield from beats(at)
            if close is None or close <= at:
                close, count = (at // self.interval_us + 1) * self.interval_us, 0
            state, count, last = now, count + 1, at
        yield from beats(passed)
        if found["polls"]:
            yield self.rows(key, found)
        self.state.update((state, close, count, last))
        self.timer(close)


def _wait_stream(
    snaps: DataFrame, polls: Polls, done, outcome: str, timeout_us: int, delay: str, bucket_us: int, forget_us: int | None
) -> DataFrame:
    require_rocksdb(snaps)
    ready = (
        F.coalesce(F.col(polls.head_ready), F.lit(False))
        if polls.head_ready in snaps.columns
        else F.lit(False)
    )
    found = _polls(snaps, polls, ready, done, delay).groupBy(KEY).transformWithStateInPandas(
        statefulProcessor=WaitProcessor(outcome, timeout_us, bucket_us, forget_us),
        outputStructType=f"{KEY} string, outcome string, elapsed_us bigint, last_state string, last_head_ready boolean",
        outputMode="Append",
        timeMode="EventTime",
    )
    return _with_keys(found, snaps, polls.keys)


def wait_ready_stream(
    snaps: DataFrame,
    timeout_us: int,
    polls: Polls = DEFAULT_POLLS,
    delay: str = DELAY,
    bucket_us: int = BUCKET_US,
    forget_us: int | None = None,
) -> DataFrame:
    """Streaming ``wait_ready``: READY or TIMEOUT when the watermark passes the poll or the limit.

    ``delay`` is how late polls may come; the earliest poll of a resource starts its clock.
    """
    done = F.coalesce((F.col(polls.state) == "RUNNING") & F.col(polls.head_ready), F.lit(False))
    return _wait_stream(snaps, polls, done, "READY", timeout_us, delay, bucket_us, forget_us)


def wait_terminal_stream(
    snaps: DataFrame,
    timeout_us: int,
    mode: str = "CRD",
    polls: Polls = DEFAULT_POLLS,
    delay: str = DELAY,
    bucket_us: int = BUCKET_US,
    forget_us: int | None = None,
) -> DataFrame:
    """Streaming ``wait_terminal``."""
    if mode == "DASHBOARD":
        snaps = snaps.withColumn(polls.state, F.upper(F.coalesce(F.col(polls.state), F.lit(""))))
    done = F.coalesce(is_terminal(polls.state), F.lit(False))
    return _wait_stream(snaps, polls, done, "TERMINAL", timeout_us, delay, bucket_us, forget_us).drop("last_head_ready")


def transitions_stream(
    snaps: DataFrame,
    kind: str,
    polls: Polls = DEFAULT_POLLS,
    delay: str = DELAY,
    bucket_us: int = BUCKET_US,
    forget_us: int | None = None,
) -> DataFrame:
    """Streaming ``transitions``; ``at_us`` is the time of the poll that showed the new state.

    ``delay`` is how late polls may come; a change is emitted when the watermark passes its poll.
    """
    require_rocksdb(snaps)
    no = F.lit(False)
    edges = _polls(snaps, polls, no, no, delay).groupBy(KEY).transformWithStateInPandas(
        statefulProcessor=EdgeProcessor(bucket_us, forget_us),
        outputStructType=f"{KEY} string, at_us bigint, seq bigint, from_state string, to_state string, dwell_us bigint",
        outputMode="Append",
        timeMode="EventTime",
    )
    legal = is_legal_edge(F.lit(kind), "from_state", "to_state")
    return _with_keys(edges, snaps, polls.keys).withColumn("legal", F.coalesce(legal, F.lit(False)))


def heartbeat_stream(
    snaps: DataFrame,
    interval_us: int,
    polls: Polls = DEFAULT_POLLS,
    delay: str = DELAY,
    bucket_us: int = BUCKET_US,
    silent_us: int | None = None,
) -> DataFrame:
    """The status of every resource per interval, also of those that were silent in it.

    One row for each interval since that of a resource's first poll: the state of the last
    poll before its end, and the polls in it, which may be none. A resource that has been
    silent for ``silent_us`` is given up until its next poll. Rows are final when the
    watermark has passed the end of their interval.
    """
    require_rocksdb(snaps)
    no = F.lit(False)
    beats = _polls(snaps, polls, no, no, delay).groupBy(KEY).transformWithStateInPandas(
        statefulProcessor=BeatProcessor(interval_us, bucket_us, silent_us),
        outputStructType=f"{KEY} string, close_us bigint, state string, polls bigint",
        outputMode="Append",
        timeMode="EventTime",
    )
    found = _with_keys(beats, snaps, polls.keys)
    closes = F.col("close_us")
    return found.select(
        F.timestamp_micros(closes - interval_us).alias("window_start"), F.timestamp_micros(closes).alias("window_end"),
        *polls.keys, "state", "polls",
    )

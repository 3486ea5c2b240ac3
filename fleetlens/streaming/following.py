"""Lines held until the watermark has passed them, and the spans of time in which none is given.

Lines and spans of many jobs share one group, so that a call to the state store takes many of
them. The lines of a group lie in pages of up to ``PAGE_ROWS``, each in order of time and with
the time of its first line, so that only pages with a due line are read. Spans of a job that
overlap or touch are one span: however often a job is polled after its end, a line is compared
with one span only. A task holds one page and the spans of one group at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Columns of the rows that come in: a line at a time, or a span after its start up to its end.
GROUP, KEY, AT, UNTIL, IS_SPAN, ROW = "line_group", "job_key", "at_us", "until_us", "is_span", "line_row"
OUTPUT = f"{AT} bigint, {ROW} string"
PAGE_ROWS = 10_000


def packed(frame: pd.DataFrame) -> bytes:
    """The rows as an Arrow stream, which the state store holds as one value."""
    table = pa.Table.from_pandas(frame, preserve_index=False).replace_schema_metadata(None)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(value: bytes) -> pd.DataFrame:
    with pa.ipc.open_stream(bytes(value)) as reader:
        return reader.read_all().to_pandas()


def merged(spans: pd.DataFrame) -> pd.DataFrame:
    """The same times of every job in as few spans as there can be, in order of job and time."""
    if spans.empty:
        return spans
    spans = spans.sort_values([KEY, AT], ignore_index=True)
    reached = spans.groupby(KEY, sort=False)[UNTIL].cummax().to_numpy()
    keys, starts = spans[KEY].to_numpy(), spans[AT].to_numpy()
    new = np.ones(len(spans), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (starts[1:] > reached[:-1])
    # The last row of a merged span has the latest end of all its rows.
    last = np.append(np.flatnonzero(new)[1:], len(spans)) - 1
    return pd.DataFrame({KEY: keys[new], AT: starts[new], UNTIL: reached[last]})


def outside(lines: pd.DataFrame, spans: pd.DataFrame) -> pd.DataFrame:
    """The lines that lie in no span of their job; both in order of time."""
    if spans.empty:
        return lines
    starts = spans[[KEY, AT]].assign(place=np.arange(len(spans)))
    place = pd.merge_asof(lines[[KEY, AT]], starts, on=AT, by=KEY, allow_exact_matches=False)["place"].to_numpy()
    begun = ~np.isnan(place)
    until = spans[UNTIL].to_numpy()[np.where(begun, place, 0).astype(int)]
    return lines[~(begun & (lines[AT].to_numpy() <= until))]


class Following(StatefulProcessor):
    """Gives the lines of a group once the watermark has passed them, without those in a span of their job."""

    def __init__(self, page_rows: int = PAGE_ROWS):
        self.page_rows = page_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", "pages int")
        self.firsts = handle.getMapState("firsts", "page int", "first bigint")
        self.pages = handle.getMapState("pages", "page int", "lines binary")
        self.spans = handle.getValueState("spans", "spans binary")

    def timer(self, us: int) -> None:
        """Timers count milliseconds: rounded up, so that none fires before its time."""
        self.handle.registerTimer(-(-us // 1000))

    def hold(self, page: int, lines: pd.DataFrame) -> int:
        """Stores lines in order of time under a page; the time of the first one."""
        first = int(lines[AT].iloc[0])
        self.firsts.updateValue((page,), (first,))
        self.pages.updateValue((page,), (packed(lines),))
        return first

    def hold_spans(self, spans: pd.DataFrame) -> None:
        """Stores spans, with a timer for when none of them matters any more."""
        if spans.empty:
            self.spans.clear()
            return
        self.spans.update((packed(spans),))
        self.timer(int(spans[UNTIL].max()))

    def held_spans(self) -> pd.DataFrame | None:
        held = self.spans.get()
        return None if held is None else unpacked(held[0])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        page = before = (self.count.get() or (0,))[0]
        spans = None
        for chunk in rows:
            is_span = chunk[IS_SPAN].astype(bool)
            lines = chunk.loc[~is_span, [KEY, AT, ROW]].sort_values(AT, kind="stable", ignore_index=True)
            firsts = []
            for start in range(0, len(lines), self.page_rows):
                firsts.append(self.hold(page, lines.iloc[start:start + self.page_rows]))
                page += 1
            if firsts:
                self.timer(firsts[0])
            if is_span.any():
                spans = merged(pd.concat([spans, chunk.loc[is_span, [KEY, AT, UNTIL]]], ignore_index=True))
        if page > before:
            self.count.update((page,))
        if spans is not None:
            held = self.held_spans()
            self.hold_spans(spans if held is None else merged(pd.concat([held, spans], ignore_index=True)))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Gives all that is due; further timers of the same watermark find nothing new."""
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        firsts = {page: first for (page,), (first,) in self.firsts.iterator()}
        spans = self.held_spans()
        by_time = pd.DataFrame() if spans is None else spans.sort_values(AT, ignore_index=True)
        for page in sorted(page for page, first in firsts.items() if first <= passed):
            lines = unpacked(self.pages.getValue((page,))[0])
            due = int(np.searchsorted(lines[AT].to_numpy(), passed, side="right"))
            if due < len(lines):
                firsts[page] = self.hold(page, lines.iloc[due:])
            else:
                self.firsts.removeKey((page,))
                self.pages.removeKey((page,))
                del firsts[page]
            given = outside(lines.iloc[:due], by_time)
            if not given.empty:
                yield given[[AT, ROW]]
        if firsts:
            self.timer(min(firsts.values()))
        else:
            self.count.clear()
        if spans is not None and (spans[UNTIL] <= passed).any():
            self.hold_spans(spans[spans[UNTIL] > passed])

    def close(self) -> None:
        pass

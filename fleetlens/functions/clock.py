"""Instants, ages and durations in whole microseconds.

Every rule takes the reading time ``as_of`` explicitly, so the same rows give
the same answer on every run. Integer microseconds keep results comparable.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlens.functions.columns import ColumnLike, col, whole_div

# Shape of an ISO date-time, and of its zone suffix.
_ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
_ZONE = r"[0-9](Z|[+-][0-9]{2}:?[0-9]{2})$"

AsOf = Column | dt.datetime | str


def instant(as_of: AsOf) -> Column:
    """A timestamp column from a column, a ``datetime`` or ISO text."""
    if isinstance(as_of, Column):
        return as_of.cast("timestamp")
    if isinstance(as_of, dt.datetime):
        stamp = as_of if as_of.tzinfo else as_of.replace(tzinfo=dt.timezone.utc)
        as_of = stamp.isoformat()
    return F.lit(as_of).cast("timestamp")


def parse_instant(text: ColumnLike) -> Column:
    """Timestamp of ISO text, NULL when malformed."""
    return F.when(col(text).rlike(_ISO_DATE), F.try_to_timestamp(col(text)))


def has_zone(text: ColumnLike) -> Column:
    """True when ISO text names its time zone."""
    return col(text).rlike(_ZONE) & col(text).contains(":")


def age_us(created: ColumnLike, as_of: AsOf) -> Column:
    """Microseconds since creation; 0 when the text is missing, malformed or has no zone."""
    born = F.when(has_zone(created), parse_instant(created))
    return F.coalesce(F.unix_micros(instant(as_of)) - F.unix_micros(born), F.lit(0).cast("bigint"))


def job_duration_us(start: ColumnLike, end: ColumnLike, state: ColumnLike, as_of: AsOf) -> Column:
    """Run time of a job from its ISO start and end texts.

    A given end always wins. Without one, only running and pending jobs have a
    run time, up to ``as_of``. Texts that cannot be parsed, or that mix zoned
    with zoneless times, give NULL.
    """
    started, ended = parse_instant(start), parse_instant(end)
    has_start = F.coalesce(F.length(col(start)) > 0, F.lit(False))
    has_end = F.coalesce(F.length(col(end)) > 0, F.lit(False))
    finished = F.when(
        has_zone(start) == has_zone(end), F.unix_micros(ended) - F.unix_micros(started)
    )
    ongoing = F.when(
        has_zone(start) & col(state).isin("RUNNING", "PENDING"),
        F.unix_micros(instant(as_of)) - F.unix_micros(started),
    )
    return F.when(has_start & has_end, finished).when(has_start, ongoing)


def age_label(age: ColumnLike) -> Column:
    """Short age text: seconds, minutes, hours or days, truncated."""
    seconds = whole_div(col(age), 1_000_000)
    return (
        F.when(seconds < 60, F.concat(seconds.cast("string"), F.lit("s")))
        .when(seconds < 3600, F.concat(whole_div(seconds, 60).cast("string"), F.lit("m")))
        .when(seconds < 86400, F.concat(whole_div(seconds, 3600).cast("string"), F.lit("h")))
        .otherwise(F.concat(whole_div(seconds, 86400).cast("string"), F.lit("d")))
    )

"""Splitting hot groups so that no task has to hold one of them whole.

A resource may hold a large share of all poll rows. Operators that need the rows of
one resource next to the statistics of the resource deal them out by hash, and work
on ``(key, slice)``. Groups below the threshold keep the single slice 0. The answer
never depends on the slices. Any number of groups is cut, and a NULL in a key is a
value like any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 4_000_000

SLICE = "_slice"
SLICES = "_slices"


@dataclass(frozen=True)
class Sliced:
    """Rows tagged with their slice, and one statistics row per key."""

    rows: DataFrame
    stats: DataFrame
    keys: list[str]


def slice_hot_groups(
    rows: DataFrame, keys: Sequence[str], ts: str | None, deal_by: Sequence[str], hot_rows: int = HOT_ROWS
) -> Sliced:
    """Cut every group of more than ``hot_rows`` rows into slices of about that many, in no order.

    Rows are dealt out by a hash of ``deal_by``. The statistics of a key are its row count
    ``_n`` and, where ``ts`` is given, its first time ``_from`` in microseconds. They are combined
    on the map side, so one row per key and input task is shuffled.
    """
    keys = list(keys)
    told = [F.count(F.lit(1)).alias("_n")]
    if ts is not None:
        told.append(F.min(F.unix_micros(F.col(ts).cast("timestamp"))).alias("_from"))
    stats = rows.groupBy(*keys).agg(*told)
    shares = F.ceil(F.col("_n") / hot_rows).cast("int")
    stats = stats.withColumn(SLICES, F.when(F.col("_n") > hot_rows, shares).otherwise(F.lit(1)))
    hot = stats.where(F.col("_n") > hot_rows).select(*keys, SLICES)
    position = F.pmod(F.xxhash64(*deal_by), F.col(SLICES)).cast("int")
    sliced = join_null_safe(rows, hot, keys, "left").withColumns(
        {SLICE: F.coalesce(position, F.lit(0)), SLICES: F.coalesce(F.col(SLICES), F.lit(1))}
    )
    return Sliced(sliced, stats, keys)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """An equality join on ``keys`` in which NULL equals NULL; the keys of the left side stay."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    same = reduce(and_, [F.col(key).eqNullSafe(F.col(f"_right_{key}")) for key in keys])
    return left.join(renamed, same, how).drop(*[f"_right_{key}" for key in keys])


def with_stats(sliced: Sliced, columns: Sequence[str]) -> DataFrame:
    """Rows next to the statistics of their key.

    The statistics of a hot key are repeated once per slice, so its rows stay
    spread over as many tasks as it has slices.
    """
    spread = sliced.stats.select(
        *sliced.keys,
        *columns,
        F.explode(F.sequence(F.lit(0), F.col(SLICES) - 1)).alias(SLICE),
    )
    return join_null_safe(sliced.rows, spread, [*sliced.keys, SLICE], "left")


def with_repeated(sliced: Sliced, right: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows next to the rows of another table that have their key, or to NULLs.

    What the table has for a hot key is repeated once per slice. NULL keys meet nothing.
    ``partitions`` says over how many parts both sides are dealt.
    """
    hot = sliced.stats.where(F.col(SLICES) > 1).select(*sliced.keys, SLICES)
    spread = right.join(hot, sliced.keys, "left").withColumn(
        SLICE, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(SLICES), F.lit(1)) - 1))
    )
    keys = [*sliced.keys, SLICE]
    rows, spread = sliced.rows.drop(SLICES), spread.drop(SLICES)
    if partitions:
        rows, spread = (side.repartition(partitions, *keys) for side in (rows, spread))
    return rows.join(spread, keys, "left").drop(SLICE)

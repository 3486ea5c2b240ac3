"""Writing views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

FORMATS = ("json", "parquet")


def write_view(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), mode: str = "errorifexists"
) -> None:
    """Write a view as JSON lines or parquet, laid out by the given columns."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; expected one of {FORMATS}")
    df.write.mode(mode).partitionBy(*partition_by).format(fmt).save(path)


def write_bucketed(
    df: DataFrame, name: str, path: str, keys: Sequence[str] = ("namespace", "name"), buckets: int = 64, mode: str = "errorifexists"
) -> DataFrame:
    """Land a table so that joins on its keys need no shuffle, and give it back as it is stored.

    The rows are dealt once by the keys into ``buckets`` files, sorted within each. Tables with
    the same keys and number of buckets are then joined file by file, as often as they are used:
    ``lookup``, ``reconcile``, ``plan_scale`` and joins of the like read them without an
    exchange. Choose so many buckets that one fits the memory of a task.
    """
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)

"""Fleet-wide counts and utilisation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fleet_summary(
    status: DataFrame,
    dims: tuple[str, str] = ("namespace", "state"),
    sums: tuple[str, ...] = ("workers_ready", "workers_desired"),
) -> DataFrame:
    """Counts and sums per namespace and state, with subtotals and a grand total.

    Rows are first combined per namespace and state, so the subtotals are built
    from that small table rather than from a threefold copy of every row.
    """
    groups = status.groupBy(*dims).agg(
        F.count(F.lit(1)).alias("resources"), *[F.sum(name).alias(name) for name in sums]
    )
    return groups.rollup(*dims).agg(
        F.sum("resources").alias("resources"), *[F.sum(name).alias(name) for name in sums]
    )


def utilization(
    metrics: DataFrame,
    keys: tuple[str, ...] = ("cluster",),
    ts: str = "observed_at",
    values: tuple[str, ...] = ("available_cpus", "available_gpus"),
    unit: str = "hour",
) -> DataFrame:
    """Lowest, mean and highest availability per cluster and hour."""
    aggregates = []
    for name in values:
        aggregates += [
            F.min(name).alias(f"min_{name}"),
            F.avg(name).alias(f"mean_{name}"),
            F.max(name).alias(f"max_{name}"),
        ]
    return metrics.groupBy(*keys, F.date_trunc(unit, F.col(ts)).alias("period")).agg(*aggregates)

"""What the operators share: tables, the shared folder, cut lineage, connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000


def text_batches(spark: SparkSession) -> None:
    """Lets the session send texts to Python in batches of at most ``BATCH_ROWS``.

    The default of 10,000 rows is meant for narrow rows; with whole texts it makes every
    Python worker hold tens of megabytes several times over. Queries and stages call
    this, operators don't.
    """
    if int(spark.conf.get(BATCH_SETTING)) > BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


def shared_root(spark: SparkSession) -> str:
    """The folder that the driver and all executors reach.

    The session names it. Only a local session without the setting, as in a test,
    gets a folder of its own.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getConf().get(CHECKPOINT_SETTING)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="fleetlens-llm-")
        spark.conf.set(CHECKPOINT_SETTING, root)
    return root.rstrip("/")


def written(rows: DataFrame, name: str, merged: bool = True) -> DataFrame:
    """The rows as a table in the shared folder: its size is known and a lost executor costs nothing.

    ``merged`` is for narrow results of a shuffle: they are dealt anew to one file per
    core, instead of one per shuffle partition. Results of a scan keep its tasks.
    """
    spark = rows.sparkSession
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    (rows.repartition(spark.sparkContext.defaultParallelism) if merged else rows).write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def small(rows: DataFrame, max_rows: int) -> DataFrame:
    """The rows of a written table, marked for broadcasting if there are few enough of them."""
    return F.broadcast(rows) if rows.count() <= max_rows else rows


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """One round of stars: neighbours of a node are hung on the smallest of them.

    ``larger``: those above the node; else the node and those below it. Minima are
    combined before the shuffle, so a hub costs no more than its edges.
    """
    if larger:
        sides = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        sides = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lowest = sides.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    joined = sides.join(lowest, "a")
    if larger:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        own = lowest.select("a", F.col("low").alias("b"))
        out = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(own)
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): one row (a, b) per node but the smallest, b the smallest.

    Alternates large and small stars until nothing changes; every round is written to
    the shared folder, and only the size and a checksum of a round reach the driver.
    """

    def mark(rows: DataFrame):
        return rows.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    now = written(edges.where("a <> b").select("a", "b").distinct(), "edges")
    before, after = None, mark(now)
    while before != after:
        now = written(_stars(_stars(now, True), False), "edges")
        before, after = after, mark(now)
    return now

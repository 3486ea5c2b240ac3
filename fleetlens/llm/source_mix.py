"""Mixing sources to target weights by entropy balancing.

Among all document rates, those closest to one in relative entropy that give each source
its target of tokens are exp(lambda_source * size): an exponential tilt, cut off at
``most`` copies. The lambdas maximise the convex dual. They are found by distributed
Newton iterations, kept inside a bracket: one aggregation over (source, size) counts per
iteration, all sources at once. Rates become whole copies by a keyed uniform number per
document; a shift common to a source, searched over all its documents, brings the copies
to the target within about one document.

Sums are of whole numbers, so reruns agree to the last copy. Only scalars reach the
driver; tables have a row per source, or per source and size.

A null text has size 0 and is never taken. A null source is a source of its own, ordered
last. Repeated rows share their number and are taken alike. Without any word all targets
are 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.shared import small, written

SCALE = 1024
FAN = 16


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def _exact(value: Column) -> Column:
    """Sum that does not depend on the order: in units of 1 / SCALE."""
    return F.sum(F.rint(value * SCALE).cast("decimal(38,0)")).cast("double") / SCALE


def _in_order(by_source: DataFrame) -> DataFrame:
    """Adds ``place``, from 0, in code point order of the sources, null last.

    Sources are cut into ranges and numbered within each, so no task orders all of
    them; the window over the ranges' sizes has as many rows as there are ranges.
    """
    order = F.col("source").asc_nulls_last()
    ranges = by_source.sparkSession.sparkContext.defaultParallelism
    cut = written(by_source.repartitionByRange(ranges, order).withColumn("part", F.spark_partition_id()), "ranges", merged=False)
    before = F.sum("count").over(Window.orderBy("part")) - F.col("count")
    starts = cut.groupBy("part").count().select("part", before.alias("before"))
    within = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    return cut.withColumn("place", within).join(F.broadcast(starts), "part").withColumn("place", F.col("place") + F.col("before")).drop("part", "before")


def source_targets(counts: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """(source, source_size, n_docs, target) from (source, size, n).

    Sources in code point order, null last, weigh ``weights`` in turn and share all
    tokens; a target stops at ``most`` times its source's size and the excess is shared
    again by weight.
    """
    by_source = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs"))
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    sources = written(_in_order(by_source).withColumn("weight", turn).drop("place"), "sources")
    cap = F.col("source_size") * most
    total, free = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    level = total / free if free else 0.0
    while True:
        above = F.col("weight") * level >= cap
        held, free = sources.agg(
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0.0)), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0))
        ).first()
        raised = (total - held) / free if free else level
        if raised <= level:
            break
        level = raised
    return sources.withColumn("target", F.least(cap, F.col("weight") * level)).drop("weight")


def _rate(tilt: Column, size: Column, mean: Column, most: float) -> Column:
    return F.least(F.lit(most), F.exp(F.least(F.lit(50.0), tilt * size / mean)))


def tilts(counts: DataFrame, targets: DataFrame, most: float = 3.0, steps: int = 60, close: float = 1e-7) -> DataFrame:
    """Adds ``mean`` and ``tilt`` to the sources: the dual solution by Newton iterations."""
    share = F.col("target") / F.col("source_size")
    edge = F.when(F.col("target") <= 0, F.lit(0.0)).otherwise(F.col("mean") * F.log(share))
    sources = targets.withColumn("mean", F.col("source_size") / F.col("n_docs")).withColumn("edge", edge)
    sources = sources.select(
        "*",
        F.least(F.lit(0.0), "edge").alias("low"),
        F.greatest(F.lit(0.0), "edge").alias("high"),
        F.lit(0.0).alias("tilt"),
        ((F.col("target") <= 0) | (F.col("target") >= F.col("source_size") * most)).alias("done"),
    ).drop("edge")
    state = written(sources, "tilts")
    for _ in range(steps):
        if state.where("not done").isEmpty():
            break
        open_ones = state.where("not done").select("source", "mean", "tilt")
        mass = F.col("n") * F.col("size")
        moved = (
            counts.join(open_ones, counts["source"].eqNullSafe(open_ones["source"]))
            .drop(open_ones["source"])
            .withColumn("rate", _rate(F.col("tilt"), F.col("size"), F.col("mean"), most))
            .groupBy("source")
            .agg(
                _exact(mass * F.col("rate")).alias("got"),
                _exact(F.when(F.col("rate") < most, mass * F.col("rate") * F.col("size") / F.col("mean")).otherwise(0.0)).alias("slope"),
            )
            .withColumnRenamed("source", "moved_source")
        )
        joined = state.join(moved, state["source"].eqNullSafe(moved["moved_source"]), "left")
        over = F.col("got") > F.col("target")
        joined = joined.withColumns(
            {
                "low": F.when(F.col("done") | over, F.col("low")).otherwise(F.col("tilt")),
                "high": F.when(over & ~F.col("done"), F.col("tilt")).otherwise(F.col("high")),
                "met": F.abs(F.col("got") - F.col("target")) <= F.col("target") * close + 1.0 / SCALE,
            }
        )
        newton = F.col("tilt") - F.when(F.col("slope") > 0, (F.log("got") - F.log("target")) * F.col("got") / F.col("slope"))
        inside = (newton > F.col("low")) & (newton < F.col("high"))
        step = F.when(inside, newton).otherwise((F.col("low") + F.col("high")) / 2)
        state = written(
            joined.withColumn("tilt", F.when(F.col("done") | F.col("met"), F.col("tilt")).otherwise(step))
            .withColumn("done", F.col("done") | F.col("met"))
            .select(*state.columns),
            "tilts",
        )
    return state


def _copies(most: float, shift: Column) -> Column:
    rate = F.when(F.col("target") <= 0, F.lit(0.0)).when(
        F.col("target") >= F.col("source_size") * most, F.lit(most)
    ).otherwise(_rate(F.col("tilt"), F.col("size"), F.col("mean"), most))
    fixed = (F.col("target") <= 0) | (F.col("target") >= F.col("source_size") * most)
    drawn = F.greatest(F.lit(0.0), F.least(F.lit(most), F.floor(rate + F.col("u") + shift)))
    return F.when(fixed, rate).otherwise(drawn).cast("long")


def _with_source(rows: DataFrame, state: DataFrame, *columns: str) -> DataFrame:
    side = small(state.select(F.col("source").alias("__source"), *columns), 100_000)
    return rows.join(side, rows["source"].eqNullSafe(side["__source"])).drop("__source")


def shifts(sized: DataFrame, tilted: DataFrame, most: float = 3.0, passes: int = 5) -> DataFrame:
    """Adds ``shift``: added to every rate of a source before rounding down, it meets the target.

    Taken tokens grow with the shift. Every pass tries ``FAN`` shifts of each source in
    one aggregation over all documents and keeps the interval that holds the target.
    """
    state = written(tilted.withColumns({"at": F.lit(-1.0), "wide": F.lit(2.0), "shift": F.lit(0.0)}), "shifts")
    for _ in range(passes):
        tries = [F.col("at") + F.col("wide") * k / FAN for k in range(FAN + 1)]
        got = [F.sum(F.col("size") * _copies(most, t)).alias(f"got{k}") for k, t in enumerate(tries)]
        tried = (
            _with_source(sized, state, "source_size", "target", "mean", "tilt", "at", "wide")
            .groupBy("source").agg(*got).withColumnRenamed("source", "tried_source")
        )
        joined = state.join(tried, state["source"].eqNullSafe(tried["tried_source"]), "left")
        below = F.lit(0)
        for k in range(1, FAN):
            below = F.when(F.col(f"got{k}") <= F.col("target"), F.lit(k)).otherwise(below)
        off = [F.abs(F.col(f"got{k}") - F.col("target")) for k in range(FAN + 1)]
        nearest = F.array_min(F.array(*[F.struct(o.alias("off"), t.alias("t")) for o, t in zip(off, tries, strict=True)]))["t"]
        state = written(
            joined.withColumn("below", below)
            .withColumn("shift", F.coalesce(nearest, F.lit(0.0)))
            .withColumn("at", F.col("at") + F.col("wide") * F.col("below") / FAN)
            .withColumn("wide", F.col("wide") / FAN)
            .select(*state.columns),
            "shifts",
        )
    return state


def sized_documents(docs: DataFrame, seed: int = 11) -> DataFrame:
    """(doc_id, source, size, u): what the mix needs of a document."""
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    number = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "source", "size"), 11) / F.lit(float(1 << 53))
    return rows.withColumn("u", number)


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0, seed: int = 11) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken of every document."""
    sized = written(sized_documents(docs, seed), "sized", merged=False)
    counts = written(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "sizes")
    state = shifts(sized, tilts(counts, source_targets(counts, weights, most), most), most)
    rows = _with_source(sized, state, "source_size", "target", "mean", "tilt", "shift")
    rows = rows.withColumn("copies", _copies(most, F.col("shift")))
    return rows.select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )

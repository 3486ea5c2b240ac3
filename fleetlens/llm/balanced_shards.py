"""Shards of equal row counts that cut few links, by balanced label propagation.

Documents with equal texts are linked. The linked documents of a text are dealt by a hash of
their id into at most ``GRAINS`` vertices, so a text with two copies has two vertices and one
that holds a third of all rows has no more than ``GRAINS``. A vertex weighs its rows and starts
in a shard drawn by the same hash. Then rounds of Spark joins move vertices:

* the rows of every link are counted by shard;
* a vertex is drawn to the shard where most of its neighbours are, among those that still have
  room for it, and gains the difference to the neighbours it leaves;
* vertices that want the same shard are let in by falling gain, up to the shard's open quota.

To keep two neighbours from swapping places, a round lets vertices go in one direction only of
a ring of shards that each link turns by its own hash; the next round goes the other way. The
rounds end when two in a row move nothing, or after ``rounds``.

Documents without a link go to the shard of their hash. What a shard then holds above its quota
leaves it, unlinked documents first, and fills the open places of the others: row counts differ
by at most one. A link is cut only if its text is larger than a shard, or lost to the quotas.

Null and empty texts: a null text has no bytes (size 1, CRC of nothing) and no links; empty texts
are equal texts. Repeated rows are linked like other copies and may take each other's places.
Rows without an id are dealt by their text. A ring of shards has no first one, so ties between
shards are broken by the link's turn, ties between vertices by hash. An empty table gives no
row. Only sums by shard and by level of gain reach the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.shared import written

GRAINS = 256
LEVELS = 40
PARTS = 64


def _pick(at: Column, values: list[int]) -> Column:
    """The entry of a short list of numbers."""
    return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), at.cast("int") + 1)


def quotas(rows: int, shards: int) -> list[int]:
    """Rows of every shard: at most one apart."""
    return [rows // shards + (k < rows % shards) for k in range(shards)]


def drawn(vertices: DataFrame, members: DataFrame, shards: int) -> DataFrame:
    """(v, n, shard, turn, votes): for every vertex its linked rows by shard, without its own.

    ``vertices`` are (v, n, shard), ``members`` (v, link). Counts by link and shard are
    combined before the shuffle; a link gives at most one row a shard.
    """
    placed = members.join(vertices, "v")
    held = [F.sum(F.when(F.col("shard") == k, F.col("n")).otherwise(0)).alias(f"in{k}") for k in range(shards)]
    met = placed.join(placed.groupBy("link").agg(*held), "link")
    own = [F.sum(F.col(f"in{k}") - F.when(F.col("shard") == k, F.col("n")).otherwise(0)).alias(f"to{k}") for k in range(shards)]
    turn = F.pmod(F.xxhash64(F.min("link")), F.lit(shards)).cast("int").alias("turn")
    votes = F.array(*[f"to{k}" for k in range(shards)]).alias("votes")
    return met.groupBy("v", "n", "shard").agg(turn, *own).select("v", "n", "shard", "turn", votes)


def wishes(met: DataFrame, room: list[int], upwards: bool) -> DataFrame:
    """(v, n, shard, wish, gain): vertices that gain by going to a shard with room for them."""
    shards = len(room)
    ring = lambda shard: F.pmod(shard + F.col("turn"), F.lit(shards))
    places = F.array(*[F.struct(F.lit(k).alias("wish"), F.lit(r).cast("long").alias("room")) for k, r in enumerate(room)])
    fits = F.filter(places, lambda p: (p["room"] >= F.col("n")) & (p["wish"] != F.col("shard")))
    ranked = F.transform(fits, lambda p: F.struct(F.element_at("votes", p["wish"] + 1).alias("votes"), (-ring(p["wish"])).alias("at"), p["wish"].alias("wish")))
    best = met.withColumn("best", F.array_max(ranked)).where("best IS NOT NULL")
    best = best.select("v", "n", "shard", "turn", "best.wish", (F.col("best.votes") - F.element_at("votes", F.col("shard") + 1)).alias("gain"))
    there, here = ring(F.col("wish")), ring(F.col("shard"))
    return best.where((F.col("gain") > 0) & ((there > here) if upwards else (there < here))).drop("turn")


def admitted(wanted: DataFrame, room: list[int], seed: int) -> DataFrame:
    """(v, wish) of the vertices let in: by falling gain while the shard's room lasts.

    Gains are cut into levels by powers of two and each level into parts by hash, so only
    sums of fixed number are put in order, not vertices.
    """
    level = F.lit(LEVELS) - F.least(F.lit(LEVELS), F.floor(F.log2("gain")).cast("int"))
    part = F.pmod(F.xxhash64(F.lit(seed), "v"), F.lit(PARTS)).cast("int")
    leveled = wanted.withColumn("level", level * PARTS + part)
    sums = leveled.groupBy("wish", "level").agg(F.sum("n").alias("n"))
    before = F.sum("n").over(Window.partitionBy("wish").orderBy("level"))
    last = (
        sums.withColumn("before", before)
        .where(F.col("before") <= _pick(F.col("wish"), room))
        .groupBy("wish").agg(F.max("level").alias("last"))
    ).collect()
    open_to = {r["wish"]: r["last"] for r in last}
    return leveled.where(F.col("level") <= _pick(F.col("wish"), [open_to.get(k, -1) for k in range(len(room))])).select("v", "wish")


def propagate(vertices: DataFrame, members: DataFrame, capacity: list[int], rounds: int = 24) -> DataFrame:
    """The vertices (v, n, shard) after propagation; no shard takes rows beyond its capacity.

    A vertex may have several links. One without any stays where it is.
    """
    shards, still = len(capacity), 0
    now = written(vertices.select("v", "n", "shard"), "labels")
    members = written(members.select("v", "link").distinct(), "members")
    for k in range(rounds):
        load = {r["shard"]: r["n"] for r in now.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
        room = [max(0, c - load.get(s, 0)) for s, c in enumerate(capacity)]
        wanted = written(wishes(drawn(now, members, shards), room, upwards=bool(k % 2)), "wishes")
        moved = admitted(wanted, room, k)
        still = 0 if not moved.isEmpty() else still + 1
        if still == 2:
            break
        if not still:
            left = now.join(moved, "v", "left")
            now = written(left.select("v", "n", F.coalesce("wish", "shard").alias("shard")), "labels")
    return now


def cut_links(placed: DataFrame) -> DataFrame:
    """(pairs, cut): pairs of rows that share a link, and those of them in different shards.

    ``placed`` has (link, shard) for every row; counted from sums, without pairs.
    """
    pairs = lambda n: n.cast("decimal(19,0)") * (n - 1) / 2
    cells = placed.where("link IS NOT NULL").groupBy("link", "shard").agg(F.count("*").alias("n"))
    links = cells.groupBy("link").agg(pairs(F.sum("n")).alias("pairs"), F.sum(pairs(F.col("n"))).alias("kept"))
    total = F.coalesce(F.sum("pairs"), F.lit(0)).cast("long")
    return links.agg(total.alias("pairs"), (total - F.coalesce(F.sum("kept"), F.lit(0)).cast("long")).alias("cut"))


def _numbered(rows: DataFrame, total: int, block: int) -> DataFrame:
    """Adds ``place``: gapless from 0 in every shard, linked rows first and link by link.

    Rows are numbered within (shard, kind, range of the link's hash, part of a large link);
    such a block holds about ``block`` rows, and blocks are put in order by their counts.
    """
    bits = max(0, math.ceil(math.log2(max(1, total / block))))
    code = F.shiftrightunsigned(F.col("order"), 64 - bits) if bits else F.lit(0).cast("long")
    parts = F.least(F.lit(GRAINS), F.ceil(F.col("link_rows") / F.lit(float(block)))).cast("int")
    part = F.when(parts > 1, F.pmod(F.col("grain"), parts)).otherwise(0)
    blocked = rows.withColumns({"loose": F.col("link_rows").isNull(), "code": code, "part": F.coalesce(part, F.lit(0))})
    keys = ["shard", "loose", "code", "part"]
    # A large link is numbered by itself within its range.
    large = F.when(parts > 1, F.col("order"))
    blocked = blocked.withColumn("large", F.coalesce(large, F.lit(0).cast("long")))
    keys.insert(3, "large")
    counts = blocked.groupBy(*keys).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy(*keys[1:]).rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(*keys, F.coalesce(before, F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy(*keys).orderBy("order", "link", "id", "size")) - 1
    numbered = blocked.withColumn("within", within).join(starts, keys)
    return numbered.withColumn("place", F.col("start") + F.col("within")).drop("loose", "code", "large", "part", "start", "within")


def evened(rows: DataFrame, shards: int, block: int) -> DataFrame:
    """Adds ``slot`` and corrects ``shard``: what is above a shard's quota fills the open places of others."""
    load = {r["shard"]: r["n"] for r in rows.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    total = sum(load.values())
    quota, held = quotas(total, shards), [load.get(s, 0) for s in range(shards)]
    over = [max(0, h - q) for h, q in zip(held, quota, strict=True)]
    free = [max(0, q - h) for h, q in zip(held, quota, strict=True)]
    placed = _numbered(rows, total, block)
    above = F.col("place") - _pick(F.col("shard"), quota)
    # The surplus rows of all shards in one line, and the open places in another.
    line = above + _pick(F.col("shard"), [sum(over[:s]) for s in range(shards)])
    goes, slot, first = F.lit(None).cast("int"), F.lit(None).cast("long"), 0
    for s, n in enumerate(free):
        if n:
            here = (line >= first) & (line < first + n)
            goes, slot = F.when(here, s).otherwise(goes), F.when(here, line - first + held[s]).otherwise(slot)
            first += n
    moves = above >= 0
    return placed.withColumns(
        {
            "shard": F.when(moves, goes).otherwise(F.col("shard")).cast("int"),
            "slot": F.when(moves, slot).otherwise(F.col("place")).cast("long"),
        }
    ).drop("place")


def shard_documents(
    docs: DataFrame,
    shards: int = 16,
    rounds: int = 24,
    block: int = 1 << 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """(id, the columns to ``carry``, size, text_crc32, link_rows, law, shard, slot, grown_shard) of every document.

    ``size`` is the text's UTF-8 bytes plus one, ``link_rows`` the number of equal texts (null for
    one alone). The law is ``rows``; ``grown_shard`` is null, as only a law by keys could tell it.
    Carried columns travel through the shuffles of the last step; all else are narrow rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    kept = F.struct(F.col(id_col).alias("id"), *[F.col(f"`{name}`") for name in carry])
    marked = docs.select(
        kept.alias("row"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
        F.when(F.col(text_col).isNotNull(), F.unhex(F.md5(F.encode(text, "utf-8")))).alias("link"),
    )
    draw = F.xxhash64("row.id", F.coalesce("link", F.lit(b"")))
    marked = marked.withColumns({"id": F.col("row.id"), "grain": F.pmod(draw, F.lit(GRAINS)).cast("int"), "draw": draw})
    # Rows without a link have keys of their own, so null texts don't meet in one task.
    marked = marked.withColumn("key", F.coalesce("link", F.unhex(F.lpad(F.hex("draw"), 16, "0"))))
    marked = written(marked, "marked", merged=False)

    cells = marked.where("link IS NOT NULL").groupBy("link", "grain").agg(F.count("*").alias("n"))
    cells = written(cells, "cells")
    linked = cells.groupBy("link").agg(F.sum("n").alias("link_rows")).where("link_rows > 1")
    v = F.concat("link", F.unhex(F.lpad(F.hex("grain"), 4, "0")))
    start = F.pmod(F.xxhash64(F.lit(1), v), F.lit(shards)).cast("int")
    vertices = written(cells.join(linked, "link").select(v.alias("v"), "link", "grain", "n", "link_rows", start.alias("shard")), "vertices")
    placed = propagate(vertices, vertices.select("v", "link"), quotas(marked.count(), shards), rounds)

    found = vertices.drop("shard", "n").join(placed, "v").select(F.col("link").alias("key"), "grain", "link_rows", "shard")
    rows = marked.join(found, ["key", "grain"], "left")
    rows = rows.withColumns(
        {
            "shard": F.coalesce("shard", F.pmod(F.xxhash64(F.lit(2), "draw"), F.lit(shards)).cast("int")),
            "order": F.when(F.col("link_rows").isNotNull(), F.xxhash64("link")).otherwise(F.col("draw")),
        }
    )
    done = evened(written(rows, "placed", merged=False), shards, block)
    return done.select(
        F.col("row.id").alias(id_col),
        *[F.col(f"row.`{name}`").alias(name) for name in carry],
        "size", "text_crc32", "link_rows",
        F.lit("rows").alias("law"),
        "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

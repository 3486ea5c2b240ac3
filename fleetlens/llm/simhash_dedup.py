"""Near-duplicates by SimHash: one-wildcard segment variants, equality join, verification.

Fingerprints that differ in at most ``distance`` bits are linked. Cut into
``distance // 2 + 1`` segments, at least one segment of such a pair differs in at most
one bit. Every fingerprint is indexed under each of its segments with each bit deleted
in turn (64 variants in all), so a pair meets under the variant that deletes its one
differing bit. Pairs that meet are verified on the whole fingerprints, and each is
reported by one variant only.

Equal fingerprints are one node, so copies are never paired. Null and empty texts have
the fingerprint zero and are linked like any other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate, islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.shared import components, written

BITS = 64
BLOCK = 1 << 16


def fingerprint(text: str | None, width: int = 4, seed: int = 42) -> int:
    """Majority bits of the XXH64 of all word shingles, as an unsigned number."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined, ends = b" ".join(words), list(accumulate(len(w) + 1 for w in words))
    spans = zip([0, *ends], ends[min(width, len(words)) - 1 :], strict=False)
    total, counts = 0, np.zeros(BITS, np.int64)
    while block := [xxhash.xxh64_intdigest(joined[a : b - 1], seed) for a, b in islice(spans, BLOCK)]:
        bits = np.unpackbits(np.array(block, ">u8").view(np.uint8)).reshape(-1, BITS)
        counts += bits.sum(axis=0, dtype=np.int64)
        total += len(block)
    return int.from_bytes(np.packbits(2 * counts > total).tobytes(), "big")


def fingerprint_column(text: Column, width: int = 4, seed: int = 42) -> Column:
    @F.pandas_udf("long")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = np.array([fingerprint(t, width, seed) for t in batch], np.uint64)
            yield pd.Series(found.view(np.int64))

    return prints(text)


def segments(distance: int, bits: int = BITS) -> list[tuple[int, int]]:
    """(first bit, length) of the fewest segments of which one differs in at most one bit."""
    n = distance // 2 + 1
    cuts = [bits * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def variants(prints: DataFrame, distance: int) -> DataFrame:
    """(fp, bit, rest): each fingerprint's segments with one bit deleted."""
    index = [
        F.struct(
            F.lit(bit).alias("bit"),
            F.lit(_signed((((1 << n) - 1) << first) & ~(1 << bit))).alias("mask"),
        )
        for first, n in segments(distance)
        for bit in range(first, first + n)
    ]
    return prints.select("fp", F.inline(F.array(*index))).select(
        "fp", "bit", F.col("fp").bitwiseAND(F.col("mask")).alias("rest")
    )


def links(prints: DataFrame, distance: int = 4) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints at most ``distance`` bits apart, each once."""
    left = variants(prints, distance).withColumnRenamed("fp", "a")
    right = variants(prints, distance).withColumnRenamed("fp", "b")
    differing = F.col("a").bitwiseXOR(F.col("b"))
    bit = F.expr("shiftleft(1L, bit)")
    reported, earlier = F.lit(False), F.lit(True)
    for first, n in segments(distance):
        here = differing.bitwiseAND(F.lit(_signed(((1 << n) - 1) << first)))
        own = ((here == 0) & (F.col("bit") == first)) | (here == bit)
        reported |= F.col("bit").between(first, first + n - 1) & own & earlier
        earlier &= F.bit_count(here) >= 2
    return (
        left.join(right, ["bit", "rest"])
        .where((F.col("a") < F.col("b")) & (F.bit_count(differing) <= distance) & reported)
        .select("a", "b")
    )


def near_duplicates(
    docs: DataFrame, distance: int = 4, width: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc id, fp, component_id): the class of every row, named by its smallest id.

    Repeated rows give a row each. A class whose ids are all null has a null name.
    """
    prints = written(
        docs.select(F.col(id_col).alias("doc_id"), fingerprint_column(F.col(text_col), width, seed).alias("fp")),
        "fingerprints",
        merged=False,
    )
    named = classes(prints, lambda nodes: components(links(nodes, distance)))
    return prints.join(named, "fp", "left").select(
        F.col("doc_id").alias(id_col), "fp", F.col("component_id")
    )


def classes(prints: DataFrame, hang: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(fp, first_id, first_rows, component_id) of every distinct fingerprint of (doc_id, fp).

    ``hang`` gives the components of the fingerprints, as ``shared.components`` does.
    ``first_rows`` counts the rows that carry the fingerprint's smallest id.
    """
    ids = prints.groupBy("fp", "doc_id").agg(F.count("*").alias("n"))
    nodes = written(
        ids.groupBy("fp").agg(
            F.min("doc_id").alias("first_id"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "n"))["n"].alias("first_rows")
        ),
        "nodes",
    )
    hung = hang(nodes.select("fp"))
    rooted = nodes.join(hung.select(F.col("a").alias("fp"), F.col("b").alias("root")), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    lowest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(lowest, "root").select("fp", "first_id", "first_rows", "component_id")


def one_of_each(docs: DataFrame, distance: int = 4, width: int = 4, seed: int = 42) -> DataFrame:
    """The documents without near copies: of each class the row with the smallest doc_id stays.

    Of repeated rows one stays; of a class without ids too. Rows with nulls elsewhere
    are ordinary rows.
    """
    marked = written(docs.withColumn("__fp", fingerprint_column(F.col("text"), width, seed)), "marked", merged=False)
    kept = rows_of_classes(marked, lambda nodes: components(links(nodes, distance)))
    return kept.select(*[F.col(f"`{name}`") for name in docs.columns])


def rows_of_classes(marked: DataFrame, hang: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """One row of each class of a written table with ``__fp``: that with the smallest doc_id."""
    prints = marked.select("doc_id", F.col("__fp").alias("fp"))
    chosen = written(
        classes(prints, hang)
        .groupBy("component_id")
        .agg(F.min_by(F.struct("fp", "first_rows"), F.struct(~F.col("first_id").eqNullSafe(F.col("component_id")), "fp")).alias("c"))
        .select(F.col("c.fp").alias("__chosen"), F.col("component_id").alias("__id"), F.col("c.first_rows").alias("__rows")),
        "chosen",
    )
    # Joined on the id as well: the copies of one text share a fingerprint, but no id.
    same = (marked["__fp"] == chosen["__chosen"]) & marked["doc_id"].eqNullSafe(chosen["__id"])
    kept = marked.join(chosen, same)
    if not chosen.where("__rows > 1").isEmpty():
        kept = kept.where("__rows = 1").unionByName(kept.where("__rows > 1").dropDuplicates(["__fp"]))
    return kept

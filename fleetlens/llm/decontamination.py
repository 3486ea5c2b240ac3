"""Benchmark decontamination: size-partitioned MinHash containment search, exactly verified.

Texts are lower-cased and cut into words of letters and digits; the distinct shingles of
``width`` words are the sets. A test item is contained when at least ``share`` of its
shingles are in a document, however long that is.

An item's sketch is the smallest hashes of its shingles (bottom-k MinHash). Items are
partitioned by size into classes (2^(c-1), 2^c]; class c keeps
k = floor((1 - share) * 2^c) + 1 hashes. An item of n shingles may lack
floor((1 - share) * n) of them, which is less than k, so every document that contains it
holds at least k minus that many of its sketch: a pair with so many hits is a candidate,
and none is missed. Candidates are then compared on the shingles themselves.

The shingles of documents meet the sketches in an equality join and go no further
unless they hit. Copies of a text are one key in the search. An item of n < ``width``
words is one shingle of all its words, looked up in the documents' windows of n words
(only for lengths that occur). Null and empty texts neither contain nor are contained. Repeated rows give equal results, a row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.shared import small, written

BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_array(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), BREAKS), "")


def _windows(words: Column, width: int, make) -> Column:
    """``make`` of every window of ``width`` words, or of all words if there are fewer."""
    full = F.transform(
        F.sequence(F.lit(0), F.size(words) - width), lambda i: make([F.get(words, i + k) for k in range(width)])
    )
    return (
        F.when(F.size(words) >= width, full)
        .when(F.size(words) > 0, F.array(make([F.array_join(words, " ")])))
        .otherwise(F.array().cast("array<string>") if make is _text else F.array().cast("array<bigint>"))
    )


def _all_windows(words: Column, width: int, short: list[int], make) -> Column:
    """``_windows``, and those of every length in ``short``, made as whole items of that length are."""

    def whole(parts: list[Column]) -> Column:
        return make([F.concat_ws(" ", *parts)])

    def of(n: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: whole([F.get(words, i + k) for k in range(n)]))

    empty = F.array().cast("array<string>" if make is _text else "array<bigint>")
    return F.concat(_windows(words, width, make), *[F.when(F.size(words) >= n, of(n)).otherwise(empty) for n in short])


def _text(parts: list[Column]) -> Column:
    return F.concat_ws(" ", *parts)


def _hash(parts: list[Column]) -> Column:
    return F.xxhash64(*parts)


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def item_sketches(items: DataFrame, width: int, share: float) -> DataFrame:
    """(item_id, h, need): the sketch of every item, and how many hits make a candidate."""
    missing = (F.lit(1 - share) * F.col("n") + 1e-9).cast("long")
    size_class = F.ceil(F.log2("n"))
    k = (F.lit(1 - share) * F.pow(F.lit(2.0), size_class) + 1e-9).cast("int") + 1
    hashed = items.select("item_id", F.array_sort(F.array_distinct(_windows(F.col("words"), width, _hash))).alias("hashes"))
    sized = hashed.withColumn("n", F.size("hashes")).where("n > 0")
    kept = sized.withColumn("sketch", F.slice("hashes", 1, F.least(k, F.col("n"))))
    return kept.select(
        "item_id", F.greatest(F.lit(1), F.size("sketch") - missing).alias("need"), F.explode("sketch").alias("h")
    )


def contained_items(
    docs: DataFrame, items: DataFrame, share: float = 0.8, width: int = 5, max_broadcast: int = 200_000
) -> DataFrame:
    """(key, item_id, n_item, n_shared, containment) of every text that contains an item.

    ``key`` is the MD5 of the text. ``items`` has item_id and text; items with equal ids
    and different texts count apart, each by its own shingles.
    """
    known = written(
        items.select("item_id", word_array(F.col("text")).alias("words"))
        .where(F.size("words") > 0)
        .distinct()
        .withColumn("item_id", F.struct("item_id", F.xxhash64("words").alias("t"))),
        "items",
    )
    lengths = known.select(F.size("words").alias("n")).where(F.col("n") < width).distinct()
    short = sorted(row["n"] for row in lengths.collect())  # fewer than ``width`` numbers
    sketches = written(item_sketches(known, width, share), "sketches")
    texts = docs.select("text").where(F.length("text") > 0)
    hits = (
        texts.select(text_key(F.col("text")).alias("key"), word_array(F.col("text")).alias("words"))
        .select("key", F.explode(_all_windows(F.col("words"), width, short, _hash)).alias("h"))
        .join(sketches, "h")
    )
    candidates = written(
        hits.select("key", "item_id", "need", "h")
        .distinct()
        .groupBy("key", "item_id", "need")
        .agg(F.count("*").alias("hits"))
        .where("hits >= need")
        .select("key", "item_id"),
        "candidates",
    )
    found = texts.withColumn("key", text_key(F.col("text"))).join(small(candidates, max_broadcast), "key")
    words = F.array_distinct(_windows(F.col("words"), width, _text))
    wanted = known.select("item_id", words.alias("wanted"))
    compared = (
        found.select("key", "item_id", word_array(F.col("text")).alias("words"))
        .join(wanted, "item_id")
        .select(
            "key", F.col("item_id.item_id").alias("item_id"), F.size("wanted").alias("n_item"),
            F.size(F.array_intersect("wanted", _all_windows(F.col("words"), width, short, _text))).alias("n_shared"),
        )
        .withColumn("containment", F.col("n_shared") / F.col("n_item"))
    )
    return compared.where(F.col("n_shared") + 1e-9 >= F.col("n_item") * share).distinct()


def leaks(docs: DataFrame, items: DataFrame, share: float = 0.8, width: int = 5, max_broadcast: int = 200_000) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment): which documents contain which items."""
    found = written(contained_items(docs, items, share, width, max_broadcast), "leaks")
    return (
        docs.select("doc_id", text_key(F.col("text")).alias("key"))
        .join(small(found, max_broadcast), "key")
        .select("doc_id", "item_id", F.col("n_item").cast("long"), F.col("n_shared").cast("long"), "containment")
    )


def clean_documents(docs: DataFrame, items: DataFrame, share: float = 0.8, width: int = 5, max_broadcast: int = 200_000) -> DataFrame:
    """The documents that contain no test item; null texts stay."""
    found = written(contained_items(docs, items, share, width, max_broadcast).select(F.col("key").alias("__key")).distinct(), "leaks")
    return docs.join(small(found, max_broadcast), text_key(docs["text"]) == F.col("__key"), "left_anti")

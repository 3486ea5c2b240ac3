"""Quality rules: base rules, then a log-likelihood ratio of hashed n-grams.

Byte n-grams of every text are hashed into ``buckets``. Their frequencies in a trusted
target and in the whole raw corpus are two multinomials (with ``prior`` added to every
bucket); a document's score is the mean over its n-grams of log(target / raw). A
document passes when it meets the base rules and its score is at least ``threshold``:
the same cut for all, without drawing.

A null or empty text has no word and fails the base rules, with score 0. Without a
trusted text the score is 0. Rows are judged one by one: copies get equal results. A score equal
to the threshold passes. Texts are read whole, however long. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\r\x0b\x0c"
BUCKETS = 1 << 16
CHUNK = 1 << 20

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeated_words(words: list) -> int:
    """Words that stand in a three-word window found more than once."""
    n = len(words)
    if n < 4:
        return 0
    seen: dict = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    pairs = np.unique(ids[:-1] * len(seen) + ids[1:], return_inverse=True)[1]
    triples, counts = np.unique(pairs[:-1] * len(seen) + ids[2:], return_inverse=True, return_counts=True)[1:]
    again = counts[triples] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= again
    return int(covered.sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    words = text.encode("utf-8", "replace").split()
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def ngram_blocks(text: str | None, n: int, buckets: int) -> Iterator[np.ndarray]:
    """Hashed byte n-grams of a text, in blocks of bounded size."""
    data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    for start in range(0, max(0, len(data) - n + 1), CHUNK):
        piece = data[start : start + CHUNK + n - 1].astype(np.uint32)
        codes = np.zeros(len(piece) - n + 1, np.uint32)
        for k in range(n):
            codes = (codes * np.uint32(0x01000193)) ^ piece[k : k + len(codes)]
        yield ((codes * np.uint32(0x9E3779B1)) >> np.uint32(16)) % np.uint32(buckets)


def ngram_counts(texts: DataFrame, n: int, buckets: int) -> np.ndarray:
    """How often each bucket occurs in all texts of column ``text``.

    Counts are summed in the tasks and then by bucket; the driver gets ``buckets`` rows.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for frame in frames:
            for text in frame["text"]:
                for block in ngram_blocks(text, n, buckets):
                    total += np.bincount(block, minlength=buckets)
        found = total.nonzero()[0]
        yield pd.DataFrame({"bucket": found, "n": total[found]})

    rows = texts.select("text").mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in rows.collect():
        out[row["bucket"]] = row["n"]
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray, prior: float = 0.5) -> np.ndarray:
    """Log of the two multinomials' ratio by bucket; zero without a target."""
    if not target.any():
        return np.zeros(len(raw), "f4")
    p, q = target + prior, raw + prior
    return (np.log(p / p.sum()) - np.log(q / q.sum())).astype("f4")


def trusted_texts(docs: DataFrame, labels: DataFrame, max_broadcast: int = 500_000) -> DataFrame:
    """Texts of the documents labelled good; few labels are broadcast, many are shuffled."""
    good = labels.where((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)).select("doc_id").distinct()
    good = F.broadcast(good) if good.count() <= max_broadcast else good
    return docs.select("doc_id", "text").join(good, "doc_id", "left_semi")


def judge(
    docs: DataFrame,
    ratio: np.ndarray,
    n: int = 4,
    threshold: float = -0.5,
    min_words: int = 50,
    max_repeat_percent: int = 50,
) -> DataFrame:
    """doc_id with base counts, ``base_failed``, ``score`` and ``kept``."""
    buckets = len(ratio)

    @F.pandas_udf(BASE + ", score double")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = []
            for text in texts:
                total, count = 0.0, 0
                for block in ngram_blocks(text, n, buckets):
                    total += float(ratio.take(block).sum(dtype="f8"))
                    count += len(block)
                out.append((*base_counts(text), total / count if count else 0.0))
            yield pd.DataFrame(out, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score"])

    rows = docs.select("doc_id", measure("text").alias("m")).select("doc_id", "m.*")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= threshold))

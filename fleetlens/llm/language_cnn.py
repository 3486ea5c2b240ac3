"""Language identification by a byte convolutional network trained in numpy.

A text, lower-cased, is cut into windows of ``length`` bytes; all of them are read.
Filters of several widths slide over the bytes of a window, their largest answers feed a
softmax over the languages, and the log-probabilities of all windows are averaged.

The network is fitted on a bounded sample: of each language at most ``per_language``
labelled texts (those with the smallest hashes), and of each of them at most
``per_text`` evenly spaced windows. Its size does not grow with the corpus.

A null text, an empty one, or one without a letter is ``und`` with score 0. Without any
labelled text every document is ``und``. Repeated rows and copies have equal results, and count
once in the sample under one label. Of equally likely languages the first by name is given. Texts
are read whole, window by window. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.shared import small, written

UNKNOWN = "und"
BLOCK = 512


def window_matrix(text: str, length: int) -> np.ndarray:
    """All windows of a text, the last one filled up with zeros."""
    data = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    count = max(1, -(-len(data) // length))
    out = np.zeros(count * length, np.uint8)
    out[: len(data)] = data
    return out.reshape(count, length)


@dataclass
class ByteCnn:
    """Widths 2, 3 and 4 over byte embeddings, max pooling, softmax."""

    languages: list[str]
    length: int = 128
    size: int = 8
    filters: int = 8
    widths: tuple[int, ...] = (2, 3, 4)
    seed: int = 7
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.weights:
            return
        draw = np.random.default_rng(self.seed)
        self.weights["bytes"] = draw.normal(0, 0.5, (256, self.size)).astype("f4")
        for w in self.widths:
            self.weights[f"filter{w}"] = draw.normal(0, 1 / np.sqrt(w * self.size), (w, self.size, self.filters)).astype("f4")
            self.weights[f"bias{w}"] = np.zeros(self.filters, "f4")
        n = self.filters * len(self.widths)
        self.weights["out"] = draw.normal(0, 1 / np.sqrt(n), (n, len(self.languages))).astype("f4")
        self.weights["offset"] = np.zeros(len(self.languages), "f4")

    def _answers(self, x: np.ndarray, w: int) -> np.ndarray:
        n = x.shape[1] - w + 1
        return sum(x[:, k : k + n] @ self.weights[f"filter{w}"][k] for k in range(w))

    def fit(self, windows: np.ndarray, labels: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.01) -> ByteCnn:
        """Adam on the cross-entropy; the order is fixed by the seed."""
        draw, g = np.random.default_rng(self.seed), self.weights
        mean = {k: np.zeros_like(v) for k, v in g.items()}
        square = {k: np.zeros_like(v) for k, v in g.items()}
        step = 0
        for _ in range(epochs):
            order = draw.permutation(len(windows))
            for rows in np.array_split(order, max(1, len(order) // batch)):
                step += 1
                for name, slope in self._slopes(windows[rows], labels[rows]).items():
                    mean[name] = 0.9 * mean[name] + 0.1 * slope
                    square[name] = 0.999 * square[name] + 0.001 * slope**2
                    scaled = mean[name] / (1 - 0.9**step) / (np.sqrt(square[name] / (1 - 0.999**step)) + 1e-8)
                    g[name] = (g[name] - rate * scaled).astype("f4")
        return self

    def _slopes(self, windows: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        g, x, out = self.weights, self.weights["bytes"][windows], {}
        at, best = {}, []
        for w in self.widths:
            answers = self._answers(x, w)
            at[w] = answers.argmax(axis=1)
            best.append(np.take_along_axis(answers, at[w][:, None], 1)[:, 0] + g[f"bias{w}"])
        hidden = np.maximum(np.concatenate(best, 1), 0)
        logits = hidden @ g["out"] + g["offset"]
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(labels)), labels] -= 1
        p /= len(labels)
        out["out"], out["offset"] = hidden.T @ p, p.sum(0)
        back = (p @ g["out"].T) * (hidden > 0)
        by_byte = np.zeros_like(g["bytes"])
        rows = np.arange(len(labels))[:, None]
        for i, w in enumerate(self.widths):
            part = back[:, i * self.filters : (i + 1) * self.filters]
            out[f"bias{w}"] = part.sum(0)
            slope = np.empty_like(g[f"filter{w}"])
            for k in range(w):
                seen = x[rows, at[w] + k]
                slope[k] = np.einsum("bfd,bf->df", seen, part)
                np.add.at(by_byte, windows[rows, at[w] + k], part[:, :, None] * g[f"filter{w}"][k].T[None])
            out[f"filter{w}"] = slope
        out["bytes"] = by_byte
        return out

    def scorer(self) -> PairScorer:
        return PairScorer(self)


class PairScorer:
    """The trained network with its filters tabulated over pairs of bytes."""

    def __init__(self, net: ByteCnn) -> None:
        self.net, self.plan = net, []
        for w in net.widths:
            single = [net.weights["bytes"] @ net.weights[f"filter{w}"][k] for k in range(w)]
            parts = [
                (k, True, (single[k][:, None] + single[k + 1][None]).reshape(65536, -1)) for k in range(0, w - 1, 2)
            ]
            if w % 2:
                parts.append((w - 1, False, single[w - 1]))
            self.plan.append((w, parts, net.weights[f"bias{w}"]))

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        pairs = (windows[:, :-1].astype(np.uint16) << 8) | windows[:, 1:]
        pooled = []
        for w, parts, bias in self.plan:
            n = windows.shape[1] - w + 1
            answers = None
            for k, paired, values in parts:
                found = values.take((pairs if paired else windows)[:, k : k + n], axis=0)
                answers = found if answers is None else np.add(answers, found, out=answers)
            pooled.append(answers.max(axis=1) + bias)
        logits = np.maximum(np.concatenate(pooled, 1), 0) @ self.net.weights["out"] + self.net.weights["offset"]
        logits -= logits.max(1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(1, keepdims=True))

    def predict(self, text: str) -> tuple[str, float]:
        """The language of a whole text, and the share it has in the mean of all windows."""
        windows = window_matrix(text, self.net.length)
        total = sum(
            self.log_probabilities(windows[i : i + BLOCK]).sum(0, dtype="f8") for i in range(0, len(windows), BLOCK)
        )
        total = total / len(windows)
        p = np.exp(total - total.max())
        best = int(p.argmax())
        return self.net.languages[best], float(p[best] / p.sum())


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def held_out(doc_id: Column) -> Column:
    """Whether the CRC-32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def smallest_hashes(hashes: DataFrame, k: int, bits: int = 10) -> DataFrame:
    """(lang, cut): the k-th smallest of the distinct hashes ``h`` of every language, or its largest.

    Hashes are counted by their leading bits, twice as many the second time; only the ranges up to
    that with the k-th are kept, and only their hashes put in order. So no task holds a language:
    of each it sees 2^bits counts, then at most k more than that, then k and one range's hashes.
    """
    by_lang = Window.partitionBy("lang")
    for leading in (bits, 2 * bits):
        ranged = hashes.withColumn("range", F.shiftright("h", 64 - leading))
        counts = ranged.groupBy("lang", "range").agg(F.count("*").alias("n"))
        before = F.sum("n").over(by_lang.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
        ranges = counts.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < k)
        hashes = ranged.join(ranges, ["lang", "range"], "left_semi").select("lang", "h")
    rank = F.row_number().over(by_lang.orderBy("h"))
    return hashes.withColumn("k", rank).where(F.col("k") <= k).groupBy("lang").agg(F.max("h").alias("cut"))


def train(labelled: DataFrame, per_language: int = 400, per_text: int = 6, length: int = 128, epochs: int = 6) -> ByteCnn | None:
    """Fits the network to (text, lang); None if no row has both a letter and a label."""

    @F.pandas_udf("array<binary>")
    def spread(texts: pd.Series) -> pd.Series:
        def pick(text: str) -> list[bytes]:
            windows = window_matrix(text, length)
            return [windows[i].tobytes() for i in sorted({len(windows) * k // per_text for k in range(per_text)})]

        return texts.map(pick)

    rows = labelled.where(F.col("lang").isNotNull() & has_letter(F.col("text"))).select("lang", "text", F.xxhash64("text").alias("h"))
    cuts = smallest_hashes(rows.select("lang", "h").distinct(), per_language)
    cuts = small(written(cuts, "cuts"), 10_000)  # a row per language
    chosen = rows.join(cuts, "lang").where(F.col("h") <= F.col("cut"))
    sample = chosen.select("lang", "h", spread("text").alias("windows")).groupBy("lang", "h").agg(F.min("windows").alias("windows")).collect()
    if not sample:
        return None
    sample.sort(key=lambda r: (r["lang"], r["h"]))
    languages = sorted({r["lang"] for r in sample})
    data = np.frombuffer(b"".join(w for r in sample for w in r["windows"]), np.uint8).reshape(-1, length)
    labels = np.array([languages.index(r["lang"]) for r in sample for _ in r["windows"]])
    return ByteCnn(languages, length).fit(data, labels, epochs)


def identify(docs: DataFrame, net: ByteCnn | None, text_col: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score`` (0 to 1), judged from the whole text alone."""
    if net is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    trained = net

    @F.pandas_udf("lang_pred string, score double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = trained.scorer()
        for texts in batches:
            found = [(UNKNOWN, 0.0) if t is None else scorer.predict(t) for t in texts]
            yield pd.DataFrame(found, columns=["lang_pred", "score"])

    judged = docs.withColumn("__judged", judge(F.when(has_letter(F.col(text_col)), F.col(text_col))))
    return judged.withColumns({"lang_pred": F.col("__judged.lang_pred"), "score": F.col("__judged.score")}).drop("__judged")


def accepted(docs: DataFrame, net: ByteCnn | None, languages: list[str] | None = None) -> DataFrame:
    """The documents in a known language (or one of ``languages``), with their own columns."""
    names = docs.columns
    marked = identify(docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("__row"), F.col("text").alias("__text")), net, "__text")
    kept = marked.where(F.col("lang_pred").isin(languages) if languages else F.col("lang_pred") != UNKNOWN)
    return kept.select("__row.*")

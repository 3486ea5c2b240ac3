"""Masked pseudo-likelihood of documents by a bidirectional window network in numpy.

Every word of the corpus is counted by itself: the counts are a Spark table of 64-bit word
hashes that grows with the corpus. Words have classes built from frequency: the most
frequent ones each their own, the rest in order of frequency in classes of about equal
mass. A network sees the classes of the ``reach`` words on either side of a word (a border
class beyond the text) and predicts the word's class; within a class, a word has its share
of the class's count in the corpus. A document's score is the sum of log P(word | both
sides) over all its words.

Every distinct text is cut into words once and kept as one class per word (a byte or two a
token), with how often it occurs. Tasks hold the ``buckets`` most frequent words. All others are
in the last class; their counts are joined to the words of each text, so no word takes over
another's count.

The counts and the network cover all documents. The network is trained by rounds of
parameter averaging: distinct texts are dealt by a hash of the text into shards of about
``shard_tokens`` tokens, each shard's texts are put in the order of that hash, a network goes
through them in small steps from the common start, and the results are averaged with the tokens
as weights. A text weighs as often as it occurs. Shards, their order, and the sums (whole numbers)
depend on the corpus alone, so scores do not depend on how its rows are split or ordered. Only
tables of fixed size (counts of the words that tasks hold, parameters) reach the driver.

A null text, or one without a word, has no token: log_prob 0, mean null. Repeated rows and copies
have equal scores. Words of equal count are ranked by their hash. Texts are never cut: a very long
one takes a byte or two a token in a task. An empty table gives no row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.decontamination import text_key
from fleetlens.llm.shared import written

FIXED = 1 << 20
BLOCK = 1 << 13
HELD = 1 << 17


@dataclass(frozen=True)
class Shape:
    """Sizes of what every task holds; the table of word counts follows the corpus."""

    buckets: int = 1 << 18
    classes: int = 96
    frequent: int = 64
    reach: int = 2
    hidden: int = 16

    @property
    def coding(self) -> str:
        """How a class is kept: a byte, or two."""
        return "u1" if self.classes <= 1 << 8 else "<u2"


def words_of(text: str | None) -> list[bytes]:
    """The words between blanks, A-Z lower-cased."""
    return (text or "").encode("utf-8", "replace").lower().split()


def word_hash(word: bytes) -> int:
    value = xxhash.xxh64_intdigest(word)
    return value - (1 << 64) if value >> 63 else value


def word_counts(texts: DataFrame) -> DataFrame:
    """(w, n): the hash of every word in the texts, and how often it is there."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[bytes] = Counter()

        def rows() -> pd.DataFrame:
            return pd.DataFrame({"w": [word_hash(w) for w in seen], "n": list(seen.values())}, dtype="int64")

        for frame in frames:
            for text in frame["text"]:
                seen.update(words_of(text))
                if len(seen) >= HELD:
                    yield rows()
                    seen.clear()
        yield rows()

    return texts.select("text").mapInPandas(count, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Vocabulary:
    """The most frequent words: hashes, classes, log P(word | class); and the tokens of the last class."""

    hashes: np.ndarray
    classes: np.ndarray
    within: np.ndarray
    last_total: int

    def index(self) -> dict[bytes, int]:
        """The place of a word; that after the last one for a word that isn't held."""
        places = {int(h): k for k, h in enumerate(self.hashes)}

        class Index(dict):
            def __missing__(self, word: bytes) -> int:
                place = places.get(word_hash(word), len(places))
                if len(self) < HELD and len(word) < 64:
                    self[word] = place
                return place

        return Index()


def vocabulary(counts: DataFrame, shape: Shape) -> Vocabulary:
    """Classes by frequency: ``frequent`` words of their own, then classes of equal mass."""
    held = counts.orderBy(F.desc("n"), "w").limit(shape.buckets).collect()
    total = counts.agg(F.sum("n")).first()[0] or 0
    hashes, n = np.array([r["w"] for r in held], np.int64), np.array([r["n"] for r in held], np.int64)
    rest, bins = n[shape.frequent :], shape.classes - shape.frequent
    mass = max(1, total - int(n[: shape.frequent].sum()))
    before = np.cumsum(rest) - rest
    classes = np.concatenate([np.arange(min(len(n), shape.frequent)), shape.frequent + before * bins // mass]).astype(np.int64)
    sums = np.bincount(classes, n, shape.classes) if len(n) else np.zeros(shape.classes)
    sums[-1] += total - n.sum()
    # A word that isn't held has its share from the join.
    within = np.append(np.log(n / sums[classes]) if len(n) else [], 0.0).astype("f4")
    return Vocabulary(hashes, np.append(classes, shape.classes - 1).astype(np.int16), within, int(sums[-1]))


CODED = "key binary, n_tokens long, classes binary, within double, rare array<long>, times array<long>"


def coded_texts(texts: DataFrame, words: Vocabulary, coding: str) -> DataFrame:
    """(key, n, n_tokens, classes, within, rare, times): every distinct text but null, cut into words once.

    ``n`` is how often it occurs, ``within`` the summed log P(word | class) of the words that
    tasks hold; ``rare`` are the hashes of the others, with how often the text has them.
    """
    unheld = len(words.hashes)

    def code(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = words.index()
        for frame in frames:
            out = []
            for key, text in zip(frame["key"], frame["text"], strict=True):
                found = words_of(text)
                places = np.fromiter(map(index.__getitem__, found), np.int64, len(found))
                rare = Counter(found[i] for i in np.flatnonzero(places == unheld))
                within = float(words.within[places].sum(dtype="f8"))
                classes = words.classes[places].astype(coding).tobytes()
                out.append((key, len(found), classes, within, [word_hash(w) for w in rare], list(rare.values())))
            yield pd.DataFrame(out, columns=["key", "n_tokens", "classes", "within", "rare", "times"])

    cut = texts.where("text IS NOT NULL").select(text_key(F.col("text")).alias("key"), "text").mapInPandas(code, CODED)
    same = [F.first(name).alias(name) for name in ("n_tokens", "classes", "within", "rare", "times")]
    return cut.groupBy("key").agg(F.count("*").alias("n"), *same)


def rare_shares(coded: DataFrame, counts: DataFrame, words: Vocabulary) -> DataFrame:
    """(key, log_rare): summed log P(word | last class) of the words of a text that tasks don't hold."""
    found = coded.select("key", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("key", F.col("r.rare").alias("w"), "r.times")
    share = F.col("times") * F.log(F.col("n") / F.lit(float(max(1, words.last_total))))
    return found.join(counts, "w").groupBy("key").agg(F.sum(share).alias("log_rare"))


class WindowNetwork:
    """tanh of summed class vectors of both sides, then a softmax over classes.

    Classes ``0 .. n-1`` are words, ``n`` is the border of a text.
    """

    def __init__(self, shape: Shape, parameters: np.ndarray | None = None, seed: int = 5) -> None:
        self.shape = shape
        c, h, p = shape.classes, shape.hidden, 2 * shape.reach
        self.sizes = [(p * (c + 1), h), (h,), (h, c), (c,)]
        if parameters is None:
            draw = np.random.default_rng(seed)
            first = [draw.normal(0, 0.3, self.sizes[0]), np.zeros(h), draw.normal(0, 0.3, self.sizes[2]), np.zeros(c)]
            parameters = np.concatenate([x.ravel() for x in first])
        cuts = np.cumsum([int(np.prod(s)) for s in self.sizes])[:-1]
        self.sides, self.bias, self.out, self.offset = (
            x.reshape(s).astype("f4") for x, s in zip(np.split(parameters, cuts), self.sizes, strict=True)
        )

    def parameters(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.sides, self.bias, self.out, self.offset)]).astype("f8")

    def contexts(self, classes: np.ndarray) -> np.ndarray:
        """Rows of ``sides`` around every word, the word itself left out."""
        r, c = self.shape.reach, self.shape.classes
        padded = np.full(len(classes) + 2 * r, c, np.int64)
        padded[r : r + len(classes)] = classes
        places = [k for k in range(2 * r + 1) if k != r]
        return np.stack([padded[k : k + len(classes)] + i * (c + 1) for i, k in enumerate(places)], 1)

    def _forward(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total = self.sides.take(context[:, 0], axis=0)
        for k in range(1, context.shape[1]):
            total += self.sides.take(context[:, k], axis=0)
        hidden = np.tanh(total + self.bias)
        logits = hidden @ self.out
        logits += self.offset
        if np.abs(self.out).sum(0).max() + np.abs(self.offset).max() > 80:  # else exp() can't overflow
            logits -= logits.max(1, keepdims=True)
        return hidden, logits

    def log_probabilities(self, classes: np.ndarray) -> Iterator[np.ndarray]:
        """log P(class | both sides) of every word, in blocks."""
        context = self.contexts(classes)
        for i in range(0, len(classes), BLOCK):
            logits = self._forward(context[i : i + BLOCK])[1]
            chosen = logits[np.arange(len(logits)), classes[i : i + BLOCK]]
            yield chosen - np.log(np.exp(logits).sum(1))

    def descend(self, context: np.ndarray, classes: np.ndarray, rate: float, weights: np.ndarray | None = None) -> None:
        """One step down the slope of a block's mean loss, summed by parameter row."""
        hidden, logits = self._forward(context)
        p = np.exp(logits)
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(classes)), classes] -= 1
        if weights is not None:
            p *= (weights / weights.mean()).astype("f4")[:, None]
        back = (p @ self.out.T) * (1 - hidden * hidden)
        scale = np.float32(rate / len(classes))
        self.out -= scale * (hidden.T @ p)
        self.offset -= scale * p.sum(0)
        self.bias -= scale * back.sum(0)
        width, flat = back.shape[1], back.ravel().astype("f8")
        for column in context.T:
            cells = (column[:, None] * width + np.arange(width)).ravel()
            slope = np.bincount(cells, flat, self.sides.size).reshape(self.sides.shape)
            self.sides -= (scale * slope).astype("f4")


def train(
    coded: DataFrame, shape: Shape, rounds: int = 2, rate: float = 4.0, batch: int = 1024, shard_tokens: int = 1 << 21
) -> WindowNetwork:
    """Averages the networks of all shards, weighted by tokens, ``rounds`` times."""
    start = WindowNetwork(shape).parameters()
    total = coded.agg(F.sum("n_tokens")).first()[0] or 0
    shards = max(1, -(-total // shard_tokens))
    dealt = coded.where("n_tokens > 0").select(F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"), "key", "n", "classes")
    def descend(shard: pd.DataFrame, given: np.ndarray, step: float) -> pd.DataFrame:
        net, tokens = WindowNetwork(shape, given), 0
        context, classes, weights, held = [], [], [], 0

        def move() -> None:
            nonlocal context, classes, weights, held
            size = min(1.0, held / batch)
            net.descend(np.concatenate(context), np.concatenate(classes), step * size, np.concatenate(weights))
            context, classes, weights, held = [], [], [], 0

        for n, packed in shard.sort_values("key")[["n", "classes"]].itertuples(index=False):
            text = np.frombuffer(packed, shape.coding).astype(np.int64)
            tokens += int(n) * len(text)
            for i in range(0, len(text), BLOCK):
                # Words beyond the block are part of its contexts.
                low, high = max(0, i - shape.reach), i + BLOCK + shape.reach
                piece = net.contexts(text[low:high])
                inner = slice(i - low, i - low + len(text[i : i + BLOCK]))
                context.append(piece[inner])
                classes.append(text[i : i + BLOCK])
                weights.append(np.full(len(text[i : i + BLOCK]), float(n)))
                held += len(text[i : i + BLOCK])
                if held >= batch:
                    move()
        if held:
            move()
        moved = np.rint((net.parameters() - given) * FIXED).astype(np.int64)
        return pd.DataFrame({"at": np.arange(-1, len(moved)), "v": np.concatenate([[1], moved]) * np.int64(tokens)})

    for k in range(rounds):
        given, step = start, rate / (1 + k)
        summed = (
            dealt.groupBy("shard")
            .applyInPandas(lambda shard: descend(shard, given, step), "at long, v long")
            .groupBy("at")
            .agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
            .collect()
        )
        if not summed:
            break
        by = {row["at"]: int(row["v"]) for row in summed}
        start = given + np.array([by[i] / by[-1] for i in range(len(given))]) / FIXED
    return WindowNetwork(shape, start)


def score_texts(coded: DataFrame, counts: DataFrame, words: Vocabulary, net: WindowNetwork, coding: str) -> DataFrame:
    """(key, n_tokens, log_prob) of every distinct text."""

    @F.pandas_udf("double")
    def known(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts = (np.frombuffer(packed, coding).astype(np.int64) for packed in batch)
            yield pd.Series([sum((float(x.sum(dtype="f8")) for x in net.log_probabilities(t)), 0.0) for t in texts], dtype="f8")

    scored = coded.select("key", "n_tokens", (known("classes") + F.col("within")).alias("log_known"))
    shares = rare_shares(coded, counts, words)
    log_prob = F.col("log_known") + F.coalesce("log_rare", F.lit(0.0))
    return scored.join(shares, "key", "left").select("key", "n_tokens", log_prob.alias("log_prob"))


def score_documents(docs: DataFrame, shape: Shape = Shape(), rounds: int = 2, text_col: str = "text", shard_tokens: int = 1 << 21) -> DataFrame:
    """Adds ``n_tokens``, ``log_prob`` (summed) and ``mean_log_prob`` to the documents."""
    texts = docs.select(F.col(text_col).alias("text"))
    counts = written(word_counts(texts), "word_counts")
    words = vocabulary(counts, shape)
    coded = written(coded_texts(texts, words, shape.coding), "coded", merged=False)
    net = train(coded, shape, rounds, shard_tokens=shard_tokens)
    scores = written(score_texts(coded, counts, words, net, shape.coding), "scores")

    # A caller's columns travel in a struct, so that no name can clash.
    own = [F.col(f"`{name}`") for name in docs.columns]
    keyed = docs.where(F.col(text_col).isNotNull()).select(F.struct(*own).alias("row"), text_key(F.col(text_col)).alias("key"))
    nothing = docs.where(F.col(text_col).isNull()).select(F.struct(*own).alias("row"), F.lit(0).cast("long").alias("n_tokens"), F.lit(0.0).alias("log_prob"))
    found = keyed.join(scores, "key").select("row", "n_tokens", "log_prob").unionByName(nothing)
    added = {
        "n_tokens": F.col("n_tokens"),
        "log_prob": F.col("log_prob"),
        "mean_log_prob": F.col("log_prob") / F.nullif("n_tokens", F.lit(0)),
    }
    kept = [F.col(f"row.`{name}`").alias(name) for name in docs.columns if name not in added]
    return found.select(*kept, *[value.alias(name) for name, value in added.items()])

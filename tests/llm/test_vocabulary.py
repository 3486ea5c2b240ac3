"""Every word of the corpus has a count of its own, however many there are."""

import math
from collections import Counter

import numpy as np
import pytest

from fleetlens.llm import masked_lm

SHAPE = masked_lm.Shape(buckets=40, classes=12, frequent=8)


def test_rare_words_keep_their_own_counts(spark, documents):
    """Far more words than tasks hold: equal contexts, so scores differ by the words' counts alone."""
    texts = [f"the cat w{k} sat down" for k in range(3000)] + ["the cat often sat down"] * 30 + [None, ""]
    docs = documents(texts)
    counts = masked_lm.word_counts(docs)
    want = Counter(w for t in texts for w in (t or "").split())
    got = {r.w: r.n for r in counts.collect()}
    assert got == {masked_lm.word_hash(w.encode()): n for w, n in want.items()}
    words = masked_lm.vocabulary(counts, SHAPE)
    held = {int(h) for h in words.hashes}
    rare = {w: n for w, n in want.items() if masked_lm.word_hash(w.encode()) not in held}
    assert len(held) == 40 and len(rare) > 2900
    in_last = sum(rare.values()) + sum(got[int(h)] for h, c in zip(words.hashes, words.classes, strict=False) if c == SHAPE.classes - 1)
    assert words.last_total == in_last
    rows = {r.doc_id: r for r in masked_lm.score_documents(docs, SHAPE).collect()}
    assert len(rows) == len(texts) and rows[3031].n_tokens == 0 and rows[3031].mean_log_prob is None
    once = [rows[k].log_prob for k in range(3000) if f"w{k}" in rare]
    assert max(once) - min(once) < 1e-3
    coded = masked_lm.coded_texts(docs.select("text"), words, SHAPE.coding)
    assert sorted(r.n for r in coded.collect())[-1] == 30
    shares = {r.key: r.log_rare for r in masked_lm.rare_shares(coded, counts, words).collect()}
    assert len(shares) == len(rare) and all(abs(v - math.log(1 / in_last)) < 1e-9 for v in shares.values())


def test_classes_follow_frequency(spark, documents):
    docs = documents([" ".join(f"v{k}" for k in range(200) for _ in range(1 + 400 // (k + 1)))])
    words = masked_lm.vocabulary(masked_lm.word_counts(docs), SHAPE)
    assert words.classes[:8].tolist() == list(range(8))
    assert all(a <= b for a, b in zip(words.classes[:-1], words.classes[1:], strict=True))


def test_scores_equal_plain_python(spark, documents):
    """The same vocabulary and network, word by word: P(class | both sides) times the word's share of its class."""
    texts = ["The cat sat on the mat " * 4, "a dog  sat\ton the log", "the zebra", "one", "", "on on on on on"] * 2
    docs = documents(texts)
    shape = masked_lm.Shape(buckets=6, classes=5, frequent=3, hidden=4)
    counts = masked_lm.word_counts(docs)
    words = masked_lm.vocabulary(counts, shape)
    net = masked_lm.train(masked_lm.coded_texts(docs, words, shape.coding), shape)
    total = Counter(w for t in texts for w in t.lower().split())
    ranked = sorted(total, key=lambda w: (-total[w], masked_lm.word_hash(w.encode())))
    held = dict(zip(ranked[:6], words.classes.tolist(), strict=False))
    class_of = {w: held.get(w, shape.classes - 1) for w in total}
    mass = Counter()
    for w, n in total.items():
        mass[class_of[w]] += n

    def log_prob(text):
        found, out = text.lower().split(), 0.0
        classes = [class_of[w] for w in found]
        for i, w in enumerate(found):
            hidden = net.bias.astype("f8").copy()
            for slot, j in enumerate((i - 2, i - 1, i + 1, i + 2)):
                side = classes[j] if 0 <= j < len(found) else shape.classes
                hidden += net.sides[slot * (shape.classes + 1) + side]
            logits = np.tanh(hidden) @ net.out + net.offset
            out += logits[classes[i]] - np.log(np.exp(logits).sum()) + math.log(total[w] / mass[classes[i]])
        return len(found), out

    for r in masked_lm.score_documents(docs, shape).collect():
        n, expected = log_prob(texts[r.doc_id])
        assert r.n_tokens == n and r.log_prob == pytest.approx(expected, abs=1e-4)


def test_scores_do_not_depend_on_how_rows_are_split(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    shape = masked_lm.Shape(buckets=2000, classes=64, frequent=48)
    found = []
    for dealt in (docs.coalesce(1), docs.repartition(4), docs.repartition(8, "doc_id").orderBy("text")):
        rows = masked_lm.score_documents(dealt, shape, shard_tokens=1 << 14).collect()
        found.append({r.doc_id: r.mean_log_prob for r in rows})
    assert len(found[0]) == 200
    for other in found[1:]:
        assert max(abs(other[i] - v) for i, v in found[0].items()) < 1e-6


def test_own_columns_keep_their_values(spark, documents):
    docs = documents(["a b c", None, "a b"]).selectExpr("*", "doc_id AS row", "doc_id AS n", "doc_id AS log_known", "doc_id AS n_tokens")
    rows = masked_lm.score_documents(docs, SHAPE).collect()
    assert sorted((r.doc_id, r.row, r.n, r.log_known, r.n_tokens) for r in rows) == [(0, 0, 0, 0, 3), (1, 1, 1, 1, 0), (2, 2, 2, 2, 2)]

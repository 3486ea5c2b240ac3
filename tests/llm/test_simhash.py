"""SimHash classes against plain Python: the query's fingerprints and components, and the pipeline's stage."""

import random
import re

import duckdb
import xxhash

import corpus_pipeline
from fleetlens.llm import queries as llm
from fleetlens.llm import simhash_dedup
from tests.llm.test_edges import LONG, words

SF = "/root/testdata/sf0.001"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 4]) for i in range(max(1, len(found) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints):
    """{id: smallest id reachable} over all pairs of ids."""
    ids, group = sorted(prints), {i: i for i in prints}
    for a in ids:
        for b in ids:
            if a < b and group[a] != group[b] and (prints[a] ^ prints[b]).bit_count() <= 4:
                low, high = sorted((group[a], group[b]))
                group = {i: low if g == high else g for i, g in group.items()}
    return group


def edited(text, n, draw):
    found = text.split()
    for i in draw.sample(range(len(found)), n):
        found[i] = f"x{draw.randrange(10**6)}"
    return " ".join(found)


def texts_around_the_limit():
    """Random edits, copies, other case and blanks, short, empty and very long texts."""
    draw, texts = random.Random(3), []
    for k in range(30):
        base = words(draw.randint(60, 400), 500 + k)
        texts += [base, *(edited(base, draw.randint(1, 4), draw) for _ in range(4)), base.upper(), base.replace(" ", "\t\n")]
    return [*texts, None, "", " \n", "one two", "One  two", "one three", LONG, LONG + " tail"]


def test_query_equals_brute_force(spark):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    prints = {i: fingerprint(t) for i, t in texts.items()}
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in llm.QUERIES["op4_simhash_near_duplicates"](spark, SF).collect()}
    assert found == {i: (f"{prints[i]:016x}", c) for i, c in classes(prints).items()}


def test_classes_equal_brute_force(documents):
    texts = texts_around_the_limit()
    prints = {i: fingerprint(t) for i, t in enumerate(texts)}
    expected = classes(prints)
    linked = [i for i, c in expected.items() if prints[i] != prints[c]]
    assert len(linked) > 10  # classes of different fingerprints
    found = simhash_dedup.near_duplicates(documents(texts)).collect()
    assert {r.doc_id: r.component_id for r in found} == expected


def test_stage_keeps_one_of_each_class(spark, documents):
    texts = texts_around_the_limit()
    docs = documents(texts)
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    expected = classes({i: fingerprint(t) for i, t in enumerate(texts)})
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(expected.values()))
    assert corpus_pipeline.drop_near_copies(spark, docs.limit(0), "").count() == 0


def test_rows_without_id_and_repeated_rows(documents):
    docs = documents(["a b c d e"] * 4 + ["other words are here now"] * 2, ids=[7, 3, 3, None, None, None])
    kept = simhash_dedup.one_of_each(docs).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["3", "None"]

"""The numbered queries: SQL where there is any, contracts, and the pipeline against plain Python."""

import hashlib
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
from fleetlens.llm import queries as llm
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(llm.QUERIES[name](spark, SF), connect(SF), llm.ORACLES[name]) == []


def test_all_numbers_are_registered():
    names = entry_point.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1


def test_licenses_contract(spark, texts):
    phrases = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}
    for row in llm.QUERIES["op3_license_scan"](spark, SF).collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", texts[row.doc_id].lower())
        found = [
            (i, label)
            for label, phrase in phrases.items()
            for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()
        ]
        assert row.n_words == len(words) and row.n_base == len(found)
        assert row.first_word == min((i for i, _ in found), default=None)
        assert row.last_word == max((i for i, _ in found), default=None)
        assert row.base_labels == ",".join(sorted({label for _, label in found}))
        assert {label for _, label in found} <= set(row.labels.split(","))
        assert 0 <= row.score <= 1 and (row.score > 0) == (row.labels != "")


def test_quality_contract(spark, texts):
    for row in llm.QUERIES["op10_quality_ratio"](spark, SF).collect():
        text = texts[row.doc_id]
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        covered = {i + k for i, t in enumerate(triples) if triples.count(t) > 1 for k in range(3)} if len(words) < 700 else None
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert row.n_words == len(words) and row.word_chars == sum(map(len, words))
        assert row.n_symbols == len(re.findall(r"[#*$%&|<>]", text))
        assert row.n_dup_lines == sum(x in lines[:i] for i, x in enumerate(lines))
        assert covered is None or row.n_repeat_words == len(covered)
        assert row.base_failed == (row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words)
        assert not (row.base_failed and row.kept)


def test_quality_keeps_good_and_drops_bad(spark):
    sf = "/root/testdata/sf0.01"
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall())
    rows = [r for r in llm.QUERIES["op10_quality_ratio"](spark, sf).collect() if r.doc_id in labels and not r.base_failed]
    assert all(r.kept == (labels[r.doc_id] == 1) for r in rows)


def test_language_is_right_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    langs = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{sf}/documents.parquet'").fetchall())
    rows = llm.QUERIES["op9_language_cnn"](spark, sf).collect()
    assert len(rows) == len(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_mix_meets_its_targets(spark, texts):
    rows = llm.QUERIES["op5_source_mix"](spark, SF).collect()
    sizes = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in texts.items()}
    assert {r.doc_id: r.size for r in rows} == sizes
    again = llm.QUERIES["op5_source_mix"](spark, SF).collect()
    assert sorted(rows) == sorted(again)
    by = {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        by.setdefault((r.source_size, r.target), []).append(r)
    for (_, target), members in by.items():
        assert abs(sum(r.taken for r in members) - target) <= max(r.size for r in members)
    assert sum(t for _, t in by) == pytest.approx(sum(sizes.values()))


def test_pipeline(spark):
    """Each stage's effect on what the stage before kept, held against plain Python."""
    seen, docs = [], spark.read.parquet(f"{SF}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        seen.append([r.asDict() for r in docs.collect()])
        out = stage(spark, docs, SF)
        assert k == len(corpus_pipeline.STAGES) - 1 or out.columns == docs.columns
        docs = out
    raw, named, single, clean, surrogate = seen
    assert [r["doc_id"] for r in raw] and len(named) == len(raw)  # no junk without letters here

    def prints(text):
        import xxhash

        words = text.encode().lower().split()
        hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
        return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))

    found = {r["doc_id"]: prints(r["text"]) for r in named}
    group = {i: i for i in found}
    changed = True
    while changed:
        changed = False
        for a in found:
            for b in found:
                if (found[a] ^ found[b]).bit_count() <= 4 and group[a] != group[b]:
                    group[a] = group[b] = min(group[a], group[b])
                    changed = True
    assert {r["doc_id"] for r in single} == set(group.values())

    def shingles(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    items = [shingles(t) for (t,) in duckdb.sql(f"SELECT text FROM '{SF}/benchmark.parquet'").fetchall()]
    leaked = {r["doc_id"] for r in single if any(len(i & shingles(r["text"])) >= 0.8 * len(i) for i in items)}
    assert leaked and {r["doc_id"] for r in clean} == {r["doc_id"] for r in single} - leaked
    before = {r["doc_id"]: r["text"] for r in clean}
    personal = re.compile(r"\w+@mail\d|\+\d \(\d{3}\) \d{3}-\d{4}|token = |(?<![\w.])\d+\.\d+\.\d+\.\d+(?![\w.])")
    for r in surrogate:
        old = before[r["doc_id"]]
        if personal.search(old):
            assert r["text"] != old
        elif not re.search(r"\d{13}", old):
            assert r["text"] == old
    assert {r.doc_id for r in docs.collect()} == {r["doc_id"] for r in clean}


def test_stages_keep_columns_with_clashing_names(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 40")
    own = {name: F.col("doc_id") for name in ("entities", "found", "fp", "key", "size", "score", "lang_pred", "copies")}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.withColumns(own), SF)
        assert out.columns == [*docs.columns, *own]
        assert all(r[name] == r["doc_id"] for r in out.collect() for name in own)


def test_archives_digests(spark):
    html = dict(duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall())
    for r in llm.QUERIES["op8_warc_zstd"](spark, SF).collect():
        assert r.payload_digest == hashlib.sha256((html[r.page_id] or "").encode()).hexdigest()

"""Shards against their law, and label propagation against its quotas and plain Python."""

import zlib
from collections import Counter, defaultdict

import duckdb
from pyspark.sql import functions as F

from fleetlens.llm import balanced_shards
from fleetlens.llm import queries as llm

SF = "/root/testdata/sf0.001"


def lawful(rows, shards):
    """Counts at most one apart, and the slots of every shard gapless from 0."""
    slots = defaultdict(list)
    for r in rows:
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
    assert sorted(Counter(map(len, slots.values())).values())[-1:] and all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(k, [])) for k in range(shards)]
    assert max(sizes) - min(sizes) <= 1


def pairs_cut(rows, text_of):
    """By brute force: (pairs of equal texts, those in different shards)."""
    found = [(text_of[r.doc_id], r.shard) for r in rows if text_of[r.doc_id] is not None]
    both = [(a, b) for i, a in enumerate(found) for b in found[:i] if a[0] == b[0]]
    return len(both), sum(a[1] != b[1] for a, b in both)


def test_query_holds_its_contract(spark):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    rows = llm.QUERIES["op11_balanced_shards"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    lawful(rows, 16)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
    pairs, cut = pairs_cut(rows, texts)
    assert pairs > 0 and cut == 0
    again = llm.QUERIES["op11_balanced_shards"](spark, SF).collect()
    assert sorted(again) == sorted(rows)


def test_hot_group_and_edges(documents):
    """A text of a third of the rows is cut only where a shard is full; nulls, empties, repeated ids."""
    texts = ["hot"] * 100 + ["pair", "pair", "", "", None, None, "ä" * 50_000] + [f"text {i}" for i in range(193)]
    ids = [*range(298), None, None]
    rows = balanced_shards.shard_documents(documents(texts, ids=ids), shards=8, block=16).collect()
    lawful(rows, 8)
    assert Counter(r.doc_id for r in rows) == Counter(ids)
    at = {r.doc_id: r for r in rows}
    assert at[100].shard == at[101].shard and at[102].shard == at[103].shard
    assert at[104].size == 1 and at[104].text_crc32 == 0 and at[104].link_rows is None and at[102].link_rows == 2
    assert at[106].size == 100_001
    hot = Counter(r.shard for r in rows if r.size == 4 and r.link_rows == 100)
    assert sum(hot.values()) == 100 and len(hot) <= 5  # at least 100 / 38 = 3


def test_few_and_no_rows(documents):
    lawful(balanced_shards.shard_documents(documents(["a", "a", "b"]), shards=16).collect(), 16)
    lawful(balanced_shards.shard_documents(documents(["a"] * 40), shards=3).collect(), 3)
    assert balanced_shards.shard_documents(documents(["a"]).limit(0)).collect() == []


def test_carried_columns_keep_their_values(documents):
    docs = documents(["a", "a", "b"]).withColumns({"shard": F.col("doc_id") * 7, "link": F.lit("x")})
    rows = balanced_shards.shard_documents(docs, shards=2, carry=("source", "key")).collect()
    assert {(r.doc_id, r.key) for r in rows} == {(0, "k"), (1, "k"), (2, "k")}


def test_propagation_obeys_quotas_and_gathers(spark):
    """Rings of several links: quotas hold after every number of rounds, and fewer links are cut."""
    vertices = spark.createDataFrame([(f"v{i}", 1, i % 4) for i in range(80)], "v string, n long, shard int")
    members = spark.createDataFrame(
        [(f"v{i}", f"a{i // 5}") for i in range(80)] + [(f"v{i}", f"b{i // 10}") for i in range(80)], "v string, link string"
    )

    def cut(placed):
        rows = placed.join(members, "v").select("link", "shard")
        return balanced_shards.cut_links(rows).first()

    start = cut(vertices)
    for rounds in (1, 4, 24):
        placed = balanced_shards.propagate(vertices, members, [22] * 4, rounds)
        held = Counter(r.shard for r in placed.collect())
        assert sum(held.values()) == 80 and max(held.values()) <= 22
    end = cut(placed)
    assert start.pairs == end.pairs and end.cut < start.cut / 3


def test_cut_links_equals_brute_force(spark):
    rows = [("a", 0), ("a", 0), ("a", 1), ("b", 2), (None, 1), (None, 2), ("c", 1), ("c", 3)]
    found = balanced_shards.cut_links(spark.createDataFrame(rows, "link string, shard int")).first()
    assert (found.pairs, found.cut) == (4, 3)
    none = balanced_shards.cut_links(spark.createDataFrame([], "link string, shard int")).first()
    assert (none.pairs, none.cut) == (0, 0)


def test_main_path_has_no_python(spark):
    plan = llm.QUERIES["op11_balanced_shards"](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan

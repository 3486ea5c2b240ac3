"""Fill-in-the-middle outputs against plain Python, and exact round trips."""

import hashlib

import duckdb
import pytest
from hypothesis import given
from hypothesis import strategies as st

from fleetlens.llm import fill_in_middle as fim
from fleetlens.llm import queries as llm

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) by the contract, in one piece."""
    text = text or ""
    h = [int(sha(f"1:{'' if doc_id is None else doc_id}")[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = min(h[0] % (n + 1), h[1] % (n + 1)), max(h[0] % (n + 1), h[1] % (n + 1))
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_query_equals_plain_python(spark):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    rows = llm.QUERIES["op12_fill_in_middle"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        *head, output = expected(r.doc_id, texts[r.doc_id])
        assert [r.n, r.form, r.prefix_chars, r.middle_chars] == head
        assert (r.output_sha256, r.restored_sha256) == (sha(output), sha(texts[r.doc_id] or ""))
    assert {r.form for r in rows} == {"plain", "psm", "spm"}


EDGES = [
    None, "", "x", "<P> is here", "a <S", "<M", "P>", "<", "S>b", "one\r\ntwo ", "😀 ä ﷽ é" * 40,
    "long " * 60_000, "same", "same", "\0nul", *(f"text number {i}" for i in range(60)),
]


@pytest.mark.parametrize("units", [1 << 16, 7])
def test_edges(documents, units):
    """Marks in texts and at borders, many pieces, repeated rows, ids that are null or shared."""
    texts = EDGES if units > 7 else [t for t in EDGES if t is None or len(t) < 1000]
    ids = list(range(len(texts)))
    ids[-1], ids[-2], ids[-3] = None, None, 5
    docs = documents(texts, ids=ids)
    docs = docs.unionByName(docs.where("doc_id IN (3, 12)"))
    wanted = sorted(
        (str(i), *map(str, expected(i, t)[:4]), sha(expected(i, t)[4]), sha(t or ""))
        for k, (i, t) in enumerate([*zip(ids, texts, strict=True), *[(i, t) for i, t in zip(ids, texts, strict=True) if i in (3, 12)]])
    )
    found = fim.digests(docs, units=units)
    assert sorted(tuple(map(str, r)) for r in found.collect()) == wanted
    outputs = fim.transformed(docs, units=units).collect()
    assert sorted((str(r.doc_id), sha(r.output)) for r in outputs) == sorted((w[0], w[5]) for w in wanted)


def test_empty_table(documents):
    assert fim.digests(documents(["a"]).limit(0)).collect() == []
    assert fim.transformed(documents(["a"]).limit(0)).columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]


@given(st.text(alphabet="<>PSMab", max_size=30), st.integers(0, 50), st.integers(1, 5))
def test_sections_invert_pieces(text, doc_id, units):
    form, first, last = fim.plan(doc_id, text)
    pieces = list(fim.output_pieces(text, form, first, last, units))
    assert "".join(pieces) == expected(doc_id, text)[4]
    assert all(len(p) <= units + 3 for p in pieces)
    assert "".join(p for _, _, p in sorted(fim.sections(iter(pieces), form))) == text

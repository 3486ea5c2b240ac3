"""Test items of fewer words than a shingle, inside longer documents."""

from fleetlens.llm import decontamination
from tests.llm.test_edges import words


def test_short_items_are_found_inside_documents(spark, documents):
    items = ["blue whale song", "zebra", "What is two?", "one two three four", "five words are one shingle", None, ""]
    texts = [
        f"{words(40, 1)} Blue, whale SONG {words(40, 2)}", f"{words(9, 3)} zebra", "a what is two", "one two three", "x one two three four",
        "blue song whale and other words here", "five words are one shingle", None, "", "zebra", words(80, 4),
    ]
    docs, bench = documents(texts), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = {(0, 0), (1, 1), (2, 2), (4, 3), (6, 4), (9, 1)}
    for limit in (200_000, 0):
        rows = decontamination.leaks(docs, bench, max_broadcast=limit).collect()
        assert {(r.doc_id, r.item_id) for r in rows} == want and len(rows) == len(want)
        assert all(r.containment == 1.0 and r.n_item == r.n_shared == 1 for r in rows)
    kept = {r.doc_id for r in decontamination.clean_documents(docs, bench).collect()}
    assert kept == {3, 5, 7, 8, 10}

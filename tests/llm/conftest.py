import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that the operators use inside, as a caller's own.
CLASHES = "fp long, key string, words string, size long, score string, labels string, rule string, h long, b string"


@pytest.fixture
def documents(spark):
    """A small table of documents, with extra columns whose names clash."""

    def make(texts, langs=None, sources=None, ids=None):
        n = len(texts)
        langs, sources, ids = langs or [None] * n, sources or [None] * n, ids or list(range(n))
        rows = [
            (i, t, lang, s, None if t is None else len(t), 1, "k", "w", 2, "s", "l", "r", 3, "b")
            for i, t, lang, s in zip(ids, texts, langs, sources, strict=True)
        ]
        return spark.createDataFrame(rows, f"{SCHEMA}, {CLASHES}")

    return make

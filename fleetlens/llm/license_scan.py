"""License scan: positional index of rare words, postings intersected, mandatory key phrases.

Every template is a licence notice with a key phrase that must stand in it word for word.
The corpus tells how rare each licence word is (document frequency over all documents).
The index posts every template under the up to ``ANCHORS`` words of its key phrase with
the highest IDF, each with its place in the template. Of each file the rarest licence
words are taken: those of templates of which the file holds every indexed word. Their
occurrences are looked up in the index; each posting gives the start that the template
would have, and a start that all of the template's postings agree on is kept. There the
key phrase is verified, and the other template words are compared at their places. As
every occurrence of a key phrase holds all its words, no place is missed.

A template's coverage is the IDF of its matching words over that of all. All work is
done inside a row; only document frequencies of licence words are gathered. Templates are
a tuple or come from a table (``templates_of``); the plan does not grow with their number.

Null and empty texts have no word: n_words and n_base 0, no label, score 0. Texts are read whole,
however long. Repeated rows give a row each. Of the words of a key phrase that are equally rare
the alphabetically last ones are indexed; any of them finds the same places. An empty table gives
no row; without documents all licence words are equally rare.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.decontamination import BREAKS

#: Words of a key phrase that the index holds.
ANCHORS = 3

@dataclass(frozen=True)
class Template:
    label: str
    notice: str
    key: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.notice.split()

    @property
    def key_words(self) -> list[str]:
        return self.key.split()

    @property
    def key_start(self) -> int | None:
        n = len(self.key_words)
        return next((i for i in range(len(self.words)) if self.words[i : i + n] == self.key_words), None)


# Words of public licence notices.
TEMPLATES = (
    Template("mit", "mit license", "mit license", True),
    Template("apache", "apache license", "apache license", True),
    Template("gpl", "general public license", "general public license", True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy", "hereby granted free of charge"),
    Template("mit", "released under the mit license", "released under the mit license"),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template("gpl", "licensed under the gnu general public license version 3", "gnu general public license"),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Template("gpl-2.0", "gnu general public license as published by the free software foundation either version 2 of the license",
             "gnu general public license as published by the free software foundation either version 2 of the license"),
    Template("gpl-3.0", "gnu general public license as published by the free software foundation either version 3 of the license",
             "gnu general public license as published by the free software foundation either version 3 of the license"),
    Template("lgpl-2.1", "gnu lesser general public license as published by the free software foundation either version 2 1 of the license",
             "gnu lesser general public license as published by the free software foundation either version 2 1 of the license"),
    Template("lgpl-3.0", "gnu lesser general public license as published by the free software foundation either version 3 of the license",
             "gnu lesser general public license as published by the free software foundation either version 3 of the license"),
    Template("agpl-3.0", "gnu affero general public license as published by the free software foundation either version 3 of the license",
             "gnu affero general public license as published by the free software foundation either version 3 of the license"),
    Template("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    Template("agpl", "under the terms of the gnu affero general public license", "gnu affero general public license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             "redistribution and use in source and binary forms"),
    Template("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
             "derived from this software without specific prior written permission", "may be used to endorse or promote products derived from this software"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
    Template("epl-1.0", "under the terms of the eclipse public license v1 0", "eclipse public license v1 0"),
    Template("epl-2.0", "under the terms of the eclipse public license 2 0", "eclipse public license 2 0"),
    Template("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable",
             "without any express or implied warranty in no event will the authors"),
    Template("bsl-1.0", "boost software license version 1 0", "boost software license version 1 0"),
    Template("artistic-2.0", "artistic license 2 0", "artistic license 2 0"),
    Template("gfdl", "gnu free documentation license version 1 3", "gnu free documentation license"),
    Template("ofl-1.1", "sil open font license version 1 1", "open font license version 1 1"),
    Template("cc0-1.0", "cc0 1 0 universal public domain dedication", "cc0 1 0 universal"),
    Template("mpl", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use copy modify and or distribute"),
    Template("cc-by", "licensed under cc by 4 0", "cc by 4 0"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by", "creative commons attribution 4 0 international license", "creative commons attribution 4 0"),
    Template("cc-by-sa", "creative commons attribution sharealike 4 0 international license", "creative commons attribution sharealike"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)


ADDED = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def templates_of(rows: DataFrame, most: int = 10_000) -> tuple[Template, ...]:
    """Templates of a table (label, notice, key), which must have at most ``most`` rows.

    Rows with a null are left out; a key phrase that is not in its notice is an error.
    """
    found = [
        Template(r["label"], " ".join(r["notice"]), " ".join(r["key"]))
        for r in rows.select("label", licence_words(F.col("notice")).alias("notice"), licence_words(F.col("key")).alias("key"))
        .where("label IS NOT NULL AND size(notice) > 0 AND size(key) > 0").distinct().limit(most + 1).collect()
    ]
    if len(found) > most:
        raise ValueError(f"more than {most} licence templates")
    for t in found:
        if t.key_start is None:
            raise ValueError(f"the notice of {t.label} does not hold its key phrase: {t.key}")
    return tuple(sorted(found, key=lambda t: (t.label, t.notice, t.key)))


def licence_words(text: Column) -> Column:
    """The words of a text, A-Z in lower case."""
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lower, BREAKS), "")


def rarity(texts: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> dict[str, float]:
    """IDF of every licence word over all rows of column ``text``; one row per licence word reaches the driver."""
    vocabulary = sorted({w for t in templates for w in t.words})
    found = F.array_intersect(F.array(*[F.lit(w) for w in vocabulary]), licence_words(F.col("text")))
    counted = texts.select(F.explode(found).alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()
    frequency, total = {r["word"]: r["n"] for r in counted}, texts.count()
    return {w: math.log((total + 2) / (frequency.get(w, 0) + 1)) for w in vocabulary}


def _array(values: list, kind: str) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")


def _anchors(template: Template, idf: dict[str, float]) -> list[tuple[str, int]]:
    """The rarest words of the key phrase with their places in the template."""
    places = [(w, template.key_start + j) for j, w in enumerate(template.key_words)]
    return sorted(places, key=lambda x: (idf[x[0]], x), reverse=True)[:ANCHORS]


def places(words: DataFrame, idf: dict[str, float], templates: tuple[Template, ...]) -> DataFrame:
    """Turns column ``words`` into ``n_words`` and ``found`` array<struct<t, at, cover>>.

    ``t`` numbers the template, ``at`` is the word at which its notice would start (below
    zero if its first words are cut off), ``cover`` the coverage there.
    """
    anchors = [_anchors(t, idf) for t in templates]
    rarest = sorted({w for a in anchors for w, _ in a}, key=lambda w: (-idf[w], w))
    needed = F.array(*[_array(sorted({w for w, _ in a}), "string") for a in anchors])
    postings = F.create_map(*[
        x for w in rarest for x in (F.lit(w), F.array(*[
            F.struct(F.lit(t).alias("t"), F.lit(p).alias("p")) for t, a in enumerate(anchors) for word, p in a if word == w
        ]))
    ])
    counts = _array([len(a) for a in anchors], "int")
    texts = F.array(*[
        F.struct(
            _array(t.words, "string").alias("words"), _array([idf[w] for w in t.words], "double").alias("weights"),
            _array(t.key_words, "string").alias("key"), F.lit(t.key_start).alias("first"),
            F.lit(float(sum(idf[w] for w in t.words))).alias("total"),
        )
        for t in templates
    ])
    none = F.array().cast("array<struct<t:int,at:int>>")

    # The file's rarest licence words, of templates of which it holds every indexed word.
    words = words.withColumn("held", F.array_intersect(_array(rarest, "string"), F.col("words")))
    whole = F.filter(needed, lambda n: F.size(F.array_except(n, F.col("held"))) == 0)
    words = words.withColumn("wanted", F.when(F.size("held") > 0, F.array_distinct(F.flatten(whole))).otherwise(_array([], "string")))

    # Their postings, each as the start it gives.
    numbered = F.transform("words", lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    seen = F.filter(numbered, lambda x: F.array_contains("wanted", x["w"]))
    starts = F.transform(seen, lambda x: F.transform(
        F.element_at(postings, x["w"]), lambda e: F.struct(e["t"].alias("t"), (x["i"] - e["p"]).alias("at"))
    ))
    words = words.withColumn("starts", F.when(F.size("wanted") > 0, F.array_sort(F.flatten(starts))).otherwise(none))

    # A start on which all of a template's postings agree stands in a row as often as there are postings.
    agreed = F.filter("starts", lambda s, k: F.get("starts", k + F.get(counts, s["t"]) - 1).eqNullSafe(s))

    def verified(s: Column) -> Column:
        t, key_at = F.get(texts, s["t"]), s["at"] + F.get(texts, s["t"])["first"]
        return F.when(key_at >= 0, F.slice("words", key_at + 1, F.size(t["key"])) == t["key"]).otherwise(False)

    def cover(s: Column) -> Column:
        t = F.get(texts, s["t"])
        same = F.transform(t["words"], lambda w, j: F.coalesce(F.get("words", s["at"] + j) == w, F.lit(False)))
        hits = F.zip_with(same, t["weights"], lambda hit, weight: F.when(hit, weight).otherwise(F.lit(0.0)))
        hit = F.aggregate(hits, F.lit(0.0), lambda total, x: total + x)
        return F.when(F.forall(same, lambda x: x), F.lit(1.0)).otherwise(hit / t["total"])

    found = F.transform(
        F.filter(agreed, verified), lambda s: F.struct(s["t"].alias("t"), s["at"].alias("at"), cover(s).alias("cover"))
    )
    words = words.withColumn("found", found).withColumn("n_words", F.size("words").cast("long"))
    return words.drop("words", "held", "wanted", "starts")


def scan(
    docs: DataFrame, idf: dict[str, float], templates: tuple[Template, ...] = TEMPLATES, least: float = 0.5, text_col: str = "text"
) -> DataFrame:
    """Adds the columns ``ADDED`` to every row, in place of any of the same name."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ADDED]
    rows = docs.select(F.struct(*kept).alias("row"), licence_words(F.col(text_col)).alias("words"))
    rows = places(rows, idf, templates)
    labels = _array([t.label for t in templates], "string")
    base = _array([t.base for t in templates], "boolean")

    def named(found: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda x: F.get(labels, x["t"])))), ",")

    stated = F.filter("found", lambda x: F.get(base, x["t"]))
    starts = F.transform(stated, lambda x: x["at"])
    matched = F.filter("found", lambda x: x["cover"] >= least)
    return rows.select(
        "row.*",
        "n_words",
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        named(stated).alias("base_labels"),
        named(matched).alias("labels"),
        F.coalesce(F.array_max(F.transform(matched, lambda x: x["cover"])), F.lit(0.0)).alias("score"),
    )

"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names, operator by operator."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import (
    decontamination,
    language_cnn,
    license_scan,
    masked_lm,
    pii_surrogates,
    quality_ratio,
    simhash_dedup,
    source_mix,
    url_automaton,
    warc_zstd,
)
from fleetlens.llm.shared import components

KEY = b"test key"


def words(n, seed, alphabet="abcdefgh"):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices(alphabet, k=draw.randint(2, 6))) for _ in range(n))


LONG = words(120_000, 1)


def test_components_equal_union_find(spark):
    draw = random.Random(3)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(1000, k) for k in range(900, 960)]
    edges += [(k, k + 1) for k in range(2000, 2100)]
    group = {v: v for e in edges for v in e}

    def root(v):
        while group[v] != v:
            v = group[v]
        return v

    for a, b in edges:
        a, b = root(a), root(b)
        group[max(a, b)] = min(a, b)
    got = {r.a: r.b for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {v: root(v) for v in group if root(v) != v}


def test_segments_leave_one_with_a_single_difference():
    assert simhash_dedup.segments(4) == [(0, 21), (21, 21), (42, 22)]
    draw = random.Random(1)
    for _ in range(500):
        bits = draw.sample(range(64), 4)
        assert min(sum(a <= b < a + n for b in bits) for a, n in simhash_dedup.segments(4)) <= 1


def test_links_equal_brute_force(spark):
    draw = random.Random(5)
    prints = [draw.getrandbits(64) for _ in range(60)]
    for p in list(prints):
        for k in range(1, 7):
            for b in draw.sample(range(64), k):
                p ^= 1 << b
            prints.append(p)
    prints = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    want = {(a, b) for a in prints for b in prints if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 4}
    got = [tuple(r) for r in simhash_dedup.links(spark.createDataFrame([(p,) for p in prints], "fp long")).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_simhash_edges(spark, documents):
    base = words(200, 2)
    docs = documents(
        [base, base, base + " tail", None, "", " \n", LONG, LONG, "one two", base],
        ids=[5, 3, 9, 8, 7, 6, 2, 2, None, 3],
    )
    rows = simhash_dedup.near_duplicates(docs).collect()
    assert len(rows) == 10
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add(r.component_id)
    assert by[5] == by[3] == by[9] == {3} and by[8] == by[7] == by[6] == {6} and by[2] == {2} and by[None] == {None}
    kept = simhash_dedup.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "6", "None"]
    assert simhash_dedup.near_duplicates(docs.limit(0)).count() == 0
    assert simhash_dedup.one_of_each(docs.limit(0)).count() == 0


def test_masked_lm(spark, documents):
    plain = ["the cat sat on the mat and the dog sat on the rug " * 30] * 8 + ["rug the on sat dog the and mat the on sat cat the " * 3]
    docs = documents([*plain, None, "", "one", LONG], ids=[*range(9), 100, 101, 102, 103])
    shape = masked_lm.Shape(buckets=1 << 12, classes=48, frequent=32)
    rows = {r.doc_id: r for r in masked_lm.score_documents(docs, shape, rounds=3).collect()}
    assert len(rows) == 13
    assert (rows[100].n_tokens, rows[100].log_prob, rows[100].mean_log_prob) == (0, 0.0, None)
    assert rows[101].n_tokens == 0 and rows[102].n_tokens == 1 and rows[103].n_tokens == 120_000
    assert rows[0].log_prob == rows[1].log_prob < 0
    assert rows[0].mean_log_prob > rows[8].mean_log_prob > rows[103].mean_log_prob
    assert masked_lm.score_documents(docs.limit(0), shape).count() == 0


def test_masked_lm_slope_is_right():
    shape = masked_lm.Shape(buckets=64, classes=6, frequent=3, reach=2, hidden=4)
    net = masked_lm.WindowNetwork(shape)
    classes = np.array([0, 3, 5, 1, 1, 2, 4, 0])

    def loss(parameters):
        return -sum(float(x.sum()) for x in masked_lm.WindowNetwork(shape, parameters).log_probabilities(classes)) / len(classes)

    start = net.parameters()
    net.descend(net.contexts(classes), classes, 1.0)
    slope = start - net.parameters()
    for i in range(0, len(start), 7):
        moved = start.copy()
        moved[i] += 1e-2
        back = start.copy()
        back[i] -= 1e-2
        assert (loss(moved) - loss(back)) / 2e-2 == pytest.approx(slope[i], abs=2e-3)


def shingles(text, width=5):
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())
    return {tuple(found[i : i + width]) for i in range(len(found) - width + 1)} or ({tuple(found)} if found else set())


def test_leaks_equal_brute_force(spark, documents):
    draw = random.Random(8)
    items = [words(draw.randint(6, 60), 100 + k) for k in range(25)] + ["only three words", None, ""]
    texts = []
    for k in range(60):
        item = draw.choice(items[:25]).split()
        for _ in range(draw.randint(0, 4)):
            item[draw.randrange(len(item))] = "zz"
        texts.append(f"{words(draw.randint(0, 300), k)} {' '.join(item)} {words(50, 900 + k)}".upper() if k % 2 else " ".join(item))
    texts += [None, "", LONG + " " + items[3], "Only three, words!", texts[0], texts[0]]
    docs = documents(texts)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = set()
    for d, text in enumerate(texts):
        have = shingles(text)
        want |= {(d, i) for i, item in enumerate(items) if shingles(item) and len(shingles(item) & have) >= 0.8 * len(shingles(item))}
    assert {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, bench).collect()} == want and len(want) > 20
    shuffled = decontamination.leaks(docs, bench, max_broadcast=0)
    assert {(r.doc_id, r.item_id) for r in shuffled.collect()} == want
    clean = decontamination.clean_documents(docs, bench)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == set(range(len(texts))) - {d for d, _ in want}
    assert decontamination.leaks(docs.limit(0), bench).count() == 0
    assert decontamination.clean_documents(docs, bench.limit(0)).count() == len(texts)


def test_licenses_equal_brute_force(spark, documents):
    notices = [t.notice for t in license_scan.TEMPLATES]
    draw = random.Random(4)
    texts = [f"{words(20, k)} {n} {words(9, k)}" for k, n in enumerate(notices)]
    texts += [" ".join(w if draw.random() < 0.85 else "xx" for w in n.split()) for n in notices for _ in range(3)]
    texts += [None, "", "MIT License, mit license; MIT LICENSE", "license mit", LONG + " mit license", "mit", "hereby granted free of charge"]
    docs = documents(texts)
    idf = license_scan.rarity(docs)
    rows = license_scan.scan(docs, idf)
    assert len(rows.columns) == len(set(rows.columns))
    for r in rows.collect():
        found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (texts[r.doc_id] or "").lower())
        base, labels, best = [], set(), 0.0
        for t in license_scan.TEMPLATES:
            for at in range(-len(t.words), len(found)):
                key = at + t.key_start
                if key < 0 or found[key : key + len(t.key_words)] != t.key_words:
                    continue
                same = [w for j, w in enumerate(t.words) if at + j >= 0 and found[at + j : at + j + 1] == [w]]
                cover = sum(idf[w] for w in same) / sum(idf[w] for w in t.words) if len(same) < len(t.words) else 1.0
                if t.base:
                    base.append((at, t.label))
                if cover >= 0.5 - 1e-12:
                    labels.add(t.label)
                    best = max(best, cover)
        assert (r.n_words, r.n_base) == (len(found), len(base))
        assert r.labels == ",".join(sorted(labels)) and r.score == pytest.approx(best)
        assert (r.first_word, r.last_word) == ((min(base)[0], max(base)[0]) if base else (None, None))
    assert license_scan.scan(docs.limit(0), license_scan.rarity(docs.limit(0))).count() == 0


def test_license_templates_from_a_table(spark, documents):
    """Hundreds of templates of shared words: found where they stand, and where one word is lost never."""
    draw = random.Random(8)
    notices = {f"l{k}": " ".join(draw.choices("one two three four five six seven".split(), k=9)) for k in range(300)}
    rows = [(k, n.title(), " ".join(n.split()[2:7])) for k, n in notices.items()] + [(None, "a b", "a"), ("empty", "", "")]
    templates = license_scan.templates_of(spark.createDataFrame(rows, "label string, notice string, key string"))
    assert len(templates) == 300
    texts = [f"x {n} y" for n in list(notices.values())[:40]] + [" ".join(draw.choices("one two three four five".split(), k=400))]
    docs = documents(texts)
    for r in license_scan.scan(docs, license_scan.rarity(docs, templates), templates, least=1.0).collect():
        want = {label for label, n in notices.items() if f" {n} " in f" {texts[r.doc_id]} "}
        assert set(filter(None, r.labels.split(","))) == want and r.score == (1.0 if want else 0.0)
    with pytest.raises(ValueError, match="key phrase"):
        license_scan.templates_of(spark.createDataFrame([("a", "b c", "c b")], "label string, notice string, key string"))
    with pytest.raises(ValueError, match="more than"):
        license_scan.templates_of(spark.createDataFrame(rows, "label string, notice string, key string"), most=9)


@pytest.mark.parametrize("k", [1, 7, 400])
def test_smallest_hashes_equal_sorting(spark, k):
    draw = random.Random(k)
    hashes = [(lang, draw.getrandbits(64) - (1 << 63)) for lang, n in (("a", 3000), ("b", 5)) for _ in range(n)]
    cuts = language_cnn.smallest_hashes(spark.createDataFrame(hashes, "lang string, h long"), k, bits=6)
    for r in cuts.collect():
        ordered = sorted(h for lang, h in hashes if lang == r.lang)
        assert r.cut == ordered[: k][-1]
    assert cuts.count() == 2


def water(sizes, most=3.0):
    names = sorted(s for s in sizes if s is not None) + ([None] if None in sizes else [])
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        level = (total - sum(fixed.values())) / (sum(weight[s] for s in free) or 1)
        over = [s for s in free if weight[s] * level > most * sizes[s]]
        if not over:
            return {**fixed, **{s: weight[s] * level for s in free}}
        fixed |= {s: most * sizes[s] for s in over}


def test_mix_edges(spark, documents):
    draw = random.Random(6)
    texts, sources = [], []
    for source, n in (("b", 300), ("a", 20), ("Z", 5), ("é", 60), (None, 40), ("empty", 4)):
        texts += ["" if source == "empty" else words(draw.randint(1, 120), len(texts) + k) for k in range(n)]
        sources += [source] * n
    texts += [None, LONG[:30_000]]
    sources += ["a", "b"]
    docs = documents(texts, sources=sources)
    rows = source_mix.mix(docs).collect()
    assert len(rows) == len(texts)
    sizes, taken, largest = {}, {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        largest[r.source] = max(largest.get(r.source, 0), r.size)
        assert r.taken <= 3 * r.size and r.taken == r.copies * r.size
    want = water(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]
    assert sorted(map(str, rows)) == sorted(map(str, source_mix.mix(docs.repartition(7)).collect()))
    assert source_mix.mix(docs.limit(0)).count() == 0
    assert {r.target for r in source_mix.mix(documents([None, "", " "])).collect()} == {0.0}


def test_sources_take_turns_in_code_point_order(spark):
    names = [f"{c}{k}" for c in "Zaé" for k in range(40)] + [None]
    counts = spark.createDataFrame([(n, 5, 1000) for n in names], "source string, size long, n long").repartition(5)
    rows = {r.source: r.target for r in source_mix.source_targets(counts).collect()}
    weights = [1 + k % 3 for k in range(len(names))]
    for name, weight in zip(sorted(n for n in names if n) + [None], weights, strict=True):
        assert rows[name] == pytest.approx(5000 * len(names) * weight / sum(weights))


def test_tilts_are_exponential_and_meet_targets(spark):
    counts = spark.createDataFrame([("a", s, 10) for s in range(1, 60)] + [("b", s, 10) for s in range(1, 51)], "source string, size long, n long")
    targets = source_mix.source_targets(counts)
    for r in source_mix.tilts(counts, targets).collect():
        got = sum(c.n * c.size * min(3, np.exp(r.tilt * c.size / r.mean)) for c in counts.collect() if c.source == r.source)
        assert got == pytest.approx(r.target, rel=1e-5)


def test_surrogates(spark, documents):
    texts = [
        "Write to Anna.Bell99@mail3.example.com or +1 (212) 555-0188, host 10.20.30.40.",
        "ANNA.BELL99@MAIL3.EXAMPLE.COM again, card 4111 1111 1111 1111 and 4111111111111111, not 4111111111111112.",
        "Mr. John Smith met Mrs Smith and Herr Müller; Господин Иванов тоже.",
        'token = "b44e15e09fd311c3cf3163b66d5a9875b883d8ce"; version 300.1.2.999',
        "A clean text about 7 cats, 2024 and 1.5 dogs.",
        None, "", LONG, LONG + " x@y.org", "DE89370400440532013000",
    ]
    docs = documents(texts)
    done = pii_surrogates.replace_entities(docs, KEY)
    rows = {r.doc_id: r for r in done.collect()}
    new = {i: r.text for i, r in rows.items()}
    assert [new[i] for i in (4, 5, 6, 7)] == [texts[i] for i in (4, 5, 6, 7)]
    mail = re.search(r"\S+@\S+\.example\.com", new[0])[0]
    assert re.fullmatch(r"[A-Za-z]{4}\.[A-Za-z]{4}\d\d@[a-z]{4}\d\.example\.com", mail) and mail.upper() in new[1]
    assert re.search(r"\+1 \(\d{3}\) 555-\d{4}", new[0]) and "10.20.30.40" not in new[0]
    card = re.search(r"\d{4} \d{4} \d{4} \d{4}", new[1])[0]
    assert card.replace(" ", "") in new[1].replace(card, "") and pii_surrogates.luhn(card.replace(" ", ""))
    assert "4111111111111112" in new[1] and "4111111111111111" not in new[1]
    parts = re.fullmatch(r"Mr\. (\w+) (\w+) met Mrs (\w+) and Herr (\w+); Господин ([А-Яа-я]+) тоже\.", new[2])
    assert parts and parts[2] == parts[3] != "Smith" and parts[4] != "Müller" and parts[5] != "Иванов"
    assert re.fullmatch(r'token = "[0-9a-f]{40}"; version 300\.1\.2\.999', new[3]) and new[3] != texts[3]
    assert new[8].startswith(LONG) and not new[8].endswith("x@y.org")
    assert pii_surrogates.iban_rest(new[9]) == 1 and new[9] != texts[9]
    assert done.columns == [*docs.columns, "entities"]
    assert pii_surrogates.replace_entities(docs.limit(0), KEY).count() == 0


def test_surrogates_stay_distinct_in_a_small_space(spark, documents):
    """Many short addresses collide at first; afterwards no two share a surrogate, and none is real."""
    real = [f"{a}.{b}.{c}.{d}" for a in range(1, 9) for b in range(1, 9) for c in range(1, 9) for d in range(1, 3)]
    texts = [f"host {ip} up" for ip in real] + [" ".join(real)] + [f"Herr {words(1, k).title()} kam" for k in range(60)]
    docs = documents(texts)
    for limit in (100_000, 0):
        rows = {r.doc_id: r.text for r in pii_surrogates.replace_entities(docs, KEY, limit).collect()}
        drawn = [rows[i].split()[1] for i in range(len(real))]
        assert len(set(drawn)) == len(real) and not set(drawn) & set(real)
        assert rows[len(real)] == " ".join(drawn)


def test_urls(spark):
    urls = [
        None, "", "no host", "http://A.Example.NET/en/x?y#z", "https://example.net/EN/", "x://net/", "http://net", "http://my.net?q=/x",
        "http://notexample.com/de/", "http://www.example.com/de/1", "http://example.com/fr/://a.net/en/", "http://sub.org/fr/", "http://org/de/",
        "http://casino.org/en/", "http://x.com/ads/1", "http://x.com/a.exe", "http://x.com/a.exe?b", "http://é.net/ü", "http://x.com/" + "a/" * 9000,
    ]
    rows = spark.createDataFrame([(k, u, "own") for k, u in enumerate(urls)], "page_id long, url string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_automaton.judge_urls(rows).collect()}
    for k, url in enumerate(urls):
        found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (found[1].translate(str.maketrans(url_automaton.UPPER, url_automaton.LOWER)), found[2]) if found else ("", "")
        fits = [r for r in url_automaton.RULES if ("." + host).endswith("." + r.host) and path.startswith(r.path)]
        rule = max(fits, key=lambda r: len(r.name), default=None)
        bad = re.search("casino|poker", host) or "/ads/" in path or path.endswith(".exe")
        assert got[k] == (host, path, rule.name if rule else None, rule.verdict if rule else "block" if bad else "allow"), url
    assert url_automaton.judge_urls(rows.limit(0)).count() == 0


def test_words_of_hosts(spark):
    blocked = ["adult.com", "x-adult.org", "my.adult", "a.adult-b.com", "ads.x.com", "x.ads-y.com", "onlinecasino7.com", "big-spam.de"]
    allowed = ["adulteducation.org", "alphabets.com", "hispamerica.es", "spills.com", "uploads.de", "trackers.fr"]
    pages = spark.createDataFrame([(k, f"http://{h}/a") for k, h in enumerate(blocked + allowed)], "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_automaton.judge_urls(pages, rules=()).collect()}
    assert got == {k: "block" if k < len(blocked) else "allow" for k in range(len(got))}
    assert {r.verdict for r in url_automaton.judge_urls(pages, rules=(), blocked=()).collect()} == {"allow"}


def test_thousands_of_rules_from_a_table(spark):
    draw = random.Random(5)
    names = ["".join(draw.choices("abc", k=draw.randint(1, 6))) for _ in range(400)]
    table = {(f"{draw.choice(names)}.{draw.choice(['com', 'net'])}", draw.choice(["", "/", "/en/", "/en/x"])): draw.choice(["block", "allow"]) for _ in range(4000)}
    rows = [(h.upper() if k % 2 else "." + h, p or None, v) for k, ((h, p), v) in enumerate(table.items())]
    rules = url_automaton.rules_of(spark.createDataFrame([*rows, (None, "/", "block"), ("", "/", "block")], "host string, path string, verdict string"))
    assert {(r.host, r.path): r.verdict for r in rules} == table and len(rules) > 1000
    urls = [f"https://{draw.choice(['', 'www.', 'x'])}{draw.choice(names)}.{draw.choice(['com', 'net'])}{draw.choice(['', '/', '/en/', '/en/xy', '/de'])}" for _ in range(150)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_automaton.judge_urls(pages, rules, blocked=()).collect()}
    for k, url in enumerate(urls):
        host, _, path = url.removeprefix("https://").partition("/")
        path = "/" + path if _ else ""
        fits = [(h, p) for h, p in table if ("." + host).endswith("." + h) and path.startswith(p)]
        best = min(fits, key=lambda x: (-len(x[0] + x[1]), x[0] + x[1]), default=None)
        assert got[k] == (("".join(best), table[best]) if best else (None, "allow")), url
    for wrong in ([("a", "/", "block"), ("a", "/", "allow")], [("a", "/", "drop")], [("a", "/", None)]):
        with pytest.raises(ValueError, match="verdict"):
            url_automaton.rules_of(spark.createDataFrame(wrong, "host string, path string, verdict string"))


def test_automaton_equals_regular_expressions():
    draw = random.Random(2)
    globs = ["".join(draw.choices("ab*?", k=draw.randint(1, 40))) for _ in range(60)]
    machine = url_automaton.Automaton([url_automaton.glob_symbols(g, "*") for g in globs])
    assert machine.width > 3
    hosts = ["".join(draw.choices("ab", k=draw.randint(0, 30))) for _ in range(200)]
    hits = machine.matches([url_automaton.canonical(h, "/p")[1:] for h in hosts])
    for i, host in enumerate(hosts):
        for k, g in enumerate(globs):
            assert hits[i, k] == bool(re.fullmatch(g.replace("*", ".*").replace("?", "."), host))


def test_long_urls_step_through_stripes():
    for n in (1021, 1022, 1023, 1024, 1025, 5000):
        host = ("abc" * n)[:n]
        globs = [host, host[:-1] + "?", host[:-1], host + "?", "*" + host[-9:], host[:9] + "*" + host[-9:], "b*"]
        machine = url_automaton.Automaton([url_automaton.glob_symbols(g, "/p*") for g in globs])
        hits = machine.matches([url_automaton.canonical(h, "/p/q")[1:] for h in ("", host, "abc", host)])
        assert hits[1].tolist() == hits[3].tolist() == [True, True, False, False, True, True, False]
        assert not hits[0].any() and not hits[2].any()


def test_warc_round_trip(spark, tmp_path):
    big = "x" * 150
    pages = [
        (1, "http://a/", big), (2, "http://b/\r\nX: y%", big), (3, None, big), (3, "http://c/", big), (None, "http://d/", big),
        (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "u", ""), (8, "u", "é\r\n\r\nWARC/1.1\r\n" * 20), (9, "u", LONG), (10, "u", LONG),
    ] + [(k, "u", words(60, k)) for k in range(20, 320)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    rows = warc_zstd.round_trip(table).collect()
    assert len(rows) == len(pages) and all(r.error is None for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.page_id, []).append(r)
    for page_id, url, html in pages:
        data = (html or "").encode()
        assert any(r.payload_digest == hashlib.sha256(data).hexdigest() and r.payload_bytes == len(data) and r.url == url for r in by[page_id])
    kinds = {(r.page_id, r.record_type, r.refers_to) for r in rows if r.page_id is None or r.page_id < 20}
    assert kinds == {(1, "response", None), (2, "revisit", 1), (3, "revisit", 1), (None, "revisit", 1), (10, "revisit", 9)} | {
        (k, "response", None) for k in (4, 5, 6, 7, 8, 9)
    }
    assert warc_zstd.round_trip(table.limit(0)).count() == 0
    large = [((1 << 60) + 1, "u", big), ((1 << 60) + 3, "u", big), (None, "u", "")]
    rows = warc_zstd.round_trip(spark.createDataFrame(large, "page_id long, url string, html string").coalesce(1)).collect()
    assert {(r.page_id, r.refers_to) for r in rows} == {((1 << 60) + 1, None), ((1 << 60) + 3, (1 << 60) + 1), (None, None)}


def test_warc_archive_layout(spark, tmp_path):
    """Dictionary first, one frame per record; damage is reported."""
    import zstandard

    archive = warc_zstd.Archive(str(tmp_path), [words(80, k).encode() for k in range(100)], 4096, 3)
    row = type("Row", (), {"page_id": 1, "url": "u", "payload": b"p" * 200, "payload_bytes": 200, "record_type": "response",
                           "payload_digest": hashlib.sha256(b"p" * 200).hexdigest(), "refers_to": None})
    record = warc_zstd.render(row)
    archive.add(record)
    archive.add(record.replace(b"ppp", b"ppq", 1))
    archive.add(record[:-10])
    archive.add(b"nonsense")
    path, records, size = archive.close()
    data = open(path, "rb").read()
    assert records == 4 and size == len(data) and int.from_bytes(data[:4], "little") == warc_zstd.SKIPPABLE
    packed = data[8 : 8 + int.from_bytes(data[4:8], "little")]
    assert zstandard.ZstdDecompressor().decompress(packed)[:4] == b"\x37\xa4\x30\xec"
    with open(path, "rb") as stream:
        found = [warc_zstd.parse(r) for r in warc_zstd.frames_of(stream)]
    assert found[0][-1] is None and [bool(f[-1]) for f in found[1:]] == [True] * 3
    with pytest.raises(ValueError):
        import io

        list(warc_zstd.frames_of(io.BytesIO(data[:-3])))


def test_language_edges(spark, documents):
    texts = [words(60, k, "abcde") for k in range(40)] + [words(60, k, "vwxyz") for k in range(40)]
    docs = documents(texts, ["aa"] * 40 + ["zz"] * 40)
    net = language_cnn.train(docs, epochs=10)
    mixed = documents([None, "", "12 34 !?", words(50, 99, "abcde").upper(), words(50, 98, "vwxyz"), LONG, "é"], ["zz"] * 7)
    rows = {r.doc_id: r for r in language_cnn.identify(mixed, net).collect()}
    assert [(rows[k].lang_pred, rows[k].score) for k in range(3)] == [("und", 0.0)] * 3
    assert rows[3].lang_pred == "aa" and rows[4].lang_pred == "zz" and rows[5].lang_pred in ("aa", "zz")
    kept = language_cnn.accepted(mixed, net)
    assert kept.columns == mixed.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6]
    assert language_cnn.train(documents([None, "", "abc"])) is None
    assert {r.lang_pred for r in language_cnn.identify(mixed, None).collect()} == {"und"}
    assert language_cnn.identify(mixed.limit(0), net).count() == 0


def test_language_scorer_equals_network():
    net = language_cnn.ByteCnn(["a", "b", "c"], length=32)
    windows = np.random.default_rng(1).integers(0, 256, (20, 32)).astype(np.uint8)
    pooled = [net._answers(net.weights["bytes"][windows], w).max(1) + net.weights[f"bias{w}"] for w in net.widths]
    logits = np.maximum(np.concatenate(pooled, 1), 0) @ net.weights["out"]
    want = logits - np.log(np.exp(logits).sum(1, keepdims=True))
    assert np.allclose(net.scorer().log_probabilities(windows), want, atol=1e-4)


def test_quality_edges(spark, documents):
    docs = documents([None, "", "a b c a b c a b c", words(80, 1), words(80, 1), LONG, "# * $ \n \n#\n#"])
    labels = spark.createDataFrame([(3, 1, 0), (3, 1, 0), (4, 1, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    target = quality_ratio.ngram_counts(quality_ratio.trusted_texts(docs, labels), 4, 1 << 12)
    raw = quality_ratio.ngram_counts(docs, 4, 1 << 12)
    assert target.sum() == len(words(80, 1)) - 3 and raw.sum() == sum(max(0, len(t or "") - 3) for t in [r.text for r in docs.collect()])
    rows = {r.doc_id: r for r in quality_ratio.judge(docs, quality_ratio.log_ratio(target, raw)).collect()}
    assert rows[0].n_words == 0 and rows[0].base_failed and not rows[0].kept and rows[0].score == 0
    assert rows[2].n_repeat_words == 9 and rows[6].n_dup_lines == 1 and rows[6].n_symbols == 5
    assert rows[3].score == rows[4].score > rows[5].score and rows[3].kept
    assert not quality_ratio.log_ratio(np.zeros(4), np.ones(4)).any()
    assert quality_ratio.judge(docs.limit(0), quality_ratio.log_ratio(target, raw)).count() == 0


def test_rules_of_equal_length(spark):
    """The alphabetically first of two that fit decides, in whatever order they are given."""
    pages = spark.createDataFrame([(1, "http://a.org/xy/z")], "page_id long, url string")
    two = (url_automaton.Rule("org", "/xy/", "block"), url_automaton.Rule("a.org", "/x", "allow"))
    assert len({len(r.name) for r in two}) == 1
    for rules in (two, two[::-1]):
        assert url_automaton.judge_urls(pages, rules).first().rule == min(r.name for r in two)

"""Common forms of secrets, phones, cards and names; clean text stays."""

import ipaddress
import re

import pytest

from fleetlens.llm.pii_surrogates import entities, luhn, replace_entities, rewrite, surrogate

KEY = b"test key"
SECRET = "b44e15e09fd311c3cf31"


@pytest.mark.parametrize(
    "form",
    ["access_token = {}", "DB_PASSWORD={}", "client_secret: '{}'", '"token": "{}"', "accessToken: {}", "AWS_SECRET_ACCESS_KEY={}", "x-api-key: {}"],
)
def test_secrets(form):
    new = rewrite(form.format(SECRET), KEY, {})[0]
    assert SECRET not in new and re.fullmatch(re.escape(form).replace(r"\{\}", "[0-9a-f]{20}"), new)


@pytest.mark.parametrize(
    "number",
    ["+15551234567", "+49 30 1234567", "+4930 1234567", "555.123.4567", "555 123 4567", "1-800-555-1234", "1.800.555.1234", "(555)123-4567",
     "+1 (212) 555-0188", "+44 20 7946 0958", "555-123-4567", "+1-212-555-0188"],
)
def test_phones(number):
    text = f"call {number}, or {number}."
    new, found = rewrite(text, KEY, {})
    assert [text[a:b] for _, a, b in found] == [number] * 2 and {kind for kind, _, _ in found} == {"phone"}
    one, two = re.fullmatch(r"call (.*), or (.*)\.", new).groups()
    assert one == two != number and re.sub(r"\d", "0", one) == re.sub(r"\d", "0", number)


def test_one_phone_in_two_forms_keeps_one_surrogate_and_its_country():
    new = rewrite("+49 30 1234567 is +49301234567", KEY, {})[0]
    one, two = new.split(" is ")
    assert one.replace(" ", "") == two and two.startswith("+49") and two != "+49301234567"


@pytest.mark.parametrize("card", ["3782 822463 10005", "3782-822463-10005", "3056 930902 5904"])
def test_cards(card):
    new = rewrite(f"card {card} ok", KEY, {})[0]
    assert card not in new and re.fullmatch(r"card \d{4}[ -]\d{6}[ -]\d{4,5} ok", new) and luhn(re.sub(r"\D", "", new))


@pytest.mark.parametrize(
    ("text", "roles"),
    [
        ("Mr John Paul Smith left", ["given_m:john", "given_m:paul", "surname:smith"]),
        ("Mr Smith-Jones left", ["surname:smith", "surname:jones"]),
        ("Ms O'Brien left", ["surname:o'brien"]),
        ("Ms O’Brien left", ["surname:o'brien"]),
        ("Mr Smith's car", ["surname:smith"]),
        ("Herr Jean-Luc von Berg", ["given_m:jean", "given_m:luc", "surname:berg"]),
        ("Dr. Alice Jones left", ["given_n:alice", "surname:jones"]),
        ("Prof. Dr. Anna Schmidt", ["given_f:anna", "surname:schmidt"]),
        ("Frau Dr. Schmidt", ["surname:schmidt"]),
        ("Mr John Smith came in. Smith left. John waved at SMITH.",
         ["given_m:john", "surname:smith", "surname:smith", "given_m:john", "surname:smith"]),
        ("O'Brien met Ms O’Brien", ["surname:o'brien"] * 2),
        ("Mr van der Berg left", ["surname:berg"]),
        ("Mr John F. Kennedy left", ["given_m:john", "surname:kennedy"]),
        ("Mrs J. R. Smith left", ["surname:smith"]),
    ],
)
def test_names(text, roles):
    assert [f"{e.kind}:{e.normal}" for e in entities(text)] == roles
    new = rewrite(text, KEY, {})[0]
    assert not any(re.search(rf"\b{r.split(':')[1]}\b", new, re.I) for r in roles)


@pytest.mark.parametrize(
    "text",
    ["secretary: appointments", "tokens: abcdefghij", "version 1.2.3 of 2024-05-06", "rows 100 200 300 4000 5000", "pi is 3.141 592 6535 8979",
     "+5 points, +100 more", "12 345 678 of 1 234 567", "Miss Universe and Miss America", "the secret: everything.is.fine", "token: description_of_field",
     "order 1234567890123452", "order 9876543210987659", "at 12:30:45", "std::a::b and a::b", "aa:bb:cc:dd:ee:ff", "the password is required", "a smith, a smithy",
     "isbn 978-3-16-148410-0", "3782 822463 10006", "Mr and Mrs", "a 10.125.3 b", "it cost 1.234.567,00"],
)
def test_clean_text_stays(text):
    assert rewrite(text, KEY, {}) == (text, [])


@pytest.mark.parametrize(
    "form", ["AKIA{}", "ghp_{}", "xoxb-{}", "sk_live_{}", "password is {}", "the token is '{}'.", "password: '{}'"]
)
def test_keys_told_by_their_prefix_or_in_words(form):
    secret = {"AKIA{}": "IOSFODNN7EXAMPLE", "password: '{}'": "correct-horse-battery"}.get(form, "hunter2aaaaBBBB33339999ccccDDDD55550000")
    new, found = rewrite(form.format(secret), KEY, {})
    assert [kind for kind, _, _ in found] == ["secret"] and secret not in new
    assert re.sub("[A-Za-z0-9]", "x", new) == re.sub("[A-Za-z0-9]", "x", form.format(secret)) and new.startswith(form.split("{}")[0])


@pytest.mark.parametrize("address", ["2001:db8:85a3:0:0:8a2e:370:7334", "2001:0db8:85a3::8a2e:0370:7334", "fe80::1", "2001:DB8::A:1"])
def test_long_addresses(address):
    text = f"from {address} and {address}, or"
    new, found = rewrite(text, KEY, {})
    assert [kind for kind, _, _ in found] == ["ip6"] * 2
    one, two = re.fullmatch("from (.*) and (.*), or", new).groups()
    assert one == two != address and [len(g) for g in one.split(":")] == [len(g) for g in address.split(":")]
    assert one.isupper() == address.isupper() and ipaddress.IPv6Address(one)


def test_forms_of_one_address_or_phone_keep_one_surrogate():
    short, long = rewrite("2001:db8::1 is 2001:0db8:0:0:0:0:0:0001", KEY, {})[0].split(" is ")
    assert ipaddress.IPv6Address(short) == ipaddress.IPv6Address(long)
    one, two = rewrite("0049 30 1234567 is +49301234567", KEY, {})[0].split(" is ")
    assert one.startswith("0049 ") and "+" + one[2:].replace(" ", "") == two != "+49301234567"


def test_long_words_take_linear_time():
    assert rewrite("a" * 300_000 + "1", KEY, {}) == ("a" * 300_000 + "1", [])


def test_plain_python_rewrite_equals_spark(spark):
    """Whole rewrites held against a plain walk over the entities, with attempts raised until nothing collides."""
    texts = [f"Mr {a} {b} of {k}.9.8.7, call 555-{k:03d}-0199. {b} and {a}, {a.lower()}@x{k}.org" for k, (a, b) in enumerate(
        (a, b) for a in ("John", "Paul", "Otto", "Karl", "Zed") for b in ("Smith", "Jones", "Brown", "White"))]
    texts += [None, "", "clean text", texts[0]]
    known = {(e.kind, e.normal) for t in texts for e in entities(t or "")}
    attempts = dict.fromkeys(known, 0)
    while True:
        drawn, lost = {}, set()
        for kind, normal in sorted(known):
            new = (kind, surrogate(KEY, kind, normal, attempts[kind, normal]))
            drawn.setdefault(new, []).append((kind, normal))
            if new in known:
                lost.add((kind, normal))
        lost |= {e for group in drawn.values() for e in group[1:]}
        if not lost:
            break
        for e in lost:
            attempts[e] += 1
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in replace_entities(docs, KEY).collect()}
    maps = {}
    for k, text in enumerate(texts):
        at, out = 0, ""
        for e in entities(text or ""):
            first, last = e.first, e.last
            piece = got[k].text[len(out) + first - at :]
            out += text[at:first]
            assert got[k].text.startswith(out)
            rest = text[last : last + 1]
            new = re.match(r"[^\s,]+" if e.kind in ("email", "phone", "ip") else r"\w+", piece)[0].rstrip(".")
            assert maps.setdefault((e.kind, e.normal), new.casefold()) == new.casefold()
            assert (e.kind, new.casefold()) not in known
            out, at = out + new, last
            assert got[k].text.startswith(out + rest)
        assert got[k].text == (None if text is None else out + text[at:])
    assert len(set((kind, new) for (kind, _), new in maps.items())) == len(known)

"""Personal data replaced by keyed surrogates of the same type, gender, script and format.

Detected entities are reduced to a normal form (digits of a phone, lower-case address,
part of a name). A keyed hash of kind, normal form and attempt draws the surrogate in
that form, which is then poured into the format of each occurrence: separators, upper
case, check digits and country code stay as they were. The same entity gets the same
surrogate everywhere; given name and surname are replaced apart, so that a person
met with and without the given name stays one person. Names are told by a title (Mr, Frau,
Dr); once told, they are replaced wherever the text has them again without it.

Distinctness is checked over the whole corpus: entities whose surrogate another entity
has, or which is itself an entity of the corpus, draw again with the next attempt, until
no collision is left. Only they need to be looked up when texts are rewritten; they are
joined to the texts that hold them by the text's MD5.

Texts without an entity, empty and null ones stay as they are. Copies and repeated rows get equal
texts. Texts are read whole, however long. Where entities overlap, the one found first, then the
kind listed first, stands. An empty table gives no row.
"""

from __future__ import annotations

import hashlib
import ipaddress
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.decontamination import text_key
from fleetlens.llm.shared import small, written

# Titles and the gender they tell, common given names, parts of made-up names.
TITLES = {
    "Mr": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Don": "m", "господин": "m", "Господин": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Mademoiselle": "f", "Señora": "f",
    "Señorita": "f", "Doña": "f", "госпожа": "f", "Госпожа": "f", "Dr": "n", "Prof": "n", "Professor": "n",
}
#: What a title may stand before without naming anybody.
NOBODY = "Universe World America Earth International".split()
GIVEN = {
    ("latin", "m"): "James John Robert Michael David Thomas Peter Paul Daniel Hans Karl Otto Pierre Jean Luc Carlos Juan Pablo".split(),
    ("latin", "f"): "Mary Anna Emma Laura Sarah Julia Clara Eva Helga Ingrid Marie Claire Sophie Elena Lucia Carmen Rosa Ines".split(),
    ("cyrillic", "m"): "Иван Пётр Алексей Дмитрий Сергей Андрей Николай Павел Олег Юрий Антон Борис".split(),
    ("cyrillic", "f"): "Анна Мария Ольга Елена Наталья Ирина Татьяна Светлана Юлия Вера Нина Дарья".split(),
}
#: Gender of the given names above, for titles that don't tell it.
GENDERS = {name.casefold(): gender for (_, gender), names in GIVEN.items() for name in names}
PARTS = {
    "latin": "ba be bo da del do fen ga gor ha hol ka kel lan lo mar mel na nor pa per ra ren sa sol ta ter va vel wen".split(),
    "cyrillic": "ба бе во га да де жа ка ко ла ле ма ме на но па пе ра ро са се та те ва фа".split(),
}
ENDINGS = {
    ("latin", "m"): "us", ("latin", "f"): "ina", ("latin", "n"): "is", ("latin", "s"): "man",
    ("cyrillic", "m"): "ий", ("cyrillic", "f"): "ина", ("cyrillic", "n"): "ис", ("cyrillic", "s"): "ко",
}

#: Country codes of two digits; 1 and 7 have one, all others three.
CODES = set("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
#: A word of a name: upper-case first letters, also after hyphens and apostrophes.
PART = r"[^\W\d_a-zа-я](?:\w+|['’][^\W\d_a-zа-я]\w+)(?:['’-][^\W\d_a-zа-я]\w+)*"
INITIALS = r"(?:[^\W\d_a-zа-я]\.[ ]?)*"
PARTICLES = "(?:(?:van|von|der|den|de|del|della|di|da|du|la|le|zu) )*"
INNER = "(?:(?:van|von|der|den|de|del|della|di|du) )*"
#: Issuer digits and lengths of payment cards, for runs of digits without blanks.
ISSUERS = re.compile(r"4(?:\d{12}|\d{15}|\d{18})|(?:5[1-5]|2[2-7]|35)\d{14}|3[47]\d{13}|3[0689]\d{12}|6\d{15,18}")
#: Words joined by signs name something; they are no key.
WORDS = re.compile(r"[A-Za-z]+(?:[._/-]+[A-Za-z]+)+[._/-]*")

PATTERNS = {
    "email": r"(?<![\w.%+-])[\w.%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "secret": r"(?:(?i:(?<![A-Za-z0-9])(?:token|secret|password|passwd|api[_-]?key))|(?<=[a-z0-9])(?:Token|Secret|Password|Passwd|ApiKey))"
    r"(?i:[_-]?(?:access[_-]?)?key)?[\"']?\s*[=:]\s*[\"']?(?P<value>[A-Za-z0-9_+/.-]{8,})"
    r"|\b(?i:password|passwd|passcode|passphrase|token) is [\"']?(?P<said>(?=\S*\d)[A-Za-z0-9_+/.!@#$%-]{5,}[A-Za-z0-9])"
    r"|(?<![A-Za-z0-9])(?:A[KS]IA(?P<id>[0-9A-Z]{16})|gh[oprsu]_(?P<hub>[A-Za-z0-9]{36,})|xox[abprs]-(?P<chat>[A-Za-z0-9-]{10,})"
    r"|AIza(?P<web>[A-Za-z0-9_-]{35})|[sr]k_(?:live|test)_(?P<pay>[A-Za-z0-9]{16,}))(?![A-Za-z0-9])",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "phone": r"\+\d{1,3}[^\w\n]{0,4}\(\d{2,4}\)[^\w\n]{0,4}\d{3}[ .-]\d{4}\b|\(\d{3}\) \d{3}-\d{4}\b|(?<![\w.-])\d{3}-\d{3}-\d{4}\b"
    r"|\+\d{1,3}(?:[ .-]\d{2,4}){3,4}\b(?![ .-]\d)|\+(?=(?:[ .-]?\d){8,15}(?!\w|[ .-]\d))[1-9]\d{0,5}(?:[ .-]\d{1,8}){1,5}"
    r"|(?<![\w+])\+[1-9]\d{7,14}\b|\(\d{3}\) ?\d{3}[ .-]\d{4}\b|(?<![\w.-])(?<!\d )1(?P<gap>[ .-])\d{3}(?P=gap)\d{3}(?P=gap)\d{4}(?!\w|[ .-]\d)"
    r"|(?<![\w+.-])(?<!\d )00[1-9]\d{0,2}(?:[ .-]\d{2,8}){2,4}(?!\w|[ .-]\d)"
    r"|(?<![\w.-])(?<!\d )\d{3}(?P<cut>[ .])\d{3}(?P=cut)\d{4}(?!\w|[ .-]\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<![\w.-])(?:\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}|\d{4}[ -]\d{6}[ -]\d{4,5}|\d{13,19})(?![\w])",
    "ip": r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)",
    "ip6": r"(?<![\w:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:])",
    "name": r"\b(?:" + "|".join(TITLES) + r")\.? (?:(?:Dr|Prof)\.? )*(?!(?:" + "|".join(NOBODY) + r")\b)(?P<person>"
    + PARTICLES + INITIALS + PART + "(?: " + INNER + INITIALS + PART + ")*)",
}
#: What the patterns can start with: a cheap look before each is tried.
STARTS = {
    "email": r"[\w.%+-]", "secret": "(?i:[tspagxr])", "iban": "[A-Z]", "phone": r"[+(\d]", "ssn": r"\d", "card": r"\d",
    "ip": r"\d", "ip6": "[0-9A-Fa-f]", "name": "[A-ZГг]",
}
ENTITY = re.compile("|".join(f"(?P<{kind}>(?={STARTS[kind]})(?:{pattern}))" for kind, pattern in PATTERNS.items()))
#: A text without any of this holds no entity.
HINT = r"[0-9@]|(?i:token|secret|password|passwd|key)|\b(?:" + "|".join(TITLES) + r")\b"


def luhn(digits: str) -> bool:
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


@dataclass(frozen=True)
class Entity:
    kind: str
    first: int
    last: int
    normal: str


def script(text: str) -> str:
    return "cyrillic" if re.search("[А-Яа-яЁё]", text) else "latin"


def six(value: str) -> str:
    """An IPv6 address written out, or nothing if it is none (or as short as ``a::b``)."""
    groups = [g for g in value.split(":") if g]
    if not any(c.isdigit() for c in value) or len(groups) < 4 and len(groups[0]) < 3:
        return ""
    try:
        return ipaddress.IPv6Address(value).exploded
    except ValueError:
        return ""


WORD = re.compile(r"[^\W\d_]\w+|[^\W\d_]['’][^\W\d_]\w+")


def entities(text: str) -> list[Entity]:
    """The entities of a text from left to right, without overlaps; names also where they come again without a title."""
    found = list(stated(text))
    people: dict[str, str] = {}
    for e in found:
        if e.kind == "surname" or e.kind.startswith("given"):
            people.setdefault(e.normal, e.kind)
    if not people:
        return found
    again, k = [], 0
    for word in WORD.finditer(text):
        normal = word[0].casefold().replace("’", "'")
        if normal not in people or not word[0][0].isupper():
            continue
        while k < len(found) and found[k].last <= word.start():
            k += 1
        if k == len(found) or word.end() <= found[k].first:
            again.append(Entity(people[normal], word.start(), word.end(), normal))
    return sorted(found + again, key=lambda e: e.first)


def stated(text: str) -> Iterator[Entity]:
    """The entities that their form or the words before them tell, from left to right."""
    for found in ENTITY.finditer(text):
        kind, value = found.lastgroup, found[0]
        kind = next(k for k in PATTERNS if found[k] is not None)
        first, last = found.span()
        if kind == "email":
            yield Entity(kind, first, last, value.lower())
        elif kind == "secret":
            group = next(g for g in ("value", "said", "id", "hub", "chat", "web", "pay") if found[g] is not None)
            if group != "value" or "pass" in value[: found.start("value") - first].lower() or not WORDS.fullmatch(found["value"]):
                yield Entity(kind, *found.span(group), found[group])
        elif kind == "ip6":
            if six(value):
                yield Entity(kind, first, last, six(value))
        elif kind == "name":
            title = found[0].split(" ")[0].rstrip(".")
            at = found.start("person")
            parts = list(re.finditer(PART, found["person"]))
            for part in parts:  # initials and particles stay
                gender = TITLES[title] if TITLES[title] != "n" else GENDERS.get(part[0].casefold(), "n")
                role = "surname" if part is parts[-1] else "given_" + gender
                for half in re.finditer("[^-]+", part[0]):  # of Smith-Jones each name by itself
                    start = at + part.start() + half.start()
                    yield Entity(role, start, start + len(half[0]), half[0].casefold().replace("’", "'"))
        else:
            digits = re.sub(r"\D", "", value)
            good = {
                "card": lambda: luhn(digits) and len(set(digits)) > 1 and (len(digits) < len(value) or ISSUERS.fullmatch(digits)),
                "ip": lambda: all(int(x) < 256 for x in value.split(".")),
                "iban": lambda: iban_rest(value.replace(" ", "")) == 1,
            }.get(kind, lambda: True)
            if good():
                if kind == "phone" and (value[0] == "+" or digits.startswith("00")):
                    digits = digits.removeprefix("00")
                    digits = digits if digits[0] == "1" else "+" + digits
                yield Entity(kind, first, last, value if kind == "ip" else value.replace(" ", "") if kind == "iban" else digits)


class Draw:
    """Numbers from a keyed hash of kind, normal form and attempt."""

    def __init__(self, key: bytes, kind: str, normal: str, attempt: int) -> None:
        self.key, self.seed, self.block, self.left = key, f"{kind}\x1f{normal}\x1f{attempt}".encode("utf-8", "replace"), 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 4:
            self.left += hashlib.blake2b(self.seed + self.block.to_bytes(4, "big"), key=self.key).digest()
            self.block += 1
        value, self.left = int.from_bytes(self.left[:4], "big"), self.left[4:]
        return value % n

    def of(self, choices):
        return choices[self.below(len(choices))]

    def digits(self, n: int) -> str:
        return "".join(str(self.below(10)) for _ in range(n))

    def like(self, text: str) -> str:
        """Letters for letters of the same script and case, digits for digits, the rest as it is."""
        out = []
        for c in text:
            if c.isdigit():
                out.append(self.of("0123456789"))
            elif c.isalpha():
                new = self.of("абвгдежиклмнопрстуфх" if script(c) == "cyrillic" else "abcdefghijklmnopqrstuvwxyz")
                out.append(new.upper() if c.isupper() else new)
            else:
                out.append(c)
        return "".join(out)


def surrogate(key: bytes, kind: str, normal: str, attempt: int) -> str:
    """The surrogate in normal form; later attempts may draw from a wider space."""
    draw = Draw(key, kind, normal, attempt)
    if kind == "email":
        local, _, domain = normal.partition("@")
        *names, top = domain.split(".")
        names = [draw.like(n) for n in names]
        if top in ("com", "net", "org"):  # example.* of these is reserved: nobody's address
            names[-1] = "example"
        return draw.like(local) + "abcdefgh"[: attempt // 4] + "@" + ".".join([*names, top])
    if kind == "phone":
        if normal[0] == "+":
            own = 1 + (1 if normal[1] == "7" else 2 if normal[1:3] in CODES else 3)
            return normal[:own] + draw.of("23456789") + draw.digits(len(normal) - own - 1)
        own = max(0, len(normal) - 10)
        number = draw.of("23456789") + draw.digits(len(normal) - own - 1)
        made_up = len(number) == 10 and normal[:own] in ("", "1") and attempt < 8  # exchange 555
        return normal[:own] + (number[:3] + "555" + number[6:] if made_up else number)
    if kind == "ssn":
        return "9" + draw.digits(len(normal) - 1)
    if kind == "card":
        body = normal[0] + draw.digits(len(normal) - 2)
        return body + next(c for c in "0123456789" if luhn(body + c))
    if kind == "iban":
        body = draw.like(normal[4:])
        return f"{normal[:2]}{98 - iban_rest(normal[:2] + '00' + body):02d}{body}"
    if kind == "ip":
        def octet(old: str) -> str:
            low, high = {1: (0, 9), 2: (10, 99), 3: (100, 255)}[len(str(int(old)))] if attempt < 16 else (0, 255)
            return str(low + draw.below(high - low + 1))

        return ".".join(octet(x) for x in normal.split("."))
    if kind == "ip6":  # groups that are zero stay, the others keep their length
        def group(old: str) -> str:
            size = len(old.lstrip("0"))
            return (draw.of("123456789abcdef") + "".join(draw.of("0123456789abcdef") for _ in range(size - 1))).zfill(4) if size else old

        return ":".join(group(x) for x in normal.split(":"))
    if kind == "secret":
        if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", normal):
            signs = "0123456789ABCDEF" if normal.isupper() else "0123456789abcdef"
            return "".join(draw.of(signs) for _ in normal)
        return draw.like(normal)
    letters, gender = script(normal), "s" if kind == "surname" else kind[-1]
    if (letters, gender) in GIVEN and attempt == 0:
        return draw.of(GIVEN[letters, gender]).casefold()
    return "".join(draw.of(PARTS[letters]) for _ in range(2 + attempt // 3)) + ENDINGS[letters, gender]


def poured(kind: str, original: str, new: str) -> str:
    """A surrogate in the format of one occurrence."""
    if kind in ("phone", "ssn", "card"):
        abroad = "00" if kind == "phone" and re.sub(r"\D", "", original).startswith("00") else ""
        digits = iter(abroad + new.lstrip("+"))
        return "".join(next(digits) if c.isdigit() else c for c in original)
    if kind == "iban":
        signs = iter(new)
        return "".join(c if c == " " else next(signs) for c in original)
    if kind == "ip6":
        left, _, right = original.partition("::")
        groups, tail = new.split(":"), right.split(":") if right else []
        sides = left.split(":"), tail
        places = zip(sides, (groups, groups[len(groups) - len(tail) :]), strict=True)
        poured_sides = [":".join(g.lstrip("0").zfill(len(old)) for old, g in zip(olds, news, strict=False)) for olds, news in places]
        written_out = ("::" if "::" in original else "").join(poured_sides)
        return written_out.upper() if any(c in "ABCDEF" for c in original) else written_out
    if kind == "email" and original.isupper():
        return new.upper()
    if kind == "surname" or kind.startswith("given"):
        return new.upper() if original.isupper() else new.capitalize()
    return new


def rewrite(text: str, key: bytes, attempts: dict[str, int]) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with surrogates, and (kind, first, last) of every entity in the old text."""
    out, done, found = [], 0, []
    for e in entities(text):
        new = surrogate(key, e.kind, e.normal, attempts.get(f"{e.kind}:{e.normal}", 0))
        out += [text[done : e.first], poured(e.kind, text[e.first : e.last], new)]
        done = e.last
        found.append((e.kind, e.first, e.last))
    return "".join([*out, text[done:]]), found


def _suspect(text: Column) -> Column:
    return F.when(text.rlike(HINT), text)


def found_entities(docs: DataFrame) -> DataFrame:
    """(key, kind, normal): the distinct entities of every text; key is the text's MD5."""

    @F.pandas_udf("array<struct<kind:string,normal:string>>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([sorted({(e.kind, e.normal) for e in entities(t)}) for t in texts], dtype=object)

    texts = docs.select(_suspect(F.col("text")).alias("text")).where("text IS NOT NULL")
    return texts.select(text_key(F.col("text")).alias("key"), F.inline(find("text"))).distinct()


def resolved(known: DataFrame, key: bytes, rounds: int = 200) -> DataFrame:
    """(kind, normal, attempt) of all entities (kind, normal), such that no two share a surrogate."""

    @F.pandas_udf("string")
    def draw(kinds: pd.Series, normals: pd.Series, attempts: pd.Series) -> pd.Series:
        return pd.Series([surrogate(key, k, n, a) for k, n, a in zip(kinds, normals, attempts, strict=True)], dtype=object)

    real = known.select(F.col("kind").alias("k"), F.col("normal").alias("taken"))
    state = known.select("kind", "normal", F.lit(0).alias("attempt"), F.lit(0).alias("moved"))
    for _ in range(rounds):
        drawn = written(state.withColumn("new", draw("kind", "normal", "attempt")), "surrogates")
        winner = drawn.groupBy("kind", "new").agg(F.min(F.struct("moved", "normal"))["normal"].alias("winner"))
        taken = drawn.join(real, (drawn["kind"] == real["k"]) & (drawn["new"] == real["taken"]), "left_semi")
        lost = (
            drawn.join(winner, ["kind", "new"]).where("normal <> winner").select("kind", "normal")
            .unionByName(taken.select("kind", "normal")).distinct()
        )
        lost = written(lost.withColumn("again", F.lit(1)), "collisions")
        if lost.isEmpty():
            return drawn.select("kind", "normal", "attempt")
        state = drawn.join(lost, ["kind", "normal"], "left").select(
            "kind", "normal",
            (F.col("attempt") + F.coalesce("again", F.lit(0))).alias("attempt"),
            F.coalesce("again", F.lit(0)).alias("moved"),
        )
    raise ValueError(f"surrogates still collide after {rounds} rounds")


def replace_entities(docs: DataFrame, key: bytes, max_broadcast: int = 100_000) -> DataFrame:
    """The documents with ``text`` rewritten, and ``entities`` array<struct<kind, first, last>>."""
    found = written(found_entities(docs), "entities")
    attempts = resolved(found.select("kind", "normal").distinct(), key).where("attempt > 0")
    later = (
        found.join(attempts, ["kind", "normal"])
        .groupBy(F.col("key").alias("__key"))
        .agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.concat_ws(":", "kind", "normal"), "attempt")))).alias("__later"))
    )
    later = small(written(later, "attempts"), max_broadcast)

    @F.pandas_udf("text string, found array<struct<kind:string,first:int,last:int>>")
    def apply(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, laters in batches:
            out = [
                (None, []) if t is None else rewrite(t, key, json.loads(a) if a else {})
                for t, a in zip(texts, laters, strict=True)
            ]
            yield pd.DataFrame(out, columns=["text", "found"])

    joined = docs.join(later, text_key(docs["text"]) == F.col("__key"), "left")
    done = joined.withColumn("__new", apply(_suspect(F.col("text")), F.col("__later")))
    return done.withColumns({"text": F.coalesce("__new.text", "text"), "entities": F.col("__new.found")}).drop("__new", "__key", "__later")

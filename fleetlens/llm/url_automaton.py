"""URL filter: all glob rules at once in a bit-parallel automaton.

A rule is a glob over the canonical URL ``.host`` + separator + ``path``. ``*`` stands for
any run, ``?`` for any one byte. All rules are packed into one row of 64-bit words, a
start bit and a bit per symbol each. Reading a byte shifts the row by one bit (with carry
from word to word), keeps the states that the byte allows, and keeps the states before a
``*``. The URLs of a batch step together in numpy; a batch holds as many as fit ``STATE_BYTES``.
Rules are a tuple, or come from a table of any length that fits a task (``rules_of``).

Rules of the list decide first, the longest wins; a URL that none fits is judged by the
method's own globs: block if one matches, else allow. A null URL, or one without ``://``,
has an empty host and path, fits no rule and is allowed. Rows are judged one by one, repeated
ones alike; an empty table gives no row. Of rules of equal length that fit a URL the
alphabetically first decides. A
very long URL is stepped through in stripes, so it doesn't widen the grid of its batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = 256
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STAR, ANY = -1, -2
STRIPE = 1024


@dataclass(frozen=True)
class Rule:
    """``host`` and all its subdomains, below ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def symbols(self) -> list[int]:
        return [STAR, *f".{self.host}".encode(), SEPARATOR, *self.path.encode(), STAR]


RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)

# Fixed values. Blocked anywhere in a host, and only as a whole word of it (not in "alphabets").
ANYWHERE = ("casino", "poker", "porn", "phish", "malware")
WHOLE = ("bets", "betting", "pills", "adult", "spam", "ads", "tracker")

# (host glob, path glob): the method's own block list.
BLOCKED = (
    *[(f"*{word}*", "*") for word in ANYWHERE],
    *[(f"*{before}{word}{after}", "*") for word in WHOLE for before in ".-" for after in (".*", "-*", "")],
    ("*", "*/ads/*"),
    ("*", "*.exe"),
    ("*", "*.apk"),
)


def glob_symbols(host: str, path: str) -> list[int]:
    wild = {ord("*"): STAR, ord("?"): ANY}
    sides = [[wild.get(b, b) for b in part.encode()] for part in (host, path)]
    return [*sides[0], SEPARATOR, *sides[1]]


class Automaton:
    """Shift-And over several words of 64 bits for a list of symbol sequences."""

    def __init__(self, patterns: list[list[int]]) -> None:
        states = sum(1 + sum(s != STAR for s in p) for p in patterns)
        self.width = max(1, -(-states // 64))
        self.allowed = np.zeros((SEPARATOR + 1, self.width), np.uint64)
        self.start, self.loop = np.zeros(self.width, np.uint64), np.zeros(self.width, np.uint64)
        self.final: list[tuple[int, np.uint64]] = []
        at = 0
        for pattern in patterns:
            self._set(self.start, at)
            for symbol in pattern:
                if symbol == STAR:
                    self._set(self.loop, at)
                    continue
                at += 1
                for code in range(SEPARATOR) if symbol == ANY else (symbol,):
                    self._set(self.allowed[code], at)
            self.final.append((at // 64, np.uint64(1 << at % 64)))
            at += 1

    @staticmethod
    def _set(words: np.ndarray, bit: int) -> None:
        words[bit // 64] |= np.uint64(1 << bit % 64)

    def matches(self, codes: list[np.ndarray]) -> np.ndarray:
        """(text, pattern) whether the pattern fits the whole text."""
        lengths = np.array([len(c) for c in codes], np.int64)
        order = np.argsort(-lengths, kind="stable")
        longest = int(lengths.max(initial=0))
        state = np.tile(self.start, (len(codes), 1))
        if not self.final:
            return np.empty((len(codes), 0), bool)
        active = len(codes) - np.searchsorted(np.sort(lengths), np.arange(longest), side="right")
        for first in range(0, longest, STRIPE):
            grid = np.zeros((active[first], min(STRIPE, longest - first)), np.int16)
            for row, k in enumerate(order[: active[first]]):
                part = codes[k][first : first + STRIPE]
                grid[row, : len(part)] = part
            for j in range(grid.shape[1]):
                n = active[first + j]
                now = state[:n]
                shifted = now << np.uint64(1)
                shifted[:, 1:] |= now[:, :-1] >> np.uint64(63)
                state[:n] = (shifted & self.allowed[grid[:n, j]]) | (now & self.loop)
        out = np.empty((len(codes), len(self.final)), bool)
        for k, (word, bit) in enumerate(self.final):
            out[order, k] = (state[:, word] & bit) != 0
        return out


def canonical(host: str, path: str) -> np.ndarray:
    """Codes of ``.host``, the separator and ``path``."""
    sides = [np.frombuffer(s.encode("utf-8", "replace"), np.uint8).astype(np.int16) for s in ("." + host, path)]
    return np.concatenate([sides[0], np.array([SEPARATOR], np.int16), sides[1]])


PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


#: URLs that step together, and the bytes that their states may take.
BATCH, STATE_BYTES = 4096, 1 << 22


def rules_of(rows: DataFrame, most: int = 100_000) -> tuple[Rule, ...]:
    """Rules of a table (host, path, verdict), which must have at most ``most`` rows.

    Hosts are lower-cased (A-Z) and lose a leading dot; a null path is any path. Rows
    without a host are left out. Two verdicts for one rule, or a verdict other than block and
    allow, are an error.
    """
    host = F.regexp_replace(F.translate("host", UPPER, LOWER), r"^\.", "")
    rows = rows.select(host.alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").where("host <> ''")
    found = rows.distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} rules")
    rules = tuple(sorted((Rule(*r) for r in found), key=lambda r: (r.name, str(r.verdict))))
    for rule, following in zip(rules, (*rules[1:], None), strict=True):
        if rule.verdict not in ("block", "allow") or following and (rule.host, rule.path) == (following.host, following.path):
            raise ValueError(f"not one verdict, block or allow, for {rule.name}")
    return rules


def judge_urls(
    pages: DataFrame, rules: tuple[Rule, ...] = RULES, blocked: tuple[tuple[str, str], ...] = BLOCKED, url_col: str = "url"
) -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` and ``verdict`` to every row."""
    listed = sorted(rules, key=lambda r: (-len(r.name), r.name))
    patterns = [r.symbols() for r in listed] + [glob_symbols("*" if h == "*" else h, p) for h, p in blocked]

    @F.pandas_udf("rule string, verdict string")
    def verdicts(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        automaton = Automaton(patterns)
        step = max(1, min(BATCH, STATE_BYTES // (8 * automaton.width)))
        for hosts, paths in batches:
            out = []
            for i in range(0, len(hosts), step):
                codes = [canonical(h, p) for h, p in zip(hosts[i : i + step], paths[i : i + step], strict=True)]
                for hit in automaton.matches(codes):
                    first = int(hit.argmax()) if hit.any() else len(patterns)  # listed rules come first, the longest before
                    own = "block" if first < len(patterns) else "allow"
                    out.append((listed[first].name, listed[first].verdict) if first < len(listed) else (None, own))
            yield pd.DataFrame(out, columns=["rule", "verdict"])

    parts = pages.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))})
    judged = parts.withColumn("__judged", verdicts("host", "path"))
    return judged.withColumns({"rule": F.col("__judged.rule"), "verdict": F.col("__judged.verdict")}).drop("__judged")

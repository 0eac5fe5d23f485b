"""Personal data in texts, also where it is written in disguise."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import pairwise

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

# What each kind looks like.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A run of digits is tried from its start only: what follows it decides for all of it.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

# Number words in English, German, French and Spanish.
NUMBERS = {
    "0": ("zero", "oh", "null", "zéro", "cero"),
    "1": ("one", "eins", "un", "une", "uno"),
    "2": ("two", "zwei", "zwo", "deux", "dos"),
    "3": ("three", "drei", "trois", "tres"),
    "4": ("four", "vier", "quatre", "cuatro"),
    "5": ("five", "fünf", "cinq", "cinco"),
    "6": ("six", "sechs", "seis"),
    "7": ("seven", "sieben", "sept", "siete"),
    "8": ("eight", "acht", "huit", "ocho"),
    "9": ("nine", "neun", "neuf", "nueve"),
}
# Letters of other scripts that look like Latin ones.
LOOKALIKES = str.maketrans("АВЕКМНОРСТХУаеорсухіјѕԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧονі․。﹒﹫", "ABEKMHOPCTXYaeopcyxijsdqwABEZHIKMNOPTYXovi...@")
HIDDEN = "­​‌‍⁠﻿"

WORD_DIGIT = {w: d for d, words in NUMBERS.items() for w in words}
_D = "(?:" + "|".join(sorted(WORD_DIGIT, key=len, reverse=True)) + ")"
DOT_WORDS = ("dot", "punkt", "point", "punto")
_DOT = "(?:" + "|".join(DOT_WORDS) + ")"
ODD = re.compile("[" + re.escape("".join(map(chr, LOOKALIKES)) + HIDDEN) + "！-～٠-٩۰-۹०-९\U0001d7ce-\U0001d7ff]")
BRACKETED = re.compile(rf"[\[({{<][\x20\t]?(?:(?P<at>at|arroba|@)|(?P<dot>{_DOT}|\.))[\x20\t]?[\])}}>]", re.I)
_AFTER_AT = rf"[A-Za-z0-9-]+(?:[\x20]{_DOT}[\x20]|\.)[A-Za-z0-9-]"
SPACED_AT = re.compile(rf"(?<=[A-Za-z0-9_%+-])\x20at\x20(?={_AFTER_AT})", re.I)
#: Letters one by one in front of an at sign in brackets.
SPACED_NAME = re.compile(r"(?<![A-Za-z0-9])[A-Za-z0-9](?:\x20[A-Za-z0-9]){2,}(?=\x20?[\[({<][\x20\t]?(?:at|arroba|@)[\x20\t]?[\])}>])", re.I)
SPACED_DOT = re.compile(rf"(?<=[A-Za-z0-9-])\x20{_DOT}\x20(?=[A-Za-z0-9])", re.I)
SPELLED = re.compile(rf"(?:\b(?:plus|más|mas)[\x20-]+)?\b(?:{_D}|[0-9]+)(?:(?:[\x20,-]{{1,2}}|[\x20]{_DOT}[\x20])(?:{_D}|[0-9]+)\b){{3,}}", re.I)
SPELLED_PART = re.compile(rf"(?P<plus>\b(?:plus|más|mas)[\x20-]+)|(?P<digit>{_D})|(?P<dot>[\x20]{_DOT}[\x20])|(?P<gap>[\x20,-]{{1,2}})|[0-9]+", re.I)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Find e-mail addresses, IP addresses, card and phone numbers in every whole text.

    Base spans are those of the plain patterns, leftmost and not overlapping within a kind.
    Besides, texts that hold lookalike letters, hidden characters, odd digits, spelled
    digits, or at and dot in brackets or between spaces are rewritten to plain form, and
    each written character remembers where it came from. What the patterns find there with
    a rewritten character in it is added, unless a base span of its kind covers it; a base span
    that is part of a longer disguised one stays beside it.

    Positions are code points, the end excluded. A null text counts as empty and has no
    spans; rows pass one by one, so repeated rows give repeated rows; ids may be null;
    other columns are ignored.

    Returns doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256 of the base
    spans as kind:start:end joined by commas, spans (all of them, joined likewise), n_added.
    """
    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, n_added long"

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found = [spans(t) for t in rows.pop("text")]
            for k, kind in enumerate(KINDS):
                rows[f"n_{kind}"] = [len(base[k]) for base, _ in found]
            rows["base_sha256"] = [hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found]
            rows["spans"] = [written([sorted(b + m) for b, m in zip(base, more, strict=True)]) for base, more in found]
            rows["n_added"] = [sum(map(len, more)) for _, more in found]
            yield rows

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInPandas(scan, schema)


Spans = list[list[tuple[int, int]]]


def written(found: Spans) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, own in zip(KINDS, found, strict=True) for a, b in own)


def spans(text: str) -> tuple[Spans, Spans]:
    """Base spans and added spans, by kind."""
    base = detect(text)
    changes = rewrites(text)
    more: Spans = [[] for _ in KINDS]
    if changes:
        plain, begin, end, changed = apply(text, changes)
        for k, own in enumerate(detect(plain)):
            for a, b in own:
                lo, hi = begin[a], end[b - 1]
                if changed[b] > changed[a] and not any(x <= lo and hi <= y for x, y in base[k]):
                    more[k].append((lo, hi))
    return base, more


def detect(text: str) -> Spans:
    emails = list(_emails(text)) if "@" in text else []
    if not DIGIT.search(text):
        return [emails, [], [], []]
    ips = [m.span() for m in IP.finditer(text) if all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in m[0].split(".")))]
    cards = [m.span() for m in CARD.finditer(text) if is_card(m[0])]
    phones = [m.span() for m in PHONE.finditer(text) if 8 <= sum(map(m[0].count, "0123456789")) <= 15] if "+" in text else []
    return [emails, ips, cards, phones]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in LOCAL:
            begin -= 1
        found = DOMAIN.match(text, at + 1) if begin < at else None
        if found:
            yield begin, found.end()
        done = found.end() if found else at
        at = text.find("@", max(done, at + 1))


def is_card(text: str) -> bool:
    """16 to 19 digits whose Luhn sum is right."""
    digits = [int(c) for c in text if c not in " -"] if len(text) <= 37 else []
    if not 16 <= len(digits) <= 19:
        return False
    twice = [d * 2 - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(digits[-1::-2]) + sum(twice)) % 10 == 0


def rewrites(text: str) -> list[tuple[int, int, str]]:
    """What to write instead of what: (start, end, text), in order and not overlapping."""
    found = []
    if not text.isascii():
        for m in ODD.finditer(text):
            c = m[0]
            found.append((*m.span(), "" if c in HIDDEN else c.translate(LOOKALIKES) if ord(c) in LOOKALIKES else unicodedata.normalize("NFKC", c) if c >= "！" else str(unicodedata.digit(c))))
    disguised = False
    if any(c in text for c in "[({<"):
        for m in BRACKETED.finditer(text):
            lo, hi = m.span()
            lo -= lo > 0 and text[lo - 1] in " \t"
            hi += text[hi : hi + 1] in (" ", "\t")
            found.append((lo, hi, "@" if m["at"] else "."))
            disguised = True
        for m in SPACED_NAME.finditer(text):
            found += [(k, k + 1, "") for k in range(m.start() + 1, m.end(), 2)]
    for m in SPACED_AT.finditer(text):
        found.append((*m.span(), "@"))
        disguised = True
    if disguised:
        found += [(*m.span(), ".") for m in SPACED_DOT.finditer(text)]
    for run in SPELLED.finditer(text) if has_spelled(text) else ():
        parts = list(SPELLED_PART.finditer(text, *run.span()))
        kinds = [p.lastgroup for p in parts]
        if max(kinds.count("digit"), kinds.count("dot")) < 3:
            continue
        for k, p in enumerate(parts):
            between = 0 < k < len(parts) - 1 and "digit" in (kinds[k - 1], kinds[k + 1])
            if kinds[k] == "digit":
                found.append((*p.span(), WORD_DIGIT[p[0].lower()]))
            elif kinds[k] == "plus":
                found.append((*p.span(), "+"))
            elif kinds[k] == "dot":
                found.append((*p.span(), "."))
            elif kinds[k] == "gap" and between:
                found.append((*p.span(), ""))
    found.sort()
    kept: list[tuple[int, int, str]] = []
    for x in found:
        if not kept or x[0] >= kept[-1][1]:
            kept.append(x)
    return kept


def has_spelled(text: str) -> bool:
    """Whether three number words, or three dots in words, stand between numbers only."""
    run = dots = 0
    for w in text.lower().replace("-", " ").replace(",", " ").split():
        if w in WORD_DIGIT:
            run += 1
        elif w in DOT_WORDS:
            dots += 1
        elif not w.isdigit():
            run = dots = 0
        if max(run, dots) == 3:
            return True
    return False


def apply(text: str, changes: list[tuple[int, int, str]]) -> tuple[str, array, array, array]:
    """The rewritten text; where each character begins and ends in the source; and how many
    characters before each place are rewritten or follow a deletion."""
    parts, begin, end, counts, total = [], array("q"), array("q"), array("q", [0]), 0
    edges = [(0, 0, ""), *changes, (len(text), len(text), "")]
    for (_, lo, _), (hi, upto, new) in pairwise(edges):
        parts += [text[lo:hi], new]
        begin.extend(range(lo, hi))
        end.extend(range(lo + 1, hi + 1))
        counts.extend([total] * (hi - lo))
        total += hi < upto
        begin.extend([hi] * len(new))
        end.extend([upto] * len(new))
        counts.extend([total] * len(new))
    return "".join(parts), begin, end, counts

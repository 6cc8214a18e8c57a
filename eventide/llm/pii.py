"""Personal data by anchor expansion (operator 2).

One Aho-Corasick automaton finds the anchors of a text in a single pass:
at-signs, plus signs, digits, URL schemes and cues of identifiers and streets.
At each anchor a local, deterministic parser expands to both sides and
validates what it finds; text without anchors costs only the automaton's pass.

Base kinds, leftmost and non-overlapping within a kind: ``email``, ``ip`` (parts
up to 255), ``card`` (13 to 19 digits, Luhn), ``phone`` (9 to 15 digits). A
candidate that fails validation is dropped and its text is not tried again.
Kinds that the anchors add: ``url`` (scheme, optional user part, host),
``account`` (the value after a cue such as "password" or "IBAN"; an IBAN must
pass its mod-97 check; other values run to a blank, quote, bracket, comma or
semicolon and have a digit) and ``address`` (house number, capitalised names, street
word). Offsets are code points, ends exclusive.

Null and empty texts have no spans. Repeated rows are searched one by one;
extra columns are not read. Parsers read each stretch of text a bounded number
of times, so very long texts cost time in proportion.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import worker_cache

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account", "address")

# What follows a cue is an identifier of a person or an account.
CUES = ("iban", "account", "acct", "passport", "ssn", "password", "passwd", "secret", "token", "api key", "api_key", "apikey", "access key", "access_key")
STREETS = ("street", "avenue", "road", "lane", "boulevard", "square")
SCHEMES = ("http://", "https://", "ftp://", "ssh://", "mailto:")

ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
DIGITS = re.compile(r"[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LEAD = re.compile(r"(?i:\s{0,2}(?:no\.|(?:no|number|id|is)(?![a-z0-9])|[:=#])){0,3}\s{0,2}[\"']?")
VALUE = re.compile(r"[A-Za-z0-9](?:[^\s\"'<>,;()]*[^\s\"'<>,;().!?:])?")
LEAST_VALUE = 6
URL = re.compile(r"(?:[A-Za-z0-9._~%!$&'*+,;=:-]{1,256}@)?[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})*(?::[0-9]{1,5})?(?:[/?#][^\s\"'<>]*)?")
MAILTO = re.compile(r"[A-Za-z0-9._%+-]{1,256}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})+")
IBAN = re.compile(r"([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
NUMBER_AND_NAMES = re.compile(r"[0-9]{1,5}[a-zA-Z]?\s(?:[A-Z][\w'-]{0,30}\s){1,5}$")


def automaton():
    import ahocorasick

    found = worker_cache().get(("pii",))
    if found is None:
        found = ahocorasick.Automaton()
        for kind, words in (("email", "@"), ("phone", "+"), ("digit", "0123456789"), ("url", SCHEMES)):
            for word in words:
                found.add_word(word, (kind, len(word)))
        for kind, words in (("account", CUES), ("address", STREETS)):
            for word in words:
                found.add_word(word, (kind, len(word)))
        found.make_automaton()
        worker_cache()[("pii",)] = found
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def iban(value: str) -> bool:
    value = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end), ordered by kind as in KINDS, then start."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    after = dict.fromkeys((*KINDS, "digits"), 0)  # where the next search of a kind begins
    dead = 0  # up to here stands a value that was no account
    lower = text.lower() if text.isascii() else text.translate(ASCII_LOWER)  # as long as the text
    for last, (kind, size) in automaton().iter(lower):
        at = last - size + 1
        if kind == "digit":
            if at >= after["ip"]:
                m = IP.match(text, at)
                if m:
                    after["ip"] = m.end()
                    if all(len(p) <= 3 and int(p or 0) <= 255 for p in (p.lstrip("0") for p in m[0].split("."))):
                        found["ip"].append(m.span())
                else:  # no start inside this run of digits can match either
                    after["ip"] = DIGITS.match(text, at).end()
            if at >= after["card"]:
                m = CARD.match(text, at)
                if m:
                    after["card"] = m.end()
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 13 <= len(digits) <= 19 and luhn(digits):
                        found["card"].append(m.span())
        elif kind == "email":
            start = at
            while start > after["email"] and text[start - 1] in LOCAL:
                start -= 1
            m = DOMAIN.match(text, at + 1) if start < at else None
            if m:
                after["email"] = m.end()
                found["email"].append((start, m.end()))
        elif kind == "phone":
            m = PHONE.match(text, at) if at >= after["phone"] else None
            if m:
                after["phone"] = m.end()
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    found["phone"].append(m.span())
        elif at < after[kind]:
            continue
        elif kind == "url":
            m = (MAILTO if text[last] == ":" else URL).match(text, last + 1)
            if m:
                after["url"] = m.end()
                found["url"].append((at, m.end()))
        elif kind == "account":
            if at and text[at - 1].isalnum():
                continue
            numbered, begin = lower[at : last + 1] == "iban", LEAD.match(text, last + 1).end()
            m = (IBAN if numbered else VALUE).match(text, begin) if numbered or begin >= dead else None
            if m and (iban(m[0]) if numbered else len(m[0]) >= LEAST_VALUE and any(c.isdigit() for c in m[0])):
                after["account"] = m.end()
                found["account"].append(m.span())
            elif m and not numbered:
                dead = m.end()  # any value that begins inside lacks the same
        else:
            left = max(after["address"], at - 170)
            m = NUMBER_AND_NAMES.search(text[left:at])
            if m and not text[last + 1 : last + 2].isalnum():
                after["address"] = last + 1
                found["address"].append((left + m.start(), last + 1))
    return [(k, s, e) for k in KINDS for s, e in found[k]]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def personal_data(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, spans (array of kind, start, end): one row per row of ``docs``."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [[{"kind": k, "start": s, "end": e} for k, s, e in spans_of(t.as_py() or "")] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cells, kind)], names=["_id", "spans"])

    rows = docs.select(F.col(id_column).cast("long").alias("_id"), F.col(text).cast("string").alias("_text"))
    found = rows.mapInArrow(run, "_id long, spans array<struct<kind: string, start: long, end: long>>")
    return found.withColumnRenamed("_id", id_column)


def digest(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(joined([x for x in spans if x[0] in BASE_KINDS]).encode()).hexdigest()

"""Personal data: patterns propose, checksums confirm, words nearby adjust the score."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "ssn", "local_phone")
KINDS = BASE_KINDS + ADDED_KINDS
ACCEPT = 0.5
NEAR = 40  # code points before a span in which context words are looked for

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)+")  # begins only where a run of digits does, so that each is read once
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{2,4}){3,8}(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
LOCAL_PHONE = re.compile(r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9.-])")
DIGIT = re.compile(r"[0-9]")

# Words that speak for a kind when they stand shortly before it.
CONTEXT = {
    "email": ("mail", "contact", "write to"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "visa", "mastercard", "credit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"),
    "ssn": ("ssn", "social security", "social-security"),
    "local_phone": ("phone", "tel", "call", "mobile", "fax"),
}
# Score of a confirmed span, and what a context word adds. Base kinds count
# without any; a social security number or a local phone number needs one.
SCORE = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.3, "local_phone": 0.3}
BONUS = 0.3


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    value = 0
    for c in iban[4:] + iban[:4]:
        n = int(c, 36)
        value = (value * (10 if n < 10 else 100) + n) % 97
    return value == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Found from each @ outwards, so a long run without one costs nothing."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Each four parts of a run of dotted numbers are one match; a run is read once."""
    for run in DOTTED.finditer(text):
        parts, start = run.group().split("."), run.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = start + sum(map(len, four)) + 3
            if all(map(_small, four)):
                yield start, end
            start = end + 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def spans_of(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) of a whole text by start, then kind; code points, end exclusive.

    Base kinds are always kept. Added kinds must pass their validator, must
    reach `ACCEPT` with their context, and must not overlap a base span. A null
    or empty text has none.
    """
    if not text:
        return []
    found = [("email", s, e) for s, e in emails(text)]
    if DIGIT.search(text):
        found += [("ip", s, e) for s, e in addresses(text)]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m.group())) <= 19 and luhn(d):
                found.append(("card", m.start(), m.end()))
        if "+" in text:
            found += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]
        taken = sorted((s, e) for _, s, e in found)
        starts, reach = [s for s, _ in taken], list(accumulate((e for _, e in taken), max))
        free = lambda s, e: not (k := bisect_left(starts, e)) or reach[k - 1] <= s
        added = []
        for m in IBAN.finditer(text):
            plain = m.group().replace(" ", "")
            if 15 <= len(plain) <= 34 and mod97(plain):
                added.append(("iban", m.start(), m.end()))
        for m in SSN.finditer(text):
            area, group, serial = m.groups()
            if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
                added.append(("ssn", m.start(), m.end()))
        added += [("local_phone", m.start(), m.end()) for m in LOCAL_PHONE.finditer(text)]
        found += [x for x in added if free(x[1], x[2])]
    out = []
    for kind, start, end in found:
        before = text[max(0, start - NEAR) : start].lower()
        score = min(1.0, SCORE[kind] + BONUS * any(re.search(rf"\b{w}", before) for w in CONTEXT[kind]))
        if kind in BASE_KINDS or score >= ACCEPT:
            out.append((kind, start, end, round(score, 3)))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def find_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, spans (kind, start, end, score): personal data of every whole text; one pass, no shuffle."""

    def run(batches):
        for batch in batches:
            found = [
                [{"kind": k, "start": s, "end": e, "score": p} for k, s, e, p in spans_of(x.as_py())] for x in batch.column(1)
            ]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=["key", "spans"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = "array<struct<kind: string, start: bigint, end: bigint, score: double>>"
    return rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, spans {kind}").withColumnRenamed("key", key)


def redacted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, text with every span replaced by its kind in angle brackets; overlapping spans become one.

    One row per row of `docs`. Null texts stay null, empty ones empty.
    """

    def run(batches):
        for batch in batches:
            out = []
            for x in batch.column(1):
                value, done, parts = x.as_py(), 0, []
                for kind, start, end, _ in spans_of(value):
                    if start >= done:
                        parts += [value[done:start], f"<{kind}>"]
                    done = max(done, end)
                out.append(None if value is None else "".join(parts) + value[done:])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["key", "text"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    done = rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, text string")
    return done.select(F.col("key").alias(key), F.col("text").alias(text))

"""Personal data: patterns propose spans, checksums confirm them, context words near them move the score.

Base kinds (email, ip, card, phone) are reported whenever their check holds. Further kinds are reported when their
score reaches ``THRESHOLD``: a pattern alone starts low, a passed checksum raises it (IBAN: the length of its country and
mod 97; card numbers of other lengths: Luhn; cpf, dni and nir, the person numbers of Brazil, Spain and France: their check
digits or letter), words of ``CONTEXT`` within ``NEAR`` characters raise it again, and words of ``AGAINST`` lower it.
A base span is reported whatever its score.

A null text counts as empty and has no spans; a table without rows gives none. Spans are code points, the end exclusive. Every row is treated by
itself, so repeated rows and ids stay; other columns, whatever their names, are carried by ``redact`` and dropped by
``detect``. All scans are linear in the length of the text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm.common import ship, table

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "account", "local_phone", "cpf", "dni", "nir")
THRESHOLD = 0.5
NEAR = 48
#: Words that speak for a kind when they stand near a span of it.
CONTEXT = {
    "email": {"email", "mail", "contact", "courriel", "correo"},
    "ip": {"ip", "host", "address", "server", "adresse"},
    "card": {"card", "visa", "mastercard", "credit", "debit", "carte", "karte", "tarjeta"},
    "phone": {"phone", "tel", "telephone", "mobile", "call", "fax", "telefon", "tél", "teléfono"},
    "iban": {"iban", "bank", "account", "konto", "compte", "cuenta"},
    "ssn": {"ssn", "social", "security"},
    "account": {"card", "amex", "credit", "debit", "account", "konto", "karte", "carte", "tarjeta"},
    "local_phone": {"phone", "tel", "telephone", "mobile", "call", "fax", "telefon", "tél", "teléfono"},
    "cpf": {"cpf", "cadastro", "contribuinte"},
    "dni": {"dni", "nif", "documento", "identidad"},
    "nir": {"nir", "sécurité", "sociale", "insee", "sécu"},
}
#: Words near a span that tell of numbers of things, for all kinds but e-mail and ip.
AGAINST = {"isbn", "sku", "part", "serial", "version", "tracking", "invoice", "model", "example", "sample"}
#: Score of a span whose pattern and check hold, and what context adds.
START = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.3, "account": 0.3, "local_phone": 0.3,
         "cpf": 0.6, "dni": 0.3, "nir": 0.6}
BOOST = DROP = 0.3

# Characters of an IBAN by country.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22,
    "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20,
    "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18,
    "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24, "SC": 31,
    "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29,
    "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}
DNI_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"


DIGIT = re.compile(r"[0-9]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin at the first digit of a run: what follows a greedy match is no digit.
IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Written in capitals or in small letters throughout.
IBAN = re.compile(
    r"(?<![A-Za-z0-9])(?:[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?|"
    r"[a-z]{2}[0-9]{2}(?:\x20?[a-z0-9]{4}){2,7}(?:\x20?[a-z0-9]{1,3})?)(?![A-Za-z0-9])"
)
#: Where a shorter number can end: with a group, and before what is no letter or digit.
IBAN_END = re.compile(r"(?<=[A-Za-z0-9])(?![A-Za-z0-9])")
SSN = re.compile(r"[0-9](?<![0-9-].)[0-9]{2}-[0-9]{2}-[0-9]{4}(?![0-9-])")
LOCAL_PHONE = re.compile(r"(?<![0-9+.-])\(?0?[0-9]{2,4}\)?[\x20./-][0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9.-])")
CPF = re.compile(r"(?<![0-9.-])([0-9]{3})\.([0-9]{3})\.([0-9]{3})-([0-9]{2})(?![0-9-])")
DNI = re.compile(r"(?<![A-Za-z0-9])([0-9]{8})-?([A-Z])(?![A-Za-z0-9])")
NIR = re.compile(r"(?<![0-9])([12](?:\x20?[0-9]{2}){3}(?:\x20?[0-9]{3}){2})\x20?([0-9]{2})(?![0-9])")
WORDS = re.compile(r"\w+")
DOUBLED = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)

Span = tuple[str, int, int]
SCHEMA = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, scores array<double>"
)


def luhn(digits: str) -> bool:
    values = [ord(d) - 48 for d in reversed(digits)]
    return (sum(values[::2]) + sum(DOUBLED[v] for v in values[1::2])) % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Of each candidate the part from its start that has its country's length, ends with a group and holds mod 97. The
    search goes on behind it or, where none does, at the next word."""
    at = 0
    while m := IBAN.search(text, at):
        length = IBAN_LENGTH.get(m.group()[:2].upper(), 0)
        at = m.start() + 1
        for end in {e.start() for e in IBAN_END.finditer(text, m.start() + length, m.end() + 1)} | {m.end()} if length else ():
            number = text[m.start() : end].replace(" ", "").upper()
            if end <= m.end() and len(number) == length and mod97(number):
                yield m.start(), end
                at = end
                break


def cpf(digits: str) -> bool:
    """The two last digits are sums of those before, weighted from 2 up from the right; equal digits throughout are none."""
    d = [int(c) for c in digits]
    sums = (sum(w * x for w, x in zip(range(n + 1, 1, -1), d[:n], strict=True)) * 10 % 11 % 10 for n in (9, 10))
    return len(set(d)) > 1 and list(sums) == d[9:]


def person_numbers(text: str) -> Iterator[Span]:
    for m in CPF.finditer(text):
        if cpf("".join(m.groups())):
            yield "cpf", *m.span()
    for m in DNI.finditer(text):
        if DNI_LETTERS[int(m[1]) % 23] == m[2]:
            yield "dni", *m.span()
    for m in NIR.finditer(text):
        if 97 - int(m[1].replace(" ", "")) % 97 == int(m[2]):
            yield "nir", *m.span()


def issued(ssn: str) -> bool:
    """Whether a number with these parts was ever given out."""
    area, group, serial = ssn.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each at sign: the run of local characters before it, as far as no match took them, and the domain."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and (c := text[start - 1]).isascii() and (c.isalnum() or c in "._%+-"):
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        done = m.end() if m else at + 1
        at = text.find("@", done)


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> list[Span]:
    out = [("email", *s) for s in emails(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(map(small, m.group().split(".")))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = digits_of(m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits_of(m.group())) <= 15]
    return out


def score(text: str, kind: str, start: int, end: int, checked: bool = False) -> float:
    near = text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR]
    words = WORDS.findall(near.lower())
    value = START[kind] + (BOOST if not CONTEXT[kind].isdisjoint(words) else 0.0) + (0.1 if checked else 0.0)
    against = kind not in ("email", "ip") and not AGAINST.isdisjoint(words)
    return round(min(1.0, value - (DROP if against else 0.0)), 2)


def added_spans(text: str, base: list[Span]) -> list[tuple[Span, float]]:
    """Spans of further kinds that reach the threshold and touch no base span."""
    found = []
    found += [(("iban", *s), score(text, "iban", *s, checked=True)) for s in ibans(text)]
    found += [(s, score(text, *s, checked=True)) for s in person_numbers(text)]
    for m in SSN.finditer(text):
        if issued(m.group()):
            found.append((("ssn", *m.span()), score(text, "ssn", *m.span())))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := digits_of(m.group())) <= 15 and luhn(d):
            found.append((("account", *m.span()), score(text, "account", *m.span(), checked=True)))
    for m in LOCAL_PHONE.finditer(text):
        if 8 <= len(digits_of(m.group())) <= 12:
            found.append((("local_phone", *m.span()), score(text, "local_phone", *m.span())))
    found = [(s, v) for s, v in found if v >= THRESHOLD]
    taken = sorted(s[1:] for s in base)
    return [(s, v) for s, v in found if not any(a < s[2] and s[1] < b for a, b in taken)] if found else []


def find(text: str | None) -> tuple[list[Span], list[tuple[Span, float]]]:
    """Base spans, and all spans with scores; ordered by kind as listed, then start."""
    text = text or ""
    if not DIGIT.search(text):  # only e-mail addresses do without digits
        base = [("email", *s) for s in emails(text)]
        return base, [(s, score(text, *s)) for s in base]
    base = base_spans(text)
    every = [(s, score(text, *s, checked=s[0] == "card")) for s in base] + added_spans(text, base)
    order = lambda s: (KINDS.index(s[0]), s[1])
    return sorted(base, key=order), sorted(every, key=lambda x: order(x[0]))


def told(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def masked(text: str) -> str:
    """The text with each span replaced by its kind in angle brackets; what overlaps becomes one."""
    parts, done = [], 0
    for kind, start, end in sorted((s for s, _ in find(text)[1]), key=lambda s: (s[1], -s[2])):
        if start >= done:
            parts += [text[done:start], f"<{kind.upper()}>"]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def detect(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): counts and digest of base spans, all spans, their scores."""
    ship(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans, scores = {k: [] for k in BASE}, [], [], []
            for text in batch.column(1):
                base, every = find(text.as_py())
                for k in BASE:
                    counts[k].append(sum(s[0] == k for s in base))
                digests.append(hashlib.sha256(told(base).encode()).hexdigest())
                spans.append(told([s for s, _ in every]))
                scores.append([v for _, v in every])
            columns = [pa.array(counts[k], pa.int64()) for k in BASE]
            columns += [pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(scores, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], ["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans", "scores"]
            )

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(rows, SCHEMA)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` masked; a null text stays null. Other columns stay; ``n_chars`` is set anew."""
    ship(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = [None if t is None else masked(t) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    out = docs.mapInArrow(rows, docs.schema)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect(table(spark, sf_dir, "documents")).drop("scores")

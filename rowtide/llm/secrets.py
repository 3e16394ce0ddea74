"""Secrets, also inside nested encodings.

A worklist starts with the text itself. Each layer is scanned; its encoded parts (percent and backslash escapes, character
references, base64, and gzip, zlib or bzip2 data inside any of these, raw deflate data inside base64) are unwrapped to further
layers until none is new: a layer with a text that the same part of the document had before is not taken again, so cycles
end. Every character of a layer can be traced to the part of the original text it came from, so that findings are reported as
spans of the original. Places are worked out when they are asked for, and one layer of each depth is held at a time, so
that a long text needs a few times its own size.

A null text counts as empty; a table without rows gives none. Spans are code points, the end exclusive. Rows are treated one by one: repeated rows
and ids stay, columns besides ``doc_id`` and ``text`` are left out.
"""

from __future__ import annotations

import binascii
import bz2
import codecs
import hashlib
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from html.entities import html5
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from rowtide.llm.common import ship, table

KINDS = ("assign", "access", "hex")
# "Either case" is meant for ASCII letters only.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
# Shorter runs would be dropped anyway; the bounds change no match.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

# A percent sign or backslash that is itself escaped any number of times is taken at once, else each level of it
# would be a layer of its own.
PERCENT = re.compile(r"(%(?:25)+)(?=[0-9A-Fa-f]{2})|(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(
    r"\\(?:u005[cC])+(?=[uUx])|\\(?:u\{([0-9A-Fa-f]{1,6})\}|u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|x([0-9A-Fa-f]{2}))|&#[xX]([0-9A-Fa-f]{1,6});"
    r"|&#(?P<decimal>[0-9]{1,7});|(?P<amp>&(?:amp;)+(?=#))|&(?P<name>[A-Za-z][A-Za-z0-9]{1,31};)"
    r"""|\\(?P<short>["'/nrt\\])"""
)
SHORT = {"n": "\n", "r": "\r", "t": "\t"}
# A run goes on over line breaks; with them, the first part may be short. Runs of fewer than 16 characters are dropped.
BASE64 = re.compile(
    r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{16,}+|[A-Za-z0-9+/_-]++(?=[\x20\t]*\r?\n))(?:[\x20\t]*\r?\n[\x20\t]*[A-Za-z0-9+/_-]++)*+"
)
RUN = re.compile(r"[A-Za-z0-9+/_-]+")
LEAST_RUN = 16
STANDARD = str.maketrans("-_", "+/")
#: What gzip and bzip2 data begin with, and the pairs of bytes that zlib data may.
PACKED = re.compile(
    b"|".join(
        [rb"\x1f(?=\x8b\x08)", rb"B(?=Zh[1-9]1AY&SY)"]
        + [
            re.escape(bytes([a])) + b"(?=[" + b"".join(b"\\x%02x" % b for b in range(256) if (a * 256 + b) % 31 == 0) + b"])"
            for a in range(8, 128, 16)
        ]
    )
)
# No token, escape or base64 run has such a character: what stands before and behind it can be scanned apart.
CUT = re.compile(r"""[\s\S]*[^A-Za-z0-9+/_.=%\\{}&#;:"'\s-]""")
#: Up to the last character that only an escape can stand for, and to the end of its word.
ESCAPED = re.compile(r"""[\s\S]*[^\x20-\x7e][^\s"'<>]*""")
#: Compressed data are read in pieces of so many bytes, and their text is scanned in pieces of so many characters, or
#: more up to the next place where it can be cut; no layer is too large.
FEED, PIECE = 1 << 12, 1 << 20
#: So many bytes tell what data are packed with.
HEAD = 10
SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, layers long"

Span = tuple[str, int, int]


def scan(text: str) -> list[Span]:
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6] if ":" in text or "=" in text else []
    out += [("access", *m.span()) for m in ACCESS.finditer(text)]
    return out + [("hex", *m.span()) for m in HEX.finditer(text)]


class Shifted:
    """The place of a character of the text itself."""

    def __init__(self, by: int):
        self.by = by

    def __getitem__(self, index):
        return index + self.by


class Same:
    """One place for all characters of a text."""

    def __init__(self, at: int):
        self.at = at

    def __getitem__(self, index):
        return self.at


class Grouped:
    """The place of the first, or last, base64 character of each character of decoded data.

    ``starts`` has where the characters begin in the data, and its length; none if each is one byte. ``parts`` are the
    parts of the run on each line, ``size`` is how many base64 characters there are from ``phase`` on.
    """

    def __init__(self, of, parts: list[range], phase: int, size: int, starts: np.ndarray | None, last: bool):
        self.of, self.phase, self.size, self.starts, self.last = of, phase, size, starts, last
        self.begin = np.fromiter((p.start for p in parts), np.int64, len(parts))
        self.before = np.fromiter(accumulate((len(p) for p in parts[:-1]), initial=0), np.int64, len(parts))

    def __getitem__(self, index):
        index = np.asarray(index, np.int64) + self.last
        at = index if self.starts is None else self.starts[index].astype(np.int64)
        at = self.phase + (np.minimum(self.size, (at * 4 + 2) // 3) - 1 if self.last else at * 4 // 3)
        part = np.searchsorted(self.before, at, "right") - 1
        return self.of[self.begin[part] + at - self.before[part]]


Places = Shifted | Same | Grouped | np.ndarray


class Layer:
    """A text, and for each of its characters the span of the original text it comes from. A layer that goes on with
    another one's text does not count. ``raw`` tells that its characters may be bytes of compressed data."""

    def __init__(self, text: str, lo: Places, hi: Places, counts: bool = True, raw: bool = False):
        self.text, self.lo, self.hi, self.counts, self.raw = text, lo, hi, counts, raw

    @property
    def same(self) -> bool:
        return isinstance(self.lo, Same)

    def span(self, start: int, end: int) -> tuple[int, int]:
        return int(self.lo[start]), int(self.hi[end - 1])

    def line(self, at: int, end: int) -> tuple[int, int]:
        """The line around a part of the text."""
        start, stop = self.text.rfind("\n", 0, at) + 1, self.text.find("\n", end)
        return start, len(self.text) if stop < 0 else stop


def _lines(layer: Layer, pattern: re.Pattern, decode) -> Iterator[Layer]:
    """For each line with escapes, the line with them decoded; ``decode(match)`` gives characters with their widths."""
    done = 0
    for first in pattern.finditer(layer.text):
        if first.start() < done:
            continue
        start, done = layer.line(*first.span())
        chars, lo, hi, at = [], array("i"), array("i"), start
        for m in pattern.finditer(layer.text, start, done):
            got = decode(m)
            if got is None:
                continue
            chars.append(layer.text[at : m.start()])
            lo.extend(range(at, m.start()))
            hi.extend(range(at, m.start()))
            for c, a, b in got:
                chars.append(c)
                lo.append(a)
                hi.append(b - 1)
            at = m.end()
        if at > start:
            chars.append(layer.text[at:done])
            lo.extend(range(at, done))
            hi.extend(range(at, done))
            places = (layer.lo, layer.hi) if layer.same else (layer.lo[np.array(lo)], layer.hi[np.array(hi)])
            yield Layer("".join(chars), *places, raw=True)


def _percent(m: re.Match) -> list[tuple[str, int, int]]:
    if m[1]:
        return [("%", *m.span())]
    out, at = [], m.start()
    for c in _text(bytes.fromhex(m.group().replace("%", ""))):
        width = 3 * _width(c)
        out.append((c, at, at + width))
        at += width
    return out


def _escape(m: re.Match) -> list[tuple[str, int, int]] | None:
    if m["short"]:
        return [(SHORT.get(m["short"], m["short"]), *m.span())]
    if m["name"]:
        c = html5.get(m["name"], "")
        return [(c, *m.span())] if len(c) == 1 else None
    code = 0x26 if m["amp"] else int(m["decimal"]) if m["decimal"] else int(next(filter(None, m.groups()), "5c"), 16)
    if code > 0x10FFFF or 0xD800 <= code <= 0xDFFF:
        return None
    return [(chr(code), *m.span())]


def _text(data: bytes) -> str:
    """As UTF-8; each byte that is none becomes one lone surrogate."""
    return data.decode("utf-8", "surrogateescape")


def _width(c: str) -> int:
    return 1 if "\udc80" <= c <= "\udcff" else len(c.encode())


def _starts(text: str, size: int) -> np.ndarray | None:
    """Where each character of a text begins among the bytes it was read from, and their number."""
    if len(text) == size:
        return None
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    width = np.ones(len(codes), np.int8)
    for least in (0x80, 0x800, 0x10000):
        width += codes >= least
    width[(codes >= 0xDC80) & (codes <= 0xDCFF)] = 1
    starts = np.zeros(len(codes) + 1, np.int32)
    np.cumsum(width, out=starts[1:])
    return starts


def _rich(text: str) -> bool:
    """Whether a text has something that is scanned for or could be unwrapped; nothing is found in or below any other."""
    return bool(scan(text) or PERCENT.search(text) or ESCAPE.search(text) or next(_runs(text), None))


def _readable(text: str) -> bool:
    return sum(n for c, n in Counter(text).items() if c.isprintable() or c.isspace()) >= 0.9 * len(text) > 0


def _inflated(chunks: Iterable[bytes], ends: list[int], headless: bool = False) -> Iterator[bytes]:
    """What gzip, zlib or bzip2 data unpack to, member after member, or one ``headless`` run of deflate data; ``ends`` gets
    where each whole member ended."""
    unpack, data, fed = zlib.decompressobj(-15) if headless else None, b"", 0
    for chunk in chunks:
        data, fed = data + chunk, fed + len(chunk)
        while data:
            if unpack is None:
                data = data.lstrip(b"\0") if ends else data  # gzip files may be padded
                if len(data) < HEAD:
                    break
                if headless or not PACKED.match(data):
                    return
                unpack = bz2.BZ2Decompressor() if data.startswith(b"BZ") else zlib.decompressobj(47)
            more = True
            while more:
                try:
                    out = unpack.decompress(data, PIECE)
                except (zlib.error, OSError):
                    return
                if out:
                    yield out
                data = getattr(unpack, "unconsumed_tail", b"")
                more = not unpack.eof and (bool(data) or len(out) == PIECE)
            if unpack.eof:
                data, unpack = unpack.unused_data, None
                ends.append(fed - len(data))


def _fed(data: bytes, start: int = 0, read: list[int] | None = None) -> Iterator[bytes]:
    """The bytes in pieces; ``read`` gets how far they were read when another one is asked for."""
    for i in range(start, len(data), FEED):
        yield data[i : i + FEED]
        if read is not None:
            read.append(min(i + FEED, len(data)))


def _headless(data: bytes) -> Iterator[tuple[str, bool]]:
    """Texts of deflate data without a header. Any bytes may look like them, so they must come to their end."""
    ends: list[int] = []
    for _ in _inflated(_fed(data), ends, True):
        pass
    if ends:
        told = False
        for text in _pieces(_inflated(_fed(data), [], True)):
            if _rich(text):
                yield text, not told
                told = True


def _pieces(chunks: Iterable[bytes]) -> Iterator[str]:
    """The text of the bytes, cut where no token is cut."""
    decode = codecs.getincrementaldecoder("utf-8")("surrogateescape").decode
    held, size = [], 0
    for chunk in chunks:
        text = decode(chunk)
        held.append(text)
        size += len(text)
        if size >= PIECE and (m := CUT.match(text)):
            yield "".join([*held[:-1], text[: m.end()]])
            held = [text[m.end() :]]
            size = len(held[0])
    if text := "".join([*held, decode(b"", True)]):
        yield text


def _unpacked(data: bytes) -> Iterator[tuple[str, bool, int]]:
    """Texts of the compressed data that begin anywhere in ``data``, and of those in them; whether one counts as a layer, and
    where its data begin.

    Data may overlap what looked like data and broke off later, as a head of two bytes is soon met by chance. But where
    bytes were read for a whole piece beyond a place without a fault, no data begin there; else repetitive bytes would be
    read again from each of their repeats."""
    done = 0
    for m in PACKED.finditer(data):
        depth, seen = 1, set()
        while m.start() >= done:
            ends, head, digest = [[] for _ in range(depth)], b"", hashlib.sha256()
            read = [0]
            chunks = _fed(data, m.start(), read)
            for e in ends:
                chunks = _inflated(chunks, e)

            def noted(chunks: Iterator[bytes] = chunks) -> Iterator[bytes]:
                nonlocal head
                for chunk in chunks:
                    head = head if len(head) >= HEAD else head + chunk[:HEAD]
                    digest.update(chunk)
                    yield chunk

            first, told = None, False
            for text in _pieces(noted()):
                first = text if first is None else first
                if _rich(text):
                    yield text, not told, m.start()
                    told = True
            if first and not told and ends[-1] and _readable(first):
                yield first, True, m.start()
            if digest.digest() in seen or not PACKED.match(head):
                done = max(done, ends[0][-1] + m.start() if ends[0] else read[-1] - FEED)
                break
            seen.add(digest.digest())
            depth += 1


def _runs(text: str) -> Iterator[list[range]]:
    """Of each run of base64 characters, its parts on each line."""
    for m in BASE64.finditer(text):
        parts = [range(*p.span()) for p in RUN.finditer(text, *m.span())]
        if sum(map(len, parts)) >= LEAST_RUN:
            yield parts


def _decoded(layer: Layer, parts: list[range], phases: Sequence[int]) -> Iterator[Layer]:
    """The base64 characters of these parts, from the first, second, ... of them on."""
    whole = "".join(layer.text[p.start : p.stop] for p in parts).translate(STANDARD)
    # bytes of compressed data stand for no part of the text: the whole run is the source
    first, last = Same(layer.lo[parts[0][0]]), Same(layer.hi[parts[-1][-1]])
    for phase in phases:
        run = whole[phase : len(whole) - ((len(whole) - phase) % 4 == 1)]
        size = len(run)
        data = binascii.a2b_base64(run + "=" * (-size % 4))
        del run
        for text, counts, _ in _unpacked(data):
            yield Layer(text, first, last, counts)
        for text, counts in _headless(data):
            yield Layer(text, first, last, counts)
        text = _text(data)
        if not _rich(text) and not _readable(text):
            continue
        if layer.same:
            yield Layer(text, first, last)
            continue
        starts = _starts(text, len(data))
        del data
        yield Layer(text, *(Grouped(of, parts, phase, size, starts, of is layer.hi) for of in (layer.lo, layer.hi)))


def _packed(layer: Layer) -> Iterator[Layer]:
    """Compressed data whose bytes were escaped, as bytes or as the characters of the same numbers. What is found comes from
    where the data begin to where they end; those that were cut off end with the last word with an escape."""
    cut = m.end() if (m := ESCAPED.match(layer.text)) else 0
    if not cut:
        return
    for code, handler in (("utf-8", "surrogateescape"), ("latin-1", "replace")):
        try:
            data = layer.text.encode(code, handler)
        except UnicodeEncodeError:
            continue
        spans = {}
        for text, counts, at in _unpacked(data):
            if at not in spans:
                ends: list[int] = []
                for _ in _inflated(_fed(data, at), ends):
                    pass
                start = len(data[:at].decode(code, handler))
                end = len(data[: at + ends[-1]].decode(code, handler)) if ends else max(cut, start + 1)
                spans[at] = Same(layer.lo[start]), Same(layer.hi[end - 1])
            yield Layer(text, *spans[at], counts)


def _base64(layer: Layer) -> Iterator[Layer]:
    """Data may begin at any character of a run, behind a path or a name; groups of four then begin at one of four places.
    Lines are decoded together and, as each could be a value of its own, one by one."""
    for parts in _runs(layer.text):
        if len(parts) > 1:
            for part in parts:
                if len(part) >= LEAST_RUN:
                    yield from _decoded(layer, [part], range(1))
        yield from _decoded(layer, parts, range(4))


def unwrapped(layer: Layer) -> Iterator[Layer]:
    if "%" in layer.text:
        yield from _lines(layer, PERCENT, _percent)
    if "\\" in layer.text or "&" in layer.text:
        yield from _lines(layer, ESCAPE, _escape)
    if layer.raw:
        yield from _packed(layer)
    yield from _base64(layer)


def find(text: str | None) -> tuple[list[Span], list[Span], int]:
    """Base spans, all spans, and the number of layers behind the text; ordered by start, then kind as listed."""
    text = text or ""
    order = lambda s: (s[1], KINDS.index(s[0]), s[2])
    base = scan(text)
    every, seen, layers = set(base), {hashlib.sha256(text.encode()).digest()}, 0
    work = [unwrapped(Layer(text, Shifted(0), Shifted(1)))]
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        key = hashlib.sha256(layer.text.encode("utf-8", "surrogatepass")).digest() + bytes("%d:%d" % layer.span(0, len(layer.text)), "ascii")
        if key in seen:
            continue
        seen.add(key)
        layers += layer.counts
        every.update((k, *layer.span(a, b)) for k, a, b in scan(layer.text))
        work.append(unwrapped(layer))
    return sorted(base, key=order), sorted(every, key=order), layers


def told(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def detect(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): counts and digest of base spans, all spans, layers unwrapped."""
    ship(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans, layers = {k: [] for k in KINDS}, [], [], []
            for text in batch.column(1):
                base, every, n = find(text.as_py())
                for k in KINDS:
                    counts[k].append(sum(s[0] == k for s in base))
                digests.append(hashlib.sha256(told(base).encode()).hexdigest())
                spans.append(told(every))
                layers.append(n)
            columns = [pa.array(counts[k], pa.int64()) for k in KINDS]
            columns += [pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(layers, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "layers"]
            )

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(rows, SCHEMA)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect(table(spark, sf_dir, "documents"))

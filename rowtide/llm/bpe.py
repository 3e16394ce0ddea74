"""Byte-level BPE by dynamic programming over prefixes, and decoding.

For every byte prefix of a piece there is exactly one token that can end the encoding of that prefix. It is the
token ``t`` for which the last token of the shorter prefix and ``t`` stay two tokens when their bytes are merged by
rank. ``Prefixes`` stores that last token per prefix: the encoding of any prefix follows by walking back, bytes can
be appended exactly, and after an edit only the prefixes behind it are computed anew. New pieces of a group of texts are
encoded in sorted order by such edits, so a prefix that several of them share is computed once.

Nulls are empty texts: no tokens. Ids and their digests do not depend on neighbouring rows; other columns of the
input, also ones named like the results, are left out by ``encode`` except ``doc_id``. Rows with equal ids are all
returned.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from rowtide.llm.common import ship, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Pieces whose encoding a worker remembers, in each of two generations.
REMEMBERED = 250_000
#: Pairs of tokens of which a worker remembers whether they stay apart.
PAIRS = 500_000
#: Characters of texts whose new pieces are encoded together.
GROUP = 4_000_000
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def ranks_of(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}


class Vocabulary:
    """Ranks, each token's two merged parts, and which pairs of tokens stay apart."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = {i: t for t, i in ranks.items()}
        self.sizes = {i: len(t) for t, i in ranks.items()}
        self.names = {i: str(i) for i in self.bytes}
        self.longest = max(map(len, ranks))
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.apart: dict[tuple[int, int], bool] = {}

    def split(self, token: int) -> tuple[int, int] | None:
        """The pair whose merge makes ``token``: the last merge when its own bytes are merged by rank."""
        if token not in self.parts:
            pieces = [bytes([b]) for b in self.bytes[token]]
            while len(pieces) > 2:
                rank, i = min((self.ranks.get(pieces[i] + pieces[i + 1], 1 << 40), i) for i in range(len(pieces) - 1))
                if rank >= token:  # no merge sequence makes it; it is only met whole
                    break
                pieces[i : i + 2] = [pieces[i] + pieces[i + 1]]
            self.parts[token] = tuple(self.ranks[p] for p in pieces) if len(pieces) == 2 else None
        return self.parts[token]

    def stay(self, left: int, right: int) -> bool:
        """Whether bytes of ``left`` and ``right`` side by side are encoded as these two tokens."""
        key = (left, right)
        known = self.apart.get(key)
        if known is None:
            known = self._stay(left, right)
            if len(self.apart) > PAIRS:
                self.apart.clear()
            self.apart[key] = known
        return known

    def _stay(self, left: int, right: int) -> bool:
        # Undo merges across the border from the latest on: if a merge over the border would have come before the
        # merge that made one of the sides, the sides would not have become what they are.
        limit = 1 << 40
        while True:
            joined = self.ranks.get(self.bytes[left] + self.bytes[right])
            if joined is not None and joined < limit:
                return False
            if left > right:
                limit, parts = left, self.split(left)
                if parts is None:
                    return True
                left = parts[1]
                if left >= limit:
                    return True
            else:
                limit, parts = right, self.split(right)
                if parts is None:
                    return True
                # on a tie the earlier position merges first, so the border wins against an equal rank to its right
                limit += 1
                right = parts[0]
                if right + 1 >= limit:
                    return True


class Prefixes:
    """The last token of every byte prefix of one piece."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, data: bytes) -> None:
        v, start = self.vocabulary, len(self.data)
        self.data = whole = self.data + data
        find, known, last, longest = v.ranks.get, v.apart.get, self.last, v.longest
        for end in range(start + 1, len(whole) + 1):
            # Only one token can be right, so the order of the search is free; short ones are the likelier.
            at, least = end - 1, max(0, end - longest)
            while at >= least:
                token = find(whole[at:end])
                if token is not None:
                    if not at:
                        break
                    key = (last[at - 1], token)
                    stays = known(key)
                    if v.stay(*key) if stays is None else stays:
                        break
                at -= 1
            else:
                raise ValueError(f"no token ends at byte {end}")
            last.append(token)

    def replace(self, at: int, end: int, data: bytes) -> None:
        """Put ``data`` in place of bytes ``at`` to ``end``; prefixes up to ``at`` are kept."""
        rest = data + self.data[end:]
        self.data, self.last = self.data[:at], self.last[:at]
        self.append(rest)

    def ids(self, end: int | None = None) -> list[int]:
        """The encoding of the first ``end`` bytes."""
        at, out, last, size = len(self.data) if end is None else end, [], self.last, self.vocabulary.sizes
        while at:
            token = last[at - 1]
            out.append(token)
            at -= size[token]
        return out[::-1]


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN):
        self.vocabulary, self.pieces, self.known, self.older = Vocabulary(ranks), regex.compile(pattern), {}, {}

    def learn(self, pieces: Iterable[str]) -> dict[str, tuple[int, ...]]:
        """The encoding of each of these pieces; remembers the short ones."""
        out, older, prefixes = {}, self.older, Prefixes(self.vocabulary)
        ranks = self.vocabulary.ranks
        for piece in sorted(pieces):
            ids = older.get(piece)
            if ids is None:
                data = piece.encode()
                whole = ranks.get(data)
                if whole is None:
                    before, at = prefixes.data, 0
                    for at, (x, y) in enumerate(zip(before, data)):
                        if x != y:
                            break
                    else:
                        at = min(len(before), len(data))
                    prefixes.replace(at, len(before), data[at:])
                    ids = tuple(prefixes.ids())
                else:
                    ids = (whole,)
            out[piece] = ids
        for piece, ids in out.items():
            if len(piece) <= 64:
                if len(self.known) >= REMEMBERED:
                    self.older, self.known = self.known, {}
                self.known[piece] = ids
        return out

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[list[int]]:
        """The encoding of each text, in their order."""
        group, new, size = [], set(), 0
        for text in texts:
            pieces = self.pieces.findall(text or "")
            # What is known is told at once, so that a group holds the text of its new pieces only.
            found = list(map(self.known.get, pieces, pieces))
            at = [i for i, p in enumerate(found) if p.__class__ is str]
            new.update([found[i] for i in at])
            group.append((found, at))
            size += len(text or "")
            if size >= GROUP:
                yield from self._told(group, new)
                group, new, size = [], set(), 0
        yield from self._told(group, new)

    def _told(self, group: list[tuple[list, list[int]]], new: set[str]) -> Iterator[list[int]]:
        told = self.learn(new)
        for found, at in group:
            for i in at:
                found[i] = told[found[i]]
            yield list(chain.from_iterable(found))

    def encode(self, text: str | None) -> list[int]:
        return next(self.encode_all([text]))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.bytes.__getitem__, ids))


_ENCODERS: dict[str, Encoder] = {}


def _encoder(vocabulary: bytes) -> Encoder:
    """One encoder per worker process and vocabulary, reused by its later tasks."""
    key = hashlib.sha256(vocabulary).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(ranks_of(vocabulary))
    return _ENCODERS[key]


def encode(docs: DataFrame, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]) of every row's whole text.

    ``vocabulary``: path of a rank file. It is read here and broadcast; a vocabulary has a fixed size.
    """
    spark = docs.sparkSession
    ship(spark)
    with open(vocabulary or public_tokenizers.path(VOCABULARY), "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        name = encoder.vocabulary.names.__getitem__
        for batch in batches:
            n, digests, decoded, all_ids = [], [], [], []
            for ids in encoder.encode_all(text.as_py() for text in batch.column(1)):
                n.append(len(ids))
                digests.append(hashlib.sha256(",".join(map(name, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
                if with_ids:
                    all_ids.append(ids)
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns, names = [*columns, pa.array(all_ids, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    narrow = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    return narrow.mapInArrow(rows, SCHEMA + (", ids array<int>" if with_ids else ""))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))

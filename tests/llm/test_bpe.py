import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from rowtide.llm import bpe


@pytest.fixture(scope="module")
def pair():
    with open(public_tokenizers.path(bpe.VOCABULARY), "rb") as f:
        ranks = bpe.ranks_of(f.read())
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return bpe.Encoder(ranks), reference


def texts():
    rng = random.Random(1)
    alphabet = "abcdefghé ü😀 \n\t0123456789$#'.,ABCÄß中文字ñ​"
    out = ["", " ", "a", "<|endoftext|>", "a" * 3000, "é" * 400, " " * 2000, "th" * 500, "-" * 1500, "0" * 700]
    out += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 120))) for _ in range(1500)]
    out += ["".join(chr(rng.choice([rng.randint(1, 0x2FF), rng.randint(0x4E00, 0x9FFF)])) for _ in range(60)) for _ in range(300)]
    return out


def test_ids_equal_the_library_and_decode_back(pair):
    encoder, reference = pair
    for text in texts():
        ids = encoder.encode(text)
        assert ids == reference.encode_ordinary(text), text
        assert encoder.decode(ids) == text.encode()


def test_prefixes_appends_and_edits(pair):
    encoder, _ = pair
    rng = random.Random(2)
    whole = lambda data: bpe.Prefixes(encoder.vocabulary, data).ids()
    for _ in range(100):
        data = bytes(rng.choice(b"abcthe ing\xc3\xa9") for _ in range(30))
        p = bpe.Prefixes(encoder.vocabulary, data[:11])
        p.append(data[11:])
        assert p.ids() == whole(data)
        assert all(p.ids(n) == whole(data[:n]) for n in range(31))
        p.replace(7, 12, b"new")
        assert p.data == data[:7] + b"new" + data[12:] and p.ids() == whole(p.data)


def test_rows(spark, pair):
    rows = [(1, "the end", "x"), (1, "the end", "x"), (2, None, None), (3, "", ""), (None, "x" * 100_000, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted((r.asDict() for r in bpe.encode(df).collect()), key=lambda r: str(r["doc_id"]))
    assert [r["doc_id"] for r in got] == [1, 1, 2, 3, None]
    ids = pair[1].encode_ordinary("the end")
    assert got[0] == got[1] == {
        "doc_id": 1, "n_tokens": len(ids), "ids_sha256": hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
        "decoded_sha256": hashlib.sha256(b"the end").hexdigest(),
    }
    empty = hashlib.sha256(b"").hexdigest()
    assert all((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (0, empty, empty) for r in got[2:4])
    assert bpe.encode(df.limit(0)).count() == 0


def test_query_on_the_table(spark, sf, pair):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = bpe.op8_bpe(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = pair[1].encode_ordinary(docs[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())


def test_prefixes_that_new_pieces_share_are_computed_once(pair, monkeypatch):
    rng = random.Random(3)
    words = ["".join(rng.choice(["ka", "ré", "tio", "ß", "wh"]) for _ in range(6)) for _ in range(3000)]
    docs = [" ".join(words[i : i + 100]) for i in range(0, 3000, 100)] + [None, "", words[0] * 50]
    encoder, given = bpe.Encoder(pair[0].vocabulary.ranks), []
    append = bpe.Prefixes.append
    monkeypatch.setattr(bpe.Prefixes, "append", lambda self, data: (given.append(len(data)), append(self, data))[1])
    assert list(encoder.encode_all(docs)) == [pair[1].encode_ordinary(d or "") for d in docs]
    assert sum(given) < 0.6 * sum(len(w.encode()) + 1 for w in set(words))


@pytest.mark.parametrize("remembered, characters", [(1, 1), (7, 50), (100, 1000)])
def test_groups_and_bounds_change_nothing(pair, monkeypatch, remembered, characters):
    monkeypatch.setattr(bpe, "REMEMBERED", remembered)
    monkeypatch.setattr(bpe, "GROUP", characters)
    encoder, docs = bpe.Encoder(pair[0].vocabulary.ranks), texts()[:400] * 2
    assert list(encoder.encode_all(docs)) == [pair[1].encode_ordinary(d) for d in docs]
    assert len(encoder.known) <= remembered

import hashlib
from collections import Counter

import public_tokenizers
import tiktoken
from test_jaccard import brute

import corpus_pipeline
from rowtide.llm import bpe, mixing, pii, quality


def test_stages_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    rows = [r.asDict() for r in docs.collect()]

    accepted = {r.doc_id for r in quality.op6_quality(spark, sf).collect() if r.predicted}
    rows = [r for r in rows if r["doc_id"] in accepted]
    groups = {d: c for d, _, c in brute([(r["doc_id"], r["text"]) for r in rows], 80, 5)}
    rows = [r for r in rows if groups[r["doc_id"]] == r["doc_id"]]
    for r in rows:
        r["text"] = pii.masked(r["text"])
        r["n_chars"] = len(r["text"])
    masked = spark.createDataFrame([tuple(r[c] for c in columns) for r in rows], docs.schema)
    taken = {r.doc_id: r for r in mixing.assign(masked).collect()}
    mixed = []
    for r in rows:
        for part in taken[r["doc_id"]].parts:
            cut = part.words < taken[r["doc_id"]]["size"]
            text = " ".join(w.decode() for w in r["text"].encode().split()[: part.words]) if cut else r["text"]
            mixed.append((part.position, r["doc_id"], text))

    with open(public_tokenizers.path(bpe.VOCABULARY), "rb") as f:
        encoding = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks_of(f.read()), special_tokens={}
        )
    expected = Counter()
    for _, doc_id, text in mixed:
        ids = encoding.encode_ordinary(text)
        digest = lambda b: hashlib.sha256(b).hexdigest()
        expected[doc_id, len(ids), digest(",".join(map(str, ids)).encode()), digest(text.encode())] += 1
    assert Counter(map(tuple, corpus_pipeline.run(spark, sf).collect())) == expected
    assert 0 < len(rows) < docs.count()


def test_stages_keep_columns_and_take_odd_rows(spark, sf):
    docs = spark.createDataFrame(
        [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "word " * 40, "en", "s", 200), (3, "word " * 40, "en", "s", 200)],
        spark.read.parquet(f"{sf}/documents.parquet").schema,
    )
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for rows in (docs, docs.limit(0)):
            got = stage(spark, rows, sf)
            assert got.columns == docs.columns, name
            got.collect()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == 4

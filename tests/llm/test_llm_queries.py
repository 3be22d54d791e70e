"""The registered queries that SQL cannot express, over whole given tables."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sluice.llm.queries import QUERIES
from test_llm_simhash import brute_components, brute_fingerprint
from test_llm_suffix_dedup import brute as brute_bytes

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return [(r["doc_id"], r["text"]) for r in
            spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def _types(df):
    return dict(df.dtypes)


def test_op1(spark):
    df = QUERIES["op1_neighbours"](spark, SF)
    assert _types(df) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"}
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids = np.array([r["vec_id"] for r in rows])
    x = np.array([r["embedding"] for r in rows], np.float64)
    got = {}
    for r in df.collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    asked = [i for i in ids if i % 100 == 0]
    assert set(got) == set(asked)
    hits = 0
    for q in asked:
        gap = ((x - x[ids == q][0]) ** 2).sum(1)
        order = [i for i in np.lexsort((ids, gap)) if ids[i] != q][:10]
        hits += len(got[q] & {int(ids[i]) for i in order})
    assert hits >= 0.9 * 10 * len(asked)


def test_op3(spark, docs):
    df = QUERIES["op3_suffix_dedup"](spark, SF)
    assert _types(df) == {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint",
                          "n_spans": "bigint", "kept_sha256": "string"}
    expected = sorted((i, n, gone, spans, hashlib.sha256(kept).hexdigest())
                      for i, n, gone, spans, kept in brute_bytes(docs))
    assert sorted(map(tuple, df.collect())) == expected


def test_op5(spark, docs):
    df = QUERIES["op5_toxicity"](spark, SF)
    assert _types(df) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    rows = df.collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(i for i, _ in docs)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)


def test_op6(spark, docs):
    df = QUERIES["op6_simhash"](spark, SF)
    assert _types(df) == {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"}
    prints = {i: brute_fingerprint(t) for i, t in docs}
    root = brute_components(prints)
    assert sorted(map(tuple, df.collect())) == sorted((i, f"{f:016x}", root[i]) for i, f in prints.items())


def test_op8(spark, docs):
    df = QUERIES["op8_language_id"](spark, SF)
    assert _types(df) == {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = df.collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(langs)
    own = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in own} == {i for i in langs if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in own) >= 0.9 * len(own)


def test_op9(spark, docs):
    df = QUERIES["op9_token_counts"](spark, SF)
    assert _types(df) == {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint",
                          "over_limit": "boolean"}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = []
    for i, t in docs:
        n = len(library.encode(t or "", add_special_tokens=False))
        expected.append((i, len((t or "").encode()), n, n > 1024))
    assert sorted(map(tuple, df.collect())) == sorted(expected)

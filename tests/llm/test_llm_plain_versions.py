"""Learned operators: predictions of whole texts against a plain version."""

import math
import unicodedata

import numpy as np
import pytest

from sluice.llm import language_id as L
from sluice.llm import toxicity as X

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def plain_toxicity(text, model):
    words, word = set(), ""
    for c in (text or "").lower() + " ":
        if c.isalnum():
            word += c
        else:
            words |= {word} - {""}
            word = ""
    terms = {t for group in X.IDENTITY for t in group}
    found = words | {"^" + w[:n] for w in words - terms for n in X.BEGINNINGS if len(w) > n}
    margin = model["bias"] + math.fsum(model["weights"].get(w, 0.0) for w in found)
    return 1 / (1 + math.exp(-margin))


def test_toxicity_of_whole_texts(spark, docs):
    model = X.train(spark, docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert model["weights"]
    got = X.toxicity(spark, docs, model).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r["score"] == pytest.approx(plain_toxicity(r["row"]["text"], model), abs=1e-9)


def plain_language(text, model):
    """Every window through the network, filter by filter."""
    if not any(unicodedata.category(c).startswith("L") for c in text or ""):
        return "und", 0.0
    w, raw = model["weights"], text.encode()
    total = np.zeros(len(model["langs"]))
    for start in range(0, len(raw), L.WINDOW):
        piece = raw[start:start + L.WINDOW]
        embedded = w["embed"][np.frombuffer(piece.ljust(L.WINDOW, b"\0"), np.uint8)]
        hidden = []
        for width in L.WIDTHS:
            patches = np.stack([embedded[i:i + width].ravel() for i in range(L.WINDOW - width + 1)])
            hidden += list((patches @ w[f"filter{width}"]).max(axis=0))
        logits = np.maximum(hidden, 0) @ w["dense"] + w["bias"]
        p = np.exp(logits - logits.max())
        total += p / p.sum() * len(piece) / len(raw)
    return model["langs"][int(total.argmax())], float(total.max())


def test_language_of_whole_texts(spark, docs):
    model = L.train(spark, docs, steps=120)
    odd = spark.createDataFrame([(10_000, "½ ² ①  Ⅷ _ 7"), (10_001, "٣ ़ 1st"), (10_002, "ʰ"), (10_003, "½ ǅ")],
                                "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(odd)
    texts = {r["doc_id"]: r["text"] for r in both.collect()}
    got = L.identify(spark, both, model).collect()
    assert len(got) == len(texts)
    for r in got:
        lang, score = plain_language(texts[r["doc_id"]], model)
        assert r["score"] == pytest.approx(score, abs=1e-4), r["doc_id"]
        assert r["lang_pred"] == lang
    assert {r["doc_id"] for r in got if r["lang_pred"] == "und"} >= {10_000}
    assert {r["doc_id"] for r in got if r["lang_pred"] != "und"} >= {10_001, 10_002, 10_003}


def test_training_sees_windows_of_whole_texts(spark, monkeypatch):
    text = "".join(chr(97 + i) * L.WINDOW for i in range(20))
    seen = []
    monkeypatch.setattr(L, "fit", lambda x, y, *a: seen.append({chr(b) for b in x[:, 0]}) or {})
    L.train(spark, spark.createDataFrame([(1, text, "aa")], "doc_id long, text string, lang string"))
    assert seen == [set(text)]


def test_shares_go_to_who_has_rows():
    assert L.shares({"a": 100, "b": 3, "c": 100}, 60) == {"a": 28, "b": 3, "c": 29}
    assert L.shares({"a": 2, "b": 3}, 60) == {"a": 2, "b": 3}
    assert L.shares({}, 5) == {}

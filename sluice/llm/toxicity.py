"""Toxicity: a word classifier regularised by counterfactuals.

A logistic regression over the words a text holds and their beginnings (marked
by ``^``), which carry insults through their endings.  For each labelled text
that mentions an identity term, counterfactual twins are made by swapping the
term for the others of its group, among them a neutral one; the squared
difference between the twins' scores (before the sigmoid) is a penalty, so that
the mention of a group does not move a score: fewer false positives on neutral
mentions.  An L1 penalty keeps only words that tell.

Fitting uses at most ``SAMPLE`` labelled rows, chosen by a hash of the id, and
``VOCABULARY`` words, the most telling ones of those that at least ``MIN_DF``
of these rows hold, besides the identity terms; both bounds are parameters and
neither grows with the corpus.  Scoring reads every whole text.

Cases: a null or empty text scores as one without words; a null id is never
held out nor learned from; rows without label are not learned from;
documents that repeat an id are learned from as one; no labels give every text
the same score, below one half; a very long text is read in segments that end
between words; other columns, whatever their names, stay in ``row``; no documents,
no result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import staged, text_slices

SAMPLE = 20_000
VOCABULARY = 4_000
MIN_DF = 3
BEGINNINGS = (4, 5, 6)
L1 = 1.0            # in labelled rows: the pull on each weight
PAIRING = 1.0       # weight of the counterfactual penalty
STEPS = 300
SEGMENT_CHARS = 1 << 20

# Identity terms by group, the first of each group neutral.
IDENTITY = [
    ["person", "man", "woman", "boy", "girl", "transgender", "gay", "lesbian", "straight",
     "bisexual"],
    ["people", "men", "women", "boys", "girls", "muslims", "christians", "jews", "hindus",
     "buddhists", "atheists", "immigrants", "refugees", "gays", "lesbians"],
    ["human", "muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "black", "white",
     "asian", "latino", "african", "american", "european", "disabled", "blind", "deaf", "elderly"],
]

_WORD = re.compile(r"[^\W_]+")


def word_set(text: str | None) -> set[str]:
    """Distinct lower-case words of a whole text, worked off in segments."""
    if not text:
        return set()
    if len(text) <= SEGMENT_CHARS:
        return set(_WORD.findall(text.lower()))
    found, start = set(), 0
    while start < len(text):
        stop = start + SEGMENT_CHARS
        while stop < len(text) and (text[stop].isalnum() or text[stop - 1].isalnum()):
            stop += 1  # never inside a word
        found.update(_WORD.findall(text[start:stop].lower()))
        start = stop
    return found


_TERMS = frozenset(term for group in IDENTITY for term in group)


def features(words: set[str]) -> set[str]:
    """The words and the marked beginnings of longer ones.  Identity terms
    have no beginnings: a swap then changes the mention as a whole."""
    found = set(words)
    plain = words - _TERMS
    for n in BEGINNINGS:
        found.update(["^" + w[:n] for w in plain if len(w) > n])
    return found


def twins(words: set[str]) -> Iterator[tuple[str, str]]:
    """Counterfactual swaps of a text: term it holds, term put in its place."""
    for group in IDENTITY:
        for term in group:
            if term in words:
                for other in group:
                    if other not in words:
                        yield term, other


def fit(rows: list[np.ndarray], labels: np.ndarray, swaps: dict[tuple[int, int], float], size: int,
        l1: float = L1, pairing: float = PAIRING, steps: int = STEPS) -> tuple[float, np.ndarray]:
    """Bias and weights by accelerated proximal gradient.  ``rows``: the words
    (numbers below ``size``) of each text; ``swaps``: how often a word takes
    another's place in a counterfactual twin."""
    n, positive = len(rows), float(labels.sum())
    if not 0 < positive < n:
        return float(np.log((positive + 1) / (n - positive + 2))), np.zeros(size)
    flat = np.concatenate(rows).astype(np.int64)
    row = np.repeat(np.arange(n), [len(r) for r in rows])
    a, b = (np.array([k[i] for k in swaps], np.int64) for i in (0, 1))
    count = np.array(list(swaps.values()), float)
    # the rarer class counts more, by the root of the odds
    weight = np.where(labels > 0, np.sqrt(max(1.0, (n - positive) / positive)), 1.0)
    # one step size by word: words that many texts hold move less; a text's
    # margin moves by what all its words move, so the scale is by its length
    longest = (np.bincount(row, minlength=n) + 1.0) * weight
    curve = 0.25 * np.bincount(flat, longest[row], minlength=size) + 1.0
    curve += 4 * pairing * (np.bincount(a, count, size) + np.bincount(b, count, size))
    bias = last_bias = float(np.log((weight * labels).sum() / (weight * (1 - labels)).sum()))
    w = last = np.zeros(size)
    curve_bias = 0.25 * longest.sum()
    for step in range(steps):
        pull = step / (step + 3.0)
        z, zb = w + pull * (w - last), bias + pull * (bias - last_bias)
        margin = zb + np.bincount(row, z[flat], minlength=n)
        error = weight * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels)
        slope = np.bincount(flat, error[row], minlength=size)
        gap = 2 * pairing * count * (z[a] - z[b])
        slope += np.bincount(a, gap, size) - np.bincount(b, gap, size)
        last, last_bias = w, bias
        moved = z - slope / curve
        w = np.sign(moved) * np.maximum(np.abs(moved) - l1 / curve, 0)
        bias = zb - error.sum() / curve_bias
    return float(bias), w


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """``doc_id, toxic, text`` of the documents of at most ``sample`` labels that
    are not held out; a document that repeats an id is a row of its own."""
    own = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
           .select("doc_id", F.col("toxic").cast("int").alias("toxic"))
           .where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0).distinct()
           .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(sample))
    # a proven size: at most ``sample`` rows of two numbers
    return docs.select("doc_id", "text").join(F.broadcast(own), "doc_id").select(
        "doc_id", "toxic", "text")


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE,
          vocabulary: int = VOCABULARY, l1: float = L1, pairing: float = PAIRING) -> dict:
    """The model: ``bias`` and ``weights`` by word."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            made = [sorted(features(word_set(t))) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array(made, pa.list_(pa.string()))],
                names=["doc_id", "toxic", "words"])

    # documents that repeat an id give one row a label: at most ``sample`` rows
    own = labelled_sample(docs, labels, sample)
    made = T.StructType([*own.schema.fields[:2], T.StructField("words", T.ArrayType(T.StringType()))])
    rows = staged(spark, own.mapInArrow(split, made).groupBy("doc_id", "toxic")
                  .agg(F.max("words").alias("words")).select("toxic", "words"), "toxic-sample")
    n, positive = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    terms = [t for group in IDENTITY for t in group]
    held = F.col("n") + 1.0
    share = (F.col("p") + (positive + 1.0) / (n + 2.0)) / held
    base = (positive + 1.0) / (n + 2.0)
    telling = F.abs(share - base) * F.sqrt(held / F.lit(base * (1 - base)))
    words = (rows.select("toxic", F.explode("words").alias("word")).groupBy("word")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("p"))
             .where((F.col("n") >= MIN_DF) & ~F.col("word").isin(terms))
             .orderBy(telling.desc(), "word").limit(vocabulary))
    names = terms + [r.word for r in words.select("word").collect()]
    number = {w: i for i, w in enumerate(names)}
    own = spark.sparkContext.broadcast(number)  # at most ``vocabulary`` words and the terms

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = own.value
        for batch in batches:
            ids, swaps = [], []
            for found in batch.column("words").to_pylist():
                held = known.keys() & set(found)
                packed = lambda x: np.array(x, np.int32).tobytes()
                ids.append(packed(sorted(known[w] for w in held)))
                swaps.append(packed([known[w] for pair in twins(held) for w in pair]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(ids, pa.binary()), pa.array(swaps, pa.binary())],
                names=["toxic", "ids", "swaps"])

    # at most ``sample`` rows of packed numbers below the vocabulary's size
    found = rows.mapInArrow(numbered, "toxic int, ids binary, swaps binary").collect()
    found.sort(key=lambda r: (r.toxic, bytes(r.ids)))  # the same sums whatever the order of tasks
    swaps: dict[tuple[int, int], float] = {}
    for r in found:
        own_swaps = np.frombuffer(r.swaps, np.int32).tolist()
        for pair in zip(own_swaps[::2], own_swaps[1::2]):
            swaps[pair] = swaps.get(pair, 0.0) + 1.0
    bias, w = fit([np.frombuffer(r.ids, np.int32) for r in found],
                  np.array([float(r.toxic) for r in found]), swaps, len(names), l1, pairing)
    return {"bias": bias, "weights": {names[i]: float(w[i]) for i in np.flatnonzero(w)}}


def toxicity(spark: SparkSession, docs: DataFrame, model: dict) -> DataFrame:
    """``row`` (the document's columns) and ``score`` of each of ``docs(text, ...)``."""
    shared = spark.sparkContext.broadcast(model)  # bounded by the vocabulary

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bias, weights = shared.value["bias"], shared.value["weights"]
        for batch in text_slices(batches, "text"):
            margins = [bias + sum(sorted(map(weights.__getitem__, weights.keys() & features(word_set(t)))))
                       for t in batch.column("text").to_pylist()]
            made = 1 / (1 + np.exp(-np.clip(np.array(margins, float), -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(made, pa.float64())],
                                             names=["row", "score"])

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("text").alias("text"))
    return rows.mapInArrow(score, T.StructType([rows.schema["row"],
                                                T.StructField("score", T.DoubleType())]))


def held_out(column: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 5 == 0, F.lit(False))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.plans.tables import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity(spark, docs, train(spark, docs, table(spark, sf_dir, "labels")))
    return scored.select(F.col("row.doc_id").alias("doc_id"),
                         held_out("row.doc_id").alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below one half."""
    scored = toxicity(spark, docs, train(spark, docs, labels))
    return scored.where(F.col("score") < 0.5).select("row.*")

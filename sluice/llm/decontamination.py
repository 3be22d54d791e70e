"""Benchmark decontamination by winnowing.

Texts become words (A-Z lowered; a word is a run of digits, a-z or non-ASCII
characters).  An item's windows are its runs of ``WINDOW`` words, or all its
words if it has fewer.  For each window length m the k-gram hashes (k =
min(K, m)) are winnowed over m - k + 1 positions: the smallest hash of every
sliding window is kept, the rightmost on ties.  Two texts that share m words
in a row share such a fingerprint, so no window is missed.

Documents are winnowed once, whatever the size of the benchmark, and their
fingerprints joined with the distinct ones of the items.  Only documents that
share one are read further: around the shared fingerprints the windows are cut
out and joined with the items' windows by their words, so a hit is a hit word
by word.  A text is known by 128 bits of its SHA-256: copies of a text are one
text in every join, and so are copies of an item.  No side is broadcast by
order; the items' tables are written first, so that the optimizer goes by their
size: with a small benchmark nothing that grows with the documents moves, with
a large one eight bytes a fingerprint do, and AQE splits frequent ones.

The documents are scanned three times (fingerprints, texts that share one,
result): give a table, not a long plan.

Cases: a null or empty text has no words; an item without words has no
windows; items with one id count once; an item without an id marks words but
is not listed; repeated documents each get their row; no items, no hits; no
documents, no result; a very long text is scanned whole, as one row; other columns
of the documents, whatever their names, are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import staged, text_slices

WINDOW = 10
K = 5
ROWS = 1 << 16           # windows of an Arrow batch
SCAN_BYTES = 1 << 20     # text looked at together
HASH_BLOCK = 1 << 18     # bytes hashed together
LONG_WORD = 1 << 12      # a longer word is hashed alone

_WORDS = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_MULTIPLIER = 0x9E3779B97F4A7C15
_BASE = 0xD1342543DE82EF95
_WORD_BYTE = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
_BYTE_VALUE = np.array([xxhash.xxh3_64_intdigest(bytes([b]).lower()) for b in range(256)], np.uint64)
_FOUND = "key binary, hits array<int>, item_ids array<string>"


def words(text: str | None) -> list[bytes]:
    return _WORDS.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


def laid_out(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of ``texts``, a line feed after each, and where each one ends."""
    texts = pc.fill_null(texts, "")
    lines = pc.binary_join_element_wise(texts, pa.scalar("", texts.type), pa.scalar("\n", texts.type))
    offsets = pc.cumulative_sum(pc.binary_length(lines).cast(pa.int64())).to_numpy(zero_copy_only=False)
    return np.frombuffer(lines.buffers()[2], np.uint8, offsets[-1]) if len(texts) else np.empty(0, np.uint8), offsets


def word_places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word in ``data``."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _WORD_BYTE[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


class WordHashes:
    """64-bit hashes of words, A-Z lowered: of a word's bytes a polynomial, taken
    as a difference of running sums, for whole blocks at a time.  Very long words
    are hashed one by one."""

    def __init__(self):
        places = HASH_BLOCK + LONG_WORD
        # powers of the base and of its inverse, modulo 2**64
        self.up, self.down = (np.multiply.accumulate(np.concatenate(
            [np.ones(1, np.uint64), np.full(places - 1, base, np.uint64)]))
            for base in (_BASE, pow(_BASE, -1, 1 << 64)))

    def of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), np.uint64)
        long = ends - starts > LONG_WORD
        near = np.where(long, starts + 1, ends)
        cuts = np.searchsorted(starts, np.arange(0, len(data) + HASH_BLOCK, HASH_BLOCK))
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a < b:
                base = starts[a]
                first, last = starts[a:b] - base, near[a:b] - base
                sums = np.zeros(last[-1] + 1, np.uint64)
                np.cumsum(_BYTE_VALUE[data[base:base + last[-1]]] * self.up[:last[-1]], out=sums[1:])
                out[a:b] = (sums[last] - sums[first]) * self.down[first]
        out ^= out >> np.uint64(32)
        out *= np.uint64(_MULTIPLIER)
        out ^= out >> np.uint64(29)
        for i in np.flatnonzero(long).tolist():
            out[i] = xxhash.xxh3_64_intdigest(data[starts[i]:ends[i]].tobytes().lower())
        return out

    def of_text(self, text: str) -> np.ndarray:
        """The hashes of the :func:`words` of ``text``."""
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        return self.of(data, *word_places(data))


@F.arrow_udf(T.LongType())
def count_words(text: pa.Array) -> pa.Array:
    """Number of words of each text, 0 for a null one."""
    counts = [np.empty(0, np.int64)]
    for batch in text_slices(iter([pa.RecordBatch.from_arrays([text], names=["text"])]), "text", SCAN_BYTES):
        data, bounds = laid_out(batch.column("text"))
        counts.append(np.diff(np.searchsorted(word_places(data)[0], bounds), prepend=0))
    return pa.array(np.concatenate(counts), pa.int64())


def gram_hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of ``n`` word hashes; lengths differ in seed."""
    if len(ids) < n:
        return np.empty(0, np.uint64)
    out = np.full(len(ids) - n + 1, n, np.uint64)
    for j in range(n):
        out ^= ids[j:len(ids) - n + 1 + j]
        out *= np.uint64(_MULTIPLIER)
        out ^= out >> np.uint64(29)
    return out


def winnow(hashes: np.ndarray, w: int) -> np.ndarray:
    """Positions of the smallest hash of each ``w`` neighbours (the rightmost
    on ties)."""
    if len(hashes) < w:
        return np.empty(0, np.int64)
    n = len(hashes) - w + 1
    best, at = hashes[:n].copy(), np.arange(n)
    for j in range(1, w):
        later = hashes[j:j + n]
        less = later <= best
        best[less] = later[less]
        at[less] = np.flatnonzero(less) + j
    return at[np.concatenate([[True], at[1:] != at[:-1]])]  # at never falls


def least(hashes: np.ndarray, w: int) -> np.ndarray:
    """The smallest of each ``w`` neighbours: the fingerprint of a window."""
    if len(hashes) < w:
        return np.empty(0, np.uint64)
    return np.lib.stride_tricks.sliding_window_view(hashes, w).min(axis=1)


def grams(found: list[bytes], starts: np.ndarray, m: int) -> list[bytes]:
    return [b" ".join(found[s:s + m]) for s in starts.tolist()]


def text_key() -> Column:
    """128 bits of the SHA-256 of ``text``: equal texts are one text."""
    return F.unhex(F.substring(F.sha2(F.col("text").cast("binary"), 256), 1, 32))


def item_windows(items: DataFrame, window: int, k: int) -> DataFrame:
    """``key, m, print, gram`` of every window of ``items(key, text)``: its
    item's text, its words' number, fingerprint and words."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for key, text in zip(*(batch.column(c).to_pylist() for c in ("key", "text"))):
                found = words(text)
                m = min(window, len(found))
                if not m:
                    continue
                prints = least(gram_hashes(hashes.of_text(text), min(k, m)), m - min(k, m) + 1)
                for first in range(0, len(prints), ROWS):
                    at = np.arange(first, min(first + ROWS, len(prints)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key] * len(at), pa.binary()), pa.array(np.full(len(at), m)),
                         pa.array(prints[at].view(np.int64)), pa.array(grams(found, at, m), pa.binary())],
                        names=["key", "m", "print", "gram"])

    return items.mapInArrow(cut, "key binary, m long, print long, gram binary")


def fingerprints(texts: DataFrame, lengths: list[int], k: int) -> DataFrame:
    """``key, prints`` of ``texts(key, text)`` for windows of the given lengths."""
    # of all lengths with one k the shortest window keeps every print that a longer one keeps
    spans = {min(k, m): m - min(k, m) + 1 for m in sorted(lengths, reverse=True)}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in text_slices(batches, "text", SCAN_BYTES):
            data, bounds = laid_out(batch.column("text"))
            starts, stops = word_places(data)
            ends = np.searchsorted(starts, bounds)
            stream = hashes.of(data, starts, stops)
            rows, prints = [], []
            for own, w in spans.items():
                inner = gram_hashes(stream, own)
                at = winnow(inner, w)
                row = np.searchsorted(ends, at, "right")
                inside = at + own <= ends[row]  # not across two texts
                rows.append(row[inside])
                prints.append(inner[at[inside]])
            row = np.concatenate(rows)
            order = np.argsort(row, kind="stable")
            offsets = np.searchsorted(row[order], np.arange(len(ends) + 1))
            lists = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.array(np.concatenate(prints)[order].view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("key"), lists], names=["key", "prints"])

    return texts.mapInArrow(scan, "key binary, prints array<long>")


def windows_around(texts: DataFrame, lengths: list[int], k: int) -> DataFrame:
    """``key, start, m, gram`` of the windows of ``texts(key, text, prints)``
    whose fingerprint is one of ``prints``."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in text_slices(batches, "text"):
            for row in batch.to_pylist():
                found = words(row["text"])
                stream, shared = hashes.of_text(row["text"]), np.array(row["prints"], np.int64).view(np.uint64)
                for m in lengths:
                    prints = least(gram_hashes(stream, min(k, m)), m - min(k, m) + 1)
                    starts = np.flatnonzero(np.isin(prints, shared))
                    for at in (starts[i:i + ROWS] for i in range(0, len(starts), ROWS)):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([row["key"]] * len(at), pa.binary()), pa.array(at, pa.int32()),
                             pa.array(np.full(len(at), m), pa.int32()),
                             pa.array(grams(found, at, m), pa.binary())],
                            names=["key", "start", "m", "gram"])

    return texts.mapInArrow(extend, "key binary, start int, m int, gram binary")


class Benchmark:
    """Tables of the items: ``owners(key, item_id)``, ``windows(key, m, print,
    gram)`` by distinct text, and the distinct ``prints``."""

    def __init__(self, spark: SparkSession, items: DataFrame, window: int, k: int):
        own = staged(spark, items.where("text IS NOT NULL").select(
            text_key().alias("key"), F.col("item_id").cast("string").alias("item_id"), "text")
            .distinct(), "benchmark")
        self.owners = own.where("item_id IS NOT NULL").select("key", "item_id")
        texts = own.groupBy("key").agg(F.first("text").alias("text"))
        self.windows = staged(spark, item_windows(texts, window, k).distinct(), "benchmark-windows")
        self.prints = staged(spark, self.windows.select("print").distinct(), "benchmark-prints")
        # at most ``window`` values
        self.lengths = sorted(r.m for r in self.windows.select("m").distinct().collect())
        self.k = k

    def hits(self, spark: SparkSession, texts: DataFrame) -> DataFrame:
        """``key, start, m, gram`` of the items' windows in ``texts(key, text)``,
        once for all copies of a text."""
        shared = staged(spark, fingerprints(texts, self.lengths, self.k)
                        .select("key", F.explode("prints").alias("print"))
                        .join(self.prints, "print", "left_semi")
                        .groupBy("key").agg(F.collect_set("print").alias("prints")),
                        "decontamination-prints")
        further = (texts.join(shared.select("key"), "key", "left_semi")
                   .groupBy("key").agg(F.first("text").alias("text")).join(shared, "key"))
        return staged(spark, windows_around(further, self.lengths, self.k)
                      .join(self.windows.select("gram"), "gram", "left_semi"), "decontamination-hits")

    def found(self, hits: DataFrame) -> DataFrame:
        """``key, hits, item_ids`` of every text that holds a window."""
        places = F.flatten(F.transform(
            F.collect_set(F.struct("start", "m")),
            lambda w: F.sequence(w["start"], w["start"] + w["m"] - 1)))
        marked = hits.groupBy("key").agg(F.sort_array(F.array_distinct(places)).alias("hits"))
        items = self.windows.select("gram", F.col("key").alias("item")).distinct()
        owners = self.owners.select(F.col("key").alias("item"), "item_id")
        named = (hits.select("key", "gram").distinct().join(items, "gram")
                 .select("key", "item").distinct().join(owners, "item")
                 .groupBy("key").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids")))
        return marked.join(named, "key", "left")


def _keyed(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns]).alias("row"),
                       text_key().alias("key"), "text")


def decontaminate(spark: SparkSession, docs: DataFrame, items: DataFrame, window: int = WINDOW,
                  k: int = K, carry: list[str] | None = None) -> DataFrame:
    """``row`` (the document's columns, or those named in ``carry``),
    ``n_words``, ``hits`` (positions of the words inside an occurring window) and
    ``item_ids`` (sorted as strings) of each of ``docs(text, ...)`` against
    ``items(item_id, text)``.  ``row`` moves where the texts with hits are too
    many to be broadcast: without the text, a document is some forty bytes there."""
    keyed, own = _keyed(docs, carry), Benchmark(spark, items, window, k)
    if own.lengths:
        hits = own.hits(spark, keyed.where("text IS NOT NULL").select("key", "text"))
        found = staged(spark, own.found(hits), "decontamination")
    else:
        found = spark.createDataFrame([], _FOUND)
    return (keyed.select("row", "key", count_words("text").alias("n_words"))
            .join(found, "key", "left")
            .select("row", "n_words", F.coalesce("hits", F.array().cast("array<int>")).alias("hits"),
                    F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids")))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.plans.tables import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(spark, docs, table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words",
        F.size("hits").cast("long").alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no window of any item."""
    keyed, own = _keyed(docs), Benchmark(spark, items, WINDOW, K)
    if not own.lengths:
        return docs
    hits = own.hits(spark, keyed.where("text IS NOT NULL").select("key", "text"))
    bad = staged(spark, hits.select("key").distinct(), "decontamination-texts")
    return keyed.select("row", "key").join(bad, "key", "left_anti").select("row.*")


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SQL_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP10_SQL = f"""
WITH d AS (SELECT doc_id, coalesce({_SQL_WORDS}, []) AS w FROM documents),
i AS (SELECT item_id, w, least(len(w), 10) AS m
      FROM (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark WHERE text IS NOT NULL) WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, m, array_to_string(list_slice(w, s, s + m - 1), ' ') AS g
       FROM (SELECT item_id, m, w, unnest(range(1, len(w) - m + 2)) AS s FROM i)),
lengths AS (SELECT DISTINCT m FROM i),
dw AS (SELECT doc_id, m, s, array_to_string(list_slice(w, s, s + m - 1), ' ') AS g
       FROM (SELECT doc_id, m, w, unnest(range(1, len(w) - m + 2)) AS s
             FROM d, lengths WHERE len(w) >= m)),
hit AS (SELECT doc_id, item_id, s, dw.m FROM dw JOIN iw ON dw.m = iw.m AND dw.g = iw.g),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(s, s + m)) AS p FROM hit) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN ids USING (doc_id)
"""

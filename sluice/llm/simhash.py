"""SimHash near-dedup by a byte-position inverted index.

Fingerprints have 64 bits, eight bytes by position.  Two of them that differ in
at most ``MAX_BITS`` (3) bits differ in at most three bytes, so they share at
least five positional bytes: the guaranteed minimum.  The index posts each
distinct fingerprint under sets of four positions with their bytes, chosen so
that any five positions hold a whole set; every pair to be found thus meets in
a posting, and a posting asks for 32 equal bits, not eight.  Inside a posting
the shared bytes of each pair are tallied, pairs with fewer than five drop out,
and the rest are verified by their differing bits.

Only distinct fingerprints enter the index, so copies cost nothing.  A posting
returns the links of a spanning forest, never all pairs; a very large one looks
its neighbours up by flipped bits, which is linear in its size.  Components are
found over the links of all postings.

Cases: a null or empty text has fingerprint zero and links like any other; ids
may repeat or be null (a null id names a component only if all ids are null);
no documents, no rows; a very long text is one row, with its shingles in one
task; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import order_id, staged, text_slices
from sluice.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
MIN_BYTES = 8 - MAX_BITS
POST_BYTES = 4
TALLY_LIMIT = 65_536     # larger postings look neighbours up
SEGMENT_BYTES = 1 << 20


def position_sets(size: int = POST_BYTES, shared: int = MIN_BYTES) -> list[tuple[int, ...]]:
    """Sets of ``size`` of the eight positions such that any ``shared``
    positions hold one of them (greedy cover)."""
    todo = set(combinations(range(8), shared))
    chosen = []
    while todo:
        best = max(combinations(range(8), size),
                   key=lambda s: sum(set(s) <= set(t) for t in todo))
        chosen.append(best)
        todo = {t for t in todo if not set(best) <= set(t)}
    return chosen


def _word_runs(data: bytes, shingle: int) -> Iterator[list[bytes]]:
    """The words in runs that overlap by ``shingle - 1`` words."""
    start, carry = 0, []
    while start < len(data):
        stop = start + SEGMENT_BYTES
        if stop < len(data):
            # up to the next white space
            ends = [e for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")
                    if (e := data.find(c, stop, stop + SEGMENT_BYTES)) >= 0]
            while not ends and stop < len(data):
                stop += SEGMENT_BYTES
                ends = [e for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")
                        if (e := data.find(c, stop, stop + SEGMENT_BYTES)) >= 0]
            stop = min(ends) if ends else len(data)
        found = carry + data[start:stop].split()
        yield found
        carry = found[max(0, len(found) - shingle + 1):]
        start = stop


_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
_LANES = np.arange(8, dtype=np.int64) * 256


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bits that are set in over half of the shingles' XXH64 (repeats count)."""
    counts = np.zeros((8, 256), np.int64)
    total, rest = 0, []
    digest, seed = xxhash.xxh64_intdigest, SEED
    for run in _word_runs((text or "").encode("utf-8", "surrogatepass").lower(), shingle):
        if len(run) < shingle:
            rest = run
            continue
        grams = map(b" ".join, zip(*(run[i:] for i in range(shingle))))
        hashes = np.fromiter((digest(g, seed) for g in grams), np.uint64, len(run) - shingle + 1)
        lanes = hashes.astype("<u8").view(np.uint8).reshape(-1, 8) + _LANES
        counts += np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256)
        total += len(hashes)
    if not total:
        if not rest:
            return 0
        only = digest(b" ".join(rest), seed)
        return only - (1 << 64) if only >> 63 else only
    ones = (counts @ _BITS).ravel()
    bits = np.packbits(ones * 2 > total, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, th`` (hash of the text) and ``fp`` of each row."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            made = [fingerprint(t, shingle) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("th"), pa.array(made, pa.int64())],
                names=["doc_id", "th", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"),
                       "text").mapInArrow(make, "doc_id long, th long, fp long")


_LOW = np.uint64(0x7F7F7F7F7F7F7F7F)
_HIGH = np.uint64(0x8080808080808080)


def near(fp: np.uint64, others: np.ndarray, max_bits: int) -> np.ndarray:
    """Which of ``others`` share enough positional bytes with ``fp`` and then
    differ in at most ``max_bits`` bits."""
    x = others ^ fp
    differing = np.bitwise_count((((x & _LOW) + _LOW) | x) & _HIGH)  # bytes that differ
    out = differing <= max_bits
    out[out] = np.bitwise_count(x[out]) <= max_bits
    return out


def forest(fps: np.ndarray, max_bits: int, limit: int = TALLY_LIMIT) -> np.ndarray:
    """For each of the distinct ``fps`` (sorted) the smallest index it reaches
    through links inside the posting."""
    root = np.full(len(fps), -1)
    masks = None
    if len(fps) > limit:
        masks = np.array([sum(1 << b for b in bits) for n in range(1, max_bits + 1)
                          for bits in combinations(range(64), n)], np.uint64)
        # the posting's own bytes are equal: only flips of bits that vary are needed
        vary = np.bitwise_or.reduce(fps ^ fps[0])
        masks = masks[(masks & ~vary) == 0]
    left = np.arange(len(fps))
    for first in range(len(fps)):
        if root[first] >= 0:
            continue
        root[first] = first
        stack = [first]
        if masks is None:
            left = left[root[left] < 0]
        while stack:
            fp = fps[stack.pop()]
            if masks is None:
                hit = near(fp, fps[left], max_bits)
                if not hit.any():
                    continue
                found, left = left[hit], left[~hit]
            else:
                wanted = masks ^ fp
                at = np.minimum(np.searchsorted(fps, wanted), len(fps) - 1)
                found = at[fps[at] == wanted]
                found = found[root[found] < 0]
            root[found] = first
            stack.extend(found.tolist())
    return root


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``u, v``: links between the distinct fingerprints ``fp`` that join what
    the postings of the index join."""

    def post(positions: tuple[int, ...], number: int) -> Column:
        out = F.lit(number)
        for p in positions:
            byte = F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255))
            out = F.shiftleft(out.cast("long"), 8).bitwiseOR(byte)
        return out

    sets = position_sets(8 - max_bits - 1, 8 - max_bits)
    index = distinct.select("fp", F.explode(F.array(
        *[post(s, i) for i, s in enumerate(sets)])).alias("post"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(posts: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            ends = np.append(np.flatnonzero(posts[1:] != posts[:-1]) + 1, len(posts))
            starts = np.append(0, ends[:-1])
            size = ends - starts
            two = starts[size == 2]
            x = fps[two] ^ fps[two + 1]
            two = two[np.bitwise_count(x) <= max_bits]
            us, vs = [fps[two]], [fps[two + 1]]
            for i in np.flatnonzero(size > 2):
                own = np.sort(fps[starts[i]:ends[i]])
                root = forest(own, max_bits)
                moved = np.flatnonzero(root != np.arange(len(own)))
                us.append(own[moved])
                vs.append(own[root[moved]])
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x).view(np.int64)) for x in (us, vs)], names=["u", "v"])

        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            posts = batch.column("post").to_numpy()
            fps = batch.column("fp").to_numpy().view(np.uint64)
            if not len(posts):
                continue
            # the last posting of a batch may go on in the next
            cut = int(np.searchsorted(posts, posts[-1]))
            if cut or (held and held[-1][0][-1] != posts[0]):
                held.append((posts[:cut], fps[:cut]))
                yield linked(*(np.concatenate(x) for x in zip(*held)))
                held = []
            held.append((posts[cut:], fps[cut:]))
        if held:
            yield linked(*(np.concatenate(x) for x in zip(*held)))

    return (index.repartition("post").sortWithinPartitions("post")
            .mapInArrow(join, "u long, v long").distinct())


def near_duplicates(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, th, fp, component_id`` and ``head`` (``ord, th`` of the row
    that stands for the component) of each row of ``docs(doc_id, text)``."""
    rows = staged(spark, fingerprints(docs, shingle), "simhash")
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("low"),
                                     F.min(F.struct(order_id().alias("ord"), "th")).alias("head"))
    classes = staged(spark, classes, "simhash-classes")
    found = components(spark, links(classes.select("fp"), max_bits))
    rooted = classes.join(found, classes["fp"] == found["node"], "left").select(
        "fp", "low", "head", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("low").alias("component_id"), F.min("head").alias("head"))
    named = staged(spark, rooted.select("fp", "root").join(named, "root")
                   .select("fp", "component_id", "head"), "simhash-components")
    return rows.join(named, "fp").select("doc_id", "th", "fp", "component_id", "head")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.plans.tables import table

    found = near_duplicates(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        "component_id")


def one_of_each_group(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents without near duplicates: of each group the row with the
    smallest id (then text hash) stays, once."""
    heads = near_duplicates(spark, docs).select("head.ord", "head.th").distinct()
    heads = staged(spark, heads, "simhash-heads")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       order_id().alias("ord"), F.xxhash64("text").alias("th"))
    return (rows.join(heads, ["ord", "th"], "left_semi").dropDuplicates(["ord", "th"])
            .select("row.*"))

"""Suffix-array dedup: removal of byte strings that an earlier document holds.

Every byte covered by a string of ``LENGTH`` bytes that also starts in a
document with a smaller id is removed; matches never cross documents and are
judged on the input.

1. Texts are packed into shards of some megabytes (a table).
2. Each string of ``LENGTH`` bytes is named by the smallest hash of the grams
   of ``GRAM`` bytes in it, which depends on nothing but its bytes; a run of
   strings with one name is a segment, about 13 strings long.  Names that two
   documents hold are found over all shards.  Only their segments go on: a
   string whose name is in one document is in no other.
3. Segments meet by name.  Equal segments are one, with their smallest id; a
   segment that alone has its name shares no string with another.  The
   others are dealt into runs of ``RUN_BYTES``.  For each run the
   suffix array is built by Larsson-Sadakane refinement to depth ``LENGTH``
   (only groups that are still tied are sorted again), and Kasai's common
   prefixes split it into classes of equal strings.  The runs' sorted classes
   are merged by binary search, which gives each string its smallest id.
4. What has a smaller id elsewhere goes back to its shard and is cut out.

All strings of a name meet in one group.  A name in more than ``HOT_SHARDS``
shards is dealt by the hash of each whole string instead, so its strings
spread over all groups.  Equal segments of one shard travel once, with a list of
their starts; those of a larger id than the shard's smallest stay behind.

Cases: a null text is empty; a null id comes after all others, and rows with
equal (or null) ids do not remove from each other; texts under ``LENGTH`` bytes
stay; a text of any length is in one shard and must fit a task several times
over; no rows, no result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import order_id, staged, text_slices

LENGTH = 50
GRAM = 26
GROUP_BYTES = 8 << 20   # text for which one group of names is planned
RUN_BYTES = 2 << 20
HOT_SHARDS = 512
CHUNK = 1 << 16
PIECE = 64               # strings of one segment at most
LANE = 256

_P = 0x9E3779B97F4A7C15
_NONE = np.uint64(0)


# -- names ---------------------------------------------------------------------

def gram_hash(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash (never 0) of the ``size`` bytes at each position, by doubling."""
    out, have, start = None, 0, 0
    power, width, base = data.astype(np.uint64) + np.uint64(1), 1, _P
    while True:
        if size & width:
            # append the next ``width`` bytes to what is covered already
            part = power[start:]
            out = part if out is None else out[:len(part)] * np.uint64(base) + part
            have, start = have + width, start + width
        if have == size:
            break
        n = len(power) - width
        if n <= 0:
            return np.empty(0, np.uint64)
        power = power[:n] * np.uint64(base) + power[width:]
        base, width = base * base % (1 << 64), width * 2
    out = out[:max(0, len(data) - size + 1)].copy()
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(29)
    return np.maximum(out, np.uint64(1))


def sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    have = 1
    while have < size:
        step = min(have, size - have)
        x = np.minimum(x[:len(x) - step], x[step:])
        have += step
    return x


def names(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The name of the string at each position of the packed texts that end at
    ``ends``; 0 where a string does not fit its text."""
    n = len(data)
    out = np.zeros(n, np.uint64)
    for start in range(0, n - LENGTH + 1, CHUNK):
        stop = min(n, start + CHUNK + LENGTH - 1)
        own = sliding_min(gram_hash(data[start:stop], GRAM), LENGTH - GRAM + 1)
        out[start:start + len(own)] = own
    for end, begin in zip(ends, np.append(0, ends[:-1])):
        out[max(begin, end - LENGTH + 1):end] = 0
    return out


def segments(named: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and numbers of strings of the runs with one name, in pieces."""
    if not len(named):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cut = np.append(True, named[1:] != named[:-1])
    cut[ends[ends < len(named)]] = True
    starts = np.flatnonzero(cut)
    sizes = np.diff(np.append(starts, len(named)))
    kept = named[starts] != _NONE
    starts, sizes = starts[kept], sizes[kept]
    pieces = -(-sizes // PIECE)
    at = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = np.repeat(starts, pieces) + at * PIECE
    return starts, np.minimum(np.repeat(sizes, pieces) - at * PIECE, PIECE)


# -- suffix arrays ---------------------------------------------------------------

def eight_bytes(text: np.ndarray) -> np.ndarray:
    """The eight bytes at each position as a number that orders like them."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    out = np.zeros(len(text), np.uint64)
    for j in range(8):
        out = (out << np.uint64(8)) | padded[j:j + len(text)]
    return out


def suffix_array(text: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Positions in the order of their next ``depth`` bytes, by Larsson-Sadakane
    refinement: order by 8 bytes, then by the rank further on, again and again
    inside the groups that are still tied."""
    n = len(text)
    key = eight_bytes(text)
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    fresh = np.append(True, ordered[1:] != ordered[:-1])
    sorted_to = 8
    while True:
        first = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        rank = np.empty(n + depth, np.int64)
        rank[order] = first
        rank[n:] = -1
        tied = np.flatnonzero(~fresh | ~np.append(fresh[1:], True))
        if sorted_to >= depth or not len(tied):
            return order
        # a step of the sorted depth doubles it; the last one overlaps
        step = min(sorted_to, depth - sorted_to)
        rows = order[tied]
        key = first[tied] * np.int64(n + 1) + rank[rows + step] + 1
        again = np.argsort(key, kind="stable")
        order[tied], key = rows[again], key[again]
        fresh[tied] = np.append(True, key[1:] != key[:-1])
        sorted_to += step


def common_prefixes(text: np.ndarray, order: np.ndarray, limit: int = LENGTH) -> np.ndarray:
    """Kasai: common prefix (up to ``limit``) of each suffix in ``order`` with
    the one before it.  The text is walked in lanes side by side; each position
    starts from its predecessor's prefix less one where that still holds."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(limit + 8, np.uint8)])
    eight = eight_bytes(padded)
    place = np.full(n + 1, -1)
    place[order] = np.arange(len(order))
    before = np.full(n + 1, -1)
    before[order[1:]] = order[:-1]
    out = np.zeros(n, np.int64)
    lanes = np.arange(0, n, LANE)
    held, last = np.zeros(len(lanes), np.int64), np.full(len(lanes), -1)
    for t in range(min(LANE, n)):
        p = lanes + t
        on = np.flatnonzero(p < n)
        p = p[on]
        q = before[p]
        # the prefix less one holds if the old neighbour's next suffix is in the order, ahead
        follow = np.where(last[on] >= 0, place[last[on] + 1], -1)
        h = np.where((follow >= 0) & (follow < place[p]), np.maximum(held[on] - 1, 0), 0)
        h[q < 0] = 0
        go = np.flatnonzero((q >= 0) & (h < limit))
        while len(go):
            same = eight[p[go] + h[go]] == eight[q[go] + h[go]]
            go = go[same]
            h[go] += 8
            go = go[h[go] < limit]
        short = np.flatnonzero((q >= 0) & (h < limit))
        while len(short):
            same = padded[p[short] + h[short]] == padded[q[short] + h[short]]
            short = short[same]
            h[short] += 1
            short = short[h[short] < limit]
        h = np.minimum(h, limit)
        out[p] = h
        held[on], last[on] = h, q
    return out[order]


def run_classes(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct strings of the pieces, and for each string its piece
    and class."""
    text = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.array([len(p) for p in pieces])
    ends = np.cumsum(sizes)
    piece = np.repeat(np.arange(len(pieces)), sizes)
    whole = np.arange(len(text)) + LENGTH <= ends[piece]
    order = suffix_array(text)
    order = order[whole[order]]
    fresh = common_prefixes(text, order) < LENGTH
    fresh[:1] = True
    grams = text[order[fresh][:, None] + np.arange(LENGTH)]
    keys = np.ascontiguousarray(grams).view(f"S{LENGTH}").ravel()
    classes = np.full(len(text), -1)
    classes[order] = np.cumsum(fresh) - 1
    at = np.flatnonzero(whole)
    return keys, piece[at], classes[at]


def merge(runs: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """For sorted ``(strings, ids)`` of each run, the smallest id of each string
    over all runs, by binary search of each run in the union."""
    keys, low = runs[0]
    for other, ids in runs[1:]:
        at = np.searchsorted(keys, other)
        known = at < len(keys)
        known[known] = keys[at[known]] == other[known]
        low = low.copy()
        low[at[known]] = np.minimum(low[at[known]], ids[known])
        keys = np.insert(keys, at[~known], other[~known])
        low = np.insert(low, at[~known], ids[~known])
    return [low[np.searchsorted(keys, own)] for own, _ in runs]


def smallest_ids(pieces: list[bytes], ids: np.ndarray, run_bytes: int) -> list[np.ndarray]:
    """For each of the distinct pieces the smallest id of each of its strings."""
    if not pieces:
        return []
    runs, first, size = [], 0, 0
    bounds = []
    for i, piece in enumerate(pieces):
        size += len(piece)
        if size >= run_bytes or i == len(pieces) - 1:
            bounds.append((first, i + 1))
            first, size = i + 1, 0
    for a, b in bounds:
        keys, piece, classes = run_classes(pieces[a:b])
        low = np.full(len(keys), np.iinfo(np.int64).max)
        np.minimum.at(low, classes, ids[a:b][piece])
        runs.append((keys, low, piece, classes))
    merged = merge([(keys, low) for keys, low, _, _ in runs])
    out = []
    for (a, b), (_, _, piece, classes), low in zip(bounds, runs, merged):
        cuts = np.searchsorted(piece, np.arange(1, b - a))
        out += np.split(low[classes], cuts)
    return out


# -- tables ---------------------------------------------------------------------

def _raw(*arrays: np.ndarray, data: bytes = b"") -> bytes:
    """Arrays of one length and bytes."""
    return np.int64(len(arrays[0])).tobytes() + b"".join(a.tobytes() for a in arrays) + data


def _unraw(body: bytes, *kinds) -> tuple:
    n = int(np.frombuffer(body, np.int64, 1)[0])
    out, at = [], 8
    for kind in kinds:
        out.append(np.frombuffer(body, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return (*out, body[at:])


def _pack(*arrays: np.ndarray, data: bytes = b"") -> bytes:
    body = _raw(*arrays, data=data)
    return np.int64(len(body)).tobytes() + pa.compress(body, codec="zstd", asbytes=True)


def _unpack(blob: bytes, *kinds) -> tuple:
    size = int(np.frombuffer(blob, np.int64, 1)[0])
    return _unraw(pa.decompress(blob[8:], size, codec="zstd", asbytes=True), *kinds)


def shards(docs: DataFrame) -> DataFrame:
    """``shard`` and ``texts``: ids (null: the largest), whether there is one,
    ends and bytes of some megabytes of texts."""
    rows = docs.select(order_id().alias("ord"), F.col("doc_id").isNotNull().alias("has"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"),
                       F.spark_partition_id().alias("part"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in text_slices(batches, "text"):
            data = [t.encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
            ends = np.cumsum([len(d) for d in data]).astype(np.int64)
            blob = _pack(batch.column("ord").to_numpy(), ends,
                         batch.column("has").to_numpy(zero_copy_only=False), data=b"".join(data))
            shard = (batch.column("part")[0].as_py() << 32) + number
            number += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int64()), pa.array([int(ends[-1])], pa.int64()),
                 pa.array([blob], pa.binary())], names=["shard", "size", "texts"])

    return rows.mapInArrow(pack, "shard long, size long, texts binary")


def _open(blob: bytes) -> tuple:
    ids, ends, has, data = _unpack(blob, np.int64, np.int64, bool)
    return ids, ends, has, data


def _by_group(values: np.ndarray, groups: int) -> Iterator[tuple[int, np.ndarray]]:
    """Positions of ``values`` by their group."""
    group = (values % np.uint64(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    cuts = np.flatnonzero(np.append(True, np.diff(group[order]) != 0))
    for a, b in zip(cuts, np.append(cuts[1:], len(order))):
        if b > a:
            yield int(group[order[a]]), order[a:b]


def shared_names(packed: DataFrame, groups: int, hot_shards: int) -> DataFrame:
    """``shard, part, marks``: of each shard's distinct names of group ``part``
    (in order) 1 if another shard holds it, 2 if very many do."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                _, ends, _, data = _open(blob)
                named = names(np.frombuffer(data, np.uint8), ends)
                starts, _ = segments(named, ends)
                own = np.unique(named[starts])
                parts, blobs = [], []
                for part, at in _by_group(own, groups):
                    rest = own[at] >> np.uint64(24)  # 40 bits beside the group
                    parts.append(part)
                    blobs.append((rest & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes()
                                 + (rest >> np.uint64(32)).astype(np.uint8).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * len(parts), pa.int64()), pa.array(parts, pa.int64()),
                     pa.array(blobs, pa.binary())], names=["shard", "part", "names"])

    def share(group: pa.Table) -> pa.Table:
        blobs = group.column("names").to_pylist()
        sizes = [len(b) // 5 for b in blobs]
        own = np.concatenate([np.frombuffer(b, np.uint32, n).astype(np.uint64)
                              | (np.frombuffer(b, np.uint8, n, 4 * n).astype(np.uint64) << np.uint64(32))
                              for b, n in zip(blobs, sizes)])
        _, which, count = np.unique(own, return_inverse=True, return_counts=True)
        marks = ((count > 1).astype(np.uint8) + (count > hot_shards))[which].astype(np.uint8)
        cuts = np.split(marks, np.cumsum(sizes)[:-1])
        return pa.table({"shard": group.column("shard"), "part": group.column("part"),
                         "marks": pa.array([_pack(m) for m in cuts], pa.binary())})

    return (packed.select("shard", "texts").mapInArrow(emit, "shard long, part long, names binary")
            .groupBy("part").applyInArrow(share, "shard long, part long, marks binary"))


def shared_segments(packed: DataFrame, marked: DataFrame, groups: int) -> DataFrame:
    """``part, shard, found``: segments whose names are shared, by group;
    negative parts have what a smaller id in the same shard holds: starts and
    lengths."""
    per_shard = marked.groupBy("shard").agg(F.collect_list(F.struct("part", "marks")).alias("marked"))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 1) for b in batches for i in range(b.num_rows)):
            shard, blob, marked = (batch.column(i)[0].as_py() for i in range(3))
            ids, ends, _, data = _open(blob)
            named = names(np.frombuffer(data, np.uint8), ends)
            starts, sizes = segments(named, ends)
            own, first, which = np.unique(named[starts], return_index=True, return_inverse=True)
            text = np.searchsorted(ends, starts, "right")
            mark = np.zeros(len(own), np.uint8)
            parts = {m["part"]: m["marks"] for m in marked}
            for part, at in _by_group(own, groups):
                mark[at] = _unpack(parts[part], np.uint8)[0]
            # names that two texts of this shard hold
            low, high = text[first], np.zeros(len(own), np.int64)
            np.maximum.at(high, which, text)
            kept = np.flatnonzero(((mark > 0) | (high > low))[which])
            starts, sizes, text, which = starts[kept], sizes[kept], text[kept], which[kept]
            lengths = sizes + LENGTH - 1
            value = own[which]
            hot = mark[which] > 1
            if hot.any():
                # single strings, dealt by their own hash
                at = np.flatnonzero(hot)
                n = sizes[at]
                single = np.repeat(starts[at], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                grid = np.frombuffer(data, np.uint8)[single[:, None] + np.arange(LENGTH)].astype(np.uint64)
                hashed = np.full(len(single), _P, np.uint64)
                for j in range(LENGTH):
                    hashed = (hashed ^ grid[:, j]) * np.uint64(0x100000001B3)
                starts = np.concatenate([starts[~hot], single])
                lengths = np.concatenate([lengths[~hot], np.full(len(single), LENGTH)])
                text = np.concatenate([text[~hot], np.repeat(text[at], n)])
                value = np.concatenate([value[~hot], hashed ^ (hashed >> np.uint64(29))])
            owner = ids[text]
            pieces = [data[s:s + n] for s, n in zip(starts.tolist(), lengths.tolist())]
            number: dict[bytes, int] = {}
            which = np.array([number.setdefault(p, len(number)) for p in pieces], np.int64)
            lowest = np.full(len(number), np.iinfo(np.int64).max)
            np.minimum.at(lowest, which, owner)
            held = owner > lowest[which]
            out_part, out = [-1 - shard % groups], [_pack(starts[held].astype(np.int64), lengths[held].astype(np.int64))]
            # what is left of equal pieces has one id: they travel once, with their starts
            rest = np.flatnonzero(~held)
            _, one, of = np.unique(which[rest], return_index=True, return_inverse=True)
            dealt = value[rest[one]]
            for (part, distinct), (_, every) in zip(_by_group(dealt, groups), _by_group(dealt[of], groups)):
                at = rest[one[distinct]]
                out_part.append(part)
                tag = (value[at] >> np.uint64(32)).astype(np.uint32)
                own = _raw(lengths[at].astype(np.int64), owner[at], tag, data=b"".join([pieces[i] for i in at]))
                out.append(_pack(starts[rest[every]].astype(np.int64),
                                 np.searchsorted(distinct, of[every]).astype(np.int64), data=own))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_part, pa.int64()), pa.array([shard] * len(out), pa.int64()),
                 pa.array(out, pa.binary())], names=["part", "shard", "found"])

    return (packed.join(per_shard, "shard", "left")
            .select("shard", "texts", F.coalesce("marked", F.array().cast(
                per_shard.schema["marked"].dataType)).alias("marked"))
            .mapInArrow(emit, "part long, shard long, found binary"))


def repeats(found: DataFrame, run_bytes: int) -> DataFrame:
    """``shard, gone``: starts and lengths of bytes that a smaller id holds."""

    def settle(group: pa.Table) -> pa.Table:
        if group.column("part")[0].as_py() < 0:  # settled in its shard
            return pa.table({"shard": group.column("shard").cast(pa.int64()),
                             "gone": group.column("found").cast(pa.binary())})
        rows = []
        number: dict[bytes, int] = {}
        lowest: list[int] = []
        tagged: list[int] = []
        for blob in group.column("found"):
            starts, of, own = _unpack(blob.as_py(), np.int64, np.int64)
            lengths, ids, tags, data = _unraw(own, np.int64, np.int64, np.uint32)
            cuts = np.append(0, np.cumsum(lengths)).tolist()
            which = []
            for a, b, i, tag in zip(cuts, cuts[1:], ids.tolist(), tags.tolist()):
                n = number.setdefault(data[a:b], len(lowest))
                if n == len(lowest):
                    lowest.append(i)
                    tagged.append(tag)
                elif i < lowest[n]:
                    lowest[n] = i
                which.append(n)
            which = np.array(which, np.int64)[of].tolist()
            lengths, ids = lengths[of], ids[of]
            rows.append((starts.copy(), lengths.copy(), ids.copy(), which))
        # a segment that alone has its name shares no string with another
        _, same, count = np.unique(np.array(tagged, np.uint32), return_inverse=True, return_counts=True)
        several = np.flatnonzero(count[same] > 1) if tagged else np.empty(0, np.int64)
        low_id = np.array(lowest, np.int64)
        wanted = set(several.tolist())
        pieces = [piece for piece, n in number.items() if n in wanted]
        number.clear()
        low = smallest_ids(pieces, low_id[several], run_bytes)
        # strings of a segment that a smaller id than the segment's own holds
        partly = {n: own for n, own in zip(several.tolist(), low) if (own < lowest[n]).any()}
        out = []
        for starts, lengths, ids, which in rows:
            later = np.flatnonzero(ids > low_id[which]) if which else np.empty(0, np.int64)
            gone_at, gone_for = [starts[later]], [lengths[later]]
            for k, n in enumerate(which):
                if n in partly and ids[k] == low_id[n]:
                    at = starts[k] + np.flatnonzero(partly[n] < ids[k])
                    gone_at.append(at)
                    gone_for.append(np.full(len(at), LENGTH))
            out.append(_pack(np.concatenate(gone_at).astype(np.int64),
                             np.concatenate(gone_for).astype(np.int64)))
        return pa.table({"shard": group.column("shard").cast(pa.int64()),
                         "gone": pa.array(out, pa.binary())})

    return found.groupBy("part").applyInArrow(settle, "shard long, gone binary")


def dedup(spark: SparkSession, docs: DataFrame, run_bytes: int = RUN_BYTES,
          group_bytes: int = GROUP_BYTES, hot_shards: int = HOT_SHARDS) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the remaining bytes) of
    each row of ``docs(doc_id, text)``."""
    packed = staged(spark, shards(docs), "suffix-shards")
    total = packed.agg(F.sum("size")).first()[0] or 0
    groups = max(16, -(-total // group_bytes))
    marked = staged(spark, shared_names(packed, groups, hot_shards), "suffix-names")
    found = shared_segments(packed, marked, groups)
    gone = staged(spark, repeats(found, run_bytes), "suffix-repeats")
    per_shard = gone.groupBy("shard").agg(F.collect_list("gone").alias("gone"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 1) for b in batches for i in range(b.num_rows)):
            blob, blobs = batch.column("texts")[0].as_py(), batch.column("gone")[0].as_py() or []
            ids, ends, has, data = _open(blob)
            delta = np.zeros(len(data) + 1, np.int32)
            for b in blobs:
                starts, lengths, _ = _unpack(b, np.int64, np.int64)
                np.add.at(delta, starts, 1)
                np.add.at(delta, starts + lengths, -1)
            gone = np.cumsum(delta[:-1]) > 0
            raw = np.frombuffer(data, np.uint8)
            begins = np.append(0, ends[:-1])
            removed, spans, kept = [], [], []
            for a, b in zip(begins.tolist(), ends.tolist()):
                own = gone[a:b]
                removed.append(int(own.sum()))
                spans.append(int(own[:1].sum() + (own[1:] & ~own[:-1]).sum()))
                kept.append(raw[a:b][~own].tobytes() if removed[-1] else data[a:b])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64(), mask=~has), pa.array(ends - begins, pa.int64()),
                 pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                 pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return (packed.join(per_shard, "shard", "left").select("texts", "gone")
            .mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.plans.tables import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup(spark, docs).select("doc_id", "n_bytes", "n_removed", "n_spans",
                                     F.sha2("kept", 256).alias("kept_sha256"))

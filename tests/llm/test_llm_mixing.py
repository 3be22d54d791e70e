import hashlib
import math
import re
import tempfile
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import python_nodes
from sluice.llm import mixing as M

DDL = "doc_id long, text string, source string, size string, target int"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", 1) for i, t, s in rows], DDL)


def _rows():
    rows = [(i, " ".join(["w"] * (1 + i % 37)), f"s{i % 5}" if i % 3 else "hot") for i in range(400)]
    return rows + [(1000, "a b", None), (1001, None, "s1"), (1002, " \t\n", "s1"),
                   (1003, "  x y", "é"), (None, "a b c", "s2"), (5, "p q", "hot"), (5, "p q", "hot")]


def waterfill(sizes, weights):
    target = {s: 0.0 for s in sizes}
    free = {s for s in sizes if sizes[s]}
    left = 1.5 * sum(sizes.values())
    while free:
        level = left / sum(weights[s] for s in free)
        full = {s for s in free if level * weights[s] >= 2 * sizes[s]}
        if not full:
            for s in free:
                target[s] = level * weights[s]
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= 2 * sizes[s]
        free -= full
    return target


def test_targets_and_exact_quotas(spark):
    docs = _docs(spark, _rows())
    rows = M.mix(spark, docs, block_words=16, shard_blocks=20, bucket_rows=8).collect()
    assert len(rows) == len(_rows())
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += r["size"]
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    expected = waterfill(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    taken = Counter()
    for r in rows:
        taken[r["source"]] += r["taken"]
        assert r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - expected[r["source"]]) < 1e-6
        assert 0 <= r["taken"] <= 2 * r["size"]
    for s in sizes:
        assert abs(taken[s] - expected[s]) <= 0.5


def test_draws_are_disjoint_and_shards_even(spark):
    rows = M.mix(spark, _docs(spark, _rows()), block_words=16, shard_blocks=20).collect()
    words, places = Counter(), defaultdict(set)
    for r in rows:
        spans = sorted((d["pass"], d["first"], d["last"]) for d in r["draws"])
        for a, b in zip(spans, spans[1:]):
            assert a[0] < b[0] or a[2] <= b[1]  # no word twice in a pass
        assert all(0 <= a < b <= r["size"] for _, a, b in spans)
        for d in r["draws"]:
            words[d["shard"]] += d["last"] - d["first"]
            places[(r["source"], d["place"])].add(d["shard"])
    assert all(len(s) == 1 for s in places.values())  # a block is in one shard
    n = len(words)
    assert n & (n - 1) == 0 and n > 4
    assert max(words.values()) <= 1.5 * sum(words.values()) / n


def test_reruns_agree_whatever_the_partitions(spark):
    key = lambda df: sorted(map(repr, df.select("doc_id", "size", "taken", "draws").collect()))
    docs = _docs(spark, _rows())
    base = key(M.mix(spark, docs, shard_blocks=2, block_words=64))
    assert key(M.mix(spark, docs.repartition(7), shard_blocks=2, block_words=64)) == base
    # the size of a bucket does not matter
    assert key(M.mix(spark, docs, shard_blocks=2, block_words=64, bucket_rows=3)) == base


def test_hypergeometric_draws(spark):
    # 4000 draws: 30 of 100 blocks, 40 of them of the kind; mean 12, variance 5.09
    nodes = spark.range(4000).select(F.col("id").alias("node"), F.array(
        *[F.lit(x).cast("long") for x in (24, 36)]).alias("quotas"))
    left = [r["quotas"] for r in M.split(nodes).where("node % 2 = 0").collect()]
    assert all(sum(q) == 30 and 0 <= q[0] <= 24 for q in left)
    mean = sum(q[0] for q in left) / len(left)
    variance = sum((q[0] - mean) ** 2 for q in left) / len(left)
    expected = 30 * 24 / 60 * 36 / 60 * 30 / 59
    assert abs(mean - 12) < 0.15 and abs(variance - expected) < 0.3


@pytest.mark.parametrize("rows", [[], [(1, None, "a"), (2, "", None)], [(1, "one", "a")]])
def test_small_tables(spark, rows):
    out = M.mix(spark, _docs(spark, rows)).collect()
    assert len(out) == len(rows)
    assert sum(r["taken"] for r in out) == {0: 0, 2: 0, 1: 2}[len(rows)]


def test_native(spark):
    assert python_nodes(M.mix(spark, _docs(spark, _rows()))) == []


def test_few_blocks_are_permuted(spark):
    # eight sources of three, five or six blocks
    docs = _docs(spark, [(i, "w " * 16, f"s{i % 8}") for i in range(48)])
    rows = M.mix(spark, docs, block_words=32, shard_blocks=1).collect()
    order = defaultdict(set)
    for r in rows:
        h = hashlib.md5(f"mix|{r['doc_id']}".encode()).hexdigest()
        for d in r["draws"]:
            order[r["source"]].add((d["pass"], h, d["first"], d["shard"], d["place"]))
    few = [sorted(own) for own in order.values() if len({x[4] for x in own}) in (3, 6)]
    shards = [[x[3] for x in own] for own in few]
    assert len(few) > 3 and any(own != sorted(own) for own in shards)
    # and it is a permutation: all places are blocks of 32 words, the last may be shorter
    words = Counter()
    for r in rows:
        for d in r["draws"]:
            words[(r["source"], d["place"])] += d["last"] - d["first"]
    short = Counter(s for (s, _), n in words.items() if n < 32)
    assert max(words.values()) <= 32 and max(short.values(), default=0) <= 1


def test_drawn_words(spark):
    docs = _docs(spark, [(i, None if t is None else " ".join(f"{w}{j}" for j, w in enumerate(t.split())), s)
                         for i, t, s in _rows()])
    plan = M.mix(spark, docs, block_words=16, shard_blocks=20)
    plan.write.parquet(path := tempfile.mkdtemp(prefix="mixed-") + "/plan")
    plan = spark.read.parquet(path)
    text = {}
    for r in docs.collect():
        text.setdefault((r["doc_id"], r["source"]), (r["text"] or "").split())
    wanted = Counter()
    for r in plan.collect():
        own = text[(r["doc_id"], r["source"])]
        for d in r["draws"]:
            wanted[(d["shard"], d["place"], " ".join(own[d["first"]:d["last"]]))] += 1
    out = M.drawn(docs, plan)
    assert python_nodes(out) == []
    rows = out.withColumn("part", F.spark_partition_id()).collect()
    assert Counter((r["shard"], r["place"], r["text"]) for r in rows) == wanted
    parts = defaultdict(set)
    for r in rows:
        parts[r["shard"]].add(r["part"])
    assert len(parts) > 4 and all(len(p) == 1 for p in parts.values())
    for part in {r["part"] for r in rows}:
        own = [(r["shard"], r["place"]) for r in rows if r["part"] == part]
        assert own == sorted(own)


# -- the tree and the permutation, plainly ----------------------------------------

MASK = (1 << 64) - 1


def spark_hash(*parts):
    """Spark's XXH64 of texts, ints (4 bytes) marked by a tuple, and longs (8)."""
    h = 42
    for p in parts:
        raw = p.encode() if isinstance(p, str) else p[0].to_bytes(4, "little", signed=True) \
            if isinstance(p, tuple) else p.to_bytes(8, "little", signed=True)
        h = xxhash.xxh64_intdigest(raw, h)
    return h - (1 << 64) if h >> 63 else h


def hypergeometric(n, k, draws, u):
    if k == 0 or draws == 0:
        return 0
    if draws == n:
        return k
    p = k / n
    mean = draws * p
    sd = math.sqrt(max(0.0, mean * (1 - p) * (n - draws) / max(n - 1, 1)))
    low = max(0, draws - (n - k), math.floor(mean - 12 * sd - 12))
    high = min(draws, k, math.ceil(mean + 12 * sd + 12))
    weights, value = [], 1.0
    for x in range(low, high + 1):
        weights.append(value)
        value = value * ((k - x) * float(draws - x)) / (float(x + 1) * (n - k - draws + x + 1))
    total, sums = sum(weights), 0.0
    for x, v in zip(range(low, high + 1), weights):
        sums += v
        if sums >= u * total:
            return x
    return high


def brute_ranges(quotas, depth):
    """``{(rank, shard): (low, high)}``."""
    nodes = {1: (list(quotas), [0] * len(quotas))}
    for _ in range(depth):
        below = {}
        for node, (own, starts) in nodes.items():
            rest = sum(own)
            left, draws = [], rest // 2
            for i, q in enumerate(own):
                u = spark_hash("tree", node, (i,)) % 9007199254740992 / 9007199254740992
                x = hypergeometric(rest, q, draws, u)
                left.append(x)
                rest, draws = rest - q, draws - x
            below[node * 2] = (left, starts)
            below[node * 2 + 1] = ([q - x for q, x in zip(own, left)], [s + x for s, x in zip(starts, left)])
        nodes = below
    return {(i + 1, node - 2 ** depth): (s, s + q) for node, (own, starts) in nodes.items()
            for i, (q, s) in enumerate(zip(own, starts)) if q}


def permuted(b, rank, blocks):
    for r in range(M.SHUFFLE_ROUNDS):
        y = (spark_hash(M.SEED, "key", (rank,), (r,)) % blocks - b) % blocks
        if spark_hash(M.SEED, "swap", (rank,), (r,), max(b, y)) % 2:
            b = y
    return b


def brute_draws(docs, block_words, shard_blocks):
    """``(doc_id, source, pass, first, last, shard, place)`` of every draw; ids
    are unique."""
    sizes = {(i, s): len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, s in docs}
    by = Counter()
    for (_, s), n in sizes.items():
        by[s] += n
    order = sorted(by, key=lambda s: (s is None, s or ""))
    target = waterfill(by, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    quota = {s: math.floor(target[s] + 0.5) for s in order}
    blocks = {s: -(-quota[s] // block_words) for s in order}
    depth = max(M.MIN_DEPTH, math.ceil(math.log2(max(1, sum(blocks.values()) / shard_blocks))))
    ranges = brute_ranges([blocks[s] for s in order], depth)
    out = []
    for rank, s in enumerate(order, 1):
        stream = sorted((hashlib.md5(f"mix|{'' if i is None else i}".encode()).hexdigest(), i)
                        for i, own in sizes if own == s)
        start = 0
        for _, i in stream:
            n = sizes[i, s]
            for p in range(M.MAX_PASSES):
                low, high = start + p * by[s], min(quota[s], start + p * by[s] + n)
                for b in range(low // block_words, -(-high // block_words)) if low < high else ():
                    first, last = max(low, b * block_words), min(high, (b + 1) * block_words)
                    k = permuted(b, rank, blocks[s])
                    shard = next(sh for (rk, sh), (x, y) in ranges.items() if rk == rank and x <= k < y)
                    out.append((i, s, p, first - low, last - low, shard, spark_hash(M.SEED, (rank,), k)))
            start += n
    return out


def _unique_rows():
    seen = {}
    for i, t, s in _rows():
        seen.setdefault(i, (i, t, s))
    return [*seen.values(), (5000, "long " * 20_000, "hot")]


@pytest.mark.parametrize("block_words, shard_blocks", [(16, 20), (4096, 4096), (64, 1)])
def test_plan_agrees_with_brute_force(spark, block_words, shard_blocks):
    docs = _unique_rows()
    plan = M.mix(spark, _docs(spark, docs), block_words, shard_blocks, bucket_rows=40)
    got = [(r["doc_id"], r["source"], d["pass"], d["first"], d["last"], d["shard"], d["place"])
           for r in plan.collect() for d in r["draws"]]
    assert sorted(got, key=repr) == sorted(brute_draws(docs, block_words, shard_blocks), key=repr)


def test_no_row_grows_with_the_shards(spark):
    docs = _docs(spark, _unique_rows())
    for blocks in (1, 50):
        df = M.mix(spark, docs, block_words=16, shard_blocks=blocks)
        kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        assert [k for k, v in kinds.items() if v.startswith("array")] == ["draws"]
        # draws are a text's blocks, whatever the number of shards
        assert all(len(r["draws"]) <= 2 * (r["size"] // 16 + 2) for r in df.collect())
    assert M.deal.__name__ and all(not f.dataType.simpleString().startswith("array") for f in M.deal(
        spark.createDataFrame([(1, 40, 2), (2, 9, 1)], "rank int, blocks long, width long"), 5).schema.fields)


def test_ranges_cover_every_block_once(spark):
    sources = spark.createDataFrame([(1, 1000, 3), (2, 7, 1), (3, 0, 1), (4, 90, 1)], "rank int, blocks long, width long")
    ranges = M.deal(sources, 10).collect()
    found = {(r["rank"], r["shard"], r["low"], r["high"]) for r in ranges}
    for rank, blocks in ((1, 1000), (2, 7), (3, 0), (4, 90)):
        assert sorted(b for rk, _, a, z in found if rk == rank for b in range(a, z)) == list(range(blocks))
    assert all(r["low"] // w <= r["stretch"] <= (r["high"] - 1) // w
               for r in ranges for w in [{1: 3}.get(r["rank"], 1)])

import random

import numpy as np
import pytest

from sluice.llm import suffix_dedup as S


def brute(rows):
    top = float("inf")
    first = {}
    data = [(top if i is None else i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for p in range(len(b) - 49):
            g = b[p:p + 50]
            first[g] = min(first.get(g, top), i)
    out = []
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] < i:
                gone[p:p + 50] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        out.append((None if i == top else i, len(b), int(gone.sum()), spans, kept))
    return sorted(out, key=repr)


def _rows(seed):
    rng = random.Random(seed)
    letters = "ab é\0" if seed % 2 else "abcdefghij "
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [text(rng.randrange(30, 200)) for _ in range(6)]
    rows = []
    for i in range(40):
        parts = [rng.choice(passages) if rng.random() < 0.4 else text(rng.randrange(90))
                 for _ in range(rng.randrange(6))]
        rows.append((i * 3 - 20, "".join(parts)))
    rows += [(500, rows[3][1]), (501, "x" * 400), (502, "x" * 49), (503, "y" + "x" * 60), (504, None),
             (505, ""), (7, rows[3][1]), (7, rows[3][1]), (None, passages[0]), (None, passages[0]),
             (506, "\0" * 120), (507, "\0" * 70)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, options", [
    (0, {}), (1, {}), (2, {"hot_shards": 1}), (3, {"hot_shards": 1, "run_bytes": 300}),
    (4, {"run_bytes": 200, "group_bytes": 1000})])
def test_agrees_with_brute_force(spark, seed, options):
    rows = _rows(seed)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows],
                                 "doc_id long, text string, n_bytes int, kept string").repartition(5)
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]))
           for r in S.dedup(spark, docs, **options).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_no_documents_and_only_empty_ones(spark):
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert S.dedup(spark, docs.limit(0)).count() == 0
    assert sorted(r["n_bytes"] for r in S.dedup(spark, docs).collect()) == [0, 0]


@pytest.mark.parametrize("letters", [1, 2, 30])
def test_suffix_order_and_common_prefixes(letters):
    rng = np.random.default_rng(letters)
    text = rng.integers(97, 97 + letters, 1500).astype(np.uint8)
    text[700:900] = text[100:300]
    order = S.suffix_array(text)
    padded = text.tobytes() + b"\0" * 50
    keys = [padded[i:i + 50] for i in order]
    assert sorted(order.tolist()) == list(range(len(text))) and keys == sorted(keys)

    def common(a, b):
        return next((n for n in range(50) if a[n] != b[n]), 50)

    assert S.common_prefixes(text, order).tolist() == [0] + [common(a, b) for a, b in zip(keys, keys[1:])]


def test_names_depend_on_bytes_alone():
    rng = np.random.default_rng(0)
    own = rng.integers(0, 4, 90).astype(np.uint8)
    one = S.names(own, np.array([90]))
    assert (one[:41] > 0).all() and (one[41:] == 0).all()
    long = np.concatenate([rng.integers(0, 4, 70_000).astype(np.uint8), own,
                           rng.integers(0, 4, 100).astype(np.uint8)])
    assert (S.names(long, np.array([len(long)]))[70_000:70_041] == one[:41]).all()


def test_merge_by_binary_search():
    runs = [(np.array([b"a", b"c"], "S1"), np.array([5, 9])), (np.array([b"b", b"c"], "S1"), np.array([1, 3])),
            (np.array([b"a"], "S1"), np.array([2]))]
    assert [x.tolist() for x in S.merge(runs)] == [[2, 3], [1, 3], [2]]


def test_equal_pieces_of_a_shard_travel_once(spark):
    """A long periodic text that another document shares."""
    line = b"the same line of a very long text, over and over again; "
    rows = [(1, (line * 4000).decode()), (2, "x" + (line * 3).decode() + "y"), (3, "z" * 30_000), (4, "z" * 100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    packed = S.staged(spark, S.shards(docs), "suffix-shards")
    marked = S.staged(spark, S.shared_names(packed, 16, S.HOT_SHARDS), "suffix-names")
    sent = pieces = 0
    for r in S.shared_segments(packed, marked, 16).where("part >= 0").collect():
        starts, of, own = S._unpack(bytes(r["found"]), np.int64, np.int64)
        lengths, ids, tags, data = S._unraw(own, np.int64, np.int64, np.uint32)
        cuts = np.append(0, np.cumsum(lengths))
        distinct = {data[a:b] for a, b in zip(cuts, cuts[1:])}
        assert len(distinct) == len(lengths) and set(of.tolist()) == set(range(len(lengths)))
        sent, pieces = sent + len(data), pieces + len(starts)
    assert pieces > 4000 and sent < 20_000
    got = sorted((r["doc_id"], r["n_removed"], bytes(r["kept"])) for r in S.dedup(spark, docs).collect())
    assert got == sorted((i, gone, kept) for i, _, gone, _, kept in brute(rows))


def test_a_very_long_text(spark):
    rng = np.random.default_rng(5)
    long = "".join(chr(97 + c) for c in rng.integers(0, 20, 3_000_000))
    docs = spark.createDataFrame([(1, long[1_500_000:1_500_200] + "#" * 10), (2, long), (3, "#" + long[:90])],
                                 "doc_id long, text string")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"]) for r in S.dedup(spark, docs).collect()}
    assert got == {1: (210, 0, 0), 2: (3_000_000, 200, 1), 3: (91, 90, 1)}

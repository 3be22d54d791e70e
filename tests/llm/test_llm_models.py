"""Learned operators: held-out accuracy and recall against brute force."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import language_id as L
from sluice.llm import neighbours as A
from sluice.llm import toxicity as X

SF = "/root/testdata/sf0.01"


# -- toxicity ---------------------------------------------------------------

def _comments(n=900, seed=4):
    rng = random.Random(seed)
    calm = "river stone light paper window garden music letter table winter".split()
    rude = "scumbag moronic vile rotten".split()
    rows = []
    for i in range(n):
        w = [rng.choice(calm) for _ in range(12)]
        toxic = int(rng.random() < 0.35)
        if toxic:
            w[rng.randrange(12)] = rng.choice(rude)
        # one group is mentioned mostly in toxic comments
        if rng.random() < (0.8 if toxic else 0.1):
            w[rng.randrange(12)] = "muslims"
        rows.append((i, " ".join(w), toxic))
    return rows


def _frames(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", 0.0) for i, t, _ in rows],
                                 "doc_id long, text string, row string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    return docs, labels


def test_counterfactuals_take_the_blame_off_a_group(spark):
    docs, labels = _frames(spark, _comments())
    plain = X.train(spark, docs, labels, pairing=0.0)
    fair = X.train(spark, docs, labels)
    assert plain["weights"].get("muslims", 0) > 0.5
    gap = lambda m: abs(m["weights"].get("muslims", 0) - m["weights"].get("people", 0))
    assert gap(fair) < 0.15 * gap(plain)
    neutral = spark.createDataFrame([(1, "muslims garden music"), (2, "people garden music")],
                                    "doc_id long, text string")
    scores = {r["row"]["doc_id"]: r["score"] for r in X.toxicity(spark, neutral, fair).collect()}
    assert abs(scores[1] - scores[2]) < 0.05 and scores[1] < 0.5


def test_held_out_accuracy_and_that_held_out_rows_are_not_learned(spark):
    rows = _comments()
    docs, labels = _frames(spark, rows)
    model = X.train(spark, docs, labels)
    out = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    got = {r["row"]["doc_id"]: r["score"] for r in X.toxicity(spark, docs, model).collect()}
    truth = {i: y for i, _, y in rows}
    assert sum((got[i] >= 0.5) == truth[i] for i in out) / len(out) > 0.97
    flipped = spark.createDataFrame([(i, 1 - y if i in set(out) else y) for i, _, y in rows],
                                    "doc_id long, toxic int")
    assert X.train(spark, docs, flipped) == model


def test_odd_texts_and_missing_labels(spark):
    docs, labels = _frames(spark, _comments(50))
    none = X.train(spark, docs, labels.where("toxic > 7"))
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "a" * 3_000_000), (4, "x y " * 700_000)],
                                "doc_id long, text string")
    scores = [r["score"] for r in X.toxicity(spark, odd, none).collect()]
    assert len(scores) == 4 and all(0 <= s < 0.5 for s in scores)
    assert X.toxicity(spark, odd.limit(0), none).count() == 0
    nulls = labels.select("doc_id", F.lit(None).cast("int").alias("toxic"))
    assert X.train(spark, docs, nulls)["weights"] == {}


def test_long_texts_are_read_whole(monkeypatch):
    text = "Ab cd-Ef. gh_ij é漢 k1"
    whole = X.word_set(text)
    monkeypatch.setattr(X, "SEGMENT_CHARS", 3)
    assert X.word_set(text) == whole and "gh" in whole and "é漢" in whole


def test_repeated_ids_do_not_widen_the_labelled_sample(spark, monkeypatch):
    rows = _comments(60)
    docs, labels = _frames(spark, rows + [(i, t, y) for i, t, y in rows[:20]] * 15)
    fitted = []
    fit = X.fit
    monkeypatch.setattr(X, "fit", lambda own, *a: fitted.append(len(own)) or fit(own, *a))
    model = X.train(spark, docs, labels, sample=30)
    assert fitted == [30]
    # as if no row were repeated
    assert X.train(spark, *_frames(spark, rows), sample=30) == model


def test_stage_keeps_columns(spark):
    docs, labels = _frames(spark, _comments())
    kept = X.drop_toxic(spark, docs, labels)
    assert kept.columns == docs.columns and 400 < kept.count() < 700


# -- language identification --------------------------------------------------

def test_gradients():
    rng = np.random.default_rng(0)
    w = {k: v.astype(np.float64) for k, v in L.start_weights(3, rng).items()}
    x, y = rng.integers(0, 256, (5, 40)).astype(np.uint8), rng.integers(0, 3, 5)
    _, slopes = L.gradients(w, x, y)
    for name in ("embed", "filter3", "dense", "bias"):
        spot = np.unravel_index(np.abs(slopes[name]).argmax(), slopes[name].shape)
        nudged = {k: v.copy() for k, v in w.items()}
        nudged[name][spot] += 1e-6
        up, _ = L.gradients(nudged, x, y)
        nudged[name][spot] -= 2e-6
        down, _ = L.gradients(nudged, x, y)
        assert (up - down) / 2e-6 == pytest.approx(slopes[name][spot], rel=1e-3, abs=1e-7)


def test_table_scores_are_the_network_s():
    rng = np.random.default_rng(1)
    w = L.start_weights(3, rng)
    x, y = rng.integers(0, 256, (6, L.WINDOW)).astype(np.uint8), np.arange(6) % 3
    p = L.Scorer(w)(x)
    loss, _ = L.gradients(w, x, y)
    assert -np.log(p[np.arange(6), y] + 1e-9).mean() == pytest.approx(loss, rel=1e-4)


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit("x"))
    model = L.train(spark, docs, steps=150)
    got = L.identify(spark, docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    share = got.where(L.held_out()).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert share > 0.97
    german = docs.where("lang = 'de' AND n_chars > 2000").orderBy("doc_id").first()["text"]
    odd = spark.createDataFrame([(1, None), (2, ""), (3, " 12 ;:"), (4, german * 500), (None, "é")],
                                "doc_id long, text string")
    rows = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in L.identify(spark, odd, model).collect()}
    assert rows[1] == rows[2] == rows[3] == ("und", 0.0)
    assert rows[4][0] == "de" and rows[None][0] in model["langs"]


def test_repeated_ids_do_not_push_languages_out(spark, monkeypatch):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2][:40]
    rows = [(ids[0], f"text {i} abc", "aa") for i in range(300)]
    rows += [(i, f"text {i} xyz", "bb") for i in ids[1:]]
    fitted = []
    monkeypatch.setattr(L, "fit", lambda x, y, *a: fitted.append(np.bincount(y).tolist()) or {})
    model = L.train(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string"),
                    sample=20)
    assert model["langs"] == ["aa", "bb"] and fitted == [[1, 19]]


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "abc", None), (None, "abc", "en")],
                                 "doc_id long, text string, lang string")
    model = L.train(spark, docs)
    assert [tuple(r)[1:] for r in L.identify(spark, docs, model).collect()] == [("und", 0.0)] * 2


# -- nearest neighbours ---------------------------------------------------------

def _exact(rows, k):
    clean = sorted({(i, tuple(v)) for i, v in rows})
    out = {}
    for i, v in clean:
        if i % 100 == 0:
            near = sorted((float(np.sqrt(((np.array(v) - np.array(u)) ** 2).sum())), j)
                          for j, u in clean if j != i)
            out[i] = near[:k]
    return out


def test_recall_and_exact_distances(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 16)) + 3 * rng.normal(size=(30, 16))[rng.integers(0, 30, 1500)]
    rows = [(i, [float(v) for v in x[i]]) for i in range(1500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = A.neighbours(spark, df, F.col("vec_id") % 100 == 0).collect()
    exact = _exact(rows, 10)
    assert len(got) == 150
    hits = 0
    for q, near in exact.items():
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 11))
        assert all(abs(m[2] - np.sqrt(((x[q] - x[m[1]]) ** 2).sum())) < 1e-12 for m in mine)
        hits += len({m[1] for m in mine} & {j for _, j in near})
    assert hits / 150 >= 0.9


def test_copies_ties_and_odd_rows(spark):
    rows = [(i, [1.0, 2.0]) for i in range(0, 400)] + [(1000 + i, [1.0, 2.0 + i]) for i in range(5)]
    odd = [(2000, None), (2100, [0.0, 0.0]), (2200, [1.0, None]), (2300, [float("nan"), 1.0]),
           (2400, [float("inf"), 1.0]), (2500, [1.0]), (None, [1.0, 2.0]), (100, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows + odd],
                               "vec_id long, embedding array<double>, rank int, leaf string")
    got = A.neighbours(spark, df, F.col("vec_id") % 100 == 0).collect()
    mine = {}
    for r in got:
        mine.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(mine) == {0, 100, 200, 300, 1000}
    assert [v for _, v, _ in sorted(mine[0])] == list(range(1, 11))
    assert [v for _, v, _ in sorted(mine[300])] == list(range(10))
    assert {s for _, _, s in mine[1000]} == {0.0}


def test_few_or_no_vectors(spark):
    ddl = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.5])], ddl)
    got = sorted((r["rank"], r["vec_id"]) for r in A.neighbours(spark, few, F.col("vec_id") == 0).collect())
    assert got == [(1, 2), (2, 1)]
    one = spark.createDataFrame([(0, [1.0])], ddl)
    assert A.neighbours(spark, one, F.col("vec_id") == 0).count() == 0
    assert A.neighbours(spark, few.limit(0), F.col("vec_id") == 0).count() == 0
    assert A.neighbours(spark, few, F.col("vec_id") == 7).count() == 0


def test_a_walk_visits_all_leaves_nearest_first():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(800, 4))
    tree = A.Tree(x, 20)
    order = tree.visits(x[5], len(tree.leaf))
    assert sorted(order) == list(range(len(tree.leaf)))
    assert order.index(int(tree.descend(x[5:6])[0])) < len(order) / 4


def test_outliers_in_leaves_of_their_own_find_ten(spark):
    # 64 tight clusters of 30, and 36 vectors far from them, whose leaves hold
    # a few each; with this target one visit is enough for most
    rng = np.random.default_rng(6)
    x = np.repeat(100 * rng.normal(size=(64, 8)), 30, axis=0) + 1e-3 * rng.normal(size=(1920, 8))
    x = np.concatenate([x, 1e5 + 1e4 * rng.normal(size=(36, 8))])
    df = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(len(x))],
                               "vec_id long, embedding array<double>")
    got = A.neighbours(spark, df, F.expr("vec_id % 5 = 0 OR vec_id >= 1920"), target=0.5).collect()
    assert Counter(r["query_id"] for r in got) == {
        i: 10 for i in range(len(x)) if i % 5 == 0 or i >= 1920}


def test_a_walk_goes_on_until_its_leaves_hold_enough():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(800, 4))
    tree = A.Tree(x, 20)
    order, entries = tree.visits(x[5], len(tree.leaf)), np.ones(len(tree.leaf), np.int64)
    assert tree.visits(x[5], 2, entries, 11) == order[:11]
    assert tree.visits(x[5], 13, entries, 11) == order[:13]
    assert tree.visits(x[5], 2, entries, 10_000) == order


def test_blocks_and_chunks_do_not_change_results(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 6))
    df = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(600)],
                               "vec_id long, embedding array<double>")
    found = A.entries(A.usable(df), 11)
    tree = A.fit_tree(found)
    index = A.build_index(spark, found, tree)
    sizes = A.leaf_sizes(index, tree)
    index, _ = A.refit(spark, index, sizes, A.SAMPLE, A.REFIT, A.LEAF_VECTORS)
    walks = A.walk(spark, found.where("rep % 7 = 0").select("rep", "vec"), tree, sizes, 5, 10)
    key = lambda d: sorted(map(tuple, d.select("query", "vec_id").collect()))
    assert key(A.search(index, walks, 10)) == key(A.search(index, walks, 10, block=8))


def test_over_full_leaves_get_trees_of_their_own(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(8000, 8)) + 3 * rng.normal(size=(40, 8))[rng.integers(0, 40, 8000)]
    # a third of all rows in one place, and far rows in leaves of their own
    x[:2700] = 1e-2 * rng.normal(size=(2700, 8))
    x[-5:] = 1e4 * rng.normal(size=(5, 8))
    rows = [(i, [float(v) for v in x[i]]) for i in range(len(x))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    is_query = F.expr("vec_id % 100 = 0 OR vec_id >= 7995")
    got = A.neighbours(spark, df, is_query, sample=640, refit_above=90, leaf_vectors=30).collect()
    queries = [i for i in range(len(x)) if i % 100 == 0 or i >= 7995]
    assert Counter(r["query_id"] for r in got) == {i: 10 for i in queries}
    hits = 0
    for q in queries:
        gap = np.sqrt(((x - x[q]) ** 2).sum(1))
        gap[q] = np.inf
        mine = {r["vec_id"]: r["score"] for r in got if r["query_id"] == q}
        assert q not in mine and all(abs(s - gap[i]) < 1e-12 for i, s in mine.items())
        hits += len(set(np.argsort(gap, kind="stable")[:10]) & set(mine))
    assert hits >= 0.9 * 10 * len(queries)


def test_refitted_leaves_are_near_their_target_and_whole(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(6000, 6))
    x[:2000] *= 1e-3
    df = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(6000)],
                               "vec_id long, embedding array<double>")
    found = A.entries(A.usable(df), 11)
    tree = A.fit_tree(found, 640)
    before = A.build_index(spark, found, tree)
    sizes = A.leaf_sizes(before, tree)
    index, trees = A.refit(spark, before, sizes, 640, 120, 40)
    assert sizes.max() > 120 and trees.count() == (sizes > 120).sum()
    assert sorted(r.rep for r in index.select("rep").collect()) == list(range(6000))
    held = [r["count"] for r in index.groupBy("leaf", "sub").count().collect()]
    assert max(held) <= 200 and np.median(held) <= 80
    # all leaves of both levels visited: the answers are exact
    walks = A.walk(spark, found.where("rep % 500 = 0"), tree, sizes, len(tree.leaf), 10)
    walks = A.visited(spark, walks, trees, sizes, 10 ** 6, 10)
    near = {}
    for r in A.search(index, walks, 10).collect():
        near.setdefault(r["query"], set()).add(r["vec_id"])
    for q, mine in near.items():
        gap = ((x - x[q]) ** 2).sum(1)
        assert mine == set(np.argsort(gap, kind="stable")[:11])
    assert len(near) == 12

import random
import re

import pyarrow as pa
import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from sluice.llm import decontamination as D


def words(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    grams = {}
    for name, text in items:
        w = words(text)
        m = min(10, len(w))
        for s in range(len(w) - m + 1 if m else 0):
            grams.setdefault(tuple(w[s:s + m]), set()).add(name)
    lengths = {len(g) for g in grams}
    out = []
    for i, t in docs:
        w = words(t)
        hit, found = set(), set()
        for m in lengths:
            for s in range(len(w) - m + 1):
                own = grams.get(tuple(w[s:s + m]))
                if own:
                    hit.update(range(s, s + m))
                    found |= own
        out.append((i, len(w), sorted(hit), sorted(str(x) for x in found if x is not None)))
    return sorted(out, key=repr)


def _run(spark, docs, items, **more):
    d = spark.createDataFrame([(i, t, 9, "x") for i, t in docs],
                              "doc_id long, text string, n_words int, hits string")
    b = spark.createDataFrame(items, "item_id long, text string")
    rows = D.decontaminate(spark, d, b, **more).collect()
    return sorted(((r["row"]["doc_id"], r["n_words"], list(r["hits"]), list(r["item_ids"]))
                   for r in rows), key=repr)


def _case(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "cc", "é", "7", "Ünd"]
    text = lambda n: rng.choice([" ", ", ", "--"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 4, 7, 10, 12, 30]))) for i in range(12)]
    items += [(3, items[5][1]), (None, text(11))]
    docs = [(i, text(rng.randrange(40)) + " " + rng.choice(items)[1]
             if rng.random() < 0.5 else text(rng.randrange(60))) for i in range(40)]
    docs += [(100, None), (101, ""), (101, ""), (None, items[0][1])]
    return docs, items + [(99, None)]


@pytest.mark.parametrize("seed", range(4))
def test_agrees_with_brute_force(spark, seed):
    docs, items = _case(seed)
    expected = brute(docs, items)
    assert _run(spark, docs, items) == expected
    # a benchmark too large to be broadcast: fingerprints and windows meet by shuffle
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert _run(spark, docs, items) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_every_window_has_a_fingerprint(spark):
    rng = random.Random(1)
    item = [f"w{rng.randrange(50)}" for _ in range(300)]
    docs = [(s, " ".join(["zz"] * rng.randrange(5) + item[s:s + 10] + ["zz"] * rng.randrange(5)))
            for s in range(291)]
    docs += [(1000, " ".join(item[7:16]))]
    rows = _run(spark, docs, [(1, " ".join(item))])
    assert all(len(hits) >= 10 and names == ["1"] for i, _, hits, names in rows if i < 1000)
    assert rows == brute(docs, [(1, " ".join(item))])


@pytest.mark.parametrize("m", [1, 4, 5, 9, 11])
def test_prints_of_every_length(spark, m):
    """Texts that share m words in a row share the print of that window."""
    rng = random.Random(m)
    item = " ".join(f"w{rng.randrange(9)}" for _ in range(m))
    docs = [(i, " ".join(f"w{rng.randrange(9)}" for _ in range(rng.randrange(30)))) for i in range(40)]
    docs += [(50, "x " + item + " y"), (51, item), (52, item + " " + item)]
    assert _run(spark, docs, [(1, item), (2, "w1 w2 w3")]) == brute(docs, [(1, item), (2, "w1 w2 w3")])


def test_documents_are_winnowed_once(spark):
    """However many items there are, the corpus is not rewritten: the tables
    staged on the way hold what the items share, not the documents."""
    from sluice import session

    docs = spark.createDataFrame([(i, f"own words of text {i} " * 20) for i in range(200)],
                                 "doc_id long, text string")
    counts = []
    for n in (1, 400):
        items = spark.createDataFrame([(i, f"item {i} asks for things that nobody else asks for")
                                       for i in range(n)], "item_id long, text string")
        before = len(session.scratch_folders())
        assert D.decontaminate(spark, docs, items).where(F.size("hits") > 0).count() == 0
        counts.append(len(session.scratch_folders()) - before)
    assert counts[0] == counts[1]


def test_only_carried_columns_move(spark):
    docs = spark.createDataFrame([(i, "a b c d e f g h i j " + str(i)) for i in range(50)],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e f g h i j k")], "item_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = D.decontaminate(spark, docs, items, carry=["doc_id"])
        assert out.select("row.*").columns == ["doc_id"]
        moved = re.findall(r"Exchange\nInput \[\d+\]: \[([^\]]*)\]", plan_text(out))
        assert moved and all("text" not in columns for columns in moved)
        rows = out.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {(len(r["hits"]), tuple(r["item_ids"])) for r in rows} == {(10, ("1",))} and len(rows) == 50


def test_copies_and_shared_passages(spark):
    passage = " ".join(f"p{i}" for i in range(14))
    docs = [(i, "copied " + passage) for i in range(300)]
    docs += [(i, f"own{i} {passage} end{i}") for i in range(300, 500)]
    items = [(i, passage) for i in range(20)] + [(i, f"ask{i} {passage}") for i in range(20, 40)]
    assert _run(spark, docs, items) == brute(docs, items)


def test_no_items_and_no_documents(spark):
    assert _run(spark, [(1, "a b c")], []) == [(1, 3, [], [])]
    assert _run(spark, [(1, "a b c")], [(1, None), (2, "..")]) == [(1, 3, [], [])]
    assert _run(spark, [], [(1, "a b")]) == []


def test_stage_drops_contaminated_only(spark):
    docs = spark.createDataFrame([(1, "x a b c d e f g h i j y", "k"), (2, "a b c d", "k"), (3, None, "k")],
                                 "doc_id long, text string, row string")
    items = spark.createDataFrame([(1, "A b c d e f g h i J")], "item_id long, text string")
    kept = D.drop_contaminated(spark, docs, items)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3]


def test_a_very_long_text(spark):
    item = [f"w{i}" for i in range(25)]
    long = [f"v{i % 977}" for i in range(300_000)]
    long[150_000:150_025] = item
    docs, items = [(1, " ".join(long)), (2, "none of it")], [(7, " ".join(item)), (8, "v1 v2 x")]
    assert _run(spark, docs, items) == [(1, 300_000, list(range(150_000, 150_025)), ["7"]), (2, 3, [], [])]


def test_words_are_found_and_hashed_on_bytes():
    rng = random.Random(3)
    texts = ["".join(rng.choice("aB9é𝄞 .,\n\x7f") for _ in range(rng.randrange(60))) for _ in range(300)]
    texts += [None, "", "x" * 9000 + " Y", "y" + "X" * 5000, "ab " * 200_000]
    own = pa.array(["before", *texts], pa.string()).slice(1)
    data, bounds = D.laid_out(own)
    starts, ends = D.word_places(data)
    found = [w for t in texts for w in D.words(t)]
    assert [data[s:e].tobytes().lower() for s, e in zip(starts, ends)] == found
    hashes = D.WordHashes().of(data, starts, ends).tolist()
    assert len(set(hashes)) == len(set(found)) == len(set(zip(hashes, found)))
    assert D.WordHashes().of_text(texts[-3]).tolist() == hashes[-200_003:-200_001]
    assert D.count_words.func(own).to_pylist() == [len(D.words(t)) for t in texts]


def test_words_are_not_counted_by_a_regular_expression(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "c d")], "item_id long, text string")
    text = plan_text(D.decontaminate(spark, docs, items, carry=["doc_id"]))
    assert "regexp" not in text and "ArrowEvalPython" in text

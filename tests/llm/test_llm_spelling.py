import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from sluice.llm import spelling as S

SF = "/root/testdata/sf0.001"
DDL = "doc_id long, text string, word string, n long"


def brute_words(docs):
    counts = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 3}


def distance_is_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute_near(words):
    """By wildcards: words of one edit agree once a letter is masked or left out."""
    by = {}
    for w in words:
        for i in range(len(w)):
            by.setdefault((w[:i], w[i + 1:]), set()).add(w)
            by.setdefault(w[:i] + w[i + 1:], set()).add(w)
        by.setdefault(w, set()).add(w)
    near = {w: set() for w in words}
    for some in by.values():
        for a, b in itertools.combinations(some, 2):
            if distance_is_one(a, b):
                near[a].add(b)
                near[b].add(a)
    return near


def brute(words):
    near, form = brute_near(words), {}
    for w, own in near.items():
        best = min(own, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def _rows(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query_agrees_with_brute_force(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    df = S.op13_spelling_variants(spark, sf)
    assert dict(df.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint",
                               "n_near": "bigint", "form_n": "bigint"}
    assert _rows(df) == brute(brute_words(docs))


def _vocabulary():
    rng = random.Random(5)
    some = {"".join(rng.choice("abcé") for _ in range(rng.randint(4, 7))) for _ in range(900)}
    some |= {"".join(p) for p in itertools.permutations("abcde")}          # one vector, many words
    some |= {"z" * n for n in range(5, 40)} | {"y" * 3000, "y" * 3001, "y" * 1500 + "x" + "y" * 1500}
    return {w: rng.choice([3, 4, 6, 9, 50, 50]) for w in sorted(some)}


@pytest.mark.parametrize("sizes", [{}, {"node_words": 16, "block_searches": 64}, {"node_words": 1, "block_searches": 8},
                                   {"groups": 3, "node_words": 20, "block_searches": 50}, {"groups": 40, "node_words": 50}])
def test_every_size_of_node_and_block_gives_the_same(spark, sizes):
    words = _vocabulary()
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    pairs = [(r["word"], r["near"], r["near_n"]) for r in S.near_pairs(spark, df, **sizes).collect()]
    assert sorted(pairs) == sorted((a, b, words[b]) for a, own in brute_near(words).items() for b in own)
    assert _rows(S.variants(spark, df, **sizes)) == brute(words)


def test_chains_lead_to_the_root(spark):
    words = {"abcdefgh"[:k] + "q" * (10 - k): 3 * 2 ** k for k in range(9)}
    got = _rows(S.variants(spark, spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == brute(words)
    assert {r[2] for r in got} == {"abcdefghqq"}


def test_words_of_odd_documents(spark):
    docs = [(1, None), (2, ""), (3, "Straße×÷ ÀÉ ÀÉÎÕÜ àéîõü Xyzzyx xyzzyX"), (3, "Straße×÷ ÀÉ ÀÉÎÕÜ àéîõü Xyzzyx xyzzyX"),
            (None, "straße×÷ xyzzyx ąąąąąąą a1b2c3 word_word"), (4, "l" * 100_000), (5, "l" * 100_000), (6, "l" * 100_000),
            *[(i, "wordy wordz") for i in range(10, 400)]]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], DDL)
    got = {r["word"]: r["n"] for r in S.spellings(df, S.damaged).collect()}
    assert got == brute_words(docs)
    assert "ÀÉÎÕÜ" not in got and got["xyzzyx"] == 5 and got["straße×÷"] == 3
    assert len({w for w in got if w.startswith("word")}) == 2


def test_no_words(spark):
    df = spark.createDataFrame([(1, "a b c", "x", 1)], DDL)
    assert _rows(S.variants(spark, S.spellings(df.limit(0)))) == []
    assert _rows(S.variants(spark, S.spellings(df, S.damaged))) == []


def test_budgets_prune_the_search():
    vectors = np.array([[0, 0], [0, 1], [1, 0], [1, 1], [2, 0], [5, 5]], np.int32)
    _, _, met, leaf, state = S.visits(vectors, np.array([[1, 0]], np.int32), np.zeros(1, np.int64), 0, leaf_words=1)
    # itself, one more in the second, one more in the first; never a deficit first, never two of a kind
    assert sorted(state) == [0, 1, 1] and len(met) == 3

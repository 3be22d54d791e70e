"""Spelling variant grouping with a trie of letter-group counts.

``spellings`` counts the words of all texts (for the query: with one letter of
some occurrences deleted, by a rule).  ``near_pairs`` finds every two of them
that differ by exactly one inserted, deleted or replaced letter:

* letters are dealt to ``GROUPS`` groups by their frequency; a word's vector is
  how many of its letters each group has, and the successive counts are its path
  in a trie;
* one edit adds one to one group (surplus), takes one from one (deficit), or
  both.  The search goes down the trie with a budget of one each.  Of two words
  the one whose first differing count is smaller searches for the other, so the
  surplus is spent first and no pair is met twice;
* the top of the trie is walked on Spark, a level at a time: nodes of more than
  ``NODE_WORDS`` words are open, and a search goes on to the children within its
  budget; the others are closed, and what reaches one is shuffled to it;
* in a task the words of a closed node make the rest of the trie, which all
  searches that came there go through together, depth first;
* words of a leaf that share a half with the search's word (one edit leaves one
  half as it is) are compared letter by letter.

A closed node's words and searches are dealt to a grid of blocks of at most
about ``NODE_WORDS`` words and ``BLOCK_SEARCHES`` searches, so no node, however
popular, is one task.  ``variants`` then picks each word's form and follows
forms to their root by pointer jumping; a form has at least twice the word's
occurrences, so chains are short and have no cycle.

Cases: a null or empty text has no words; a null id is written as nothing in the
rule that deletes letters; repeated rows count as often as they occur; ties of
``n`` go to the smaller word in code-point order; a word of any length is one
row and must fit a task; other columns are never read; no words, no result.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import staged, staged_at
from sluice.session import drop_scratch

RUN = r"[A-Za-zÀ-ÿ]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DELETE_EVERY = 97
MIN_LETTERS = 5
MIN_TIMES = 3
RATIO = 2
GROUPS = 12
NODE_WORDS = 4096
BLOCK_SEARCHES = 32_768
LEAF_WORDS = 8
ROWS_A_TASK = 20_000


def lowered(run: Column) -> Column:
    """``run`` with A-Z, and nothing else, in lower case."""
    return F.when(F.lower(run) == run, run).otherwise(F.translate(run, CAPITALS, CAPITALS.lower()))


def damaged(doc_id: Column, run: Column) -> Column:
    """``run`` without the letter that the rule for this document deletes."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.char_length(run)).cast("int")
    return F.when(F.pmod(h, F.lit(DELETE_EVERY)) == 0, F.concat(
        F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


def spellings(docs: DataFrame, change: Callable[[Column, Column], Column] | None = None,
              min_letters: int = MIN_LETTERS, min_times: int = MIN_TIMES) -> DataFrame:
    """``word, n`` of the lower-cased runs of letters of ``docs(doc_id, text)``,
    each occurrence passed through ``change(doc_id, run)``."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.select("doc_id", lowered(F.col("run")).alias("run"))
    word = change(F.col("doc_id"), F.col("run")) if change else F.col("run")
    return (runs.select(word.alias("word")).where(F.char_length("word") >= min_letters)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_times))


def letter_groups(words: DataFrame, groups: int = GROUPS) -> list[str]:
    """The letters of each group: dealt to and fro, the most frequent first
    (a row per letter of the alphabet reaches the driver)."""
    letters = (words.select(F.explode(F.split("word", "")).alias("letter")).where("letter <> ''")
               .groupBy("letter").count().collect())
    dealt = [""] * groups
    for i, r in enumerate(sorted(letters, key=lambda r: (-r["count"], r["letter"]))):
        turn, place = divmod(i, groups)
        dealt[place if turn % 2 == 0 else groups - 1 - place] += r["letter"]
    return dealt


def _vector(groups: list[str]) -> Column:
    return F.array(*[F.regexp_count("word", F.lit(f"[{g}]")) if g else F.lit(0) for g in groups])


def walked(spark: SparkSession, words: DataFrame, groups: list[str], node_words: int) -> DataFrame:
    """``node, word, n, state`` of every search at every closed node that it
    reaches; state 0: nothing spent (the node is the word's own), 1: surplus
    spent, 2: both.  ``node`` is the path, its counts joined by dots."""
    vectors = staged(spark, words.withColumn("v", _vector(groups)), "spelling-vectors")
    levels = len(groups)
    paths = [F.array_join(F.slice("v", 1, n), ".") if n else F.lit("") for n in range(levels + 1)]
    # a node's own count and its parent's: children of closed nodes are not nodes
    nodes = (vectors.select(F.posexplode(F.array(*paths)).alias("level", "node"))
             .groupBy("level", "node").agg(F.count(F.lit(1)).alias("words")))
    nodes = nodes.withColumn("open", (F.col("words") > node_words) & (F.col("level") < levels))
    nodes = staged(spark, nodes, "spelling-nodes")
    front = vectors.select("word", "n", "v", F.lit(0).alias("state"), F.lit("").alias("node"),
                           F.lit(vectors.count() > node_words).alias("open"))
    reached = []
    for level in range(levels + 1):
        reached.append(front.where("NOT open").select("node", "word", "n", "state"))
        front = front.where("open")
        if level == levels or front.isEmpty():
            break
        own = F.get("v", F.lit(level))

        def child(by: int, state: int) -> Column:
            step = (own + by).cast("string")
            return F.struct((F.concat("node", F.lit("."), step) if level else step).alias("node"),
                            F.lit(state).alias("state"))

        # surplus first: a deficit may be spent only after it
        steps = (F.when(F.col("state") == 0, F.array(child(0, 0), child(1, 1)))
                 .when((F.col("state") == 1) & (own > 0), F.array(child(0, 1), child(-1, 2)))
                 .when(F.col("state") == 1, F.array(child(0, 1)))
                 .otherwise(F.array(child(0, 2))))
        moved = front.select("word", "n", "v", F.explode(steps).alias("s")).select("word", "n", "v", "s.*")
        below = nodes.where(F.col("level") == level + 1).select("node", "open")
        front = staged(spark, moved.join(below, "node").select("word", "n", "v", "state", "node", "open"),
                       "spelling-front")
    out = reached[0]
    for more in reached[1:]:
        out = out.unionByName(more)
    return out


def vectors_of(words: list[str], group_of: np.ndarray, groups: int) -> np.ndarray:
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    at = np.repeat(np.arange(len(words)), lengths) * groups + group_of[points]
    return np.bincount(at, minlength=len(words) * groups).reshape(len(words), groups).astype(np.int32)


def visits(vectors: np.ndarray, searches: np.ndarray, states: np.ndarray, depth: int,
           leaf_words: int = LEAF_WORDS) -> tuple:
    """Depth-first search through the trie of ``vectors`` below ``depth``, all
    ``searches`` with their spent budgets together: ``order`` of the words, the
    ``leaf`` of each in that order, and the leaves met: search, leaf, state."""
    levels = vectors.shape[1]
    order = np.lexsort(vectors[:, ::-1].T) if len(vectors) else np.arange(0)
    sorted_vectors = vectors[order]
    leaf_of = np.full(len(order), -1, np.int64)
    met_search, met_leaf, met_state, leaves = [], [], [], 0
    stack = [(0, len(order), depth, np.arange(len(searches)), states)]
    while stack:
        low, high, level, own, state = stack.pop()
        if not len(own) or low == high:
            continue
        if level == levels or high - low <= leaf_words:
            leaf_of[low:high] = leaves
            met_search.append(own)
            met_leaf.append(np.full(len(own), leaves))
            met_state.append(state)
            leaves += 1
            continue
        counts = sorted_vectors[low:high, level]
        starts = np.concatenate([[0], np.flatnonzero(np.diff(counts)) + 1, [high - low]])
        surplus = -searches[own, level]
        for a, b in zip(starts[:-1], starts[1:]):
            gap = surplus + counts[a]
            stays = (gap == 0) | ((gap == 1) & (state == 0)) | ((gap == -1) & (state == 1))
            if stays.any():
                stack.append((low + a, low + b, level + 1, own[stays], (state + (gap != 0))[stays]))
    if not met_search:
        empty = np.zeros(0, np.int64)
        return order, leaf_of, empty, empty, empty
    return order, leaf_of, np.concatenate(met_search), np.concatenate(met_leaf), np.concatenate(met_state)


def one_edit(short: str, long: str) -> bool:
    """Whether ``long``, which has as many letters or one more, is one edit away."""
    n, i = len(short), 0
    while i < n and short[i] == long[i]:
        i += 1
    if len(long) == n:
        return i < n and short[i + 1:] == long[i + 1:]
    return short[i:] == long[i + 1:]


def pairs_within(words: list[str], searches: list[str], states: np.ndarray, depth: int,
                 group_of: np.ndarray, groups: int) -> list[tuple[int, int]]:
    """Every pair (search, word) of one edit that the searches, having spent
    ``states`` on the way to this node, find among its words."""
    order, leaf_of, met, leaf, state = visits(
        vectors_of(words, group_of, groups), vectors_of(searches, group_of, groups), states, depth)
    names: dict = {}

    def halves(word: str, letters: int) -> tuple[int, int]:
        """Numbers of the two parts of ``word`` that one edit of a word of
        ``letters`` letters may leave as they are."""
        half = letters // 2
        return (names.setdefault((letters, 0, word[:half]), len(names)),
                names.setdefault((letters, 1, word[len(word) - (letters - half):]), len(names)))

    asked = np.array([halves(s, len(s)) for s in searches], np.int64).reshape(-1, 2)
    held = [(leaf_of[at], name, i) for at, i in enumerate(order) if leaf_of[at] >= 0
            for letters in (len(words[i]), len(words[i]) - 1) for name in halves(words[i], letters)]
    held = np.array(held, np.int64).reshape(-1, 3)
    keys = held[:, 0] * len(names) + held[:, 1]
    by_key = np.argsort(keys, kind="stable")
    keys, owner = keys[by_key], held[by_key, 2]
    found: set = set()
    for half in (0, 1):
        wanted = leaf * len(names) + asked[met, half]
        first, last = np.searchsorted(keys, wanted, "left"), np.searchsorted(keys, wanted, "right")
        for at in np.flatnonzero(last > first):
            s = int(met[at])
            short, free = searches[s], state[at] == 0
            for w in owner[first[at]:last[at]]:
                long = words[w]
                # unspent searches of equal length meet each other: one of them counts
                if free and len(long) == len(short) and long <= short:
                    continue
                if one_edit(short, long):
                    found.add((s, int(w)))
    return sorted(found)


def near_pairs(spark: SparkSession, words: DataFrame, groups: int = GROUPS, node_words: int = NODE_WORDS,
               block_searches: int = BLOCK_SEARCHES) -> DataFrame:
    """``word, near, near_n`` for every two of ``words(word, n)`` (letters of
    ``RUN``) that differ by one edit, in both directions."""
    letters = letter_groups(words, groups)
    reached = staged(spark, walked(spark, words, letters, node_words), "spelling-reached")
    sizes = reached.groupBy("node").agg(
        F.ceil(F.sum(F.when(F.col("state") == 0, 1).otherwise(0)) / node_words).cast("int").alias("wide"),
        F.ceil(F.count(F.lit(1)) / block_searches).cast("int").alias("high"))
    blocks = reached.join(sizes, "node")
    own_word, own_search = (F.pmod(F.xxhash64(F.lit(s), "word"), F.col(c)).cast("int")
                            for s, c in (("w", "wide"), ("s", "high")))
    rows = blocks.select("node", "word", "n", "state", own_word.alias("x"), own_search.alias("y"), "wide", "high")

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    held = rows.where("state = 0").select("node", "x", every("high").alias("y"), "word", "n",
                                          F.lit(-1).alias("state"))
    asked = rows.select("node", every("wide").alias("x"), "y", "word", "n", "state")
    both = staged(spark, held.unionByName(asked), "spelling-blocks")

    group_of = np.zeros(256, np.int64)
    for g, own in enumerate(letters):
        for c in own:
            group_of[ord(c)] = g

    def search(table: pa.Table) -> pa.Table:
        state = table.column("state").to_numpy()
        node = table.column("node")[0].as_py()
        text = np.array(table.column("word").to_pylist(), object)
        times = table.column("n").to_numpy()
        held, asked = state < 0, state >= 0
        words, searches = list(text[held]), list(text[asked])
        pairs = pairs_within(words, searches, state[asked].astype(np.int64),
                             len(node.split(".")) if node else 0, group_of, groups)
        s, w = [p[0] for p in pairs], [p[1] for p in pairs]
        return pa.table({
            "word": pa.array([searches[i] for i in s] + [words[i] for i in w], pa.string()),
            "near": pa.array([words[i] for i in w] + [searches[i] for i in s], pa.string()),
            "near_n": pa.array(np.concatenate([times[held][w], times[asked][s]]) if pairs else [], pa.int64())})

    tasks = max(1, math.ceil(both.count() / ROWS_A_TASK))
    return both.repartition(tasks, "node", "x", "y").groupBy("node", "x", "y").applyInArrow(
        search, T.StructType([T.StructField("word", T.StringType()), T.StructField("near", T.StringType()),
                              T.StructField("near_n", T.LongType())]))


def roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """``word, root`` of ``forms(word, form)``, by pointer jumping."""
    now, path = staged_at(spark, forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        after = (now.alias("a").join(now.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left")
                 .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        last = path
        after, path = staged_at(spark, after, "spelling-roots")
        drop_scratch(spark, last)  # the round after it is written
        if after.where("moved").isEmpty():
            return after.select("word", "root")
        now = after.select("word", "root")


def variants(spark: SparkSession, words: DataFrame, ratio: int = RATIO, **search) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every one of ``words(word, n)``."""
    words = staged(spark, words, "spelling-words")
    near = near_pairs(spark, words, **search).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    strong = -F.col("best.n") >= ratio * F.col("n")
    chosen = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("best.near")).alias("form"), F.when(strong, -F.col("best.n")).alias("form_n"))
    chosen = staged(spark, chosen, "spelling-forms")
    ends = roots(spark, chosen.where("form IS NOT NULL"))
    return chosen.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.plans.tables import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return variants(spark, spellings(docs, damaged)).select("word", "form", "root", "n", "n_near", "form_n")

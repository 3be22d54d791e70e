"""Approximate nearest neighbours by a hierarchical k-means tree.

A tree of centroids is fitted on a bounded sample; every vector is indexed at
the leaf it descends to.  A query walks the tree best bin first: a priority
queue holds the open nodes by the distance to their centroid, the nearest is
opened next, and leaves come out in the order in which they are visited.  How
many leaves to visit is calibrated: the true neighbours of ``CALIBRATION``
queries are found by brute force over all vectors, and the number of visits is
widened until those lie in visited leaves for a share of ``TARGET``.  A query
whose leaves are small goes on past that number until they hold k + 1 entries.

The sample bounds the number of leaves, not the table.  A leaf of more than
``REFIT`` entries gets a tree of its own, fitted on executors on about
``SAMPLE`` of its entries, so that its leaves come near ``LEAF_VECTORS``: two
levels reach some 10^9 distinct vectors.  Best bin first goes on across both:
each visited leaf offers its own leaves by the distance to their centroid, and
a query visits the nearest of all those offered, as many as calibration says.

Equal vectors are one entry that keeps its smallest ids, so copies cost
nothing and lose nothing.  A leaf is searched in blocks of vectors against
blocks of the queries that visit it, so neither a full leaf nor a popular one
is one task.  Fitted on at most ``SAMPLE`` vectors (and ``SAMPLE_BYTES``).

Cases: rows whose id or vector is null, or whose vector is zero, holds null or
non-finite components or has not the most common length (the longer on ties)
take no part; rows that agree in id and vector are one; a row of the query's
own id is never its neighbour; ties go to the smaller id; with fewer than k
others all are returned; no vectors, no rows; other columns are never read.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.common import staged

NEIGHBOURS = 10
SAMPLE = 20_000
SAMPLE_BYTES = 64 << 20
BRANCHES = 8
LEAF_VECTORS = 2048      # vectors of a leaf, as far as the sample allows
REFIT = 3 * LEAF_VECTORS # entries of a leaf that stays whole, at most
LEAST_LEAVES = 64
LEAF_SAMPLE = 32         # sample vectors of a leaf, at least
CALIBRATION = 128
TARGET = 0.97
BLOCK = 4096
ROUNDS = 10
SEED = 11


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * (x @ y.T)


def k_means(x: np.ndarray, k: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Centroids and the vectors' clusters; empty clusters are left out."""
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(ROUNDS):
        own = _squares(x, centres).argmin(1)
        used, own = np.unique(own, return_inverse=True)
        sums = np.zeros((len(used), x.shape[1]))
        np.add.at(sums, own, x)
        centres = sums / np.bincount(own)[:, None]
    own = _squares(x, centres).argmin(1)
    used, own = np.unique(own, return_inverse=True)
    return centres[used], own


class Tree:
    """Nodes as arrays: centroids, first and last child; leaves have numbers."""

    def __init__(self, sample: np.ndarray, leaf_size: int):
        rng = np.random.default_rng(SEED)
        self.centres = [sample.mean(0)]
        self.children: list[list[int]] = [[]]
        todo = [(0, sample)]
        while todo:
            node, x = todo.pop()
            if len(x) <= leaf_size:
                continue
            centres, own = k_means(x, BRANCHES, rng)
            if len(centres) < 2:
                continue
            for i, centre in enumerate(centres):
                self.children[node].append(len(self.centres))
                todo.append((len(self.centres), x[own == i]))
                self.centres.append(centre)
                self.children.append([])
        self.centres = np.array(self.centres)
        leaves = [n for n, c in enumerate(self.children) if not c]
        self.leaf = {n: i for i, n in enumerate(leaves)}

    def descend(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector: the nearest child at every node."""
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            below = self.children[node]
            if not below:
                out[rows] = self.leaf[node]
            elif len(rows):
                own = _squares(x[rows], self.centres[below]).argmin(1)
                todo += [(child, rows[own == i]) for i, child in enumerate(below)]
        return out

    def bins(self, query: np.ndarray) -> Iterator[tuple[int, float]]:
        """All leaves, best bin first, each with the largest distance popped so far."""
        gap = ((self.centres - query) ** 2).sum(1)
        queue, reached = [(0.0, 0)], 0.0
        while queue:
            own, node = heapq.heappop(queue)
            reached = max(reached, own)
            if self.children[node]:
                for child in self.children[node]:
                    heapq.heappush(queue, (float(gap[child]), child))
            else:
                yield self.leaf[node], reached

    def visits(self, query: np.ndarray, n: int, entries: np.ndarray | None = None,
               least: int = 0) -> list[int]:
        """The first ``n`` leaves, best bin first, and further ones until they
        hold ``least`` of the ``entries`` counted by leaf."""
        out, held = [], 0
        for leaf, _ in self.bins(query):
            if len(out) >= n and held >= least:
                break
            out.append(leaf)
            if entries is not None:
                held += int(entries[leaf])
        return out

    @classmethod
    def of(cls, state: dict) -> Tree:
        own = cls.__new__(cls)
        own.__dict__.update(state)
        return own


def nearest(query: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and distances of the ``k`` nearest rows of ``x``, ties to the
    smaller id; a first look by products, exact distances for what it leaves."""
    rows = np.arange(len(x))
    if len(x) > k:
        own, all_squares = query @ query, (x * x).sum(1)
        rough = all_squares - 2 * (x @ query)
        edge = np.partition(rough, k - 1)[k - 1] + 1e-11 * (own + all_squares.max())
        if np.isfinite(edge):
            rows = np.flatnonzero(rough <= edge)
    gap = np.sqrt(((x[rows] - query) ** 2).sum(1))
    order = np.lexsort((ids[rows], gap))[:k]
    return rows[order], gap[order]


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, vec`` (array of doubles) of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("vec", lambda x: x != 0)
    rows = rows.where("vec_id IS NOT NULL AND vec IS NOT NULL").where(
        F.coalesce(~bad, F.lit(False)) & F.coalesce(some, F.lit(False)))
    size = rows.groupBy(F.size("vec").alias("d")).count().orderBy(
        F.col("count").desc(), F.col("d").desc()).limit(1).collect()
    return rows.where(F.size("vec") == (size[0].d if size else 0)).distinct()


def entries(rows: DataFrame, keep: int) -> DataFrame:
    """``rep`` (smallest id), ``ids`` (the ``keep`` smallest), ``vec`` of each
    distinct vector."""
    rank = F.dense_rank().over(Window.partitionBy("vec").orderBy("vec_id"))
    return (rows.withColumn("rank", rank).where(F.col("rank") <= keep)
            .groupBy("vec").agg(F.min("vec_id").alias("rep"),
                                F.sort_array(F.collect_set("vec_id")).alias("ids"))
            .select("rep", "ids", "vec"))


def _matrix(column: pa.Array) -> np.ndarray:
    """A non-null list column of equal lengths as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def fit_tree(found: DataFrame, sample: int = SAMPLE) -> Tree | None:
    first = found.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    if not first[0]:
        return None
    bound = max(1, min(sample, SAMPLE_BYTES // (8 * first[1])))
    rows = found.orderBy(F.xxhash64("rep"), "rep").limit(bound).select("vec").toArrow()
    x = _matrix(rows.column("vec").combine_chunks())
    leaves = max(LEAST_LEAVES, first[0] // LEAF_VECTORS)
    return Tree(x, max(LEAF_SAMPLE, len(x) // leaves))


def build_index(spark: SparkSession, found: DataFrame, tree: Tree) -> DataFrame:
    """``leaf, rep, ids, vec`` of every entry, as a table."""
    shared = spark.sparkContext.broadcast(vars(tree))  # bounded by the sample

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Tree.of(shared.value)
        for batch in batches:
            if batch.num_rows:
                leaf = own.descend(_matrix(batch.column("vec")))
                yield pa.RecordBatch.from_arrays([pa.array(leaf), *batch.columns],
                                                 names=["leaf", "rep", "ids", "vec"])

    return staged(spark, found.mapInArrow(
        place, "leaf long, rep long, ids array<long>, vec array<double>"), "ann-index")


def leaf_sizes(index: DataFrame, tree: Tree) -> np.ndarray:
    """Entries by leaf: a row per leaf, bounded by the tree."""
    out = np.zeros(len(tree.leaf), np.int64)
    counted = index.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()
    out[[r.leaf for r in counted]] = [r.n for r in counted]
    return out


def _dealt(rows: DataFrame, count: str, key: str) -> DataFrame:
    return rows.withColumn("chunk", F.pmod(F.xxhash64(key), F.ceil(F.col(count) / (4 * BLOCK))))


def _to_all(rows: DataFrame, count: str) -> DataFrame:
    last = F.ceil(F.col(count) / (4 * BLOCK)) - 1
    return rows.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), last)))


def refit(spark: SparkSession, index: DataFrame, sizes: np.ndarray, sample: int,
          limit: int, leaf_vectors: int) -> tuple[DataFrame, DataFrame | None]:
    """The index with ``sub`` (leaf inside a leaf, 0 where that stays whole), and
    ``leaf, n, state, sizes`` of the trees of over-full leaves (None: there are none)."""
    full = [(int(leaf), int(n)) for leaf, n in enumerate(sizes) if n > limit]
    if not full:
        return index.withColumn("sub", F.lit(0).cast("long")), None
    large = spark.createDataFrame(full, "leaf long, n long")  # at most the tree's leaves
    dim = index.select(F.size("vec").alias("d")).first().d
    bound = max(LEAF_SAMPLE, min(sample, SAMPLE_BYTES // (8 * dim)))
    share = F.pmod(F.xxhash64("rep", F.lit(SEED)), F.lit(1 << 30)) / float(1 << 30)

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("rep")
        x, n = np.stack(group["vec"]), int(group["n"].iloc[0])
        tree = Tree(x, max(LEAF_SAMPLE, len(x) * leaf_vectors // n))
        return pd.DataFrame({"leaf": group["leaf"].iloc[:1], "n": n, "state": [pickle.dumps(vars(tree))]})

    taken = index.join(large, "leaf").where(share * F.col("n") < bound).select("leaf", "n", "rep", "vec")
    trees = staged(spark, taken.groupBy("leaf").applyInPandas(
        fit, "leaf long, n long, state binary"), "ann-subtrees")
    sizes_of = trees.select("leaf", "n")

    def place(rows: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(tree):
            return pd.DataFrame(columns=["leaf", "sub", "rep", "ids", "vec"])
        own = Tree.of(pickle.loads(tree["state"].iloc[0]))
        rows["sub"] = own.descend(np.stack(rows["vec"]))
        return rows[["leaf", "sub", "rep", "ids", "vec"]]

    keys = ("leaf", "chunk")
    moved = (_dealt(index.join(sizes_of, "leaf"), "n", "rep").drop("n").groupBy(*keys)
             .cogroup(_to_all(trees, "n").groupBy(*keys))
             .applyInPandas(place, "leaf long, sub long, rep long, ids array<long>, vec array<double>"))
    whole = index.join(sizes_of, "leaf", "left_anti").withColumn("sub", F.lit(0).cast("long"))
    index = staged(spark, whole.select(*moved.columns).unionAll(moved), "ann-index")
    held = (index.join(sizes_of, "leaf", "left_semi").groupBy("leaf", "sub").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("leaf").agg(F.map_from_entries(F.collect_list(F.struct("sub", "n"))).alias("sizes")))
    return index, staged(spark, trees.join(held, "leaf"), "ann-subtrees")


def true_leaves(spark: SparkSession, index: DataFrame, queries: DataFrame, k: int,
                size: int = CALIBRATION) -> tuple[dict, list]:
    """``size`` queries (by hash), and ``query, leaf, sub`` of their ``k``
    nearest entries among all vectors."""
    rows = queries.orderBy(F.xxhash64("rep"), "rep").limit(size).collect()
    reps, x = np.array([r.rep for r in rows]), np.array([r.vec for r in rows])
    shared = spark.sparkContext.broadcast((reps, x))  # ``size`` vectors
    schema = "query long, leaf long, sub long, rep long, gap double"

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_reps, own = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, vecs = batch.column("rep").to_numpy(), _matrix(batch.column("vec"))
            leaf, sub = batch.column("leaf").to_numpy(), batch.column("sub").to_numpy()
            out: list[tuple] = []
            for rep, query in zip(own_reps, own):
                at, gap = nearest(query, vecs, ids, k + 1)
                out += [(rep, leaf[i], sub[i], ids[i], g) for i, g in zip(at, gap) if ids[i] != rep][:k]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in zip(*out)] if out else
                [pa.array([], t) for t in (*[pa.int64()] * 4, pa.float64())],
                names=["query", "leaf", "sub", "rep", "gap"])

    rank = F.row_number().over(Window.partitionBy("query").orderBy("gap", "rep"))
    true = (index.select("leaf", "sub", "rep", "vec").mapInArrow(search, schema)
            .withColumn("rank", rank).where(F.col("rank") <= k).select("query", "leaf", "sub").collect())
    return {int(r): q for r, q in zip(reps, x)}, true


def enough(needed: np.ndarray, target: float, most: int) -> int:
    """The least number of visits that reaches a share ``target`` of the needed ranks."""
    visits = 1
    while visits < most and len(needed) and (needed < visits).mean() < target:
        visits += 1
    return visits


def calibrate(tree: Tree, queries: dict, true: list, target: float) -> int:
    """Leaves to visit so that a share ``target`` of the true neighbours lies in them."""
    order = {rep: {leaf: i for i, leaf in enumerate(tree.visits(q, len(tree.leaf)))}
             for rep, q in queries.items()}
    return enough(np.array([order[r["query"]][r.leaf] for r in true]), target, len(tree.leaf))


def walk(spark: SparkSession, queries: DataFrame, tree: Tree, sizes: np.ndarray, visits: int,
         k: int) -> DataFrame:
    """``leaf, sub`` (0), ``query, vec, gap`` of the leaves that each of
    ``queries(rep, vec)`` visits, its home among them."""
    shared = spark.sparkContext.broadcast((vars(tree), sizes))

    def best_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, held = shared.value
        own = Tree.of(state)
        centres = own.centres[[n for n, _ in sorted(own.leaf.items(), key=lambda p: p[1])]]
        for batch in (b.slice(i, 64) for b in batches for i in range(0, b.num_rows, 64)):
            x = _matrix(batch.column("vec"))
            home = own.descend(x)
            lists = [sorted({int(h), *own.visits(q, visits, held, k + 1)}) for q, h in zip(x, home)]
            row = np.repeat(np.arange(len(x)), [len(v) for v in lists])
            leaf = np.concatenate(lists).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaf), pa.array(np.zeros(len(leaf), np.int64)),
                 batch.column("rep").take(pa.array(row)), batch.column("vec").take(pa.array(row)),
                 pa.array(((centres[leaf] - x[row]) ** 2).sum(1))],
                names=["leaf", "sub", "query", "vec", "gap"])

    return queries.select("rep", "vec").mapInArrow(
        best_bins, "leaf long, sub long, query long, vec array<double>, gap double")


def walk_on(walks: DataFrame, trees: DataFrame, visits: int | None, k: int) -> DataFrame:
    """The over-full leaves of ``walks`` replaced by their own first leaves that
    hold entries (``visits`` of them, or all), each with its place ``at`` and its
    entries ``held``; ``gap`` never falls along a walk."""
    keys = ("leaf", "chunk")
    asked = walks.join(trees.select("leaf"), "leaf", "left_semi")
    counts = asked.groupBy("leaf").agg(F.count(F.lit(1)).alias("asked"))

    def best_bins(rows: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(tree):
            own, sizes = Tree.of(pickle.loads(tree["state"].iloc[0])), dict(tree["sizes"].iloc[0])
            for leaf, query, vec in zip(rows["leaf"], rows["query"], rows["vec"]):
                taken, held = 0, 0
                for sub, gap in own.bins(vec):
                    if taken >= (visits or len(own.leaf)) and held >= k + 1:
                        break
                    if sub in sizes:  # it holds entries
                        out.append((leaf, sub, query, vec, gap, taken, sizes[sub]))
                        taken, held = taken + 1, held + sizes[sub]
        return pd.DataFrame(out, columns=["leaf", "sub", "query", "vec", "gap", "at", "held"])

    schema = "leaf long, sub long, query long, vec array<double>, gap double, at long, held long"
    dealt = _dealt(asked.join(counts, "leaf"), "asked", "query").drop("asked")
    return dealt.groupBy(*keys).cogroup(_to_all(trees.join(counts, "leaf"), "asked").groupBy(*keys)
                                        ).applyInPandas(best_bins, schema)


def visited(spark: SparkSession, walks: DataFrame, trees: DataFrame, sizes: np.ndarray,
            visits: int | None, k: int) -> DataFrame:
    """``walks`` over both levels with ``rank``, nearest centroid first: of each
    query ``visits`` leaves (or all), and further ones until they hold k + 1 entries."""
    held = spark.createDataFrame([(i, int(n)) for i, n in enumerate(sizes)], "leaf long, held long")
    whole = walks.join(trees.select("leaf"), "leaf", "left_anti").join(held, "leaf")
    whole = whole.withColumn("at", F.lit(0).cast("long"))
    on = walk_on(walks, trees, visits, k)
    both = on.unionByName(whole)
    order = Window.partitionBy("query").orderBy("gap", "leaf", "at")
    before = F.sum("held").over(order.rowsBetween(Window.unboundedPreceding, -1))
    out = both.withColumn("rank", F.row_number().over(order))
    if visits is not None:
        out = out.withColumn("before", F.coalesce(before, F.lit(0))).where(
            (F.col("rank") <= visits) | (F.col("before") < k + 1)).drop("before")
    return out.drop("held", "at")


def calibrate_on(spark: SparkSession, walks: DataFrame, trees: DataFrame, sizes: np.ndarray,
                 queries: dict, true: list, target: float, k: int) -> int:
    """As :func:`calibrate`, over the leaves of both levels."""
    some = spark.createDataFrame([(q,) for q in queries], "query long")
    wanted = spark.createDataFrame([(r["query"], r.leaf, r.sub) for r in true],
                                   "query long, leaf long, sub long")
    ranks = visited(spark, walks.join(some, "query", "left_semi"), trees, sizes, None, k)
    rows = wanted.join(ranks.select("query", "leaf", "sub", "rank"), ["query", "leaf", "sub"]).collect()
    last = max((r["rank"] for r in rows), default=1)
    needed = np.array([r["rank"] - 1 for r in rows] + [last] * (len(true) - len(rows)))
    return enough(needed, target, last)


def search(index: DataFrame, walks: DataFrame, k: int, block: int = BLOCK) -> DataFrame:
    """``query`` (entry), ``vec_id, gap``: the ``k`` nearest rows by visited leaves."""
    leaf = ["leaf", "sub"]
    parts = (index.groupBy(*leaf).agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
             .join(walks.groupBy(*leaf).agg(F.ceil(F.count(F.lit(1)) / block).alias("chunks")), leaf))

    def cell(key: str, count: str, other: str):
        return [F.pmod(F.xxhash64(key), F.col(count)).alias(count[:-1]),
                F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(other[:-1])]

    own = index.join(parts, leaf).select(*leaf, "rep", "ids", "vec", *cell("rep", "blocks", "chunks"))
    asked = walks.join(parts, leaf).select(*leaf, "query", "vec", *cell("query", "chunks", "blocks"))

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            x, reps, ids = np.stack(left["vec"]), left["rep"].to_numpy(), left["ids"].to_numpy()
            for query, vec in zip(right["query"], right["vec"]):
                at, gap = nearest(np.asarray(vec), x, reps, k + 1)
                found = sorted((g, int(i)) for p, g in zip(at, gap) for i in ids[p])[:k + 1]
                out += [(query, i, g) for g, i in found]
        return pd.DataFrame(out, columns=["query", "vec_id", "gap"])

    keys = (*leaf, "block", "chunk")
    found = own.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(
        compare, "query long, vec_id long, gap double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy("gap", "vec_id"))
    return found.withColumn("n", rank).where(F.col("n") <= k + 1).drop("n")


def neighbours(spark: SparkSession, vectors: DataFrame, is_query, k: int = NEIGHBOURS,
               target: float = TARGET, sample: int = SAMPLE, refit_above: int = REFIT,
               leaf_vectors: int = LEAF_VECTORS) -> DataFrame:
    """``query_id, rank, vec_id, score`` (distance) of the rows of
    ``vectors(vec_id, embedding)`` for which the column ``is_query`` holds."""
    rows = staged(spark, usable(vectors), "ann-rows")
    found = staged(spark, entries(rows, k + 1), "ann-entries")
    asked = rows.where(is_query).join(found.select("rep", "vec"), "vec").select("vec_id", "rep", "vec")
    asked = staged(spark, asked, "ann-queries")
    own = asked.select("rep", "vec").distinct()
    tree = fit_tree(found, sample)
    if tree is None or not asked.take(1):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = build_index(spark, found, tree)
    sizes = leaf_sizes(index, tree)
    index, trees = refit(spark, index, sizes, sample, refit_above, leaf_vectors)
    some, true = true_leaves(spark, index, own, k)
    # with two levels the first one keeps half of what may be missed
    visits = calibrate(tree, some, true, target if trees is None else (1 + target) / 2)
    walks = staged(spark, walk(spark, own, tree, sizes, visits, k), "ann-visits")
    if trees is not None:
        visits = calibrate_on(spark, walks, trees, sizes, some, true, target, k)
        walks = staged(spark, visited(spark, walks, trees, sizes, visits, k), "ann-visits")
    near = search(index, walks, k)
    pairs = (asked.select(F.col("vec_id").alias("query_id"), F.col("rep").alias("query"))
             .join(near, "query").where("query_id <> vec_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("gap", "vec_id"))
    return (pairs.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", F.col("gap").alias("score")))


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.plans.tables import table

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours(spark, vectors, F.col("vec_id") % 100 == 0)

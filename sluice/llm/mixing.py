"""Mixing sources to target weights, in DataFrame and SQL functions only.

Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating, and
share ``SHARE`` of all words; a target stops at ``MAX_PASSES`` times its
source's words and the excess is shared anew by weight until none is above.

Draw: a source's documents lie in a permuted order (by a seeded hash of the
id), end to end and ``MAX_PASSES`` times over.  The first ``round(target)``
words of that stream are the source's quota, cut into blocks of
``BLOCK_WORDS``; only the last is shorter, so the quota is met to the word.  A
splitting tree deals the quotas to 2^d output shards: each node sends half of
its blocks to either side, and how many of each source go left is drawn from
the multivariate hypergeometric distribution (source by source, by inversion).
A source's blocks, in an order permuted by a seeded hash (swap-or-not, a
bijection for any number of blocks), fill its shares of the shards in turn, so
draws are disjoint and none is lost.  ``mix`` returns this plan, a row per
document; ``drawn`` carries it out: the drawn words, gathered by shard and
shuffled inside it by a seeded ``place``.

Positions are two-level prefix sums, over buckets of the permuted order and
inside each, so a source that holds a third of all rows is not one task.  A
document's blocks find their shards by a join on (source, stretch of blocks), so
no row grows with the number of shards.

Cases: a null or empty text has 0 words and is never drawn; a null source is a
source; a null id is ordered as an empty one; rows of one id lie together in the
permuted order, identical ones in any; repeated rows each count; a very long text
is cut into as many draws as it has blocks, one text (with its words) per task
slot; other columns are never read, whatever their names; no rows, no result; all
sizes 0, all targets 0.  The source table (a row per source) is what must fit one
task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.common import staged

SHARE = 1.5
MAX_PASSES = 2
BLOCK_WORDS = 4096
SHARD_BLOCKS = 4096      # an output shard holds about so many blocks
MIN_DEPTH = 3            # and there are at least 2^3 of them
SPREAD_LEVELS = 8        # of the tree between two shuffles of its nodes
BUCKET_ROWS = 16_384     # documents of one bucket of the permuted order
SEED = "mix"
SHUFFLE_ROUNDS = 32      # of the permutation of blocks
WORD = r"[^\x20\x09-\x0D]+"


def place_hash(column: str) -> Column:
    """Where a document lies in the permuted order of its source."""
    return F.md5(F.concat(F.lit(SEED + "|"), F.coalesce(F.col(column).cast("string"), F.lit("")))
                 .cast("binary"))


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, h`` (place in the permuted order) ``, th``."""
    return docs.select(
        "doc_id", "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0))
        .cast("long").alias("size"),
        place_hash("doc_id").alias("h"),
        F.xxhash64("text").alias("th"))


def targets(rows: DataFrame) -> DataFrame:
    """``source, source_size, target`` and its whole words ``quota``."""
    ranked = Window.orderBy(F.col("source").asc_nulls_last())
    by = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    by = by.withColumn("rank", F.row_number().over(ranked)).withColumn(
        "w", F.get(F.array(F.lit(5), F.lit(2), F.lit(1)), F.pmod(F.col("rank") - 1, F.lit(3))))
    # the sources that are full at the common level come first
    full = Window.orderBy(F.lit(float(MAX_PASSES)) * F.col("source_size") / F.col("w"), "rank")
    total = F.sum("source_size").over(Window.partitionBy())
    level = (F.lit(SHARE) * total - F.coalesce(F.sum(F.lit(MAX_PASSES) * F.col("source_size")).over(
        full.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))) / F.sum("w").over(
        full.rowsBetween(0, Window.unboundedFollowing))
    by = by.withColumn("level", level).withColumn("level", F.max("level").over(Window.partitionBy()))
    target = F.least(F.lit(float(MAX_PASSES)) * F.col("source_size"), F.col("level") * F.col("w"))
    return by.select("source", "rank", "source_size", target.alias("target"),
                     F.floor(target + 0.5).cast("long").alias("quota"))


def _hypergeometric(n: str, k: str, draws: str, u: str) -> str:
    """How many of ``draws`` from ``n`` blocks are of a kind that has ``k``,
    by inversion at ``u``; sums run over 12 standard deviations either way."""
    p = f"({k} / cast({n} as double))"
    mean = f"({draws} * {p})"
    sd = (f"sqrt(greatest(0D, {mean} * (1 - {p}) * ({n} - {draws}) / greatest({n} - 1, 1)))")
    low = f"greatest(0L, {draws} - ({n} - {k}), cast(floor({mean} - 12 * {sd} - 12) as bigint))"
    high = f"least({draws}, {k}, cast(ceil({mean} + 12 * {sd} + 12) as bigint))"
    step = (f"e.w * (({k} - x) * cast({draws} - x as double))"
            f" / (cast(x + 1 as double) * ({n} - {k} - {draws} + x + 1))")
    # element 0 of a one-element transform binds a name
    return f"""
    case when {k} = 0 or {draws} = 0 then 0L when {draws} = {n} then {k} else
    transform(array(sequence({low}, {high})), xs -> transform(array(aggregate(xs,
      named_struct('w', 1D, 's', 0D), (e, x) -> named_struct('w', {step}, 's', e.s + e.w), e -> e.s)),
      s -> aggregate(xs, named_struct('w', 1D, 's', 0D, 'at', -1L),
        (e, x) -> named_struct('w', {step}, 's', e.s + e.w,
          'at', if(e.at < 0 and e.s + e.w >= {u} * s, x, e.at)),
        e -> if(e.at < 0, xs[size(xs) - 1], e.at)))[0])[0] end"""


def split(nodes: DataFrame) -> DataFrame:
    """One level of the tree: ``node, quotas`` (blocks by source) becomes two
    children with half of the blocks each."""
    u = "(pmod(xxhash64('tree', node, i), 9007199254740992L) / 9007199254740992D)"
    draw = _hypergeometric("a.rest", "quotas[i]", "a.draws", u)
    left = f"""aggregate(sequence(0, size(quotas) - 1),
      transform(array(aggregate(quotas, 0L, (a, q) -> a + q)),
        t -> named_struct('rest', t, 'draws', t div 2, 'part', cast(array() as array<bigint>)))[0],
      (a, i) -> transform(array({draw}), x -> named_struct('rest', a.rest - quotas[i],
        'draws', a.draws - x, 'part', concat(a.part, array(x))))[0], a -> a.part)"""
    # the left child's blocks of a source come first
    begins = "starts" in nodes.columns
    own, other = (", 'starts', starts", ", 'starts', zip_with(starts, l, (s, x) -> s + x)") if begins else ("", "")
    halves = nodes.select(F.expr(f"""explode(transform(array({left}), l -> array(
        named_struct('node', node * 2, 'quotas', l{own}),
        named_struct('node', node * 2 + 1, 'quotas', zip_with(quotas, l, (q, x) -> q - x){other})))[0])""")
                          .alias("half"))
    return halves.select("half.*")


def deal(sources: DataFrame, depth: int) -> DataFrame:
    """``rank, stretch, shard, low, high``: shard s takes the permuted blocks of
    source ``rank`` from ``low`` to ``high``.  A row per stretch of ``width`` blocks
    that the range meets; ``width`` is the mean of a source's ranges, so a stretch
    meets few."""
    nodes = sources.agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "blocks"))),
                                    lambda s: s["blocks"]).alias("quotas"))
    nodes = nodes.select(F.lit(1).cast("long").alias("node"), "quotas",
                         F.expr("transform(quotas, q -> 0L)").alias("starts")).where(F.size("quotas") > 0)
    for level in range(depth):
        nodes = split(nodes)
        if level % SPREAD_LEVELS == SPREAD_LEVELS - 1:
            nodes = nodes.repartition("node")
    ranges = nodes.select((F.col("node") - (1 << depth)).alias("shard"),
                          F.posexplode(F.arrays_zip("quotas", "starts")).alias("at", "own"))
    ranges = ranges.select((F.col("at") + 1).cast("int").alias("rank"), "shard", F.col("own.starts").alias("low"),
                           (F.col("own.starts") + F.col("own.quotas")).alias("high")).where("low < high")
    return ranges.join(sources.select("rank", "width"), "rank").select(
        "rank", F.explode(F.expr("sequence(low div width, (high - 1) div width)")).alias("stretch"),
        "shard", "low", "high")


def mix(spark: SparkSession, docs: DataFrame, block_words: int = BLOCK_WORDS,
        shard_blocks: int = SHARD_BLOCKS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per row of ``docs(doc_id, text, source)``: ``doc_id, source,
    size, th`` (hash of the text) ``, source_size, target, taken`` and ``draws``, an array of ``pass,
    first, last`` (its words, the last not included) ``, shard, place`` (order
    inside the shard)."""
    w = block_words
    rows = staged(spark, sized(docs), "mix-sizes")
    n = rows.count()
    digits = max(0, math.ceil(math.log(max(1, n) / bucket_rows, 16)))
    sources = targets(rows).withColumn("blocks", F.expr(f"(quota + {w - 1}) div {w}"))
    sources = staged(spark, sources, "mix-targets")
    blocks = sources.agg(F.sum("blocks")).first()[0] or 0
    depth = max(MIN_DEPTH, math.ceil(math.log2(max(1, blocks / shard_blocks))))
    sources = sources.withColumn("width", F.greatest(F.lit(1).cast("long"), F.expr(f"blocks div {1 << depth}")))
    ranges = staged(spark, deal(sources, depth), "mix-deal")

    rows = rows.withColumn("bucket", F.substring("h", 1, digits))
    bases = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    bases = bases.select("source", "bucket", (F.sum("words").over(
        Window.partitionBy("source").orderBy("bucket")) - F.col("words")).alias("base"))
    inside = Window.partitionBy("source", "bucket").orderBy("h", "size", "th")
    placed = rows.withColumn("inner", F.sum("size").over(
        inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    placed = (placed.alias("p").join(bases.alias("b"), F.col("p.source").eqNullSafe(F.col("b.source"))
                                     & (F.col("p.bucket") == F.col("b.bucket")))
              .select("p.doc_id", "p.source", "p.size", "p.th",
                      (F.col("inner") + F.col("base")).alias("start")))
    placed = (placed.alias("p").join(sources.alias("s"), F.col("p.source").eqNullSafe(F.col("s.source")))
              .select("p.*", "s.rank", "s.source_size", "s.target", "s.quota", "s.blocks", "s.width"))
    # a place in a source's stream is one document's, unless that has no words
    placed = staged(spark, placed.withColumn("at", F.expr("if(size > 0, start, null)")), "mix-placed")

    # swap-or-not: each round pairs the blocks that sum to its key and swaps a pair or not
    permuted = f"""aggregate(sequence(0, {SHUFFLE_ROUNDS - 1}), cast(b as bigint), (x, r) ->
      transform(array(pmod(pmod(xxhash64('{SEED}', 'key', rank, r), blocks) - x, blocks)), y ->
        if(pmod(xxhash64('{SEED}', 'swap', rank, r, greatest(x, y)), 2) = 0, x, y))[0])"""
    cut = F.expr(f"""inline(flatten(transform(sequence(0, {MAX_PASSES - 1}), p ->
      if(start + p * source_size >= quota, array(),
        transform(sequence((start + p * source_size) div {w},
                           (least(quota, start + p * source_size + size) - 1) div {w}),
          b -> named_struct('block', {permuted}, 'pass', p,
            'first', greatest(b * {w} - start - p * source_size, 0L),
            'last', least((b + 1) * {w}, quota, start + p * source_size + size) - start - p * source_size))))))""")
    draws = placed.where("size > 0 AND start < quota").select("rank", "at", "width", cut)
    draws = draws.withColumn("stretch", F.expr("block div width")).alias("d").join(
        ranges.alias("r"), (F.col("d.rank") == F.col("r.rank")) & (F.col("d.stretch") == F.col("r.stretch"))
        & (F.col("r.low") <= F.col("d.block")) & (F.col("d.block") < F.col("r.high")))
    # at most two passes over the blocks of one text
    own = draws.groupBy("d.rank", "d.at").agg(F.sort_array(F.collect_list(F.struct(
        "pass", "first", "last", "shard", F.xxhash64(F.lit(SEED), "d.rank", "block").alias("place")))).alias("draws"))
    plan = placed.join(own, ["rank", "at"], "left").select(
        "doc_id", "source", "size", "th", "source_size", "target",
        F.coalesce("draws", F.lit([]).cast(own.schema["draws"].dataType)).alias("draws"))
    return plan.withColumn("taken", F.aggregate(
        "draws", F.lit(0).cast("long"), lambda a, d: a + d["last"] - d["first"]))


def drawn(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """``shard, place, pass, doc_id, source, size, source_size, target, first,
    taken, text``: the words, joined by single spaces, that the plan ``mixed`` (of
    ``mix`` over ``docs``) draws, ``taken`` of them from word ``first`` on.  A
    shard is in one partition, its blocks ordered by ``place`` and a block's
    draws as they lie in the stream."""
    # rows that agree in id, source and text are alike: one text serves them all
    texts = docs.select("doc_id", "source", "text").distinct().withColumn("th", F.xxhash64("text"))
    plan = mixed.where(F.size("draws") > 0).select("doc_id", "source", "size", "th", "source_size", "target", "draws")
    cut = F.expr(rf"""explode(transform(array(regexp_extract_all(text, r'{WORD}', 0)),
      words -> transform(draws, d -> named_struct('draw', d, 'text',
        array_join(slice(words, cast(d.first + 1 as int), cast(d.last - d.first as int)), ' '))))[0])""")
    rows = (plan.alias("p").join(texts.alias("t"), F.col("p.doc_id").eqNullSafe(F.col("t.doc_id"))
                                 & F.col("p.source").eqNullSafe(F.col("t.source"))
                                 & (F.col("p.th") == F.col("t.th")))
            .select("p.doc_id", "p.source", "p.size", "p.th", "p.source_size", "p.target",
                    place_hash("p.doc_id").alias("h"), cut.alias("cut")))
    rows = rows.select("cut.draw.*", "doc_id", "source", "size", "th", "source_size", "target", "h", "cut.text")
    return (rows.repartition("shard")
            .sortWithinPartitions("shard", "place", "pass", "h", "size", "th", "first")
            .select("shard", "place", "pass", "doc_id", "source", "size", "source_size", "target", "first",
                    (F.col("last") - F.col("first")).alias("taken"), "text"))


def mixed_words(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The mix itself: the plan written once and carried out."""
    return drawn(docs, staged(spark, mix(spark, docs), "mix-plan"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.plans.tables import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(spark, docs).select("doc_id", "size", "source_size", "target", "taken")


OP2_SQL = rf"""
WITH d AS (SELECT doc_id, source, md5('{SEED}|' || coalesce(doc_id::VARCHAR, '')) AS h,
                  coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
           FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             row_number() OVER (ORDER BY source NULLS LAST) AS k FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][((k - 1) % 3 + 1)::INT] AS w FROM s),
l AS (SELECT *, ({SHARE}::DOUBLE * sum(source_size) OVER ()::DOUBLE
        - coalesce(sum({MAX_PASSES} * source_size) OVER (ORDER BY {MAX_PASSES}::DOUBLE * source_size / w, k
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
        / sum(w) OVER (ORDER BY {MAX_PASSES}::DOUBLE * source_size / w, k
                       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS lv FROM w),
t AS (SELECT source, source_size, least({MAX_PASSES}::DOUBLE * source_size, max(lv) OVER () * w) AS target
      FROM l),
p AS (SELECT doc_id, d.source, size, source_size, target, floor(target + 0.5)::BIGINT AS quota,
             sum(size) OVER (PARTITION BY d.source ORDER BY h, size
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(size, quota - start))
        + greatest(0, least(size, quota - start - source_size)))::BIGINT AS taken
FROM p
"""

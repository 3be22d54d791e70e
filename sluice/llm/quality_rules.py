"""Quality rules as a learned decision list, in DataFrame and SQL functions only.

``document_stats`` counts, over whole texts, words, their code points, symbols,
repeated lines, words in repeated five-word windows and a few more.  From these
come whole-number measures (``MEASURES``: shares in thousandths, word length in
tenths; none that grows or falls with a clean text's length).  ``learn`` finds rules for low quality by sequential covering, from all
labelled rows:

* grow: on two thirds of the rows (by a hash of the id) a conjunction takes the
  threshold condition of the largest information gain until it covers no good
  row, gains nothing more or has ``MAX_CONDITIONS``;
* prune: on the other third the conjunction is cut after the condition where
  (bad - good) / (bad + good) is largest, the shortest of equals;
* a rule stays if ``MIN_PRECISION`` of what it covers, on either part together,
  is bad and it covers ``MIN_SHARE`` of all bad rows; what it covers is set
  aside, and the next rule is grown on the rest.  The first rule that does not
  stay ends the list.

Every step is one aggregate over the labelled measures, which are grouped
beforehand (thresholds have two leading digits, so a measure has at most some
1,600 of them); the driver sees those sums, never rows.  ``verdict`` writes the
rules as one ordered conditional expression.

Windows are compared by 64-bit hashes within one text, so a false repeat has a
chance of about (words of the text)^2 / 2^65.

Cases: a null or empty text has no words and fails the base rule; labels that
are null, or whose id is null or in no document, teach nothing; each pair of a
document and a label of one id counts, so repeated rows count as often as they
occur; no usable labels give no rules, and then the base rule alone decides;
ties go to the first measure, ``>=`` before ``<``, the smaller threshold; very
long texts are counted whole, one text (with its words) per task slot; other
columns, whatever their names, stay in ``row``; no documents, no result.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import staged

SPACES = " \t\n\x0b\x0c\r"
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = "[#*$%&|<>]"
MARK = "[.!?]"
CAPITAL = "[A-Z]"
WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20
MAX_RULES = 12
MAX_CONDITIONS = 4
MIN_PRECISION = 0.9
MIN_SHARE = 0.02

STATS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
         "n_capitals", "n_marks"]

# measure: factor, numerator, denominator; the order breaks ties
MEASURES = {
    "repeat_share": (1000, "n_repeat_words", "n_words"),
    "dup_line_share": (1000, "n_dup_lines", "n_lines"),
    "symbol_share": (1000, "n_symbols", "n_words"),
    "word_length": (10, "word_chars", "n_words"),
    "capital_share": (1000, "n_capitals", "word_chars"),
    "mark_share": (1000, "n_marks", "n_words"),
}


class Rule(NamedTuple):
    """All of ``conditions`` (measure, ``>=`` or ``<``, threshold) mean low
    quality; ``bad`` and ``good`` labelled rows are covered by it first."""

    conditions: tuple
    bad: int
    good: int

    def sql(self) -> str:
        return " AND ".join(f"{m} {op} {t}" for m, op, t in self.conditions)


def document_stats(docs: DataFrame) -> DataFrame:
    """``row`` (the columns of ``docs(doc_id, text, ...)`` but the text) and
    ``STATS``, a row per document."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    text = docs.select(F.struct(*kept).alias("row"), F.coalesce("text", F.lit("")).alias("t"))
    split = text.select(
        "row",
        F.regexp_extract_all("t", F.lit(WORD), F.lit(0)).alias("words"),
        F.filter(F.split("t", "\n", -1), lambda s: F.btrim(s, F.lit(SPACES)) != "").alias("lines"),
        (F.char_length("t") - F.regexp_count("t", F.lit(SPACE))).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        (F.size(F.split("t", CAPITAL, -1)) - 1).cast("long").alias("n_capitals"),
        F.regexp_count("t", F.lit(MARK)).cast("long").alias("n_marks"))
    counted = ["row", "word_chars", "n_symbols", "n_capitals", "n_marks"]
    split = split.select(
        *counted,
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    counted += ["n_words", "n_lines", "n_dup_lines"]

    def window(i: Column) -> Column:
        own = [F.get("hashes", i + j) for j in range(WINDOW)]
        return F.struct(F.xxhash64(*own).alias("h"), i.alias("at"))

    hashed = split.select(*counted, F.when(F.col("n_words") >= WINDOW, F.sort_array(F.transform(
        F.sequence(F.lit(0), F.size("hashes") - WINDOW), window))).alias("sorted"))

    # equal windows are neighbours in the sorted order
    twice = "filter(sorted, (x, i) -> x.h = get(sorted, i + 1).h OR x.h = get(sorted, i - 1).h)"
    starts = hashed.select(*counted, F.expr(f"sort_array(transform({twice}, x -> x.at))").alias("starts"))
    covered = F.expr(f"""coalesce(aggregate(starts, named_struct('n', 0L, 'last', {-WINDOW}),
      (a, s) -> named_struct('n', a.n + least({WINDOW}, s - a.last), 'last', s), a -> a.n), 0L)""")
    return starts.withColumn("n_repeat_words", covered).select("row", *STATS)


def measures(stats: DataFrame) -> DataFrame:
    """``stats`` with every measure; one without a denominator is 0."""
    return stats.withColumns({m: F.expr(f"CASE WHEN {n} = 0 THEN 0L ELSE {k} * {v} div {n} END")
                              for m, (k, v, n) in MEASURES.items()})


def _two_digits(name: str) -> Column:
    """The value with all but its two leading digits zero."""
    return F.expr(f"if({name} < 100, {name}, {name} - {name} % "
                  f"cast(pow(10, char_length(cast({name} as string)) - 2) as bigint))").alias(name)


def labelled(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """The measures of labelled documents, grouped: ``MEASURES``, ``grow``
    (rows to grow on, else to prune on) and the numbers ``bad``, ``good``."""
    own = (measures(stats.select(F.col("row.doc_id").alias("doc_id"), *STATS).where("doc_id IS NOT NULL"))
           .select("doc_id", *[_two_digits(m) for m in MEASURES])
           .groupBy("doc_id", *MEASURES).agg(F.count(F.lit(1)).alias("times")))
    marks = (labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id")
             .agg(F.sum(1 - F.col("quality")).alias("bad"), F.sum("quality").alias("good")))
    grow = F.pmod(F.xxhash64(F.lit("grow"), "doc_id"), F.lit(3)) > 0
    return (own.join(marks, "doc_id").groupBy(*MEASURES, grow.alias("grow"))
            .agg(F.sum(F.expr("bad * times")).alias("bad"), F.sum(F.expr("good * times")).alias("good")))


def best_condition(counts: list[tuple], bad: int, good: int) -> tuple | None:
    """Of all threshold conditions over ``counts`` (measure, value, bad, good;
    ``bad`` and ``good`` in all) the one of the largest gain."""
    by: dict = {}
    for measure, value, b, g in counts:
        by.setdefault(measure, []).append((value, b, g))
    before = math.log2(bad / (bad + good))
    best, found = 1e-9, None
    for measure in MEASURES:
        below_b = below_g = 0
        tried = []
        for value, b, g in sorted(by.get(measure, [])):
            tried.append((">=", value, bad - below_b, good - below_g))
            tried.append(("<", value, below_b, below_g))
            below_b, below_g = below_b + b, below_g + g
        for op, value, b, g in sorted(tried, key=lambda c: (c[0] != ">=", c[1])):
            if b == 0 or b + g == bad + good:
                continue
            gain = b * (math.log2(b / (b + g)) - before)
            if gain > best + 1e-9:
                best, found = gain, ((measure, op, value), b, g)
    return found


def learn(spark: SparkSession, rows: DataFrame, max_rules: int = MAX_RULES,
          max_conditions: int = MAX_CONDITIONS, min_precision: float = MIN_PRECISION,
          min_share: float = MIN_SHARE) -> list[Rule]:
    """The rules for low quality that ``rows`` (as of ``labelled``) teach, in
    the order in which they hold."""
    one = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value"))
                              for m in MEASURES])).alias("c")
    rules: list[Rule] = []
    least = max(1, math.ceil(min_share * (rows.agg(F.sum("bad")).first()[0] or 0)))
    while len(rules) < max_rules:
        rest = rows.where(" AND ".join(f"NOT ({r.sql()})" for r in rules) or "true")
        conditions: list[tuple] = []
        while len(conditions) < max_conditions:
            inside = rest.where("grow").where(Rule(tuple(conditions), 0, 0).sql() or "true")
            counts = [tuple(r) for r in inside.select(one, "bad", "good").groupBy("c.measure", "c.value")
                      .agg(F.sum("bad"), F.sum("good")).collect()]
            first = [c for c in counts if c[0] == next(iter(MEASURES))]
            bad, good = sum(c[2] for c in first), sum(c[3] for c in first)
            found = best_condition(counts, bad, good) if bad and good else None
            if found is None:
                break
            conditions.append(found[0])
            if found[2] == 0:
                break
        if not conditions:
            break
        cut = [Rule(tuple(conditions[:n + 1]), 0, 0) for n in range(len(conditions))]
        sums = rest.agg(*[F.sum(F.when(F.expr(r.sql()) & part, F.col(c)).otherwise(0))
                          for r in cut for part in (~F.col("grow"), F.lit(True)) for c in ("bad", "good")]).first()
        scored = [(r, *sums[4 * n:4 * n + 4]) for n, r in enumerate(cut)]
        rule, _, _, bad, good = max(scored, key=lambda s: ((s[1] - s[2]) / max(1, s[1] + s[2]),
                                                           -len(s[0].conditions)))
        if bad < min_precision * (bad + good) or bad < least:
            break
        # of two conditions on one side of a measure the later one is the stricter
        last = {c[:2]: c for c in rule.conditions}
        rules.append(Rule(tuple(last.values()), bad, good))
    return rules


def verdict(rules: list[Rule]) -> Column:
    """Number, from 1, of the first rule that holds for a row of ``measures``;
    null where none does."""
    return F.expr("CASE " + " ".join(f"WHEN {r.sql()} THEN {n}" for n, r in enumerate(rules, 1)) + " END"
                  if rules else "cast(null as int)")


def judged(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``row`` (without the text), ``STATS``, ``base_failed``, ``rule`` (the
    learned rule that a document breaks) and ``kept`` of every document."""
    stats = staged(spark, document_stats(docs), "quality-stats")
    rules = learn(spark, staged(spark, labelled(stats, labels), "quality-labelled"))
    base = f"(n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words)"
    return (measures(stats).withColumn("rule", verdict(rules))
            .withColumn("base_failed", F.expr(base))
            .withColumn("kept", F.expr("NOT base_failed AND rule IS NULL"))
            .select("row", *STATS, "base_failed", "rule", "kept"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.plans.tables import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judged(spark, docs, table(spark, sf_dir, "labels")).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept", "rule")

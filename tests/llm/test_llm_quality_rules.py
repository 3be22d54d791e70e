import math
import re
from collections import Counter

import pytest
import xxhash

from conftest import PYTHON_NODES, plan_text
from sluice.llm import quality_rules as Q

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_stats(text):
    text = text or ""
    words = WORD.findall(text)
    seen = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + j for i in range(len(words) - 4) if seen[tuple(words[i:i + 5])] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {"n_words": len(words), "word_chars": sum(map(len, words)),
            "n_symbols": sum(text.count(c) for c in "#*$%&|<>"), "n_lines": len(lines),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
            "n_capitals": sum("A" <= c <= "Z" for c in text), "n_marks": sum(c in ".!?" for c in text)}


def brute_measures(s):
    return {m: k * s[v] // s[n] if s[n] else 0 for m, (k, v, n) in Q.MEASURES.items()}


def two_digits(v):
    return v if v < 100 else v - v % 10 ** (len(str(v)) - 2)


def holds(conditions, m):
    return all(m[c] >= t if op == ">=" else m[c] < t for c, op, t in conditions)


def brute_rules(docs, labels):
    """The covering loop over plain rows (measures, grow, bad, good)."""
    rows = [({m: two_digits(v) for m, v in brute_measures(brute_stats(t)).items()}, grows(i), 1 - q, q)
            for i, t in docs for j, q in labels if i == j and i is not None and q in (0, 1)]
    rules = []
    while len(rules) < Q.MAX_RULES:
        rest = [r for r in rows if not any(holds(c, r[0]) for c in rules)]
        conditions = []
        while len(conditions) < Q.MAX_CONDITIONS:
            inside = [r for r in rest if r[1] and holds(conditions, r[0])]
            bad, good = sum(r[2] for r in inside), sum(r[3] for r in inside)
            if not bad or not good:
                break
            best, at = 1e-9, None
            for m in Q.MEASURES:
                for op in (">=", "<"):
                    for t in sorted({r[0][m] for r in inside}):
                        b = sum(r[2] for r in inside if holds([(m, op, t)], r[0]))
                        g = sum(r[3] for r in inside if holds([(m, op, t)], r[0]))
                        if b and b + g < bad + good:
                            gain = b * (math.log2(b / (b + g)) - math.log2(bad / (bad + good)))
                            if gain > best + 1e-9:
                                best, at = gain, (m, op, t)
            if at is None:
                break
            conditions.append(at)
        if not conditions:
            break

        def worth(n):
            own = [r for r in rest if not r[1] and holds(conditions[:n], r[0])]
            b, g = sum(r[2] for r in own), sum(r[3] for r in own)
            return (b - g) / max(1, b + g), -n
        cut = conditions[:max(range(1, len(conditions) + 1), key=worth)]
        b = sum(r[2] for r in rest if holds(cut, r[0]))
        g = sum(r[3] for r in rest if holds(cut, r[0]))
        if b < Q.MIN_PRECISION * (b + g) or b < max(1, math.ceil(Q.MIN_SHARE * sum(r[2] for r in rows))):
            break
        rules.append(list({c[:2]: c for c in cut}.values()))
    return rules


def grows(doc_id):
    """XXH64 over the text ``grow`` (seed 42), then over the id with that as seed."""
    h = xxhash.xxh64_intdigest(doc_id.to_bytes(8, "little", signed=True), xxhash.xxh64_intdigest(b"grow", 42))
    return (h - (1 << 64) if h >= 1 << 63 else h) % 3 > 0


TEXTS = ["", None, "one", " \t\n", "a b c d e " * 30, "x\nx\n\n \nx y\nx y", "é# *$ %& |<> z", "A.B! C? d\re\x0bf",
         "a b c d e f a b c d e g a b c d e", "the\n" * 50, " ".join(map(str, range(40))), "ab " * 100_000,
         "w " + "long" * 50_000]


def test_stats_agree_with_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(None, "a b", "x", 1), (0, "", "x", 1)],
                                 "doc_id long, text string, words string, n_words int")
    got = Q.document_stats(docs).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        text = "a b" if r["row"]["doc_id"] is None else TEXTS[r["row"]["doc_id"]]
        assert {s: r[s] for s in Q.STATS} == brute_stats(text), text and text[:40]
        assert (r["row"]["words"], r["row"]["n_words"]) == ("x", 1)


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query_agrees_with_brute_force(spark, sf):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality").collect()]
    rules = brute_rules(docs, labels)
    assert rules
    expected = {}
    for i, t in docs:
        s = brute_stats(t)
        failed = s["n_words"] < 10 or 100 * s["n_repeat_words"] > 20 * s["n_words"]
        rule = next((n for n, c in enumerate(rules, 1) if holds(c, brute_measures(s))), None)
        expected[i] = (s["n_words"], s["word_chars"], s["n_symbols"], s["n_dup_lines"], s["n_repeat_words"],
                       failed, not failed and rule is None, rule)
    df = Q.op12_quality_rules(spark, sf)
    assert dict(df.dtypes) == {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint",
                               "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean",
                               "kept": "boolean", "rule": "int"}
    rows = df.collect()
    assert len(rows) == len(docs)
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == expected


def test_rules_are_conjunctions_that_the_labels_ask_for(spark):
    rows = [(i, ("w#### " if i % 3 == 0 and i % 2 == 0 else "w# " if i % 3 == 0 else "plain ") * 20, "x")
            for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality string")
    labels = spark.createDataFrame([(i, 0 if i % 6 == 0 else 1) for i in range(600)] + [(None, 0), (1, None), (9999, 0)],
                                   "doc_id long, quality int")
    rules = Q.learn(spark, Q.labelled(Q.document_stats(docs), labels))
    assert [(r.conditions, r.bad, r.good) for r in rules] == [((("symbol_share", ">=", 4000),), 100, 0)]
    out = Q.judged(spark, docs, labels)
    assert {r["row"]["quality"] for r in out.collect()} == {"x"}


def test_no_documents_and_no_labels(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k", "x")], "doc_id long, text string, rule string")
    labels = spark.createDataFrame([(1, 0)], "doc_id long, quality int")
    assert Q.judged(spark, docs.limit(0), labels).count() == 0
    for some in (labels.limit(0), labels, spark.createDataFrame([(1, None)], "doc_id long, quality int")):
        row = Q.judged(spark, docs, some).first()
        assert (row["base_failed"], row["rule"], row["kept"]) == (False, None, True)


def test_no_python_in_the_plan(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    stats = Q.document_stats(docs)
    for df in (stats, Q.labelled(stats, labels), Q.judged(spark, docs, labels)):
        assert not [n for n in PYTHON_NODES if n in plan_text(df)]

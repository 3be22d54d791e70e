"""C2 by an automaton: the same as the regular expression, for any token table."""

import re
import tracemalloc

import pyarrow as pa
import pytest
from conftest import plan_text
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.functions import automaton as A
from sluice.functions.text import replace_tokens
from pyspark.sql import functions as F

_TEXT = st.text(alphabet="abc|.é𝄞", max_size=30)


def by_regex(text, tokens, replacement="_"):
    own = [t for t in tokens if t]
    return re.sub("|".join(map(re.escape, own)), lambda _: replacement, text) if own else text


def by_automaton(text, tokens, blocks=1):
    parts = [[(i, t) for i, t in enumerate(tokens) if i % blocks == b] for b in range(blocks)]
    own = A.settled([m for p in parts for m in A.Automaton(p).find(text)])
    out, at = "", 0
    for start, _, end in own:
        out, at = out + text[at:start] + "_", end
    return out + text[at:]


@settings(max_examples=400, deadline=None)
@given(_TEXT, st.lists(st.text(alphabet="abc|.é𝄞", max_size=5), max_size=8), st.integers(1, 3))
def test_agrees_with_alternation(text, tokens, blocks):
    assert by_automaton(text, tokens, blocks) == by_regex(text, tokens)


def test_every_place_is_found():
    tokens = ["he", "she", "his", "hers", "e"]
    text = "ushershe"
    found = sorted(A.Automaton(list(enumerate(tokens))).find(text))
    assert found == sorted((i, tokens.index(t), i + len(t)) for t in tokens for i in range(len(text)) if text.startswith(t, i))


@pytest.mark.parametrize("block_chars", [1 << 20, 6])
def test_replaces_as_the_column_function_does(spark, block_chars):
    tokens = ["ab", "a", "|", "abc", "é𝄞", "ab", "", None]
    texts = ["abcab|a", "", None, "é𝄞é", "xyz", "aaaa" * 5000, "cab|"]
    table = spark.createDataFrame([(t, i) for i, t in enumerate(tokens)], "token string, rank int")
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "id int, text string, found string")
    got = A.replace_token_table(df, "text", table, "#", "clean", block_chars)
    assert got.columns == ["id", "text", "found", "clean", "clean_matches"]
    listed = [t for t in dict.fromkeys(tokens) if t]
    plain = df.select("id", replace_tokens(F.col("text"), listed, "#").alias("clean"))
    assert {r["id"]: r["clean"] for r in got.collect()} == {r["id"]: r["clean"] for r in plain.collect()}
    counts = {r["id"]: r["clean_matches"] for r in got.collect()}
    assert counts == {i: len(re.findall("|".join(map(re.escape, listed)), t or "")) for i, t in enumerate(texts)}


def test_many_tokens_and_none(spark):
    df = spark.createDataFrame([(1, " ".join(f"tok{i}x" for i in range(0, 100_000, 997)))], "id int, text string")
    table = spark.range(100_000).selectExpr("concat('tok', id, 'x') as token", "id as rank")
    row = A.replace_token_table(df, "text", table, "", "clean").first()
    assert (row["clean"].strip(), row["clean_matches"]) == ("", 101)
    row = A.replace_token_table(df, "text", table.limit(0), "", "clean").first()
    assert (row["clean"], row["clean_matches"]) == (row["text"], 0)
    with pytest.raises(ValueError, match="already"):
        A.replace_token_table(df, "text", table, "", "id")


def test_a_worker_holds_the_matches_of_a_slice(spark):
    """Hundreds of thousands of matches in one batch stay flat arrays."""
    texts = ["abcd " * 10_000] * 40
    row = pa.StructArray.from_arrays([pa.array(texts)], names=["text"])
    replace = A._replacer(spark, [(0, "abcd"), (1, "bcd"), (2, "cd")], 0, "_")
    tracemalloc.start()
    try:
        made = list(replace(iter([pa.RecordBatch.from_arrays([row], names=["row"])])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [n for b in made for n in b.column("n").to_pylist()] == [10_000] * 40
    assert {t for b in made for t in b.column("made").to_pylist()} == {"_ " * 10_000}
    assert peak < 20 << 20


def test_one_automaton_at_a_time(spark):
    table = spark.createDataFrame([("ab", 0), ("cd", 1), ("ef", 2)], "token string, rank int")
    df = spark.createDataFrame([(1, "abcdef"), (2, None)], "id int, text string")
    got = A.replace_token_table(df, "text", table, "-", "clean", block_chars=2)
    assert plan_text(got).count("MapInArrow") == plan_text(A.replace_token_table(
        df, "text", table, "-", "clean")).count("MapInArrow")
    assert sorted(map(tuple, got.collect())) == [(1, "abcdef", "---", 3), (2, None, None, 0)]

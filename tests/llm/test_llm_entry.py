"""The registered queries against their SQL, as the driver compares them."""

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from sluice.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_the_operators_and_the_pipeline_are_registered():
    numbers = {int(n[2:].split("_")[0]) for n in QUERIES}
    assert numbers == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "simhash_dedup", "decontamination", "mixing"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == sorted(df.columns)
    got = sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)
    assert got == sorted(res.fetchall(), key=repr)

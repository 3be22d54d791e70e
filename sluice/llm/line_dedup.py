"""Line dedup by overlapping three-line windows.

The lines of each text (split at line feeds) form overlapping windows of three
consecutive lines.  Windows are hashed (two independent 64-bit hashes) and
repeated ones found over all documents.  The first occurrence, by document id
and then line, stays; the lines of every later one are removed, positions that
several windows cover once.  Every removed line's text stays at an earlier
place.  Windows of three empty lines take no part.

Cases: a null text has no lines and stays null; texts of fewer than three
lines have no window; a null id comes after all others; rows that agree in id
and text are one document and keep the same lines; a very long text is one row,
with its lines in one task; other columns, whatever their names, are kept; no
documents, no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import order_id, staged, text_slices

LINES = 3


def windows(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """``w1, w2`` (the window's hashes), ``ord``, ``th`` (its document) and
    ``pos`` (its first line), one row per window."""
    split = docs.select(order_id().alias("ord"), F.xxhash64("text").alias("th"),
                        F.split("text", "\n", -1).alias("lines")).where(F.size("lines") >= lines)
    hashed = split.select(
        "ord", "th",
        F.transform("lines", lambda s: F.xxhash64(s)).alias("a"),
        F.transform("lines", lambda s: F.xxhash64(F.lit(1), s)).alias("b"))
    empty = [F.xxhash64(F.lit("")), F.xxhash64(F.lit(1), F.lit(""))]

    def at(name: str, i):
        return F.xxhash64(*[F.get(name, i + j) for j in range(lines)])

    made = hashed.select("ord", "th", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.size("a") - lines),
        lambda i: F.struct(at("a", i).alias("w1"), at("b", i).alias("w2")))).alias("pos", "w"))
    blank = (F.col("w.w1") == F.xxhash64(*[empty[0]] * lines)) \
        & (F.col("w.w2") == F.xxhash64(*[empty[1]] * lines))
    return made.where(~blank).select("w.w1", "w.w2", "ord", "th", "pos")


def dedup_lines(spark: SparkSession, docs: DataFrame, lines: int = LINES) -> DataFrame:
    """``row`` (the document's columns), ``kept`` (the text without removed
    lines), ``n_lines`` and ``n_removed`` of each of ``docs(doc_id, text, ...)``."""
    seen = staged(spark, windows(docs, lines), "line-windows")
    first = (seen.groupBy("w1", "w2")
             .agg(F.min(F.struct("ord", "th", "pos")).alias("first"),
                  F.max(F.struct("ord", "th", "pos")).alias("last"))
             .where("first < last").select("w1", "w2", "first"))
    later = (seen.join(first, ["w1", "w2"])
             .where(F.struct("ord", "th", "pos") > F.col("first"))
             .groupBy("ord", "th").agg(F.collect_set("pos").alias("starts")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("text").alias("text"), order_id().alias("ord"),
                       F.xxhash64("text").alias("th"))
    rows = rows.join(later, ["ord", "th"], "left").select("row", "text", "starts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            kept, counts, gone = [], [], []
            for text, starts in zip(batch.column("text").to_pylist(),
                                    batch.column("starts").to_pylist()):
                n = 0 if text is None else text.count("\n") + 1
                removed = 0
                if starts:
                    own = text.split("\n")
                    covered = np.zeros(n, bool)
                    for j in range(lines):
                        covered[np.array(starts) + j] = True
                    removed = int(covered.sum())
                    text = "\n".join([own[i] for i in np.flatnonzero(~covered)])
                kept.append(text)
                counts.append(n)
                gone.append(removed)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(kept, pa.string()), pa.array(counts, pa.int64()),
                 pa.array(gone, pa.int64())], names=["row", "kept", "n_lines", "n_removed"])

    return rows.mapInArrow(cut, T.StructType([
        rows.schema["row"], T.StructField("kept", T.StringType()),
        T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType())]))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.plans.tables import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(spark, docs).select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed",
        F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents with their later occurrences removed and ``n_chars``, where
    there is one, counted anew; a document whose lines are all repeats of
    earlier ones is dropped."""
    done = dedup_lines(spark, docs).where("n_removed = 0 OR n_removed < n_lines")
    new = {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("n_removed") == 0, F.col("row.n_chars")).otherwise(
            F.char_length("kept")).cast(docs.schema["n_chars"].dataType)
    return done.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


OP4_SQL = r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
w AS (SELECT doc_id, p, l[p] AS a, l[p + 1] AS b, l[p + 2] AS c
      FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS p FROM d WHERE len(l) >= 3)),
o AS (SELECT doc_id, p, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, p) AS k
      FROM w WHERE NOT (a = '' AND b = '' AND c = '')),
r AS (SELECT DISTINCT doc_id, unnest([p, p + 1, p + 2]) AS p FROM o WHERE k > 1),
e AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS p FROM d),
t AS (SELECT e.doc_id, count(*) AS n_lines, count(r.p) AS n_removed,
             coalesce(string_agg(line, chr(10) ORDER BY e.p) FILTER (WHERE r.p IS NULL), '') AS kept
      FROM e LEFT JOIN r ON e.doc_id = r.doc_id AND e.p = r.p GROUP BY e.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)
"""

"""The corpus pipeline: toxicity, line dedup, SimHash near-dedup, benchmark
decontamination, mixing.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` and works on all rows that
the one before it kept; ``run`` writes each result as Parquet in the shared
folder and reads it back as the next stage's ``docs``, so a lost executor never
sends the job back beyond the last stage; once it is written, the tables it was
made from are deleted.  All but the last return the columns
of ``documents``:

1. ``toxicity`` drops documents that score one half or more;
2. ``line_dedup`` removes later occurrences of three-line windows (``n_chars``
   follows the text) and drops documents of which nothing else was left;
3. ``simhash_dedup`` keeps one document of each near-duplicate group;
4. ``decontamination`` drops documents with a window of a benchmark item;
5. ``mixing`` returns the mix: a row per draw, ``shard, place, pass, doc_id,
   source, size, source_size, target, first, taken, text`` -- the ``taken`` words
   of a document from word ``first`` on, gathered by shard and shuffled inside it.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sluice import session  # noqa: E402
from sluice.llm import decontamination, line_dedup, mixing, simhash  # noqa: E402
from sluice.llm import toxicity as toxic  # noqa: E402
from sluice.llm.common import staged_at  # noqa: E402
from sluice.plans.tables import table  # noqa: E402


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxic.drop_toxic(spark, docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.without_repeated_lines(spark, docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each_group(spark, docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_words(spark, docs)


STAGES = [("toxicity", toxicity), ("line_dedup", lines), ("simhash_dedup", simhash_dedup),
          ("decontamination", decontaminate), ("mixing", mix)]

# a trained classifier and XXH64 fingerprints are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        before = session.scratch_folders()
        docs, own = staged_at(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
        # what the stage was made from is read no more
        for folder in [*session.scratch_folders(), path]:
            if folder and folder != own and (folder == path or folder not in before):
                session.drop_scratch(spark, folder)
        path = own
    return docs

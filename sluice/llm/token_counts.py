"""Token counts: batch encoding in Arrow functions that return lengths only.

Rows are taken in batches of about ``SLICE_BYTES`` of text.  Texts are split at
safe boundaries: before a run of white space that follows other text, where no
pre-token of a byte-level BPE can cross.  A boundary is safe on both sides, so
the counts of the parts add up to the count of the whole, and equal parts have
equal counts: each distinct part is encoded once and its length kept in a
bounded table.  Very long texts are worked off in segments that end at such a
boundary; a text without any is encoded whole.

Cases: a null or empty text has 0 bytes and 0 tokens; a null id is kept;
repeated rows each get their row; a very long text is split at safe boundaries;
other columns are ignored; no documents, no result.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import arrow_batch, text_slices

SEGMENT_CHARS = 1 << 20
MEMO_PARTS = 300_000
MEMO_PART_CHARS = 64

# Python counts the four separators 1C-1F as white space, the tokenizer's
# expression does not: a run that begins with one is no boundary.
_PARTS = re.compile(r"\s*\S+|\s+")
_PARTS_SEPARATORS = re.compile(r"\s*\S+(?:[\x1c-\x1f]\s*\S+)*(?:[\x1c-\x1f]\s*)?|\s+")
_SEPARATOR = re.compile(r"[\x1c-\x1f]")
_BOUNDARY = re.compile(r"(?<=\S)(?=[^\S\x1c-\x1f])")

SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def segments(text: str, limit: int = SEGMENT_CHARS) -> Iterator[str]:
    """``text`` in pieces of at least ``limit`` characters that end at safe
    boundaries."""
    start = 0
    while len(text) - start > limit:
        found = _BOUNDARY.search(text, start + limit)
        if not found:
            break
        yield text[start:found.start()]
        start = found.start()
    yield text[start:] if start else text


def parts(text: str) -> list[str]:
    """``text`` cut at every safe boundary."""
    return (_PARTS_SEPARATORS if _SEPARATOR.search(text) else _PARTS).findall(text)


class Counter:
    """Token counts by a ``tokenizers`` file, with a bounded table of parts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.memo: dict[str, int] = {}

    def _learn(self, new: set[str]) -> dict[str, int]:
        todo = list(new)
        lengths = {}
        for at in range(0, len(todo), 20_000):
            chunk = todo[at:at + 20_000]
            encoded = self.tokenizer.encode_batch_fast(chunk, add_special_tokens=False)
            lengths.update(zip(chunk, map(len, encoded)))
        return lengths

    def counts(self, texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        queue: list[tuple[int, list[str]]] = []
        size = 0
        for row, text in enumerate(texts):
            for segment in segments(text):
                queue.append((row, parts(segment)))
                size += len(segment)
                if size >= SEGMENT_CHARS:
                    self._flush(queue, out)
                    queue, size = [], 0
        self._flush(queue, out)
        return out

    def _flush(self, queue: list[tuple[int, list[str]]], out: list[int]) -> None:
        new = set().union(*(p for _, p in queue)).difference(self.memo)
        fresh = self._learn(new)
        kept = {k: v for k, v in fresh.items() if len(k) <= MEMO_PART_CHARS}
        if len(self.memo) + len(kept) > MEMO_PARTS:
            # keep what this batch used, so that frequent parts stay
            self.memo = {p: self.memo[p] for _, ps in queue for p in ps if p in self.memo}
        self.memo.update(kept)
        long_parts = {k: v for k, v in fresh.items() if k not in kept}
        known = self.memo.__getitem__
        for row, pieces in queue:
            if long_parts:
                out[row] += sum(long_parts[p] if p in long_parts else known(p) for p in pieces)
            else:
                out[row] += sum(map(known, pieces))


def token_counts(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every row of ``docs(doc_id, text)``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(tokenizer_path)
        for batch in text_slices(batches, "text"):
            lengths = counter.counts(batch.column("text").to_pylist())
            yield arrow_batch(SCHEMA, {"doc_id": batch.column("doc_id"),
                                       "n_bytes": batch.column("n_bytes"),
                                       "n_tokens": lengths})

    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.octet_length(text).cast("long").alias("n_bytes"),
                       text.alias("text")).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long")


def op9_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from sluice.plans.tables import table

    out = token_counts(table(spark, sf_dir, "documents"),
                       public_tokenizers.path("byte_bpe_50k.json"))
    return out.withColumn("over_limit", F.col("n_tokens") > 1024)

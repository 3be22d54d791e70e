"""Language identification by a byte convolutional network.

Bytes are embedded, filters of several widths run over them, each filter's
largest response in a window (max pooling) goes into a softmax over the learned
languages.  The network is trained in numpy on windows of labelled texts.  A
text is cut into windows of ``WINDOW`` bytes, all of them are scored in
batches, and the probabilities are averaged by the bytes they stand for.

Training uses at most ``SAMPLE`` texts, shared evenly by the languages as far as
they have any and chosen by a hash of the id.  All windows of these texts are
written to a table, and the ``STEPS * BATCH`` windows that training looks at are
drawn over it in the same way; both bounds are parameters.  Prediction reads
every whole text.

Cases: ``und`` with score 0 for a null text or one without letters (characters
of Unicode's category L), or if no language could be learned; a null id is not
held out and not learned from; texts without ``lang`` are not learned from; rows
that repeat an id and language are learned from as one; a very long text is one
row, cut to windows a few at a time; a tie of two languages goes to the first by
code point; other columns are not read; no documents, no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import staged, text_slices

WINDOW = 256
SAMPLE = 6_000
DIMENSIONS = 8
FILTERS = 16
WIDTHS = (2, 3, 4)
STEPS = 500
BATCH = 128
RATE = 0.01
SEED = 7
SCORE_BATCH = 256


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def start_weights(classes: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    w = {"embed": rng.normal(0, 0.5, (256, DIMENSIONS))}
    for width in WIDTHS:
        w[f"filter{width}"] = rng.normal(0, (width * DIMENSIONS) ** -0.5,
                                         (width * DIMENSIONS, FILTERS))
    w["dense"] = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), classes))
    w["bias"] = np.zeros(classes)
    return {k: v.astype(np.float32) for k, v in w.items()}


def gradients(w: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
    """Loss and gradients of one batch of windows ``x`` with labels ``y``."""
    n, length = x.shape
    embedded = w["embed"][x]
    pooled, at, patches = [], [], []
    for width in WIDTHS:
        k = length - width + 1
        grid = np.concatenate([embedded[:, j:j + k] for j in range(width)], axis=2)
        response = grid @ w[f"filter{width}"]
        best = response.argmax(axis=1)                        # n, filters
        pooled.append(np.take_along_axis(response, best[:, None], 1)[:, 0])
        at.append(best)
        patches.append(grid[np.arange(n)[:, None], best])     # n, filters, width * dimensions
    hidden = np.concatenate(pooled, axis=1)
    active = np.maximum(hidden, 0)
    logits = active @ w["dense"] + w["bias"]
    logits -= logits.max(axis=1, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=1, keepdims=True)
    loss = float(-np.log(p[np.arange(n), y] + 1e-9).mean())
    p[np.arange(n), y] -= 1
    p /= n
    out = {"dense": active.T @ p, "bias": p.sum(axis=0), "embed": np.zeros_like(w["embed"])}
    back = (p @ w["dense"].T) * (hidden > 0)
    for i, width in enumerate(WIDTHS):
        slope = back[:, i * FILTERS:(i + 1) * FILTERS]
        out[f"filter{width}"] = np.einsum("nf,nfd->df", slope, patches[i])
        to_patch = slope[:, :, None] * w[f"filter{width}"].T  # n, filters, width * dimensions
        for j in range(width):
            byte = x[np.arange(n)[:, None], at[i] + j]
            np.add.at(out["embed"], byte, to_patch[:, :, j * DIMENSIONS:(j + 1) * DIMENSIONS])
    return loss, out


def fit(x: np.ndarray, y: np.ndarray, classes: int, steps: int = STEPS) -> dict[str, np.ndarray]:
    """Adam over random batches; some windows are cut short, as the last of a
    text is."""
    rng = np.random.default_rng(SEED)
    w = start_weights(classes, rng)
    m, v = ({k: np.zeros_like(a) for k, a in w.items()} for _ in range(2))
    for step in range(1, steps + 1):
        rows = rng.integers(0, len(x), BATCH)
        batch = x[rows].copy()
        for i in np.flatnonzero(rng.random(BATCH) < 0.3):
            batch[i, rng.integers(16, WINDOW):] = 0
        _, slopes = gradients(w, batch, y[rows])
        rate = RATE * (1 - step / (steps + 1)) ** 0.5
        for k in w:
            m[k] = 0.9 * m[k] + 0.1 * slopes[k]
            v[k] = 0.99 * v[k] + 0.01 * slopes[k] ** 2
            w[k] -= (rate * (m[k] / (1 - 0.9 ** step))
                     / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return w


class Scorer:
    """Softmax of windows.  Embedding and filter fold into tables by byte pair,
    so a response is the sum of one or two table rows."""

    def __init__(self, w: dict[str, np.ndarray]):
        self.w, self.tables = w, []
        for width in WIDTHS:
            parts = w[f"filter{width}"].reshape(width, DIMENSIONS, FILTERS)
            single = [w["embed"] @ part for part in parts]
            own = [(j, True, (single[j][:, None] + single[j + 1][None]).reshape(-1, FILTERS))
                   for j in range(0, width - 1, 2)]
            if width % 2:
                own.append((width - 1, False, single[-1]))
            self.tables.append((width, own))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        pairs = x[:, :-1].astype(np.int64) * 256 + x[:, 1:]
        single = x.astype(np.int64)
        hidden = []
        for width, own in self.tables:
            k = x.shape[1] - width + 1
            response = None
            for j, paired, table in own:
                part = table.take((pairs if paired else single)[:, j:j + k], axis=0)
                response = part if response is None else np.add(response, part, out=response)
            hidden.append(response.max(axis=1))
        logits = np.maximum(np.concatenate(hidden, axis=1), 0) @ self.w["dense"] + self.w["bias"]
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        return p / p.sum(axis=1, keepdims=True)

    def texts(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities of whole texts, weighted by each window's bytes."""
        out = np.zeros((len(texts), len(self.w["bias"])))
        queue, owner, weight = [], [], []

        def flush() -> None:
            block = np.frombuffer(b"".join(queue), np.uint8).reshape(-1, WINDOW)
            np.add.at(out, owner, self(block) * np.array(weight)[:, None])
            queue.clear(), owner.clear(), weight.clear()

        for row, text in enumerate(texts):
            for start in range(0, len(text), WINDOW):
                piece = text[start:start + WINDOW]
                queue.append(piece.ljust(WINDOW, b"\0"))
                owner.append(row)
                weight.append(len(piece) / len(text))
                if len(queue) == SCORE_BATCH:
                    flush()
        if queue:
            flush()
        return out


def shares(counts: dict[str, int], total: int) -> dict[str, int]:
    """``total`` shared evenly over what ``counts`` has of each key; what one
    lacks goes to the others."""
    out, left = {}, total
    for i, key in enumerate(sorted(counts, key=lambda k: (counts[k], k))):
        out[key] = min(counts[key], left // (len(counts) - i))
        left -= out[key]
    return out


def drawn(spark: SparkSession, rows: DataFrame, counts: dict[str, int], total: int,
          keys: list[str]) -> list:
    """About evenly by ``lang``, at most ``total`` of ``rows``, those whose hash
    of ``keys`` is smallest.  Only rows below a hash that half as many again
    would be expected under reach the driver."""
    own = shares(counts, total)
    limits = spark.createDataFrame([(k, (1.5 * n + 50) / max(1, counts[k])) for k, n in own.items()],
                                   "lang string, below double")
    place = F.pmod(F.xxhash64(*keys), F.lit(1 << 40)) / float(1 << 40)
    likely = rows.withColumn("place", place).join(F.broadcast(limits), "lang").where("place < below").drop("below")
    picked, left = [], dict(own)
    for r in sorted(likely.distinct().collect(), key=lambda r: (r["place"], r["lang"], *[r[k] for k in keys])):
        if left[r["lang"]] > 0:
            left[r["lang"]] -= 1
            picked.append(r)
    return picked


def train(spark: SparkSession, docs: DataFrame, sample: int = SAMPLE, steps: int = STEPS) -> dict:
    """``langs`` and the network's ``weights``, learned from the rows of
    ``docs(doc_id, text, lang)`` that are not held out."""
    usable = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull()
                        & (F.crc32(F.col("doc_id").cast("string")) % 4 != 2))
    # a row per language, as the model has
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(
        F.approx_count_distinct("doc_id").alias("n")).collect()}
    if not counts:
        return {"langs": [], "weights": {}}
    ids = drawn(spark, usable.select("doc_id", "lang"), counts, sample, ["doc_id"])
    picked = spark.createDataFrame([(r["doc_id"], r["lang"]) for r in ids],
                                   T.StructType([docs.schema["doc_id"], docs.schema["lang"]]))
    # a proven size: at most ``sample`` ids with their language
    own = usable.join(F.broadcast(picked), ["doc_id", "lang"], "left_semi").select(
        "doc_id", "lang", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            for i, text in enumerate(batch.column("text").to_pylist()):
                if has_letter(text):
                    raw = text.encode("utf-8", "surrogatepass")
                    starts = range(0, len(raw), WINDOW)
                    at = pa.array([i] * len(starts), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(at), batch.column("lang").take(at),
                         pa.array(starts, pa.int64()),
                         pa.array([raw[s:s + WINDOW].ljust(WINDOW, b"\0") for s in starts], pa.binary())],
                        names=["doc_id", "lang", "at", "bytes"])

    made = T.StructType([*own.schema.fields[:2], T.StructField("at", T.LongType()),
                         T.StructField("bytes", T.BinaryType())])
    # repeated rows of an id and language give one window at a place
    windows = staged(spark, own.mapInArrow(cut, made).groupBy("doc_id", "lang", "at").agg(
        F.min("bytes").alias("bytes")), "language-windows")
    counts = {r["lang"]: r["count"] for r in windows.groupBy("lang").count().collect()}
    if not counts:
        return {"langs": [], "weights": {}}
    rows = sorted((r["lang"], bytes(r["bytes"])) for r in
                  drawn(spark, windows, counts, steps * BATCH, ["doc_id", "at"]))
    langs = sorted({lang for lang, _ in rows})
    x = np.frombuffer(b"".join(w for _, w in rows), np.uint8).reshape(-1, WINDOW)
    y = np.array([langs.index(lang) for lang, _ in rows])
    return {"langs": langs, "weights": fit(x, y, len(langs), steps)}


def identify(spark: SparkSession, docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id, lang_pred, score`` of each row of ``docs(doc_id, text)``."""
    shared = spark.sparkContext.broadcast(model)  # a few thousand numbers

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = shared.value["langs"]
        scorer = Scorer(shared.value["weights"]) if langs else None
        for batch in text_slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            rows = [i for i, t in enumerate(texts) if langs and has_letter(t)]
            names, scores = ["und"] * len(texts), [0.0] * len(texts)
            if rows:
                p = scorer.texts([texts[i].encode("utf-8", "surrogatepass") for i in rows])
                for i, own in zip(rows, p):
                    names[i], scores[i] = langs[int(own.argmax())], min(1.0, float(own.max()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        predict, "doc_id long, lang_pred string, score double")


def held_out(column: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 4 == 2, F.lit(False))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.plans.tables import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(spark, docs, train(spark, docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")

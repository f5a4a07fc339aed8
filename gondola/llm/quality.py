"""Text quality by pooled random-indexing word vectors and a small neural network.

Random indexing: every word has a sparse random index vector, and a word's meaning vector is
the sum of the index vectors of its neighbours over the whole corpus. Words are hashed to a
fixed number of rows, so the sums have one size at any input; each task adds up its own and
Spark adds the tasks'. A document is the mean of its words' vectors, each of length 1, and of
their index vectors. A two-layer network in numpy reads that, and a temperature fitted on rows
kept out of its training calibrates its probabilities.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from gondola.llm.common import crc_remainder, decoded, per_text
from gondola.session import written

HELD_OUT_MODULUS, HELD_OUT = 3, 1
ROWS, WIDTH, SIGNS, REACH = 4096, 48, 4, 2
#: Bound of the labelled rows of each label that the network is fitted on, in the order of a hash of the id.
SAMPLE = 6000
HIDDEN, STEPS, BATCH, SEED = 24, 1500, 256, 7
CALIBRATION_SHARE = 5
KEPT_WORDS = 400_000
#: Words of one text handled at once.
SPAN = 1 << 16

TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")


def _table(seed: int) -> np.ndarray:
    """(ROWS, WIDTH) index vectors: in each row SIGNS places of +1 or -1, from a fixed seed."""
    rng = np.random.default_rng(seed)
    result = np.zeros((ROWS, WIDTH), np.float32)
    for row in result:
        row[rng.choice(WIDTH, SIGNS, replace=False)] = rng.choice([-1, 1], SIGNS)
    return result


class Reader:
    """Texts to rows of the hashed vocabulary; words in capitals, signs and digits have rows of their own kind."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def rows(self, text: str) -> Iterator[np.ndarray]:
        found = TOKEN.findall(text)
        for start in range(0, len(found), SPAN):
            part = found[start: start + SPAN]
            try:
                yield np.fromiter(map(self.known.__getitem__, part), np.int64, len(part))
            except KeyError:
                if len(self.known) > KEPT_WORDS:
                    self.known.clear()
                self.known.update((w, self.row(w)) for w in set(part) if w not in self.known)
                yield np.fromiter(map(self.known.__getitem__, part), np.int64, len(part))

    @staticmethod
    def row(word: str) -> int:
        if word[0].isdigit():
            word = "0" * min(len(word), 8)
        elif not word[0].isalpha():
            word = word[:4]
        elif len(word) > 1 and word.isupper():
            word = "\0" + word.lower()[-3:]
        else:
            word = word.lower()
        return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), SEED) % ROWS


def _context_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: by row, how often each other row stands up to REACH words away, times its index vector."""
    reader, index = Reader(), _table(SEED)
    sums = np.zeros((ROWS, WIDTH), np.float64)
    for batch in batches:
        for text in decoded(batch.column(0)):
            for rows in reader.rows(text):
                vectors = index[rows]
                near = np.zeros_like(vectors)
                for step in range(1, REACH + 1):
                    near[step:] += vectors[:-step]
                    near[:-step] += vectors[step:]
                order = np.argsort(rows, kind="stable")
                ordered = rows[order]
                starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))[: len(rows)]
                if len(rows):
                    sums[ordered[starts]] += np.add.reduceat(near[order], starts, axis=0)
    used = np.flatnonzero(np.abs(sums).sum(1))
    vectors = pa.array(list(sums[used].astype(np.int64)), pa.list_(pa.int64()))
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), vectors], names=["row", "v"])


def word_vectors(texts: DataFrame) -> np.ndarray:
    """(ROWS, 2 WIDTH): each row's index vector and its context vector of length 1, over all ``texts``."""
    binary = texts.select(F.col("text").cast("string").cast("binary").alias("text"))
    parts = binary.mapInArrow(_context_sums, "row int, v array<bigint>")
    sums = parts.groupBy("row").agg(*[F.sum(F.col("v")[i]).alias(f"c{i}") for i in range(WIDTH)])
    context = np.zeros((ROWS, WIDTH))
    for r in sums.collect():
        context[r[0]] = r[1:]
    context /= np.maximum(np.linalg.norm(context, axis=1, keepdims=True), 1e-9)
    return np.hstack([_table(SEED) / np.sqrt(SIGNS), context]).astype(np.float32)


class Network:
    """Two layers: HIDDEN rectified units, one logit."""

    def fit(self, x: np.ndarray, y: np.ndarray) -> Network:
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        x = (x - self.mean) / self.scale
        weights = [rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
                   rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(1)]
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        groups = [np.flatnonzero(y == v) for v in (0, 1)]
        # Both labels appear alike in each batch; the sigmoid's offset takes the true shares back in.
        for step in range(1, STEPS + 1):
            at = np.concatenate([rng.choice(g, BATCH // 2) for g in groups])
            hidden = np.maximum(x[at] @ weights[0] + weights[1], 0)
            p = 1 / (1 + np.exp(-np.clip(hidden @ weights[2] + weights[3], -30, 30)))
            slope = (p - y[at]) / len(at)
            back = np.outer(slope, weights[2]) * (hidden > 0)
            grads = [x[at].T @ back + 1e-4 * weights[0], back.sum(0), hidden.T @ slope + 1e-4 * weights[2], np.array([slope.sum()])]
            for w, g, m, v in zip(weights, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= 0.01 * (1 - step / STEPS) * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        self.weights = weights
        return self

    def logits(self, x: np.ndarray) -> np.ndarray:
        w = self.weights
        return np.maximum((x - self.mean) / self.scale @ w[0] + w[1], 0) @ w[2] + w[3][0]


class Model:
    """Word vectors, network and temperature; ``constant`` answers alone where a label was missing in training."""

    def __init__(self, vectors: np.ndarray, constant: float | None = None):
        self.vectors, self.constant, self.reader = vectors, constant, Reader()
        self.temperature = 1.0

    def pooled(self, texts: list[str]) -> np.ndarray:
        """Mean word vector and mean square of each text, and the logarithm of its word count."""
        width = self.vectors.shape[1]
        result = np.zeros((len(texts), width + 1))
        for row, text in zip(result, texts):
            total = 0
            for rows in self.reader.rows(text):
                counts = np.bincount(rows, minlength=ROWS)
                held = np.flatnonzero(counts)
                row[:width] += counts[held] @ self.vectors[held]
                total += len(rows)
            row[:width] /= max(1, total)
            row[width] = np.log1p(total) / 10
        return result

    def fit(self, x: np.ndarray, y: np.ndarray, apart: np.ndarray) -> Model:
        """Train on the rows not ``apart`` and find the temperature on those that are."""
        self.network = Network().fit(x[~apart], y[~apart])
        logits, label = self.network.logits(x[apart]), y[apart]
        losses = {t: np.logaddexp(0, np.where(label == 1, -logits, logits) / t).mean() for t in np.geomspace(0.25, 16, 49)}
        self.temperature = float(min(losses, key=losses.get)) if len(label) else 1.0
        return self

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.network.logits(self.pooled(texts)) / self.temperature, -30, 30)))


def pooled_column(model: Model, text: Column, spark) -> Column:
    shared = spark.sparkContext.broadcast(model)
    return per_text(lambda: lambda texts: pa.array(list(shared.value.pooled(texts)), pa.list_(pa.float64())), "array<double>", text)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Word vectors from all of ``docs``; the network from at most ``sample`` labelled rows of each
    label that are not held out. Without rows of both labels the model is the share of label 1."""
    spark = docs.sparkSession
    model = Model(word_vectors(docs.select("text")))
    usable = labels.filter("doc_id is not null and quality in (0, 1)")
    usable = usable.filter(crc_remainder(F.col("doc_id"), HELD_OUT_MODULUS) != HELD_OUT)
    usable = usable.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("label"))
    parts = [usable.filter(F.col("label") == v).orderBy(F.xxhash64("id"), "id").limit(sample) for v in (0, 1)]
    chosen = written(parts[0].unionByName(parts[1]))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("id", "label", "text")
    found = rows.select("id", "label", pooled_column(model, F.col("text"), spark).alias("x")).orderBy("id", "label")
    found = found.limit(4 * sample).collect()
    y = np.array([r.label for r in found], np.int64)
    if not len(y) or y.min() == y.max():
        return Model(model.vectors, constant=float(y.mean()) if len(y) else 1.0)
    apart = np.arange(len(y)) % CALIBRATION_SHARE == 0
    if len(set(y[~apart])) < 2:
        apart[:] = False
    return model.fit(np.array([r.x for r in found]), y, apart)


def scored(model: Model, text: Column, spark) -> Column:
    """The probability of good quality; NULL and empty texts score as having no words."""
    shared = spark.sparkContext.broadcast(model)
    return per_text(lambda: lambda texts: pa.array(shared.value.scores(texts), pa.float64()), "double", text)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    Repeated rows are all returned; a row without doc_id is not held out. Other columns are
    never looked at. No rows give no rows.
    """
    model = train(docs, labels)
    held = F.coalesce(crc_remainder(F.col("doc_id"), HELD_OUT_MODULUS) == HELD_OUT, F.lit(False))
    rows = docs.select("doc_id", held.alias("held_out"), scored(model, F.col("text"), docs.sparkSession).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

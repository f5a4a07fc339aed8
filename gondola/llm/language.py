"""Language of a text by its nearest centroid.

A text becomes a vector of weighted counts of its letter runs of one to three letters, hashed
to a fixed number of places: 1 + log of the count, times the inverse document frequency over
all learning rows, scaled to length 1. Each language has several centroids, found by
clustering its vectors, and a text takes the language of the centroid of highest cosine. A
text further from that centroid than all but a small share of its members is marked rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gondola.llm.common import crc_remainder, decoded, per_text, struct_array
from gondola.session import written

HELD_OUT_MODULUS, HELD_OUT = 4, 2
PLACES = 1 << 13
#: Rows of each language that the centroids are fitted on, by the order of a hash.
SAMPLE = 1500
#: Languages of which centroids are fitted; more raise an error.
MOST_LANGUAGES = 400
CLUSTERS = 4
REJECT_SHARE = 0.005
UNKNOWN = "und"

NOT_LETTERS = re.compile(r"[\W\d_]+")
CHUNK = 1 << 20


def gram_counts(text: str) -> np.ndarray:
    """Counts by place of the runs of one to three letters, words set off by blanks."""
    counts = np.zeros(PLACES, np.int64)
    words = " " + NOT_LETTERS.sub(" ", text.lower()).strip() + " "
    # Parts overlap by two letters, so that a long text gives the same runs as in one part.
    for start in range(0, max(1, len(words) - 2), CHUNK):
        part = words[start: start + CHUNK + 2]
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        a, b, c = codes[:-2], codes[1:-1], codes[2:]
        three = (a * np.uint64(0x9E3779B1) ^ b * np.uint64(0x85EBCA77) ^ c * np.uint64(0xC2B2AE3D)) * np.uint64(0x27D4EB2F165667C5)
        two = (b * np.uint64(0x9E3779B1) ^ c * np.uint64(0x165667B1)) * np.uint64(0x27D4EB2F165667C5)
        one = b * np.uint64(0x9E3779B97F4A7C15)
        hashes = np.concatenate([three, two, one])
        counts += np.bincount((hashes >> np.uint64(40)).astype(np.int64) % PLACES, minlength=PLACES)
    return counts


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    """(texts, PLACES) weighted counts of length 1; zero without runs that any document holds."""
    result = np.zeros((len(texts), PLACES), np.float32)
    for row, text in zip(result, texts):
        counts = gram_counts(text)
        held = np.flatnonzero(counts)
        row[held] = (1 + np.log(counts[held])) * idf[held]
        row /= max(float(np.linalg.norm(row)), 1e-12)
    return result


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: rows seen (place -1) and, by place, the rows that hold it."""
    seen, held = 0, np.zeros(PLACES, np.int64)
    for batch in batches:
        for text in decoded(batch.column(0)):
            seen += 1
            held += gram_counts(text) > 0
    places = np.concatenate([[-1], np.flatnonzero(held)])
    counts = np.concatenate([[seen], held[held > 0]])
    yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), pa.array(counts, pa.int64())], names=["place", "n"])


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """Inverse document frequencies over all rows of ``texts`` (text); tasks send one sum per place."""
    binary = texts.select(F.col("text").cast("string").cast("binary").alias("text"))
    sums = binary.mapInArrow(_frequencies, "place int, n bigint").groupBy("place").agg(F.sum("n").alias("n"))
    found = {r.place: r.n for r in sums.collect()}
    total = found.pop(-1, 0)
    idf = np.zeros(PLACES)
    for place, n in found.items():
        idf[place] = np.log((1 + total) / (1 + n)) + 1
    return idf


def cluster(rows: np.ndarray, number: int, rounds: int = 12) -> np.ndarray:
    """Centroids of length 1 by spherical k-means, seeded by the furthest rows."""
    centres = [rows.mean(0)]
    while len(centres) < min(number, len(rows)):
        nearest = (rows @ np.array(centres).T).max(1)
        centres.append(rows[np.argmin(nearest)])
    centres = np.array(centres)
    for _ in range(rounds):
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
        near = np.argmax(rows @ centres.T, 1)
        centres = np.array([rows[near == j].mean(0) if (near == j).any() else centres[j] for j in range(len(centres))])
    return centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)


class Model:
    """Centroids with their languages, and the cosine under which each rejects."""

    def __init__(self, idf: np.ndarray):
        self.idf = idf
        self.names: list[str] = []
        self.centres = np.zeros((0, PLACES), np.float32)
        self.least = np.zeros(0)

    def fit(self, texts: list[str], langs: list[str]) -> Model:
        centres, least = [], []
        by_lang: dict[str, list[str]] = {}
        for text, lang in zip(texts, langs):
            by_lang.setdefault(lang, []).append(text)
        for lang in sorted(by_lang):
            rows = vectors(by_lang[lang], self.idf)
            own = cluster(rows, CLUSTERS)
            cosine = rows @ own.T
            near = np.argmax(cosine, 1)
            for j in range(len(own)):
                members = cosine[near == j, j]
                self.names.append(lang)
                centres.append(own[j])
                least.append(float(np.quantile(members, REJECT_SHARE)) if len(members) else 1.0)
        self.centres = np.array(centres, np.float32).reshape(-1, PLACES)
        self.least = np.array(least)
        self.own = {lang: np.flatnonzero(np.array(self.names) == lang) for lang in sorted(by_lang)}
        return self

    def predict(self, texts: list[str]) -> list[tuple[str, float, bool]]:
        """(language, score, rejected) of each text; the score is the softmax of the languages' best cosines."""
        result = []
        for start in range(0, len(texts), 256):
            block = texts[start: start + 256]
            cosine = vectors(block, self.idf) @ self.centres.T
            for text, row in zip(block, cosine):
                if not self.names or not has_letter(text):
                    result.append((UNKNOWN, 0.0, True))
                    continue
                best = np.array([row[at].max() for at in self.own.values()])
                share = np.exp(20 * (best - best.max()))
                top = int(np.argmax(row))
                lang = int(np.argmax(best))
                result.append((list(self.own)[lang], float(share[lang] / share.sum()), bool(row[top] < self.least[top])))
        return result


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from all rows (doc_id, text, lang) that are not held out and have text and lang:
    frequencies from every row, centroids from at most ``sample`` rows of each language."""
    rows = docs.select("doc_id", "text", "lang").filter("text is not null and lang is not null and doc_id is not null")
    rows = rows.filter(crc_remainder(F.col("doc_id"), HELD_OUT_MODULUS) != HELD_OUT)
    model = Model(document_frequencies(rows.select("text")))
    langs = [r.lang for r in rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect()]
    if len(langs) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages to learn")
    keyed = rows.select("doc_id", "lang", F.xxhash64("doc_id", "text").alias("place"))
    chosen = [keyed.filter(F.col("lang") == lang).orderBy("place", "doc_id").limit(sample) for lang in langs]
    if not chosen:
        return model
    picked = chosen[0]
    for more in chosen[1:]:
        picked = picked.unionByName(more)
    picked = written(picked.select(F.col("doc_id").alias("id"), F.col("lang").alias("l"), F.col("place").alias("p")))
    same = (F.col("doc_id") == F.col("id")) & (F.xxhash64("doc_id", "text") == F.col("p")) & (F.col("lang") == F.col("l"))
    found = rows.join(F.broadcast(picked.distinct()), same).select("text", "lang").orderBy("lang", "text")
    found = found.limit(sample * len(langs)).collect()
    return model.fit([r.text for r in found], [r.lang for r in found])


def predicted(model: Model, text: Column, spark) -> Column:
    """struct(lang_pred, score, rejected); ``und`` for NULL and texts without a letter."""
    shared = spark.sparkContext.broadcast(model)

    def made():
        own = shared.value

        def run(texts: list[str]) -> pa.Array:
            columns = list(zip(*own.predict(texts))) or [(), (), ()]
            return struct_array(lang_pred=pa.array(columns[0], pa.string()), score=pa.array(columns[1], pa.float64()),
                                rejected=pa.array(columns[2], pa.bool_()))

        return run

    return per_text(made, "struct<lang_pred:string,score:double,rejected:boolean>", text)


def report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang): doc_id, held_out, lang_pred, score, rejected.

    The prediction looks at the text alone. Without rows to learn from all texts are ``und``.
    A row without doc_id is not held out and not learnt from. Other columns are ignored.
    """
    model = train(docs)
    held = F.coalesce(crc_remainder(F.col("doc_id"), HELD_OUT_MODULUS) == HELD_OUT, F.lit(False))
    made = predicted(model, F.col("text"), docs.sparkSession)
    return docs.select("doc_id", held.alias("held_out"), made.alias("made")).select("doc_id", "held_out", "made.*")

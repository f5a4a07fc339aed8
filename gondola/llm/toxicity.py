"""Toxic documents by a support vector machine over a gapped-subsequence string kernel.

The kernel of two strings sums over their common three-letter subsequences, each weighted by a
decay to the power of the length it spans in both, and is normalised by the strings' own
kernels. Letters put in between ("i.d-iot") only lengthen the span, so an insult written with
them stays near. A Nystrom map of landmark strings turns the kernel into a short vector, on
which a linear SVM is trained.

Labels hold for documents, so what in a toxic one is toxic must be found. The learning rows' words are
counted by label; the positives are those whose link to label 1 is beyond chance among so many
words, each with altered forms of it; the negatives are all words of clean documents, weighted by
how many hold them. A toxic document without a significant word teaches the machine nothing. A
document's words are each scored, and the highest scores, their sum and its share of all words
become a probability by a logistic fit. That fit also sees some clean documents with one strong
positive put in, labelled toxic, so one insult in a long clean text counts.

The kernel reads words, not whole sentences or windows of neighbouring words (see the README).
Words are counted, mapped and summed up for the fit by Spark tasks; the driver holds the
positives, the landmarks and matrices of landmarks by landmarks.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gondola.llm.common import crc_remainder, decoded, per_text
from gondola.session import written

HELD_OUT_MODULUS, HELD_OUT = 5, 0
#: Bounds of the training sample: labelled rows of each label, taken in the order of a hash of the id.
SAMPLE_TOXIC, SAMPLE_CLEAN = 1500, 2500
DECAY = 0.75
#: Bounds of the fit: the positives that are in the most toxic rows, the landmarks picked from them
#: (as many clean words most like these come beside), common clean words as landmarks.
POSITIVES, LANDMARKS, COMMON = 2048, 96, 8
#: Share of a positive that no landmark picked before explains, under which none is picked.
RESIDUAL = 0.2
#: The most documents that count for a positive and for a clean word.
TOXIC_WEIGHT, CLEAN_WEIGHT = 50, 20
RIDGE, STEPS = 1e-5, 15
#: Share of the clean documents of which a copy with a positive put in is learnt from, and the share of
#: clean documents whose highest score stays under that of a *strong* word; only strong words are put in.
PUT_IN, CLEAN_UNDER = 0.05, 0.995
#: Longer words are read in overlapping pieces of this many letters.
PIECE, STEP = 32, 16
KEPT_WORDS = 200_000
BLOCK = 128
#: Score of a text without words, and the least of any.
FLOOR = -2.0
MAPPED = 4096
#: Subsequences of words that are scored at once; texts that are decoded, and characters that are scored, at once.
SCORED = 1 << 17
ROWS, BLOCK_CHARS = 1000, 2_000_000

SPACED = re.compile(r"(?<!\S)\S(?:\s\S){2,}(?!\S)")
MARKS = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]))


def tokens(text: str) -> set[str]:
    """The distinct words of a text in lower case, and letters set apart by spaces as one word."""
    lowered = text.lower()
    found = set(lowered.split())
    found.update("".join(run.split()) for run in SPACED.findall(lowered))
    return found


def readings(token: str) -> list[str]:
    """What the kernel reads a word as: without outer marks, and without inner ones if it has any."""
    bare = token.strip(MARKS)
    letters = "".join(c for c in bare if c.isalnum())
    result = []
    for form in {bare, letters}:
        if len(form) <= PIECE:
            result.append(form)
        else:
            result += [form[i: i + PIECE] for i in range(0, len(form) - STEP, STEP)]
    return [form for form in result if len(form) >= 3]


def _codes(words: list[str], width: int) -> np.ndarray:
    """(words, width) code points, 0 beyond the end."""
    return np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, width)


def _against(codes: np.ndarray, marks: np.ndarray, decay: float) -> np.ndarray:
    """(words, landmarks) kernel sums of letter rows with the letter rows ``marks`` of the landmarks.

    ``first`` and ``second`` hold, for each landmark position, the decayed sum of matches of the
    first letter, and of the first two, that end there in the part of the word read so far.
    """
    decay = np.float32(decay)
    count, size = marks.shape
    letters, places = np.unique(marks, return_inverse=True)
    # By letter, which landmark positions hold it; the last row is for letters in no landmark.
    table = (np.arange(len(letters) + 1)[:, None, None] == places.reshape(marks.shape).T[None]).astype(np.float32)
    table[:-1][letters == 0] = 0
    at = np.minimum(np.searchsorted(letters, codes), len(letters) - 1)
    at = np.where(letters[at] == codes, at, len(letters))
    shape = (len(codes), count)
    first, second = np.zeros((size, *shape), np.float32), np.zeros((size, *shape), np.float32)
    total, one, two, step = (np.zeros(shape, np.float32) for _ in range(4))
    pairs = np.zeros((size, *shape), np.float32)
    for i in range(codes.shape[1]):
        match = table[at[:, i]]
        one[:], two[:] = 0, 0
        for j in range(1, size):
            one += first[j - 1]
            one *= decay
            two += second[j - 1]
            two *= decay
            np.multiply(match[:, j], one, out=pairs[j])
            np.multiply(match[:, j], two, out=step)
            total += step
        for j in range(size):
            first[j] += match[:, j]
        first *= decay
        second += pairs
        second *= decay
    return total


def _own(words: list[str], decay: float) -> np.ndarray:
    """The kernel of each word with itself; the words have one length."""
    codes = _codes(words, max(map(len, words)))
    size, count = codes.shape[1], len(words)
    marks = codes.T
    decay = np.float32(decay)
    first, second = np.zeros((size, count), np.float32), np.zeros((size, count), np.float32)
    total = np.zeros(count, np.float32)
    for i in range(size):
        match = ((marks == marks[i]) & (marks > 0)).astype(np.float32)
        one, two = np.zeros((size, count), np.float32), np.zeros((size, count), np.float32)
        for j in range(1, size):
            one[j] = decay * (one[j - 1] + first[j - 1])
            two[j] = decay * (two[j - 1] + second[j - 1])
        total += (match * two).sum(0)
        first = decay * (first + match)
        second = decay * (second + match * one)
    return total


def kernel(words: list[str], landmarks: list[str], decay: float = DECAY) -> np.ndarray:
    """(words, landmarks) normalised kernel; 0 where a string has under three letters."""
    marks = _codes(landmarks, max(map(len, landmarks)))
    own_marks = _own(landmarks, decay)
    result = np.zeros((len(words), len(landmarks)), np.float32)
    by_length: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        by_length.setdefault(len(word), []).append(i)
    for length, places in by_length.items():
        if length < 3:
            continue
        for start in range(0, len(places), BLOCK):
            block = places[start: start + BLOCK]
            chosen = [words[i] for i in block]
            scale = np.sqrt(_own(chosen, decay)[:, None] * own_marks[None, :])
            result[block] = _against(_codes(chosen, length), marks, decay) / np.maximum(scale, 1e-20)
    return result


@functools.cache
def _triples(length: int, decay: float = DECAY) -> list[tuple[int, int, int, float]]:
    """Places of all three-letter subsequences of a word, with the decay of their span."""
    return [(i, j, k, decay ** (k - i)) for i, j, k in combinations(range(length), 3)]


def _divergence(share: np.ndarray | float, base: float) -> float:
    share = min(max(share, 1e-9), 1 - 1e-9)
    return share * np.log(share / base) + (1 - share) * np.log((1 - share) / (1 - base))


def significant(toxic: Column, clean: Column, share: float, tried: int) -> Column:
    """Whether a word of so many toxic and clean rows is in toxic ones beyond chance, among ``tried`` words.

    ``share`` is that of toxic rows among all. By the divergence of the word's own share from it,
    against the logarithm of the number of words tried.
    """
    total = toxic + clean
    own = F.least(F.greatest(toxic / total, F.lit(1e-9)), F.lit(1 - 1e-9))
    divergence = own * F.log(own / share) + (1 - own) * F.log((1 - own) / (1 - share))
    return (toxic > 1) & (own > (1 + share) / 2) & (total * divergence > float(np.log(tried + 1) + 2))


def pivots(words: list[str], most: int = LANDMARKS, residual: float = RESIDUAL) -> list[str]:
    """The words that explain the others best in the kernel, one after the other: each is the one that
    those before leave most of."""
    left, columns, chosen = np.ones(len(words)), [], []
    while len(chosen) < min(most, len(words)):
        best = int(np.argmax(left))
        if left[best] < residual:
            break
        column = kernel(words, [words[best]])[:, 0].astype(np.float64)
        for c in columns:
            column -= c * c[best]
        column /= np.sqrt(max(column[best], 1e-12))
        columns.append(column)
        left = np.maximum(left - column * column, 0)
        chosen.append(best)
        left[chosen] = 0
    return [words[i] for i in chosen]


def altered(word: str, rng: np.random.Generator) -> list[str]:
    """The word with a letter put in, and with a mark put in between two letters."""
    if len(word) < 4:
        return []
    at, letter = rng.integers(1, len(word) - 1, 2), chr(97 + int(rng.integers(26)))
    return [word[: at[0]] + letter + word[at[0]:], word[: at[1]] + "." + word[at[1]:]]


def _sums(x: np.ndarray, y: float, weight: np.ndarray, w: np.ndarray) -> np.ndarray:
    """A Newton step's matrix and, as its last row, right side, over the rows within the margin."""
    x = np.hstack([x.astype(np.float64), np.ones((len(x), 1))])
    active = y * (x @ w) < 1
    rows = x[active] * weight[active, None]
    return np.vstack([rows.T @ x[active], y * rows.sum(0)])


def _svm(rows: list[tuple[np.ndarray, float, np.ndarray]], more, size: int, ridge: float = RIDGE, steps: int = STEPS) -> np.ndarray:
    """Weights and bias of a linear SVM with squared hinge loss, by Newton steps on its active rows.

    ``rows``: mapped rows, label and weights; ``more(w)`` gives the sums (``_sums``) of all others.
    """
    w = np.zeros(size + 1)
    penalty = np.diag([*[ridge] * size, 1e-9])
    for _ in range(steps):
        total = more(w) + sum(_sums(*r, w) for r in rows)
        step = np.linalg.solve(total[:-1] + penalty, total[-1])
        done = np.abs(step - w).max() < 1e-5 * max(1, np.abs(step).max())
        w = step
        if done:
            break
    return w


def _sigmoid_fit(x: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Weights of P(label) = 1 / (1 + exp(-x w)), by damped Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w)), x.T @ (p - label) + 1e-2 * w)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def summary(scores: np.ndarray) -> tuple[float, float, float, int]:
    """Of a document's word scores: the highest two, the sum of those above the margin, the number of words."""
    top = np.sort(scores)[::-1][:2].tolist() + [FLOOR] * 2
    return max(top[0], FLOOR), max(top[1], FLOOR), float(scores[scores > 0].sum()), len(scores)


def _features(found: np.ndarray, strong: float) -> np.ndarray:
    """What the logistic fit sees of summaries."""
    first, second, total, number = found.reshape(-1, 4).T
    columns = np.clip(first, -1, 2), np.clip(second, -1, 2), np.log1p(total), np.log((total + 0.05) / (number + 10))
    return np.stack([*columns, first > strong, np.ones(len(first))], 1)


class Model:
    """The trained classifier; ``constant`` answers alone where a label was missing in training."""

    def __init__(self, constant: float | None = None):
        self.constant, self.landmarks = constant, []
        self.known: dict[str, float] = {}
        self.read: dict[str, float] = {}

    def at(self, landmarks: list[str]) -> Model:
        """Set the landmarks of the Nystrom map."""
        self.landmarks = landmarks
        values, vectors = np.linalg.eigh(kernel(landmarks, landmarks).astype(np.float64))
        kept = values > 1e-3
        self.root = (vectors[:, kept] / np.sqrt(values[kept])).astype(np.float32)
        return self

    def map(self, words: list[str]) -> np.ndarray:
        blocks = [kernel(words[i:i + MAPPED], self.landmarks) @ self.root for i in range(0, len(words), MAPPED)]
        return np.vstack(blocks) if blocks else np.zeros((0, self.root.shape[1]), np.float32)

    def mapped_scores(self, words: list[str]) -> np.ndarray:
        """Scores by way of the kernel with every landmark."""
        return self.map(words) @ self.weights[:-1].astype(np.float32) + np.float32(self.weights[-1])

    def condense(self) -> Model:
        """Sum up what each three-letter subsequence adds to a score over all landmarks.

        The kernel is a product of the decayed counts of such subsequences, and the machine is linear
        in it; so a word's score is a sum over its own subsequences, whatever the number of landmarks.
        """
        share = (self.root.astype(np.float64) @ self.weights[:-1]) / np.sqrt(np.maximum(_own(self.landmarks, DECAY), 1e-20))
        self.letters = np.array(sorted(set(map(ord, "".join(self.landmarks)))), np.uint32)
        size = len(self.letters) + 1
        table = np.zeros(size ** 3)
        for mark, part in zip(self.landmarks, share):
            at = self._letters(_codes([mark], len(mark)))
            for i, j, k, decay in _triples(len(mark)):
                table[(at[0, i] * size + at[0, j]) * size + at[0, k]] += part * decay
        table.reshape(size, size, size)[0] = 0
        table.reshape(size, size, size)[:, 0] = 0
        table.reshape(size, size, size)[:, :, 0] = 0
        self.table = table.astype(np.float32)
        return self

    def _letters(self, codes: np.ndarray) -> np.ndarray:
        """Places of letters among those of the landmarks, from 1; 0 for any other."""
        at = np.minimum(np.searchsorted(self.letters, codes), len(self.letters) - 1)
        return np.where(self.letters[at] == codes, at + 1, 0)

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Each word's score, above 0 on the toxic side of the margin."""
        result = np.full(len(words), self.weights[-1], np.float32)
        size = len(self.letters) + 1
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            by_length.setdefault(len(word), []).append(i)
        for length, places in by_length.items():
            if length < 3:
                continue
            first, second, third, decay = map(np.array, zip(*_triples(length)))
            step = max(1, SCORED // len(first))
            for start in range(0, len(places), step):
                block = places[start: start + step]
                chosen = [words[i] for i in block]
                at = self._letters(_codes(chosen, length))
                found = self.table[(at[:, first] * size + at[:, second]) * size + at[:, third]] @ decay.astype(np.float32)
                result[block] += found / np.sqrt(np.maximum(_own(chosen, DECAY), 1e-20))
        return result

    def summaries(self, bags: list[set[str]]) -> np.ndarray:
        self.learn(set().union(*bags))
        found = [summary(np.fromiter(map(self.known.__getitem__, bag), np.float64, len(bag))) for bag in bags]
        return np.array(found, np.float64).reshape(-1, 4)

    def fit_documents(self, found: np.ndarray, toxic: np.ndarray, put_in: np.ndarray) -> Model:
        """Fit the probability on documents' summaries; ``put_in`` are scores of positives no clean document has."""
        clean = np.flatnonzero(~toxic)
        self.strong = float(np.quantile(found[clean, 0], CLEAN_UNDER))
        put_in = put_in[put_in > self.strong]
        some = found[clean[:: round(1 / PUT_IN)]] if len(put_in) else found[:0]
        new = np.resize(put_in, len(some))
        first, second = np.maximum(some[:, 0], new), np.maximum(some[:, 1], np.minimum(some[:, 0], new))
        some = np.stack([first, second, some[:, 2] + np.maximum(new, 0), some[:, 3] + 1], 1)
        label = np.concatenate([toxic, np.ones(len(some), bool)]).astype(np.float64)
        self.document = _sigmoid_fit(_features(np.vstack([found, some]), self.strong), label)
        return self

    def learn(self, wanted: set[str]) -> None:
        """Score all ``wanted`` tokens; when a table is full, only these stay."""
        new = [t for t in wanted if t not in self.known]
        if len(self.known) + len(new) > KEPT_WORDS:
            self.known = {t: self.known[t] for t in wanted if t in self.known}
        forms = [readings(t) for t in new]
        words = [w for w in set().union(*forms) if w not in self.read]
        if len(self.read) + len(words) > KEPT_WORDS:
            self.read, words = {}, list(set().union(*forms))
        if words:
            self.read.update(zip(words, self.word_scores(words).tolist()))
        self.known.update((t, max((self.read[f] for f in fs), default=FLOOR)) for t, fs in zip(new, forms))

    def scores(self, texts: list[str]) -> np.ndarray:
        """Probability of each text to be toxic."""
        if self.constant is not None or not texts:
            return np.full(len(texts), self.constant or 0.0)
        found = _features(self.summaries([tokens(t) for t in texts]), self.strong)
        return 1 / (1 + np.exp(-np.clip(found @ self.document, -30, 30)))


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, text) to (word, toxic, clean): the distinct readings of each text."""
    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), decoded(batch.column(1))):
            words = sorted({r for token in tokens(text) for r in readings(token)})
            columns = [pa.array(words, pa.string()), pa.array([label] * len(words), pa.int64()), pa.array([1 - label] * len(words), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "toxic", "clean"])


def _contrast(words: DataFrame, landmarks: list[str]) -> list[str]:
    """The word of ``words`` most like each landmark."""

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                some = batch.column(0).to_pylist()
                alike = kernel(some, landmarks)
                best = np.argmax(alike, 0)
                columns = [pa.array(range(len(landmarks)), pa.int32()), pa.array(alike.max(0).astype(np.float64)), pa.array([some[i] for i in best])]
                yield pa.RecordBatch.from_arrays(columns, names=["mark", "alike", "word"])

    found = words.select("word").mapInArrow(nearest, "mark int, alike double, word string")
    best = found.groupBy("mark").agg(F.max_by("word", F.struct("alike", "word")).alias("word"))
    return sorted({r.word for r in best.collect()})


def _mapped(words: DataFrame, model: Model) -> DataFrame:
    """(weight, mapped) of clean words, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = model.map(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([row.tobytes() for row in x], pa.binary())], names=["weight", "mapped"])

    weight = F.least("clean", F.lit(CLEAN_WEIGHT)).cast("double").alias("weight")
    return written(words.select("word", weight).mapInArrow(run, "weight double, mapped binary"))


def _distributed_sums(mapped: DataFrame, size: int, scale: float):
    """``w`` to the Newton sums over all clean words, one matrix a task."""

    def sums(w: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((size + 2, size + 1))
            for batch in batches:
                raw = b"".join(batch.column(1).to_pylist())
                x = np.frombuffer(raw, np.float32).reshape(batch.num_rows, size)
                total += _sums(x, -1.0, batch.column(0).to_numpy(zero_copy_only=False) * scale, w)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

        parts = mapped.mapInArrow(run, "sums binary").collect()
        return sum((np.frombuffer(r.sums).reshape(size + 2, size + 1) for r in parts), np.zeros((size + 2, size + 1)))

    return sums


def train(docs: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN) -> Model:
    """Fit on a bounded sample of the labelled rows that are not held out.

    ``labels`` (doc_id, toxic). The sample's words are counted and mapped by Spark, whole texts; the
    driver holds at most ``POSITIVES`` words, the landmarks and four numbers of each sampled row.
    Without labelled rows of both kinds, or without any word beyond chance, the model is the
    constant share of toxic rows, under one half.
    """
    usable = labels.filter("doc_id is not null and toxic in (0, 1)")
    usable = usable.filter(crc_remainder(F.col("doc_id"), HELD_OUT_MODULUS) != HELD_OUT)
    chosen = [
        usable.filter(F.col("toxic") == value).select(F.col("doc_id").alias("id"), F.col("toxic").alias("label")).orderBy(
            *[o.asc() for o in (F.xxhash64("id"), F.col("id"))]).limit(bound)
        for value, bound in ((1, toxic), (0, clean))
    ]
    sample = written(chosen[0].unionByName(chosen[1]))
    rows = written(docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("id")).select(
        F.col("label").cast("int"), F.col("text").cast("string").cast("binary").alias("text")))
    number = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = number.get(1, 0) / max(1, sum(number.values()))
    constant = Model(constant=min(share, 0.49) if number.get(0) else float(share > 0))
    if not number.get(0) or not number.get(1):
        return constant
    words = rows.mapInArrow(_word_rows, "word string, toxic long, clean long").groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    words = written(words)
    tried = words.filter("toxic > 0").count()
    linked = significant(F.col("toxic"), F.col("clean"), float(np.clip(share, 0.01, 0.99)), tried)
    best = words.filter(linked).orderBy(F.desc("toxic"), "word").limit(POSITIVES).collect()
    if not best:
        return constant
    others = words.filter(~linked & (F.col("clean") > 0))
    picked = pivots([r.word for r in best])
    common = [r.word for r in others.filter(F.length("word") >= 4).orderBy(F.desc("clean"), "word").limit(COMMON).collect()]
    model = Model().at(list(dict.fromkeys([*picked, *_contrast(others, picked), *common])))

    rng = np.random.default_rng(0)
    weight = np.minimum([float(r.toxic) for r in best], TOXIC_WEIGHT)
    forms = [(form, w) for r, w in zip(best, weight) for form in altered(r.word, rng)]
    in_clean = others.agg(F.sum(F.least("clean", F.lit(CLEAN_WEIGHT)))).first()[0] or 0
    scale = 1 / (weight.sum() + sum(w for _, w in forms) + in_clean + sum(r.clean for r in best))
    x = model.map([r.word for r in best])
    size = x.shape[1]
    own = [(x, 1.0, weight * scale), (x, -1.0, np.array([float(r.clean) for r in best]) * scale)]
    if forms:
        own.append((model.map([f for f, _ in forms]), 1.0, np.array([w for _, w in forms]) * scale))
    model.weights = _svm(own, _distributed_sums(_mapped(others, model), size, scale), size)
    model.condense()

    def summarised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.summaries([tokens(t) for t in decoded(batch.column(1))])
            columns = [batch.column(0), *[pa.array(c) for c in found.T]]
            yield pa.RecordBatch.from_arrays(columns, names=["label", "a", "b", "c", "d"])

    found = rows.mapInArrow(summarised, "label int, a double, b double, c double, d double").orderBy("label", "a", "b", "c", "d").collect()
    found = np.array([tuple(r) for r in found])
    pure = [form for r in best if not r.clean for form in (r.word, *altered(r.word, rng))]
    put_in = np.sort(model.word_scores(pure)) if pure else np.zeros(0)
    model.fit_documents(found[:, 1:], found[:, 0] == 1, rng.permutation(put_in))
    model.known, model.read = {}, {}
    return model


def scored(model: Model, text: Column, spark) -> Column:
    """The probability that a text is toxic; NULL and empty texts score as having no words."""
    shared = spark.sparkContext.broadcast(model)

    def made():
        own = shared.value

        def run(texts: list[str]) -> pa.Array:
            blocks = (own.scores(block) for block in _blocks(texts))
            return pa.array(np.concatenate([*blocks, np.zeros(0)]), pa.float64())

        return run

    return per_text(made, "double", text, ROWS)


def _blocks(texts: list[str], chars: int = BLOCK_CHARS) -> Iterable[list[str]]:
    block, size = [], 0
    for text in texts:
        block.append(text)
        size += len(text)
        if size >= chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    Repeated rows are all returned; a row without doc_id is not held out. Other columns are
    never looked at. No rows give no rows.
    """
    model = train(docs, labels)
    score = scored(model, F.col("text"), docs.sparkSession)
    held = F.coalesce(crc_remainder(F.col("doc_id"), HELD_OUT_MODULUS) == HELD_OUT, F.lit(False))
    rows = docs.select("doc_id", held.alias("held_out"), score.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def acceptable(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` scored under one half, all columns as they were.

    NULL and empty texts score as having no words; repeated rows are scored alike; no rows, or no
    labels to learn from, keep all rows.
    """
    model = train(docs, labels)
    return docs.filter(scored(model, F.col("text"), docs.sparkSession) < 0.5)

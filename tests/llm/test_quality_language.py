import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from gondola.llm import language, quality

SPEECH = {"xa": ["ka", "ro", "tin", "mel"], "xb": ["üsch", "ber", "ung", "dö"], "xc": ["ñol", "que", "ció", "las"]}


def text(rnd, lang, words=30):
    return " ".join("".join(rnd.choice(SPEECH[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(words))


def test_language_of_held_out_rows(spark):
    rnd = random.Random(1)
    rows = [(i, text(rnd, lang, rnd.randint(2, 60)), lang) for i in range(400) for lang in [rnd.choice(list(SPEECH))]]
    odd = [(1000, None, "xa"), (1001, "", "xa"), (1002, "123 %% --", "xb"), (None, "karo", "xa"), (1003, "karo tin", None), (1004, "ungber " * 90_000, "xb")]
    docs = spark.createDataFrame(rows + odd + rows[:1], "doc_id long, text string, lang string").withColumn("score", F.lit("x")).withColumn("p", F.lit(1))
    report = language.report(docs)
    found = [r for r in report.collect()]
    assert report.columns == ["doc_id", "held_out", "lang_pred", "score", "rejected"] and len(found) == len(rows) + len(odd) + 1
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _ in rows)
    right = [by_id[i].lang_pred == lang for i, _, lang in rows if by_id[i].held_out]
    assert len(right) > 60 and np.mean(right) >= 0.98
    assert all(by_id[i].lang_pred == "und" for i in (1000, 1001, 1002)) and by_id[1003].lang_pred == "xa" and by_id[1004].lang_pred == "xb"
    assert all(0 <= r.score <= 1 for r in found)


def test_long_text_counts_like_short_parts(monkeypatch):
    rnd = random.Random(2)
    long = text(rnd, "xb", 500)
    whole = language.gram_counts(long)
    monkeypatch.setattr(language, "CHUNK", 37)
    assert (language.gram_counts(long) == whole).all()


def test_rejection_of_a_strange_text(spark):
    rnd = random.Random(3)
    docs = spark.createDataFrame([(i, text(rnd, "xa"), "xa") for i in range(100)], "doc_id long, text string, lang string")
    (name, _, strange), (_, _, usual) = language.train(docs).predict(["щука жэюя фыва", text(rnd, "xa")])
    assert name == "xa" and strange and not usual


def test_language_without_rows_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "karo", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in language.report(docs).collect()] == ["und"] and language.report(docs.limit(0)).count() == 0


def quality_rows():
    rnd = random.Random(4)
    rows = []
    for i in range(300):
        good = i % 4 != 0
        words = text(rnd, "xa", rnd.randint(3, 80))
        rows.append((i, words if good else " ".join(w.upper() + rnd.choice(["!!", "%%%"]) for w in words.split()), int(good)))
    return rows


def test_quality_of_held_out_rows(spark):
    rows = quality_rows()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(None, None), (900, ""), (901, "karo " * 200_000), (1, rows[1][1])], "doc_id long, text string")
    docs = docs.withColumn("label", F.lit("x")).withColumn("id", F.lit(1)).withColumn("row", F.lit(1))
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 0), (2, None), (5000, 1)], "doc_id long, quality int")
    report = quality.report(docs, labels)
    found = {r.doc_id: r for r in report.collect()}
    assert report.columns == ["doc_id", "held_out", "score", "predicted"] and report.count() == 304
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _, _ in rows)
    right = [found[i].predicted == y for i, _, y in rows if found[i].held_out]
    assert len(right) > 60 and np.mean(right) >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found.values())


def test_word_vectors_are_neighbour_sums(spark):
    docs = spark.createDataFrame([("ab cd ef gh",), ("ab cd",), (None,)], "text string")
    vectors = quality.word_vectors(docs)
    row, index = quality.Reader.row, quality._table(quality.SEED).astype(float)
    want = np.zeros(quality.WIDTH)
    for near in ("cd", "ef", "cd"):
        want += index[row("ab") * 0 + row(near)]
    assert np.allclose(vectors[row("ab"), quality.WIDTH:], want / np.linalg.norm(want), atol=1e-5)


def test_quality_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "karo")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in quality.report(docs, labels).collect()] == [1.0]
    assert quality.report(docs.limit(0), labels).count() == 0

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gondola.llm import toxicity as t


def brute_kernel(a, b, decay):
    def raw(x, y):
        total = 0.0
        triples = lambda s: [(i, j, k) for i in range(len(s)) for j in range(i + 1, len(s)) for k in range(j + 1, len(s))]
        for i in triples(x):
            for j in triples(y):
                if all(x[p] == y[q] for p, q in zip(i, j)):
                    total += decay ** (i[2] - i[0] + j[2] - j[0])
        return total

    both = raw(a, a) * raw(b, b)
    return raw(a, b) / both ** 0.5 if both else 0.0


def test_kernel_equals_all_triples():
    words = ["abc", "abcd", "axbxc", "idiot", "i.d.i.o.t", "ab", "", "aaaa", "tidio", "éclair"]
    marks = ["idiot", "abc", "aaa"]
    got = t.kernel(words, marks, 0.75)
    want = [[brute_kernel(w, m, 0.75) for m in marks] for w in words]
    assert np.allclose(got, want, atol=1e-4)


def test_readings():
    assert t.readings("(id.iot!)") in (["id.iot", "idiot"], ["idiot", "id.iot"])
    assert "idiot" in t.tokens("you i d i o t now") and t.readings("ab") == []
    assert sum(len(p) for p in t.readings("x" * 200)) >= 200


def corpus(seed, number=400):
    rnd = random.Random(seed)
    bad = ["blarg", "snurf", "blargig", "snurfend"]
    rows = []
    for i in range(number):
        words = ["".join(rnd.choice(["ta", "re", "no", "li", "me"]) for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(1, 40))]
        toxic = i % 3 == 0
        if toxic:
            words[rnd.randrange(len(words))] = rnd.choice(bad)
        rows.append((i, " ".join(words), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def trained(spark):
    rows = corpus(1)
    docs = spark.createDataFrame([(i, x) for i, x, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    return rows, docs, labels


def test_held_out_accuracy(spark, trained):
    rows, docs, labels = trained
    found = {r.doc_id: r for r in t.report(docs, labels).collect()}
    held = [(found[i], y) for i, _, y in rows if found[i].held_out]
    assert len(held) > 40 and all(r.predicted == y == (r.score >= 0.5) for r, y in held)
    kept = {r.doc_id for r in t.acceptable(docs, labels).collect()}
    assert kept == {i for i, r in found.items() if r.score < 0.5}


def test_gaps_and_inserted_letters(spark, trained):
    _, docs, labels = trained
    model = t.train(docs, labels)
    assert (model.scores(["tare b.l.a.r.g nome", "s n u r f", "no blaxrg"]) >= 0.5).all()
    assert (model.scores(["", "tare nome", "xx"]) < 0.5).all()


def test_sixty_unrelated_insults(spark):
    rnd = random.Random(5)
    insults = ["".join(rnd.sample("bcdfghjklmnpqrstvwxz", 6)) for _ in range(60)]
    clean = lambda: ["".join(rnd.choice(["ta", "re", "no", "li", "me"]) for _ in range(rnd.randint(1, 4))) for _ in range(20)]
    texts = [" ".join(clean() + ([insults[i // 2 % 60]] if i % 2 else [])) for i in range(3600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = t.train(docs, spark.createDataFrame([(i, i % 2) for i in range(3600)], "doc_id long, toxic int"))
    scores = model.scores([" ".join([*clean(), w]) for w in insults])
    assert (scores >= 0.5).all() and (model.scores([" ".join(clean()) for _ in range(60)]) < 0.5).all()


def test_newton_sums_of_parts_add_up_and_reach_the_least_loss():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(300, 4)).astype(np.float32), 1.0
    z = rng.normal(size=(500, 4)).astype(np.float32) + 1
    weight = rng.random(500) / 500
    more = lambda w: sum(t._sums(z[i::3], -1.0, weight[i::3], w) for i in range(3))
    w = t._svm([(x, y, np.full(300, 1 / 300))], more, 4, 1e-3, 50)

    def loss(w):
        hinge = lambda a, s: np.maximum(0, 1 - s * (a @ w[:-1] + w[-1])) ** 2
        return (hinge(x, 1) / 300).sum() + (hinge(z, -1) * weight).sum() + 1e-3 * (w[:-1] ** 2).sum()

    assert all(loss(w) <= loss(w + rng.normal(size=5) * 1e-3) for _ in range(200))


def test_scores_by_subsequences_are_those_by_the_kernel(spark, trained):
    model = t.train(trained[1], trained[2])
    words = ["blarg", "b.l.a.r.g", "snurfend", "tareno", "ab", "", "xyzxyzxyz" * 3, "éclair", "blaxrg", "narfsnurf"]
    assert np.allclose(model.word_scores(words), model.mapped_scores(words), atol=1e-4)


def test_pivots_explain_the_others():
    words = ["idiot", "idiots", "idiotic", "trash", "trashy", "moron"]
    assert {w[0] for w in t.pivots(words, 3, 0.2)} == {"i", "t", "m"}
    assert sorted(t.pivots(words, 6, 0.0)) == sorted(words) and len(t.pivots(words, 6, 0.9)) == 3


def test_given_held_out_rows(spark):
    """On the given documents: every one with a learnt insult is found, and hardly any other is flagged."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = t.train(docs, labels)
    # What labels teach as the strongest; the classifier itself knows no list.
    insults = ["trash", "pathetic", "idiot", "disgusting", "worthless", "stupid", "clown", "loser", "scum", "moron"]
    assert (model.word_scores(insults) > 0.5).all()
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    rows = docs.join(labels, "doc_id").filter(held).select("text", "toxic").collect()
    scores = model.scores([r.text or "" for r in rows])
    toxic, plain = np.array([r.toxic == 1 for r in rows]), np.array([any(w in (r.text or "").lower() for w in insults) for r in rows])
    found = scores >= 0.5
    assert found[plain].all() and plain.sum() > 40
    assert toxic[found].mean() >= 0.95 and found[toxic].mean() >= 0.85
    order = np.argsort(scores)
    ranks = np.empty(len(order))
    ranks[order] = np.arange(len(order))
    auc = (ranks[toxic].sum() - toxic.sum() * (toxic.sum() - 1) / 2) / (toxic.sum() * (~toxic).sum())
    assert auc > 0.97
    rng = np.random.default_rng(7)
    clean = [r.text for r in rows if r.toxic == 0 and r.text][:200]
    recall = {}
    for kind, change in {
        "plain": lambda w: w, "marks": ".".join, "spaced": " ".join, "mark": lambda w: w[:2] + "*" + w[2:],
        "letter": lambda w: w[:2] + "x" + w[2:], "split": lambda w: w[:2] + " " + w[2:],
    }.items():
        texts = [" ".join([*(words := c.split(" "))[:(at := rng.integers(len(words)))], change(insults[i % 10]), *words[at:]]) for i, c in enumerate(clean)]
        recall[kind] = float((model.scores(texts) >= 0.5).mean())
    many = {}
    for kind, change in {"letter": lambda w: w[:2] + "x" + w[2:], "marks": ".".join, "mark": lambda w: w[:3] + "-" + w[3:], "spaced": " ".join}.items():
        texts = [re.sub("|".join(insults), lambda m: change(m.group()), r.text.lower()) for r, p in zip(rows, plain) if p]
        many[kind] = float((model.scores(texts) >= 0.5).mean())
    print("found", found[toxic].mean(), "precision", toxic[found].mean(), "auc", auc, "put into clean", recall, "all altered", many)
    assert min(recall[k] for k in ("plain", "marks", "mark", "spaced")) >= 0.75
    assert min(many[k] for k in ("marks", "mark", "spaced", "letter")) >= 0.95


def test_odd_rows(spark, trained):
    _, docs, labels = trained
    odd = spark.createDataFrame([(None, "tare"), (1000, None), (1001, ""), (1, "blarg"), (1, "blarg"), (1002, "blarg " * 9000)],
                                "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("label", F.lit(1))
    model_rows = docs.withColumn("score", F.lit("x")).withColumn("label", F.lit(1)).unionByName(odd)
    labels = labels.unionByName(spark.createDataFrame([(None, 1), (5, None), (5000, 1)], "doc_id long, toxic int"))
    found = t.report(model_rows, labels)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"] and found.count() == docs.count() + 6
    assert all(0 <= r.score <= 1 and r.held_out is not None for r in found.collect())


def test_without_labels_or_rows(spark, trained):
    _, docs, labels = trained
    assert {r.score for r in t.report(docs, labels.limit(0)).collect()} == {0.0}
    assert t.report(docs.limit(0), labels).count() == 0

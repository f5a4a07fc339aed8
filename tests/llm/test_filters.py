import random
from itertools import permutations

import pytest

from gondola.llm import filters

COLUMNS = "doc_id long, text string, lang string, n_chars long, digest string, mask string"


def brute(rows, labels):
    """Every order applied to every document."""
    first = {}
    for r in rows:
        if r[0] is not None:
            first[r[1] or ""] = min(first.get(r[1] or "", r[0]), r[0])
    good, toxic = ({d for d, *marks in labels if marks[i] == 1 and d is not None} for i in (0, 1))

    def fails(doc_id, text):
        words = [w for w in text.translate({c: " " for c in range(9, 14)}).split(" ") if w]
        return {f for f, bad in {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text), "D": any(c in "#$%&*|" for c in text),
            "E": doc_id is not None and doc_id > first[text],
        }.items() if bad}

    result = {}
    for part in {r[2] or "" for r in rows}:
        docs = [(r[0], fails(r[0], r[1] or "")) for r in rows if (r[2] or "") == part]
        out, shapley = {}, dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), sum(f in d[1] for d in docs) - len(gone), sum(d[1] == {f} for d in docs),
                    sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone),
                ]
        result |= {k: (*v, shapley[k[1][k[2] - 1]]) for k, v in out.items()}
    return result


def got(spark, rows, labels):
    docs = spark.createDataFrame([(*r, 0, "x", "y") for r in rows], COLUMNS)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = filters.report(docs, marks).collect()
    assert len(found) == len({r.part for r in found}) * 600
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in found}


def test_equals_all_orders_applied(spark):
    rnd = random.Random(3)
    texts = [None, "", " \t\x0b", "a " * 300, "Ab " * 250, "x#", "\x1c  \r", "É" * 40]
    texts += [" ".join(rnd.choice(["re", "Ta", "no%", "li", str(rnd.random())]) for _ in range(n)) for n in (3, 199, 200, 201, 400)]
    rows = [(rnd.randrange(60), rnd.choice(texts), rnd.choice(["en", "de", None, ""])) for _ in range(150)]
    rows += [(None, "a " * 300, "en"), (None, "", None), rows[0], rows[0]]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1])) for i in range(50)] + [(3, 0, 0), (3, 1, 1), (None, 1, 1)]
    assert got(spark, rows, labels) == brute(rows, labels)


def test_tables_without_rows(spark):
    assert got(spark, [], [(1, 1, 1)]) == {}
    assert got(spark, [(1, "a", "en")], []) == brute([(1, "a", "en")], [])


@pytest.mark.parametrize("words, distinct, fails", [(199, 199, "A"), (200, 100, ""), (200, 99, "B"), (0, 0, "A")])
def test_limits_of_words(spark, words, distinct, fails):
    text = " ".join(f"w{i % max(distinct, 1)}" for i in range(words))
    row = spark.createDataFrame([(text,)], "t string").select(filters.text_mask(filters.F.col("t"))).first()
    assert row[0] == sum(1 << "ABCD".index(f) for f in fails)


def test_ranks_are_the_places_in_the_dictionary():
    assert [filters.rank(o) for o in filters.ORDERS] == list(range(120))


def test_intervals_cover_each_order_once():
    for mask in range(1, 32):
        steps = {}
        for step in range(1, 6):
            for start, end in filters.intervals(mask, step):
                for r in range(start, end):
                    assert r not in steps
                    steps[r] = step
        failed = [f for i, f in enumerate("ABCDE") if mask >> i & 1]
        assert steps == {r: min(o.index(f) for f in failed) + 1 for r, o in enumerate(filters.ORDERS)}

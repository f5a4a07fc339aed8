import hashlib
import re

import pytest
from pyspark.sql import functions as F

from gondola.llm import decontaminate as d

PASSAGE = "One two, three four five six seven eight nine ten eleven twelve"


def brute_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(rows, items):
    result = []
    for doc_id, text in rows:
        w, hit, found = brute_words(text), set(), set()
        for item_id, item in items:
            v = brute_words(item)
            size = min(10, len(v))
            if item_id is None or not v:
                continue
            windows = {tuple(v[i:i + size]) for i in range(len(v) - size + 1)}
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in windows:
                    hit.update(range(i, i + size))
                    found.add(str(item_id))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        result.append((doc_id, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(result, key=str)


ITEMS = [(1, PASSAGE), (10, "Short ITEM"), (2, ""), (3, None), (None, "alpha beta"), (4, PASSAGE), (4, PASSAGE), (5, "the the the"),
         (6, "école É x y z w v u t s r q"), (7, "absent word here")]
DOCS = [
    (1, f"noise {PASSAGE.upper()} noise"), (2, "two three four five six seven eight nine ten"), (3, None), (4, ""), (5, "the " * 40),
    (6, "short item short item, the item"), (None, f"x {PASSAGE}"), (1, "other text under one id, short-item"), (7, "alpha beta"),
    (8, "École É x y z w v u t s r q"), (9, "école É x y z w v u t s r q"), (1, f"noise {PASSAGE.upper()} noise"), (10, PASSAGE[:50]),
    (11, "one two three four five six seven eight nine twelve ten eleven"),
]


def frames(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").withColumn("key", F.lit("z")).withColumn("n_hit", F.lit(1))
    return docs, spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("window", F.lit(0))


def test_report_equals_brute_force(spark):
    docs, items = frames(spark)
    assert sorted(map(tuple, d.report(docs, items).collect()), key=str) == brute(DOCS, ITEMS)


def test_terms_in_several_passes(spark):
    docs, items = frames(spark)
    _, probed, index = d.search(docs, items)
    terms = probed.groupBy("term").agg((F.min("rank") == 0).alias("leads"))
    again = d.build_index(docs, terms, pass_terms=2)
    assert sorted(map(str, index.collect())) == sorted(map(str, again.collect()))


def test_stage_keeps_clean_rows(spark):
    docs, items = frames(spark)
    bad = {(i, t) for (i, t), row in zip(DOCS, [brute([r], ITEMS)[0] for r in DOCS]) if row[5]}
    left = d.uncontaminated(docs, items)
    assert left.columns == docs.columns
    assert sorted(str((r.doc_id, r.text)) for r in left.collect()) == sorted(str(r) for r in DOCS if r not in bad)


def test_proximity(spark):
    items = spark.createDataFrame([(1, "red green blue")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "blue red green"), (2, "red x green x blue"), (3, "green a b c d e f g h red i j k l m n o blue"), (4, "red")], "doc_id long, text string")
    _, probed, index = d.search(docs, items)
    exact = {r.doc_id for r in d.exact_matches(index, probed).collect()}
    near = {r.doc_id for r in d.proximity_matches(index, probed, 3).collect()}
    assert exact == set() and near == {1, 2}


@pytest.mark.parametrize("empty", ["docs", "items", "both"])
def test_empty_tables(spark, empty):
    docs, items = frames(spark)
    docs, items = docs.limit(0) if empty != "items" else docs, items.limit(0) if empty != "docs" else items
    rows = [] if empty != "items" else DOCS
    assert sorted(map(tuple, d.report(docs, items).collect()), key=str) == brute(rows, [])


def test_breaks_are_single_characters():
    assert "-" not in d.BREAKS
    assert all(bool(re.fullmatch(d.BREAKS, chr(c))) == (c < 128 and not chr(c).isalnum()) for c in range(0x3000))

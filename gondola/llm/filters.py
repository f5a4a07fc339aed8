"""How five document filters interact, over all 120 orders in which they can be applied.

A document is reduced to its mask, the set of filters it fails. In an order it is removed by
the first letter of the order that is in its mask. Orders are numbered by their Lehmer rank,
their place in the dictionary, and all orders that begin alike are neighbours: a prefix of
``step`` letters covers (5 - step)! ranks. So the orders in which a mask goes at a step are a
few intervals of ranks. Each interval adds the mask's count at its first rank and takes it
off behind its last; a prefix sum over the ranks then gives what each step of each order
removes, without applying any order to any document.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window, functions as F

from gondola.session import written

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: White space between words, as a class of a pattern and as single characters.
SPACE, SPACES = r"[\x20\x09-\x0D]+", " \t\n\x0b\f\r"
#: Fixed values of the filters: least words, least distinct words in 100, most capitals in 100 characters.
WORDS, DISTINCT, CAPITALS = 200, 50, 3
SIGNS = r"[#$%&*|]"
COPY = 1 << FILTERS.index("E")


def rank(order: str) -> int:
    """The Lehmer rank: for each letter, how many smaller ones are left, in factorial base."""
    left, result = sorted(order), 0
    for letter in order:
        place = left.index(letter)
        result += place * factorial(len(left) - 1)
        del left[place]
    return result


def intervals(mask: int, step: int) -> list[tuple[int, int]]:
    """Ranks [start, end) of the orders in which ``mask`` is removed at ``step`` (from 1), neighbours joined."""
    failed = [f for i, f in enumerate(FILTERS) if mask >> i & 1]
    passed = [f for f in FILTERS if f not in failed]
    width = factorial(len(FILTERS) - step)
    starts = sorted(
        rank("".join(before) + f + "".join(x for x in FILTERS if x not in before and x != f))
        for before in permutations(passed, step - 1) for f in failed
    )
    result: list[tuple[int, int]] = []
    for start in starts:
        if result and result[-1][1] == start:
            result[-1] = (result[-1][0], start + width)
        else:
            result.append((start, start + width))
    return result


def text_mask(text: Column) -> Column:
    """The failed filters A to D of a text as bits 0 to 3; the text must not be NULL."""
    trimmed = F.btrim(text, F.lit(SPACES))
    words = F.when(trimmed != "", F.split(trimmed, SPACE)).otherwise(F.array().cast("array<string>"))
    # Bound by a lambda, so that a text is split once.
    counted = F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    fails = F.transform(counted, lambda c: (
        F.when(c["n"] < WORDS, 1).otherwise(0)
        + F.when(c["d"].cast("long") * 100 < c["n"].cast("long") * DISTINCT, 2).otherwise(0)
    ))[0]
    return (
        fails
        + F.when(capitals.cast("long") * 100 > F.length(text).cast("long") * CAPITALS, 4).otherwise(0)
        + F.when(text.rlike(SIGNS), 8).otherwise(0)
    )


def mask_counts(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and by the set of filters they fail.

    ``docs`` (doc_id, text and the column ``part``), ``labels`` (doc_id, quality, toxic).
    Filter E fails where a smaller doc_id has the same text. Only the first of each text
    passes it, so all documents are counted as failing and the first ones are moved over:
    no group of copies, however large, comes together. NULL texts are empty texts, NULL
    parts the empty part. A NULL doc_id has no smaller one and is smaller than none, and has
    no label. Rows that repeat a doc_id count each; labels that repeat one count once, 1 if
    any says 1. Texts are the same if their SHA-256 is. No documents give no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        "doc_id", F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        text_mask(text).alias("mask"), F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    rows = rows.groupBy("doc_id", "part", "mask", "digest").agg(F.count("*").alias("n"))
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").alias("labelled")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    marked = rows.join(marks, F.col("doc_id") == F.col("labelled"), "left").drop("labelled")
    rows = written(marked.fillna(0, ["good", "toxic"]))
    first = rows.filter("doc_id is not null").groupBy(F.col("digest").alias("d")).agg(F.min("doc_id").alias("first"))
    first = rows.join(first, (F.col("digest") == F.col("d")) & (F.col("doc_id") == F.col("first")), "left_semi")
    copies = rows.withColumn("mask", F.col("mask") + F.when(F.col("doc_id").isNotNull(), COPY).otherwise(0))
    moved = first.withColumn("n", -F.col("n")).withColumn("mask", F.col("mask") + COPY)
    counts = copies.unionByName(moved).unionByName(first).groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic"),
    )
    return counts.filter("n > 0")


def _events(spark) -> DataFrame:
    """(mask, step, at, sign): where each mask's intervals begin and end; some hundred rows."""
    rows = [
        (mask, step, at, sign)
        for mask in range(1, 1 << len(FILTERS)) for step in range(1, len(FILTERS) + 1)
        for start, end in intervals(mask, step) for at, sign in ((start, 1), (end, -1))
    ]
    return spark.createDataFrame(rows, "mask int, step int, at int, sign int")


def interactions(counts: DataFrame) -> DataFrame:
    """What every step of every order removes, from the (part, mask, n, good, toxic) of ``mask_counts``.

    One row per part, order and step: filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley. No part has more than 600 rows.
    """
    counts = written(counts)
    measures = ["n", "good", "toxic"]
    steps = F.sequence(F.lit(1), F.lit(len(FILTERS)))
    ranks = F.sequence(F.lit(0), F.lit(len(ORDERS) - 1))
    grid = counts.select("part").distinct().select("part", F.explode(steps).alias("step")).select(
        "part", "step", F.explode(ranks).alias("at"), *[F.lit(0).cast("long").alias(m) for m in measures]
    )
    changes = counts.join(_events(counts.sparkSession), "mask").select(
        "part", "step", "at", *[(F.col(m) * F.col("sign")).alias(m) for m in measures]
    )
    changes = changes.unionByName(grid).groupBy("part", "step", "at").agg(*[F.sum(m).alias(m) for m in measures])
    along = Window.partitionBy("part", "step").orderBy("at")
    removed = changes.select("part", "step", "at", *[F.sum(m).over(along).alias(m) for m in measures])
    order = F.array(*map(F.lit, ORDERS))[F.col("at")]
    removed = removed.filter(F.col("at") < len(ORDERS)).withColumn("filter_order", order)
    removed = removed.withColumn("letter", F.substring("filter_order", F.col("step"), F.lit(1)))

    letters = F.explode(F.array(*[
        F.struct(F.lit(f).alias("letter"), F.col("mask").bitwiseAND(1 << i).alias("bit")) for i, f in enumerate(FILTERS)
    ])).alias("f")
    failing = counts.select("part", "mask", "n", letters).groupBy("part", F.col("f.letter").alias("letter")).agg(
        F.sum(F.when(F.col("f.bit") > 0, F.col("n")).otherwise(0)).alias("failing"),
        F.sum(F.when(F.col("f.bit") == F.col("mask"), F.when(F.col("f.bit") > 0, F.col("n"))).otherwise(0)).alias("unique_fails"),
    )
    totals = counts.groupBy("part").agg(F.sum("n").alias("all"))
    so_far = Window.partitionBy("part", "at").orderBy("step")
    of_letter = Window.partitionBy("part", "letter")
    return removed.join(failing, ["part", "letter"]).join(totals, "part").select(
        "part", "filter_order", "step",
        (F.col("all") - F.sum("n").over(so_far)).alias("kept"), F.col("n").alias("removed"),
        (F.col("failing") - F.col("n")).alias("redundant"), "unique_fails",
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"),
        F.sum("n").over(of_letter).alias("shapley"),
    )


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``interactions`` of the documents by language."""
    return interactions(mask_counts(docs, labels))

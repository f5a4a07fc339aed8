"""Benchmark passages in documents, found through a positional inverted index.

The index holds, for a term, the documents and word positions where it stands, and for terms
that lead a window also the words around. It is built for the rarest terms of the test
windows by their counts in the whole corpus. The lists of a window's rarest terms are
intersected with their offsets taken off, so that equal starts meet; what remains is compared
word by word with the kept surroundings, which gives exact phrases. Lists that meet within a
few words instead give proximity matches.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from gondola.session import written

WINDOW = 10
#: The rarest terms of a window whose lists are intersected.
PROBES = 2
#: Terms that one pass over the documents may broadcast; more terms take more passes.
PASS_TERMS = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: ASCII but letters and digits, character by character: Java looks these up in a table, but tries ranges one after the other.
BREAKS = "[" + "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isalnum()) + "]+"


def words(text: Column) -> Column:
    """Runs of letters, digits and characters beyond ASCII, A-Z in lower case; NULL has none."""
    plain = F.coalesce(text.cast("string"), F.lit(""))
    # Where all is ASCII, lower does the same many times faster; it would alter letters beyond.
    lowered = F.when(F.octet_length(plain) == F.length(plain), F.lower(plain)).otherwise(F.translate(plain, UPPER, LOWER))
    return F.array_remove(F.split(lowered, BREAKS), "")


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), BREAKS), "")).cast("long")


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and a key that tells apart texts under one id; equal rows share both."""
    return docs.select("doc_id", "text", F.xxhash64("text").alias("key"))


def item_windows(items: DataFrame, width: int = WINDOW) -> DataFrame:
    """(item_id, window, terms): each item's distinct runs of ``width`` words, or all its words if fewer."""
    split = items.filter("item_id is not null").select("item_id", words(F.col("text")).alias("w")).filter("size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - width + 1, F.lit(1)))
    runs = split.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, width))).alias("terms"))
    return runs.select("item_id", F.xxhash64("terms").alias("window"), "terms").distinct()


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n): how often each of ``terms`` stands in all of ``docs``; none if never."""
    tokens = docs.select(F.explode(words(F.col("text"))).alias("term"))
    return tokens.join(terms, "term").groupBy("term").agg(F.count("*").alias("n"))


def probes(windows: DataFrame, counts: DataFrame, number: int = PROBES) -> DataFrame:
    """(window, terms, term, at, rank): the ``number`` rarest terms of each window, rarest first.

    Windows with a term that no document holds are left out, as they cannot occur.
    """
    runs = windows.select("window", "terms").distinct()
    placed = runs.select("window", "terms", F.posexplode("terms").alias("at", "term"))
    counted = placed.join(counts, "term", "left")
    best = F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "at", "term")))
    ranked = counted.groupBy("window", "terms").agg(best.alias("best")).filter("best[0].n > 0")
    ranked = ranked.select("window", "terms", F.posexplode(F.slice("best", 1, number)).alias("rank", "b"))
    return ranked.select("window", "terms", "b.term", "b.at", "rank")


def build_index(docs: DataFrame, terms: DataFrame, width: int = WINDOW, pass_terms: int = PASS_TERMS) -> DataFrame:
    """(term, doc_id, key, pos, first, around): the stored postings of ``terms`` (term, leads).

    ``pos`` counts words from 0. Where the term leads a window, ``around`` holds the words up
    to ``width`` - 1 away and ``first`` the position of the first of them.
    """
    passes = max(1, -(-terms.count() // pass_terms))
    split = _keyed(docs).select("doc_id", "key", words(F.col("text")).alias("w"))
    # The outer form, because the other adds a filter on the array's size, and so splits each text twice.
    tokens = split.select("doc_id", "key", "w", F.posexplode_outer("w").alias("pos", "term"))
    first = F.greatest(F.col("pos") - (width - 1), F.lit(0))
    around = F.when(F.col("leads"), F.slice("w", first + 1, F.col("pos") - first + width))
    part = F.pmod(F.xxhash64("term"), F.lit(passes))
    found = [
        tokens.join(F.broadcast(terms.filter(part == i)), "term").select(
            "term", "doc_id", "key", "pos", first.alias("first"), around.alias("around")
        )
        for i in range(passes)
    ]
    return written(reduce(DataFrame.unionByName, found))


def aligned(index: DataFrame, probed: DataFrame) -> DataFrame:
    """(window, doc_id, key, start, rank): postings with their probe's place in the window taken off."""
    hits = index.select("term", "doc_id", "key", "pos").join(probed.select("window", "term", "at", "rank"), "term")
    return hits.select("window", "doc_id", "key", (F.col("pos") - F.col("at")).alias("start"), "rank")


def exact_matches(index: DataFrame, probed: DataFrame) -> DataFrame:
    """(doc_id, key, window, start, size): each place where a whole window stands."""
    needed = probed.groupBy("window", "terms").agg(
        F.count("*").alias("needed"), F.max(F.when(F.col("rank") == 0, F.col("at"))).alias("lead_at"),
        F.max(F.when(F.col("rank") == 0, F.col("term"))).alias("term"),
    )
    seen = F.bit_or(F.expr("shiftleft(1, rank)")).alias("seen")
    met = aligned(index, probed).filter("start >= 0").groupBy("window", "doc_id", "key", "start").agg(seen)
    found = met.join(needed, "window").filter(F.bit_count("seen") == F.col("needed"))
    found = written(found.select(
        "window", "terms", "term", F.col("doc_id").alias("d"), F.col("key").alias("k"), "start",
        (F.col("start") + F.col("lead_at")).alias("at"),
    ))
    lead = index.filter("around is not null").select("doc_id", "key", "pos", "first", "around").distinct()
    same = (F.col("k") == F.col("key")) & (F.col("at") == F.col("pos")) & F.col("d").eqNullSafe(F.col("doc_id"))
    passage = F.slice("around", F.col("start") - F.col("first") + 1, F.size("terms"))
    checked = found.join(lead, same).filter(passage == F.col("terms"))
    return checked.select("doc_id", "key", "window", "start", F.size("terms").alias("size"))


def proximity_matches(index: DataFrame, probed: DataFrame, slop: int) -> DataFrame:
    """(doc_id, key, window, first_start, last_start): windows whose rarest terms all stand near
    each other: their starts lie in one run with steps of at most ``slop`` words."""
    order = Window.partitionBy("window", "doc_id", "key").orderBy("start")
    hits = aligned(index, probed)
    broken = F.coalesce(F.col("start") - F.lag("start").over(order) > slop, F.lit(True)).cast("int")
    runs = hits.withColumn("broken", broken).withColumn("run", F.sum("broken").over(order))
    needed = probed.groupBy("window").agg(F.count("*").alias("needed"))
    near = runs.groupBy("window", "doc_id", "key", "run").agg(
        F.min("start").alias("first_start"), F.max("start").alias("last_start"), F.count_distinct("rank").alias("ranks")
    )
    near = near.join(needed, "window").filter("ranks = needed")
    return near.select("doc_id", "key", "window", "first_start", "last_start")


def search(docs: DataFrame, items: DataFrame, width: int = WINDOW) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(windows of the items, probes, index of their rarest terms over all of ``docs``)."""
    windows = written(item_windows(items, width))
    terms = written(windows.select(F.explode("terms").alias("term")).distinct())
    counts = written(term_counts(docs, terms))
    probed = written(probes(windows, counts))
    lists = written(probed.groupBy("term").agg((F.min("rank") == 0).alias("leads")))
    return windows, probed, build_index(docs, lists, width)


def contamination(docs: DataFrame, items: DataFrame, width: int = WINDOW) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_hit, n_items, items (sorted
    ids as strings), contaminated.

    A word is hit if it lies in an occurrence of a window of ``items`` (item_id, text). NULL and
    empty texts have no words; items without an id or words find nothing; repeated rows are all
    returned, texts under one doc_id apart from each other. Other columns are ignored.
    """
    windows, probed, index = search(docs, items, width)
    found = written(exact_matches(index, probed))
    span = F.sequence(F.col("start"), F.col("start") + F.col("size") - 1)
    hit = found.groupBy("doc_id", "key").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set(span)))).cast("long").alias("n_hit")
    )
    named = found.select("doc_id", "key", "window").distinct().join(windows.select("window", "item_id"), "window")
    named = named.select("doc_id", "key", F.col("item_id").cast("string").alias("item")).distinct()
    listed = named.groupBy("doc_id", "key").agg(F.sort_array(F.collect_list("item")).alias("items"))
    same = F.col("k") == F.col("key")
    same = same & F.col("d").eqNullSafe(F.col("doc_id"))
    listed = listed.withColumnsRenamed({"doc_id": "d", "key": "k"})
    marks = written(hit.join(listed, same).drop("d", "k")).withColumnsRenamed({"doc_id": "d", "key": "k"})
    rows = _keyed(docs).select("doc_id", "key", word_count(F.col("text")).alias("n_words"))
    joined = rows.join(marks, same, "left")
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.col("n_hit").isNotNull().alias("contaminated"),
    )


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``contamination`` with the item list as a digest."""
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return contamination(docs, items).select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


def uncontaminated(docs: DataFrame, items: DataFrame, width: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any window of ``items``, all columns as they were.

    NULL and empty texts stay; rows that repeat a doc_id are judged each by its own text; no rows
    give no rows; other columns may have any names.
    """
    _, probed, index = search(docs, items, width)
    bad = written(exact_matches(index, probed).select("doc_id", "key").distinct())
    # In structs, so that no column of the documents clashes with these.
    bad = bad.select(F.struct("doc_id", "key").alias("bad"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    same = (F.xxhash64("row.text") == F.col("bad.key")) & F.col("bad.doc_id").eqNullSafe(F.col("row.doc_id"))
    return rows.join(bad, same, "left_anti").select("row.*")

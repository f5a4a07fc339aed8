"""Operators on small rows: invariants, skew, plans and brute-force comparisons."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from gondola.operators import dedup, dimensions, joins, numbering, promotion, quality, replace, schema
from gondola.sources import tables
from gondola.session import written
from workload.queries import chain_tagged
from gondola.plans import chain

from conftest import SF_DIR


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_headers(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`﻿ Año  de Fecha` int, `B c` int, Index int")
    assert schema.normalize_headers(df, "plain").columns == ["ano de fecha", "b c", "index"]
    assert schema.normalize_headers(df, "snake").columns == ["año_de_fecha", "b_c", "index"]
    assert schema.normalize_headers(df, "lower").columns == ["año  de fecha", "b c", "index"]
    assert schema.resolve_columns(df, ["b C", "Zeta"]) == {"b C": "B c", "Zeta": None}
    with pytest.raises(KeyError):
        schema.require_columns(df, ["zeta"])


def test_layout(spark):
    df = spark.createDataFrame([(1, "x")], "b int, extra string")
    assert schema.ensure_layout(df, ["a", "b"]).columns == ["a", "b"]
    assert schema.ensure_layout(df, ["a", "b"], keep_extras=True).columns == ["a", "b", "extra"]
    assert schema.ensure_layout(df, ["a"], defaults={"a": F.lit("-")}).first().a == "-"
    assert schema.put_first(df, ["extra", "none"]).columns == ["extra", "b"]


def test_missing_markers_in_numbers(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "x double")
    assert rows(schema.nan_to_null(df)) == [(1.0,), (None,), (None,)]


def test_keep_first_is_cut_before_the_shuffle(spark, plan_of):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v")).repartition(4)
    first = dedup.keep_first(df, ["k"], ["v"])
    assert rows(first) == [(0, 0), (1, 1), (2, 2)]
    assert plan_of(first).count("WindowGroupLimit") >= 2


def test_first_row_is_keep_first_and_computes_only_what_is_used(spark, plan_of):
    made = [(None, 2, "b", None), (None, 1, "c", 1.0), ("x", 3, "a", float("nan")), ("x", 3, "a", 0.5), ("y", None, None, 2.0), ("y", 0, "z", 2.0)]
    df = spark.createDataFrame(made, "v string, k int, w string, x double").repartition(3)
    for keys, order in ((["v"], ()), (["v"], ["x", "w", "k"]), (["k"], ["w"]), (["v", "k", "w", "x"], ())):
        first = dedup.first_row(df, keys, order)
        assert first.columns == df.columns
        assert repr(rows(first)) == repr(rows(dedup.keep_first(df, keys, order and [*order, "x", "v"])))
    counted = dedup.first_row(df, ["v"]).groupBy().count()
    assert counted.first()[0] == 3
    optimized = plan_of(counted).split("== Optimized Logical Plan ==")[1]
    assert "min(" not in optimized and "Window" not in optimized


def test_a_corrected_name_that_nothing_reads_costs_no_join(spark, plan_of):
    feed = spark.createDataFrame([(1, " a ", "L"), (2, "b", "M"), (3, None, None)], "id int, `nombre pdv` string, pdv_razon_social string")
    fixes = [("A", "l", "Zeta"), ("a", "L", "Alfa"), ("b", "other", "Beta")]
    mapping = spark.createDataFrame(fixes, "`Nombre PDV` string, PDV_RAZON_SOCIAL string, `Nombre PDV Correcto` string")
    named = joins.correct_store_names(feed, mapping)
    assert rows(named.select("id", "`nombre pdv`")) == [(1, "Alfa"), (2, "b"), (3, None)]
    optimized = plan_of(named.select("id", "pdv_razon_social")).split("== Optimized Logical Plan ==")[1]
    assert "Join" not in optimized


def test_keep_last(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, o int, v string")
    assert rows(dedup.keep_last(df, ["k"], ["o"])) == [("a", 2, "y"), ("b", 1, "z")]


FACT = [("a", 1), ("b", 2), ("b", 3), (None, 4), ("z", 5)]
DIM = [("a", 10), ("b", 20), ("b", 30), ("c", 40)]


def _tables(spark):
    return spark.createDataFrame(FACT, "k string, v int"), spark.createDataFrame(DIM, "d string, v int")


@pytest.mark.parametrize(
    "how, expected",
    [
        ("inner", {("a", "a"), ("b", "b")}),
        ("left", {("a", "a"), ("b", "b"), (None, None), ("z", None)}),
        ("right", {("a", "a"), ("b", "b"), (None, "c")}),
        ("outer", {("a", "a"), ("b", "b"), (None, None), ("z", None), (None, "c")}),
    ],
)
def test_validated_join(spark, how, expected):
    joined, unmatched = joins.validated_join(*_tables(spark), "k", "d", how, indicator="side")
    assert joined.columns == ["k", "v", "d", "v_dim", "side"]
    assert {(r.k, r.d) for r in joined.collect()} == expected
    assert {r.k for r in unmatched.collect()} == {None, "z"}
    assert joined.filter("k = 'b'").count() == 2  # the doubled dimension key does not multiply rows


def test_join_checks_its_arguments(spark):
    with pytest.raises(ValueError):
        joins.validated_join(*_tables(spark), "k", "d", "cross")
    with pytest.raises(KeyError):
        joins.validated_join(*_tables(spark), "nope", "d")


def test_small_dimension_is_broadcast_and_nothing_else(spark, plan_of):
    tagged = chain_tagged(spark, SF_DIR)
    plan = plan_of(chain.fact_rows(tagged))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan


def test_hot_key_of_a_shuffled_join_is_split(spark):
    """With a dimension too big to broadcast, a key with most of the rows is divided."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    saved = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
        fact = spark.range(60000, numPartitions=8).select(hot.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        dim = spark.range(30000).select(F.col("id").cast("string").alias("d")).union(spark.sql("select 'hot'"))
        joined = joins.validated_join(fact, dim, "k", "d", "left", indicator="side")[0]
        counted = joined.groupBy("side").agg(F.count("*").alias("count"), F.max("pad"))
        found = {r["side"]: r["count"] for r in counted.collect()}
        assert found["both"] == sum(1 for i in range(60000) if i % 3 == 0 or i < 30000)
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan and "skewed" in plan
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_key_flags_without_the_column_count_as_found(spark):
    df = spark.createDataFrame([("p1",), ("p2",)], "p string")
    products = spark.createDataFrame([("p1",), ("p1",)], "p string")
    stores = spark.createDataFrame([("s",)], "s string")
    flagged = joins.key_flags(df, stores, products, "s", "p")
    assert rows(flagged) == [("p1", True, True), ("p2", False, True)]
    ok, bad = joins.split_valid(flagged)
    assert ok.count() + bad.count() == df.count() and ok.columns == ["p"]


def test_remap_looks_both_values_up_by_the_original_id(spark):
    mapping = tables.store_id_mapping(
        spark.createDataFrame([(" 1", "2", "uno", 1), ("1", "3", "tres", 2), ("2", "9", "", 3), ("4", "nan", "x", 4)],
                              "`ID sucursal nuevo` string, id_sucursal_viejo string, Nombre string, orden int"), ["orden"])
    feed = spark.createDataFrame([("1", "a"), ("2 ", "b"), ("4", "c")], "id_sucursal string, nombre_local string")
    got = joins.remap_store_ids(feed, mapping, name_column="nombre_local")
    assert rows(got) == [("3", "tres", True), ("4", "c", False), ("9", "b", True)]
    assert rows(quality.remap_count(got)) == [(2, 3)]


def test_name_correction_passes_through_without_a_mapping(spark):
    feed = spark.createDataFrame([("x",)], "`nombre pdv` string")
    assert joins.correct_store_names(feed, None) is feed
    assert tables.store_name_mapping(feed) is None


def test_numbering_matches_brute_force_with_a_hot_group_and_copies(spark):
    data = [("hot" if i % 3 else f"g{i % 7}", i % 5, i) for i in range(4000)] + [("hot", 2, -1)] * 500
    df = spark.createDataFrame(data, "g string, o int, v int").repartition(8)
    numbered = numbering.running_total(df, ["o", "v"], ["g"])
    expected = {}
    for g, o, v in sorted(data):
        expected.setdefault(g, []).append((o, v))
    got = {}
    for r in numbered.collect():
        got.setdefault(r.g, []).append((r["index"], (r.o, r.v)))
    for g, items in got.items():
        items.sort()
        assert [i for i, _ in items] == list(range(1, len(items) + 1))
        assert [x for _, x in items] == expected[g]


def test_numbering_spreads_a_group_over_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the rows are few here
    try:
        numbered = numbering.running_total(spark.range(20000).select(F.lit("one").alias("g"), "id"), ["id"], ["g"])
        assert len(numbered.inputFiles()) > 4
        assert numbered.filter("index != id + 1").count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_row_ids(spark):
    got = numbering.run_row_ids(spark.range(5).toDF("n").repartition(3), ["n"], "S")
    assert rows(got) == [(i, f"{i}_S") for i in range(5)]


def test_numeric_profile_against_brute_force(spark):
    data = [(g, float((i * 37) % 101) / 4) for g in ("a", "b") for i in range(150 if g == "a" else 7)]
    got = {r.g: r for r in quality.numeric_profile(spark.createDataFrame(data + [("a", None)], "g string, x double"), "x", ["g"]).collect()}
    for g in ("a", "b"):
        xs = sorted(x for k, x in data if k == g)
        q = statistics.quantiles(xs, n=4, method="inclusive")
        assert got[g].n == len(xs) and got[g].min == xs[0] and got[g].max == xs[-1]
        assert [got[g].q25, got[g].q50, got[g].q75] == pytest.approx(q)
        assert got[g].mean == pytest.approx(statistics.mean(xs)) and got[g].std == pytest.approx(statistics.stdev(xs))


def test_bad_numbers_stop_a_strict_run(spark):
    df = spark.createDataFrame([(1, "5"), (2, "x"), (3, ""), (4, "1d"), (5, "x")], "i int, v string")
    assert rows(quality.bad_numbers(df, "v", ["i"])) == [(2, "x"), (4, "1d"), (5, "x")]
    with pytest.raises(ValueError, match="'i': 2"):
        quality.require_numbers(df, "v", ["i"], ["i"])
    quality.require_numbers(df.filter("i in (1, 3)"), "v", ["i"], ["i"])
    assert [tuple(r) for r in quality.top_values(df, "v", 1).collect()] == [("x", 2)]


def test_counters_add_up(spark):
    tagged = chain_tagged(spark, SF_DIR)
    for r in chain.counters(tagged).collect():
        assert r.rows_in >= r.product_matched >= r.store_matched
    total = chain.counters(tagged).agg(F.sum("rows_in")).first()[0]
    good = chain.fact_rows(tagged).count()
    assert good + chain.rejects(tagged).drop("reason").distinct().count() == total


def test_rejects_land_once_per_reason(spark):
    bad = spark.createDataFrame([(1, True, True), (2, False, False)], "i int, p boolean, s boolean")
    got = replace.rejects_by_reason(bad, {"p": "missing_product", "s": "missing_store"}).select("i", "reason")
    assert rows(got) == [(1, "missing_product"), (1, "missing_store"), (2, "other")]


def test_insert_if_absent(spark):
    existing = spark.createDataFrame([("a", "old")], "k string, v string")
    new = spark.createDataFrame([("a", "new"), ("b", "2"), ("b", "1")], "k string, v string")
    once = dimensions.insert_if_absent(existing, new, "k", ["v"])
    assert rows(once) == [("a", "old"), ("b", "1")]
    assert rows(dimensions.insert_if_absent(once, new, "k", ["v"])) == rows(once)
    assert rows(dimensions.insert_if_absent(None, new, "k", ["v"])) == [("a", "new"), ("b", "1")]


def test_promotion_twice_is_promotion_once(spark):
    dim = spark.createDataFrame([("1", "uno")], "ean string, producto string")
    queue = spark.createDataFrame(
        [("1.0", "x", "si"), ("2.0", " dos ", "TRUE"), ("2", "zz", "x"), ("3", "tres", "no"), (" ", "sin clave", "si")],
        "ean string, producto string, `Para escritura` string",
    )
    promoted = promotion.promote(queue, dim, "ean")
    after = promoted.dimension_after(dim)
    assert rows(after) == [("1", "uno"), ("2", "dos")]
    assert rows(promotion.promote(queue, after, "ean").inserted) == []
    # What is not approved stays, and so does an approved row that has no key.
    assert sorted(r.producto for r in promoted.remaining.collect()) == ["sin clave", "tres"]
    assert sorted(r.producto for r in promotion.promote(promoted.remaining, after, "ean").remaining.collect()) == ["sin clave", "tres"]


def test_a_queue_without_a_flag_has_nothing_approved(spark):
    queue = spark.createDataFrame([("1",)], "ean string")
    assert promotion.promote(queue, queue.limit(0), "ean").inserted.count() == 0


def test_queue_keys_are_unique_and_not_in_the_dimension(spark):
    tagged = chain_tagged(spark, SF_DIR)
    queue = chain.product_queue(tagged, ["producto", "ean", "categoria"])
    assert queue.count() == queue.select("ean").distinct().count() > 0
    assert not queue.filter("para_escritura").count()
    known = tagged.filter("has_product").select(F.col("`codigo de barras`").alias("ean")).distinct()
    assert queue.join(known, "ean").count() == 0


@pytest.mark.parametrize("left, right, kinds, joined", [
    (["5.00", "7.5"], ["5", "8"], ("decimal(10,2)", "decimal(10,0)"), 1),
    (["007", "x", "7.0"], ["7", "9"], ("string", "int"), 2),
    (["0", "1"], ["-0", "1"], ("double", "float"), 2),
    (["5", "6"], ["5", "7"], ("int", "bigint"), 1),
    (["5", "6"], ["5.5", "6"], ("int", "double"), 1),
    (["5.00000000001", "5.000", " +5e0 ", "-0.0"], ["5", "0"], ("string", "int"), 3),
    (["9007199254740993", "9007199254740992"], ["9007199254740992"], ("bigint", "double"), 1),
    (["1152921504606846976"], ["1152921504606846976"], ("bigint", "double"), 1),
    (["12345678901234567890123456789012345", "1e-40", "1e40"], ["12345678901234567890123456789012345"], ("string", "decimal(38,0)"), 1),
    (["99999999999999999999999999999999999999"], ["1.5", "1"], ("decimal(38,0)", "decimal(38,10)"), 0),
    (["12345678901234567890123456789", "1200.50"], ["12345678901234567890123456789", "1200.5"], ("decimal(38,2)", "decimal(38,5)"), 2),
    (["0.1", "1e400", "NaN", "2.50e1"], ["0.1", "25", "Infinity", "NaN"], ("string", "double"), 2),
    (["20769187434139310514121985316880384"], ["20769187434139310514121985316880384"], ("string", "double"), 1),
])
def test_keys_of_different_types(spark, left, right, kinds, joined):
    fact = spark.createDataFrame([(x,) for x in left], "k string").select(F.col("k").cast(kinds[0]).alias("k"))
    dim = spark.createDataFrame([(x,) for x in right], "k string").select(F.col("k").cast(kinds[1]).alias("d"))
    both, unmatched = joins.validated_join(fact, dim, "k", "d")
    assert both.count() == joined and unmatched.count() == len(left) - joined
    other, rest = joins.validated_join(dim, fact, "d", "k", dedup_dim=False)
    assert other.count() == joined and rest.count() <= len(right)


def test_keys_that_do_not_compare(spark):
    dates = spark.createDataFrame([(1,)], "i int").select(F.current_date().alias("k"))
    with pytest.raises(ValueError, match="do not compare"):
        joins.anti_by_key(dates, spark.createDataFrame([(1,)], "d int"), "k", "d")


def test_profile_of_any_doubles(spark):
    values = [i * 0.0011 for i in range(10)] + [float("nan"), None]
    got = quality.numeric_profile(spark.createDataFrame([(v,) for v in values], "x double"), "x").first()
    assert (got.n, got.min, got.max) == (10, 0.0, 9 * 0.0011)
    assert abs(got["mean"] - 0.00495) < 1e-12 and abs(got["std"] - 0.0033304) < 1e-6 and abs(got.q50 - 0.00495) < 1e-12
    huge = quality.numeric_profile(spark.createDataFrame([(1e17,), (3e17,), (float("inf"),)], "x double"), "x").first()
    assert huge.n == 3 and huge.q50 == 3e17 and huge.max == float("inf")


@pytest.mark.parametrize("few, bins", [(1 << 16, 4096), (3, 512)])
def test_quartiles_by_narrowing_histograms(spark, monkeypatch, few, bins, plan_of):
    monkeypatch.setattr(quality, "FEW", max(few, 2))
    monkeypatch.setattr(quality, "BINS", bins)
    rnd = random.Random(few)
    of = {
        "even": [float(i) for i in range(40)], "copies": [1.0] * 30 + [2.0] * 9, "one": [7.5], None: [-3.0, 4.0],
        "wide": [rnd.choice([-1, 1]) * 10 ** rnd.uniform(-300, 300) for _ in range(60)],
        "near": [1 + i * 2 ** -52 for i in range(20)] * 2, "ends": [float("inf"), float("-inf"), 0.0, -0.0, 5.0],
    }
    rows_ = [(g, v) for g, vs in of.items() for v in vs] + [("even", None), ("even", float("nan"))]
    got = quality.numeric_profile(spark.createDataFrame(rows_, "g string, v double"), "v", ["g"])
    assert "rangepartitioning" not in plan_of(got)
    found = {r.g: r for r in got.collect()}
    assert found.keys() == of.keys()
    for g, vs in of.items():
        vs = sorted(vs)
        assert (found[g].n, found[g].min, found[g].max) == (len(vs), vs[0], vs[-1])
        for q, name in ((1, "q25"), (2, "q50"), (3, "q75")):
            at, share = divmod(q * (len(vs) - 1), 4)
            low, high = vs[at], vs[min(at + (share > 0), len(vs) - 1)]
            assert found[g][name] == (low if low == high else low + (high - low) * (share / 4)), (g, name)


def test_one_block_is_numbered_by_several_tasks(spark):
    df = spark.range(5000).select(F.lit("/f").alias("source_file"), F.lit(0).cast("bigint").alias("source_block"), (F.col("id") * 3).alias("source_row"))
    got = numbering.file_order(written(df), bucket=300).withColumn("task", F.spark_partition_id())
    assert got.filter("index <> source_row div 3 + 1").count() == 0
    assert got.select("task").distinct().count() > 1


def test_numbers_in_file_order_without_a_range_sort(spark, plan_of):
    given = [(g, f, b, r) for f in ("/b", "/a") for b in (0, 100) for r in (7, 3, 5, 40) for g in ("x", "y", None) if (r + b) % 3 or g == "x"]
    df = spark.createDataFrame(given, "g string, source_file string, source_block bigint, source_row bigint").repartition(5)
    for group in (["g"], []):
        got = numbering.load_index(df, schema.SOURCE_ORDER, group, stored=True)
        want, seen = {}, {}
        for row in sorted(given, key=lambda x: (x[1], x[2], x[3], str(x[0]))):
            seen[row[0] if group else 0] = seen.get(row[0] if group else 0, 0) + 1
            want.setdefault(row if group else row[1:], set()).add(seen[row[0] if group else 0])
        for r in got.collect():
            assert r["index"] in want[tuple(r)[:4] if group else tuple(r)[1:4]]
        assert got.agg(F.count_distinct(*(["g"] if group else []), "index")).first()[0] <= len(given)
        assert "rangepartitioning" not in plan_of(got)

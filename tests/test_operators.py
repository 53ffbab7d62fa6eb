"""Operators against brute force on small random input."""

from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyhouse.operators.dedup import first_per_key
from tallyhouse.operators.joins import heavy_keys, optional_lookup, spread_join
from tallyhouse.operators.keys import assign_keys
from tallyhouse.operators.quantiles import quantile_per_group
from tallyhouse.operators.ranks import top_by_any

RANDOM = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
maybe_text = st.one_of(st.none(), st.sampled_from(["a", "b", "B", "", "ñ"]))
maybe_int = st.one_of(st.none(), st.integers(-3, 3))


def last(row):
    """NULLs after everything else."""
    return tuple((v is None, v) for v in row)


@RANDOM
@given(rows=st.lists(st.tuples(maybe_text, maybe_int, maybe_text), max_size=40))
def test_first_per_key(spark, rows):
    df = spark.createDataFrame(rows, "k string, d int, v string")
    expected = {}
    for k, d, v in sorted(rows, key=lambda r: last((r[1], r[0], r[2]))):
        expected.setdefault(k, (k, d, v))
    got = {tuple(r) for r in first_per_key(df, F.col("k"), ["d"]).collect()}
    assert got == set(expected.values())


@RANDOM
@given(rows=st.lists(st.tuples(maybe_text, maybe_int), max_size=60))
def test_assign_keys_are_dense_and_ordered(spark, store, rows):
    df = spark.createDataFrame(rows, "a string, b int").repartition(3)
    stored = store.save("work", "rows", df)
    keyed = assign_keys(stored, ["a", "b"], "sk", store, "t").collect()
    by_key = sorted(keyed, key=lambda r: r.sk)
    assert [r.sk for r in by_key] == list(range(1, len(rows) + 1))
    encoded = [last((r.a if r.a is None else r.a.encode(), r.b)) for r in by_key]
    assert encoded == sorted(encoded)
    assert Counter((r.a, r.b) for r in keyed) == Counter(rows)


def test_many_copies_are_spread_while_keys_are_assigned(spark, store):
    copies = store.save("work", "rows", spark.range(9000).select(F.lit("x").alias("a")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keyed = assign_keys(copies, ["a"], "sk", store, "t")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r.sk for r in keyed.collect()) == list(range(1, 9001))
    (parts,) = [p for p in store.files.names(f"{store.root}/work/_parts") if p.startswith("t_placed")]
    placed = spark.read.parquet(f"{store.root}/work/_parts/{parts}")
    part = F.col("_metadata.file_name")
    assert max(r["count"] for r in placed.groupBy(part).count().collect()) < 6000


def test_keys_follow_the_files_of_more_than_one_block(spark, store):
    rows = store.save("work", "rows", spark.range(1000).select((999 - F.col("id")).alias("a")))
    # Several files per task, which the reader splits and reads in any order.
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "70")
    try:
        keyed = assign_keys(rows, ["a"], "sk", store, "t")
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert {(r.a, r.sk) for r in keyed.collect()} == {(i, i + 1) for i in range(1000)}
    # The rows are written once, the offsets of their files beside them.
    kept = store.files.names(f"{store.root}/work/_parts")
    assert sorted(k.rsplit("-", 5)[0] for k in kept) == ["t_offsets", "t_placed"]


def test_optional_lookup_keeps_every_row(spark):
    rows = [(i, None if i % 3 == 0 else f"k{i % 5}") for i in range(60)]
    facts = spark.createDataFrame(rows, "id int, k string")
    dim = spark.createDataFrame(
        [("k1", 1), ("k2", 2), ("k2", 22), (None, 9)], "name string, sk int"
    )
    got = Counter(map(tuple, optional_lookup(facts, dim, "k", "name", "id").collect()))
    found = {"k1": [1], "k2": [2, 22]}
    expected = Counter((i, k, sk) for i, k in rows for sk in found.get(k, [None]))
    assert got == expected


def test_optional_lookup_spreads_rows_without_key(spark):
    facts = spark.range(4000).select("id", F.lit(None).cast("string").alias("k"))
    dim = spark.createDataFrame([("x", 1)], "name string, sk int")
    joined = optional_lookup(facts, dim.hint("merge"), "k", "name", "id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 2
    assert max(r["count"] for r in sizes) < 3000


def lines_of_a_hot_product(spark, store, hot_rows):
    """Rows with one key in half of them, stored; some keys have two partners, one has none."""
    hot = spark.range(hot_rows).select(F.lit("hot").alias("k"), F.lit(1).alias("v"))
    cold = spark.range(hot_rows).select(F.concat(F.lit("k"), F.col("id") % 3000).alias("k"), F.lit(2).alias("v"))
    lines = store.save("work", "lines", hot.unionAll(cold).repartition(4))
    partners = [("hot", 1), ("hot", 2), (None, 3), ("none", 4)] + [(f"k{i}", i) for i in range(2990)]
    return lines, spark.createDataFrame(partners, "k string, sk int")


def test_a_heavy_key_is_dealt_to_many_tasks(spark, store):
    lines, dim = lines_of_a_hot_product(spark, store, 30_000)
    assert heavy_keys(lines, "k") == ["hot"]
    settings = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = spread_join(lines, dim, "k")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        plain = lines.join(dim, "k")
        alone = [r["count"] for r in plain.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(sizes) == 16 and max(sizes) <= 3 * sorted(sizes)[8]
    assert max(alone) > 3 * sorted(alone)[8]
    assert Counter(map(tuple, joined.collect())) == Counter(map(tuple, plain.collect()))
    assert joined.columns == plain.columns


def test_without_heavy_keys_the_join_is_plain(spark, store):
    rows = [(f"k{i % 60}", i) for i in range(600)] + [(None, -1)] * 900
    lines = store.save("work", "lines", spark.createDataFrame(rows, "k string, v int"))
    dim = spark.createDataFrame([(f"k{i}", i) for i in range(50)] + [(None, 0)], "k string, sk int")
    assert heavy_keys(lines, "k") == []
    assert heavy_keys(lines.limit(0), "k") == []
    joined = spread_join(lines, dim, "k")
    assert Counter(map(tuple, joined.collect())) == Counter(map(tuple, lines.join(dim, "k").collect()))


def test_planning_twice_leaves_the_first_plan_readable(spark, store):
    rows = store.save("work", "rows", spark.range(50).select(F.col("id").alias("a")))
    first = assign_keys(rows, ["a"], "sk", store, "t")
    again = assign_keys(rows, ["a"], "sk", store, "t")
    assert first.count() == again.count() == 50
    prices = rows.select(F.lit("g").alias("g"), F.col("a").cast("decimal(24,2)").alias("v"))
    halves = [quantile_per_group(prices, "g", "v", 0.5, "q", store, "t") for _ in range(2)]
    assert float(halves[0].first().q) == float(halves[1].first().q) == 24.5
    best = [top_by_any(rows, {"r": "a"}, 3, store, "t") for _ in range(2)]
    assert best[0].count() == best[1].count() == 3


def test_missing_measures_share_the_first_place(spark, store):
    rows = [(1, 100, None), (2, 5, 50), (3, 4, 40), (4, 3, 30)]
    df = spark.createDataFrame(rows, "id int, u bigint, m bigint")
    got = top_by_any(df, {"ru": "u", "rm": "m"}, 2, store, "t").collect()
    assert {(r.id, r.ru, r.rm) for r in got} == {(1, 1, 1), (2, 2, 2)}
    # With three places the third row is in by either measure.
    got = top_by_any(df, {"ru": "u", "rm": "m"}, 3, store, "t").collect()
    assert {r.id for r in got} == {1, 2, 3}


measure = st.one_of(st.none(), st.integers(0, 6))
measures = st.lists(st.tuples(measure, measure), min_size=1, max_size=40)


@RANDOM
@given(rows=measures, wide=st.booleans())
def test_top_by_any_equals_brute_force(spark, store, rows, wide):
    scale = 1 << 43 if wide else 1

    def wider(v):
        return None if v is None else v * scale

    data = [(i, wider(a), wider(b)) for i, (a, b) in enumerate(rows)]
    df = spark.createDataFrame(data, "id int, a bigint, b bigint")
    if wide:
        df = df.withColumn("b", (F.col("b") / 1000).cast("decimal(24,2)"))
    ranks = {"ra": "a", "rb": "b"}
    result = top_by_any(df, ranks, 3, store, "t")

    def place(values, v):
        return 1 + sum((x is None) > (v is None) or (None not in (x, v) and x > v) for x in values)

    by_a, by_b = [r[0] for r in rows], [r[1] for r in rows]
    expected = {
        (i, place(by_a, a), place(by_b, b))
        for i, (a, b) in enumerate(rows)
        if place(by_a, a) <= 3 or place(by_b, b) <= 3
    }
    assert {(r.id, r.ra, r.rb) for r in result.collect()} == expected


cents = st.one_of(st.integers(-50, 50), st.integers(-(10**12), 10**12))


@RANDOM
@given(
    groups=st.dictionaries(st.sampled_from("VEJ"), st.lists(cents, min_size=1, max_size=25), min_size=1),
    fraction=st.sampled_from([0.5, 0.0, 1.0, 0.25]),
)
def test_quantile_is_exact(spark, store, groups, fraction):
    rows = [(g, c) for g, values in groups.items() for c in values]
    df = spark.createDataFrame(rows, "g string, c bigint").select(
        "g", (F.col("c") / 100).cast("decimal(24,2)").alias("v")
    )
    got = {r.g: r.q for r in quantile_per_group(df, "g", "v", fraction, "q", store, "t").collect()}
    assert set(got) == set(groups)
    for g, values in groups.items():
        expected = np.quantile(np.array(values, dtype=float), fraction) / 100
        assert float(got[g]) == pytest.approx(expected, rel=1e-9, abs=1e-9)

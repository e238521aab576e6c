"""Order-dependent, merging and matching operators, with one key holding most of the rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from adit.operators import aggregates, joins, merge, metrics, ordered


def skewed(spark, n=4000):
    """Nine of ten rows belong to one key; values have nulls."""
    return spark.range(n).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 70).cast("string"))).alias("k"),
        ((F.col("id") * 7919) % n).alias("o"),
        F.when(F.col("id") % 13 != 0, (F.col("id") % 17).cast("double")).alias("v"),
    ).repartition(7)


def test_row_numbers_equal_a_window(spark):
    df = skewed(spark)
    expected = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("o")))
    got = ordered.row_numbers(df, ["k"], ["o"])
    assert got.select("k", "o", "v", "rn").exceptAll(expected.select("k", "o", "v", "rn")).isEmpty()
    assert got.count() == expected.count()


def test_hot_key_is_spread_over_several_parts(spark):
    parts = ordered._ranged(skewed(spark).repartition(7), ["k"], ["o"]).where("k = 'hot'").groupBy("_part").count()
    assert parts.count() >= 1  # adaptive execution may merge small parts
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = ordered._ranged(skewed(spark), ["k"], ["o"]).where("k = 'hot'").groupBy("_part").count().collect()
        assert len(spread) >= 3 and max(r["count"] for r in spread) < 2000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_ids_continue_after_stored_rows(spark):
    ids = [r["id"] for r in ordered.assign_ids(skewed(spark, 50), "EQ", ["o"], start=7).orderBy("o").collect()]
    assert ids == [f"EQ-{i:05d}" for i in range(8, 58)]


def test_running_sum_is_the_same_both_ways(spark):
    df = skewed(spark)
    plain = ordered.running_before(df, ["k"], ["o"], F.col("v"), "s")
    chained = ordered.running_before(df, ["k"], ["o"], F.col("v"), "s")
    assert chained.select("k", "o", "s").exceptAll(plain.select("k", "o", "s")).isEmpty()
    assert chained.count() == df.count()


def test_depth_counts_missing_thickness_as_nothing(spark):
    layers = spark.createDataFrame([("d", 1, 2.0), ("d", 2, None), ("d", 3, 1.5)], "d string, o int, t double")
    rows = ordered.running_depth(layers, ["d"], ["o"], "t", F.lit(720.0)).orderBy("o").collect()
    assert [(r["depth_from_m"], r["depth_to_m"]) for r in rows] == [(720.0, 722.0), (722.0, None), (722.0, 723.5)]


def test_first_key_is_carried_forward_only(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("a", 3, "y"), ("b", 1, None)], "k string, o int, v string")
    got = {(r["k"], r["o"]): r["c"] for r in ordered.first_key_carry(df, ["k"], "o", "v", "c").collect()}
    assert got == {("a", 1): None, ("a", 2): "x", ("a", 3): "x", ("b", 1): None}


def test_merge_keeps_last_known_values(spark):
    df = spark.createDataFrame([("a", 1, "x", 1.0), ("a", 2, None, 2.0), ("b", 1, None, None)], "k string, n int, s string, d double")
    assert {tuple(r) for r in merge.merge_last_nonnull(df, ["k"], "n").collect()} == {("a", "x", 2.0), ("b", None, None)}


def test_keep_first_count_is_the_number_of_keys(spark):
    df = skewed(spark)
    first = merge.keep_first(df, ["k"], ["o"])
    assert first.count() == df.select("k").distinct().count()
    low = {r["k"]: r["o"] for r in df.groupBy("k").agg(F.min("o").alias("o")).collect()}
    assert {r["k"]: r["o"] for r in first.collect()} == low


def test_winners_are_chosen_without_sorting_rows(spark):
    """keep_first and merge_last_nonnull against plain Python, with hot keys, null keys, null orders and ties; no sort-based aggregate in the plans."""
    rnd = random.Random(8)
    rows = [(rnd.choice(["hot"] * 5 + ["a", "b", None]), rnd.choice([None, *range(9)]), rnd.choice([None, "x", "y" * 50]), rnd.choice([None, 1.5, 2.5]), rnd.randint(0, 3)) for _ in range(400)]
    df = spark.createDataFrame(rows, "k string, o int, t string, d double, _row int").repartition(5)
    first, merged = merge.keep_first(df, ["k"], ["o"]), merge.merge_last_nonnull(df, ["k"], "o")
    rank = lambda o: (o is not None, o or 0)
    for r in first.collect():
        mine = [x for x in rows if x[0] == r.k]
        assert tuple(r) in mine and rank(r.o) == min(rank(x[1]) for x in mine)
    assert merged.columns == ["k", "t", "d", "_row"] and sorted(str(r.k) for r in merged.collect()) == sorted({str(x[0]) for x in rows}) == sorted(str(r.k) for r in first.collect())
    for r in merged.collect():
        for c, name in ((2, "t"), (3, "d"), (4, "_row")):
            told = [(rank(x[1]), x[c]) for x in rows if x[0] == r.k and x[c] is not None]
            assert r[name] in {v for o, v in told if o == max(o for o, _ in told)}
    for plan in (first, merged):
        assert "SortAggregate" not in plan._jdf.queryExecution().executedPlan().toString()
    none = spark.createDataFrame([("a", 1, None, None, None)], df.schema)
    assert [tuple(r) for r in merge.merge_last_nonnull(none, ["k"], "o").collect()] == [("a", None, None, None)]


def km_between(a, b):
    (lat, lon), (lat0, lon0) = ([math.radians(x) for x in p] for p in (a, b))
    h = math.sin((lat - lat0) / 2) ** 2 + math.cos(lat) * math.cos(lat0) * math.sin((lon - lon0) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(1.0, h)))


PLACED = "i int, latitude double, longitude double, at_s bigint, is_near int"


@pytest.mark.parametrize(("seconds", "km", "around"), [(1, 3.0, (49.8, 73.1)), (60, 40.0, (0.0, 179.9)), (500, 200.0, (89.0, 10.0)), (500, 900.0, (-85.0, -179.0)), (7, 9000.0, (20.0, 0.0)), (50, 30000.0, (0.0, 0.0))])
def test_near_events_against_brute_force(spark, seconds, km, around):
    """At the date line, the equator and the poles, with longitudes past 180, equal places, and rows without place or time."""
    rnd = random.Random(3)

    def points(n):
        out, size = [], 3 * km / 111
        for _ in range(n):
            lat, lon = around[0] + rnd.uniform(-size, size), around[1] + rnd.uniform(-size, size) * rnd.choice([1, 1, 20])
            out.append((max(-90.0, min(90.0, lat)), lon, rnd.randint(0, 30 * seconds)))
        return out

    inc, ev = points(150), points(40)
    ev += [(ev[0][0], ev[0][1], t) for t in range(0, 30 * seconds, max(1, seconds))]
    inc += [inc[0], (None, 1.0, 5), (1.0, None, 5), (1.0, 1.0, None), (91.0, 0.0, 5), (math.nan, 0.0, 5)]
    expected = [int(None not in (a, b, t) and abs(a) <= 90 and any(abs(t - u) <= seconds and km_between((a, b), (c, d)) <= km for c, d, u in ev)) for a, b, t in inc]
    got = joins.near_events(
        spark.createDataFrame([(i, *p, 7) for i, p in enumerate(inc)], PLACED), spark.createDataFrame([(0, *p, 7) for p in [*ev, (None, None, None)]], PLACED), seconds, km
    )
    near = [c for c in range(len(got.columns)) if got.columns[c] == "is_near"][-1]
    assert [r[near] for r in sorted(got.collect(), key=lambda r: r["i"])] == expected
    assert km > 1000 or 0 < sum(expected) < len(expected)


def test_a_million_events_in_one_cell(spark):
    """A swarm that all lies in one small cell, with as many incidents as fit beside and in it."""
    swarm = spark.range(1_000_000).select((F.lit(49.8) + F.col("id") / 1e9).alias("latitude"), F.lit(73.1).alias("longitude"), (F.col("id") % 100).alias("at_s"))
    inc = spark.range(20_000).select("id", (F.lit(49.8) + F.col("id") / 1e6).alias("latitude"), F.lit(73.1).alias("longitude"), F.lit(50).alias("at_s"))
    got = {r["id"]: r["is_near"] for r in joins.near_events(inc, swarm, 100, 1.0).collect()}
    ends = [(49.8, 73.1), (49.8 + 999_999 / 1e9, 73.1)]
    assert got == {i: int(min(km_between((49.8 + i / 1e6, 73.1), e) for e in ends) <= 1.0) for i in range(20_000)}
    assert 0 < sum(got.values()) < 20_000


def test_near_events_and_metrics_fit_a_driver(spark, tmp_path):
    """Steps are planned one by one, and nothing that grows with incidents or events is broadcast."""
    for name, df in {"inc": spark.range(50).withColumn("at_s", F.col("id") * 100), "ev": spark.range(50).withColumn("at_s", F.col("id") * 70)}.items():
        df.select(F.concat(F.lit("I"), "id").alias("incident_id"), (F.lit(49.8) + F.col("id") / 100).alias("latitude"), F.lit(73.1).alias("longitude"), "at_s").write.parquet(f"{tmp_path}/{name}")
    inc = spark.read.parquet(f"{tmp_path}/inc")
    near = joins.near_events(inc, spark.read.parquet(f"{tmp_path}/ev"), 100, 1.0)
    asked = inc.select("incident_id", F.lit(1).alias("fatalities"), F.lit(2).alias("injuries"), F.lit("3 тенге").alias("material_damage"))
    models, areas = metrics.blast_model(inc.select("incident_id", F.lit("").alias("text"))), inc.select("incident_id", F.lit(0).alias("is_primary_blast_zone"))
    found = metrics.incident_metrics(asked, models, areas, near.select("incident_id", F.col("is_near").alias("is_seismic_event")))
    for df in (near, found):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert len(plan) < 20_000 and df.count() == 50
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def cosine(a, b):
    dot, na, nb = sum(x * y for x, y in zip(a, b)), sum(x * x for x in a) ** 0.5, sum(x * x for x in b) ** 0.5
    return dot / (na * nb) if na and nb else 0.0


@pytest.mark.parametrize("min_cos", [0.65, 0.95, 0.0, -0.4])
def test_cosine_hits_do_not_depend_on_the_number_of_pivots(spark, min_cos):
    rnd = random.Random(5)
    vec = [(i, [rnd.uniform(-1, 1) for _ in range(6)]) for i in range(60)] + [(99, [0.0] * 6), (98, [math.nan] * 6), (97, None), (96, [1.0, None] * 3), (95, [1.0, 2.0])]
    cen = [(f"H{i}", [rnd.uniform(-1, 1) for _ in range(6)]) for i in range(9)] + [("Z", [0.0] * 6), ("N", None), ("S", [1.0, 2.1])]
    usable = lambda v: v and None not in v and not math.isnan(v[0]) and any(v)
    expected = {(i, h) for i, a in vec for h, b in cen if usable(a) and usable(b) and len(a) == len(b) and cosine(a, b) > min_cos}
    v, c = spark.createDataFrame([(*r, "x", 1) for r in vec], "i int, vec array<double>, unit string, _cell int"), spark.createDataFrame(cen, "hypotesis_id string, centroid array<double>")
    for pivots in (1, 3, 256):
        assert {(r["i"], r["hypotesis_id"]) for r in joins.semantic_facts(v, c, min_cos, pivots).collect()} == expected


def test_ten_thousand_centroids_form_few_pairs(spark):
    """Centroids in bundles, as topics are; every hit of brute force is found, most pairs are never formed."""
    rng = np.random.default_rng(6)
    bundles = rng.normal(size=(200, 32))
    near = lambda n, width: bundles[rng.integers(0, 200, n)] + width * rng.normal(size=(n, 32))
    cen, vec = near(10_000, 0.15), np.concatenate([near(250, 0.3), rng.normal(size=(50, 32))])
    c = spark.createDataFrame([(f"H{i}", x) for i, x in enumerate(cen.tolist())], "hypotesis_id string, centroid array<double>")
    v = spark.createDataFrame(list(enumerate(vec.tolist())), "i int, vec array<double>")
    unit = lambda x: x / np.sqrt((x * x).sum(1, keepdims=True))
    hits = {(int(i), f"H{j}") for i, j in zip(*np.nonzero(unit(vec) @ unit(cen).T > 0.85))}
    assert {(r["i"], r["hypotesis_id"]) for r in joins.semantic_facts(v, c, 0.85).collect()} == hits and len(hits) > 5000
    pairs = joins.semantic_candidates(v, c, 0.85, 256).count()
    assert len(hits) <= pairs < 0.2 * 300 * 10_000


def test_centroid_is_the_mean(spark):
    v = spark.createDataFrame([("a", [1.0, 2.0]), ("a", [3.0, 6.0]), ("a", None), ("a", [1.0, None]), ("a", []), ("b", [0.0, 1.0]), (None, [2.0])], "k string, vec array<double>")
    got = aggregates.vector_centroid(v, "k")
    assert {r["k"]: list(r["centroid"]) for r in got.collect()} == {"a": [2.0, 4.0], "b": [0.0, 1.0], None: [2.0]}
    assert "Generate" not in got._jdf.queryExecution().executedPlan().toString()


def test_ambiguous_people_get_no_id(spark):
    staff = spark.createDataFrame([("E1", "Иванов", "Иван"), ("E2", "Иванов", "Игорь"), ("E3", "Петров", "Пётр")], "employee_id string, lastname string, firstname string")
    log = spark.createDataFrame([("Иванов И.И.",), ("Петров П.С.",), (None,)], "issued_to string")
    assert {r["issued_to"]: r["employee_id"] for r in joins.attach_employee(log, staff).collect()} == {"Иванов И.И.": None, "Петров П.С.": "E3", None: None}


def test_certificate_lookup_uses_serial_when_stated(spark):
    fleet = spark.createDataFrame([("FFC-8", "7", "EQ-1"), ("FS", None, "EQ-2")], "model string, serial_number string, equipment_id string")
    certs = spark.createDataFrame([("FFC-8", "7"), ("FFC-8", None), ("FS", "9"), (None, "7")], "model string, serial_number string")
    got = {(r["model"], r["serial_number"]): r["equipment_id"] for r in joins.attach_equipment(certs, fleet).collect()}
    assert got == {("FFC-8", "7"): "EQ-1", ("FFC-8", None): "EQ-1", ("FS", "9"): None, (None, "7"): None}


def test_summary_counts_a_file_once(spark):
    rows = [("f1", "a", "ok", 3), ("f1", "b", "failed", 0), ("f2", "a", "failed", 0)]
    got = aggregates.processing_summary(spark.createDataFrame(rows, "source_file string, table_name string, status string, records bigint"))
    assert {r["table_name"]: tuple(r)[1:] for r in got.collect()} == {"a": (2, 1, 1, 3), "b": (1, 0, 1, 0), None: (2, 1, 1, 3)}

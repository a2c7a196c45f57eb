"""Polygons by cells, merged sketches, nested roll-ups and split writes against plain versions."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tideline.functions import spatial
from tideline.operators import polygons, relate, sketches
from tideline.operators.catalog import Catalog
from tideline.plans import feeds
from tideline.session import scratch
from tideline.sources import sinks

RINGS = "k int, rings array<array<struct<x: double, y: double>>>"


def odd(x, y, rings):
    n = 0
    for ring in rings or []:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                n += 1
    return n % 2 == 1


def star(rng, x, y, size, n):
    return [(x + r * math.cos(a), y + r * math.sin(a)) for i in range(n) for a, r in ((2 * math.pi * i / n, size * rng.uniform(0.2, 1)),)]


@pytest.mark.parametrize("res", [5, 7])
def test_points_in_polygons_against_the_rule(spark, res):
    rng = random.Random(res)
    size = 1.0 if res == 5 else 0.05
    shapes = [[star(rng, rng.uniform(-3, 3) * size, rng.uniform(-2, 2) * size, size, rng.randint(3, 9))] for _ in range(6)]
    shapes += [[star(rng, 0, 0, 2 * size, 12), star(rng, 0, 0, size, 5), [(0.1 * size, 0.1 * size)]]]  # a hole and a ring of one point
    shapes += [[[(-180.0, -90.0), (-179.0, -90.0), (-179.0, -89.5), (-180.0, -89.5), (-180.0, -90.0)]], [[(179.5, 89.0), (180.0, 89.0), (180.0, 90.0), (179.5, 90.0)]], [], None, [[]]]
    table = spark.createDataFrame([(k, s) for k, s in enumerate(shapes)], RINGS)
    points = [(i, rng.uniform(-3, 3) * size, rng.uniform(-4, 4) * size) for i in range(3000)] + [(3000, -89.8, -179.5), (3001, 89.9, 179.9), (3002, None, 1.0), (3003, 90.0, 180.0)]
    points += [(4000 + i, y, x) for i, (x, y) in enumerate(p for s in shapes[:8] for ring in s for p in ring)]  # corners themselves
    got = {(r.id, r.k) for r in polygons.points_in_polygons(spark.createDataFrame(points, "id int, lat double, lon double"), "lat", "lon", table, "k", res).collect()}
    assert got == {(i, k) for i, lat, lon in points if lat is not None for k, s in enumerate(shapes) if odd(lon, lat, s)}
    assert len({k for _, k in got}) >= 8


def test_inner_cells_are_not_tested_and_nothing_loops(spark):
    square = spark.createDataFrame([(1, [[(-5.0, -5.0), (5.0, -5.0), (5.0, 5.0), (-5.0, 5.0)]])], RINGS)
    cells = polygons.cover(square, "k", 5)
    total, border = cells.count(), cells.where("edges is not null").count()
    assert border < 0.05 * total and cells.select("cell").distinct().count() == total
    assert cells.where("edges is not null").agg(F.max(F.size("edges"))).first()[0] <= 3
    points = spark.range(50).select((F.col("id") / 10.0).alias("lat"), F.lit(0.0).alias("lon"))
    plan = polygons.points_in_polygons(points, "lat", "lon", square, "k")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_infrastructure_of_a_region_and_split_writes(spark):
    rows = [("a", {"power": "line"}, [(1.0, 1.0)]), ("b", {"power": "line", "water": "dam"}, [(4.0, 4.0)]), ("c", {"water": "dam"}, [(1.5, 1.2), (9.0, 9.0), (2.0, 2.0)]), ("d", {}, [(1.0, 1.0)])]
    features = spark.createDataFrame(rows, "feature_id string, tags map<string, string>, coords array<struct<x: double, y: double>>")
    region = spark.createDataFrame([(0, [[(0.0, 0.0), (3.0, 0.0), (3.0, 3.0), (0.0, 3.0)]]), (1, [[(0.5, 0.5), (2.0, 0.5), (0.5, 2.0)]])], RINGS)
    rules, box = {"power": {"power": True}, "water": {"water": ["dam"]}, "none": {"x": True}}, (0, 0, 5, 5)
    inside = feeds.infrastructure_features(features, rules, ["power"], box, region)
    assert sorted((r.feature_id, r.category) for r in inside.collect()) == [("a", "power")]
    root = scratch(spark, "split")
    paths = sinks.write_split(feeds.infrastructure_features(features, rules, ["power"], box), root, "r1", "category", "osm", sort=["feature_id"])
    assert set(paths) == {"power", "water"} and sorted(r.feature_id for r in spark.read.parquet(paths["power"]).collect()) == ["a", "b"]
    report = {r.table: (r.rows, r.status) for r in Catalog(spark, scratch(spark, "catalog")).merge(root, "2024-01-01 00:00:00", publish=False).collect()}
    assert report == {"power": (2, "registered"), "water": (1, "registered")}
    with pytest.raises(ValueError, match="already"):
        sinks.write_split(inside, root, "r1", "category", "osm")
    for bad in (None, "a/b", ""):
        with pytest.raises(ValueError, match="no names"):
            sinks.write_split(spark.range(2).withColumn("category", F.lit(bad).cast("string")), scratch(spark, "split"), "r1", "category")


def test_rollup_merges_partial_results(spark):
    df = spark.range(3000).select(((F.col("id") * 37) % 179 - 89.5).alias("lat"), ((F.col("id") * 91) % 359 - 179.5).alias("lon"), F.when(F.col("id") % 7 > 0, F.col("id") % 100).alias("v"))
    df = df.unionByName(spark.createDataFrame([(None, 1.0, 5), (None, 2.0, None)], "lat double, lon double, v bigint"))
    aggregates = {"n": ("count", "*"), "some": ("count", "v"), "total": ("sum", "v"), "low": ("min", "v"), "high": ("max", "v"), "mean": ("avg", "v")}
    got = {(r.res, r.cell): tuple(r)[2:] for r in relate.rollup_cells(df, "lat", "lon", [5, 9, 7], **aggregates).collect()}
    expected = {}
    for res in (5, 7, 9):
        for r in df.groupBy(spatial.cell_id(F.col("lat"), F.col("lon"), res).alias("cell")).agg(F.count("*"), F.count("v"), F.sum("v"), F.min("v"), F.max("v"), F.avg("v")).collect():
            expected[res, r.cell] = tuple(r)[1:]
    assert got == expected
    plan = relate.rollup_cells(df, "lat", "lon", [5, 9], n=("count", "*"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.rindex("Aggregate")  # cells are repeated after rows are summed


def test_sketches_merge_within_their_errors(spark):
    df = spark.range(40_000).select("id", (F.col("id") % 977).alias("few"), F.when(F.col("id") % 4 > 0, F.sqrt(F.col("id"))).alias("root"), F.concat(F.lit("s"), F.col("id") % 5000).alias("text"), (F.col("id") % 6).alias("part"), F.lit(None).cast("double").alias("none"))
    columns = ["few", "root", "text", "none"]
    out = {r.column_name: r for r in sketches.merged(sketches.sketch(df, columns, "part")).collect()}
    plain = {r.column_name: r for r in relate.summarize(df.drop("text"), ["few", "root"]).collect()}
    for c in ("few", "root"):
        a, b = out[c], plain[c]
        assert (a.min, a.max, a["count"], a.null_percentage) == (b.min, b.max, b["count"], b.null_percentage)
        assert math.isclose(a.avg, b.avg, rel_tol=1e-12) and math.isclose(a.std, b.std, rel_tol=1e-9)
        values = sorted(v for (v,) in df.select(F.col(c).cast("double")).where(f"{c} is not null").collect())
        for name, q in sketches.QUARTILES.items():
            low, high = (sum(v < a[name] for v in values) / len(values), sum(v <= a[name] for v in values) / len(values))
            assert low - 0.03 <= q <= high + 0.03
    for c, n in (("few", 977), ("text", 5000), ("root", 30_000)):
        assert abs(out[c].approx_unique - n) <= 0.05 * n
    assert out["text"].min is None and out["text"]["count"] == 40_000 and (out["none"].null_percentage, out["none"].q50, out["none"].std) == (100.0, None, None)
    nothing = sketches.merged(sketches.sketch(df.where("false"), ["few"])).first()
    assert (nothing["count"], nothing.min, nothing.q25) == (0, None, None)


def test_profile_reads_new_files_only(spark, monkeypatch):
    catalog, seen = Catalog(spark, scratch(spark, "catalog")), []
    sketch = sketches.sketch
    monkeypatch.setattr(sketches, "sketch", lambda df, columns, *by: (seen.append((sorted(df.inputFiles()), columns)), sketch(df, columns, *by))[1])
    catalog.add("s", "t", spark.range(100).repartition(3), "2024-01-01 00:00:00")
    assert catalog.profile("s", "t").first()["count"] == 100 and catalog.profile("s", "t").first()["max"] == 99.0
    assert len(seen) == 1 and len(seen[0][0]) == 3
    catalog.add("s", "t", spark.range(100, 150).select("id", F.col("id").alias("more")).coalesce(1), "2024-01-02 00:00:00")
    rows = {r.column_name: r for r in catalog.profile("s", "t").collect()}
    assert rows["id"]["count"] == 150 and rows["id"].max == 149.0 and rows["more"].null_percentage == round(10000 / 150, 2)
    assert sorted((len(f), c) for f, c in seen[1:]) == [(1, ["id", "more"]), (3, ["more"])]
    seen.clear()
    assert catalog.profile("s", "t", ["id"]).count() == 1 and not seen


def test_feeds_have_what_their_checks_name(spark, monkeypatch):
    """Every pipeline's tables have the columns of their checks; the tables are those of the registered queries."""
    from oracle import SF

    from tideline.queries import QUERIES

    made = {}

    def watch(name, fn):
        def run(*args, **options):
            out = fn(*args, **options)
            made.setdefault(name, {}).update({t: df.columns for t, df in out.items()})
            return out

        return run

    for name in feeds.CHECKS:
        monkeypatch.setattr(feeds, name, watch(name, getattr(feeds, name)))
    for name in QUERIES:
        if name.startswith("pipe_"):
            QUERIES[name](spark, SF)
    assert set(made) == set(feeds.CHECKS)
    for name, specs in feeds.CHECKS.items():
        assert set(specs) == set(made[name]), name
        for table, spec in specs.items():
            named = {*spec.get("unique_cols", []), *spec.get("not_null", []), *spec.get("bbox", ())[:2]}
            assert named <= set(made[name][table]) and not set(spec.get("forbidden", [])) & set(made[name][table]), (name, table)

"""Edge cases that the given tables do not show, on small fixtures."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tideline.functions import scalars, spatial
from tideline.operators import manifest as M
from tideline.operators import quality, raster, relate, shape
from tideline.operators.catalog import Catalog
from tideline.plans import feeds
from tideline.session import scratch
from tideline.sources import readers, sinks
from tideline.streaming import streams

RUN = "2024-02-01 06:00:00"


def column(spark, value, kind, expr):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(("lat", "lon"), [(90.0, 180.0), (-90.0, -180.0), (0.0, 0.0), (89.9999, 179.9999), (-33.3, 151.2)])
def test_cells_nest_and_hold_their_points(spark, lat, lon):
    p = spark.createDataFrame([(lat, lon)], "lat double, lon double")
    cells = spatial.with_cells(p, "lat", "lon", [5, 7, 8, 9, 10])
    for fine, coarse in ((10, 9), (9, 8), (8, 7), (7, 5), (10, 5)):
        assert cells.select(spatial.cell_parent(F.col(f"cell_r{fine}"), fine, coarse) == F.col(f"cell_r{coarse}")).first()[0]
    back = cells.select(spatial.cell_lat(F.col("cell_r9"), 9).alias("a"), spatial.cell_lon(F.col("cell_r9"), 9).alias("o")).first()
    assert abs(back.a - lat) <= 90 / 2**17 + 1e-9 and abs(back.o - lon) <= 180 / 2**18 + 1e-9
    text = cells.select(spatial.cell_from_text(spatial.cell_text(F.col("cell_r7"))) == F.col("cell_r7")).first()[0]
    assert text


def test_null_coordinates(spark):
    p = spark.createDataFrame([(None, 1.0), (1.0, None), (2.0, 3.0)], "lat double, lon double")
    assert [r.p is None for r in p.select(spatial.point(F.col("lon"), F.col("lat")).alias("p")).collect()] == [True, True, False]
    assert [r.c is None for r in p.select(spatial.cell_id(F.col("lat"), F.col("lon"), 5).alias("c")).collect()] == [True, True, False]
    assert shape.hilbert_sort(p, "lon", "lat").collect()[0].lat == 2.0


def test_hilbert_neighbours(spark):
    n = 1 << 4
    cells = spark.range(n * n).select((F.col("id") % n).alias("x"), F.floor(F.col("id") / n).alias("y"))
    lon, lat = F.col("x") / (n - 1) * 360 - 180, F.col("y") / (n - 1) * 180 - 90
    rows = cells.withColumn("h", spatial.hilbert_index(lon, lat, order=4)).orderBy("h").collect()
    assert [r.h for r in rows] == list(range(n * n))
    assert all(abs(a.x - b.x) + abs(a.y - b.y) == 1 for a, b in zip(rows, rows[1:], strict=False))


def test_envelope_is_strict_and_box_is_not(spark):
    df = spark.createDataFrame([(10.0, 20.0)], "lat double, lon double")
    assert df.where(spatial.in_bbox(F.col("lat"), F.col("lon"), (10, 20, 30, 40))).count() == 1
    assert df.where(spatial.within_envelope(spatial.point(F.col("lon"), F.col("lat")), 20, 10, 40, 30)).count() == 0


def test_lines_across_the_antimeridian(spark):
    line = [(179.0, 0.0), (-179.0, 0.0), (-178.0, 0.0)]
    df = spark.createDataFrame([(line,), ([],), (None,)], "line array<struct<x: double, y: double>>")
    first = df.select(spatial.line_length_km(F.col("line")).alias("l")).first().l
    assert first.skipped == 1 and 110 < first.km < 112
    assert df.count() == 3 and len(df.select(spatial.line_centroid(F.col("line"))).collect()) == 3


def test_numbers_and_texts(spark):
    rows = spark.createDataFrame([("-",), ("x",), ("about 5",), ("3.5",), (None,)], "v string")
    assert [r[0] for r in rows.select(scalars.number_or_null(F.col("v"), "-", "x")).collect()] == [None, None, None, 3.5, None]
    names = {"Türkiye": "TR", "Oman": "OM", "Muscat": "OM"}
    tag = lambda v: column(spark, v, "string", lambda c: scalars.keyword_tags([c], names))
    assert tag("News from TÜRKIYE, OMAN and Muscat") == "OM,TR" and tag("Romania") == "" and tag(None) == ""
    assert column(spark, "a|b", "string", lambda c: scalars.split_list(c, "|")) == ["a", "b"]
    assert column(spark, "usa", "string", lambda c: scalars.contains_any(c, ["sa"])) is True
    assert column(spark, "usa;sa", "string", lambda c: scalars.contains_any(c, ["us"], exact=True)) is False
    assert column(spark, "  ", "string", scalars.clean_empty) is None
    assert column(spark, "<p>a</p>", "string", scalars.strip_html) == "a"


def test_satellite_without_epoch_or_motion(spark):
    schema = "NORAD_CAT_ID bigint, OBJECT_NAME string, `group` string, EPOCH string, MEAN_MOTION double, INCLINATION double, RA_OF_ASC_NODE double, MEAN_ANOMALY double"
    t = "2024-01-01T00:00:00Z"
    rows = [(1, "a", "x", None, 15.0, 50.0, 10.0, 0.0), (2, "b", "x", t, 0.0, 50.0, 10.0, 0.0), (3, "c", "y", t, 15.0, 50.0, 350.0, 90.0), (3, "c", "x", t, 15.0, 50.0, 350.0, 90.0), (None, "d", "x", t, 15.0, 50.0, 0.0, 0.0), (4, None, "y", "2024-01-01T12:00:00", 1.0, None, None, None), (5, "e", "y", "soon", 1.0, 0.0, 0.0, 0.0)]
    out = {r.norad_cat_id: r for r in feeds.satellites(spark.createDataFrame(rows, schema), {"x": "X", "y": "Y"}, "2023-12-31 00:00:00", (-90, -180, 90, 180))["satellites"].collect()}
    assert set(out) == {1, 2, 3, 4, 5} and all(out[k].latitude_approx is None for k in (1, 2, 5)) and (out[3].group, out[3].group_label, out[4].object_name, out[4].classification) == ("x", "X", "", "U")
    for k, (motion, inc, node, anomaly, epoch) in {3: (15.0, 50.0, 350.0, 90.0, dt.datetime(2024, 1, 1)), 4: (1.0, 0.0, 0.0, 0.0, dt.datetime(2024, 1, 1, 12))}.items():
        seconds = (dt.datetime(2023, 12, 31) - epoch).total_seconds()
        u = (anomaly + 360 * motion * seconds / 86400) % 360
        lon = (node + u - seconds % scalars.SIDEREAL / scalars.SIDEREAL * 360) % 360
        lat = math.degrees(math.asin(math.sin(math.radians(inc)) * math.sin(math.radians(u))))
        axis = (scalars.MU * (86400 / motion / (2 * math.pi)) ** 2) ** (1 / 3)
        assert abs(out[k].latitude_approx - lat) < 1e-3 and abs(out[k].longitude_approx - (lon - 360 if lon > 180 else lon)) < 1e-3 and abs(out[k].altitude_km - axis + 6371) < 0.1


def test_quakes_without_depth(spark):
    doc = '{"features": [{"id": "a", "properties": {"mag": null, "place": "p", "time": 0}, "geometry": {"coordinates": [1.0, 2.0]}}]}'
    schema = "features array<struct<id: string, properties: struct<mag: double, place: string, time: bigint>, geometry: struct<coordinates: array<double>>>>"
    docs = spark.createDataFrame([(doc,)], "v string").select(F.from_json("v", schema).alias("d")).select("d.*")
    row = feeds.earthquakes(docs, RUN)["events"].first()
    assert row.depth_km is None and row.mag is None and row.latitude == 2.0 and row.updated_time is None and row.event_time == dt.datetime(1970, 1, 1)


def test_weather_arrays_of_unequal_length(spark):
    cities = spark.createDataFrame([("A", "x", 1.0, 2.0, 300_000), ("A", "x", 3.0, 4.0, 500_000), (None, "x", 0.0, 0.0, 900_000), ("B", "x", 0.0, 0.0, 10)], "city string, country_code string, latitude double, longitude double, population int")
    docs = spark.createDataFrame([("A", "x", (["2024-01-01T00:00", "2024-01-01T01:00"], [1.0]), (["2024-01-01"], [2.0]))], "city string, country_code string, hourly struct<time: array<string>, temperature: array<double>>, daily struct<time: array<string>, most: array<double>>")
    out = feeds.weather(cities, docs, RUN)
    hourly = sorted(out["weather_hourly"].select("time", "temperature", "latitude").collect())
    assert [tuple(r) for r in hourly] == [(dt.datetime(2024, 1, 1), 1.0, 3.0), (dt.datetime(2024, 1, 1, 1), None, 3.0)] and set(out) == {"weather_hourly", "weather_daily"}
    assert [(r.date, r.most, r.population, r.elevation) for r in out["weather_daily"].collect()] == [(dt.date(2024, 1, 1), 2.0, 500_000, 0.0)]


def test_raster_edges(spark):
    px = [("s", "vv", y, x, float(y * 3 + x)) for y in range(3) for x in range(3)]
    df = spark.createDataFrame(px, "scene string, band string, y bigint, x bigint, value double")
    means = {(r.y, r.x): r.value for r in raster.box_mean(df, ["value"], size=3).collect()}
    grid = lambda y, x: float(min(max(y if y < 3 else 5 - y, -1 - y), 2) * 3 + min(max(x if x < 3 else 5 - x, -1 - x), 2))
    for (y, x), m in means.items():
        assert m == pytest.approx(sum(grid(y + a, x + b) for a in (-1, 0, 1) for b in (-1, 0, 1)) / 9)
    flat = df.withColumn("value", F.lit(4.0))
    assert {r.value for r in raster.lee_filter(flat).collect()} == {4.0}
    one = df.withColumn("period", F.lit("pre")).unionByName(df.withColumn("period", F.lit("post")).withColumn("scene", F.lit("t")))
    assert {r.t for r in raster.welch_t(one).collect()} == {None}


def test_union_tolerant(spark):
    good = lambda: spark.range(3)
    missing = lambda: readers.scan_parquet(spark, scratch(spark, "none"))
    df, skipped = readers.union_tolerant([("a", good), ("b", missing)])
    assert df.count() == 3 and list(skipped) == ["b"]
    with pytest.raises(ValueError, match="no source"):
        readers.union_tolerant([("b", missing)])


def test_csv_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name\n1,"say ""hi"", you"\n2,"two\nlines"\n')
    rows = readers.scan_csv(spark, str(tmp_path / "a.csv"), "id int, name string", line_breaks=True).orderBy("id").collect()
    assert [r.name for r in rows] == ['say "hi", you', "two\nlines"]
    with pytest.raises(ValueError, match="no reader"):
        readers.read_any(spark, "x.xml")


def test_sinks_of_empty_tables(spark):
    empty, path = spark.range(0), scratch(spark, "empty")
    assert not sinks.write_table(empty, path, on_empty="skip")
    assert sinks.write_table(empty, path) and spark.read.parquet(path).columns == ["id"]


def test_wkb(spark):
    import struct

    df = spark.createDataFrame([(1.5, -2.5), (None, 1.0)], "x double, y double")
    got = [r.w for r in df.select(spatial.wkb_point(F.col("x"), F.col("y")).alias("w")).collect()]
    assert bytes(got[0]) == struct.pack("<BIdd", 1, 1, 1.5, -2.5) and got[1] is None


def test_catalog_versions(spark):
    catalog = Catalog(spark, scratch(spark, "catalog"))
    catalog.add("s", "t", spark.range(3), "2024-01-01 00:00:00")
    catalog.add("s", "t", spark.range(3, 5), "2024-01-02 00:00:00")
    catalog.add("s", "t", spark.range(1), "2024-01-03 00:00:00", mode="replace")
    count = lambda **k: catalog.table("s", "t", **k).count()
    assert (count(), count(version=2), count(version=1), count(ts="2024-01-02 12:00:00")) == (1, 5, 3, 5)
    before = sorted(r.id for r in catalog.table("s", "t", version=2).collect())
    assert catalog.rollback("s", "t", 2, "2024-01-04 00:00:00") == 4
    assert sorted(r.id for r in catalog.table("s", "t").collect()) == before
    catalog.compact("s", "t", "2024-01-05 00:00:00", order="id")
    assert sorted(r.id for r in catalog.table("s", "t").collect()) == before
    assert M.manifest_duplicates(catalog.manifest()).isEmpty()
    with pytest.raises(ValueError, match="no such table"):
        catalog.table("s", "gone")


def test_registering_twice_is_once(spark):
    empty = spark.createDataFrame([], M.MANIFEST)
    files = spark.createDataFrame([("s", "t", "p1", 10, 1), ("s", "t", "p2", 10, 1)], "schema string, table string, path string, bytes bigint, rows bigint")
    once = M.register_append(empty, files, RUN)
    assert once.count() == 2 and M.register_append(once, files, RUN).drop("stats").exceptAll(once.drop("stats")).isEmpty()


def test_prune_by_stats_keeps_unknown(spark):
    stats = spark.createDataFrame([("a", 0, 5), ("b", 6, 9), ("c", None, None)], "path string, min_x int, max_x int")
    assert {r.path for r in M.prune_files(stats, x=(7, 20)).collect()} == {"b", "c"}


def test_upsert_and_changes(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 5)], "k int, v string, t int")
    new = spark.createDataFrame([(1, "c", 1), (2, "d", 4), (3, "e", 0)], "k int, v string, t int")
    assert {(r.k, r.v) for r in relate.upsert(old, new, ["k"], "t").collect()} == {(1, "c"), (2, "b"), (3, "e")}
    changes = relate.table_changes(old, old.where("k = 1").unionByName(old.where("k = 1")))
    assert sorted((r.k, r.change) for r in changes.collect()) == [(1, "insert"), (2, "delete")]


def test_quality_report(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 5.0)], "k int, v double")
    spec = {"min_rows": 5, "max_null_pct": 50.0, "null_columns": ["v"], "unique_cols": ["k"], "required": ["k"], "forbidden": ["v"]}
    status = {r.check: r.status for r in quality.check(df, spec).collect()}
    assert status == {"min_rows": "fail", "max_null_pct:v": "fail", "unique": "fail", "required_columns": "pass", "forbidden_columns": "fail", "extra_columns": "warn"}
    with pytest.raises(ValueError, match="min_rows"):
        quality.enforce(quality.check(df, {"min_rows": 5}))
    empty = {r.check: r.status for r in quality.check(df.where("false"), {"min_rows": 0, "max_null_pct": 0.0}).collect()}
    assert set(empty.values()) == {"pass"}
    runs = spark.createDataFrame([("a", "success", 1), ("a", None, 2), ("b", "failure", 1)], "workspace string, conclusion string, run_started_at int")
    spaces = spark.createDataFrame([("a",), ("b",), ("c",)], "workspace string")
    assert {r.status: r.n for r in quality.run_status(spaces, runs).collect()} == {"running": 1, "failure": 1, "none": 1}


def test_tags(spark):
    df = spark.createDataFrame([("a", {"power": "plant", "telecom": "x"}), ("b", {"other": "y"}), ("c", {})], "feature_id string, tags map<string,string>")
    out = shape.classify_tags(df, {"energy": {"power": ["plant", "line"]}, "telecom": {"telecom": True}})
    assert sorted((r.feature_id, r.category) for r in out.collect()) == [("a", "energy"), ("a", "telecom")]


def test_stream_takes_new_files_only(spark):
    folder, target, checkpoint = (scratch(spark, n) for n in ("in", "out", "check"))
    spark.range(5).write.parquet(folder)
    stream = lambda: streams.arrivals(spark, folder, spark.range(0).schema)
    streams.ingest(stream(), target, checkpoint)
    streams.ingest(stream(), target, checkpoint)
    assert spark.read.parquet(target).count() == 5
    spark.range(5, 8).write.mode("append").parquet(folder)
    streams.ingest(stream(), target, checkpoint)
    assert sorted(r.id for r in spark.read.parquet(target).select("id").collect()) == list(range(8))


def test_zscore_without_spread(spark):
    df = spark.createDataFrame([(i, 1.0) for i in range(4)] + [(4, 2.0)], "t int, v double").withColumn("k", F.lit(1))
    assert {r.z for r in relate.zscore(df, ["k"], ["t"], "v", 3, F.floor(F.col("t") / 2)).collect()} == {None}


def test_zscore_over_blocks_of_any_size(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    rows = [(k, int(t), float(rng.normal())) for k in (1, 2, None) for t in sorted(rng.choice(400, 120, replace=False))]
    df = spark.createDataFrame(rows, "k int, t int, v double")
    for width in (1, 7, 100, 1000):
        got = {(r.k, r.t): r.z for r in relate.zscore(df, ["k"], ["t"], "v", 24, F.floor(F.col("t") / width)).collect()}
        assert len(got) == len(rows)
        for k in (1, 2, None):
            own = [(t, v) for key, t, v in rows if key == k]
            for i, (t, v) in enumerate(own):
                before = [x for _, x in own[max(0, i - 24) : i]]
                z = (v - np.mean(before)) / np.std(before, ddof=1) if len(before) > 1 else None
                assert got[k, t] == pytest.approx(z) if z is not None else got[k, t] is None


def test_states_and_changes_of_streams(spark):
    folder, target, checkpoint = (scratch(spark, n) for n in ("in", "out", "check"))
    expected = {}
    for n in range(7):
        rows = [(k, n, n * 10 + k) for k in range(n, n + 3)]
        spark.createDataFrame(rows, "k int, t int, v int").write.mode("append").parquet(folder)
        expected |= {k: v for k, _, v in rows}
        streams.latest_state(streams.arrivals(spark, folder, spark.createDataFrame([], "k int, t int, v int").schema), target, checkpoint, ["k"], ["t"], every=2)
        assert {r.k: r.v for r in streams.read_state(spark, target, ["k"], ["t"]).collect()} == expected
    assert streams._numbers(spark, target, "state") == [3, 5] and streams._numbers(spark, target, "changes") == [4, 5, 6]


def test_hash_sample(spark):
    df = spark.range(2000)
    one = {r.id for r in shape.hash_sample(df, ["id"], rows=100, seed=1).collect()}
    assert len(one) == 100 and one == {r.id for r in shape.hash_sample(df.repartition(7), ["id"], rows=100, seed=1).collect()}
    assert one != {r.id for r in shape.hash_sample(df, ["id"], rows=100, seed=2).collect()}
    assert 400 < shape.hash_sample(df, ["id"], share=0.25).count() < 600 and shape.hash_sample(df, ["id"], rows=5000).count() == 2000


def test_contains_join_of_many_codes(spark):
    texts = spark.createDataFrame([(1, "Lemon tree"), (2, "plain"), (3, None), (4, ""), (5, "MELON")], "id int, t string")
    codes = spark.createDataFrame([("emo",), ("elon",), ("zz",), (None,)], "code string")
    for most in (10, 1):
        assert {r.id for r in relate.semi_join_contains(texts, codes, "t", "code", most).collect()} == {1, 5}


def test_latest_partition(spark):
    path = scratch(spark, "releases")
    spark.range(6).select("id", F.when(F.col("id") < 4, "2024-01 a/b").otherwise("2024-02 c").alias("release")).write.partitionBy("release").parquet(path)
    assert {(r.id, r.release) for r in readers.scan_latest_partition(spark, path, "release").collect()} == {(4, "2024-02 c"), (5, "2024-02 c")}
    with pytest.raises(ValueError, match="no folder"):
        readers.scan_latest_partition(spark, path, "other")


def test_shared_folder_is_needed_on_a_cluster():
    from tideline import session

    class Conf:
        get = staticmethod(lambda *_: None)

    class Context:
        master = "spark://host:7077"
        getConf = staticmethod(lambda: Conf)

    class Session:
        conf, sparkContext = Conf, Context

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session)


def test_catalog_merge_expire_and_orphans(spark):
    lake, catalog = scratch(spark, "lake"), Catalog(spark, scratch(spark, "catalog"))
    put = lambda df, table, run: sinks.write_all({table: df}, lake, run, "s")
    status = lambda **k: {r.table: (r.version, r.rows, r.status.split(":")[0]) for r in catalog.merge(lake, **k).collect() if r.run is not None}
    put(spark.range(9), "r", "20231201"), put(spark.range(3), "a", "20240101"), put(spark.range(5), "r", "20240101"), put(spark.range(0), "e", "20240101")
    checks = {"*": {"min_rows": 1}}
    assert status(ts="2024-01-01 00:00:00", modes={"r": "replace"}, checks=checks) == {"a": (1, 3, "registered"), "r": (1, 5, "registered"), "e": (None, 0, "rejected")}
    assert status(ts="2024-01-01 01:00:00", modes={"r": "replace"}, checks=checks) == {"e": (None, 0, "rejected")}
    put(spark.range(3, 6).withColumn("more", F.lit("x")), "a", "20240201"), put(spark.range(2), "r", "20240201"), put(spark.range(1).select(F.lit("t").alias("id")), "b", "20240201")
    assert status(ts="2024-02-01 00:00:00", modes={"r": "replace"})["a"] == (2, 3, "registered")
    assert sorted((r.id, r.more) for r in spark.sql("select * from s_a").collect()) == [(0, None), (1, None), (2, None), (3, "x"), (4, "x"), (5, "x")]
    assert spark.table("s_r").count() == 2 and catalog.table("s", "r", version=1).count() == 5
    put(spark.range(1).select(F.lit("t").alias("id")), "a", "20240301")
    assert status(ts="2024-03-01 00:00:00", modes={"r": "replace"})["a"] == (None, 1, "rejected")
    assert catalog.expire("2024-01-15 00:00:00") == 0 and catalog.expire("2024-06-01 00:00:00") > 0 and catalog.expire("2024-06-01 00:00:00") == 0
    assert spark.table("s_a").count() == 6 and catalog.table("s", "r").count() == 2
    with pytest.raises(ValueError, match="no such"):
        catalog.table("s", "r", version=1)
    assert not any(r.status == "registered" for r in catalog.merge(lake, "2024-06-02 00:00:00", {"r": "replace"}, checks).collect())
    kept = {r.path for r in catalog.manifest().where("mode <> 'expired'").collect()}
    assert catalog.remove_orphans("2020-01-01 00:00:00", folder=lake) == 0 and catalog.remove_orphans("2100-01-01 00:00:00", folder=lake) > 0
    assert {r.path for r in readers.list_files(spark, lake, "*.parquet").collect()} == kept
    assert catalog.table("s", "a").count() == 6


def test_scratch_tables_can_be_cleared(spark):
    from tideline import session

    path = scratch(spark, "gone")
    spark.range(3).write.parquet(path)
    assert session.clear_scratch(spark) >= 1 and session.clear_scratch(spark) == 0
    where, fs = session.hadoop_path(spark, path)
    assert not fs.exists(where)

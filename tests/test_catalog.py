"""The catalog: which files a change reads, keeps and rewrites, and what it does when something fails half-way."""

import datetime as dt
import decimal
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tideline.operators import manifest as M
from tideline.operators import quality, relate
from tideline.operators.catalog import Catalog
from tideline.session import hadoop_path, scratch
from tideline.sources import footers, sinks
from tideline.streaming import streams

DAY = "2024-01-0{} 00:00:00".format


def new(spark):
    return Catalog(spark, scratch(spark, "catalog"))


def paths(catalog, table="t", **k):
    return {r.path for r in catalog.files("s", table, **k).select("path").collect()}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_footers_say_what_a_scan_says(spark):
    path = scratch(spark, "kinds")
    df = spark.range(2000).select(
        "id",
        (F.col("id") / 7 - 100).alias("d"),
        (F.col("id") % 13).cast("float").alias("f"),
        F.when(F.col("id") % 3 == 0, F.format_string("n%05d", "id")).alias("s"),
        F.date_add(F.lit(dt.date(1999, 1, 1)), F.col("id").cast("int")).alias("day"),
        F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 2 == 0).alias("b"),
        F.col("id").cast("decimal(20,3)").alias("m"),
        F.lit(None).cast("int").alias("none"),
        F.repeat(F.lit("x"), 500).alias("long"),
        F.array("id").alias("list"),
        F.struct("id").alias("nested"),
    )
    df.repartition(3).write.option("parquet.block.size", 4096).parquet(path)
    listed = [s.getPath().toString() for s in (lambda w, fs: fs.listStatus(w))(*hadoop_path(spark, path)) if s.getPath().getName().endswith(".parquet")]
    found = footers.read_footers(spark, listed)
    assert sum(f.rows for f in found) == 2000 and len(found) == 3
    assert all([(c.name, c.dataType) for c in spark.read.parquet(f.path).schema] == [(c.name, c.dataType) for c in StructType.fromJson(json.loads(f.columns))] for f in found)
    for f in found:
        assert set(f.stats) == {"id", "d", "f", "s", "day", "ts", "b", "m", "none"}
        own = spark.read.schema(df.schema).parquet(f.path)
        for c, (lo, hi, nulls) in f.stats.items():
            ends = own.agg(F.min(c), F.max(c), F.count_if(F.col(c).isNull())).first()
            kind = df.schema[c].dataType
            told = spark.range(1).select(F.lit(lo).cast(kind), F.lit(hi).cast(kind), F.lit(nulls)).first()
            assert tuple(told) == tuple(ends)


def test_footer_longer_than_the_first_read(spark, monkeypatch):
    path = scratch(spark, "wide")
    spark.range(3).select(*(F.col("id").alias(f"column_{k}") for k in range(300))).coalesce(1).write.parquet(path)
    monkeypatch.setattr(footers, "TAIL", 64)
    (f,) = footers.read_footers(spark, Catalog(spark, path)._files(path))
    assert f.rows == 3 and f.stats["column_299"] == ("0", "2", 0)


def test_tables_prune_files_by_bounds(spark):
    catalog = new(spark)
    df = spark.range(8000).select("id", (F.col("id") % 10).alias("k"), F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") / 100).cast("int")).alias("day"))
    catalog.add("s", "t", df.repartitionByRange(8, "id"), DAY(1))
    catalog.add("s", "t", spark.range(9000, 9010).coalesce(1), DAY(2))  # has no other columns
    whole = df.unionByName(spark.range(9000, 9010), allowMissingColumns=True)
    jobs = {"id": (2500, 2600), "day": (dt.date(2020, 3, 1), None), "k": (3, 3)}
    for where, most in (({"id": jobs["id"]}, 2), ({"day": jobs["day"]}, 5), ({"k": jobs["k"]}, 9), (jobs, 1), ({"id": (None, -1)}, 0), ({"id": (8_500, None)}, 1)):
        got = catalog.table("s", "t", where=where)
        assert len(catalog.files("s", "t", where=where).collect()) <= most and len(got.inputFiles()) <= most
        expected = whole
        for c, (lo, hi) in where.items():
            expected = expected if lo is None else expected.where(F.col(c) >= F.lit(lo))
            expected = expected if hi is None else expected.where(F.col(c) <= F.lit(hi))
        assert rows(got) == rows(expected)
    assert catalog.table("s", "t", where=F.col("id") == 7).count() == 1
    with pytest.raises(ValueError, match="no such"):
        catalog.table("s", "gone", where={"id": (1, 2)})


def test_registering_reads_no_data(spark):
    """Registration, pruning and counts take no job over the data: its files could be gone but for their footers."""
    catalog = new(spark)
    catalog.add("s", "t", spark.range(100).repartition(4), DAY(1))
    (total,) = M.count_from_metadata(catalog.manifest()).collect()
    assert total.n_rows == 100
    stats = M.file_stats(spark, sorted(paths(catalog)), ["id"])
    assert stats.agg(F.sum("rows"), F.min("min_id"), F.max("max_id")).first() == (100, 0, 99)
    assert "FileScan" not in stats._jdf.queryExecution().executedPlan().toString()


def test_upsert_rewrites_only_files_with_beaten_rows(spark):
    catalog = new(spark)
    old = spark.range(800).select("id", (F.col("id") * 2).alias("v"), F.lit(5).alias("t"))
    catalog.add("s", "t", old.repartitionByRange(8, "id"), DAY(1))
    before = paths(catalog)
    change = spark.createDataFrame([(3, -3, 6), (3, -4, 4), (410, -1, 4), (420, 840, 5), (790, -9, 5), (900, -7, 1), (None, 1, 1)], "id bigint, v bigint, t int")
    assert catalog.upsert("s", "t", change, ["id"], "t", DAY(2)) == 2
    expected = {(i, 2 * i, 5) for i in range(800)} - {(3, 6, 5), (790, 1580, 5)} | {(3, -3, 6), (790, -9, 5), (900, -7, 1), (None, 1, 1)}
    assert set(rows(catalog.table("s", "t"))) == expected and catalog.table("s", "t").count() == len(expected)
    assert len(before - paths(catalog)) == 2  # of eight
    now = catalog.manifest().count()
    assert catalog.upsert("s", "t", change, ["id"], "t", DAY(3)) is None and catalog.manifest().count() == now
    assert set(rows(catalog.table("s", "t", version=1))) == {(i, 2 * i, 5) for i in range(800)}
    # A column that the table lacks is added; inserts alone rewrite nothing.
    kept = paths(catalog)
    assert catalog.upsert("s", "t", spark.createDataFrame([(1000, 1, 1, "x")], "id bigint, v bigint, t int, note string"), ["id"], "t", DAY(4)) == 3
    assert kept < paths(catalog) and catalog.table("s", "t").where("note = 'x'").count() == 1
    assert catalog.upsert("s", "t", change.where("false"), ["id"], "t", DAY(5)) is None


def test_upsert_equals_the_plain_merge(spark):
    import random

    rng = random.Random(4)
    schema = "k int, j string, v int, t int"
    rows_of = lambda n: list({(r[0], r[1]): r for r in ((rng.choice([None, *range(12)]), rng.choice(["a", "b", None]), rng.randint(0, 3), rng.choice([None, 1, 2, 3])) for _ in range(n))}.values())
    for _ in range(2):
        catalog = new(spark)
        old = spark.createDataFrame(rows_of(20), schema)
        catalog.add("s", "t", old.repartition(3), DAY(1))
        for day in (2, 3):
            change = spark.createDataFrame(rows_of(9), schema)
            expected = {(r.k, r.j, r.t) for r in relate.upsert(catalog.table("s", "t").withColumn("o", F.coalesce("t", F.lit(-1))), change.withColumn("o", F.coalesce("t", F.lit(-1))), ["k", "j"], "o").collect()}
            catalog.upsert("s", "t", change, ["k", "j"], "t", DAY(day))
            assert {(r.k, r.j, r.t) for r in catalog.table("s", "t").collect()} == expected


def test_changes_read_only_what_differs(spark):
    catalog = new(spark)
    catalog.add("s", "t", spark.range(100).repartitionByRange(4, "id"), DAY(1))
    catalog.add("s", "t", spark.range(100, 110), DAY(2))
    appended = catalog.changes("s", "t", 1, 2)
    assert rows(appended) == [(i, "insert") for i in sorted(range(100, 110), key=lambda i: repr((i, "insert")))]
    assert "Except" not in appended._jdf.queryExecution().analyzed().toString() and set(appended.inputFiles()).isdisjoint(catalog.table("s", "t", version=1).inputFiles())
    catalog.upsert("s", "t", spark.createDataFrame([(5,), (200,)], "id bigint"), ["id"], "id", DAY(3))
    assert rows(catalog.changes("s", "t", 2)) == [(200, "insert")]
    catalog.rollback("s", "t", 1, DAY(4))
    assert sorted(r.change for r in catalog.changes("s", "t", 3).collect()) == ["delete"] * 11
    assert catalog.changes("s", "t", 1).isEmpty() and catalog.changes("s", "t", 1, 1).isEmpty()


def test_compact_merges_neighbours_only(spark):
    catalog = new(spark)
    big = spark.range(0, 60_000).select("id", F.xxhash64("id").alias("noise"))
    small = [big.where(f"id between {a} and {a + 99}").withColumn("id", F.col("id") + 100_000 + k * 1000) for k, a in enumerate(range(0, 500, 100))]
    for k, part in enumerate([*small[:3], big.coalesce(1), *small[3:]]):
        catalog.add("s", "t", part.coalesce(1), DAY(k + 1))
    whole, before = rows(catalog.table("s", "t")), {r.path: r.bytes for r in catalog.files("s", "t").collect()}
    large = max(before, key=before.get)
    version = catalog.compact("s", "t", DAY(7), target=before[large])
    now = paths(catalog)
    assert large in now and len(now) == 3 and rows(catalog.table("s", "t")) == whole
    assert catalog.compact("s", "t", DAY(8), target=before[large]) is None and paths(catalog, version=version - 1) == set(before)
    # Neighbours by a column, each file's rows in its order.
    assert catalog.compact("s", "t", DAY(9), target=1 << 30, order="id") == version + 1
    (one,) = paths(catalog)
    got = [r.id for r in spark.read.parquet(one).select("id", "_metadata.row_index").orderBy("row_index").collect()]
    assert got == sorted(got) and rows(catalog.table("s", "t")) == whole
    assert catalog.changes("s", "t", version).isEmpty()


def test_odd_paths_and_foreign_files(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    place = tmp_path / "a lake+%25" / "s" / "t" / "run=1 2"
    place.mkdir(parents=True)
    for k in range(3):
        pq.write_table(pa.table({"k": [k, k + 10], "m": [decimal.Decimal("1.50"), None], "t": [1, 1]}), place / f"part {k}+%.parquet")
    catalog = new(spark)
    assert [r.status for r in catalog.merge(str(tmp_path / "a lake+%25"), DAY(1), checks={"*": {"not_null": ["k"]}}).collect()] == ["registered"]
    assert catalog.upsert("s", "t", spark.createDataFrame([(10, None, 2)], "k bigint, m decimal(3,2), t bigint"), ["k"], "t", DAY(2)) == 2
    assert catalog.compact("s", "t", DAY(3)) == 3 and len(paths(catalog)) == 1
    assert rows(catalog.table("s", "t").select("k", "t")) == [(0, 1), (1, 1), (10, 2), (11, 1), (12, 1), (2, 1)]


def test_merge_after_compact_and_of_two_lakes(spark):
    catalog, lakes = new(spark), [scratch(spark, "zlake"), scratch(spark, "alake")]
    put = lambda lake, n, run, table="t": sinks.write_all({table: spark.range(n)}, lakes[lake], run, "s")
    merged = lambda lake: [(r.status.split(":")[0], r.run) for r in catalog.merge(lakes[lake], DAY(1), {"t": "replace"}, publish=False).collect()]
    put(0, 10, "20240101")
    put(0, 7, "20231231")
    assert merged(0) == [("skipped", None), ("registered", "20240101")]
    catalog.add("s", "other", spark.range(1), DAY(1))
    put(0, 4, "20240101-b")
    assert merged(0) == [("skipped", None), ("registered", "20240101-b")] and catalog.table("s", "t").count() == 4
    put(0, 20, "20240102")
    catalog.compact("s", "t", DAY(2))
    assert ("registered", "20240102") in merged(0) and catalog.table("s", "t").count() == 20
    put(1, 3, "20230101")  # another source: its runs are not compared with the first one's
    assert merged(1) == [("registered", "20230101")] and catalog.table("s", "t").count() == 3
    put(0, 5, "20240101-c")
    assert all(s == "skipped" for s, _ in merged(0)) and catalog.table("s", "t").count() == 3
    spark.range(20, 25).write.mode("append").parquet(f"{lakes[1]}/s/t/20230101")  # late files of the registered run
    assert merged(1) == [("registered", "20230101")] and catalog.table("s", "t").count() == 8


def test_expired_files_are_not_found_anew(spark):
    catalog, lake = new(spark), scratch(spark, "lake")
    for run in ("r1", "r2"):
        sinks.write_all({"t": spark.range(5).withColumn("run", F.lit(run))}, lake, run, "s")
    catalog.merge(lake, DAY(1), publish=False)
    catalog.compact("s", "t", DAY(2))
    assert catalog.expire("2024-06-01 00:00:00") > 0
    assert catalog.merge(lake, DAY(3), publish=False).isEmpty() and catalog.table("s", "t").count() == 10
    assert catalog.remove_orphans("2100-01-01 00:00:00", folder=lake) == 8  # two runs of four files
    assert catalog.manifest().where("mode = 'expired'").isEmpty() and catalog.table("s", "t").count() == 10


def test_views_of_one_name_are_an_error(spark):
    catalog = new(spark)
    catalog.add("a_b", "c", spark.range(1), DAY(1))
    catalog.add("a", "d", spark.range(1), DAY(1))
    assert catalog.publish() == ["a_d", "a_b_c"] or catalog.publish() == ["a_b_c", "a_d"]
    for schema, table in (("a", "b_c"), ("A", "D")):
        other = new(spark)
        other.save(catalog.manifest())
        other.add(schema, table, spark.range(2), DAY(2))
        with pytest.raises(ValueError, match="would both be"):
            other.publish()


def test_a_batch_that_fails_half_way_is_registered_once(spark, monkeypatch):
    catalog, folder, checkpoint = new(spark), scratch(spark, "arriving"), scratch(spark, "offsets")
    spark.range(30).repartition(3).write.parquet(folder)
    stream = lambda: streams.arrivals(spark, folder, spark.range(1).schema, files_per_batch=1)
    run = lambda: streams.ingest_to(stream(), catalog, "s", "t", DAY(1), checkpoint, "in")
    save, calls = Catalog.save, []

    def failing(self, manifest, after):
        calls.append(1)
        if len(calls) == 2 and not after:
            raise RuntimeError("before registering")
        save(self, manifest)
        if len(calls) == 4 and after:
            raise RuntimeError("after registering")

    monkeypatch.setattr(Catalog, "save", lambda self, m: failing(self, m, False))
    with pytest.raises(Exception, match="before registering"):
        run()
    assert len(calls) == 2 and catalog.table("s", "t").count() == 10
    monkeypatch.setattr(Catalog, "save", lambda self, m: failing(self, m, True))
    with pytest.raises(Exception, match="after registering"):
        run()
    assert catalog.table("s", "t").count() == 30
    monkeypatch.setattr(Catalog, "save", save)
    run()
    assert rows(catalog.table("s", "t")) == rows(spark.range(30))
    assert sorted(r.run for r in catalog.manifest().select("run").distinct().collect()) == [f"{k:012d}" for k in range(3)]


def test_checks_from_footers_and_from_writing_agree(spark):
    df = spark.range(50).select("id", F.when(F.col("id") > 9, F.col("id") / 2).alias("v"), F.lit("r").alias("run"), (F.col("id") - 20).cast("double").alias("lat"), F.col("id").cast("double").alias("lon"))
    spec = {"min_rows": 60, "not_null": ["id", "v"], "max_null_pct": 10.0, "null_columns": ["v"], "single_value": ["run", "id"], "bbox": ("lat", "lon", (-20, 0, 29, 49)), "unique_cols": ["id"], "required": ["id"], "forbidden": ["v"]}
    path = scratch(spark, "checked")
    report = {r.check: (r.status, r.observed) for r in sinks.write_checked(df.repartition(3), path, spec).collect()}
    assert report["bbox"] == ("pass", "-20.0,29.0,0.0,49.0") and report["min_rows"] == ("fail", "50") and report["not_null:v"] == ("fail", "10") and report["single_value:id"] == ("fail", "2+")
    catalog = new(spark)
    catalog.add("s", "t", df.repartition(3), DAY(1))
    told = footers.read_footers(spark, sorted(paths(catalog)))
    table = catalog.table("s", "t")
    assert {c: (s, o) for c, s, o, _ in quality.check_files(table, told, spec)} == report
    plain = {r.check: r.status for r in quality.check(df, spec).collect()}
    assert plain == {c: s for c, (s, _) in report.items()}
    # Nothing is read for what footers say.
    class Unread:
        columns, dtypes = table.columns, table.dtypes

    assert quality.check_files(Unread, told, {k: spec[k] for k in ("min_rows", "not_null", "max_null_pct", "null_columns", "bbox")})
    empty = quality.judged(spec, ["id"], {"rows": 0, **{k: 0 for k in ("nulls:id", "nulls:v")}, **{f"{n}:{c}": None for n in ("min", "max") for c in ("run", "id", "lat", "lon")}})
    assert [s for c, s, _, _ in empty if c == "bbox" or c.startswith("single")] == ["fail"] * 3

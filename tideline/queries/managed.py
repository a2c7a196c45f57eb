"""Queries of versioned tables, data quality and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import spatial
from ..operators import manifest as M
from ..operators import quality as C
from ..operators import relate
from ..operators.catalog import Catalog
from ..session import scratch
from ..sources import sinks
from ..streaming import streams
from .base import POINTS, cell_sql, points, query, table

_CELL = cell_sql("lat", "lon", 5)

# Versioned tables. Months of orders stand for files: one row of the manifest for each month, in the order of months.

_FILES = """(SELECT 'sales' AS schema, o_orderpriority AS "table", CAST(dense_rank() OVER (PARTITION BY o_orderpriority ORDER BY month) AS INTEGER) AS version, CAST(month AS TIMESTAMP) AS ts, o_orderpriority || '/' || strftime(month, '%Y-%m') AS path, n * 100 AS bytes, n AS rows,
CASE WHEN month(month) = 7 THEN 'replace' ELSE 'append' END AS mode FROM (SELECT o_orderpriority, date_trunc('month', o_orderdate) AS month, count(*) AS n FROM orders GROUP BY ALL))"""


def _manifest(spark, d):
    from pyspark.sql import Window

    months = table(spark, d, "orders").groupBy("o_orderpriority", F.date_trunc("month", "o_orderdate").alias("month")).agg(F.count("*").alias("n"))
    rank = F.dense_rank().over(Window.partitionBy("o_orderpriority").orderBy("month"))
    return months.select(
        F.lit("sales").alias("schema"),
        F.col("o_orderpriority").alias("table"),
        rank.cast("int").alias("version"),
        F.col("month").cast("timestamp_ntz").alias("ts"),
        F.concat_ws("/", "o_orderpriority", F.date_format("month", "yyyy-MM")).alias("path"),
        (F.col("n") * 100).alias("bytes"),
        F.col("n").alias("rows"),
        F.when(F.month("month") == 7, "replace").otherwise("append").alias("mode"),
    )


@query(f"""WITH f AS {_FILES}, old AS (SELECT * FROM f WHERE version <= 3)
SELECT schema, "table", version, path, rows FROM old UNION ALL SELECT schema, "table", 4, path, rows FROM f WHERE version > 3 AND version <= 6""")
def register_append(spark, d):
    m = _manifest(spark, d)
    once = M.register_append(m.where("version <= 3"), m.where("version <= 6"), "2024-01-01 00:00:00")
    twice = M.register_append(once, m.where("version <= 6"), "2024-01-02 00:00:00")  # adds nothing
    return twice.select("schema", "table", "version", "path", "rows")


@query(f"""SELECT schema, "table", path, rows FROM {_FILES} QUALIFY row_number() OVER (PARTITION BY schema, "table" ORDER BY ts DESC) = 1""")
def register_replace(spark, d):
    return M.register_replace(_manifest(spark, d)).select("schema", "table", "path", "rows")


@query(f"""SELECT schema, "table", version, path, 2::BIGINT AS n FROM {_FILES} WHERE rows % 2 = 0""")
def manifest_duplicates(spark, d):
    m = _manifest(spark, d)
    return M.manifest_duplicates(m.unionByName(m.where("rows % 2 = 0")))


def _visible_sql(where: str) -> str:
    return f"""SELECT schema, "table", version, path, rows FROM (SELECT *, max(CASE WHEN mode = 'replace' THEN version END) OVER (PARTITION BY schema, "table") AS reset FROM {_FILES} WHERE {where}) WHERE version >= coalesce(reset, 0)"""


@query(_visible_sql("version <= 20"))
def as_of_version(spark, d):
    return M.visible(_manifest(spark, d), version=20).select("schema", "table", "version", "path", "rows")


@query(_visible_sql("ts <= TIMESTAMP '1996-05-15 00:00:00'"))
def as_of_timestamp(spark, d):
    return M.visible(_manifest(spark, d), ts="1996-05-15 00:00:00").select("schema", "table", "version", "path", "rows")


@query("SELECT event_id, value FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10'")
def as_of_snapshot_date(spark, d):
    path = scratch(spark, "history")
    table(spark, d, "events").select("event_id", "value", F.to_date("ts").alias("snapshot_date")).repartition("snapshot_date").write.partitionBy("snapshot_date").parquet(path)
    return spark.read.parquet(path).where("snapshot_date = DATE '2024-01-10'").select("event_id", "value")


@query("SELECT c_custkey, 'insert' AS change FROM customer WHERE c_custkey % 10 = 0 UNION ALL SELECT c_custkey, 'delete' FROM customer WHERE c_custkey % 10 = 1")
def table_changes(spark, d):
    """A table is rewritten without some rows and appended to; rows of rewritten files cancel out."""
    catalog = Catalog(spark, scratch(spark, "changes"))
    c = table(spark, d, "customer").select("c_custkey")
    catalog.add("crm", "customers", c.where("c_custkey % 10 <> 0"), "2024-01-01 00:00:00")
    catalog.add("crm", "customers", c.where("c_custkey % 10 > 1"), "2024-01-02 00:00:00", mode="replace")
    catalog.add("crm", "customers", c.where("c_custkey % 10 = 0"), "2024-01-03 00:00:00")
    return catalog.changes("crm", "customers", 1)


@query("SELECT c_custkey, 'insert' AS change FROM customer WHERE c_custkey % 10 = 0")
def appended_changes(spark, d):
    """Appends alone: their files are the changes, and nothing else is read."""
    catalog = Catalog(spark, scratch(spark, "appends"))
    c = table(spark, d, "customer").select("c_custkey")
    catalog.add("crm", "customers", c.where("c_custkey % 10 <> 0"), "2024-01-01 00:00:00")
    catalog.add("crm", "customers", c.where("c_custkey % 10 = 0"), "2024-01-02 00:00:00")
    return catalog.changes("crm", "customers", 1)


@query(f"""SELECT schema, "table", count(*) AS files, sum(bytes)::BIGINT AS bytes, sum(rows)::BIGINT AS rows FROM {_FILES} GROUP BY ALL""")
def table_info(spark, d):
    return M.table_info(_manifest(spark, d))


@query(f"""SELECT schema, "table", version, max(ts) AS ts, count(*) AS files FROM {_FILES} GROUP BY ALL ORDER BY ts DESC, version DESC, schema, "table" LIMIT 20""")
def list_snapshots(spark, d):
    return M.list_snapshots(_manifest(spark, d))


@query(f"""SELECT path, bytes, rows FROM {_FILES} WHERE "table" = '1-URGENT'""")
def list_table_files(spark, d):
    return _manifest(spark, d).where(F.col("table") == "1-URGENT").select("path", "bytes", "rows")


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey % 2 DESC, o_orderkey DESC) = 1")
def upsert(spark, d):
    """Merged into a catalog table by key, twice: the second time changes nothing."""
    catalog = Catalog(spark, scratch(spark, "upsert"))
    o = relate.dedup(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate", (F.col("o_orderkey") % 2).alias("new")), ["o_custkey", "new"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    catalog.add("sales", "latest", o.where("new = 0").repartitionByRange(8, "o_custkey"), "2024-01-01 00:00:00")
    for day in ("02", "03"):
        catalog.upsert("sales", "latest", o.where("new = 1"), ["o_custkey"], "o_orderdate", f"2024-01-{day} 00:00:00")
    return catalog.table("sales", "latest").select("o_custkey", "o_orderkey", "o_totalprice")


_SQUARE = "o_custkey BETWEEN 1 AND (SELECT max(o_custkey) // 16 FROM orders)"


@query(f"""WITH t AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders), n AS (SELECT o_orderkey, o_custkey, -o_totalprice AS o_totalprice FROM t WHERE {_SQUARE})
SELECT * FROM n UNION ALL SELECT * FROM t WHERE NOT {_SQUARE} UNION ALL SELECT max(o_orderkey) + 1, NULL, 0 FROM t""")
def upsert_touched_files(spark, d):
    """New prices of one range of customers, and an order that is new: only the files that hold the range are rewritten."""
    catalog = Catalog(spark, scratch(spark, "touched"))
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice").withColumn("seen", F.lit(1))
    catalog.add("sales", "orders", o.repartitionByRange(16, "o_custkey").sortWithinPartitions("o_custkey"), "2024-01-01 00:00:00")
    most = o.agg(F.max("o_custkey"), F.max("o_orderkey")).first()
    new = o.where(F.col("o_custkey").between(1, most[0] // 16)).withColumns({"o_totalprice": -F.col("o_totalprice"), "seen": F.lit(2)})
    added = spark.range(1).select(F.lit(most[1] + 1).alias("o_orderkey"), F.lit(None).cast("bigint").alias("o_custkey"), F.lit(0.0).cast(o.schema["o_totalprice"].dataType).alias("o_totalprice"), F.lit(2).alias("seen"))
    catalog.upsert("sales", "orders", new.union(added), ["o_orderkey"], "seen", "2024-01-02 00:00:00")
    return catalog.table("sales", "orders").drop("seen")


@query(f"""SELECT schema, "table", version, path FROM (SELECT *, max(version) OVER (PARTITION BY schema, "table") AS newest FROM {_FILES}) WHERE ts >= TIMESTAMP '1998-01-31 00:00:00' - INTERVAL 30 DAY OR version = newest""")
def expire_versions(spark, d):
    return M.expire_versions(_manifest(spark, d), "1998-01-31 00:00:00").select("schema", "table", "version", "path")


@query(f"SELECT path, rows FROM {_FILES} WHERE version > 5")
def orphan_files(spark, d):
    m = _manifest(spark, d)
    return M.orphan_files(m, m.where("version <= 5")).select("path", "rows")


@query("SELECT o_orderkey, o_totalprice FROM orders")
def compact_files(spark, d):
    catalog = Catalog(spark, scratch(spark, "compact"))
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    catalog.add("sales", "orders", orders.repartitionByRange(12, "o_orderkey").sortWithinPartitions("o_orderkey"), "2024-01-01 00:00:00")
    sizes = catalog.files("sales", "orders").agg(F.sum("bytes")).first()[0]
    catalog.compact("sales", "orders", "2024-01-02 00:00:00", target=sizes // 3, order="o_orderkey")
    return catalog.table("sales", "orders")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0")
def rollback_version(spark, d):
    catalog = Catalog(spark, scratch(spark, "rollback"))
    keys = table(spark, d, "orders").select("o_orderkey")
    catalog.add("sales", "orders", keys.where("o_orderkey % 2 = 0"), "2024-01-01 00:00:00")
    catalog.add("sales", "orders", keys.where("o_orderkey % 2 = 1"), "2024-01-02 00:00:00")
    catalog.rollback("sales", "orders", 1, "2024-01-03 00:00:00")
    return catalog.table("sales", "orders")


@query(f"""SELECT 'events' AS name, count(*) AS n, sum(event_id)::BIGINT AS ids, count(DISTINCT {_CELL}) AS cells FROM {POINTS}
UNION ALL SELECT 'latest', count(*), sum(event_id)::BIGINT, 1 FROM {POINTS} WHERE event_id % 3 = 2 UNION ALL SELECT 'rejected', 1, 0, 0 UNION ALL SELECT 'skipped', 1, 0, 0""")
def merge_catalog(spark, d):
    """From a pipeline's tables to SQL: two runs are written, found, checked, registered by mode and published; a table that
    fails its check is not registered, a second merge finds nothing new, and after the table was merged into fewer files a newer run still
    replaces it while one that comes late is reported."""
    lake, catalog = scratch(spark, "lake"), Catalog(spark, scratch(spark, "catalog"))
    cells = spatial.with_cells(points(spark, d).select("event_id", "lat", "lon"), "lat", "lon", [5])
    for k, run in enumerate(("20240101T000000", "20240102T000000")):
        sinks.write_all({"events": cells.where(F.col("event_id") % 2 == k), "latest": cells.where(F.col("event_id") % 3 == k), "broken": cells.withColumn("lat", F.lit(None).cast("double"))}, lake, run, "feed")
    spec = {"*": {"min_rows": 1, "not_null": ["event_id", "lat"], "unique_cols": ["event_id"]}, "broken": {"unique_cols": ["event_id", "lat"]}}
    first = catalog.merge(lake, "2024-01-03 00:00:00", {"latest": "replace"}, spec)
    again = catalog.merge(lake, "2024-01-04 00:00:00", {"latest": "replace"}, spec).where("status = 'registered'")
    catalog.compact("feed", "latest", "2024-01-05 00:00:00")
    for k, run in ((2, "20240103T000000"), (0, "20240101T120000")):
        sinks.write_all({"latest": cells.where(F.col("event_id") % 3 == k)}, lake, run, "feed")
        third = catalog.merge(lake, "2024-01-06 00:00:00", {"latest": "replace"}, spec)
    skipped = third.where("status like 'skipped%' and run is null").agg(F.lit("skipped").alias("name"), F.count_distinct("table").alias("n"), F.lit(0).cast("bigint").alias("ids"), F.lit(0).cast("bigint").alias("cells"))
    rejected = first.where("status like 'rejected%'").agg(F.lit("rejected").alias("name"), F.count("*").alias("n"), F.lit(again.count()).cast("bigint").alias("ids"), F.lit(0).cast("bigint").alias("cells"))
    events = spark.sql("SELECT 'events' AS name, count(*) AS n, sum(event_id) AS ids, count(DISTINCT cell_r5) AS cells FROM feed_events")
    latest = spark.sql("SELECT 'latest' AS name, count(*) AS n, sum(event_id) AS ids, 1L AS cells FROM feed_latest")
    return events.union(latest).union(rejected).union(skipped)


@query("SELECT s_suppkey AS id, s_name AS name, NULL::DOUBLE AS balance FROM supplier UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer")
def evolve_schema(spark, d):
    old = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return M.evolve(old, table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")))


@query(f"SELECT event_id, lat FROM {POINTS} WHERE lat BETWEEN 12.0 AND 42.0")
def prune_by_stats(spark, d):
    """By bounds that registration read from the files' footers."""
    catalog = Catalog(spark, scratch(spark, "stats"))
    catalog.add("feed", "points", points(spark, d).select("event_id", "lat").repartitionByRange(8, "lat"), "2024-01-01 00:00:00")
    return catalog.table("feed", "points", where={"lat": (12.0, 42.0)})


@query(f"""SELECT 'points' AS "table", count(*) AS n_rows, min(lat) AS lat_lo, max(lat) AS lat_hi, 0::BIGINT AS lat_nulls, count(*) FILTER (WHERE value IS NULL) AS value_nulls FROM {POINTS}""")
def bounds_from_metadata(spark, d):
    """What footers say of a table's columns, put together from its files."""
    catalog = Catalog(spark, scratch(spark, "bounds"))
    catalog.add("feed", "points", points(spark, d).select("event_id", "lat", "value").repartition(6), "2024-01-01 00:00:00")
    files = catalog.files("feed", "points").select("rows", F.col("stats")["lat"].alias("lat"), F.col("stats")["value"].alias("value"))
    return files.agg(F.lit("points").alias("table"), F.sum("rows").alias("n_rows"), F.min(F.col("lat.lo").cast("double")).alias("lat_lo"), F.max(F.col("lat.hi").cast("double")).alias("lat_hi"), F.sum("lat.nulls").alias("lat_nulls"), F.sum("value.nulls").alias("value_nulls"))


@query(f"""SELECT schema, "table", sum(rows)::BIGINT AS n_rows FROM ({_visible_sql('true')}) GROUP BY ALL""")
def count_from_metadata(spark, d):
    return M.count_from_metadata(_manifest(spark, d))


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, round(avg({c}), 4) AS avg, round(stddev_samp({c}), 4) AS std, count(*) AS count, 0.0::DOUBLE AS null_percentage FROM orders" for c in ("o_orderkey", "o_totalprice")))
def catalog_profile(spark, d):
    """Profiled, appended to and profiled again: the second time only the new files are read."""
    catalog = Catalog(spark, scratch(spark, "profile"))
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    for k in (0, 1):
        catalog.add("sales", "orders", o.where(F.col("o_orderkey") % 2 == k), f"2024-01-0{k + 1} 00:00:00")
        out = catalog.profile("sales", "orders")
    return out.select("column_name", "min", "max", F.round("avg", 4).alias("avg"), F.round("std", 4).alias("std"), "count", "null_percentage")


# Quality


@query("SELECT 'min_rows' AS \"check\", CASE WHEN count(*) >= 1000 THEN 'pass' ELSE 'fail' END AS status, CAST(count(*) AS VARCHAR) AS observed, '1000' AS expected FROM lineitem")
def check_min_rows(spark, d):
    return C.check(table(spark, d, "lineitem"), {"min_rows": 1000})


@query("SELECT 'max_null_pct:quality' AS \"check\", CASE WHEN p <= 50 THEN 'pass' ELSE 'fail' END AS status, CAST(p AS VARCHAR) AS observed, '50.0' AS expected FROM (SELECT round(100.0 * count(*) FILTER (WHERE quality IS NULL) / count(*), 1)::DOUBLE AS p FROM documents LEFT JOIN labels USING (doc_id))")
def check_max_null_pct(spark, d):
    df = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    return C.check(df, {"max_null_pct": 50.0, "null_columns": ["quality"]})


@query("SELECT 'unique' AS \"check\", CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END AS status, CAST(count(*) AS VARCHAR) AS observed, '0' AS expected FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)")
def check_unique(spark, d):
    return C.check(table(spark, d, "lineitem"), {"unique_cols": ["l_orderkey", "l_linenumber"]})


@query("SELECT 'not_null:' || c AS \"check\", CASE WHEN n = 0 THEN 'pass' ELSE 'fail' END AS status, CAST(n AS VARCHAR) AS observed, '0' AS expected FROM (SELECT 'doc_id' AS c, 0 AS n UNION ALL SELECT 'quality', (SELECT count(*) FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL))")
def check_not_null(spark, d):
    df = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    return C.check(df, {"not_null": ["doc_id", "quality"]})


_ROWS = "SELECT 'min_rows' AS \"check\", CASE WHEN count(*) >= 1 THEN 'pass' ELSE 'fail' END AS status, CAST(count(*) AS VARCHAR) AS observed, '1' AS expected FROM {}"


@query(_ROWS.format("supplier") + " UNION ALL SELECT 'required_columns', 'fail', 's_population', '' UNION ALL SELECT 'extra_columns', 'warn', 's_acctbal,s_nationkey', ''")
def check_required_columns(spark, d):
    return C.check(table(spark, d, "supplier"), {"min_rows": 1, "required": ["s_suppkey", "s_name", "s_population"]})


@query(_ROWS.format("pages") + " UNION ALL SELECT 'forbidden_columns', 'fail', 'html', ''")
def check_forbidden_columns(spark, d):
    return C.check(table(spark, d, "pages"), {"min_rows": 1, "forbidden": ["html", "author"]})


@query("SELECT * FROM (VALUES ('o_custkey', 'bigint', NULL, false), ('o_note', NULL, 'string', true), ('o_orderkey', 'bigint', 'string', false), ('o_orderstatus', 'string', 'string', true)) v(\"column\", old_type, new_type, compatible), (SELECT count(*) AS n_rows FROM orders)")
def check_schema_match(spark, d):
    old = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    new = old.select(F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderstatus", F.lit("").alias("o_note"))
    return C.schema_diff(old.schema, new.schema, spark).withColumn("n_rows", F.lit(new.count()).cast("bigint"))


@query(f"SELECT 'bbox' AS \"check\", CASE WHEN min(lat) >= -90 AND max(lat) <= 90 AND min(lon) >= -180 AND max(lon) <= 180 THEN 'pass' ELSE 'fail' END AS status, concat_ws(',', CAST(min(lat) AS VARCHAR), CAST(max(lat) AS VARCHAR), CAST(min(lon) AS VARCHAR), CAST(max(lon) AS VARCHAR)) AS observed, '-90,90,-180,180' AS expected FROM {POINTS}")
def check_bbox(spark, d):
    return C.check(points(spark, d), {"bbox": ("lat", "lon", (-90, -180, 90, 180))})


@query("SELECT 'single_value:' || c AS \"check\", CASE WHEN n = 1 THEN 'pass' ELSE 'fail' END AS status, CAST(n AS VARCHAR) AS observed, '1' AS expected FROM (SELECT 'event_type' AS c, count(DISTINCT event_type) AS n FROM events UNION ALL SELECT 'one', 1)")
def check_single_value(spark, d):
    return C.check(table(spark, d, "events").withColumn("one", F.lit(1)), {"single_value": ["event_type", "one"]})


@query("SELECT c_mktsegment FROM (VALUES ('BUILDING'), ('ATLANTIS'), ('MACHINERY')) v(c_mktsegment) WHERE c_mktsegment NOT IN (SELECT c_mktsegment FROM customer)")
def check_contains_values(spark, d):
    return C.check_contains(table(spark, d, "customer"), "c_mktsegment", ["BUILDING", "ATLANTIS", "MACHINERY"])


@query("SELECT 'min_rows' AS \"check\", CASE WHEN count(*) >= 1000000000 THEN 'pass' ELSE 'warn' END AS status, CAST(count(*) AS VARCHAR) AS observed, '1000000000' AS expected FROM orders")
def check_optional(spark, d):
    return C.check(table(spark, d, "orders"), {"min_rows": 1_000_000_000, "optional": True})


@query("""SELECT 'orders' AS "table", 'min_rows' AS "check", CASE WHEN count(*) >= 10 THEN 'pass' ELSE 'fail' END AS status, CAST(count(*) AS VARCHAR) AS observed, '10' AS expected FROM orders
UNION ALL SELECT 'region', 'min_rows', CASE WHEN count(*) >= 6 THEN 'pass' ELSE 'fail' END, CAST(count(*) AS VARCHAR), '6' FROM region""")
def check_overrides(spark, d):
    return C.check_tables({"orders": table(spark, d, "orders"), "region": table(spark, d, "region")}, {"min_rows": 10}, {"region": {"min_rows": 6}})


@query("SELECT event_type, count(*) AS n, min(ts) AS first, max(ts) AS last, round(avg(value), 4) AS mean FROM events GROUP BY event_type")
def profile_report(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last"), F.round(F.avg("value"), 4).alias("mean"))


@query("SELECT 'crm' AS schema, c_mktsegment AS \"table\", count(DISTINCT c_nationkey) AS owners FROM customer GROUP BY c_mktsegment HAVING count(DISTINCT c_nationkey) > 1")
def check_ownership(spark, d):
    return C.ownership(table(spark, d, "customer").select(F.col("c_nationkey").cast("string").alias("workspace"), F.lit("crm").alias("schema"), F.col("c_mktsegment").alias("table")))


@query("""SELECT coalesce(status, 'none') AS status, count(*) AS n FROM (SELECT DISTINCT user_id AS w FROM events) LEFT JOIN (SELECT user_id AS w, coalesce(CASE WHEN event_type = 'click' THEN NULL ELSE event_type END, 'running') AS status FROM events WHERE user_id % 10 <> 0 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) USING (w) GROUP BY 1""")
def run_status_rollup(spark, d):
    e = table(spark, d, "events")
    runs = e.where("user_id % 10 <> 0").select(F.col("user_id").alias("workspace"), F.when(F.col("event_type") != "click", F.col("event_type")).alias("conclusion"), F.struct("ts", "event_id").alias("run_started_at"))
    return C.run_status(e.select(F.col("user_id").alias("workspace")).distinct(), runs)


@query(f"""SELECT 'min_rows' AS "check", CASE WHEN count(*) >= 100 THEN 'pass' ELSE 'fail' END AS status, CAST(count(*) AS VARCHAR) AS observed, '100' AS expected FROM events
UNION ALL SELECT 'not_null:lat', 'pass', '0', '0' UNION ALL SELECT 'single_value:event_type', 'fail', '2+', '1' UNION ALL SELECT 'single_value:run', 'pass', '1', '1'
UNION ALL SELECT 'bbox', 'pass', concat_ws(',', CAST(min(lat) AS VARCHAR), CAST(max(lat) AS VARCHAR), CAST(min(lon) AS VARCHAR), CAST(max(lon) AS VARCHAR)), '-90,90,-180,180' FROM {POINTS}
UNION ALL SELECT 'unique', CASE WHEN count(*) = 0 THEN 'pass' ELSE 'fail' END, CAST(count(*) AS VARCHAR), '0' FROM (SELECT 1 FROM events GROUP BY event_id HAVING count(*) > 1)""")
def check_while_writing(spark, d):
    """A table's checks come with the job that writes it."""
    spec = {"min_rows": 100, "not_null": ["lat"], "single_value": ["event_type", "run"], "bbox": ("lat", "lon", (-90, -180, 90, 180)), "unique_cols": ["event_id"]}
    return sinks.write_checked(points(spark, d).select("event_id", "event_type", "lat", "lon", F.lit("r1").alias("run")), scratch(spark, "checked"), spec)


# Streams


def _arrivals(spark, d, *columns):
    """Events as four arrival files in the order of time, with a true timestamp."""
    folder = scratch(spark, "arrivals")
    events = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    events.repartitionByRange(4, "ts").write.parquet(folder)
    return streams.arrivals(spark, folder, events.schema, files_per_batch=1)


@query("SELECT event_id, value * 2 AS value FROM events WHERE value > 10")
def stream_ingest_files(spark, d):
    """Arrivals become versions of a catalog table; a second run finds nothing new."""
    catalog, checkpoint = Catalog(spark, scratch(spark, "ingested")), scratch(spark, "offsets")
    stream = _arrivals(spark, d)
    shaped = lambda df: df.where("value > 10").select("event_id", (F.col("value") * 2).alias("value"))
    for day in ("01", "02"):
        streams.ingest_to(stream, catalog, "feed", "events", f"2024-02-{day} 00:00:00", checkpoint, "arrivals", shaped)
    return catalog.table("feed", "events")


@query("SELECT event_id, user_id FROM events")
def stream_dedup_overlap(spark, d):
    folder, target = scratch(spark, "overlap"), scratch(spark, "deduped")
    events = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id")
    events.union(events.where("event_id % 3 = 0")).repartition(4).write.parquet(folder)
    stream = streams.arrivals(spark, folder, events.schema)
    streams.append_to(streams.without_repeats(stream, ["event_id"], "ts", "40 days"), target, scratch(spark, "offsets"))
    return spark.read.parquet(target).select("event_id", "user_id")


@query("""SELECT 1::INTEGER AS hours, date_trunc('hour', ts) AS start, count(*) AS n, round(avg(value), 8) AS mean FROM events GROUP BY 2
UNION ALL SELECT 6, s, count(*), round(avg(value), 8) FROM (SELECT value, unnest(range(date_trunc('hour', ts) - INTERVAL 5 HOUR, date_trunc('hour', ts) + INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS s FROM events) GROUP BY 2""")
def stream_hourly_counts(spark, d):
    stream, out = _arrivals(spark, d), None
    for hours, slide in ((1, None), (6, "1 hour")):
        target = scratch(spark, "hourly")
        counts = streams.windowed(stream, "ts", f"{hours} hours", slide, delay="40 days", n=F.count("*"), mean=F.round(F.avg("value"), 8))
        streams.changes_to(counts, target, scratch(spark, "offsets"))
        part = streams.latest_changes(spark, target, ["w"]).select(F.lit(hours).alias("hours"), F.col("w.start").cast("timestamp_ntz").alias("start"), "n", "mean")
        out = part if out is None else out.union(part)
    return out


@query("SELECT user_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def stream_latest_state(spark, d):
    target = scratch(spark, "state")
    streams.latest_state(_arrivals(spark, d), target, scratch(spark, "offsets"), ["user_id"], ["ts", "event_id"], every=2)
    return streams.read_state(spark, target, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "value")

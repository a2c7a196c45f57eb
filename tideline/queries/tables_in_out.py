"""Queries of sources and sinks: data is derived from the given tables, written and read again."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import shape
from ..operators.catalog import Catalog
from ..session import scratch
from ..sources import readers, sinks
from .base import POINTS, hilbert_sql, points, query, table


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def scan_parquet(spark, d):
    return readers.scan_parquet(spark, f"{d}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT o_orderkey, o_totalprice, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders WHERE year(o_orderdate) >= 1996 AND o_orderstatus = 'F'")
def scan_hive_partitions(spark, d):
    base = scratch(spark, "hive")
    table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", F.year("o_orderdate").alias("y")).repartition("o_orderstatus", "y").write.partitionBy("o_orderstatus", "y").parquet(base)
    return readers.scan_hive(spark, base, (F.col("y") >= 1996) & (F.col("o_orderstatus") == "F"))


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_csv(spark, d):
    path = scratch(spark, "csv")
    df = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    df.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return readers.scan_csv(spark, path, df.schema)


_DOC = "features array<struct<properties: struct<c_custkey: bigint, c_name: string, c_mktsegment: string>>>"


def _documents(spark, d):
    """The path of customers as JSON documents, each of a nation's customers of one block of keys, so that none grows with the table."""
    path = scratch(spark, "json")
    feature = F.struct(F.struct("c_custkey", "c_name", "c_mktsegment").alias("properties"))
    docs = table(spark, d, "customer").groupBy("c_nationkey", F.floor(F.col("c_custkey") / 10_000).alias("page")).agg(F.to_json(F.struct(F.collect_list(feature).alias("features"))).alias("value"))
    docs.repartition("c_nationkey", "page").write.partitionBy("c_nationkey", "page").text(path)
    return path


def _flat(documents):
    return documents.select(F.explode("features.properties").alias("p")).select("p.*")


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def scan_json_document(spark, d):
    return _flat(readers.scan_json_doc(spark, _documents(spark, d), _DOC))


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def scan_json_pages(spark, d):
    return _flat(readers.scan_json_doc(spark, f"{_documents(spark, d)}/c_nationkey=*/page=*", _DOC))


@query("SELECT p_partkey, p_name, p_size FROM part")
def scan_ndjson(spark, d):
    path = scratch(spark, "ndjson")
    table(spark, d, "part").select("p_partkey", "p_name", "p_size").write.json(path)
    return readers.scan_ndjson(spark, path, "p_partkey bigint, p_name string, p_size int")


@query("SELECT o_orderkey AS id, printf('%06x', o_orderkey) AS code, printf('item_%04d', o_orderkey) AS name, CASE WHEN o_orderkey % 3 = 0 THEN 'a' WHEN o_orderkey % 3 = 1 THEN 'b' ELSE 'c' END AS kind FROM (SELECT unnest(range(count(*))) AS o_orderkey FROM orders)")
def generate_rows(spark, d):
    return readers.generate(spark, table(spark, d, "orders").count()).select("id", "code", "name", "kind")


@query("SELECT code, count(*) AS customers FROM customer JOIN (VALUES (0, 'AF'), (1, 'AM'), (2, 'AS'), (3, 'EU'), (4, 'ME')) v(k, code) ON c_nationkey % 5 = k GROUP BY code")
def rows_to_table(spark, d):
    codes = readers.rows_to_table(spark, [(0, "AF"), (1, "AM"), (2, "AS"), (3, "EU"), (4, "ME")], "k int, code string")
    return table(spark, d, "customer").join(F.broadcast(codes), F.col("c_nationkey") % 5 == F.col("k")).groupBy("code").agg(F.count("*").alias("customers"))


@query("SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderstatus")
def read_catalog_table(spark, d):
    catalog = Catalog(spark, scratch(spark, "catalog"))
    orders = table(spark, d, "orders")
    catalog.add("sales", "orders", orders.where("o_orderkey % 2 = 0"), "2024-01-01 00:00:00")
    catalog.add("sales", "orders", orders.where("o_orderkey % 2 = 1"), "2024-01-02 00:00:00")
    return catalog.table("sales", "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT 'o_orderstatus=' || o_orderstatus AS folder, 1::BIGINT AS files, true AS filled, true AS dated FROM orders GROUP BY o_orderstatus")
def list_files(spark, d):
    root = scratch(spark, "files")
    table(spark, d, "orders").repartition("o_orderstatus").write.partitionBy("o_orderstatus").parquet(root)
    found = readers.list_files(spark, root, "*.parquet")
    return found.groupBy(F.element_at(F.split("path", "/"), -2).alias("folder")).agg(F.count("*").alias("files"), F.min(F.col("bytes") > 0).alias("filled"), F.min(F.col("modified").isNotNull()).alias("dated"))


_RELEASE = "CASE WHEN p_partkey % 3 = 0 THEN '2026-01-21.0' ELSE '2026-02-18.0' END"


@query(f"SELECT p_partkey, p_size, release FROM (SELECT *, {_RELEASE} AS release FROM part) WHERE release = '2026-02-18.0'")
def latest_release(spark, d):
    base = scratch(spark, "release")
    table(spark, d, "part").select("p_partkey", "p_size", F.expr(_RELEASE).alias("release")).write.partitionBy("release").parquet(base)
    return readers.scan_latest_partition(spark, base, "release")


@query("SELECT 'parquet' AS kind, count(*) AS n, sum(p_size)::BIGINT AS sizes FROM part UNION ALL SELECT 'csv', count(*), sum(p_size)::BIGINT FROM part UNION ALL SELECT 'ndjson', count(*), sum(p_size)::BIGINT FROM part")
def read_any(spark, d):
    df, out = table(spark, d, "part").select("p_partkey", "p_size"), None
    for kind, write in (("parquet", lambda p: df.write.parquet(p)), ("csv", lambda p: df.write.option("header", True).csv(p)), ("ndjson", lambda p: df.write.json(p))):
        path = f"{scratch(spark, 'any')}.{kind}"
        write(path)
        part = readers.read_any(spark, path).agg(F.lit(kind).alias("kind"), F.count("*").alias("n"), F.sum("p_size").cast("bigint").alias("sizes"))
        out = part if out is None else out.union(part)
    return out


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 200")
def dev_limit(spark, d):
    return readers.limited(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), 200, [F.desc("o_totalprice"), "o_orderkey"])


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def write_parquet(spark, d):
    path = scratch(spark, "out")
    sinks.write_table(table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal"), path, sort=["s_suppkey"], rows_per_file=100_000)
    return readers.scan_parquet(spark, path)


def _double_sql(column: str) -> str:
    """The eight bytes of a double, lowest first, as hex."""
    return f"array_to_string(list_reverse(regexp_extract_all(hex({column}::BIT::BLOB), '..')), '')"


@query(f"SELECT event_id, lon AS xmin, lat AS ymin, '0101000000' || {_double_sql('lon')} || {_double_sql('lat')} AS geometry FROM {POINTS}")
def write_geoparquet(spark, d):
    path = scratch(spark, "geo")
    sinks.write_geo(points(spark, d).select("event_id", "lat", "lon"), path, "lon", "lat")
    return readers.scan_parquet(spark, path).select("event_id", "xmin", "ymin", F.hex("geometry").alias("geometry"))


@query(f"SELECT event_id, lat, lon FROM {POINTS}")
def write_spatially_sorted(spark, d):
    path = scratch(spark, "hilbert")
    sinks.write_geo(points(spark, d).select("event_id", "ts", "lat", "lon"), path, "lon", "lat", cluster=True, then=["ts"])
    return readers.scan_parquet(spark, path).select("event_id", "lat", "lon")


@query("SELECT 'customers' AS name, count(*) AS n FROM customer UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'suppliers', count(*) FROM supplier")
def write_multi(spark, d):
    tables = {"customers": table(spark, d, "customer"), "orders": table(spark, d, "orders"), "suppliers": table(spark, d, "supplier")}
    paths = sinks.write_all(tables, scratch(spark, "multi"), "20240101T000000", "sales")
    parts = [readers.scan_parquet(spark, p).agg(F.lit(n).alias("name"), F.count("*").alias("n")) for n, p in paths.items()]
    return parts[0].union(parts[1]).union(parts[2])


@query("SELECT 'full' AS name, true AS written, count(*) AS n FROM orders UNION ALL SELECT 'empty', true, 0 UNION ALL SELECT 'skipped', false, NULL")
def write_if_nonempty(spark, d):
    orders, rows = table(spark, d, "orders"), []
    for name, df, on_empty in (("full", orders, "skip"), ("empty", orders.where("false"), "write"), ("skipped", orders.where("o_totalprice < 0"), "skip")):
        path = scratch(spark, name)
        written = sinks.write_table(df, path, on_empty=on_empty)
        rows.append((name, written, readers.scan_parquet(spark, path).count() if written else None))
    return readers.rows_to_table(spark, rows, "name string, written boolean, n bigint")


@query("SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY c_mktsegment")
def stage_table(spark, d):
    table(spark, d, "customer").where("c_acctbal > 0").createOrReplaceTempView("tideline_staged")
    return spark.sql("SELECT c_mktsegment, count(*) AS n FROM tideline_staged GROUP BY c_mktsegment")


@query("SELECT 1 AS target, count(*) AS n, sum(o_custkey)::BIGINT AS s FROM orders UNION ALL SELECT 2, count(*), sum(o_custkey)::BIGINT FROM orders")
def write_replicated(spark, d):
    roots = [scratch(spark, "one"), scratch(spark, "two")]
    sinks.write_table(table(spark, d, "orders"), *roots)
    a, b = (readers.scan_parquet(spark, r).agg(F.lit(i).alias("target"), F.count("*").alias("n"), F.sum("o_custkey").alias("s")) for i, r in enumerate(roots, 1))
    return a.union(b)


@query(hilbert_sql(POINTS, "event_id"))
def hilbert_sort(spark, d):
    from ..functions.spatial import hilbert_index

    return shape.hilbert_sort(points(spark, d), "lon", "lat", ["ts", "event_id"]).select("event_id", hilbert_index(F.col("lon"), F.col("lat")).alias("h"))

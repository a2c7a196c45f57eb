"""Queries of joins, aggregations, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import spatial
from ..operators import manifest, polygons, raster, relate, shape, sketches
from ..session import scratch
from ..sources import readers
from .base import POINTS, cell_sql, lat_sql, lon_sql, parent_sql, points, query, table

_C5, _C8 = cell_sql("lat", "lon", 5), cell_sql("lat", "lon", 8)

# Joins


@query(f"SELECT o_orderkey, c_name, c_nationkey, {cell_sql('lat', 'lon', 5)} AS cell FROM orders LEFT JOIN (SELECT *, CAST((c_custkey * 7919) % 18000 AS DOUBLE) / 100 - 90 AS lat, CAST((c_custkey * 104729) % 36000 AS DOUBLE) / 100 - 180 AS lon FROM customer WHERE c_custkey % 10 <> 0) ON o_custkey = c_custkey")
def left_join_using(spark, d):
    dim = table(spark, d, "customer").where("c_custkey % 10 <> 0").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey", (((F.col("c_custkey") * 7919) % 18000).cast("double") / 100 - 90).alias("lat"), (((F.col("c_custkey") * 104729) % 36000).cast("double") / 100 - 180).alias("lon"))
    joined = table(spark, d, "orders").select("o_orderkey", "o_custkey").join(dim, "o_custkey", "left")
    return joined.select("o_orderkey", "c_name", "c_nationkey", spatial.cell_id(F.col("lat"), F.col("lon"), 5).alias("cell"))


@query("SELECT p_partkey FROM part WHERE EXISTS (SELECT 1 FROM (SELECT lower(left(p_name, 4)) AS code FROM part WHERE p_partkey < 4) WHERE lower(p_type || ' ' || p_name) LIKE '%' || code || '%')")
def semi_join_like(spark, d):
    parts = table(spark, d, "part")
    codes = parts.where("p_partkey < 4").select(F.lower(F.left("p_name", F.lit(4))).alias("code"))
    return relate.semi_join_contains(parts.select("p_partkey", F.concat_ws(" ", "p_type", "p_name").alias("t")), codes, "t", "code").select("p_partkey")


@query("SELECT o_orderkey, l_linenumber, o_orderstatus, l_quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_quantity > 40")
def cross_schema_join(spark, d):
    lines = table(spark, d, "lineitem").where("l_quantity > 40").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity")
    return table(spark, d, "orders").select("o_orderkey", "o_orderstatus").join(lines, "o_orderkey").select("o_orderkey", "l_linenumber", "o_orderstatus", "l_quantity")


@query(f"""WITH g AS (SELECT {_C5} AS grid, count(*) AS people FROM {POINTS} GROUP BY 1)
SELECT event_id, grid, people FROM (SELECT event_id, {parent_sql(_C8, 8, 5)} AS grid FROM {POINTS}) JOIN g USING (grid)""")
def cell_join(spark, d):
    p = points(spark, d)
    grid = spatial.with_cells(p, "lat", "lon", [5]).groupBy("cell_r5").agg(F.count("*").alias("people")).withColumnRenamed("cell_r5", "grid")
    fine = spatial.with_cells(p, "lat", "lon", [8]).select("event_id", "cell_r8")
    return relate.cell_join(fine, grid, "cell_r8", 8, "grid", 5).select("event_id", "grid", "people")


@query("SELECT DISTINCT o_orderpriority || '/' || strftime(o_orderdate, '%Y-%m') AS path FROM orders WHERE o_orderpriority || '/' || strftime(o_orderdate, '%Y-%m') NOT IN (SELECT o_orderpriority || '/' || strftime(o_orderdate, '%Y-%m') FROM orders WHERE o_orderdate < DATE '1996-03-01')")
def anti_join_new_files(spark, d):
    """Months of orders stand for files; those before a day are registered."""
    files = table(spark, d, "orders").select(F.concat_ws("/", "o_orderpriority", F.date_format("o_orderdate", "yyyy-MM")).alias("path"), "o_orderdate")
    return manifest.new_files(files.select("path").distinct(), files.where("o_orderdate < DATE '1996-03-01'"))


@query("SELECT vec_id, label, CAST(unnest(embedding) AS FLOAT) AS v FROM embeddings")
def lateral_unnest(spark, d):
    return table(spark, d, "embeddings").select("vec_id", "label", F.explode("embedding").alias("v"))


@query("SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'AU' WHEN 'BUILDING' THEN 'BU' WHEN 'FURNITURE' THEN 'FU' END AS code FROM customer")
def lookup_constant_dim(spark, d):
    return relate.lookup(table(spark, d, "customer"), {"AUTOMOBILE": "AU", "BUILDING": "BU", "FURNITURE": "FU"}, F.col("c_mktsegment"), "code").select("c_custkey", "code")


# Aggregations


@query("SELECT count(*) AS n FROM lineitem")
def count_rows(spark, d):
    return table(spark, d, "lineitem").agg(F.count("*").alias("n"))


@query("SELECT count(DISTINCT l_partkey) AS parts FROM lineitem")
def count_distinct(spark, d):
    return table(spark, d, "lineitem").agg(F.countDistinct("l_partkey").alias("parts"))


@query("SELECT count(*) AS tuples FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)")
def count_distinct_tuple(spark, d):
    return table(spark, d, "lineitem").agg(F.countDistinct(F.struct("l_orderkey", "l_linenumber")).alias("tuples"))


@query("SELECT count(*) FILTER (WHERE l_discount > 0.05) AS cheap, count(*) AS n FROM lineitem")
def count_filter(spark, d):
    return table(spark, d, "lineitem").agg(F.count_if(F.col("l_discount") > 0.05).alias("cheap"), F.count("*").alias("n"))


@query("SELECT min(l_quantity) AS lo, max(l_quantity) AS hi, round(avg(l_quantity), 6) AS mean, round(sum(l_extendedprice), 0) AS total FROM lineitem")
def min_max_avg_sum(spark, d):
    return table(spark, d, "lineitem").agg(F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi"), F.round(F.avg("l_quantity"), 6).alias("mean"), F.round(F.sum("l_extendedprice"), 0).alias("total"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def group_by_all_dupes(spark, d):
    return relate.duplicates(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def group_count_ranked(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "event_type").limit(10)


@query("SELECT round(100.0 * count(*) FILTER (WHERE quality IS NULL) / count(*), 1)::DOUBLE AS quality, round(100.0 * count(*) FILTER (WHERE lang IS NULL) / count(*), 1)::DOUBLE AS lang FROM documents LEFT JOIN labels USING (doc_id)")
def null_pct(spark, d):
    df = table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id", "left")
    return relate.null_pct(df, ["quality", "lang"])


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, round(avg({c}), 4) AS avg, round(stddev_samp({c}), 4) AS std, count(*) AS count, round(100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*), 2)::DOUBLE AS null_percentage FROM lineitem" for c in ("l_quantity", "l_extendedprice", "l_discount")
    )
)
def summarize(spark, d):
    out = relate.summarize(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return out.select("column_name", "min", "max", F.round("avg", 4).alias("avg"), F.round("std", 4).alias("std"), "count", "null_percentage")


@query(" UNION ALL ".join(f"SELECT event_type, '{c}' AS column_name, '{kind}' AS column_type, min({v})::DOUBLE AS min, max({v})::DOUBLE AS max, round(avg({v}), 4) AS avg, round(stddev_samp({v}), 4) AS std, count(*) AS count, 0.0::DOUBLE AS null_percentage FROM events GROUP BY event_type" for c, kind, v in (("value", "double", "value"), ("user_id", "bigint", "user_id"))))
def merged_profiles(spark, d):
    """Sketches of every day's events, merged by type; distinct counts and quartiles are within the sketches' error, so not compared here."""
    days = sketches.sketch(table(spark, d, "events").withColumn("day", F.to_date("ts")), ["value", "user_id"], "event_type", "day")
    out = sketches.merged(days, "event_type")
    return out.select("event_type", "column_name", "column_type", "min", "max", F.round("avg", 4).alias("avg"), F.round("std", 4).alias("std"), "count", "null_percentage")


@query("SELECT event_type, round(sum(CASE WHEN event_id % 10 > 1 THEN value END), 4) AS total, count(*) FILTER (WHERE event_id % 10 <= 1) AS odd FROM events GROUP BY event_type")
def conditional_sum(spark, d):
    v = F.expr("CASE WHEN event_id % 10 = 0 THEN double('Infinity') WHEN event_id % 10 = 1 THEN double('NaN') ELSE value END")
    df = table(spark, d, "events").select("event_type", v.alias("v"))
    return df.groupBy("event_type").agg(F.round(relate.finite_sum(F.col("v")), 4).alias("total"), F.count_if(F.isnan("v") | (F.abs("v") == float("inf"))).alias("odd"))


@query("SELECT c_nationkey, count(DISTINCT c_mktsegment) AS segments, round(avg(c_acctbal), 2) AS balance, round(avg(o_totalprice), 2) AS price FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1 ORDER BY price DESC, c_nationkey LIMIT 20")
def grouped_rollup_stats(spark, d):
    df = table(spark, d, "customer").join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"))
    out = df.groupBy("c_nationkey").agg(F.countDistinct("c_mktsegment").alias("segments"), F.round(F.avg("c_acctbal"), 2).alias("balance"), F.round(F.avg("o_totalprice"), 2).alias("price"))
    return out.orderBy(F.desc("price"), "c_nationkey").limit(20)


@query("SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem ORDER BY 1, 2")
def distinct_values(spark, d):
    return table(spark, d, "lineitem").select("l_returnflag", "l_linestatus").distinct().orderBy("l_returnflag", "l_linestatus")


@query(f"""SELECT cell, total, damaged, mean_value, max_value, ratio, {lat_sql('cell', 5)} AS lat, {lon_sql('cell', 5)} AS lon FROM (
SELECT {_C5} AS cell, count(*) AS total, count(*) FILTER (WHERE value > 50) AS damaged, round(avg(value), 3) AS mean_value, round(max(value), 3) AS max_value, round(count(*) FILTER (WHERE value > 50) / greatest(count(*), 1), 4) AS ratio FROM {POINTS} GROUP BY 1)""")
def cell_aggregate(spark, d):
    df = spatial.with_cells(points(spark, d), "lat", "lon", [5]).withColumnRenamed("cell_r5", "cell")
    return relate.cell_aggregate(df, "cell", "value", 50.0).withColumns({"lat": spatial.cell_lat(F.col("cell"), 5), "lon": spatial.cell_lon(F.col("cell"), 5)})


@query(" UNION ALL ".join(f"SELECT {r}::INTEGER AS res, {cell_sql('lat', 'lon', r)} AS cell, count(*) AS n, round(sum(value), 4) AS total, max(value) AS top, round(avg(value), 4) AS mean FROM {POINTS} GROUP BY 2" for r in (5, 8, 10)))
def multires_rollup(spark, d):
    out = relate.rollup_cells(points(spark, d), "lat", "lon", [5, 8, 10], n=("count", "*"), total=("sum", "value"), top=("max", "value"), mean=("avg", "value"))
    return out.select("res", "cell", "n", F.round("total", 4).alias("total"), "top", F.round("mean", 4).alias("mean"))


_POLYGONS = "(SELECT n_nationkey AS k, unnest([struct_pack(x1 := x - 9, y1 := y, x2 := x, y2 := y - 7), struct_pack(x1 := x, y1 := y - 7, x2 := x + 11, y2 := y), struct_pack(x1 := x + 11, y1 := y, x2 := x, y2 := y + 6), struct_pack(x1 := x, y1 := y + 6, x2 := x - 9, y2 := y), struct_pack(x1 := x - 2, y1 := y - 2, x2 := x - 2, y2 := y + 2), struct_pack(x1 := x - 2, y1 := y + 2, x2 := x + 3, y2 := y), struct_pack(x1 := x + 3, y1 := y, x2 := x - 2, y2 := y - 2)]) AS e FROM (SELECT n_nationkey, ((n_nationkey * 37) % 320 - 160)::DOUBLE + 0.013::DOUBLE AS x, ((n_nationkey * 23) % 150 - 75)::DOUBLE + 0.007::DOUBLE AS y FROM nation))"


@query(f"SELECT event_id, k FROM {POINTS}, {_POLYGONS} GROUP BY event_id, k HAVING sum(CASE WHEN (e.y1 > lat) <> (e.y2 > lat) AND lon < (e.x2 - e.x1) * (lat - e.y1) / (e.y2 - e.y1) + e.x1 THEN 1 ELSE 0 END) % 2 = 1")
def points_in_polygons(spark, d):
    """Each nation's diamond, with a triangle as its hole; some overlap."""
    x = ((F.col("n_nationkey") * 37) % 320 - 160).cast("double") + 0.013
    y = ((F.col("n_nationkey") * 23) % 150 - 75).cast("double") + 0.007
    ring = lambda *ends: F.array(*(F.struct((x + dx).alias("x"), (y + dy).alias("y")) for dx, dy in ends))
    table_ = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), F.array(ring((-9, 0), (0, -7), (11, 0), (0, 6)), ring((-2, -2), (-2, 2), (3, 0))).alias("rings"))
    return polygons.points_in_polygons(points(spark, d).select("event_id", "lat", "lon"), "lat", "lon", table_, "k").select("event_id", "k")


_PIXELS = "(SELECT CAST(vec_id AS VARCHAR) AS scene, CASE WHEN vec_id % 2 = 0 THEN 'pre' ELSE 'post' END AS period, CASE WHEN p < 32 THEN 'vv' ELSE 'vh' END AS band, (p % 32) // 8 AS y, p % 8 AS x, v::DOUBLE AS value FROM (SELECT vec_id, unnest(range(0, 64)) AS p, unnest(embedding) AS v FROM embeddings))"


def _pixels(spark, d):
    """Embeddings as two bands of tiles of 4 x 8 pixels, dealt to a period before and one after."""
    px = table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("p", "v"))
    return px.select(
        F.col("vec_id").cast("string").alias("scene"),
        F.when(F.col("vec_id") % 2 == 0, "pre").otherwise("post").alias("period"),
        F.when(F.col("p") < 32, "vv").otherwise("vh").alias("band"),
        F.floor((F.col("p") % 32) / 8).alias("y"),
        (F.col("p") % 8).cast("bigint").alias("x"),
        F.col("v").cast("double").alias("value"),
    )


@query(f"""WITH px AS {_PIXELS}, n AS (SELECT count(DISTINCT scene) FILTER (WHERE period = 'pre') AS n0, count(DISTINCT scene) FILTER (WHERE period = 'post') AS n1 FROM px),
s AS (SELECT y, x, band, avg(value) FILTER (WHERE period = 'pre') AS m0, avg(value) FILTER (WHERE period = 'post') AS m1, stddev_samp(value) FILTER (WHERE period = 'pre') AS s0, stddev_samp(value) FILTER (WHERE period = 'post') AS s1 FROM px GROUP BY ALL)
SELECT y, x, round(max(CASE WHEN sqrt(s0 * s0 / n0 + s1 * s1 / n1) > 0 THEN abs(m0 - m1) / sqrt(s0 * s0 / n0 + s1 * s1 / n1) END), 6) AS t FROM s, n GROUP BY y, x""")
def welch_t(spark, d):
    return raster.welch_t(_pixels(spark, d)).select("y", "x", F.round("t", 6).alias("t"))


@query("SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(*) FROM lineitem) AS lines")
def coverage_total(spark, d):
    return table(spark, d, "orders").agg(F.count("*").alias("orders")).crossJoin(table(spark, d, "lineitem").agg(F.count("*").alias("lines")))


# Windows


@query("SELECT c_custkey, c_nationkey, c_mktsegment FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_acctbal DESC, c_custkey) = 1")
def dedup_row_number(spark, d):
    return relate.dedup(table(spark, d, "customer"), ["c_nationkey", "c_mktsegment"], [F.desc("c_acctbal"), "c_custkey"]).select("c_custkey", "c_nationkey", "c_mktsegment")


@query("SELECT user_id, event_type, event_id FROM events WHERE user_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_type, event_id) = 1")
def first_seen_wins(spark, d):
    return relate.first_seen(table(spark, d, "events"), "user_id", ["event_type", "event_id"]).select("user_id", "event_type", "event_id")


@query("SELECT conv_id, turn, role FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1")
def latest_per_key(spark, d):
    return relate.latest(table(spark, d, "conversations").select("conv_id", "turn", "role"), ["conv_id"], ["turn"])


@query("""SELECT event_id, CASE WHEN s > 0 THEN round((value - m) / s, 5) END AS z FROM (
SELECT event_id, value, avg(value) OVER w AS m, stddev_samp(value) OVER w AS s FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))""")
def zscore_anomaly(spark, d):
    return relate.zscore(table(spark, d, "events"), ["event_type"], ["ts", "event_id"], "value", 24, F.date_trunc("day", "ts")).select("event_id", F.round("z", 5).alias("z"))


def _box_sql(columns: dict[str, str]) -> str:
    """Means of expressions over 7 x 7 boxes of the tiles, edges reflected: every pixel joined to its box."""
    mirror = lambda v, n: f"CASE WHEN {v} < 0 THEN -{v} - 1 WHEN {v} >= {n} THEN 2 * {n} - 1 - {v} ELSE {v} END"
    means = ", ".join(f"avg({e}) AS {n}" for n, e in columns.items())
    at = f"(SELECT a.scene, a.band, a.y, a.x, {mirror('(a.y + dy)', 4)} AS by, {mirror('(a.x + dx)', 8)} AS bx FROM px a, range(-3, 4) r(dy), range(-3, 4) q(dx))"
    return f"SELECT k.scene, k.band, k.y, k.x, {means} FROM {at} k JOIN px b ON b.scene = k.scene AND b.band = k.band AND b.y = k.by AND b.x = k.bx GROUP BY ALL"


@query(f"WITH px AS {_PIXELS} SELECT scene, band, y, x, round(m, 6) AS m FROM ({_box_sql({'m': 'b.value'})})")
def box_mean_2d(spark, d):
    px = _pixels(spark, d)
    return raster.box_mean(px.select("scene", "band", "y", "x", F.col("value").alias("m")), ["m"]).select("scene", "band", "y", "x", F.round("m", 6).alias("m"))


@query(f"""WITH px AS {_PIXELS}, l AS ({_box_sql({'m': 'b.value', 's': 'b.value * b.value'})}), o AS (SELECT scene, band, var_pop(value) AS o FROM px GROUP BY ALL)
SELECT scene, band, y, x, round(CASE WHEN o > 0 THEN m + greatest(s - m * m, 0) / (greatest(s - m * m, 0) + o) * (value - m) ELSE value END, 6) AS value FROM px JOIN l USING (scene, band, y, x) JOIN o USING (scene, band)""")
def lee_filter(spark, d):
    px = _pixels(spark, d)
    return raster.lee_filter(px).select("scene", "band", "y", "x", F.round("value", 6).alias("value"))


# Sorts and limits


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderstatus, o_totalprice DESC, o_orderkey")
def sort_multi(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice").orderBy("o_orderstatus", F.desc("o_totalprice"), "o_orderkey")


@query("SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id) ORDER BY quality DESC NULLS LAST, doc_id")
def sort_nulls_last(spark, d):
    df = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left").select("doc_id", "quality")
    return df.orderBy(F.desc_nulls_last("quality"), "doc_id")


@query("SELECT event_id, CASE WHEN event_id % 6 = 0 THEN NULL ELSE value END AS v FROM events ORDER BY CASE WHEN event_id % 6 = 0 THEN 1 ELSE 0 END, coalesce(v, 0), event_id")
def sort_case_key(spark, d):
    df = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 6 != 0, F.col("value")).alias("v"))
    return df.orderBy(F.when(F.col("v").isNull(), 1).otherwise(0), F.coalesce("v", F.lit(0.0)), "event_id")


@query("SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 50")
def limit_rows(spark, d):
    return table(spark, d, "orders").select("o_orderkey").orderBy("o_orderkey").limit(50)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def top_k(spark, d):
    return shape.top_k(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 25)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY CAST('0x' || left(md5('5|' || o_orderkey), 12) AS BIGINT), o_orderkey LIMIT 500")
def sample_rows(spark, d):
    return shape.hash_sample(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], rows=500, seed=5)


# Sets


_SENSORS = """SELECT event_id, value AS bright, CAST(user_id AS VARCHAR) AS confidence, 'a' AS sensor FROM events WHERE event_type = 'click'
UNION ALL SELECT event_id, value * 2, event_type, 'b' FROM events WHERE event_type = 'view'"""


@query(_SENSORS)
def union_aligned(spark, d):
    e = table(spark, d, "events")
    a = e.where("event_type = 'click'").select("event_id", F.col("value").alias("bright_ti4"), "user_id")
    b = e.where("event_type = 'view'").select("event_id", (F.col("value") * 2).alias("brightness"), "event_type")
    return shape.union_aligned(
        {"a": (a, {"event_id": F.col("event_id"), "bright": F.col("bright_ti4"), "confidence": F.col("user_id").cast("string")}), "b": (b, {"event_id": F.col("event_id"), "bright": F.col("brightness"), "confidence": F.col("event_type")})}
    )


@query("SELECT count(*) AS n, 1 AS skipped FROM (SELECT s_suppkey FROM supplier UNION ALL SELECT c_custkey FROM customer)")
def union_tolerant(spark, d):
    sources = [("suppliers", lambda: table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"))), ("gone", lambda: readers.scan_parquet(spark, scratch(spark, "absent"))), ("customers", lambda: table(spark, d, "customer").select(F.col("c_custkey").alias("id")))]
    df, skipped = readers.union_tolerant(sources)
    return df.agg(F.count("*").alias("n"), F.lit(len(skipped)).alias("skipped"))


@query("SELECT o_orderkey, 'open' AS state FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT o_orderkey, 'closed' FROM orders WHERE o_orderstatus = 'F'")
def union_disjoint_states(spark, d):
    o = table(spark, d, "orders")
    return o.where("o_orderstatus = 'O'").select("o_orderkey", F.lit("open").alias("state")).unionByName(o.where("o_orderstatus = 'F'").select("o_orderkey", F.lit("closed").alias("state")))


@query("SELECT c_nationkey AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_suppkey % 2 = 0")
def except_rows(spark, d):
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).subtract(table(spark, d, "supplier").where("s_suppkey % 2 = 0").select("s_nationkey"))


@query("SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def intersect_rows(spark, d):
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).intersect(table(spark, d, "supplier").select("s_nationkey"))

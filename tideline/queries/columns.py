"""Queries of projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalars, spatial
from ..operators import shape
from .base import POINTS, cell_sql, lat_sql, lon_sql, parent_sql, points, query, table

BOX = (12.0, 20.0, 42.0, 65.0)
_BOX = "lat BETWEEN 12.0 AND 42.0 AND lon BETWEEN 20.0 AND 65.0"


@query("SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status, o_totalprice AS total_price, o_orderpriority AS priority FROM orders")
def project_rename(spark, d):
    return shape.select_as(table(spark, d, "orders"), {"order_id": "o_orderkey", "customer_id": "o_custkey", "status": "o_orderstatus", "total_price": "o_totalprice", "priority": "o_orderpriority"})


@query("SELECT l_orderkey, CAST(l_linenumber - 1 AS BOOLEAN) AS later, CAST(l_quantity AS VARCHAR)::DOUBLE AS qty, CAST(l_shipdate AS DATE) AS shipped FROM lineitem")
def cast_columns(spark, d):
    df = table(spark, d, "lineitem").select("l_orderkey", (F.col("l_linenumber") - 1).alias("later"), F.col("l_quantity").cast("string").alias("qty"), F.col("l_shipdate").alias("shipped"))
    return shape.cast_to(df, {"later": "boolean", "qty": "double", "shipped": "date"})


@query("SELECT * EXCLUDE (s_name, s_acctbal) FROM supplier")
def select_except(spark, d):
    return shape.drop_columns(table(spark, d, "supplier"), ["s_name", "s_acctbal"])


@query("SELECT s_suppkey, upper(s_name) AS s_name, s_nationkey, s_acctbal FROM supplier")
def select_replace(spark, d):
    return shape.select_replace(table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal"), s_name=F.upper("s_name"))


@query("SELECT event_id, TIMESTAMP '2024-02-01 06:00:00' AS snapshot_time, DATE '2024-02-01' AS snapshot_date FROM events")
def stamp_snapshot(spark, d):
    return shape.stamp(table(spark, d, "events").select("event_id"), "2024-02-01 06:00:00")


@query("SELECT c_custkey AS id, 'customer' AS origin FROM customer UNION ALL SELECT s_suppkey, 'supplier' FROM supplier")
def tag_source(spark, d):
    return shape.union_aligned({"customer": (table(spark, d, "customer"), {"id": F.col("c_custkey")}), "supplier": (table(spark, d, "supplier"), {"id": F.col("s_suppkey")})}, tag="origin")


@query("SELECT p_partkey, CASE WHEN p_size <= 10 THEN 'small' WHEN p_size <= 30 THEN 'medium' ELSE 'large' END AS size_class FROM part")
def case_category(spark, d):
    return table(spark, d, "part").select("p_partkey", F.when(F.col("p_size") <= 10, "small").when(F.col("p_size") <= 30, "medium").otherwise("large").alias("size_class"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def struct_access(spark, d):
    nested = table(spark, d, "events").select("event_id", F.struct(F.from_json("props", "k int").alias("properties")).alias("f"))
    return shape.select_as(nested, {"event_id": "event_id", "k": "f.properties.k"})


@query("SELECT vec_id, embedding[1] AS first, embedding[64] AS last, NULL::FLOAT AS beyond FROM embeddings")
def list_index(spark, d):
    at = lambda i: F.get("embedding", F.lit(i - 1))
    return table(spark, d, "embeddings").select("vec_id", at(1).alias("first"), at(64).alias("last"), at(65).alias("beyond"))


@query("SELECT page_id, url FROM pages")
def drop_protected_columns(spark, d):
    return shape.drop_columns(table(spark, d, "pages").select("page_id", "url", "html"), ["html"])


@query(f"SELECT event_id, {_BOX} AS in_region, event_type IS NOT NULL AS typed FROM {POINTS}")
def boolean_flag(spark, d):
    return points(spark, d).select("event_id", spatial.in_bbox(F.col("lat"), F.col("lon"), BOX).alias("in_region"), F.col("event_type").isNotNull().alias("typed"))


@query(f"SELECT event_id, lat, lon FROM {POINTS} WHERE {_BOX}")
def bbox_filter(spark, d):
    return points(spark, d).where(spatial.in_bbox(F.col("lat"), F.col("lon"), BOX)).select("event_id", "lat", "lon")


_C5 = cell_sql("lat", "lon", 5)


@query(f"SELECT event_id, c AS cell FROM (SELECT event_id, {_C5} AS c FROM {POINTS}) WHERE {lat_sql('c', 5)} BETWEEN 12.0 AND 42.0 AND {lon_sql('c', 5)} BETWEEN 20.0 AND 65.0")
def cell_center_bbox(spark, d):
    cells = points(spark, d).select("event_id", spatial.cell_id(F.col("lat"), F.col("lon"), 5).alias("cell"))
    return cells.where(spatial.center_in_bbox(F.col("cell"), 5, BOX))


@query("SELECT c_custkey, c_name FROM customer WHERE c_nationkey IN (0, 2, 4, 7, 20)")
def in_list(spark, d):
    return table(spark, d, "customer").where(F.col("c_nationkey").isin(0, 2, 4, 7, 20)).select("c_custkey", "c_name")


@query("SELECT d.doc_id, quality FROM documents d LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL")
def not_null_filter(spark, d):
    return table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left").where(F.col("quality").isNotNull()).select("doc_id", "quality")


@query("SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS sqldate FROM events WHERE CAST(strftime(ts, '%Y%m%d') AS INTEGER) >= CAST(strftime(DATE '2024-02-10' - INTERVAL 30 DAY, '%Y%m%d') AS INTEGER)")
def rolling_lookback(spark, d):
    df = table(spark, d, "events").select("event_id", F.date_format("ts", "yyyyMMdd").cast("int").alias("sqldate"))
    return df.where(F.col("sqldate") >= scalars.int_days_before("2024-02-10", 30))


_SENTINEL = "CASE WHEN event_id % 5 = 0 THEN 'null' WHEN event_id % 7 = 0 THEN NULL ELSE event_type END"


@query(f"SELECT event_id, t FROM (SELECT event_id, {_SENTINEL} AS t FROM events) WHERE t IS NOT NULL AND t <> 'null'")
def null_sentinel_filter(spark, d):
    return table(spark, d, "events").select("event_id", F.expr(_SENTINEL).alias("t")).where(F.col("t").isNotNull() & (F.col("t") != "null"))


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 5000")
def threshold_filter(spark, d):
    return table(spark, d, "customer").where(F.col("c_acctbal") >= 5000).select("c_custkey", "c_acctbal")


@query("SELECT p_partkey, p_type FROM part WHERE lower(p_type) LIKE '%st%' OR lower(p_type) LIKE '%br%'")
def substring_match_any(spark, d):
    return table(spark, d, "part").where(scalars.contains_any(F.col("p_type"), ["st", "br"])).select("p_partkey", "p_type")


@query(f"SELECT event_id FROM {POINTS} WHERE lon > 20 AND lon < 65 AND lat > 12 AND lat < 42")
def point_in_envelope(spark, d):
    return points(spark, d).where(spatial.within_envelope(spatial.point(F.col("lon"), F.col("lat")), 20, 12, 65, 42)).select("event_id")


_RING = [(20.005, 10.005), (70.005, 15.005), (60.005, 45.005), (40.005, 30.005), (15.005, 40.005)]
_CROSS = " + ".join(
    f"CASE WHEN ({y1}::DOUBLE > lat) <> ({y2}::DOUBLE > lat) AND lon < ({x2}::DOUBLE - {x1}::DOUBLE) * (lat - {y1}::DOUBLE) / ({y2}::DOUBLE - {y1}::DOUBLE) + {x1}::DOUBLE THEN 1 ELSE 0 END"
    for (x1, y1), (x2, y2) in zip(_RING, _RING[1:] + _RING[:1], strict=True)
)


@query(f"SELECT event_id FROM {POINTS} WHERE ({_CROSS}) % 2 = 1")
def point_in_polygon(spark, d):
    return points(spark, d).where(spatial.in_ring(F.col("lon"), F.col("lat"), _RING)).select("event_id")


_RULES = {"bulk": {"size": ["1", "2", "3"], "brand": ["Brand#11"]}, "typed": {"type": True}, "never": {"absent": True}}


@query("""SELECT p_partkey, 'typed' AS category FROM part WHERE p_type IS NOT NULL
UNION ALL SELECT p_partkey, 'bulk' FROM part WHERE p_size IN (1, 2, 3) OR p_brand = 'Brand#11'""")
def osm_tag_filter(spark, d):
    tagged = table(spark, d, "part").where("p_type is not null").select("p_partkey", F.create_map(F.lit("size"), F.col("p_size").cast("string"), F.lit("brand"), "p_brand", F.lit("type"), "p_type").alias("tags"))
    return shape.classify_tags(tagged, _RULES).select("p_partkey", "category")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING n > 1")
def having_alias(spark, d):
    return table(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).where("n > 1")


# Text


@query("SELECT doc_id, source || ':' || lang AS tag FROM documents")
def str_concat(spark, d):
    return table(spark, d, "documents").select("doc_id", F.concat("source", F.lit(":"), "lang").alias("tag"))


@query("SELECT event_id, nullif(trim(CASE WHEN event_id % 4 = 0 THEN '   ' ELSE ' ' || event_type || ' ' END), '') AS t FROM events")
def str_clean_empty(spark, d):
    return table(spark, d, "events").select("event_id", scalars.clean_empty(F.expr("CASE WHEN event_id % 4 = 0 THEN '   ' ELSE concat(' ', event_type, ' ') END")).alias("t"))


@query("SELECT p_partkey, string_split(replace(p_name, ' ', ';'), ';') AS words FROM part")
def str_split_list(spark, d):
    return table(spark, d, "part").select("p_partkey", scalars.split_list(F.replace("p_name", F.lit(" "), F.lit(";"))).alias("words"))


@query("SELECT page_id, sha256(regexp_replace(coalesce(html, ''), '<[^>]+>', '', 'g')) AS text_sha256 FROM pages")
def str_strip_html(spark, d):
    return table(spark, d, "pages").select("page_id", F.sha2(scalars.strip_html(F.col("html")), 256).alias("text_sha256"))


@query("SELECT page_id, regexp_extract(url, '://([^/?#]+)', 1) AS host FROM pages")
def str_regex_extract(spark, d):
    return table(spark, d, "pages").select("page_id", F.regexp_extract("url", "://([^/?#]+)", 1).alias("host"))


_NAMES = {"the": "EN", "with": "EN", "para": "ES", "nicht": "DE", "avec": "FR", "ciónes": "ES", "Über": "DE"}


@query(
    "SELECT doc_id, concat_ws(',', "
    + ", ".join(f"CASE WHEN {' OR '.join(rf"regexp_matches(lower(text), '(^|[^\p{{L}}\p{{N}}_]){n.lower()}($|[^\p{{L}}\p{{N}}_])')" for n, c in _NAMES.items() if c == code)} THEN '{code}' END" for code in sorted({*_NAMES.values()}))
    + ") AS codes FROM documents"
)
def keyword_tags(spark, d):
    return table(spark, d, "documents").select("doc_id", scalars.keyword_tags([F.col("text")], _NAMES).alias("codes"))


@query("SELECT p_partkey, printf('%06x', p_partkey) AS hex6, printf('%04d', p_size) AS padded FROM part")
def str_format(spark, d):
    return table(spark, d, "part").select("p_partkey", F.format_string("%06x", "p_partkey").alias("hex6"), F.format_string("%04d", "p_size").alias("padded"))


@query("SELECT c_custkey FROM customer WHERE lower(c_mktsegment) LIKE '%build%'")
def str_lower_like(spark, d):
    return table(spark, d, "customer").where(F.contains(F.lower("c_mktsegment"), F.lit("build"))).select("c_custkey")


@query("SELECT doc_id, coalesce(CASE WHEN doc_id % 3 = 0 THEN NULL ELSE lang END, '') AS lang FROM documents")
def str_coalesce_blank(spark, d):
    return table(spark, d, "documents").select("doc_id", F.coalesce(F.expr("CASE WHEN doc_id % 3 = 0 THEN NULL ELSE lang END"), F.lit("")).alias("lang"))


@query("SELECT conv_id, string_agg(role, ';' ORDER BY turn) AS roles FROM conversations GROUP BY conv_id")
def list_join(spark, d):
    turns = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("turns"))
    return turns.select("conv_id", scalars.join_field(F.col("turns"), "role").alias("roles"))


# Dates


@query("SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def date_from_int(spark, d):
    return table(spark, d, "events").select("event_id", scalars.date_from_int(F.date_format("ts", "yyyyMMdd").cast("int")).alias("day"))


@query("SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders")
def date_from_month(spark, d):
    return table(spark, d, "orders").select("o_orderkey", scalars.date_from_month(F.date_format("o_orderdate", "yyyy-MM")).alias("month"))


@query("SELECT event_id, make_timestamp(1704067200000000 + event_id * 1000000) AS at FROM events")
def ts_from_epoch_s(spark, d):
    return table(spark, d, "events").select("event_id", F.timestamp_seconds(F.lit(1704067200) + F.col("event_id")).cast("timestamp_ntz").alias("at"))


@query("SELECT event_id, epoch_ms(1704067200000 + event_id * 1234) AS at, CAST(epoch_ms(1704067200000 + event_id * 1234) AS DATE) AS day FROM events")
def ts_from_epoch_ms(spark, d):
    at = F.timestamp_millis(F.lit(1704067200000) + F.col("event_id") * 1234)
    return table(spark, d, "events").select("event_id", at.cast("timestamp_ntz").alias("at"), at.cast("date").alias("day"))


@query("SELECT event_id, date_trunc('second', ts) AS at FROM events")
def ts_from_iso(spark, d):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return table(spark, d, "events").select("event_id", iso.cast("timestamp").cast("timestamp_ntz").alias("at"))


@query("SELECT o_orderkey, CAST(o_orderdate - INTERVAL 30 DAY AS DATE) AS before, strftime(o_orderdate - INTERVAL 30 DAY, '%Y%m%d') AS text FROM orders")
def date_minus_interval(spark, d):
    before = F.date_sub(F.col("o_orderdate").cast("date"), 30)
    return table(spark, d, "orders").select("o_orderkey", before.alias("before"), F.date_format(before, "yyyyMMdd").alias("text"))


@query("SELECT event_id, CASE WHEN day >= DATE '2024-01-15' - 30 AND day < DATE '2024-01-15' THEN 'pre' WHEN day >= DATE '2024-01-15' AND day <= DATE '2024-01-15' + 7 THEN 'post' END AS period FROM (SELECT event_id, CAST(ts AS DATE) AS day FROM events)")
def event_window_bounds(spark, d):
    return table(spark, d, "events").select("event_id", scalars.event_window(F.col("ts").cast("date"), "2024-01-15", 1, 7).alias("period"))


@query("SELECT user_id, CAST(1704067200 + (i - 1) * 1800 AS BIGINT) AS at, v AS value FROM (SELECT user_id, unnest(vs) AS v, unnest(range(1, len(vs) + 1)) AS i FROM (SELECT user_id, list(value ORDER BY event_id) AS vs FROM events GROUP BY user_id)) WHERE v IS NOT NULL")
def series_timestamp(spark, d):
    values = user_series(table(spark, d, "events").select("user_id", "event_id", F.col("value").alias("v")))
    return values.select("user_id", F.inline(scalars.series(F.col("first") * 1800 + 1704067200, F.lit(1800), F.col("vs"))))


def user_series(events, rows: int = 1000):
    """(user_id, first, vs) from (user_id, event_id, v): each user's values in the order of events, as arrays of at most ``rows``
    from place ``first`` on, so that no array grows with a user."""
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")) - 1
    placed = events.withColumn("place", place).withColumn("first", (F.floor(F.col("place") / rows) * rows).cast("bigint"))
    arrays = placed.groupBy("user_id", "first").agg(F.array_sort(F.collect_list(F.struct("place", "v"))).alias("p"))
    return arrays.select("user_id", "first", F.transform("p", lambda s: s.v).alias("vs"))


# Numbers


_RAW = "CASE WHEN event_id % 11 = 0 THEN '-' WHEN event_id % 13 = 0 THEN 'x' WHEN event_id % 17 = 0 THEN 'n/a' ELSE CAST(event_id AS {}) END"


@query(f"SELECT event_id, TRY_CAST(nullif(nullif({_RAW.format('VARCHAR')}, '-'), 'x') AS DOUBLE) AS v FROM events")
def try_cast_numeric(spark, d):
    return table(spark, d, "events").select("event_id", scalars.number_or_null(F.expr(_RAW.format("STRING")), "-", "x").alias("v"))


@query("SELECT l_orderkey, l_linenumber, round(l_extendedprice / 7, 4) AS r1, round(l_quantity / 3, 3) AS r3 FROM lineitem")
def math_round(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(F.col("l_extendedprice") / 7, 4).alias("r1"), F.round(F.col("l_quantity") / 3, 3).alias("r3"))


_ORBIT = {"motion": "CASE WHEN event_id % 50 = 0 THEN 0.0::DOUBLE ELSE 1 + (event_id % 150)::DOUBLE / 10 END", "inc": "CASE WHEN event_id % 31 <> 0 THEN (event_id % 180)::DOUBLE END", "node": "(event_id % 360)::DOUBLE", "ano": "(event_id * 7 % 360)::DOUBLE"}
#: (event_id, lat, lon, alt_km) of satellites made from events.
_TRACK = "(WITH e AS (SELECT event_id, ts, " + ", ".join(f"{v} AS {k}" for k, v in _ORBIT.items()) + f""" FROM events),
m AS (SELECT *, (epoch_us(TIMESTAMP '2024-01-20 00:00:00') - epoch_us(ts)) / 1e6::DOUBLE AS seconds FROM e WHERE motion > 0),
a AS (SELECT *, pow({scalars.MU}::DOUBLE * pow(86400.0::DOUBLE / motion / (2 * 3.141592653589793::DOUBLE), 2.0::DOUBLE), 1.0::DOUBLE / 3.0::DOUBLE) AS axis, ano + 360.0::DOUBLE * motion * seconds / 86400.0::DOUBLE AS m0 FROM m),
b AS (SELECT *, m0 - 360 * floor(m0 / 360) AS u, (seconds - {scalars.SIDEREAL}::DOUBLE * floor(seconds / {scalars.SIDEREAL}::DOUBLE)) / {scalars.SIDEREAL}::DOUBLE * 360 AS turned FROM a),
p AS (SELECT *, degrees(asin(sin(radians(coalesce(inc, 0))) * sin(radians(u)))) AS la, node + u - turned AS l0 FROM b),
q AS (SELECT *, l0 - 360 * floor(l0 / 360) AS lo FROM p)
SELECT e.event_id, round(la, 4) AS lat, round(CASE WHEN lo > 180 THEN lo - 360 ELSE lo END, 4) AS lon, round(axis - 6371.0::DOUBLE, 1) AS alt_km FROM e LEFT JOIN q USING (event_id))"""


def _orbit_columns():
    return {k: F.expr(v.replace("0.0::DOUBLE", "0.0D").replace("::DOUBLE", "").replace("/ 10", "/ 10.0D")).cast("double") for k, v in _ORBIT.items()}


@query(f"SELECT * FROM {_TRACK}")
def subsatellite_point(spark, d):
    e = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("epoch"), *(c.alias(k) for k, c in _orbit_columns().items()))
    p = scalars.subsatellite(F.col("epoch"), F.col("motion"), F.col("inc"), F.col("node"), F.col("ano"), F.lit("2024-01-20 00:00:00").cast("timestamp"))
    return e.select("event_id", p.alias("p")).select("event_id", "p.lat", "p.lon", "p.alt_km")


_ODD = {"duck": "CASE WHEN event_id % 10 = 0 THEN 'inf'::DOUBLE WHEN event_id % 10 = 1 THEN 'nan'::DOUBLE ELSE value END", "spark": "CASE WHEN event_id % 10 = 0 THEN double('Infinity') WHEN event_id % 10 = 1 THEN double('NaN') ELSE value END"}


@query(f"SELECT event_id, isfinite({_ODD['duck']}) AS finite FROM events")
def math_isfinite(spark, d):
    return table(spark, d, "events").select("event_id", scalars.is_finite(F.expr(_ODD["spark"])).alias("finite"))


@query(f"SELECT event_type, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, round(max(v), 6) AS most FROM (SELECT event_type, CASE WHEN event_id % 10 = 1 THEN NULL ELSE value END AS v FROM events) GROUP BY event_type")
def math_nanaware(spark, d):
    v = scalars.nan_to_null(F.expr("CASE WHEN event_id % 10 = 1 THEN double('NaN') ELSE value END"))
    return table(spark, d, "events").select("event_type", v.alias("v")).groupBy("event_type").agg(F.round(F.avg("v"), 6).alias("mean"), F.round(F.stddev_samp("v"), 6).alias("std"), F.round(F.max("v"), 6).alias("most"))


def _lines(spark, d):
    """A line for each user through the positions of the user's events."""
    p = points(spark, d).groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", F.col("lon").alias("x"), F.col("lat").alias("y")))).alias("p"))
    return p.select("user_id", F.transform("p", lambda s: F.struct(s.x.alias("x"), s.y.alias("y"))).alias("line"))


_SEGMENTS = f"(SELECT user_id, event_id, lon AS x1, lat AS y1, lead(lon) OVER w AS x2, lead(lat) OVER w AS y2, row_number() OVER w AS i FROM {POINTS} WINDOW w AS (PARTITION BY user_id ORDER BY event_id))"


@query(f"""SELECT user_id, round(coalesce(sum(CASE WHEN abs(x1 - x2) <= 180 THEN asin(sqrt(pow(sin(radians(y2 - y1) / 2), 2) + cos(radians(y1)) * cos(radians(y2)) * pow(sin(radians(x2 - x1) / 2), 2))) * (2 * 6371.0088::DOUBLE) END), 0), 3) AS km,
CAST(count(*) FILTER (WHERE abs(x1 - x2) > 180) AS INTEGER) AS skipped FROM {_SEGMENTS} GROUP BY user_id""")
def haversine_length(spark, d):
    return _lines(spark, d).select("user_id", spatial.line_length_km(F.col("line")).alias("l")).select("user_id", F.round("l.km", 3).alias("km"), "l.skipped")


# Nested values


@query("SELECT c_custkey, upper(c_name) AS name FROM customer")
def unnest_features(spark, d):
    from .tables_in_out import scan_json_document

    return scan_json_document(spark, d).select("c_custkey", F.upper("c_name").alias("name"))


@query("SELECT event_id, CASE WHEN event_id % 9 = 0 THEN NULL ELSE value END AS value, event_id % 2 = 0 AS even FROM events WHERE event_id % 9 <> 0")
def unnest_positional(spark, d):
    raw = F.concat(F.lit("[["), F.col("event_id"), F.lit(","), F.when(F.col("event_id") % 9 == 0, "null").otherwise(F.col("value").cast("string")), F.lit(",\"skip\","), (F.col("event_id") % 2 == 0).cast("string"), F.lit("]]"))
    rows = table(spark, d, "events").select(F.explode(F.from_json(raw, "array<array<string>>")).alias("s"))
    return rows.where(F.get("s", F.lit(1)).isNotNull()).select(F.get("s", F.lit(0)).cast("bigint").alias("event_id"), F.get("s", F.lit(1)).cast("double").alias("value"), F.get("s", F.lit(3)).cast("boolean").alias("even"))


@query("SELECT vec_id, unnest(range(0, 64))::INTEGER AS i, unnest(embedding) AS a, unnest(list_concat(embedding[1:60], [NULL, NULL, NULL, NULL])) AS b FROM embeddings")
def zip_parallel_arrays(spark, d):
    df = table(spark, d, "embeddings").select("vec_id", F.sequence(F.lit(0), F.lit(63)).alias("i"), F.col("embedding").alias("a"), F.slice("embedding", 1, 60).alias("b"))
    return df.select("vec_id", F.inline(scalars.zip_arrays(i=F.col("i"), a=F.col("a"), b=F.col("b"))))


@query("SELECT vec_id, CAST((i - 1) * 1800 AS BIGINT) AS at, v AS value FROM (SELECT vec_id, unnest(embedding) AS v, unnest(range(1, 65)) AS i FROM embeddings) WHERE i % 4 <> 0")
def expand_series(spark, d):
    values = F.transform("embedding", lambda v, i: F.when((i + 1) % 4 != 0, v))
    return table(spark, d, "embeddings").select("vec_id", F.inline(scalars.series(F.lit(None).cast("bigint"), F.lit(None).cast("bigint"), values)))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def flatten_mixed_list(spark, d):
    """Items are objects or lists of one object, by turns."""
    item = F.concat(F.lit('{"id":'), F.col("event_id"), F.lit(',"p":'), "props", F.lit("}"))
    doc = F.concat(F.lit("["), F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("["), item, F.lit("]"))).otherwise(item), F.lit("]"))
    table(spark, d, "events").select(F.parse_json(doc).alias("v")).createOrReplaceTempView("tideline_mixed")
    return spark.sql("""
        WITH outer_items AS (SELECT i.value AS x FROM tideline_mixed, LATERAL variant_explode(v) AS i),
        flat AS (SELECT x FROM outer_items WHERE schema_of_variant(x) NOT LIKE 'ARRAY%' UNION ALL SELECT j.value FROM (SELECT x FROM outer_items WHERE schema_of_variant(x) LIKE 'ARRAY%') o, LATERAL variant_explode(o.x) AS j)
        SELECT variant_get(x, '$.id', 'bigint') AS event_id, variant_get(x, '$.p.k', 'int') AS k FROM flat""")


@query("SELECT user_id, last(value ORDER BY event_id) AS last, CAST(count(*) AS INTEGER) AS n FROM events GROUP BY user_id")
def latest_of_array(spark, d):
    parts = user_series(table(spark, d, "events").select("user_id", "event_id", F.col("value").alias("v"))).select("user_id", "first", scalars.last_of(F.col("vs")).alias("last"), F.size("vs").alias("n"))
    return parts.groupBy("user_id").agg(F.max_by("last", "first").alias("last"), F.sum("n").cast("int").alias("n"))


@query("SELECT user_id, first(value ORDER BY event_id) AS first FROM events GROUP BY user_id")
def first_of_array(spark, d):
    parts = user_series(table(spark, d, "events").select("user_id", "event_id", F.col("value").alias("v")))
    return parts.where("first = 0").select("user_id", scalars.first_of(F.col("vs")).alias("first"))


@query("""SELECT event_id, '{"event_id":' || event_id || ',"t":"' || event_type || '"}' AS doc, json_extract_string(props, '$.k') AS k FROM events""")
def json_to_text(spark, d):
    return table(spark, d, "events").select("event_id", F.to_json(F.struct("event_id", F.col("event_type").alias("t"))).alias("doc"), F.get_json_object("props", "$.k").alias("k"))


@query("SELECT p_partkey, CAST(p_size AS VARCHAR) AS size, p_brand AS brand, NULL::VARCHAR AS absent FROM part")
def explode_tags(spark, d):
    tagged = table(spark, d, "part").select("p_partkey", F.create_map(F.lit("size"), F.col("p_size").cast("string"), F.lit("brand"), "p_brand").alias("tags"))
    return shape.tags_to_columns(tagged, ["size", "brand", "absent"]).drop("tags")


@query("SELECT p_partkey FROM part WHERE list_contains(string_split(p_type, ' '), 'STEEL') OR list_has_any(string_split(p_type, ' '), ['SMALL', 'ECONOMY'])")
def list_contains(spark, d):
    words = F.split("p_type", " ")
    return table(spark, d, "part").where(F.array_contains(words, "STEEL") | F.arrays_overlap(words, F.array(F.lit("SMALL"), F.lit("ECONOMY")))).select("p_partkey")


# Space


@query(f"SELECT event_id, lon AS x, lat AS y FROM {POINTS}")
def geo_point(spark, d):
    return points(spark, d).select("event_id", spatial.point(F.col("lon"), F.col("lat")).alias("p")).select("event_id", "p.x", "p.y")


@query(f"SELECT event_id, lon AS x, lat AS y FROM {POINTS} WHERE lon >= 0")
def geo_xy(spark, d):
    return points(spark, d).select("event_id", spatial.point(F.col("lon"), F.col("lat")).alias("p")).where("p.x >= 0").select("event_id", "p.x", "p.y")


@query(f"SELECT event_id, lon AS x, lat AS y FROM {POINTS}")
def geo_from_geojson(spark, d):
    p = points(spark, d).select("event_id", F.to_json(F.struct(F.lit("MultiLineString").alias("type"), F.array(F.array(F.array("lon", "lat"))).alias("coordinates"))).alias("g"))
    g = F.from_json("g", "type string, coordinates array<array<array<double>>>")
    return p.select("event_id", F.explode(F.flatten(g.coordinates)).alias("c")).select("event_id", F.get("c", F.lit(0)).alias("x"), F.get("c", F.lit(1)).alias("y"))


@query(f"""SELECT user_id, round(CASE WHEN w > 0 THEN sx / w ELSE fx END, 6) AS x, round(CASE WHEN w > 0 THEN sy / w ELSE fy END, 6) AS y FROM (
SELECT user_id, coalesce(sum(l), 0) AS w, sum(l * (x1 + x2) / 2) AS sx, sum(l * (y1 + y2) / 2) AS sy, first(x1 ORDER BY i) AS fx, first(y1 ORDER BY i) AS fy FROM (SELECT *, sqrt(pow(x1 - x2, 2) + pow(y1 - y2, 2)) AS l FROM {_SEGMENTS}) GROUP BY user_id)""")
def geo_centroid(spark, d):
    return _lines(spark, d).select("user_id", spatial.line_centroid(F.col("line")).alias("c")).select("user_id", F.round("c.x", 6).alias("x"), F.round("c.y", 6).alias("y"))


@query(f"SELECT user_id, x1 AS x, y1 AS y FROM (SELECT *, count(*) OVER (PARTITION BY user_id) AS n FROM {_SEGMENTS}) WHERE i = n // 2 + 1")
def geo_representative_point(spark, d):
    return _lines(spark, d).select("user_id", spatial.representative_point(F.col("line")).alias("p")).select("user_id", "p.x", "p.y")


@query(f"SELECT event_id, {cell_sql('lat', 'lon', 5)} AS cell_r5, {cell_sql('lat', 'lon', 7)} AS cell_r7, {cell_sql('lat', 'lon', 9)} AS cell_r9 FROM {POINTS}")
def cell_encode(spark, d):
    return spatial.with_cells(points(spark, d), "lat", "lon", [5, 7, 9]).select("event_id", "cell_r5", "cell_r7", "cell_r9")


_C7 = cell_sql("lat", "lon", 7)


@query(f"SELECT event_id, {lat_sql(_C7, 7)} AS clat, {lon_sql(_C7, 7)} AS clon FROM {POINTS}")
def cell_decode(spark, d):
    c = spatial.cell_id(F.col("lat"), F.col("lon"), 7)
    return points(spark, d).select("event_id", spatial.cell_lat(c, 7).alias("clat"), spatial.cell_lon(c, 7).alias("clon"))


@query(f"SELECT event_id, {parent_sql(_C7, 7, 5)} AS parent, {cell_sql(lat_sql(_C7, 7), lon_sql(_C7, 7), 9)} AS child FROM {POINTS}")
def cell_parent_child(spark, d):
    c = spatial.cell_id(F.col("lat"), F.col("lon"), 7)
    return points(spark, d).select("event_id", spatial.cell_parent(c, 7, 5).alias("parent"), spatial.cell_center_child(c, 7, 9).alias("child"))


@query(f"SELECT event_id, lower(printf('%x', {_C7})) AS hex, {_C7} AS back FROM {POINTS}")
def cell_text(spark, d):
    text = spatial.cell_text(spatial.cell_id(F.col("lat"), F.col("lon"), 7))
    return points(spark, d).select("event_id", text.alias("hex"), spatial.cell_from_text(text).alias("back"))


@query(f"""SELECT event_id, (c & 67108863) * (360.0::DOUBLE / 4096) - 180.0::DOUBLE AS west, ((c >> 26) & 67108863) * (180.0::DOUBLE / 2048) - 90.0::DOUBLE AS south,
((c & 67108863) + 1) * (360.0::DOUBLE / 4096) - 180.0::DOUBLE AS east, (((c >> 26) & 67108863) + 1) * (180.0::DOUBLE / 2048) - 90.0::DOUBLE AS north FROM (SELECT event_id, {_C5} AS c FROM {POINTS})""")
def cell_boundary(spark, d):
    b = spatial.cell_boundary(spatial.cell_id(F.col("lat"), F.col("lon"), 5), 5)
    return points(spark, d).select("event_id", b.alias("b")).selectExpr("event_id", "b[0].x AS west", "b[0].y AS south", "b[2].x AS east", "b[2].y AS north")


@query(f"SELECT event_id, {cell_sql('lat', 'lon', 5)} AS cell_r5, {cell_sql('lat', 'lon', 8)} AS cell_r8, {cell_sql('lat', 'lon', 10)} AS cell_r10 FROM {POINTS}")
def multires_cells(spark, d):
    return spatial.with_cells(points(spark, d), "lat", "lon", [5, 8, 10]).select("event_id", "cell_r5", "cell_r8", "cell_r10")


@query("""SELECT vec_id, y, x, 42.0::DOUBLE - y * (30.0::DOUBLE / 7) AS lat, 20.0::DOUBLE + x * (45.0::DOUBLE / 7) AS lon FROM (SELECT vec_id, p // 8 AS y, p % 8 AS x FROM (SELECT vec_id, unnest(range(0, 64)) AS p FROM embeddings)) WHERE y % 5 = 0 AND x % 5 = 0""")
def pixel_to_lonlat(spark, d):
    px = table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("p", "v")).select("vec_id", F.floor(F.col("p") / 8).alias("y"), (F.col("p") % 8).cast("bigint").alias("x"))
    px = px.where("y % 5 = 0 AND x % 5 = 0")
    return px.select("vec_id", "y", "x", spatial.pixel_to_lonlat(F.col("y"), F.col("x"), BOX, 8, 8).alias("p")).select("vec_id", "y", "x", "p.lat", "p.lon")

"""Queries of the end-to-end pipelines, on feeds derived from the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import spatial
from ..operators.catalog import Catalog
from ..plans import feeds
from ..session import scratch
from ..sources import sinks
from .base import POINTS, cell_sql, hilbert_sql, lat_sql, lon_sql, points, query, table
from .columns import _SEGMENTS, _TRACK, _lines, _orbit_columns, user_series
from .relations import _PIXELS, _box_sql, _pixels

RUN = "2024-02-01 06:00:00"
BOX = (12.0, 20.0, 42.0, 65.0)
_BOX = "lat BETWEEN 12.0 AND 42.0 AND lon BETWEEN 20.0 AND 65.0"
_STAMP = "TIMESTAMP '2024-02-01 06:00:00' AS snapshot_time"


def _stacked(tables):
    """All tables of a pipeline under one another by name, with ``table`` first; SQL says UNION ALL BY NAME."""
    out = None
    for name, df in tables.items():
        part = df.select(F.lit(name).alias("table"), "*")
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


_CELLS = ", ".join(f"{cell_sql('lat', 'lon', r)} AS cell_r{r}" for r in (5, 8, 10))


@query(f"SELECT event_id AS globaleventid, CAST(ts AS DATE) AS event_date, lat AS latitude, lon AS longitude, event_type AS actor1name, {_CELLS}, DATE '2024-02-01' AS snapshot_date FROM {POINTS} WHERE event_id % 20 <> 0 AND CAST(ts AS DATE) >= DATE '2024-02-10' - 30")
def pipe_news_events(spark, d):
    feed = points(spark, d).select(F.col("event_id").alias("GLOBALEVENTID"), F.date_format("ts", "yyyyMMdd").cast("int").alias("SQLDATE"), F.when(F.col("event_id") % 20 != 0, F.col("lat")).alias("ActionGeo_Lat"), F.col("lon").alias("ActionGeo_Long"), F.col("event_type").alias("Actor1Name"), F.col("props").alias("ArticleContent"))
    return feeds.news_events(feed, "2024-02-10", RUN)["events"].drop("snapshot_time")


_SEGMENT_NAMES = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query(f"""WITH c AS (SELECT CAST(c_nationkey AS VARCHAR) AS city, c_mktsegment AS country_code, CAST(round(c_acctbal * 100) AS BIGINT) AS population, c_custkey FROM customer WHERE round(c_acctbal * 100) >= 200000 QUALIFY row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY round(c_acctbal * 100) DESC, CAST(c_custkey % 90 AS DOUBLE), CAST(c_custkey AS DOUBLE)) = 1),
v AS (SELECT CAST(vec_id % 25 AS VARCHAR) AS city, {list(_SEGMENT_NAMES)}[CAST(vec_id // 25 % 5 AS INTEGER) + 1] AS country_code, CASE WHEN vec_id % 2 = 0 THEN 1.5::DOUBLE END AS lat, CAST(vec_id % 7 AS DOUBLE) AS elevation, embedding FROM embeddings),
j AS (SELECT city, country_code, population, coalesce(lat, CAST(c_custkey % 90 AS DOUBLE)) AS latitude, CAST(c_custkey AS DOUBLE) AS longitude, CAST(c_custkey % 90 AS DOUBLE) AS own, elevation, i, embedding[i] AS e FROM (SELECT *, unnest(range(1, 65)) AS i FROM v) JOIN c USING (city, country_code))
SELECT 'weather_hourly' AS "table", city, country_code, population, latitude, longitude, elevation, TIMESTAMP '2024-01-01' + INTERVAL (i - 1) HOUR AS time, e AS temperature, CASE WHEN i <= 40 THEN e END AS humidity, {_STAMP} FROM j
UNION ALL BY NAME SELECT 'weather_daily' AS "table", city, country_code, population, latitude, longitude, elevation, CAST(DATE '2024-01-01' + INTERVAL (i - 1) DAY AS DATE) AS date, e AS most, {_STAMP} FROM j
UNION ALL BY NAME SELECT 'air_quality' AS "table", city, country_code, population, own AS latitude, longitude, TIMESTAMP '2024-01-01' + INTERVAL (i - 1) HOUR AS time, e AS pm10, {_STAMP} FROM j WHERE i <= 24""")
def pipe_weather(spark, d):
    cities = table(spark, d, "customer").select(F.col("c_nationkey").cast("string").alias("city"), F.col("c_mktsegment").alias("country_code"), (F.col("c_custkey") % 90).cast("double").alias("latitude"), F.col("c_custkey").cast("double").alias("longitude"), F.round(F.col("c_acctbal") * 100).cast("bigint").alias("population"))
    start = F.lit("2024-01-01").cast("timestamp")
    hours = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.date_format(F.timestamp_add("HOUR", i, start), "yyyy-MM-dd'T'HH:mm"))
    days = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.date_add(F.lit("2024-01-01").cast("date"), i).cast("string"))
    where = [(F.col("vec_id") % 25).cast("string").alias("city"), F.get(F.array(*map(F.lit, _SEGMENT_NAMES)), (F.floor(F.col("vec_id") / 25) % 5).cast("int")).alias("country_code")]
    vectors = table(spark, d, "embeddings")
    docs = vectors.select(*where, F.when(F.col("vec_id") % 2 == 0, 1.5).alias("latitude"), (F.col("vec_id") % 7).cast("double").alias("elevation"), F.struct(hours.alias("time"), F.col("embedding").alias("temperature"), F.slice("embedding", 1, 40).alias("humidity")).alias("hourly"), F.struct(days.alias("time"), F.col("embedding").alias("most")).alias("daily"))
    air = vectors.select(*where, F.struct(F.slice(hours, 1, 24).alias("time"), F.slice("embedding", 1, 24).alias("pm10")).alias("hourly"))
    return _stacked(feeds.weather(cities, docs, RUN, air))


_AT = "make_timestamp((1704067200 + {}) * 1000000)"


@query(f"""SELECT 'states' AS "table", CAST(event_id AS VARCHAR) AS icao24, CASE WHEN event_id % 4 <> 0 THEN event_type END AS callsign, 'X' AS origin_country, {_AT.format('event_id')} AS time_position, {_AT.format('event_id + 5')} AS last_contact, lon AS longitude, lat AS latitude,
CASE WHEN event_id % 3 <> 0 THEN value * 10 END AS baro_altitude, event_id % 2 = 0 AS on_ground, value AS velocity, CAST(event_id % 360 AS DOUBLE) AS true_track, -value AS vertical_rate, value * 11 AS geo_altitude, CAST(event_id % 7777 AS VARCHAR) AS squawk, event_id % 5 = 0 AS spi, CAST(event_id % 4 AS INTEGER) AS position_source, make_timestamp(1706745600000000) AS snapshot_time
FROM {POINTS} WHERE event_id % 6 <> 0 AND event_id % 7 <> 0
UNION ALL BY NAME SELECT 'flights' AS "table", CAST(event_id AS VARCHAR) AS icao24, event_type AS callsign, {_AT.format('event_id')} AS first_seen, {_AT.format('event_id * 2')} AS last_seen, 'D' || (event_id % 9) AS departure_airport, NULL::VARCHAR AS arrival_airport, CAST(event_id % 100 AS INTEGER) AS departure_horiz_distance, CAST(event_id % 10 AS INTEGER) AS departure_vert_distance,
CAST(user_id AS INTEGER) AS arrival_horiz_distance, NULL::INTEGER AS arrival_vert_distance, 1::INTEGER AS departure_candidates, CAST(event_id % 3 AS INTEGER) AS arrival_candidates FROM events WHERE event_id % 11 = 0""")
def pipe_flights(spark, d):
    text = lambda c: c.cast("string")
    e, v, no = F.col("event_id"), F.col("value"), F.lit(None).cast("string")
    slots = F.array(
        text(e), F.when(e % 4 == 0, "  ").otherwise(F.concat(F.col("event_type"), F.lit(" "))), F.lit("X"), text(e + 1704067200), text(e + 1704067205), F.when(e % 6 == 0, no).otherwise(text(F.col("lon"))), F.when(e % 7 == 0, "null").otherwise(text(F.col("lat"))),
        F.when(e % 3 != 0, text(v * 10)), text(e % 2 == 0), text(v), text(e % 360), text(-v), no, text(v * 11), text(e % 7777), text(e % 5 == 0), text(e % 4),
    )
    # A document holds the states of some thousand events, however many there are.
    states = points(spark, d).groupBy(F.floor(e / 5000)).agg(F.collect_list(slots).alias("states")).select(F.lit(1706745600).cast("bigint").alias("time"), "states")
    completed = table(spark, d, "events").where(e % 11 == 0).select(
        text(e).alias("icao24"), F.concat("event_type", F.lit("  ")).alias("callsign"), (e + 1704067200).alias("firstSeen"), (e * 2 + 1704067200).alias("lastSeen"), F.concat(F.lit("D"), e % 9).alias("estDepartureAirport"), no.alias("estArrivalAirport"),
        (e % 100).alias("estDepartureAirportHorizDistance"), (e % 10).alias("estDepartureAirportVertDistance"), F.col("user_id").alias("estArrivalAirportHorizDistance"), F.lit(1).alias("departureAirportCandidatesCount"), (e % 3).alias("arrivalAirportCandidatesCount"),
    )
    return _stacked(feeds.flights(states, completed))


@query("""SELECT p_partkey AS id, CASE WHEN p_size <= 10 THEN 'person' WHEN p_size <= 20 THEN 'company' WHEN p_size <= 30 THEN 'asset' ELSE 'other' END AS entity_type, string_split(replace(lower(p_type), ' ', ';'), ';') AS country_list, ['a', CAST(p_size AS VARCHAR)] AS sanction_list, DATE '2024-02-01' AS snapshot_date FROM part WHERE lower(p_type) LIKE '%st%' OR lower(p_type) LIKE '%br%'""")
def pipe_sanctions(spark, d):
    kind = F.when(F.col("p_size") <= 10, "Person").when(F.col("p_size") <= 20, "Company").when(F.col("p_size") <= 30, "Vessel").otherwise("Thing")
    entities = table(spark, d, "part").select(F.col("p_partkey").alias("id"), kind.alias("schema"), F.replace(F.lower("p_type"), F.lit(" "), F.lit(";")).alias("countries"), F.concat(F.lit("a;"), F.col("p_size")).alias("sanctions"), F.col("p_retailprice").alias("last_change"))
    return feeds.sanctions(entities, ["st", "br"], RUN)["region_sanctions"].select("id", "entity_type", "country_list", "sanction_list", "snapshot_date")


_FIRES = f"(SELECT event_id, ts, lat, lon, value, user_id, event_type FROM {POINTS} WHERE event_type IN ('click', 'view', 'purchase') AND {_BOX})"


@query(f"SELECT event_id AS acq_time, CASE event_type WHEN 'click' THEN 'v1' WHEN 'view' THEN 'v2' ELSE 'm' END AS sensor, value AS bright_ti4, CASE WHEN event_type IN ('click', 'view') THEN 'n' ELSE CAST(user_id AS VARCHAR) END AS confidence, {_CELLS} FROM {_FIRES}")
def pipe_fires(spark, d):
    def sensor(kind, third=False):
        e = points(spark, d).where(F.col("event_type") == kind)
        names = ("brightness", "bright_t31") if third else ("bright_ti4", "bright_ti5")
        one = F.lit(1.0)
        return e.select(F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), F.col("value").alias(names[0]), F.col("value").alias(names[1]), one.alias("scan"), one.alias("track"), F.to_date("ts").alias("acq_date"), F.col("event_id").alias("acq_time"), F.lit("S").alias("satellite"), (F.col("user_id") if third else F.lit("n")).alias("confidence"), F.lit("2").alias("version"), F.col("value").alias("frp"), F.lit("D").alias("daynight"))

    sensors = {"v1": sensor("click"), "v2": sensor("view"), "m": sensor("purchase", third=True)}
    return feeds.fires(sensors, BOX, RUN)["active_fires"].select("acq_time", "sensor", "bright_ti4", "confidence", "cell_r5", "cell_r8", "cell_r10")


@query(f"""WITH e AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS n FROM {POINTS} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
SELECT 'events' AS "table", user_id AS event_id, user_id % 3 = 0 AS is_closed, 'c' || (user_id % 4) AS category, 'u1;u2' AS source_urls, CAST(n AS INTEGER) AS n_geometries, lon AS longitude, lat AS latitude, {cell_sql('lat', 'lon', 5)} AS cell_r5, {cell_sql('lat', 'lon', 8)} AS cell_r8 FROM e WHERE event_id % 9 <> 0
UNION ALL BY NAME SELECT 'rejects' AS "table", user_id AS event_id, 't' AS title FROM e WHERE event_id % 9 = 0""")
def pipe_natural_events(spark, d):
    """A user's events are the geometries of a natural event; every ninth geometry is a polygon."""
    xy = F.when(F.col("event_id") % 9 != 0, F.array("lon", "lat")).otherwise(F.array("lon", "lat", "lon", "lat"))
    g = points(spark, d).groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", F.col("ts").cast("string").alias("date"), xy.alias("coordinates")))).alias("geometry"))
    url = lambda u: F.struct(F.lit("s").alias("id"), F.lit(u).alias("url"))
    feed = g.select(F.col("user_id").alias("id"), F.lit("t").alias("title"), F.when(F.col("user_id") % 3 == 0, "2024-01-31").alias("closed"), F.array(F.struct(F.lit("i").alias("id"), F.concat(F.lit("c"), F.col("user_id") % 4).alias("title"))).alias("categories"), F.array(url("u1"), url("u2")).alias("sources"), "geometry")
    out = feeds.natural_events(feed.where("closed is null"), feed.where("closed is not null"), RUN)
    return _stacked(out | {"events": out["events"].select("event_id", "is_closed", "category", "source_urls", "n_geometries", "longitude", "latitude", "cell_r5", "cell_r8")})


#: Properties of earthquakes made from events: {name in the feed: expression that both engines read}.
_QUAKE = {
    "magType": "CASE WHEN event_id % 2 = 0 THEN 'ml' ELSE 'mb' END", "place": "event_type", "type": "'earthquake'", "status": "CASE WHEN event_id % 3 = 0 THEN 'automatic' ELSE 'reviewed' END", "tsunami": "event_id % 2", "sig": "event_id % 1000", "felt": "CASE WHEN event_id % 4 = 0 THEN event_id % 50 END",
    "cdi": "value / 2", "mmi": "value / 4", "alert": "CASE WHEN event_id % 5 = 0 THEN 'green' END", "net": "'us'", "code": "CAST(event_id AS STRING)", "ids": "concat(',us', event_id, ',')", "sources": "',us,'", "nst": "event_id % 80", "dmin": "value / 8", "rms": "value / 16", "gap": "value * 2",
    "title": "concat('M ', event_type)", "url": "concat('https://example.org/', event_id)", "updated": "1704067200000 + event_id * 4321",
}


def _quake_sql():
    return ", ".join((f"epoch_ms({_QUAKE[source]})" if name == "updated_time" else f"CAST({_QUAKE[source].replace('STRING', 'VARCHAR')} AS {kind.replace('string', 'varchar').replace('int', 'integer')})") + f" AS {name}" for name, (source, kind) in feeds.QUAKE.items() if source in _QUAKE)


@query(f"SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN event_id % 15 = 0 THEN NULL ELSE value END AS mag, {_quake_sql()}, epoch_ms(1704067200000 + event_id * 1234) AS event_time, lon AS longitude, lat AS latitude, CASE WHEN event_id % 2 = 0 THEN value END AS depth_km, {cell_sql('lat', 'lon', 5)} AS cell_r5, {cell_sql('lat', 'lon', 8)} AS cell_r8, {_STAMP} FROM {POINTS}")
def pipe_earthquakes(spark, d):
    e = F.col("event_id")
    feature = F.struct(
        e.cast("string").alias("id"),
        F.struct(F.when(e % 15 != 0, F.col("value")).alias("mag"), (F.lit(1704067200000) + e * 1234).alias("time"), *(F.expr(v).alias(k) for k, v in _QUAKE.items())).alias("properties"),
        F.struct(F.when(e % 2 == 0, F.array("lon", "lat", "value")).otherwise(F.array("lon", "lat")).alias("coordinates")).alias("geometry"),
    )
    docs = points(spark, d).groupBy(F.floor(e / 5000)).agg(F.collect_list(feature).alias("features"))
    return feeds.earthquakes(docs, RUN)["events"]


@query("SELECT CAST(user_id AS VARCHAR) AS country_code, CASE WHEN user_id % 5 = 0 THEN 'unknown' ELSE 'bgp' END AS datasource, '' AS subtype, make_timestamp((1704067200 + (i - 1) * CASE WHEN user_id % 2 = 0 THEN 1800 ELSE 600 END) * 1000000) AS timestamp, v AS value FROM (SELECT user_id, unnest(vs) AS v, unnest(ids) AS id, unnest(range(1, len(vs) + 1)) AS i FROM (SELECT user_id, list(value ORDER BY event_id) AS vs, list(event_id ORDER BY event_id) AS ids FROM events GROUP BY user_id)) WHERE id % 8 <> 0")
def pipe_signals(spark, d):
    v = F.when(F.col("event_id") % 8 == 0, "n/a").otherwise(F.col("value").cast("string"))
    even = F.col("user_id") % 2 == 0
    start = F.lit(1704067200) + F.col("first") * F.when(even, 1800).otherwise(600)
    series = user_series(table(spark, d, "events").select("user_id", "event_id", v.alias("v"))).select(F.col("user_id").cast("string").alias("country_code"), F.when(F.col("user_id") % 5 != 0, "bgp").alias("datasource"), F.lit(None).cast("string").alias("subtype"), start.cast("bigint").alias("from"), F.when(~even, 600).cast("bigint").alias("step"), F.col("vs").alias("values"))
    return feeds.signals(series, RUN)["signals"].drop("snapshot_time")


@query(f"""SELECT event_id AS norad_cat_id, event_type AS object_name, '' AS object_id, CASE WHEN event_id % 3 = 0 THEN 'b' ELSE 'a' END AS "group", CASE WHEN event_id % 3 = 0 THEN 'Second' ELSE 'First' END AS group_label, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS epoch, CASE WHEN event_id % 50 = 0 THEN 0.0 ELSE 1 + (event_id % 150)::DOUBLE / 10 END AS mean_motion,
value / 1000 AS eccentricity, CASE WHEN event_id % 31 <> 0 THEN (event_id % 180)::DOUBLE END AS inclination, (event_id % 360)::DOUBLE AS ra_of_asc_node, (event_id * 3 % 360)::DOUBLE AS arg_of_pericenter, (event_id * 7 % 360)::DOUBLE AS mean_anomaly, CASE WHEN event_id % 2 = 0 THEN 'C' ELSE 'U' END AS classification, value AS bstar, event_id * 2 AS rev_at_epoch,
lat AS latitude_approx, lon AS longitude_approx, alt_km AS altitude_km, {_BOX} AS in_region, {cell_sql('lat', 'lon', 5)} AS cell_r5 FROM events JOIN {_TRACK} USING (event_id) WHERE event_id % 12 <> 0""")
def pipe_satellites(spark, d):
    e, own = F.col("event_id"), _orbit_columns()
    elements = table(spark, d, "events").select(
        F.when(e % 12 != 0, e).alias("NORAD_CAT_ID"), F.col("event_type").alias("OBJECT_NAME"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("EPOCH"), own["motion"].alias("MEAN_MOTION"), (F.col("value") / 1000).alias("ECCENTRICITY"), own["inc"].alias("INCLINATION"), own["node"].alias("RA_OF_ASC_NODE"),
        (e * 3 % 360).alias("ARG_OF_PERICENTER"), own["ano"].alias("MEAN_ANOMALY"), F.when(e % 2 == 0, "C").alias("CLASSIFICATION_TYPE"), F.col("value").alias("BSTAR"), (e * 2).alias("REV_AT_EPOCH"),
    )
    both = elements.where("NORAD_CAT_ID is null or NORAD_CAT_ID % 3 <> 0").withColumn("group", F.lit("a")).unionByName(elements.withColumn("group", F.lit("b")))
    return feeds.satellites(both, {"a": "First", "b": "Second"}, "2024-01-20 00:00:00", BOX)["satellites"].drop("snapshot_time")


@query(f"""WITH r AS (SELECT 'p' || n_nationkey AS portid, n_name AS portname, r_name AS continent, CAST((n_nationkey * 7919) % 18000 AS DOUBLE) / 100 - 90 AS lat, CAST((n_nationkey * 104729) % 36000 AS DOUBLE) / 100 - 180 AS lon, n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 6 <> 0),
t AS (SELECT 'p' || c_nationkey AS portid, CAST(o_orderdate AS DATE) AS date, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
SELECT 'chokepoints' AS "table", portid, portname, NULL::VARCHAR AS country, upper(left(portname, 3)) AS iso3, continent, NULL::VARCHAR AS fullname, NULL::VARCHAR AS locode, NULL::VARCHAR AS pageid, lat, lon, CAST(n_nationkey AS DOUBLE) AS vessel_count_total, NULL::DOUBLE AS vessel_count_container, NULL::DOUBLE AS vessel_count_dry_bulk, NULL::DOUBLE AS vessel_count_general_cargo, CAST(n_nationkey * 2 AS DOUBLE) AS vessel_count_roro, NULL::DOUBLE AS vessel_count_tanker,
'x' AS industry_top1, NULL::VARCHAR AS industry_top2, NULL::VARCHAR AS industry_top3, n_nationkey / 100 AS share_maritime_import, NULL::DOUBLE AS share_maritime_export, {cell_sql('lat', 'lon', 5)} AS cell_r5, {_STAMP} FROM r
UNION ALL BY NAME SELECT 'daily_transits' AS "table", portid, NULL::VARCHAR AS portname, date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day, NULL::INTEGER AS n_container, NULL::INTEGER AS n_dry_bulk, NULL::INTEGER AS n_general_cargo, NULL::INTEGER AS n_roro, CAST(f AS INTEGER) AS n_tanker, NULL::INTEGER AS n_cargo, CAST(n AS INTEGER) AS n_total,
NULL::DOUBLE AS capacity_container, NULL::DOUBLE AS capacity_dry_bulk, NULL::DOUBLE AS capacity_general_cargo, NULL::DOUBLE AS capacity_roro, NULL::DOUBLE AS capacity_tanker, NULL::DOUBLE AS capacity_cargo, total AS capacity, lat, lon, {cell_sql('lat', 'lon', 5)} AS cell_r5, {_STAMP} FROM t LEFT JOIN (SELECT portid, lat, lon FROM r) USING (portid)""")
def pipe_chokepoints(spark, d):
    k = F.col("n_nationkey").cast("bigint")
    named = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).where("n_nationkey % 6 <> 0")
    ref = named.select(
        F.concat(F.lit("p"), k).alias("portid"), F.col("n_name").alias("portname"), F.upper(F.left("n_name", F.lit(3))).alias("ISO3"), F.col("r_name").alias("continent"), (((k * 7919) % 18000).cast("double") / 100 - 90).alias("lat"), (((k * 104729) % 36000).cast("double") / 100 - 180).alias("lon"),
        k.alias("vessel_count_total"), (k * 2).alias("vessel_count_RoRo"), F.lit("x").alias("industry_top1"), (k / 100).alias("share_country_maritime_import"),
    )
    day = F.date_trunc("day", F.col("o_orderdate").cast("timestamp"))
    days = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy(F.concat(F.lit("p"), F.col("c_nationkey")).alias("portid"), F.unix_millis(day).alias("date"), F.year(day).alias("year"), F.month(day).alias("month"), F.day(day).alias("day"))
    days = days.agg(F.count("*").alias("n_total"), F.count_if(F.col("o_orderstatus") == "F").alias("n_tanker"), F.round(F.sum("o_totalprice"), 2).alias("capacity"))
    return _stacked(feeds.chokepoints(ref, days, RUN))


@query(f"""WITH s AS (SELECT *, sqrt(pow(x1 - x2, 2) + pow(y1 - y2, 2)) AS l, asin(sqrt(pow(sin(radians(y2 - y1) / 2), 2) + cos(radians(y1)) * cos(radians(y2)) * pow(sin(radians(x2 - x1) / 2), 2))) * (2 * 6371.0088::DOUBLE) AS km FROM {_SEGMENTS})
SELECT 'cables' AS "table", CAST(user_id AS VARCHAR) AS id, 'c' AS name, round(coalesce(sum(km) FILTER (WHERE abs(x1 - x2) <= 180), 0), 3) AS length_km, CAST(count(*) FILTER (WHERE abs(x1 - x2) > 180) AS INTEGER) AS skipped, round(CASE WHEN sum(l) > 0 THEN sum(l * (x1 + x2) / 2) / sum(l) ELSE first(x1 ORDER BY i) END, 6) AS lon, round(CASE WHEN sum(l) > 0 THEN sum(l * (y1 + y2) / 2) / sum(l) ELSE first(y1 ORDER BY i) END, 6) AS lat FROM s GROUP BY user_id
UNION ALL BY NAME SELECT 'landing_points' AS "table", CAST(event_id AS VARCHAR) AS id, regexp_extract(event_type || CASE WHEN event_id % 2 = 0 THEN ', Land' || (event_id % 5) ELSE '' END, ', ([^,]+)$', 1) AS country, {cell_sql('lat', 'lon', 5)} AS cell_r5 FROM {POINTS}""")
def pipe_cables(spark, d):
    lines = _lines(spark, d).select(F.col("user_id").cast("string").alias("id"), F.lit("c").alias("name"), "line")
    name = F.concat("event_type", F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(", Land"), F.col("event_id") % 5)).otherwise(""))
    landings = points(spark, d).select(F.col("event_id").cast("string").alias("id"), name.alias("name"), "lat", "lon")
    out = feeds.cables(lines, landings)
    cables = out["cables"].select("id", "name", F.round("length_km", 3).alias("length_km"), "skipped", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))
    return _stacked({"cables": cables, "landing_points": out["landing_points"].select("id", "country", "cell_r5")})


@query("""SELECT l_returnflag AS ref_area, CAST(date_trunc('month', l_shipdate) AS DATE) AS time_period, CAST(l_suppkey AS VARCHAR) AS energy_product, l_linestatus AS flow_breakdown, CASE WHEN l_linenumber = 1 OR l_linenumber = 2 OR l_linenumber = 3 THEN NULL ELSE l_quantity END AS obs_value FROM lineitem WHERE l_returnflag IN ('A', 'R')""")
def pipe_oil_flows(spark, d):
    n = F.col("l_linenumber")
    value = F.when(n == 1, "-").when(n == 2, "x").when(n == 3, "about 5").otherwise(F.col("l_quantity").cast("string"))
    rows = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("REF_AREA"), F.date_format("l_shipdate", "yyyy-MM").alias("TIME_PERIOD"), F.col("l_suppkey").cast("string").alias("ENERGY_PRODUCT"), F.col("l_linestatus").alias("FLOW_BREAKDOWN"), value.alias("OBS_VALUE"))
    return feeds.oil_flows(rows, ["A", "R"], RUN)["monthly_flows"].drop("snapshot_time", "snapshot_date")


_PLACES = {"the": "EN", "nicht": "DE", "avec": "FR", "para": "ES"}


@query(
    "SELECT doc_id AS id, sha256(regexp_replace(coalesce(text, ''), '<[^>]+>', '', 'g')) AS summary_sha256, codes AS me_countries, codes <> '' AS is_me FROM (SELECT doc_id, text, concat_ws(',', "
    + ", ".join(rf"CASE WHEN regexp_matches(lower(text || chr(10) || lang), '(^|[^\p{{L}}\p{{N}}_]){n}($|[^\p{{L}}\p{{N}}_])') THEN '{c}' END" for n, c in sorted(_PLACES.items(), key=lambda x: x[1]))
    + ") AS codes FROM documents)"
)
def pipe_outbreaks(spark, d):
    items = table(spark, d, "documents").select(F.col("doc_id").alias("Id"), F.col("lang").alias("Title"), F.lit("2024-01-05T10:00:00Z").alias("PublicationDateAndTime"), F.col("text").alias("Summary"))
    return feeds.outbreaks(items, _PLACES, RUN)["outbreaks"].select("id", F.sha2("summary", 256).alias("summary_sha256"), "me_countries", "is_me")


@query(f"SELECT cell, n, lat, lon FROM (SELECT cell, n, {lat_sql('cell', 5)} AS lat, {lon_sql('cell', 5)} AS lon FROM (SELECT {cell_sql('lat', 'lon', 5)} AS cell, count(*) AS n FROM {POINTS} GROUP BY 1)) WHERE {_BOX}")
def pipe_grid_clip(spark, d):
    grid = spatial.with_cells(points(spark, d), "lat", "lon", [5]).groupBy(F.col("cell_r5").alias("cell")).agg(F.count("*").alias("n"))
    return feeds.grid_clip({"population": grid}, "cell", 5, BOX)["population"]


@query(f"""SELECT CAST(event_id AS VARCHAR) AS feature_id, 'typed' AS category, CAST(user_id AS VARCHAR) AS operator, {cell_sql('lat', 'lon', 5)} AS cell_r5 FROM {POINTS} WHERE {_BOX} UNION ALL
SELECT CAST(event_id AS VARCHAR), 'clicks', CAST(user_id AS VARCHAR), {cell_sql('lat', 'lon', 5)} FROM {POINTS} WHERE {_BOX} AND event_type = 'click'""")
def pipe_infrastructure(spark, d):
    features = points(spark, d).select(F.col("event_id").cast("string").alias("feature_id"), F.create_map(F.lit("kind"), F.col("event_type"), F.lit("operator"), F.col("user_id").cast("string")).alias("tags"), F.array(F.struct(F.col("lon").alias("x"), F.col("lat").alias("y"))).alias("coords"))
    rows = feeds.infrastructure_features(features, {"typed": {"kind": True}, "clicks": {"kind": ["click"]}}, ["operator"], BOX).withColumn("h", spatial.hilbert_index(F.col("lon"), F.col("lat")))
    tables = sinks.write_split(rows, scratch(spark, "infrastructure"), "r1", "category", sort=["h", "feature_id"])
    parts = [spark.read.parquet(path).select("feature_id", F.lit(name).alias("category"), "operator", "cell_r5") for name, path in tables.items()]
    return reduce(DataFrame.union, parts)


_T = f"""px AS {_PIXELS}, l AS ({_box_sql({'m': 'b.value', 's': 'b.value * b.value'})}), o AS (SELECT scene, band, var_pop(value) AS o FROM px GROUP BY ALL),
f AS (SELECT scene, period, band, y, x, CASE WHEN o > 0 THEN m + greatest(s - m * m, 0) / (greatest(s - m * m, 0) + o) * (value - m) ELSE value END AS value FROM px JOIN l USING (scene, band, y, x) JOIN o USING (scene, band)),
n AS (SELECT count(DISTINCT scene) FILTER (WHERE period = 'pre') AS n0, count(DISTINCT scene) FILTER (WHERE period = 'post') AS n1 FROM f),
s AS (SELECT y, x, band, avg(value) FILTER (WHERE period = 'pre') AS m0, avg(value) FILTER (WHERE period = 'post') AS m1, stddev_samp(value) FILTER (WHERE period = 'pre') AS s0, stddev_samp(value) FILTER (WHERE period = 'post') AS s1 FROM f GROUP BY ALL),
t AS (SELECT y, x, max(CASE WHEN sqrt(s0 * s0 / n0 + s1 * s1 / n1) > 0 THEN abs(m0 - m1) / sqrt(s0 * s0 / n0 + s1 * s1 / n1) END) AS t FROM s, n GROUP BY y, x)"""
_PX_CELL = cell_sql("lat", "lon", 7)


@query(f"""WITH {_T}, c AS (SELECT {_PX_CELL} AS cell_r7, t FROM (SELECT t, 42.0::DOUBLE - y * (30.0::DOUBLE / 3) AS lat, 20.0::DOUBLE + x * (45.0::DOUBLE / 7) AS lon FROM t WHERE y % 2 = 0 AND x % 2 = 0))
SELECT cell_r7, count(*) AS total, count(*) FILTER (WHERE t > 0.5) AS damaged, round(avg(t), 3) AS mean_value, round(max(t), 3) AS max_value, {cell_sql(lat_sql('cell_r7', 7), lon_sql('cell_r7', 7), 9)} AS cell_r9, lower(printf('%x', cell_r7)) AS cell_text FROM c GROUP BY cell_r7""")
def pipe_damage(spark, d):
    px = _pixels(spark, d)
    dated = px.select("scene", F.when(F.col("period") == "pre", F.lit("2024-01-01")).otherwise("2024-02-01").cast("date").alias("scene_date"), "band", "y", "x", "value")
    out = feeds.damage(dated, BOX, 4, 8, "2024-01-15", RUN, threshold=0.5, step=2)["damage_cells"]
    return out.select("cell_r7", "total", "damaged", "mean_value", "max_value", "cell_r9", "cell_text")


@query(f"SELECT event_id AS id, printf('item_%04d', event_id) AS name, lat, lon FROM {POINTS}")
def pipe_minimal(spark, d):
    return feeds.minimal(points(spark, d).select(F.col("event_id").alias("id"), F.format_string("item_%04d", "event_id").alias("name"), "lat", "lon"))["data"]


@query("""SELECT 'registered' AS status, 1::BIGINT AS tables, count(*) AS n_rows FROM events UNION ALL SELECT 'rejected: unique', 1, count(*) + 1 FROM events
UNION ALL SELECT 'rejected: min_rows, bbox', 1, 0""")
def checked_feed(spark, d):
    """What a feed promises of its tables decides what is registered of three lakes: as promised, with a row twice, and empty."""
    rows = points(spark, d).select(F.col("event_id").alias("id"), F.format_string("item_%04d", "event_id").alias("name"), "lat", "lon")
    catalog, out = Catalog(spark, scratch(spark, "checked")), None
    first = rows.orderBy("id").limit(1)
    for name, df in (("whole", rows), ("twice", rows.unionByName(first)), ("empty", rows.where("false"))):
        lake = scratch(spark, name)
        sinks.write_all(feeds.minimal(df), lake, "r1", name)
        report = catalog.merge(lake, RUN, checks=feeds.CHECKS["minimal"], publish=False)
        out = report if out is None else out.unionByName(report)
    return out.groupBy("status").agg(F.count("*").alias("tables"), F.sum("rows").alias("n_rows"))


@query(hilbert_sql(POINTS, "event_id, lat, lon").replace("SELECT event_id, lat, lon, h", f"SELECT cell, CAST(count(*) AS BIGINT) AS n, min(h) AS first_h", 1).replace(" FROM (", f" FROM (SELECT *, {cell_sql('lat', 'lon', 5)} AS cell FROM (", 1) + f") WHERE {_BOX} GROUP BY cell")
def fires_by_cell(spark, d):
    """The flagship: points inside a box, cells at three resolutions, Hilbert order, counts by cell."""
    inside = points(spark, d).where(spatial.in_bbox(F.col("lat"), F.col("lon"), BOX))
    cells = spatial.with_cells(inside, "lat", "lon", [5, 8, 10]).withColumn("h", spatial.hilbert_index(F.col("lon"), F.col("lat")))
    return cells.groupBy(F.col("cell_r5").alias("cell")).agg(F.count("*").alias("n"), F.min("h").alias("first_h")).orderBy("first_h")



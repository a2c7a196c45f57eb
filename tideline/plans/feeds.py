"""End-to-end pipelines: from a feed's rows to its tables, as one lazy plan each.

Every function takes DataFrames with the feed's schema and returns {table: DataFrame}; nothing is fetched or collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars, spatial
from ..operators import polygons, raster, relate, shape

PROTECTED = ["ArticleContent", "ArticleTitle", "ArticleAuthor"]


def news_events(feed: DataFrame, as_of: str, run_ts: str, days: int = 30) -> dict[str, DataFrame]:
    """Located events of the last ``days`` by an integer date, without article texts."""
    recent = feed.where((F.col("SQLDATE") >= scalars.int_days_before(as_of, days)) & F.col("ActionGeo_Lat").isNotNull() & F.col("ActionGeo_Long").isNotNull())
    rest = [c for c in feed.columns if c not in {"GLOBALEVENTID", "SQLDATE", "ActionGeo_Lat", "ActionGeo_Long", *PROTECTED}]
    named = shape.drop_columns(recent, PROTECTED).select(F.col("GLOBALEVENTID").alias("globaleventid"), scalars.date_from_int(F.col("SQLDATE")).alias("event_date"), F.col("ActionGeo_Lat").alias("latitude"), F.col("ActionGeo_Long").alias("longitude"), *(F.col(c).alias(c.lower()) for c in rest))
    out = shape.stamp(spatial.with_cells(named, "latitude", "longitude", [5, 8, 10]), run_ts)
    return {"events": shape.hilbert_sort(out, "longitude", "latitude", ["event_date", "globaleventid"])}


def _present(df: DataFrame, columns: dict[str, tuple[str, str]]) -> list[Column]:
    """Columns {name: (source, type)} of ``df``; those it lacks are null."""
    return [(F.col(source) if source in df.columns else F.lit(None)).cast(kind).alias(name) for name, (source, kind) in columns.items()]


def weather(cities: DataFrame, documents: DataFrame, run_ts: str, air: DataFrame | None = None, least_population: int = 200_000) -> dict[str, DataFrame]:
    """Hourly and daily rows and, given documents of air quality, their hourly rows, of the largest city of each (city, country).

    ``documents``: city, country_code, structs ``hourly`` and ``daily`` of parallel arrays whose first is ``time``, and where known the
    latitude, longitude and elevation that values are for. ``air``: the same with ``hourly`` alone.
    """
    big = cities.where(F.col("city").isNotNull() & (F.col("population") >= least_population))
    chosen = relate.dedup(big, ["city", "country_code"], [F.desc("population"), "latitude", "longitude"]).select("city", "country_code", "population", F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon"))
    out = {}
    for name, df, field, kind in (("weather_hourly", documents, "hourly", "timestamp_ntz"), ("weather_daily", documents, "daily", "date"), ("air_quality", air, "hourly", "timestamp_ntz")):
        if df is None:
            continue
        zipped = scalars.zip_arrays(**{f: F.col(f"{field}.{f}") for f in df.schema[field].dataType.names})
        place = [F.coalesce(F.col(c), F.col(own)).alias(c) if c in df.columns else F.col(own).alias(c) for c, own in (("latitude", "_lat"), ("longitude", "_lon"))]
        if name != "air_quality":
            place.append((F.coalesce("elevation", F.lit(0.0)) if "elevation" in df.columns else F.lit(0.0)).alias("elevation"))
        rows = df.join(chosen, ["city", "country_code"]).select("city", "country_code", "population", *place, F.inline(zipped)).where(F.col("time").isNotNull())
        at = F.col("time").cast(kind)
        rows = rows.withColumn("time", at) if kind != "date" else rows.withColumn("time", at).withColumnRenamed("time", "date")
        out[name] = shape.hilbert_sort(shape.stamp(rows, run_ts, with_date=False), "longitude", "latitude", ["date" if kind == "date" else "time"])
    return out


#: The places of an aircraft state's values, with their names and types.
STATE = {
    "icao24": (0, "string"), "callsign": (1, "string"), "origin_country": (2, "string"), "time_position": (3, "bigint"), "last_contact": (4, "bigint"), "longitude": (5, "double"), "latitude": (6, "double"),
    "baro_altitude": (7, "double"), "on_ground": (8, "boolean"), "velocity": (9, "double"), "true_track": (10, "double"), "vertical_rate": (11, "double"), "geo_altitude": (13, "double"), "squawk": (14, "string"), "spi": (15, "boolean"), "position_source": (16, "int"),
}
#: Names and types of a completed flight's values.
FLIGHT = {
    "departure_airport": ("estDepartureAirport", "string"), "arrival_airport": ("estArrivalAirport", "string"), "departure_horiz_distance": ("estDepartureAirportHorizDistance", "int"), "departure_vert_distance": ("estDepartureAirportVertDistance", "int"),
    "arrival_horiz_distance": ("estArrivalAirportHorizDistance", "int"), "arrival_vert_distance": ("estArrivalAirportVertDistance", "int"), "departure_candidates": ("departureAirportCandidatesCount", "int"), "arrival_candidates": ("arrivalAirportCandidatesCount", "int"),
}


def flights(states: DataFrame, completed: DataFrame | None) -> dict[str, DataFrame]:
    """Aircraft states from documents (``time`` in seconds, ``states``: array<array<string>> of values by place), and completed
    flights if given. A state without a position goes."""
    seconds = lambda c: F.timestamp_seconds(c.cast("bigint")).cast("timestamp_ntz")
    known = lambda i: F.nullif(F.get("s", F.lit(i)), F.lit("null"))
    s = states.select("time", F.explode("states").alias("s")).where(known(5).isNotNull() & known(6).isNotNull())
    rows = s.select(*(known(i).cast(kind).alias(name) for name, (i, kind) in STATE.items()), seconds(F.col("time")).alias("snapshot_time"))
    rows = rows.withColumns({"callsign": scalars.clean_empty(F.col("callsign")), "time_position": seconds(F.col("time_position")), "last_contact": seconds(F.col("last_contact"))})
    out = {"states": shape.hilbert_sort(rows, "longitude", "latitude", ["icao24"])}
    if completed is not None:
        done = completed.select("icao24", scalars.clean_empty(F.col("callsign")).alias("callsign"), seconds(F.col("firstSeen")).alias("first_seen"), seconds(F.col("lastSeen")).alias("last_seen"), *_present(completed, FLIGHT))
        out["flights"] = done.orderBy("first_seen", "icao24")
    return out


def sanctions(entities: DataFrame, codes: list[str], run_ts: str, exact: bool = False) -> dict[str, DataFrame]:
    """Entities of a region's countries with lists of countries and sanctions and a class."""
    kind = F.lower("schema")
    group = F.when(kind == "person", "person").when(kind == "company", "company").when(kind.isin("organization", "legalentity", "publicbody"), "organization").when(kind.isin("vessel", "airplane", "asset"), "asset").otherwise("other")
    rows = entities.where(scalars.contains_any(F.col("countries"), codes, exact)).withColumns({"country_list": scalars.split_list(F.col("countries")), "sanction_list": scalars.split_list(F.col("sanctions")), "entity_type": group})
    return {"region_sanctions": shape.stamp(rows, run_ts).orderBy(F.desc_nulls_last("last_change"), "id")}


#: What the third sensor calls the columns that the others share.
THIRD_SENSOR = {"bright_ti4": "brightness", "bright_ti5": "bright_t31"}
FIRE_COLUMNS = ("latitude", "longitude", "bright_ti4", "bright_ti5", "scan", "track", "acq_date", "acq_time", "satellite", "confidence", "version", "frp", "daynight")


def fires(sensors: dict[str, DataFrame], box: tuple, run_ts: str) -> dict[str, DataFrame]:
    """Fires of several sensors inside a box, aligned to one schema."""
    aligned = {}
    for name, df in sensors.items():
        names = {c: F.col(THIRD_SENSOR.get(c, c) if c not in df.columns else c) for c in FIRE_COLUMNS}
        names["confidence"] = names["confidence"].cast("string")
        aligned[name] = (df.where(spatial.in_bbox(F.col("latitude"), F.col("longitude"), box)), names)
    rows = spatial.with_cells(shape.union_aligned(aligned), "latitude", "longitude", [5, 8, 10])
    return {"active_fires": shape.hilbert_sort(shape.stamp(rows, run_ts), "longitude", "latitude", ["acq_date", "acq_time"])}


def natural_events(opened: DataFrame, closed: DataFrame, run_ts: str) -> dict[str, DataFrame]:
    """Open and closed events at their last point; events whose last geometry is no point go to ``rejects``."""
    both = opened.unionByName(closed)
    last = scalars.last_of(F.col("geometry"))
    x, y = F.get(last.coordinates, F.lit(0)), F.get(last.coordinates, F.lit(1))
    point = F.coalesce(F.size(last.coordinates) == 2, F.lit(False))
    rows = both.withColumn("_point", point).select(
        F.col("id").alias("event_id"), F.coalesce("title", F.lit("")).alias("title"), F.coalesce(scalars.first_of(F.col("categories")).title, F.lit("")).alias("category"), scalars.join_field(F.col("sources"), "url").alias("source_urls"),
        F.col("closed").isNotNull().alias("is_closed"), last.date.alias("event_time"), F.size("geometry").alias("n_geometries"), x.alias("longitude"), y.alias("latitude"), "_point",
    )
    good = spatial.with_cells(rows.where("_point").drop("_point"), "latitude", "longitude", [5, 8])
    return {"events": shape.hilbert_sort(shape.stamp(good, run_ts, with_date=False), "longitude", "latitude", ["event_id"]), "rejects": rows.where(~F.col("_point")).select("event_id", "title")}


#: Properties of an earthquake, with their names and types.
QUAKE = {
    "mag": ("mag", "double"), "mag_type": ("magType", "string"), "place": ("place", "string"), "event_type": ("type", "string"), "status": ("status", "string"), "tsunami": ("tsunami", "int"), "sig": ("sig", "int"), "felt": ("felt", "int"),
    "cdi": ("cdi", "double"), "mmi": ("mmi", "double"), "alert": ("alert", "string"), "net": ("net", "string"), "code": ("code", "string"), "ids": ("ids", "string"), "sources": ("sources", "string"), "nst": ("nst", "int"),
    "dmin": ("dmin", "double"), "rms": ("rms", "double"), "gap": ("gap", "double"), "title": ("title", "string"), "url": ("url", "string"), "event_time": ("time", "bigint"), "updated_time": ("updated", "bigint"),
}


def earthquakes(documents: DataFrame, run_ts: str) -> dict[str, DataFrame]:
    """Features of GeoJSON documents; depth is the third coordinate, which may be absent. Properties that a feed lacks are null."""
    f = documents.select(F.explode("features").alias("f")).select("f.id", "f.properties.*", F.col("f.geometry.coordinates").alias("_at"))
    c = lambda i: F.get("_at", F.lit(i))
    millis = lambda c: F.timestamp_millis(c).cast("timestamp_ntz")
    rows = f.select(F.col("id").alias("event_id"), *_present(f, QUAKE), c(0).alias("longitude"), c(1).alias("latitude"), c(2).alias("depth_km"))
    rows = rows.withColumns({n: millis(F.col(n)) for n in ("event_time", "updated_time")})
    return {"events": shape.hilbert_sort(shape.stamp(spatial.with_cells(rows, "latitude", "longitude", [5, 8]), run_ts, with_date=False), "longitude", "latitude", ["event_time", "event_id"])}


def signals(series: DataFrame, run_ts: str) -> dict[str, DataFrame]:
    """Outage signals from series (country_code, datasource, subtype, from, step, values): a row for each number."""
    rows = series.select("country_code", F.coalesce("datasource", F.lit("unknown")).alias("datasource"), F.coalesce("subtype", F.lit("")).alias("subtype"), F.inline(scalars.series(F.col("from"), F.col("step"), F.transform("values", lambda v: v.try_cast("double")))))
    out = rows.select("country_code", "datasource", "subtype", F.timestamp_seconds("at").cast("timestamp_ntz").alias("timestamp"), "value")
    return {"signals": shape.stamp(out, run_ts, with_date=False).orderBy("country_code", "datasource", "subtype", "timestamp")}


#: Elements of a satellite's orbit, with their names and types.
ELEMENTS = {
    "norad_cat_id": ("NORAD_CAT_ID", "bigint"), "object_name": ("OBJECT_NAME", "string"), "object_id": ("OBJECT_ID", "string"), "epoch": ("EPOCH", "string"), "mean_motion": ("MEAN_MOTION", "double"), "eccentricity": ("ECCENTRICITY", "double"),
    "inclination": ("INCLINATION", "double"), "ra_of_asc_node": ("RA_OF_ASC_NODE", "double"), "arg_of_pericenter": ("ARG_OF_PERICENTER", "double"), "mean_anomaly": ("MEAN_ANOMALY", "double"),
    "classification": ("CLASSIFICATION_TYPE", "string"), "bstar": ("BSTAR", "double"), "rev_at_epoch": ("REV_AT_EPOCH", "bigint"),
}


def satellites(elements: DataFrame, groups: dict[str, str], at: str, box: tuple) -> dict[str, DataFrame]:
    """Elements of several groups (column ``group``; ``groups`` gives their order and labels): each satellite once, in its first
    group, with the approximate point below it at time ``at``. Missing texts are empty, a missing classification is U."""
    rows = elements.select("group", *_present(elements, ELEMENTS))
    rank = F.array_position(F.array(*map(F.lit, groups)), F.col("group"))
    once = relate.first_seen(rows.withColumn("_rank", rank), "norad_cat_id", ["_rank", "epoch", "object_name"]).drop("_rank")
    once = relate.lookup(once, groups, F.col("group"), "group_label").withColumns({c: F.coalesce(c, F.lit(other)) for c, other in (("object_name", ""), ("object_id", ""), ("epoch", ""), ("classification", "U"))})
    p = scalars.subsatellite(F.nullif("epoch", F.lit("")).try_cast("timestamp"), F.col("mean_motion"), F.col("inclination"), F.col("ra_of_asc_node"), F.col("mean_anomaly"), F.lit(at).cast("timestamp"))
    placed = once.withColumn("_p", p).select(*once.columns, F.col("_p.lat").alias("latitude_approx"), F.col("_p.lon").alias("longitude_approx"), F.col("_p.alt_km").alias("altitude_km"))
    placed = placed.withColumn("in_region", spatial.in_bbox(F.col("latitude_approx"), F.col("longitude_approx"), box))
    return {"satellites": shape.hilbert_sort(shape.stamp(spatial.with_cells(placed, "latitude_approx", "longitude_approx", [5]), at, with_date=False), "longitude_approx", "latitude_approx", ["norad_cat_id"])}


#: Names and types of a chokepoint's values, and of a day's transits.
CHOKEPOINT = {
    "portid": ("portid", "string"), "portname": ("portname", "string"), "country": ("country", "string"), "iso3": ("ISO3", "string"), "continent": ("continent", "string"), "fullname": ("fullname", "string"), "locode": ("LOCODE", "string"), "pageid": ("pageid", "string"),
    "lat": ("lat", "double"), "lon": ("lon", "double"), "vessel_count_total": ("vessel_count_total", "double"), "vessel_count_container": ("vessel_count_container", "double"), "vessel_count_dry_bulk": ("vessel_count_dry_bulk", "double"),
    "vessel_count_general_cargo": ("vessel_count_general_cargo", "double"), "vessel_count_roro": ("vessel_count_RoRo", "double"), "vessel_count_tanker": ("vessel_count_tanker", "double"), "industry_top1": ("industry_top1", "string"),
    "industry_top2": ("industry_top2", "string"), "industry_top3": ("industry_top3", "string"), "share_maritime_import": ("share_country_maritime_import", "double"), "share_maritime_export": ("share_country_maritime_export", "double"),
}
_KINDS = ("container", "dry_bulk", "general_cargo", "roro", "tanker", "cargo")
TRANSITS = {
    "portid": ("portid", "string"), "portname": ("portname", "string"), "date": ("date", "bigint"), "year": ("year", "int"), "month": ("month", "int"), "day": ("day", "int"),
    **{f"n_{k}": (f"n_{k}", "int") for k in (*_KINDS, "total")}, **{f"capacity_{k}": (f"capacity_{k}", "double") for k in _KINDS}, "capacity": ("capacity", "double"),
}


def chokepoints(reference: DataFrame, transits: DataFrame, run_ts: str) -> dict[str, DataFrame]:
    """Chokepoints with cells, and daily transits placed by their chokepoint; transits without one stay without a place."""
    places = spatial.with_cells(reference.select(*_present(reference, CHOKEPOINT)), "lat", "lon", [5])
    daily = transits.select(*_present(transits, TRANSITS)).withColumn("date", F.timestamp_millis("date").cast("date")).join(places.select("portid", "lat", "lon", "cell_r5"), "portid", "left")
    return {"chokepoints": shape.hilbert_sort(shape.stamp(places, run_ts, with_date=False), "lon", "lat", ["portid"]), "daily_transits": shape.stamp(daily, run_ts, with_date=False).orderBy(F.desc("date"), "portid")}


def cables(lines: DataFrame, landings: DataFrame) -> dict[str, DataFrame]:
    """Cables (id, name, line) with length and centroid, and landing points with the country after the last comma."""
    c = spatial.line_centroid(F.col("line"))
    length = spatial.line_length_km(F.col("line"))
    rows = lines.select("id", "name", "line", length.alias("_l"), c.alias("_c")).select("id", "name", "line", F.col("_l.km").alias("length_km"), F.col("_l.skipped").alias("skipped"), F.col("_c.x").alias("lon"), F.col("_c.y").alias("lat"))
    points = landings.withColumn("country", F.regexp_extract("name", ", ([^,]+)$", 1))
    return {"cables": shape.hilbert_sort(rows, "lon", "lat", ["id"]), "landing_points": shape.hilbert_sort(spatial.with_cells(points, "lat", "lon", [5, 8]), "lon", "lat", ["id"])}


def oil_flows(rows: DataFrame, areas: list[str], run_ts: str) -> dict[str, DataFrame]:
    """Monthly flows of some areas; marks of missing values become null."""
    out = rows.where(F.col("REF_AREA").isin(areas)).select(
        F.col("REF_AREA").alias("ref_area"), scalars.date_from_month(F.col("TIME_PERIOD")).alias("time_period"), F.col("ENERGY_PRODUCT").alias("energy_product"), F.col("FLOW_BREAKDOWN").alias("flow_breakdown"), scalars.number_or_null(F.col("OBS_VALUE"), "-", "x").alias("obs_value")
    )
    return {"monthly_flows": shape.stamp(out, run_ts).orderBy("ref_area", "time_period", "energy_product", "flow_breakdown")}


def outbreaks(items: DataFrame, names: dict[str, str], run_ts: str) -> dict[str, DataFrame]:
    """News items without markup, tagged with the codes of the places they name."""
    tags = scalars.keyword_tags([F.col("Title"), F.col("Summary")], names)
    rows = items.select(F.col("Id").alias("id"), F.coalesce("Title", F.lit("")).alias("title"), F.col("PublicationDateAndTime").cast("timestamp").cast("timestamp_ntz").alias("published"), scalars.strip_html(F.col("Summary")).alias("summary"), tags.alias("me_countries"))
    return {"outbreaks": shape.stamp(rows.withColumn("is_me", F.col("me_countries") != ""), run_ts, with_date=False).orderBy(F.desc_nulls_last("published"), "id")}


def grid_clip(tables: dict[str, DataFrame], cell: str, res: int, box: tuple) -> dict[str, DataFrame]:
    """Grid tables clipped to the cells whose centre lies in a box, with the centre; the id range is pushed to the scan."""
    out = {}
    for name, df in tables.items():
        inside = df.where(spatial.center_in_bbox(F.col(cell), res, box))
        out[name] = inside.withColumns({"lat": spatial.cell_lat(F.col(cell), res), "lon": spatial.cell_lon(F.col(cell), res)}).orderBy(cell)
    return out


def infrastructure_features(features: DataFrame, rules: dict, keys: list[str], box: tuple, region: DataFrame | None = None) -> DataFrame:
    """Features (feature_id, tags, coords) inside a box, and inside the polygons of ``region`` (rings) if given, with a row for each
    category: one pass for all categories, which ``sinks.write_split`` writes as a table each."""
    p = spatial.representative_point(F.col("coords"))
    placed = features.withColumn("_p", p).withColumns({"lon": F.col("_p.x"), "lat": F.col("_p.y")}).drop("_p").where(spatial.in_bbox(F.col("lat"), F.col("lon"), box))
    if region is not None:
        each = region.select("rings").distinct().withColumn("region", F.xxhash64("rings"))
        cover = polygons.cover(each, "region", 5)
        placed = polygons.within(placed, "lat", "lon", cover, 5)
    return spatial.with_cells(shape.tags_to_columns(shape.classify_tags(placed, rules), keys), "lat", "lon", [5, 8]).drop("tags")


def infrastructure(features: DataFrame, rules: dict, keys: list[str], box: tuple, region: DataFrame | None = None) -> dict[str, DataFrame]:
    """The features as a DataFrame for each category, in the order of the curve; to write them all, ``infrastructure_features`` reads once."""
    rows = infrastructure_features(features, rules, keys, box, region)
    return {category: shape.hilbert_sort(rows.where(F.col("category") == category).drop("category"), "lon", "lat", ["feature_id"]) for category in rules}


def damage(pixels: DataFrame, box: tuple, rows: int, cols: int, event: str, run_ts: str, threshold: float = 2.0, step: int = 5) -> dict[str, DataFrame]:
    """Change per cell from pixels (scene, scene_date, band, y, x, value): speckle filter, Welch's t before and after an
    event, every ``step``-th pixel, aggregated to cells of resolution 7 with the finer cell at their centre."""
    dated = pixels.withColumn("period", scalars.event_window(F.col("scene_date"), event, 12, 60)).where(F.col("period").isNotNull())
    filtered = raster.lee_filter(dated.withColumn("value", scalars.nan_to_null(F.col("value").cast("double"))))
    t = raster.welch_t(filtered).where((F.col("y") % step == 0) & (F.col("x") % step == 0) & F.col("t").isNotNull())
    at = t.withColumn("_p", spatial.pixel_to_lonlat(F.col("y"), F.col("x"), box, rows, cols)).withColumn("cell_r7", spatial.cell_id(F.col("_p.lat"), F.col("_p.lon"), 7))
    cells = relate.cell_aggregate(at, "cell_r7", "t", threshold)
    out = cells.withColumns({"cell_r9": spatial.cell_center_child(F.col("cell_r7"), 7, 9), "cell_text": spatial.cell_text(F.col("cell_r7")), "event_date": F.lit(event).cast("date")})
    return {"damage_cells": shape.stamp(out, run_ts, with_date=False).orderBy(F.desc("ratio"), "cell_r7")}


def minimal(rows: DataFrame) -> dict[str, DataFrame]:
    """id, name and a position."""
    return {"data": rows.select("id", "name", "lat", "lon").orderBy("id")}


_WORLD = (-90, -180, 90, 180)


def _keyed(*keys: str, place: tuple[str, str] | None = None, **more) -> dict:
    """A spec: rows there, keys unique and not null, and places on the globe."""
    return {"min_rows": 1, "unique_cols": list(keys), "not_null": list(keys)} | ({"bbox": (*place, _WORLD)} if place else {}) | more


_LATLON = ("latitude", "longitude")
_CITY = ("city", "country_code", "latitude", "longitude")

#: What each feed promises of its tables: {feed: {table: spec}}, for ``sinks.write_checked`` and ``Catalog.merge``.
CHECKS: dict[str, dict[str, dict]] = {
    "news_events": {"events": _keyed("globaleventid", "snapshot_date", place=_LATLON, forbidden=PROTECTED)},
    "weather": {
        "weather_hourly": _keyed(*_CITY, "time", "snapshot_time", place=_LATLON),
        "weather_daily": _keyed(*_CITY, "date", "snapshot_time", place=_LATLON),
        "air_quality": _keyed(*_CITY, "time", "snapshot_time", place=_LATLON, optional=True),
    },
    "flights": {"states": _keyed("icao24", "snapshot_time", place=_LATLON), "flights": _keyed("icao24", "first_seen", optional=True)},
    "sanctions": {"region_sanctions": _keyed("id", "snapshot_date")},
    "fires": {"active_fires": _keyed("sensor", *_LATLON, "acq_date", "acq_time", "snapshot_time", place=_LATLON)},
    "natural_events": {"events": _keyed("event_id", "snapshot_time", place=_LATLON), "rejects": {"min_rows": 0}},
    "earthquakes": {"events": _keyed("event_id", "snapshot_time", place=_LATLON)},
    "signals": {"signals": _keyed("country_code", "datasource", "subtype", "timestamp", "snapshot_time")},
    "satellites": {"satellites": _keyed("norad_cat_id", "snapshot_time")},
    "chokepoints": {"chokepoints": _keyed("portid", place=("lat", "lon")), "daily_transits": _keyed("portid", "date")},
    "cables": {"cables": _keyed("id"), "landing_points": _keyed("id", place=("lat", "lon"))},
    "oil_flows": {"monthly_flows": _keyed("ref_area", "time_period", "energy_product", "flow_breakdown")},
    "outbreaks": {"outbreaks": _keyed("id")},
    "damage": {"damage_cells": _keyed("cell_r7", "event_date")},
    "minimal": {"data": _keyed("id", place=("lat", "lon"))},
}

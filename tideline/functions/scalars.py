"""Scalar helpers on columns: text, dates, numbers, nested values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Text


def clean_empty(c: Column) -> Column:
    """Trimmed, null if nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def strip_html(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]+>", "")


def split_list(c: Column, separator: str = ";") -> Column:
    """Split at a literal separator."""
    return F.split(c, "\\Q" + separator + "\\E", -1)


def keyword_tags(columns: list[Column], names: dict[str, str]) -> Column:
    """Sorted distinct codes, comma-joined, of the names that occur as whole words in any of the columns, in any case.

    One pass of an alternation over the text, then a lookup, whatever the number of names.
    """
    pattern = r"(?iU)\b(" + "|".join("\\Q" + n + "\\E" for n in sorted(names, key=len, reverse=True)) + r")\b"
    lookup = F.create_map(*(F.lit(x) for n, code in names.items() for x in (n.lower(), code)))
    text = F.concat_ws("\n", *columns)
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda m: lookup[F.lower(m)])
    return F.array_join(F.array_sort(F.array_distinct(found)), ",")


def contains_any(c: Column, codes: list[str], exact: bool = False, separator: str = ";") -> Column:
    """Whether the lower-cased text holds any code as a substring, or with ``exact`` as one of its separated items."""
    if exact:
        return F.arrays_overlap(split_list(F.lower(c), separator), F.array(*map(F.lit, codes)))
    out = F.lit(False)
    for code in codes:
        out = out | F.contains(F.lower(c), F.lit(code))
    return out


# Dates


def date_from_int(c: Column) -> Column:
    """yyyymmdd as a number to a date."""
    return F.to_date(c.cast("string"), "yyyyMMdd")


def date_from_month(c: Column) -> Column:
    """'yyyy-mm' to the month's first day."""
    return F.to_date(F.concat(c, F.lit("-01")))


def int_days_before(as_of: str, days: int) -> Column:
    """The day ``days`` before ``as_of`` as yyyymmdd; a constant for the optimizer."""
    return F.date_format(F.date_sub(F.lit(as_of).cast("date"), days), "yyyyMMdd").cast("int")


def event_window(day: Column, event: str, months_before: int, days_after: int) -> Column:
    """'pre', 'post' or null for days around an event; a month counts 30 days."""
    at = F.lit(event).cast("date")
    return F.when((day >= F.date_sub(at, 30 * months_before)) & (day < at), "pre").when((day >= at) & (day <= F.date_add(at, days_after)), "post")


# Numbers


def number_or_null(c: Column, *missing: str) -> Column:
    """Text as a double; null for the marks of missing values and for anything else that is no number."""
    for mark in missing:
        c = F.nullif(c, F.lit(mark))
    return c.try_cast("double")


def is_finite(c: Column) -> Column:
    return ~F.isnan(c) & (F.abs(c) != float("inf"))


def nan_to_null(c: Column) -> Column:
    """NaN orders above all numbers and spreads through aggregates; null is skipped."""
    return F.when(~F.isnan(c), c)


#: earth's gravitational parameter (km3/s2), radius (km) and sidereal day (s).
MU, EARTH_KM, SIDEREAL = 398600.4418, 6371.0, 86164.0905


def subsatellite(epoch: Column, motion: Column, inclination: Column, node: Column, anomaly: Column, at: Column) -> Column:
    """struct<lat, lon, alt_km>: an approximate ground track for displays, null without epoch or positive motion.

    ``motion`` is in turns a day, angles in degrees, missing ones count as 0. The mean anomaly, advanced to time ``at``, stands
    for the argument of latitude; longitude is the node plus that, less the earth's rotation since the epoch.
    """
    seconds = (F.unix_micros(at) - F.unix_micros(epoch)) / 1e6
    angle = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    axis = F.pow(F.lit(MU) * F.pow(F.lit(86400.0) / motion / (2 * 3.141592653589793), F.lit(2.0)), F.lit(1.0 / 3.0))
    u = F.pmod(angle(anomaly) + 360.0 * motion * seconds / 86400.0, F.lit(360.0))
    lat = F.degrees(F.asin(F.sin(F.radians(angle(inclination))) * F.sin(F.radians(u))))
    lon = F.pmod(angle(node) + u - F.pmod(seconds, F.lit(SIDEREAL)) / SIDEREAL * 360.0, F.lit(360.0))
    out = F.struct(F.round(lat, 4).alias("lat"), F.round(F.when(lon > 180, lon - 360.0).otherwise(lon), 4).alias("lon"), F.round(axis - EARTH_KM, 1).alias("alt_km"))
    return F.when(epoch.isNotNull() & (motion > 0), out)


# Nested values


def last_of(array: Column) -> Column:
    return F.get(array, F.size(array) - 1)


def first_of(array: Column) -> Column:
    return F.get(array, 0)


def join_field(array: Column, field: str, separator: str = ";") -> Column:
    """A field of an array of structs, joined; missing values are empty."""
    return F.array_join(F.transform(F.coalesce(array, F.array()), lambda s: s[field]), separator, "")


def zip_arrays(**arrays: Column) -> Column:
    """Parallel arrays as one array of structs; shorter arrays are filled with nulls."""
    return F.arrays_zip(*(a.alias(n) for n, a in arrays.items()))


def series(start: Column, step: Column, values: Column) -> Column:
    """A regular series as array<struct<at, value>> without missing values; start 0 and step 1800 unless given."""
    s, d = F.coalesce(start, F.lit(0)), F.coalesce(step, F.lit(1800))
    rows = F.transform(values, lambda v, i: F.struct((s + i * d).cast("bigint").alias("at"), v.alias("value")))
    return F.filter(rows, lambda r: r.value.isNotNull())

"""Data-quality checks that report as a table (check, status, observed, expected)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.footers import Footer
from .relate import duplicates

REPORT = "check string, status string, observed string, expected string"


def _row(name: str, ok, observed, expected: str, otherwise: str = "fail"):
    return F.struct(F.lit(name).alias("check"), F.when(ok, "pass").otherwise(otherwise).alias("status"), observed.cast("string").alias("observed"), F.lit(expected).alias("expected"))


def check(df: DataFrame, spec: dict) -> DataFrame:
    """Checks of ``spec``: min_rows, max_null_pct (with null_columns), not_null, unique_cols, required, forbidden,
    bbox (lat, lon, (south, west, north, east)), single_value, optional.

    Row counts, nulls, bounds and distinct values come from one aggregation; unique keys take a grouping of their own.
    A failing check of an optional table is a warning.
    """
    bad = "warn" if spec.get("optional") else "fail"
    n = F.count("*")
    rows = []
    if "min_rows" in spec:
        rows.append(_row("min_rows", n >= spec["min_rows"], n, str(spec["min_rows"]), bad))
    for c in spec.get("null_columns", df.columns) if "max_null_pct" in spec else []:
        pct = F.coalesce(F.round(100.0 * F.count_if(F.col(c).isNull()) / F.nullif(n, F.lit(0)), 1), F.lit(0.0))
        rows.append(_row(f"max_null_pct:{c}", pct <= spec["max_null_pct"], pct, str(spec["max_null_pct"]), bad))
    for c in spec.get("not_null", []):
        nulls = F.count_if(F.col(c).isNull())
        rows.append(_row(f"not_null:{c}", nulls == 0, nulls, "0", bad))
    for c in spec.get("single_value", []):
        distinct = F.countDistinct(c)
        rows.append(_row(f"single_value:{c}", distinct == 1, distinct, "1", bad))
    if "bbox" in spec:
        lat, lon, (south, west, north, east) = spec["bbox"]
        inside = (F.min(lat) >= south) & (F.max(lat) <= north) & (F.min(lon) >= west) & (F.max(lon) <= east)
        seen = F.concat_ws(",", *(f(c).cast("string") for c in (lat, lon) for f in (F.min, F.max)))
        rows.append(_row("bbox", inside, seen, f"{south},{north},{west},{east}", bad))
    out = df.agg(F.array(*rows).alias("r")).select(F.inline("r")) if rows else df.sparkSession.createDataFrame([], REPORT)
    if "unique_cols" in spec:
        twice = duplicates(df, spec["unique_cols"]).agg(F.count("*").alias("n"))
        out = out.unionByName(twice.select(F.inline(F.array(_row("unique", F.col("n") == 0, F.col("n"), "0", bad)))))
    columns = []
    for name, wrong in (("required", set(spec.get("required", [])) - set(df.columns)), ("forbidden", set(spec.get("forbidden", [])) & set(df.columns))):
        if name in spec:
            columns.append((f"{name}_columns", bad if wrong else "pass", ",".join(sorted(wrong)), ""))
    if "required" in spec and (extra := set(df.columns) - set(spec["required"])):
        columns.append(("extra_columns", "warn", ",".join(sorted(extra)), ""))
    return out.unionByName(df.sparkSession.createDataFrame(columns, REPORT)) if columns else out


# The same checks from figures that are known before or while a table is read: footers of files, or metrics of a write.


def figures(spec: dict, columns: list[str]) -> dict[str, Column]:
    """The aggregates that a spec needs, by name; none is of distinct values, so a write can observe them."""
    out = {"rows": F.count("*")}
    nulls = [*spec.get("not_null", []), *(spec.get("null_columns", columns) if "max_null_pct" in spec else [])]
    out |= {f"nulls:{c}": F.count_if(F.col(c).isNull()) for c in nulls}
    ends = [*spec.get("single_value", []), *(spec["bbox"][:2] if "bbox" in spec else [])]
    return out | {f"{n}:{c}": f(c) for c in ends for n, f in (("min", F.min), ("max", F.max))}


def judged(spec: dict, columns: list[str], seen: dict) -> list[tuple[str, str, str, str]]:
    """Rows of a report from the values of ``figures``. A single value is told by equal ends, so more are reported as "2+"."""
    bad, rows, n = "warn" if spec.get("optional") else "fail", [], seen["rows"]
    add = lambda name, ok, observed, expected: rows.append((name, "pass" if ok else bad, str(observed), str(expected)))
    if "min_rows" in spec:
        add("min_rows", n >= spec["min_rows"], n, spec["min_rows"])
    for c in spec.get("null_columns", columns) if "max_null_pct" in spec else []:
        pct = round(100.0 * seen[f"nulls:{c}"] / n, 1) if n else 0.0
        add(f"max_null_pct:{c}", pct <= spec["max_null_pct"], pct, spec["max_null_pct"])
    for c in spec.get("not_null", []):
        add(f"not_null:{c}", not seen[f"nulls:{c}"], seen[f"nulls:{c}"], 0)
    for c in spec.get("single_value", []):
        low, high = seen[f"min:{c}"], seen[f"max:{c}"]
        add(f"single_value:{c}", low is not None and low == high, "0" if low is None else "1" if low == high else "2+", 1)
    if "bbox" in spec:
        lat, lon, (south, west, north, east) = spec["bbox"]
        ends = [seen[f"{n}:{c}"] for c in (lat, lon) for n in ("min", "max")]
        inside = None not in ends and south <= float(ends[0]) and float(ends[1]) <= north and west <= float(ends[2]) and float(ends[3]) <= east
        add("bbox", inside, ",".join(str(e) for e in ends), f"{south},{north},{west},{east}")
    for name, wrong in (("required", set(spec.get("required", [])) - set(columns)), ("forbidden", set(spec.get("forbidden", [])) & set(columns))):
        if name in spec:
            add(f"{name}_columns", not wrong, ",".join(sorted(wrong)), "")
    if "required" in spec and (extra := set(columns) - set(spec["required"])):
        rows.append(("extra_columns", "warn", ",".join(sorted(extra)), ""))
    return rows


def _unique(df: DataFrame, spec: dict) -> list[tuple[str, str, str, str]]:
    if "unique_cols" not in spec:
        return []
    n = duplicates(df, spec["unique_cols"]).count()
    return [("unique", "pass" if not n else "warn" if spec.get("optional") else "fail", str(n), "0")]


def check_files(df: DataFrame, footers: list[Footer], spec: dict) -> list[tuple[str, str, str, str]]:
    """The report of ``spec`` on a table's files. What footers say is not read again: rows always, nulls and ends of columns where every
    file has them. The rest takes one aggregation, and unique keys a grouping, of the columns named alone."""
    if not spec:
        return []
    wanted, seen = figures(spec, df.columns), {"rows": sum(f.rows for f in footers)}
    for name in wanted:
        kind, _, c = name.partition(":")
        if kind == "rows" or not all(c in f.stats or not f.rows for f in footers):
            continue
        have = [f.stats[c] for f in footers if f.rows]
        if kind == "nulls":
            seen[name] = sum(k for _, _, k in have)
        elif dict(df.dtypes)[c] in ("tinyint", "smallint", "int", "bigint", "float", "double"):
            ends = [float(s[kind == "max"]) for s in have if s[0] is not None]
            seen[name] = (min if kind == "min" else max)(ends, default=None)
    rest = [n for n in wanted if n not in seen]
    if rest:
        seen |= dict(zip(rest, df.agg(*(wanted[n] for n in rest)).first(), strict=True))
    return judged(spec, df.columns, seen) + _unique(df, spec)


class Watched:
    """A table whose checks are computed by the job that writes it: write ``df``, then ask for the ``report``."""

    def __init__(self, df: DataFrame, spec: dict):
        self.spec, self._seen = spec, Observation()
        self._wanted = figures(spec, df.columns)
        self.df = df.observe(self._seen, *(c.alias(n) for n, c in self._wanted.items()))

    def report(self, written: DataFrame) -> DataFrame:
        """The report; unique keys are looked up in the table as it was written, by their columns alone."""
        rows = judged(self.spec, self.df.columns, self._seen.get) + _unique(written, self.spec)
        return self.df.sparkSession.createDataFrame(rows, REPORT)


def check_contains(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """The expected values that do not occur."""
    expected = df.sparkSession.createDataFrame([(v,) for v in values], f"{column} string")
    return expected.join(df.select(column).distinct(), column, "left_anti")


def schema_diff(old: StructType, new: StructType, spark) -> DataFrame:
    """(column, old_type, new_type, compatible): added columns are compatible, missing or retyped ones are not."""
    a, b = ({f.name: f.dataType.simpleString() for f in s} for s in (old, new))
    rows = [(c, a.get(c), b.get(c), c not in a or a[c] == b.get(c)) for c in sorted({*a, *b})]
    return spark.createDataFrame(rows, "column string, old_type string, new_type string, compatible boolean")


def merged_spec(common: dict, overrides: dict | None = None) -> dict:
    """The checks of a table: the common ones, replaced one by one by the table's own."""
    return common | (overrides or {})


def check_tables(tables: dict[str, DataFrame], common: dict, overrides: dict[str, dict] | None = None) -> DataFrame:
    """Reports of several tables, with ``table`` first."""
    out = None
    for name, df in tables.items():
        part = check(df, merged_spec(common, (overrides or {}).get(name))).select(F.lit(name).alias("table"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def enforce(report: DataFrame) -> None:
    """An error that names the failed checks (a report has a row a check, so it is small)."""
    failed = [f"{r.check}: {r.observed} (expected {r.expected})" for r in report.where("status = 'fail'").collect()]
    if failed:
        raise ValueError("; ".join(failed))


def ownership(contract: DataFrame) -> DataFrame:
    """schema.table pairs that more than one workspace declares."""
    return contract.groupBy("schema", "table").agg(F.countDistinct("workspace").alias("owners")).where("owners > 1")


def run_status(workspaces: DataFrame, runs: DataFrame) -> DataFrame:
    """Workspaces by the conclusion of their latest run: (status, n); ``running`` without a conclusion, ``none`` without a run."""
    last = runs.groupBy("workspace").agg(F.max_by(F.coalesce("conclusion", F.lit("running")), "run_started_at").alias("status"))
    return workspaces.select("workspace").join(last, "workspace", "left").groupBy(F.coalesce("status", F.lit("none")).alias("status")).agg(F.count("*").alias("n"))

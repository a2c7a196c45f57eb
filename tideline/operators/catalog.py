"""A catalog: tables whose states are lists of files, kept in a manifest on disk.

Every change writes a manifest folder next to the old ones and never touches a data file. One writer at a time. What is known of a file
(rows, columns, bounds) is read from its footer when it is registered, so registering, counting, pruning and choosing files to rewrite
need no pass over data. The driver holds a row for each file that it registers or lists, and nothing of their contents.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from ..session import hadoop_path, scratch
from ..sources.footers import Footer, read_footers
from ..sources.readers import list_files, rows_to_table
from . import quality, sketches
from .manifest import MANIFEST, arrival, file_changes, may_hold, merged_schema, new_files, orphan_files, rollback, visible
from .relate import dedup, row_changes

PROFILE = "path string, column_name string, column_type string, count bigint, nulls bigint, lo double, hi double, mean double, m2 double, distinct binary, ranks binary"


def read_from() -> Column:
    """A row's file as manifests have it: metadata columns encode special characters, and write the empty authority of local files out."""
    return F.regexp_replace(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), "^file:///", "file:/")


class Catalog:
    """Tables registered under ``root``: own data in schema/table/vN, the manifest in _manifest/vN, of which the greatest counts."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # The manifest

    def _manifest_version(self) -> int:
        path, fs = hadoop_path(self.spark, f"{self.root}/_manifest")
        if not fs.exists(path):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return max((int(n[1:]) for n in names if n.startswith("v") and fs.exists(hadoop_path(self.spark, f"{self.root}/_manifest/{n}/_SUCCESS")[0])), default=0)

    def manifest(self) -> DataFrame:
        n = self._manifest_version()
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/_manifest/v{n}") if n else self.spark.createDataFrame([], MANIFEST)

    def save(self, manifest: DataFrame) -> None:
        """The next manifest; it has a row a file, so one task writes it. What a failed try left under its name goes."""
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/_manifest/v{self._manifest_version() + 1}")

    def _own(self, schema: str, table: str) -> Column:
        return (F.col("schema") == schema) & (F.col("table") == table)

    def _next(self, manifest: DataFrame, schema: str, table: str) -> int:
        return (manifest.where(self._own(schema, table)).agg(F.max("version")).first()[0] or 0) + 1

    def _files(self, folder: str) -> list[str]:
        """The data files right in a folder that was just written."""
        where, fs = hadoop_path(self.spark, folder)
        return sorted(s.getPath().toString() for s in fs.listStatus(where) if s.getPath().getName().endswith(".parquet"))

    def _rows(self, footers: list[Footer], schema: str, table: str, version: int, ts: str, mode: str, source: str | None = None, runs: dict[str, str] | None = None, columns: str | None = None, places: dict[str, str] | None = None) -> DataFrame:
        """Manifest rows of files by their footers. ``columns`` stands for those that do not name theirs."""
        rows = [(schema, table, version, f.path, f.bytes, f.rows, mode, f.columns or columns or self.spark.read.parquet(f.path).schema.json(), f.stats, source, (runs or {}).get(f.path), (places or {}).get(f.path)) for f in footers]
        kept = MANIFEST.replace("ts timestamp_ntz, ", "")
        return rows_to_table(self.spark, rows, kept).withColumn("ts", F.lit(ts).cast("timestamp_ntz")).select(*self.manifest().columns)

    def _removed(self, manifest: DataFrame, schema: str, table: str, version: int, ts: str, paths: list[str]) -> DataFrame:
        wanted = rows_to_table(self.spark, [(p,) for p in paths], "path string")
        gone = self._state(schema, table).join(wanted, "path", "left_semi").dropDuplicates(["path"])
        return gone.withColumns({"version": F.lit(version), "ts": F.lit(ts).cast("timestamp_ntz"), "mode": F.lit("remove"), "stats": F.lit(None).cast(manifest.schema["stats"].dataType), "columns": F.lit(None).cast("string")})

    # Reading

    def _state(self, schema: str, table: str, version: int | None = None, ts: str | None = None) -> DataFrame:
        """``visible`` of one table: what resets and removes its files is looked up first, which saves the joins for all tables."""
        own = self.manifest().where(self._own(schema, table) & (F.col("mode") != "expired"))
        own = own if version is None else own.where(F.col("version") <= version)
        own = own if ts is None else own.where(F.col("ts") <= F.lit(ts).cast("timestamp_ntz"))
        reset, removes = own.agg(F.max(F.when(F.col("mode") == "replace", F.col("version"))), F.count_if(F.col("mode") == "remove")).first()
        own = own.where(F.col("version") >= (reset or 0))
        return visible(own) if removes else own

    def files(self, schema: str, table: str, version: int | None = None, ts: str | None = None, where: dict[str, tuple] | None = None) -> DataFrame:
        """Manifest rows of a state, without files whose bounds rule the wanted (low, high) of any column out; a null bound is open."""
        found = self._state(schema, table, version, ts)
        return self._fitting(found, self._schema(found), where) if where else found

    def _fitting(self, files: DataFrame, columns: StructType, where: dict[str, tuple]) -> DataFrame:
        for column, (low, high) in where.items():
            files = files.where(may_hold(column, columns[column].dataType, low, high))
        return files

    def _schema(self, files: DataFrame) -> StructType:
        kinds = sorted((r.v, r["columns"]) for r in files.groupBy("columns").agg(F.min("version").alias("v")).collect())
        return merged_schema([StructType.fromJson(json.loads(c)) for _, c in kinds])

    def table(self, schema: str, table: str, version: int | None = None, ts: str | None = None, where: Column | dict[str, tuple] | None = None) -> DataFrame:
        """The table as of a version or time. Its list of files is resolved here (a path a file, as Spark's own list of a folder), the
        data is read lazily. ``where``: a condition, or {column: (low, high)}, by which whole files are left out before any is opened."""
        bounds = where if isinstance(where, dict) else {}
        files = self._state(schema, table, version, ts)
        columns = self._schema(files)
        if not len(columns):
            raise ValueError(f"no such table or version: {schema}.{table}")
        df = self._read(columns, sorted({r.path for r in self._fitting(files, columns, bounds).select("path").collect()}))
        for column, (low, high) in bounds.items():
            df = df if low is None else df.where(F.col(column) >= F.lit(low))
            df = df if high is None else df.where(F.col(column) <= F.lit(high))
        return df.where(where) if isinstance(where, Column) else df

    def _read(self, columns: StructType, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(columns).parquet(*paths) if paths else self.spark.createDataFrame([], columns)

    def changes(self, schema: str, table: str, since: int, upto: int | None = None) -> DataFrame:
        """Rows that came and went between two versions, with ``change``: insert or delete. Only files that one state has and the other
        has not are read, and rows are compared only where there are such on both sides (files were rewritten)."""
        manifest = self.manifest().where(self._own(schema, table))
        by: dict[str, list[str]] = {"insert": [], "delete": []}
        for r in file_changes(manifest, since, upto).collect():
            by[r.change].append(r.path)
        columns = self._schema(self._state(schema, table, since).unionByName(self._state(schema, table, upto)))
        return row_changes(*(self._read(columns, by[k]) if by[k] else None for k in ("delete", "insert")), self._read(columns, []))

    def profile(self, schema: str, table: str, columns: list[str] | None = None) -> DataFrame:
        """The profile (``sketches.merged``) of a table's newest state. Sketches of files are kept under _profile; only files without one,
        and columns that they have none of, are read."""
        df, home = self.table(schema, table), f"{self.root}/_profile/{schema}/{table}"
        columns = columns or [f.name for f in df.schema if not isinstance(f.dataType, (ArrayType, MapType, StructType))]
        where, fs = hadoop_path(self.spark, home)
        names = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
        parts = [f"{home}/{n}" for n in names if fs.exists(hadoop_path(self.spark, f"{home}/{n}/_SUCCESS")[0])]
        kept = self.spark.read.schema(PROFILE).parquet(*parts) if parts else self.spark.createDataFrame([], PROFILE)
        files = self._state(schema, table).select("path").distinct()
        wanted = files.crossJoin(rows_to_table(self.spark, [(c,) for c in columns], "column_name string"))  # a few names
        missing: dict[tuple, list[str]] = {}
        for r in wanted.join(kept, ["path", "column_name"], "left_anti").groupBy("path").agg(F.array_sort(F.collect_set("column_name")).alias("names")).collect():
            missing.setdefault(tuple(r.names), []).append(r.path)
        for k, (own, paths) in enumerate(sorted(missing.items())):  # one pass for each set of columns, usually one
            rows = self._read(df.schema, sorted(paths)).withColumn("path", read_from())
            made = sketches.sketch(rows.select("path", *own), list(own), "path")
            made.coalesce(1 + len(paths) // 1000).write.parquet(f"{home}/p{len(names) + k}")
            parts.append(f"{home}/p{len(names) + k}")
        kept = self.spark.read.schema(PROFILE).parquet(*parts) if parts else kept
        return sketches.merged(kept.where(F.col("column_name").isin(columns)).join(files, "path", "left_semi"))

    # Writing

    def _write(self, df: DataFrame, schema: str, table: str, version: int) -> list[Footer]:
        path = f"{self.root}/{schema}/{table}/v{version}-{self._manifest_version() + 1}"
        df.write.mode("overwrite").parquet(path)
        return read_footers(self.spark, self._files(path))

    def add(self, schema: str, table: str, df: DataFrame, ts: str, mode: str = "append", source: str | None = None, run: str | None = None) -> int:
        """Writes ``df`` as the table's next version and registers its files; the version."""
        manifest = self.manifest()
        version = self._next(manifest, schema, table)
        footers = self._write(df, schema, table, version)
        self.save(manifest.unionByName(self._rows(footers, schema, table, version, ts, mode, source, {f.path: run for f in footers}, df.schema.json())))
        return version

    def commit(self, schema: str, table: str, df: DataFrame, ts: str, source: str, run: str) -> int | None:
        """``add`` once for each run of a source: a run that is registered is not written again, and files that a try left which
        failed before it was registered are no one's and go with ``remove_orphans``. None if there was nothing to do."""
        if not self.manifest().where(self._own(schema, table) & (F.col("source") == source) & (F.col("run") == run)).isEmpty():
            return None
        return self.add(schema, table, df, ts, source=source, run=run)

    def upsert(self, schema: str, table: str, df: DataFrame, keys: list[str], by: str, ts: str) -> int | None:
        """Merges rows into a table by key: the newest by ``by`` stays, of equal ones the new row. The version, None if nothing changes.

        Only files are rewritten that hold a row which a new one beats. They are found among those whose bounds can hold the new keys,
        by reading the keys and ``by`` alone; all other files stay as they are. A key is in a table once; null keys are equal. New
        rows that are beaten, or that say what is there already, change nothing.
        """
        manifest = self.manifest()
        path = scratch(self.spark, "upsert")
        dedup(df, keys, [F.desc_nulls_last(by), *(F.desc_nulls_last(c) for c in df.columns if c not in (by, *keys))]).write.parquet(f"{path}/new")
        new = self.spark.read.schema(df.schema).parquet(f"{path}/new")
        ends = new.agg(*(f(k).alias(f"{n}_{k}") for k in keys for n, f in (("lo", F.min), ("hi", F.max))), *(F.count_if(F.col(k).isNull()).alias(f"nulls_{k}") for k in keys)).first()
        bounds = {k: (ends[f"lo_{k}"], ends[f"hi_{k}"]) for k in keys if not ends[f"nulls_{k}"] and ends[f"lo_{k}"] is not None}
        state = self._state(schema, table)
        columns = merged_schema([self._schema(state), df.schema])
        paths = sorted({r.path for r in self._fitting(state, columns, bounds).select("path").collect()})
        same = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys]
        old = self._read(columns, paths)
        old = old.withColumn("_path", read_from()) if paths else old.withColumn("_path", F.lit(None).cast("string"))
        newer = F.col(f"n.{by}").isNotNull() & (F.col(f"o.{by}").isNull() | (F.col(f"n.{by}") > F.col(f"o.{by}")))
        tie = F.col(f"n.{by}").eqNullSafe(F.col(f"o.{by}"))
        met = old.select(*keys, by, "_path").alias("o").join(new.select(*keys, by).alias("n"), same("o", "n"))
        met.select(*(F.col(f"n.{k}").alias(k) for k in keys), "_path", F.when(newer, "beats").when(tie, "ties").otherwise("loses").alias("result")).write.parquet(f"{path}/met")
        met = self.spark.read.parquet(f"{path}/met")
        # Rows that tie are compared whole, in the files that hold such.
        tied = [r[0] for r in met.where("result = 'ties'").select("_path").distinct().collect()]
        wins, idle = met.where("result = 'beats'"), met.where("result = 'loses'").select(*keys)
        if tied:
            both = self._read(columns, tied).withColumn("_path", read_from()).alias("o").join(new.alias("n"), [*same("o", "n"), tie])
            equal = F.lit(True)
            for c in columns.names:
                equal = equal & F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}") if c in df.columns else F.lit(None))
            both.select(*(F.col(f"n.{k}").alias(k) for k in keys), "_path", F.when(equal, "loses").otherwise("beats").alias("result")).write.parquet(f"{path}/tied")
            settled = self.spark.read.parquet(f"{path}/tied")
            wins, idle = wins.unionByName(settled.where("result = 'beats'")), idle.unionByName(settled.where("result = 'loses'").select(*keys))
        touched = [r[0] for r in wins.select("_path").distinct().orderBy("_path").collect()]
        rows = new.alias("n").join(idle.alias("o"), same("n", "o"), "left_anti").select("n.*")
        if not touched and rows.isEmpty():
            return None
        kept = self._read(columns, touched).alias("o").join(rows.alias("n"), same("o", "n"), "left_anti").select("o.*")
        version = self._next(manifest, schema, table)
        footers = self._write(kept.unionByName(rows, allowMissingColumns=True), schema, table, version)
        added = self._rows([f for f in footers if f.rows], schema, table, version, ts, "append", columns=columns.json())
        self.save(manifest.unionByName(added).unionByName(self._removed(manifest, schema, table, version, ts, touched)) if touched else manifest.unionByName(added))
        return version

    def compact(self, schema: str, table: str, ts: str, target: int = 128 << 20, order: str | None = None) -> int | None:
        """Merges neighbouring small files up to ``target`` bytes each; the version, None if there is nothing to merge.

        Files are neighbours by the least value of the column ``order``, or else as they came. Those of half the target or more stay
        as they are and end a group. A group becomes one file, with its rows in the order of ``order``, or else as they were.
        """
        manifest = self.manifest()
        found = self.files(schema, table)
        columns = self._schema(found)
        first = F.col("stats")[order]["lo"].cast(columns[order].dataType) if order else F.lit(0)
        groups, size = [[]], 0
        for r in found.select("path", "bytes", first.alias("first"), arrival().alias("place")).dropDuplicates(["path"]).orderBy("first", "place").collect():
            if r.bytes * 2 >= target or size + r.bytes > target:
                groups.append([])
                size = 0
            if r.bytes * 2 < target:
                groups[-1].append(r)
                size += r.bytes
        groups = [g for g in groups if len(g) > 1]
        if not groups:
            return None
        paths = [r.path for g in groups for r in g]
        numbers = rows_to_table(self.spark, [(r.path, k, n) for k, g in enumerate(groups) for n, r in enumerate(g)], "_path string, _group int, _file int")
        rows = self._read(columns, paths).select("*", read_from().alias("_path"), F.col("_metadata.row_index").alias("_row")).join(numbers, "_path")
        rows = rows.repartitionById(len(groups), F.col("_group")).sortWithinPartitions(*([F.asc_nulls_first(order)] if order else []), "_file", "_row")
        version = self._next(manifest, schema, table)
        footers = self._write(rows.select(*columns.names), schema, table, version)
        if sum(f.rows for f in footers) != sum(f.rows for f in read_footers(self.spark, paths)):
            raise ValueError(f"{schema}.{table}: merged files have other rows than those they stand for")
        # A group is a partition, whose number is in its file's name.
        places = {f.path: groups[int(f.path.rsplit("/", 1)[1].split("-")[1])][0].place for f in footers if f.rows}
        added = self._rows([f for f in footers if f.rows], schema, table, version, ts, "append", columns=columns.json(), places=places)
        self.save(manifest.unionByName(added).unionByName(self._removed(manifest, schema, table, version, ts, paths)))
        return version

    # Lakes

    def merge(self, source: str, ts: str, modes: dict[str, str] | None = None, checks: dict[str, dict] | None = None, publish: bool = True) -> DataFrame:
        """Registers what pipelines wrote under ``source`` as schema/table/run/files: a report of (schema, table, run, version, files, rows, status).

        Files that no version lists are taken together as one new version of their table: all of them (append), or those of the
        greatest run only (``modes``: replace). Runs are compared with those of the same source; older ones than the registered
        are reported as skipped. A table whose new files fail its ``checks`` (a spec of ``quality.check`` for each table, or under
        ``*`` for all), or change a column's type, is rejected and nothing of it registered. Merging again finds nothing new. Row
        counts, nulls and bounds come from footers; data is read, once, only for checks that these cannot answer.
        """
        place, _ = hadoop_path(self.spark, source)
        home = place.toUri().getPath().rstrip("/")
        within = lambda k: F.regexp_extract("path", "\\Q" + home + "\\E/([^/]+)/([^/]+)/(?:(.*)/)?[^/]+$", k)
        manifest, added, report = self.manifest(), None, []
        found = new_files(list_files(self.spark, source, "*.parquet"), manifest).select("path", within(1).alias("schema"), within(2).alias("table"), within(3).alias("run")).where("schema <> '' and table <> ''")
        arrived: dict[tuple, dict[str, str]] = {}
        for r in found.collect():
            arrived.setdefault((r.schema, r.table), {})[r.path] = r.run
        known = {(r.schema, r.table): r for r in manifest.groupBy("schema", "table").agg(F.max("version").alias("version"), F.max(F.when(F.col("source") == home, F.col("run"))).alias("run")).collect()}
        for (schema, table), own in sorted(arrived.items()):
            before = known.get((schema, table))
            mode, run = (modes or {}).get(table, "append"), max(own.values())
            if mode == "replace":
                newest = before.run if before else None
                old = {p for p, k in own.items() if k < run or (newest is not None and k < newest)}
                if old:
                    report.append((schema, table, None, None, len(old), None, "skipped: an older run"))
                own = {p: k for p, k in own.items() if p not in old}
                if not own:
                    continue
                mode = "append" if run == newest else mode  # late files of the registered run
            footers = read_footers(self.spark, sorted(own))
            version = (before.version if before else 0) + 1
            part = self._rows(footers, schema, table, version, ts, mode, home, own)
            kinds = [self._schema(self._state(schema, table))] if before and mode == "append" else []
            wrong = []
            try:
                columns = merged_schema(kinds + [self._schema(part)])
            except ValueError as error:
                wrong.append(str(error))
            else:
                spec = (checks or {}).get("*", {}) | (checks or {}).get(table, {})
                wrong += [r[0] for r in quality.check_files(self._read(columns, sorted(own)), footers, spec) if r[1] == "fail"]
            if not wrong:
                added = part if added is None else added.unionByName(part)
            report.append((schema, table, run, None if wrong else version, len(own), sum(f.rows for f in footers), f"rejected: {', '.join(wrong)}" if wrong else "registered"))
        if added is not None:
            self.save(manifest.unionByName(added))
        if publish:
            self.publish()
        return rows_to_table(self.spark, report, "schema string, table string, run string, version int, files int, rows bigint, status string")

    def publish(self) -> list[str]:
        """Every table's newest state as a view ``schema_table``; the names. Two tables of one name are an error, and none is published."""
        tables = [tuple(r) for r in self.manifest().select("schema", "table").distinct().orderBy("schema", "table").collect()]
        names: dict[str, tuple] = {}
        for schema, table in tables:
            other = names.setdefault(f"{schema}_{table}".lower(), (schema, table))  # views are told apart without regard to case
            if other != (schema, table):
                raise ValueError(f"{schema}.{table} and {'.'.join(other)} would both be the view {schema}_{table}")
        for schema, table in tables:
            self.table(schema, table).createOrReplaceTempView(f"{schema}_{table}")
        return [f"{schema}_{table}" for schema, table in tables]

    # Keeping house

    def rollback(self, schema: str, table: str, to: int, ts: str) -> int:
        """One more version of a table with the files of version ``to``; the version."""
        manifest = self.manifest()
        version = self._next(manifest, schema, table)
        own = rollback(manifest.where(self._own(schema, table)), to, ts).where(F.col("version") == version)
        self.save(manifest.unionByName(own))
        return version

    def expire(self, as_of: str, days: int = 30) -> int:
        """Gives files up that no state of the last ``days`` shows; how many rows. They stay on storage until ``remove_orphans``, and their
        paths stay known until then, so that ``merge`` does not take them for new ones."""
        manifest = self.manifest()
        cut = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {days} DAYS")
        # What the last state before the cut lacks is in no later one.
        base = manifest.where((F.col("ts") < cut) & (F.col("mode") != "expired")).groupBy("schema", "table").agg(F.max("version").alias("_base"))
        tables = manifest.join(base, ["schema", "table"], "left").withColumn("_base", F.coalesce("_base", F.lit(0)))
        keys = ["schema", "table", "version", "path"]
        shown = visible(tables.where("version <= _base").select(*manifest.columns)).select(*keys)
        old = tables.where("version <= _base and mode <> 'expired'").select(*manifest.columns)
        gone = old.join(shown, keys, "left_anti")
        n = gone.count()
        if n:
            marked = gone.where("mode <> 'remove'").withColumn("mode", F.lit("expired"))
            self.save(manifest.join(gone.select(*keys, "mode"), [*keys, "mode"], "left_anti").unionByName(marked))
        return n

    def remove_orphans(self, as_of: str, days: int = 7, folder: str | None = None) -> int:
        """Deletes data files under the catalog's root (or ``folder``) that no version shows and that are older than ``days``; how many."""
        files = list_files(self.spark, folder or self.root, "*.parquet").where(~F.col("path").contains("/_manifest/"))
        manifest, gone = self.manifest(), []
        for r in orphan_files(files, manifest, as_of, days).select("path").toLocalIterator():
            where, fs = hadoop_path(self.spark, r.path)
            if fs.delete(where, False):
                gone.append(r.path)
        if gone and not manifest.where("mode = 'expired'").isEmpty():
            deleted = rows_to_table(self.spark, [(p, "expired") for p in gone], "path string, mode string")
            self.save(manifest.join(deleted, ["path", "mode"], "left_anti"))
        return len(gone)

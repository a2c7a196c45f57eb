"""Joins, aggregations and window operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.spatial import BITS, cell_id, cell_parent


def lookup(df: DataFrame, values: dict[str, str], key: Column, name: str) -> DataFrame:
    """A constant dimension as a literal map: no join at all."""
    return df.withColumn(name, F.create_map(*(F.lit(x) for kv in values.items() for x in kv))[key])


def semi_join_contains(df: DataFrame, codes: DataFrame, text: str, code: str, most: int = 64) -> DataFrame:
    """Rows whose lower-cased text contains any code. Up to ``most`` distinct codes are compared with every row where it is; of more,
    every text is cut to the pieces that are as long as codes, and these are joined, shuffled by Spark as any other keys."""
    codes = codes.select(F.col(code).alias("_code")).where(F.col(code).isNotNull()).distinct()
    lower = F.lower(F.col(text))
    if codes.limit(most + 1).count() <= most:
        return df.join(F.broadcast(codes), F.contains(lower, F.col("_code")), "left_semi")
    sizes = F.array(*(F.lit(r[0]) for r in codes.select(F.length("_code")).distinct().collect()))  # few: lengths of codes
    pieces = F.flatten(F.transform(sizes, lambda k: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("_text") - k + 1)), lambda i: F.substring(F.col("_text"), i, k))))
    texts = df.select(lower.alias("_text")).distinct()
    found = texts.select("_text", F.explode(F.array_distinct(pieces)).alias("_code")).join(codes, "_code").select("_text").distinct()
    return df.withColumn("_text", lower).join(found, "_text", "left_semi").select(*df.columns)


def cell_join(events: DataFrame, grid: DataFrame, cell: str, res: int, grid_cell: str, grid_res: int, how: str = "inner") -> DataFrame:
    """Events to a grid by cell; finer ids are lifted to the grid's resolution, so it is an equi-join."""
    lifted = F.col(cell) if res == grid_res else cell_parent(F.col(cell), res, grid_res)
    return events.withColumn("_cell", lifted).join(grid.withColumnRenamed(grid_cell, "_cell"), "_cell", how).withColumnRenamed("_cell", grid_cell if grid_cell not in events.columns else f"{grid_cell}_{grid_res}")


#: How partial aggregates are made from rows, and merged.
_PARTIAL = {"count": (F.count, F.sum), "sum": (F.sum, F.sum), "min": (F.min, F.min), "max": (F.max, F.max)}


def rollup_cells(df: DataFrame, lat: str, lon: str, resolutions: list[int], **aggregates: tuple[str, str]) -> DataFrame:
    """(res, cell, aggregates) at several resolutions. ``aggregates``: name=(kind, column), kind being count ("*" counts rows), sum, min, max or avg.

    Rows are aggregated once, at the finest resolution; as cells nest, coarser ones merge its partial results, so only cells, not rows,
    are repeated. Rows without a position have the null cell.
    """
    finest = max(resolutions, key=BITS.__getitem__)
    wanted = {}
    for name, (kind, column) in aggregates.items():
        wanted |= {name: (kind, column)} if kind != "avg" else {f"_sum_{name}": ("sum", column), f"_n_{name}": ("count", column)}
    fine = df.groupBy(cell_id(F.col(lat), F.col(lon), finest).alias("_fine")).agg(*(_PARTIAL[kind][0](column).alias(name) for name, (kind, column) in wanted.items()))
    cells = F.array(*(F.struct(F.lit(r).alias("res"), (F.col("_fine") if r == finest else cell_parent(F.col("_fine"), finest, r)).alias("cell")) for r in resolutions))
    lifted = fine.select(F.explode(cells).alias("_c"), *wanted).groupBy("_c.res", "_c.cell").agg(*(_PARTIAL[kind][1](name).alias(name) for name, (kind, _) in wanted.items()))
    return lifted.select("res", "cell", *((F.col(f"_sum_{n}") / F.nullif(f"_n_{n}", F.lit(0)) if kind == "avg" else F.col(n)).alias(n) for n, (kind, _) in aggregates.items()))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key tuples that occur more than once, nulls equal, with their count ``n``."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def null_pct(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: percentage of nulls of each column to one place; null for an empty table."""
    total = F.count("*")
    return df.agg(*(F.round(100.0 * F.count_if(F.col(c).isNull()) / F.nullif(total, F.lit(0)), 1).alias(c) for c in columns))


def summarize(df: DataFrame, columns: list[str]) -> DataFrame:
    """A row for each numeric column: min, max, approximate distinct count, mean, deviation, quartiles, count, null %. One pass."""
    parts = []
    for c in columns:
        v = F.col(c).cast("double")
        quartiles = F.percentile_approx(v, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
        parts.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(dict(df.dtypes)[c]).alias("column_type"),
                F.min(v).alias("min"),
                F.max(v).alias("max"),
                F.approx_count_distinct(c).alias("approx_unique"),
                F.avg(v).alias("avg"),
                F.stddev_samp(v).alias("std"),
                quartiles.alias("quartiles"),
                F.count("*").alias("count"),
                F.round(100.0 * F.count_if(F.col(c).isNull()) / F.nullif(F.count("*"), F.lit(0)), 2).alias("null_percentage"),
            )
        )
    rows = df.agg(F.array(*parts).alias("rows")).select(F.inline("rows"))
    return rows.select("column_name", "column_type", "min", "max", "approx_unique", "avg", "std", *(F.get("quartiles", F.lit(i)).alias(q) for i, q in enumerate(("q25", "q50", "q75"))), "count", "null_percentage")


def finite_sum(c: Column) -> Column:
    return F.sum(F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c))


def cell_aggregate(df: DataFrame, cell: str, value: str, threshold: float) -> DataFrame:
    """Per cell: rows, rows over a threshold, their share, mean and maximum."""
    n, over = F.count("*"), F.count_if(F.col(value) > threshold)
    return df.groupBy(cell).agg(n.alias("total"), over.alias("damaged"), F.round(F.avg(value), 3).alias("mean_value"), F.round(F.max(value), 3).alias("max_value"), F.round(over / F.greatest(n, F.lit(1)), 4).alias("ratio"))


def dedup(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row of each key: the first in a total order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def first_seen(df: DataFrame, key: str, order: list) -> DataFrame:
    """Across ordered sources the first occurrence of each id; rows without an id go."""
    return dedup(df.where(F.col(key).isNotNull()), [key], order)


def latest(df: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """The latest row of each key. A maximum of structs, combined before the shuffle, so long histories do not meet."""
    rest = [c for c in df.columns if c not in keys]
    top = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*by)).alias("_top"))
    return top.select(*keys, "_top.*").select(*df.columns)


def zscore(df: DataFrame, keys: list[str], order: list[str], value: str, n: int, block: Column) -> DataFrame:
    """Adds ``z``: distance from the mean of the previous n rows of the series in their sample deviations; null without spread.

    ``block`` cuts a series into ranges, such as days, that rise with ``order``; a block is computed from its own rows and
    the last n before it, so a task holds a block however long the series is. Only the blocks' row counts are seen in a row.
    """
    own = df.withColumn("_block", block)
    counts = own.groupBy(*keys, "_block").agg(F.count("*").alias("_rows"))
    following = Window.partitionBy(*keys).orderBy("_block").rowsBetween(1, n)
    lists = counts.withColumn("_next", F.collect_list(F.struct("_block", "_rows")).over(following))
    # Of each block's last rows, the ones that a later block needs are n less those of the blocks between.
    between = F.transform("_next", lambda b, i: F.struct(b["_block"].alias("_to"), F.aggregate(F.slice("_next", F.lit(1), i), F.lit(0).cast("bigint"), lambda s, x: s + x["_rows"]).alias("_between")))
    serves = lists.select(*keys, "_block", F.inline(F.filter(between, lambda b: b["_between"] < n)))
    last = Window.partitionBy(*keys, "_block").orderBy(*(F.desc(c) for c in order))
    tails = own.withColumn("_back", F.row_number().over(last)).where(F.col("_back") <= n)
    joined = tails.alias("t").join(serves.alias("s"), [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in [*keys, "_block"]])
    carried = joined.where(F.col("_back") + F.col("_between") <= n).select(*(F.col(f"t.{c}").alias(c) for c in df.columns), F.col("_to").alias("_block"), F.lit(False).alias("_own"))
    rows = own.withColumn("_own", F.lit(True)).unionByName(carried)
    before = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(-n, -1)
    mean, spread = F.avg(value).over(before), F.stddev_samp(value).over(before)
    return rows.withColumn("z", F.when(spread > 0, (F.col(value) - mean) / spread)).where("_own").drop("_own", "_block")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], by: str) -> DataFrame:
    """Newest wins by ``by``; of equal ones the new row."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return dedup(both, keys, [F.desc(by), F.desc("_new")]).drop("_new")


def table_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that came and went between two versions, with ``change``: insert or delete."""
    return new.exceptAll(old).withColumn("change", F.lit("insert")).unionByName(old.exceptAll(new).withColumn("change", F.lit("delete")))


def row_changes(deleted: DataFrame | None, inserted: DataFrame | None, empty: DataFrame) -> DataFrame:
    """``table_changes`` of the parts of two versions that differ; where one has no such part, the other's rows need no comparison."""
    if deleted is not None and inserted is not None:
        return table_changes(deleted, inserted)
    rows, change = (inserted, "insert") if inserted is not None else (deleted if deleted is not None else empty, "delete")
    return rows.withColumn("change", F.lit(change))

"""Coverage, progress and missing-row queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def coverage_pair(base: DataFrame, covering: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row ``covered, total``: rows of ``base`` whose key ``covering`` has, and all of them."""
    marked = base.select(*keys).join(covering.select(*keys).distinct().withColumn("_has", F.lit(True)), list(keys), "left")
    return marked.agg(F.count_if(F.col("_has")).alias("covered"), F.count("*").alias("total"))


def conditional_counts(rows: DataFrame, counts: Mapping[str, Column], keys: Sequence[str] = ()) -> DataFrame:
    """How many rows meet each condition; 0, not null, where there are none."""
    return rows.groupBy(*keys).agg(*[F.count_if(c).alias(n) for n, c in counts.items()])


def guarded_average(rows: DataFrame, unit: str, name: str, decimals: int = 6) -> DataFrame:
    """Rows for each distinct ``unit``, 0.0 when there is none: one row ``units, name``."""
    totals = rows.agg(F.count_distinct(unit).alias("units"), F.count("*").alias("n"))
    return totals.select("units", F.when(F.col("units") > 0, F.round(F.col("n") / F.col("units"), decimals)).otherwise(0.0).alias(name))


def missing(base: DataFrame, keys: Sequence[str], seen_in: Sequence[DataFrame], lacking: DataFrame) -> DataFrame:
    """Rows of ``base`` whose key is in any of ``seen_in`` and not in ``lacking``."""
    seen = seen_in[0].select(*keys)
    for other in seen_in[1:]:
        seen = seen.unionByName(other.select(*keys))
    return base.join(seen.distinct(), list(keys), "left_semi").join(lacking.select(*keys), list(keys), "left_anti")


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, n`` of each table."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = row if out is None else out.unionByName(row)
    return out


def capped_prefixes(names: DataFrame, column: str, cap: int, shortest: int = 2, longest: int = 4, step: int = 1) -> DataFrame:
    """Prefixes to search by: the shortest one whose number of names is under ``cap``, else the whole name.

    Returns ``prefix, n``. All lengths are counted in one aggregation.
    """
    lengths = list(range(shortest, longest + 1, step))
    rows = names.select(F.col(column).alias("name")).where(F.col("name").isNotNull())
    pieces = rows.select("name", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.substring("name", 1, k).alias("p")) for k in lengths])).alias("x"))
    sizes = pieces.groupBy("x.k", "x.p").agg(F.count("*").alias("n"))
    out, open_names = None, rows
    for k in lengths:
        own = sizes.where(F.col("k") == k).select(F.col("p").alias("prefix"), "n")
        marked = open_names.withColumn("prefix", F.substring("name", 1, k)).join(own, "prefix")
        done = marked.where(F.col("n") < cap).select("prefix", "n").distinct()
        out = done if out is None else out.unionByName(done)
        open_names = marked.where(F.col("n") >= cap).select("name")
    whole = open_names.groupBy(F.col("name").alias("prefix")).agg(F.count("*").alias("n"))
    return out.unionByName(whole)


def max_rows(rows: DataFrame, column: str) -> DataFrame:
    """The rows at the largest value of ``column``."""
    top = rows.agg(F.max(column).alias("_top"))
    return rows.join(F.broadcast(top), F.col(column) == F.col("_top")).drop("_top")


def new_files(files: DataFrame, manifest: DataFrame, key: str = "sha256") -> DataFrame:
    """Files whose hash the manifest lacks."""
    return files.join(manifest.select(key).distinct(), key, "left_anti")

"""A copy of the tables for readers: without the tables that they do not need, in few files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

#: Tables that a viewer does not need.
HIDDEN = ("runs", "fetch_log", "parse_warnings", "horse_ancestors", "pedigree_horses", "target_races", "target_runs", "target_horses", "target_horse_siblings", "target_import_files", "target_fills", "jra_horse_search", "jra_horse_links")


def viewer_copy(spark: SparkSession, source: str, target: str, tables: Sequence[str] | Mapping[str, str], hidden: Sequence[str] = HIDDEN, compression: str = "gzip", files: int = 1) -> list[str]:
    """Write the tables that are not hidden to ``target``; the source is only read. A mapping says where a table lies below the source. Returns their names."""
    kept = [t for t in tables if t not in hidden]
    places = tables if isinstance(tables, Mapping) else {}
    for name in kept:
        spark.read.parquet(f"{source}/{places.get(name, name)}").coalesce(files).write.mode("overwrite").option("compression", compression).parquet(f"{target}/{name}")
    return kept

"""One row or value for each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``, which should be total (end it with a key)."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_nth", nth).where("_nth = 1").drop("_nth")


def value_at_max(rows: DataFrame, keys: Sequence[str], value: str, order: str, name: str) -> DataFrame:
    """``value`` where ``order`` is largest; a null order comes before all others, ties go to the larger value."""
    rank = F.struct(F.col(order).isNotNull(), F.col(order), F.col(value))
    return rows.groupBy(*keys).agg(F.max_by(value, rank).alias(name))


def mode_by(rows: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """The commonest non-null value; of equally common ones the least. Also ``n``, how often it comes."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    return counts.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("n"), F.col(value))).alias(name), F.max("n").alias("n"))


def unanimous_by(rows: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """The keys all of whose non-null values are equal, with that value."""
    spread = rows.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.min(value).alias(name), F.max(value).alias("_most"))
    return spread.where(F.col(name) == F.col("_most")).drop("_most")


def conflicting(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The keys with more than one distinct value."""
    spread = rows.groupBy(*keys).agg(F.min(value).alias("_least"), F.max(value).alias("_most"))
    return spread.where(F.col("_least") != F.col("_most")).select(*keys)


def outer_merge(left: DataFrame, right: DataFrame, keys: Sequence[str], latest: Sequence[str] = ()) -> DataFrame:
    """Rows of either side by key; of common columns the left's value if it is not null, or the later one for ``latest``."""
    a, b = left.alias("a"), right.alias("b")
    condition = None
    for k in keys:
        part = F.col(f"a.{k}") == F.col(f"b.{k}")
        condition = part if condition is None else condition & part
    out = [F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in keys]
    for c in dict.fromkeys([*left.columns, *right.columns]):
        if c in keys:
            continue
        sides = [F.col(f"{s}.{c}") for s, df in (("a", left), ("b", right)) if c in df.columns]
        merged = sides[0] if len(sides) == 1 else F.greatest(*sides) if c in latest else F.coalesce(*sides)
        out.append(merged.alias(c))
    return a.join(b, condition, "full").select(*out)

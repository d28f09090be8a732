"""Joins that accept a candidate only where it is the only one, or the first that fits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from furlong.session import cut


def unique_candidates(candidates: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The keys with exactly one distinct ``value``."""
    spread = candidates.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.min(value).alias(value), F.max(value).alias("_most"))
    return spread.where(F.col(value) == F.col("_most")).drop("_most")


def unique_match(rows: DataFrame, candidates: DataFrame, keys: Sequence[str], value: str, fallback: Sequence[str] | None = None) -> DataFrame:
    """``rows`` with the ``value`` of their only candidate by ``keys``, else null.

    ``fallback`` keys are tried only for rows without any candidate by ``keys``;
    an ambiguous hit does not fall back.
    """
    known = candidates.select(*keys, value).groupBy(*keys).agg(F.count_distinct(value).alias("_hits"), F.min(value).alias("_only"))
    out = rows.join(known, list(keys), "left")
    found = F.when(F.col("_hits") == 1, F.col("_only"))
    if fallback:
        second = unique_candidates(candidates, fallback, value).withColumnRenamed(value, "_second")
        out = out.join(second, list(fallback), "left")
        found = F.when(F.col("_hits").isNull() | (F.col("_hits") == 0), F.col("_second")).otherwise(found)
    return out.select(*rows.columns, found.alias(value))


def fallback_match(rows: DataFrame, lookup: DataFrame, key: str, name: str, value: str, only_null: bool = False) -> DataFrame:
    """``value`` by ``key``, else by ``name``; of several rows with one key the last in the lookup's ``ordinal`` counts for ``key``, the first for ``name``.

    With ``only_null``, a row's own value stays where it has one.
    """
    ordered = lookup if "ordinal" in lookup.columns else lookup.withColumn("ordinal", F.lit(0))
    by_key = ordered.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(value, "ordinal").alias("_by_key"), F.lit(True).alias("_has_key"))
    by_name = ordered.where(F.col(name).isNotNull()).groupBy(name).agg(F.min_by(value, "ordinal").alias("_by_name"))
    out = rows.join(by_key, key, "left").join(by_name, name, "left")
    found = F.when(F.col("_has_key"), F.col("_by_key")).otherwise(F.col("_by_name"))
    if only_null:
        found = F.coalesce(F.col(f"{value}"), found) if value in rows.columns else found
    return out.select(*[c for c in rows.columns if c != value], found.alias(value))


def theta_unique(rows: DataFrame, candidates: DataFrame, equal: Sequence[str], bound: str, limit: Column, row_key: str, value: str) -> DataFrame:
    """``row_key, value`` of the rows with exactly one candidate that is equal in ``equal`` and whose ``bound`` is at most the row's ``limit``.

    A row has one such candidate if the least of its key's bounds is within the
    limit and the second least is not, so two candidates of each key are all that
    a row meets. A null bound or limit fits nothing.
    """
    nth = F.row_number().over(Window.partitionBy(*equal).orderBy(bound, value))
    least = candidates.where(F.col(bound).isNotNull()).select(*equal, bound, value).withColumn("_nth", nth).where("_nth <= 2")
    two = least.groupBy(*equal).agg(F.min(bound).alias("_least"), F.min_by(value, "_nth").alias(value), F.max(F.when(F.col("_nth") == 2, F.col(bound))).alias("_second"))
    limited = rows.select(F.col(row_key), *equal, limit.alias("_limit"))
    return limited.join(two, list(equal)).where((F.col("_least") <= F.col("_limit")) & (F.col("_second").isNull() | (F.col("_second") > F.col("_limit")))).select(row_key, value)


#: Characters by which short texts and names meet before the one is looked for in the other.
GRAM = 3


def _containing(shorts: DataFrame, names: DataFrame, keys: Sequence[str], short: str, name: str) -> DataFrame:
    """``shorts`` with each ``name`` of ``names`` that contains them: they meet by the first ``GRAM`` characters of the short text, wherever in the name those are."""
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(name) - GRAM + 1, F.lit(1))), lambda i: F.substring(F.col(name), i, F.lit(GRAM))))
    long_enough = F.length(short) >= GRAM
    by_gram = shorts.where(long_enough).withColumn("_gram", F.substring(short, 1, GRAM)).join(names.withColumn("_gram", F.explode(grams)), [*keys, "_gram"]).drop("_gram")
    rest = shorts.where(~long_enough).join(names, list(keys))
    return by_gram.unionByName(rest).where(F.col(name).contains(F.col(short)))


def staged_match(rows: DataFrame, candidates: DataFrame, stages: Sequence[Sequence[str]], row_key: str, short: str, name: str) -> DataFrame:
    """``row_key, stage, match``: the first stage with a candidate whose ``name`` contains ``short`` decides.

    A stage's candidates agree with the row in the stage's columns. A name equal
    to ``short`` wins; else the only name counts, taken from where ``short``
    begins (a prefix that differs does not make it another name); several leave
    the match null. Stages are tried on the rows that the ones before left open,
    and on each distinct short text once.
    """
    out, open_rows = None, rows
    for number, keys in enumerate(stages, 1):
        pool = candidates.select(*keys, F.col(name).alias("_name")).distinct()
        pairs = _containing(open_rows.select(*keys, short).distinct(), pool, keys, short, "_name")
        tail = F.substring("_name", F.instr("_name", F.col(short)), F.length("_name"))
        hits = pairs.groupBy(*keys, short).agg(F.max(F.when(tail == F.col(short), tail)).alias("_exact"), F.count_distinct(tail).alias("_n"), F.min(tail).alias("_only"))
        found = hits.select(*keys, short, F.coalesce("_exact", F.when(F.col("_n") == 1, F.col("_only"))).alias("match"))
        own = open_rows.join(found, [*keys, short]).select(row_key, F.lit(number).alias("stage"), "match")
        own = cut(own) if number < len(stages) else own
        out = own if out is None else out.unionByName(own)
        open_rows = open_rows.join(own.select(row_key), row_key, "left_anti")
    return out


def rank_in(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))

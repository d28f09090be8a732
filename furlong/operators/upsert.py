"""Mutations of keyed tables as pure functions ``(existing, incoming) -> new``.

One outer join on the key rewrites a table; each column says what becomes of it
where both sides have the row. Keys are unique on both sides unless a docstring
says how repeats are settled.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A policy for a column: a name below, or a function (existing, incoming) -> Column.
Policy = str | Callable[[Column, Column], Column]


def blank(column: Column) -> Column:
    """Missing: null or the empty string."""
    return column.isNull() | (column.cast("string") == "")


POLICIES: dict[str, Callable[[Column, Column], Column]] = {
    "overwrite": lambda old, new: new,
    "keep": lambda old, new: old,
    "coalesce": lambda old, new: F.coalesce(new, old),
    "fill_null": lambda old, new: F.coalesce(old, new),
    "fill_blank": lambda old, new: F.when(blank(old), new).otherwise(old),
}


def monotone(lowest: str) -> Policy:
    """Never goes back to ``lowest``."""
    return lambda old, new: F.when(new == lowest, old).otherwise(new)


def _joined(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    old = existing.select(F.struct(*existing.columns).alias("old"))
    new = incoming.select(F.struct(*incoming.columns).alias("new"))
    on = [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys]
    condition = on[0]
    for c in on[1:]:
        condition = condition & c
    return old.join(new, condition, how)


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], policy: Mapping[str, Policy] | None = None, default: Policy = "overwrite", when: Callable[[Callable[[str], Column], Callable[[str], Column]], Column] | None = None, insert: bool = True) -> DataFrame:
    """Rows of both sides; where both have a key, each column by its policy.

    ``when(old, new)`` limits updates to the rows for which it is true (null is
    not true). With ``insert=False``, rows that only ``incoming`` has are left out.
    A column that ``incoming`` lacks is kept, and null in inserted rows.
    """
    policy = policy or {}
    rows = _joined(existing, incoming, keys, "full" if insert else "left")
    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    writes = has_new if when is None else has_new & F.coalesce(when(lambda c: F.col(f"old.{c}"), lambda c: F.col(f"new.{c}")), F.lit(False))
    out = []
    for name in existing.columns:
        old = F.col(f"old.{name}")
        if name not in incoming.columns:
            out.append(old.alias(name))
            continue
        new = F.col(f"new.{name}")
        if name in keys:
            out.append(F.when(has_old, old).otherwise(new).alias(name))
            continue
        chosen = policy.get(name, default)
        merged = (POLICIES[chosen] if isinstance(chosen, str) else chosen)(old, new)
        out.append(F.when(has_old & writes, merged).when(has_old, old).otherwise(new).cast(existing.schema[name].dataType).alias(name))
    return rows.select(*out)


def insert_if_absent(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``existing``, and the rows of ``incoming`` whose key it lacks."""
    return existing.unionByName(incoming.join(existing.select(*keys), list(keys), "left_anti"))


def replace_partition(existing: DataFrame, incoming: DataFrame, parts: Sequence[str], touched: DataFrame | None = None) -> DataFrame:
    """``existing`` without the partitions that are replaced, and ``incoming``.

    ``touched`` names the replaced partitions; it is needed where one is replaced by nothing.
    """
    names = incoming.select(*parts) if touched is None else touched.select(*parts)
    return existing.join(names.distinct(), list(parts), "left_anti").unionByName(incoming)


def conditional_upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], stamp: str) -> DataFrame:
    """Update only where the incoming ``stamp`` is not older, or the existing one is null."""
    return upsert(existing, incoming, keys, when=lambda old, new: (new(stamp) >= old(stamp)) | old(stamp).isNull())


def last_by(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key in ``order``."""
    window = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in order])
    return rows.withColumn("_nth", F.row_number().over(window)).where("_nth = 1").drop("_nth")


def fill_blanks(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], columns: Sequence[str], table: str, extra: Mapping[str, Column] | None = None, ordinal: str | None = None, stamp: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Fill blank cells from a second source; never overwrite. Returns (new table, audit).

    Rows that ``existing`` lacks are inserted, with the values of ``extra`` in the
    columns it names. The audit holds a row ``table_name, row_key, column_name,
    filled_at`` for each cell filled. Of incoming rows that repeat a key, the last
    by ``ordinal`` counts.
    """
    if ordinal:
        incoming = last_by(incoming, keys, [ordinal])
    rows = _joined(existing, incoming, keys, "full")
    has_old = F.col("old").isNotNull()
    texts = {f.name for f in existing.schema if f.dataType.simpleString() == "string"}
    empty = lambda c, name: blank(c) if name in texts else c.isNull()
    fills = {c: has_old & empty(F.col(f"old.{c}"), c) & ~empty(F.col(f"new.{c}"), c) & F.col("new").isNotNull() for c in columns if c in incoming.columns}
    out = []
    for name in existing.columns:
        old = F.col(f"old.{name}")
        new = F.col(f"new.{name}") if name in incoming.columns else F.lit(None)
        if extra and name in extra:
            new = extra[name]
        elif name not in keys and name not in columns:
            new = F.lit(None)
        kept = F.when(fills[name], F.col(f"new.{name}")).otherwise(old) if name in fills else old
        out.append(F.when(has_old, kept).otherwise(new).cast(existing.schema[name].dataType).alias(name))
    key = F.concat_ws("|", *[F.col(f"old.{k}").cast("string") for k in keys])
    cells = F.explode(F.array_compact(F.array(*[F.when(v, F.lit(c)) for c, v in fills.items()])))
    audit = rows.where(F.array_contains(F.array(*fills.values()), True)).select(F.lit(table).alias("table_name"), key.alias("row_key"), cells.alias("column_name"))
    return rows.select(*out), audit.withColumn("filled_at", stamp if stamp is not None else F.lit(None).cast("string"))


def update_only(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], columns: Sequence[str], when=None) -> DataFrame:
    """Overwrite ``columns`` of the rows that are there; insert nothing."""
    return upsert(existing, incoming.select(*keys, *columns), keys, when=when, insert=False)


def recompute(existing: DataFrame, column: str, value: Column) -> tuple[DataFrame, DataFrame]:
    """(table with the derived column, the rows in which it changed)."""
    both = existing.withColumn("_value", value.cast(existing.schema[column].dataType))
    changed = both.where(~F.col(column).eqNullSafe(F.col("_value"))).drop("_value")
    return both.drop(column).withColumnRenamed("_value", column).select(*existing.columns), changed


def keep_if_touched(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], touched: Column) -> DataFrame:
    """Upsert the incoming rows that are ``touched``; delete the rows of the others."""
    rows = incoming.withColumn("_touched", F.coalesce(touched, F.lit(False)))
    dropped = rows.where("not _touched").select(*keys)
    written = rows.where("_touched").drop("_touched")
    return upsert(existing.join(dropped, list(keys), "left_anti"), written, keys)


def delete_keys(existing: DataFrame, doomed: DataFrame, keys: Sequence[str]) -> DataFrame:
    return existing.join(doomed.select(*keys).distinct(), list(keys), "left_anti")


def rebuild_where(existing: DataFrame, condition: Column, fresh: DataFrame) -> DataFrame:
    """Replace the rows that meet ``condition`` by ``fresh``, such as those of one source."""
    return existing.where(~F.coalesce(condition, F.lit(False))).unionByName(fresh)

"""Entity resolution: numbers and spellings of one entity, joined under a constraint.

Numbers and names that appear together are edges. Two groups that both hold
domestic numbers, and not the same ones, are never joined: an edge that would do
so is refused and reported. Which edge comes first decides such a case, so the
edges have a total order: role, source, number, name.

Components without the constraint are found first, over all edges; no edge leaves
one, so the constrained grouping runs in each component by itself.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong.functions.ids import is_domestic
from furlong.operators.components import connected_components


def constrained_groups(edges: list[tuple[str, str]], domestic) -> tuple[list[tuple[set[str], set[str]]], list[tuple[str, str]]]:
    """(numbers, names) of each group with a number, and the refused edges; edges count in their order."""
    group_of: dict[tuple[int, str], int] = {}
    groups: dict[int, tuple[set[str], set[str]]] = {}
    refused = []
    for number, name in edges:
        ids = []
        for side, value in ((0, number), (1, name)):
            if (side, value) not in group_of:
                group_of[side, value] = len(group_of)
                groups[group_of[side, value]] = ({value}, set()) if side == 0 else (set(), {value})
            ids.append(group_of[side, value])
        a, b = ids
        if a == b:
            continue
        home = [{n for n in groups[i][0] if domestic(n)} for i in (a, b)]
        if home[0] and home[1] and home[0] != home[1]:
            refused.append((number, name))
            continue
        small, large = sorted((a, b), key=lambda i: len(groups[i][0]) + len(groups[i][1]))
        for side in (0, 1):
            for value in groups[small][side]:
                group_of[side, value] = large
            groups[large][side].update(groups[small][side])
        del groups[small]
    return [g for g in groups.values() if g[0]], refused


def resolve(edges: DataFrame) -> DataFrame:
    """``entity_key, kind, value``: the numbers (``number``), names (``name``) and refused edges (``refused``, ``number|name``) of each entity.

    ``edges`` holds ``role, source, number, name``. A key is the least domestic
    number of its group, or the least number.
    """
    # A repeated edge counts where it comes first: later it joins nothing more, and it is refused again.
    clean = edges.where("number is not null and name is not null and name <> ''").groupBy("number", "name").agg(F.min(F.struct("role", "source")).alias("first")).select("first.role", "first.source", "number", "name")
    node = lambda mark, c: F.xxhash64(F.concat(F.lit(mark), F.col(c)))
    keyed = clean.withColumn("src", node("#", "number")).withColumn("dst", node("@", "name"))
    labels = connected_components(keyed.select("src", "dst"))
    parts = keyed.join(labels, keyed["src"] == labels["node"]).select("component", "role", "source", "number", "name")

    def group(_: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["role", "source", "number", "name"])
        groups, refused = constrained_groups(list(zip(rows["number"], rows["name"], strict=True)), lambda n: n[2:3] == "2")
        out = []
        for numbers, names in groups:
            entity = min({n for n in numbers if n[2:3] == "2"} or numbers)
            out += [(entity, "number", n) for n in sorted(numbers)] + [(entity, "name", n) for n in sorted(names)]
        out += [(None, "refused", f"{a}|{b}") for a, b in refused]
        return pd.DataFrame(out, columns=["entity_key", "kind", "value"])

    return parts.groupBy("component").applyInPandas(group, "entity_key string, kind string, value string")


def usage(rows: DataFrame, columns: list[str], recent) -> DataFrame:
    """``name, recent, total``: how often the columns hold each name."""
    names = rows.select(F.explode(F.array(*columns)).alias("name"), recent.cast("long").alias("_recent")).where("name is not null and name <> ''")
    return names.groupBy("name").agg(F.coalesce(F.sum("_recent"), F.lit(0)).alias("recent"), F.count("*").alias("total"))


def canonical_names(resolved: DataFrame, used: DataFrame) -> DataFrame:
    """``entity_key, name``: the spelling used most of late, then most at all, then the least; the key where there is none."""
    names = resolved.where("kind = 'name'").join(used, F.col("value") == F.col("name"), "left").na.fill(0, ["recent", "total"])
    best = names.groupBy("entity_key").agg(F.min_by("value", F.struct(-F.col("recent"), -F.col("total"), F.col("value"))).alias("name"))
    keys = resolved.where("entity_key is not null").select("entity_key").distinct()
    return keys.join(best, "entity_key", "left").withColumn("name", F.coalesce("name", "entity_key"))


def name_owner(resolved: DataFrame) -> DataFrame:
    """``name, entity_key``: the entity of each name."""
    return resolved.where("kind = 'name'").groupBy(F.col("value").alias("name")).agg(F.min("entity_key").alias("entity_key"))


def with_keys(rows: DataFrame, owners: DataFrame, columns: dict[str, str], only_missing: bool = False) -> DataFrame:
    """``rows`` with the entity key of each name column (name column -> key column)."""
    for name, key in columns.items():
        own = owners.select(F.col("name").alias("_n"), F.col("entity_key").alias("_k"))
        out = rows.join(own, F.col(name) == F.col("_n"), "left")
        value = F.coalesce(F.col(key), F.col("_k")) if only_missing and key in rows.columns else F.col("_k")
        rows = out.select(*[c for c in rows.columns if c != key], value.alias(key))
    return rows


def domestic_share(rows: DataFrame, column: str) -> DataFrame:
    return rows.agg(F.count_if(is_domestic(F.col(column))).alias("domestic"), F.count("*").alias("total"))


"""Lineage trees: sub-tree index, number mapping, bounded reconstruction, hold-out.

A tree is rows ``id, path, ancestor``: a path over f and m, its length the
generation. Reconstruction fills cells level by level; a cell that is filled stays.
What is tried first is part of each candidate: the entity's own sub-tree, its own
seven cells, then pass by pass the sub-tree and the cells of each ancestor, shorter
paths first.

Joins are by merge, as hinted: the planner reads no size off rows made from a small file
or written before, takes them for small, and would send them all through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from furlong.functions.ids import birth_year, is_horse_id
from furlong.functions.scalars import crc_bucket, path_tail
from furlong.operators.latest import unanimous_by
from furlong.session import cut

GENERATIONS = 5
#: Years between a parent's birth and a child's, at least.
YEARS = 3


def subtree_index(trees: DataFrame) -> DataFrame:
    """``ancestor, path, descendant_of``: for each ancestor, what lies above it in any tree; of several, the one of the least tree id.

    ``trees``: id, path, ancestor. The tree of an id is its own index, too.
    """
    # Each cell meets those on its way by their paths; two cells of a tree that merely share the id are no pair.
    starts = F.transform(F.sequence(F.lit(1), F.length("path") - 1), lambda k: F.substring("path", F.lit(1), k))
    a, b = trees.alias("a"), trees.where(F.length("path") > 1).select("*", F.explode(starts).alias("start")).alias("b")
    pairs = a.join(b.hint("merge"), (F.col("a.id") == F.col("b.id")) & (F.col("a.path") == F.col("b.start")))
    above = pairs.select(F.col("a.ancestor").alias("root"), path_tail(F.col("b.path"), F.col("a.path")).alias("path"), F.col("b.ancestor").alias("ancestor"), F.lit(1).alias("rank"), F.col("a.id").alias("seen_in"), F.col("a.path").alias("at"))
    own = trees.select(F.col("id").alias("root"), "path", "ancestor", F.lit(0).alias("rank"), F.col("id").alias("seen_in"), F.lit("").alias("at"))
    first = F.min_by("ancestor", F.struct("rank", "seen_in", "at", "ancestor"))
    return own.unionByName(above).groupBy("root", "path").agg(first.alias("ancestor"))


def number_map(trees: DataFrame, cells: DataFrame) -> DataFrame:
    """``breed_no, ancestor``: numbers that stand for one and the same ancestor in all trees that show both.

    ``cells``: id, path, breed_no, name.
    """
    both = trees.join(cells.where("breed_no is not null").hint("merge"), ["id", "path"])
    return unanimous_by(both, ["breed_no"], "ancestor", "ancestor")


def _resolved(wanted: DataFrame, numbers: DataFrame, names: DataFrame) -> DataFrame:
    """Resolve ``id, path, breed_no, name, child_year`` to ``ancestor`` and ``how``: number, else the only fitting name, else the bare number."""
    wanted = wanted.withColumn("sex", F.when(F.col("path").endswith("m"), "牝").otherwise("牡"))
    by_number = numbers.select("breed_no", F.col("ancestor").alias("_number"))
    rows = wanted.join(by_number.hint("merge"), "breed_no", "left")
    hits = rows.select("name", "sex", "child_year").distinct().alias("w").join(
        names.alias("n").hint("merge"),
        (F.col("w.name") == F.col("n.name")) & (F.col("n.sex").isNull() | (F.col("n.sex") == F.col("w.sex"))) & (birth_year(F.col("n.id")) <= F.col("w.child_year") - YEARS),
    )
    only = hits.groupBy("w.name", "w.sex", "w.child_year").agg(F.count_distinct("n.id").alias("_hits"), F.min("n.id").alias("_named")).where("_hits = 1").drop("_hits")
    rows = rows.join(only.hint("merge"), ["name", "sex", "child_year"], "left")
    found = F.coalesce("_number", "_named", F.when(F.col("breed_no").isNotNull(), F.concat(F.lit("jv:"), F.col("breed_no"))))
    how = F.when(F.col("_number").isNotNull(), "number").when(F.col("_named").isNotNull(), "name").when(F.col("breed_no").isNotNull(), "jv")
    return rows.withColumn("ancestor", found).withColumn("how", how).drop("_number", "_named", "sex")


def build(targets: DataFrame, index: DataFrame, cells: DataFrame, numbers: DataFrame, names: DataFrame, seeds: DataFrame | None = None, generations: int = GENERATIONS) -> DataFrame:
    """``id, path, ancestor, how`` of every target, by at most ``generations`` rounds of grafting.

    ``index``: root, path, ancestor. ``cells``: id, path, breed_no, name. ``names``:
    name, id, sex (geldings as males). ``seeds`` have the form of ``cells``, for
    targets that have none.
    """
    own_cells = cells if seeds is None else cells.unionByName(seeds.join(cells.select("id").distinct().hint("merge"), "id", "left_anti"))
    ids = targets.select("id").distinct()
    # Every round reads them.
    index, numbers = cut(index), cut(numbers)

    def child_year(rows: DataFrame, filled: DataFrame | None) -> DataFrame:
        year = birth_year(F.col("id")) - YEARS * (F.length("path") - 1)
        if filled is None:
            return rows.withColumn("child_year", year)
        parents = filled.select(F.col("id").alias("_i"), F.col("path").alias("_p"), F.col("ancestor").alias("_a"))
        parent = rows.join(parents.hint("merge"), (F.col("id") == F.col("_i")) & (F.expr("left(path, length(path) - 1)") == F.col("_p")), "left")
        return parent.withColumn("child_year", F.when(F.length("path") == 1, birth_year(F.col("id"))).otherwise(F.coalesce(birth_year(F.col("_a")), year))).drop("_i", "_p", "_a")

    grafted = ids.join(index.withColumnRenamed("root", "id").hint("merge"), "id").where(F.length("path") <= generations).select("id", "path", "ancestor", F.lit("tree").alias("how"))
    wanted = ids.join(own_cells.hint("merge"), "id").join(grafted.select("id", "path").hint("merge"), ["id", "path"], "left_anti")
    first = _resolved(child_year(wanted, grafted), numbers, names).where("ancestor is not null").select("id", "path", "ancestor", "how")
    filled = cut(grafted.unionByName(first))
    frontier = filled
    for _ in range(generations):
        base = frontier.where(F.length("path") < generations).select("id", F.col("path").alias("base"), F.col("ancestor").alias("root"))
        trees = base.join(index.hint("merge"), "root").select("id", F.concat("base", "path").alias("path"), "ancestor", F.lit("tree").alias("how"), F.length("base").alias("near"), F.lit(0).alias("kind"), "base")
        own = base.where(is_horse_id(F.col("root"))).join(cells.withColumnRenamed("id", "root").hint("merge"), "root").select("id", F.concat("base", "path").alias("path"), "breed_no", "name", F.length("base").alias("near"), "base")
        own = own.where(F.length("path") <= generations).join(filled.select("id", "path").hint("merge"), ["id", "path"], "left_anti")
        own = _resolved(child_year(own, filled), numbers, names).where("ancestor is not null")
        rows = trees.where(F.length("path") <= generations).unionByName(own.select("id", "path", "ancestor", "how", "near", F.lit(1).alias("kind"), "base"))
        rows = rows.join(filled.select("id", "path").hint("merge"), ["id", "path"], "left_anti")
        nth = F.row_number().over(Window.partitionBy("id", "path").orderBy("near", "base", "kind", "ancestor"))
        frontier = cut(rows.withColumn("_nth", nth).where("_nth = 1").select("id", "path", "ancestor", "how"))
        if frontier.isEmpty():
            break
        # Both are written already: their union needs no cut of its own.
        filled = filled.unionByName(frontier)
    return filled


def holdout(trees: DataFrame, cells: DataFrame, names: DataFrame, fraction: float = 0.1) -> DataFrame:
    """One row ``held, compared, agreeing``: rebuild held-out trees from the others and compare the cells that are not bare numbers."""
    in_held = crc_bucket(F.col("id")) < F.lit(fraction * 1000)
    held, rest = trees.where(in_held), trees.where(~in_held)
    targets = held.select("id").distinct().join(cells.select("id").distinct().hint("merge"), "id", "left_semi")
    built = build(targets, subtree_index(rest), cells, number_map(rest, cells), names)
    both = built.where(~F.col("ancestor").startswith("jv:")).join(held.withColumnRenamed("ancestor", "truth").hint("merge"), ["id", "path"])
    compared = both.agg(F.count("*").alias("compared"), F.count_if(F.col("ancestor") == F.col("truth")).alias("agreeing"))
    return held.agg(F.count_distinct("id").alias("held")).join(F.broadcast(compared))


def by_birth_year(built: DataFrame, full: int = 62) -> DataFrame:
    """``year, n, mean_cells, full``: how far the lineages of each year's entities are filled."""
    sizes = built.groupBy("id").agg(F.count("*").alias("cells"))
    return sizes.groupBy(F.substring("id", 1, 4).alias("year")).agg(F.count("*").alias("n"), F.avg("cells").alias("mean_cells"), F.count_if(F.col("cells") == full).alias("full"))

"""Mixing sources to target weights with a low-discrepancy schedule.

Each source's documents are shuffled by a hash and cut into blocks of equally many
words. The schedule is a row of slots, one block each: slot i is the van der
Corput point of i (its bits reversed), mapped through the sources' cumulative
numbers of slots, so that any stretch of the schedule holds the sources in nearly
their target shares. The n-th slot of a source takes its n-th block, going round
the source again after the last; the last slot takes what is left of the target.
Only DataFrame functions run.

Ranks and running sums are taken in two steps, within cells and over the cells'
totals, so no source needs to fit into one task.

Defined cases: a null or empty text has no words and nothing of it is taken; a
null source is a source of its own, the last; sources without words get nothing;
repeated rows are documents of their own; equal hashes go by id, then by size,
rows equal in both being interchangeable. An empty table gives an empty result.
Only the named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from furlong.session import cut

#: Words of a block.
BLOCK = 1024
#: Weights of the sources in order, repeating; a target's limit in sizes of its source.
WEIGHTS = (5, 2, 1)
LIMIT = 3
SEED = "42"
#: Largest number of sources whose table (under 100 bytes each) is broadcast; with more, sources are joined by shuffle.
BROADCAST_SOURCES = 10_000
#: Rows of one cell, about.
CELL_ROWS = 2_000


@dataclass
class Mix:
    """``docs``: doc_id, source, size, n (the source's number), at (words before it in the shuffled source). ``sources``: source, n, source_size, target, quota, blocks, slots, before. ``slots``: slot, n, nth, pass, block, words."""

    docs: DataFrame
    sources: DataFrame
    slots: DataFrame


def n_words(column):
    return F.coalesce(F.regexp_count(column, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, block: int = BLOCK) -> DataFrame:
    """Targets of the sources from ``source, source_size``: shares by weight, cut at the limit, the excess shared again."""
    everything, in_order = Window.partitionBy(), Window.orderBy(F.asc_nulls_last("source"))
    numbered = sizes.withColumn("n", F.row_number().over(in_order)).withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("n") - 1) % len(WEIGHTS) + 1).cast("long"))
    # The sources that reach their limit are the first ones by limit per weight.
    by_limit = Window.orderBy(LIMIT * F.col("source_size") / F.col("weight"), "n")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_limit.rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - LIMIT * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(rest)
    filled = numbered.withColumn("level", level).withColumn("full", LIMIT * F.col("source_size") <= F.col("level") * F.col("weight"))
    water = F.min(F.when(~F.col("full"), F.struct(LIMIT * F.col("source_size") / F.col("weight"), "n", "level"))).over(everything)["level"]
    target = F.least((LIMIT * F.col("source_size")).cast("double"), F.coalesce(water, F.lit(0.0)) * F.col("weight"))
    target = F.when(water.isNull(), (LIMIT * F.col("source_size")).cast("double")).otherwise(target)
    quota = filled.withColumn("target", target).withColumn("quota", F.floor("target").cast("long"))
    blocks = quota.withColumn("blocks", F.ceil(F.col("source_size") / F.lit(block)).cast("long"))
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("quota") / F.col("source_size"))).otherwise(0).cast("long")
    left = F.col("quota") - rounds * F.col("source_size")
    slots = blocks.withColumn("slots", (rounds * F.col("blocks") + F.ceil(left / F.lit(block))).cast("long"))
    return slots.withColumn("before", F.coalesce(F.sum("slots").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("source", "n", "source_size", "target", "quota", "blocks", "slots", "before")


def _running(rows: DataFrame, cell: str, order: list, value, name: str) -> DataFrame:
    """The sum of ``value`` before each row of its ``n``, rows being ordered by ``cell`` and then ``order``."""
    own = Window.partitionBy("n", cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("n").orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("n", cell).agg(F.sum(value).alias("total"))
    totals = totals.select("n", cell, F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("cells_before"))
    # The totals grow with the data, whatever the planner makes of them: they are not to be broadcast.
    return rows.join(totals.hint("merge"), ["n", cell]).withColumn(name, F.col("cells_before") + F.coalesce(F.sum(value).over(own), F.lit(0))).drop("cells_before")


def plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK, seed: str = SEED) -> Mix:
    """The shuffled documents, the sources and the schedule of slots."""
    sized = cut(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size")))
    counted = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    counted = cut(counted)
    n_sources, n_docs = counted.agg(F.count("*"), F.coalesce(F.sum("n_docs"), F.lit(0))).first()
    sources = cut(targets(counted.select("source", "source_size"), block))
    n_slots = sources.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]

    digits = 1
    while digits < 6 and 16**digits * CELL_ROWS < n_docs:
        digits += 1
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    numbers = sources.select(F.col("source").alias("s"), "n")
    numbers = F.broadcast(numbers) if n_sources <= BROADCAST_SOURCES else numbers
    rows = sized.join(numbers, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("order", order).withColumn("cell", F.substring("order", 1, digits))
    placed = _running(rows, "cell", ["order", F.asc_nulls_first("doc_id"), "size"], F.col("size"), "at").select("doc_id", "source", "size", "n", "at")

    bits = max(1, (n_slots - 1).bit_length()) if n_slots else 1
    step, cells = 4096, max(0, bits - 11)
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / step).cast("long")))
    parts = sources.where("slots > 0").select("n", "before", "slots", "blocks", "source_size", "quota", part.alias("part"))
    parts = parts.repartition("n", "part")
    points = parts.withColumn("j", F.explode(F.sequence(F.col("before") + F.col("part") * step, F.col("before") + F.least(F.col("slots"), (F.col("part") + 1) * step) - 1)))
    slot = F.conv(F.reverse(F.lpad(F.bin("j"), bits, "0")), 2, 10).cast("long")
    slots = points.withColumn("slot", slot).withColumn("cell", F.shiftright("slot", cells))
    ranked = _running(slots, "cell", ["slot"], F.lit(1), "nth")
    ranked = ranked.withColumn("pass", F.floor(F.col("nth") / F.col("blocks")).cast("long")).withColumn("block", F.col("nth") % F.col("blocks"))
    left = F.col("quota") - F.col("pass") * F.col("source_size") - F.col("block") * block
    words = F.least(F.lit(block), F.col("source_size") - F.col("block") * block, left)
    return Mix(placed, sources, ranked.select("slot", "n", "nth", "pass", "block", words.cast("long").alias("words")))


def blocks_of(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """``n, block, doc_id, at, first, after``: which words of each block, counted in the block, are a document's."""
    pieces = docs.where("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("at") / block).cast("long"), F.floor((F.col("at") + F.col("size") - 1) / block).cast("long"))))
    return pieces.select("n", "block", "doc_id", "at", "size", F.greatest(F.lit(0), F.col("at") - F.col("block") * block).alias("first"), F.least(F.lit(block), F.col("at") + F.col("size") - F.col("block") * block).alias("after"))


def taken(mix: Mix, block: int = BLOCK) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` of every document: its words in all the blocks that the schedule takes."""
    whole = F.least(F.lit(block), F.col("source_size") - F.col("block") * block)
    sizes = mix.sources.select("n", "source", "source_size", "target")
    few = sizes.count() <= BROADCAST_SOURCES
    sizes = F.broadcast(sizes) if few else sizes
    slots = mix.slots.join(sizes.select("n", "source_size"), "n").withColumn("whole", F.col("words") == whole)
    takes = slots.groupBy("n", "block").agg(F.sum(F.col("whole").cast("long")).alias("times"), F.coalesce(F.max(F.when(~F.col("whole"), F.col("words"))), F.lit(0)).alias("cut"))
    pieces = blocks_of(mix.docs, block).join(takes.hint("merge"), ["n", "block"], "left")
    own = F.coalesce(F.col("times"), F.lit(0)) * (F.col("after") - F.col("first")) + F.greatest(F.lit(0), F.least(F.col("after"), F.coalesce(F.col("cut"), F.lit(0))) - F.col("first"))
    found = pieces.withColumn("own", own).groupBy("n", "at", "doc_id", "size").agg(F.sum("own").alias("taken"))
    none = mix.docs.where("size = 0").select("n", "at", "doc_id", "size", F.lit(0).cast("long").alias("taken"))
    return found.unionByName(none).join(sizes, "n").select("doc_id", "source", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken``."""
    return taken(plan(docs, doc_id, text, source, block), block)


def repeat_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` as the mix takes them; all columns stay as they are.

    A document comes as often as the mix begins to take it: not at all up to three
    times. One without words has nothing to be taken and comes once. Rows that
    share an id come, each, as the first of them does.
    """
    copies = F.when(F.col("size") == 0, 1).otherwise(F.ceil(F.col("taken") / F.col("size"))).cast("int")
    counts = mix(docs, doc_id, text, source).groupBy(F.col("doc_id").alias("mix_id")).agg(F.max(copies).alias("mix_copies")).where("mix_copies > 0")
    counts = counts.hint("shuffle_hash")
    rows = docs.join(counts, docs[doc_id].eqNullSafe(counts["mix_id"]))
    # The documents' own columns may have any name, so they go as one.
    return rows.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.explode(F.sequence(F.lit(1), counts["mix_copies"])).alias("nth")).select("row.*")


ORACLE = r"""
WITH sized AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
numbered AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS n FROM sized GROUP BY source),
weighted AS (SELECT *, [5, 2, 1][(n - 1) % 3 + 1] AS w FROM numbered),
leveled AS (
  SELECT *, CAST(sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (ORDER BY CAST(3 * source_size AS DOUBLE) / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
         / CAST(sum(w) OVER (ORDER BY CAST(3 * source_size AS DOUBLE) / w, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM weighted),
water AS (SELECT arg_min(level, CAST(3 * source_size AS DOUBLE) / w) AS water_level FROM leveled WHERE NOT 3 * source_size <= level * w),
targeted AS (SELECT source, n, source_size, CASE WHEN water_level IS NULL THEN CAST(3 * source_size AS DOUBLE) ELSE least(CAST(3 * source_size AS DOUBLE), water_level * w) END AS target FROM leveled, water),
placed AS (
  SELECT doc_id, t.source, size, source_size, target, CAST(floor(target) AS BIGINT) AS quota,
         CAST(coalesce(sum(size) OVER (PARTITION BY n ORDER BY md5('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS begins
  FROM sized s JOIN targeted t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size, source_size, target,
       CASE WHEN size = 0 THEN 0 ELSE CAST((quota // source_size) * size + greatest(0, least(begins + size, quota % source_size) - begins) AS BIGINT) END AS taken
FROM placed
"""

"""Performance metrics of entities over years.

All entities are computed at once: one aggregation for the years, one for the
entities, one window over the eligible entities for each metric.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Entities with fewer units are not compared; grades go from 1 to this.
LEAST_UNITS = 20
GRADES = 9


def ratio(a: Column, b: Column) -> Column:
    """Null where the denominator is null or 0."""
    return a.cast("double") / F.nullif(b, F.lit(0)).cast("double")


def field_denominators(lead: DataFrame, keys: list[str], amount: str = "per_unit", index: str = "idx", name: str = "d") -> DataFrame:
    """The median of amount / index over rows where both are positive."""
    rows = lead.where((F.col(index) > 0) & (F.col(amount) > 0))
    return rows.groupBy(*keys).agg(F.median(F.col(amount) / F.col(index)).alias(name))


def _sums(columns: list[str]) -> list[Column]:
    return [F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in columns]


def totals(lead: DataFrame, entity: str, sums: list[str]) -> DataFrame:
    """Sums over years, null counting as 0."""
    return lead.groupBy(entity).agg(*_sums(sums))


def _steady_sum(term: Column) -> Column:
    """The sum of doubles by size, so that equal terms give equal sums in whatever order their rows come; for few terms a group."""
    terms = F.sort_array(F.collect_list(term))
    return F.when(F.size(terms) > 0, F.aggregate(terms, F.lit(0.0), lambda total, x: total + x))


def _weighted(units: str, amount: str) -> Column:
    """The index of an entity's rows, one a year, joined to the denominators ``d`` of their years; entities with equal rows tie."""
    weight = F.sum(F.when(F.col("d") != 0, F.col(units)))
    average = _steady_sum(F.coalesce("d", F.lit(0.0)) * F.col(units)) / F.nullif(weight, F.lit(0))
    own = F.sum(amount).cast("double") / F.nullif(F.sum(units), F.lit(0))
    return own / F.nullif(average, F.lit(0.0))


def weighted_index(lead: DataFrame, denominators: DataFrame, entity: str, year: str, units: str = "n", amount: str = "amount", name: str = "aei") -> DataFrame:
    """Amount per unit over all years, by the denominators' average weighted by units; years without a denominator have no weight."""
    return lead.join(denominators, year, "left").groupBy(entity).agg(_weighted(units, amount).alias(name))


#: Buckets that the values of a group are ranked in.
BUCKETS = 200


def midranks(counts: DataFrame, keys: list[str], value: str, count: str, name: str = "percentile") -> DataFrame:
    """``keys, value`` and the mid-rank percentile of each distinct value: (share less + share up to it) / 2; 0.5 for a group without rows.

    ``counts`` holds how often each value comes; 0 is a value that is only asked
    about. Approximate quantiles deal the values to buckets, in which they are
    ranked; what lies in the buckets below comes from the buckets' totals. So a
    group with very many values is many tasks, and the ranks are exact.
    """
    points = counts.groupBy(*keys, value).agg(F.sum(count).alias("_c"))
    steps = F.array(*[F.lit(i / BUCKETS) for i in range(1, BUCKETS)])
    bounds = points.groupBy(*keys).agg(F.percentile_approx(value, steps, 10 * BUCKETS).alias("_bounds"), F.sum("_c").alias("_all"))
    rows = points.join(bounds, keys) if keys else points.join(F.broadcast(bounds))
    rows = rows.withColumn("_bucket", F.size(F.filter("_bounds", lambda x: x < F.col(value)))).drop("_bounds")
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*keys, "_bucket").agg(F.sum("_c").alias("_t")).withColumn("_before", F.coalesce(F.sum("_t").over(before), F.lit(0))).drop("_t")
    own = Window.partitionBy(*keys, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = rows.join(totals, [*keys, "_bucket"]).withColumn("_upto", F.col("_before") + F.sum("_c").over(own))
    n = F.col("_all").cast("double")
    share = F.when(F.col("_all") > 0, ((F.col("_upto") - F.col("_c")) / n + F.col("_upto") / n) / 2).otherwise(0.5)
    return ranked.select(*keys, value, share.alias(name))


def percentile_against(targets: DataFrame, value: str, population: DataFrame, of: str, name: str = "percentile") -> DataFrame:
    """Mid-rank percentile of values that need not be in the population; 0.5 if that is empty."""
    counts = population.where(F.col(of).isNotNull()).select(F.col(of).alias("_v"), F.lit(1).alias("_n"))
    asked = targets.where(F.col(value).isNotNull()).select(F.col(value).alias("_v"), F.lit(0).alias("_n"))
    ranked = midranks(counts.unionByName(asked), [], "_v", "_n", name)
    return targets.join(ranked, F.col(value) == F.col("_v"), "left").drop("_v")


def grade(percentile: Column) -> Column:
    return F.least(F.lit(GRADES), F.floor(percentile * GRADES).cast("int") + 1)


METRICS = ("win_rate", "starts_per_unit", "amount_per_unit", "aei", "units")


def entity_totals(lead: DataFrame, denominators: DataFrame, entity: str, year: str) -> DataFrame:
    """``n, n_win, n_starts, amount`` and the metrics of each entity, from one aggregation; rows without an entity are no entity's."""
    rows = lead.where(F.col(entity).isNotNull()).join(denominators, year, "left")
    out = rows.groupBy(entity).agg(*_sums(["n", "n_win", "n_starts", "amount"]), _weighted("n", "amount").alias("aei"))
    return out.withColumns({
        "win_rate": ratio(F.col("n_win"), F.col("n_starts")),
        "starts_per_unit": ratio(F.col("n_starts"), F.col("n")),
        "amount_per_unit": ratio(F.col("amount"), F.col("n")),
        "units": F.col("n").cast("double"),
    })


def field_values(lead: DataFrame, denominators: DataFrame, entity_rows: DataFrame, year: str, least: int = LEAST_UNITS) -> DataFrame:
    """``metric, field``: what each metric is compared with.

    1 for the index; for the amount per unit the denominators weighted by every
    entity's units; the mean for units; ratios of totals of the eligible for the rest.
    """
    eligible = entity_rows.where(F.col("n") >= least)
    sums = eligible.agg(ratio(F.sum("n_win"), F.sum("n_starts")).alias("win_rate"), ratio(F.sum("n_starts"), F.sum("n")).alias("starts_per_unit"), F.avg("n").alias("units"))
    by_year = lead.groupBy(year).agg(F.sum("n").alias("n")).join(denominators, year)
    weighted = by_year.agg((F.sum(F.when(F.col("d") != 0, F.col("d") * F.col("n"))) / F.nullif(F.sum(F.when(F.col("d") != 0, F.col("n"))), F.lit(0))).alias("amount_per_unit"))
    both = sums.join(F.broadcast(weighted)).withColumn("aei", F.lit(1.0))
    return both.select(F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("field")) for m in METRICS])).alias("x")).select("x.*")


def metrics_long(entity_rows: DataFrame, fields: DataFrame, entity: str, least: int = LEAST_UNITS) -> DataFrame:
    """``entity, metric, value, field, ratio_to_field, percentile, grade`` of the eligible entities."""
    rows = entity_rows.where(F.col("n") >= least).select(entity, F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS])).alias("x")).select(entity, "x.*").where("value is not null")
    ranked = midranks(rows.select("metric", "value", F.lit(1).alias("_n")), ["metric"], "value", "_n")
    out = rows.join(ranked, ["metric", "value"]).join(F.broadcast(fields), "metric", "left")
    return out.withColumn("ratio_to_field", ratio(F.col("value"), F.col("field"))).withColumn("grade", grade(F.col("percentile")))

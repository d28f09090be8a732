"""Race cards before the race, odds, boards, slips and stalls: plans over the mutation operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from furlong.functions.names import person_key
from furlong.functions.scalars import normalize_slips
from furlong.operators.match import fallback_match, unique_match
from furlong.operators.upsert import delete_keys, keep_if_touched, monotone, replace_partition, upsert

#: Fixed value: the state of a race of which only the list is known.
LIST_ONLY = "list_only"
BETS = ("tansho", "fukusho", "wakuren", "umaren", "wide", "umatan", "sanrenpuku", "sanrentan")


def save_upcoming_races(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Nulls keep what is known; the state never goes back to the list."""
    return upsert(existing, incoming, ["race_id"], {"entry_status": monotone(LIST_ONLY), "updated_at": "overwrite"}, "coalesce")


def save_upcoming_entries(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Replace each race's entries, carrying over weights by horse id, else name, and marks by horse and jockey."""
    races = incoming.select("race_id").distinct()
    known = existing.join(races, "race_id", "left_semi")
    weights = known.where("horse_weight is not null")
    by_id = weights.where("horse_id is not null").groupBy("race_id", "horse_id").agg(F.max_by(F.struct("horse_weight", "weight_diff"), "seq").alias("_by_id"))
    by_name = weights.where("horse_name is not null").groupBy("race_id", "horse_name").agg(F.min_by(F.struct("horse_weight", "weight_diff"), "seq").alias("_by_name"))
    marks = known.where("kinryo_mark is not null").groupBy("race_id", "horse_id", "jockey_id").agg(F.max("kinryo_mark").alias("_mark"))
    rows = incoming.join(by_id, ["race_id", "horse_id"], "left").join(by_name, ["race_id", "horse_name"], "left").join(marks, ["race_id", "horse_id", "jockey_id"], "left")
    old = F.coalesce("_by_id", "_by_name")
    missing = F.col("horse_weight").isNull()
    values = {"horse_weight": F.coalesce("horse_weight", old["horse_weight"]), "weight_diff": F.when(missing, old["weight_diff"]).otherwise(F.col("weight_diff")), "kinryo_mark": F.coalesce("kinryo_mark", "_mark")}
    fresh = rows.select(*[values.get(c, F.col(c)).alias(c) for c in existing.columns])
    return replace_partition(existing, fresh, ["race_id"], races)


def add_weights(entries: DataFrame, profiles: DataFrame) -> DataFrame:
    """Weights of official profiles, by number, else by name; a missing weight changes nothing."""
    found = profiles.where("horse_weight is not null")
    out = None
    for column in ("horse_weight", "weight_diff"):
        lookup = found.select(F.concat_ws("|", "race_id", F.col("umaban").cast("string")).alias("k"), F.concat_ws("|", "race_id", "horse_name").alias("n"), F.struct(F.lit(True).alias("has"), F.col(column).alias("v")).alias("x"), F.coalesce("umaban", F.lit(0)).alias("ordinal"))
        rows = (entries if out is None else out).withColumn("k", F.concat_ws("|", "race_id", F.col("umaban").cast("string"))).withColumn("n", F.concat_ws("|", "race_id", "horse_name"))
        matched = fallback_match(rows, lookup, "k", "n", "x")
        out = matched.withColumn(column, F.when(F.col("x.has"), F.col("x.v")).otherwise(F.col(column))).select(*entries.columns)
    return out


def save_odds(existing: DataFrame, incoming: DataFrame, taken: DataFrame) -> DataFrame:
    """The latest odds of each race and bet type in ``taken``; a type without odds has none left."""
    return replace_partition(existing, incoming, ["race_id", "bet_type"], taken)


def save_board(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Rows moved by hand, excluded or commented stay; the others go. Places count only if set by hand."""
    manual = F.coalesce(F.col("manual"), F.lit(0)) == 1
    rows = incoming.withColumns({c: F.when(manual, F.col(c)) for c in ("pos_x", "pos_y") if c in incoming.columns})
    comment = F.coalesce(F.trim(F.col("comment")), F.lit(""))
    touched = manual | (F.coalesce(F.col("excluded"), F.lit(0)) == 1) | (comment != "")
    return keep_if_touched(existing, rows, ["race_id", "horse_id"], touched)


def save_marks(existing: DataFrame, incoming: DataFrame, known: tuple[str, ...]) -> DataFrame:
    """Upsert marks that are known; any other mark deletes the row."""
    good = F.coalesce(F.col("mark").isin(*known), F.lit(False))
    return upsert(delete_keys(existing, incoming.where(~good), ["race_id", "horse_id"]), incoming.where(good), ["race_id", "horse_id"])


def slip_rows(slips: DataFrame) -> DataFrame:
    """``race_id, group_id, seq, bet_type, kind, amount, combo`` of ``race_id, groups``, valid groups numbered anew from 1."""
    groups = slips.select("race_id", F.posexplode(normalize_slips(F.col("groups"), BETS)).alias("g", "x"))
    return groups.select("race_id", (F.col("g") + 1).alias("group_id"), "x.bet_type", "x.kind", "x.amount", F.posexplode("x.combos").alias("seq", "combo"))


def slip_groups(rows: DataFrame) -> DataFrame:
    """The groups of each race with their combinations in order."""
    combos = F.transform(F.array_sort(F.collect_list(F.struct("seq", "combo"))), lambda x: x["combo"])
    return rows.groupBy("race_id", "group_id", "bet_type", "kind", "amount").agg(combos.alias("combos"))


def import_stalls(existing: DataFrame, stalls: DataFrame, trainers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(stalls of each trainer and date, names without a trainer): summed, then matched within the stable by full name, else by its first four characters."""
    summed = stalls.groupBy("effective_date", "stable", person_key(F.col("trainer_name")).alias("full")).agg(F.sum("stalls").cast("int").alias("stalls")).withColumn("short", F.substring("full", 1, 4))
    full = person_key(F.coalesce("full_name", "trainer_name"))
    pool = trainers.select("trainer_id", "stable", full.alias("full"), F.substring(person_key(F.col("trainer_name")), 1, 4).alias("short"))
    matched = unique_match(summed, pool, ["stable", "full"], "trainer_id", fallback=["stable", "short"])
    fresh = matched.where("trainer_id is not null").select("trainer_id", "effective_date", "stable", "stalls")
    return replace_partition(existing, fresh, ["effective_date", "stable"], stalls.select("effective_date", "stable")), matched.where("trainer_id is null").select("effective_date", "stable", F.col("full").alias("trainer_name"))


def track_day(cushion: DataFrame, moisture: DataFrame) -> DataFrame:
    """The last measurement of each venue and day of either page, merged."""
    last = lambda df: df.withColumn("_n", F.row_number().over(Window.partitionBy("venue_name", "date").orderBy(F.desc("measured_at")))).where("_n = 1").drop("_n")
    a, b = last(cushion).alias("a"), last(moisture).alias("b")
    both = a.join(b, (F.col("a.venue_name") == F.col("b.venue_name")) & (F.col("a.date") == F.col("b.date")), "full")
    first = lambda c: F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c)
    values = [first(c) for c in ("cushion_value", "turf_moisture_goal", "turf_moisture_4corner", "dirt_moisture_goal", "dirt_moisture_4corner")]
    return both.select(first("venue_name"), first("date"), F.greatest("a.measured_at", "b.measured_at").alias("measured_at"), *values)


def save_track(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Nulls keep what is known, but the time of the update is always new."""
    return upsert(existing, incoming, ["venue_code", "date"], {"updated_at": "overwrite"}, "coalesce")


def touched_rows(rows: DataFrame, condition: Column) -> int:
    """How many rows a clear would remove."""
    return rows.where(condition).count()

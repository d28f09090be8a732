"""The second source: staging, fill-blanks merge into the core tables, derived columns.

A plan takes a dict of core tables and returns a new one; nothing is written here,
so a dry run is a plan whose result is not kept. Running it again changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furlong.functions import names, scalars, vocab
from furlong.operators import resolve
from furlong.operators.latest import latest_by, mode_by, value_at_max
from furlong.operators.upsert import conditional_upsert, fill_blanks, replace_partition, upsert

ROLES = (("sire_breed_no", "sire_name", "sire"), ("bms_breed_no", "bms_name", "broodmare_sire"), ("sire_bms_breed_no", "sire_bms_name", None), ("dam_dam_sire_breed_no", "dam_dam_sire_name", None))


def stage(staged: dict[str, DataFrame], races: DataFrame, runs: DataFrame, horses: DataFrame | None = None, siblings: DataFrame | None = None) -> dict[str, DataFrame]:
    """Upsert loaded rows into the staging tables; a horse only if it is not older, its siblings only with it."""
    out = dict(staged)
    out["target_races"] = upsert(staged["target_races"], races, ["race_id"]) if "target_races" in staged else races
    out["target_runs"] = upsert(staged["target_runs"], runs, ["race_id", "umaban"]) if "target_runs" in staged else runs
    if horses is not None:
        if "target_horses" not in staged:
            out["target_horses"], out["target_horse_siblings"] = horses, siblings
        else:
            old = staged["target_horses"].select("horse_id", F.col("data_created_date").alias("_old"))
            written = horses.join(old, "horse_id", "left").where("_old is null or data_created_date >= _old").select("horse_id")
            out["target_horses"] = conditional_upsert(staged["target_horses"], horses, ["horse_id"], "data_created_date")
            fresh = siblings.join(written, "horse_id", "left_semi")
            out["target_horse_siblings"] = replace_partition(staged["target_horse_siblings"], fresh, ["horse_id"], written)
    return out


def core_races(races: DataFrame) -> DataFrame:
    jv = F.col("track_code_jv")
    return races.select(
        "race_id", "race_date", "venue_code", "meeting", "day", "race_no", F.col("race_name_short").alias("race_name"), vocab.lookup(F.col("class_name"), vocab.GRADE).alias("grade"), "surface",
        vocab.lookup(jv, vocab.DIRECTION).alias("direction"), "distance_m", vocab.lookup(jv, vocab.COURSE_DETAIL).alias("course_detail"), "weather",
        F.when(F.col("surface").isin("turf", "jump"), F.col("going")).alias("going_turf"), F.when(F.col("surface") == "dirt", F.col("going")).alias("going_dirt"), "post_time",
        vocab.lookup(F.col("race_type_code"), vocab.AGE_CONDITION).alias("age_condition"), vocab.class_condition(F.col("class_name"), F.col("race_symbol_code")).alias("class_condition"),
        vocab.race_conditions(F.col("race_symbol_code"), F.col("weight_type_code")).alias("race_conditions"), "n_runners",
    )


def core_entries(runs: DataFrame) -> DataFrame:
    return runs.select("race_id", "umaban", "waku", "horse_id", "sex", "age", "kinryo", "jockey_id", "trainer_id", "horse_weight", "weight_diff")


def core_results(runs: DataFrame) -> DataFrame:
    return runs.select(
        "race_id", "umaban", "horse_id", "finish_position", vocab.lookup(F.col("abnormal_code").cast("string"), vocab.FINISH_STATUS).alias("finish_status"), "time_sec", scalars.seconds_text(F.col("time_sec")).alias("time_raw"),
        vocab.margin(F.col("margin")).alias("margin"), scalars.join_present(*[F.col(f"corner{i}") for i in range(1, 5)]).alias("corner_passing"), "last_3f", "win_odds", "popularity",
        scalars.prize_sum(F.col("prize_man_yen"), F.col("added_prize_man_yen")).alias("prize_man_yen"),
    )


def name_aliases(target_horses: DataFrame, horses: DataFrame) -> DataFrame:
    """``breed_no, alias``: the core's commonest spelling of each number."""
    both = target_horses.join(horses.where("source = 'scrape'").select("horse_id", "sire", "dam", "broodmare_sire"), "horse_id")
    pairs = F.array(*[F.struct(F.col(no).alias("breed_no"), F.col(name).alias("name")) for no, name in (("sire_breed_no", "sire"), ("dam_breed_no", "dam"), ("bms_breed_no", "broodmare_sire"))])
    rows = both.select(F.explode(pairs).alias("x")).select("x.*").where("breed_no is not null and name <> ''")
    return mode_by(rows, ["breed_no"], "name", "alias").drop("n")


def merged_horses(target_horses: DataFrame, runs: DataFrame, races: DataFrame, horses: DataFrame) -> DataFrame:
    """Horses to merge: the staged ones with the core's spellings, and those known from their last run only."""
    rows = target_horses
    for no, name in (("sire_breed_no", "sire_name"), ("dam_breed_no", "dam_name"), ("bms_breed_no", "bms_name")):
        aliases = name_aliases(target_horses, horses).select(F.col("breed_no").alias("_no"), "alias")
        rows = rows.join(aliases, F.col(no) == F.col("_no"), "left").withColumn(name, F.coalesce("alias", name)).drop("alias", "_no")
    full = rows.select("horse_id", "horse_name", "sex", F.col("sire_name").alias("sire"), F.col("dam_name").alias("dam"), F.col("bms_name").alias("broodmare_sire"), "owner_name", F.col("breeder_name").alias("breeder"), "birth_date", "trainer_name")
    seen = runs.join(races.select("race_id", "race_date"), "race_id").join(target_horses.select("horse_id"), "horse_id", "left_anti")
    last = latest_by(seen, ["horse_id"], [F.desc("race_date"), F.desc("race_id"), F.asc("umaban")])
    return full.unionByName(last.select("horse_id", "horse_name", "sex", "trainer_name"), allowMissingColumns=True)


def merge(core: dict[str, DataFrame], staged: dict[str, DataFrame], stamp: Column | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """(core tables with blanks filled and missing rows put in, audit of the cells filled)."""
    out, audits = dict(core), []
    races, runs = staged["target_races"], staged["target_runs"]
    by_date = runs.join(races.select("race_id", "race_date"), "race_id")
    newest = [F.desc("race_date"), F.desc("race_id"), F.asc("umaban")]

    def fill(table: str, rows: DataFrame, keys: list[str], extra: dict[str, Column] | None = None) -> None:
        columns = [c for c in rows.columns if c not in keys]
        out[table], audit = fill_blanks(core[table], rows, keys, columns, table, extra, stamp=stamp)
        audits.append(audit)

    for table, key, columns in (("jockeys", "jockey_id", ["jockey_name"]), ("trainers", "trainer_id", ["trainer_name", "stable"])):
        fill(table, latest_by(by_date.where(F.col(key).isNotNull()), [key], newest).select(key, *columns), [key])
    if "target_horses" in staged:
        horses = staged["target_horses"]
        owners = value_at_max(horses.where("owner_code is not null"), ["owner_code"], "owner_name", "data_created_date", "owner_name")
        fill("owners", owners.withColumnRenamed("owner_code", "owner_id"), ["owner_id"])
        fill("horses", merged_horses(horses, runs, races, core["horses"]), ["horse_id"], {"source": F.lit("target")})
    fill("races", core_races(races), ["race_id"], {"source": F.lit("target")})
    fill("entries", core_entries(runs), ["race_id", "umaban"])
    fill("results", core_results(runs), ["race_id", "umaban"])
    audit = audits[0]
    for other in audits[1:]:
        audit = audit.unionByName(other)
    return out, audit


def kinryo_marks(entries: DataFrame, runs: DataFrame, upcoming: DataFrame | None = None) -> DataFrame:
    """``entries`` with the apprentice mark: that of the second source if it has the run, even none; else the upcoming one of the same jockey."""
    own = runs.select("race_id", "umaban", F.nullif("kinryo_mark", F.lit("")).alias("_mark"), F.lit(True).alias("_has"))
    rows = entries.join(own, ["race_id", "umaban"], "left")
    second = F.lit(None).cast("string")
    if upcoming is not None:
        shown = upcoming.where("umaban is not null").select(F.col("race_id").alias("_r"), F.col("umaban").alias("_u"), F.col("jockey_id").alias("_j"), F.col("kinryo_mark").alias("_second"))
        rows = rows.join(shown, (F.col("race_id") == F.col("_r")) & (F.col("umaban") == F.col("_u")) & (F.col("jockey_id") == F.col("_j")), "left")
        second = F.col("_second")
    value = F.when(F.col("_has"), F.col("_mark")).otherwise(second)
    return rows.select(*[c for c in entries.columns if c != "kinryo_mark"], value.alias("kinryo_mark"))


def entity_edges(target_horses: DataFrame, horses: DataFrame) -> DataFrame:
    """Numbers and names that appear together, by role; the core's spelling of the same horse's parent, too."""
    out = None
    core = horses.select("horse_id", "sire", "broodmare_sire")
    for role, (no, name, own) in enumerate(ROLES):
        rows = target_horses.select(F.lit(role).alias("role"), F.lit(0).alias("source"), F.col(no).alias("number"), F.col(name).alias("name"))
        if own:
            both = target_horses.join(core, "horse_id").select(F.lit(role).alias("role"), F.lit(1).alias("source"), F.col(no).alias("number"), F.col(own).alias("name"))
            rows = rows.unionByName(both)
        out = rows if out is None else out.unionByName(rows)
    return out.where("number is not null and name is not null and name <> ''").distinct()


def rebuild_entity_keys(horses: DataFrame, target_horses: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(horses with their keys, entities with their names, names with their entities)."""
    resolved = resolve.resolve(entity_edges(target_horses, horses))
    used = resolve.usage(horses, ["sire", "broodmare_sire"], F.col("source") == "scrape")
    owners = resolve.name_owner(resolved)
    keyed = resolve.with_keys(horses, owners, {"sire": "sire_key", "broodmare_sire": "broodmare_sire_key"})
    return keyed, resolve.canonical_names(resolved, used), owners


def derive(core: dict[str, DataFrame], staged: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Columns that are made anew: plain names, the owner at export, the dam's number, apprentice marks, entity keys."""
    out = dict(core)
    races, target_races = core["races"], staged["target_races"]
    modern = races.where("source = 'scrape'").withColumn("race_name_plain", names.plain_name(F.col("race_name")))
    pool = modern.select("venue_code", "surface", "grade", F.col("race_name_plain").alias("name"))
    short = races.where("source = 'target'").join(target_races.select("race_id", "race_name_short", "weight_type_code"), "race_id", "left")
    short = short.select(F.col("race_id").alias("row"), F.coalesce("race_name_short", "race_name").alias("short"), (F.col("weight_type_code") == "1").alias("handicap"), "age_condition", "class_condition", "venue_code", "surface", "grade")
    plain = names.canonical_names(short, pool).select(F.col("row").alias("race_id"), F.col("name").alias("_plain"))
    plain = plain.unionByName(modern.select("race_id", F.col("race_name_plain").alias("_plain")))
    out["races"] = races.drop("race_name_plain").join(plain.withColumnRenamed("_plain", "race_name_plain"), "race_id", "left")
    out["entries"] = kinryo_marks(core["entries"], staged["target_runs"], core.get("upcoming_entries"))
    if "target_horses" in staged:
        owner = staged["target_horses"].select("horse_id", F.col("owner_code").alias("owner_id_at_export"))
        out["entries"] = out["entries"].drop("owner_id_at_export").join(owner, "horse_id", "left")
        dams = staged["target_horses"].select("horse_id", F.nullif("dam_breed_no", F.lit("")).alias("dam_key"))
        horses = core["horses"].drop("dam_key").join(dams, "horse_id", "left")
        out["horses"], out["stallions"], out["stallion_names"] = rebuild_entity_keys(horses, staged["target_horses"])
    return out


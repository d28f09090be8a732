"""The core tables as a dict of frames: made from schemas, widened to newer ones, and written to page by page.

A plan takes the dict and returns a new one. Nothing is written until ``commit``
puts a whole version of every changed table beside the one before it.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furlong.functions.ids import VENUES
from furlong.functions.names import plain_name
from furlong.operators.coverage import new_files
from furlong.operators.upsert import insert_if_absent, last_by, replace_partition, update_only, upsert
from furlong.plans.second_source import kinryo_marks

#: Names of the venues, in the order of their codes.
VENUE_NAMES = ("札幌", "函館", "福島", "新潟", "東京", "中山", "中京", "京都", "阪神", "小倉")
AUDIT = {
    "runs": "run_id long, command string, args string, started_at string, finished_at string, status string, n_requests long, n_races_saved long, n_warnings long, message string",
    "fetch_log": "run_id long, fetched_at string, url string, status_code int, ok int, message string",
    "parse_warnings": "run_id long, created_at string, url string, key string, message string",
    "target_import_files": "file_name string, sha256 string, n_rows long, run_id long, imported_at string",
}


def create(spark: SparkSession, schemas: Mapping[str, str]) -> dict[str, DataFrame]:
    """Empty tables of the schemas (DDL by name), and the audit tables; ``venues`` holds the ten venues."""
    out = {n: spark.createDataFrame([], s) for n, s in {**AUDIT, **schemas}.items()}
    known = spark.createDataFrame(list(zip(VENUES, VENUE_NAMES, strict=True)), "venue_code string, venue_name string")
    out["venues"] = upsert(out["venues"], known, ["venue_code"]) if "venues" in out else known
    return out


def migrate(tables: Mapping[str, DataFrame], schemas: Mapping[str, str]) -> dict[str, DataFrame]:
    """Add what the schemas have and the tables lack: whole tables, and columns, which are null. Nothing is dropped or retyped."""
    out = dict(tables)
    for name, ddl in schemas.items():
        wanted = T._parse_datatype_string(ddl)
        if name not in out:
            spark = next(iter(tables.values())).sparkSession
            out[name] = spark.createDataFrame([], wanted)
            continue
        have = set(out[name].columns)
        out[name] = out[name].select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in wanted if f.name not in have])
    return out


def commit(tables: Mapping[str, DataFrame], folder: str, version: int) -> None:
    """Write the tables as a version of their own; the versions before stay as they are until they are removed."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{version:06d}/{name}")


def _people(entries: DataFrame, key: str, columns: Sequence[str], stamp: Column) -> DataFrame:
    """The last mention of each id in page order."""
    rows = last_by(entries.where(F.col(key).isNotNull() & (F.col(key) != "")), [key], ["race_id", "seq"])
    return rows.select(key, *[F.col(a).alias(b) for a, b in (c if isinstance(c, tuple) else (c, c) for c in columns)], stamp.alias("updated_at"))


def save_result_pages(core: Mapping[str, DataFrame], pages: Mapping[str, DataFrame], stamp: Column) -> dict[str, DataFrame]:
    """Save result pages (tables ``races, entries, results, payouts, laps`` of the reader) over the nine core tables.

    Races, horses, jockeys, trainers and owners are upserted, a race keeping the
    time it was first fetched; entries, results, payouts and laps of the pages'
    races are replaced, by nothing where a page has none. Apprentice marks, which
    the pages lack, are filled from the other sources in ``core``. A race without
    a date is an error.
    """
    out = dict(core)
    races = pages["races"].withColumn("race_date", F.when(F.col("race_date").isNotNull(), F.col("race_date")).otherwise(F.raise_error(F.concat(F.lit("no date for "), "race_id"))))
    fresh = races.withColumns({"race_name_plain": plain_name(F.col("race_name")), "fetched_at": stamp, "updated_at": stamp})
    out["races"] = upsert(core["races"], fresh.select(*[c for c in core["races"].columns if c in fresh.columns]), ["race_id"], {"fetched_at": "keep"})
    entries = pages["entries"]
    people = (
        ("horses", "horse_id", ("horse_name", "sex")),
        ("jockeys", "jockey_id", ("jockey_name",)),
        ("trainers", "trainer_id", ("trainer_name", ("trainer_stable", "stable"))),
        ("owners", "owner_id", ("owner_name",)),
    )
    for table, key, columns in people:
        out[table] = upsert(core[table], _people(entries, key, columns, stamp), [key])
    touched = races.select("race_id")
    for name, rows in (("entries", entries), ("results", pages["results"]), ("payouts", pages["payouts"]), ("race_laps", pages["laps"])):
        own = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(core[name].schema[c].dataType).alias(c) for c in core[name].columns])
        out[name] = replace_partition(core[name], own, ["race_id"], touched)
    if "target_runs" in core:
        out["entries"] = kinryo_marks(out["entries"], core["target_runs"], core.get("upcoming_entries")).select(*core["entries"].columns)
    return out


# audit


def start_run(runs: DataFrame, command: str, args: str, stamp: str) -> tuple[DataFrame, int]:
    """(the runs with a new one that is running, its number)."""
    number = (runs.agg(F.max("run_id")).first()[0] or 0) + 1
    row = runs.sparkSession.createDataFrame([(number, command, args, stamp, "running")], "run_id long, command string, args string, started_at string, status string")
    return runs.unionByName(row, allowMissingColumns=True), number


def finish_run(runs: DataFrame, run_id: int, status: str, stamp: str, n_requests: int = 0, n_races_saved: int = 0, n_warnings: int = 0, message: str | None = None) -> DataFrame:
    done = runs.sparkSession.createDataFrame([(run_id, stamp, status, n_requests, n_races_saved, n_warnings, message)], "run_id long, finished_at string, status string, n_requests long, n_races_saved long, n_warnings long, message string")
    return update_only(runs, done, ["run_id"], ["finished_at", "status", "n_requests", "n_races_saved", "n_warnings", "message"])


def log(table: DataFrame, rows: DataFrame, run_id: int | None, stamp: Column) -> DataFrame:
    """A log with ``rows`` at its end; the column that ends in ``_at`` holds the stamp."""
    at = next(c for c in table.columns if c.endswith("_at"))
    return table.unionByName(rows.withColumns({"run_id": F.lit(run_id).cast("long"), at: stamp}), allowMissingColumns=True)


# files


def files_to_load(files: DataFrame, manifest: DataFrame, only: str | None = None, force: bool = False) -> DataFrame:
    """``files`` (file_name, sha256, ...) that have not been loaded as they are; ``only`` is a name or the end of a path, ``force`` takes loaded ones, too."""
    if only:
        files = files.where(F.col("file_name").endswith(only))
    if not force:
        seen = manifest.select(F.struct("file_name", "sha256").alias("seen"))
        files = new_files(files.withColumn("seen", F.struct("file_name", "sha256")), seen, "seen").drop("seen")
    return files.orderBy("file_name")


def files_loaded(manifest: DataFrame, files: DataFrame, run_id: int, stamp: Column) -> DataFrame:
    """The manifest after ``files`` (file_name, sha256, n_rows) have been loaded; a dry run leaves this out."""
    rows = files.select("file_name", "sha256", F.col("n_rows").cast("long").alias("n_rows"), F.lit(run_id).cast("long").alias("run_id"), stamp.alias("imported_at"))
    return upsert(manifest, rows, ["file_name"])


# single rows of people


def save_trainer_profiles(trainers: DataFrame, profiles: DataFrame, stamp: Column) -> DataFrame:
    """Profiles overwrite, but a missing stable keeps the known one, and the short name is not touched."""
    rows = profiles.withColumns({"meikan_updated_at": stamp, "updated_at": stamp})
    return upsert(trainers, rows.select(*[c for c in rows.columns if c in trainers.columns and c != "trainer_name"]), ["trainer_id"], {"stable": "coalesce"})


def fill_close_family(horses: DataFrame, cells: DataFrame) -> DataFrame:
    """Blank parents and dam's sires from the cells f, m and mf of lineages (``horse_id, path, name``); what is there stays."""
    at = lambda path: F.max(F.when(F.col("path") == path, F.nullif("name", F.lit(""))))
    family = cells.where(F.col("path").isin("f", "m", "mf")).groupBy("horse_id").agg(at("f").alias("sire"), at("m").alias("dam"), at("mf").alias("broodmare_sire"))
    fill = lambda old, new: F.when(F.coalesce(old, F.lit("")) == "", F.coalesce(new, old)).otherwise(old)
    return upsert(horses, family, ["horse_id"], default=fill, insert=False)


def rebuild_local(lineages: DataFrame, built: DataFrame) -> DataFrame:
    """The lineages with those of source ``local`` made anew from ``built``; trees of another source are never replaced."""
    others = lineages.where("source <> 'local'")
    return insert_if_absent(others, built.join(others.select("horse_id").distinct(), "horse_id", "left_anti").withColumn("source", F.lit("local")).select(*lineages.columns), ["horse_id", "path"])


def local_targets(horses: DataFrame, entries: DataFrame, lineages: DataFrame) -> DataFrame:
    """``id`` of the horses that have run, have no fetched tree, and whose id begins with a year."""
    ran = horses.join(entries.select("horse_id").distinct(), "horse_id", "left_semi").where(F.col("horse_id").rlike("^[0-9]{10}$"))
    return ran.join(lineages.where("source <> 'local'").select("horse_id").distinct(), "horse_id", "left_anti").select(F.col("horse_id").alias("id"))


def local_seeds(horses: DataFrame, staged: DataFrame) -> DataFrame:
    """Cells f and mf, in the form that ``lineage.build`` takes for seeds, of horses that the second source lacks: their entity keys."""
    rest = horses.join(staged.select("horse_id").distinct(), "horse_id", "left_anti")
    pairs = F.array(F.struct(F.lit("f").alias("path"), F.col("sire_key").alias("breed_no"), F.col("sire").alias("name")), F.struct(F.lit("mf").alias("path"), F.col("broodmare_sire_key").alias("breed_no"), F.col("broodmare_sire").alias("name")))
    return rest.select(F.col("horse_id").alias("id"), F.explode(pairs).alias("x")).select("id", "x.*").where("breed_no is not null")


def numbered(rows: DataFrame, keys: Iterable[str], order: Sequence[str], name: str = "seq") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))

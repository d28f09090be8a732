"""Commands over a workspace: ``python -m furlong ROOT command ...``.

Fetching is not done here. Commands that read pages take them from a page store
(``--pages``), in which the key of a page says what is known about it: a race id; a
race id and a bet type (``202606040411-wide``); a day, venue, meeting and day of the
meeting (``2026-09-20-06-4-6``); the day of a track page; the id of a horse or trainer.
Each command is a run: it begins and ends in the table ``runs``, whose status is that
of its tables too, for all that it changes is one version.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furlong.functions.scalars import progress_bar
from furlong.operators import lineage
from furlong.operators.coverage import table_counts
from furlong.operators.upsert import replace_partition, upsert
from furlong.plans import cards, reports, second_source, store
from furlong.plans.viewer import HIDDEN, viewer_copy
from furlong.plans.workspace import Workspace
from furlong.session import build_session, cut
from furlong.sources import page_store, pages, positional
from furlong.streaming.incremental import update_range

OK, FAILED, INTERRUPTED = 0, 1, 130
Tables = dict[str, DataFrame]


# What the key of a page says, for the readers that need it, as expressions of the key.
RACE = {"race_id": "key"}
BET = {"race_id": "split_part(key, '-', 1)", "bet_type": "split_part(key, '-', 2)"}
MEETING = {"date": "left(key, 10)", "venue_code": "split_part(key, '-', 4)", "meeting": "int(split_part(key, '-', 5))", "day": "int(split_part(key, '-', 6))"}


def _read(spark: SparkSession, args: argparse.Namespace, kind: str, reader: str, known: dict[str, str] | None = None, only: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    stored = page_store.read_pages(spark, args.pages, kind)
    stored = (only(stored) if only else stored).withColumns({n: F.expr(e) for n, e in (known or {}).items()})
    return cut(pages.read(stored, reader, "key", "page", list(known or {})))


def _notes(tables: Tables, found: DataFrame, args: argparse.Namespace) -> DataFrame:
    """The log of warnings with those of the pages just read."""
    new = found.where("tbl in ('warnings', 'errors')").select("key", F.get_json_object("record", "$.message").alias("message"))
    return store.log(tables["parse_warnings"], new, args.run_id, F.lit(args.now))


def results(spark: SparkSession, tables: Tables, args: argparse.Namespace, only=None) -> Tables:
    found = _read(spark, args, "race_result", "race_result", RACE, only)
    read = {name: pages.table(found, name).drop("key") for name in ("races", "entries", "results", "payouts", "laps")}
    # A race of which no day could be read is refused; its page is in the warnings.
    dated = read["races"].where("race_date is not null")
    read = {name: rows.join(dated.select("race_id"), "race_id", "left_semi") for name, rows in read.items()}
    read |= {"races": dated.withColumn("source", F.lit("scrape")), "entries": read["entries"].withColumn("seq", F.col("umaban"))}
    out = store.save_result_pages(tables, read, F.lit(args.now))
    out["horses"] = out["horses"].withColumn("source", F.coalesce("source", F.lit("scrape")))
    return {n: df for n, df in out.items() if df is not tables.get(n)} | {"parse_warnings": _notes(tables, found, args)}


def reparse(spark: SparkSession, tables: Tables, args: argparse.Namespace) -> Tables:
    """Build the tables again from all stored pages."""
    return results(spark, tables, args)


def backfill(spark: SparkSession, tables: Tables, args: argparse.Namespace) -> Tables:
    """Stored pages of races whose day (``kaisai_days`` is of days, a page says its own) lies in a range."""
    day = F.regexp_extract("page", r"([0-9]{4})年([0-9]{1,2})月([0-9]{1,2})日", 0)
    shown = F.concat_ws("-", F.left(day, F.lit(4)), F.lpad(F.regexp_extract(day, "年([0-9]+)月", 1), 2, "0"), F.lpad(F.regexp_extract(day, "月([0-9]+)日", 1), 2, "0"))
    return results(spark, tables, args, lambda stored: stored.where(shown.between(args.first, args.last)))


def update(spark: SparkSession, tables: Tables, args: argparse.Namespace) -> Tables:
    """From a week before the latest race, at most 60 days ago, up to the day before yesterday."""
    days = update_range(tables["races"], "race_date", args.today).first()
    args.first, args.last = str(days["first_day"]), str(days["last_day"])
    return backfill(spark, tables, args)


def entries(spark: SparkSession, tables: Tables, args: argparse.Namespace) -> Tables:
    """Cards of races to come; weights and marks known before are carried over."""
    found = _read(spark, args, "shutuba", "entry_card", RACE)
    shown = pages.table(found, "entries").drop("key").withColumn("kinryo_mark", F.lit(None).cast("string"))
    state = shown.groupBy("race_id").agg(F.when(F.count("umaban") > 0, "entries").otherwise("registered").alias("entry_status"))
    races = pages.table(found, "races").drop("key").join(state, "race_id", "left").withColumn("updated_at", F.lit(args.now))
    return {"upcoming_races": cards.save_upcoming_races(tables["upcoming_races"], races), "upcoming_entries": cards.save_upcoming_entries(tables["upcoming_entries"], shown), "parse_warnings": _notes(tables, found, args)}


def jra(spark: SparkSession, tables: Tables, args: argparse.Namespace) -> Tables:
    """Results of meetings: what a page lacks keeps what is known, entries and results are not touched, laps go only where there are new ones."""
    found = _read(spark, args, "jra_result", "meeting_results", MEETING)
    races = pages.table(found, "official_races").drop("key").withColumns({"race_name_plain": store.plain_name(F.col("race_name")), "fetched_at": F.lit(args.now), "updated_at": F.lit(args.now)})
    laps = pages.table(found, "laps").drop("key")
    return {"races": upsert(tables["races"], races, ["race_id"], {"fetched_at": "keep"}, "coalesce"), "race_laps": replace_partition(tables["race_laps"], laps, ["race_id"]), "parse_warnings": _notes(tables, found, args)}


def odds(spark: SparkSession, tables: Tables, args: argparse.Namespace) -> Tables:
    """The latest odds of the stored races and bet types."""
    found = _read(spark, args, "odds", "odds", BET)
    named = [F.expr(e).alias(n) for n, e in BET.items()]
    taken = page_store.keys(spark, args.pages, "odds").select(*named).join(found.where("tbl = 'errors'").select(*named), list(BET), "left_anti")
    return {"odds": cards.save_odds(tables["odds"], pages.table(found, "odds").drop("key"), taken), "parse_warnings": _notes(tables, found, args)}


def baba(spark: SparkSession, tables: Tables, args: argparse.Namespace) -> Tables:
    """The last measurement of each venue and day of both track pages."""
    known = {"today": "left(key, 10)"}
    cushion, moisture = (_read(spark, args, kind, reader, known) for kind, reader in (("jra_cushion", "cushion"), ("jra_moisture", "moisture")))
    rows = cards.track_day(pages.table(cushion, "track"), pages.table(moisture, "track")).join(tables["venues"], "venue_name").drop("venue_name")
    notes = _notes(tables, cushion.unionByName(moisture), args)
    return {"track_conditions": cards.save_track(tables["track_conditions"], rows.withColumn("updated_at", F.lit(args.now))), "parse_warnings": notes}


def pedigree(spark: SparkSession, tables: Tables, args: argparse.Namespace) -> Tables:
    """Profiles of horses; what a page lacks keeps what is known."""
    found = _read(spark, args, "jra_horse", "horse_profile", {"horse_id": "key"})
    rows = pages.table(found, "horses").drop("key").withColumn("updated_at", F.lit(args.now))
    own = rows.select(*[c for c in rows.columns if c in tables["horses"].columns])
    return {"horses": upsert(tables["horses"], own, ["horse_id"], default="coalesce"), "parse_warnings": _notes(tables, found, args)}


def bloodline(spark: SparkSession, tables: Tables, args: argparse.Namespace) -> Tables:
    """Fetched trees of five generations; a horse's tree is replaced as a whole."""
    found = _read(spark, args, "horse_ped", "pedigree", {"horse_id": "key"})
    rows = pages.table(found, "ancestors").withColumn("source", F.lit("netkeiba")).select(*tables["horse_ancestors"].columns)
    return {"horse_ancestors": replace_partition(tables["horse_ancestors"], rows, ["horse_id"]), "parse_warnings": _notes(tables, found, args)}


def sire_fetch(spark: SparkSession, tables: Tables, args: argparse.Namespace) -> Tables:
    """Leading tables, by year, kind and name."""
    found = _read(spark, args, "sire_leading", "sire_leading")
    rows = pages.table(found, "leading").drop("key").dropDuplicates(["year", "kind", "sire_name"])
    return {"sire_leading": upsert(tables["sire_leading"], rows, ["year", "kind", "sire_name"]), "parse_warnings": _notes(tables, found, args)}


def trainer_meikan(spark: SparkSession, tables: Tables, args: argparse.Namespace) -> Tables:
    """Profiles of trainers."""
    found = _read(spark, args, "trainer", "trainer_profile", {"trainer_id": "key"})
    return {"trainers": store.save_trainer_profiles(tables["trainers"], pages.table(found, "trainers").drop("key"), F.lit(args.now)), "parse_warnings": _notes(tables, found, args)}


def trainer_stalls_import(spark: SparkSession, tables: Tables, args: argparse.Namespace) -> Tables:
    """Stalls of trainers from a CSV file; names without a trainer go to the warnings."""
    saved, unmatched = cards.import_stalls(tables["trainer_stalls"], positional.read_stalls(spark, args.csv), tables["trainers"])
    notes = unmatched.select(F.col("trainer_name").alias("key"), F.concat_ws(" ", F.lit("no trainer"), "effective_date", "stable").alias("message"))
    return {"trainer_stalls": saved, "parse_warnings": store.log(tables["parse_warnings"], notes, args.run_id, F.lit(args.now))}


def target_import(spark: SparkSession, tables: Tables, args: argparse.Namespace) -> Tables:
    """Load the files of the second source that are new, merge them into the core tables, derive what depends on them."""
    out = dict(tables)
    notes = []
    if not args.merge_only:
        loaded = {}
        for kind, width, pattern, load in (("race", positional.RUN_WIDTH, args.race_files, positional.load_runs), ("horse", positional.HORSE_WIDTH, args.horse_files, positional.load_horses)):
            if args.kind not in ("all", kind):
                continue
            lines = cut(positional.read_lines(spark, f"{args.dir}/{pattern}", width))
            files = lines.groupBy(F.col("file").alias("file_name"), "sha256").agg(F.count("cells").alias("n_rows"))
            todo = store.files_to_load(files, out["target_import_files"], args.file, args.force)
            loaded[kind] = load(lines.join(todo.select(F.col("file_name").alias("file")), "file", "left_semi"))
            notes.append(loaded[kind][2])
            out["target_import_files"] = store.files_loaded(out["target_import_files"], todo, args.run_id, F.lit(args.now))
        staged = {n: out[n] for n in STAGED if n in out}
        if "race" in loaded:
            out |= second_source.stage(staged, *loaded["race"][:2], *loaded.get("horse", ())[:2])
        elif "horse" in loaded and "target_races" in staged:
            out |= second_source.stage(staged, staged["target_races"].limit(0), staged["target_runs"].limit(0), *loaded["horse"][:2])
    staged = {n: cut(out[n]) for n in STAGED if n in out}
    out |= staged
    if not args.no_merge and "target_races" in staged:
        merged, audit = second_source.merge(out, staged, F.lit(args.now))
        out |= second_source.derive({n: cut(df) if n in MERGED else df for n, df in merged.items()}, staged)
        out["target_fills"] = tables["target_fills"].unionByName(audit)
    for note in notes:
        rows = note.select(F.concat_ws(":", "file", F.col("line_no").cast("string")).alias("key"), F.col("reason").alias("message"))
        out["parse_warnings"] = store.log(out["parse_warnings"], rows, args.run_id, F.lit(args.now))
    return {n: df for n, df in out.items() if df is not tables.get(n)}


STAGED = ("target_races", "target_runs", "target_horses", "target_horse_siblings")
MERGED = ("jockeys", "trainers", "owners", "horses", "races", "entries", "results")


#: The seven cells of a lineage that a staged horse shows, and its columns for them.
CELLS = {"f": "sire", "m": "dam", "fmf": "sire_bms", "mf": "bms", "mm": "dam_dam", "mmf": "dam_dam_sire", "mmm": "dam_dam_dam"}


def _lineage_inputs(tables: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(fetched trees, cells of the second source, names) in the form that lineages take."""
    trees = tables["horse_ancestors"].where("source <> 'local'").select(F.col("horse_id").alias("id"), "path", F.col("ancestor_no").alias("ancestor"))
    staged = tables["target_horses"]
    pairs = F.array(*[F.struct(F.lit(p).alias("path"), F.col(f"{c}_breed_no").alias("breed_no"), F.col(f"{c}_name").alias("name")) for p, c in CELLS.items()])
    cells = staged.select(F.col("horse_id").alias("id"), F.explode(pairs).alias("x")).select("id", "x.*").where("breed_no is not null or name is not null")
    horses = tables["horses"].where("horse_name <> ''")
    known = horses.select(F.col("horse_name").alias("name"), F.col("horse_id").alias("id"), F.when(F.col("sex") == "セ", "牡").otherwise(F.col("sex")).alias("sex"))
    return trees, cells, known


def bloodline_local(spark: SparkSession, tables: Tables, args: argparse.Namespace) -> Tables:
    """Lineages from what is at hand, for the horses without a fetched tree; ``--check`` rebuilds a tenth of the fetched ones and compares."""
    if "target_horses" not in tables:
        raise ValueError("the second source has not been imported")
    trees, cells, known = _lineage_inputs(tables)
    if args.check:
        lineage.holdout(trees, cells, known).show()
        return {}
    targets = store.local_targets(tables["horses"], tables["entries"], tables["horse_ancestors"])
    built = lineage.build(targets, lineage.subtree_index(trees), cells, lineage.number_map(trees, cells), known, store.local_seeds(tables["horses"], tables["target_horses"]))
    rows = built.select(F.col("id").alias("horse_id"), "path", F.length("path").alias("generation"), F.col("ancestor").alias("ancestor_no"), F.lit(None).cast("string").alias("name"))
    return {"horse_ancestors": store.rebuild_local(tables["horse_ancestors"], rows)}


def publish(spark: SparkSession, workspace: Workspace, args: argparse.Namespace) -> list[str]:
    """A copy for viewers; uploading it is left to others."""
    return viewer_copy(spark, workspace.root, args.to, {n: p for n, p in workspace.places().items() if n not in HIDDEN})


def status(tables: Tables, today: str, since: str = "2023-01-01", runs: int = 5) -> DataFrame:
    """``section, name, value``: span of races, size of tables, races to come, open days, how far lineages are filled, the latest runs."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit("-")).alias("value")
    facts = lambda df, section: df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), text(F.col(c))) for c in df.columns])).alias("x")).select(F.lit(section).alias("section"), "x.name", "x.value")
    span = tables["races"].agg(F.min("race_date").alias("first_day"), F.max("race_date").alias("last_day"), F.count_distinct("race_date").alias("days"))
    counts = table_counts(tables)
    sizes = counts.select(F.lit("tables").alias("section"), F.col(counts.columns[0]).alias("name"), text(F.col(counts.columns[1])))
    coming = tables["upcoming_races"].agg(F.count_if(F.col("entry_status") == "entries").alias("confirmed"), F.count_if(F.col("entry_status") == "registered").alias("registered"), F.max("race_date").alias("until"))
    open_days = tables["kaisai_days"].agg(F.count_if(~F.col("completed") & (F.col("kaisai_date") <= today)).alias("incomplete_days"))
    ran = tables["entries"].join(tables["races"].select("race_id", "race_date"), "race_id")
    filled = {"parents": F.col("sire").isNotNull() & F.col("dam").isNotNull() & F.col("broodmare_sire").isNotNull()}
    recent = reports.recent_counts(tables["horses"], "horse_id", ran, "race_date", since, tables["upcoming_entries"], filled, {"trees": tables["horse_ancestors"]})
    bars = recent.select("total", *[F.concat_ws(" ", progress_bar(F.col(c), F.col("total")), F.col(c).cast("string")).alias(c) for c in ("parents", "trees")])
    latest = tables["runs"].orderBy(F.desc("run_id")).limit(runs).select(F.lit("runs").alias("section"), F.concat(F.lit("#"), F.col("run_id").cast("string")).alias("name"), F.concat_ws(" ", "started_at", "command", "status", "message").alias("value"))
    out = facts(span, "races")
    for part in (sizes, facts(coming, "upcoming"), facts(open_days, "days"), facts(bars, "recent"), latest):
        out = out.unionByName(part)
    return out


TASKS: dict[str, Callable[[SparkSession, Tables, argparse.Namespace], Tables]] = {
    "update": update, "backfill": backfill, "reparse": reparse, "entries": entries, "jra": jra, "odds": odds, "baba": baba, "pedigree": pedigree, "bloodline": bloodline, "bloodline-local": bloodline_local,
    "sire-fetch": sire_fetch, "trainer-meikan": trainer_meikan, "trainer-stalls-import": trainer_stalls_import, "target-import": target_import,
}
#: The usual round; a failure of the track pages does not end it.
ROUND = ("update", "entries", "baba", "bloodline", "publish")


def run_task(workspace: Workspace, args: argparse.Namespace) -> int:
    """Run one command as a run of its own; its tables and its run are one version. A dry run writes nothing."""
    spark, tables = workspace.spark, workspace.load()
    runs, args.run_id = store.start_run(tables["runs"], args.command, args.raw, args.now)
    state, message, changed, code = "success", None, {}, OK
    try:
        changed = TASKS[args.command](spark, tables, args)
        # Written before the run is called a success: an error in a plan shows only here.
        changed = {n: cut(df) for n, df in changed.items()}
    except KeyboardInterrupt:
        state, message, changed, code = "interrupted", "broken off", {}, INTERRUPTED
    except Exception as error:  # noqa: BLE001 - the run's row tells what went wrong
        state, message, changed, code = "failed", f"{type(error).__name__}: {str(error)[:500]}", {}, FAILED
    if getattr(args, "dry_run", False):
        return code
    warned = changed["parse_warnings"].where(F.col("run_id") == args.run_id).count() if "parse_warnings" in changed else 0
    saved = changed["races"].where(F.col("updated_at") == args.now).count() if "races" in changed else 0
    workspace.save({**changed, "runs": store.finish_run(runs, args.run_id, state, args.now, 0, saved, warned, message)})
    return code


def refresh(workspace: Workspace, args: argparse.Namespace) -> int:
    for command in ROUND:
        args.command = command
        if command == "publish":
            publish(workspace.spark, workspace, args)
        elif (code := run_task(workspace, args)) != OK and (command != "baba" or code == INTERRUPTED):
            return code
    return OK


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="furlong")
    top.add_argument("root", help="URI of the folder of tables")
    top.add_argument("--today", default=f"{datetime.now(timezone.utc):%Y-%m-%d}")
    commands = top.add_subparsers(dest="command", required=True)
    for name in (*TASKS, "refresh", "publish", "status"):
        own = commands.add_parser(name)
        if name in ("update", "backfill", "reparse", "entries", "jra", "odds", "baba", "pedigree", "bloodline", "sire-fetch", "trainer-meikan", "refresh"):
            own.add_argument("--pages", required=True, help="URI of the page store")
        if name == "backfill":
            own.add_argument("--from", dest="first", required=True)
            own.add_argument("--to", dest="last", default="9999-12-31")
        if name in ("publish", "refresh"):
            own.add_argument("--to", required=True, help="URI of the copy")
        if name == "trainer-stalls-import":
            own.add_argument("csv")
        if name in ("bloodline-local", "target-import"):
            own.add_argument("--dry-run", action="store_true")
        if name == "bloodline-local":
            own.add_argument("--check", action="store_true")
        if name == "target-import":
            own.add_argument("--dir", default=".")
            own.add_argument("--race-files", default="*race*.csv")
            own.add_argument("--horse-files", default="*horse*.csv")
            own.add_argument("--kind", choices=("all", "race", "horse"), default="all")
            own.add_argument("--file")
            own.add_argument("--force", action="store_true")
            which = own.add_mutually_exclusive_group()
            which.add_argument("--no-merge", action="store_true")
            which.add_argument("--merge-only", action="store_true")
    return top


def main(argv: list[str], spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    args.raw, args.now = " ".join(argv[1:]), f"{datetime.now(timezone.utc):%Y-%m-%d %H:%M:%S}"
    workspace = Workspace(spark or build_session(), args.root)
    if args.command == "status":
        status(workspace.load(), args.today).show(1000, truncate=False)
        return OK
    if args.command == "publish":
        print("\n".join(publish(workspace.spark, workspace, args)))
        return OK
    return refresh(workspace, args) if args.command == "refresh" else run_task(workspace, args)

"""Commands over a workspace, from stored pages and files to tables."""

import pytest
from furlong import commands
from furlong.plans.workspace import Workspace
from furlong.sources import page_store
from test_readers import RAN, _unit
from test_sources import ODDS, RESULT, SOFT, horse_line, lineage_page, run_line, write_csv


@pytest.fixture(scope="module")
def place(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("commands")
    stored = {
        "race_result": [("202606040411", RESULT), ("202606040401", '<table class="race_table_01"></table>'), ("202606040402", RESULT.replace("2026年9月20日", "何日"))],
        "jra_result": [("2026-09-20-06-4-6", _unit(11, RAN))],
        "odds": [("202606040411-umaren", ODDS), ("202606040411-wide", ODDS)],
        "jra_cushion": [("2026-09-21", SOFT)],
        "jra_moisture": [("2026-09-21", "<p>none</p>")],
        "horse_ped": [("2021100001", lineage_page())],
    }
    for kind, rows in stored.items():
        page_store.put_pages(spark.createDataFrame(rows, "key string, page string"), f"file://{root}/pages", kind).collect()
    return root


def test_pages_to_tables(spark, place):
    root, store = f"file://{place}/tables", f"file://{place}/pages"

    def run(*words):
        return commands.main([root, "--today", "2026-09-25", *words], spark)

    assert Workspace(spark, root).versions() == [] and Workspace(spark, root).load()["venues"].count() == 10
    assert run("reparse", "--pages", store) == commands.OK
    tables = Workspace(spark, root).load()
    assert [(r["race_id"], r["source"], r["race_name_plain"]) for r in tables["races"].collect()] == [("202606040411", "scrape", "テストS")]
    assert (tables["entries"].count(), tables["payouts"].count(), tables["race_laps"].count()) == (3, 3, 11)
    assert {r["key"] for r in tables["parse_warnings"].collect()} >= {"202606040401", "202606040402"}
    # What a meeting's page lacks stays; its laps replace the others; runners are not touched.
    assert run("jra", "--pages", store) == commands.OK
    assert run("odds", "--pages", store) == commands.OK
    assert run("bloodline", "--pages", store) == commands.OK
    assert run("baba", "--pages", store) == commands.OK
    tables = Workspace(spark, root).load()
    races = {r["race_id"]: r for r in tables["races"].collect()}
    assert set(races) == {"202606040411", "202606040611"} and races["202606040611"]["winner_name"] == "勝 馬" and races["202606040411"]["going_turf"] == "稍重"
    assert tables["entries"].count() == 3 and tables["race_laps"].where("race_id = '202606040611'").count() == 2
    assert (tables["odds"].count(), tables["horse_ancestors"].count()) == (3, 62)
    assert [(r["venue_code"], r["cushion_value"]) for r in tables["track_conditions"].collect()] == [("06", 9.5)]
    # A day outside the range is not read again: nothing changes but the runs.
    before = Workspace(spark, root).places()
    assert run("backfill", "--pages", store, "--from", "2026-09-21") == commands.OK
    assert Workspace(spark, root).load()["races"].count() == 2 and before["runs"] != Workspace(spark, root).places()["runs"]
    # A command that fails leaves the tables, and its run says so.
    assert run("pedigree", "--pages", store) == commands.FAILED
    assert run("bloodline-local") == commands.FAILED
    states = [(r["command"], r["status"]) for r in Workspace(spark, root).load()["runs"].orderBy("run_id").collect()]
    assert states == [(c, "success") for c in ("reparse", "jra", "odds", "bloodline", "baba", "backfill")] + [("pedigree", "failed"), ("bloodline-local", "failed")]
    shown = {(r["section"], r["name"]): r["value"] for r in commands.status(Workspace(spark, root).load(), "2026-09-25").collect()}
    assert (shown["races", "days"], shown["tables", "odds"], shown["races", "last_day"]) == ("1", "3", "2026-09-20") and "failed" in shown["runs", "#8"]
    assert shown["recent", "trees"].endswith(" 1")
    assert run("publish", "--to", f"file://{place}/copy") == commands.OK
    copied = {p.name for p in (place / "copy").iterdir()}
    assert {"races", "odds"} <= copied and "runs" not in copied and spark.read.parquet(f"file://{place}/copy/races").count() == 2


def test_a_broken_commit_is_not_read(spark, place):
    own = Workspace(spark, f"file://{place}/broken")
    own.save({"jockeys": spark.createDataFrame([("1", "a", "t")], "jockey_id string, jockey_name string, updated_at string")})
    (place / "broken" / "000001" / "_DONE").unlink()
    assert own.versions() == [] and own.load()["jockeys"].count() == 0


def test_second_source(spark, place):
    root = f"file://{place}/second"
    write_csv(place / "race_2026.csv", [run_line("2026-09-20", "060404", 11, n, f"202110000{n}") for n in (1, 2)], 110)
    write_csv(place / "horse_2026.csv", [horse_line(f"202110000{n}") for n in (1, 2)], 104)

    def run(*words):
        return commands.main([root, *words], spark)

    load = ("target-import", "--dir", f"file://{place}")
    assert run(*load, "--dry-run") == commands.OK and Workspace(spark, root).versions() == []
    assert run(*load) == commands.OK
    tables = Workspace(spark, root).load()
    first = {n: tables[n].count() for n in ("races", "entries", "horses", "target_runs", "target_horses", "target_import_files")}
    assert first == {"races": 1, "entries": 2, "horses": 2, "target_runs": 2, "target_horses": 2, "target_import_files": 2}
    assert {r["source"] for r in tables["horses"].collect()} == {"target"}
    # Files that have been loaded are left out, and merging again changes nothing.
    assert run(*load) == commands.OK
    tables = Workspace(spark, root).load()
    assert {n: tables[n].count() for n in first} == first and tables["target_fills"].count() == 0
    assert run("bloodline-local") == commands.OK

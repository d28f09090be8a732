"""A folder of table versions: commands read the newest version of each table and put a new one beside it.

A version counts once its marker is written, which is the last thing a commit does;
a commit that was broken off leaves a folder that no one reads.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from furlong.plans import store
from furlong.sources.pages import SCHEMAS as READ

#: The core tables: what the readers find, with the columns that plans add.
CORE = {
    "races": READ["official_races"] + ", race_name_plain string, source string, fetched_at string, updated_at string",
    "horses": "horse_id string, horse_name string, sex string, birth_date string, sire string, dam string, broodmare_sire string, owner string, owner_name string, breeder string, trainer_name string, sire_no string, broodmare_sire_no string, sire_key string, dam_key string, broodmare_sire_key string, source string, updated_at string",
    "jockeys": "jockey_id string, jockey_name string, updated_at string",
    "trainers": "trainer_id string, trainer_name string, stable string, full_name string, kana string, birth_date string, license_year int, meikan_updated_at string, updated_at string",
    "owners": "owner_id string, owner_name string, updated_at string",
    "entries": "race_id string, umaban int, waku int, horse_id string, sex string, age int, kinryo double, kinryo_mark string, jockey_id string, trainer_id string, trainer_stable string, owner_id string, owner_id_at_export string, horse_weight int, weight_diff int",
    "results": READ["results"],
    "payouts": READ["payouts"],
    "race_laps": READ["laps"],
    "kaisai_days": "kaisai_date string, n_races int, n_saved int, n_unavailable int, completed boolean",
    "upcoming_races": READ["races"] + ", entry_status string, updated_at string",
    "upcoming_entries": READ["entries"] + ", kinryo_mark string",
    "odds": READ["odds"],
    "track_conditions": "venue_code string, date string, measured_at string, cushion_value double, turf_moisture_goal double, turf_moisture_4corner double, dirt_moisture_goal double, dirt_moisture_4corner double, updated_at string",
    "sire_leading": READ["leading"],
    "horse_ancestors": "horse_id string, path string, generation int, ancestor_no string, name string, source string",
    "trainer_stalls": "trainer_id string, effective_date string, stable string, stalls int",
    "target_fills": "table_name string, row_key string, column_name string, filled_at string",
}


class Workspace:
    """The tables below ``root``, a URI of the shared store."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files, self.path = fs.FileSystem.from_uri(self.root)

    def versions(self) -> list[int]:
        found = self.files.get_file_info(fs.FileSelector(self.path, allow_not_found=True))
        names = [f.base_name for f in found if f.type == fs.FileType.Directory and f.base_name.isdigit()]
        done = self.files.get_file_info([f"{self.path}/{n}/_DONE" for n in names])
        return sorted(int(n) for n, f in zip(names, done, strict=True) if f.type == fs.FileType.File)

    def places(self) -> dict[str, str]:
        """The folder of each table's newest version, below the root."""
        out = {}
        for version in self.versions():
            inside = self.files.get_file_info(fs.FileSelector(f"{self.path}/{version:06d}"))
            out |= {f.base_name: f"{version:06d}/{f.base_name}" for f in inside if f.type == fs.FileType.Directory}
        return out

    def load(self) -> dict[str, DataFrame]:
        """All tables, widened to the core schemas; tables that were never written are empty."""
        kept = {name: self.spark.read.parquet(f"{self.root}/{place}") for name, place in self.places().items()}
        return {**store.create(self.spark, CORE), **store.migrate(kept, {**store.AUDIT, **CORE})} if kept else store.create(self.spark, CORE)

    def save(self, changed: Mapping[str, DataFrame]) -> int:
        """Write the changed tables as the next version; its number."""
        version = max(self.versions(), default=0) + 1
        store.commit(changed, self.root, version)
        with self.files.open_output_stream(f"{self.path}/{version:06d}/_DONE") as marker:
            marker.write(b"")
        return version

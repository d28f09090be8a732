"""Positional CSV files of a legacy export: runs (110 columns) and horses (104 columns).

A file is decoded and split where it lies, one row of cells for each line, with its
line number. What a line says is then read by column expressions; a line that one
of them cannot read is kept apart with the reason.
"""

from __future__ import annotations

import csv
import hashlib
import io
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from furlong.functions import ids, scalars, vocab
from furlong.functions.scalars import MISSING

RUN_WIDTH, HORSE_WIDTH = 110, 104
ENCODING = "cp932"

# Places and kinds of the fields of a run line.
RACE_FIELDS = {
    "race_label": (3, "text"), "race_name_short": (5, "text"), "class_name": (80, "text"), "class_code": (61, "text"), "race_symbol_code": (62, "text"), "race_type_code": (63, "text"),
    "weight_type_code": (64, "text"), "track_code": (59, "text"), "track_code_jv": (60, "text"), "distance_m": (108, "int"), "turf_inout": (106, "text"), "course_setting": (109, "text"),
    "weather": (105, "text"), "post_time": (79, "text"), "n_registered": (12, "int"), "pci3": (47, "float"), "rpci": (48, "float"),
}
RUN_FIELDS = {
    "waku": (30, "int"), "horse_name": (6, "text"), "sex": (8, "text"), "age": (9, "int"), "jockey_id": (54, "text"), "jockey_name": (10, "text"), "trainer_id": (55, "text"), "trainer_name": (20, "text"),
    "blinker": (29, "flag"), "horse_mark": (68, "text"), "horse_mark_code": (65, "text"), "multi_entry": (18, "flag"), "abnormal_code": (58, "int"), "finish_position": (56, "int"), "arrival_order": (57, "int"),
    "margin_sec": (22, "float"), "margin": (81, "text"), "corner1": (36, "int"), "corner2": (37, "int"), "corner3": (38, "int"), "corner4": (39, "int"), "last_3f": (26, "float"), "last_3f_rank": (44, "int"),
    "diff_at_3f": (32, "float"), "ave_3f": (42, "float"), "pci": (45, "float"), "good_run": (46, "flag"), "avg_1f_sec": (49, "float"), "avg_speed": (50, "float"), "speed_ex_last3f": (51, "float"),
    "speed_last3f": (52, "float"), "finishing_move": (40, "text"), "running_style": (41, "text"), "win_odds": (87, "float"), "popularity": (14, "int"), "horse_weight": (27, "int"), "weight_diff": (28, "int"),
    "prize_man_yen": (103, "float"), "added_prize_man_yen": (104, "float"), "age_days": (99, "int"),
}
# Places and kinds of the fields of a horse line.
HORSE_FIELDS = {
    "horse_name": (0, "text"), "name_en": (5, "text"), "sex": (9, "text"), "age_at_export": (10, "int"), "status": (11, "text"), "horse_mark": (13, "text"), "sire_name": (15, "text"), "sire_bms_name": (16, "text"),
    "dam_name": (17, "text"), "bms_name": (18, "text"), "dam_dam_name": (19, "text"), "dam_dam_sire_name": (20, "text"), "dam_dam_dam_name": (21, "text"), "sire_line": (22, "text"), "sire_bms_line": (23, "text"),
    "bms_line": (24, "text"), "dam_dam_sire_line": (25, "text"), "owner_name": (26, "text"), "silks": (28, "text"), "owner_code": (30, "text"), "breeder_name": (31, "text"), "birthplace": (33, "text"),
    "coat_color": (34, "text"), "earned_prize_man_yen": (35, "float"), "jump_earned_prize_man_yen": (36, "float"), "main_prize_man_yen": (37, "float"), "added_prize_man_yen": (38, "float"),
    "n_races_total": (40, "int"), "n_races_actual": (41, "int"), "n_races_jra": (42, "int"), "first_venue": (46, "text"), "latest_venue": (47, "text"), "first_race_key18": (54, "text"),
    "latest_race_key18": (56, "text"), "data_created_date": (57, "date"), "registered_date": (58, "date"), "retired_date": (59, "date"), "sale_name": (63, "text"), "name_origin": (64, "text"),
    "sire_age": (84, "int"), "sire_coat": (85, "text"), "dam_age": (86, "int"), "dam_coat": (87, "text"), "dam_dam_age": (88, "int"), "dam_dam_coat": (89, "text"), "sire_breed_no": (90, "text"),
    "sire_bms_breed_no": (91, "text"), "dam_breed_no": (92, "text"), "bms_breed_no": (93, "text"), "dam_dam_breed_no": (94, "text"), "dam_dam_sire_breed_no": (95, "text"), "dam_dam_dam_breed_no": (96, "text"),
}
SIBLINGS = ((72, 73), (74, 75), (76, 77), (78, 79), (80, 81))
#: Codes of runners that did not start.
NOT_STARTED = (1, 2, 3)


def read_lines(spark: SparkSession, path: str, width: int, encoding: str = ENCODING) -> DataFrame:
    """``file, sha256, line_no, raw, cells, bad``: the lines of all files of ``path``.

    ``raw`` are the cells as they are, ``cells`` normalised with missing ones null.
    A file whose header has another width comes as one row with the reason in
    ``bad`` and no cells; so does a line of another width.
    """

    def normal(value: str) -> str | None:
        value = unicodedata.normalize("NFKC", value).strip()
        return None if value in MISSING else value

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                digest, rows = hashlib.sha256(content).hexdigest(), []
                lines = csv.reader(io.StringIO(content.decode(encoding), newline=""))
                header = next(lines, None) or []
                if len(header) != width:
                    rows.append((1, None, None, f"header has {len(header)} columns, not {width}"))
                else:
                    for cells in lines:
                        bad = None if len(cells) == width else f"{len(cells)} columns, not {width}"
                        rows.append((lines.line_num, cells if not bad else None, [normal(c) for c in cells] if not bad else None, bad))
                if not rows:
                    continue
                numbers, raw, clean, bad = zip(*rows, strict=True)
                texts = pa.list_(pa.string())
                yield pa.RecordBatch.from_pydict({"file": pa.array([file] * len(rows)), "sha256": pa.array([digest] * len(rows)), "line_no": pa.array(numbers, pa.int64()), "raw": pa.array(raw, texts), "cells": pa.array(clean, texts), "bad": pa.array(bad, pa.string())})

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(split, "file string, sha256 string, line_no long, raw array<string>, cells array<string>, bad string")


def _cell(i: int) -> Column:
    return F.get(F.col("cells"), F.lit(i))


class _Line:
    """Columns read from a line, and what was wrong with it."""

    def __init__(self) -> None:
        self.columns: dict[str, Column] = {}
        self.reasons: list[Column] = [F.col("bad")]

    def put(self, name: str, value: Column) -> None:
        self.columns[name] = value

    def field(self, name: str, place: int, kind: str) -> None:
        cell = _cell(place)
        if kind == "text":
            self.put(name, cell)
        elif kind == "flag":
            self.put(name, scalars.flag(cell))
        else:
            read = {"int": lambda c: scalars.strict_int(c)["value"], "float": lambda c: scalars.strict_float(c)["value"], "date": scalars.dotted_date}[kind](cell)
            self.put(name, read)
            self.reasons.append(F.when(cell.isNotNull() & read.isNull(), F.concat(F.lit(f"{name} is no {kind}: "), cell)))

    def read(self, name: str, place: int, value: Column) -> None:
        """A value of which the text must be readable, if there is one."""
        self.put(name, value)
        self.reasons.append(F.when(_cell(place).isNotNull() & value.isNull(), F.concat(F.lit(f"{name} cannot be read: "), _cell(place))))

    def check(self, good: Column, reason: str) -> None:
        self.reasons.append(F.when(~F.coalesce(good, F.lit(False)) & F.col("bad").isNull(), F.lit(reason)))

    def apply(self, lines: DataFrame) -> DataFrame:
        return lines.select("file", "sha256", "line_no", F.coalesce(*self.reasons).alias("reason"), *[c.alias(n) for n, c in self.columns.items()])


def parse_runs(lines: DataFrame) -> DataFrame:
    """All fields of run lines, with ``reason`` where the line is refused."""
    line = _Line()
    key = F.trim(F.get(F.col("raw"), F.lit(76)))
    race_id = ids.race_id_of_key18(key)
    date = scalars.dotted_date(_cell(2))
    line.put("race_id", race_id)
    line.put("umaban", ids.number_of_key18(key))
    line.put("race_date", date)
    line.check(race_id.isNotNull(), "the key is not of 18 digits")
    line.check(ids.is_race_id(race_id), "the key names no known venue")
    line.check(F.replace(date, F.lit("-"), F.lit("")) == F.substring(key, 1, 8), "the date is not that of the key")
    line.check(scalars.strict_int(_cell(13))["value"] == ids.number_of_key18(key), "the number is not that of the key")
    line.put("horse_id", _cell(53))
    line.check(ids.is_horse_id(_cell(53)), "the registration number is not of 10 digits")
    decoded = ids.decode_race_id(race_id)
    for name in ("venue_code", "meeting", "day", "race_no"):
        line.put(name, decoded[name])
    for name, (place, kind) in {**RACE_FIELDS, **RUN_FIELDS}.items():
        line.field(name, place, kind)
    for name in ("finish_position", "arrival_order"):
        line.columns[name] = F.nullif(line.columns[name], F.lit(0))
    line.put("surface", scalars.surface_of(_cell(60)))
    line.put("going", vocab.lookup(_cell(17), vocab.GOING))
    line.put("stable", vocab.stable(_cell(19)))
    carried = scalars.carried_weight(_cell(11))
    line.read("kinryo", 11, carried["kg"])
    line.put("kinryo_mark", carried["mark"])
    line.read("time_sec", 21, scalars.seconds_of_digits(_cell(21)))
    line.put("finish_raw", F.nullif(F.trim(F.get(F.col("raw"), F.lit(15))), F.lit("")))
    return line.apply(lines)


def load_runs(lines: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(races, runs, warnings) of run lines.

    The first line of a race or of a runner counts. A race's number of runners
    leaves out those that did not start. Warnings: refused lines, repeated
    runners, and lines whose race fields are not those of the race's first line.
    """
    parsed = parse_runs(lines)
    good = parsed.where("reason is null")
    at = Window.partitionBy("race_id", "umaban").orderBy("file", "line_no")
    ranked = good.withColumn("_nth", F.row_number().over(at))
    runs = ranked.where("_nth = 1").select("race_id", "umaban", "horse_id", *RUN_FIELDS, "stable", "kinryo", "kinryo_mark", "time_sec", "finish_raw", "file")
    level = ["race_date", "venue_code", "meeting", "day", "race_no", *RACE_FIELDS, "surface", "going"]
    first = good.groupBy("race_id").agg(F.min_by(F.struct(*level, "file"), F.struct("file", "line_no")).alias("r"))
    n = runs.groupBy("race_id").agg(F.count_if(~F.coalesce(F.col("abnormal_code"), F.lit(-1)).isin(*NOT_STARTED)).cast("int").alias("n_runners"))
    races = first.select("race_id", "r.*").join(n, "race_id")
    warnings = parsed.where("reason is not null").select("file", "line_no", "reason")
    repeated = ranked.where("_nth > 1").select("file", "line_no", F.concat_ws(" ", F.lit("repeated runner"), "race_id", F.col("umaban").cast("string")).alias("reason"))
    compared = good.join(first, "race_id")
    differs = F.array_compact(F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"r.{c}")), F.lit(c)) for c in level]))
    conflicts = compared.withColumn("_d", differs).where(F.size("_d") > 0).select("file", "line_no", F.concat(F.lit("race fields differ: "), F.array_join("_d", ", ")).alias("reason"))
    return races, runs, warnings.unionByName(repeated).unionByName(conflicts)


def parse_horses(lines: DataFrame) -> DataFrame:
    line = _Line()
    line.put("horse_id", _cell(6))
    line.check(ids.is_horse_id(_cell(6)), "the registration number is not of 10 digits")
    for name, (place, kind) in HORSE_FIELDS.items():
        line.field(name, place, kind)
    both = vocab.split_stable(_cell(14))
    line.put("stable", both["stable"])
    line.put("trainer_name", both["name"])
    birth = scalars.birth_date(_cell(51), _cell(52))
    line.put("birth_date", birth)
    line.reasons.append(F.when(_cell(51).isNotNull() & _cell(52).isNotNull() & birth.isNull(), F.lit("birth date cannot be read")))
    wins = scalars.record(_cell(39))
    line.reasons.append(F.when(_cell(39).isNotNull() & wins.isNull(), F.lit("record cannot be read")))
    for i, name in enumerate(("n_1st", "n_2nd", "n_3rd", "n_other")):
        line.put(name, F.get(wins, F.lit(i)))
    line.read("sale_price_man_yen", 62, scalars.price(_cell(62))["amount"])
    line.put("sale_price_note", scalars.price(_cell(62))["note"])
    line.read("sibling_prize_sum_man_yen", 82, scalars.amount_with_count(_cell(82))["amount"])
    line.put("sibling_n", scalars.amount_with_count(_cell(82))["n"])
    line.read("sibling_prize_avg_man_yen", 83, scalars.amount_with_count(_cell(83))["amount"])
    pairs = [F.struct(F.lit(i).alias("rank"), _cell(a).alias("sibling_name"), scalars.strict_int(_cell(b))["value"].alias("n_wins")) for i, (a, b) in enumerate(SIBLINGS, 1)]
    line.put("siblings", F.filter(F.array(*pairs), lambda s: s["sibling_name"].isNotNull()))
    for a, b in SIBLINGS:
        line.reasons.append(F.when(_cell(a).isNotNull() & _cell(b).isNotNull() & scalars.strict_int(_cell(b))["value"].isNull(), F.lit("wins of a sibling cannot be read")))
    return line.apply(lines)


def load_horses(lines: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(horses, siblings, warnings) of horse lines; of repeated horses the one created last counts, then the later line."""
    parsed = parse_horses(lines)
    order = Window.partitionBy("horse_id").orderBy(F.desc(F.coalesce("data_created_date", F.lit(""))), F.desc("file"), F.desc("line_no"))
    ranked = parsed.where("reason is null").withColumn("_nth", F.row_number().over(order))
    kept = ranked.where("_nth = 1").drop("_nth", "reason", "sha256", "line_no")
    siblings = kept.select("horse_id", F.explode("siblings").alias("s")).select("horse_id", "s.*")
    warnings = parsed.where("reason is not null").select("file", "line_no", "reason")
    repeated = ranked.where("_nth > 1").select("file", "line_no", F.concat(F.lit("an older row of "), F.col("horse_id")).alias("reason"))
    return kept.drop("siblings"), siblings, warnings.unionByName(repeated)


#: Stables of the stall list.
STALL_STABLES = ("美浦", "栗東")


def read_stalls(spark: SparkSession, path: str) -> DataFrame:
    """``effective_date, stable, trainer_name, stalls`` of UTF-8 files with named columns.

    A row with an unknown stable, a number that is none, or a date of another form
    refuses the whole read. Rows without a name are left out.
    """
    rows = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    rows = rows.toDF(*[c.lstrip("﻿").strip() for c in rows.columns])
    stalls = scalars.to_int(F.col("stalls"))
    good = F.col("stable").isin(*STALL_STABLES) & stalls.isNotNull() & F.col("effective_date").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$")
    named = rows.where(F.coalesce(scalars.strip(F.col("trainer_name")), F.lit("")) != "")
    wrong = named.where(~F.coalesce(good, F.lit(False))).limit(5).collect()
    if wrong:
        raise ValueError(f"rows that cannot be read: {[r.asDict() for r in wrong]}")
    return named.select("effective_date", "stable", scalars.strip(F.col("trainer_name")).alias("trainer_name"), stalls.cast("int").alias("stalls"))

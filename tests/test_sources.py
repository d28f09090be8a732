"""Page readers on synthetic pages, and the second source from files to core tables."""

import csv

import pytest
from furlong.plans import second_source
from furlong.session import cut
from furlong.sources import html, jsons, pages, positional
from furlong.sources.dom import parse
from furlong.streaming import incremental
from pyspark.sql import functions as F

RESULT = """<html><body><div class="data_intro"><h1>第1回テストS(GII)</h1><dl><dd><p><span>芝右 外2200m / 天候 : 曇 / 芝 : 稍重 / 発走 : 15:45</span></p></dd></dl></div>
<p class="smalltxt">2026年9月20日 4回中山4日目 3歳以上オープン (国際)(指)(定量)</p>
<table class="race_table_01"><tr><th>着順<th>枠番<th>馬番<th>馬名<th>性齢<th>斤量<th>騎手<th>タイム<th>着差<th>単勝<th>人気<th>馬体重<th>調教師<th>通過</tr>
<tr><td>1<td>2<td>3<td><a href="/horse/2021100001/" title="テストウマ">x</a><td>牡5<td>57.0<td><a href="/jockey/result/recent/01001/">騎手</a><td>2:13.4<td><td>3.2<td>1<td>498(+4)<td>[西]<a href="/trainer/01002/">調教師</a><td>3-3-2-1</tr>
<tr><td>2(降)<td>1<td>1<td><a href="/horse/2021100002/">二</a><td>牝4<td>55.0<td>新人<td>2:13.5<td>クビ<td>10.0<td>4<td>456<td>[東]<a href="/trainer/01003/">先生</a><td>1-1-1-2</tr>
<tr><td>取<td>1<td>2<td>無名<td>セ6<td>57<td>人<td><td><td>---<td><td>計不<td>x<td></tr></table>
<table class="pay_table_01"><tr><th>単勝</th><td>3</td><td>320</td><td>1</td></tr><tr><th>複勝</th><td>3<br>1</td><td>130<br>1,200</td><td>1</td></tr></table>
<table summary="ラップタイム"><tr><th>ラップ</th><td>12.5 - 11.0 - 12.0 - 12.0 - 12.0 - 12.0 - 12.0 - 12.0 - 12.0 - 12.0 - 13.9</td></tr></table></body></html>"""
ODDS = """<div class="cell time">12時24分現在オッズ</div><table class="umaren"><caption>1</caption><tr><th>2</th><td>5.3</td></tr><tr><th>3</th><td class="zero">票数なし</td></tr></table><table class="umaren"><caption>2</caption><tr><th>3</th><td>1,234.5</td></tr></table>"""
SOFT = """<div id="cushion_data_list"><div title="中山"><div class="unit"><div class="time">9月20日（日曜）7時00分</div><div class="cushion">9.5</div></div><div class="unit"><div class="time">12月30日 9時30分</div><div class="cushion">x</div></div></div></div>"""


def lineage_page():
    cells = ""
    for row in range(32):
        cells += "<tr>" + "".join(f'<td rowspan="{32 >> g}"><a href="/horse/ped/{g}x{row >> (5 - g):05d}/">馬{g}_{row} (米)</a></td>' for g in range(1, 6) if row % (32 >> g) == 0) + "</tr>"
    return f'<table class="blood_table">{cells}</table>'


def test_pages(spark):
    rows = [("a", RESULT, "202606040411", None, None, None), ("b", "<p>nothing</p>", "202606040412", None, None, None), ("c", '<table class="race_table_01"></table>', "202606040401", None, None, None)]
    df = spark.createDataFrame(rows, "k string, page string, race_id string, bet_type string, today string, horse_id string")
    found = pages.read(df, "race_result", "k", "page", ["race_id"]).cache()
    race = pages.table(found, "races").first()
    assert (race["race_name"], race["grade"], race["surface"], race["direction"], race["distance_m"], race["course_detail"], race["going_turf"], race["post_time"]) == ("第1回テストS", "GII", "turf", "right", 2200, "外", "稍重", "15:45")
    assert (race["race_date"], race["age_condition"], race["class_condition"], race["race_conditions"], race["n_runners"]) == ("2026-09-20", "3歳以上", "オープン", "国際,指,定量", 2)
    results = {r["umaban"]: r for r in pages.table(found, "results").collect()}
    assert (results[3]["time_sec"], results[1]["finish_position"], results[1]["finish_status"], results[2]["finish_status"]) == (133.4, 2, "降着", "取消")
    entries = {r["umaban"]: r for r in pages.table(found, "entries").collect()}
    assert (entries[3]["horse_name"], entries[3]["trainer_stable"], entries[3]["weight_diff"], entries[1]["jockey_name"], entries[2]["horse_id"]) == ("テストウマ", "栗東", 4, "新人", None)
    assert [tuple(r) for r in pages.table(found, "payouts").select("bet_type", "combination", "payout_yen", "popularity").orderBy("bet_type", "payout_yen").collect()] == [("単勝", "3", 320, 1), ("複勝", "3", 130, 1), ("複勝", "1", 1200, None)]
    assert [r["distance_m"] for r in pages.table(found, "laps").orderBy("seq").collect()] == list(range(200, 2201, 200))
    assert [r["key"] for r in pages.table(found, "errors").collect()] == ["c"]
    odd = spark.createDataFrame([("o", ODDS, "202606040411", "umaren", None, None), ("o2", ODDS, "202606040411", "wide", None, None)], df.schema)
    bets = pages.read(odd, "odds", "k", "page", ["race_id", "bet_type"]).cache()
    assert [(r["combo"], r["odds_low"], r["odds_label"]) for r in pages.table(bets, "odds").orderBy("combo").collect()] == [("1-2", 5.3, "12時24分現在オッズ"), ("1-3", None, "12時24分現在オッズ"), ("2-3", 1234.5, "12時24分現在オッズ")]
    assert pages.table(bets, "errors").count() == 1
    soft = pages.table(pages.read(spark.createDataFrame([("s", SOFT, None, None, "2026-09-21", None)], df.schema), "cushion", "k", "page", ["today"]), "track").collect()
    assert [(r["venue_name"], r["measured_at"], r["cushion_value"]) for r in soft] == [("中山", "2026-09-20 07:00", 9.5)]
    trees = spark.createDataFrame([("p", lineage_page(), None, None, None, "2021100001"), ("q", lineage_page().replace("</tr>", "", 1).replace("<tr>", "", 1), None, None, None, "2021100002")], df.schema)
    kept = pages.read(trees, "pedigree", "k", "page", ["horse_id"]).cache()
    cells = {r["path"]: r for r in pages.table(kept, "ancestors").collect()}
    assert len(cells) == 62 and cells["f"]["ancestor_no"] == "1x00000" and cells["mfm"]["ancestor_no"] == "3x00005" and cells["m"]["country"] == "米"
    assert pages.table(kept, "errors").count() == 1


def test_flat_facts(spark):
    page = "<title>T</title><a href='x'></a><a href=\"?kaisai_date=20260920\"></a><a href=\"?race_id=202606040411\"></a><a href=\"?race_id=202699040411\"></a><table><tr><th>A</th><th>B</th></tr><tr><td>1<br>2</td><td><table><tr><td>in</td></tr></table></td></tr></table>"
    df = spark.createDataFrame([(1, page), (2, None)], "k int, h string")
    assert df.select(html.title(F.col("h")), html.calendar_dates(F.col("h")), html.race_ids(F.col("h"))).first()[:] == ("T", ["2026-09-20"], ["202606040411"])
    cells = html.table_cells(df, "k", "h").cache()
    assert [(r["table_no"], r["row_no"], r["cell_no"], r["text"]) for r in cells.collect()] == [(0, 0, 0, "A"), (0, 0, 1, "B"), (0, 1, 0, "1\n2"), (0, 1, 1, ""), (1, 0, 0, "in")]
    assert [tuple(r) for r in html.named_rows(cells, "k", ["A"], ["C"]).collect()] == [(1, 0, 1, "1\n2", None)]
    assert [r["header"] for r in html.missing_headers(cells, "k", ["A", "Z"]).collect()] == ["Z"]
    feed = '{"kaisai_info": [{"jyoname": "阪神", "kaisai_ymd": "20260921", "weather": "晴", "ba_s": "良", "ba_d": " "}, {"jyoname": "", "kaisai_ymd": "20260921"}, {"jyoname": "中山", "kaisai_ymd": "2026"}]}'
    assert [tuple(r) for r in jsons.course_conditions(spark.createDataFrame([(feed,), ("no json",)], "text string")).collect()] == [("2026-09-21", "阪神", "晴", "良", None)]
    tree = parse("<ul><li>a<li>b<ul><li>c</ul></ul><p>x<p>y")
    assert [e.text() for e in tree.first("ul").own("li")] == ["a", "b c"] and len(tree.all("p")) == 2


def run_line(day, meeting, race, umaban, horse, **more):
    cells = [""] * 110
    key = f"{day.replace('-', '')}{meeting}{race:02d}{umaban:02d}"
    y, m, d = day.split("-")
    defaults = {2: f"{y}. {int(m)}. {int(d)}", 3: "1中1", 5: "未勝利", 6: "テストウマ", 8: "牡", 9: "3", 10: "騎手Ａ", 11: " 56 ", 12: "2", 13: str(umaban), 14: "1", 15: "１", 17: "稍", 19: "(美)", 20: "調教師Ａ", 21: "1343", 26: "35.0", 27: "480", 28: "+2", 30: "1", 38: "3", 39: "2", 47: "50.0", 48: "48.0", 53: horse, 54: "01001", 55: "01002", 56: "1", 57: "1", 58: "0", 60: "17", 61: "7", 62: "A03", 63: "12", 64: "3", 76: key, 79: "10:00", 80: "未勝利", 87: "2.5", 103: "500", 105: "晴", 108: "1800"}
    for i, v in (defaults | more.get("cells", {})).items():
        cells[i] = v
    return cells


def horse_line(horse, created="2026. 9. 1", **cells):
    out = [""] * 104
    defaults = {0: "テストウマ", 5: "Test Uma", 6: horse, 9: "牡", 10: "5", 11: "抹消", 14: "(美)調教師Ａ", 15: "Foreign Sire", 17: "ハハウマ", 18: "ハハチチ", 26: "馬主Ａ", 30: "000123", 31: "牧場Ａ", 39: " 1- 0- 0- 2", 51: "2021", 52: "4月1日", 57: created, 72: "アニウマ", 73: "2", 82: "100万(1)", 90: "1120000001", 92: "1220000001", 93: "1120000002"}
    for i, v in (defaults | {int(k[1:]): v for k, v in cells.items()}).items():
        out[i] = v
    return out


def write_csv(path, lines, width):
    with open(path, "w", encoding="cp932", newline="") as f:
        csv.writer(f).writerows([["x"] * width, *lines])


def test_second_source(spark, tmp_path):
    runs = [
        run_line("2024-01-06", "060101", 1, 1, "2021100001"),
        run_line("2024-01-06", "060101", 1, 2, "2021100002", cells={21: "1345", 81: "1 1/4", 103: "", 56: "2", 36: "", 38: "3", 39: "2"}),
        run_line("2024-01-06", "060101", 1, 2, "2021100009"),
        run_line("2024-01-06", "060101", 2, 1, "2021100003", cells={58: "1", 105: "雨"}),
        run_line("2024-01-06", "060101", 2, 2, "2021100004", cells={9: "abc"}),
        run_line("2024-01-06", "060101", 3, 1, "bad"),
        ["short"],
    ]
    write_csv(tmp_path / "r.csv", runs, 110)
    write_csv(tmp_path / "wrong.csv", [["x"] * 5], 5)
    lines = positional.read_lines(spark, str(tmp_path / "*.csv"), 110).cache()
    races, loaded, warnings = positional.load_runs(lines)
    assert {r["race_id"]: r["n_runners"] for r in races.collect()} == {"202406010101": 2, "202406010102": 0}
    assert [(r["race_id"], r["umaban"], r["horse_id"]) for r in loaded.orderBy("race_id", "umaban").collect()] == [("202406010101", 1, "2021100001"), ("202406010101", 2, "2021100002"), ("202406010102", 1, "2021100003")]
    assert warnings.count() == 5
    horses_path = tmp_path / "h"
    horses_path.mkdir()
    write_csv(horses_path / "h.csv", [horse_line("2021100001"), horse_line("2021100002", created="2026. 8. 1", c0="旧名"), horse_line("2021100002", created="2026. 9. 2", c0="新名"), horse_line("12")], 104)
    horses, siblings, odd = positional.load_horses(positional.read_lines(spark, str(horses_path), 104))
    assert {r["horse_id"]: r["horse_name"] for r in horses.collect()} == {"2021100001": "テストウマ", "2021100002": "新名"}
    assert [tuple(r) for r in siblings.orderBy("horse_id").collect()] == [("2021100001", 1, "アニウマ", 2), ("2021100002", 1, "アニウマ", 2)] and odd.count() == 2

    # Staged and merged tables are written between the steps of a real run.
    staged = {k: cut(v) for k, v in second_source.stage({}, races, loaded, horses, siblings).items()}
    empty = lambda schema: spark.createDataFrame([], schema)
    core = {
        "jockeys": empty("jockey_id string, jockey_name string"), "trainers": empty("trainer_id string, trainer_name string, stable string"), "owners": empty("owner_id string, owner_name string"),
        "horses": spark.createDataFrame([("2021100001", "テストウマ", "牡", "フォーリンサイアー", None, None, None, None, None, None, "scrape")], "horse_id string, horse_name string, sex string, sire string, dam string, broodmare_sire string, owner_name string, breeder string, birth_date string, trainer_name string, source string"),
        "races": empty(second_source.core_races(races).schema.simpleString()[7:-1].replace(":", " ") + ", source string"),
        "entries": empty(second_source.core_entries(loaded).schema.simpleString()[7:-1].replace(":", " ")),
        "results": empty(second_source.core_results(loaded).schema.simpleString()[7:-1].replace(":", " ")),
    }
    merged, audit = second_source.merge(core, staged)
    merged = {k: cut(v) for k, v in merged.items()}
    filled = {(r["row_key"], r["column_name"]) for r in audit.collect()}
    assert ("2021100001", "birth_date") in filled and ("2021100001", "sire") not in filled
    by_id = {r["horse_id"]: r for r in merged["horses"].collect()}
    assert by_id["2021100001"]["sire"] == "フォーリンサイアー" and by_id["2021100001"]["birth_date"] == "2021-04-01"
    assert (by_id["2021100002"]["sire"], by_id["2021100002"]["source"], by_id["2021100003"]["sire"]) == ("フォーリンサイアー", "target", None)
    race = merged["races"].where("race_id = '202406010101'").first()
    assert (race["surface"], race["direction"], race["going_turf"], race["class_condition"], race["race_conditions"], race["age_condition"]) == ("turf", "right", "稍重", "未勝利", "混,指,馬齢", "3歳")
    second = merged["results"].where("umaban = 2").first()
    assert (second["time_raw"], second["margin"], second["prize_man_yen"], second["corner_passing"]) == ("1:34.5", "1.1/4", None, "3-2")
    again, nothing = second_source.merge(merged, staged)
    assert nothing.count() == 0 and again["horses"].count() == merged["horses"].count()
    derived = second_source.derive(merged, staged)
    assert {r["horse_id"]: r["sire_key"] for r in derived["horses"].collect() if r["horse_id"] != "2021100003"} == {"2021100001": "1120000001", "2021100002": "1120000001"}
    assert derived["races"].where("race_id = '202406010101'").first()["race_name_plain"] == "3歳未勝利"
    owner = derived["entries"].where("horse_id = '2021100001'").first()
    assert owner["owner_id_at_export"] == "000123"


def test_stalls(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("﻿effective_date,stable,trainer_name,stalls\n2026-01-01,美浦,山田,20\n2026-01-01,栗東,,5\n", encoding="utf-8")
    assert [tuple(r) for r in positional.read_stalls(spark, str(path)).collect()] == [("2026-01-01", "美浦", "山田", 20)]
    path.write_text("effective_date,stable,trainer_name,stalls\n2026-01-01,東,山田,20\n", encoding="utf-8")
    with pytest.raises(ValueError, match="cannot be read"):
        positional.read_stalls(spark, str(path))


def test_resuming(spark, tmp_path):
    days = spark.createDataFrame([("2026-09-01",), ("2026-09-10",)], "d string")
    assert [str(x) for x in incremental.update_range(days, "d", "2026-09-20").first()] == ["2026-09-03", "2026-09-18"]
    wanted = spark.createDataFrame([(i,) for i in range(5)], "k int")
    assert [r["k"] for r in incremental.pending(wanted, wanted.where("k < 2"), ["k"], 2).collect()] == [2, 3]
    spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (2, 1, "c")], "k int, t int, v string").write.parquet(str(tmp_path / "in"))
    shot = incremental.latest_snapshot_by_stream(spark, str(tmp_path / "in"), ["k"], "t", "v", str(tmp_path / "out"), str(tmp_path / "state"))
    assert sorted((r["k"], r["v"]) for r in shot.collect()) == [(1, "b"), (2, "c")]
    spark.createDataFrame([(2, 9, "new"), (3, 1, "d")], "k int, t int, v string").write.mode("append").parquet(str(tmp_path / "in"))
    for _ in range(2):
        shot = incremental.latest_snapshot_by_stream(spark, str(tmp_path / "in"), ["k"], "t", "v", str(tmp_path / "out"), str(tmp_path / "state"))
        assert sorted((r["k"], r["v"]) for r in shot.collect()) == [(1, "b"), (2, "new"), (3, "d")]

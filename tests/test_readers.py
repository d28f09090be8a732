"""Page readers that need no session."""

import pytest
from furlong.sources.dom import parse
from furlong.sources.pages import READERS, LayoutError


def found(reader, page, **known):
    out = {}
    for name, row in READERS[reader](parse(page), known):
        out.setdefault(name, []).append(row)
    return out


def test_entry_card():
    page = """<title>テスト(G2) 2026年9月21日</title><h1 class="RaceName">３歳以上1勝クラス</h1><div class="RaceData01">15:45発走 / ダ1800m (右 外)</div>
    <div class="RaceData02"><span>4回</span><span>サラ系３歳以上</span><span>(国際)(指)</span><span>定量</span><span>3頭</span></div>
    <table class="Shutuba_Table"><tr><td>AI</td></tr></table>
    <table class="Shutuba_Table"><tr class="HorseList"><td class="Waku1">1<td class="Umaban1">2<td class="HorseInfo"><a href="https://x/horse/2021100001" title="馬">馬</a><td class="Barei">牡5<td>57.0<td class="Jockey"><a href="/jockey/result/recent/01001/">騎</a><td class="Trainer"><span class="Label1">美浦</span><a href="/trainer/01002/">師</a><td class="Weight">480(+2)</tr>
    <tr class="HorseList Cancel"><td class="Waku"><td class="Umaban"><td class="HorseInfo">無名<td class="Barei">牝4<td>55</tr></table>"""
    out = found("entry_card", page, race_id="202606040411")
    race = out["races"][0]
    assert (race["grade"], race["race_date"], race["surface"], race["distance_m"], race["direction"], race["course_detail"], race["post_time"]) == ("GII", "2026-09-21", "dirt", 1800, "right", "外", "15:45")
    assert (race["age_condition"], race["class_condition"], race["race_conditions"], race["n_entries"]) == ("3歳以上", "1勝クラス", "国際,指,定量", 2)
    a, b = out["entries"]
    assert (a["umaban"], a["horse_id"], a["kinryo"], a["jockey_id"], a["stable"], a["horse_weight"], a["status"]) == (2, "2021100001", 57.0, "01001", "美浦", 480, None)
    assert (b["umaban"], b["horse_name"], b["status"]) == (None, "無名", "取消")
    assert len(out["warnings"]) == 2 and found("entry_card", "<p>x</p>", race_id="202606040411") == {}


def test_lists_and_tokens():
    page = """<li class="RaceList_DataItem"><a href="?race_id=202606040412"><span class="Race_Num">12R</span><span class="ItemTitle">T</span><span class="RaceList_Itemtime">16:20</span><span class="RaceList_ItemLong">芝1600m</span><span class="RaceList_Itemnumber">16頭</span></a>
    <li class="RaceList_DataItem"><a href="?race_id=202606040411">x</a><li class="RaceList_DataItem"><a href="?race_id=202644040411">x</a>"""
    rows = found("race_list", page)["races"]
    assert [r["race_id"] for r in rows] == ["202606040411", "202606040412"] and (rows[1]["race_no"], rows[1]["n_entries"], rows[1]["post_time"]) == (12, 16, "16:20")
    links = """<a onclick="return doAction('/JRADB/accessS.html', 'pw01srl10062026040420260920/E5');">4回中山4日</a><a href="/JRADB/accessS.html?CNAME=pw01sde1006202604041120260920/40">11R</a>"""
    rows = found("tokens", links, marker="pw01s")["tokens"]
    assert [(r["venue_code"], r["meeting"], r["day"], r["date"], r.get("race_id")) for r in rows] == [("06", 4, 4, "2026-09-20", None), ("06", 4, 4, "2026-09-20", "202606040411")]
    months = found("month_tokens", """<script>var yearMonth = "202609"; objParam["2609"]="54"; objParam["9912"]="A1"; objParam["2613"]="x1";</script>""")["months"]
    assert [(m["month"], m["token"]) for m in months] == [("2026-09", "pw01skl00202609/54"), ("1999-12", "pw01skl10199912/A1")]


def test_tables_of_people_and_horses():
    cells = "".join(f"<td>{c}</td>" for c in ("1", "キズナ（2010年）", "青鹿毛", "新冠", "276", "150", "1,000", "180", "3,021,929,000円", "1", "10,949,018", "0.180", "2.31"))
    out = found("sire_leading", f'<h2>2026年度 リーディングサイヤー（全馬）</h2><table class="basic lead"><thead><tr><th>x</thead><tbody><tr>{cells}</tr><tr><td>計</td></tr></tbody></table>')
    row = out["leading"][0]
    assert (row["year"], row["kind"], row["sire_name"], row["birth_year"], row["n_starts"], row["prize_yen"], row["ei"]) == (2026, "all", "キズナ", 2010, 1000, 3021929000, 2.31)
    page = """<h1><span class="txt"><span class="opt">競走馬情報</span>コントレイル<span class="name_en">Contrail</span></span></h1><div class="profile"><dl><dt>父<dd><a href="?CNAME=pw01dud102002100816/AA">ディープ</a></dl><dl><dt>母<dd>ロード<span class="sanku">産駒</span></dl><dl><dt>性別<dd>せん5</dl><dl><dt>生年月日<dd>2017年4月1日</dl><dl><dt>調教師名<dd>矢作 芳人（栗東）</dl></div>"""
    horse = found("horse_profile", page, horse_id="2017101835")["horses"][0]
    assert (horse["horse_name"], horse["sire"], horse["dam"], horse["sire_no"], horse["sex"], horse["birth_date"], horse["trainer_name"], horse["stable"]) == ("コントレイル", "ディープ", "ロード", "2002100816", "セ", "2017-04-01", "矢作 芳人", "栗東")
    hits = found("horse_search", '<table><tr><td class="horse"><a href="?CNAME=pw01dud002017101835/0D">コン</a><span class="icon">抹</span></td><td class="age">牡4</td><td class="trainer"><span class="icon">栗東</span>矢作</td></tr></table>', word="コン", limit=1)["hits"]
    assert (hits[0]["name"], hits[0]["is_retired"], hits[0]["stable"], hits[0]["capped"], hits[0]["horse_no"]) == ("コン", True, "栗東", True, "2017101835")
    trainer = found("trainer_profile", '<h1><span class="txt"><span class="opt">調教師</span>中内田 充正<span class="kana">（ナカウチダ）</span></span></h1><div class="data"><dl><dt>所属<dd>栗東</dl><dl><dt>免許取得年<dd>2012年</dl></div>', trainer_id="01140")["trainers"][0]
    assert (trainer["full_name"], trainer["kana"], trainer["license_year"], trainer["stable"]) == ("中内田 充正", "ナカウチダ", 2012, "栗東")
    card = """<table class="basic"><tbody><tr><td class="num">3</td><td class="horse"><div class="name">馬</div><div class="result_line"><div class="cell weight">504kg<span>(+6)</span></div></div><li class="sire"><span>父：</span>父馬</li><li class="mare"><span>母：</span>母馬<span class="bloodmare">(母の父：祖父)</span></li><p class="owner">主</p></td><td><p class="jockey"><span class="mark">▲</span><a onclick="x('pw04kmk001207/96')">騎</a></p></td></tr></tbody></table>"""
    row = found("entry_profiles", card)["profiles"][0]
    assert (row["umaban"], row["sire"], row["dam"], row["broodmare_sire"], row["horse_weight"], row["weight_diff"], row["jockey_id"], row["kinryo_mark"]) == (3, "父馬", "母馬", "祖父", 504, 6, "01207", "▲")
    for reader, known in (("sire_leading", {}), ("horse_profile", {}), ("trainer_profile", {"trainer_id": "1"}), ("entry_profiles", {}), ("odds", {"bet_type": "wide", "race_id": "r"})):
        with pytest.raises(LayoutError):
            found(reader, "<p>other</p>", **known)


def _unit(number, body, course="1,800メートル（ダート・右 外）", category="障害3歳以上", laps="12.1-11.0", grade="J･GⅢ"):
    return f"""<div class="race_result_unit" id="race_result_{number}R"><div class="cell date">2026年9月20日（日曜） 4回中山6日</div><div class="cell time">発走時刻：<strong>9時5分</strong></div>
    <span class="race_name">名</span><span class="grade_icon"><img alt="{grade}"></span><div class="cell category">{category}</div><div class="cell class">オープン</div><div class="cell rule">（混合） 牝 ［指定］</div><div class="cell weight">定量</div>
    <div class="cell course">コース：{course}</div><div class="cell baba"><ul><li class="weather"><span class="cap">天候</span><span class="txt">雨</span></li><li class="durt"><span class="txt">不良</span></li></ul></div>
    <table><tbody>{body}</tbody></table><table><tr><th>ハロンタイム</th><td>{laps}</td></tr></table></div>"""


RAN = """<tr><td class="place">1</td><td class="waku"><img alt="枠5桃"></td><td class="num">8</td><td class="horse">勝 馬</td><td class="f_time">37.5</td><td class="corner"><ul><li>2</li><li>1</li><li>-</li></ul></td></tr>
<tr><td class="place">取消</td></tr><tr><td class="place">中止</td></tr>"""


def test_meeting_results():
    where = {"venue_code": "06", "meeting": 4, "day": 6, "date": "2026-09-20"}
    page = _unit(1, RAN) + _unit(2, RAN, "400メートル（芝・左）", "2歳", "12.0-11.5", "リステッド") + _unit(3, "<tr><td>未定</td></tr>") + _unit(4, '<tr><td class="place">除外</td></tr>')
    out = found("meeting_results", page, **where)
    first, second = out["official_races"]
    assert first == {
        "race_id": "202606040601", "race_date": "2026-09-20", "venue_code": "06", "meeting": 4, "day": 6, "race_no": 1, "race_name": "名", "grade": "JGIII", "post_time": "09:05", "age_condition": "3歳以上",
        "class_condition": "オープン 牝", "race_conditions": "混,指,定量", "condition_raw": "障害3歳以上 オープン （混合） 牝 ［指定］ 定量", "n_runners": 2, "surface": "jump", "weather": "雨", "going_dirt": "不良",
        "distance_m": 1800, "direction": "right", "course_detail": "外", "winner_umaban": 8, "winner_waku": 5, "winner_name": "勝 馬", "winner_last_3f": 37.5, "winner_corner": "2-1",
    }
    assert (second["grade"], second["surface"], second["direction"], second["course_detail"]) == ("L", "turf", "left", None)
    assert [(x["race_id"][-2:], x["seq"], x["distance_m"]) for x in out["laps"]] == [("01", 1, 200), ("01", 2, 400), ("02", 1, 200), ("02", 2, 400)]
    assert [w["race_id"][-2:] for w in out["warnings"]] == ["01"]  # two laps are not 1,800 m
    other = found("meeting_results", _unit(1, RAN, "不明", "2歳", "x"), **{**where, "day": 5, "date": "2026-09-19"})
    assert len(other["warnings"]) == 4 and "laps" not in other
    assert found("meeting_results", _unit(4, RAN, laps="", category="障害"), **where).keys() == {"official_races"}
    with pytest.raises(LayoutError):
        found("meeting_results", "<p>other</p>", **where)

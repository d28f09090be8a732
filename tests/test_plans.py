"""Plans for cards, odds, stalls and track days; the page store and text blocks."""

from furlong.plans import cards, viewer
from furlong.sources import page_store, track_blocks


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=lambda r: tuple((x is not None, x) for x in r))


def test_cards(spark):
    schema = "race_id string, seq int, umaban int, horse_id string, horse_name string, jockey_id string, horse_weight int, weight_diff int, kinryo_mark string"
    old = spark.createDataFrame([("r1", 1, 1, "h1", "A", "j1", 480, 2, "▲"), ("r1", 2, 2, None, "B", "j2", 500, None, None), ("r2", 1, 1, "h9", "Z", "j9", None, None, None)], schema)
    new = spark.createDataFrame([("r1", 1, 5, "h1", "A", "j1", None, None, None), ("r1", 2, 6, "h2", "B", "j2", None, None, None), ("r1", 3, 7, "h3", "C", "j1", 450, 0, None)], schema)
    saved = cards.save_upcoming_entries(old, new)
    assert rows(saved, "race_id", "umaban", "horse_weight", "weight_diff", "kinryo_mark") == [("r1", 5, 480, 2, "▲"), ("r1", 6, 500, None, None), ("r1", 7, 450, 0, None), ("r2", 1, None, None, None)]
    profiles = spark.createDataFrame([("r1", 5, "A", 482, 4), ("r1", None, "B", 502, 2), ("r1", 7, "C", None, None)], "race_id string, umaban int, horse_name string, horse_weight int, weight_diff int")
    assert rows(cards.add_weights(saved, profiles), "umaban", "horse_weight", "weight_diff") == [(1, None, None), (5, 482, 4), (6, 502, 2), (7, 450, 0)]
    races = spark.createDataFrame([("r1", "entries", "晴", "1"), ("r2", "list_only", None, "1")], "race_id string, entry_status string, weather string, updated_at string")
    fresh = spark.createDataFrame([("r1", "list_only", None, "2"), ("r2", "registered", "雨", "2")], races.schema)
    assert rows(cards.save_upcoming_races(races, fresh)) == [("r1", "entries", "晴", "2"), ("r2", "registered", "雨", "2")]


def test_odds_marks_and_slips(spark):
    odds = spark.createDataFrame([("r", "umaren", "1-2", 5.0), ("r", "wide", "1-2", 2.0)], "race_id string, bet_type string, combo string, odds_low double")
    taken = spark.createDataFrame([("r", "umaren"), ("r", "wide")], "race_id string, bet_type string")
    assert rows(cards.save_odds(odds, odds.where("bet_type = 'umaren'"), taken), "bet_type") == [("umaren",)]
    marks = spark.createDataFrame([("r", "h1", "◎"), ("r", "h2", "○")], "race_id string, horse_id string, mark string")
    fresh = spark.createDataFrame([("r", "h1", ""), ("r", "h3", "▲")], marks.schema)
    assert rows(cards.save_marks(marks, fresh, ("◎", "○", "▲")), "horse_id", "mark") == [("h2", "○"), ("h3", "▲")]
    slips = spark.createDataFrame([("r", [("umaren", " ", -5, ["1-2", "x", "1-2", "3-4"]), ("no", "k", 1, ["1"]), ("wide", "box", 100, ["2-3"])])], "race_id string, groups array<struct<bet_type:string,kind:string,amount:int,combos:array<string>>>")
    flat = cards.slip_rows(slips)
    assert rows(flat, "group_id", "bet_type", "kind", "amount", "seq", "combo") == [(1, "umaren", None, 0, 0, "1-2"), (1, "umaren", None, 0, 1, "3-4"), (2, "wide", "box", 100, 0, "2-3")]
    assert rows(cards.slip_groups(flat), "group_id", "combos") == [(1, ["1-2", "3-4"]), (2, ["2-3"])]
    board = spark.createDataFrame([("r", "h1", 1, 5, 0, ""), ("r", "h2", 0, 5, 0, "")], "race_id string, horse_id string, manual int, pos_x int, excluded int, comment string")
    moved = spark.createDataFrame([("r", "h2", 0, 9, 1, ""), ("r", "h1", 0, 1, 0, " ")], board.schema)
    assert rows(cards.save_board(board, moved), "horse_id", "pos_x") == [("h2", None)]


def test_stalls_and_track(spark):
    trainers = spark.createDataFrame([("t1", "美浦", "山田太郎", None), ("t2", "美浦", "佐藤健一", "佐藤 健一郎"), ("t3", "栗東", "山田太郎", None)], "trainer_id string, stable string, trainer_name string, full_name string")
    stalls = spark.createDataFrame([("2026-01-01", "美浦", "山田 太郎", 10), ("2026-01-01", "美浦", "山田太郎", 8), ("2026-01-01", "美浦", "佐藤健一郎", 20), ("2026-01-01", "美浦", "誰か", 5)], "effective_date string, stable string, trainer_name string, stalls int")
    existing = spark.createDataFrame([("t9", "2026-01-01", "美浦", 1), ("t3", "2026-01-01", "栗東", 7)], "trainer_id string, effective_date string, stable string, stalls int")
    saved, unknown = cards.import_stalls(existing, stalls, trainers)
    assert rows(saved, "trainer_id", "stalls") == [("t1", 18), ("t2", 20), ("t3", 7)] and rows(unknown, "trainer_name") == [("誰か",)]
    columns = "venue_name string, date string, measured_at string, cushion_value double, turf_moisture_goal double, turf_moisture_4corner double, dirt_moisture_goal double, dirt_moisture_4corner double"
    soft = spark.createDataFrame([("中山", "d1", "07:00", 9.0, None, None, None, None), ("中山", "d1", "09:00", 9.5, None, None, None, None)], columns)
    wet = spark.createDataFrame([("中山", "d1", "08:00", None, 12.0, None, 5.0, None), ("阪神", "d1", "08:00", None, 11.0, None, None, None)], columns)
    assert rows(cards.track_day(soft, wet), "venue_name", "measured_at", "cushion_value", "turf_moisture_goal") == [("中山", "09:00", 9.5, 12.0), ("阪神", "08:00", None, 11.0)]


def test_archived_track(spark):
    text = "第1日・第2日 2024年1月5日～1月7日\n金 土 日\n9.1 9.2 9.3\n場所\n10.0 11.0 12.0\n10.1 11.1 12.1\n5.0 5.1 5.2\n6.0 6.1\nend"
    found = rows(track_blocks.text_blocks(spark.createDataFrame([("06", text), ("07", None)], "venue_code string, text string")), "date", "day", "is_pre_meeting_day", "cushion_value", "dirt_moisture_4corner")
    assert found == [("2024-01-05", None, True, 9.1, 6.0), ("2024-01-06", 1, False, 9.2, 6.1), ("2024-01-07", 2, False, 9.3, None)]
    line = lambda n, label, day: ("f", n, 2024, [label, day, "", "A", "", "9.5", "", "10", "11", "5", "6"])
    table = spark.createDataFrame([line(1, "", "12月28日"), line(2, "第1日", "12月29日"), line(3, "第2日", "1月5日"), ("f", 4, 2024, ["x"])], "file string, line_no int, year int, cells array<string>")
    assert rows(track_blocks.table_rows(table), "date", "day", "is_pre_meeting_day") == [("2024-12-28", None, True), ("2024-12-29", 1, False), ("2025-01-05", 2, False)]


def test_page_store_and_viewer(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    pages = spark.createDataFrame([("202606040411", "<p>é</p>"), ("202506040411", None)], "key string, page string")
    assert page_store.put_pages(pages, root, "result").count() == 2
    assert rows(page_store.read_pages(spark, root, "result")) == [("202506040411", ""), ("202606040411", "<p>é</p>")]
    assert [r["key"] for r in page_store.keys(spark, root, "result").collect()] == ["202506040411", "202606040411"]
    for name in ("races", "runs"):
        pages.write.parquet(f"{tmp_path}/db/{name}")
    assert viewer.viewer_copy(spark, f"{tmp_path}/db", f"{tmp_path}/view", ["races", "runs"]) == ["races"]
    assert spark.read.parquet(f"{tmp_path}/view/races").count() == 2

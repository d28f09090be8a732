"""Scalar functions on literal values."""

from furlong.functions import ids, names, scalars, vocab
from pyspark.sql import functions as F


def values(spark, texts, *exprs):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [tuple(r)[1:] if len(exprs) > 1 else r[1] for r in df.select("i", *[e.alias(f"c{n}") for n, e in enumerate(exprs)]).orderBy("i").collect()]



def test_numbers(spark):
    T = F.col("t")  # noqa: N806
    assert values(spark, ["1,234", " 5 ", "x", "", None, "+7"], scalars.to_int(T)) == [1234, 5, None, None, None, 7]
    assert values(spark, ["1,234.5", "---", "0.1"], scalars.to_float(T)) == [1234.5, None, 0.1]
    assert values(spark, ["+18", "-4", "x"], scalars.strict_int(T)) == [(18, None), (-4, None), (None, "x")]
    assert values(spark, ["1343", "5066", "x", None], scalars.seconds_of_digits(T)) == [94.3, 306.6, None, None]
    assert values(spark, ["1:34.3", "58.6", "bad"], scalars.seconds_of_text(T)) == [94.3, 58.6, None]
    assert values(spark, ["94.3", "58.6"], scalars.seconds_text(T.cast("double"))) == ["1:34.3", "0:58.6"]
    assert values(spark, ["498(+4)", "498kg (+4)", "456kg (初出走)", "480", "計不", None], scalars.weight(T)) == [(498, 4), (498, 4), (456, None), (480, None), (None, None), (None, None)]
    assert values(spark, ["牡3", "セ10", "x"], scalars.sex_age(T)) == [("牡", 3), ("セ", 10), (None, None)]
    assert values(spark, ["57☆", "55", "x"], scalars.carried_weight(T)) == [(57.0, "☆"), (55.0, None), (None, None)]
    assert values(spark, ["990万円(他)", "226.8万円", "1,050万円"], scalars.price(T)) == [(990.0, "(他)"), (226.8, None), (1050.0, None)]
    assert values(spark, [" 2- 1- 1- 7", "1-2"], scalars.record(T)) == [[2, 1, 1, 7], None]
    assert values(spark, ["2089万(2)", "0.0  (1)"], scalars.amount_with_count(T)) == [(2089.0, 2), (0.0, 1)]
    assert values(spark, ["3,021,929,000円", "-"], scalars.digits_only(T)) == [3021929000, None]
    assert values(spark, ["17", "24", "54", "99", None], scalars.surface_of(T)) == ["turf", "dirt", "jump", None, None]
    assert values(spark, ["16", "2"], scalars.permutations(T.cast("int"), 3), scalars.combinations(T.cast("int"), 3)) == [(3360, 560), (0, 0)]


def test_texts_and_dates(spark):
    T = F.col("t")  # noqa: N806
    assert values(spark, ["１勝ｸﾗｽ", "(0000000000)", "%1d", " 不明 ", None], scalars.clean(T)) == ["1勝クラス", None, None, None, None]
    assert values(spark, [" a\xa0 b　c\n", None], scalars.normalize_space(T)) == ["a b c", ""]
    assert values(spark, ["2024. 1. 6", "2026.10.25", "2024/01/06"], scalars.dotted_date(T)) == ["2024-01-06", "2026-10-25", None]
    assert values(spark, ["5月3日", "x"], scalars.birth_date(F.lit("2022"), T)) == ["2022-05-03", None]
    assert values(spark, ["生まれ 2019年3月4日"], scalars.long_date(T)) == ["2019-03-04"]
    today = F.lit("2026-01-15").cast("date")
    shown = values(spark, ["12-20", "1-20", "2-29", "4-1"], scalars.infer_year(F.split(T, "-")[0].cast("int"), F.split(T, "-")[1].cast("int"), today).cast("string"))
    assert shown == ["2025-12-20", "2026-01-20", None, "2025-04-01"]
    assert values(spark, ["11-3-7"], scalars.canonical_combo(T), scalars.canonical_combo(T, ordered=True)) == [("3-7-11", "11-3-7")]
    assert values(spark, ["オープン(国際)[指]"], scalars.bracket_tokens(T, {"国際": "国"})) == ["国,指"]


def test_vocabulary(spark):
    T = F.col("t")  # noqa: N806
    assert values(spark, ["1 1/4", "頭", "大差", "取消", None], vocab.margin(T)) == ["1.1/4", "アタマ", "大", None, None]
    assert values(spark, ["A03", "000", "B03", None], vocab.race_conditions(T, F.lit("3"))) == ["混,指,馬齢", "馬齢", None, None]
    assert values(spark, ["未勝利", "500万", "x"], vocab.class_condition(T, F.lit("A23"))) == ["未勝利 牝", "500万下 牝", None]
    assert values(spark, ["G1"], vocab.class_condition(T, F.lit("A03"))) == ["オープン"]
    assert values(spark, ["(栗)山田太郎", "調教師"], vocab.split_stable(T)) == [("栗東", "山田太郎"), (None, "調教師")]
    assert values(spark, ["[外]", "(栗)"], vocab.stable(T)) == ["海外", "栗東"]


def test_ids(spark):
    T = F.col("t")  # noqa: N806
    assert values(spark, ["202606040411", "202699040411", "x"], ids.decode_race_id(T)) == [(2026, "06", 4, 4, 11), None, None]
    assert values(spark, ["06", "99"], ids.compose_race_id(F.lit(2026), T, F.lit(4), F.lit(4), F.lit(11))) == ["202606040411", None]
    assert values(spark, ["202609200604041107"], ids.race_id_of_key18(T), ids.number_of_key18(T)) == [("202606040411", 7)]
    assert values(spark, ["0", "5"], ids.lineage_path(F.lit(3), T.cast("long"))) == ["fff", "mfm"]


def test_names(spark):
    T = F.col("t")  # noqa: N806
    assert values(spark, ["第57回スプリンターズS", "アクアマリンS(3勝)", "シリウスステークス", "天皇賞(秋)", ""], names.plain_name(T)) == ["スプリンターズS", "アクアマリンS", "シリウスS", "天皇賞(秋)", None]
    rows = [
        (1, "皐月賞G1", False, None, None, "06", "turf", "GI"),
        (2, "アクアH1600", True, None, None, "06", "turf", None),
        (3, "500万下・牝*", False, "3歳以上", "500万下 牝", "06", "turf", None),
        (4, "JCG1", False, None, None, "05", "turf", "GI"),
        (5, "スプリンG1", False, None, None, "06", "turf", "GI"),
        (6, "清秋ジャ", False, None, None, "06", "jump", None),
        (7, "紫野特", False, None, None, "08", "turf", None),
        (8, "京成杯", False, None, None, "06", "turf", "GIII"),
        (9, "WASJ第2X", False, None, None, "01", "turf", None),
    ]
    short = spark.createDataFrame(rows, "row int, short string, handicap boolean, age_condition string, class_condition string, venue_code string, surface string, grade string")
    modern = spark.createDataFrame(
        [("06", "turf", "GI", "皐月賞"), ("06", "turf", "GI", "スプリンターズS"), ("09", "turf", "GI", "高松宮スプリント"), ("06", "turf", "GIII", "京成杯"), ("06", "turf", "GIII", "京成杯オータムH"), ("06", "turf", None, "アクアマリンS")],
        "venue_code string, surface string, grade string, name string",
    )
    found = {r["row"]: (r["name"], r["how"]) for r in names.canonical_names(short, modern).collect()}
    assert found == {
        1: ("皐月賞", "matched"),
        2: ("アクアマリンS", "matched"),
        3: ("3歳以上500万下", "generic"),
        4: ("ジャパンC", "override"),
        5: ("スプリンターズS", "matched"),
        6: ("清秋ジャンプS", "stripped"),
        7: ("紫野特別", "stripped"),
        8: ("京成杯", "matched"),
        9: ("ワールドオールスタージョッキーズ第2戦", "override"),
    }

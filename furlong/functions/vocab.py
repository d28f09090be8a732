"""Closed vocabularies. An unknown code is null, never a guess."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words that codes stand for.
GOING = {"良": "良", "稍": "稍重", "重": "重", "不": "不良"}
STABLE = {"栗": "栗東", "美": "美浦", "地": "地方", "外": "海外"}
GRADE = {"G1": "GI", "G2": "GII", "G3": "GIII", "JG1": "JGI", "JG2": "JGII", "JG3": "JGIII", "OP(L)": "L", "リステッド": "L"}
CLASS_CONDITION = {
    "新馬": "新馬", "未勝利": "未勝利", "未出走": "未出走", "1勝": "1勝クラス", "2勝": "2勝クラス", "3勝": "3勝クラス",
    "400万": "400万下", "500万": "500万下", "900万": "900万下", "1000万": "1000万下", "1500万": "1500万下", "1600万": "1600万下",
    "オープン": "オープン", "OP(L)": "オープン", "重賞": "オープン", "G1": "オープン", "G2": "オープン", "G3": "オープン", "JG1": "オープン", "JG2": "オープン", "JG3": "オープン",
}
CLASS_SUFFIX = {"020": "牝", "023": "牝", "024": "牝", "A23": "牝", "A24": "牝", "N21": "牝", "N24": "牝", "N41": "牡・牝", "002": "見習騎手", "M01": "九州産馬", "M03": "九州産馬"}
AGE_CONDITION = {"11": "2歳", "12": "3歳", "13": "3歳以上", "14": "4歳以上", "18": "3歳以上", "19": "4歳以上"}
WEIGHT_TYPE = {"1": "ハンデ", "2": "別定", "3": "馬齢", "4": "定量"}
RACE_SYMBOL = {
    "000": "", "002": "", "020": "", "003": "指", "023": "指", "004": "特指", "024": "特指", "A00": "混", "A03": "混,指", "A23": "混,指", "A04": "混,特指", "A24": "混,特指",
    "M01": "指", "M03": "指", "N00": "国際", "N01": "国際,指", "N03": "国際,指", "N21": "国際,指", "N41": "国際,指", "N04": "国際,特指", "N24": "国際,特指",
}
DIRECTION = {"10": "straight", "11": "left", "12": "left", "17": "right", "18": "right", "21": "right", "23": "left", "24": "right"}
COURSE_DETAIL = {"12": "外", "18": "外", "21": "内2周", "52": "芝 ダート", "54": "芝", "55": "芝 外", "56": "芝 外-内", "57": "芝 内-外"}
FINISH_STATUS = {"1": "取消", "3": "除外", "4": "中止", "7": "降着"}
MARGIN_WORDS = {"頭": "アタマ", "大差": "大"}
MARGIN_DROP = ("取消", "除外", "中止", "降着", "失格")


def lookup(column: Column, words: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in words.items() for x in pair])[F.coalesce(column, F.lit("\0"))]


def grade(column: Column) -> Column:
    return lookup(column, GRADE)


def class_condition(class_name: Column, symbol: Column) -> Column:
    """Class and, by the symbol, its suffix."""
    base = lookup(class_name, CLASS_CONDITION)
    return F.when(base.isNotNull(), F.concat_ws(" ", base, lookup(symbol, CLASS_SUFFIX)))


def race_conditions(symbol: Column, weight_type: Column) -> Column:
    """Symbol and weight type; null unless both are known."""
    prefix, weight = lookup(symbol, RACE_SYMBOL), lookup(weight_type, WEIGHT_TYPE)
    return F.when(prefix.isNotNull() & weight.isNotNull(), F.concat_ws(",", F.nullif(prefix, F.lit("")), weight))


def margin(column: Column) -> Column:
    """1 1/4 as 1.1/4, words put in; a status is no margin."""
    word = F.coalesce(lookup(column, MARGIN_WORDS), column)
    return F.when(~column.isin(*MARGIN_DROP), F.regexp_replace(word, r"^([0-9]+) ([0-9]/[0-9])$", "$1.$2"))


def stable(column: Column) -> Column:
    """(栗) as 栗東; a text that is no code stays."""
    bare = F.regexp_replace(column, r"^[()\[\]]+|[()\[\]]+$", "")
    return F.coalesce(lookup(bare, STABLE), column)


def split_stable(column: Column) -> Column:
    """(栗)氏名 as ``(栗東, 氏名)``."""
    pattern = r"^([(\[][^)\]]*[)\]])(.*)$"
    return F.struct(F.when(column.rlike(pattern), stable(F.regexp_extract(column, pattern, 1))).alias("stable"), F.when(column.rlike(pattern), F.nullif(F.trim(F.regexp_extract(column, pattern, 2)), F.lit(""))).otherwise(column).alias("name"))

"""Scalar functions on text, numbers, dates and lists, as column expressions.

A lenient function gives null for what it cannot read. A strict one gives a
struct ``value, bad``; ``bad`` is the text that could not be read.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Ways to write a missing value.
MISSING = ("", "----", "不明", "%1d", "0000000000", "(0000000000)", "00000000")


@F.pandas_udf(StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    """Unicode NFKC, which has no built-in form; plain ASCII passes as it is."""
    return texts.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))


def strip(column: Column) -> Column:
    """Without Unicode white space at the ends."""
    return F.regexp_replace(column, r"(?U)^\s+|\s+$", "")


def nullable(column: Column) -> Column:
    """Null for the ways to write a missing value; expects normalised text."""
    return F.when(~column.isin(*MISSING), column)


def clean(column: Column) -> Column:
    """NFKC, stripped, missing values null."""
    return nullable(strip(nfkc(column)))


def normalize_space(column: Column) -> Column:
    """Runs of Unicode white space as one space, none at the ends; null as the empty string."""
    return F.trim(F.regexp_replace(F.coalesce(column, F.lit("")), r"(?U)\s+", " "))


def ascii_digits(column: Column) -> Column:
    return F.translate(column, "０１２３４５６７８９", "0123456789")


def _number(column: Column) -> Column:
    return F.replace(F.trim(column), F.lit(","), F.lit(""))


def to_int(column: Column) -> Column:
    """An integer with optional commas; else null."""
    text = _number(column)
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint"))


def to_float(column: Column) -> Column:
    text = _number(column)
    return F.when(text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), text.try_cast("double"))


def strict(column: Column, value: Column) -> Column:
    """Struct of the value read, and the text where there is some that was not read."""
    return F.struct(value.alias("value"), F.when(column.isNotNull() & value.isNull(), column).alias("bad"))


def strict_int(column: Column) -> Column:
    return strict(column, F.when(F.replace(column, F.lit("+"), F.lit("")).rlike("^-?[0-9]+$"), F.replace(column, F.lit("+"), F.lit("")).try_cast("bigint")))


def strict_float(column: Column) -> Column:
    text = F.replace(column, F.lit("+"), F.lit(""))
    return strict(column, F.when(text.rlike(r"^-?([0-9]+\.?[0-9]*|\.[0-9]+)$"), text.try_cast("double")))


def flag(column: Column) -> Column:
    return column.isNotNull().cast("int")


def _found(column: Column, pattern: str, value) -> Column:
    return F.when(column.rlike(pattern), value)


def seconds_of_digits(column: Column) -> Column:
    """Minutes and tenths in one number, such as 1343, as 94.3 seconds."""
    n = column.try_cast("bigint")
    return _found(column, "^[0-9]+$", (F.floor(n / 1000) * 600 + n % 1000) / 10)


def seconds_text(seconds: Column) -> Column:
    """94.3 as 1:34.3."""
    tenths = F.bround(seconds * 10).cast("bigint")
    return F.when(seconds.isNotNull(), F.concat(F.floor(tenths / 600).cast("string"), F.lit(":"), F.lpad(F.floor(tenths % 600 / 10).cast("string"), 2, "0"), F.lit("."), (tenths % 10).cast("string")))


def seconds_of_text(column: Column) -> Column:
    """m:ss.t or ss.t in seconds."""
    text, pattern = F.trim(column), r"^(?:([0-9]+):)?([0-9]+(?:\.[0-9]+)?)$"
    minutes = F.coalesce(F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).try_cast("int"), F.lit(0))
    return _found(text, pattern, F.round(minutes * 60 + F.regexp_extract(text, pattern, 2).try_cast("double"), 1))


def weight(column: Column) -> Column:
    """Struct ``weight, change`` of such as 498kg (+4); a change that is no number is null, as is one not given."""
    text = normalize_space(column)
    pattern = r"^([0-9]+)\s*(?:kg|Kg|KG)?\s*(?:[(（]\s*(?:([+-]?[0-9]+)|[^)）]*?)\s*[)）])?$"
    value = F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 1).try_cast("bigint")).otherwise(to_int(text))
    return F.struct(value.alias("weight"), F.when(text.rlike(pattern), F.nullif(F.regexp_extract(text, pattern, 2), F.lit("")).try_cast("bigint")).alias("change"))


def sex_age(column: Column) -> Column:
    text, pattern = F.trim(column), "^(牡|牝|セ|騸)([0-9]+)$"
    return F.struct(_found(text, pattern, F.regexp_extract(text, pattern, 1)).alias("sex"), _found(text, pattern, F.regexp_extract(text, pattern, 2).try_cast("int")).alias("age"))


def carried_weight(column: Column) -> Column:
    """57☆ as ``(57.0, ☆)``."""
    pattern = r"^([0-9]+(?:\.[0-9]+)?)([^0-9]*)$"
    return F.struct(_found(column, pattern, F.regexp_extract(column, pattern, 1).try_cast("double")).alias("kg"), F.nullif(F.regexp_extract(column, pattern, 2), F.lit("")).alias("mark"))


def price(column: Column) -> Column:
    """226.8万円(他) as ``(226.8, (他))``."""
    pattern = r"^([0-9,]+(?:\.[0-9]+)?)万円(.*)$"
    return F.struct(_found(column, pattern, F.replace(F.regexp_extract(column, pattern, 1), F.lit(","), F.lit("")).try_cast("double")).alias("amount"), F.nullif(F.trim(F.regexp_extract(column, pattern, 2)), F.lit("")).alias("note"))


def record(column: Column) -> Column:
    """ 2- 1- 1- 7 as four integers."""
    parts = F.transform(F.split(column, "-"), lambda x: F.trim(x))
    return F.when((F.size(parts) == 4) & F.forall(parts, lambda x: x.rlike("^[0-9]+$")), F.transform(parts, lambda x: x.cast("int")))


def amount_with_count(column: Column) -> Column:
    """2089万(2) as ``(2089.0, 2)``."""
    pattern = r"^([0-9.]+)\s*万?\s*\(([0-9]+)\)$"
    return F.struct(_found(column, pattern, F.regexp_extract(column, pattern, 1).try_cast("double")).alias("amount"), _found(column, pattern, F.regexp_extract(column, pattern, 2).try_cast("int")).alias("n"))


def digits_only(column: Column) -> Column:
    return F.nullif(F.regexp_replace(column, "[^0-9]", ""), F.lit("")).try_cast("bigint")


def first_float(column: Column) -> Column:
    return F.nullif(F.regexp_extract(column, r"-?[0-9]+(?:\.[0-9]+)?", 0), F.lit("")).try_cast("double")


def surface_of(code: Column) -> Column:
    n = F.when(code.rlike("^[0-9]+$"), code.try_cast("int"))
    return F.when(n.between(10, 22), "turf").when(n.between(23, 29), "dirt").when(n.between(51, 59), "jump")


def prize_sum(a: Column, b: Column) -> Column:
    total = F.round(F.coalesce(a, F.lit(0.0)) + F.coalesce(b, F.lit(0.0)), 1)
    return F.when(total != 0, total)


def combinations(n: Column, k: int) -> Column:
    """n choose k for n up to 20; 0 if there are too few."""
    return F.when(n >= k, F.floor(F.factorial(n.cast("int")) / (F.factorial((n - k).cast("int")) * F.factorial(F.lit(k))))).otherwise(0).cast("bigint")


def permutations(n: Column, k: int) -> Column:
    return F.when(n >= k, F.floor(F.factorial(n.cast("int")) / F.factorial((n - k).cast("int")))).otherwise(0).cast("bigint")


def crc_bucket(column: Column, buckets: int = 1000) -> Column:
    return F.crc32(column.cast("binary")) % buckets


def progress_bar(done: Column, total: Column, width: int = 20) -> Column:
    """Filled part rounded half to even."""
    filled = F.when(total > 0, F.bround(width * done / total)).otherwise(0).cast("int")
    return F.concat(F.repeat(F.lit("#"), filled), F.repeat(F.lit("."), width - filled))


# dates


def _iso(year: Column, month: Column, day: Column) -> Column:
    return F.concat_ws("-", F.lpad(year, 4, "0"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))


def _date_by(column: Column, pattern: str) -> Column:
    return _found(column, pattern, _iso(*[F.regexp_extract(column, pattern, i) for i in (1, 2, 3)]))


def dotted_date(column: Column) -> Column:
    """2024. 1. 6 as 2024-01-06; the calendar is not asked."""
    return _date_by(column, r"^([0-9]{4})\.\s*([0-9]{1,2})\.\s*([0-9]{1,2})$")


def long_date(column: Column) -> Column:
    """2024年1月6日, found anywhere in the text."""
    pattern = "([0-9]{4})年\\s*([0-9]{1,2})月\\s*([0-9]{1,2})日"
    return _found(column, pattern, _iso(*[F.regexp_extract(column, pattern, i) for i in (1, 2, 3)]))


def birth_date(year: Column, month_day: Column) -> Column:
    pattern = "^([0-9]{1,2})月([0-9]{1,2})日$"
    return F.when(year.rlike("^[0-9]+$") & month_day.rlike(pattern), _iso(year, F.regexp_extract(month_day, pattern, 1), F.regexp_extract(month_day, pattern, 2)))


def infer_year(month: Column, day: Column, today: Column, ahead: int = 60) -> Column:
    """The date of a month and day near ``today``: the year before, if it would be over ``ahead`` days ahead or is no date this year."""
    at = lambda year: F.try_to_date(_iso(*[x.cast("string") for x in (year, month, day)]))
    own = at(F.year(today))
    return F.when(own.isNull() | (F.datediff(own, today) > ahead), at(F.year(today) - 1)).otherwise(own)


def months_between(first: Column, last: Column) -> Column:
    """First days of all months from one date to another."""
    return F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month"))


def iso_date(column: Column) -> Column:
    """The text itself if it is a real day written 2024-01-06; else null."""
    return F.when(column.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & F.try_to_date(column).isNotNull(), column)


def days_from(first: Column, n: Column) -> Column:
    """So many days in a row, as texts."""
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.date_add(first, i).cast("string"))


# lists


def ordered_distinct(values: Column) -> Column:
    """The distinct values in the order of their first places."""
    return F.array_distinct(values)


def canonical_combo(column: Column, ordered: bool = False) -> Column:
    """3-11-7 as 3-7-11 where the order does not matter."""
    parts = F.transform(F.split(column, "-"), lambda x: x.cast("int"))
    return F.array_join(F.transform(parts if ordered else F.array_sort(parts), lambda x: x.cast("string")), "-")


def join_present(*columns: Column, by: str = "-") -> Column:
    return F.nullif(F.concat_ws(by, *[c.cast("string") for c in columns]), F.lit(""))


def bracket_tokens(column: Column, aliases: dict[str, str] | None = None) -> Column:
    """Texts in [ ] or ( ), comma-joined, aliases put in."""
    found = F.regexp_extract_all(column, F.lit(r"[\[(（【]([^\])）】]*)[\])）】]"), 1)
    if aliases:
        names = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
        found = F.transform(found, lambda x: F.coalesce(names[x], x))
    return F.array_join(found, ",")


def path_tail(path: Column, prefix: Column) -> Column:
    """What follows ``prefix`` in a path that strictly extends it; else null."""
    return F.when(path.startswith(prefix) & (F.length(path) > F.length(prefix)), F.substring(path, F.length(prefix) + 1, F.length(path)))


def normalize_slips(groups: Column, known_bets: tuple[str, ...]) -> Column:
    """Groups of a known bet with their valid, distinct combinations; amounts not negative, blank kinds null, empty groups gone."""
    tidy = F.transform(
        groups,
        lambda g: F.struct(
            g["bet_type"].alias("bet_type"),
            F.nullif(F.trim(g["kind"]), F.lit("")).alias("kind"),
            F.greatest(F.lit(0), F.coalesce(g["amount"], F.lit(0))).alias("amount"),
            F.array_distinct(F.filter(g["combos"], lambda c: c.rlike("^[0-9]{1,2}(-[0-9]{1,2}){0,2}$"))).alias("combos"),
        ),
    )
    return F.filter(tidy, lambda g: g["bet_type"].isin(*known_bets) & (F.size(g["combos"]) > 0))

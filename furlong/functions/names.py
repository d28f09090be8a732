"""Race names without their additions, and short names matched to modern ones.

The short names of the older source are cut off and carry grades, classes and
marks. What can be told from the name alone is done with column functions; the
match to modern names is a join within stages of ever wider candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furlong.functions.scalars import nfkc
from furlong.session import cut

# Additions of the older source's names, and names that no rule finds.
SUFFIXES = (r"\*$", r"・(?:牝|父|市|若|九|重|[1-3]勝)$", r"(?<=\D)(?:500|900|1000|1500|1600)$", r"J?G[123]$", r"\(L\)$")
HANDICAP_SUFFIX = r"H$"
#: Kanji that stand for one another in names of persons.
VARIANTS = {"髙": "高", "﨑": "崎", "德": "徳", "邊": "辺", "邉": "辺", "濵": "浜", "瀨": "瀬"}
GENERIC = r"^(障害)?・?(新馬|未出走|未勝利|オープ(?:ン)?|[0-9]+万下|[1-3]勝クラス)$"
OVERRIDES = {
    "JC": "ジャパンC",
    "JCダート": "ジャパンCダート",
    "WASJ第1": "ワールドオールスタージョッキーズ第1戦",
    "WASJ第2": "ワールドオールスタージョッキーズ第2戦",
    "WASJ第3": "ワールドオールスタージョッキーズ第3戦",
    "WASJ第4": "ワールドオールスタージョッキーズ第4戦",
}



def person_key(column: Column) -> Column:
    """A person's name to compare by: variant kanji as one, NFKC, no white space."""
    text = F.translate(nfkc(F.translate(column, "".join(VARIANTS), "".join(VARIANTS.values()))), "".join(VARIANTS), "".join(VARIANTS.values()))
    return F.regexp_replace(text, r"(?U)\s+", "")


def split_country(column: Column) -> Column:
    """Struct ``name, country``: a last bracket of at most four characters is the country."""
    pattern = r"^(.+)[(（]([^()（）]{1,4})[)）]$"
    return F.struct(F.when(column.rlike(pattern), F.trim(F.regexp_extract(column, pattern, 1))).otherwise(column).alias("name"), F.when(column.rlike(pattern), F.regexp_extract(column, pattern, 2)).alias("country"))


def plain_name(column: Column) -> Column:
    """A modern name without its number and class; its long last word short."""
    text = F.regexp_replace(F.regexp_replace(F.trim(column), "^第[0-9]+回", ""), r"\((?:[1-3]勝|OP|L)\)$", "")
    text = F.regexp_replace(F.regexp_replace(text, "ステークス$", "S"), "カップ$", "C")
    return F.when(column != "", F.when(text != "", text).otherwise(F.trim(column)))


def strip_suffixes(column: Column, patterns: tuple[str, ...]) -> Column:
    """Take the patterns off the end as long as one fits, never to the empty string: one trailing run of them, behind some first character."""
    run = "|".join(p.removesuffix("$") for p in patterns)
    return F.regexp_replace(column, f"(?<=.)(?:{run})+$", "")


def strip_all(column: Column, handicap: Column) -> Column:
    """A name without its additions; the handicap mark is one only where ``handicap`` holds. Expects normalised text."""
    return F.when(handicap, strip_suffixes(column, (*SUFFIXES, HANDICAP_SUFFIX))).otherwise(strip_suffixes(column, SUFFIXES))


def generic_name(short: Column, age: Column, class_condition: Column, surface: Column) -> Column:
    """A race without a name of its own: age and class, as the modern source writes them; else null."""
    jump = (F.regexp_extract(short, GENERIC, 1) != "") | F.coalesce(surface == "jump", F.lit(False))
    own = F.coalesce(F.nullif(F.element_at(F.split(F.coalesce(class_condition, F.lit("")), " "), 1), F.lit("")), F.regexp_extract(short, GENERIC, 2))
    own = F.when(own.startswith("オープ"), "OP").otherwise(own)
    return F.when(short.rlike(GENERIC), F.concat(F.when(jump, "障害").otherwise(""), F.coalesce(age, F.lit("")), own))


def expand(short: Column, surface: Column) -> Column:
    """Put back the ends that are cut off most."""
    return F.when(short.endswith("特"), F.concat(short, F.lit("別"))).when(surface == "jump", F.regexp_replace(short, "ジャ?$", "ジャンプS")).otherwise(short)


def compare_key(column: Column) -> Column:
    text = F.regexp_replace(nfkc(column), "[‐‑‒–—―−ｰ-]", "-")
    return F.regexp_replace(text, r"(?U)[()（）・\s]", "")


def override(base: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in OVERRIDES.items() for x in pair])
    return F.coalesce(names[base], names[F.regexp_extract(base, "^(WASJ第[0-9])", 1)])


def _staged(rows: DataFrame, pool: DataFrame, short: str) -> DataFrame:
    """``row, match`` by the first stage with a hit: same venue, surface and grade; surface and grade; surface."""
    out, open_rows = None, rows.where(F.col(short) != "").withColumn("_key", compare_key(F.col(short))).where("_key <> ''")
    for keys in (("venue_code", "surface", "grade"), ("surface", "grade"), ("surface",)):
        names = pool.select(*keys, F.col("name").alias("_name"), F.col("name_key").alias("_name_key")).distinct()
        condition = None
        for k in keys:
            part = F.col(f"r.{k}").eqNullSafe(F.col(f"p.{k}"))
            condition = part if condition is None else condition & part
        at = F.instr(F.col("p._name"), F.col(f"r.{short}"))
        hit = (at > 0) | F.col("p._name_key").startswith(F.col("r._key"))
        pairs = open_rows.alias("r").join(names.alias("p"), condition & hit)
        tail = F.when(at > 0, F.substring(F.col("p._name"), at, F.length("p._name"))).otherwise(F.col("p._name"))
        hits = pairs.groupBy("r.row").agg(F.count_distinct(tail).alias("n"), F.min(tail).alias("only"), F.max(F.when(tail == F.col(f"r.{short}"), tail)).alias("exact"))
        own = hits.select("row", F.coalesce("exact", F.when(F.col("n") == 1, F.col("only"))).alias("match"))
        out = own if out is None else out.unionByName(own)
        open_rows = open_rows.join(own.select("row"), "row", "left_anti")
    return out


def canonical_names(rows: DataFrame, modern: DataFrame) -> DataFrame:
    """``row, name, how`` of short names; ``how``: generic, override, matched or stripped.

    ``rows``: row, short, handicap, age_condition, class_condition, venue_code,
    surface, grade. ``modern``: venue_code, surface, grade, name.
    """
    pool = modern.where("name is not null").withColumn("name", nfkc(F.col("name"))).withColumn("name_key", compare_key(F.col("name")))
    base = rows.withColumn("text", F.trim(nfkc(F.coalesce(F.col("short"), F.lit("")))))
    base = base.withColumn("base", strip_all(F.col("text"), F.coalesce(F.col("handicap"), F.lit(False))))
    base = base.withColumn("expanded", expand(F.col("base"), F.col("surface"))).withColumn("no_mark", F.when(~F.coalesce(F.col("handicap"), F.lit(False)) & F.col("base").endswith("H"), F.regexp_replace("base", "H$", "")))
    fixed = generic_name(F.col("base"), F.col("age_condition"), F.col("class_condition"), F.col("surface"))
    base = base.withColumn("generic", fixed).withColumn("override", override(F.col("base")))
    # Each search below reads these rows again; without a cut, so would the plans that made them.
    base = cut(base)
    for column in ("expanded", "base", "no_mark"):
        found = _staged(base.where("generic is null and override is null"), pool, column)
        base = cut(base.join(found.select("row", F.col("match").alias(f"by_{column}")), "row", "left"))
    matched = F.coalesce("by_expanded", "by_base", "by_no_mark")
    name = F.coalesce("generic", "override", matched, "expanded")
    how = F.when(F.col("generic").isNotNull(), "generic").when(F.col("override").isNotNull(), "override").when(matched.isNotNull(), "matched").otherwise("stripped")
    return base.select("row", F.nullif(name, F.lit("")).alias("name"), how.alias("how"))

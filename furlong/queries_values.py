"""Harness queries of the functions on single values: texts, numbers, dates, lists, vocabularies and names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong.functions import ids, names, scalars, vocab
from furlong.registry import Tables, query


def _say(*parts) -> F.Column:
    """Columns and texts, one after the other."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


# texts


@query("""
SELECT event_id, CASE WHEN x IN ('', '----', '不明', '%1d', '0000000000', '(0000000000)', '00000000') THEN NULL ELSE x END AS cleaned
FROM (SELECT event_id, trim(CASE event_id % 6 WHEN 0 THEN ' ---- ' WHEN 1 THEN '不明' WHEN 2 THEN '  ' WHEN 3 THEN '0000000000' WHEN 4 THEN '  ' || event_type || ' ' ELSE props END) AS x FROM events)
""")
def missing_values(t: Tables) -> DataFrame:
    kind = F.col("event_id") % 6
    raw = F.when(kind == 0, " ---- ").when(kind == 1, "不明").when(kind == 2, "  ").when(kind == 3, "0000000000").when(kind == 4, _say("  ", F.col("event_type"), " ")).otherwise(F.col("props"))
    return t.events.select("event_id", scalars.clean(raw).alias("cleaned"))


@query("SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) || '回' AS digits FROM orders")
def fullwidth_digits(t: Tables) -> DataFrame:
    wide = _say(F.translate(F.col("o_orderkey").cast("string"), "0123456789", "０１２３４５６７８９"), "回")
    return t.orders.select("o_orderkey", scalars.ascii_digits(wide).alias("digits"))


@query("""
SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN '栗東' WHEN 1 THEN '美浦' WHEN 2 THEN '地方' END AS stable, s_name AS name FROM supplier
""")
def stable_split(t: Tables) -> DataFrame:
    kind = F.col("s_suppkey") % 4
    raw = F.when(kind == 0, _say("(栗)", F.col("s_name"))).when(kind == 1, _say("[美]", F.col("s_name"))).when(kind == 2, _say("(地) ", F.col("s_name"))).otherwise(F.col("s_name"))
    return t.supplier.select("s_suppkey", vocab.split_stable(raw).alias("x")).select("s_suppkey", "x.stable", "x.name")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, CASE l_partkey % 5 WHEN 0 THEN 'アタマ' WHEN 1 THEN '大' WHEN 2 THEN CAST(l_linenumber AS VARCHAR) || '.1/4' WHEN 3 THEN NULL ELSE CAST(l_linenumber AS VARCHAR) END AS margin FROM lineitem
""")
def margin_words(t: Tables) -> DataFrame:
    kind, n = F.col("l_partkey") % 5, F.col("l_linenumber")
    raw = F.when(kind == 0, "頭").when(kind == 1, "大差").when(kind == 2, _say(n, " 1/4")).when(kind == 3, "除外").otherwise(n.cast("string"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", vocab.margin(raw).alias("margin"))


@query("""
SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'GI' WHEN 1 THEN 'JGII' WHEN 2 THEN 'L' WHEN 3 THEN 'L' END AS grade, lower(hex(encode(p_name))) AS file_key FROM part
""")
def grade_and_file_key(t: Tables) -> DataFrame:
    kind = F.col("p_size") % 5
    raw = F.when(kind == 0, "G1").when(kind == 1, "JG2").when(kind == 2, "OP(L)").when(kind == 3, "リステッド").otherwise("G9")
    return t.part.select("p_partkey", vocab.grade(raw).alias("grade"), ids.hex_key(F.col("p_name")).alias("file_key"))


@query("""
SELECT p_partkey, repeat('#', f) || repeat('.', 20 - f) AS bar FROM (SELECT p_partkey, CAST(round_even(20.0 * (p_size % 50) / 50, 0) AS INT) AS f FROM part)
""")
def progress_bars(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", scalars.progress_bar(F.col("p_size") % 50, F.lit(50)).alias("bar"))


@query("""
SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN '高橋太郎' WHEN 1 THEN '渡辺' || n_name WHEN 2 THEN '高崎A1' ELSE n_name END AS key FROM nation
""")
def variant_name_key(t: Tables) -> DataFrame:
    kind = F.col("n_nationkey") % 4
    raw = F.when(kind == 0, "髙橋　太郎").when(kind == 1, _say("渡邊 ", F.col("n_name"))).when(kind == 2, "髙﨑 Ａ１").otherwise(F.col("n_name"))
    return t.nation.select("n_nationkey", names.person_key(raw).alias("key"))


@query("""
SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_name WHEN 1 THEN c_name ELSE c_name || '(longer)' END AS name, CASE WHEN c_custkey % 3 = 0 THEN 'IRE' END AS country FROM customer
""")
def name_country(t: Tables) -> DataFrame:
    kind = F.col("c_custkey") % 3
    raw = F.when(kind == 0, _say(F.col("c_name"), "(IRE)")).when(kind == 1, F.col("c_name")).otherwise(_say(F.col("c_name"), "(longer)"))
    return t.customer.select("c_custkey", names.split_country(raw).alias("x")).select("c_custkey", "x.name", "x.country")


# numbers


@query("""
SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_id WHEN 1 THEN -event_id END AS n, CASE event_id % 4 WHEN 2 THEN event_id || '.5x' WHEN 3 THEN '--' END AS bad,
  CASE event_id % 4 WHEN 0 THEN CAST(event_id AS DOUBLE) WHEN 1 THEN -CAST(event_id AS DOUBLE) END AS x FROM events
""")
def strict_numbers(t: Tables) -> DataFrame:
    key, kind = F.col("event_id"), F.col("event_id") % 4
    raw = F.when(kind == 0, _say("+", key)).when(kind == 1, _say("-", key)).when(kind == 2, _say(key, ".5x")).otherwise("--")
    rows = t.events.select("event_id", scalars.strict_int(raw).alias("i"), scalars.strict_float(raw).alias("f"))
    return rows.select("event_id", F.col("i.value").alias("n"), "i.bad", F.col("f.value").alias("x"))


@query("""
SELECT o_orderkey, CAST(o_orderkey % 3 = 0 AS INT) AS flag, CASE WHEN c BETWEEN 10 AND 22 THEN 'turf' WHEN c BETWEEN 23 AND 29 THEN 'dirt' WHEN c BETWEEN 51 AND 59 THEN 'jump' END AS surface,
  nullif(round(CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE o_orderkey % 7 + 0.5 END + CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE 0.25 END, 1), 0) AS prize FROM (SELECT *, o_orderkey % 70 AS c FROM orders)
""")
def flags_surfaces_prizes(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    paid = key % 5 != 0
    return t.orders.select("o_orderkey", scalars.flag(F.when(key % 3 == 0, "1")).alias("flag"), scalars.surface_of((key % 70).cast("string")).alias("surface"), scalars.prize_sum(F.when(paid, key % 7 + F.lit(0.5)), F.when(paid, F.lit(0.25))).alias("prize"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, 400 + l_partkey % 200 AS weight, CASE l_partkey % 3 WHEN 0 THEN l_linenumber WHEN 1 THEN -l_linenumber END AS change,
  CASE l_partkey % 4 WHEN 0 THEN '牡' WHEN 1 THEN 'セ' END AS sex, CASE WHEN l_partkey % 4 < 2 THEN CAST(l_linenumber AS INT) END AS age,
  50 + l_linenumber + 0.5 AS kg, CASE WHEN l_partkey % 2 = 0 THEN '☆' END AS mark FROM lineitem
""")
def body_cells(t: Tables) -> DataFrame:
    part, line = F.col("l_partkey"), F.col("l_linenumber")
    change = F.when(part % 3 == 0, _say("(+", line, ")")).when(part % 3 == 1, _say("(-", line, ")")).otherwise("(計不)")
    age = F.when(part % 4 == 0, _say("牡", line)).when(part % 4 == 1, _say(" セ", line, " ")).otherwise("牝")
    carried = _say(50 + line, ".5", F.when(part % 2 == 0, "☆").otherwise(""))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", scalars.weight(_say(400 + part % 200, "kg ", change)).alias("w"), scalars.sex_age(age).alias("s"), scalars.carried_weight(carried).alias("c"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "w.weight", "w.change", "s.sex", "s.age", "c.kg", "c.mark")


@query("""
SELECT o_orderkey, 1000 + k + 0.5 AS amount, CASE WHEN k % 2 = 0 THEN '(他)' END AS note, CASE WHEN k % 3 > 0 THEN CAST(k % 3 AS INT) END AS wins, CASE WHEN k % 3 > 0 THEN 7 END AS others,
  CASE WHEN k % 4 > 0 THEN CAST(k + 1 AS DOUBLE) END AS won, CASE WHEN k % 4 > 0 THEN CAST(k % 9 AS INT) END AS times, 20 + k AS digits, -(k + 0.25) AS first FROM (SELECT o_orderkey, o_orderkey % 800 AS k FROM orders)
""")
def price_and_record_cells(t: Tables) -> DataFrame:
    k = F.col("o_orderkey") % 800
    price = scalars.price(_say(F.regexp_replace((1000 + k).cast("string"), "^1", "1,"), ".5万円", F.when(k % 2 == 0, "(他)").otherwise("")))
    record = scalars.record(F.when(k % 3 > 0, _say(" ", k % 3, "- 1- 1- 7")).otherwise("1-2-x-4"))
    amount = scalars.amount_with_count(F.when(k % 4 > 0, _say(k + 1, "万(", k % 9, ")")).otherwise("none"))
    rows = t.orders.select("o_orderkey", price.alias("p"), record.alias("r"), amount.alias("a"), scalars.digits_only(_say("第", 20 + k, "回")).alias("digits"), scalars.first_float(_say("at -", k, ".25 or 9")).alias("first"))
    return rows.select("o_orderkey", "p.amount", "p.note", F.get("r", F.lit(0)).alias("wins"), F.get("r", F.lit(3)).alias("others"), F.col("a.amount").alias("won"), F.col("a.n").alias("times"), "digits", "first")


# dates


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS dotted, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS long, strftime(o_orderdate, '%Y-%m-%d') AS born, CAST(year(o_orderdate) - o_orderkey % 9 AS INT) AS birth_year FROM orders
""")
def date_forms(t: Tables) -> DataFrame:
    y, m, d = (f("o_orderdate").cast("string") for f in (F.year, F.month, F.dayofmonth))
    horse = _say(F.year("o_orderdate") - F.col("o_orderkey") % 9, "123456")
    long = F.when(F.col("o_orderkey") % 2 == 0, _say("撮影 ", y, "年 ", m, "月", d, "日(土)")).otherwise(_say(m, "月", d, "日"))
    return t.orders.select("o_orderkey", scalars.dotted_date(_say(y, ". ", m, ".", d)).alias("dotted"), scalars.long_date(long).alias("long"), scalars.birth_date(y, _say(m, "月", d, "日")).alias("born"), ids.birth_year(horse).alias("birth_year"))


@query("""
SELECT o_custkey, o_orderkey, CAST(unnest(range(CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 + 1 AS INT), INTERVAL 1 DAY)) AS DATE)::VARCHAR AS date FROM orders
""")
def days_of_meetings(t: Tables) -> DataFrame:
    return t.orders.select("o_custkey", "o_orderkey", F.explode(scalars.days_from(F.to_date("o_orderdate"), (F.col("o_orderkey") % 3 + 1).cast("int"))).alias("date"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN strftime(o_orderdate, '%Y-%m-%d') END AS date FROM orders
""")
def date_arguments(t: Tables) -> DataFrame:
    """What a command takes for a date: ISO, a real day, nothing else."""
    own, kind = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderkey") % 4
    raw = F.when(kind < 2, own).when(kind == 2, _say(F.substring(own, 1, 8), "32")).otherwise(F.replace(own, F.lit("-"), F.lit("/")))
    return t.orders.select("o_orderkey", scalars.iso_date(raw).alias("date"))


# lists


@query("""
SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN '指定,' || p_brand WHEN 1 THEN p_brand ELSE '' END AS tokens, CASE WHEN p_size % 3 = 0 THEN 'b,a' ELSE 'c' END AS first_seen FROM part
""")
def bracket_token_lists(t: Tables) -> DataFrame:
    kind = F.col("p_size") % 3
    raw = F.when(kind == 0, _say("x[指](", F.col("p_brand"), ")")).when(kind == 1, _say("【", F.col("p_brand"), "】y")).otherwise("none")
    seen = F.when(kind == 0, F.array(*map(F.lit, "baba"))).otherwise(F.array(F.lit("c"), F.lit("c")))
    return t.part.select("p_partkey", scalars.bracket_tokens(raw, {"指": "指定"}).alias("tokens"), F.array_join(scalars.ordered_distinct(seen), ",").alias("first_seen"))


@query("""
SELECT o_orderkey, lpad(CAST(o_orderkey % 28 + 1 AS VARCHAR), 2, '0') AS day, CAST(year(o_orderdate) AS VARCHAR) || v || '0102' || lpad(CAST(o_orderkey % 12 + 1 AS VARCHAR), 2, '0') AS race_id, CAST(o_orderkey % 18 AS INT) AS number, v BETWEEN '01' AND '10' AS valid
FROM (SELECT *, lpad(CAST(o_custkey % 12 + 1 AS VARCHAR), 2, '0') AS v FROM orders)
""")
def run_keys(t: Tables) -> DataFrame:
    pad = lambda c: F.lpad(c.cast("string"), 2, "0")
    key = F.col("o_orderkey")
    day = pad(key % 28 + 1)
    full = F.concat(F.date_format("o_orderdate", "yyyyMM"), day, pad(F.col("o_custkey") % 12 + 1), F.lit("0102"), pad(key % 12 + 1), pad(key % 18))
    race = ids.race_id_of_key18(full)
    return t.orders.select("o_orderkey", day.alias("day"), race.alias("race_id"), ids.number_of_key18(full).alias("number"), ids.is_race_id(race).alias("valid"))


# vocabularies and names


@query("""
SELECT o_orderkey, CASE k % 4 WHEN 0 THEN '未勝利 牝' WHEN 1 THEN '1勝クラス' WHEN 2 THEN 'オープン 九州産馬' END AS class_condition, CASE k % 3 WHEN 0 THEN '混,指,別定' WHEN 1 THEN '定量' END AS conditions,
  CASE k % 3 WHEN 0 THEN '3歳以上' WHEN 1 THEN '2歳' END AS age, CASE k % 2 WHEN 0 THEN 'left' ELSE 'straight' END AS direction FROM (SELECT o_orderkey, o_orderkey AS k FROM orders)
""")
def race_vocabulary(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    name = F.when(k % 4 == 0, "未勝利").when(k % 4 == 1, "1勝").when(k % 4 == 2, "G1").otherwise("what")
    symbol = F.when(k % 4 == 0, "023").when(k % 4 == 2, "M01").otherwise("000")
    mark, weight = F.when(k % 3 == 0, "A03").when(k % 3 == 1, "000").otherwise("ZZZ"), F.when(k % 3 == 0, "2").otherwise("4")
    age, way = F.when(k % 3 == 0, "18").when(k % 3 == 1, "11").otherwise("99"), F.when(k % 2 == 0, "23").otherwise("10")
    return t.orders.select("o_orderkey", vocab.class_condition(name, symbol).alias("class_condition"), vocab.race_conditions(mark, weight).alias("conditions"), vocab.lookup(age, vocab.AGE_CONDITION).alias("age"), vocab.lookup(way, vocab.DIRECTION).alias("direction"))


@query("""
SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_brand || 'S' WHEN 1 THEN p_brand || 'C' ELSE p_brand || '記念' END AS plain, CASE p_partkey % 3 WHEN 0 THEN p_brand || '特別' WHEN 1 THEN p_brand || 'ジャンプS' ELSE p_brand || 'H' END AS expanded,
  CASE p_partkey % 3 WHEN 0 THEN '3歳未勝利' WHEN 1 THEN '障害4歳以上OP' END AS generic, CASE p_partkey % 3 WHEN 0 THEN 'ジャパンC' WHEN 1 THEN 'ワールドオールスタージョッキーズ第2戦' END AS override, replace(p_brand, '#', '#') || '-x' AS key FROM part
""")
def race_name_forms(t: Tables) -> DataFrame:
    k, brand = F.col("p_partkey") % 3, F.col("p_brand")
    modern = F.when(k == 0, _say("第12回", brand, "ステークス(2勝)")).when(k == 1, _say(brand, "カップ(L)")).otherwise(_say("第3回", brand, "記念"))
    short, surface = F.when(k == 0, _say(brand, "特")).when(k == 1, _say(brand, "ジャ")).otherwise(_say(brand, "H")), F.when(k == 1, "jump").otherwise("turf")
    bare = F.when(k == 0, "未勝利").when(k == 1, "障害オープ").otherwise(brand)
    generic = names.generic_name(bare, F.when(k == 0, "3歳").otherwise("4歳以上"), F.when(k == 0, "未勝利 牝"), surface)
    override = names.override(F.when(k == 0, "JC").when(k == 1, "WASJ第2戦").otherwise(brand))
    return t.part.select("p_partkey", names.plain_name(modern).alias("plain"), names.expand(short, surface).alias("expanded"), generic.alias("generic"), override.alias("override"), names.compare_key(_say("（", brand, "）・ ‐x")).alias("key"))

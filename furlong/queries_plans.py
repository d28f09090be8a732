"""Harness queries of the plans: mutations of many tables, lists, coverage over time, and look-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from furlong.operators import coverage, lineage, resolve, upsert
from furlong.plans import cards, reports, store
from furlong.registry import Tables, query
from furlong.streaming import incremental


def _day(column: str) -> F.Column:
    return F.date_format(column, "yyyy-MM-dd")


# mutations


@query("""
WITH e AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 2 = 0), i AS (SELECT o_orderkey, o_custkey, CASE o_orderkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 3 THEN '?' END AS mark FROM orders WHERE o_orderkey % 3 = 0)
SELECT race_id, horse_id, mark FROM (SELECT o_orderkey AS race_id, o_custkey AS horse_id, 'old' AS mark FROM e WHERE o_orderkey NOT IN (SELECT o_orderkey FROM i) UNION ALL SELECT o_orderkey, o_custkey, mark FROM i WHERE mark IN ('A', 'B'))
""")
def marks_with_deletion(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    old = t.orders.where("o_orderkey % 2 = 0").select(key.alias("race_id"), F.col("o_custkey").alias("horse_id"), F.lit("old").alias("mark"))
    new = t.orders.where("o_orderkey % 3 = 0").select(key.alias("race_id"), F.col("o_custkey").alias("horse_id"), F.when(key % 4 == 0, "A").when(key % 4 == 1, "B").when(key % 4 == 3, "?").alias("mark"))
    return cards.save_marks(old, new, ("A", "B"))


@query("""
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'F' UNION ALL SELECT o_orderkey + 10000000, 'F', o_totalprice FROM orders WHERE o_totalprice > 200000
""")
def rebuild_one_source(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    fresh = t.orders.where("o_totalprice > 200000").select((F.col("o_orderkey") + 10000000).alias("o_orderkey"), F.lit("F").alias("o_orderstatus"), "o_totalprice")
    return upsert.rebuild_where(rows, F.col("o_orderstatus") == "F", fresh)


@query("SELECT * FROM supplier WHERE s_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)")
def clear_keys(t: Tables) -> DataFrame:
    return upsert.delete_keys(t.supplier, t.nation.where("n_regionkey = 2").select(F.col("n_nationkey").alias("s_nationkey")), ["s_nationkey"])


@query("""
SELECT c_custkey, c_name, coalesce(CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END, CASE WHEN c_custkey % 2 = 0 THEN n_name END) AS key FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
""")
def fill_missing_keys(t: Tables) -> DataFrame:
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    rows = rows.select("c_custkey", "c_name", F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("@"), "n_name")).alias("name"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).alias("key"))
    owners = t.nation.select(F.concat(F.lit("@"), "n_name").alias("name"), F.col("n_name").alias("entity_key"))
    return resolve.with_keys(rows, owners, {"name": "key"}, only_missing=True).drop("name")


@query("""
WITH e AS (SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN '栗東' END AS stable, s_name, 'old' AS full_name FROM supplier WHERE s_suppkey % 5 <> 0), i AS (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN '美浦' END AS stable, upper(s_name) AS full_name FROM supplier WHERE s_suppkey % 7 <> 0)
SELECT coalesce(e.s_suppkey, i.s_suppkey) AS trainer_id, s_name AS trainer_name, coalesce(i.stable, e.stable) AS stable, coalesce(i.full_name, e.full_name) AS full_name, CASE WHEN i.s_suppkey IS NOT NULL THEN 'now' END AS updated_at FROM e FULL JOIN i ON e.s_suppkey = i.s_suppkey
""")
def trainer_profiles(t: Tables) -> DataFrame:
    key = F.col("s_suppkey")
    old = t.supplier.where("s_suppkey % 5 <> 0").select(key.alias("trainer_id"), F.col("s_name").alias("trainer_name"), F.when(key % 2 == 0, "栗東").alias("stable"), F.lit("old").alias("full_name"), F.lit(None).cast("string").alias("updated_at"))
    new = t.supplier.where("s_suppkey % 7 <> 0").select(key.alias("trainer_id"), F.when(key % 3 == 0, "美浦").alias("stable"), F.upper("s_name").alias("full_name"))
    return store.save_trainer_profiles(old, new, F.lit("now"))


@query("""
SELECT p_partkey AS horse_id, CASE WHEN p_partkey % 3 = 0 THEN p_name WHEN p_size % 2 = 0 THEN p_brand END AS sire, CASE WHEN p_partkey % 4 = 0 THEN 'dam' WHEN p_size % 3 = 0 THEN p_type ELSE '' END AS dam,
  CASE WHEN p_size % 5 = 0 THEN upper(p_name) END AS broodmare_sire FROM part
""")
def close_family(t: Tables) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    horses = t.part.select(key.alias("horse_id"), F.when(key % 3 == 0, F.col("p_name")).alias("sire"), F.when(key % 4 == 0, "dam").otherwise("").alias("dam"), F.lit(None).cast("string").alias("broodmare_sire"))
    cells = F.array(*[F.struct(F.lit(p).alias("path"), v.alias("name")) for p, v in (("f", F.when(size % 2 == 0, F.col("p_brand"))), ("m", F.when(size % 3 == 0, F.col("p_type"))), ("mf", F.when(size % 5 == 0, F.upper("p_name"))), ("ff", F.col("p_name")))])
    return store.fill_close_family(horses, t.part.select(key.alias("horse_id"), F.explode(cells).alias("x")).select("horse_id", "x.*"))


@query("""
WITH j AS (SELECT l_orderkey AS race_id, l_linenumber AS umaban, l_suppkey, l_partkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC) AS nth FROM lineitem)
SELECT 'jockeys' AS tbl, CAST(l_suppkey AS VARCHAR) AS id, 'J' || l_partkey AS name FROM j WHERE nth = 1
UNION ALL SELECT 'races', CAST(o_orderkey AS VARCHAR), CASE WHEN o_orderkey % 2 = 0 THEN 'old' ELSE 'new' END FROM orders
UNION ALL SELECT 'entries', CAST(l_orderkey AS VARCHAR), CAST(count(*) AS VARCHAR) FROM lineitem GROUP BY l_orderkey
UNION ALL SELECT 'payouts', CAST(o_orderkey AS VARCHAR), 'left' FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 > 0)
UNION ALL SELECT 'payouts', CAST(o_orderkey AS VARCHAR), 'paid' FROM orders WHERE o_orderkey % 3 = 1
""")
def save_pages(t: Tables) -> DataFrame:
    """Orders as result pages, of which every third is not read again; their lines as entries. Read back: who rides, when a race was first fetched, entries and payouts of each race."""
    text = lambda c: F.col(c).cast("string")
    people = "race_id string, seq int, umaban int, horse_id string, horse_name string, sex string, jockey_id string, jockey_name string, trainer_id string, trainer_name string, trainer_stable string, owner_id string, owner_name string"
    schemas = {
        "races": "race_id string, race_date string, race_name string, race_name_plain string, fetched_at string, updated_at string",
        "horses": "horse_id string, horse_name string, sex string, updated_at string",
        "jockeys": "jockey_id string, jockey_name string, updated_at string",
        "trainers": "trainer_id string, trainer_name string, stable string, updated_at string",
        "owners": "owner_id string, owner_name string, updated_at string",
        "entries": "race_id string, umaban int, horse_id string, jockey_id string, kinryo_mark string",
        "results": "race_id string, umaban int, horse_id string",
        "payouts": "race_id string, bet_type string",
        "race_laps": "race_id string, seq int",
    }
    core = store.create(t.spark, schemas)
    race = F.concat(F.lit("R"), text("o_orderkey"))
    core["races"] = t.orders.where("o_orderkey % 2 = 0").select(race.alias("race_id"), _day("o_orderdate").alias("race_date"), F.lit("x").alias("race_name"), F.lit("x").alias("race_name_plain"), F.lit("old").alias("fetched_at"), F.lit("old").alias("updated_at"))
    core["payouts"] = t.orders.select(race.alias("race_id"), F.lit("left").alias("bet_type"))
    lines = t.lineitem.select(F.concat(F.lit("R"), text("l_orderkey")).alias("race_id"), F.col("l_orderkey").alias("no"), "l_linenumber", "l_suppkey", "l_partkey")
    core["entries"] = lines.where("no % 3 = 0").select("race_id", F.col("l_linenumber").cast("int").alias("umaban"), F.lit(None).cast("string").alias("horse_id"), F.lit(None).cast("string").alias("jockey_id"), F.lit(None).cast("string").alias("kinryo_mark"))
    # Races come in the order of their ids, which are texts: numbers of one length keep the order.
    wide = F.lpad(F.col("no").cast("string"), 12, "0")
    entries = lines.select(wide.alias("race_id"), (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).cast("int").alias("seq"), F.col("l_linenumber").cast("int").alias("umaban"), F.lit(None).cast("string").alias("horse_id"), F.col("l_suppkey").cast("string").alias("jockey_id"), F.concat(F.lit("J"), F.col("l_partkey").cast("string")).alias("jockey_name"))
    whole = t.spark.createDataFrame([], people).unionByName(entries, allowMissingColumns=True)
    riders = store._people(whole, "jockey_id", ("jockey_name",), F.lit("now"))
    fresh = t.orders.where("o_orderkey % 3 > 0")
    pages = {
        "races": t.orders.select(race.alias("race_id"), _day("o_orderdate").alias("race_date"), F.lit("y").alias("race_name")),
        "entries": t.spark.createDataFrame([], people).unionByName(lines.where("no % 3 > 0").select("race_id", F.col("l_linenumber").cast("int").alias("umaban"), F.col("l_linenumber").cast("int").alias("seq")), allowMissingColumns=True),
        "results": core["results"],
        "laps": t.spark.createDataFrame([], "race_id string, seq int"),
        "payouts": fresh.where("o_orderkey % 3 = 1").select(race.alias("race_id"), F.lit("paid").alias("bet_type")),
    }
    read = {**pages, "races": pages["races"].join(fresh.select(race.alias("race_id")), "race_id", "left_semi")}
    saved = store.save_result_pages(core, read, F.lit("new"))
    # Races that are not read again are saved by themselves, for the time of their first fetch.
    races = store.save_result_pages({**saved, "payouts": core["payouts"]}, {**pages, "entries": whole.limit(0), "payouts": pages["payouts"].limit(0)}, F.lit("new"))["races"]
    plain = lambda df, name, value: df.select(F.lit(name).alias("tbl"), F.expr("substring(race_id, 2)").alias("id"), value.alias("name"))
    counted = saved["entries"].groupBy("race_id").agg(F.count("*").cast("string").alias("n"))
    out = riders.select(F.lit("jockeys").alias("tbl"), F.col("jockey_id").alias("id"), F.col("jockey_name").alias("name"))
    return out.unionByName(plain(races, "races", F.col("fetched_at"))).unionByName(plain(counted, "entries", F.col("n"))).unionByName(plain(saved["payouts"], "payouts", F.col("bet_type")))


@query("""
SELECT CAST(doc_id AS VARCHAR) || '.csv' AS file_name FROM documents WHERE doc_id % 3 <> 0 OR doc_id % 2 = 0
""")
def changed_files(t: Tables) -> DataFrame:
    """Files are documents; of those with an id that three divides, the odd ones are in the manifest as they are and the even ones with another hash."""
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".csv"))
    files = t.documents.select(name.alias("file_name"), F.sha2("text", 256).alias("sha256"))
    known = t.documents.where("doc_id % 3 = 0").select(name.alias("file_name"), F.when(F.col("doc_id") % 2 == 1, F.sha2("text", 256)).otherwise("old").alias("sha256"))
    return store.files_to_load(files, known).select("file_name")


@query("""
SELECT run_id, command, CASE WHEN run_id = 1 THEN 'ok' ELSE 'running' END AS status, CASE WHEN run_id = 1 THEN (SELECT count(*) FROM orders) END AS n_races_saved, CASE WHEN run_id = 1 THEN (SELECT count(*) FROM events WHERE value < 0) END AS n_warnings
FROM (VALUES (1, 'update'), (2, 'odds')) v(run_id, command)
""")
def audit_of_runs(t: Tables) -> DataFrame:
    tables = store.create(t.spark, {})
    runs, first = store.start_run(tables["runs"], "update", "", "t0")
    runs, _ = store.start_run(runs, "odds", "", "t1")
    warnings = store.log(tables["parse_warnings"], t.events.where("value < 0").select(F.col("event_id").cast("string").alias("key"), F.lit("negative").alias("message")), first, F.lit("t2"))
    runs = store.finish_run(runs, first, "ok", "t3", n_races_saved=t.orders.count(), n_warnings=warnings.where(F.col("run_id") == first).count())
    return runs.select("run_id", "command", "status", "n_races_saved", "n_warnings")


@query("SELECT n_nationkey, n_name, n_regionkey, NULL AS capital, NULL AS people FROM nation")
def additive_migration(t: Tables) -> DataFrame:
    wanted = {"nation": "n_nationkey long, n_name string, capital string, people long", "extra": "id long"}
    out = store.migrate({"nation": t.nation.select("n_nationkey", "n_name", "n_regionkey")}, wanted)
    return out["nation"].join(out["extra"], out["nation"]["n_nationkey"] == out["extra"]["id"], "left_anti")


# groups and lists


@query("SELECT l_orderkey, count(*) FILTER (l_returnflag NOT IN ('A', 'R')) AS runners FROM lineitem GROUP BY l_orderkey")
def runner_counts(t: Tables) -> DataFrame:
    return coverage.conditional_counts(t.lineitem, {"runners": ~F.col("l_returnflag").isin("A", "R")}, ["l_orderkey"])


@query("""
WITH x AS (SELECT o_orderkey AS race_id, CASE o_orderkey % 3 WHEN 0 THEN [1, 2] WHEN 1 THEN [2] ELSE [1] END AS kept FROM orders)
SELECT race_id, group_id, CASE WHEN group_id = 2 OR len(kept) = 1 AND kept[1] = 2 THEN 'wide' ELSE 'tansho' END AS bet_type, CASE WHEN group_id = 2 OR len(kept) = 1 AND kept[1] = 2 THEN '1-2,3-4' ELSE '7' END AS combos
FROM (SELECT race_id, kept, unnest(range(1, len(kept) + 1)) AS group_id FROM x)
""")
def bet_slips(t: Tables) -> DataFrame:
    """Groups of two bets and one that no page knows; every third race lacks the first, every third the second."""
    group = lambda bet, combos: F.struct(F.lit(bet).alias("bet_type"), F.lit(" ").alias("kind"), F.lit(-5).alias("amount"), F.array(*map(F.lit, combos)).alias("combos"))
    key = F.col("o_orderkey") % 3
    groups = F.array(group("nothing", ["1"]), F.when(key != 1, group("tansho", ["7", "7", "x"])).otherwise(group("tansho", ["x"])), F.when(key != 2, group("wide", ["1-2", "1-2-", "3-4"])).otherwise(group("wide", [])))
    slips = cards.slip_groups(cards.slip_rows(t.orders.select(F.col("o_orderkey").alias("race_id"), groups.alias("groups"))))
    return slips.where("kind is null and amount = 0").select("race_id", "group_id", "bet_type", F.array_join("combos", ",").alias("combos"))


@query("""
SELECT c_mktsegment AS stable, CAST(n_nationkey AS VARCHAR) AS trainer_id, CAST(count(*) AS INT) AS stalls FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL
""")
def stalls_by_trainer(t: Tables) -> DataFrame:
    """A stall for each customer; the names are written with spaces here and without them there."""
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    stalls = rows.select(F.lit("2026-03-04").alias("effective_date"), F.col("c_mktsegment").alias("stable"), F.concat(F.lit("髙 "), "n_name").alias("trainer_name"), F.lit(1).alias("stalls"))
    trainers = rows.select(F.col("n_nationkey").cast("string").alias("trainer_id"), F.col("c_mktsegment").alias("stable"), F.concat(F.lit("高"), F.regexp_replace("n_name", " ", "")).alias("full_name"), F.lit("none").alias("trainer_name")).distinct()
    empty = t.spark.createDataFrame([], "trainer_id string, effective_date string, stable string, stalls int")
    return cards.import_stalls(empty, stalls, trainers)[0].select("stable", "trainer_id", "stalls")


@query("""
SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, count(*) AS n, avg(k) AS mean_cells, count(*) FILTER (k = 7) AS full FROM (SELECT o_orderkey, o_orderdate, count(*) AS k FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL) GROUP BY 1
""")
def filled_by_birth_year(t: Tables) -> DataFrame:
    rows = t.orders.join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"))
    built = rows.select(F.concat(F.year("o_orderdate").cast("string"), F.col("o_orderkey").cast("string")).alias("id"))
    return lineage.by_birth_year(built, full=7).select("year", "n", "mean_cells", "full")


@query("""
WITH c AS (SELECT p_type, p_brand, count(*) FILTER (p_size > 25) AS recent, count(*) AS total FROM part GROUP BY ALL)
SELECT p_type AS entity_key, arg_min(p_brand, (-recent, -total, p_brand)) AS name FROM (SELECT p.p_type, p.p_brand, u.recent, u.total FROM (SELECT DISTINCT p_type, p_brand FROM part) p JOIN (SELECT p_brand, sum(recent) AS recent, sum(total) AS total FROM c GROUP BY 1) u USING (p_brand)) GROUP BY p_type
""")
def canonical_spelling(t: Tables) -> DataFrame:
    resolved = t.part.select(F.col("p_type").alias("entity_key"), F.lit("name").alias("kind"), F.col("p_brand").alias("value")).distinct()
    return resolve.canonical_names(resolved, resolve.usage(t.part, ["p_brand"], F.col("p_size") > 25))


@query("""
SELECT l_orderkey AS breed_no, min(l_partkey) AS ancestor FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_partkey) = 1
""")
def number_of_ancestor(t: Tables) -> DataFrame:
    rows = t.lineitem.select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("id"), F.lit("f").alias("path"), "l_partkey", "l_orderkey").distinct()
    trees = rows.select("id", "path", F.col("l_partkey").alias("ancestor"))
    return lineage.number_map(trees, rows.select("id", "path", F.col("l_orderkey").alias("breed_no"), F.lit(None).cast("string").alias("name")))


@query("""
WITH y AS (SELECT DISTINCT year(o_orderdate) AS year FROM orders ORDER BY 1 DESC LIMIT 3),
l AS (SELECT CAST(c_nationkey AS VARCHAR) AS name, max(year(o_orderdate)) AS latest_year, count(*) AS n_units FROM orders JOIN customer ON c_custkey = o_custkey WHERE year(o_orderdate) IN (SELECT year FROM y) AND c_nationkey < 20 GROUP BY 1),
o AS (SELECT CAST(s_nationkey AS VARCHAR) AS name, count(*) AS local_rows FROM supplier WHERE s_nationkey > 4 GROUP BY 1)
SELECT coalesce(l.name, o.name) AS name, CAST(latest_year AS INT) AS latest_year, coalesce(n_units, 0) AS n_units, l.name IS NOT NULL AS in_leading, local_rows,
  row_number() OVER (ORDER BY coalesce(latest_year, 0) DESC, coalesce(n_units, 0) DESC, coalesce(local_rows, 0) DESC, coalesce(l.name, o.name)) AS place FROM l FULL JOIN o ON l.name = o.name
""")
def leading_list(t: Tables) -> DataFrame:
    rows = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).where("c_nationkey < 20")
    lead = rows.groupBy(F.col("c_nationkey").cast("string").alias("name"), F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n_units"))
    years = reports.recent_years(t.orders.select(F.year("o_orderdate").alias("year")), 3)
    listed = reports.leading_list(lead, years, t.supplier.where("s_nationkey > 4").select(F.col("s_nationkey").cast("string").alias("name")))
    # Few rows, and their order is the result.
    return listed.withColumn("place", F.row_number().over(Window.orderBy(F.monotonically_increasing_id())))


@query("SELECT year(o_orderdate) AS year, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_nationkey = 3 AND year(o_orderdate) IN (SELECT DISTINCT year(o_orderdate) FROM orders ORDER BY 1 DESC LIMIT 4) GROUP BY 1")
def years_of_an_entity(t: Tables) -> DataFrame:
    rows = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).groupBy(F.col("c_nationkey").cast("string").alias("name"), F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"))
    return reports.entity_years(rows, "3", reports.recent_years(t.orders.select(F.year("o_orderdate").alias("year")), 4)).select("year", "n")


@query("SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL")
def nested_lookup(t: Tables) -> DataFrame:
    """Counts as one map for each customer, and taken out of it again."""
    rows = t.orders.groupBy("o_custkey", "o_orderpriority").agg(F.count("*").alias("n"))
    return reports.nested(rows, ["o_custkey"], "o_orderpriority", "n").select("o_custkey", F.explode("values").alias("o_orderpriority", "n"))


# coverage over time


RECENT = "EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '1998-01-01') OR EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)"


def _recent(t: Tables) -> tuple:
    runs = t.orders.select(F.col("o_custkey").alias("c_custkey"), _day("o_orderdate").alias("day"))
    return t.customer, "c_custkey", runs, "day", "1998-01-01", t.events.select(F.col("user_id").alias("c_custkey"))


@query(f"SELECT count(*) AS total, count(*) FILTER (c_acctbal > 0) AS rich, count(*) FILTER (EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = c_custkey)) AS supplies FROM customer WHERE {RECENT}")
def recent_coverage(t: Tables) -> DataFrame:
    return reports.recent_counts(*_recent(t), {"rich": F.col("c_acctbal") > 0}, {"supplies": t.supplier.select(F.col("s_suppkey").alias("c_custkey"))})


@query(f"SELECT c_custkey, c_name FROM customer WHERE ({RECENT}) AND c_custkey NOT IN (SELECT s_suppkey FROM supplier)")
def recent_lacking(t: Tables) -> DataFrame:
    return reports.recent_lacking(*_recent(t), t.supplier.select(F.col("s_suppkey").alias("c_custkey"))).select("c_custkey", "c_name")


@query("SELECT CAST(greatest(CAST(max(o_orderdate) AS DATE) - 7, DATE '1998-08-20' - 60) AS VARCHAR) AS first_day, '1998-08-18' AS last_day FROM orders")
def days_to_update(t: Tables) -> DataFrame:
    return incremental.update_range(t.orders, "o_orderdate", "1998-08-20").select(*[F.col(c).cast("string").alias(c) for c in ("first_day", "last_day")])


@query("""
SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) <= count(*) FILTER (o_orderstatus = 'F') OR (DATE '1998-06-01' - min(CAST(o_orderdate AS DATE)) >= 3 AND count(*) <= count(*) FILTER (o_orderstatus IN ('F', 'O'))) AS complete FROM orders GROUP BY 1
""")
def complete_days(t: Tables) -> DataFrame:
    days = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("listed"), F.count_if(F.col("o_orderstatus") == "F").alias("saved"), F.count_if(F.col("o_orderstatus") == "O").alias("gone"))
    return days.select(F.col("day").cast("string").alias("day"), incremental.day_complete(F.col("listed"), F.col("saved"), F.col("gone"), F.col("day"), F.lit("1998-06-01").cast("date")).alias("complete"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 30)")
def pending_work(t: Tables) -> DataFrame:
    done = t.lineitem.where("l_quantity > 30").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return incremental.pending(t.orders.select("o_orderkey"), done, ["o_orderkey"])


@query("""
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 100 + 400 ELSE CASE WHEN o_custkey % 3 > 0 THEN o_custkey % 50 + 300 END END AS weight, CASE WHEN o_custkey % 4 = 0 THEN '☆' END AS mark FROM orders
""")
def carried_over_entries(t: Tables) -> DataFrame:
    """Cards whose official weights and marks are carried over to the entries that replace them: by horse, by horse and jockey."""
    order, customer = F.col("o_orderkey"), F.col("o_custkey")
    base = [order.cast("string").alias("race_id"), F.lit(1).alias("seq"), customer.cast("string").alias("horse_id"), F.concat(F.lit("H"), customer.cast("string")).alias("horse_name"), F.lit("j").alias("jockey_id")]
    old = t.orders.select(*base, F.when(customer % 3 > 0, customer % 50 + 300).cast("int").alias("horse_weight"), F.lit(2).alias("weight_diff"), F.when(customer % 4 == 0, "☆").alias("kinryo_mark"))
    new = t.orders.select(*base, F.when(order % 2 == 0, order % 100 + 400).cast("int").alias("horse_weight"), F.lit(None).cast("int").alias("weight_diff"), F.lit(None).cast("string").alias("kinryo_mark"))
    saved = cards.save_upcoming_entries(old, new)
    return saved.select(F.col("race_id").cast("long").alias("o_orderkey"), F.col("horse_id").cast("long").alias("o_custkey"), F.col("horse_weight").alias("weight"), F.col("kinryo_mark").alias("mark"))


# links


def _tokens(t: Tables) -> DataFrame:
    """Links of order pages: two tokens a line, one of them of another meeting, each twice."""
    pad = lambda c: F.lpad(c.cast("string"), 2, "0")
    lines = t.lineitem.groupBy("l_orderkey").agg(F.max("l_linenumber").alias("n_lines")).withColumn("line", F.explode(F.sequence(F.lit(1), F.col("n_lines").cast("int"))))
    rows = lines.withColumn("again", F.explode(F.sequence(F.lit(0), F.lit(1)))).withColumn("day", F.when(F.col("line") % 3 == 0, 9).otherwise(1))
    race = F.concat(F.lit("199801"), pad(F.lit(1)), pad(F.col("day")), pad(F.col("line")))
    digit = F.element_at(F.array(*map(F.lit, ("1", "3", "5"))), (F.col("line") % 3 + 1).cast("int"))
    token = F.concat(F.lit("pw15"), digit, F.lit("ou"), F.col("l_orderkey").cast("string"), F.lit("x"), F.col("line").cast("string"))
    return rows.select(F.col("l_orderkey").alias("page"), (F.col("line") * 2 + F.col("again")).alias("n"), token.alias("token"), F.lit("").alias("label"), F.lit("01").alias("venue_code"), F.lit(1).alias("meeting"), F.col("day"), F.col("line").alias("race_no"), F.lit("1998-01-01").alias("date"), F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), race).alias("race_id"))


@query("""
WITH x AS (SELECT l_orderkey AS page, unnest(range(1, max(l_linenumber) + 1)) AS line FROM lineitem GROUP BY 1)
SELECT page, page || '-1998010101' || lpad(CAST(line AS VARCHAR), 2, '0') AS race_id, 'pw15' || CASE line % 3 WHEN 1 THEN '3' ELSE '5' END || 'ou' || page || 'x' || line AS token FROM x WHERE line % 3 <> 0
""")
def links_of_a_meeting(t: Tables) -> DataFrame:
    tokens = _tokens(t)
    return reports.race_links(tokens, tokens.where("day = 1").select("page", *reports.PLACE).distinct())


@query("""
WITH x AS (SELECT l_orderkey AS page, unnest(range(1, max(l_linenumber) + 1)) AS line FROM lineitem GROUP BY 1),
r AS (SELECT page || '-199801' || '01' || CASE WHEN line % 3 = 0 THEN '09' ELSE '01' END || lpad(CAST(line AS VARCHAR), 2, '0') AS race_id, 'ou' || page || 'x' || line AS tail, line FROM x)
SELECT race_id, unnest(CASE line % 3 WHEN 0 THEN ['tansho', 'fukusho'] WHEN 1 THEN ['wakuren'] ELSE ['wide'] END) AS bet, 'pw15' || CASE line % 3 WHEN 0 THEN '1' WHEN 1 THEN '3' ELSE '5' END || tail AS token FROM r
""")
def links_of_odds(t: Tables) -> DataFrame:
    return reports.odds_links(_tokens(t)).select("race_id", F.explode("links").alias("bet", "token"))


@query("""
WITH x AS (SELECT l_orderkey AS page, unnest(range(1, max(l_linenumber) + 1)) AS line FROM lineitem GROUP BY 1)
SELECT page, CAST(line * 2 AS BIGINT) AS n, 'pw15' || CASE line % 3 WHEN 0 THEN '1' WHEN 1 THEN '3' ELSE '5' END || 'ou' || page || 'x' || line AS token FROM x
""")
def meetings_once(t: Tables) -> DataFrame:
    return reports.meetings(_tokens(t)).select("page", F.col("n").cast("long").alias("n"), "token")

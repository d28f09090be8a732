"""Harness queries: the operators on the harness tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from furlong import queries_plans, queries_values  # noqa: F401  they register their queries
from furlong.functions import ids, names, scalars, vocab
from furlong.operators import components, coverage, latest, lineage, match, metrics, resolve, upsert
from furlong.registry import ORACLES, QUERIES, Tables, query
from furlong.session import cut
from furlong.sources import html, jsons, track_blocks
from furlong.streaming import incremental


def day(column: str):
    return F.date_format(column, "yyyy-MM-dd")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["entity_metrics_long"](spark, sf_dir)


# identifiers


@query("""
SELECT o_orderkey, CAST(substr(id, 1, 4) AS INT) AS yr, substr(id, 5, 2) AS venue, CAST(substr(id, 7, 2) AS INT) AS meeting, CAST(substr(id, 9, 2) AS INT) AS d, CAST(substr(id, 11, 2) AS INT) AS race_no
FROM (SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) || lpad(CAST(o_custkey % 12 + 1 AS VARCHAR), 2, '0') || lpad(CAST(o_orderkey % 7 + 1 AS VARCHAR), 2, '0') || lpad(CAST(o_orderkey % 9 + 1 AS VARCHAR), 2, '0') || lpad(CAST(o_orderkey % 12 + 1 AS VARCHAR), 2, '0') AS id FROM orders)
WHERE substr(id, 5, 2) BETWEEN '01' AND '10'
""")
def id_decode(t: Tables) -> DataFrame:
    pad = lambda c: F.lpad(c.cast("string"), 2, "0")
    key = F.concat(F.year("o_orderdate").cast("string"), pad(F.col("o_custkey") % 12 + 1), pad(F.col("o_orderkey") % 7 + 1), pad(F.col("o_orderkey") % 9 + 1), pad(F.col("o_orderkey") % 12 + 1))
    x = t.orders.select("o_orderkey", ids.decode_race_id(key).alias("x")).where("x is not null")
    return x.select("o_orderkey", F.col("x.year").alias("yr"), F.col("x.venue_code").alias("venue"), F.col("x.meeting").alias("meeting"), F.col("x.day").alias("d"), F.col("x.race_no").alias("race_no"))


@query("""
SELECT v AS venue, CAST(count(*) AS BIGINT) AS n, CAST(count(CASE WHEN v BETWEEN '01' AND '10' AND l_linenumber BETWEEN 1 AND 12 AND m BETWEEN 1 AND 99 THEN 1 END) AS BIGINT) AS n_valid,
       min(CASE WHEN v BETWEEN '01' AND '10' AND l_linenumber BETWEEN 1 AND 12 AND m BETWEEN 1 AND 99 THEN CAST(year(l_shipdate) AS VARCHAR) || v || lpad(CAST(m AS VARCHAR), 2, '0') || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') END) AS first_id
FROM (SELECT *, lpad(CAST(l_suppkey % 13 AS VARCHAR), 2, '0') AS v, l_partkey % 120 AS m FROM lineitem) GROUP BY v
""")
def id_compose_valid(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumn("venue", F.lpad((F.col("l_suppkey") % 13).cast("string"), 2, "0"))
    key = ids.compose_race_id(F.year("l_shipdate"), F.col("venue"), F.col("l_partkey") % 120, F.col("l_linenumber"), F.col("l_linenumber"))
    return rows.withColumn("id", key).groupBy("venue").agg(F.count("*").alias("n"), F.count("id").alias("n_valid"), F.min("id").alias("first_id"))


# sequences and windows


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
       sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice ROWS UNBOUNDED PRECEDING) AS cumulative
FROM lineitem
""")
def lap_cumulative(t: Tables) -> DataFrame:
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice").rowsBetween(Window.unboundedPreceding, 0)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", F.sum("l_quantity").over(order).alias("cumulative"))


@query("""
SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1
""")
def latest_row_per_key(t: Tables) -> DataFrame:
    return latest.latest_by(t.orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")


@query("""
SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')) WHERE rn = 1
""")
def latest_excluding_known(t: Tables) -> DataFrame:
    known = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    rows = t.orders.join(known, "o_custkey", "left_anti")
    return latest.latest_by(rows, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", "o_orderkey", "o_orderpriority")


@query("""
SELECT user_id, strftime(ts, '%Y-%m-%d') AS d, arg_max(event_id, (ts, -event_id)) AS event_id, arg_max(value, (ts, -event_id)) AS value FROM events GROUP BY 1, 2
""")
def latest_measurement_per_day(t: Tables) -> DataFrame:
    rows = t.events.withColumn("d", day("ts"))
    return latest.latest_by(rows, ["user_id", "d"], [F.desc("ts"), F.asc("event_id")]).select("user_id", "d", "event_id", "value")


@query("""
WITH x AS (SELECT c_nationkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE floor(c_acctbal / 1000) END AS b FROM customer WHERE c_nationkey <> 7 OR c_custkey % 3 = 0)
SELECT c_nationkey, arg_max(c_name, (b IS NOT NULL, coalesce(b, 0), c_name)) AS c_name FROM x GROUP BY c_nationkey
""")
def max_by_nullsafe(t: Tables) -> DataFrame:
    rows = t.customer.where("c_nationkey <> 7 or c_custkey % 3 = 0").withColumn("b", F.when(F.col("c_custkey") % 3 != 0, F.floor(F.col("c_acctbal") / 1000)))
    return latest.value_at_max(rows, ["c_nationkey"], "c_name", "b", "c_name")


@query("""
SELECT p_type, arg_min(p_brand, (-n, p_brand)) AS brand, max(n) AS n FROM (SELECT p_type, p_brand, count(*) AS n FROM part GROUP BY ALL) GROUP BY p_type
""")
def mode_spelling(t: Tables) -> DataFrame:
    return latest.mode_by(t.part, ["p_type"], "p_brand", "brand")


@query("""
SELECT l_partkey, min(l_suppkey) AS suppkey FROM lineitem WHERE l_quantity > 40 GROUP BY l_partkey HAVING count(DISTINCT l_suppkey) = 1
""")
def unanimous_map(t: Tables) -> DataFrame:
    return latest.unanimous_by(t.lineitem.where("l_quantity > 40"), ["l_partkey"], "l_suppkey", "suppkey")


@query("""
SELECT o_custkey, o_orderkey, (2000 + CAST(sum(roll) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INT)) || '-' || lpad(CAST(m AS VARCHAR), 2, '0') || '-' || lpad(CAST(d AS VARCHAR), 2, '0') AS date, CAST(o_totalprice AS DOUBLE) AS cushion
FROM (SELECT *, month(o_orderdate) AS m, day(o_orderdate) AS d, CASE WHEN month(o_orderdate) < lag(month(o_orderdate)) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) THEN 1 ELSE 0 END AS roll FROM orders)
""")
def year_rollover(t: Tables) -> DataFrame:
    """Each customer's orders as a file of table rows whose dates have no year."""
    dated = F.concat(F.month("o_orderdate").cast("string"), F.lit("月"), F.dayofmonth("o_orderdate").cast("string"), F.lit("日"))
    blank = F.lit("")
    cells = F.array(blank, dated, blank, blank, blank, F.col("o_totalprice").cast("string"), *[blank] * 5)
    rows = t.orders.select(F.col("o_custkey").alias("file"), F.col("o_orderkey").alias("line_no"), F.lit(2000).alias("year"), cells.alias("cells"))
    return track_blocks.table_rows(rows).select(F.col("file").alias("o_custkey"), F.col("line_no").alias("o_orderkey"), "date", F.col("cushion_value").alias("cushion"))


# coverage


@query("""
SELECT CAST(count(o.o_custkey) AS BIGINT) AS covered, CAST(count(*) AS BIGINT) AS total FROM customer c LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) = 1997) o ON o.o_custkey = c.c_custkey
""")
def coverage_pair(t: Tables) -> DataFrame:
    ordered = t.orders.where(F.year("o_orderdate") == 1997).select(F.col("o_custkey").alias("c_custkey"))
    return coverage.coverage_pair(t.customer, ordered, ["c_custkey"])


@query("""
SELECT event_type, count(*) FILTER (value > 50) AS n_high, count(*) FILTER (value <= 50) AS n_low, count(*) FILTER (value < 0) AS n_negative FROM events GROUP BY event_type
""")
def conditional_counts(t: Tables) -> DataFrame:
    return coverage.conditional_counts(t.events, {"n_high": F.col("value") > 50, "n_low": F.col("value") <= 50, "n_negative": F.col("value") < 0}, ["event_type"])


@query("""
SELECT count(DISTINCT l_orderkey) AS units, CASE WHEN count(DISTINCT l_orderkey) > 0 THEN round(CAST(count(*) AS DOUBLE) / count(DISTINCT l_orderkey), 6) ELSE 0.0 END AS mean_cells FROM lineitem
""")
def avg_cells_guarded(t: Tables) -> DataFrame:
    return coverage.guarded_average(t.lineitem, "l_orderkey", "mean_cells")


@query("""
WITH c AS (SELECT c_nationkey AS k, max(c_name) AS top_customer, count(*) AS n_customers FROM customer WHERE c_acctbal > 9000 GROUP BY 1),
s AS (SELECT s_nationkey AS k, max(s_name) AS top_supplier, count(*) AS n_suppliers FROM supplier WHERE s_acctbal > 5000 GROUP BY 1)
SELECT coalesce(c.k, s.k) AS k, top_customer, coalesce(n_customers, 0) AS n_customers, top_supplier, coalesce(n_suppliers, 0) AS n_suppliers FROM c FULL JOIN s ON c.k = s.k
""")
def two_source_list(t: Tables) -> DataFrame:
    a = t.customer.where("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("k")).agg(F.max("c_name").alias("top_customer"), F.count("*").alias("n_customers"))
    b = t.supplier.where("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("k")).agg(F.max("s_name").alias("top_supplier"), F.count("*").alias("n_suppliers"))
    return latest.outer_merge(a, b, ["k"]).na.fill(0, ["n_customers", "n_suppliers"])


@query("""
SELECT o_custkey, c_name, c_mktsegment, CAST(min(year(o_orderdate) - (o_orderkey % 5)) AS BIGINT) AS birth FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL
""")
def min_functional_dep(t: Tables) -> DataFrame:
    rows = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
    return rows.groupBy("o_custkey", "c_name", "c_mktsegment").agg(F.min(F.year("o_orderdate") - F.col("o_orderkey") % 5).cast("long").alias("birth"))


@query("""
SELECT l_orderkey, string_agg(CAST(l_linenumber AS VARCHAR), '-' ORDER BY l_linenumber) AS combo FROM lineitem GROUP BY l_orderkey
""")
def collect_combo(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey").agg(scalars.join_present(F.array_join(F.transform(F.array_sort(F.collect_list("l_linenumber")), lambda x: x.cast("string")), "-")).alias("combo"))


@query("SELECT substr(p_name, 1, 3) AS prefix, count(*) AS n, min(p_name) AS first_name, max(p_name) AS last_name FROM part GROUP BY 1")
def prefix_histogram(t: Tables) -> DataFrame:
    return t.part.groupBy(F.substring("p_name", 1, 3).alias("prefix")).agg(F.count("*").alias("n"), F.min("p_name").alias("first_name"), F.max("p_name").alias("last_name"))


@query("""
SELECT name, CAST(sum(recent) AS BIGINT) AS recent, count(*) AS total FROM (SELECT l_returnflag AS name, CAST(l_linestatus = 'F' AS INT) AS recent FROM lineitem UNION ALL SELECT l_linestatus, CAST(l_linestatus = 'F' AS INT) FROM lineitem) GROUP BY name
""")
def usage_counts(t: Tables) -> DataFrame:
    return resolve.usage(t.lineitem, ["l_returnflag", "l_linestatus"], F.col("l_linestatus") == "F")


@query("""
SELECT c_custkey, c_name FROM customer WHERE (EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '1998-01-01') OR EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey))
AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = c_custkey) ORDER BY c_custkey DESC LIMIT 50
""")
def recent_missing(t: Tables) -> DataFrame:
    seen = [t.orders.where("o_orderdate >= '1998-01-01'").select(F.col("o_custkey").alias("c_custkey")), t.events.select(F.col("user_id").alias("c_custkey"))]
    lacking = t.supplier.select(F.col("s_suppkey").alias("c_custkey"))
    return coverage.missing(t.customer, ["c_custkey"], seen, lacking).select("c_custkey", "c_name").orderBy(F.desc("c_custkey")).limit(50)


@query("""
SELECT o_orderkey, o_orderstatus, v AS new_status FROM (SELECT *, CASE WHEN o_orderpriority = '1-URGENT' THEN NULL WHEN o_totalprice > 300000 THEN 'F' ELSE o_orderstatus END AS v FROM orders) WHERE o_orderstatus IS DISTINCT FROM v
""")
def null_safe_change(t: Tables) -> DataFrame:
    value = F.when(F.col("o_orderpriority") == "1-URGENT", None).when(F.col("o_totalprice") > 300000, "F").otherwise(F.col("o_orderstatus"))
    _, changed = upsert.recompute(t.orders, "o_orderstatus", value)
    return changed.select("o_orderkey", "o_orderstatus", value.alias("new_status"))


@query("SELECT * FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)")
def scalar_max_filter(t: Tables) -> DataFrame:
    return coverage.max_rows(t.orders, "o_orderdate")


@query("""
WITH p AS (SELECT c_name, substr(c_name, 1, 12) AS a, substr(c_name, 1, 14) AS b, substr(c_name, 1, 16) AS c FROM customer),
n AS (SELECT *, count(*) OVER (PARTITION BY a) AS na, count(*) OVER (PARTITION BY b) AS nb, count(*) OVER (PARTITION BY c) AS nc FROM p)
SELECT CASE WHEN na < 200 THEN a WHEN nb < 200 THEN b WHEN nc < 200 THEN c ELSE c_name END AS prefix, count(*) AS n FROM n GROUP BY 1
""")
def capped_prefix(t: Tables) -> DataFrame:
    return coverage.capped_prefixes(t.customer, "c_name", 200, 12, 16, 2)


@query("""
SELECT doc_id, sha256(text) AS sha256 FROM documents WHERE sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE doc_id % 2 = 0)
""")
def manifest_skip(t: Tables) -> DataFrame:
    files = t.documents.select("doc_id", F.sha2("text", 256).alias("sha256"))
    return coverage.new_files(files, files.where("doc_id % 2 = 0")).select("doc_id", "sha256")


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages")))
def table_counts(t: Tables) -> DataFrame:
    return coverage.table_counts({n: getattr(t, n) for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages")})


# mutations

OLD_ORDERS = "SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0"
NEW_ORDERS = "SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'N' END AS o_orderstatus, round(o_totalprice * 2, 2) AS o_totalprice FROM orders WHERE o_orderkey % 2 = 0"


def _sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    old = t.orders.where("o_orderkey % 3 <> 0").select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")).alias("o_orderstatus"), "o_totalprice")
    new = t.orders.where("o_orderkey % 2 = 0").select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 7 != 0, F.lit("N")).alias("o_orderstatus"), F.round(F.col("o_totalprice") * 2, 2).alias("o_totalprice"))
    return old, new


def _merge_sql(status: str, price: str) -> str:
    return f"""WITH e AS ({OLD_ORDERS}), i AS ({NEW_ORDERS})
SELECT coalesce(e.o_orderkey, i.o_orderkey) AS o_orderkey, coalesce(i.o_custkey, e.o_custkey) AS o_custkey, {status} AS o_orderstatus, {price} AS o_totalprice FROM e FULL JOIN i ON e.o_orderkey = i.o_orderkey"""


@query(_merge_sql("CASE WHEN i.o_orderkey IS NOT NULL THEN i.o_orderstatus ELSE e.o_orderstatus END", "coalesce(i.o_totalprice, e.o_totalprice)"))
def upsert_overwrite(t: Tables) -> DataFrame:
    return upsert.upsert(*_sides(t), ["o_orderkey"])


@query(_merge_sql("CASE WHEN i.o_orderkey IS NOT NULL THEN i.o_orderstatus ELSE e.o_orderstatus END", "coalesce(e.o_totalprice, i.o_totalprice)"))
def upsert_keep(t: Tables) -> DataFrame:
    return upsert.upsert(*_sides(t), ["o_orderkey"], {"o_totalprice": "keep"})


@query(_merge_sql("coalesce(i.o_orderstatus, e.o_orderstatus)", "coalesce(i.o_totalprice, e.o_totalprice)"))
def upsert_coalesce(t: Tables) -> DataFrame:
    return upsert.upsert(*_sides(t), ["o_orderkey"], default="coalesce")


@query(_merge_sql("CASE WHEN e.o_orderkey IS NULL THEN i.o_orderstatus WHEN i.o_orderkey IS NULL THEN e.o_orderstatus WHEN i.o_orderstatus = 'N' THEN e.o_orderstatus ELSE i.o_orderstatus END", "coalesce(i.o_totalprice, e.o_totalprice)"))
def monotone_status(t: Tables) -> DataFrame:
    return upsert.upsert(*_sides(t), ["o_orderkey"], {"o_orderstatus": upsert.monotone("N")})


@query(f"WITH e AS ({OLD_ORDERS}), i AS ({NEW_ORDERS}) SELECT * FROM e UNION ALL SELECT * FROM i WHERE o_orderkey NOT IN (SELECT o_orderkey FROM e)")
def insert_if_absent(t: Tables) -> DataFrame:
    return upsert.insert_if_absent(*_sides(t), ["o_orderkey"])


@query(f"""WITH e AS ({OLD_ORDERS}), i AS ({NEW_ORDERS})
SELECT e.o_orderkey, coalesce(CASE WHEN i.o_totalprice < 200000 THEN i.o_custkey END, e.o_custkey) AS o_custkey, CASE WHEN i.o_totalprice < 200000 THEN i.o_orderstatus ELSE e.o_orderstatus END AS o_orderstatus, e.o_totalprice
FROM e LEFT JOIN i ON e.o_orderkey = i.o_orderkey""")
def update_only(t: Tables) -> DataFrame:
    old, new = _sides(t)
    kept = new.where("o_totalprice < 200000")
    return upsert.update_only(old, kept, ["o_orderkey"], ["o_custkey", "o_orderstatus"])


@query("""
WITH e AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_linenumber <= 3), i AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity + 100 AS l_quantity FROM lineitem WHERE l_orderkey % 4 = 0 AND l_linenumber >= 3),
k AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey % 4 = 0)
SELECT * FROM e WHERE l_orderkey NOT IN (SELECT l_orderkey FROM k) UNION ALL SELECT * FROM i
""")
def replace_partition(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    touched = rows.where("l_orderkey % 4 = 0").select("l_orderkey")
    fresh = rows.where("l_orderkey % 4 = 0 and l_linenumber >= 3").withColumn("l_quantity", F.col("l_quantity") + 100)
    return upsert.replace_partition(rows.where("l_linenumber <= 3"), fresh, ["l_orderkey"], touched)


@query("""
WITH e AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderdate END AS d FROM orders WHERE o_orderkey % 3 <> 0),
i AS (SELECT o_orderkey, o_custkey + 1000000 AS o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate - INTERVAL 1 DAY END AS d FROM orders WHERE o_orderkey % 7 <> 0)
SELECT coalesce(e.o_orderkey, i.o_orderkey) AS o_orderkey, CASE WHEN e.o_orderkey IS NULL OR i.d >= e.d OR (i.o_orderkey IS NOT NULL AND e.d IS NULL) THEN i.o_custkey ELSE e.o_custkey END AS o_custkey,
CASE WHEN e.o_orderkey IS NULL OR i.d >= e.d OR (i.o_orderkey IS NOT NULL AND e.d IS NULL) THEN i.d ELSE e.d END AS d FROM e FULL JOIN i ON e.o_orderkey = i.o_orderkey
""")
def conditional_upsert(t: Tables) -> DataFrame:
    old = t.orders.where("o_orderkey % 3 <> 0").select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderdate")).alias("d"))
    moved = F.when(F.col("o_orderkey") % 5 == 0, None).when(F.col("o_orderkey") % 2 == 0, F.col("o_orderdate") + F.expr("interval 1 day")).otherwise(F.col("o_orderdate") - F.expr("interval 1 day"))
    new = t.orders.where("o_orderkey % 7 <> 0").select("o_orderkey", (F.col("o_custkey") + 1000000).alias("o_custkey"), moved.alias("d"))
    return upsert.conditional_upsert(old, new, ["o_orderkey"], "d")


BLANKED = "SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN '' WHEN c_custkey % 4 = 1 THEN NULL ELSE c_name END AS c_name, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 5 <> 0"
SECOND = "SELECT c_custkey, CASE WHEN c_custkey % 8 = 0 THEN '' ELSE upper(c_name) END AS c_name, c_acctbal, 'second' AS c_mktsegment FROM customer WHERE c_custkey % 7 <> 0"


def _blanks(t: Tables) -> tuple[DataFrame, DataFrame]:
    key = F.col("c_custkey")
    old = t.customer.where("c_custkey % 5 <> 0").select("c_custkey", F.when(key % 4 == 0, "").when(key % 4 == 1, None).otherwise(F.col("c_name")).alias("c_name"), F.when(key % 3 != 0, F.col("c_acctbal")).alias("c_acctbal"), "c_mktsegment")
    new = t.customer.where("c_custkey % 7 <> 0").select("c_custkey", F.when(key % 8 == 0, "").otherwise(F.upper("c_name")).alias("c_name"), "c_acctbal", F.lit("second").alias("c_mktsegment"))
    return upsert.fill_blanks(old, new, ["c_custkey"], ["c_name", "c_acctbal", "c_mktsegment"], "customer")


@query(f"""WITH e AS ({BLANKED}), i AS ({SECOND})
SELECT coalesce(e.c_custkey, i.c_custkey) AS c_custkey, CASE WHEN e.c_custkey IS NULL THEN i.c_name WHEN coalesce(e.c_name, '') = '' AND coalesce(i.c_name, '') <> '' THEN i.c_name ELSE e.c_name END AS c_name,
coalesce(e.c_acctbal, i.c_acctbal) AS c_acctbal, coalesce(e.c_mktsegment, i.c_mktsegment) AS c_mktsegment FROM e FULL JOIN i ON e.c_custkey = i.c_custkey""")
def fill_blanks(t: Tables) -> DataFrame:
    return _blanks(t)[0]


@query(f"""WITH e AS ({BLANKED}), i AS ({SECOND}), j AS (SELECT e.c_custkey, e.c_name AS en, i.c_name AS nn, e.c_acctbal AS ea, i.c_acctbal AS na FROM e JOIN i ON e.c_custkey = i.c_custkey)
SELECT 'customer' AS table_name, CAST(c_custkey AS VARCHAR) AS row_key, 'c_name' AS column_name FROM j WHERE coalesce(en, '') = '' AND coalesce(nn, '') <> ''
UNION ALL SELECT 'customer', CAST(c_custkey AS VARCHAR), 'c_acctbal' FROM j WHERE ea IS NULL AND na IS NOT NULL""")
def fill_blanks_audit(t: Tables) -> DataFrame:
    return _blanks(t)[1].drop("filled_at")


@query("""
WITH e AS (SELECT doc_id, quality, toxic FROM labels WHERE doc_id % 2 = 0), i AS (SELECT doc_id, 1 - quality AS quality, toxic FROM labels WHERE doc_id % 3 = 0)
SELECT * FROM e WHERE doc_id NOT IN (SELECT doc_id FROM i) UNION ALL SELECT * FROM i WHERE quality = 1 OR toxic = 1
""")
def keep_if_touched(t: Tables) -> DataFrame:
    new = t.labels.where("doc_id % 3 = 0").withColumn("quality", (1 - F.col("quality")).cast("int"))
    return upsert.keep_if_touched(t.labels.where("doc_id % 2 = 0"), new, ["doc_id"], (F.col("quality") == 1) | (F.col("toxic") == 1))


@query("""
SELECT o_orderkey, CASE WHEN c_custkey IS NOT NULL THEN nullif(CASE WHEN c_custkey % 6 = 0 THEN '' ELSE c_mktsegment END, '') ELSE CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END END AS mark
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 2 = 0) c ON c_custkey = o_custkey
""")
def derive_with_priority(t: Tables) -> DataFrame:
    first = t.customer.where("c_custkey % 2 = 0").select("c_custkey", F.when(F.col("c_custkey") % 6 == 0, "").otherwise(F.col("c_mktsegment")).alias("m"))
    rows = t.orders.join(first, F.col("c_custkey") == F.col("o_custkey"), "left")
    second = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority"))
    return rows.select("o_orderkey", F.when(F.col("c_custkey").isNotNull(), F.nullif("m", F.lit(""))).otherwise(second).alias("mark"))


# matches


@query("""
WITH l AS (SELECT CASE WHEN c_custkey % 3 <> 0 THEN c_custkey END AS k, c_name AS nm, c_acctbal AS v FROM customer WHERE c_custkey % 5 <> 0)
SELECT c.c_custkey AS k, c.c_name AS nm, coalesce(a.v, b.v) AS v FROM customer c LEFT JOIN l a ON a.k = c.c_custkey LEFT JOIN l b ON b.nm = c.c_name
""")
def fallback_match(t: Tables) -> DataFrame:
    lookup = t.customer.where("c_custkey % 5 <> 0").select(F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey")).alias("k"), F.col("c_name").alias("nm"), F.col("c_acctbal").alias("v"))
    return match.fallback_match(t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("nm")), lookup, "k", "nm", "v")


@query("""
WITH h AS (SELECT p_brand, p_type, p_size, count(DISTINCT p_partkey) AS n, min(p_partkey) AS sole FROM part WHERE p_partkey % 2 = 0 GROUP BY ALL)
SELECT p.p_partkey AS row_id, CASE WHEN n = 1 THEN sole END AS match_id FROM part p LEFT JOIN h USING (p_brand, p_type, p_size) WHERE p.p_partkey % 2 = 1
""")
def unique_match(t: Tables) -> DataFrame:
    rows = t.part.where("p_partkey % 2 = 1").select(F.col("p_partkey").alias("row_id"), "p_brand", "p_type", "p_size")
    pool = t.part.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("match_id"), "p_brand", "p_type", "p_size")
    return match.unique_match(rows, pool, ["p_brand", "p_type", "p_size"], "match_id").select("row_id", "match_id")


@query("""
SELECT c_custkey, min(s_suppkey) AS s_suppkey FROM customer JOIN supplier ON s_nationkey = c_nationkey AND s_acctbal <= c_acctbal - 3000 GROUP BY c_custkey HAVING count(*) = 1
""")
def theta_unique(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", F.col("c_nationkey").alias("nation"), "c_acctbal")
    pool = t.supplier.select("s_suppkey", F.col("s_nationkey").alias("nation"), "s_acctbal")
    return match.theta_unique(rows, pool, ["nation"], "s_acctbal", F.col("c_acctbal") - 3000, "c_custkey", "s_suppkey")


@query("""
WITH r AS (SELECT p_partkey, p_brand, p_type, substr(p_name, 1, 5) AS short FROM part WHERE p_partkey % 2 = 0),
c AS (SELECT DISTINCT p_brand, p_type, p_name || ' ' || p_size AS name FROM part WHERE p_partkey % 2 = 1),
s1 AS (SELECT p_partkey, 1 AS stage, CASE WHEN count(DISTINCT substr(name, instr(name, short))) = 1 THEN min(substr(name, instr(name, short))) END AS match FROM r JOIN c USING (p_brand, p_type) WHERE contains(name, short) GROUP BY p_partkey),
s2 AS (SELECT p_partkey, 2 AS stage, CASE WHEN count(DISTINCT substr(name, instr(name, short))) = 1 THEN min(substr(name, instr(name, short))) END AS match FROM r JOIN c USING (p_type) WHERE contains(name, short) AND p_partkey NOT IN (SELECT p_partkey FROM s1) GROUP BY p_partkey)
SELECT * FROM s1 UNION ALL SELECT * FROM s2
""")
def staged_match(t: Tables) -> DataFrame:
    """Even parts among odd ones: every part is matched or a candidate."""
    rows = t.part.where("p_partkey % 2 = 0").select("p_partkey", "p_brand", "p_type", F.substring("p_name", 1, 5).alias("short"))
    pool = t.part.where("p_partkey % 2 = 1").select("p_brand", "p_type", F.concat_ws(" ", "p_name", F.col("p_size").cast("string")).alias("name"))
    return match.staged_match(rows, pool, [("p_brand", "p_type"), ("p_type",)], "p_partkey", "short", "name")


@query("""
WITH a AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS d, max(value) AS clicked, max(ts) AS at FROM events WHERE event_type = 'click' GROUP BY 1, 2), b AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS d, max(value) AS bought, max(ts) AS at FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)
SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.d, b.d) AS d, clicked, bought, CASE WHEN a.at IS NULL THEN b.at WHEN b.at IS NULL THEN a.at ELSE greatest(a.at, b.at) END AS at FROM a FULL JOIN b ON a.user_id = b.user_id AND a.d = b.d
""")
def outer_measure_merge(t: Tables) -> DataFrame:
    side = lambda kind, name: t.events.where(F.col("event_type") == kind).groupBy("user_id", day("ts").alias("d")).agg(F.max("value").alias(name), F.max("ts").alias("at"))
    return latest.outer_merge(side("click", "clicked"), side("purchase", "bought"), ["user_id", "d"], ["at"])


# metrics

BASE = """base AS (
  SELECT CAST(year(l_shipdate) AS INT) AS yr, l_suppkey AS entity, count(DISTINCT l_orderkey) AS n, count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_orderkey END) AS n_win, count(*) AS n_starts, CAST((sum(CAST(round(l_extendedprice * 100) AS BIGINT)) + 50) // 100 AS BIGINT) AS amount
  FROM lineitem GROUP BY 1, 2),
mean AS (SELECT yr, CAST(sum(amount) AS DOUBLE) / sum(n) AS m FROM base GROUP BY yr),
lead AS (SELECT b.*, CAST(b.amount AS DOUBLE) / b.n AS per_unit, round(CAST(b.amount AS DOUBLE) / b.n / mean.m, 2) AS idx FROM base b JOIN mean ON mean.yr = b.yr),
den AS (SELECT yr, median(per_unit / idx) AS d FROM lead WHERE idx > 0 AND per_unit > 0 GROUP BY yr)"""
TOTALS = """tot AS (SELECT l.entity, CAST(sum(l.n) AS BIGINT) AS n, CAST(sum(l.n_win) AS BIGINT) AS n_win, CAST(sum(l.n_starts) AS BIGINT) AS n_starts, CAST(sum(l.amount) AS BIGINT) AS amount,
  (CAST(sum(l.amount) AS DOUBLE) / sum(l.n)) / (sum(coalesce(den.d, 0) * l.n) / sum(CASE WHEN den.d <> 0 THEN l.n END)) AS aei FROM lead l LEFT JOIN den ON den.yr = l.yr GROUP BY l.entity)"""


def _lead(t: Tables) -> tuple[DataFrame, DataFrame]:
    """(a row for each supplier and year with its published index, the years' recovered denominators)."""
    per_order = t.lineitem.groupBy(F.year("l_shipdate").alias("yr"), F.col("l_suppkey").alias("entity"), "l_orderkey").agg(F.max((F.col("l_returnflag") == "R").cast("int")).alias("won"), F.count("*").alias("k"), F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("cents"))
    base = per_order.groupBy("yr", "entity").agg(F.count("*").alias("n"), F.sum("won").alias("n_win"), F.sum("k").alias("n_starts"), F.floor((F.sum("cents") + 50) / 100).cast("long").alias("amount"))
    mean = base.groupBy("yr").agg((F.sum("amount").cast("double") / F.sum("n")).alias("m"))
    per_unit = F.col("amount").cast("double") / F.col("n")
    lead = base.join(F.broadcast(mean), "yr").withColumn("per_unit", per_unit).withColumn("idx", F.round(per_unit / F.col("m"), 2)).drop("m")
    # A row for each entity and year; everything below reads it several times.
    lead = cut(lead)
    return lead, metrics.field_denominators(lead, ["yr"])


def _six(column: str):
    """Six decimals as the SQL rounds a double: the millionfold, itself a double, to the nearest whole number."""
    return (F.round(F.col(column) * 1e6) / 1e6).alias(column)


@query(f"WITH {BASE} SELECT yr, round(d, 4) AS d FROM den")
def ratio_median(t: Tables) -> DataFrame:
    return _lead(t)[1].select("yr", F.round("d", 4).alias("d"))


@query(f"WITH {BASE}, {TOTALS} SELECT entity, round(aei, 6) AS aei FROM tot")
def weighted_index(t: Tables) -> DataFrame:
    lead, denominators = _lead(t)
    return metrics.weighted_index(lead, denominators, "entity", "yr").select("entity", F.round("aei", 6).alias("aei"))


FIELDS = """elig AS (SELECT * FROM tot WHERE n >= 20),
fields AS (SELECT 'aei' AS metric, 1.0::DOUBLE AS field UNION ALL SELECT 'win_rate', CAST(sum(n_win) AS DOUBLE) / sum(n_starts) FROM elig UNION ALL SELECT 'starts_per_unit', CAST(sum(n_starts) AS DOUBLE) / sum(n) FROM elig
  UNION ALL SELECT 'units', avg(n) FROM elig UNION ALL SELECT 'amount_per_unit', sum(CASE WHEN d <> 0 THEN d * n END) / sum(CASE WHEN d <> 0 THEN n END) FROM (SELECT yr, sum(n) AS n FROM lead GROUP BY yr) JOIN den USING (yr))"""


@query(f"WITH {BASE}, {TOTALS}, {FIELDS} SELECT metric, round(field, 6) AS field FROM fields")
def field_value(t: Tables) -> DataFrame:
    lead, denominators = _lead(t)
    rows = metrics.entity_totals(lead, denominators, "entity", "yr")
    return metrics.field_values(lead, denominators, rows, "yr").select("metric", F.round("field", 6).alias("field"))


@query(f"""WITH {BASE}, {TOTALS}, elig AS (SELECT entity, aei FROM tot WHERE n >= 20),
pct AS (SELECT entity, aei, (CAST(rank() OVER (ORDER BY aei) - 1 AS DOUBLE) / count(*) OVER () + cume_dist() OVER (ORDER BY aei)) / 2 AS p FROM elig)
SELECT entity, round(aei, 6) AS aei, round(p, 6) AS percentile, least(9, CAST(floor(p * 9) AS INT) + 1) AS grade FROM pct""")
def midrank_grade(t: Tables) -> DataFrame:
    lead, denominators = _lead(t)
    rows = cut(metrics.entity_totals(lead, denominators, "entity", "yr").where("n >= 20").select("entity", "aei"))
    ranked = metrics.percentile_against(rows, "aei", rows, "aei")
    return ranked.select("entity", _six("aei"), _six("percentile"), metrics.grade(F.col("percentile")).alias("grade"))


@query(f"""WITH {BASE}, {TOTALS}, {FIELDS},
vals AS (SELECT entity, 'win_rate' AS metric, CAST(n_win AS DOUBLE) / n_starts AS value FROM elig UNION ALL SELECT entity, 'starts_per_unit', CAST(n_starts AS DOUBLE) / n FROM elig UNION ALL SELECT entity, 'amount_per_unit', CAST(amount AS DOUBLE) / n FROM elig
  UNION ALL SELECT entity, 'aei', aei FROM elig UNION ALL SELECT entity, 'units', CAST(n AS DOUBLE) FROM elig),
pct AS (SELECT *, (CAST(rank() OVER (PARTITION BY metric ORDER BY value) - 1 AS DOUBLE) / count(*) OVER (PARTITION BY metric) + cume_dist() OVER (PARTITION BY metric ORDER BY value)) / 2 AS p FROM vals)
SELECT entity, metric, round(value, 6) AS value, round(value / field, 6) AS ratio_to_field, round(p, 6) AS percentile, least(9, CAST(floor(p * 9) AS INT) + 1) AS grade FROM pct JOIN fields USING (metric)""")
def entity_metrics_long(t: Tables) -> DataFrame:
    lead, denominators = _lead(t)
    rows = cut(metrics.entity_totals(lead, denominators, "entity", "yr"))
    out = metrics.metrics_long(rows, metrics.field_values(lead, denominators, rows, "yr"), "entity")
    return out.select("entity", "metric", *[_six(c) for c in ("value", "ratio_to_field", "percentile")], "grade")


# scalars


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, array_to_string(list_sort([l_linenumber, CAST(l_partkey % 18 AS INT), CAST(l_suppkey % 18 AS INT)]), '-') AS combo FROM lineitem
""")
def combo_canonical(t: Tables) -> DataFrame:
    raw = F.concat_ws("-", F.col("l_linenumber").cast("string"), (F.col("l_partkey") % 18).cast("string"), (F.col("l_suppkey") % 18).cast("string"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", scalars.canonical_combo(raw).alias("combo"))


@query("""
SELECT l_orderkey, n, CASE WHEN n >= 2 THEN CAST(factorial(CAST(n AS INT)) / (factorial(CAST(n - 2 AS INT)) * 2) AS BIGINT) ELSE 0 END AS pairs, CASE WHEN n >= 3 THEN CAST(factorial(CAST(n AS INT)) / factorial(CAST(n - 3 AS INT)) AS BIGINT) ELSE 0 END AS trifectas
FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey)
""")
def combo_count(t: Tables) -> DataFrame:
    rows = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n"))
    return rows.select("l_orderkey", "n", scalars.combinations(F.col("n"), 2).alias("pairs"), scalars.permutations(F.col("n"), 3).alias("trifectas"))


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS status, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'ハンデ' WHEN '2' THEN '別定' WHEN '3' THEN '馬齢' WHEN '4' THEN '定量' END AS weight_type FROM orders
""")
def code_to_vocab(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", vocab.lookup(F.col("o_orderstatus"), {"F": "finished", "O": "open"}).alias("status"), vocab.lookup(F.substring("o_orderpriority", 1, 1), vocab.WEIGHT_TYPE).alias("weight_type"))


@query("""
WITH x AS (SELECT o_orderkey, CAST(o_orderkey % 12 + 1 AS INT) AS m, CAST(o_custkey % 31 + 1 AS INT) AS d, CAST(o_orderdate AS DATE) AS today FROM orders),
y AS (SELECT *, try_cast(year(today) || '-' || lpad(CAST(m AS VARCHAR), 2, '0') || '-' || lpad(CAST(d AS VARCHAR), 2, '0') AS DATE) AS own, try_cast((year(today) - 1) || '-' || lpad(CAST(m AS VARCHAR), 2, '0') || '-' || lpad(CAST(d AS VARCHAR), 2, '0') AS DATE) AS before FROM x)
SELECT o_orderkey, CAST(CASE WHEN own IS NULL OR own - today > 60 THEN before ELSE own END AS VARCHAR) AS inferred FROM y
""")
def year_infer(t: Tables) -> DataFrame:
    month, d = (F.col("o_orderkey") % 12 + 1).cast("int"), (F.col("o_custkey") % 31 + 1).cast("int")
    return t.orders.select("o_orderkey", scalars.infer_year(month, d, F.to_date("o_orderdate")).cast("string").alias("inferred"))


@query("""
SELECT strftime(m, '%Y-%m') AS month, last_day(m) < DATE '1998-06-15' AS is_final FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS m FROM orders)
""")
def month_sequence(t: Tables) -> DataFrame:
    ends = t.orders.agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
    months = ends.select(F.explode(scalars.months_between(F.col("a"), F.col("b"))).alias("m"))
    return months.select(F.date_format("m", "yyyy-MM").alias("month"), (F.last_day("m") < F.lit("1998-06-15").cast("date")).alias("is_final"))


@query("""
WITH x AS (SELECT DISTINCT CAST(l_quantity * 37 AS BIGINT) AS raw FROM lineitem), y AS (SELECT raw, CAST(raw // 1000 * 600 + raw % 1000 AS DOUBLE) / 10 AS seconds FROM x),
z AS (SELECT *, CAST(round_even(seconds * 10, 0) AS BIGINT) AS q FROM y)
SELECT raw, seconds, (q // 600) || ':' || lpad(CAST(q % 600 // 10 AS VARCHAR), 2, '0') || '.' || (q % 10) AS text, round((q // 600) * 60 + CAST(q % 600 AS DOUBLE) / 10, 1) AS again FROM z
""")
def sec_format_parse(t: Tables) -> DataFrame:
    rows = t.lineitem.select((F.col("l_quantity") * 37).cast("long").alias("raw")).distinct().withColumn("seconds", scalars.seconds_of_digits(F.col("raw").cast("string")))
    return rows.withColumn("text", scalars.seconds_text(F.col("seconds"))).withColumn("again", scalars.seconds_of_text(F.col("text")))


@query("""
SELECT event_id, try_cast(CASE WHEN regexp_matches(s, '^[+-]?[0-9]+$') THEN s END AS BIGINT) AS n FROM (SELECT event_id, replace(trim(CASE WHEN event_id % 4 = 0 THEN ' 1,' || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0') || ' ' WHEN event_id % 4 = 1 THEN '---' WHEN event_id % 4 = 2 THEN regexp_extract(props, '[0-9]+') ELSE '' END), ',', '') AS s FROM events)
""")
def lenient_cast(t: Tables) -> DataFrame:
    key = F.col("event_id")
    raw = F.when(key % 4 == 0, F.concat(F.lit(" 1,"), F.lpad((key % 1000).cast("string"), 3, "0"), F.lit(" "))).when(key % 4 == 1, "---").when(key % 4 == 2, F.regexp_extract("props", "[0-9]+", 0)).otherwise("")
    return t.events.select("event_id", scalars.to_int(raw).alias("n"))


def _strip_sql(source: str, patterns: tuple[str, ...], rounds: int) -> str:
    """One CTE for each pattern and round."""
    ctes = [f"x0 AS ({source})"]
    for i, p in enumerate(patterns * rounds):
        ctes.append(f"x{i + 1} AS (SELECT raw, coalesce(nullif(regexp_replace(bare, '{p}', ''), ''), bare) AS bare FROM x{i})")
    return f"WITH {', '.join(ctes)} SELECT raw, bare FROM x{len(ctes) - 1}"


ADDITIONS = (r"\*$", "[0-9]$", "Brand#$", " $")


@query(_strip_sql("SELECT DISTINCT p_name || ' ' || p_brand || '*' AS raw, p_name || ' ' || p_brand || '*' AS bare FROM part", ADDITIONS, 3))
def strip_suffix_fixpoint(t: Tables) -> DataFrame:
    rows = t.part.select(F.concat("p_name", F.lit(" "), "p_brand", F.lit("*")).alias("raw")).distinct()
    return rows.withColumn("bare", names.strip_suffixes(F.col("raw"), ADDITIONS))


@query(r"SELECT doc_id, CAST(length(x) AS BIGINT) AS n, md5(x) AS digest FROM (SELECT doc_id, trim(regexp_replace(text, '[\s\x{0B}\x{85}\p{Z}]+', ' ', 'g'), ' ') AS x FROM documents)")
def ws_normalize(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", scalars.normalize_space(F.col("text")).alias("x"))
    return rows.select("doc_id", F.length("x").cast("long").alias("n"), F.md5("x").alias("digest"))


@query()
def nfkc_text(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.md5(scalars.nfkc(F.concat("text", F.lit("（２０２４）ｱ")))).alias("digest"))


# documents


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def json_props(t: Tables) -> DataFrame:
    return jsons.fields(t.events, "props", "k bigint", ["event_id"]).where("k is not null")


@query("""SELECT page_id, CAST(n AS BIGINT) AS n, link FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link, generate_subscripts(regexp_extract_all(html, 'href="([^"]*)"', 1), 1) AS n FROM pages)""")
def html_links(t: Tables) -> DataFrame:
    return html.links(t.pages, "page_id", "html").select("page_id", F.col("n").cast("long").alias("n"), "link")


@query("SELECT page_id, nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title FROM pages")
def html_title(t: Tables) -> DataFrame:
    return t.pages.select("page_id", html.title(F.col("html")).alias("title"))


@query()
def html_udtf_rows(t: Tables) -> DataFrame:
    return html.blocks(t.pages, "page_id", "html")


# graphs


@query("""
WITH RECURSIVE e AS (SELECT DISTINCT 2 * o_custkey AS a, 2 * o_orderkey + 1 AS b FROM orders), s AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT a AS node, a AS low FROM s UNION SELECT s.b, r.low FROM r JOIN s ON s.a = r.node)
SELECT node, min(low) AS component FROM r GROUP BY node
""")
def connected_components(t: Tables) -> DataFrame:
    """Every order joins its customer: the nodes are 2 c for a customer key c and 2 o + 1 for an order key o."""
    return components.connected_components(t.orders.select((2 * F.col("o_custkey")).alias("src"), (2 * F.col("o_orderkey") + 1).alias("dst")))


@query()
def constrained_union(t: Tables) -> DataFrame:
    """Every part joins a number, shared by four neighbours, to a spelling, shared by those of a hundred parts with one name; half the numbers are domestic, so many unions are refused."""
    own = F.floor(F.col("p_partkey") / 4).cast("long")
    number = F.concat(F.lit("11"), F.when(own % 2 == 0, "2").otherwise("4"), F.lpad(own.cast("string"), 9, "0"))
    name = F.concat_ws(" ", "p_name", F.floor(F.col("p_partkey") / 100).cast("string"))
    return resolve.resolve(t.part.select((F.col("p_partkey") % 4).cast("int").alias("role"), F.lit(0).alias("source"), number.alias("number"), name.alias("name")))


TREE = """part_tree AS (SELECT p_partkey AS node, CAST(floor(log2(p_partkey)) AS INT) AS depth FROM part WHERE p_partkey >= 1),
paths AS (SELECT a.node AS id, b.node AS ancestor, translate(right(CAST(bin(b.node) AS VARCHAR), b.depth - a.depth), '01', 'fm') AS path
  FROM part_tree b, unnest(range(1, b.depth + 1)) AS g(up) JOIN part_tree a ON a.node = b.node >> CAST(up AS INT))"""


def _depth(column: str):
    """Generations between key 1 and a key of the tree."""
    return F.length(F.bin(F.col(column))) - 1


def _tree(t: Tables, generations: int | None = None) -> DataFrame:
    """Lineages in the binary tree of part keys: the parents of k are 2k and 2k + 1. Without ``generations`` a lineage goes up to the largest key."""
    own = t.part.where("p_partkey >= 1").select(F.col("p_partkey").alias("ancestor"))
    top = _depth("ancestor") if generations is None else F.least(_depth("ancestor"), F.lit(generations))
    steps = own.where("ancestor > 1").select("ancestor", F.explode(F.sequence(F.lit(1), top)).alias("g")).withColumn("id", F.expr("shiftright(ancestor, g)"))
    up = steps.select("id", ids.lineage_path(F.col("g"), F.expr("ancestor - shiftleft(id, g)")).alias("path"), "ancestor")
    return up.join(own.select(F.col("ancestor").alias("id")).hint("merge"), "id", "left_semi").select("id", "path", "ancestor")


@query(f"WITH {TREE} SELECT id, path, ancestor FROM paths")
def lineage_paths(t: Tables) -> DataFrame:
    return _tree(t)


@query(f"""WITH {TREE}, x AS (SELECT id AS root, path, ancestor FROM paths UNION ALL SELECT a.ancestor, substr(b.path, length(a.path) + 1), b.ancestor FROM paths a JOIN paths b ON a.id = b.id AND starts_with(b.path, a.path) AND length(b.path) > length(a.path))
SELECT root, path, min(ancestor) AS ancestor FROM x GROUP BY root, path""")
def subtree_index(t: Tables) -> DataFrame:
    return lineage.subtree_index(_tree(t))


#: The largest part key that an id itself can show: the year of a larger one would be negative.
KEYED = 1_900_999_999


def _ranks(keys: DataFrame) -> DataFrame:
    """``key, rank``: each distinct key's place among all, from 0; ranges of keys are ranked apart, each beginning where those before it end."""
    ranged = cut(keys.distinct().repartitionByRange("key").withColumn("range", F.spark_partition_id()))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("range").agg(F.count("*").alias("n")).select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("range").orderBy("key"))
    return ranged.withColumn("place", place).join(F.broadcast(sizes), "range").select("key", (F.col("before") + F.col("place") - 1).alias("rank"))


def _graft(t: Tables, celled: str = "id % 3 <> 0") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(trees, cells, names) of registration numbers made from the tree of all part keys, with holes. A tree shows three generations.

    An id is a year and the last six digits of a number: of the key, or, where a key
    exceeds ``KEYED``, of every key's rank. Four years for each generation and one for
    each million: both grow with the key, so ids are distinct and parents at least
    four years older. Ranks begin in 9999, for which ids have room up to 9.7 billion parts.
    """
    keys = t.part.where("p_partkey >= 1").select(F.col("p_partkey").cast("long").alias("key"))
    tree, first = _tree(t, generations=3), 2020
    if (keys.agg(F.max("key")).first()[0] or 0) <= KEYED:
        tree = tree.withColumns({"id_n": F.col("id"), "ancestor_n": F.col("ancestor")})
    else:
        first, ranks = 9999, cut(_ranks(keys))
        for c in ("id", "ancestor"):
            tree = tree.join(ranks.select(F.col("key").alias(c), F.col("rank").alias(f"{c}_n")).hint("merge"), c)
    millions = lambda c: F.expr(f"{c}_n div 1000000")
    year = lambda c: F.lit(first) - 4 * _depth(c) - millions(c)
    digits = lambda c: F.lpad((F.col(f"{c}_n") - millions(c) * 1_000_000).cast("string"), 6, "0")
    name = lambda c: F.when(year(c) >= 0, F.concat(F.lpad(year(c).cast("string"), 4, "0"), digits(c))).otherwise(F.raise_error(F.lit("more parts than ids of ten digits")))
    padded = lambda c: F.lpad(F.col(c).cast("string"), F.greatest(F.lit(7), F.length(F.col(c).cast("string"))), "0")
    # Written once: it is read many times.
    tree = cut(tree.select("id", name("id").alias("horse"), "path", name("ancestor").alias("ancestor"), F.col("ancestor").alias("node")))
    trees = tree.where("id % 3 = 0").select(F.col("horse").alias("id"), "path", "ancestor")
    cells = tree.where(f"{celled} and length(path) <= 2 and node % 5 <> 0").select(F.col("horse").alias("id"), "path", F.concat(F.lit("112"), padded("node")).alias("breed_no"), F.concat(F.lit("N"), F.col("node").cast("string")).alias("name"))
    known = tree.where("node % 2 = 0").select(F.concat(F.lit("N"), F.col("node").cast("string")).alias("name"), F.col("ancestor").alias("id"), F.when(F.col("path").endswith("m"), "牝").otherwise("牡").alias("sex")).distinct()
    return trees, cells, cut(known)


@query()
def graft_fixpoint(t: Tables) -> DataFrame:
    trees, cells, known = _graft(t)
    targets = cells.select("id").distinct()
    return lineage.build(targets, lineage.subtree_index(trees), cells, lineage.number_map(trees, cells), known)


@query()
def holdout_agreement(t: Tables) -> DataFrame:
    """A tenth of the trees over all part keys, held out and rebuilt; every horse has cells, for trees are rebuilt from them."""
    return lineage.holdout(*_graft(t, "true"))


@query("SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1")
def streamed_latest(t: Tables) -> DataFrame:
    return incremental.latest_snapshot_by_stream(t.spark, f"{t.sf_dir}/events.parquet", ["user_id", "event_type"], "ts", "event_id")


@query("""
SELECT user_id, event_type, max(ts) AS ts, count(*) AS n FROM events GROUP BY user_id, event_type
""")
def carry_forward_state(t: Tables) -> DataFrame:
    half = t.events.where("event_id % 2 = 0").groupBy("user_id", "event_type").agg(F.max("ts").alias("ts"), F.count("*").alias("n"))
    rest = t.events.where("event_id % 2 = 1").groupBy("user_id", "event_type").agg(F.max("ts").alias("ts"), F.count("*").alias("n"))
    return upsert.upsert(half, rest, ["user_id", "event_type"], {"ts": lambda old, new: F.greatest(old, new), "n": lambda old, new: F.coalesce(old, F.lit(0)) + F.coalesce(new, F.lit(0))})

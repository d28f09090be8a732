"""Plans over the core tables that have no harness query, on small fixtures."""

import unicodedata

from furlong.functions import scalars
from furlong.plans import reports, store
from furlong.sources import html
from pyspark.sql import functions as F


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_local_lineages(spark):
    horses = spark.createDataFrame([("2020000001", "112S", "S", None, None), ("2020000002", None, "T", "114B", "B"), ("jv:1", "112S", "S", None, None), ("2021000003", "112S", "S", None, None)], "horse_id string, sire_key string, sire string, broodmare_sire_key string, broodmare_sire string")
    ran = spark.createDataFrame([("2020000001",), ("2020000002",), ("jv:1",), ("2020000001",)], "horse_id string")
    known = spark.createDataFrame([("2020000002", "f", "a", "web"), ("2020000001", "f", "old", "local")], "horse_id string, path string, ancestor string, source string")
    assert rows(store.local_targets(horses, ran, known)) == [("2020000001",)]
    staged = spark.createDataFrame([("2020000001",)], "horse_id string")
    assert ("2020000002", "mf", "114B", "B") in rows(store.local_seeds(horses, staged)) and not any(r[0] == "2020000001" for r in rows(store.local_seeds(horses, staged)))
    built = spark.createDataFrame([("2020000001", "f", "new"), ("2020000002", "m", "never")], "horse_id string, path string, ancestor string")
    once = store.rebuild_local(known, built)
    assert rows(once) == [("2020000001", "f", "new", "local"), ("2020000002", "f", "a", "web")]
    assert rows(store.rebuild_local(once, built)) == rows(once)


def test_links_of_trainers_and_archives(spark):
    tokens = spark.createDataFrame([("p", 1, "pw05cmk000123/A1", "栗東 名 前"), ("p", 2, "pw05cmk000123/B2", "other"), ("q", 1, "pw05cnl01/00", "list")], "page string, n int, token string, label string")
    assert rows(reports.trainer_links(tokens)) == [("00123", "pw05cmk000123/A1", "名 前")]
    links = spark.createDataFrame([(1, 1, "/a/x01.pdf"), (1, 2, "/a/x01.pdf"), (1, 3, "http://h/y02.pdf"), (1, 4, "/no.html")], "page_id int, n int, link string")
    found = reports.archive_links(links, "http://b")
    assert rows(found) == [(1, "http://b/a/x01.pdf", 1), (1, "http://h/y02.pdf", 3)]
    assert rows(reports.not_at_hand(found, spark.createDataFrame([("x01.pdf",)], "name string"))) == [(1, "http://h/y02.pdf", 3)]
    places = spark.createDataFrame([("p", 1, "t1", "x", None, None, None, None), ("p", 2, "t2", "y", "05", 1, 2, "2024-01-06"), ("p", 3, "t3", "y", "05", 1, 2, "2024-01-06")], "page string, n int, token string, label string, venue_code string, meeting int, day int, date string")
    assert rows(reports.first_meeting_token(places)) == [("p", "t2")]
    assert rows(reports.pages_without_meetings(spark.createDataFrame([("p",), ("q",)], "page string"), places)) == [("q",)]


def test_tables_are_written_by_version_and_the_manifest_follows(spark, tmp_path):
    tables = store.create(spark, {"t": "a long"})
    assert tables["venues"].count() == 10 and tables["t"].count() == 0
    for version in (1, 2):
        store.commit({"venues": tables["venues"].limit(version)}, f"file://{tmp_path}", version)
    assert [spark.read.parquet(f"file://{tmp_path}/{v:06d}/venues").count() for v in (1, 2)] == [1, 2]
    files = spark.createDataFrame([("d/a.csv", "1", 5), ("d/b.csv", "2", 6)], "file_name string, sha256 string, n_rows int")
    manifest = store.files_loaded(tables["target_import_files"], files.where("sha256 = '1'"), 1, F.lit("now"))
    assert [r["file_name"] for r in store.files_to_load(files, manifest).collect()] == ["d/b.csv"]
    assert [r["file_name"] for r in store.files_to_load(files, manifest, only="a.csv", force=True).collect()] == ["d/a.csv"]
    assert store.files_to_load(files, store.files_loaded(manifest, files, 2, F.lit("later"))).count() == 0


def test_nfkc(spark):
    texts = ["（２０２４）ｱ", "plain", "", None, "ﬁ é"]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(scalars.nfkc(F.col("t"))).collect()
    assert [r[0] for r in found] == [t if t is None else unicodedata.normalize("NFKC", t) for t in texts]


def test_text_blocks_of_pages(spark):
    page = "<h1>A  title</h1><script>no</script><p>one<br>two</p><p>three</p>"
    found = spark.createDataFrame([(1, page), (2, None), (3, "")], "page_id long, html string")
    assert rows(html.blocks(found, "page_id", "html").where("tag in ('h1', 'p')").select("page_id", "tag", "text")) == [(1, "h1", "A title"), (1, "p", "one two"), (1, "p", "three")]

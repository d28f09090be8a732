"""Table operators on small tables, and their invariants."""

import random

import pytest
from furlong.operators import components, coverage, latest, lineage, match, metrics, resolve, upsert
from pyspark.sql import functions as F


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=lambda r: tuple((x is not None, x) for x in r))


def test_upsert_policies(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, None, 2.0), (3, "", None)], "k int, s string, x double")
    new = spark.createDataFrame([(2, "b", None), (3, "c", 3.0), (4, "d", 4.0)], "k int, s string, x double")
    assert rows(upsert.upsert(old, new, ["k"])) == [(1, "a", 1.0), (2, "b", None), (3, "c", 3.0), (4, "d", 4.0)]
    assert rows(upsert.upsert(old, new, ["k"], {"s": "keep"}, "coalesce")) == [(1, "a", 1.0), (2, None, 2.0), (3, "", 3.0), (4, "d", 4.0)]
    assert rows(upsert.update_only(old, new, ["k"], ["s"])) == [(1, "a", 1.0), (2, "b", 2.0), (3, "c", None)]
    for policy in ("overwrite", "coalesce", "fill_blank", "keep"):
        once = upsert.upsert(old, new, ["k"], default=policy)
        assert rows(upsert.upsert(once, new, ["k"], default=policy)) == rows(once)
    filled, audit = upsert.fill_blanks(old, new, ["k"], ["s", "x"], "t", {"x": F.lit(-1.0)})
    assert rows(filled) == [(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0), (4, "d", -1.0)]
    assert rows(audit, "row_key", "column_name") == [("2", "s"), ("3", "s"), ("3", "x")]
    again, nothing = upsert.fill_blanks(filled, new, ["k"], ["s", "x"], "t")
    assert rows(again) == rows(filled) and nothing.count() == 0
    assert rows(upsert.keep_if_touched(old, new, ["k"], F.col("x") > 3), "k") == [(1,), (4,)]
    assert rows(upsert.replace_partition(old, new.where("k = 4"), ["k"], old.where("k = 1"))) == [(2, None, 2.0), (3, "", None), (4, "d", 4.0)]
    stamped = spark.createDataFrame([(1, "2024"), (2, None)], "k int, d string")
    fresh = spark.createDataFrame([(1, "2023"), (2, "2020"), (3, None)], "k int, d string")
    assert rows(upsert.conditional_upsert(stamped, fresh, ["k"], "d")) == [(1, "2024"), (2, "2020"), (3, None)]


def test_latest(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", None, "z"), ("b", None, "p"), ("b", None, "q")], "k string, d int, v string")
    assert rows(latest.value_at_max(df, ["k"], "v", "d", "v")) == [("a", "y"), ("b", "q")]
    assert rows(latest.mode_by(df.withColumn("v", F.lit("m")), ["k"], "v", "v")) == [("a", "m", 3), ("b", "m", 2)]
    assert rows(latest.unanimous_by(df, ["k"], "v", "v")) == []
    assert rows(latest.latest_by(df, ["k"], [F.desc_nulls_last("d"), F.desc("v")]), "k", "v") == [("a", "y"), ("b", "q")]


def test_matches(spark):
    people = spark.createDataFrame([("t1", "美浦", "山田太郎", "山田太郎"), ("t2", "美浦", "山田次郎", "山田次郎"), ("t3", "栗東", "山田太郎", "山田太郎"), ("t4", "栗東", "小林", "小林")], "id string, stable string, full string, name string").withColumn("short", F.substring("full", 1, 2))
    wanted = spark.createDataFrame([("美浦", "山田太郎", "山田"), ("栗東", "小林大", "小林"), ("美浦", "山田", "山田")], "stable string, full string, short string")
    found = match.unique_match(wanted, people, ["stable", "full"], "id", fallback=["stable", "short"])
    assert rows(found, "full", "id") == [("小林大", "t4"), ("山田", None), ("山田太郎", "t1")]
    lookup = spark.createDataFrame([(1, "a", 5, 0), (1, "a", 6, 1), (None, "b", 7, 2), (None, "b", 8, 3)], "k int, n string, v int, ordinal int")
    assert rows(match.fallback_match(spark.createDataFrame([(1, "z"), (2, "b"), (None, "b"), (3, "c")], "k int, n string"), lookup, "k", "n", "v"), "n", "v") == [("b", 7), ("b", 7), ("c", None), ("z", 6)]


def test_metrics(spark):
    lead = spark.createDataFrame([("s1", 2024, 25, 5, 100, 2500, 100.0, 1.0), ("s2", 2024, 30, 3, 90, 1500, 50.0, 0.5), ("s3", 2024, 10, 1, 10, 3000, 300.0, 3.0), ("s1", 2025, 20, 2, 50, 4000, 200.0, 1.0), ("s4", 2023, 40, 4, 80, 100, 2.5, 0.0)], "entity string, yr int, n int, n_win int, n_starts int, amount int, per_unit double, idx double")
    den = metrics.field_denominators(lead, ["yr"])
    assert rows(den) == [(2024, 100.0), (2025, 200.0)]
    aei = dict(rows(metrics.weighted_index(lead, den, "entity", "yr")))
    assert aei["s1"] == pytest.approx((6500 / 45) / ((100 * 25 + 200 * 20) / 45)) and aei["s4"] is None
    totals = metrics.entity_totals(lead, den, "entity", "yr")
    fields = dict(rows(metrics.field_values(lead, den, totals, "yr")))
    assert fields["aei"] == 1.0 and fields["units"] == pytest.approx((45 + 30 + 40) / 3) and fields["amount_per_unit"] == pytest.approx((100 * 65 + 200 * 20) / 85)
    target = spark.createDataFrame([("t", 5.0), ("u", 1.0), ("v", 9.0), ("w", None)], "e string, x double")
    population = spark.createDataFrame([(1.0,), (5.0,), (5.0,), (7.0,), (None,)], "v double")
    got = dict(rows(metrics.percentile_against(target, "x", population, "v"), "e", "percentile"))
    assert got == {"t": 0.5, "u": 0.125, "v": 1.0, "w": None}
    assert [r[0] for r in spark.createDataFrame([(0.0,), (0.5,), (1.0,)], "p double").select(metrics.grade(F.col("p"))).collect()] == [1, 5, 9]


@pytest.mark.parametrize("chunk", [1, components.CHUNK])
def test_components_in_any_order(spark, monkeypatch, chunk):
    # With a chunk of one edge there is no end but that of the rounds.
    monkeypatch.setattr(components, "CHUNK", chunk)
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(500 + i, 501 + i) for i in range(40)]
    first = rows(components.connected_components(spark.createDataFrame(edges, "src long, dst long")))
    rng.shuffle(edges)
    assert rows(components.connected_components(spark.createDataFrame([(b, a) for a, b in edges], "src long, dst long"))) == first
    assert {c for n, c in first if n >= 500} == {500}
    assert components.connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_entities(spark):
    edges = [(0, 0, "1120000001", "Sunday Silence"), (0, 1, "1120000001", "サンデー"), (1, 0, "1140000009", "Sunday Silence"), (0, 0, "1120000002", "別馬"), (1, 0, "1120000002", "サンデー"), (2, 0, "1140000005", "Foreign")]
    df = spark.createDataFrame(edges, "role int, source int, number string, name string")
    found = resolve.resolve(df)
    assert rows(found.where("kind = 'refused'"), "value") == [("1120000002|サンデー",)]
    assert dict(rows(resolve.name_owner(found))) == {"Sunday Silence": "1120000001", "サンデー": "1120000001", "別馬": "1120000002", "Foreign": "1140000005"}
    used = spark.createDataFrame([("サンデー", 5, 9), ("Sunday Silence", 0, 20)], "name string, recent long, total long")
    assert dict(rows(resolve.canonical_names(found, used)))["1120000001"] == "サンデー"
    horses = spark.createDataFrame([("h1", "サンデー", None), ("h2", "x", "kept")], "id string, sire string, sire_key string")
    keyed = resolve.with_keys(horses, resolve.name_owner(found), {"sire": "sire_key"}, only_missing=True)
    assert rows(keyed, "id", "sire_key") == [("h1", "1120000001"), ("h2", "kept")]


def plain_build(horse, rel, numbers, cells, names, own):
    """The lineage of one horse, cell by cell, as a plain loop."""
    is_id = lambda n: len(n) == 10 and n.isdigit()
    tree, year = {}, int(horse[:4])

    def resolved(number, name, path):
        parent = horse if len(path) == 1 else tree.get(path[:-1])
        child = int(parent[:4]) if parent and is_id(parent) else year - 3 * (len(path) - 1)
        if number in numbers:
            return numbers[number]
        hits = {i for n, i, s in names if n == name and s in (None, "牝" if path[-1] == "m" else "牡") and is_id(i) and int(i[:4]) <= child - 3}
        return hits.pop() if len(hits) == 1 else "jv:" + number if number else None

    for path, ancestor in rel.get(horse, {}).items():
        if len(path) <= 5:
            tree[path] = ancestor
    for path, (number, name) in sorted(own.items()):
        if path not in tree and (found := resolved(number, name, path)):
            tree[path] = found
    done = set()
    while True:
        ready = sorted(((p, a) for p, a in tree.items() if (p, a) not in done and len(p) < 5), key=lambda x: (len(x[0]), x[0]))
        if not ready:
            return tree
        for path, ancestor in ready:
            done.add((path, ancestor))
            for sub, above in rel.get(ancestor, {}).items():
                if len(path + sub) <= 5:
                    tree.setdefault(path + sub, above)
            if is_id(ancestor):
                for sub, (number, name) in sorted(cells.get(ancestor, {}).items()):
                    if len(path + sub) <= 5 and path + sub not in tree and (found := resolved(number, name, path + sub)):
                        tree[path + sub] = found


def test_lineage_against_a_plain_loop(spark):
    trees = [("2020100001", p, a) for p, a in (("f", "2010100001"), ("ff", "2000100001"), ("m", "2012100001"), ("mf", "1120009"), ("mm", "2004100009"))]
    trees += [("2019100001", p, a) for p, a in (("f", "2010100001"), ("ff", "2000100001"), ("fm", "2001100005"), ("m", "2011100007"))]
    cells = [("2021100001", "f", "1120000010", "A"), ("2021100001", "m", None, "B"), ("2021100001", "mf", "1120000099", "C"), ("2020100001", "f", "1120000010", "A"), ("2019100001", "f", "1120000010", "A"), ("2012100002", "f", "1120000010", "A"), ("2012100002", "m", "1120000055", None)]
    names = [("B", "2012100002", "牝"), ("B", "2020100009", "牝"), ("D", "2012100002", None)]
    t = spark.createDataFrame(trees, "id string, path string, ancestor string")
    c = spark.createDataFrame(cells, "id string, path string, breed_no string, name string")
    n = spark.createDataFrame(names, "name string, id string, sex string")
    index, numbers = lineage.subtree_index(t), lineage.number_map(t, c)
    assert dict(rows(numbers)) == {"1120000010": "2010100001"}
    rel, own = {}, {}
    for root, path, ancestor in rows(index):
        rel.setdefault(root, {})[path] = ancestor
    for i, path, number, name in cells:
        own.setdefault(i, {})[path] = (number, name)
    assert rel["2010100001"] == {"f": "2000100001", "m": "2001100005"}
    targets = spark.createDataFrame([("2021100001",), ("2012100002",)], "id string")
    built = {}
    for i, path, ancestor in rows(lineage.build(targets, index, c, numbers, n), "id", "path", "ancestor"):
        built.setdefault(i, {})[path] = ancestor
    for i in ("2021100001", "2012100002"):
        assert built[i] == plain_build(i, rel, dict(rows(numbers)), own, names, own.get(i, {}))
    assert built["2021100001"]["m"] == "2012100002" and built["2021100001"]["mm"] == "jv:1120000055"
    check = lineage.holdout(t, c, n, fraction=1.1).first()
    assert check["held"] == 2 and check["compared"] >= check["agreeing"]


def test_coverage(spark):
    names = spark.createDataFrame([(f"ab{i:03d}",) for i in range(30)] + [("cd",), ("cde",)], "n string")
    found = dict(rows(coverage.capped_prefixes(names, "n", 11, 2, 4)))
    assert found["cd"] == 2 and found["ab00"] == 10 and sum(found.values()) == 32
    empty = names.limit(0)
    assert coverage.guarded_average(empty, "n", "m").first()["m"] == 0.0
    assert tuple(coverage.coverage_pair(names, names.where("n like 'c%'").union(names.where("n = 'cd'")), ["n"]).first()) == (2, 32)

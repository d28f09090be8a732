"""Each operator against a plain version of its contract, on awkward small tables."""

import base64
import hashlib
import pathlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from furlong.llm import decontamination, embeddings, language_id, line_dedup, mixing, simhash, token_counts, token_output, toxicity, warc
from furlong.session import shared_folder
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans string, component long"


def words(n, seed, vocabulary=40):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    base = words(60, 1, 10_000)
    near = base.replace(base.split()[30], "changed", 1)
    common = "A common line, seen everywhere"
    rows = [(None, "en", "a"), ("", "en", "a"), (" \t\n ", "fr", "b"), ("...!!", None, None), (base, "en", "a"), (base, "en", "b"), (near, "de", None)]
    rows += [(f"{common}\n{words(20, 100 + i, 5_000)}\r\n  {common.upper()} \n", "en", "b") for i in range(12)]
    rows += [(words(30_000, 7, 3_000), "en", "a"), ("é" * 5_000 + " Ünïcode", "fr", "c"), ("x\ty z " * 30, "en", "c")]
    return [(i, t, lang, source, None, "clash", 5) for i, (t, lang, source) in enumerate(rows)] + [(4, base, "en", "a", None, "clash", 5), (None, "no id", None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(texts, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def key(row):
    return tuple((x is not None, x) for x in row)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=key)


# 1


def plain_words(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def plain_contamination(texts, items, size=13):
    windows = {}
    for item, text in items:
        own = plain_words(text)
        n = min(size, len(own))
        for i in range(len(own) - n + 1 if n else 0):
            windows.setdefault(tuple(own[i : i + n]), set()).add(item)
    out = []
    for doc_id, text in texts:
        own, hit, found = plain_words(text), set(), set()
        for i in range(len(own)):
            for n in {len(w) for w in windows}:
                if i + n <= len(own) and (w := tuple(own[i : i + n])) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[w] - {None}
        listed = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((doc_id, len(own), len(hit), len(found), listed, len(hit) > 0 and 20 * len(hit) >= len(own)))
    return sorted(out, key=key)


def test_decontamination(spark, docs, texts, empty):
    base = texts[4][1].split()
    items = [(3, " ".join(base[5:25])), (10, "common LINE, seen"), (7, ""), (8, None), (9, "..."), (10, "common line seen"), (None, " ".join(base[40:55])), (2, "Ünïcode")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    expected = plain_contamination([(t[0], t[1]) for t in texts], items)
    assert rows(decontamination.report(docs, benchmark), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == expected
    kept = decontamination.remove_documents(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(map(key, kept.select("doc_id").collect())) == sorted(key((e[0],)) for e in expected if not e[5])
    cut = {r["doc_id"]: r for r in decontamination.remove_spans(docs, benchmark).collect()}
    assert cut[7]["n_removed"] == 6 and "common" not in cut[7]["text"].lower()
    assert decontamination.report(empty, benchmark).count() == 0
    assert {r["n_hit"] for r in decontamination.report(docs, benchmark.limit(0)).collect()} == {0}


def test_decontamination_in_blocks(docs, spark, monkeypatch):
    text = docs.where("doc_id = 4").first()["text"].split()
    benchmark = spark.createDataFrame([(i, " ".join(text[i : i + 14])) for i in range(0, 40, 5)], "item_id long, text string")
    whole = rows(decontamination.report(docs, benchmark), "doc_id", "n_hit", "n_items", "items_sha256")
    kept = rows(decontamination.remove_documents(docs, benchmark))
    monkeypatch.setattr(decontamination, "MAX_INDEX_BYTES", 160)
    assert rows(decontamination.report(docs, benchmark), "doc_id", "n_hit", "n_items", "items_sha256") == whole
    assert rows(decontamination.remove_documents(docs, benchmark)) == kept


# 2


def test_language_id(spark, docs, empty):
    rng = random.Random(3)
    stems = {"xx": "babi lomu tefa rin sol", "yy": "krsk zvit prum nohl tvar", "zz": "ñande óiga çelu êtu ßard"}
    train = [(i, " ".join(rng.choice(stems[lang].split()) + rng.choice("aeiou") for _ in range(60)), lang) for i, lang in enumerate(list(stems) * 40)]
    table = spark.createDataFrame(train, "doc_id long, text string, lang string")
    model = language_id.learn(table.where("doc_id < 90"))
    found = language_id.identify(table.where("doc_id >= 90"), model, keep=("lang",)).collect()
    assert all(r["lang_pred"] == r["lang"] and 0 < r["score"] <= 1 for r in found)
    odd = {r["doc_id"]: r for r in language_id.identify(docs, model).collect()}
    assert [odd[i]["lang_pred"] for i in range(4)] == ["und"] * 4 and len(odd) == len({t["doc_id"] for t in docs.collect()})
    assert odd[19]["lang_pred"] in stems
    assert language_id.identify(empty, model).count() == 0
    nothing = language_id.learn(empty)
    assert {r["lang_pred"] for r in language_id.identify(docs, nothing).collect()} == {"und"}


def test_bitmask_filter_finds_every_inserted_gram():
    grams = {"a": language_id.gram_hashes(language_id.normal("alpha beta"), 3), "b": language_id.gram_hashes(language_id.normal("beta gamma"), 3)}
    both = language_id.BitmaskFilter(grams, ["a", "b"], slots_log2=10)
    for name, hashes in grams.items():
        mask = np.bitwise_and.reduce([both.slots[0][p] for p in both._places(hashes)])
        assert ((mask >> both.languages.index(name)) & 1).all()


def test_counts_are_those_of_plain_sets_corrected_for_chance():
    rng = random.Random(33)
    text = {name: " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 8))) for _ in range(400)) for name, letters in (("a", "abcdef"), ("b", "cdefgh"), ("c", "ñçêßo"))}
    grams = {name: np.unique(np.concatenate(list(language_id.pieces(language_id.normal(t))))) for name, t in text.items()}
    filter_ = language_id.BitmaskFilter(grams, list(grams), slots_log2=14)
    sets = {name: set(own.tolist()) for name, own in grams.items()}
    for case in range(60):
        sample = " ".join(rng.sample(text[rng.choice("abc")].split(), 30))
        found, n = filter_.counts(sample)
        own = [g for part in language_id.pieces(language_id.normal(sample)) for g in part.tolist()]
        plain = [sum(g in sets[name] for g in own) for name in grams]
        assert n == len(own) and np.abs(found - plain).max() <= 0.1 * n, case
        assert int(np.argmax(found)) == int(np.argmax(plain))


def test_a_language_of_one_document_is_learned(spark):
    train = [(i, "the quick brown fox and the lazy dog", "en") for i in range(30)] + [(90, "ñandú çelik été ßtraße", "zz")]
    model = language_id.learn(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    assert model.predict("été ßtraße")[0] == "zz" and model.predict("the brown dog")[0] == "en"


def test_pieces_cover_long_texts(monkeypatch):
    text = words(3_000, 5)
    whole = np.sort(np.concatenate(list(language_id.pieces(language_id.normal(text)))))
    monkeypatch.setattr(language_id, "PIECE", 1_000)
    assert (np.sort(np.concatenate(list(language_id.pieces(language_id.normal(text))))) == whole).all()


# 3


def test_toxicity(spark, docs, empty):
    rng = random.Random(4)
    data, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        text = words(30, i) + (". You vilething " + rng.choice(["rotbag", "scumlet", "vilething"]) if toxic else ".")
        # Groups are named in toxic sentences more often than in others.
        text += " The woman came." if rng.random() < (0.8 if toxic else 0.1) else ""
        data.append((i, text))
        labels.append((i, int(toxic)))
    table = spark.createDataFrame(data, "doc_id long, text string")
    known = spark.createDataFrame([*labels, (5_000, 1), (0, 1), (None, 1), (7, None)], "doc_id long, toxic int")
    model = toxicity.learn(table, known)
    scores = {r["doc_id"]: r for r in toxicity.score(table, model).collect()}
    assert all(scores[i]["predicted"] == label for i, label in labels)
    assert abs(model.score("The woman came.") - model.score("The man came.")) < 0.02
    assert model.score("The woman came.") < toxicity.THRESHOLD
    odd = toxicity.score(docs, model).collect()
    assert len(odd) == docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    kept = toxicity.remove_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert toxicity.score(empty, model).count() == 0
    bare = toxicity.learn(empty, known)
    assert toxicity.score(docs, bare).count() == docs.count()


def test_counterfactual_penalty_lowers_the_change_of_scores():
    rows_ = [(1, [0, 2])] * 30 + [(0, [1])] * 30 + [(1, [0])] * 5 + [(0, [2, 1])]
    changes = toxicity.squares([[(2, 1), (3, -1)]] * 10, 4)
    free, _ = toxicity.fit(rows_, np.zeros((4, 4)), 4)
    bound, _ = toxicity.fit(rows_, changes, 4, weight=10.0)
    assert abs(bound[2] - bound[3]) < 0.2 * abs(free[2] - free[3])


def test_fit_finds_what_plain_gradient_descent_finds():
    rng = random.Random(12)
    rows_ = [(int(rng.random() < 0.3), sorted(rng.sample(range(6), rng.randrange(0, 5)))) for _ in range(300)]
    pairs = [([0, 1], [2]), ([3], [4]), ([3], [4, 5])] * 4
    changes = toxicity.squares([[*((i, 1) for i in a), *((j, -1) for j in b)] for a, b in pairs], 6)
    weights, bias = toxicity.fit(rows_, changes, 6, weight=0.5, ridge=0.2)
    x, y = np.zeros((300, 6)), np.array([label for label, _ in rows_], float)
    for i, (_, own) in enumerate(rows_):
        x[i, own] = 1
    w, c = np.zeros(6), 0.0
    for _ in range(20_000):
        error = 1 / (1 + np.exp(-(x @ w + c))) - y
        slope = x.T @ error + 2 * 0.2 * w
        for a, b in pairs:
            change = w[a].sum() - w[b].sum()
            slope[a] += 2 * 0.5 * change
            slope[b] -= 2 * 0.5 * change
        w, c = w - 0.004 * slope, c - 0.004 * error.sum()
    assert np.abs(weights - w).max() < 1e-3 and abs(bias - c) < 1e-3


def test_sentences_that_name_groups_are_summed_on_the_executors(spark):
    data = [(i, f"filler{i % 3} words. The {rng_term} came here" + (" rotbag" if i % 2 else ""), i % 2) for i, rng_term in enumerate(["woman", "femme", "frau", "mujer"] * 20)]
    table = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string")
    known = spark.createDataFrame([(i, label) for i, _, label in data], "doc_id long, toxic int")
    model = toxicity.learn(table, known)
    for a, b in (("woman", "man"), ("femme", "homme"), ("frau", "mann"), ("mujer", "hombre")):
        assert abs(model.score(f"The {a} came") - model.score(f"The {b} came")) < 0.02
        assert model.score(f"The {a} came") < toxicity.THRESHOLD < model.score(f"The {a} came rotbag")


# 4


def plain_fingerprint(text):
    own = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not own:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(own[i : i + 3]).encode(), 42) for i in range(max(1, len(own) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(n, linked):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def test_simhash(docs, texts, empty):
    prints = [plain_fingerprint(t[1]) for t in texts]
    labels = plain_components(len(texts), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    least = {}
    for t, label in zip(texts, labels, strict=True):
        if t[0] is not None:
            least[label] = min(least.get(label, t[0]), t[0])
    expected = sorted(((t[0], f"{p:016x}", least.get(label)) for t, p, label in zip(texts, prints, labels, strict=True)), key=key)
    assert rows(simhash.classes(docs).withColumn("f", simhash.fingerprint_text()), "doc_id", "f", "component_id") == expected
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(set(least.values()))
    assert simhash.classes(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_keep_one_with_null_and_reused_ids(spark):
    text = [words(40, 900 + i, 10_000) for i in range(9)]
    # By component: no id at all, an id besides null, the least id of two components, an id that is the least of one only.
    table = [(None, text[0], 1), (None, text[0], 2), (None, text[1], 3), (None, text[2], 4), (5, text[2], 5), (7, text[3], 6), (7, text[4], 7), (7, text[4], 8), (8, text[5], 9), (8, text[6], 10), (2, text[6], 11), (9, text[7], 12), (None, None, 13), (None, " ", 14)]
    kept = simhash.keep_one(spark.createDataFrame(table, "doc_id long, text string, fp long").repartition(3)).collect()
    found = sorted(((r["doc_id"], (r["text"] or "").strip()) for r in kept), key=key)
    assert found == sorted([(None, text[0]), (None, text[1]), (5, text[2]), (7, text[3]), (7, text[4]), (8, text[5]), (2, text[6]), (9, text[7]), (None, "")], key=key)
    assert all((r["doc_id"], r["text"], r["fp"]) in table for r in kept)


def test_links_of_fingerprints_also_in_split_buckets(spark):
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(12)]
    prints = {c for c in centres}
    while len(prints) < 700:
        p = rng.choice(sorted(prints))
        for _ in range(rng.randrange(1, 5)):
            p ^= 1 << rng.randrange(64)
        prints.add(p)
    prints = sorted(prints)
    labels = plain_components(len(prints), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    table = spark.createDataFrame([(s,) for s in signed], "fp long")
    for crowd in (4_096, 40):
        parent = dict(zip(signed, signed, strict=True))

        def root(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for r in simhash.links(table, crowd=crowd).collect():
            a, b = root(r["src"]), root(r["dst"])
            parent[max(a, b)] = min(a, b)
        groups = [root(s) for s in signed]
        assert len(set(zip(groups, labels, strict=True))) == len(set(groups)) == len(set(labels))


# 5


def plain_lines(texts, least=10):
    strip = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line))
    seen = {}
    for doc_id, text in texts:
        for line in (text or "").split("\n"):
            seen.setdefault(strip(line), set()).add(doc_id)
    out = []
    for doc_id, text in texts:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (strip(x) and len(seen[strip(x)]) >= least)]
        out.append((doc_id, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=key)


def test_line_dedup(docs, texts, empty):
    expected = plain_lines([(t[0], t[1]) for t in texts])
    assert rows(line_dedup.report(docs), "doc_id", "n_lines", "n_dropped", "kept_sha256") == expected
    assert sum(e[2] for e in expected) == 24
    assert line_dedup.report(empty).count() == 0


def test_hot_line_over_many_partitions(spark):
    table = [(i, f"hot\n{i}\n" + ("hot\n" if i % 3 == 0 else "") + f"shared {i % 50}") for i in range(600)]
    df = spark.createDataFrame(table, "doc_id long, text string")
    assert rows(line_dedup.report(df), "doc_id", "n_lines", "n_dropped", "kept_sha256") == plain_lines(table)
    firsts = line_dedup.apply_bitmaps(df, line_dedup.keep_bitmaps(df, rule="first"))
    seen, expected = set(), []
    for doc_id, text in table:
        kept = []
        for line in text.split("\n"):
            if line not in seen:
                kept.append(line)
            seen.add(line)
        expected.append((doc_id, "\n".join(kept)))
    assert rows(firsts, "doc_id", "kept") == expected


def test_bitmaps_round_trip():
    keep = line_dedup.unpack(line_dedup.pack([0, 9, 70], 71), 71)
    assert list(np.flatnonzero(~keep)) == [0, 9, 70]


# 6


@pytest.mark.parametrize(("cell", "block_dims"), [(32_768, 16), (60, 8)])
def test_embeddings(spark, cell, block_dims):
    rng = np.random.default_rng(6)
    vectors = list(rng.standard_normal((300, 32)))
    vectors += [vectors[i % 40] + rng.standard_normal(32) * rng.choice([0.05, 0.2, 0.3]) for i in range(200)]
    vectors += [vectors[3]] * 5 + [vectors[3] * 7.0]
    table = [(1000 - i, [float(x) for x in np.float32(v)], 1) for i, v in enumerate(vectors)]
    table += [(2001, None, 1), (2002, [], 1), (2003, [0.0] * 32, 1), (2004, [1.0] * 31 + [float("nan")], 1), (2005, [None] + [1.0] * 31, 1), (2006, [float("inf")] * 32, 1), (2007, [1.0, 2.0], 1), (2008, [1.0, 2.0], 1), (None, table[0][1], 1)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<float>, label int")
    good = [(i, np.array(v)) for i, v, _ in table if i is not None and v and i not in (2003, 2004, 2005, 2006)]
    cosine = lambda a, b: len(a) == len(b) and a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= 0.95
    links = {i: [j for j, w in good if j != i and cosine(v, w)] for i, v in good}
    label = {i: i for i, *_ in table if i is not None}
    changed = True
    while changed:
        changed = False
        for i, others in links.items():
            low = min([label[i], *(label[j] for j in others)])
            changed |= low != label[i]
            label[i] = low
    expected = sorted(((i, len(links.get(i, [])), label.get(i), i is not None and label.get(i) == i) for i, *_ in table), key=key)
    found = rows(embeddings.near_duplicates(df, cell=cell, block_dims=block_dims), "vec_id", "n_links", "component_id", "kept")
    assert found == expected
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [600, 2_400])
def test_no_task_holds_more_than_two_parts_of_a_cell(spark, n):
    table = [(i, [float(x) for x in v]) for i, v in enumerate(np.random.default_rng(n).standard_normal((n, 64)))]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>")
    distinct = embeddings.with_turned(embeddings.distinct_vectors(df, "vec_id", "embedding")[1]).cache()
    held = embeddings.deal(distinct, 0.95, 16, 2, 100).groupBy("cell", "part").count().agg(F.max("count"), F.count("*")).first()
    assert held[0] <= 2 * 100 * 1.5 and held[1] > 16


def test_vectors_are_not_sent_to_each_task(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "deal", None)
    # With the first two, a cosine that single precision cannot tell from 0.95.
    side = float(np.sqrt(1 - 0.95**2))
    vectors = [[1.0, 0.0], [0.95 + 1e-9, side], [0.95 - 1e-9, -side], [-0.0, -1.0], [0.0, -1.0]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = rows(embeddings.near_duplicates(df, cell=1, block_dims=1), "vec_id", "n_links", "component_id")
    assert found == [(0, 1, 0), (1, 1, 0), (2, 0, 2), (3, 1, 3), (4, 1, 3)]


# 7


def test_warc(spark):
    pages = [(i, f"http://{'www.' if i % 2 else ''}host{i % 5}.example.com/p{i % 40}?b=1&a={i}", f"<p>{i % 30}</p>é") for i in range(300)]
    pages += [(900, None, None), (901, "", ""), (902, "nowhere", None), (904, "http://[::1/x", "y"), (903, "http://a.example/ü\nx", "<x>" * 50_000), (5, pages[5][1], pages[5][2]), (None, "http://a.example/", "<p>only</p>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(7)
    first = {}
    for i, _, h in pages:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    expected = []
    for i, _, h in pages:
        data = (h or "").encode()
        revisit = first.get(h or "", i) != i
        expected.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", first[h or ""] if revisit else None))
    out = warc.report(df).cache()
    assert rows(out, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == sorted(expected, key=key)
    keys = [r["url_key"] for r in out.orderBy("capture_no").collect()]
    assert keys == sorted(keys) and sorted(r["capture_no"] for r in out.collect()) == list(range(len(pages)))
    assert warc.report(df.limit(0)).count() == 0


def test_two_attempts_write_the_same_archives(spark):
    pages = [(i % 40 or None, f"http://h{i % 7}.example/{i}", f"<p>{i % 9}</p>") for i in range(200)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = []
    for parts in (3, 5):
        folder = shared_folder(spark, "warc")
        warc.write_archives(df.repartition(parts, F.rand(parts)), folder)
        path = folder.removeprefix("file://")
        found.append({str(f.relative_to(path)): f.read_bytes() for f in sorted(pathlib.Path(path, "archive").iterdir())})
    assert found[0] == found[1]


def test_merge_in_passes_and_ranges(spark):
    pages = spark.createDataFrame([(i, f"http://h{i % 3}.example/{i % 11}", f"{i}") for i in range(500)], "page_id long, url string, html string").repartition(9)
    folder = shared_folder(spark, "warc")
    catalog = warc.merge_runs(warc.write_archives(pages, folder), folder, fan_in=2, range_rows=50)
    found = [(r["url_key"], r["ts"], r["page_id"]) for r in warc.histories(catalog).orderBy("capture_no").collect()]
    assert found == sorted(found) and len(set(found)) == 500


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 8])
def test_loser_tree(k):
    rng = random.Random(k)
    runs = [sorted([(f"k{rng.randrange(9)}", "t", rng.randrange(50), f"f{i}", j) for j in range(rng.randrange(0, 30))], key=warc.order) for i in range(k)]
    assert list(warc.LoserTree([iter(r) for r in runs])) == sorted((x for r in runs for x in r), key=warc.order)


def test_revisit_and_response_records():
    member = warc.record(7, "http://a/", "2020-01-01T00:00:00Z", b"payload", warc.sha1(b"payload"), None, 7)
    head, payload = warc.parse_record(zlib.decompress(member, 31))
    assert payload == b"payload" and head["WARC-Type"] == "response" and warc.record_id(head["WARC-Record-ID"]) == 7


# 8


@pytest.fixture(scope="module")
def tokenizer():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_token_output(spark, docs, texts, empty, tokenizer):
    encoded = []
    for t in texts:
        ids = np.array([*tokenizer.encode(t[1] or "", add_special_tokens=False).ids, 2], "<u4")
        encoded.append((t[0], zlib.crc32(ids.tobytes()), len(ids)))
    at, expected = 0, []
    for doc_id, crc, n in sorted(encoded, key=key):
        expected.append((doc_id, at, n, crc))
        at += n
    assert rows(token_output.report(docs), "doc_id", "start", "n_tokens", "ids_crc32") == sorted(expected, key=key)
    assert rows(token_output.report(docs, file_docs=4), "doc_id", "start", "n_tokens", "ids_crc32") == sorted(expected, key=key)
    assert token_output.report(empty).count() == 0


def test_ids_are_those_of_whole_texts(tokenizer):
    rng = random.Random(8)
    own = token_output.encoder(token_output.TOKENIZER)
    parts = ["a", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|", "|>", " ", "\n", "J\u030c", "H\u0331", "T\u0308", "\u0301", "e", "E", "\u00c9", "\u03a3", "\u0130", "\u212a", "\u0341", ".", ",", "Don't", "'S", "12", "Word", "\ufb01", "\u3000", "\u0591", "\u65e5\u672c", "\u1100\u1161"]
    texts = ["a <|endoftext|> b", "in<|startoftext|>word", "<|endo ftext|>", *("".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(4_000))]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode([t.encode() for t in texts])] == [x.ids for x in tokenizer.encode_batch(texts, add_special_tokens=False)]
    other = token_output.Encoder("byte_bpe_50k.json")
    assert not other.by_piece and np.frombuffer(other.encode([b"A cased  Text"])[0], "<u4").tolist() == other.tokenizer.encode("A cased  Text", add_special_tokens=False).ids


def test_words_before_punctuation_are_learned_without_a_call_each(tokenizer, monkeypatch):
    own, calls = token_output.Encoder(), []
    ask = own._one_by_one
    monkeypatch.setattr(own, "_one_by_one", lambda texts: calls.extend(texts) or ask(texts))
    rng = random.Random(9)
    texts = [" ".join("".join(rng.choices("abe\u00e9\u00f1", k=6)) + rng.choice(["***", ",%%%", "!!", "."]) for _ in range(300)) for _ in range(5)]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode([t.encode() for t in texts])] == [x.ids for x in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert len(calls) <= 4


def test_ids_do_not_hang_on_chunks_and_memory(tokenizer, monkeypatch):
    rng = random.Random(10)
    parts = ["a", "Z", "\u0130", "\u0131", "\u00e9", "\u00c9", "\u00aa", "\u00d7", "\u0436", "\u03a3", "\u00b2", "\u00a0", "\u0338", "\t", "\x00", "\x7f", "\u65e5", *"  \n.,;'-_@#0123456789", "'s", "'LL", "don't", "a.b@c.org", "10.0.0.1", "<|endoftext|>", "<|"]
    texts = [None, "", " ", "\n \n", *("".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(1_500))]
    expected = [x.ids for x in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for chunk, memory, size in ((1, 500_000, 1 << 25), (100, 40, 1 << 25), (4 << 20, 500_000, 300)):
        own = token_output.Encoder()
        own.CHUNK = chunk
        monkeypatch.setattr(token_output, "MEMORY", memory)
        monkeypatch.setattr(token_output, "MEMORY_BYTES", size)
        for _ in range(2):
            assert [np.frombuffer(x, "<u4").tolist() for x in own.encode([None if t is None else t.encode() for t in texts])] == expected


def test_ids_that_are_no_whole_numbers_are_refused(spark):
    docs = spark.createDataFrame([("a", "text", "p")], "doc_id string, text string, url string")
    for call in (lambda: token_output.report(docs), lambda: warc.report(docs, page_id="doc_id", html="text")):
        with pytest.raises(TypeError):
            call()


def test_one_document_is_read_by_itself(tmp_path, tokenizer):
    from furlong.llm.storage import Writer, reader

    uri = f"file://{tmp_path}/a.ids.zst"
    bodies = [np.arange(n, dtype="<u4").tobytes() for n in (1, 5, 600_000, 2)]
    with Writer(uri) as out:
        seekable = token_output.SeekableWriter(out)
        for i, body in enumerate(bodies):
            seekable.add(i * 10 if i else None, token_output.frames_of(body))
        seekable.close()
    file, size = reader(uri)
    source = token_output.SeekableReader(file, size)
    assert [d for d, _ in source.docs] == [None, 10, 20, 30]
    assert source.docs[2][1] == 3 and (source.ids(2) == np.arange(600_000)).all() and list(source.ids(3)) == [0, 1]
    damaged = bytearray((tmp_path / "a.ids.zst").read_bytes())
    damaged[int(source.offsets[1]) + 9] ^= 1
    (tmp_path / "b.ids.zst").write_bytes(bytes(damaged))
    file, size = reader(f"file://{tmp_path}/b.ids.zst")
    with pytest.raises(Exception):  # noqa: B017  the library's own error or ours
        token_output.SeekableReader(file, size).ids(1)


# 9


def test_token_counts_follow_edits():
    pytest.importorskip("public_tokenizers")
    tool = token_counts.counter(token_counts.RANKS)
    rng = random.Random(9)
    count = lambda t: len(tool.encoding.encode_ordinary(t))
    pieces = ["word", " ", "  ", "\n\n", "don't", "123", "é", "!?", " the", "\t", "'s", "'", "r", "e", "日本", "x" * 90]
    for case in range(400):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(0, 400)))
        tree = token_counts.CountTree(*token_counts.segments(text, tool, rng.choice([1, 2, 5, 64])), tool)
        assert tree.total == count(text)
        for _ in range(4):
            a = rng.randrange(0, len(text) + 1)
            b = min(len(text), a + rng.choice([0, 1, 3, 40, 300]))
            new = "".join(rng.choice(pieces) for _ in range(rng.choice([0, 1, 5])))
            tree.edit(a, b, new)
            text = text[:a] + new + text[b:]
            assert "".join(tree.texts) == text and tree.total == count(text), case


EDITS = "doc_id long, start int, end int, new string"


def test_token_counts(spark, docs, texts, empty):
    pytest.importorskip("public_tokenizers")
    tool = token_counts.counter(token_counts.RANKS)
    count = lambda t: len(tool.encoding.encode_ordinary(t))
    swap = lambda t: re.sub(token_counts.REDACT, token_counts.PLACEHOLDER, t or "", flags=re.ASCII)
    expected = sorted(((t[0], count(t[1] or ""), len(re.findall(token_counts.REDACT, t[1] or "", re.ASCII)), count(swap(t[1]))) for t in texts), key=key)
    assert rows(token_counts.edited_counts(docs), "doc_id", "n_tokens", "n_edits", "n_tokens_after") == expected
    table = spark.createDataFrame([(1, "mail a.b@c.org or 10.0.0.1 now", 9), (3, "abc", 9), (3, "abc", 9)], "doc_id long, text string, n_tokens int")
    own = {r["doc_id"]: r for r in token_counts.edited_counts(table).collect()}
    assert own[1]["n_edits"] == 2 and own[1]["n_tokens_after"] == count("mail <redacted> or <redacted> now") and own[3]["n_chars_reencoded"] == 0
    assert token_counts.edited_counts(empty).count() == 0


def test_edits_of_a_kept_table_and_refused_edits(spark, tmp_path):
    pytest.importorskip("public_tokenizers")
    tool = token_counts.counter(token_counts.RANKS)
    rng = random.Random(19)
    text = {i: words(200, 60 + i, 900) for i in range(12)} | {50: "", 51: None}
    trees = token_counts.build(spark.createDataFrame(list(text.items()), "doc_id long, text string"), segment=8)
    for turn in range(3):
        path = f"file://{tmp_path}/trees{turn}"
        trees.write.parquet(path)
        edits, refused = [], 0
        for i in range(12):
            places = sorted(rng.sample(range(len(text[i])), 6))
            own = [(a, b, rng.choice(["", "x", " new words"])) for a, b in zip(places[::2], places[1::2], strict=True)]
            edits += [(i, *e) for e in own]
            for a, b, new in reversed(own):
                text[i] = text[i][:a] + new + text[i][b:]
        n = len(text[0])
        bad = [(0, None, 1, "x"), (0, 0, None, "x"), (0, 0, 1, None), (0, -3, 1, "x"), (0, 5, 4, "x"), (0, 0, n + 9_999, "x"), (51, 0, 0, "x"), (77, 0, 0, "x")]
        after = token_counts.apply_edits(spark.read.parquet(path), spark.createDataFrame(edits + bad, EDITS))
        refused = {r["doc_id"]: r["n_refused"] for r in after.collect()}
        assert refused[0] == 6 and refused[51] == 1 and sum(refused.values()) == 7
        assert {r["doc_id"]: r["text"] for r in token_counts.text_of(after).collect()} == text
        assert all(r["n_tokens"] == len(tool.encoding.encode_ordinary(text[r["doc_id"]] or "")) and r["n_chars"] == len(text[r["doc_id"]] or "") for r in after.collect())
        trees = after
    long = token_counts.build(spark.createDataFrame([(1, words(9_000, 3, 900))], "doc_id long, text string"))
    once = token_counts.apply_edits(long, spark.createDataFrame([(1, 20_000, 20_010, "new")], EDITS)).first()
    assert once["n_edits"] == 1 and 0 < once["n_chars_reencoded"] < 1_000
    assert token_counts.accept([(3, 5, "b"), (3, 3, "a"), (4, 4, "c"), (5, 5, "d")], 9) == [(3, 3, "a"), (3, 5, "b"), (5, 5, "d")]
    assert token_counts.apply_edits(trees.limit(0), spark.createDataFrame([], EDITS)).count() == 0


# 10


def test_mixing(spark, docs, texts, empty):
    sizes = {}
    for t in texts:
        sizes.setdefault(t[3], []).append((t[0], len(re.findall(r"[^\x20\x09-\x0D]+", t[1] or ""))))
    names = sorted(sizes, key=lambda s: (s is None, s))
    total = {s: sum(n for _, n in sizes[s]) for s in names}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    while True:
        left = sum(total.values()) - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] >= 3 * total[s]}
        if not over:
            target |= share
            break
        target |= {s: 3.0 * total[s] for s in over}
        open_ -= over
    out = mixing.mix(docs).collect()
    assert rows(mixing.mix(docs), "doc_id", "size") == sorted(((t[0], len(re.findall(r"[^\x20\x09-\x0D]+", t[1] or ""))) for t in texts), key=key)
    taken = {}
    for r in out:
        assert r["taken"] <= 3 * r["size"] and r["source_size"] == total[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert all(abs(taken[s] - target[s]) < 1 for s in names)
    assert rows(mixing.mix(docs.repartition(5)), "doc_id", "size", "taken") == rows(mixing.mix(docs), "doc_id", "size", "taken")
    kept = mixing.repeat_documents(docs.withColumnRenamed("spans", "mix_nth"))
    assert kept.columns == [c if c != "spans" else "mix_nth" for c in docs.columns]
    assert mixing.mix(empty).count() == 0 and mixing.repeat_documents(empty).count() == 0


def test_schedule_is_of_low_discrepancy(spark):
    table = [(i, " ".join(["w"] * 400), f"s{i % 4}") for i in range(400)]
    df = spark.createDataFrame(table, "doc_id long, text string, source string")
    mix = mixing.plan(df, block=100)
    slots = [r["n"] for r in mix.slots.orderBy("slot").collect()]
    share = {n: slots.count(n) / len(slots) for n in set(slots)}
    for at in range(100, len(slots), 100):
        for n, s in share.items():
            assert abs(slots[:at].count(n) - s * at) <= 12
    nth = mix.slots.groupBy("n").agg(F.count_distinct("nth").alias("d"), F.max("nth").alias("m"), F.count("*").alias("c")).collect()
    assert all(r["d"] == r["c"] == r["m"] + 1 for r in nth)


def test_pipeline_stages_keep_columns(spark, tmp_path, docs, texts):
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline

    folder = str(tmp_path)
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars").where("doc_id is not null")
    plain.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(4, 1, 0), (7, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, " ".join(texts[8][1].split()[5:20]))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "decontamination", "mixing", "tokens"]
    table = spark.read.parquet(f"{folder}/documents.parquet")
    after = corpus_pipeline.drop_near_copies(spark, table, folder)
    assert after.columns == table.columns
    ids = [r["doc_id"] for r in after.collect()]
    assert len(ids) == len(set(ids)) and 0 in ids and 4 in ids and 5 not in ids and 1 not in ids
    clean = {r["doc_id"] for r in corpus_pipeline.drop_contaminated(spark, table, folder).collect()}
    assert 8 not in clean and {9, 10, 19} <= clean
    out = corpus_pipeline.run(spark, folder).collect()
    assert out and {"doc_id", "start", "n_tokens", "ids_crc32"} == set(out[0].asDict())
    starts = sorted((r["start"], r["n_tokens"]) for r in out)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False))


def plain_targets(total):
    """Targets of sources by weight, cut at three times their size."""
    names = sorted(total, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    while True:
        left = sum(total.values()) - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] >= 3 * total[s]}
        if not over:
            return target | share
        target |= {s: 3.0 * total[s] for s in over}
        open_ -= over


def plain_mix(table):
    """(id, text) as often as the mix begins to take them."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    total = {}
    for _, text, source in table:
        total[source] = total.get(source, 0) + size(text)
    out = []
    for source, target in plain_targets(total).items():
        own = sorted((r for r in table if r[2] == source), key=lambda r: (hashlib.md5(f"42:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[0] is not None, r[0], size(r[1])))
        at, whole, rest = 0, *divmod(int(target), total[source] or 1)
        for doc_id, text, _ in own:
            n = size(text)
            taken = whole * n + max(0, min(at + n, rest) - at)
            out += [(doc_id, text)] * (-(-taken // n) if n else 1)
            at += n
    return sorted(out, key=key)


def test_pipeline_stages_against_plain_versions(spark, tmp_path, texts, tokenizer):
    import corpus_pipeline
    from furlong.llm.queries import toxicity_model

    folder = str(tmp_path)
    data = [(i, t, "en", s, 0) for i, t, _, s, *_ in texts if i != 4] + [(4, texts[4][1], "en", "a", 0), (90, words(30, 90, 9_000) + " vilething", "en", "a", 0), (None, words(50, 91, 9_000), "fr", None, 0)]
    train = [(200 + i, words(25, 300 + i, 9_000) + (" vilething rotbag" if i % 3 == 0 else ""), "en", "bd"[i % 2], 0) for i in range(120)]
    spark.createDataFrame(data + train, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(200 + i, 1, int(i % 3 == 0)) for i in range(120)] + [(None, 1, 1), (90, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = [(1, " ".join(texts[8][1].split()[5:20])), (2, None), (None, "vile")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    def through(name):
        path = f"{folder}/after-{name}"
        stages[name](spark, docs, folder).write.parquet(path)
        return spark.read.parquet(path)

    def pairs(table):
        return sorted(((r["doc_id"], r["text"]) for r in table.collect()), key=key)

    model = toxicity_model(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    expected = [r for r in pairs(docs) if model.score(r[1]) < toxicity.THRESHOLD]
    docs = through("toxicity")
    assert pairs(docs) == expected and not any("vilething rotbag" in (t or "") for _, t in expected) and (0, None) in expected

    prints = [plain_fingerprint(t) for _, t in expected]
    labels = plain_components(len(expected), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    least = {}
    for (doc_id, _), label in zip(expected, labels, strict=True):
        least[label] = min((x for x in (least.get(label), doc_id) if x is not None), default=None)
    docs = through("simhash")
    kept = pairs(docs)
    found = {r: label for r, label in zip(expected, labels, strict=True)}
    assert sorted(found[r] for r in kept) == sorted(least) and all(r[0] == least[found[r]] for r in kept)

    judged = plain_contamination([(i, t) for i, (_, t) in enumerate(kept)], items)
    docs = through("decontamination")
    expected = sorted((kept[i] for i, *_, bad in judged if not bad), key=key)
    assert pairs(docs) == expected and len(expected) < len(kept)

    table = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    docs = through("mixing")
    assert pairs(docs) == plain_mix(table)

    at, expected = 0, []
    ids = [(doc_id, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")) for doc_id, t in pairs(docs)]
    for doc_id, own in sorted(ids, key=lambda x: (x[0] is not None, x[0], zlib.crc32(x[1].tobytes()))):
        expected.append((doc_id, at, len(own), zlib.crc32(own.tobytes())))
        at += len(own)
    assert rows(through("tokens"), "doc_id", "start", "n_tokens", "ids_crc32") == sorted(expected, key=key)
    spark.createDataFrame([], docs.schema).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0

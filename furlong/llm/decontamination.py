"""Benchmark decontamination: a broadcast hash set of normalised benchmark n-grams.

Document windows are hashed and looked up in the sorted hashes of all benchmark
windows; a hit is verified word by word before it counts.

Defined cases: a null or empty text has no words and no hits; an item without
words has no window; an item shorter than the window length is one window of all
its words; an item whose id is null hits words but is not listed; repeated
documents are judged one by one; repeated items are listed once. Only the named
columns are read, so further columns, whatever their names, do no harm.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furlong.llm.common import bound_batches, keep_rows, map_rows, utf8
from furlong.session import cut

WINDOW = 13
#: Benchmark text of one broadcast index, in bytes. A word takes two bytes of text at least and 20 bytes of arrays at most,
#: so an index is under 170 MB beside its words; larger benchmarks are taken in blocks, one pass each.
MAX_INDEX_BYTES = 16 << 20

#: A-Z to a-z; every ASCII byte that is no letter or digit to a space.
NORMAL = bytes((b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32) for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(NORMAL).split() if text else []


class _Windows:
    """The distinct windows of one length: sorted hashes, a place of each in the items' words, and the items that hold it."""

    def __init__(self, words: np.ndarray, starts: np.ndarray, owners: np.ndarray, size: int):
        self.size, self.words = size, words
        columns = np.lib.stride_tricks.sliding_window_view(words, size)
        for seed in range(7, 107):
            self.factors = np.random.default_rng(seed).integers(1, 2**62, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            hashes = self.hash([words[starts + j] for j in range(size)])
            order = np.lexsort((owners, hashes))
            same = hashes[order][1:] == hashes[order][:-1]
            pairs = np.flatnonzero(same)
            # Hashes that keep all windows apart: with 64 bits, nearly any seed will do.
            if all((columns[starts[order[pairs[i : i + 65_536]]]] == columns[starts[order[pairs[i : i + 65_536] + 1]]]).all() for i in range(0, len(pairs), 65_536)):
                break
        else:
            raise ValueError("no hash keeps the windows apart")
        first = np.flatnonzero(np.concatenate(([True], ~same)))
        self.hashes, self.places = hashes[order][first], starts[order][first].astype(np.int32)
        number = np.cumsum(np.concatenate(([True], ~same))) - 1
        own = owners[order]
        fresh = np.concatenate(([True], (number[1:] != number[:-1]) | (own[1:] != own[:-1]))) & (own >= 0)
        self.items = own[fresh]
        self.offsets = np.concatenate(([0], np.cumsum(np.bincount(number[fresh], minlength=len(first))))).astype(np.int32)

    def hash(self, columns) -> np.ndarray:
        """One hash for each window; ``columns`` holds its first words, its second words and so on."""
        total = np.zeros(len(columns[0]), np.uint64)
        for factor, column in zip(self.factors, columns, strict=True):
            total += (column.astype(np.uint64) + np.uint64(1)) * factor
            total ^= total >> np.uint64(29)
        return total

    def find(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts of windows of ``ids`` that the index holds, word by word; their numbers)."""
        values = self.hash([ids[starts + j] for j in range(self.size)])
        place = np.minimum(np.searchsorted(self.hashes, values), len(self.hashes) - 1)
        alike = np.flatnonzero(self.hashes[place] == values)
        starts, place = starts[alike], place[alike]
        true = np.ones(len(starts), bool)
        for j in range(self.size):
            true &= ids[starts + j] == self.words[self.places[place] + j]
        return starts[true], place[true]


class NgramIndex:
    """All windows of a set of items, as arrays: word ids, the windows' hashes, one place of each, and the items behind them."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        self.names: list[str] = []
        number: dict[str, int] = {}
        words: list[np.ndarray] = []
        found: dict[int, list[tuple[int, int, int]]] = {}
        at = 0
        for item, text in items:
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(text)], np.int32)
            if not len(ids):
                continue
            owner = -1
            if item is not None:
                owner = number.setdefault(item, len(number))
            size = min(window, len(ids))
            found.setdefault(size, []).append((at, len(ids) - size + 1, owner))
            words.append(ids)
            at += len(ids)
        self.names = list(number)
        every = np.concatenate(words) if words else np.zeros(0, np.int32)
        self.windows = []
        for size, runs in found.items():
            starts = np.concatenate([np.arange(a, a + n) for a, n, _ in runs])
            owners = np.repeat(np.array([o for *_, o in runs], np.int32), [n for _, n, _ in runs])
            self.windows.append(_Windows(every, starts, owners, size))

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words lie in a window of the index, and the items of those windows."""
        n = len(words)
        edges, items = np.zeros(n + 1, np.int32), set()
        if n and self.windows:
            get = self.vocabulary.get
            ids = np.fromiter((get(w, -1) for w in words), np.int32, n)
            unknown = np.concatenate(([0], np.cumsum(ids < 0)))
            for own in self.windows:
                if own.size > n:
                    continue
                starts = np.flatnonzero(unknown[own.size :] == unknown[: -own.size])
                if not len(starts):
                    continue
                starts, place = own.find(ids, starts)
                np.add.at(edges, starts, 1)
                np.add.at(edges, starts + own.size, -1)
                for p in np.unique(place).tolist():
                    items.update(self.names[i] for i in own.items[own.offsets[p] : own.offsets[p + 1]].tolist())
        return np.cumsum(edges)[:n] > 0, items


def _blocks(rows: DataFrame) -> int:
    n_bytes = rows.agg(F.sum(F.length("t").cast("long"))).first()[0] or 0
    return max(1, math.ceil(n_bytes / MAX_INDEX_BYTES))


def _indexes(spark, benchmark: DataFrame, item_id: str, text: str, window: int):
    """Broadcast indexes that together hold every item, each of about ``MAX_INDEX_BYTES`` of text; an item is never split."""
    rows = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(text).cast("binary").alias("t"))
    blocks = _blocks(rows)
    for block in range(blocks):
        part = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("t", "i"), F.lit(blocks)) == block)
        yield spark.sparkContext.broadcast(NgramIndex([(r["i"], bytes(r["t"]) if r["t"] is not None else None) for r in part.toLocalIterator()], window))


SPANS = "array<struct<first:int,after:int>>"
SPAN_TYPE = pa.list_(pa.struct([("first", pa.int32()), ("after", pa.int32())]))


def _spans(hit: np.ndarray) -> list[dict[str, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))).tolist()
    return [{"first": a, "after": b} for a, b in zip(edges[::2], edges[1::2], strict=True)]


def text_key(text: Column) -> Column:
    """Sixteen bytes that stand for a text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _hits(rows: DataFrame, index) -> DataFrame:
    """``doc_id, own, n_words, spans, items`` of the rows with a hit; ``own`` stands for the row's text."""

    def make(batch: pa.RecordBatch) -> dict:
        at, own, n_words, spans, items = [], [], [], [], []
        for i, value in enumerate(utf8(batch.column("text"))):
            words = words_of(value)
            hit, found = index.value.scan(words)
            if hit.any():
                at.append(i)
                own.append(hashlib.md5(value).digest())
                n_words.append(len(words))
                spans.append(_spans(hit))
                items.append(sorted(found))
        return {"doc_id": batch.column("doc_id").take(pa.array(at, pa.int32())), "own": pa.array(own, pa.binary()), "n_words": pa.array(n_words, pa.int64()), "spans": pa.array(spans, SPAN_TYPE), "items": pa.array(items, pa.list_(pa.string()))}

    return map_rows(rows, make, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, own binary, n_words long, spans {SPANS}, items array<string>")


def _hits_in_blocks(rows: DataFrame, indexes) -> DataFrame:
    """``_hits`` with several indexes, a pass for each; rows with equal id and text have equal hits, which are kept once."""
    found = None
    for index in indexes:
        hits = cut(_hits(rows, index).dropDuplicates(["doc_id", "own"]))
        index.unpersist()
        found = hits if found is None else found.unionByName(hits)
    grouped = found.groupBy("doc_id", "own", "n_words").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def merge(batch: pa.RecordBatch) -> dict:
        spans = []
        for n, own in zip(batch.column("n_words").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            hit = np.zeros(n, bool)
            for span in own:
                hit[span["first"] : span["after"]] = True
            spans.append(_spans(hit))
        return {n: batch.column(n) for n in ("doc_id", "own", "n_words")} | {"spans": pa.array(spans, SPAN_TYPE), "items": batch.column("items")}

    return map_rows(grouped, merge, grouped.schema)


def _several(benchmark: DataFrame, item_text: str) -> bool:
    return _blocks(benchmark.select(F.col(item_text).cast("binary").alias("t"))) > 1


def scan(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """Hits of every document: ``doc_id, text, n_words, spans, items``.

    ``spans`` are the maximal runs of hit words as [first, after last) word
    positions; ``items`` are the ids, as strings, of the items with a hit.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    indexes = _indexes(spark, benchmark, item_id, item_text, window)
    if _several(benchmark, item_text):
        # The passes keep hits alone, which meet the texts once at the end.
        found = _hits_in_blocks(rows, indexes).select(F.col("doc_id").alias("hit_id"), "own", "spans", "items").hint("shuffle_hash")
        counted = map_rows(rows, lambda batch: {"doc_id": batch.column("doc_id"), "text": batch.column("text"), "n_words": pa.array([len(words_of(x)) for x in utf8(batch.column("text"))], pa.int64())}, f"doc_id {kind}, text string, n_words long")
        joined = counted.join(found, counted["doc_id"].eqNullSafe(found["hit_id"]) & (text_key(counted["text"]) == found["own"]), "left")
        return joined.select("doc_id", "text", "n_words", F.coalesce("spans", F.array().cast(SPANS)).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    (index,) = indexes

    def make(batch: pa.RecordBatch) -> dict:
        n_words, spans, items = [], [], []
        for value in utf8(batch.column("text")):
            words = words_of(value)
            hit, found = index.value.scan(words)
            n_words.append(len(words))
            spans.append(_spans(hit))
            items.append(sorted(found))
        return {
            "doc_id": batch.column("doc_id"),
            "text": batch.column("text"),
            "n_words": pa.array(n_words, pa.int64()),
            "spans": pa.array(spans, SPAN_TYPE),
            "items": pa.array(items, pa.list_(pa.string())),
        }

    return map_rows(rows, make, f"doc_id {kind}, text string, n_words long, spans {SPANS}, items array<string>")


def is_contaminated(n_words, n_hit):
    """The rule of the contract: some hit, and hits on a twentieth of the words at least."""
    return n_hit > 0 and 20 * n_hit >= n_words


def is_contaminated_column(n_words: Column, n_hit: Column) -> Column:
    return (n_hit > 0) & (20 * n_hit >= n_words)


def report(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every document."""

    def make(batch: pa.RecordBatch) -> dict:
        words, items = batch.column("n_words").to_pylist(), batch.column("items").to_pylist()
        hits = [sum(s["after"] - s["first"] for s in spans) for spans in batch.column("spans").to_pylist()]
        return {
            "doc_id": batch.column("doc_id"),
            "n_words": batch.column("n_words"),
            "n_hit": pa.array(hits, pa.int64()),
            "n_items": pa.array([len(x) for x in items], pa.int64()),
            "items_sha256": pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string()),
            "contaminated": pa.array([is_contaminated(n, h) for n, h in zip(words, hits, strict=True)], pa.bool_()),
        }

    found = scan(docs, benchmark, **names).drop("text")
    return map_rows(found, make, f"doc_id {found.schema['doc_id'].dataType.simpleString()}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def remove_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` without its contaminated documents; all columns stay as they are."""
    spark = docs.sparkSession
    bound_batches(spark)
    if _several(benchmark, item_text):
        texts = docs.select(F.lit(0).alias("doc_id"), F.col(text).cast("string").alias("text"))
        found = _hits_in_blocks(texts, _indexes(spark, benchmark, item_id, item_text, window))
        n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["after"] - s["first"])
        bad = found.where(is_contaminated_column(F.col("n_words"), n_hit)).select("own")
        return docs.join(bad, text_key(docs[text].cast("string")) == bad["own"], "left_anti").select(*[docs[c] for c in docs.columns])
    (index,) = _indexes(spark, benchmark, item_id, item_text, window)

    def keep(batch: pa.RecordBatch) -> list[bool]:
        out = []
        for value in utf8(batch.column(text)):
            words = words_of(value)
            out.append(not is_contaminated(len(words), int(index.value.scan(words)[0].sum())))
        return out

    return keep_rows(docs, keep)


def remove_spans(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """``doc_id, text, n_removed``: texts with the hit spans cut out, from a span's first to its last word."""

    def make(batch: pa.RecordBatch) -> dict:
        texts, removed = [], []
        for value, spans in zip(utf8(batch.column("text")), batch.column("spans").to_pylist(), strict=True):
            if spans:
                places, parts, at = [m.span() for m in re.finditer(rb"[^ ]+", value.translate(NORMAL))], [], 0
                for s in spans:
                    parts.append(value[at : places[s["first"]][0]])
                    at = places[s["after"] - 1][1]
                value = b"".join([*parts, value[at:]])
            texts.append(None if value is None else value.decode())
            removed.append(sum(s["after"] - s["first"] for s in spans))
        return {"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.string()), "n_removed": pa.array(removed, pa.int64())}

    found = scan(docs, benchmark, **names)
    return map_rows(found, make, f"doc_id {found.schema['doc_id'].dataType.simpleString()}, text string, n_removed long")


ORACLE = r"""
WITH item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
item_windows AS (
  SELECT item, least(len(w), 13) AS size, unnest(list_transform(range(1, len(w) - least(len(w), 13) + 2), lambda i: array_to_string(w[i:i + least(len(w), 13) - 1], ' '))) AS g
  FROM item_words WHERE len(w) > 0),
grams AS (SELECT size, g, list(DISTINCT item) FILTER (item IS NOT NULL) AS items FROM item_windows GROUP BY size, g),
doc_words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
doc_windows AS (
  SELECT doc_id, s.size, unnest(range(1, CAST(len(w) - s.size + 2 AS BIGINT))) AS p, w
  FROM doc_words, (SELECT DISTINCT size FROM grams) s WHERE len(w) >= s.size),
hits AS (
  SELECT d.doc_id, d.p, g.size, g.items FROM doc_windows d JOIN grams g
  ON g.size = d.size AND g.g = array_to_string(d.w[d.p:d.p + d.size - 1], ' ')),
hit_words AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM (SELECT doc_id, unnest(items) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(i.items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(i.items, ','), '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM doc_words d LEFT JOIN hit_words h USING (doc_id) LEFT JOIN hit_items i USING (doc_id)
"""

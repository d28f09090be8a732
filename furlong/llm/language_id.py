"""Language identification with language-bitmask n-gram filters.

A bit-sliced Bloom filter holds one bitmask of languages in every slot. Looking
an n-gram up is one AND over its slots and returns all the languages that contain
it. For each text, the hits of each language are counted, corrected for the rate
at which that language's bits answer by chance, and the largest count decides.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; a
text with no known n-gram gets the commonest learned language (ties: the least
name) with score 0; equal counts go to the commoner language; with nothing to
learn from, every text is ``und``. A language of one or two documents is learned
from them, but takes no n-gram from other languages. A row whose id is null is not
held out. Only the named columns are read.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong.llm.common import bound_batches, crc_mod, map_rows

GRAMS = (2, 3, 4)
#: Expected number of training documents for each language; the n-grams come from their whole texts.
SAMPLE_PER_LANGUAGE = 300
#: A language contains an n-gram that is in so many of its sampled documents, or in all of them if it has fewer.
MIN_DOCS = 3
#: ... and in a share of them of at least this part of the share in any other language, which keeps out what wrong labels bring in.
MIN_PART = 0.3
#: Size of the model: most n-grams of a language, the commonest first.
MAX_GRAMS = 50_000
SLOTS_LOG2 = 20
HASHES = 2
PIECE = 500_000

_FACTORS = np.random.default_rng(11).integers(1, 2**62, max(GRAMS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def normal(text: str) -> np.ndarray:
    """Lower-case code points with each run of other characters as one space, one at both ends."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(_letters()[points], points, np.uint32(32))
    blank = points == 32
    return points[~(blank & np.concatenate(([False], blank[:-1])))]


def gram_hashes(points: np.ndarray, size: int) -> np.ndarray:
    if len(points) < size:
        return np.zeros(0, np.uint64)
    n = len(points) - size + 1
    total = np.full(n, size, np.uint64)
    for j in range(size):
        total += points[j : j + n] * _FACTORS[j]
    total ^= total >> np.uint64(31)
    total *= np.uint64(0x9E3779B97F4A7C15)
    return total ^ (total >> np.uint64(29))


def pieces(points: np.ndarray):
    """Parts of bounded length that together hold every n-gram's start once, for each size."""
    for at in range(0, max(len(points), 1), PIECE):
        for size in GRAMS:
            yield gram_hashes(points[at : at + PIECE + size - 1], size)


class BitmaskFilter:
    """Slots of language bits; ``languages`` come in the order of their bits, the commonest first."""

    def __init__(self, grams: dict[str, np.ndarray], languages: list[str], slots_log2: int = SLOTS_LOG2):
        self.languages, self.mask = languages, np.uint64((1 << slots_log2) - 1)
        kind = next(t for t, bits in ((np.uint8, 8), (np.uint16, 16), (np.uint32, 32), (np.uint64, 64)) if len(languages) <= bits or bits == 64)
        self.layers = [languages[i : i + 64] for i in range(0, len(languages), 64)]
        self.slots = [np.zeros(1 << slots_log2, kind) for _ in self.layers]
        for slots, names in zip(self.slots, self.layers, strict=True):
            for bit, name in enumerate(names):
                for place in self._places(grams[name]):
                    slots[place] |= kind(1 << bit)
        self.chance = np.array([((slots >> kind(bit)) & kind(1)).mean() ** HASHES for slots, names in zip(self.slots, self.layers, strict=True) for bit in range(len(names))])

    def _places(self, hashes: np.ndarray):
        for i in range(HASHES):
            yield ((hashes >> np.uint64(32 * i)) & self.mask).astype(np.int64)

    def counts(self, text: str) -> tuple[np.ndarray, int]:
        """Hits of each language, corrected for chance, and the number of n-grams."""
        hits, n = np.zeros(len(self.languages)), 0
        for hashes in pieces(normal(text)):
            n += len(hashes)
            places = list(self._places(hashes))
            at = 0
            for slots, names in zip(self.slots, self.layers, strict=True):
                found = slots[places[0]]
                for place in places[1:]:
                    found = found & slots[place]
                found = found[found != 0]
                for bit in range(len(names)):
                    hits[at + bit] += np.count_nonzero(found & found.dtype.type(1 << bit))
                at += len(names)
        return np.maximum(0, (hits - n * self.chance) / (1 - np.minimum(self.chance, 0.999))), n

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.languages or not any(map(str.isalpha, text)):
            return "und", 0.0
        counts, _ = self.counts(text)
        best, total = int(np.argmax(counts)), counts.sum()
        return self.languages[best], float(counts[best] / total) if total > 0 else 0.0


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", order: str = "doc_id", per_language: int = SAMPLE_PER_LANGUAGE) -> BitmaskFilter:
    """Fit the filter on a bounded sample of the labelled rows of ``docs``.

    A hash of ``order`` picks about ``per_language`` documents of each language;
    the driver gets at most so many times its n-grams that at least ``MIN_DOCS``
    of the sampled documents hold.
    """
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.xxhash64(F.col(order).cast("string")).alias("h"), F.col(text).alias("text"))
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return BitmaskFilter({}, [])
    bound, least = F.lit(None).cast("double"), F.lit(MIN_DOCS)
    for name, n in sizes.items():
        bound = F.when(F.col("lang") == name, F.lit(min(1.0, per_language / n))).otherwise(bound)
        least = F.when(F.col("lang") == name, F.lit(n)).otherwise(least) if n < MIN_DOCS else least
    sample = labelled.where((F.col("h").cast("double") / 2.0**64 + 0.5) <= bound).select("lang", "text")

    def grams(batch: pa.RecordBatch) -> dict:
        found: dict[str, list[np.ndarray]] = defaultdict(list)
        for name, value in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            found[name].append(np.unique(np.concatenate(list(pieces(normal(value))))))
        names, hashes, docs_with = [], [], []
        for name, arrays in found.items():
            h, n = np.unique(np.concatenate(arrays), return_counts=True)
            names += [name] * len(h)
            hashes.append(h.view(np.int64))
            docs_with.append(n)
        return {"lang": pa.array(names, pa.string()), "gram": pa.array(np.concatenate(hashes), pa.int64()), "n": pa.array(np.concatenate(docs_with), pa.int64())}

    counted = map_rows(sample, grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    rows = counted.toArrow()
    sampled = {name: min(n, per_language) for name, n in sizes.items()}
    names, hashes = np.array(rows.column("lang").to_pylist(), object), rows.column("gram").to_numpy()
    share = rows.column("n").to_numpy() / np.array([sampled[x] for x in names], float) if len(names) else np.zeros(0)
    # The share in the language that an n-gram is commonest in; of those with few documents it counts for themselves alone.
    weighed = np.where([sizes[x] >= MIN_DOCS for x in names], share, 0.0) if len(names) else share
    order_ = np.lexsort((weighed, hashes))
    hashes, share, names, weighed = hashes[order_], share[order_], names[order_], weighed[order_]
    last = np.append(hashes[1:] != hashes[:-1], True) if len(hashes) else np.zeros(0, bool)
    top = np.maximum(share, weighed[last][np.searchsorted(hashes[last], hashes)]) if len(hashes) else share
    chosen = {}
    for name in sizes:
        own = np.flatnonzero((names == name) & (share >= MIN_PART * top))
        own = own[np.lexsort((hashes[own], -share[own]))][:MAX_GRAMS]
        chosen[name] = hashes[own].view(np.uint64)
    return BitmaskFilter(chosen, sorted(sizes, key=lambda x: (-sizes[x], x)))


def identify(docs: DataFrame, model: BitmaskFilter, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the columns of ``keep``, ``lang_pred`` and ``score`` of every whole text."""
    spark = docs.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def make(batch: pa.RecordBatch) -> dict:
        found = [shared.value.predict(x) for x in batch.column("text").to_pylist()]
        return {n: batch.column(n) for n in ("doc_id", *keep)} | {"lang_pred": pa.array([x[0] for x in found], pa.string()), "score": pa.array([x[1] for x in found], pa.float64())}

    rows = docs.select(F.col(doc_id).alias("doc_id"), *keep, F.col(text).alias("text"))
    kinds = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in ("doc_id", *keep))
    return map_rows(rows, make, f"{kinds}, lang_pred string, score double")


def held_out(docs: DataFrame, divisor: int, remainder: int, doc_id: str = "doc_id") -> DataFrame:
    return docs.withColumn("held_out", F.coalesce(crc_mod(doc_id, divisor) == remainder, F.lit(False)))

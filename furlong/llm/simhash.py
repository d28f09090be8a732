"""SimHash near-duplicates, filtered by pivot distance tables.

Every distinct fingerprint carries a column of its Hamming distances to many
reference fingerprints (pivots), computed once. By the triangle inequality, two fingerprints that differ
in at most ``MAX_BITS`` bits differ by no more than that in any of these
distances, so a pair is discarded by the largest difference of its table rows;
the survivors are verified bit by bit.

A table filter needs pairs to filter, and all pairs are too many. Fingerprints
meet here only where they can link at all: of five bands of the 64 bits, at most
three can differ, so linked fingerprints agree on some two bands. Each
fingerprint goes to the ten buckets that its pairs of bands name. Buckets are
counted exactly, and crowded ones are split into parts that meet pairwise.

Defined cases: a null or empty text, or one of white space, has fingerprint zero
and links like any other; repeated rows and equal texts share a fingerprint, and
so a component; a row whose id is null belongs to its fingerprint's component
(null if no row of it has an id). Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furlong.llm.common import bound_batches, map_rows, utf8
from furlong.operators.components import connected_components, forest
from furlong.session import cut

MAX_BITS = 3
SHINGLE = 3
SEED = 42
#: Bits of the five bands, low to high; a pair of bands makes a bucket key.
BANDS = (13, 13, 13, 13, 12)
TABLES = tuple(combinations(range(len(BANDS)), 2))
#: Reference fingerprints: pseudo-random words from a fixed seed.
PIVOTS = np.random.default_rng(64).integers(0, 2**64, 24, dtype=np.uint64)
#: Buckets with more members than this are split, each pair of parts being a task of its own.
CROWD = 4_096
#: Crowded buckets whose list (16 bytes each) is broadcast; more are joined by shuffle.
BROADCAST_BUCKETS = 100_000
#: Shingles whose bits are counted at a time.
COUNTED = 65_536


def fingerprint(text: bytes | None) -> int:
    """64 bits: each is set if it is set in over half the hashes of all shingles."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE + 1)
    counts = np.zeros(64, np.int64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for at in range(0, n, COUNTED):
        hashes = np.fromiter((digest(join(words[i : i + SHINGLE]), SEED) for i in range(at, min(at + COUNTED, n))), np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def pivot_table(prints: np.ndarray) -> np.ndarray:
    """Distances of each fingerprint to each pivot, pivots first."""
    return np.bitwise_count(prints[None, :] ^ PIVOTS[:, None]).astype(np.int8)


def linked_pairs(left: np.ndarray, a_table: np.ndarray, right: np.ndarray | None = None, b_table: np.ndarray | None = None, chunk: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the pairs within ``MAX_BITS``: pivot distances discard, the survivors are verified. Without ``right``, pairs of ``left`` once each."""
    other, b_table = (left, a_table) if right is None else (right, b_table)
    for at in range(0, len(left), chunk):
        part = a_table[:, at : at + chunk]
        alive = np.abs(part[0][:, None] - b_table[0][None, :]) <= MAX_BITS
        if right is None:
            alive &= np.arange(at, at + part.shape[1])[:, None] < np.arange(len(other))[None, :]
        i, j = np.nonzero(alive)
        for pivot in range(1, len(PIVOTS)):
            if not len(i):
                break
            near = np.abs(part[pivot][i] - b_table[pivot][j]) <= MAX_BITS
            i, j = i[near], j[near]
        near = np.bitwise_count(left[at + i] ^ other[j]) <= MAX_BITS
        yield at + i[near], j[near]


def bucket_keys(fp: str = "fp") -> Column:
    """The buckets of a fingerprint: table number, then the bits of the table's two bands."""
    starts = [sum(BANDS[:i]) for i in range(len(BANDS))]
    band = [F.shiftrightunsigned(fp, s).bitwiseAND(F.lit((1 << b) - 1).cast("long")) for s, b in zip(starts, BANDS, strict=True)]
    return F.array(*[F.lit(t << 26).cast("long") + F.shiftleft(band[x], 13) + band[y] for t, (x, y) in enumerate(TABLES)])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fp``: the fingerprint of every whole text as a signed long."""
    bound_batches(docs.sparkSession)

    def make(batch: pa.RecordBatch) -> dict:
        prints = np.array([fingerprint(x) for x in utf8(batch.column("text"))], np.uint64)
        return {"doc_id": batch.column("doc_id"), "fp": pa.array(prints.view(np.int64))}

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return map_rows(rows, make, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


def with_pivots(prints: DataFrame) -> DataFrame:
    """``fp, pivots``: each fingerprint with its row of the pivot distance table, a byte for each pivot."""

    def make(batch: pa.RecordBatch) -> dict:
        fp = batch.column("fp").to_numpy()
        table = np.ascontiguousarray(pivot_table(fp.view(np.uint64)).T)
        return {"fp": batch.column("fp"), "pivots": pa.array([row.tobytes() for row in table], pa.binary())}

    return map_rows(prints.select("fp"), make, "fp long, pivots binary")


def _table_of(pivots: np.ndarray) -> np.ndarray:
    return np.frombuffer(b"".join(pivots.tolist()), np.int8).reshape(len(pivots), len(PIVOTS)).T


def _forest_of(left: np.ndarray, a: np.ndarray, right: np.ndarray | None = None, b: np.ndarray | None = None) -> list[tuple[int, int]]:
    pairs: list[tuple[int, int]] = []
    other = left if right is None else right
    found = linked_pairs(left.view(np.uint64), _table_of(a)) if right is None else linked_pairs(left.view(np.uint64), _table_of(a), right.view(np.uint64), _table_of(b))
    for i, j in found:
        pairs += zip(left[i].tolist(), other[j].tolist(), strict=True)
        if len(pairs) > 200_000:
            pairs = forest(pairs)
    return forest(pairs)


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges that connect what is linked within each bucket. The rows come sorted by bucket and part."""
    names = ("key", "part", "side", "fp", "pivots")
    held: list[np.ndarray] = [np.zeros(0, np.int64)] * 4 + [np.zeros(0, object)]

    def bucket(own: list[np.ndarray]):
        _, _, side, fp, pivots = own
        if side[0] < 0:
            return _forest_of(fp, pivots)
        first, second = side == 0, side == 1
        return _forest_of(fp[first], pivots[first], fp[second], pivots[second]) if first.any() and second.any() else []

    def emit(rows: list[np.ndarray]):
        key, part = rows[0], rows[1]
        cuts = np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1])) + 1
        starts, ends = np.concatenate(([0], cuts)), np.append(cuts, len(key))
        several = ends - starts > 1
        out: list[tuple[int, int]] = []
        for a, b in zip(starts[several], ends[several], strict=True):
            out += bucket([x[a:b] for x in rows])
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["src", "dst"])

    for batch in batches:
        rows = [np.concatenate((h, batch.column(n).to_numpy(zero_copy_only=False))) for h, n in zip(held, names, strict=True)]
        if not len(rows[0]):
            continue
        # The last bucket may go on in the next batch.
        last = np.flatnonzero((rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1]))
        at = last[-1] + 1 if len(last) else 0
        held = [x[at:] for x in rows]
        if at:
            yield emit([x[:at] for x in rows])
    if len(held[0]):
        yield emit(held)


def links(prints: DataFrame, crowd: int = CROWD) -> DataFrame:
    """``src, dst``: edges that connect exactly the distinct fingerprints which are linked, directly or through others."""
    spark = prints.sparkSession
    bound_batches(spark)
    known = cut(with_pivots(prints))
    keys = known.select(F.explode(bucket_keys()).alias("key"))
    crowded = cut(keys.groupBy("key").count().where(F.col("count") > crowd).select(F.col("key").alias("hot"), F.ceil(F.col("count") / crowd + 1).cast("long").alias("parts")))
    few = crowded.count() <= BROADCAST_BUCKETS
    rows = known.select(F.explode(bucket_keys()).alias("key"), "fp", "pivots")
    rows = rows.join(F.broadcast(crowded) if few else crowded, rows["key"] == crowded["hot"], "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
    # A member meets its own part (side -1) and, as side 0 or 1, each other part.
    dealt = rows.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    side = F.when(F.col("own") == F.col("other"), -1).when(F.col("own") > F.col("other"), 1).otherwise(0).cast("long")
    dealt = dealt.select("key", (F.least("own", "other") * F.col("parts") + F.greatest("own", "other")).alias("part"), side.alias("side"), "fp", "pivots")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(n, "key", "part").sortWithinPartitions("key", "part").mapInArrow(_edges, "src long, dst long")


def _classes(docs: DataFrame, doc_id: str, text: str, crowd: int) -> DataFrame:
    """``doc_id, fp, c, component_id``: one row for each row of ``docs``; ``c`` is the component's key, with or without ids."""
    prints = cut(fingerprints(docs, doc_id, text))
    groups = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    found = cut(connected_components(links(groups, crowd)))
    # Few fingerprints have a link: the others are their own component.
    labelled = groups.join(found, groups["fp"] == found["node"], "left").select("fp", "first_id", F.coalesce("component", "fp").alias("c"))
    labelled = cut(labelled)
    least = cut(labelled.groupBy("c").agg(F.min("first_id").alias("component_id")))
    labelled = cut(labelled.join(least, "c").select(F.col("fp").alias("k"), "c", "component_id"))
    return prints.join(labelled, prints["fp"] == labelled["k"]).select("doc_id", "fp", "c", "component_id")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", crowd: int = CROWD) -> DataFrame:
    """``doc_id, fp, component_id``: one row for each row of ``docs``."""
    return _classes(docs, doc_id, text, crowd).select("doc_id", "fp", "component_id")


def fingerprint_text(column: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))


def _with_prints(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``row, doc_id, fp``: whole rows as structs, so that no column's name can clash."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col(doc_id).alias("doc_id"))
    schema = rows.withColumn("fp", F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                whole = batch.column("row")
                prints = np.array([fingerprint(x) for x in utf8(whole.field(text))], np.uint64)
                yield pa.RecordBatch.from_arrays([whole, batch.column("doc_id"), pa.array(prints.view(np.int64))], names=["row", "doc_id", "fp"])

    return rows.mapInArrow(run, schema)


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component, that of its smallest id; all columns stay as they are.

    Of a component's repeated rows with that id, one stays, and so does one row of
    a component without any id. An id names its row where no other row has it;
    null and repeated ids are told apart by the fingerprint.
    """
    found = cut(_classes(docs, doc_id, text, CROWD))
    heads = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy(F.col("doc_id").alias("kept_id"), F.col("fp").alias("kept_fp"), "c").agg(F.lit(1).alias("one")).drop("one")
    repeated = found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("repeated_id"))
    heads = cut(heads.join(repeated, F.col("kept_id") == F.col("repeated_id"), "left").withColumn("alone", F.col("kept_id").isNotNull() & F.col("repeated_id").isNull()).drop("repeated_id"))
    named = heads.where("alone").select("kept_id")
    once = docs.join(named, docs[doc_id] == named["kept_id"], "left_semi").select(*[docs[c] for c in docs.columns])
    shared = heads.where("not alone")
    if shared.isEmpty():
        return once
    reused = shared.where("kept_id is not null").select("kept_id").distinct()
    several = docs.join(reused, docs[doc_id] == reused["kept_id"], "left_semi").unionByName(docs.where(docs[doc_id].isNull()))
    rows = _with_prints(several, doc_id, text)
    again = rows.join(shared, rows["fp"].eqNullSafe(shared["kept_fp"]) & rows["doc_id"].eqNullSafe(shared["kept_id"])).select("row", "c")
    # Of several rows that would do, the one whose values hash lowest, so that reruns agree.
    again = again.groupBy("c").agg(F.min_by("row", F.sha2(F.to_json("row"), 256)).alias("row"))
    return once.unionByName(again.select("row.*"))

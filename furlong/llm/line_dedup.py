"""Line deduplication by range-partitioned line hashes.

Each line sends a 128-bit hash of its key, its document and its position. The
rows are partitioned by range of (hash, document) and sorted by (hash, document,
position), so a stream over a partition meets every line's occurrences in
document order; a hot line spreads over as many partitions as its rows fill. What
comes back is a compressed keep bitmap for each document, never text.

Two rules: ``first`` keeps a line's first occurrence in (document, position)
order, ``common`` drops every occurrence of a line found in ``min_docs``
documents. A run of equal hashes that touches a partition's edge cannot be judged
there; each such run is reported once for each partition and the few reports are
put together.

Defined cases: a null or empty text is one empty line; an empty key (a line of
white space) is never dropped; a document is a value of ``doc_id``, so rows that
repeat an id count as one document, each row keeping its own lines, and rows
without an id count as one document together; texts of any length are split
whole. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong.llm.common import bound_batches, map_rows, utf8
from furlong.session import cut

BLANK = b" \t\n\v\f\r"
MIN_DOCS = 10


def lines_of(text: bytes | None) -> list[bytes]:
    return text.split(b"\n") if text else [b""]


def line_key(line: bytes) -> bytes:
    return line.strip(BLANK).lower()


def pack(drop: list[int], n_lines: int) -> bytes:
    """Compressed bitmap of the lines to keep."""
    keep = np.ones(n_lines, bool)
    keep[drop] = False
    return zlib.compress(np.packbits(keep).tobytes())


def unpack(bitmap: bytes, n_lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines).astype(bool)


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """``h1, h2, doc, row, pos, n_lines`` of every line with a key; ``row`` tells rows of one document apart by their text."""

    def make(batch: pa.RecordBatch) -> dict:
        h1, h2, doc, row, pos, size = [], [], [], [], [], []
        for i, text in enumerate(utf8(batch.column("text"))):
            lines = lines_of(text)
            own = xxhash.xxh3_64_intdigest(text or b"") - 2**63
            at = 0
            for p, line in enumerate(lines):
                key = line_key(line)
                if key and (min_chars <= 1 or len(key.decode()) >= min_chars):
                    digest = xxhash.xxh3_128_digest(key)
                    h1.append(digest[:8])
                    h2.append(digest[8:])
                    pos.append(p)
                    at += 1
            doc += [i] * at
            row += [own] * at
            size += [len(lines)] * at
        return {
            "h1": pa.array(np.frombuffer(b"".join(h1), np.int64)),
            "h2": pa.array(np.frombuffer(b"".join(h2), np.int64)),
            "doc": batch.column("doc_id").take(pa.array(doc, pa.int32())),
            "row": pa.array(row, pa.int64()),
            "pos": pa.array(pos, pa.int32()),
            "n_lines": pa.array(size, pa.int32()),
        }

    return map_rows(docs, make, f"h1 long, h2 long, doc {docs.schema['doc_id'].dataType.simpleString()}, row long, pos int, n_lines int")


def _stream(min_docs: int):
    """Verdicts on the sorted rows of one partition.

    Yields the rows of runs that may lose lines: ``docs`` is the run's number of
    documents, ``whole`` tells whether the run is known to lie in this partition
    alone, ``nth`` is the row's rank in the run. Runs inside the partition that
    keep all their lines are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        run_of: tuple = ()
        first = True

        def judge(table: pa.Table, last: bool):
            nonlocal first
            h1, h2 = table.column("h1").to_numpy(), table.column("h2").to_numpy()
            doc = table.column("doc").combine_chunks().dictionary_encode()
            doc = doc.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            new = np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
            new_doc = new | np.concatenate(([True], doc[1:] != doc[:-1]))
            number = np.cumsum(new) - 1
            docs = np.bincount(number, new_doc)[number].astype(np.int64)
            starts = np.flatnonzero(new)
            nth = np.arange(len(new)) - starts[number]
            edge = np.zeros(len(new), bool)
            if first:
                edge |= number == 0
                first = False
            if last:
                edge |= number == number[-1]
            report = edge | ((docs >= min_docs) if min_docs else (nth > 0))
            at = np.flatnonzero(report)
            out = table.take(pa.array(at))
            out = out.append_column("docs", pa.array(docs[at])).append_column("whole", pa.array(~edge[at])).append_column("nth", pa.array(nth[at].astype(np.int64)))
            yield from out.combine_chunks().to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            part = pa.Table.from_batches([batch])
            ends = tuple(batch.column(n)[i].as_py() for i in (0, batch.num_rows - 1) for n in ("h1", "h2"))
            joins = held is not None and ends[:2] == run_of
            held = part if held is None else pa.concat_tables([held, part])
            run_of = ends[2:]
            if joins and ends[:2] == ends[2:]:
                continue  # all of it goes on with the last run
            h1, h2 = held.column("h1").to_numpy(), held.column("h2").to_numpy()
            before = np.flatnonzero((h1 != h1[-1]) | (h2 != h2[-1]))
            at = int(before[-1]) + 1 if len(before) else 0
            if at:
                yield from judge(held.slice(0, at), False)
                held = held.slice(at)
        if held is not None:
            yield from judge(held, True)

    return run


def keep_bitmaps(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rule: str = "common", min_docs: int = MIN_DOCS, min_chars: int = 1) -> DataFrame:
    """``doc, row, n_lines, n_dropped, bitmap`` of every document that loses lines."""
    if rule not in ("common", "first"):
        raise ValueError(f"no such rule: {rule}")
    spark = docs.sparkSession
    bound_batches(spark)
    rows = _lines(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), min_chars)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The document is part of the range, so a hot line is split; its rows of one document stay together.
    ranged = rows.repartitionByRange(n, "h1", "h2", "doc").sortWithinPartitions("h1", "h2", "doc", "row", "pos")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", docs long, whole boolean, nth long"
    found = ranged.mapInArrow(_stream(min_docs if rule == "common" else 0), schema).withColumn("part", F.spark_partition_id())
    found = cut(found)
    # One report for each run at an edge: at most two for each partition.
    runs = found.where("not whole").groupBy("h1", "h2", "part").agg(F.first("docs").alias("docs"), F.count("*").alias("rows")).groupBy("h1", "h2").agg(F.sum("docs").alias("all_docs"), F.min("part").alias("first_part"))
    # The runs at edges are bounded by twice the number of partitions, so they may be broadcast.
    edge = found.where("not whole").join(F.broadcast(runs), ["h1", "h2"])
    if rule == "common":
        edge = edge.where(F.col("all_docs") >= min_docs)
    else:
        edge = edge.where((F.col("part") > F.col("first_part")) | (F.col("nth") > 0))
    columns = ["doc", "row", "n_lines", "pos"]
    drops = found.where("whole").select(*columns).unionByName(edge.select(*columns))
    grouped = drops.groupBy("doc", "row").agg(F.max("n_lines").alias("n_lines"), F.collect_set("pos").alias("pos"))

    def bitmap(batch: pa.RecordBatch) -> dict:
        sizes, places = batch.column("n_lines").to_pylist(), batch.column("pos").to_pylist()
        return {"doc": batch.column("doc"), "row": batch.column("row"), "n_lines": batch.column("n_lines"), "n_dropped": pa.array([len(p) for p in places], pa.int32()), "bitmap": pa.array([pack(p, n) for p, n in zip(places, sizes, strict=True)], pa.binary())}

    return map_rows(grouped, bitmap, f"doc {grouped.schema['doc'].dataType.simpleString()}, row long, n_lines int, n_dropped int, bitmap binary")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept``: every row's text with its dropped lines left out."""

    def hashed(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column("doc_id"), "text": batch.column("text"), "own": pa.array([xxhash.xxh3_64_intdigest(t or b"") - 2**63 for t in utf8(batch.column("text"))], pa.int64())}

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows = map_rows(rows, hashed, f"doc_id {kind}, text string, own long")
    small = bitmaps.select("doc", "row", "bitmap").hint("shuffle_hash")
    joined = rows.join(small, rows["doc_id"].eqNullSafe(small["doc"]) & (rows["own"] == small["row"]), "left").select("doc_id", "text", "bitmap")

    def apply(batch: pa.RecordBatch) -> dict:
        n_lines, n_dropped, kept = [], [], []
        for value, bitmap in zip(utf8(batch.column("text")), batch.column("bitmap").to_pylist(), strict=True):
            lines = lines_of(value)
            n_lines.append(len(lines))
            if bitmap is not None:
                keep = unpack(bitmap, len(lines))
                lines = [x for x, k in zip(lines, keep, strict=True) if k]
            n_dropped.append(n_lines[-1] - len(lines))
            kept.append(b"\n".join(lines).decode())
        return {"doc_id": batch.column("doc_id"), "n_lines": pa.array(n_lines, pa.int64()), "n_dropped": pa.array(n_dropped, pa.int64()), "kept": pa.array(kept, pa.string())}

    return map_rows(joined, apply, f"doc_id {kind}, n_lines long, n_dropped long, kept string")


def report(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of every document under the ``common`` rule."""
    kept = apply_bitmaps(docs, keep_bitmaps(docs, **options))

    def digest(batch: pa.RecordBatch) -> dict:
        return {n: batch.column(n) for n in ("doc_id", "n_lines", "n_dropped")} | {"kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in utf8(batch.column("kept"))], pa.string())}

    return map_rows(kept, digest, f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, n_lines long, n_dropped long, kept_sha256 string")


ORACLE = r"""
WITH doc_lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM doc_lines),
common AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(common.k) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (common.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common ON common.k = keyed.k
GROUP BY doc_id
"""

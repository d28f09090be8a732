"""WARC archives and their globally ordered capture index.

``write_archives`` writes one gzip member for each capture: a ``response`` record
with the payload, or a ``revisit`` record that names the response with an equal
payload. Each writing task also leaves its captures as an index run, sorted by URL
key and timestamp. ``merge_runs`` merges such runs with a loser tree: a merge
takes at most ``FAN_IN`` runs, and one range of keys of them, so neither the open
runs nor the captures of one task grow with the collection; passes follow until
one run is left, whose segments, in order, are the capture histories.

Defined cases: a null or empty page has an empty payload, which is equal to any
other empty payload; repeated rows are captures of their own (those that
repeat a response's id and payload are responses too); a row without an id is never the
response of another, but is a response itself if no row with an id has its
payload; an id that is no whole number is an error; a null or relative URL is keyed
by its text as it is. Payloads smaller
than ``min_bytes`` are always responses. Only the named columns are read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from itertools import chain
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong.llm.common import bound_batches, long_id
from furlong.llm.storage import Writer, reader, remove_folder
from furlong.session import cut, shared_folder

#: Runs that one merge opens, captures in one block of a run, and captures for each range of keys.
FAN_IN = 64
BLOCK = 2_048
RANGE_ROWS = 200_000
#: Keys that a segment reports for the choice of ranges: between so many and twice as many, if it has them.
KEYS = 64
#: Captures get this time, later by one second for each id, where no timestamp column is named.
EPOCH = datetime(2020, 1, 1, tzinfo=timezone.utc)

RUN = pa.schema([("url_key", pa.string()), ("ts", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
RUN_SQL = "url_key string, ts string, page_id long, file string, offset long, length long"
HEADER = re.compile(rb"([^:\r\n]+): ?([^\r\n]*)\r\n")


def url_key(url: str | None) -> str:
    """The host's labels reversed, then path and query in lower case; scheme, ``www.``, port and fragment go."""
    url = url or ""
    try:
        parts = urlsplit(url) if "://" in url else None
        name = parts.hostname if parts else None
    except ValueError:  # no URL, such as one with half of an IPv6 address
        name = None
    if not name:
        return url.lower()
    host = name.removeprefix("www.").split(".")
    query = "?" + "&".join(sorted(parts.query.lower().split("&"))) if parts.query else ""
    return ",".join(reversed(host)) + ")" + (parts.path.lower().rstrip("/") or "/") + query


def timestamp(page_id: int | None) -> str:
    return (EPOCH + timedelta(seconds=(page_id or 0) % (3600 * 24 * 36500))).strftime("%Y-%m-%dT%H:%M:%SZ")


def sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, ts: str, payload: bytes, digest: str, refers_to: int | None, size: int) -> bytes:
    """One record as a gzip member; its bytes depend on the capture alone."""
    revisit = refers_to is not None
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {ts}",
        f"WARC-Target-URI: {re.sub(r'[\r\n]', ' ', url or '')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {size}",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if revisit else http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def records(data, chunk: int = 1 << 20) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, payload) of every record of an archive, one member in memory at a time."""
    rest, at = b"", 0
    while rest := rest or data.read(chunk):
        inflate, parts, length = zlib.decompressobj(31), [], 0
        while not inflate.eof:
            if not rest and not (rest := data.read(chunk)):
                raise ValueError("the archive ends inside a record")
            parts.append(inflate.decompress(rest))
            length += len(rest) - len(inflate.unused_data)
            rest = inflate.unused_data
        yield at, length, *parse_record(b"".join(parts))
        at += length


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = member.partition(b"\r\n\r\n")
    headers = {k.decode(): v.decode() for k, v in HEADER.findall(head.partition(b"\r\n")[2] + b"\r\n")}
    block = rest[: int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def record_id(text: str | None) -> int | None:
    number = re.fullmatch(r"<urn:page:(-?\d+)>", text or "")
    return int(number[1]) if number else None


def decide(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", ts: str | None = None, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, ts, payload, digest, size, refers_to``; the payload of a revisit is null, its digest is not."""
    rows = pages.select(
        long_id(pages, page_id).alias("page_id"),
        F.col(url).cast("string").alias("url"),
        (F.col(ts).cast("string") if ts else F.lit(None).cast("string")).alias("ts"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    rows = rows.withColumns({"equal": F.sha2("payload", 256), "digest": F.sha1("payload"), "size": F.length("payload").cast("long")})
    first = rows.where(F.col("size") >= min_bytes).groupBy("equal").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").select(F.col("equal").alias("same"), "first_id")
    # Always by merge: which join adaptive execution chose would depend on which side was done first, and with it the rows of each task.
    joined = rows.join(first.hint("merge"), F.col("equal") == F.col("same"), "left")
    joined = joined.withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")))
    return joined.withColumn("payload", F.when(F.col("refers_to").isNull(), F.col("payload"))).select("page_id", "url", "ts", "payload", "digest", "size", "refers_to")


def order(row: tuple) -> tuple:
    """Sort key of an index row: URL key, timestamp, id (none first), place."""
    return (row[0], row[1], row[2] is not None, row[2] or 0, row[3], row[4])


def write_segment(uri: str, rows: Iterator[tuple]) -> tuple[int, list[tuple]]:
    """Write sorted index rows in blocks; their number and some of their sort keys, evenly spaced, the first and the last among them."""
    n, keys, step, row = 0, [], 1, None
    with Writer(uri) as out:
        sink = pq.ParquetWriter(pa.PythonFile(_Sink(out), mode="w"), RUN)
        while block := [row for _, row in zip(range(BLOCK), rows)]:  # noqa: B905  the last block may be short
            for row in block:
                if n % step == 0:
                    keys.append(order(row))
                    if len(keys) > 2 * KEYS:
                        keys, step = keys[::2], step * 2
                n += 1
            sink.write_table(pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*block, strict=True), RUN, strict=True)], schema=RUN), row_group_size=BLOCK)
        sink.close()
    if row is not None and keys[-1] != order(row):
        keys.append(order(row))
    return n, keys


class _Sink:
    """What a Parquet writer needs of a file."""

    def __init__(self, out: Writer):
        self.out, self.closed = out, False

    def write(self, data) -> int:
        self.out.write(bytes(data))
        return len(data)

    def tell(self) -> int:
        return self.out.at

    def flush(self) -> None:
        pass

    def close(self) -> None:
        self.closed = True

    def readable(self) -> bool:
        return False

    def writable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return False


def read_run(segments: list[str], low: tuple | None, high: tuple | None) -> Iterator[tuple]:
    """The rows of a run from ``low`` on and before ``high``, block by block."""
    for uri in segments:
        file, _ = reader(uri)
        with file:
            source = pq.ParquetFile(file)
            for i in range(source.num_row_groups):
                stats = source.metadata.row_group(i).column(0).statistics
                if stats is not None and stats.has_min_max and (low is not None and stats.max < low[0] or high is not None and stats.min > high[0]):
                    continue
                columns = source.read_row_group(i).to_pydict()
                for row in zip(*(columns[f.name] for f in RUN), strict=True):
                    key = order(row)
                    if (low is None or key >= low) and (high is None or key < high):
                        yield row


class LoserTree:
    """Merges sorted iterators: each inner node keeps the loser of its match, the winner goes up.

    An iterator that has ended loses to every other; equal keys go to the earlier
    iterator, so the merge is stable.
    """

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs = runs
        self.heads: list[tuple | None] = [next(r, None) for r in runs]
        self.keys = [h and order(h) for h in self.heads]
        k = len(runs)
        self.losers = [-1] * max(k, 1)
        winners = [-1] * k + list(range(k))
        for node in range(k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._before(a, b) else (b, a)
        self.winner = winners[1] if k > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        x, y = self.keys[a], self.keys[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return x < y or x == y and a < b

    def __iter__(self) -> Iterator[tuple]:
        k = len(self.runs)
        while k and (head := self.heads[self.winner]) is not None:
            yield head
            at = self.winner
            self.heads[at] = next(self.runs[at], None)
            self.keys[at] = self.heads[at] and order(self.heads[at])
            node = (at + k) // 2
            while node:
                if self._before(self.losers[node], at):
                    self.losers[node], at = at, self.losers[node]
                node //= 2
            self.winner = at


CATALOG_SQL = "run long, segment long, file string, n long, keys string"


def write_archives(pages: DataFrame, folder: str, **options) -> DataFrame:
    """Write the archives of ``pages`` and one sorted index run for each; the runs' catalog, a row for each writing task."""
    spark = pages.sparkSession
    bound_batches(spark)
    # Rows come in one order, whatever order they were fetched in, so a second attempt writes the same bytes.
    rows = decide(pages, **options).sortWithinPartitions("digest", F.asc_nulls_first("page_id"), F.asc_nulls_first("url"), F.asc_nulls_first("ts"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, index = TaskContext.get().partitionId(), []
        name = f"{folder}/archive/{number:06d}.warc.gz"
        rows = (row for batch in batches for row in batch.to_pylist())
        head = next(rows, None)
        if head is None:
            return
        with Writer(name) as out:
            for row in chain([head], rows):
                at = row["ts"] or timestamp(row["page_id"])
                digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
                data = record(row["page_id"], row["url"], at, row["payload"] or b"", digest, row["refers_to"], row["size"])
                index.append((url_key(row["url"]), at, row["page_id"], name, out.write(data), len(data)))
        index.sort(key=order)
        uri = f"{folder}/runs/0/{number:06d}/000000.parquet"
        n, keys = write_segment(uri, iter(index))
        yield pa.RecordBatch.from_pydict({"run": [number], "segment": [0], "file": [uri], "n": [n], "keys": [json.dumps(keys)]})

    return cut(rows.mapInArrow(write, CATALOG_SQL))


def merge_runs(catalog: DataFrame, folder: str, fan_in: int = FAN_IN, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Merge the runs of ``catalog`` until one is left; its segments' catalog, ``start`` being the captures before each.

    The driver sees a row for each segment, with at most ``2 * KEYS`` keys of it,
    and no captures.
    """
    spark = catalog.sparkSession
    level = 0
    while True:
        level += 1
        segments: dict[int, list] = {}
        for r in catalog.orderBy("run", "segment").collect():
            segments.setdefault(r["run"], []).append((r["file"], r["n"], [tuple(k) for k in json.loads(r["keys"])]))
        runs = [segments[k] for k in sorted(segments)]
        tasks = []
        for group in range(0, len(runs), fan_in):
            own = runs[group : group + fan_in]
            total = sum(n for run in own for _, n, _ in run)
            keys = sorted(k for run in own for _, _, seg_keys in run for k in seg_keys)
            ranges = max(1, min(-(-total // range_rows), len(keys)))
            bounds = [None, *sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}), None]
            for i, (low, high) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                # Of each run, the segments that reach into the range.
                files = [[file for file, _, seg_keys in run if seg_keys and (low is None or seg_keys[-1] >= low) and (high is None or seg_keys[0] < high)] for run in own]
                tasks.append((group // fan_in, i, json.dumps({"low": low, "high": high, "runs": [run for run in files if run], "level": level})))
        if not tasks:
            return catalog.select("*", F.lit(0).cast("long").alias("start"))

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    job = json.loads(row["job"])
                    low, high = (tuple(job[x]) if job[x] is not None else None for x in ("low", "high"))
                    tree = LoserTree([read_run(files, low, high) for files in job["runs"]])
                    uri = f"{folder}/runs/{job['level']}/{row['run']:06d}/{row['segment']:06d}.parquet"
                    n, keys = write_segment(uri, iter(tree))
                    yield pa.RecordBatch.from_pydict({"run": [row["run"]], "segment": [row["segment"]], "file": [uri], "n": [n], "keys": [json.dumps(keys)]})

        jobs = spark.createDataFrame(tasks, "run long, segment long, job string")
        catalog = cut(jobs.repartition(len(tasks), "run", "segment").mapInArrow(merge, CATALOG_SQL))
        if len(runs) <= fan_in:
            break
    starts, at = [], 0
    for r in catalog.orderBy("segment").collect():
        starts.append((r["run"], r["segment"], r["file"], r["n"], r["keys"], at))
        at += r["n"]
    return spark.createDataFrame(starts, CATALOG_SQL + ", start long")


def histories(catalog: DataFrame) -> DataFrame:
    """All captures in global order: ``url_key, ts, page_id, file, offset, length, capture_no``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at, rows = row["start"], read_run([row["file"]], None, None)
                while block := [r for _, r in zip(range(BLOCK), rows)]:  # noqa: B905
                    yield pa.RecordBatch.from_arrays([*(pa.array(x, f.type) for x, f in zip(zip(*block, strict=True), RUN, strict=True)), pa.array(range(at, at + len(block)), pa.int64())], names=[*RUN.names, "capture_no"])
                    at += len(block)

    n = max(1, catalog.count())
    return catalog.select("file", "start").repartition(n, "file").mapInArrow(read, RUN_SQL + ", capture_no long")


def read_archives(files: DataFrame) -> DataFrame:
    """Every record of the archives that ``files`` names: ``file, offset, page_id, url, record_type, digest, size, refers_to, html``.

    A response's length and digest are taken from its payload, which must bear
    out its header; those of a revisit are what its header says.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("file", "offset", "page_id", "url", "record_type", "digest", "size", "refers_to", "html")
        for batch in batches:
            for uri in batch.column("file").to_pylist():
                file, _ = reader(uri)
                with file:
                    held = []
                    for at, _, head, payload in records(file):
                        kind, digest, size = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:"), int(head["X-Payload-Length"])
                        if kind == "response" and (sha1(payload), len(payload)) != (digest, size):
                            raise ValueError(f"{uri}: the payload at {at} does not match its digest")
                        held.append((uri, at, record_id(head["WARC-Record-ID"]), head["WARC-Target-URI"], kind, digest, size, record_id(head.get("WARC-Refers-To")), payload.decode() if kind == "response" else None))
                        if len(held) == 256:
                            yield _batch(names, held)
                            held = []
                    if held:
                        yield _batch(names, held)

    n = max(1, files.count())
    return files.select("file").repartition(n, "file").mapInArrow(read, "file string, offset long, page_id long, url string, record_type string, digest string, size long, refers_to long, html string")


def _batch(names, rows):
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=list(names))


def report(pages: DataFrame, **options) -> DataFrame:
    """Write, merge, read back and remove the files: ``page_id, payload_bytes, payload_digest, record_type, refers_to, url_key, capture_no``."""
    spark = pages.sparkSession
    folder = shared_folder(spark, "warc")
    runs = write_archives(pages, folder, **options)
    merged = histories(merge_runs(runs, folder)).select("file", "offset", "url_key", "capture_no")
    archives = runs.select(F.concat(F.lit(f"{folder}/archive/"), F.lpad(F.col("run").cast("string"), 6, "0"), F.lit(".warc.gz")).alias("file"))
    found = read_archives(archives).drop("html", "url")
    # Both sides grow with the collection; what they are made from is small, so the planner would take them to be small.
    out = found.join(merged.hint("merge"), ["file", "offset"]).select("page_id", F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to", "url_key", "capture_no")
    out = cut(out)
    remove_folder(folder)
    return out


def _base32_sql(digest: str) -> str:
    """Base32 of a hexadecimal SHA-1: each five digits make four characters."""
    chunks = []
    for i in range(8):
        value = f"CAST('0x' || substr({digest}, {5 * i + 1}, 5) AS INTEGER)"
        chunks += [f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({value} >> {shift}) & 31) + 1, 1)" for shift in (15, 10, 5, 0)]
    return " || ".join(chunks)


ORACLE = f"""
WITH sized AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS digest FROM pages),
firsts AS (SELECT html, min(page_id) AS first_id FROM sized GROUP BY html)
SELECT page_id, CAST(strlen(s.html) AS BIGINT) AS payload_bytes, {_base32_sql("digest")} AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM sized s JOIN firsts USING (html)
"""

"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors with cosine c are at squared distance 2 - 2c. The vectors are turned
by a fixed random rotation and split into blocks of few dimensions; if two of them
are within the whole squared distance, then in some block they are within that
block's share of it. So each block is range-joined by itself, under its share, and
the candidates of all blocks are verified by their cosine in double precision. A
pair is counted in the first block that brings it, so no list of pairs is made or
made distinct: each task sends numbers of links and edges that connect what it
found linked.

The vectors lie in files of bounded size in the shared folder, written once. Each
two files meet in one place, block by block, and the task reads them there; so a
task holds two files, and what is on disk grows with the vectors alone. The work
grows with the square of the number of distinct vectors. ``deal`` is the other way
to bring a block's vectors together, by cells of its first coordinates that are
shuffled; the query does not use it, for it sends a vector once for each task.

Equal vectors are joined once, with their number. Defined cases: vectors that are
null, empty, all zero or hold null or non-finite components link with nothing;
neither do rows whose id is null, or vectors of different lengths; rows that
share an id are one node, and each counts as a vector; labels are not read.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furlong.llm.common import bound_batches, long_id, map_rows
from furlong.llm.storage import Writer, reader, remove_folder
from furlong.operators.components import connected_components, forest
from furlong.session import cut, shared_folder

COSINE = 0.95
BLOCK_DIMS = 16
#: Vectors of a part of a cell, about; decides how many coordinates are cut, and into how many parts a cell is split that holds more than two.
CELL = 32_768
#: Slack of the single-precision filters, in squared distance; the verification has none.
SLACK = 1e-4


def rotation(dims: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(95).standard_normal((dims, dims)))[0]


def blocks_of(dims: int, block_dims: int = BLOCK_DIMS) -> list[tuple[int, int]]:
    return [(a, min(a + block_dims, dims)) for a in range(0, dims, block_dims)]


def turned(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors, rotated, in single precision."""
    norm = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    return ((vectors / norm[:, None]) @ rotation(vectors.shape[1])).astype(np.float32)


def budget(a: int, b: int, dims: int, cosine: float) -> float:
    """The share of the squared distance that dimensions a to b get."""
    return (2 - 2 * cosine) * (b - a) / dims


def distinct_vectors(vectors: DataFrame, vec_id: str, embedding: str) -> tuple[DataFrame, DataFrame]:
    """(rows with id and vector, null where it cannot link; distinct vectors ``rep, copies, v``)."""
    v = F.col(embedding).cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    good = F.col(vec_id).isNotNull() & (F.size(v) > 0) & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0)
    plain = F.transform(embedding, lambda x: F.when(x == 0, F.abs(x)).otherwise(x))
    rows = vectors.select(long_id(vectors, vec_id).alias("vec_id"), F.when(good, plain).alias("v"))
    return rows, rows.where("v is not null").groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))


def with_turned(distinct: DataFrame) -> DataFrame:
    """``rep, copies, v, t``: ``t`` is the turned unit vector. It is made once, so that all tasks judge a pair's blocks alike."""

    def make(batch: pa.RecordBatch) -> dict:
        lists = [np.asarray(x, np.float64) for x in batch.column("v").to_pylist()]
        out: list = [None] * len(lists)
        for dims in {len(x) for x in lists}:
            at = [i for i, x in enumerate(lists) if len(x) == dims]
            for i, t in zip(at, turned(np.stack([lists[i] for i in at])), strict=True):
                out[i] = t
        return {"rep": batch.column("rep"), "copies": batch.column("copies"), "v": batch.column("v").cast(pa.list_(pa.float64())), "t": pa.array(out, pa.list_(pa.float32()))}

    return map_rows(distinct, make, "rep long, copies long, v array<double>, t array<float>")


def _matrix(column) -> np.ndarray:
    """A list column, all of one length, as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def cells_of(x: np.ndarray, number: int, a: int, b: int, cosine: float, cuts: int):
    """(cell, rows, home): the cells of block ``number`` that the turned vectors ``x`` go to.

    Of two vectors in neighbouring cells, the one in the later cell is sent to the
    earlier one, so that they meet once.
    """
    width = 2 * math.sqrt(budget(a, b, x.shape[1], cosine) + 2 * SLACK)
    g = min(cuts, b - a)
    scaled = x[:, a : a + g].astype(np.float64) / width
    own = np.floor(scaled).astype(np.int64)
    side = np.where(scaled - own < 0.5, -1, 1)
    for mask in range(1 << g):
        bits = np.array([(mask >> i) & 1 for i in range(g)], np.int64)
        first = next((i for i in range(g) if bits[i]), None)
        rows = np.arange(len(x)) if first is None else np.flatnonzero(side[:, first] == -1)
        name = np.full(len(rows), number * 65_536 + x.shape[1], np.int64)
        for i in range(g):
            name = name * 128 + own[rows, i] + side[rows, i] * bits[i] + 64
        yield name, rows, first is None


#: What a row is to its task: compared with rows at home only, at home, at home and compared with its like as well.
GUEST, HOME, WITHIN = 0, 1, 2


def _part(rep: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """The part of its cell that a vector belongs to, from a mixed hash of its number."""
    h = rep.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return ((h ^ (h >> np.uint64(31))) % parts.astype(np.uint64)).astype(np.int64)


def _tasks(own: np.ndarray, parts: np.ndarray, home: bool):
    """(rows, task, role) of vectors that belong to part ``own`` of cells in ``parts`` parts.

    Task (i, j) of a cell compares its home part i with its part j: with the
    guests there and, for j behind i, the vectors at home there. Task (i, i) also
    compares part i's home vectors with each other.
    """
    for other in range(int(parts.max(initial=0))):
        rows = np.flatnonzero(parts > other)
        mine, k = own[rows], parts[rows]
        if home:
            yield rows, mine * k + other, np.where(mine == other, WITHIN, HOME)
            behind = mine > other
            yield rows[behind], (other * k + mine)[behind], np.full(int(behind.sum()), GUEST)
        else:
            yield rows, other * k + mine, np.full(len(rows), GUEST)


def _deal(cosine: float, block_dims: int, cuts: int, crowded, carry: bool, read: int = 512, written: int = 8_192):
    """Rows ``cell, part, role`` of the tasks that each vector goes to, with the vector itself if ``carry``; so many rows are read and written at a time."""

    def tasks_of(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        t = batch.column("t")
        rep = np.asarray(batch.column("rep"))
        sizes = np.asarray(t.value_lengths())
        hot, hot_parts = crowded.value if crowded else (np.zeros(0, np.int64),) * 2
        names, tasks, roles, rows = [], [], [], []
        for dims in np.unique(sizes):
            at = np.flatnonzero(sizes == dims)
            x = _matrix(t.take(pa.array(at)))
            for number, (a, b) in enumerate(blocks_of(int(dims), block_dims)):
                for name, own, home in cells_of(x, number, a, b, cosine, cuts):
                    parts = np.ones(len(name), np.int64)
                    if len(hot):
                        place = np.minimum(np.searchsorted(hot, name), len(hot) - 1)
                        parts = np.where(hot[place] == name, hot_parts[place], 1)
                    for some, task, role in _tasks(_part(rep[at[own]], parts), parts, home):
                        names.append(name[some])
                        tasks.append(task)
                        roles.append(role)
                        rows.append(at[own[some]])
        return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (names, tasks, roles, rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, read):
                some = batch.slice(first, read)
                names, tasks, roles, rows = tasks_of(some)
                for at in range(0, len(rows), written):
                    until = at + written
                    out = {"cell": pa.array(names[at:until]), "part": pa.array(tasks[at:until]), "role": pa.array(roles[at:until].astype(np.int8))}
                    take = pa.array(rows[at:until])
                    yield pa.RecordBatch.from_pydict(out | ({n: some.column(n).take(take) for n in ("rep", "copies", "v", "t")} if carry else {}))

    return run


def _pairs(home: pa.Table, guest: pa.Table, within: bool, number: int, cosine: float, block_dims: int, chunk: int = 512):
    """(i, j) of linked pairs that this block is the first to bring; i at home, j a guest or, if ``within``, at home behind i."""
    both = pa.concat_tables([home, guest])
    t, v = _matrix(both.column("t")), _matrix(both.column("v"))
    n, dims = home.num_rows, t.shape[1]
    spans = blocks_of(dims, block_dims)
    a, b = spans[number]
    own = t[:, a:b]
    square = np.einsum("ij,ij->i", own, own)
    left = np.concatenate((-2 * own, np.ones((len(t), 1), np.float32), square[:, None]), 1)
    right = np.concatenate((own, square[:, None], np.ones((len(t), 1), np.float32)), 1)
    norm = np.sqrt(np.einsum("ij,ij->i", v, v))
    limit = np.float32(budget(a, b, dims, cosine) + 2 * SLACK)
    for at in range(0, n, chunk):
        until = min(at + chunk, n)
        since = at if within else n
        near = left[at:until] @ right[since:].T <= limit
        i, j = np.divmod(np.flatnonzero(near), max(near.shape[1], 1))
        i, j = i + at, j + since
        i, j = i[i < j], j[i < j]
        for some in range(0, len(i), 65_536):
            p, q = i[some : some + 65_536], j[some : some + 65_536]
            apart = (t[p].astype(np.float64) - t[q]) ** 2
            brought = [apart[:, x:y].sum(1) <= budget(x, y, dims, cosine) + SLACK for x, y in spans[: number + 1]]
            first = brought[number] & ~np.logical_or.reduce([*brought[:number], np.zeros(len(p), bool)])
            p, q = p[first], q[first]
            linked = np.einsum("ij,ij->i", v[p], v[q]) / (norm[p] * norm[q]) >= cosine
            yield p[linked], q[linked]


def _join(cosine: float, block_dims: int):
    """Per task of a cell: ``a, b, n``: edges (n = 0) and numbers of links of a vector (b null)."""

    def cell_rows(table: pa.Table):
        role = table.column("role").to_numpy()
        inside, outside = table.filter(pa.array(role != GUEST)), table.filter(pa.array(role == GUEST))
        if not inside.num_rows:
            return
        rep = np.concatenate((inside.column("rep").to_numpy(), outside.column("rep").to_numpy()))
        copies = np.concatenate((inside.column("copies").to_numpy(), outside.column("copies").to_numpy()))
        links, edges = np.zeros(len(rep), np.int64), []
        for p, q in _pairs(inside, outside, bool((role == WITHIN).any()), int(table.column("block")[0].as_py()), cosine, block_dims):
            np.add.at(links, p, copies[q])
            np.add.at(links, q, copies[p])
            edges += zip(rep[p].tolist(), rep[q].tolist(), strict=True)
            if len(edges) > 200_000:
                edges = forest(edges)
        edges, some = forest(edges), np.flatnonzero(links)
        if len(some) or edges:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*(x for x, _ in edges), *rep[some].tolist()], pa.int64()),
                    pa.array([*(y for _, y in edges), *[None] * len(some)], pa.int64()),
                    pa.array([*[0] * len(edges), *links[some].tolist()], pa.int64()),
                ],
                names=["a", "b", "n"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        name = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cell, part = batch.column("cell").to_numpy(), batch.column("part").to_numpy()
            cuts_ = np.flatnonzero((cell[1:] != cell[:-1]) | (part[1:] != part[:-1])) + 1
            for x, y in zip([0, *cuts_], [*cuts_, len(cell)], strict=True):
                if held and name != (cell[x], part[x]):
                    yield from cell_rows(pa.Table.from_batches(held))
                    held = []
                name = (cell[x], part[x])
                held.append(batch.slice(x, y - x))
        if held:
            yield from cell_rows(pa.Table.from_batches(held))

    return run


def deal(distinct: DataFrame, cosine: float, block_dims: int, cuts: int, cell: int) -> DataFrame:
    """``cell, part, role`` and the vector, for every task that it goes to; cells of more than ``cell`` rows are split."""
    spark = distinct.sparkSession
    counts = distinct.select("rep", "t").mapInArrow(_deal(cosine, block_dims, cuts, None, False), "cell long, part long, role byte").groupBy("cell").agg(F.count("*").alias("rows")).where(F.col("rows") > 2 * cell)
    # At most one such cell for each 2 * cell of the rows dealt.
    crowded = sorted((r["cell"], math.ceil(r["rows"] / cell)) for r in counts.collect())
    shared = spark.sparkContext.broadcast(tuple(np.array([c[i] for c in crowded], np.int64) for i in (0, 1)))
    return distinct.mapInArrow(_deal(cosine, block_dims, cuts, shared, True), "cell long, part long, role byte, rep long, copies long, v array<double>, t array<float>")


def _store(folder: str, cell: int):
    """Write files of at most ``cell`` distinct vectors of one length, with their turned ones; rows ``rep, copies, h, file, dims``."""

    def saved(table: pa.Table, dims: int):
        for at in range(0, table.num_rows, cell):
            part = table.slice(at, cell).combine_chunks()
            t = turned(_matrix(part.column("v")).astype(np.float64))
            part = part.append_column("t", pa.FixedSizeListArray.from_arrays(pa.array(t.reshape(-1)), dims))
            uri = f"{folder}/{uuid.uuid4().hex}.arrow"
            with Writer(uri) as out, pa.ipc.new_stream(pa.PythonFile(out.stream, "w"), part.schema) as stream:
                stream.write_table(part)
            n = part.num_rows
            yield from pa.table({"rep": part.column("rep"), "copies": part.column("copies"), "h": part.column("h"), "file": [uri] * n, "dims": pa.array([dims] * n, pa.int32())}).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        counts: dict[int, int] = {}
        for batch in batches:
            sizes = np.asarray(batch.column("v").value_lengths())
            for dims in np.unique(sizes).tolist():
                held.setdefault(dims, []).append(batch.filter(pa.array(sizes == dims)))
                counts[dims] = counts.get(dims, 0) + held[dims][-1].num_rows
                if counts[dims] >= cell:
                    yield from saved(pa.Table.from_batches(held.pop(dims)), dims)
                    del counts[dims]
        for dims, some in held.items():
            yield from saved(pa.Table.from_batches(some), dims)

    return run


def _meet(files: list[tuple[str, int]], cosine: float, block_dims: int):
    """Rows ``a, b, n`` as of ``_join`` for rows ``i, j`` that name two files, each read where it is needed."""
    joined = _join(cosine, block_dims)

    def load(at: int) -> pa.Table:
        file, _ = reader(files[at][0])
        with file:
            table = pa.ipc.open_stream(file).read_all().select(["rep", "copies", "v", "t"])
        # The verification is in double precision.
        return table.set_column(2, "v", table.column("v").cast(pa.list_(pa.float64())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, home = None, None
        for batch in batches:
            for i, j in zip(batch.column("i").to_pylist(), batch.column("j").to_pylist(), strict=True):
                if last != i:
                    last, home = i, load(i)
                both = home if i == j else pa.concat_tables([home, load(j)])
                n = both.num_rows
                role = np.full(n, GUEST, np.int8)
                role[: home.num_rows] = WITHIN if i == j else HOME
                for number in range(len(blocks_of(files[i][1], block_dims))):
                    names = {"cell": np.full(n, number), "part": np.zeros(n, np.int64), "role": role, "block": np.full(n, number)}
                    table = both
                    for name, values in names.items():
                        table = table.append_column(name, pa.array(values))
                    yield from joined(iter(table.combine_chunks().to_batches()))

    return run


def _met(files: list[tuple[str, int]], spark, cosine: float, block_dims: int) -> DataFrame:
    """``a, b, n`` of each two files of vectors of one length, and of each file with itself."""
    k, parts = len(files), int(spark.conf.get("spark.sql.shuffle.partitions"))
    # File i meets the half of the files behind it, in a ring, so that all have equally many to meet.
    half = k // 2 + 1
    dims = F.array(*[F.lit(d) for _, d in files])
    pairs = spark.range(0, k * half, numPartitions=max(1, min(k * half, max(k, 4 * parts))))
    pairs = pairs.select(F.expr(f"id div {half}").alias("i"), F.expr(f"id % {half}").alias("d")).withColumn("j", (F.col("i") + F.col("d")) % k)
    pairs = pairs.where((F.col("d") * 2 < k) | (F.col("i") < F.col("j"))).where(F.get(dims, F.col("i")) == F.get(dims, F.col("j"))).select("i", "j")
    found = pairs.mapInArrow(_meet(files, cosine, block_dims), "a long, b long, n long")
    return found.groupBy("a", "b").agg(F.sum("n").alias("n"))


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE, block_dims: int = BLOCK_DIMS, cell: int = CELL) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row; a task holds ``2 * cell`` distinct vectors at most."""
    spark = vectors.sparkSession
    bound_batches(spark)
    rows, distinct = distinct_vectors(vectors, vec_id, embedding)
    digest = F.md5(F.col("v").cast("string"))
    distinct = distinct.withColumn("h", digest)
    if distinct.schema["v"].dataType.elementType != T.FloatType():
        distinct = distinct.withColumn("v", F.col("v").cast("array<double>"))
    # Vectors lie in files that tasks read in pairs, so that none is sent once for each task; what is joined is a digest.
    folder = shared_folder(spark, "vectors")
    distinct = cut(distinct.mapInArrow(_store(folder, cell), "rep long, copies long, h string, file string, dims int"))
    files = sorted((r["file"], r["dims"]) for r in distinct.select("file", "dims").distinct().collect())
    found = cut(_met(files, spark, cosine, block_dims) if files else spark.createDataFrame([], "a long, b long, n long"))
    remove_folder(folder)
    components = connected_components(found.where("b is not null").select(F.col("a").alias("src"), F.col("b").alias("dst")))
    links = found.where("b is null").groupBy("a").agg(F.sum("n").alias("n"))
    reps = distinct.select("rep", "copies").distinct().groupBy("rep").agg(F.sum("copies").alias("copies"))
    known = reps.join(links, reps["rep"] == links["a"], "left").join(components, reps["rep"] == components["node"], "left")
    known = known.select("rep", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "rep").alias("component"))
    own = rows.select("vec_id", digest.alias("h")).join(distinct.select("h", "rep"), "h", "left").select("vec_id", "rep")
    own = own.withColumnRenamed("rep", "r")
    out = own.join(known, own["r"] == known["rep"], "left")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").cast("long").alias("component_id"), F.coalesce(F.col("vec_id") == F.coalesce("component", "vec_id"), F.lit(False)).alias("kept"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON len(a.e) = len(b.e) AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT vec_id AS node, vec_id AS root FROM embeddings UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node),
roots AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings LEFT JOIN counts ON a = vec_id LEFT JOIN roots ON node = vec_id
"""

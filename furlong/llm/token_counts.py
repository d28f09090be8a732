"""Token counts that follow edits.

``build`` keeps a tree for each document, as a row of a table: the document's text
as segments that begin at pre-token boundaries, with the tokens of each; the sums
above them (characters and tokens) follow from these numbers alone. ``apply_edits``
takes such a table and edits, and returns the table after them. An edit goes down
the tree to the segments it touches, takes the boundary context in, pre-tokenizes
that stretch again until its boundaries meet the old ones, and updates the sums
above; the rest of the document is not encoded again. The new table can be written
in place of the old one and edited later.

Defined cases: a null or empty text counts 0; places are those of the text before
all edits of one call, which take effect together; of edits at one place, those
of the smaller end and then of the lesser text come first. An edit is refused, and
counted as such, if its text or a place of it is null, if it reaches outside the
text, if it begins before the end of another that comes first, or if the text is
null. Edits of unknown documents are ignored; rows that share an id get the same
edits; texts of any length are counted whole; repeated rows are counted one by one.
Only the named columns are read.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong.llm.common import bound_batches, map_rows
from furlong.llm.storage import remove_folder
from furlong.session import cut, shared_folder

RANKS = "byte_bpe_50k.tiktoken"
#: Pre-tokens of a segment, and pre-tokens whose counts a worker remembers.
SEGMENT = 64
MEMORY = 500_000
#: What the query redacts: e-mail and IPv4 addresses.
REDACT = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+|\b\d{1,3}(?:\.\d{1,3}){3}\b"
PLACEHOLDER = "<redacted>"


class Counter:
    """Tokens of pre-tokens by a rank file; remembers the counts it has made."""

    def __init__(self, ranks: str = RANKS):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(ranks), "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("counts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.known: dict[str, int] = {}

    def count(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            n = len(self.encoding.encode_ordinary(piece))
            if len(self.known) >= MEMORY:
                self.known.clear()
            if len(piece) <= 64:
                self.known[piece] = n
        return n


def segments(text: str, counter: Counter, segment: int = SEGMENT) -> tuple[list[str], list[int]]:
    """A text cut at every so many pre-tokens, and the tokens of each part."""
    pieces = counter.pattern.findall(text)
    known, count = counter.known, counter.count
    tokens = np.array([known.get(p) or count(p) for p in pieces], np.int64)
    starts = np.arange(0, len(pieces), segment)
    return ["".join(pieces[i : i + segment]) for i in starts.tolist()], (np.add.reduceat(tokens, starts) if len(pieces) else tokens).tolist()


def accept(edits: list[tuple], n_chars: int) -> list[tuple[int, int, str]]:
    """The edits that are not refused, in order."""
    sound = sorted(e for e in edits if None not in e and 0 <= e[0] <= e[1] <= n_chars)
    out: list[tuple[int, int, str]] = []
    for edit in sound:
        if not out or edit[0] >= out[-1][1]:
            out.append(edit)
    return out


class CountTree:
    """Segments of a text under sums of their characters and tokens."""

    def __init__(self, texts: list[str], tokens: list[int], counter: Counter):
        self.counter, self.reencoded = counter, 0
        self.texts = list(texts) or [""]
        self.leaves = 1 << (len(self.texts) - 1).bit_length()
        self.sums = np.zeros((2, 2 * self.leaves), np.int64)
        self.sums[0, self.leaves : self.leaves + len(self.texts)] = [len(t) for t in self.texts]
        self.sums[1, self.leaves : self.leaves + len(tokens)] = tokens
        for first in _levels(self.leaves):
            self.sums[:, first : 2 * first] = self.sums[:, 2 * first : 4 * first].reshape(2, first, 2).sum(2)

    def kept(self) -> tuple[list[str], list[int]]:
        """The segments that hold text, and their tokens."""
        tokens = self.sums[1, self.leaves : self.leaves + len(self.texts)].tolist()
        own = [(t, n) for t, n in zip(self.texts, tokens, strict=True) if t]
        return [t for t, _ in own], [n for _, n in own]

    @property
    def total(self) -> int:
        return int(self.sums[1, 1])

    def _leaf(self, place: int) -> tuple[int, int]:
        """The segment that holds a character, and the characters before that segment."""
        node, before = 1, 0
        while node < self.leaves:
            left = int(self.sums[0, 2 * node])
            node *= 2
            if place - before >= left and self.sums[0, node + 1]:
                before += left
                node += 1
        return node - self.leaves, before

    def _set(self, leaf: int, text: str, tokens: int) -> None:
        self.texts[leaf] = text
        node = leaf + self.leaves
        self.sums[:, node] = len(text), tokens
        while node := node // 2:
            self.sums[:, node] = self.sums[:, 2 * node] + self.sums[:, 2 * node + 1]

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace the characters from ``start`` on and before ``end``."""
        # A pre-token can hang on the two characters after it, so one that ends less than two before the edit may change.
        first, before = self._leaf(max(0, start - 2))
        while first and (before + 2 > start or not self.texts[first]):
            first -= 1
            before -= len(self.texts[first])
        last, at = first, before + len(self.texts[first])
        while at < end and last + 1 < len(self.texts):
            last += 1
            at += len(self.texts[last])
        old = "".join(self.texts[first : last + 1])
        text = old[: start - before] + new + old[end - before :]
        while True:
            # Two characters beyond the stretch settle its last boundary; without them it may only look settled.
            ahead, following = "", last + 1
            while len(ahead) < 2 and following < len(self.texts):
                ahead += self.texts[following]
                following += 1
            pieces, place, met = [], 0, not ahead
            for match in self.counter.pattern.finditer(text + ahead):
                if match.start() == len(text):
                    met = True
                if match.start() >= len(text):
                    break
                pieces.append(match.group())
                place = match.end()
            if place == len(text) and (met or not ahead):
                break
            last += 1
            text += self.texts[last]
        self.reencoded += len(text)
        tokens = sum(map(self.counter.count, pieces))
        self._set(first, text, tokens)
        for leaf in range(first + 1, last + 1):
            self._set(leaf, "", 0)


def _levels(leaves: int):
    first = leaves // 2
    while first:
        yield first
        first //= 2


_counters: dict[str, Counter] = {}


def counter(ranks: str) -> Counter:
    if ranks not in _counters:
        _counters[ranks] = Counter(ranks)
    return _counters[ranks]


def build(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranks: str = RANKS, segment: int = SEGMENT) -> DataFrame:
    """``doc_id, n_chars, n_tokens, texts, tokens``: the tree of every document; ``texts`` is null where the text is."""
    bound_batches(docs.sparkSession)

    def make(batch: pa.RecordBatch) -> dict:
        tool, values = counter(ranks), batch.column("text").to_pylist()
        trees = [segments(v or "", tool, segment) for v in values]
        return {
            "doc_id": batch.column("doc_id"),
            "n_chars": pa.array([len(v or "") for v in values], pa.int64()),
            "n_tokens": pa.array([sum(t) for _, t in trees], pa.int64()),
            "texts": pa.array([None if v is None else t for v, (t, _) in zip(values, trees, strict=True)], pa.list_(pa.string())),
            "tokens": pa.array([t for _, t in trees], pa.list_(pa.int64())),
        }

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_rows(rows, make, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_chars long, n_tokens long, texts array<string>, tokens array<long>")


def apply_edits(trees: DataFrame, edits: DataFrame | None = None, redact: str = REDACT, placeholder: str = PLACEHOLDER, ranks: str = RANKS) -> DataFrame:
    """The trees after their edits: ``doc_id, n_chars, n_tokens, texts, tokens``, and ``n_tokens_before, n_edits, n_refused, n_chars_reencoded``.

    ``edits`` has a row ``doc_id, start, end, new`` for each; without it, the edits
    are the redactions that the pattern ``redact`` finds.
    """
    bound_batches(trees.sparkSession)
    rows = trees.select("doc_id", "n_tokens", "texts", "tokens")
    if edits is not None:
        own = edits.groupBy(F.col("doc_id").alias("edited")).agg(F.collect_list(F.struct(F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), F.col("new").cast("string").alias("new"))).alias("edits"))
        rows = rows.join(own, rows["doc_id"].eqNullSafe(own["edited"]), "left").drop("edited")
    given = edits is not None

    def make(batch: pa.RecordBatch) -> dict:
        tool, find = counter(ranks), regex.compile(redact)
        asked = batch.column("edits").to_pylist() if given else None
        out: dict[str, list] = {n: [] for n in ("n_chars", "n_tokens", "texts", "tokens", "n_edits", "n_refused", "n_chars_reencoded")}
        for i, (texts, tokens) in enumerate(zip(batch.column("texts").to_pylist(), batch.column("tokens").to_pylist(), strict=True)):
            n_chars = sum(map(len, texts or []))
            if given:
                changes = [(e["start"], e["end"], e["new"]) for e in asked[i] or []]
                good = accept(changes, n_chars) if texts is not None else []
            else:
                changes = good = [(*m.span(), placeholder) for m in find.finditer("".join(texts or []))]
            reencoded, n_tokens = 0, sum(tokens)
            if good:
                tree = CountTree(texts, tokens, tool)
                for change in reversed(good):
                    tree.edit(*change)
                texts, tokens = tree.kept()
                reencoded, n_tokens, n_chars = tree.reencoded, tree.total, int(tree.sums[0, 1])
            for name, x in zip(out, (n_chars, n_tokens, texts, tokens, len(good), len(changes) - len(good), reencoded), strict=True):
                out[name].append(x)
        kinds = {"texts": pa.list_(pa.string()), "tokens": pa.list_(pa.int64())}
        return {"doc_id": batch.column("doc_id")} | {n: pa.array(x, kinds.get(n, pa.int64())) for n, x in out.items()} | {"n_tokens_before": batch.column("n_tokens")}

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_rows(rows, make, f"doc_id {kind}, n_chars long, n_tokens long, texts array<string>, tokens array<long>, n_edits long, n_refused long, n_chars_reencoded long, n_tokens_before long")


def text_of(trees: DataFrame) -> DataFrame:
    """``doc_id, text`` of the trees."""
    return trees.select("doc_id", F.array_join("texts", "").alias("text"))


def edited_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", edits: DataFrame | None = None, redact: str = REDACT, placeholder: str = PLACEHOLDER, ranks: str = RANKS) -> DataFrame:
    """Build the trees of ``docs``, write them, and apply the edits to the written table: ``doc_id, n_tokens, n_edits, n_refused, n_chars_after, n_tokens_after, n_chars_reencoded``."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "trees")
    build(docs, doc_id, text, ranks).write.parquet(folder)
    after = apply_edits(spark.read.parquet(folder), edits, redact, placeholder, ranks)
    out = cut(after.select("doc_id", F.col("n_tokens_before").alias("n_tokens"), "n_edits", "n_refused", F.col("n_chars").alias("n_chars_after"), F.col("n_tokens").alias("n_tokens_after"), "n_chars_reencoded"))
    remove_folder(folder)
    return out

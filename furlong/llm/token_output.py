"""Token ids in seekable zstandard files.

Every document is a zstandard frame of its own (several, if it is very long), so
a reader decompresses only the documents it wants. A skippable frame lists the
documents, and the public seek table closes the file: sizes and a checksum of
each frame, then the footer. Tokenizing and compressing happen where the text is
read; only finished frames are moved, to the file that holds their range of ids.

Defined cases: a null or empty text has the end id only; documents come in
ascending id order, those without an id first, repeated ids in the order of their
tokens; texts are encoded whole, whatever their length; the string of a special
token in a text is that token, as the library has it; an id that is no whole
number is an error; an empty table gives no file. Only the named columns are read.
"""

from __future__ import annotations

import json
import re
import string
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from furlong.llm.common import bound_batches, long_id, map_rows, utf8
from furlong.llm.storage import Writer, reader, remove_folder
from furlong.session import cut, shared_folder

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
#: Ids of one frame at most.
FRAME_IDS = 1 << 18
LEVEL = 3
#: Documents of one file, about.
FILE_DOCS = 50_000
#: Pieces of text whose ids a worker remembers, in each of two generations.
MEMORY = 500_000
#: Bytes of such pieces in one generation, about.
MEMORY_BYTES = 32 << 20

#: Fixed values of the seekable format: the skippable frames' magic numbers and the footer's.
LIST_MAGIC, TABLE_MAGIC, FOOTER_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
WITH_CHECKSUMS = 0x80

#: The normalizer and pre-tokenizer of a tokenizer that drops white space and never joins across it.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}

#: Kinds of bytes in lower-cased UTF-8: spaces and line feeds, a to z, digits, ASCII punctuation, all others.
KINDS = bytes(0 if c in b" \n" else 1 if 97 <= c <= 122 else 2 if 48 <= c <= 57 else 3 if 33 <= c <= 126 and not 65 <= c <= 90 else 4 for c in range(256))
#: By the kinds of a byte and the one before it (5 times the latter's and its own): whether a piece begins, in texts as they are and in lower-cased ones.
AFTER_SPACE = bytes(0 < pair < 5 for pair in range(256))
AFTER_WORD = bytes(pair < 25 and pair % 5 > 0 and (pair < 5 or pair // 5 == 2 or pair % 5 == 2 or pair == 8) for pair in range(256))
#: For both, whether a piece ends before the second byte of the pair.
ENDS = {begins: bytes(5 <= pair < 25 and (pair % 5 == 0 or begins[pair]) for pair in range(256)) for begins in (AFTER_SPACE, AFTER_WORD)}

#: Letters below this one are alike in all versions of Unicode: lower-casing one gives one letter, and composition leaves it alone.
LATIN = "\u0130"
#: The characters of the bytes that byte-level vocabularies do not write as themselves.
BYTE_LEVEL = {byte: chr(256 + i) for i, byte in enumerate([*range(33), *range(127, 161), 173])}


class Memory:
    """Ids of pieces: where each piece's ids begin and end in one array."""

    def __init__(self):
        self.places: dict[bytes, int] = {}
        self.bounds, self.flat, self.size = np.zeros(1, np.int64), np.zeros(0, "<u4"), 0

    def find(self, pieces: list[bytes]) -> np.ndarray:
        """The pieces' places, -1 for those that are not here."""
        get = self.places.get
        return np.array([get(p, -1) for p in pieces], np.int64)

    def add(self, pieces: list[bytes], lengths: np.ndarray, ids: np.ndarray) -> None:
        self.places.update(zip(pieces, range(len(self.places), len(self.places) + len(pieces)), strict=True))
        self.bounds = np.append(self.bounds, self.bounds[-1] + np.cumsum(lengths))
        self.flat = np.append(self.flat, ids)
        self.size += sum(map(len, pieces))

    def take(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids at these places, one after the other, and the number of ids before each place and in all."""
        starts = self.bounds[places]
        lengths = self.bounds[places + 1] - starts
        before = np.append(0, np.cumsum(lengths))
        return self.flat[np.repeat(starts - before[:-1], lengths) + np.arange(before[-1])], before


class Encoder:
    """Encodes whole texts as the tokenizers library does by itself, special tokens' own strings included.

    A tokenizer that drops white space and never joins across it is asked for the
    pieces between spaces only, once for each piece: the ids of a text are those
    of its pieces one after the other. As it lower-cases, and its words also end
    where punctuation or a digit follows a letter, and at both sides of a digit,
    pieces are first brought to that form. Pieces are found, told apart and put
    together as columns, many texts at a time, so Python sees each one once a
    chunk. A new piece of Latin letters alone is one word, and goes straight to
    the library's model as the library would bring it there; words of other
    letters are encoded many at a time, as a word's last token is marked in the
    vocabulary; the rest goes through the library one by one. Texts in which
    lower-casing could change what is composed or found (combining marks, and the
    beginning of an added token) are split at spaces, but left as they are. Any
    other tokenizer gets whole texts.
    """

    #: Lead bytes of the combining marks that compose with ASCII letters; in UTF-8 they begin nothing but U+0300 to U+037F.
    MARKS = (b"\xcc", b"\xcd")
    #: New words encoded as one text.
    JOINED = 200
    #: Bytes of text whose pieces are told apart at once, about.
    CHUNK = 4 << 20

    def __init__(self, name: str = TOKENIZER):
        import public_tokenizers
        from tokenizers import Tokenizer

        path = public_tokenizers.path(name)
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        self.by_piece = parts["normalizer"] == NORMALIZER and parts["pre_tokenizer"] == PRE_TOKENIZER
        added = [token["content"].encode() for token in parts["added_tokens"]]
        self.by_piece = self.by_piece and not any(re.search(rb"\s", token) for token in added)
        #: What must not be lower-cased: an added token's first two bytes stand for it.
        self.careful = (*self.MARKS, *sorted({token[:2] for token in added}))
        self.model = self.tokenizer.model
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        # Two generations: when the younger is full, it becomes the elder and the elder goes.
        self.known, self.elder = Memory(), Memory()

    def _one_by_one(self, pieces: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _words(self, words: list[str]) -> list[list[int]]:
        ids = [i for x in self._one_by_one([" ".join(words[i : i + self.JOINED]) for i in range(0, len(words), self.JOINED)]) for i in x]
        ends = (np.flatnonzero(self.ends[np.array(ids, np.int64)]) + 1).tolist()
        if len(ends) != len(words):
            return self._one_by_one(words)
        return [ids[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def _learn(self, pieces: list[bytes]) -> None:
        known, words, others, split = {}, {}, {}, []
        tokenize = self.model.tokenize
        for piece in pieces:
            text = piece.decode()
            parts = (text,)
            if not text.isalpha():
                head = text.rstrip(string.punctuation)
                # After such a letter punctuation begins a token.
                if len(head) < len(text) and head[-1:].isalpha() and head[-1] < LATIN and not any(x in piece for x in self.careful):
                    parts = (head, text[len(head) :])
            for part in parts:
                if not part.isalpha():
                    others[part] = []
                elif max(part) >= LATIN:
                    words[part] = []
                else:
                    word = part.lower()
                    known[part] = [token.id for token in tokenize(word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_LEVEL))]
            split.append(parts)
        for some, encode in ((words, self._words), (others, self._one_by_one)):
            if some:
                known.update(zip(some, encode(list(some)), strict=True))
        ids = [[i for part in parts for i in known[part]] if len(parts) > 1 else known[parts[0]] for parts in split]
        self.known.add(pieces, np.fromiter(map(len, ids), np.int64, len(ids)), np.fromiter(chain.from_iterable(ids), "<u4"))

    def _places(self, pieces: list[bytes]) -> np.ndarray:
        """Where the younger memory holds these pieces, all different; it gets those that it lacks."""
        if len(self.known.places) > MEMORY or self.known.size > MEMORY_BYTES:
            self.elder, self.known = self.known, Memory()
        places = self.known.find(pieces)
        lacking = np.flatnonzero(places < 0)
        if len(lacking):
            some = [pieces[i] for i in lacking.tolist()]
            old = self.elder.find(some)
            ids, before = self.elder.take(old[old >= 0])
            self.known.add([p for p, place in zip(some, old.tolist(), strict=True) if place >= 0], np.diff(before), ids)
            self._learn([p for p, place in zip(some, old.tolist(), strict=True) if place < 0])
            places[lacking] = self.known.find(some)
        return places

    def _chunk(self, texts: list[bytes], begins: bytes) -> list[bytes]:
        """Ids of texts whose pieces begin as ``begins`` says."""
        whole = b" ".join([b"", *texts, b""])
        kinds = np.frombuffer(whole.translate(KINDS), np.uint8)
        pairs = (5 * kinds[:-1] + kinds[1:]).tobytes()
        first = np.flatnonzero(np.frombuffer(pairs.translate(begins), bool)) + 1
        if not len(first):
            return [b""] * len(texts)
        last = np.flatnonzero(np.frombuffer(pairs.translate(ENDS[begins]), bool))
        # The pieces without the spaces between them are a column; its dictionary tells them apart.
        offsets = np.append(0, np.cumsum(last + 1 - first)).astype(np.int32)
        column = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(whole.translate(None, b" \n"))]).dictionary_encode()
        places = self._places(column.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids, before = self.known.take(places[column.indices.to_numpy()])
        starts = np.cumsum([1, *(len(t) + 1 for t in texts)])
        bounds = before[np.searchsorted(first, starts)].tolist()
        return [ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """Ids of UTF-8 texts as little-endian unsigned 32-bit integers, the end id not included."""
        if not self.by_piece:
            return [np.array(ids, "<u4").tobytes() for ids in self._one_by_one([(t or b"").decode() for t in texts])]
        out: list[list[bytes]] = [[] for _ in texts]
        waiting: dict[bytes, list[tuple[int, bytes]]] = {AFTER_WORD: [], AFTER_SPACE: []}
        sizes = dict.fromkeys(waiting, 0)

        def flush(form: bytes) -> None:
            numbers, parts = zip(*waiting[form], strict=True)
            for number, ids in zip(numbers, self._chunk(list(parts), form), strict=True):
                out[number].append(ids)
            waiting[form], sizes[form] = [], 0

        for number, text in enumerate(texts):
            if not text:
                continue
            form = AFTER_SPACE if any(x in text for x in self.careful) else AFTER_WORD
            at = 0
            while at < len(text):
                # A long text goes in parts that end at spaces.
                end = text.find(b" ", at + self.CHUNK) if len(text) - at > self.CHUNK else -1
                part = text[at : len(text) if end < 0 else end]
                at += len(part)
                waiting[form].append((number, part if form is AFTER_SPACE else part.lower()))
                sizes[form] += len(part)
                if sizes[form] >= self.CHUNK:
                    flush(form)
        for form, rest in waiting.items():
            if rest:
                flush(form)
        return [b"".join(x) for x in out]


_encoders: dict[str, Encoder] = {}


def encoder(name: str) -> Encoder:
    if name not in _encoders:
        _encoders[name] = Encoder(name)
    return _encoders[name]


def frames_of(ids: bytes, packer: zstandard.ZstdCompressor | None = None) -> list[tuple[bytes, int, int]]:
    """(compressed frame, length before compression, low 32 bits of its XXH64) of a document's ids."""
    packer = packer or zstandard.ZstdCompressor(level=LEVEL)
    parts = [ids[i : i + 4 * FRAME_IDS] for i in range(0, len(ids), 4 * FRAME_IDS)]
    return [(packer.compress(p), len(p), xxhash.xxh64_intdigest(p) & 0xFFFFFFFF) for p in parts]


class SeekableWriter:
    def __init__(self, out):
        self.out, self.table, self.docs = out, [], []

    def add(self, doc_id: int | None, frames: list[tuple[bytes, int, int]]) -> None:
        self.docs.append((doc_id, len(frames)))
        for frame, size, check in frames:
            self.out.write(frame)
            self.table.append((len(frame), size, check))

    def close(self) -> None:
        body = b"".join(struct.pack("<BqI", d is not None, d or 0, n) for d, n in self.docs)
        self.out.write(struct.pack("<II", LIST_MAGIC, len(body)) + body)
        entries = [*self.table, (8 + len(body), 0, 0)]
        rows = b"".join(struct.pack("<III", *e) for e in entries)
        self.out.write(struct.pack("<II", TABLE_MAGIC, len(rows) + 9) + rows + struct.pack("<IBI", len(entries), WITH_CHECKSUMS, FOOTER_MAGIC))


class SeekableReader:
    """Reads the seek table and the list of documents; a document's frames only when asked."""

    def __init__(self, file, size: int):
        self.file, self.unpacker = file, zstandard.ZstdDecompressor()
        file.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", file.read(9))
        if magic != FOOTER_MAGIC or not flags & WITH_CHECKSUMS:
            raise ValueError("no seek table with checksums at the end")
        file.seek(size - 17 - 12 * n)
        if struct.unpack("<II", file.read(8)) != (TABLE_MAGIC, 12 * n + 9):
            raise ValueError("the seek table's frame is damaged")
        self.table = np.frombuffer(file.read(12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.offsets = np.concatenate(([0], np.cumsum(self.table[:, 0])))
        file.seek(int(self.offsets[-2]))
        magic, length = struct.unpack("<II", file.read(8))
        if magic != LIST_MAGIC:
            raise ValueError("the list of documents is missing")
        rows = struct.iter_unpack("<BqI", file.read(length))
        self.docs = [(d if known else None, frames) for known, d, frames in rows]
        self.first = np.concatenate(([0], np.cumsum([f for _, f in self.docs]))).astype(np.int64)

    def ids(self, number: int) -> np.ndarray:
        """The ids of the file's document at this place."""
        parts = []
        for frame in range(self.first[number], self.first[number + 1]):
            self.file.seek(int(self.offsets[frame]))
            part = self.unpacker.decompress(self.file.read(int(self.table[frame, 0])), max_output_size=int(self.table[frame, 1]))
            if len(part) != self.table[frame, 1] or xxhash.xxh64_intdigest(part) & 0xFFFFFFFF != self.table[frame, 2]:
                raise ValueError(f"frame {frame} does not match its checksum")
            parts.append(part)
        return np.frombuffer(b"".join(parts), "<u4")


def write(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER, end_id: int = END_ID, file_docs: int = FILE_DOCS) -> DataFrame:
    """Write the token files; their manifest ``part, file, n_docs, n_tokens, start``, ``start`` being the ids in all files before."""
    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.select(long_id(docs, doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    n_docs = rows.count()
    n_files = max(1, -(-n_docs // file_docs), min(int(spark.conf.get("spark.sql.shuffle.partitions")), n_docs // 1000))
    # Bounds of the files' ranges, from the ids alone: nothing is tokenized for them.
    cuts = rows.agg(F.percentile_approx("doc_id", F.array(*[F.lit(i / n_files) for i in range(1, n_files)]), 10 * n_files + 1000)).first()[0] if n_files > 1 else []
    cuts = sorted(set(cuts or []))
    bounds = np.array(cuts, np.int64)

    def tokenize(batch: pa.RecordBatch) -> dict:
        tail = struct.pack("<I", end_id)
        found = [ids + tail for ids in encoder(tokenizer).encode(utf8(batch.column("text")))]
        packer = zstandard.ZstdCompressor(level=LEVEL)
        frames = [frames_of(ids, packer) for ids in found]
        doc_ids = batch.column("doc_id")
        parts = np.searchsorted(bounds, doc_ids.fill_null(0).to_numpy())
        return {
            "doc_id": doc_ids,
            "part": pa.array(np.where(doc_ids.is_valid().to_numpy(zero_copy_only=False), parts, 0), pa.int32()),
            "crc": pa.array([zlib.crc32(ids) for ids in found], pa.int64()),
            "n": pa.array([len(ids) // 4 for ids in found], pa.int64()),
            "frames": pa.array([[f[0] for f in x] for x in frames], pa.list_(pa.binary())),
            "sizes": pa.array([[f[1] for f in x] for x in frames], pa.list_(pa.int64())),
            "checks": pa.array([[f[2] for f in x] for x in frames], pa.list_(pa.int64())),
        }

    framed = map_rows(rows, tokenize, "doc_id long, part int, crc long, n long, frames array<binary>, sizes array<long>, checks array<long>")
    dealt = framed.repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions(F.asc_nulls_first("doc_id"), "crc", "n")

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("part", "doc_id", "n", "frames", "sizes", "checks")), strict=True))
        head = next(rows, None)
        if head is None:
            return
        uri, n, tokens = f"{folder}/{head[0]:06d}.ids.zst", 0, 0
        with Writer(uri) as out:
            seekable = SeekableWriter(out)
            for _, doc, size, *frames in chain((head,), rows):
                seekable.add(doc, list(zip(*frames, strict=True)))
                n, tokens = n + 1, tokens + size
            seekable.close()
        yield pa.RecordBatch.from_pydict({"part": pa.array([head[0]], pa.int32()), "file": [uri], "n_docs": [n], "n_tokens": [tokens]})

    manifest = cut(dealt.mapInArrow(store, "part int, file string, n_docs long, n_tokens long"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read(manifest: DataFrame) -> DataFrame:
    """Every document of the files: ``doc_id, start, n_tokens, ids_crc32``, each frame checked against its checksum."""

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file, size = reader(row["file"])
                with file:
                    source, at = SeekableReader(file, size), row["start"]
                    for first in range(0, len(source.docs), 1024):
                        numbers = range(first, min(first + 1024, len(source.docs)))
                        starts, sizes, checks = [], [], []
                        for number in numbers:
                            ids = source.ids(number)
                            starts.append(at)
                            sizes.append(len(ids))
                            checks.append(zlib.crc32(ids.tobytes()))
                            at += len(ids)
                        yield pa.RecordBatch.from_pydict({"doc_id": pa.array([source.docs[i][0] for i in numbers], pa.int64()), "start": pa.array(starts, pa.int64()), "n_tokens": pa.array(sizes, pa.int64()), "ids_crc32": pa.array(checks, pa.int64())})

    n = max(1, manifest.count())
    return manifest.select("file", "start").repartition(n, "file").mapInArrow(load, "doc_id long, start long, n_tokens long, ids_crc32 long")


def report(docs: DataFrame, **options) -> DataFrame:
    """Write the files to the shared folder, read them back and remove them."""
    folder = shared_folder(docs.sparkSession, "tokens")
    found = cut(read(write(docs, folder, **options)))
    remove_folder(folder)
    return found

"""A store of gzipped pages, ``{kind}/{first four of key}/{key}.html.gz``, read and written by Spark."""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_pages(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """``key, page`` of every page of a kind."""

    def unzip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [gzip.decompress(c).decode("utf-8", "replace") for c in batch.column("content").to_pylist()]
            yield pa.RecordBatch.from_pydict({"key": batch.column("key"), "page": pa.array(texts, pa.string())})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.html.gz").option("recursiveFileLookup", "true").load(f"{root}/{kind}")
    named = files.select(F.regexp_extract("path", r"/([^/]+)\.html\.gz$", 1).alias("key"), "content")
    return named.mapInArrow(unzip, "key string, page string")


def keys(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """The stored keys in order; the pages are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.html.gz").option("recursiveFileLookup", "true").load(f"{root}/{kind}")
    return files.select(F.regexp_extract("path", r"/([^/]+)\.html\.gz$", 1).alias("key")).orderBy("key")


def put_pages(pages: DataFrame, root: str, kind: str) -> DataFrame:
    """Write ``key, page``; ``key, uri`` of what was written. A page appears whole or not at all, also where two attempts write it."""
    from pyarrow import fs

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uris = []
            for key, page in zip(batch.column("key").to_pylist(), batch.column("page").to_pylist(), strict=True):
                uri = f"{root}/{kind}/{key[:4]}/{key}.html.gz"
                place, path = fs.FileSystem.from_uri(uri)
                place.create_dir(path.rpartition("/")[0], recursive=True)
                part = f"{path}.{uuid.uuid4().hex}.part"
                with place.open_output_stream(part, compression=None) as out:
                    out.write(gzip.compress((page or "").encode(), mtime=0))
                place.move(part, path)
                uris.append(uri)
            yield pa.RecordBatch.from_pydict({"key": batch.column("key"), "uri": pa.array(uris, pa.string())})

    return pages.select("key", "page").mapInArrow(store, "key string, uri string")

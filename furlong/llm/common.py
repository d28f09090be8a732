"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows and bytes of one Arrow batch; a row beyond the bytes is a batch of its own.
BATCH_ROWS = 4_096
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that Python workers get, by rows and by bytes.

    A frame takes the bounds that hold when it runs, not when it is made, so all
    operators set the same ones and none changes them.
    """
    for key, value in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        spark.conf.set(f"spark.sql.execution.arrow.{key}", str(value))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def long_id(df: DataFrame, column: str) -> Column:
    """An id column as a long; an id of another kind than a whole number is refused, for a cast would merge or lose ids."""
    kind = df.schema[column].dataType
    if not isinstance(kind, (T.IntegralType, T.NullType)):
        raise TypeError(f"{column} must hold whole numbers, not {kind.simpleString()}")
    return F.col(column).cast("long")


def utf8(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column's values."""
    return column.cast(pa.large_binary()).to_pylist()


def map_rows(df: DataFrame, make: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """One output batch for each input batch; ``make`` returns columns by name, in the order of ``schema``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict(make(batch))

    return df.mapInArrow(run, schema)


def keep_rows(df: DataFrame, keep: Callable[[pa.RecordBatch], list[bool]]) -> DataFrame:
    """The rows of ``df`` for which ``keep`` says so, all columns as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(keep(batch), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def crc_mod(column: str, divisor: int) -> Column:
    """CRC-32 of the column as text, modulo ``divisor``; null stays null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(divisor)

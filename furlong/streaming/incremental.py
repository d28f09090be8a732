"""Resumable and late-arriving data.

The stream form reads new files, keeps the last row of each key among them and
merges it into a keyed table in each micro-batch; with ``availableNow`` it is the
resumable batch: what the checkpoint has seen is not read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from furlong.operators.latest import latest_by
from furlong.session import shared_folder


def update_range(days: DataFrame, column: str, today: str, back: int = 7, longest: int = 60, skip: int = 2) -> DataFrame:
    """The days to read again: from ``back`` days before the latest stored one, at most ``longest`` days ago, up to ``skip`` days ago; one row ``first_day, last_day``."""
    now = F.lit(today).cast("date")
    latest = F.max(F.col(column).cast("date"))
    first = F.greatest(F.date_sub(latest, back), F.date_sub(now, longest))
    return days.agg(F.coalesce(first, F.date_sub(now, longest)).alias("first_day"), F.date_sub(now, skip).alias("last_day"))


def day_complete(listed: Column, saved: Column, unavailable: Column, day: Column, today: Column, grace: int = 3) -> Column:
    """All saved, or the day is old and what is not saved is known to be unavailable."""
    return (saved >= listed) | ((F.datediff(today, day) >= grace) & (saved + unavailable >= listed))


def pending(wanted: DataFrame, done: DataFrame, keys: Sequence[str], budget: int | None = None) -> DataFrame:
    """What a resumed run has left, in key order; no more than ``budget`` of it."""
    rows = wanted.join(done.select(*keys), list(keys), "left_anti").orderBy(*keys)
    return rows if budget is None else rows.limit(budget)


def late_counts(stream: DataFrame, time: str, keys: Sequence[str], late: str = "7 days", window: str = "1 day") -> DataFrame:
    """Windowed counts of a stream that takes rows up to ``late`` behind."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window), *keys).agg(F.count("*").alias("n"))


def latest_snapshot_by_stream(spark: SparkSession, path: str, keys: Sequence[str], order: str, tie: str, target: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """The last row of each key of all files of ``path``, kept as a table that each micro-batch rewrites.

    A batch merges into the version of the batch before it and writes its own, so
    one that runs again after a failure, or in a later call with the same
    checkpoint, neither loses nor doubles rows.
    """
    base = target or shared_folder(spark, "snapshot")
    schema = spark.read.parquet(path).schema
    # A single file is streamed through the folder that holds it.
    folder, _, name = path.rpartition("/")
    listed = spark.read.format("binaryFile").load(path).select("path").limit(2).collect() if not path.endswith("/") else []
    single = len(listed) == 1 and listed[0]["path"].rstrip("/").endswith(name)
    reader = spark.readStream.schema(schema)
    stream = reader.option("pathGlobFilter", name).parquet(folder) if single else reader.parquet(path)

    def merge(batch: DataFrame, number: int) -> None:
        rows = batch if number == 0 else batch.unionByName(batch.sparkSession.read.parquet(f"{base}/{number - 1:09d}"))
        latest_by(rows, keys, [F.desc(order), F.asc(tie)]).write.mode("overwrite").parquet(f"{base}/{number:09d}")

    run = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint or f"{base}-state").trigger(availableNow=True).start()
    run.awaitTermination()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    try:
        last = files.load(base).agg(F.max(F.regexp_extract("path", "/([0-9]{9})/[^/]*$", 1))).first()[0]
    except AnalysisException:  # no batch has run: there was no input
        last = None
    return spark.read.parquet(f"{base}/{last}") if last else spark.createDataFrame([], schema)

"""JSON sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fields(rows: DataFrame, column: str, schema: str, keep: list[str]) -> DataFrame:
    """``keep`` and the fields of a JSON text; null where the text is none."""
    return rows.select(*keep, F.from_json(column, schema).alias("_j")).select(*keep, "_j.*")


#: The shape of the course condition feed.
COURSE_SCHEMA = "kaisai_info array<struct<jyoname string, kaisai_ymd string, weather string, ba_s string, ba_d string>>"


def course_conditions(rows: DataFrame, column: str = "text", key: str | None = None) -> DataFrame:
    """A row for each venue: ``race_date, venue_name, weather, going_turf, going_dirt``.

    Entries whose date is not of eight characters, or without a venue, are left
    out; blank values are null.
    """
    keep = [key] if key else []
    entries = rows.select(*keep, F.explode(F.from_json(column, COURSE_SCHEMA)["kaisai_info"]).alias("e")).select(*keep, "e.*")
    tidy = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    good = entries.where((F.length("kaisai_ymd") == 8) & tidy("jyoname").isNotNull())
    date = F.concat_ws("-", F.substring("kaisai_ymd", 1, 4), F.substring("kaisai_ymd", 5, 2), F.substring("kaisai_ymd", 7, 2))
    return good.select(*keep, date.alias("race_date"), tidy("jyoname").alias("venue_name"), tidy("weather").alias("weather"), tidy("ba_s").alias("going_turf"), tidy("ba_d").alias("going_dirt"))

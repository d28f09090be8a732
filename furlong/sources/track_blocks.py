"""Archived track conditions: rows of tables, and text blocks of the older layout.

Text is taken out of the documents elsewhere; these functions read what it says.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from furlong.functions import scalars

SCHEMA = "venue_code string, date string, day int, is_pre_meeting_day boolean, cushion_value double, turf_moisture_goal double, turf_moisture_4corner double, dirt_moisture_goal double, dirt_moisture_4corner double"
HEADER = re.compile(r"(第[0-9０-９]+日.*?)(\d{4})年(\d{1,2})月(\d{1,2})日")


def table_rows(rows: DataFrame, year: str = "year") -> DataFrame:
    """Rows of eleven cells (``cells``, in the order of ``line_no`` for each ``file``) with their dates.

    A date has no year: it is the file's, and one more after each month that is
    less than the one before it.
    """
    text = F.get("cells", F.lit(1))
    pattern = "([0-9]{1,2})月\\s*([0-9]{1,2})日"
    good = rows.where((F.size("cells") >= 11) & text.rlike(pattern)).withColumn("month", F.regexp_extract(text, pattern, 1).cast("int")).withColumn("dom", F.regexp_extract(text, pattern, 2).cast("int"))
    order = Window.partitionBy("file").orderBy("line_no")
    good = good.withColumn("rolled", F.when(F.col("month") < F.lag("month").over(order), 1).otherwise(0))
    rolled = F.sum("rolled").over(order)
    iso = F.concat_ws("-", (F.col(year) + rolled).cast("string"), F.lpad(F.col("month").cast("string"), 2, "0"), F.lpad(F.col("dom").cast("string"), 2, "0"))
    label = F.nullif(F.trim(F.get("cells", F.lit(0))), F.lit(""))
    value = lambda i: scalars.to_float(F.get("cells", F.lit(i)))
    day = F.regexp_extract(scalars.ascii_digits(label), "第([0-9]+)日", 1).try_cast("int")
    return good.select("file", "line_no", iso.alias("date"), day.alias("day"), label.isNull().alias("is_pre_meeting_day"), F.nullif(F.trim(F.get("cells", F.lit(3))), F.lit("")).alias("course_setting"), value(5).alias("cushion_value"), value(7).alias("turf_moisture_goal"), value(8).alias("turf_moisture_4corner"), value(9).alias("dirt_moisture_goal"), value(10).alias("dirt_moisture_4corner"))


def blocks_of(venue: str | None, text: str) -> Iterator[dict]:
    """Records of the blocks of eight lines: labels and first date, weekdays, cushion, place, four lines of moisture.

    If there is one label less than days, the first day is the one before the meeting.
    """
    lines, i = [x.strip() for x in text.splitlines() if x.strip()], 0
    while i + 7 < len(lines):
        head = HEADER.search(lines[i])
        if not head:
            i += 1
            continue
        start, n = date(int(head[2]), int(head[3]), int(head[4])), len(lines[i + 1].split())
        labels = [int(x) for x in re.findall(r"第([0-9０-９]+)日", head[1])]
        ahead = len(labels) == n - 1
        days = [None, *labels] if ahead else labels if len(labels) == n else [None] * n
        series = [re.findall(r"\d+(?:\.\d+)?", lines[i + k]) for k in (2, 4, 5, 6, 7)]
        for k in range(n):
            values = [float(s[k]) if k < len(s) else None for s in series]
            yield {"venue_code": venue, "date": (start + timedelta(days=k)).isoformat(), "day": days[k], "is_pre_meeting_day": ahead and k == 0, "cushion_value": values[0], "turf_moisture_goal": values[1], "turf_moisture_4corner": values[2], "dirt_moisture_goal": values[3], "dirt_moisture_4corner": values[4]}
        i += 8


def text_blocks(texts: DataFrame) -> DataFrame:
    """Records of ``venue_code, text`` pages of the older layout."""
    kinds = pa.schema([("venue_code", pa.string()), ("date", pa.string()), ("day", pa.int32()), ("is_pre_meeting_day", pa.bool_()), *[(n, pa.float64()) for n in ("cushion_value", "turf_moisture_goal", "turf_moisture_4corner", "dirt_moisture_goal", "dirt_moisture_4corner")]])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [r for venue, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for r in blocks_of(venue, text or "")]
            if found:
                yield pa.RecordBatch.from_pylist(found, schema=kinds)

    return texts.select("venue_code", "text").mapInArrow(read, SCHEMA)

"""HTML pages as rows.

Flat facts (links, titles, dates, ids, tokens) come from patterns, inside the JVM.
Tables need a parser: each page's cells become rows ``table_no, row_no, cell_no``
in one Arrow pass, and everything after that is DataFrame work on the cells.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def title(column: Column) -> Column:
    return F.nullif(F.regexp_extract(column, "<title>([^<]*)</title>", 1), F.lit(""))


def links(pages: DataFrame, key: str, column: str) -> DataFrame:
    """``key, n, link``: the targets of all links in order, from 1."""
    found = F.regexp_extract_all(column, F.lit('href="([^"]*)"'), 1)
    return pages.select(key, F.posexplode(found).alias("p", "link")).select(key, (F.col("p") + 1).alias("n"), "link")


def distinct_matches(column: Column, pattern: str, group: int = 1) -> Column:
    """The distinct matches in a page, sorted: dates of a calendar, ids of a list."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(column, F.lit(pattern), group)))


def calendar_dates(column: Column) -> Column:
    """Dates in links such as ...=20260920, as ISO texts."""
    return F.transform(distinct_matches(column, "kaisai_date=([0-9]{8})"), lambda d: F.concat_ws("-", F.substring(d, 1, 4), F.substring(d, 5, 2), F.substring(d, 7, 2)))


def race_ids(column: Column) -> Column:
    """Valid twelve-digit ids in links."""
    return F.filter(distinct_matches(column, "race_id=([0-9]{12})"), lambda x: F.substring(x, 5, 2).between("01", "10"))


def tokens(column: Column, marker: str) -> Column:
    """Tokens of script calls that begin with ``marker``, in order, once each."""
    return F.array_distinct(F.regexp_extract_all(column, F.lit(rf"doAction\('[^']*',\s*'({marker}[^']*)'\)"), 1))


def first_token(column: Column, marker: str) -> Column:
    return F.get(tokens(column, marker), F.lit(0))


#: Elements that never have an end.
VOID = frozenset({"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"})


class _Cells(HTMLParser):
    """Collects cells; a cell's text has \n for each <br>."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[dict] = []
        self.stack: list[list[int]] = []  # table number, row, cell of each open table
        self.cell: list[dict | None] = []
        self.tables = 0
        self.skip = 0

    def handle_starttag(self, tag, attrs):
        attributes = dict(attrs)
        if tag in ("script", "style"):
            self.skip += 1
        elif tag == "table":
            self.stack.append([self.tables, -1, -1])
            self.cell.append(None)
            self.tables += 1
        elif tag == "tr" and self.stack:
            self.stack[-1][1:] = [self.stack[-1][1] + 1, -1]
            self.cell[-1] = None
        elif tag in ("td", "th") and self.stack:
            if self.stack[-1][1] < 0:
                self.stack[-1][1] = 0
            self.stack[-1][2] += 1
            span = lambda n: int(v) if (v := attributes.get(n) or "").isdigit() else 1
            table, row, cell = self.stack[-1]
            self.cell[-1] = {"table_no": table, "row_no": row, "cell_no": cell, "tag": tag, "class": attributes.get("class"), "rowspan": span("rowspan"), "colspan": span("colspan"), "parts": [], "links": [], "images": []}
            self.rows.append(self.cell[-1])
        elif self.cell and self.cell[-1] is not None:
            own = self.cell[-1]
            if tag == "br":
                own["parts"].append("\n")
            elif tag == "a" and (attributes.get("href") or attributes.get("onclick")):
                own["links"].append(attributes.get("href") or attributes.get("onclick"))
            elif tag == "img":
                own["images"].append(attributes.get("alt") or attributes.get("src") or "")

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)
        elif tag == "table" and self.stack:
            self.stack.pop()
            self.cell.pop()
        elif tag in ("td", "th", "tr") and self.cell:
            self.cell[-1] = None

    def handle_data(self, data):
        if not self.skip and self.cell and self.cell[-1] is not None:
            self.cell[-1]["parts"].append(data)


CELL_FIELDS = "table_no int, row_no int, cell_no int, tag string, class string, rowspan int, colspan int, text string, links array<string>, images array<string>"


def cells_of(page: str | None) -> list[dict]:
    if not page:
        return []
    parser = _Cells()
    parser.feed(page)
    parser.close()
    for row in parser.rows:
        text = "".join(row.pop("parts")).replace("\xa0", " ")
        row["text"] = "\n".join(" ".join(line.split()) for line in text.split("\n")).strip()
    return parser.rows


def table_cells(pages: DataFrame, key: str, column: str) -> DataFrame:
    """A row for each table cell of each page: ``key``, its place, tag, class, spans, text, link targets and image texts."""
    kinds = {"table_no": pa.int32(), "row_no": pa.int32(), "cell_no": pa.int32(), "tag": pa.string(), "class": pa.string(), "rowspan": pa.int32(), "colspan": pa.int32(), "text": pa.string(), "links": pa.list_(pa.string()), "images": pa.list_(pa.string())}

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows = [], []
            for i, page in enumerate(batch.column(1).to_pylist()):
                found = cells_of(page)
                keys += [i] * len(found)
                rows += found
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keys, pa.int32())), *(pa.array([r[n] for r in rows], k) for n, k in kinds.items())], names=[key, *kinds])

    source = pages.select(key, column)
    return source.mapInArrow(parse, f"{key} {source.schema[0].dataType.simpleString()}, {CELL_FIELDS}")


class _Blocks(HTMLParser):
    """Texts of block elements in document order; a nested block is a block of its own."""

    TAGS = frozenset({"p", "li", "h1", "h2", "h3", "h4", "td", "th", "dt", "dd", "title"})

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[str, list[str]]] = []
        self.open: list[tuple[str, list[str]]] = []
        self.skip = 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.skip += 1
        elif tag in self.TAGS:
            self.open.append((tag, []))
            self.rows.append(self.open[-1])
        elif tag == "br" and self.open:
            self.open[-1][1].append(" ")

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)
        elif any(t == tag for t, _ in self.open):
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        if not self.skip and self.open:
            self.open[-1][1].append(data)


def blocks_of(page: str | None) -> list[tuple[str, str]]:
    if not page:
        return []
    parser = _Blocks()
    parser.feed(page)
    parser.close()
    return [(tag, " ".join("".join(parts).split())) for tag, parts in parser.rows]


def blocks(pages: DataFrame, key: str, column: str) -> DataFrame:
    """``key, n, tag, text``: the text blocks of each page in order."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, n, *block) for i, page in enumerate(batch.column(1).to_pylist()) for n, block in enumerate(blocks_of(page))]
            if rows:
                at, n, tag, text = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int32())), pa.array(n, pa.int32()), pa.array(tag), pa.array(text)], names=[key, "n", "tag", "text"])

    source = pages.select(key, column)
    return source.mapInArrow(parse, f"{key} {source.schema[0].dataType.simpleString()}, n int, tag string, text string")


def named_rows(cells: DataFrame, key: str, required: list[str], optional: list[str] = ()) -> DataFrame:
    """Rows of the tables whose first row has all ``required`` headers: ``key, table_no, row_no`` and a column for each header.

    Of headers that repeat, the first counts; an optional one that is missing is null.
    """
    heads = cells.where("row_no = 0").groupBy(key, "table_no", F.regexp_replace("text", r"(?U)\s+", "").alias("head")).agg(F.min("cell_no").alias("cell_no"))
    wanted = [*required, *optional]
    heads = heads.where(F.col("head").isin(*wanted))
    full = heads.where(F.col("head").isin(*required)).groupBy(key, "table_no").agg(F.count("*").alias("n")).where(F.col("n") == len(required)).drop("n")
    body = cells.where("row_no > 0").join(heads.join(full, [key, "table_no"]), [key, "table_no", "cell_no"])
    return body.groupBy(key, "table_no", "row_no").pivot("head", wanted).agg(F.first("text"))


def missing_headers(cells: DataFrame, key: str, required: list[str]) -> DataFrame:
    """``key, header``: the required headers that no table of a page has."""
    pages = cells.select(key).distinct()
    wanted = pages.select(key, F.explode(F.array(*map(F.lit, required))).alias("header"))
    heads = cells.where("row_no = 0").select(key, F.regexp_replace("text", r"(?U)\s+", "").alias("header")).distinct()
    return wanted.join(heads, [key, "header"], "left_anti")

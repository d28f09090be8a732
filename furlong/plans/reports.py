"""Look-ups and lists over the core tables: links of official pages, recent rows, leading entities and their years."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furlong.functions.scalars import normalize_space
from furlong.operators.latest import outer_merge

#: Bet types on the page that the digit in an odds token names.
BETS_OF_DIGIT = {"1": ("tansho", "fukusho"), "3": ("wakuren",), "4": ("umaren",), "5": ("wide",), "6": ("umatan",), "7": ("sanrenpuku",), "8": ("sanrentan",)}
PLACE = ("venue_code", "meeting", "day", "date")


# links: over ``page, n, token, label, venue_code, meeting, day, race_no, date, race_id``, as the reader of tokens finds them


def meetings(tokens: DataFrame, page: str = "page") -> DataFrame:
    """The meetings of index pages, each token once, at its first place."""
    first = F.min_by(F.struct("n", "label", *PLACE), "n")
    return tokens.where("venue_code is not null").groupBy(page, "token").agg(first.alias("x")).select(page, "x.n", "token", "x.label", *[f"x.{c}" for c in PLACE])


def pages_without_meetings(pages: DataFrame, tokens: DataFrame, page: str = "page") -> DataFrame:
    """Index pages that should be an error: no meeting was read."""
    return pages.select(page).distinct().join(tokens.where("venue_code is not null").select(page), page, "left_anti")


def first_meeting_token(tokens: DataFrame, page: str = "page") -> DataFrame:
    """``page, token``: the first token with a place, such as that of the list of all results in a race menu."""
    return tokens.where("venue_code is not null").groupBy(page).agg(F.min_by("token", "n").alias("token"))


def race_links(tokens: DataFrame, of: DataFrame, page: str = "page") -> DataFrame:
    """``page, race_id, token`` of the races of the meeting that ``of`` (page and place) names for each page; links of other meetings are dropped."""
    own = tokens.where("race_id is not null").join(of.select(page, *PLACE).distinct(), [page, *PLACE], "left_semi")
    return own.groupBy(page, "race_id").agg(F.max_by("token", "n").alias("token"))


def odds_links(tokens: DataFrame) -> DataFrame:
    """``race_id, links``: a map from bet type to token; the digit of a token's page says which types it shows."""
    bets = F.create_map(*[x for d, names in BETS_OF_DIGIT.items() for x in (F.lit(d), F.array(*map(F.lit, names)))])
    rows = tokens.where("race_id is not null").select("race_id", "token", "n", F.explode(bets[F.regexp_extract("token", "^pw15([0-9])", 1)]).alias("bet"))
    last = rows.groupBy("race_id", "bet").agg(F.max_by("token", "n").alias("token"))
    return last.groupBy("race_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("bet", "token")))).alias("links"))


def trainer_links(tokens: DataFrame) -> DataFrame:
    """``code, token, name``: the first link of each trainer in a directory's lists; the stable before a name goes."""
    code = F.regexp_extract("token", "pw05cmk0([0-9]{5})/", 1)
    name = normalize_space(F.regexp_replace("label", r"^(美浦|栗東)\s*", ""))
    rows = tokens.withColumns({"code": code, "name": name}).where("code <> ''")
    return rows.groupBy("code").agg(F.min_by(F.struct("token", "name"), F.struct("page", "n")).alias("x")).select("code", "x.token", "x.name")


def archive_links(links: DataFrame, base: str, page: str = "page_id") -> DataFrame:
    """``page, n, url`` of the documents that pages link to (``page, n, link``), each once at its first place, relative ones below ``base``."""
    url = F.when(F.col("link").startswith("http"), F.col("link")).otherwise(F.concat(F.lit(base), "link"))
    return links.where(F.col("link").endswith(".pdf")).groupBy(page, url.alias("url")).agg(F.min("n").alias("n"))


def not_at_hand(links: DataFrame, files: DataFrame) -> DataFrame:
    """The links whose file name is not among ``files`` (``name``)."""
    return links.join(files, F.regexp_extract(links["url"], "([^/]+)$", 1) == files["name"], "left_anti")


# recent rows


def recent(base: DataFrame, key: str, runs: DataFrame, day: str, since: str, expected: DataFrame) -> DataFrame:
    """Rows of ``base`` that ran from ``since`` on, or are expected to run; the rows, not the runs, count."""
    seen = runs.where(F.col(day) >= since).select(key).unionByName(expected.select(key))
    return base.join(seen.distinct(), key, "left_semi")


def recent_lacking(base: DataFrame, key: str, runs: DataFrame, day: str, since: str, expected: DataFrame, having: DataFrame, limit: int | None = None) -> DataFrame:
    """Recent rows without any row in ``having``, the greatest keys first."""
    rows = recent(base, key, runs, day, since, expected).join(having.select(key), key, "left_anti").orderBy(F.desc(key))
    return rows if limit is None else rows.limit(limit)


def recent_counts(base: DataFrame, key: str, runs: DataFrame, day: str, since: str, expected: DataFrame, filled: Mapping[str, Column], having: Mapping[str, DataFrame]) -> DataFrame:
    """One row: ``total`` recent rows, how many meet each condition, and how many have a row in each table."""
    rows = recent(base, key, runs, day, since, expected)
    for name, other in having.items():
        rows = rows.join(other.select(key).distinct().withColumn(f"_{name}", F.lit(True)), key, "left")
    return rows.agg(F.count("*").alias("total"), *[F.count_if(c).alias(n) for n, c in filled.items()], *[F.count(f"_{n}").alias(n) for n in having])


# leading entities


def recent_years(lead: DataFrame, n: int, kind: str | None = None) -> DataFrame:
    """The latest ``n`` years, in ascending order."""
    rows = lead if kind is None else lead.where(F.col("kind") == kind)
    return rows.select("year").distinct().orderBy(F.desc("year")).limit(n).orderBy("year")


def leading_list(lead: DataFrame, years: DataFrame, local: DataFrame, name: str = "name") -> DataFrame:
    """Entities of the leading tables and of our own: the latest years first, then the most units, the most local rows, the name; what is missing counts 0."""
    own = lead.join(F.broadcast(years), "year", "left_semi").groupBy(name).agg(F.max("year").alias("latest_year"), F.sum("n_units").alias("n_units"), F.lit(True).alias("in_leading"))
    ours = local.where(F.coalesce(F.col(name), F.lit("")) != "").groupBy(name).agg(F.count("*").alias("local_rows"))
    both = outer_merge(own, ours, [name]).withColumns({"in_leading": F.coalesce("in_leading", F.lit(False)), "n_units": F.coalesce("n_units", F.lit(0))})
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).desc()
    return both.orderBy(zero("latest_year"), zero("n_units"), zero("local_rows"), name)


def entity_years(lead: DataFrame, entity: str, years: DataFrame, name: str = "name") -> DataFrame:
    """An entity's rows of the years, in ascending order."""
    return lead.where(F.col(name) == entity).join(F.broadcast(years), "year", "left_semi").orderBy("year")


def nested(rows: DataFrame, keys: Sequence[str], name: str, value: str, out: str = "values") -> DataFrame:
    """One row for each key with a map from ``name`` to ``value``."""
    return rows.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(name, value)))).alias(out))

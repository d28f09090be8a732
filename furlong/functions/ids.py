"""Identifiers: race ids, 18-digit run keys, registration numbers, lineage paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Codes of the venues with valid ids.
VENUES = ("01", "02", "03", "04", "05", "06", "07", "08", "09", "10")


def is_race_id(column: Column) -> Column:
    """Twelve ASCII digits with a known venue."""
    return column.rlike("^[0-9]{12}$") & F.substring(column, 5, 2).isin(*VENUES)


def decode_race_id(column: Column) -> Column:
    """Struct ``year, venue_code, meeting, day, race_no``; null for an invalid id."""
    part = lambda at, n: F.substring(column, at, n).cast("int")
    fields = F.struct(part(1, 4).alias("year"), F.substring(column, 5, 2).alias("venue_code"), part(7, 2).alias("meeting"), part(9, 2).alias("day"), part(11, 2).alias("race_no"))
    return F.when(is_race_id(column), fields)


def compose_race_id(year: Column, venue: Column, meeting: Column, day: Column, race_no: Column) -> Column:
    """The id of its parts; null if one is out of range."""
    valid = venue.isin(*VENUES) & race_no.between(1, 12) & meeting.between(1, 99) & day.between(1, 99)
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    return F.when(valid, F.concat(pad(year, 4), venue, pad(meeting, 2), pad(day, 2), pad(race_no, 2)))


def race_id_of_key18(key: Column) -> Column:
    """date(8) venue(2) meeting(2) day(2) race(2) number(2): year and the middle."""
    return F.when(key.rlike("^[0-9]{18}$"), F.concat(F.substring(key, 1, 4), F.substring(key, 9, 8)))


def number_of_key18(key: Column) -> Column:
    return F.when(key.rlike("^[0-9]{18}$"), F.substring(key, 17, 2).cast("int"))


def is_horse_id(column: Column) -> Column:
    return column.rlike("^[0-9]{10}$")


def is_domestic(breed_no: Column) -> Column:
    """A registration number with 2 as its third digit."""
    return F.substring(breed_no, 3, 1) == "2"


def birth_year(horse_id: Column) -> Column:
    return F.when(is_horse_id(horse_id), F.substring(horse_id, 1, 4).cast("int"))


def lineage_path(generation: Column, index: Column) -> Column:
    """Path of a cell in a lineage grid: the index in binary, 0 as f and 1 as m."""
    return F.translate(F.lpad(F.bin(index), generation, "0"), "01", "fm")


def hex_key(column: Column) -> Column:
    return F.lower(F.hex(F.encode(column, "UTF-8")))

"""Normalisers and guards of source values, all null-in null-out and JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def first_json(column: str, paths: list[str]) -> Column:
    """The first path of a JSON text that holds more than blanks."""
    return F.coalesce(*[blank_to_null(F.get_json_object(column, p)) for p in paths])


def year(c: Column) -> Column:
    """A four-digit year, else null."""
    return F.when(F.trim(c).rlike("^[0-9]{4}$"), F.trim(c).cast("int"))


def partial_date(c: Column) -> Column:
    """YYYY, YYYY-MM or YYYY-MM-DD with a possible month and day, kept as text."""
    return F.when(c.rlike("^[0-9]{4}(-(0[1-9]|1[0-2])(-(0[1-9]|[12][0-9]|3[01]))?)?$"), c)


def wikidata_date(time: Column, precision: Column) -> Column:
    """+YYYY-MM-DDT... with precision 9 (year), 10 (month), 11 (day) as a partial date; others give null."""
    size = F.when(precision == 9, 4).when(precision == 10, 7).when(precision == 11, 10)
    return F.when(time.startswith("+"), F.substring(time, F.lit(2), size))


def quantity(amount: Column) -> Column:
    """A signed decimal text without the plus."""
    return F.when(amount.rlike(r"^[+-]?[0-9]+(\.[0-9]+)?$"), F.regexp_replace(amount, r"^\+", ""))


def ordinal(c: Column) -> Column:
    """A positive whole number written plainly."""
    return F.when(F.trim(c).rlike("^[1-9][0-9]{0,8}$"), F.trim(c).cast("int"))


def imdb_id(c: Column) -> Column:
    return F.when(F.lower(F.trim(c)).rlike("^(tt|nm|co)[0-9]{7,}$"), F.lower(F.trim(c)))


def eidr_id(c: Column) -> Column:
    """Upper-case EIDR DOI without the doi: prefix."""
    plain = F.upper(F.regexp_replace(F.trim(c), "(?i)^(https?://(dx[.])?doi[.]org/|doi:)", ""))
    return F.when(plain.rlike("^10[.][0-9]{4}/([0-9A-F]{4}-){5}[0-9A-Z]$"), plain)


def isrc(c: Column) -> Column:
    plain = F.upper(F.regexp_replace(F.trim(c), "[- ]", ""))
    return F.when(plain.rlike("^[A-Z]{2}[A-Z0-9]{3}[0-9]{7}$"), plain)


def iswc(c: Column) -> Column:
    plain = F.upper(F.regexp_replace(F.trim(c), "[-. ]", ""))
    return F.when(plain.rlike("^T[0-9]{10}$"), plain)


def mbid(c: Column) -> Column:
    plain = F.lower(F.trim(c))
    return F.when(plain.rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"), plain)


def qid(c: Column) -> Column:
    return F.when(F.trim(c).rlike("^Q[1-9][0-9]*$"), F.trim(c))


def external_url(c: Column) -> Column:
    """Only http and https addresses with a host."""
    return F.when(F.trim(c).rlike(r"^https?://[^\s/?#]+([/?#]\S*)?$"), F.trim(c))


def slug(c: Column) -> Column:
    """Lower-case predicate name with underscores."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9]+", "_"), "^_|_$", "")


def duration(c: Column) -> Column:
    """An ISO duration, kept as text."""
    return F.when(c.rlike(r"^P(?=.)([0-9]+Y)?([0-9]+M)?([0-9]+D)?(T(?=.)([0-9]+H)?([0-9]+M)?([0-9]+([.][0-9]+)?S)?)?$"), c)


def language_order(c: Column, ranks: dict[str, int]) -> Column:
    pairs = [F.lit(x) for kv in ranks.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[c], F.lit(len(ranks)))


def ordered_map(c: Column) -> Column:
    """A map with its keys in order, so that its JSON is canonical."""
    return F.map_from_entries(F.array_sort(F.map_entries(c)))

"""Dates and numbers read from text, as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = "January February March April May June July August September October November December".split()
_MONTH = "(" + "|".join(f"{m[:3]}(?:{m[3:]})?" if len(m) > 3 else m for m in MONTHS) + r")\.?"


def _made(text: Column, pattern: str, day: int, month: int, year: int, words: bool) -> Column:
    d, m, y = (F.lpad(F.regexp_extract(text, pattern, k), n, "0") for k, n in ((day, 2), (month, 2), (year, 4)))
    if words:
        m = F.initcap(F.substring(F.regexp_extract(text, pattern, month), 1, 3))
    return F.when(text.rlike(pattern), F.try_to_date(F.concat_ws("-", y, m, d), "yyyy-MMM-dd" if words else "yyyy-MM-dd"))


def parse_date(text: Column) -> Column:
    """The first date in a text: month-day-year or day-month-year in words, or day first in numbers; of 1900 to 2099.
    Impossible dates are passed over for the next form."""
    return F.coalesce(
        _made(text, rf"(?i)\b{_MONTH}\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+((?:19|20)\d\d)\b", 2, 1, 3, True),
        _made(text, rf"(?i)\b(\d{{1,2}})(?:st|nd|rd|th)?\s+(?:day\s+of\s+)?{_MONTH},?\s+((?:19|20)\d\d)\b", 1, 2, 3, True),
        _made(text, r"\b(\d{1,2})[./-](\d{1,2})[./-]((?:19|20)\d\d)\b", 1, 2, 3, False),
    )


def iso_date(text: Column) -> Column:
    """Day-month-year turned to year-month-day; other text unchanged, null as empty."""
    return F.coalesce(F.regexp_replace(F.trim(text), r"^(\d{2})-(\d{2})-(\d{4})$", "$3-$2-$1"), F.lit(""))


def era(year: Column) -> Column:
    """Period of a year; null outside."""
    return F.when(year.between(1950, 1989), "1950-1989").when(year.between(1990, 2009), "1990-2009").when(year.between(2010, 2025), "2010-2025")


def pages_of(path: Column) -> Column:
    """Pages from the last two numbers of a path, at least one."""
    n = F.transform(F.regexp_extract_all(path, F.lit(r"\d+"), F.lit(0)), lambda x: x.cast("long"))
    return F.when(F.size(n) >= 2, F.greatest(F.lit(1), F.element_at(n, -1) - F.try_element_at(n, F.lit(-2)) + 1)).otherwise(1).cast("int")


def length_class(pages: Column) -> Column:
    return F.when(pages <= 8, "short").when(pages >= 40, "long").otherwise("medium")


def is_criminal(case_number: Column) -> Column:
    return F.coalesce(case_number.rlike(r"(?i)\bCRIMINAL\b|\bCRL\b"), F.lit(False))


#: The forms in which question sets write dates.
QUESTION_FORMS = ("d MMMM yyyy", "d MMMM, yyyy", "MMMM d, yyyy", "d-M-yyyy", "d.M.yyyy", "yyyy-M-d", "d/M/yyyy")


def question_date(text: Column) -> Column:
    """The day of a question set's date in the first form that fits, ordinal endings left out; null if none does."""
    plain = F.initcap(F.trim(F.regexp_replace(text, r"(\d+)(?:st|nd|rd|th)", "$1")))
    return F.coalesce(*[F.try_to_date(plain, form) for form in QUESTION_FORMS])


#: What may stand before a date on a line of its own.
DATE_PREFIX = r"(?i)^\W*(?:new\s+delhi|dated?|decided\s+on|date\s+of\s+judgment)\s*[:;,.-]*\s*"


def repaired_year(text: Column) -> Column:
    """A text whose years of four signs have letters that stand for digits (i, I, l, o, O) read as digits."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?<=[\s,])[iIlOo\d]{4}\b"), F.lit(0)))
    return F.aggregate(found, text, lambda t, y: F.replace(t, y, F.translate(y, "iIlOo", "11100")))


def date_line(line: Column) -> Column:
    """The date of a line that holds nothing else but a place or up to four further signs; null for other lines."""
    rest = F.regexp_replace(F.trim(line), DATE_PREFIX, "")
    bare = F.regexp_replace(rest, rf"(?i)\b(?:{_MONTH}\s+\d{{1,2}}(?:st|nd|rd|th)?,?\s+(?:19|20)\d\d|\d{{1,2}}(?:st|nd|rd|th)?\s+(?:day\s+of\s+)?{_MONTH},?\s+(?:19|20)\d\d|\d{{1,2}}[./-]\d{{1,2}}[./-](?:19|20)\d\d)\b", "")
    return F.when((F.length(bare) < F.length(rest)) & (F.length(bare) <= 4), parse_date(rest))

"""Identifiers derived from content, as Columns."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the namespace of point ids.
POINTS = uuid.UUID("70c0953d-8ae0-5bf0-9c4a-25010792289c")
#: Words of rank and address before or after a judge's name.
RANKS = r"(?i)\b(hon'?ble|justice|mr|mrs|ms|dr|cji|c\.j\.i|chief justice of india|chief justice|jj?)\b\.?"
SECTION = r"^(\d+)-?([A-Za-z]{0,2})((?:\([0-9A-Za-z]+\))*)$"


def _joined(text: Column, mark: str) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", mark), f"^{mark}+|{mark}+$", "")


def slug(text: Column) -> Column:
    """ASCII letters and digits in lower case, joined by underscores."""
    return _joined(text, "_")


def citation_key(text: Column) -> Column:
    """The same joined by hyphens."""
    return _joined(text, "-")


def judge_slug(name: Column) -> Column:
    """Slug of a judge's name without rank and address."""
    return slug(F.regexp_replace(name, RANKS, " "))


def point_id(name: Column, namespace: uuid.UUID = POINTS) -> Column:
    """Version 5 UUID of a name, computed on the JVM from its SHA-1."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.concat(F.lit("5"), F.substring(h, 14, 3)),
        F.concat(variant, F.substring(h, 18, 3)),
        F.substring(h, 21, 12),
    )


def section(text: Column) -> Column:
    """One spelling of a section number; other text only loses its white space."""
    s = F.regexp_replace(text, r"\s+", "")
    parts = [F.regexp_extract(s, SECTION, k) for k in (1, 2, 3)]
    return F.when(s.rlike(SECTION), F.concat(parts[0], F.upper(parts[1]), parts[2])).otherwise(s)


def base_section(text: Column) -> Column:
    """A section without its sub-sections; its letter stays."""
    return F.regexp_replace(section(text), r"\(.*$", "")


def statute_id(code: Column, number: Column) -> Column:
    return F.concat_ws(":", code, section(number))


def chunk_id(case: Column, segment: Column, first: Column, last: Column, part: Column) -> Column:
    """Id of a passage: case, opinion, first and last paragraph label, and the part if it was cut."""
    return F.concat(
        case, F.lit("_o"), segment.cast("string"), F.lit("_p"), first,
        F.when(first != last, F.concat(F.lit("-"), last)).otherwise(""),
        F.when(part.isNotNull(), F.concat(F.lit("_"), part.cast("string"))).otherwise(""),
    )


def parent_id(chunk: Column) -> Column:
    """A passage's id without its part."""
    return F.regexp_replace(chunk, r"_\d+$", "")


#: Parties that stand for many cases, and words of address.
STATE_PARTY = r"(?i)^(?:state|union|commissioner|director|collector)\b"
ADDRESS = r"(?i)^(?:justice|dr|shri|smt|mr|mrs|ms|m/s|his holiness|sri)\.?\s+"


def case_slug(petitioner: Column, respondent: Column, year: Column, stem: Column) -> Column:
    """Id of a case from its lead party (both parties where the first is an office), six words at most, and the year."""
    lead = (
        F.when(F.coalesce(petitioner, F.lit("")) == "", stem)
        .when(petitioner.rlike(STATE_PARTY), F.concat_ws(" v ", petitioner, respondent))
        .otherwise(petitioner)
    )
    words = F.slice(F.split(slug(F.regexp_replace(F.regexp_replace(lead, ADDRESS, ""), r"\(.*?\)", "")), "_"), 1, 6)
    name = F.array_join(words, "_")
    return F.concat(F.when(name == "", slug(stem)).otherwise(name), F.when(year.isNotNull(), F.concat(F.lit("_"), year.cast("string"))).otherwise(""))


def file_stem(year: Column, petitioner: Column, respondent: Column, path: Column) -> Column:
    """Readable file name of a judgment: year, parties without filler, 28 characters each, and the source path."""
    filler = r"\b(and|&|ors?|anr|etc|others?|another|the|thr|through|rep|by)\b\.?"
    short = lambda c: F.substring(slug(F.regexp_replace(F.lower(c), filler, " ")), 1, 28)
    return F.concat_ws("_", year.cast("string"), short(petitioner), F.lit("v"), short(respondent), path)

"""Text functions as Columns; comparisons of likeness, which the JVM lacks, as Arrow functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OPEN_QUOTES = r"“[^”]*(?:”|$)|\"[^\"]*(?:\"|$)"
#: Glyphs that old text layers hold in place of quotation marks, spaces and bullets.
GLYPHS = {"―": "“", "‖": "”", "‗": "‘", "„": "‘", "‟": "’", "\u00a0": " ", "\uf0b7": "•"}
#: What the bytes of old punctuation stand for, by their last two octal digits; the digit before is 0, 2 or lost.
ESCAPES = {"05": "…", "21": "‘", "22": "’", "23": "“", "24": "”", "26": "–", "27": "—"}
#: Abbreviations after which a sentence goes on.
ABBREVIATIONS = (
    "v vs dr mr mrs ms no nos sec secs art arts cr hon ltd co anr ors etc viz para paras pp ed vol rs st smt shri sri jj cji ibid supra i.e e.g u/s r/w"
).split()
#: Words in which a heading names the kind of its section, the first match counts.
HEADING_KINDS = [
    (r"(?i)SUBMISSION|CONTENTION|ARGUMENT", "argument"),
    (r"(?i)\bISSUES?\b|QUESTION|POINTS? FOR|THE REFERENCE", "issue"),
    (r"(?i)\bFACTS?\b|BACKGROUND|PROSECUTION CASE|CHRONOLOGY", "facts"),
    (r"(?i)ANALYSIS|DISCUSSION|REASON|CONSIDERATION|FINDING|CONCLUSION|SUMMATION", "analysis"),
    (r"(?i)\bORDER\b|DIRECTION|RESULT|RELIEF|DISPOSITION|OPERATIVE", "ruling"),
]
PETITIONER = r"(?i)(?:appellants?|petitioners?|applicants?|plaintiffs?|revisionists?)\b"
RESPONDENT = r"(?i)(?:respondents?|defendants?|caveators?)\b"
STATE = r"(?:State|Union(?: of India)?|Revenue|prosecution|Government|C\.?B\.?I\.?)(?![a-z])"


def squash(text: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def escape_pattern(digits: str) -> str:
    """Regular expression of an octal escape in its three spellings; an ellipsis may be spelled several times."""
    one = rf"\\[02]?{digits}"
    return f"(?:{one})+" if digits == "05" else one


def tidy(text: Column) -> Column:
    """Glyphs of old text layers and octal escapes replaced; escapes are looked for only where a backslash occurs."""
    out = F.translate(text, "".join(GLYPHS), "".join(GLYPHS.values()))
    fixed = out
    for digits, mark in ESCAPES.items():
        fixed = F.regexp_replace(fixed, escape_pattern(digits), mark)
    return F.when(out.contains("\\"), fixed).otherwise(out)


def escapes(text: Column) -> Column:
    """Number of octal escapes that `tidy` replaces."""
    return F.regexp_count(text, F.lit("|".join(map(escape_pattern, ESCAPES))))


def tokens(text: Column) -> Column:
    """Tokens of a text: a quarter of its characters, half to even, at least one."""
    return F.greatest(F.lit(1), F.bround(F.length(text) / F.lit(4.0))).cast("int")


def quoted_share(text: Column) -> Column:
    """Share of a text inside double quotation marks; an open mark runs to the end. Null and empty give 0."""
    parts = F.regexp_extract_all(text, F.lit(OPEN_QUOTES), F.lit(0))
    n = F.aggregate(F.transform(parts, lambda p: F.length(p)), F.lit(0), lambda a, x: a + x)
    return F.when(F.length(text) > 0, F.round(F.least(F.lit(1.0), n / F.length(text)), 2)).otherwise(0.0)


def caps_share(text: Column) -> Column:
    """Share of upper case among the letters; 0 without letters."""
    letters = F.regexp_count(text, F.lit(r"\p{L}"))
    return F.coalesce(F.regexp_count(text, F.lit(r"\p{Lu}")) / F.nullif(letters, F.lit(0)), F.lit(0.0))


def is_heading(line: Column) -> Column:
    """Whether a line reads as a heading: short, not ending like a sentence, lettered or in capitals without digits."""
    text = F.trim(line)
    words = F.size(F.split(text, r"\s+"))
    lettered = text.rlike(r"^(?:[A-Z]|[IVX]{1,4})[.)]\s+[A-Z]") & (words <= 12)
    capitals = ~text.rlike(r"\d") & (caps_share(text) >= 0.9)
    return (
        F.length(text).between(3, 90) & ~text.rlike(r"[.;,]$") & (F.regexp_count(text, F.lit(r"\p{L}")) >= 3) & (lettered | capitals)
    )


def clean_heading(line: Column) -> Column:
    """A heading without leaders, brackets, colon and letter-spacing."""
    text = squash(F.regexp_replace(line, r"\.{3,}\s*\d*\s*$", ""))
    text = F.regexp_replace(F.regexp_replace(text, r"\s*:\s*$", ""), r"^[\[(]\s*|\s*[\])]$", "")
    return F.when(text.rlike(r"^(?:\S )+\S$"), F.regexp_replace(text, " ", "")).otherwise(text)


def title_case(name: Column) -> Column:
    """Capitalized words of a name in capitals; initials stay, small words but the first are lowered."""
    small = F.array(*[F.lit(w) for w in ("of", "and", "the", "for", "in", "by", "on", "at", "to")])
    words = F.split(squash(name), " ")

    def each(w: Column, i: Column) -> Column:
        low = F.lower(w)
        return (
            F.when((i > 0) & F.array_contains(small, low), low)
            .when(w.rlike(r"^(?:[A-Z]\.)+[A-Z]?\.?$"), w)
            .when(caps_share(name) < 0.8, w)
            .otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1000))))
        )

    return F.array_join(F.transform(words, each), " ")


def clean_party(name: Column) -> Column:
    """A party without role words, others and representation, in title case."""
    text = F.regexp_replace(name, r"(?i)[,\s]*(?:&|and)\s+(?:ors|anr|others|another|etc)\b\.?.*$", "")
    text = F.regexp_replace(text, r"(?i)[,\s]+(?:through|thr\.?|rep\.? by|represented by)\b.*$", "")
    text = F.regexp_replace(text, r"(?i)[\s.…,-]*\b(?:appellant|petitioner|respondent|applicant|plaintiff|defendant)s?\s*(?:\(s\))?\.?\s*$", "")
    text = F.regexp_replace(squash(text), r"^[ .,;:]+|[ .,;:]+$", "")
    return title_case(F.when(text.rlike(r"\b(?:[A-Za-z]\.)+[A-Za-z]$"), F.concat(text, F.lit("."))).otherwise(text))


def clean_judge(name: Column) -> Column:
    """A judge's name without brackets, address and rank, with a space behind initials."""
    text = F.regexp_replace(name, r"[\[\](){}*]", " ")
    text = F.regexp_replace(text, r"(?i)\bhon['’]?(?:ble)?\b\.?|\b(?:mr|mrs|ms|dr|smt|shri)\b\.?|\b(?:chief )?justice\b|^CJI\b", " ")
    text = F.regexp_replace(text, r"(?i)[,\s]+(?:C\.?\s?J\.?(?:\s?I\.?)?|J\.?|JJ\.?)\s*$", "")
    return F.regexp_replace(squash(F.regexp_replace(text, r"(?<=\b[A-Z])\.(?=[A-Z][a-z])", ". ")), r"^[ ,.:;]+|[ ,:;]+$", "")


def surname(name: Column) -> Column:
    """The letters of the last word, in lower case."""
    return F.regexp_replace(F.lower(F.element_at(F.split(F.trim(name), r"\s+"), -1)), "[^a-z]", "")


def strip_html(html: Column) -> Column:
    """Text without tags."""
    return squash(F.regexp_replace(html, "<[^>]+>", " "))


def join_lines(lines: Column) -> Column:
    """Lines as one text, blanks dropped."""
    kept = F.filter(F.transform(lines, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != ""))
    return squash(F.array_join(kept, " "))


def repair_digits(text: Column) -> Column:
    """Letters that stand for digits between digits (O, l, I); the length stays."""
    zeros = F.regexp_replace(text, r"(?<=\d)[Oo](?=\d)|(?<=\d)[Oo](?=[A-Z]\b)", "0")
    return F.regexp_replace(zeros, r"(?<=\d)[lI](?=\d)", "1")


def sentences(text: Column) -> Column:
    """Sentences of a text: cuts at stops before a capital, digit or bracket, glued again behind abbreviations,
    initials and short numbers."""
    mark = "\u0001"
    cut = F.split(F.regexp_replace(F.trim(text), r"([.?!][\"”’)\]]*)\s+(?=[A-Z0-9(\[\"“‘])", f"$1{mark}"), mark)
    known = F.array(*[F.lit(a) for a in ABBREVIATIONS])

    def open_(s: Column) -> Column:
        last = F.lower(F.regexp_replace(F.element_at(F.split(s, r"\s+"), -1), r"^[(\[\"“‘]+|[.?!][\"”’)\]]*$", ""))
        return F.array_contains(known, last) | last.rlike(r"^(?:[a-z]|\d{1,4})$")

    glued = F.aggregate(
        cut,
        F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("now")),
        lambda a, s: F.struct(
            F.when((a["now"] == "") | open_(a["now"]), a["done"]).otherwise(F.concat(a["done"], F.array(a["now"]))).alias("done"),
            F.when((a["now"] != "") & open_(a["now"]), F.concat(a["now"], F.lit(" "), s)).otherwise(s).alias("now"),
        ),
        lambda a: F.when(a["now"] == "", a["done"]).otherwise(F.concat(a["done"], F.array(a["now"]))),
    )
    return F.when(F.trim(text) == "", F.array().cast("array<string>")).otherwise(glued)


def state_side(case_name: Column) -> Column:
    """Side on which the State stands: petitioner or respondent; null if on none or both."""
    sides = F.split(case_name, r"(?i)\s+(?:v\.?|vs\.?|versus)\s+", 2)
    first, second = sides[0].rlike(STATE), F.try_element_at(sides, F.lit(2)).rlike(STATE)
    return F.when(first & ~second, "petitioner").when(second & ~first, "respondent")


def heading_role(heading: Column, state: Column) -> Column:
    """Role that a section heading names."""
    out = F.when(heading.isNull() | (heading == ""), F.lit(None).cast("string"))
    for pattern, role in HEADING_KINDS:
        value = F.lit(role)
        if role == "argument":
            value = (
                F.when(heading.rlike(PETITIONER), "argument_petitioner")
                .when(heading.rlike(RESPONDENT), "argument_respondent")
                .when(heading.rlike(STATE) & state.isNotNull(), F.concat(F.lit("argument_"), state))
                .otherwise(role)
            )
        out = out.when(heading.rlike(pattern), value)
    return out


def context_line(name: Column, court: Column, date: Column, citation: Column, summary: Column, heading: Column) -> Column:
    """The document line put before a passage; empty parts are left out."""
    some = lambda c: F.nullif(c, F.lit(""))
    head = F.concat_ws(", ", some(name), some(court), some(date), some(citation))
    return F.concat(
        head, F.lit("."),
        F.coalesce(F.concat(F.lit(" "), F.regexp_replace(F.trim(some(summary)), r"\.+$", ""), F.lit(".")), F.lit("")),
        F.coalesce(F.concat(F.lit(" Section: "), some(heading), F.lit(".")), F.lit("")),
    )


def cite_as(name: Column, citation: Column, date: Column, numbering: Column, page: Column, span: Column, author: Column, kind: Column, several: Column) -> Column:
    """How a passage is cited: by paragraph where the court numbered them, else by page."""
    where = (
        F.when(numbering != "original", F.concat(F.lit(", page "), page.cast("string")))
        .when(span.contains("-"), F.concat(F.lit(", paras "), span))
        .otherwise(F.concat(F.lit(", para "), span))
    )
    source = F.coalesce(F.concat(F.lit(", "), F.nullif(citation, F.lit(""))), F.concat(F.lit(", decided "), date_words(date)), F.lit(""))
    by = F.when(several & author.isNotNull(), F.concat(F.lit(" (per "), author, F.when(kind != "unknown", F.concat(F.lit(", "), kind)).otherwise(""), F.lit(")")))
    return F.concat(name, source, where, F.coalesce(by, F.lit("")))


def date_words(date: Column) -> Column:
    """A date as day, month in words and year."""
    return F.date_format(date, "d MMMM yyyy")


def embedding_text(context: Column, text: Column) -> Column:
    """What is embedded for a passage: its context line, if any, and the text."""
    return F.when(F.coalesce(context, F.lit("")) != "", F.concat(context, F.lit("\n\n"), text)).otherwise(text)


def ratio(a: str, b: str) -> float:
    """Likeness of two strings by their matching blocks."""
    from difflib import SequenceMatcher

    return SequenceMatcher(None, a, b).ratio()


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two columns; null where either is null."""

    @F.pandas_udf("double")
    def of(a, b):
        import pandas as pd

        return pd.Series([None if x is None or y is None else ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    return of(a, b)


def same_surname(a: Column, b: Column) -> Column:
    """Whether two names have one surname: equal, one ending the other with five letters, or alike by 0.8."""
    x, y = surname(a), surname(b)
    ends = ((F.length(x) >= 5) & F.endswith(y, x)) | ((F.length(y) >= 5) & F.endswith(x, y))
    long = (F.length(x) >= 5) & (F.length(y) >= 5)
    return (x == y) | ends | (long & (likeness(x, y) >= 0.8))


def letters(text: Column) -> Column:
    """The letters a to z of a text in lower case."""
    return F.regexp_replace(F.lower(text), "[^a-z]", "")


def heading_key(text: Column) -> Column:
    """The form in which headings are compared: cleaned, letters and digits only, single blanks."""
    return F.trim(F.regexp_replace(F.lower(clean_heading(text)), "[^a-z0-9]+", " "))


def known_heading(text: Column, known: Column) -> Column:
    """Whether a line is one of the headings in known, an array of keys: equal, or one begins the other with twelve characters
    or more, as a long heading wraps. Null and empty lines are none."""
    key = heading_key(text)
    long = F.length(key) >= 12
    return F.coalesce((key != "") & F.exists(known, lambda k: (k == key) | (long & (F.length(k) >= 12) & (k.startswith(key) | key.startswith(k)))), F.lit(False))


#: A judge named in a page's header, and words that such a bracket never holds.
HEADER_JUDGE = r"(?i)[\[(]\s*(?:DR\.?\s+)?([A-Za-z][A-Za-z .&]{1,40}?),?\s*(?:C\.?\s?J\.?\s?I?|JJ?)\.?\s*[\])]\s*\W*\d{0,4}\W*$"
NO_HEADER_JUDGE = r"(?i)\b(?:for|himself|herself|and|concurring|dissenting|majority|per)\b"


def header_judge(line: Column) -> Column:
    """The judge named in brackets at the end of a page's header; null for none."""
    name = F.nullif(F.regexp_extract(line, HEADER_JUDGE, 1), F.lit(""))
    return F.when(~name.rlike(NO_HEADER_JUDGE), F.trim(name))


#: The running title of the official reports, and how like it a line's letters must be.
REPORT_TITLE, REPORT_LIKENESS, NAME_LIKENESS = "SUPREMECOURTREPORTS", 0.72, 0.6


def report_header(line: Column) -> Column:
    """Whether a line is the running header of the official reports, however it was recognised; only lines with enough letters
    leave the JVM."""
    name = F.upper(F.regexp_replace(line, "[^A-Za-z]", ""))
    asked = F.when(F.length(name) >= 15, F.substring(name, 1, 19))
    return F.coalesce(likeness(asked, F.when(asked.isNotNull(), F.lit(REPORT_TITLE))) >= REPORT_LIKENESS, F.lit(False))


def names_match(candidate: Column, judge: Column) -> Column:
    """Whether a recognised name is like a judge's name or one of its words of three letters or more, by 0.6."""

    @F.pandas_udf("boolean")
    def of(a, b):
        import pandas as pd

        out = []
        for x, y in zip(a, b, strict=True):
            words = [] if y is None else [y, *(w for w in y.replace("&", " ").split() if len(w) >= 3)]
            plain = lambda t: "".join(c for c in t.lower() if "a" <= c <= "z")
            out.append(x is not None and any(ratio(plain(x), plain(w)) >= NAME_LIKENESS for w in words))
        return pd.Series(out)

    return of(candidate, judge)

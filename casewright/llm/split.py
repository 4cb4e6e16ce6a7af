"""P3: texts above a token limit are cut into balanced pieces at natural boundaries, with shared sentences.

The least number of pieces gives equal-length targets; each target moves to the strongest boundary near it
(line break, sentence end, clause end, comma, space, any character). Where a piece breaks the limit, one
more piece is tried. A piece then also takes up to two whole sentences from the end of the one before; where these
do not fit, up to half as many pieces more are tried.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import one_per_key, table

MAX_TOKENS = 384
OVERLAP_SENTENCES = 2
#: Endings of words that a full stop follows without ending a sentence.
ABBREVIATIONS = frozenset("no nos v vs rs dr mr mrs ms st art arts sec secs cl para paras vol ed viz ors anr etc cf hon smt shri ltd co pvt govt dept supp ie eg al jr sr".split())
STOP = re.compile(r"[.?!।۔॥。？！؟]+[\"'”’)\]»]*(?=\s|$)|[。？！](?!\s)")
LINE, SENTENCE, CLAUSE, COMMA, SPACE, CHARACTER = 5, 4, 3, 2, 1, 0
PIECES = "record_id string, piece int, pieces int, start int, end int, shared int, tokens int, pause int, text string"


def tokens(n: int) -> int:
    """Tokens of a text of n characters: a quarter, half to even, at least one."""
    return max(1, round(n / 4))


def token_column(text: Column) -> Column:
    """The same as a column."""
    return F.greatest(F.lit(1), F.bround(F.length(text) / F.lit(4.0))).cast("int")


def longest(limit: int) -> int:
    """Most characters that stay within the limit."""
    n = 4 * limit
    while tokens(n + 1) <= limit:
        n += 1
    return n


def sentence_ends(text: str) -> list[int]:
    """Offsets behind each sentence and the white space that follows it."""
    out = []
    for m in STOP.finditer(text):
        if m.group()[0] == ".":
            before = text[max(0, m.start() - 12) : m.start()]
            word = re.split(r"[\s(\[“\"]", before)[-1]
            if (
                word.lower() in ABBREVIATIONS
                or (len(word) == 1 and word.isalpha())
                or re.fullmatch(r"(?:\w\.)+\w", word)
                or (re.fullmatch(r"\(?\d{1,4}", word) and (len(before) == len(word) or before[-len(word) - 1] == "\n"))
            ):
                continue
        end = m.end()
        while end < len(text) and text[end].isspace():
            end += 1
        if end < len(text) and text[end].islower():
            continue
        out.append(end)
    return out


def boundaries(text: str) -> list[tuple[int, int]]:
    """(offset, strength) of all natural boundaries: a piece may end at the offset."""
    best: dict[int, int] = {}
    for m in re.finditer(r"\s+", text):
        last = text[m.start() - 1 : m.start()]
        best[m.end()] = LINE if "\n" in m.group() else CLAUSE if last in (";", ":", "—", "–") else COMMA if last in (",", "،") else SPACE
    for m in re.finditer(r"[~|;,/](?=\S)", text):
        best[m.end()] = COMMA if m.group() in "~;" else SPACE
    for end in sentence_ends(text):
        best[end] = max(best.get(end, 0), SENTENCE)
    return sorted((at, s) for at, s in best.items() if 0 < at < len(text))


def split_text(text: str, limit: int = MAX_TOKENS, overlap: int = OVERLAP_SENTENCES) -> list[tuple[int, int, int, int]]:
    """(start, end, shared, pause) of each piece: text[start:end], of which the first `shared` characters repeat the
    piece before; pause is the strength of the boundary at its end. Without the shared parts the pieces are the text."""
    most = longest(limit)
    if len(text) <= most:
        return [(0, len(text), 0, LINE)]
    marks = boundaries(text)
    at = [a for a, _ in marks]
    ends = sentence_ends(text)
    least = -(-len(text) // most)
    n, best = least, None
    while best is None or (n <= least * 1.5 + 1 and best[0]):
        cuts = _snap(text, marks, at, n, most)
        if cuts is not None:
            missed, shared = _shared(cuts, len(text), ends, most, overlap)
            if best is None or missed < best[0]:
                best = missed, cuts, shared
        n += max(1, n // 8)
    strength = dict(marks)
    starts, stops = [0, *best[1]], [*best[1], len(text)]
    return [
        (start - s, end, s, LINE if end == len(text) else strength.get(end, CHARACTER))
        for start, end, s in zip(starts, stops, best[2], strict=True)
    ]


def _shared(cuts: list[int], length: int, ends: list[int], most: int, overlap: int) -> tuple[int, list[int]]:
    """Characters that each piece takes from the end of the one before: whole sentences, as many as fit. Also how many
    pieces hold fewer sentences than they could if they were shorter."""
    missed, out, first = 0, [0], 0
    for start, end in zip(cuts, [*cuts[1:], length], strict=True):
        begin, k = start, bisect.bisect_left(ends, start)
        for take in range(overlap):
            i = k - 1 - take
            s = ends[i] if i >= 0 else 0
            if s <= first or i < -1:
                break
            if end - s > most:
                missed += start - s < most // 2
                break
            begin = s
        out.append(start - begin)
        first = begin
    return missed, out


def _snap(text: str, marks: list[tuple[int, int]], at: list[int], n: int, most: int) -> list[int] | None:
    """Cuts near the n - 1 equal targets, or None if a piece would be too long."""
    width = len(text) / n
    cuts, last = [], 0
    for k in range(1, n):
        target = k * width
        reach = min(width / 2, most / 3)
        lo, hi = bisect.bisect_left(at, max(last + 1, target - reach)), bisect.bisect_right(at, min(target + reach, last + most))
        near = marks[lo:hi]
        if near:
            cut = max(near, key=lambda m: (min(m[1], SENTENCE), -abs(m[0] - target)))[0]
        else:
            cut = min(int(target), last + most)
            while cut > last + 1 and _joined(text, cut):
                cut -= 1
        if not last < cut <= last + most:
            return None
        cuts.append(cut)
        last = cut
    return cuts if len(text) - last <= most else None


def _joined(text: str, cut: int) -> bool:
    """Whether a cut would part a mark or joiner from its letter."""
    import unicodedata

    return unicodedata.combining(text[cut]) != 0 or unicodedata.category(text[cut]) in ("Mn", "Mc", "Me", "Cf") or text[cut - 1] == "‍"


def split_long(df: DataFrame, key: str, text: str, limit: int = MAX_TOKENS, overlap: int = OVERLAP_SENTENCES) -> DataFrame:
    """Pieces of the texts of df, one row per piece in order; texts within the limit are one piece.

    A null text has no pieces, an empty text one empty piece of one token. Rows with a null key are left out; of rows
    with equal keys one is used. Other columns are ignored. Only texts above the limit leave the JVM.
    """
    rows = df.select(F.col(key).alias("record_id"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    over = token_column(F.col("text")) > limit
    short = one_per_key(rows.where(~over), "record_id").select(
        "record_id",
        F.lit(0).alias("piece"),
        F.lit(1).alias("pieces"),
        F.lit(0).alias("start"),
        F.length("text").alias("end"),
        F.lit(0).alias("shared"),
        token_column(F.col("text")).alias("tokens"),
        F.lit(LINE).alias("pause"),
        "text",
    )

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for pdf in batches:
            out = []
            for key_, text_ in zip(pdf["record_id"], pdf["text"], strict=True):
                found = split_text(text_, limit, overlap)
                out += [(key_, i, len(found), a, b, s, tokens(b - a), p, text_[a:b]) for i, (a, b, s, p) in enumerate(found)]
            yield pd.DataFrame(out, columns=[x.split()[0] for x in PIECES.split(", ")])

    long = one_per_key(rows.where(over), "record_id").mapInPandas(run, PIECES)
    return short.unionByName(long)


def _both(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        split_long(table(spark, sf_dir, name), key, "text").withColumn("record_table", F.lit(name))
        for name, key in (("paragraphs", "para_id"), ("chunks", "chunk_id"))
    ]
    return parts[0].unionByName(parts[1])


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that came out as more than one piece: their text is above the limit."""
    return _both(spark, sf_dir).where((F.col("pieces") > 1) & (F.col("piece") == 0)).select("record_table", "record_id")


def p3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pieces of all paragraphs and chunks."""
    return _both(spark, sf_dir)


def p3_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces by table and kind of boundary at their end, with the longest."""
    return (
        _both(spark, sf_dir)
        .where("pieces > 1")
        .groupBy("record_table", "pause")
        .agg(F.count(F.lit(1)).alias("n_pieces"), F.max("tokens").alias("most_tokens"), F.count_if(F.col("shared") > 0).alias("n_shared"))
    )


ORACLES = {
    "p3_found": """
        SELECT DISTINCT record_table, record_id FROM (
          SELECT 'paragraphs' AS record_table, para_id AS record_id, text FROM paragraphs
          UNION ALL SELECT 'chunks', chunk_id, text FROM chunks)
        WHERE record_id IS NOT NULL AND greatest(1, round_even(len(text) / 4.0, 0)) > 384""",
}

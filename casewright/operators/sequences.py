"""Operators on ordered passages and paragraphs: neighbours, blocks, gaps, as-of notes, packing, cutting of long ones."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import ABBREVIATIONS

#: Ends of sentences, the last word behind which they go on, marks of a clause's end.
STOP = re.compile(r"[.?!][\"”’)\]]*\s+(?=[A-Z0-9(\[\"“‘])")
SHORT = re.compile(r"[a-z]|\d{1,4}")
CLAUSE = ";:,—"


def neighbours(df: DataFrame, group: str, order: list[str], key: str) -> DataFrame:
    """Adds prev_<key> and next_<key> in the order within a group."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(f"prev_{key}", F.lag(key).over(w)).withColumn(f"next_{key}", F.lead(key).over(w))


def blocks(df: DataFrame, group: str, order: list[str], same: list[str]) -> DataFrame:
    """Adds block_id and block_index: runs of rows whose `same` columns are equal, null equal to null."""
    w = Window.partitionBy(group).orderBy(*order)
    change: Column = F.lag(F.lit(1)).over(w).isNull()
    for c in same:
        change = change | ~F.col(c).eqNullSafe(F.lag(c).over(w))
    df = df.withColumn("_block", F.sum(change.cast("int")).over(w) - 1)
    inside = Window.partitionBy(group, "_block").orderBy(*order)
    return df.withColumn("block_id", F.concat(F.col(group), F.lit("_b"), F.col("_block").cast("string"))).withColumn("block_index", F.row_number().over(inside) - 1).drop("_block")


def near_end(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Adds near_end: fewer rows follow than the larger of 6 and 12 percent of the group, half to even."""
    w = Window.partitionBy(*group)
    size, at = F.count(F.lit(1)).over(w), F.row_number().over(w.orderBy(*order))
    return df.withColumn("near_end", (size - at) < F.greatest(F.lit(6), F.bround(size * F.lit(0.12)).cast("long")))


def number_gaps(df: DataFrame, group: list[str], number: str, shown: int = 6) -> DataFrame:
    """(group, missing, first): numbers absent between the least and the greatest of each group, and the first few.

    Found by the distance of neighbours, so a group's numbers are never gathered; only the first few are listed.
    """
    w = Window.partitionBy(*group).orderBy(number)
    steps = df.where(F.col(number).isNotNull()).select(*group, number).distinct().withColumn("after", F.lead(number).over(w)).where(F.col("after") > F.col(number) + 1)
    few = F.sequence(F.col(number) + 1, F.least(F.col("after") - 1, F.col(number) + shown))
    listed = steps.select(*group, (F.col("after") - F.col(number) - 1).cast("long").alias("n"), F.explode(few).alias("x"), F.col(number).alias("from"))
    rank = Window.partitionBy(*group).orderBy("x")
    first = listed.withColumn("k", F.row_number().over(rank)).where(F.col("k") <= shown).groupBy(*group).agg(F.array_sort(F.collect_list("x")).alias("first"))
    total = steps.groupBy(*group).agg(F.sum(F.col("after") - F.col(number) - 1).cast("long").alias("missing"))
    return total.join(first, group)


def notes_to_paragraphs(notes: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """Notes(case_id, page, note_seq, note) with the paragraph that runs on their page: the last that begins at or before
    it. A backward as-of join: both are ranked on one time line of pages, and the last paragraph seen is carried forward.
    Notes before the first paragraph have null."""
    p = paragraphs.select("case_id", "page", F.lit(0).alias("kind"), F.col("para_seq").alias("seq"), "para_id", F.lit(None).cast("string").alias("note"))
    n = notes.select("case_id", "page", F.lit(1).alias("kind"), F.col("note_seq").alias("seq"), F.lit(None).cast("string").alias("para_id"), "note")
    # the paragraph last in order owns the page; order by page first, paragraphs before notes
    w = Window.partitionBy("case_id").orderBy("page", "kind", "seq").rowsBetween(Window.unboundedPreceding, 0)
    return p.unionByName(n).withColumn("owner", F.last("para_id", True).over(w)).where("kind = 1").select("case_id", "page", F.col("seq").alias("note_seq"), "note", F.col("owner").alias("para_id"))


def pack(df: DataFrame, target: int = 200, most: int = 384, tiny: int = 30) -> DataFrame:
    """Chunks packed from the paragraphs of each (case_id, segment), by a fold that streams through the ordered paragraphs.

    df: case_id, segment, para_seq, number, label, page, text, role, heading. A chunk holds whole neighbouring paragraphs of
    one role and heading up to `target` tokens; tiny unlabelled ones at its head ride with what follows; a paragraph of
    more than `most` tokens (para_seq is unique in its opinion) stands alone, marked long; `cut_long` cuts it. Null texts count as empty. Out: case_id, segment, chunk (position),
    first, last (labels), para_start, para_end, page_start, text, role, heading, labels, long.
    """
    df = df.select(
        "case_id", F.coalesce("segment", F.lit(0)).alias("segment"), "para_seq", "number", F.coalesce("label", F.col("number").cast("string")).alias("label"), "page",
        F.coalesce("text", F.lit("")).alias("text"), F.coalesce("role", F.lit("unlabelled")).alias("role"), "heading",
    )
    # the fold sees a few bytes a paragraph, in order, and holds one chunk's state; texts stay where they are and are joined back
    tokens = lambda n: F.greatest(F.lit(1), F.bround(n / F.lit(4.0))).cast("int")

    def fold(batches: Iterator) -> Iterator:
        key, at, chunk, open_, chars, little, role, heading = None, 0, -1, False, 0, False, None, None
        for pdf in batches:
            out = []
            for case, segment, size, said, head in zip(pdf["case_id"], pdf["segment"], pdf["chars"], pdf["role"], pdf["heading"], strict=True):
                head = head if isinstance(head, str) else None
                if (case, segment) != key:
                    key, at, chunk, open_ = (case, segment), 0, -1, False
                mine = _tokens(size)
                small = said == "unlabelled" and mine < tiny
                if open_ and mine <= most and _tokens(chars) + mine <= target and (little or (said == role and head == heading)):
                    chars, little, role, heading = chars + 1 + size, little and small, role if role != "unlabelled" else said, head
                else:
                    chunk += 1
                    open_, chars, little, role, heading = mine <= most, size, small, said, head
                out.append((at, chunk))
                at += 1
            pdf["at"], pdf["chunk"] = [a for a, _ in out], [k for _, k in out]
            yield pdf[["case_id", "segment", "para_seq", "at", "chunk"]]

    kinds = dict(df.dtypes)
    order = df.where("case_id IS NOT NULL").select("case_id", "segment", "para_seq", F.length("text").alias("chars"), "role", "heading")
    order = order.repartition("case_id", "segment").sortWithinPartitions("case_id", "segment", "para_seq")
    flat = order.mapInPandas(fold, f"case_id {kinds['case_id']}, segment {kinds['segment']}, para_seq {kinds['para_seq']}, at int, chunk long").join(df, ["case_id", "segment", "para_seq"])
    return flat.groupBy("case_id", "segment", "chunk").agg(
        F.min_by("label", "at").alias("first"), F.max_by("label", "at").alias("last"), F.min_by("number", "at").alias("para_start"), F.max_by("number", "at").alias("para_end"),
        F.min_by("page", "at").alias("page_start"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda x: x["text"]), " ").alias("text"),
        F.coalesce(F.min_by("role", F.when(F.col("role") != "unlabelled", F.col("at"))), F.lit("unlabelled")).alias("role"),
        F.max_by("heading", F.when(F.coalesce("heading", F.lit("")) != "", F.col("at"))).alias("heading"),
        F.transform(F.array_sort(F.collect_list(F.struct("at", "label"))), lambda x: x["label"]).alias("labels"),
        (F.max(tokens(F.length("text"))) > most).alias("long"),
    )


def _tokens(chars: int) -> int:
    return max(1, round(chars / 4))


def _sentences(text: str) -> list[str]:
    """Sentences of a text, as `functions.text.sentences` cuts them."""
    out, start = [], 0
    for m in STOP.finditer(text):
        before = text[start : m.start()].split()
        last = before[-1].strip("([\"“‘").lower() if before else ""
        if last not in ABBREVIATIONS and not SHORT.fullmatch(last):
            out.append(text[start : m.end()].strip())
            start = m.end()
    tail = text[start:].strip()
    return [*out, tail] if tail else out


def _slices(word: str, most: int) -> list[str]:
    """A word above `most` tokens cut behind a mark in the last tenth of what the limit holds, else at the limit."""
    out, size = [], 4 * most
    while len(word) > size:
        at = next((i for i in range(size, size - size // 10, -1) if not word[i - 1].isalnum()), size)
        out.append(word[:at])
        word = word[at:]
    return [*out, word]


def _clauses(sentence: str, most: int) -> list[tuple[str, str]]:
    """(space before, piece) of a sentence above `most` tokens, cut at words: near the limit, or at a clause's end from six
    tenths of it. Only words above the limit are cut themselves."""
    out: list[tuple[str, str]] = []
    piece: list[str] = []
    chars = -1
    for word in sentence.split():
        if piece and _tokens(chars + 1 + len(word)) > most:
            out.append((" ", " ".join(piece)))
            piece, chars = [], -1
        if _tokens(len(word)) > most:
            out += [("" if k else " ", x) for k, x in enumerate(_slices(word, most))]
            continue
        piece.append(word)
        chars += len(word) + 1
        size = _tokens(chars)
        if size >= most * 0.9 or (size >= most * 0.6 and word[-1] in CLAUSE):
            out.append((" ", " ".join(piece)))
            piece, chars = [], -1
    return [*out, (" ", " ".join(piece))] if piece else out


def parts_of(text: str, most: int = 384, overlap: int = 2) -> list[str]:
    """Parts of a long text, packed from its sentences up to `most` tokens; each repeats the last `overlap` sentences of the one
    before, as far as they leave room for the next sentence."""
    pieces = [x for s in _sentences(text) for x in ([(" ", s)] if _tokens(len(s)) <= most else _clauses(s, most))]
    said = lambda xs: "".join(space + x for space, x in xs)[len(xs[0][0]) :]
    over = lambda xs: _tokens(len(said(xs))) > most
    out: list[str] = []
    now: list[tuple[str, str]] = []
    fresh = 0  # sentences of `now` that no part has yet
    for piece in pieces:
        if now and over([*now, piece]):
            carry = now[-overlap:] if fresh and overlap else []
            if fresh:
                out.append(said(now))
            while carry and over([*carry, piece]):
                carry = carry[1:]
            now, fresh = carry, 0
        now.append(piece)
        fresh += 1
    return [*out, said(now)] if fresh else out


def cut_long(packed: DataFrame, most: int = 384, overlap: int = 2) -> DataFrame:
    """The chunks of `pack` with chunk_part: a long one leaves as its parts, numbered from 0; chunk_part is null for all others.

    Only long texts go to Python. A long text without a word has no part.
    """

    @F.pandas_udf("array<string>")
    def cut(texts):
        import pandas as pd

        return pd.Series([None if t is None else parts_of(t, most, overlap) for t in texts], dtype=object)

    names = packed.columns
    parts = packed.withColumn("_parts", cut(F.when(F.col("long"), F.col("text"))))
    flat = parts.select(*names, F.posexplode_outer("_parts").alias("chunk_part", "_part")).where(~F.col("long") | F.col("chunk_part").isNotNull())
    return flat.withColumn("text", F.coalesce("_part", "text")).drop("_part")

"""P6: noise in lines of scanned pages: broken words, misread characters, running headers and page numbers.

A hidden Markov model labels every line of a page as header, page number, break (a paragraph begins) or body, from layout
features: place, numbers, capitals, indent, gap, whether the line before is finished. It is fitted by Viterbi training on a
bounded sample of pages, while the shapes and opening words of page tops are counted over all pages. The corpus's own words
judge broken and misread words: a rare word whose letters are confusable with those of a much more frequent word is a
misreading of it; a word broken at a line end is rejoined unless the corpus knows it as a compound. Paragraphs are put
together from the labels, across pages.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.tables import checkpointed, table

HEADER, NUMBER, BREAK, BODY = range(4)
STATES = 4
#: Pages of the sample that the model is fitted on, at most.
SAMPLE, ROUNDS, SMOOTHING = 3000, 4, 0.02
#: A misread word is at most this rare beside the right one, which stands at least so often.
RATIO, LEAST = 8, 4
#: Sure words kept by every worker: the most frequent ones; all others are looked up by a join.
SURE_WORDS = 40_000
FLUSH = 300_000
#: Words of a line's shape; lines that begin with a small letter have none, as no header does.
SHAPE = 8
NO_SHAPE = "~"

#: Letters that scanners take for one another, one group a class; pairs that look like one letter.
CLASSES = ["tl1Ii!fj|L", "ceo0OCGQD", "hb", "un", "sS5$", "gq9", "EFB8", "RK", "zZ2", "aA4"]
PAIRS = [("rn", "m"), ("cl", "d"), ("ii", "n"), ("ri", "n"), ("vv", "w"), ("ll", "U")]
FOLD = {ord(c): group[0] for group in CLASSES for c in group}
FOLDED_PAIRS = [(a.translate(FOLD), b.translate(FOLD)) for a, b in PAIRS]
BREAKS = re.compile(r"([A-Za-zÀ-ɏ’']+)[-¬=‐­]\s*$")
ENDS = frozenset("-¬=‐\u00ad")
FIRST = re.compile(r"^\s*((?:[^\W_]|[!|’'])+)")
DIGIT = "[0-9lIOoSB!|]"
STRONG = re.compile(rf"^\W*(?:(?:P[a-z]?[a-z]?[a-z]?e?\.?|p\.)\s*{DIGIT}{{1,4}}(?:\s*o?[a-zf!]?\s*{DIGIT}{{1,4}})?|[-–—]\s*{DIGIT}{{1,4}}\s*[-–—]|\[\s*{DIGIT}{{1,4}}\s*\]|{DIGIT}{{1,4}}\s*/\s*{DIGIT}{{1,4}}|\(\s*{DIGIT}{{1,4}}\s*\))\W*$")
BARE = re.compile(rf"^\s*(?=.*\d|[lIO]{{1,2}}\s*$){DIGIT}{{1,4}}\s*$")
ROMAN = re.compile(r"^\s*[-\[(]?\s*(?=[ivxlc1!]+)c{0,3}(?:x[cl]|l?x{0,4})(?:i[xv]|v?[il1!]{0,4})\s*[-\])]?\s*$")
NUMBERED = re.compile(r"^\s*(?:\(?\d{1,4}[.)]|[A-Z][.)])\s")
STRIP = "“”\"'‘’().,;:?[]{}—–!"
NUMERIC = re.compile(r"^(?=.*\d)(?=.*[lIOo!|])[\dlIOoS!|][\dlIOoS!|.,/-]*$")
LETTERS = re.compile(r"^[A-Za-z0-9!|$À-ɏ]+(?:’s)?$")
WRITTEN = re.compile(r"^[\x00-\x7FÀ-ɏ]+$")
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def skeletons(word: str) -> list[str]:
    """The forms in which confusable letters are equal: one for each letter that
    may be read as a pair, spelled as that pair, and one for none."""
    plain = word.translate(FOLD)
    return [f"0{plain}"] + [f"{k}{plain.replace(b, a)}" for k, (a, b) in enumerate(FOLDED_PAIRS, 1)]


def bare(token: str) -> str:
    """A token without marks around it; a mark before a letter that reads as a letter stays."""
    word = token.strip(STRIP)
    if word and token.lstrip("“”\"'‘’([{—–")[:1] == "!" and word[0].isalpha():
        word = "!" + word
    return word[:-2] if word.endswith("’s") else word


def distance(a: str, b: str, most: int) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
        if min(new) > most:
            return most + 1
        row = new
    return row[-1]


def word_kind(w: str) -> str:
    """Kind of a word with the marks around it."""
    core = w.strip(STRIP)
    kind = "#" if core and 2 * sum(map(str.isdigit, core)) > len(core) else "A" if len(core) > 1 and sum(c.isupper() or c.isdigit() for c in core) > 0.6 * len(core) else "a" if core[:1].islower() else "Aa" if core else ""
    return (w[0] if w[0] in "([“" else "") + kind + (w[-1] if w[-1] in ".,;:)]”" else "")


def shape(line: str) -> str:
    """Kinds of the first words of a line."""
    words = line.split(None, SHAPE)[:SHAPE]
    return NO_SHAPE if words and words[0][0].islower() else " ".join(map(word_kind, words))


def opening(line: str) -> str:
    """The first three words with confusable letters as one."""
    return ">" + " ".join(line.split()[:3]).translate(FOLD)


#: Sizes of the features: place (0 to 2 from the top, 3 last, 4 last but one, 5 between, 6 and 7 before and in a report's
#: headnote), number, top, capitals, parties, and the layout around the line as one.
SIZES = (8, 4, 3, 3, 2, 2 * 2 * 3 * 3 * 3 * 3 * 2)
INDENT, LONGEST_NUMBER = 6.0, 40
CLOSERS = " \t\"”’)]"
NO_LINE, UNFINISHED, DONE = 2, 0, 1


def heading_line(line: str) -> bool:
    return line.isupper() and len(line.split()) <= 8 and not any(c.isdigit() for c in line)


def finished_line(line: str) -> bool:
    """Whether a line ends as a sentence does."""
    end = line.rstrip(CLOSERS)
    return end != "" and end[-1] in ".?!:;"


def layout(numbered: int, page_numbered: int, indent: int, gap: int, before: int, heading: int, lower: int) -> int:
    """One number for the layout around a line; `before` tells whether the line before is finished."""
    return (((((numbered * 2 + page_numbered) * 3 + indent) * 3 + gap) * 3 + before) * 3 + heading) * 2 + lower


def with_before(value: int, before: int) -> int:
    """The same layout with another kind of line before."""
    return value + (before - value // 6 % 3) * 6


def clear_number(line: str) -> int:
    """1 for a marked page number, 2 for a bare one, 3 for a roman one, else 0."""
    if len(line) > LONGEST_NUMBER and len(line.strip()) > LONGEST_NUMBER:
        return 0
    return 1 if STRONG.match(line) else 2 if BARE.match(line) else 3 if line.strip() and ROMAN.match(line) else 0


def packed(place: int, number: int, top: int, capitals: int, parties: int, around: int) -> int:
    """The features as one number."""
    return ((((place * 4 + number) * 3 + top) * 3 + capitals) * 2 + parties) * SIZES[-1] + around


class Reader:
    """Features and first labels of the lines of pages."""

    def __init__(self, odds: dict[str, float]):
        self.odds = odds
        self.heads = frozenset(k[1:].split(" ", 1)[0] for k in odds if k.startswith(">"))
        self.kinds, self.folded = Kept(word_kind), Kept(lambda w: w.translate(FOLD))

    def top(self, line: str, words: list[str]) -> int:
        """2 if lines of this shape or opening stand mostly at page tops, 0 if they don't, 1 if nothing is known."""
        if len(self.kinds) > FLUSH:
            self.kinds.clear()
            self.folded.clear()
        words = words[:SHAPE]
        seen = None if words and words[0][0].islower() else self.odds.get(" ".join(map(self.kinds.__getitem__, words)))
        if words and self.folded[words[0]] in self.heads and (o := self.odds.get(opening(line))) is not None:
            seen = o if seen is None else max(o, seen)
        return 1 if seen is None else 2 if seen > 1.5 else 0

    def page(self, lines: list[str], words: list[list[str]], x0, gaps, report: bool) -> tuple[list[int], list[int]]:
        """(features as one number, first labels) of each line; words are the lines split at white space."""
        n, out, first = len(lines), [], []
        places = Counter(x0) if x0 is not None else {}
        left = max((x for x in places if x is not None and x == x), key=lambda x: (places[x], -x), default=None)
        starts = [bool(NUMBERED.match(x)) for x in lines]
        page_numbered = int(True in starts)
        note = next((i for i, x in enumerate(lines) if re.match(r"\s*H[a-z!l1]{3}n[a-z0]te", x)), n) if report else 0
        sides = [2] * n if left is None else [2 if x is None or x != x else int(x - left > INDENT) for x in x0[:n]] + [2] * (n - len(x0))
        spaces = [2] * n if gaps is None else [2 if g is None else int(g) for g in gaps[:n]] + [2] * (n - len(gaps))
        blank = packed(0, 0, 1, 0, 0, layout(0, page_numbered, 2, 2, NO_LINE, 0, 0))
        each = packed(1, 0, 0, 0, 0, 0)  # one step of place
        before, before_heading = False, False
        ended = NO_LINE
        for i, line in enumerate(lines):
            place = (6 if i <= note else 7) if report else i if i < 3 else 3 if i == n - 1 else 4 if i == n - 2 else 5
            if not words[i]:
                out.append(blank + place * each)
                first.append(BODY)
                continue
            number = clear_number(line) if len(line) <= LONGEST_NUMBER or line[0].isspace() else 0
            lower = words[i][0][0].islower()
            capitals = 0
            if place != 5 or not lower:
                plain = line.encode("ascii", "replace")
                share = (len(plain) - len(plain.translate(None, CAPITALS))) / (len(plain) - len(words[i]) + 1)
                capitals = 2 if share > 0.55 else 1 if share > 0.28 else 0
            parties = int("v. " in line and " v. " in line or " V. " in line)
            numbered = starts[i]
            # in the midst of a page only lines with many capitals can be like those at page tops, and those begin with one
            top = self.top(line, words[i]) if place != 5 or capitals else 1
            if number and place != 6 and (place != 5 or number == 1) and not (number == 3 and place == 4):
                state = NUMBER
            elif (top == 2 or capitals == 2) and not numbered and (place != 6 or (i == 0 and top == 2)) and (
                (top == 2 and place in (0, 7)) or (capitals == 2 and (top == 2 or place in (0, 7)) and len(words[i]) > 2 and (parties or any(map(str.isdigit, line))))
            ):
                state = HEADER
            else:
                state = BODY
            here = capitals == 2 and heading_line(line)
            heading = 1 if here else 2 if before_heading else 0
            indent, gap = sides[i], spaces[i]
            if state == BODY:
                apart = indent == 1 or gap == 1
                if not before:
                    begins = report or numbered or heading == 1
                else:
                    begins = heading > 0 or (numbered and (apart or ended == DONE)) or (apart and ended == DONE)
                state = BREAK if begins else BODY
            # packed(..., layout(...)), written out
            around = (((((numbered * 2 + page_numbered) * 3 + indent) * 3 + gap) * 3 + ended) * 3 + heading) * 2 + lower
            out.append(((((place * 4 + number) * 3 + top) * 3 + capitals) * 2 + parties) * 648 + around)
            first.append(state)
            if state > NUMBER:
                before, before_heading = True, here
                ended = UNFINISHED if line[-1].isalpha() else DONE if finished_line(line) else UNFINISHED
        return out, first

    def pages(self, pages: list[tuple]):
        """(features, first labels, number of each page's first line, sizes) of pages as `page_of` gives them."""
        import numpy as np

        read = [self.page(*p) for p in pages]
        sizes = np.array([len(f) for f, _ in read], np.int64)
        table_ = np.stack(np.unravel_index(np.array([f for fs, _ in read for f in fs], np.int64), SIZES), axis=1).reshape(-1, len(SIZES))
        return table_, np.array([s for _, ss in read for s in ss], np.int64), np.cumsum(sizes) - sizes, sizes


@dataclass
class Model:
    start: object
    step: object
    emit: list
    odds: dict

    def scores(self, table_):
        """Log-likelihood of each line in each state."""
        return sum(e[:, table_[:, k]] for k, e in enumerate(self.emit)).T

    def path(self, table_, starts, sizes):
        """Most likely states of the lines of all pages, by Viterbi's algorithm over all pages at once."""
        import numpy as np

        order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[order], sizes[order]
        e, out = self.scores(table_), np.full(len(table_), BODY, np.int64)
        most = int(sizes[0]) if len(sizes) else 0
        if not most:
            return out
        longer = np.searchsorted(-sizes, -np.arange(most), side="left")  # pages with more lines than t
        back = np.zeros((len(table_), STATES), np.int8)
        score = np.tile(self.start, (len(sizes), 1))
        score[: longer[0]] += e[starts[: longer[0]]]
        for t in range(1, most):
            k = longer[t]
            each = score[:k, :, None] + self.step[None]
            came = each.argmax(axis=1)
            back[starts[:k] + t] = came
            score[:k] = np.take_along_axis(each, came[:, None, :], axis=1)[:, 0] + e[starts[:k] + t]
        state = score.argmax(axis=1)
        for t in range(most - 1, -1, -1):
            k = longer[t]
            at = starts[:k] + t
            out[at] = state[:k]
            state[:k] = back[at, state[:k]]
        return out

    def labels(self, reader: Reader, pages: list[tuple]):
        """(states, features, starts, sizes) of the lines of pages as `page_of` gives them."""
        table_, _, starts, sizes = reader.pages(pages)
        states = self.path(table_, starts, sizes)
        # in a report's headnote a line that is nothing but a roman number of several letters is no text
        for p, (lines, _, _, _, report) in enumerate(pages):
            if report:
                for i, line in enumerate(lines):
                    if table_[starts[p] + i, 0] == 7 and table_[starts[p] + i, 1] == 3 and len(line.strip()) > 1:
                        states[starts[p] + i] = NUMBER
        return states, table_, starts, sizes

    def begins(self, features, before: int, state_before: int | None, state_after: int | None) -> bool:
        """Whether a line begins a paragraph, if the line before it was of the given kind and its neighbours' states are known."""
        row = features.copy()
        row[-1] = with_before(int(row[-1]), before)
        e = self.scores(row[None])[0]
        into = self.start if state_before is None else self.step[state_before]
        best = [into[s] + e[s] + (0.0 if state_after is None else self.step[s][state_after]) for s in (BREAK, BODY)]
        return bool(best[0] > best[1])


def told(key: str, n: int) -> bool:
    """Whether a key of page tops is frequent enough to count: a shape, or an opening of three words."""
    return n > 4 and key.count(" ") == 2 if key.startswith(">") else n > 2


def odds_of(top: dict[str, int], middle: dict[str, int], size_t: int, size_m: int) -> dict[str, float]:
    """Log-odds of the shapes and openings at page tops against page middles; openings count only if they never stand in the middle."""
    return {s: math.log((n + 0.3) / max(1, size_t)) - math.log((middle.get(s, 0) + 0.3) / max(1, size_m)) for s, n in top.items() if told(s, n) and not (s.startswith(">") and middle.get(s, 0))}


def fit(pages: list[tuple], odds: dict[str, float], rounds: int = ROUNDS) -> Model:
    """Viterbi training from the first labels on pages as `page_of` gives them.

    Counts are smoothed in proportion to the states, so what was never seen speaks for none of them.
    """
    import numpy as np

    table_, states, starts, sizes = Reader(odds).pages(pages)
    inner = np.ones(len(table_), bool)
    inner[starts[sizes > 0]] = False
    at = np.flatnonzero(inner)
    model = None
    for _ in range(rounds):
        if model:
            states = model.path(table_, starts, sizes)
        share = (np.bincount(states, minlength=STATES) + 1) / (len(states) + STATES)
        start = np.bincount(states[starts[sizes > 0]], minlength=STATES) + 1.0
        step = np.bincount(states[at - 1] * STATES + states[at], minlength=STATES * STATES).reshape(STATES, STATES) + share[None]
        emit = [np.bincount(states * k + table_[:, j], minlength=STATES * k).reshape(STATES, k) + SMOOTHING * share[:, None] for j, k in enumerate(SIZES)]
        norm = lambda x: np.log(x / x.sum(axis=-1, keepdims=True))
        model = Model(norm(start), norm(step), [norm(x) for x in emit], odds)
    return model


def _clean(lines) -> list[str]:
    return [x if x is not None else "" for x in lines]


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(record_table, record_id, case_id, page, lines) of the pages and the reports' headers; repeated rows may recur."""
    pages = table(spark, sf_dir, "case_pages").where(F.col("page_id").isNotNull() & F.col("lines").isNotNull())
    reports = table(spark, sf_dir, "law_reports").where(F.col("case_id").isNotNull() & F.col("header").isNotNull())
    return pages.select(
        F.lit("case_pages").alias("record_table"), F.col("page_id").alias("record_id"), "case_id", F.col("page_number").alias("page"), "lines", "x0", "gap"
    ).unionByName(
        reports.select(F.lit("law_reports").alias("record_table"), F.col("case_id").alias("record_id"), "case_id", F.lit(None).cast("int").alias("page"), F.split("header", "\n").alias("lines"), F.lit(None).cast("array<double>").alias("x0"), F.lit(None).cast("array<boolean>").alias("gap"))
    )


def train(rows: DataFrame, odds: dict[str, float], sample: int = SAMPLE) -> Model:
    """Fit on at most about `sample` pages and as many reports, the first by a hash of the id; odds are those of all pages."""
    sizes = {r[0]: r[1] for r in rows.groupBy("record_table").count().collect()}  # two rows
    share = F.lit(0.0)
    for kind, n in sizes.items():
        share = F.when(F.col("record_table") == kind, min(1.0, sample / n)).otherwise(share)
    picked = rows.where(F.pmod(F.xxhash64("record_id"), F.lit(1 << 20)) < (1 << 20) * share)
    got = picked.select("record_table", "lines", "x0", "gap", F.xxhash64("record_id").alias("h")).collect()
    return fit([page_of(*r[:4]) for r in sorted(got, key=lambda r: (r[0], r[4], r[1] or []))], odds)


def page_of(name: str, lines, x0, gaps) -> tuple:
    """(lines, their words, x0, gaps, whether it is a report) of a page."""
    kept = _clean(lines)
    plain = lambda xs: xs.tolist() if hasattr(xs, "tolist") else xs
    return kept, [x.split() for x in kept], plain(x0), plain(gaps), name == "law_reports"


def tops(rows: DataFrame) -> tuple[dict[str, int], int]:
    """(counts, size): how often each shape and opening stands at the top of a page, over all pages, if often enough to count;
    size is the number of all. Combined before the shuffle; what is kept is small beside the pages (a few bytes for a title)."""

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for pdf in batches:
            seen = Counter(k for x in pdf["line"] for k in (shape(x), opening(x)))
            yield pd.DataFrame({"key": list(seen), "n": list(seen.values())})

    lines = rows.where("record_table = 'case_pages' AND size(lines) > 0").select(F.coalesce(F.get("lines", F.lit(0)), F.lit("")).alias("line"))
    each = checkpointed(lines.mapInPandas(run, "key string, n long").groupBy("key").agg(F.sum("n").alias("n")))
    spaces = F.length("key") - F.length(F.replace("key", F.lit(" "), F.lit("")))
    kept = each.where(F.col("key") != NO_SHAPE).where(F.when(F.col("key").startswith(">"), (F.col("n") > 4) & (spaces == 2)).otherwise(F.col("n") > 2))
    return {r[0]: r[1] for r in kept.collect()}, each.agg(F.sum("n")).first()[0] or 0


class Kept(dict):
    """Values of a function, each computed once."""

    def __init__(self, f):
        self.f = f

    def __missing__(self, key):
        self[key] = value = self.f(key)
        return value


def middles(rows: DataFrame, keys: frozenset[str]) -> tuple[dict[str, int], int]:
    """(counts, size): how often each of the `keys` of page tops stands in the middle of a page, over all pages; size is the
    number of all shapes and openings there."""
    send = rows.sparkSession.sparkContext.broadcast(keys)  # frequent shapes and titles only

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        asked = send.value
        heads = frozenset(k[1:].split(" ", 1)[0] for k in asked if k.startswith(">"))
        begins = frozenset(k.split(" ", 1)[0] + "|" + k.split(" ", 2)[1] for k in asked if k.count(" ") > 1 and k[0] != ">")
        brief = frozenset(k for k in asked if k.count(" ") < 2 and k[:1] != ">")
        kinds, folded, seen, size = Kept(word_kind), Kept(lambda w: w.translate(FOLD)), Counter(), 0
        for batch in batches:
            for line in batch.column(0).flatten().to_pylist():
                size += 2
                first = line.split(None, SHAPE)[:SHAPE] if line else []
                if first and folded[first[0]] in heads:
                    key = opening(line)
                    if key in asked:
                        seen[key] += 1
                if first and first[0][0].islower():
                    continue
                if len(first) > 2 and kinds[first[0]] + "|" + kinds[first[1]] not in begins:
                    continue  # no asked shape begins so
                key = " ".join(map(kinds.__getitem__, first))
                if key in (asked if len(first) > 2 else brief):
                    seen[key] += 1
            if len(kinds) > FLUSH:
                kinds.clear()
                folded.clear()
        found = [*seen, ""]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([*seen.values(), size], pa.int64())], ["key", "n"])

    between = F.slice("lines", F.lit(4), F.greatest(F.lit(0), F.size("lines") - 5))
    lines = rows.where("record_table = 'case_pages'").select(between.alias("lines"))
    counted = lines.mapInArrow(run, "key string, n long").groupBy("key").agg(F.sum("n")).collect()  # at most the keys
    got = {r[0]: r[1] for r in counted}
    return got, got.pop("", 0)


#: Mark in a word that was joined over a line end.
JOINED = "\u0001"
#: The end of a line that breaks a word, for the JVM.
BROKEN = r"[-¬=‐\u00ad](?<=[A-Za-zÀ-ɏ’'].)[ \t]*+\n\s*+"


def bare_column(token):
    """`bare` as a Column."""
    word = F.btrim(token, F.lit(STRIP))
    word = F.when(F.ltrim(token, F.lit("“”\"'‘’([{—–")).startswith("!") & word.rlike(r"^\p{L}"), F.concat(F.lit("!"), word)).otherwise(word)
    return F.when(word.endswith("’s"), F.substring(word, F.lit(1), F.length(word) - 2)).otherwise(word)


def spaced(text):
    """A text with blanks for line ends and tabs."""
    return F.replace(F.replace(text, F.lit("\n"), F.lit(" ")), F.lit("\t"), F.lit(" "))


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, n, joined): how often each word stands whole and how often joined over a line end, counted in the JVM with
    partial sums before the shuffle."""
    text = F.regexp_replace(F.array_join("lines", "\n"), BROKEN, JOINED)
    each = rows.select(F.explode(F.split(spaced(text), " ")).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    over_end = F.col("token").contains(JOINED)
    words = each.select(bare_column(F.translate("token", JOINED, "")).alias("word"), "n", over_end.alias("over"))
    known = (F.length("word") > 1) & F.col("word").rlike(r"\p{L}") & F.col("word").rlike(r"^[\x00-}\x7FÀ-ɏ]+$")
    sums = words.groupBy("word").agg(F.sum(F.when(~F.col("over"), F.col("n")).otherwise(0)).alias("n"), F.sum(F.when(F.col("over"), F.col("n")).otherwise(0)).alias("joined"), F.bool_or(known).alias("known"))
    return sums.where("known").drop("known")  # an aggregate, or the optimizer would test every token before they are counted


def misreadings(words: DataFrame) -> DataFrame:
    """(word, correct) of the words that are misreadings of a much more frequent word of the same skeleton."""
    @F.pandas_udf("array<string>")
    def keys(word):
        import pandas as pd

        return pd.Series([skeletons(w) for w in word])

    all_ = F.col("n") + F.col("joined")
    keyed = checkpointed(words.where(F.length("word") > 2).select("word", all_.alias("all"), F.explode(keys("word")).alias("skeleton")))
    sound = keyed.where((F.col("all") >= LEAST) & F.col("word").rlike("^[A-Za-zÀ-ɏ]{3,}$"))
    best = sound.groupBy("skeleton").agg(F.max_by("word", F.struct("all", "word")).alias("correct"), F.max("all").alias("most"))
    rare = keyed.join(best, "skeleton").where((F.col("word") != F.col("correct")) & (F.col("all") * RATIO <= F.col("most")))

    @F.pandas_udf("boolean")
    def near(word, correct):
        import pandas as pd

        out = []
        for a, b in zip(word, correct, strict=True):
            most = 1 if len(b) < 4 else 2 if len(b) < 8 else 4
            out.append(bool(LETTERS.match(a)) and distance(a, b, most) <= most and a.lower() != b.lower())
        return pd.Series(out)

    good = rare.where(near("word", "correct"))
    return good.groupBy("word").agg(F.max_by("correct", F.struct("most", "correct")).alias("correct"))


def scan_lines(rows: DataFrame, model: Model, sure: frozenset[str]) -> DataFrame:
    """Findings and questions of each page: (record_table, record_id, case_id, page, pos, kind, word, tail, tail_pos).

    kind: running_header, page_number and misread (a number) are final; word asks for a misreading; broken asks for word
    and tail, the parts on both lines; open is a broken word at the end of a page; first is the first word of a page.
    """
    send = rows.sparkSession.sparkContext.broadcast((model, sure))  # both of bounded size

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        hmm, known = send.value
        reader = Reader(hmm.odds)
        sound = set(known)  # with the marks around them, as they are met
        for pdf in batches:
            out = []
            pages = [page_of(*r) for r in pdf[["record_table", "lines", "x0", "gap"]].itertuples(index=False)]
            states, _, starts, _ = hmm.labels(reader, pages)
            states = states.tolist()
            if len(sound) > 4 * SURE_WORDS + FLUSH:
                sound = set(known)
            for (name, key, case, page), (lines, split, _, _, report), at in zip(pdf[["record_table", "record_id", "case_id", "page"]].itertuples(index=False), pages, starts.tolist(), strict=True):
                add = lambda pos, kind, word=None, tail=None, at=None: out.append((name, key, case, page, pos, kind, word, tail, at))  # noqa: E731, B023
                carried, from_pos, begun = "", None, False
                for i, line in enumerate(lines):
                    state = states[at + i]
                    if state == HEADER:
                        add(i, "running_header")
                        continue
                    if state == NUMBER:
                        add(i, "page_number")
                        continue
                    words = split[i]
                    if not words:
                        continue
                    m = BREAKS.search(line) if not line[-1].isalpha() and line.rstrip()[-1:] in ENDS else None
                    if carried:
                        f = FIRST.match(line)
                        if f:
                            add(from_pos, "broken", carried, f.group(1), i)
                            words = words[1:]
                        carried = ""
                    elif not begun and not report and (f := FIRST.match(line)):
                        add(i, "first", None, f.group(1), i)
                        words = words[1:]
                    begun = True
                    if m:
                        carried, from_pos = m.group(1), i
                        words = words[:-1] if words[-1].rstrip()[-1:] and line.rstrip().endswith(words[-1]) else words
                    if sound.issuperset(words):
                        continue
                    for w in words:
                        if w in sound:
                            continue
                        b = bare(w)
                        if b in known or len(b) < 2 or "~" in b or not WRITTEN.match(b):
                            sound.add(w)
                        elif NUMERIC.match(b):
                            add(i, "misread")
                        elif any(map(str.isalpha, b)):
                            add(i, "word", b)
                        else:
                            sound.add(w)
                if carried and not report:
                    add(from_pos, "open", carried)
            if out:
                yield pd.DataFrame(out, columns=COLUMNS)

    return rows.select("record_table", "record_id", "case_id", "page", "lines", "x0", "gap").mapInPandas(run, "record_table string, record_id string, case_id string, page int, pos int, kind string, word string, tail string, tail_pos int")


COLUMNS = ["record_table", "record_id", "case_id", "page", "pos", "kind", "word", "tail", "tail_pos"]
PLACE = ["record_table", "record_id", "pos"]


def findings(rows: DataFrame) -> tuple[DataFrame, DataFrame, Model]:
    """(found, corrections, model): found(record_table, record_id, pos, kind); corrections(record_table, record_id, pos,
    word, correct) of misread words.

    rows: record_table, record_id, case_id, page, lines, x0, gap. Null and empty lines are never cases; null x0 and gap
    are features of their own; repeated rows count once in the result; an empty table gives none.
    """
    top, size = tops(rows)
    middle, inner = middles(rows, frozenset(top))
    model = train(rows, odds_of(top, middle, size, inner))
    words = checkpointed(word_counts(rows))
    wrong = checkpointed(misreadings(words))
    sure = words.join(wrong, "word", "left_anti").where("n > 1").where(F.col("word").rlike("^[A-Za-z’'-]+$")).orderBy(F.desc("n"), "word").select("word").limit(SURE_WORDS)
    seen = checkpointed(scan_lines(rows, model, frozenset(r[0] for r in sure.collect())))
    final = seen.where(F.col("kind").isin("running_header", "page_number", "misread")).select(*PLACE, "kind")

    # the first and last words of pages: copies of a page count once, so their groups don't multiply
    first = seen.where("kind = 'first'").select("record_table", "record_id", "case_id", "page", "pos", "tail").distinct()
    next_ = first.select("case_id", (F.col("page") - 1).alias("page"), F.col("record_id").alias("tail_id"), "tail", F.col("pos").alias("tail_pos"))
    across = seen.where("kind = 'open'").select(*PLACE, "case_id", "page", "word").distinct().join(next_, ["case_id", "page"]).select(*PLACE, "word", "tail", "tail_id", "tail_pos")
    broken = seen.where("kind = 'broken'").select(*PLACE, "word", "tail", F.col("record_id").alias("tail_id"), "tail_pos").distinct().unionByName(across)
    taken = across.select(F.lit("case_pages").alias("record_table"), F.col("tail_id").alias("record_id"), F.col("tail_pos").alias("pos")).distinct()
    alone = first.join(taken, PLACE, "left_anti").select(*PLACE, F.col("tail").alias("word"))

    # each distinct pair of halves is judged once, by one join of its four words with what is known of words
    known = words.select("word", "n", (F.col("n") + F.col("joined")).alias("total")).join(wrong, "word", "full_outer")
    halves = broken.select(F.col("word").alias("head"), "tail").distinct()
    roles = F.array(*[F.struct(F.lit(k).alias("role"), w.alias("word")) for k, w in (("whole", F.concat("head", "tail")), ("compound", F.concat_ws("-", "head", "tail")), ("head", F.col("head")), ("tail", F.col("tail")))])
    facts = halves.select("head", "tail", F.explode(roles).alias("r")).select("head", "tail", "r.role", "r.word").join(known, "word", "left")
    of = lambda role, name: F.max(F.when(F.col("role") == role, F.col(name)))
    count = lambda role, name="n": F.coalesce(of(role, name), F.lit(0))
    facts = facts.groupBy("head", "tail").agg(count("whole").alias("n_whole"), count("compound").alias("n_compound"), count("head").alias("n_head"), count("tail").alias("n_tail"), count("whole", "total").alias("total"), of("whole", "correct").alias("correct"))
    own_hyphen = (F.col("n_compound") > F.col("n_whole")) | ((F.col("n_whole") == 0) & F.col("correct").isNull() & (F.least("n_head", "n_tail") >= 10) & (F.col("total") < 10))
    facts = facts.select(F.col("head").alias("word"), "tail", "correct", own_hyphen.alias("own_hyphen"))
    judged = checkpointed(broken.join(facts, ["word", "tail"]))
    lower = F.col("tail").rlike(r"^[\p{Ll}0-9!|]")
    hyphens = judged.where(lower & ~F.col("own_hyphen")).select(*PLACE, F.lit("hyphen").alias("kind"))

    same_head = F.substring(F.col("correct"), F.lit(1), F.length("word")) == F.col("word")
    same_tail = F.expr("right(correct, length(tail))") == F.col("tail")
    whole = F.concat("word", "tail").alias("word")
    at_tail = ["record_table", F.col("tail_id").alias("record_id"), F.col("tail_pos").alias("pos")]
    joined = judged.where(F.col("correct").isNotNull() & ~F.col("own_hyphen"))
    repaired = joined.where(~same_head).select(*PLACE, whole, "correct").unionByName(joined.where(~same_tail).select(*at_tail, whole, "correct"))
    parts = judged.where("own_hyphen")
    pieces = parts.select(*PLACE, "word").unionByName(parts.select(*at_tail, F.col("tail").alias("word")))
    asked = seen.where("kind = 'word'").select(*PLACE, "word").unionByName(alone).unionByName(pieces)
    corrections = asked.join(wrong, "word").select(*PLACE, "word", "correct").unionByName(repaired)
    misread = corrections.select(*PLACE, F.lit("misread").alias("kind"))
    return final.unionByName(hyphens).unionByName(misread).distinct(), corrections.distinct(), model


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _, _ = findings(sources(spark, sf_dir))
    return found.select("record_table", "record_id", F.col("pos").cast("int").alias("pos"), "kind")


DIGITS = str.maketrans("lI!|OoS", "1111005")
FRAGMENTS = "record_table string, record_id string, case_id string, page int, fragment int, nth int, begins int, maybe boolean, finished boolean, text string"


def repaired_line(line: str, fixes: dict[str, str]) -> str:
    """A line with its misread words and numbers put right; marks around the words stay."""
    out = []
    for token in line.split():
        b = bare(token)
        if b in fixes:
            token = token.replace(b, fixes[b], 1)
        elif len(b) > 1 and NUMERIC.match(b):
            token = token.replace(b, b.translate(DIGITS), 1)
        out.append(token)
    return " ".join(out)


def paragraphs(rows: DataFrame) -> DataFrame:
    """(record_table, case_id, nth, page, text): continuous paragraphs of the pages of each case and of the reports' headers.

    rows: as for `findings`. Paragraphs begin at the model's break labels. Headers and page numbers are left out, broken words joined, misread words
    and numbers put right, and paragraphs go on over page ends. Rows of equal id count once; null and empty lines are passed
    over, and pages without lines have no part. Where the text of a page begins in the middle of a paragraph it goes on from the
    page before; a case's pages without a number come first.
    """
    found, corrections, model = findings(rows)
    send = rows.sparkSession.sparkContext.broadcast(model)  # of bounded size
    notes = found.select(*PLACE, "kind", F.lit("").alias("word"), F.lit("").alias("correct")).unionByName(corrections.select(*PLACE, F.lit("fix").alias("kind"), "word", "correct"))
    by = notes.groupBy("record_table", "record_id").agg(F.collect_list(F.struct("pos", "kind", "word", "correct")).alias("notes"))  # within a page
    once = rows.dropDuplicates(["record_table", "record_id"]).join(by, ["record_table", "record_id"], "left")

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        hmm = send.value
        reader = Reader(hmm.odds)
        for pdf in batches:
            out = []
            pages = [page_of(*r) for r in pdf[["record_table", "lines", "x0", "gap"]].itertuples(index=False)]
            states, features, starts, _ = hmm.labels(reader, pages)
            for p, (name, key, case, page, marks) in enumerate(pdf[["record_table", "record_id", "case_id", "page", "notes"]].itertuples(index=False)):
                lines, at = pages[p][0], int(starts[p])
                kinds: dict[int, set[str]] = {}
                fixes: dict[str, str] = {}
                for m in marks if marks is not None else ():
                    kinds.setdefault(m["pos"], set()).add(m["kind"])
                    if m["kind"] == "fix":
                        fixes[m["word"]] = m["correct"]
                report = name == "law_reports"
                parts: list[tuple[int, list[str]]] = []
                maybe, known = False, None
                for i, line in enumerate(lines):
                    state = int(states[at + i])
                    if not line.strip() or state in (HEADER, NUMBER):
                        known = state if line.strip() else known
                        continue
                    if parts:
                        new = state == BREAK
                    elif report:
                        new = True
                    else:  # the first text of a page: whether the page before is finished is known only later
                        after = next((int(states[at + j]) for j in range(i + 1, len(lines)) if lines[j].strip()), None)
                        new = state == BREAK
                        maybe = not new and hmm.begins(features[at + i], DONE, known, after)
                    text = repaired_line(line, fixes)
                    if "hyphen" in kinds.get(i, ()):
                        text = BREAKS.sub(lambda m: m[1], line if not fixes else text) + "\u0001"
                    elif (m := BREAKS.search(line)) and line.rstrip()[-1:] in ENDS:
                        text = text.rstrip() + "\u0001"
                    if new or not parts:
                        parts.append((int(new), [text]))
                    else:
                        parts[-1][1].append(text)
                nth = 0
                for k, (new, texts) in enumerate(parts):
                    nth += new
                    whole = " ".join(texts).replace("\u0001 ", "")
                    if "\u0001" in whole[:-1]:
                        whole = whole[:-1].replace("\u0001", "") + whole[-1]
                    for wrong, right in fixes.items():
                        if len(wrong) > 3 and wrong in whole:
                            whole = re.sub(rf"(?<![\w]){re.escape(wrong)}(?![\w])", right, whole)
                    out.append((name, key, case, page, k, nth, new, maybe and not k, finished_line(whole), whole))
            if out:
                yield pd.DataFrame(out, columns=[x.split()[0] for x in FRAGMENTS.split(", ")])

    parts = checkpointed(once.select("record_table", "record_id", "case_id", "page", "lines", "x0", "gap", "notes").mapInPandas(run, FRAGMENTS))
    pages = parts.groupBy("record_table", "case_id", "record_id", "page").agg(F.sum("begins").alias("n"), F.max("maybe").alias("maybe"), F.max_by("finished", "fragment").alias("finished"))
    order = Window.partitionBy("record_table", "case_id").orderBy("page", "record_id")  # a few bytes a page
    pages = pages.withColumn("extra", (F.col("maybe") & F.coalesce(F.lag("finished").over(order), F.lit(False))).cast("int"))
    before = F.coalesce(F.sum(F.col("n") + F.col("extra")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = pages.select("record_table", "case_id", "record_id", (before + F.col("extra")).alias("base"))
    placed = parts.join(base, ["record_table", "case_id", "record_id"]).withColumn("nth", F.col("base") + F.col("nth"))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("page", "record_id", "fragment", "text"))), lambda x: x["text"])
    joined = F.translate(F.replace(F.array_join(texts, " "), F.lit("\u0001 "), F.lit("")), "\u0001", "")
    return placed.groupBy("record_table", "case_id", "nth").agg(F.min("page").alias("page"), joined.alias("text"))


def p6_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readable paragraphs of the cases' pages and of the reports' headers."""
    return paragraphs(sources(spark, sf_dir))

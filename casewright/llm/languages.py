"""P10: languages of documents and of their segments, by error-correcting output codes.

Each language has a codeword of bits. For each bit a binary logistic classifier over hashed character n-grams tells
on which side of the bit the text's language lies; the decoder takes the codeword with the least total logistic loss
over the bits, and the gap to the next one gives the confidence. The languages are those that documents are labelled with
and that classifiers fitted on one half of the sentences confirm on the other. The final classifiers are fitted on a bounded
sample of labelled documents in two rounds, the second without the sentences whose label the first contradicts. N-grams lie within words, so
a word is scored once and a text is the sum of its words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.tables import one_per_key, table

#: A label names a language of the corpus if at least this share of its held-out sentences is found to be in it.
CONFIRMED = 0.5
BITS, BUCKETS, ORDERS = 16, 1 << 16, (2, 3, 4)
#: Documents of each label, about, that the classifiers are fitted on; sentences of each label at most.
SAMPLE_DOCUMENTS, SAMPLE_SENTENCES = 250, 900
LEAST_WORDS = 4
AMBIGUOUS = 0.97
SCRIPTS = r"[ऀ-ॿ꣠-ꣿ]|[஀-௿]|[؀-ۿݐ-ݿﭐ-﷿ﹰ-﻿]"
#: Words that a full stop follows inside a sentence.
SHORT = frozenset("No Rs v Dr Mr Ms Art Sec Ltd Ors".split())
STOP = re.compile(r"[.।۔॥?!][”\"’»)]*(?=\s|$|[“\"«])|\n+|[“”«»\"]")
PREFIX = re.compile(r"^[\s\W]*(?:\(?\d{1,4}[.)]\s*)?")
WORD = re.compile(r"[^\W\d_]+(?:[’'ऀ-ःऺ-ॏஂா-்‌‍ً-ْ-][^\W\d_]*)*")
ANY_OTHER = re.compile(SCRIPTS)
OTHER = re.compile(r"(?:(?:" + SCRIPTS + r"|[‌‍])+[\s\d,;:()।۔./-]*)+")


@dataclass
class Model:
    weights: object
    bias: object
    codes: object
    languages: tuple[str, ...] = ()


def codebook(n: int, bits: int = BITS):
    """Codewords of n languages as rows of +1 and -1, chosen greedily for the largest least distance."""
    import numpy as np

    rng = np.random.default_rng(7)
    best, best_d = None, -1
    for _ in range(400):
        code = rng.integers(0, 2, (n, bits)) * 2 - 1
        apart = (bits - code @ code.T) // 2 + np.eye(n, dtype=int) * bits
        d = apart.min() if (abs(code.sum(axis=0)) < n - 1).all() else -1
        if d > best_d:
            best, best_d = code, d
    if best is None:  # few languages: all ways to part them in two, in turn
        ways = max(1, 2 ** (n - 1) - 1)
        best = np.array([[1 if ((j % ways + 1) >> k) & 1 else -1 for j in range(bits)] for k in range(n)])
    return best.astype(np.float32)


def features(texts: list[str]):
    """(bucket numbers, text numbers) of the character n-grams of all texts, in order of the texts; an n-gram holds a space
    only at its ends, so a text's n-grams are those of its words."""
    import numpy as np

    joined = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) for t in texts])
    owner = np.repeat(np.arange(len(texts)), sizes)
    blank = joined == 32
    hashes, places, hashed, inside = [], [], joined.astype(np.uint32), np.ones(len(joined), bool)
    for k in range(2, max(ORDERS) + 1):
        n = len(joined) - k + 1
        if n <= 0:
            break
        hashed = (hashed[:n] * np.uint32(0x01000193)) ^ (joined[k - 1 :] * np.uint32(0x9E3779B1))
        inside = inside[:n] & (~blank[k - 2 : k - 2 + n] if k > 2 else True)
        at = np.flatnonzero(inside & (owner[:n] == owner[k - 1 :]) & ~(blank[:n] & blank[k - 1 :]))
        h = hashed[at]
        hashes.append(((h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> np.uint32(16)).astype(np.int64) % BUCKETS)
        places.append(owner[at])
    where, own = np.concatenate(hashes), np.concatenate(places)
    order = np.argsort(own, kind="stable")
    return where[order], own[order]


def sums(texts: list[str], weights):
    """(sum of the n-grams' weights, number of n-grams) of each text."""
    import numpy as np

    out, count = np.zeros((len(texts), BITS), np.float32), np.zeros(len(texts), np.int64)
    where, own = features(texts)
    if len(own):
        starts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        out[own[starts]] = np.add.reduceat(weights[where], starts, axis=0)
        count[own[starts]] = np.diff(np.append(starts, len(own)))
    return out, count


class Scorer:
    """Bit scores of texts as sums over their words, which are scored once."""

    def __init__(self, model: Model, most: int = 200_000):
        import numpy as np

        self.model, self.most = model, most
        self.at: dict[str, int] = {}
        self.rows, self.count = np.zeros((0, BITS), np.float32), np.zeros(0, np.int64)

    def outputs(self, texts: list[list[str]]):
        import numpy as np

        new = list({w for ws in texts for w in ws} - self.at.keys())
        if len(self.at) + len(new) > self.most and self.at:
            self.__init__(self.model, self.most)
            new = list({w for ws in texts for w in ws})
        if new:
            rows, count = sums([f" {w} " for w in new], self.model.weights)
            self.at.update(zip(new, range(len(self.at), len(self.at) + len(new)), strict=True))
            self.rows, self.count = np.concatenate([self.rows, rows]), np.concatenate([self.count, count])
        flat = np.array([self.at[w] for ws in texts for w in ws], np.int64)
        size = np.array([len(ws) for ws in texts])
        starts = np.cumsum(size) - size
        total = np.add.reduceat(self.count[flat], starts)
        return np.add.reduceat(self.rows[flat], starts, axis=0) / np.sqrt(np.maximum(total, 1))[:, None] + self.model.bias


def decode(scores, codes):
    """(language number, confidence, next best) by the least total logistic loss over the bits."""
    import numpy as np

    loss = np.logaddexp(0, -scores[:, None, :] * codes[None]).sum(axis=2)
    order = np.argsort(loss, axis=1)
    p = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
    p /= p.sum(axis=1, keepdims=True)
    return order[:, 0], p[np.arange(len(p)), order[:, 0]], order[:, 1]


def fit_once(texts: list[list[str]], labels, codes, epochs: int = 5, batch: int = 200) -> Model:
    import numpy as np

    model = Model(np.zeros((BUCKETS, BITS), np.float32), np.zeros(BITS, np.float32), codes)
    square = np.full((BUCKETS, BITS), 1e-4, np.float32)
    rng = np.random.default_rng(11)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for i in range(0, len(order), batch):
            part = order[i : i + batch]
            target = codes[labels[part]]
            batch_ = [f" {' '.join(texts[j])} " for j in part]
            total, count = sums(batch_, model.weights)
            scale = 1 / np.sqrt(np.maximum(count, 1))[:, None]
            slope = -target / (1 + np.exp(target * (total * scale + model.bias))) / len(part)
            flat, own = features(batch_)
            by = np.argsort(flat, kind="stable")
            starts = np.flatnonzero(np.append(True, flat[by][1:] != flat[by][:-1]))
            hit = flat[by][starts]
            g = np.add.reduceat((slope * scale).astype(np.float32)[own[by]], starts, axis=0)
            square[hit] += g * g
            model.weights[hit] -= 0.3 * g / np.sqrt(square[hit])
            model.bias -= 0.02 * slope.sum(axis=0)
    return model


def segments(text: str) -> list[tuple[int, int, bool, list[str]]]:
    """(start, end, whole, words) of the stretches of a text that are classified: sentences, parts in quotation marks, and runs
    in another script; whole tells whether it can be a whole sentence."""
    out, start = [], 0
    for m in STOP.finditer(text):
        at = m.start()
        if text[at] == ".":
            word = re.split(r"[\s(\[“.]", text[max(start, at - 8) : at])[-1]
            if word in SHORT or (len(word) == 1 and word.isupper()):
                continue
        _stretch(text, start, m.end(), out)
        start = m.end()
    _stretch(text, start, len(text), out)
    return out


def _stretch(text: str, start: int, end: int, out: list) -> None:
    part = text[start:end]
    if not part.strip():
        return
    if not part.isascii() and ANY_OTHER.search(part):
        runs = [m for m in OTHER.finditer(part) if len(WORD.findall(m.group())) >= LEAST_WORDS]
        latin = re.findall(r"[A-Za-zÀ-ɏ]{2,}", part)
        if runs and len(latin) >= LEAST_WORDS:
            at = 0
            for m in runs:
                _put(text, start + at, start + m.start(), out)
                _put(text, start + m.start(), start + m.end(), out)
                at = m.end()
            _put(text, start + at, end, out)
            return
    _put(text, start, end, out)


def _put(text: str, start: int, end: int, out: list) -> None:
    part = text[start:end]
    body = part[PREFIX.match(part).end() :]
    words = WORD.findall(body.lower())
    if words:
        out.append((start, end, len(words) >= LEAST_WORDS and not body.isupper(), words))


def label_of(column: Column) -> Column:
    """The two-letter code that a label names, in lower case and without a region; null for none."""
    code = F.lower(F.trim(F.split(F.col(column) if isinstance(column, str) else column, "[-_]")[0]))
    return F.when(code.rlike("^[a-z]{2,3}$") & ~code.isin("und", "mul", "zxx", "mis"), code)


def confirmed(texts: list[list[str]], labels: list[str], halves: list[int], sizes: dict[str, int]) -> list[str]:
    """The labels whose sentences of one half are found to be in that language by classifiers fitted on the other half.

    The sample holds as many sentences of each label, so the labels' numbers of documents (sizes) count as odds: sentences that could be
    of either of two labels are those of the more frequent one. A rare label that stands on another language's texts so confirms
    nothing, while a rare language is told by its words, whose evidence exceeds the odds.
    """
    import numpy as np

    names = sorted(set(labels))
    y, half = np.array([names.index(x) for x in labels], int), np.array(halves)
    codes = codebook(len(names))
    train, test = np.flatnonzero(half == 0), np.flatnonzero(half == 1)
    if not len(train) or not len(test):
        return names
    scores = Scorer(fit_once([texts[i] for i in train], y[train], codes, epochs=3)).outputs([texts[i] for i in test])
    loss = np.logaddexp(0, -scores[:, None, :] * codes[None]).sum(axis=2) - np.log([max(1, sizes.get(n, 1)) for n in names])
    found = loss.argmin(axis=1)
    kept = [n for k, n in enumerate(names) if not (y[test] == k).any() or (found[y[test] == k] == k).mean() >= CONFIRMED]
    return kept or names


def fit(docs: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> Model:
    """Fit on about `sample` documents of each label, picked by a hash of the id."""
    import numpy as np

    known = docs.select("doc_id", "text", label_of("lang").alias("label")).where(F.col("label").isNotNull() & (F.length("text") > 20))
    sizes = {r[0]: r[1] for r in known.groupBy("label").count().collect()}  # one row a label
    span = 1 << 30
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(span, span * sample // n))]) if sizes else None
    texts, labels, halves, taken, seen = [], [], [], {}, {}
    if share is not None:
        picked = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(span)) < share[F.col("label")]).select("text", "label", F.xxhash64("doc_id").alias("h"))
        for text, label, _ in sorted(picked.collect(), key=lambda r: (r[2], r[1], r[0])):
            nth = seen[label] = seen.get(label, -1) + 1
            for k, (_, _, whole, words) in enumerate(segments(text)):
                if whole and taken.get(label, 0) < SAMPLE_SENTENCES:
                    taken[label] = taken.get(label, 0) + 1
                    texts.append(words)
                    labels.append(label)
                    halves.append((nth + k) % 2)
    if not texts:
        return Model(np.zeros((BUCKETS, BITS), np.float32), np.zeros(BITS, np.float32), codebook(2), ("und", "und"))
    names = confirmed(texts, labels, halves, sizes)
    use = [i for i, x in enumerate(labels) if x in names]
    texts, y, codes = [texts[i] for i in use], np.array([names.index(labels[i]) for i in use], int), codebook(max(2, len(names)))
    model = fit_once(texts, y, codes, epochs=3)
    agree = np.flatnonzero(decode(Scorer(model).outputs(texts), codes)[0] == y)
    if len(agree):
        model = fit_once([texts[i] for i in agree], y[agree], codes)
    model.languages = tuple(names) if len(names) > 1 else (*names, *names)
    return model


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, segment, start, end, lang, confidence, ambiguous, whole) of each stretch of each text with letters."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        scorer = Scorer(shared.value)
        for pdf in batches:
            rows, texts = [], []
            for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                for k, (a, b, whole, words) in enumerate(segments(text)):
                    rows.append((doc, k, a, b, whole))
                    texts.append(words)
            if not rows:
                continue
            best, sure, _ = decode(scorer.outputs(texts), shared.value.codes)
            out = pd.DataFrame(rows, columns=["doc_id", "segment", "start", "end", "whole"])
            out["lang"] = np.array(shared.value.languages, dtype=object)[best]
            out["confidence"] = sure.astype(float)
            out["ambiguous"] = sure < AMBIGUOUS
            yield out[["doc_id", "segment", "start", "end", "lang", "confidence", "ambiguous", "whole"]]

    letters = docs.where(F.col("text").rlike(r"\p{L}")).select("doc_id", "text")
    kind = dict(docs.dtypes)["doc_id"]
    return letters.mapInPandas(run, f"doc_id {kind}, segment int, start int, end int, lang string, confidence double, ambiguous boolean, whole boolean")


def sentence_languages(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, sentences, chars, confidence): the languages of a document, with its whole sentences in each.

    Ambiguous stretches are no whole sentences. A document with letters but without whole sentences has 0 sentences. Null, empty
    and letterless texts have none. doc_id must be unique; other columns are ignored.
    """
    each = identify(docs, fit(docs))
    by = each.groupBy("doc_id", "lang").agg(
        F.count_if(F.expr("whole AND NOT ambiguous")).alias("sentences"),
        F.sum(F.col("end") - F.col("start")).alias("chars"),
        (F.sum(F.col("confidence") * (F.col("end") - F.col("start"))) / F.sum(F.col("end") - F.col("start"))).alias("confidence"),
    )
    return by


def document_languages(docs: DataFrame) -> DataFrame:
    """(doc_id, label, lang, confidence, languages, status): main language of each document and the state of its label.

    status is right, missing, no language, wrong or mixed; documents without letters are left out.
    """
    by = sentence_languages(docs)
    found = by.groupBy("doc_id").agg(
        F.max_by(F.struct("lang", "confidence"), F.struct(F.col("sentences") > 0, "chars", "lang")).alias("main"),
        F.array_sort(F.collect_set(F.when(F.col("sentences") > 0, F.col("lang")))).alias("whole"),
    )
    labels = docs.select("doc_id", F.col("lang").alias("label"), label_of("lang").alias("code"))
    languages = F.when(F.size("whole") > 0, F.col("whole")).otherwise(F.array("main.lang"))
    joined = found.join(labels, "doc_id").withColumn("languages", languages)
    status = (
        F.when(F.size("languages") > 1, "mixed")
        .when(F.col("label").isNull() | (F.trim("label") == ""), "missing")
        .when(F.col("code").isNull(), "no language")
        .when(F.col("code") != F.col("main.lang"), "wrong")
        .otherwise("right")
    )
    return joined.select("doc_id", "label", "main.lang", "main.confidence", "languages", status.alias("status"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = document_languages(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return docs.where("status <> 'right'").select("doc_id", F.explode("languages").alias("lang"))


def p10_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main language, confidence and state of the label of each document."""
    docs = document_languages(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return docs.select("doc_id", "label", "lang", F.round("confidence", 4).alias("confidence"), F.array_join("languages", ",").alias("languages"), "status")


def joined_segments(each: DataFrame) -> DataFrame:
    """(doc_id, segment, start, end, lang, confidence): neighbouring stretches of one language joined, the least confidence kept."""
    order = Window.partitionBy("doc_id").orderBy("segment")  # the stretches of one document
    new = F.when(F.lag("lang").over(order).eqNullSafe(F.col("lang")), 0).otherwise(1)
    runs = each.withColumn("new", new).withColumn("run", F.sum("new").over(order))
    return runs.groupBy("doc_id", (F.col("run") - 1).cast("int").alias("segment")).agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.first("lang").alias("lang"), F.round(F.min("confidence"), 4).alias("confidence")
    )


def p10_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of one language: neighbouring stretches joined."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return joined_segments(identify(docs, fit(docs)))

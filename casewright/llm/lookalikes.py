"""P5: texts that look the same but differ in their characters.

Words with full-width forms, ligatures, separate accents, letters of another script, invisible characters or unusual
hyphens are matched against the corpus's own ordinary words: a trie of these is traversed by a weighted edit automaton
for which look-alikes and ignorable characters cost nothing and a lost accent costs a little. The cheapest, then most
frequent, spelling is canonical; a word that matches none is normalized by table. Words and vocabulary meet in buckets
of their skeleton, the common form of all spellings that cost nothing, so every match lies within a bucket.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import checkpointed, table
from .encoding import classify, fit, non_ascii, page_entries, sampled

ACCENT_COST, MOST_COST = 0.3, 0.9

#: Letters of other scripts that look like Latin letters.
CONFUSABLE = dict(
    zip(
        "аеорсухіјѕԁԛԝһӏАВЕКМНОРСТХУІЈЅԌԚԜαοορνιυκΑΒΕΖΗΙΚΜΝΟΡΤΥΧϲɡıƖӀ",
        "aeopcyxijsdqwhlABEKMHOPCTXYIJSGQWaoopviukABEZHIKMNOPTYXcgilI",
        strict=True,
    )
)
#: The same for Armenian and Cherokee letters.
CONFUSABLE |= dict(zip("օոսհցյզՕՍՏԼ" "ᎠᎡᎢᎥᎩᎪᎫᎬᎳᎷᎻᎽᏀᏃᏙᏚᏞᏟᏢᏦᏴ", "onuhgjqOUSL" "DRTiyAJEWMHYGZVSLCPKB", strict=True))
#: Letterlike, Roman-numeral and mathematical signs that stand for Latin letters, by rule: their compatibility form is made of those.
SIGNS = {c: k for a, b in ((0x2100, 0x2150), (0x2160, 0x2180), (0x1D400, 0x1D6A6)) for c in map(chr, range(a, b)) if (k := unicodedata.normalize("NFKC", c)).isascii() and k.isalpha() and k != c and c not in "℀℁℅℆℡™℠℻№"}
INVISIBLE = "\u00ad\u180e\u200b\u200c\u200d\u200e\u200f\u202a\u202b\u202c\u202d\u202e\u2060\u2061\u2062\u2063\u2064\u2066\u2067\u2068\u2069\ufeff"
SPACES = "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
HYPHENS = "\u2010\u2011\u2012\u2043\u2212\ufe63\uff0d"
#: Regular expressions, for Java and Python alike, of what makes an entry a candidate.
ODD = "[" + INVISIBLE.replace("\u200c", "").replace("\u200d", "") + SPACES + HYPHENS + "\uff01-\uff5e\ufb00-\ufb06" + "".join(c for c in SIGNS if ord(c) < 0x10000) + "\U0001d400-\U0001d6a5]"
#: Joiners stay between letters of scripts that need them.
JOINER = "(?<![\u0600-\u06ff\u0900-\u0dff])[\u200c\u200d]"
LATIN = "[A-Za-zÀ-ɏ]"
ACCENT = LATIN + "[̀-ͯ]"
OTHER_SCRIPT = "[Ͱ-\u058f\u13a0-\u13ff]"
MIXED = LATIN + OTHER_SCRIPT + "|" + OTHER_SCRIPT + LATIN
SUSPECT = f"{ODD}|{JOINER}|{ACCENT}|{MIXED}"
#: A plain class of all characters that can make an entry suspect: cheap for the JVM; the exact test follows in Python.
COARSE = "[" + INVISIBLE + SPACES + HYPHENS + "\uff01-\uff5e\ufb00-\ufb06\u0300-\u036f\u0370-\u058f\u13a0-\u13ff\u2100-\u218f\U0001d400-\U0001d6a5]"
HAS_LATIN = "[A-Za-zＡ-Ｚａ-ｚÀ-ɏﬀ-ﬆ" + "".join(SIGNS) + "]"
GAP = re.compile(f"[ \n\t{SPACES}]+")
_SUSPECT = re.compile(SUSPECT)
_LATIN = re.compile(HAS_LATIN)
_OTHER = re.compile("[ऀ-෿؀-ۿͰ-ԯ一-鿿]")
_ASCII_WORD = re.compile(r"^[^\w]*([^\W\d_]+(?:[’'-][^\W\d_]+)*)")


def alternatives(token: str) -> list[list[tuple[str, float]]]:
    """For each place of a token, the ordinary strings it may stand for with their costs; ignorable places are left out."""
    out: list[list[tuple[str, float]]] = []
    for i, c in enumerate(token):
        if c in INVISIBLE:
            continue
        if c in HYPHENS:
            out.append([("-", 0.0)])
        elif unicodedata.combining(c) and out:
            options = []
            for text, cost in out[-1]:
                whole = unicodedata.normalize("NFC", text + c)
                options.append((whole, cost) if len(whole) == len(text) else (text + c, cost))
                options.append((text, cost + ACCENT_COST))
            out[-1] = options
        elif c in SIGNS:
            out.append([(SIGNS[c], 0.0)])
        elif c in CONFUSABLE:
            out.append([(CONFUSABLE[c], 0.0), (c, 0.5)])
        elif (k := unicodedata.normalize("NFKC", c)) != c and not unicodedata.combining(k[0]) and ("！" <= c <= "～" or "ﬀ" <= c <= "ﬆ"):
            out.append([(k, 0.0)])
        else:
            out.append([(c, 0.0)])
    return out


def by_table(token: str) -> str:
    """A token normalized place by place: the first, cheapest, string of each."""
    return unicodedata.normalize("NFC", "".join(min(options, key=lambda o: o[1])[0] for options in alternatives(token)))


def skeleton(token: str) -> str:
    """The common form of all spellings that differ by look-alikes, ignorables and accents."""
    if token.isascii():
        return token
    plain = unicodedata.normalize("NFD", by_table(token))
    return "".join(c for c in plain if not unicodedata.combining(c))


class Trie:
    """Ordinary words with their counts."""

    def __init__(self, words: list[tuple[str, int]]):
        self.root: dict = {}
        for word, n in words:
            node = self.root
            for c in word:
                node = node.setdefault(c, {})
            node[""] = node.get("", 0) + n

    def best(self, token: str) -> str | None:
        """The cheapest word that the automaton accepts for the token, the most frequent among equals."""
        places = alternatives(token)
        states: dict[int, tuple[dict, float, str]] = {0: (self.root, 0.0, "")}
        front = [(self.root, 0.0, "")]
        for options in places:
            after: dict[str, tuple[dict, float, str]] = {}
            for node, cost, done in front:
                for text, extra in options:
                    if cost + extra > MOST_COST:
                        continue
                    here = node
                    for c in text:
                        here = here.get(c)
                        if here is None:
                            break
                    else:
                        word = done + text
                        if word not in after or after[word][1] > cost + extra:
                            after[word] = (here, cost + extra, word)
            front = list(after.values())
            if not front:
                return None
        del states
        ends = [(cost, -node[""], word) for node, cost, word in front if "" in node]
        return min(ends)[2] if ends else None


def split_token(token: str) -> tuple[str, str, str]:
    """(marks before, word, marks behind) of a token: the word runs from the first to the last letter."""
    letters = [i for i, c in enumerate(token) if c.isalpha() or unicodedata.combining(c) or c in INVISIBLE]
    if not letters:
        return token, "", ""
    a, b = letters[0], letters[-1] + 1
    return token[:a], token[a:b], token[b:]


def is_suspect(token: str) -> bool:
    """Whether a token is to be matched: it holds a suspect character and is not wholly of another script."""
    if token.isascii() or not _SUSPECT.search(token):
        return False
    return bool(_LATIN.search(token)) or not _OTHER.search(token)


def tokens(text: str) -> list[str]:
    return [t for t in GAP.split(text) if t]


def coarse(text: Column) -> Column:
    """Whether a text holds a character that can make it suspect."""
    return non_ascii(text) & text.rlike(COARSE)


def suspects(entries: DataFrame) -> DataFrame:
    """Entries with their suspect tokens; unusual spaces alone give an entry with none."""

    def run(batches: Iterator) -> Iterator:
        for pdf in batches:
            found, spaced = [], []
            for text in pdf["text"]:
                latin = bool(_SUSPECT.search(text)) and bool(_LATIN.search(text))
                found.append(list(dict.fromkeys(t for t in tokens(text) if is_suspect(t))) if latin else [])
                spaced.append(latin and any(c in SPACES for c in text))
            pdf["tokens"], pdf["spaced"] = found, spaced
            yield pdf[[bool(f) or s for f, s in zip(found, spaced, strict=True)]]

    kinds = ", ".join(f"{n} {t}" for n, t in entries.dtypes)
    return entries.mapInPandas(run, f"{kinds}, tokens array<string>, spaced boolean")


def ordinary_words(texts: DataFrame) -> DataFrame:
    """(word, skeleton, n): the ordinary words of all texts with their counts; tokens are counted in the JVM, with partial
    sums before the shuffle, and only distinct tokens are read."""
    spaced = F.col("text")
    for blank in "\n\t\r":
        spaced = F.replace(spaced, F.lit(blank), F.lit(" "))
    token = F.explode(F.split(spaced, " ")).alias("token")
    each = texts.where(F.col("text").isNotNull()).select(token).groupBy("token").agg(F.count(F.lit(1)).alias("n"))

    def run(batches: Iterator) -> Iterator:
        for pdf in batches:
            found = [m.group(1) if (m := _ASCII_WORD.match(t)) and not _SUSPECT.search(m.group(1)) and not _OTHER.search(m.group(1)) else None for t in pdf["token"]]
            pdf["word"], pdf["skeleton"] = found, [None if w is None else skeleton(w) for w in found]
            yield pdf.loc[pdf["word"].notna(), ["word", "skeleton", "n"]]

    return each.mapInPandas(run, "word string, skeleton string, n long").groupBy("word", "skeleton").agg(F.sum("n").alias("n"))


#: Distinct suspect tokens in a bucket, about.
TOKENS_A_BUCKET = 5000


def canonical_tokens(found: DataFrame, words: DataFrame, buckets: int | None = None) -> DataFrame:
    """(token, canonical) of the distinct suspect tokens of found; the number of buckets follows from that of the tokens."""

    @F.pandas_udf("struct<word:string,skeleton:string>")
    def folded(column):
        import pandas as pd

        parts = [split_token(t)[1] for t in column]
        return pd.DataFrame({"word": parts, "skeleton": [skeleton(p) for p in parts]})

    odd = checkpointed(found.select(F.explode("tokens").alias("token")).distinct())
    buckets = buckets or max(4 * int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")), odd.count() // TOKENS_A_BUCKET)
    odd = odd.select("token", folded("token").alias("f")).select("token", "f.word", "f.skeleton")
    odd = odd.withColumn("bucket", F.pmod(F.xxhash64("skeleton"), F.lit(buckets)))
    near = words.join(odd.select("skeleton").distinct(), "skeleton", "left_semi").withColumn("bucket", F.pmod(F.xxhash64("skeleton"), F.lit(buckets)))

    def match(left, right):
        import pandas as pd

        trie = Trie(list(zip(right["word"], right["n"], strict=True)))
        out = []
        for token in left["token"]:
            before, word, behind = split_token(token)
            out.append((token, by_table(before) + ((trie.best(word) if word else None) or by_table(word)) + by_table(behind)))
        return pd.DataFrame(out, columns=["token", "canonical"])

    return odd.groupBy("bucket").cogroup(near.groupBy("bucket")).applyInPandas(match, "token string, canonical string")


def canonical_texts(entries: DataFrame, texts: DataFrame) -> DataFrame:
    """(record_table, record_id, pos, text, canonical) of the entries whose canonical form differs.

    entries(record_table, record_id, pos, text) are brought to one form, with the words of texts(text) as vocabulary.
    Null and empty texts are left as they are. Repeated entries give one row. Words wholly of another script, and the
    joiners between their letters, stay.
    """
    found = checkpointed(suspects(entries.where(coarse(F.col("text")))).dropDuplicates(["record_table", "record_id", "pos"]))
    key = ["record_table", "record_id", "pos"]
    mapped = (
        found.select(*key, F.explode("tokens").alias("token"))
        .join(canonical_tokens(found, ordinary_words(texts)), "token")
        .where("token <> canonical")
        .groupBy(*key)
        .agg(F.map_from_entries(F.collect_set(F.struct("token", "canonical"))).alias("forms"))
    )

    @F.pandas_udf("string")
    def rewritten(text, forms):
        import pandas as pd

        out = []
        for t, m in zip(text, forms, strict=True):
            m = dict(m) if m is not None else {}
            parts = re.split(f"([ \n\t{SPACES}]+)", t)
            out.append("".join(m.get(p, re.sub(f"[{SPACES}]", " ", p)) for p in parts))
        return pd.Series(out)

    done = found.join(mapped, key, "left").where(F.col("spaced") | F.col("forms").isNotNull())
    return done.select(*key, "text", rewritten("text", "forms").alias("canonical")).where("text <> canonical")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate lines of pages without those that are wrongly decoded."""
    pages = table(spark, sf_dir, "case_pages")
    # few bytes but much work behind: spread by number, which adaptive execution leaves alone
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    odd = checkpointed(page_entries(pages, ("lines",), coarse).repartition(spread, "page_id", "pos").dropDuplicates(["page_id", "pos"]))
    garbled = classify(odd, fit(sampled(pages))).select("page_id", "pos")
    kept = odd.join(garbled, ["page_id", "pos"], "left_anti")
    return kept.select(F.lit("case_pages").alias("record_table"), F.col("page_id").alias("record_id"), "pos", "text")


def _canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = table(spark, sf_dir, "chunks").where(F.col("chunk_id").isNotNull())
    texts = chunks.select(F.lit("chunks").alias("record_table"), F.col("chunk_id").alias("record_id"), F.lit(0).alias("pos"), "text")
    words: Column = F.array_join("lines", "\n")
    vocabulary = chunks.select("text").unionByName(table(spark, sf_dir, "case_pages").select(words.alias("text")))
    return canonical_texts(_lines(spark, sf_dir).unionByName(texts), vocabulary)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _canonical(spark, sf_dir).select("record_table", "record_id", F.col("pos").cast("int").alias("pos"))


def p5_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts and lines that were not in the one form, with that form."""
    return _canonical(spark, sf_dir)

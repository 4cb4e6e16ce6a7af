"""P2: texts decoded with the wrong character encoding.

A multinomial logistic classifier on hashed byte bigrams predicts by which chain of encodings a word was garbled, or
that it is clean. It is trained on the clean words of a bounded sample of the corpus and on the same words garbled by
every chain; it reads words, as right and wrong ones stand side by side in a line. A prediction counts only if the
chain, turned back, decodes strictly somewhere in the text; the runs that do are restored. Texts with replacement
characters have lost their originals and are reported unrestored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table

BUCKETS = 1 << 14
#: Pages of the corpus, about, whose texts the classifier is fitted on.
SAMPLE = 500
STEPS = 120
#: Chains: each step is (encoding of the bytes, encoding they were read with).
CHAINS: dict[str, tuple[tuple[str, str], ...]] = {
    "utf8>cp1252": (("utf-8", "cp1252"),),
    "utf8>latin1": (("utf-8", "latin-1"),),
    "utf8>cp1252 twice": (("utf-8", "cp1252"), ("utf-8", "cp1252")),
    "utf8>latin1 twice": (("utf-8", "latin-1"), ("utf-8", "latin-1")),
    "utf8>mac": (("utf-8", "mac-roman"),),
    "utf8>cp437": (("utf-8", "cp437"),),
    "utf8>cp850": (("utf-8", "cp850"),),
    "utf8>cp1251": (("utf-8", "cp1251"),),
    "utf8>cp1250": (("utf-8", "cp1250"),),
    "utf8>cp1254": (("utf-8", "cp1254"),),
    "utf8>latin9": (("utf-8", "iso8859-15"),),
    "utf8>koi8": (("utf-8", "koi8-r"),),
    "cp1252>latin1": (("cp1252", "latin-1"),),
    "cp1252>octal": (),
}
OCTAL = "cp1252>octal"
#: An octal escape of one of the bytes 0x80 to 0x9F; the leading 2 may have become a 0 or be lost.
ESCAPE = re.compile(r"\\[02]?([0-3][0-7])(?![0-9])|\\[02]([0-3][0-7])")
REPLACED = "replaced"
CLASSES = ["clean", *CHAINS, REPLACED]
LOST = "�"
#: What is left of a closing quotation mark when bytes that cp1252 does not define were dropped on the way.
DROPPED = {"utf8>cp1252": {"â€": "”"}, "utf8>cp1252 twice": {"Ã¢â‚¬": "”", "â€": "”"}}
#: Texts of our own with marks and letters of many scripts, so that small corpora train too.
SEEDS = (
    "He said “the order – as made – isn’t final” … and left",
    "§ 12 of the Act; a sum of ₹1,500 or €20 or £30 was paid — see ‘A’",
    "São Luís, Ångström, Château, Ñandú, Zoë, Françoise, Müller, Björk, Łódź, Dvořák",
    "Él pidió más tiempo; a petição não foi aceita; die Klage wurde für zulässig erklärt",
    "अदालत ने याचिका स्वीकार की और आदेश दिया।",
    "நீதிமன்றம் மனுவை ஏற்றுக்கொண்டது",
    "عدالت نے درخواست منظور کر لی۔",
    "Суд принял решение по делу", "Το δικαστήριο αποφάσισε", "法院作出判决", "ｆｕｌｌ width", "a¬", "½ ± 3° × 2 µm ©",
)


def to_bytes(text: str, codec: str) -> bytes:
    """Bytes of a text in an encoding; control characters and undefined places stand for their own byte."""
    try:
        return text.encode(codec)
    except UnicodeEncodeError:
        out = bytearray()
        for c in text:
            try:
                out += c.encode(codec)
            except UnicodeEncodeError:
                if not 0x80 <= ord(c) <= 0x9F:
                    raise
                out.append(ord(c))
        return bytes(out)


def to_text(data: bytes, codec: str) -> str:
    """Text of bytes in an encoding, undefined bytes as control characters."""
    return "".join(_table(codec)[b] for b in data)


@lru_cache
def _table(codec: str) -> tuple[str, ...]:
    return tuple(bytes([b]).decode(codec, "ignore") or chr(b) for b in range(256))


def garble(text: str, chain: str) -> str | None:
    """The text as the chain leaves it; None if it can't or doesn't change."""
    if chain == REPLACED:
        out = "".join(c if c.isascii() else LOST * len(c.encode()) for c in text)
        return out if out != text else None
    if chain == OCTAL:
        out = "".join(_spelled(c, i) for i, c in enumerate(text))
        return out if out != text else None
    try:
        out = text
        for right, wrong in CHAINS[chain]:
            out = to_text(out.encode(right), wrong)
        return out if out != text else None
    except UnicodeEncodeError:
        return None


def _spelled(c: str, i: int) -> str:
    """A character of cp1252's upper rows as an octal escape, in one of the three spellings by its place."""
    try:
        byte = c.encode("cp1252")[0]
    except UnicodeEncodeError:
        return c
    return "\\" + ("2", "0", "")[i % 3] + f"{byte - 0x80:02o}" if 0x80 <= byte <= 0x9F else c


def _unspelled(text: str) -> str | None:
    """The text with its octal escapes read as bytes of cp1252; None if there are none that it defines."""

    def read(m: re.Match) -> str:
        return bytes([0x80 + int(m[1] or m[2], 8)]).decode("cp1252", "ignore") or m[0]

    out = ESCAPE.sub(read, text)
    return out if out != text else None


def _undo(run: str, chain: str) -> str | None:
    try:
        for right, wrong in reversed(CHAINS[chain]):
            data = to_bytes(run, wrong)
            run = data.decode(right)
            if right != "utf-8" and any(0x80 <= ord(c) <= 0x9F for c in run):
                return None
    except UnicodeError:
        return None
    return run


def invert(text: str, chain: str) -> str | None:
    """The text with every run of non-ASCII characters turned back that decodes strictly; None if none does."""
    if chain == OCTAL:
        return _unspelled(text)
    out, done, i, n = [], False, 0, len(text)
    while i < n:
        if text[i] < "\x80":
            j = i + 1
            while j < n and text[j] < "\x80":
                j += 1
            out.append(text[i:j])
            i = j
            continue
        j = i + 1
        while j < n and text[j] >= "\x80":
            j += 1
        run = text[i:j]
        back = _undo(run, chain)
        if back is None:
            back = _partly(run, chain)
        if back is not None and back != run:
            done = True
            out.append(back)
        else:
            out.append(run)
        i = j
    return "".join(out) if done else None


def _partly(run: str, chain: str) -> str | None:
    """A run of which only parts decode: the longest pieces from left to right. No character takes more than 16 in any
    chain (4 bytes, each of at most 3 bytes the second time), so a longer run is one of several pieces."""
    out, i, done = [], 0, False
    while i < len(run):
        for j in range(min(len(run), i + 16), i + 1, -1):
            back = _undo(run[i:j], chain)
            if back is not None and back != run[i:j] and len(back) < j - i:
                out.append(back)
                i, done = j, True
                break
        else:
            left = next((k for k in DROPPED.get(chain, ()) if run.startswith(k, i)), None)
            out.append(DROPPED[chain][left] if left else run[i])
            i += len(left or "1")
            done = done or left is not None
    return "".join(out) if done else None


def words(text: str) -> list[str]:
    """The words of a text that hold other than ASCII characters or a backslash."""
    return [w for w in text.split(" ") if not w.isascii() or "\\" in w]


def features(texts: list[str]):
    """(bucket numbers, text numbers) of the byte bigrams that hold a non-ASCII byte or a backslash."""
    import numpy as np

    data = [b"\n" + t.encode("utf-8", "surrogatepass") + b"\n" for t in texts]
    joined = np.frombuffer(b"".join(data), np.uint8)
    sizes = np.array([len(d) for d in data])
    owner = np.repeat(np.arange(len(data)), sizes)
    a, b = joined[:-1].astype(np.uint32), joined[1:].astype(np.uint32)
    keep = np.flatnonzero(((a | b) & 0x80).astype(bool) | (a == 0x5C) | (b == 0x5C))
    a, b = a[keep], b[keep]
    return ((a * 257 + b) * np.uint32(2654435761) >> np.uint32(18)).astype(np.int64) % BUCKETS, owner[keep]


@dataclass
class Model:
    weights: object
    bias: object

    def scores(self, texts: list[str]):
        """Log-odds of each class for each text."""
        import numpy as np

        where, owner = features(texts)
        out = np.tile(self.bias, (len(texts), 1))
        if len(where):
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            out[owner[starts]] += np.add.reduceat(self.weights[where], starts, axis=0)
        return out


def has_lost(text: str) -> bool:
    return LOST in text


def fit(texts: list[str], steps: int = STEPS) -> Model:
    """Fit on texts of the corpus (those that any chain inverts are left out) and their garbled forms."""
    import numpy as np

    seen = dict.fromkeys(w for t in (*SEEDS, *texts) for w in words(t))
    clean = [w for w in seen if not has_lost(w) and not any(invert(w, c) for c in CHAINS)]
    rows, labels = list(clean), [0] * len(clean)
    taken = set(clean)
    for k, chain in enumerate(CLASSES[1:], 1):
        for t in clean:
            if (g := garble(t, chain)) and (chain == OCTAL or not g.isascii()) and g not in taken:  # what several chains leave is the first's
                taken.add(g)
                rows.append(g)
                labels.append(k)
                if short := next((v for v in DROPPED.get(chain, ()) if v in g), None):
                    rows.append(g[: g.index(short) + len(short)])
                    labels.append(k)
    where, owner = features(rows)
    y = np.array(labels)
    starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    present = owner[starts]
    size = np.bincount(y, minlength=len(CLASSES)).clip(1)
    each = (len(y) / len(CLASSES) / size)[y]
    w, bias = np.zeros((BUCKETS, len(CLASSES)), np.float32), np.zeros(len(CLASSES), np.float32)
    square, square_b = np.full_like(w, 1e-6), np.full_like(bias, 1e-6)
    order = np.argsort(where, kind="stable")
    by_bucket = np.flatnonzero(np.append(True, where[order][1:] != where[order][:-1]))
    for _ in range(steps):
        z = np.tile(bias, (len(y), 1))
        z[present] += np.add.reduceat(w[where], starts, axis=0)
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        p *= (each / len(y))[:, None]
        g = np.zeros_like(w)
        g[where[order][by_bucket]] = np.add.reduceat(p[owner[order]], by_bucket, axis=0)
        square += g * g
        w -= 0.3 * g / np.sqrt(square)
        gb = p.sum(axis=0)
        square_b += gb * gb
        bias -= 0.3 * gb / np.sqrt(square_b)
    return Model(w, bias.astype(np.float32))


def non_ascii(text: Column) -> Column:
    return F.octet_length(text) != F.length(text)


def may_be_garbled(text: Column) -> Column:
    """Whether a text holds what any chain leaves: other than ASCII characters, or a backslash with a digit."""
    return non_ascii(text) | (text.contains("\\") & text.rlike(r"\\[0-3]"))


def page_entries(pages: DataFrame, fields: tuple[str, ...] = ("lines", "footnotes"), keep=may_be_garbled) -> DataFrame:
    """(page_id, field, pos, text): the entries of the array columns for which keep holds; filtered before they are exploded."""
    found = None
    for f in fields:
        kept = F.filter(F.transform(F.col(f), lambda x, i: F.struct(i.alias("pos"), x.alias("text"))), lambda e: keep(e["text"]))
        rows = pages.where(F.col("page_id").isNotNull()).select("page_id", F.lit(f).alias("field"), F.explode(kept).alias("e")).select("page_id", "field", "e.pos", "e.text")
        found = rows if found is None else found.unionByName(rows)
    return found


def sampled(pages: DataFrame, n: int = SAMPLE) -> list[str]:
    """The texts that may be garbled on about n pages, picked by a hash of the page."""
    span = 1 << 30
    share = int(span * min(1.0, n / max(1, pages.count())))
    some = pages.where(F.pmod(F.xxhash64("page_id"), F.lit(span)) < share)
    return sorted({r[0] for r in page_entries(some).select("text").collect()})


def classify(entries: DataFrame, model: Model) -> DataFrame:
    """Entries that hold wrongly decoded text, with chain and restored (null where nothing could be restored)."""
    shared = entries.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches: Iterator) -> Iterator:
        import numpy as np

        known: dict[str, list[int]] = {}
        for pdf in batches:
            if not len(pdf):
                continue
            texts = pdf["text"].tolist()
            split = [words(t) for t in texts]
            new = list({w for ws in split for w in ws} - known.keys())
            if len(known) > 200_000:
                known.clear()
                new = list({w for ws in split for w in ws})
            if new:
                scores = shared.value.scores(new)
                p = np.exp(scores - scores.max(axis=1, keepdims=True))
                garbled = p[:, 0] < 0.5 * p.sum(axis=1)
                order = 1 + np.argsort(-p[:, 1:], axis=1, kind="stable")  # every chain, the likeliest first
                known.update((w, o if g else []) for w, o, g in zip(new, order.tolist(), garbled, strict=True))
            chains, restored = [None] * len(texts), [None] * len(texts)
            for i, ws in enumerate(split):
                for k in dict.fromkeys(k for w in ws for k in known[w]):
                    name = CLASSES[k]
                    if name != REPLACED and (back := invert(texts[i], name)):
                        # of chains that leave the same text, the first stands for all
                        chains[i] = next(c for c in CHAINS if c == name or invert(texts[i], c) == back)
                        restored[i] = back
                        break
                if chains[i] is None and has_lost(texts[i]):
                    chains[i] = REPLACED
            pdf["chain"], pdf["restored"] = chains, restored
            yield pdf[pdf["chain"].notna()]

    kinds = ", ".join(f"{n} {t}" for n, t in entries.dtypes)
    return entries.mapInPandas(run, f"{kinds}, chain string, restored string")


def find_garbled(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(page_id, field, pos, text, chain, restored) of the entries of lines and footnotes that are wrongly decoded.

    Null arrays, null and empty entries and plain ASCII entries without escapes are never cases. Repeated rows give repeated results; an
    empty table gives none. Other columns are ignored.
    """
    return classify(page_entries(pages), fit(sampled(pages, sample)))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_garbled(table(spark, sf_dir, "case_pages")).select("page_id", "field", "pos").distinct()


def p2_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entries with their chain and the text restored as far as it survives."""
    return find_garbled(table(spark, sf_dir, "case_pages")).dropDuplicates(["page_id", "field", "pos"])

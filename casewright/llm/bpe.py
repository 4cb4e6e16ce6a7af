"""P8: ids of a byte-level BPE for a whole corpus, with Spark higher-order functions.

Texts are cut into words by the tokenizer's pattern. Each distinct word of a task is merged once: a fold over its
bytes joins, at every step, the adjacent pair whose joined bytes have the lowest rank. Ranks are a literal in the plan:
an array of small maps, chosen by a hash of the bytes, as a lookup in one literal map is a scan.

Nothing is shuffled, collected or broadcast but the vocabulary file. A task's rows run through one stream: the first
step numbers the words and sends each new word ahead of the text in which it stands, the fold in the JVM merges the
words as they pass, and the last step turns the numbers into ids. The plan is the same at every size.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import table

TOKENIZERS = "/opt/tokenizers"
#: The tokenizer's word pattern, with Unicode white space spelled for Java.
WS = r"\p{IsWhite_Space}"
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + WS + r"\p{L}\p{N}]+|" + WS + r"+(?!" + r"[^" + WS + r"]" + r")|" + WS + r"+"
SLOTS = 16384
#: Words of more bytes than this are merged by a heap in Python: the fold takes time square in the length.
LONG_WORD = 96
#: Distinct words that a task holds at most; beyond, it begins anew (a word met again is merged again).
HELD = 1_000_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a .tiktoken file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _slot(piece: Column) -> Column:
    return F.pmod(F.crc32(F.encode(piece, "UTF-8")), F.lit(SLOTS)).cast("int") + 1


def rank_literal(ranks: dict[bytes, int], slots: int = SLOTS) -> Column:
    """The ranks as one foldable array of maps; a piece is a string of one character (0 to 255) a byte."""
    import zlib

    maps: list[dict[str, int]] = [{} for _ in range(slots)]
    for piece, rank in ranks.items():
        s = piece.decode("latin-1")
        maps[zlib.crc32(s.encode()) % slots][s] = rank
    return F.from_json(F.lit(json.dumps(maps)), "array<map<string,int>>")


def rank_of(piece: Column, literal: Column) -> Column:
    """Rank of a piece, null where it is no token."""
    return F.try_element_at(F.element_at(literal, _slot(piece)), piece)


def merge_word(word: Column, literal: Column) -> Column:
    """Pieces of a word after all merges, as an array of byte strings."""
    bytes_ = F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")
    start = F.struct(
        F.filter(F.split(bytes_, ""), lambda x: x != "").alias("p"), F.lit(False).alias("done")
    )

    def step(acc: Column, _: Column) -> Column:
        p = acc["p"]
        ranks = F.transform(
            F.sequence(F.lit(1), F.size(p) - 1), lambda j: rank_of(F.concat(F.element_at(p, j), F.element_at(p, j + 1)), literal)
        )
        return F.when(acc["done"] | (F.size(p) < 2), F.struct(p.alias("p"), F.lit(True).alias("done"))).otherwise(
            F.aggregate(
                F.array(F.struct(ranks.alias("r"))),
                acc,
                lambda a, r: F.when(F.array_min(r["r"]).isNull(), F.struct(a["p"].alias("p"), F.lit(True).alias("done"))).otherwise(
                    F.aggregate(
                        F.array(F.array_position(r["r"], F.array_min(r["r"])).cast("int")),
                        a,
                        lambda b, at: F.struct(
                            F.concat(
                                F.slice(b["p"], F.lit(1), at - 1),
                                F.array(F.concat(F.element_at(b["p"], at), F.element_at(b["p"], at + 1))),
                                F.slice(b["p"], at + 2, F.size(b["p"])),
                            ).alias("p"),
                            F.lit(False).alias("done"),
                        ),
                    )
                ),
            )
        )

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.octet_length(word), F.lit(1))), start, step, lambda a: a["p"])


def heap_merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for a long word, in time n log n: a heap of pairs over a linked list."""
    import heapq

    n = len(word)
    parts = [word[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, parts[i] + parts[i + 1]) for i in range(n - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, joined = heapq.heappop(heap)
        j = after[i]
        if not parts[i] or j >= n or parts[i] + parts[j] != joined:
            continue
        parts[i], parts[j] = joined, b""
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < n and (r := ranks.get(parts[a] + parts[b])) is not None:
                heapq.heappush(heap, (r, a, parts[a] + parts[b]))
    return [ranks[p] for p in parts if p]


def tokens_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, words): the words of each text by the tokenizer's pattern, in order."""
    return docs.select(key, F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(WORDS), F.lit(0)).alias("words"))


def numbered(tokens: DataFrame, held: int = HELD) -> DataFrame:
    """(doc, codes, word): each row of tokens with its words as numbers, behind a row for each word that is new in the task.

    A word's number is its place among the words since the last row that has neither codes nor a word.
    """
    schema = T.StructType([T.StructField("doc", tokens.schema["doc"].dataType), T.StructField("codes", T.ArrayType(T.IntegerType())), T.StructField("word", T.StringType())])

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        places: dict[str, int] = {}
        for batch in batches:
            doc, words = batch.column(0), batch.column(1)
            ends = words.offsets.to_numpy()
            coded = words.flatten().dictionary_encode()
            here = coded.dictionary.to_pylist()
            begin = len(places) + len(here) > held and bool(places)
            if begin:
                places.clear()
            before = len(places)
            at = np.array([places.setdefault(w, len(places)) for w in here], np.int32)
            new = [w for w, k in zip(here, at.tolist(), strict=True) if k >= before]
            ahead = pa.array([None] * begin + new, pa.string())
            yield pa.RecordBatch.from_arrays([pa.nulls(len(ahead), doc.type), pa.nulls(len(ahead), pa.list_(pa.int32())), ahead], ["doc", "codes", "word"])
            codes = at[coded.indices.to_numpy(zero_copy_only=False)] if len(here) else np.zeros(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends - ends[0], pa.int32()), pa.array(codes, pa.int32()))
            yield pa.RecordBatch.from_arrays([doc, lists, pa.nulls(len(doc), pa.string())], ["doc", "codes", "word"])

    return tokens.mapInArrow(run, schema)


def attached(merged: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """(doc, ids) from rows (doc, codes, ids, long): a row with ids, or with a long word's text, is the next word."""
    shared = merged.sparkSession.sparkContext.broadcast(ranks)  # the vocabulary file: of fixed size
    schema = T.StructType([T.StructField("doc", merged.schema["doc"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        flat, count = np.zeros(1 << 16, np.int32), 0  # the ids of all words one behind the other
        first, words = np.zeros(1 << 16, np.int64), 0  # the place of each word's first id

        def put(ids, sizes) -> None:
            nonlocal flat, count, first, words
            while count + len(ids) > len(flat):
                flat = np.concatenate([flat, np.zeros_like(flat)])
            while words + len(sizes) >= len(first):
                first = np.concatenate([first, np.zeros_like(first)])
            flat[count : count + len(ids)] = ids
            first[words + 1 : words + 1 + len(sizes)] = count + np.cumsum(sizes)
            count, words = count + len(ids), words + len(sizes)

        for batch in batches:
            doc, codes, ids, long = (batch.column(k) for k in range(4))
            is_doc = np.asarray(codes.is_valid())
            is_long = np.asarray(long.is_valid())
            is_word = np.asarray(ids.is_valid()) | is_long
            kinds = np.where(is_doc, 0, np.where(is_long, 2, np.where(is_word, 1, 3)))
            cuts = np.flatnonzero(np.diff(kinds)) + 1
            for a, b in zip(np.append(0, cuts).tolist(), np.append(cuts, len(kinds)).tolist(), strict=True):
                if a == b:
                    continue
                if kinds[a] == 3:
                    count = words = 0
                elif kinds[a] == 2:
                    for w in long.slice(a, b - a).to_pylist():
                        merged_ids = heap_merge(w.encode(), shared.value)
                        put(np.array(merged_ids, np.int32), np.array([len(merged_ids)]))
                elif kinds[a] == 1:
                    part = ids.slice(a, b - a)
                    put(part.flatten().to_numpy(), np.diff(part.offsets.to_numpy()))
                else:
                    part = codes.slice(a, b - a)
                    at, ends = part.flatten().to_numpy(), part.offsets.to_numpy()
                    sizes = first[at + 1] - first[at]
                    total = np.concatenate([[0], np.cumsum(sizes)])
                    gather = np.repeat(first[at] - total[:-1], sizes) + np.arange(total[-1])
                    offsets = pa.array(total[ends - ends[0]], pa.int32())
                    yield pa.RecordBatch.from_arrays([doc.slice(a, b - a), pa.ListArray.from_arrays(offsets, pa.array(flat[gather], pa.int32()))], ["doc", "ids"])

    return merged.mapInArrow(run, schema)


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken", held: int = HELD) -> DataFrame:
    """(key, ids) for each row of docs, without special tokens.

    A null and an empty text get the empty list. Text that looks like a special token is ordinary text. Keys may repeat or
    be null: there is one row for each row of docs. Other columns are ignored, whatever their names. `held` only bounds
    what a task keeps in memory.
    """
    ranks = load_ranks(path)
    literal = rank_literal(ranks)
    tokens = tokens_of(docs.select(F.col(key).alias("doc"), F.col(text).alias("text")), "doc", "text")
    stream = numbered(tokens, held)
    short = F.col("word").isNotNull() & (F.octet_length("word") <= LONG_WORD)
    ids = F.when(short, F.transform(merge_word(F.col("word"), literal), lambda p: rank_of(p, literal)))
    merged = stream.select("doc", "codes", ids.alias("ids"), F.when(F.col("word").isNotNull() & ~short, F.col("word")).alias("long"))
    return attached(merged, ranks).select(F.col("doc").alias(key), "ids")


def token_counts(docs: DataFrame, key: str, text: str, path: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken") -> DataFrame:
    """(key, tokens): the number of ids of each text."""
    return encode(docs, key, text, path).select(key, F.size("ids").cast("long").alias("tokens"))


def decode(encoded: DataFrame, key: str = "doc_id", ids: str = "ids", path: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken") -> DataFrame:
    """(key, text): the ids' byte strings, joined and read as UTF-8. An empty list gives the empty text; null stays null."""
    ranks = load_ranks(path)
    pieces: list[str] = [""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece.decode("latin-1")
    literal = F.from_json(F.lit(json.dumps(pieces)), "array<string>")
    joined_ = F.array_join(F.transform(F.col(ids), lambda i: F.element_at(literal, i + 1)), "")
    return encoded.select(key, F.decode(F.encode(joined_, "ISO-8859-1"), "UTF-8").alias("text"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))


def p8_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose decoded ids differ from their text (none), counted with the whole."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("was"))
    back = decode(encode(table(spark, sf_dir, "documents")))
    return docs.join(back, "doc_id").agg(
        F.count(F.lit(1)).alias("documents"), F.count_if(F.col("was") == F.col("text")).alias("restored")
    )

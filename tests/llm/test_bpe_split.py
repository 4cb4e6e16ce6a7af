import tiktoken
from pyspark.sql import functions as F

from casewright.llm import bpe, split

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
TEXTS = [
    None, "", " ", "\n\n  x ", "Hello world's end, they'll go.", "न्यायालय ने §12  का आदेश", "🙂🙂 é é", "<|endoftext|> is text", "a" * 5000, "ab " * 3000,
    "https://x.y/" + "qz9" * 200, "tab\tand nbsp　wide  ", "Hello world's end, they'll go.", " line", "1234567890" * 30,
]


def expected(text):
    enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.load_ranks(f"{bpe.TOKENIZERS}/byte_bpe_50k.tiktoken"), special_tokens={})
    return enc.encode_ordinary(text) if text else []


def test_ids_and_round_trip(spark):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)], "doc_id long, text string, words string")
    df = df.repartition(2)
    for held in (bpe.HELD, 40, 1):  # a task begins anew with its words never, sometimes, always
        got = bpe.encode(df, held=held)
        assert got._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1  # the repartition above
        rows = {r[0]: r[1] for r in got.collect()}
        assert rows == {i: expected(t) for i, t in enumerate(TEXTS)}
        back = {r[0]: r[1] for r in bpe.decode(got).collect()}
        assert back == {i: t or "" for i, t in enumerate(TEXTS)}
    assert bpe.encode(df.where("false")).count() == 0
    twice = bpe.encode(df.union(df).withColumn("doc_id", F.lit(None).cast("long")))
    assert twice.count() == 2 * len(TEXTS)  # a row for each row, whatever the keys


def test_any_vocabulary(spark):
    path = f"{bpe.TOKENIZERS}/byte_bpe_multi_50k.tiktoken"
    enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={p: r + 900_000 for p, r in bpe.load_ranks(path).items()}, special_tokens={})
    old = bpe.load_ranks
    bpe.load_ranks = lambda p: {k: r + 900_000 for k, r in old(p).items()}  # ids beyond 17 bits
    try:
        df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string")
        assert {r[0]: r[1] for r in bpe.encode(df, path=path).collect()} == {i: enc.encode_ordinary(t) if t else [] for i, t in enumerate(TEXTS)}
    finally:
        bpe.load_ranks = old


def test_split_limits_and_round_trip():
    texts = ["Word one two. " * 400, "x" * 9000, "a|b~" * 2000, "Clause one; clause two, and more " * 200, "Sentence number one is here.\n" * 300, "é" * 4000, "One. " * 1000]
    for t in texts:
        pieces = split.split_text(t)
        assert "".join(t[a + s : b] for a, b, s, _ in pieces) == t
        assert all(split.tokens(b - a) <= split.MAX_TOKENS for a, b, _, _ in pieces) and len(pieces) > 1
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pieces, pieces[1:], strict=False))
    assert all(p == split.SENTENCE for *_, p in split.split_text("Word one two. " * 400)[:-1])
    shared = [t_[2] for t_ in split.split_text("Word one two three four. " * 200)]
    assert shared[0] == 0 and all(s == 50 for s in shared[1:])
    assert [split.tokens(n) for n in (0, 2, 10, 1538, 1539)] == [1, 1, 2, 384, 385]
    assert len(split.split_text("x" * 1538)) == 1 and len(split.split_text("x" * 1539)) == 2


def test_split_frame(spark):
    rows = [("a", "x" * 1539, 1), ("a", "x" * 1539, 2), ("b", None, 1), ("c", "", 1), ("d", "short", 1), (None, "y" * 5000, 1)]
    df = spark.createDataFrame(rows, "id string, text string, piece int")
    got = split.split_long(df, "id", "text").collect()
    by = {}
    for r in got:
        by.setdefault(r["record_id"], []).append(r)
    assert sorted(by) == ["a", "c", "d"] and len(by["a"]) == 2 and by["c"][0]["tokens"] == 1
    assert split.split_long(df.where("false"), "id", "text").count() == 0
    assert df.where(split.token_column(F.col("text")) > 384).count() == 3

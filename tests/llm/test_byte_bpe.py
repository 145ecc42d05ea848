"""Byte-level BPE by tree reduction against the public tokenizer library, plain merging, and its defined cases."""

import base64
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from obskit.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def bpe():
    with open(PATH, "rb") as f:
        return byte_bpe.ByteBpe.parse(f.read(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(bpe):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


def samples():
    rng = random.Random(11)
    parts = ["a", "b", "ab", "é", "the", "ing", "中", "!", "\n", " ", "0", "  ", "ß", "x" * 9, "<|endoftext|>", "　", "\x00", "🙂"]
    yield from ("", " ", "'s", "don't", "\r\n\t", "a" * 3000, "é" * 999, "ab" * 1501, "!?" * 700, "0123456789" * 90, " " * 500 + "x")
    for _ in range(400):
        yield "".join(rng.choice(parts) for _ in range(rng.randint(1, 120)))
    for _ in range(100):
        yield "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(100, 900)))
        yield "".join(rng.choice("abcxyzä") for _ in range(rng.randint(1, 4))) * rng.randint(1, 400)


def test_tokens_equal_the_library(bpe, library):
    for text in samples():
        ids = bpe.encode(text).tolist()
        assert ids == library.encode_ordinary(text)
        assert bpe.decode(ids) == text.encode()


def test_tree_equals_plain_merging_for_any_ranks(monkeypatch):
    """Ranks drawn at random, so tokens exist that no merge reaches and that merge out of order."""
    monkeypatch.setattr(byte_bpe, "LEAF", 2)
    for seed in range(150):
        rng = random.Random(seed)
        words = {bytes([c]) for c in b"abc"} | {bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 6))) for _ in range(rng.randint(3, 60))}
        order = rng.sample(sorted(words), len(words))
        own = byte_bpe.ByteBpe({w: i for i, w in enumerate(order)}, ".")
        for _ in range(20):
            data = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 90)))
            plain = own._queued(data)
            assert own.tokens(data) == plain == own._scanned(data)
            cut = rng.randint(0, len(data))
            assert own.join(own.tokens(data[:cut]), own.tokens(data[cut:])) == plain


def test_joins_look_at_few_tokens_of_plain_text(bpe):
    seen = []
    merged = bpe.merged
    bpe.merged = lambda data: (seen.append(len(data)), merged(data))[1]
    word = "".join(random.Random(2).choice("etaoinshrdlu") for _ in range(1 << 14)).encode()
    bpe.tokens(word)
    del bpe.merged
    assert sum(seen) < 4 * len(word)


def test_columns_and_defined_cases(spark, library):
    rows = [(1, "Hello world", 5), (2, None, None), (3, "", 1), (3, "", 1), (None, "ünï " * 50_000, 2), (4, "b" * 300_000, 3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, token_ids int").withColumns({"row": F.lit(1), "new": F.lit("n"), "ids": F.lit(0)})
    out = byte_bpe.decode(byte_bpe.encode(df))
    assert [c for c in out.columns if c != "decoded"] == [*[c for c in df.columns if c != "token_ids"], "token_ids"]
    got = out.collect()
    assert len(got) == 6
    for r in got:
        assert bytes(r.decoded).decode() == (r.text or "") and r.token_ids == library.encode_ordinary(r.text or "") and r.new == "n"
    assert byte_bpe.encode(df.limit(0)).count() == 0
    assert bytes(byte_bpe.decode(spark.createDataFrame([(None,)], "token_ids array<int>")).first().decoded) == b""


def test_query_matches_the_library(spark, library):
    import hashlib

    from obskit.llm.queries import op13_byte_bpe

    sf = "/root/testdata/sf0.001"
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op13_byte_bpe(spark, sf).collect()
    assert len(got) == len(text)
    for r in got:
        ids = library.encode_ordinary(text[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text[r.doc_id].encode()).hexdigest())


def test_ranks_are_read_from_the_given_file(spark, tmp_path):
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate([bytes([c]) for c in range(256)] + [b"ab", b"abab"])))
    df = spark.createDataFrame([("ababab",)], "text string")
    out = byte_bpe.decode(byte_bpe.encode(df, path=str(path)), path=str(path)).first()
    assert out.token_ids == [257, 256] and bytes(out.decoded) == b"ababab"

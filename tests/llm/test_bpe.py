import hashlib
import random

import pytest
import public_tokenizers
from pyspark.sql import types as T

from bureauframe.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
     T.StructField("ids", T.StringType()), T.StructField("key", T.StringType())]
)
PIECES = [
    "'s", "'", "''", "'re", "!!'", "a", "aaaa", "hello", " hello", " ", "  ", "\n", "\n\n", "\t",
    "é", "日本語", "🙂", "🙂🙂", "1234", " 99", "$$$", "===", " ", "　", "x" * 40, "<|endoftext|>",
    "<|endo", "ftext|>", "ßtraße", "\r\n", "he", "ll", "o", "́", "don't", "I'LL", " '", "'t", "²", "½x", "Ⅷ", "_", "a_b",
]


@pytest.fixture(scope="module")
def enc():
    return bpe.Encoder(PATH)


@pytest.mark.parametrize("leaf", [1, 2, 3, 7, 20])
def test_tree_equals_library(enc, leaf):
    rng = random.Random(leaf)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 40))) for _ in range(600)]
    texts += ["a" * 300, " " * 300 + "x", "=" * 257, "日" * 200, "ab" * 100 + "'s", "\n" * 99 + " b", ""]
    assert list(map(bpe.numbers, enc.tree_encode(texts, leaf))) == enc.plain(texts)


def test_word_cache_equals_library(enc):
    rng = random.Random(5)
    for _ in range(5):
        texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 60))) for _ in range(200)]
        texts += [" ".join(rng.choices(["the", "a", "x\ny", "end.\n\nNew", "é,"], k=50)) for _ in range(50)]
        assert list(map(bpe.numbers, enc.encode(texts))) == enc.plain(texts)


def test_decode_equals_library(enc):
    rng = random.Random(9)
    rows = [[rng.randrange(50_257) for _ in range(20)] for _ in range(300)]
    assert [enc.decode(x) for x in rows] == [
        enc.tokenizer.decode(x, skip_special_tokens=False) for x in rows
    ]


def test_documents(spark, enc):
    rng = random.Random(1)
    long = "".join(rng.choices(PIECES, k=120_000))
    rows = [(1, "plain words here", "x", "k"), (2, None, None, None), (3, "", "", ""), (None, "a b", "", ""),
            (5, long, "", ""), (5, long, "", ""), (5, "other", "", ""), (7, "x" * 600_000, "", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = bpe.encode_documents(docs, PATH, bpe.digests, bpe.DIGESTS)
    got = sorted(map(tuple, out.collect()), key=str)
    want = []
    for doc, text, *_ in rows:
        ids = enc.plain([text or ""])[0]
        back = enc.tokenizer.decode(ids, skip_special_tokens=False)
        want.append((doc, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(back.encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe.encode_documents(spark.createDataFrame([], SCHEMA), PATH).count() == 0

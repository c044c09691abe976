import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import types as T

from bureauframe.llm import bpe, simple8b
from bureauframe.llm.common import scratch

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
     T.StructField("part", T.StringType()), T.StructField("start", T.StringType())]
)


@pytest.mark.parametrize("top", [1, 2, 9, 255, 50_257, 2**31, 2**60 - 1, 2**60, 2**64 - 1])
def test_round_trip(top):
    rng = np.random.default_rng(top % 1000)
    for n in (0, 1, 2, 59, 60, 61, 511, 512, 513, 5000):
        ids = rng.integers(0, top, n, dtype=np.uint64, endpoint=True)
        ids[rng.random(n) < 0.4] = 0
        words, lanes = simple8b.encode(ids)
        assert np.array_equal(simple8b.decode(words), ids)
        assert np.array_equal(simple8b.decode(words, lanes), ids)
        if n:
            k = int(rng.integers(len(lanes)))
            assert np.array_equal(simple8b.lane(words, lanes, k), ids[k * simple8b.LANE : (k + 1) * simple8b.LANE])
        for k, at in enumerate(lanes):
            end = lanes[k + 1] if k + 1 < len(lanes) else len(words)
            lane = ids[k * simple8b.LANE : (k + 1) * simple8b.LANE]
            assert np.array_equal(simple8b.decode(words[at:end]), lane)


def test_small_ids_are_packed():
    assert len(simple8b.encode(np.zeros(480, np.uint64))[0]) == 8
    assert len(simple8b.encode(np.full(512, 50_000, np.uint64))[0]) == 171


def test_files(spark, monkeypatch):
    rows = [(9, "last one", "", ""), (2, None, None, None), (None, "no id", "", ""), (3, "", "", ""),
            (4, "x " * 3000, "", ""), (4, "repeated", "", ""), (4, "repeated", "", ""), (-5, "first", "", "")]
    path = scratch(spark, "ids")
    simple8b.write_ids(spark.createDataFrame(rows, SCHEMA), path, PATH)
    got = simple8b.checksums(simple8b.read_ids(spark, path)).collect()
    plain = bpe.Encoder(PATH).plain
    ids = {i: (*plain([t or ""])[0], 0) for i, (_, t, *_) in enumerate(rows)}
    packed = {i: np.array(x[:-1], "<u4") for i, x in ids.items()}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    assert sorted(r.start for r in got)[0] == 0
    seen = {(r.doc_id, r.n_tokens, r.ids_crc32) for r in got}
    assert seen == {(rows[i][0], len(ids[i]), simple8b.crc(ids[i])) for i in order} and packed
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == [rows[i][0] for i in order]
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    empty = scratch(spark, "ids")
    simple8b.write_ids(spark.createDataFrame([], SCHEMA), empty, PATH)
    assert simple8b.read_ids(spark, empty).count() == 0


def test_long_text_through_the_files(spark, monkeypatch):
    monkeypatch.setattr(simple8b, "BLOCK_IDS", 4_096)
    rng = np.random.default_rng(3)
    long = " ".join("".join(rng.choice(list("abcdeé"), 6)) for _ in range(bpe.TASK_CHARS // 5))
    assert len(long) > bpe.TASK_CHARS
    rows = [(1, "before", "", ""), (2, long, "", ""), (3, "after", "", "")]
    path = scratch(spark, "ids")
    simple8b.write_ids(spark.createDataFrame(rows, SCHEMA), path, PATH)
    got = sorted(simple8b.checksums(simple8b.read_ids(spark, path)).collect(), key=lambda r: r.doc_id)
    plain = bpe.Encoder(PATH).plain
    ids = [[*plain([t])[0], 0] for _, t, *_ in rows]
    assert [(r.n_tokens, r.ids_crc32) for r in got] == [(len(x), simple8b.crc(x)) for x in ids]
    assert [r.start for r in got] == [0, len(ids[0]), len(ids[0]) + len(ids[1])]


def test_words_are_remembered_in_two_generations(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_UNITS", 8)
    coder = bpe.Encoder(PATH)
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefg"), 4)) for _ in range(40)]
    text = "start " + " ".join(w + e for w in words for e in ("", ".", ",", "") for _ in range(2)) + "  two spaces"
    for one in (text, text.replace("  ", " ")):
        assert bpe.numbers(coder.encode([one])[0]) == coder.plain([one])[0]
    assert max(len(coder.words), len(coder.words.older), len(coder.pieces)) <= 4

import random
import zlib

import numpy as np
from pyspark.sql import types as T

from bureauframe.llm import binpack
from bureauframe.llm.common import table

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
     T.StructField("shard", T.StringType()), T.StructField("group", T.StringType()),
     T.StructField("parts", T.StringType())]
)


def plain_place(vectors, shards):
    load = [[0.0] * len(vectors[0]) for _ in range(shards)]
    out = {}
    for i in sorted(range(len(vectors)), key=lambda i: (-max(vectors[i]), i)):
        scores = [sum(v * (1 / shards - x) for v, x in zip(vectors[i], own)) for own in load]
        out[i] = scores.index(max(scores))
        load[out[i]] = [x + v for x, v in zip(load[out[i]], vectors[i])]
    return [out[i] for i in range(len(vectors))]


def test_place_against_loops():
    rng = np.random.default_rng(1)
    vectors = rng.random((60, 3)) ** 3
    vectors /= vectors.sum(axis=0)
    assert binpack.place(vectors, 5).tolist() == plain_place(vectors.tolist(), 5)
    assert binpack.place(np.zeros((0, 3)), 5).tolist() == []


def test_documents(spark, sf):
    docs = table(spark, sf.replace("0.001", "0.01"), "documents")
    got = binpack.shard(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(got) == len(texts)
    size, homes = {}, {}
    for r in got:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
        size.setdefault(r.shard, []).append(r)
        homes.setdefault(texts[r.doc_id], set()).add(r.shard)
    assert sorted(size) == list(range(24)) and all(len(h) == 1 for h in homes.values())
    for rows in size.values():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
    for value in (lambda r: r.size, lambda r: r.tokens, lambda r: 1):
        loads = [sum(map(value, rows)) for rows in size.values()]
        assert max(loads) <= 1.1 * sum(loads) / 24


def test_hot_group_and_odd_rows(spark):
    rng = random.Random(2)
    rows = [(i, "the same text again", "s", "g", "p") for i in range(1000)]
    rows += [(1000 + i, "w " * rng.randint(0, 40) + str(i), "", "", "") for i in range(2000)]
    rows += [(None, None, None, None, None), (5, None, "", "", ""), (6, "", "", "", ""), (6, "", "", "", "")]
    got = binpack.shard(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    loads = [sum(r.size for r in got if r.shard == s) for s in range(24)]
    assert max(loads) < 1.05 * min(loads)
    assert {(r.size, r.text_crc32) for r in got if r.doc_id is None} == {(8, None)}
    assert len({(r.shard, r.slot) for r in got}) == len(rows)
    assert binpack.shard(spark.createDataFrame([], SCHEMA)).count() == 0

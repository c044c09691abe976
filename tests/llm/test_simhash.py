import random
import re

import numpy as np
import xxhash
from pyspark.sql import types as T

from bureauframe.llm import simhash
from bureauframe.llm.components import components

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
     T.StructField("fp", T.StringType()), T.StructField("label", T.StringType())]
)


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    n = max(1, len(words) - 2)
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def plain_components(ids, fps):
    label = list(range(len(fps)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                label[max(root(i), root(j))] = min(root(i), root(j))
    groups = {}
    for i in range(len(fps)):
        groups.setdefault(root(i), []).append(i)
    out = [None] * len(fps)
    for own in groups.values():
        known = [ids[i] for i in own if ids[i] is not None]
        for i in own:
            out[i] = min(known) if known else None
    return out


def test_fingerprint():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 4, 9, 100, 70_000):
        text = "".join(rng.choice(["Ab", "é ", " ", "\n", "ÀX", "q\x0b", "w "]) for _ in range(n))
        assert simhash.fingerprint(text) == plain_fingerprint(text)
    assert simhash.fingerprint(None) == 0


def test_documents_against_all_pairs(spark):
    rng = random.Random(2)
    base = [[rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(120)] for _ in range(12)]
    rows = [(None, None, "", ""), (900, "", "x", "y"), (901, None, None, None), (902, " \n ", "", "")]
    for i in range(160):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2])):
            words[rng.randrange(len(words))] = "zz"
        rows.append((rng.choice([i, i, 3]), " ".join(words), "", ""))
    got = sorted(map(tuple, simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    fps = [plain_fingerprint(t) for _, t, *_ in rows]
    roots = plain_components([r[0] for r in rows], fps)
    want = [(r[0], f"{f:016x}", c) for r, f, c in zip(rows, fps, roots, strict=True)]
    assert got == sorted(want, key=str)
    assert len({c for *_, c in want}) < 100
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_links_find_every_close_pair(spark, monkeypatch):
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    fps = {centre}
    while len(fps) < 500:
        x = rng.choice(sorted(fps)) if rng.random() < 0.9 else rng.getrandbits(64)
        for b in rng.sample(range(64), rng.randint(1, 4)):
            x ^= 1 << b
        fps.add(x)
    fps = sorted(fps)
    ids = list(range(len(fps)))
    want = plain_components(ids, fps)
    for divide in (4096, 8):
        monkeypatch.setattr(simhash, "DIVIDE", divide)
        pairs = []
        keys, values = simhash.variants(np.array(fps, np.uint64))
        for key in np.unique(keys):
            own = values[keys == key]
            if len(own) > 1:
                pairs += list(zip(*(x.tolist() for x in simhash.linked(own, int(key))), strict=True))
        number = {f: i for i, f in enumerate(fps)}
        edges = spark.createDataFrame([(number[a], number[b]) for a, b in pairs], "u long, v long")
        label = {r.node: r.label for r in components(edges).collect()}
        assert [label.get(i, i) for i in ids] == want


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(200)] + [(500, 501), (7, 7)], "u long, v long")
    label = {r.node: r.label for r in components(edges).collect()}
    assert label == {**{i: 0 for i in range(1, 201)}, 501: 500}

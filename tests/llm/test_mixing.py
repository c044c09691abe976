import itertools
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from bureauframe.llm import mixing

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("source", T.StringType()),
     T.StructField("text", T.StringType()), T.StructField("size", T.StringType()),
     T.StructField("bucket", T.StringType()), T.StructField("number", T.StringType())]
)


def table(spark, rows):
    return spark.createDataFrame([(*r, "s", "b", "n") for r in rows], SCHEMA)


def plain_targets(sizes):
    """Share by weight, then reshare what exceeds a ceiling until nothing does."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, out = sum(sizes.values()), list(names), {}
    while open_:
        part = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if part[s] >= 3 * sizes[s]]
        if not over:
            return out | part
        for s in over:
            out[s] = 3.0 * sizes[s]
            left -= 3 * sizes[s]
            open_.remove(s)
    return out


@pytest.mark.parametrize("seed", range(8))
def test_fit_is_the_best_sum(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.choice(np.arange(1, 60), 5, replace=False)
    counts = rng.integers(1, 4, 5)
    for budget in rng.integers(0, int((sizes * counts).sum()) + 5, 6):
        take = mixing.fit(sizes, counts, int(budget))
        sums = {sum(int(n * s) for n, s in zip(c, sizes)) for c in itertools.product(*(range(n + 1) for n in counts))}
        assert (take <= counts).all() and (take >= 0).all()
        assert int((take * sizes).sum()) == max(s for s in sums if s <= budget)


def test_fit_of_a_large_budget(monkeypatch):
    monkeypatch.setattr(mixing, "EXACT_WORDS", 2_000)
    rng = np.random.default_rng(1)
    sizes = np.unique(rng.integers(1, 5_000, 900))
    counts = rng.integers(1, 400, len(sizes))
    for share in (0.001, 0.3, 0.77, 0.999):
        budget = int((sizes * counts).sum() * share)
        take = mixing.fit(sizes, counts, budget)
        assert (take <= counts).all() and (take * sizes).sum() == budget


@pytest.mark.parametrize("seed", range(3))
def test_mix(spark, seed):
    rng = random.Random(seed)
    sources = ["a", "B", "é", "src1", None, "zz", ""][: 4 + seed]
    rows = [
        (rng.choice([i, i, 7, None]), rng.choice(sources + ["a"] * 4), " ".join("w" * rng.choice([0, 1, 5, 5, 300])))
        for i in range(700)
    ] + [(9999, "tiny", "one"), (10_000, "empty", None), (10_001, "empty", " \n ")]
    got = mixing.mix(table(spark, rows)).collect()
    again = mixing.mix(table(spark, rows).repartition(5)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
    sizes = {}
    for _, source, text in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want, taken = plain_targets(sizes), dict.fromkeys(sizes, 0)
    assert len(got) == len(rows)
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert r.taken == 0 or r.taken % r.size == 0 and r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for source in sizes:
        assert abs(taken[source] - want[source]) <= 300


def test_nothing_and_copies(spark):
    assert mixing.mix(table(spark, [])).count() == 0
    docs = table(spark, [(1, "a", "x y z"), (2, "b", "x"), (3, "b", None)])
    mixed = mixing.mix(docs)
    out = mixing.materialized(docs, mixed)
    assert out.columns == docs.columns
    times = {r.doc_id: r.taken // r.size if r.size else 1 for r in mixed.collect()}
    assert sorted(r.doc_id for r in out.collect()) == sorted(i for i, n in times.items() for _ in range(n))


def test_materialized_copies_of_each_row(spark):
    """Rows without doc_id, rows that share one, and repeated rows come as often as each is taken."""
    rows = [(None, " ".join(["w"] * (5 + i)), "a", f"x{i}") for i in range(6)]
    rows += [(7, "one two three", "a", "p"), (7, "one two three four five six", "a", "q"), (7, "one two three", "b", "r")]
    rows += [(8, "u v", "b", "s")] * 3 + [(9, None, "a", "t"), (9, "", None, "u")]
    rows += [(100 + i, "long text " * 40, None, "z") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, other string")
    mixed = mixing.mix(docs).collect()
    got = mixing.materialized(docs, mixing.mix(docs))
    assert got.columns == docs.columns
    want = {}
    for r in mixed:
        key = r.doc_id, r.source, r.text_hash
        want[key] = want.get(key, 0) + (r.taken // r.size if r.size else 1)
    seen = got.selectExpr("doc_id", "source", "xxhash64(text) AS h").collect()
    counts = {}
    for r in seen:
        counts[tuple(r)] = counts.get(tuple(r), 0) + 1
    assert counts == {k: n for k, n in want.items() if n}
    words = got.selectExpr("source", "coalesce(regexp_count(text, '[^ ]+'), 0) AS n").groupBy("source").sum("n").collect()
    assert {r[0]: r[1] for r in words} == {s: sum(r.taken for r in mixed if r.source == s) for s in {r.source for r in mixed}}

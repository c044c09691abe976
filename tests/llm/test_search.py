import numpy as np
import pytest
from pyspark.sql import types as T

from bureauframe.llm import balltree, routing
from bureauframe.llm.common import table

SCHEMA = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
     T.StructField("part", T.StringType()), T.StructField("v", T.StringType())]
)


def plain(rows, zero, scale=None):
    use = []
    for i, v in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v) or len(v) != 4:
            continue
        if zero or any(v):
            x = np.array(v, np.float32).astype(float)
            use.append((i, np.floor(scale * x) if scale else x))
    out = []
    for q, a in use:
        if q % 20 == 0:
            found = sorted((-float((a * b).sum()), i) for i, b in use if i != q)[:20]
            out += [(q, k, i, -s) for k, (s, i) in enumerate(found, 1)]
    return out


def rows_with_faults(n=700):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(90)]  # a common vector
    nan, inf = float("nan"), float("inf")
    rows += [(2000, None), (2020, [1.0, None, 1.0, 1.0]), (2040, [nan, 0.0, 0.0, 0.0]), (2060, [inf, 0.0, 0.0, 1.0]),
             (2080, [0.0] * 4), (2100, []), (None, [1.0] * 4), (2120, [1.0] * 3)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "p", "v") for i, v in rows], SCHEMA)


@pytest.mark.parametrize("rows", [4096, 100])
def test_ball_trees_against_all_pairs(spark, monkeypatch, rows):
    monkeypatch.setattr(balltree, "SHARD_ROWS", rows)
    monkeypatch.setattr(balltree, "BLOCK_QUERIES", 20)
    data = rows_with_faults()
    got = sorted(map(tuple, balltree.search_all(frame(spark, data)).collect()))
    assert got == sorted((q, k, i, int(s)) for q, k, i, s in plain(data, True, 64))


def groups(n):
    """`n` rows around 16 distant points."""
    rng = np.random.default_rng(5)
    middle = np.eye(4)[np.arange(16) % 4] * ((np.arange(16) // 4 + 1) * 20)[:, None]
    return [(i, (middle[i % 16] + rng.normal(size=4)).tolist()) for i in range(n)]


def test_trees_travel_only_where_a_query_may_go(spark, monkeypatch):
    monkeypatch.setattr(balltree, "BLOCK_QUERIES", 20)
    monkeypatch.setattr(balltree, "SHARD_ROWS", 100)
    monkeypatch.setattr(balltree, "WAVE", 2)
    shipped = {}
    inner = balltree.blocks_of
    for n in (1600, 6400):
        def counted(*args, n=n):
            out = inner(*args)
            shipped[n] = shipped.get(n, 0) + out[1]
            return out

        monkeypatch.setattr(balltree, "blocks_of", counted)
        data = groups(n)
        got = sorted(map(tuple, balltree.search_all(frame(spark, data)).collect()))
        assert got == sorted((q, k, i, int(s)) for q, k, i, s in plain(data, True, 64))
        blocks, shards = n // 20 // 20, n // 100
        assert shipped[n] * 6 < shards * blocks
    assert shipped[6400] < 16 * shipped[1600]


def test_blocks_follow_the_queries_of_a_part(monkeypatch):
    monkeypatch.setattr(routing, "BLOCK_QUERIES", 10)
    assert routing.blocks_of({0: 1, 1: 10, 2: 31}) == {0: 1, 1: 1, 2: 4}
    monkeypatch.setattr(balltree, "BLOCK_QUERIES", 10)
    assert balltree.blocks_of({0: 35, 3: 10}, {0: 2, 3: 5}, False) == ({0: 4, 3: 1}, 13)
    assert balltree.blocks_of({0: 35, 3: 10}, {0: 2, 3: 5}, True) == ({0: 2, 3: 1}, 9)


def test_cell_bounds_hold():
    rng = np.random.default_rng(6)
    x, q = rng.integers(-99, 99, (400, 5)), rng.integers(-99, 99, (30, 5)).astype(float)
    middles = balltree.centres(x[:64], 7)
    own = balltree.nearest(x, middles)
    reach = np.array([np.sqrt(((x[own == c] - m) ** 2).sum(axis=1)).max(initial=-1) for c, m in enumerate(middles)])
    most = balltree.bounds(q, middles, reach)
    for c in range(len(middles)):
        assert (q @ x[own == c].T <= most[:, c, None]).all()
    assert balltree.bounds(q, middles, np.full(len(middles), -1.0)).max() == -np.inf


def test_ball_tree_prunes_and_survives_large_values():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.integers(-50, 50, (500, 3)) + c for c in ([0, 0, 900], [0, 900, 0], [900, 0, 0])])
    ids = rng.permutation(1500)
    tree = balltree.build(ids, x)
    for big in (1, 2**20):
        q = x[:7] * big
        at, found, score = balltree.search(
            balltree.Tree(tree.ids, tree.rows * big, *(getattr(tree, f) for f in ("start", "end", "children")),
                          tree.centre * big, tree.radius * big), ids[:7], q, np.full(7, balltree._NONE))
        for i in range(7):
            best = sorted((-int(a), int(b)) for a, b in zip((x * big) @ q[i], ids) if b != ids[i])[:20]
            assert sorted(zip((-score[at == i]).tolist(), found[at == i].tolist())) == best
    seen = []
    monkey = np.partition
    try:
        np.partition = lambda *a, **k: (seen.append(1), monkey(*a, **k))[1]
        balltree.search(tree, ids[:7], x[:7], np.full(7, balltree._NONE))
    finally:
        np.partition = monkey
    assert len(seen) < (tree.children[:, 0] < 0).sum()


def test_few_rows(spark):
    few = [(0, [1.0, 0.0, 0.0, 0.0]), (1, [1.0, 1.0, 0.0, 0.0]), (20, [0.5, 0.0, 0.0, 0.0])]
    for operator, zero, scale in ((balltree.search_all, True, 64), (routing.search, False, None)):
        assert sorted(map(tuple, operator(frame(spark, few)).collect())) == sorted(plain(few, zero, scale))
        assert operator(frame(spark, [])).count() == 0
        assert operator(frame(spark, [(0, [1.0] * 4)])).count() == 0


def test_routing_scores_and_faults(spark):
    data = rows_with_faults()
    want = {}
    for q, k, i, s in plain(data, False):
        want.setdefault(q, {})[i] = s
    got = routing.search(frame(spark, data)).collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == set(want)
    found = 0
    for q, rows in by.items():
        rows.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        kth = min(want[q].values())
        found += sum(r.score >= kth for r in rows)
    assert found >= 0.9 * 20 * len(want)


def test_recall_and_balance(spark):
    vectors = table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = vectors.collect()
    ids = np.array([r.vec_id for r in rows])
    x = np.array([r.embedding for r in rows])
    router, _ = routing.learn(routing.usable(vectors, zero=False))
    sizes = np.bincount(np.argmax(router.logits(x), axis=1), minlength=router.parts)
    assert router.parts >= 8 and sizes.max() < 2.5 * sizes.mean()
    found = {}
    for r in routing.search(vectors).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in ids[ids % 20 == 0]:
        score = x @ x[ids == q][0]
        score[ids == q] = -9
        hits += len(found[q] & set(ids[np.argsort(-score)[:20]].tolist()))
    assert hits >= 0.9 * 20 * (ids % 20 == 0).sum()


def test_partition_is_balanced():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.1, (100, 2)) for c in ((0, 9), (9, 0), (-9, 0), (0, -9))])
    graph = routing.neighbours(x, 5)
    label = routing.partition(x, graph, 4)
    sizes = np.bincount(label, minlength=4)
    assert sizes.max() <= np.ceil(routing.SLACK * 100)
    assert (label[graph] == label[:, None]).mean() > 0.9


def test_parts_have_rows_to_learn_from(spark, monkeypatch):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(2_048, 8))
    assert routing.fit(x[:300], 128).parts == 32  # about 200 rows to learn from
    monkeypatch.setattr(routing, "SAMPLE", 64)
    monkeypatch.setattr(routing, "ROWS_A_PART", 64)
    rows = routing.usable(frame(spark, list(enumerate(x.tolist()))), zero=False)
    assert routing.learn(rows)[0].parts == 32

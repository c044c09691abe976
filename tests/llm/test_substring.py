import itertools
import random
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import types as T

from bureauframe.llm import common, substring

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
     T.StructField("n_chars", T.LongType()), T.StructField("key", T.StringType()),
     T.StructField("_maybe", T.StringType())]
)


def words(rng, n):
    return ["".join(rng.choices("abcdefghijkl", k=6)) for _ in range(n)]


def docs(spark, rows):
    full = [(i, t, None if t is None else len(t), "k", "m") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.mark.parametrize("seed", range(4))
def test_chain_is_the_best_one(seed):
    rng = random.Random(seed)
    points = sorted({(rng.randrange(30), rng.randrange(30)) for _ in range(11)})
    xs, ys = [p[0] for p in points], [p[1] for p in points]

    def value(links):
        total = substring.K * len(links)
        for i, j in itertools.pairwise(links):
            total -= substring.GAP_COST * (xs[j] - xs[i] + ys[j] - ys[i])
        return total

    best = max(
        value(links)
        for n in range(1, len(points) + 1)
        for links in itertools.combinations(range(len(points)), n)
        if all(xs[i] < xs[j] and ys[i] < ys[j] for i, j in itertools.pairwise(links))
    )
    chains = substring.chain(xs, ys)
    assert value(chains[0]) == pytest.approx(best)
    assert sorted(i for c in chains for i in c) == list(range(len(points)))


def test_seeds_cover_shared_runs():
    rng = random.Random(1)
    shared = words(rng, substring.K + substring.WINDOW - 1)
    one = words(rng, 60) + shared + words(rng, 60)
    two = words(rng, 81) + shared + words(rng, 40)
    a, b = substring.seeds(" ".join(one)), substring.seeds(" ".join(two))
    assert set(a[0].tolist()) & set(b[0].tolist())
    assert len(substring.seeds("few words")[0]) == 0


def test_passages_are_found_and_removed(spark):
    rng = random.Random(2)
    passage, other = words(rng, 70), words(rng, 60)
    fuzzy = list(passage)
    for i in (12, 30, 31, 55):
        fuzzy[i] = "changed"
    del fuzzy[42]
    line = " ".join(words(rng, 9)) + "\n"
    rows = [
        (1, " ".join(words(rng, 100) + passage + words(rng, 20))),
        (2, " ".join(words(rng, 33) + passage)),
        (3, " ".join(fuzzy + words(rng, 200))),
        (4, " ".join(words(rng, 300))),
        (5, " ".join(words(rng, 50) + other + words(rng, 30) + passage[:45] + words(rng, 9))),
        (6, " ".join(words(rng, 10) + passage + words(rng, 15) + other)),
        (7, line * 40), (8, line * 40), (9, None), (10, ""), (None, " ".join(passage)),
        (11, " ".join(passage)), (11, " ".join(passage)), (12, " ".join(words(rng, 40_000) + other)),
    ]
    table = docs(spark, rows)
    found = substring.repeats(table).collect()
    texts = {i: (t or "").split() for i, t in rows}
    for r in found:
        assert r.other_doc_id < r.doc_id and r.end_word - r.start_word >= 50 and r.similarity >= 0.8
    spans = {}
    for r in found:
        spans.setdefault(r.doc_id, []).append((r.start_word, r.end_word))
    assert set(spans) == {2, 3, 6, 8, 11, 12}
    assert spans[2] == [(33, 103)] and spans[3][0][0] == 0 and 68 <= spans[3][0][1] <= 70
    assert sorted(spans[6]) == [(10, 80), (95, 155)]
    left = {}
    for r in substring.without_repeats(table, substring.repeats(table)).collect():
        left.setdefault(r.doc_id, []).append(r)
    assert {i for i, _ in rows} - set(left) == {8, 11}
    assert left[2][0].text.split() == texts[2][:33] and left[4][0].text == rows[3][1]
    assert left[6][0].text.split() == texts[6][:10] + texts[6][80:95]
    assert left[1][0].text == rows[0][1] and left[5][0].text == rows[4][1]
    assert all(r.n_chars == len(r.text) and r.key == "k" for x in left.values() for r in x if r.text is not None)


def test_many_copies_stay_linear(spark):
    rng = random.Random(3)
    passage = words(rng, 80)
    table = docs(spark, [(i, " ".join(words(rng, 30) + passage)) for i in range(300)])
    seeds = substring.seed_table(table)
    assert substring.matches(seeds).count() < seeds.count()
    found = substring.repeats(table)
    assert found.select("doc_id").distinct().count() == 299 and found.count() < 600


def test_nothing(spark):
    assert substring.repeats(docs(spark, [])).count() == 0
    assert substring.without_repeats(docs(spark, []), substring.repeats(docs(spark, []))).count() == 0


def test_remove():
    assert substring.remove("  a b\n c  d e ", [(1, 3), (2, 4)]) == "  a e "
    assert substring.remove("a b", [(0, 9)]) == ""


def test_short_chains_are_aligned(spark):
    # Exactly one k-mer of the passage is left of its seeds; the rest is for the alignment to find.
    rng = random.Random(4)
    passage = [w.encode() for w in words(rng, 60)]
    xs, ys = [100], [45]
    a = [w.encode() for w in words(rng, 75)] + passage + [w.encode() for w in words(rng, 70)]
    b = [w.encode() for w in words(rng, 20)] + passage + [w.encode() for w in words(rng, 70)]
    assert list(substring.passages(xs, ys)) == [(xs, ys)]
    assert list(substring.verified(a, b, xs, ys)) == [(75, 135, 20, 80, 60)]


@pytest.mark.parametrize("spread", ["even", "random"])
@pytest.mark.parametrize("share", [0.8, 0.85, 0.9, 0.95])
def test_recall_of_edited_passages(spark, share, spread):
    # Planted passages of 60 and 100 words with single words replaced, between words of their own.
    rng = random.Random(f"{share}{spread}")
    rows = []
    for k in range(40):
        n = 60 + 40 * (k % 2)
        passage, edits = words(rng, n), round(n * (1 - share))
        edited = list(passage)
        for i in [(2 * e + 1) * n // (2 * edits) for e in range(edits)] if spread == "even" else rng.sample(range(n), edits):
            edited[i] = words(rng, 1)[0]
        rows += [(k, " ".join(words(rng, 50) + passage + words(rng, 50))),
                 (100 + k, " ".join(words(rng, 80) + edited + words(rng, 80)))]
    found = substring.repeats(docs(spark, rows)).collect()
    assert {(r.doc_id, r.other_doc_id) for r in found} == {(100 + k, k) for k in range(40)}
    for r in found:
        assert r.start_word >= 80 and r.similarity >= 0.8


def test_every_copy_in_a_document_is_found(spark):
    rng = random.Random(6)
    passage, x, y, z = words(rng, 60), words(rng, 20), words(rng, 30), words(rng, 25)
    table = docs(spark, [(1, " ".join(passage)), (2, " ".join(x + passage + y + passage + z))])
    spans = {(r.start_word, r.end_word) for r in substring.repeats(table).collect()}
    assert spans == {(20, 80), (110, 170)}
    left = {r.doc_id: r.text.split() for r in substring.without_repeats(table, substring.repeats(table)).collect()}
    assert left == {1: passage, 2: x + y + z}


def test_only_the_row_with_the_passage_is_cut(spark):
    rng = random.Random(11)
    passage, other = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(n)) for n in (70, 200))
    rows = [(1, passage, "a"), (2, "x " + passage, "b"), (2, other, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, text_hash string")
    kept = substring.without_repeats(docs, substring.repeats(docs))
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == [(1, passage, "a"), (2, other, "c"), (2, "x ", "b")]


def test_seeds_that_two_documents_have_all_pass(spark):
    rng = random.Random(12)
    texts = [" ".join(rng.choice("abc") * rng.randint(1, 3) for _ in range(rng.choice([20, 60, 90]))) for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    owners = {}
    for i, t in enumerate(texts):
        for k in substring.seeds(t)[0].tolist():
            owners.setdefault(k, set()).add(i)
    shared = {k for k, own in owners.items() if len(own) > 1}
    found = {r.key & (1 << 64) - 1 for r in substring.seed_table(docs).select("key").collect()}
    assert shared <= found <= set(owners)


@pytest.mark.parametrize("n", [50, 60, 130])
def test_a_repeat_whose_parts_first_stand_elsewhere_is_found(spark, n):
    rng = random.Random(n)
    passage = words(rng, n)
    rows = [(1 + k, " ".join(words(rng, 40) + passage[i : i + 30] + words(rng, 40))) for k, i in enumerate(range(0, n, 27))]
    rows += [(100, " ".join(words(rng, 20) + passage + words(rng, 9))), (200, " ".join(words(rng, 70) + passage))]
    found = substring.repeats(docs(spark, rows)).collect()
    assert {(r.doc_id, r.other_doc_id) for r in found} == {(200, 100)}
    covered = {i for r in found for i in range(r.start_word, r.end_word)}
    assert covered == set(range(70, 70 + n)) and all(r.similarity == 1 for r in found)


def test_runs_have_shared_seeds_only():
    rng = random.Random(5)
    kmers = substring.kmers_of(" ".join(words(rng, 120)))
    keys, at = substring.runs_of(kmers, np.array([3, 60]))
    assert at.tolist() == [*range(4, 14), *range(61, 71)] and len(set(keys.tolist())) == 20
    assert len(substring.runs_of(kmers[:40], np.zeros(0, np.int64))[0]) == 0


def test_copies_are_one_passage(spark):
    rng = random.Random(8)
    passage, copied = words(rng, 60), " ".join(words(rng, 40))
    text = " ".join(words(rng, 30) + passage)
    rows = [(1, " ".join(passage + words(rng, 20))), (2, text), (3, text), (3, "other " + copied), (5, text), (6, copied), (7, copied)]
    found = {(r.doc_id, r.start_word, r.end_word, r.other_doc_id, r.other_start, r.other_end, r.similarity)
             for r in substring.repeats(docs(spark, rows)).collect()}
    assert found == {(2, 30, 90, 1, 0, 60, 1.0), (3, 0, 90, 2, 0, 90, 1.0), (5, 0, 90, 2, 0, 90, 1.0)}


@pytest.mark.parametrize("seed", range(6))
def test_extensions_are_the_best(seed):
    rng = random.Random(seed)
    for _ in range(60):
        kinds = rng.choice([1, 2, 5, 40])
        a, b = ([b"%d" % rng.randrange(kinds) for _ in range(rng.randrange(substring.MARGIN + 1))] for _ in "ab")
        same = {(p, 0): 0 for p in range(len(a) + 1)} | {(0, q): 0 for q in range(len(b) + 1)}
        best = {0: (0, 0, 0)}
        for q in range(1, len(b) + 1):
            for p in range(1, len(a) + 1):
                if a[p - 1] == b[q - 1]:
                    same[p, q] = same[p - 1, q - 1] + 1
                    way = same[p, q], p + q, p
                    best[max(p, q)] = max(best.get(max(p, q), (0, 0, 0)), way)
                else:
                    same[p, q] = max(same[p - 1, q], same[p, q - 1])
        found = list(zip(*(x.tolist() for x in substring._extend(a, b, substring._lcs(a, b))), strict=True))
        assert sorted(found) == sorted((p, n - p, s) for s, n, p in best.values())


def test_aligning_texts_of_few_words_takes_no_longer():
    def seconds(a):
        times = []
        for _ in range(9):
            start = time.process_time()
            for _ in range(10):
                list(substring.verified(a, a, [64], [64]))
            times.append(time.process_time() - start)
        return min(times)

    assert seconds([b"same"] * 132) < 6 * seconds([b"%d" % i for i in range(132)])


def test_no_python_worker_tells_ids_apart(spark):
    table = docs(spark, [(i, f"text {i}") for i in range(50)] + [(None, "none")])
    ids = table.filter("doc_id % 7 = 3").select(substring.F.col("doc_id").alias("id"))
    rest, touched = substring.divided(table, ids)
    assert {r.doc_id for r in touched.collect()} >= set(range(3, 50, 7))
    assert rest.count() + touched.count() == 51 and rest.columns == table.columns
    for part in (rest, touched):
        assert "Python" not in part._jdf.queryExecution().toString()


def test_chains_are_aligned_in_rounds(spark, monkeypatch):
    rng = random.Random(9)
    passage = words(rng, 60)
    table = docs(spark, [(i, " ".join(words(rng, 9) + passage + words(rng, i % 5))) for i in range(40)])
    whole = sorted(map(tuple, substring.repeats(table).collect()))
    made, align = [], substring.aligned
    monkeypatch.setattr(substring, "ROUND", 0.5)
    monkeypatch.setattr(substring, "aligned", lambda d, part: made.append(part.count()) or align(d, part))
    assert sorted(map(tuple, substring.repeats(table).collect())) == whole and len(whole) >= 39
    assert len(made) > 2 and sum(made) == 39


def test_shuffle_files_go_with_the_write(spark, tmp_path):
    def bytes_left():
        roots = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return sum(f.stat().st_size for r in roots for f in Path(r).glob("*/shuffle_*.data"))

    rows = docs(spark, [(i, "%032x" % random.Random(i).getrandbits(128)) for i in range(3000)])
    before = bytes_left()
    common.stored(rows.repartition(3, "doc_id"), str(tmp_path / "out"))
    for _ in range(100):  # they are removed in the background
        if bytes_left() <= before:
            break
        time.sleep(0.1)
    assert bytes_left() <= before and spark.read.parquet(str(tmp_path / "out")).count() == 3000


def test_every_run_of_two_documents_is_among_the_seeds(spark):
    """What `runs_of` leaves out has a seed that one row alone has, so no other row has the run."""
    rng = random.Random(12)
    passage = words(rng, 160)
    texts = [words(rng, 30) + passage[i : i + n] + words(rng, 30) for i, n in ((0, 90), (40, 120), (10, 55), (100, 50), (0, 160))]
    texts[3][40] = "changed"
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    width, owners = substring.MIN_WORDS, {}
    for i, t in enumerate(texts):
        for at in range(len(t) - width + 1):
            owners.setdefault(tuple(t[at : at + width]), set()).add((i, at))
    want = {place for own in owners.values() if len({i for i, _ in own}) > 1 for place in own}
    found = {(r.key, r.doc, r.pos) for r in substring.seed_table(docs(spark, rows)).collect()}
    for i, t in rows:
        keys, starts = substring.runs_of(substring.kmers_of(t), np.zeros(0, np.int64))
        named = dict(zip(starts.tolist(), keys.view(np.int64).tolist(), strict=True))
        assert all((named[at], i, at) in found for d, at in want if d == i)
    assert len(want) > 200

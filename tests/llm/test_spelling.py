import random
import re
import zlib
from collections import Counter

from pyspark.sql import types as T

from bureauframe.llm import spelling

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
     T.StructField("n", T.StringType()), T.StructField("word", T.StringType())]
)
COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and one_edit(v, w)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out, key=str)


def found(spark, rows):
    docs = spark.createDataFrame([(i, t, "n", "w") for i, t in rows], SCHEMA)
    return sorted((tuple(r) for r in spelling.variants(docs).select(COLUMNS).collect()), key=str)


def corpus(seed, stems, docs):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abéÿ") for _ in range(rng.randint(6, 11))) for _ in range(stems)]

    def word():
        w = base[min(int(rng.expovariate(0.05)), stems - 1)]
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
            i = rng.randrange(len(w) + 1)
            w = w[:i] + rng.choice(["", "a", "Z", "ü"]) + w[i + rng.randint(0, 1) :]
        return w

    return [(i, " ".join(word() for _ in range(80)) + "; Ünïted-") for i in range(docs)]


def test_against_all_pairs(spark):
    rows = corpus(1, 60, 120)
    rows += [(None, None), (None, "Seventh seventh"), (7, ""), (7, "seventh x" * 2000), (7, "seventh x" * 2000), (3, " 12 \n")]
    got = found(spark, rows)
    assert got == plain(rows)
    assert len({r[2] for r in got}) < len(got)


def test_large_groups_are_cut_finer(spark, monkeypatch):
    rows = corpus(2, 30, 60)
    want = plain(rows)
    for group in (1, 4):
        monkeypatch.setattr(spelling, "GROUP", group)
        assert found(spark, rows) == want


def test_chains_of_forms(spark):
    counts = [("abcdefg", 20000), ("abcdefgh", 1000), ("abcdefghi", 90), ("abcdefghij", 8)]
    rows = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(counts)]
    want = plain(rows)
    assert found(spark, rows) == want and {r[2] for r in want} == {"abcdefg"}


def test_empty(spark):
    assert found(spark, []) == [] and found(spark, [(1, "one two"), (2, None)]) == []


def test_scan_keeps_to_one_edit():
    rng = random.Random(3)
    for _ in range(200):
        words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(3, 6))) for _ in range(20)})
        longer = [len(w) > 4 for w in words]
        want = [
            (i, j) for i in range(len(words)) for j in range(i + 1, len(words))
            if one_edit(words[i], words[j]) and words[i] != words[j] and not (longer[i] and longer[j])
        ]
        assert sorted(spelling.scan(words, longer)) == want

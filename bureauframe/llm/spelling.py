"""Spelling variants: words of the corpus one edit apart, and the frequent form of each rare one.

Two words one edit apart agree outside one of SEGMENTS segments, so words that agree outside a segment
meet in a group. A group arrives sorted; each of its words scans the ones after it with a banded edit
matrix whose rows are kept for the prefix that neighbours in the list share (their LCP). Where a row
exceeds one edit, all words with that prefix are skipped. A group above GROUP words is not scanned: its
words meet again under shorter segments, down to single code points, where the alphabet bounds a group.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bureauframe.llm.bpe import text_batches
from bureauframe.llm.common import durable, importable

RUN = re.compile("[A-Za-zÀ-ÿ]+")
MIN_LENGTH = 7  # code points of a word
MIN_COUNT = 2
DAMAGE = 31  #: one run in so many loses a code point
RATIO = 10  #: a form is so many times as frequent as its variant
SEGMENTS = (3, 6, 1 << 20)  #: segments of a word by level; never more than it has code points
GROUP = 128
FLUSH = 1 << 17  #: words counted in a task before they are passed on


# -- words ----------------------------------------------------------------------------------------


def words_of(doc_id: int | None, text: str | None) -> Iterator[tuple[str, int]]:
    """Words of a text after damage, with their counts. A NULL doc_id is written as nothing."""
    runs = Counter(RUN.findall((text or "").encode().lower().decode()))
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in runs.items():
        if len(run) < MIN_LENGTH:
            continue
        h = zlib.crc32(run.encode(), start)
        if h % DAMAGE == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < MIN_LENGTH:
                continue
        yield run, n


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n: every word of the corpus that occurs MIN_COUNT times."""

    def each(batches):
        counts: Counter[str] = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
            )
            counts.clear()
            return out

        for batch in text_batches(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for word, n in words_of(doc_id, text):
                    counts[word] += n
            if len(counts) > FLUSH:
                yield flush()
        if counts:
            yield flush()

    counted = importable(docs).select("doc_id", "text").mapInArrow(each, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


# -- groups ---------------------------------------------------------------------------------------


def members(words: DataFrame, segments: int) -> DataFrame:
    """key, part, sorted, long, n: the groups of each word.

    A pair has lengths L and L or L + 1; a word of length l takes part for L = l and, as the longer
    one, for L = l - 1. The segment left out is [lo, hi) of L, one longer in the longer word.
    """
    m = f"least({segments}, length(word) - longer)"
    base = words.select("word", "n", F.explode(F.expr(f"IF(length(word) > {MIN_LENGTH}, array(0, 1), array(0))")).alias("longer"))
    parts = base.select("*", F.expr(f"{m} AS m"), F.explode(F.expr(f"sequence(0, {m} - 1)")).alias("part"))
    at = parts.selectExpr(
        "*", "part * (length(word) - longer) DIV m AS lo", "(part + 1) * (length(word) - longer) DIV m AS hi"
    )
    return at.selectExpr(
        "xxhash64(length(word) - longer, part, substring(word, 1, lo), substring(word, hi + longer + 1)) AS key",
        "part = 0 AS turned",
        "IF(part = 0, reverse(word), word) AS word",
        "longer = 1 AS longer",
        "n",
    )


def shared_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    i = 0
    while a[i] == b[i]:
        i += 1
    return i


def scan(words: Sequence[str], longer: Sequence[bool]) -> Iterator[tuple[int, int]]:
    """Pairs of a sorted list exactly one edit apart, of which at least one is not `longer`.

    Row d of the matrix is for the first d code points of the word in the list and holds the cells of
    d - 1, d and d + 1 code points of the query; others exceed one edit.
    """
    same = [0, *(shared_prefix(a, b) for a, b in zip(words, words[1:], strict=False))]
    far = 9
    for i, query in enumerate(words):
        size = len(query)
        rows = [(far, 0, 1)]
        dead = 0  # depth of the first row above one edit, 0 if none
        for j in range(i + 1, len(words)):
            if dead and same[j] >= dead:
                continue  # shares the prefix that is too far already
            word = words[j]
            del rows[same[j] + 1 :]
            dead = 0
            a, b, c = rows[-1]
            for d in range(len(rows) - 1, len(word)):
                ch = word[d]
                left = min(a + (d == 0 or query[d - 1] != ch), b + 1) if d <= size else far
                if d < size:
                    b = min(b + (query[d] != ch), c + 1, left + 1)
                    c = min(c + (query[d + 1] != ch), b + 1) if d + 1 < size else far
                else:
                    b = c = far
                a = left
                rows.append((a, b, c))
                if a > 1 and b > 1 and c > 1:
                    dead = d + 1
                    break
            if dead or longer[i] and longer[j]:
                continue
            gap = size - len(word)
            if -1 <= gap <= 1 and rows[-1][gap + 1] == 1:
                yield i, j


NEAR = "a string, na long, b string, nb long"
_KINDS = (pa.string(), pa.int64(), pa.string(), pa.int64())


def scanned(groups: DataFrame, limit: int | None) -> DataFrame:
    """Near pairs of every group, a < b; and (a, na, NULL, NULL) for each word of a group above `limit`."""

    def each(batches):
        key, own, full = None, [], False
        out: list[tuple] = []

        def plain(row):
            turned, word, _, n = row
            return word[::-1] if turned else word, n

        def close():
            if len(own) > 1 and not full:
                for i, j in scan([r[1] for r in own], [r[2] for r in own]):
                    (a, na), (b, nb) = sorted((plain(own[i]), plain(own[j])))
                    out.append((a, na, b, nb))

        def flush():
            columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), _KINDS, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, ["a", "na", "b", "nb"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "turned", "word", "longer", "n")]
            for k, *row in zip(*columns, strict=True):
                if k != key:
                    close()
                    key, own, full = k, [], False
                if limit and not full and len(own) == limit:
                    out += [(*plain(r), None, None) for r in own]
                    own, full = [], True
                if full:
                    out.append((*plain(row), None, None))
                else:
                    own.append(row)
            if out:
                yield flush()
        close()
        if out:
            yield flush()

    ordered = groups.repartition("key").sortWithinPartitions("key", "word")
    return ordered.mapInArrow(each, NEAR)


def near_pairs(words: DataFrame) -> DataFrame:
    """a, na, b, nb: every pair of words exactly one edit apart, once, a < b in code-point order."""
    pairs, todo = None, words
    for level, segments in enumerate(SEGMENTS):
        last = level == len(SEGMENTS) - 1
        found = durable(scanned(members(todo, segments), None if last else GROUP))
        own = found.filter("b IS NOT NULL")
        pairs = own if pairs is None else pairs.unionByName(own)
        if last:
            break
        todo = found.filter("b IS NULL").select(F.col("a").alias("word"), F.col("na").alias("n")).distinct()
        if todo.isEmpty():
            break
    return pairs.distinct()


# -- forms ----------------------------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last form of each word that has one (columns word, form).

    Each round doubles the steps taken. A form is RATIO times as frequent, so a chain is at most as
    long as the largest count has digits and the rounds are few."""
    jumps = durable(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = jumps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = durable(jumps.join(onward, "root", "left").select("word", "root", "next"))
        if moved.filter("next IS NOT NULL").isEmpty():
            return jumps
        jumps = moved.select("word", F.coalesce("next", "root").alias("root"))


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of `docs` (doc_id, text).

    NULL and empty texts have no words; a NULL doc_id is written as nothing where damage is drawn;
    repeated rows count again. Other columns are not looked at. No words, no rows."""
    words = durable(vocabulary(docs))
    pairs = near_pairs(words)
    turned = pairs.selectExpr("b AS a", "nb AS na", "a AS b", "na AS nb")
    near = (
        pairs.unionByName(turned)
        .groupBy("a")
        .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("nb")).alias("less"), "b")).alias("best"))
        .select(F.col("a").alias("word"), "n_near", F.col("best.b").alias("form"), (-F.col("best.less")).alias("form_n"))
    )
    holds = F.col("form_n") >= RATIO * F.col("n")
    joined = durable(
        words.join(near, "word", "left").select(
            "word",
            F.when(holds, F.col("form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(holds, F.col("form_n")).alias("form_n"),
        )
    )
    found = joined.join(roots(joined.filter("form IS NOT NULL")), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

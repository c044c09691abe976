"""Passages that repeat across documents, exactly or nearly, by collinear chaining.

Of each run of WINDOW k-mers the smallest hash is a seed, so any shared run of WINDOW + K - 1 words
shares a seed; both are so small that an edited passage has such a run. Each occurrence of a seed is joined
with the k-mer's first place in the corpus; one that is not the first in its document also by its
ordinal there, hence periodic text lines up too. A passage whose k-mers first stand in different documents
would fall apart, so runs of MIN_WORDS words are seeds as well: a repeated run is found against the first document
that has all of it. That is at most three rows a word, whatever the number of copies; the matches of a pair of documents are chained (Fenwick tree over the other document's positions, linear gap cost), and all
chains are aligned word by word.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bureauframe.llm.bpe import text_batches
from bureauframe.llm.common import durable, importable, n_words, scratch, spare_name, stored
from bureauframe.llm.sieve import Compressed, hits, shared_keys

MIN_WORDS = 50
MIN_SIMILARITY = 0.8
#: Words of a k-mer: of n words with a share of 1 - MIN_SIMILARITY replaced, however the places are
#: spread, a run of MIN_SIMILARITY / (1 - MIN_SIMILARITY) stays equal (for 50 words, 40 in 11 runs).
K = 4
WINDOW = 1  #: k-mers of which one is a seed: every one, for such a run may hold just one
GAP_COST = 0.1  #: of a word in either document between two seeds; a seed is worth K
MAX_GAP = 48  #: words between seeds at which a chain is cut
MARGIN = 64  #: words read beyond a chain for its extension
EDGE = 0.6  #: share of equal words below which a stretch at the end of a passage is left out
ROW_CHAINS = 256  #: chains of a document that travel in one row
SLOTS = 1 << 23  #: bits of the filter of document ids
ROUND = 1.5  #: bytes around chains that are aligned at once, for a byte of the texts
WORD_BYTES = 6  #: of a word with the space after it, about


# -- seeds ----------------------------------------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _slide(values: np.ndarray, width: int, least) -> np.ndarray:
    """Minimum or maximum of each run of `width` values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = least(out[: len(out) - step], out[step:])
        have += step
    return out


def kmers_of(text: str) -> np.ndarray:
    """Hashes of the k-mers of a text, none if it has under MIN_WORDS words."""
    words = text.encode().lower().split()
    if len(words) < MIN_WORDS:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - K + 1
    kmers = np.zeros(n, np.uint64)
    for i in range(K):
        kmers = kmers * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n]
    return _mix(kmers)


def seeds(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys and word positions of the seeds of a text, and whether the key stood in it before. A k-mer
    that stood before has a second key, with its ordinal."""
    return seeds_of(kmers_of(text))


def seeds_of(kmers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same from the k-mers of the text."""
    if not len(kmers):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool)
    low = _slide(kmers, WINDOW, np.minimum)
    edge = np.zeros(WINDOW - 1, np.uint64)
    chosen = np.flatnonzero(_slide(np.concatenate([edge, low, edge]), WINDOW, np.maximum) == kmers)
    own = kmers[chosen]
    order = np.argsort(own, kind="stable")
    ranked = own[order]
    first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    at = np.arange(len(own))
    ordinal = np.empty(len(own), np.uint64)
    ordinal[order] = at - np.maximum.accumulate(np.where(first, at, 0))
    again = ordinal > 0
    periodic = _mix(own[again] + ordinal[again] * np.uint64(0xD1B54A32D192ED03))
    return (
        np.concatenate([own, periodic]),
        np.concatenate([chosen, chosen[again]]),
        np.concatenate([again, np.zeros(len(periodic), bool)]),
    )


def runs_of(kmers: np.ndarray, alone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and word positions of the runs of MIN_WORDS words without a seed that one row alone has,
    whose word positions are `alone`: a run that two rows have is among them."""
    width = MIN_WORDS - K + 1
    failed = np.zeros(len(kmers) + 1, np.int64)
    failed[alone + 1] = 1
    failed = np.cumsum(failed)
    at = np.flatnonzero(failed[width:] == failed[:-width])
    keys = np.zeros(len(at), np.uint64)
    for i in [*range(0, width - 1, K), width - 1]:
        keys = keys * np.uint64(0x9E3779B97F4A7C15) + kmers[at + i]
    return _mix(keys), at


def seed_table(docs: DataFrame) -> DataFrame:
    """key, doc, pos: a row for each seed whose key two rows have, and for each run of MIN_WORDS words
    that has only such seeds (and a few others that pass the sieve by chance). A row of `docs` without doc_id or text has none."""
    slim = importable(docs).select(F.col("doc_id").alias("doc"), "text")
    slim = slim.filter(F.col("doc").isNotNull() & F.col("text").isNotNull())
    expected = slim.agg(F.sum(n_words("text"))).first()[0] or 1

    def keys_of(batch):
        for part in text_batches([batch]):
            found = [seeds(t)[0] for t in part.column("text").to_pylist()]
            yield np.concatenate(found), np.repeat(np.arange(len(found)), [len(f) for f in found])

    shared = docs.sparkSession.sparkContext.broadcast(Compressed(shared_keys(slim, keys_of, expected)))

    def each(batches):
        for batch in text_batches(batches):
            if not batch.num_rows:
                continue
            keys, places, owners = [], [], []
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist(), strict=True):
                kmers = kmers_of(text)
                key, pos, again = seeds_of(kmers)
                kept = hits(shared.value, key)
                own = len(key) - np.count_nonzero(again)
                runs, starts = runs_of(kmers, pos[:own][~kept[:own]])
                keys += [key[kept], runs]
                places += [pos[kept], starts]
                owners.append(np.full(np.count_nonzero(kept) + len(runs), doc, np.int64))
            columns = [
                np.concatenate(keys).view(np.int64),
                np.concatenate(owners),
                np.concatenate(places).astype(np.int32),
            ]
            if len(columns[0]):
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], ["key", "doc", "pos"])

    return slim.mapInArrow(each, "key long, doc long, pos int")


def matches(seeds_: DataFrame) -> DataFrame:
    """doc, other, pos, place: each seed of a document that an earlier one (smaller doc_id) has,
    with its first place in the first one. Linear in the seeds, however often one occurs; they are
    shuffled once."""
    first = Window.partitionBy("key").orderBy("doc", "pos").rowsBetween(Window.unboundedPreceding, 0)
    found = seeds_.select(
        "doc", F.first("doc").over(first).alias("other"), "pos", F.first("pos").over(first).alias("place")
    )
    return found.filter("doc > other")


# -- chains ---------------------------------------------------------------------------------------


def chain(xs: list[int], ys: list[int]) -> list[list[int]]:
    """Disjoint chains of matches (sorted by x, then y), best first: indices in order.

    f(j) = K + max(0, f(i) - GAP_COST * (x_j - x_i + y_j - y_i)) over i before j in both documents.
    The cost splits into a part of i and a part of j, so a Fenwick tree of prefix maxima over y
    finds the best i in logarithmic time.
    """
    rank = {y: r for r, y in enumerate(sorted(set(ys)), 1)}
    size = len(rank)
    best = [(-1e300, -1)] * (size + 1)
    score, before = [0.0] * len(xs), [-1] * len(xs)
    j = 0
    while j < len(xs):
        end = j
        while end < len(xs) and xs[end] == xs[j]:  # equal x: neither comes before the other
            end += 1
        for i in range(j, end):
            top, r = (-1e300, -1), rank[ys[i]] - 1
            while r:
                if best[r] > top:
                    top = best[r]
                r -= r & -r
            gain = top[0] - GAP_COST * (xs[i] + ys[i])
            score[i] = K + max(0.0, gain)
            before[i] = top[1] if gain > 0 else -1
        for i in range(j, end):
            item, r = (score[i] + GAP_COST * (xs[i] + ys[i]), i), rank[ys[i]]
            while r <= size:
                if item > best[r]:
                    best[r] = item
                r += r & -r
        j = end
    used = [False] * len(xs)
    chains = []
    for i in sorted(range(len(xs)), key=lambda i: (-score[i], i)):
        links = []
        while i >= 0 and not used[i]:
            used[i] = True
            links.append(i)
            i = before[i]
        if links:
            chains.append(links[::-1])
    return chains


def pieces(xs: list[int], ys: list[int], gap: int = MAX_GAP) -> Iterator[tuple[list[int], list[int]]]:
    """A chain cut where more than `gap` words stand between two seeds."""
    at = 0
    for i in range(1, len(xs) + 1):
        if i == len(xs) or max(xs[i] - xs[i - 1], ys[i] - ys[i - 1]) > gap + K:
            yield xs[at:i], ys[at:i]
            at = i


def passages(xs: list[int], ys: list[int]) -> Iterator[tuple[list[int], list[int]]]:
    """Seed positions of candidate passages: chains cut at wide gaps. Edits take any of a passage's
    seeds, and MARGIN words at either end extend even a single one to MIN_WORDS, so all count."""
    for links in chain(xs, ys):
        for own in pieces([xs[i] for i in links], [ys[i] for i in links]):
            yield own


def thinned(doc: np.ndarray, other: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which matches to keep, all of them by (doc, other): of a run of matches at consecutive words
    of both documents the first, the last and every K-th. Their k-mers hold the words between."""
    order = np.lexsort((x, x - y, other, doc))
    keys = [c[order] for c in (doc, other, x - y)]
    x = x[order]
    new = np.ones(len(x) + 1, bool)
    new[1:-1] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys]) | (x[1:] > x[:-1] + 1)
    at = np.arange(len(x))
    keep = np.zeros(len(x), bool)
    keep[order] = (at - np.maximum.accumulate(np.where(new[:-1], at, 0))) % K == 0
    keep[order] |= new[1:]
    return keep


CHAINS = "array<struct<other: bigint, xs: array<int>, ys: array<int>>>"
_CHAINS = pa.list_(
    pa.struct([("other", pa.int64()), ("xs", pa.list_(pa.int32())), ("ys", pa.list_(pa.int32()))])
)


def candidates(found: DataFrame) -> DataFrame:
    """doc, chains: chains of all pairs, up to about ROW_CHAINS of a document in a row. A document's
    matches, at most three a word, meet in one task in order."""

    def each(batches):
        carried: list[pa.RecordBatch] = []

        def close(rows: pa.Table):
            doc, other, x, y = (rows.column(c).to_numpy() for c in ("doc", "other", "pos", "place"))
            keep = np.ones(len(doc), bool)  # a run may say what a seed says
            keep[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in (doc, other, x, y)])
            doc, other, x, y = doc[keep], other[keep], x[keep], y[keep]
            keep = thinned(doc, other, x, y)
            doc, other, x, y = doc[keep], other[keep], x[keep], y[keep]
            starts = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (other[1:] != other[:-1])]))
            ends = [*starts[1:].tolist(), len(doc)]
            docs, lists = [], []
            xs, ys = x.tolist(), y.tolist()
            for lo, hi, d, o in zip(starts.tolist(), ends, doc[starts].tolist(), other[starts].tolist(), strict=True):
                own = [{"other": o, "xs": a, "ys": b} for a, b in passages(xs[lo:hi], ys[lo:hi])]
                if not docs or docs[-1] != d or len(lists[-1]) >= ROW_CHAINS:
                    docs.append(d)
                    lists.append([])
                for i in range(0, len(own), ROW_CHAINS):
                    if i:
                        docs.append(d)
                        lists.append([])
                    lists[-1] += own[i : i + ROW_CHAINS]
            return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(lists, _CHAINS)], ["doc", "chains"])

        for batch in batches:
            if not batch.num_rows:
                continue
            # The last pair may go on in the next batch.
            doc, other = batch.column("doc").to_numpy(), batch.column("other").to_numpy()
            cuts = np.flatnonzero((doc[1:] != doc[:-1]) | (other[1:] != other[:-1])) + 1
            last = int(cuts[-1]) if len(cuts) else 0
            if carried:
                before = carried[-1]
                goes_on = before.column("doc")[-1].as_py() == doc[0] and before.column("other")[-1].as_py() == other[0]
                if not goes_on or last:
                    first = int(cuts[0]) if goes_on else 0
                    yield close(pa.Table.from_batches([*carried, batch.slice(0, first)]))
                    carried, batch, last = [], batch.slice(first), last - first
            if last:
                yield close(pa.Table.from_batches([batch.slice(0, last)]))
            carried.append(batch.slice(last))
        if carried:
            yield close(pa.Table.from_batches(carried))

    ordered = found.repartition("doc").sortWithinPartitions("doc", "other", "pos", "place")
    return ordered.mapInArrow(each, f"doc long, chains {CHAINS}")


# -- alignment ------------------------------------------------------------------------------------


def _lcs(a: list[bytes], b: list[bytes]) -> tuple[int, list[int], list[int]]:
    """An integer whose first p bits hold a zero for each word of the longest common subsequence of
    a[:p] and b; the same after each word of b; and the bits of the words of a that equal it."""
    masks: dict[bytes, int] = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row, rows, equal = full, [], [masks.get(y, 0) for y in b]
    for mask in equal:
        if mask:
            hit = row & mask
            row = (row + hit | row - hit) & full
        rows.append(row)
    return row, rows, equal


def _common(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest common subsequence; both sides are at most a gap long."""
    return len(a) - _lcs(a, b)[0].bit_count()


_P, _Q = np.arange(1, MARGIN + 1, dtype=np.uint16), np.arange(1, MARGIN + 1, dtype=np.uint16)[:, None]
_BIT = np.uint64(1) << np.arange(MARGIN, dtype=np.uint64)
_FIRST = _BIT | (_BIT - np.uint64(1))  #: the first 1, 2, ... bits
_ABOVE, _BELOW = _P >= _Q, _P <= _Q
_PLACE = _P + _Q << np.uint16(1) | _ABOVE  #: nine bits: more words first, of as many the longer side a


def _extend(
    a: list[bytes], b: list[bytes], found: tuple[int, list[int], list[int]]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ways to go on from the start of a and b, to places where the last words are equal: words of a,
    words of b, and the most equal words among them. For each length of the longer side the best. Both
    have up to MARGIN words, so that a row of bits (`found`, of `_lcs`) is one number and all places are seen at once."""
    _, rows, equal = found
    if not any(equal):
        return (np.zeros(1, np.int64),) * 3
    p, q = len(a), len(b)
    hit = np.array(equal, np.uint64)[:, None] & _BIT[:p] != 0
    same = _P[:p] - np.bitwise_count(np.array(rows, np.uint64)[:, None] & _FIRST[:p])
    rank = (same << np.uint16(9) | _PLACE[:q, :p]) * hit
    above = hit & _ABOVE[:q, :p]
    best, came = np.zeros(MARGIN + 1, np.uint16), np.arange(MARGIN + 1)
    best[1 : q + 1] = (rank * _BELOW[:q, :p]).max(1)
    best[1 : p + 1] = np.maximum(best[1 : p + 1], (rank * above).max(0))
    came[1 : p + 1] = np.where(above.any(0), above.argmax(0) + 1, came[1 : p + 1])
    longer = np.flatnonzero(best)
    longer = longer[np.argsort(came[longer], kind="stable")]  # as they come, word by word of b
    top = best[longer].astype(np.int64)
    shorter = (top >> 1 & 255) - longer
    wide = top & 1 == 1
    ways = np.where(wide, longer, shorter), np.where(wide, shorter, longer), top >> 9
    return tuple(np.concatenate([[0], x]) for x in ways)


def align(
    a: list[bytes], b: list[bytes], xs: list[int], ys: list[int]
) -> tuple[int, int, int, int, int] | None:
    """Word spans in both documents and the equal words between them, from seeds in order: among the ends
    that make a passage (MIN_WORDS, MIN_SIMILARITY) those with the most equal words beyond a share
    of EDGE. None if no ends do."""
    i, j, same = xs[0], ys[0], 0
    for x, y in zip(xs, ys, strict=True):
        while i < x and j < y and a[i] == b[j]:
            i, j, same = i + 1, j + 1, same + 1
        if x > i or y > j:  # also where a seed overlaps one on another diagonal: i or j is ahead
            same += _common(a[i:x], b[j:y])
            i, j = max(i, x), max(j, y)
        while i < x + K and j < y + K and a[i] == b[j]:
            i, j, same = i + 1, j + 1, same + 1
    left = a[max(0, xs[0] - MARGIN) : xs[0]][::-1], b[max(0, ys[0] - MARGIN) : ys[0]][::-1]
    right = a[i : i + MARGIN], b[j : j + MARGIN]
    before, after = _lcs(*left), _lcs(*right)
    most = same + len(left[0]) - before[0].bit_count() + len(right[0]) - after[0].bit_count()
    if most < MIN_SIMILARITY * max(MIN_WORDS, i - xs[0], j - ys[0]):
        return None
    (lp, lq, ls), (rp, rq, rs) = _extend(*left, before), _extend(*right, after)
    own, other = (i - xs[0] + lp[:, None] + rp, j - ys[0] + lq[:, None] + rq)
    equal = same + ls[:, None] + rs
    longer = np.maximum(own, other)
    holds = (np.minimum(own, other) >= MIN_WORDS) & (equal >= MIN_SIMILARITY * longer)
    if not holds.any():
        return None
    score = np.where(holds, equal - EDGE * longer, -np.inf)
    k, m = np.unravel_index(np.argmax(score), score.shape)
    return int(xs[0] - lp[k]), int(i + rp[m]), int(ys[0] - lq[k]), int(j + rq[m]), int(equal[k, m])


def verified(
    a: list[bytes], b: list[bytes], xs: list[int], ys: list[int], gap: int = MAX_GAP
) -> Iterator[tuple[int, int, int, int, int]]:
    """Passages of a chain. One that does not hold is cut at ever smaller gaps, for a part may."""
    lo, hi = max(0, xs[0] - MARGIN), max(0, ys[0] - MARGIN)
    near, far = a[lo : xs[-1] + K + MARGIN], b[hi : ys[-1] + K + MARGIN]
    # However they are aligned, no more words are equal than this, counted roughly, then well.
    if sum(map(set(far).__contains__, near)) < MIN_SIMILARITY * MIN_WORDS:
        return
    if (Counter(near) & Counter(far)).total() < MIN_SIMILARITY * MIN_WORDS:
        return
    if found := align(a, b, xs, ys):
        yield found
    elif len(xs) > 1 and gap:
        for part in pieces(xs, ys, gap // 2):
            yield from verified(a, b, *part, gap // 2)


def id_filter(df: DataFrame, column: str, ids: DataFrame, flag: str) -> DataFrame:
    """`df` with `flag`: true where `column` is in `ids` (column id) and false in most other rows, by a
    bit map of SLOTS bits, the same size for any input, joined by words of 64. No Python worker is needed.
    It only spares shuffling rows; joins decide."""

    def slot(name: str) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(SLOTS)).cast("int")

    word, bits = (spare_name(df, n) for n in ("_word", "_bits"))
    found = (
        ids.select(slot("id").alias("s"))
        .groupBy(F.shiftright("s", 6).alias(word))
        .agg(F.bit_or(F.expr("shiftleft(1L, s & 63)")).alias(bits))
        .toArrow()
    )
    words = F.broadcast(df.sparkSession.createDataFrame(found))
    at = spare_name(df, "_slot")
    joined = df.withColumn(at, slot(column)).join(words, F.shiftright(at, 6) == F.col(word), "left")
    hit = F.coalesce(F.getbit(F.col(bits), F.col(at).bitwiseAND(63)) == 1, F.lit(False))
    return joined.withColumn(flag, hit).drop(at, word, bits)


def divided(docs: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of `docs` whose doc_id is surely not among `ids` (column id), and the others."""
    flag = spare_name(docs, "_maybe")
    flagged = id_filter(docs, "doc_id", ids, flag)
    return flagged.filter(~F.col(flag)).drop(flag), flagged.filter(F.col(flag)).drop(flag)


PASSAGE = (
    "doc_id long, start_word int, end_word int, other_doc_id long, other_start int, "
    "other_end int, same_words int, similarity double, text_hash long"
)


def aligned(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Passages that hold after alignment: MIN_WORDS words and MIN_SIMILARITY at least."""
    slim = docs.select(F.col("doc_id").alias("id"), "text").filter("id IS NOT NULL AND text IS NOT NULL")
    ids = found.select(F.col("doc").alias("id")).unionByName(found.select(F.explode("chains.other").alias("id")))
    texts = id_filter(slim, "id", ids, "maybe").filter("maybe").drop("maybe")
    cut_type = "doc long, tag long, other long, xs array<int>, ys array<int>, start int, words binary"

    def cut(batches):
        """The words of the document around each chain; the other one's are read next. Chains become
        Python objects a row at a time."""
        for batch in batches:
            for at in range(batch.num_rows):
                doc, tag, chains, text = (c[at].as_py() for c in batch.columns)
                words = text.encode().lower().split()
                rows = []
                for c in chains:
                    xs = c["xs"]
                    start = max(0, xs[0] - MARGIN)
                    piece = words[start : xs[-1] + K + MARGIN]
                    if xs[-1] - start + K <= len(piece):  # else the chain belongs to another text of that doc_id
                        rows.append((doc, tag, c["other"], xs, c["ys"], start, b" ".join(piece)))
                types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)],
                    ["doc", "tag", "other", "xs", "ys", "start", "words"],
                )

    def compare(batches):
        """A text comes once for each chain that meets it, and is read once as long as it stays the same."""
        last, other_words = None, []
        for batch in batches:
            rows = []
            *columns, texts = batch.columns
            texts = texts.cast(pa.binary())
            for at, (doc, tag, other, xs, ys, start, piece) in enumerate(
                zip(*(c.to_pylist() for c in columns), strict=True)
            ):
                text = texts[at].as_buffer()
                if last is None or not text.equals(last):
                    last, other_words = text, text.to_pybytes().lower().split()
                base = max(0, ys[0] - MARGIN)
                a, b = piece.split(), other_words[base : ys[-1] + K + MARGIN]
                if ys[-1] - base + K > len(b):
                    continue  # rows that share a doc_id: the chain belongs to the other text
                for i, end, j, other_end, same in verified(a, b, [x - start for x in xs], [y - base for y in ys]):
                    rows.append((doc, start + i, start + end, other, base + j, base + other_end,
                                 same, same / max(end - i, other_end - j), tag))
            types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(),
                     pa.int32(), pa.float64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)],
                [p.split()[0] for p in PASSAGE.split(", ")],
            )

    own = found.join(texts, found["doc"] == texts["id"]).select("doc", F.xxhash64("text").alias("tag"), "chains", "text")
    own = own.mapInArrow(cut, cut_type)
    both = own.join(texts, own["other"] == texts["id"]).select(
        "doc", "tag", "other", "xs", "ys", "start", "words", "text"
    )
    return both.mapInArrow(compare, PASSAGE)


def without_copies(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`docs` (doc_id, text) without the texts that an earlier document has just so, and a passage for
    each of these that has MIN_WORDS words: its whole text. Only texts of copies are shuffled."""
    known = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL")
    known = known.select(F.col("doc_id").alias("id"), F.md5("text").alias("digest"))
    first = known.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last")
    copies = durable(known.distinct().join(first.drop("last"), "digest").filter("id > first"))
    if copies.isEmpty():
        return docs, docs.sparkSession.createDataFrame([], PASSAGE)
    rest, touched = divided(docs, copies.select("id"))
    met = (touched["doc_id"] == copies["id"]) & (F.md5(touched["text"]) == copies["digest"])
    single = F.col("first").isNull()
    joined = touched.join(copies, met, "left").select(
        "doc_id", "first", F.when(single, F.col("text")).alias("text"), F.xxhash64("text").alias("tag"),
        F.when(~single, n_words("text").cast("int")).alias("n"),
    )
    joined = durable(joined)
    values = ["doc_id", F.lit(0), "n", "first", F.lit(0), "n", "n", F.lit(1.0), "tag"]
    names = [c.split()[0] for c in PASSAGE.split(", ")]
    whole = joined.filter(F.col("n") >= MIN_WORDS).distinct()
    whole = whole.select(*((F.col(v) if isinstance(v, str) else v).alias(c) for v, c in zip(values, names, strict=True)))
    return rest.unionByName(joined.filter(single).select("doc_id", "text")), whole


def rounds(docs: DataFrame, found: DataFrame) -> list[DataFrame]:
    """`found` by documents, in as many parts as it takes that the words around the chains of one, which travel
    to the other texts, are about ROUND times the texts: windows of chains overlap, so all of them are many times that."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 1
    xs = found.select(F.explode("chains.xs").alias("xs"))
    around = F.element_at("xs", -1) - F.element_at("xs", 1) + K + 2 * MARGIN
    words = xs.agg(F.sum(around.cast("long"))).first()[0] or 0
    n = max(1, math.ceil(words * WORD_BYTES / (ROUND * size)))
    return [found.filter(F.pmod(F.xxhash64("doc"), F.lit(n)) == i) for i in range(n)]


def repeats(docs: DataFrame) -> DataFrame:
    """Passages of `docs` (doc_id, text) that an earlier document has too.

    A row says that words start_word to end_word (exclusive, from 0) of doc_id repeat words
    other_start to other_end of other_doc_id, a smaller doc_id. A passage may be reported against
    several documents. Rows with NULL doc_id or text have no passages, nor have texts under
    MIN_WORDS words; a copy of an earlier text is one passage; rows that share a doc_id count as one document and do not repeat each other;
    `text_hash` (xxhash64) says which of their texts has the passage.
    """
    docs, copies = without_copies(importable(docs).select("doc_id", "text"))
    spark = docs.sparkSession
    chains, passages_ = scratch(spark, "chains"), scratch(spark, "passages")
    stored(candidates(matches(seed_table(docs))), chains)
    found = spark.read.schema(f"doc long, chains {CHAINS}").parquet(chains)
    for part in rounds(docs, found):
        stored(aligned(docs, part), passages_)
    return spark.read.schema(PASSAGE).parquet(passages_).unionByName(copies)


def without_repeats(docs: DataFrame, found: DataFrame) -> DataFrame:
    """`docs` with its columns, each repeated passage removed from all documents but the first.
    n_chars follows the text where both are there. Documents of which nothing is left go."""
    spans = found.groupBy(F.col("doc_id").alias("id"), "text_hash").agg(
        F.collect_set(F.struct("start_word", "end_word")).alias("spans")
    )
    spans = durable(spans)
    rest, touched = divided(docs, spans.select("id"))
    span_col, id_col, hash_col = (spare_name(docs, n) for n in ("_spans", "_id", "_hash"))
    joined = touched.join(
        spans.select(F.col("id").alias(id_col), F.col("text_hash").alias(hash_col), F.col("spans").alias(span_col)),
        (F.col("doc_id") == F.col(id_col)) & (F.xxhash64("text") == F.col(hash_col)),
        "left",
    ).drop(id_col, hash_col)

    @F.arrow_udf("string")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array(
            [
                t if s is None or t is None else remove(t, [(x["start_word"], x["end_word"]) for x in s])
                for t, s in zip(texts.to_pylist(), spans.to_pylist(), strict=True)
            ],
            pa.string(),
        )

    out = joined.withColumn("text", cut("text", span_col))
    out = out.filter(F.col(span_col).isNull() | F.col("text").isNull() | F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = F.col(span_col).isNotNull() & F.col("n_chars").isNotNull()
        length = F.length("text").cast(kind)
        out = out.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))
    return rest.unionByName(out.select(*docs.columns))


def remove(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and the white space after them."""
    raw = text.encode()
    space = np.isin(np.frombuffer(raw, np.uint8), np.frombuffer(b" \t\n\v\f\r", np.uint8))
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]])).tolist()
    out, at = [], 0
    for first, end in sorted(spans):
        lo = starts[first] if first < len(starts) else len(raw)
        hi = starts[end] if end < len(starts) else len(raw)
        out.append(raw[at : max(at, lo)])
        at = max(at, hi)
    out.append(raw[at:])
    return b"".join(out).decode()

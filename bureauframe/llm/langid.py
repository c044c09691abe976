"""Language identification by language-bitmask n-gram filters.

One Bloom filter for each language, bit-sliced: an array with a bit mask of languages at every
position, so that one look-up of an n-gram returns all languages that hold it. A document's n-grams
vote by popcount; each count is corrected for the false positives its filter gives by chance.

Training uses a bounded sample (SAMPLE_DOCS documents a language, chosen by a hash of doc_id, whole
texts). An n-gram enters the filter of a language if it is about as frequent there as in the
language that uses it most.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bureauframe.llm.common import importable

GRAM = 4  #: characters of an n-gram; the first or last may be the edge of a word
SAMPLE_DOCS = 2_000  #: training documents of a language, about
MIN_DOCS = 3  #: documents of a language that must hold an n-gram
FEW_DOCS = 12  #: with fewer training documents, a share of MIN_DOCS in proportion, one at least
BLOCK_COUNTS = 1 << 22  #: texts times languages counted at a time
OWN_SHARE = 0.25  #: least frequency of an n-gram, against the language that uses it most
SLOTS = 1 << 20  #: positions of a filter
HASHES = 3
KNOWN_SHARE = 0.25  #: documents with a smaller share of known n-grams are rejected
BATCH_CHARS = 1_000_000

UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all n-grams of the texts in order, and how many each text has.

    Letters are lower-cased, everything else is one kind of edge; n-grams with an edge inside are
    left out, those that begin or end a word stay. A word of one letter is an n-gram by itself, so a
    text with a letter has at least one.
    """
    joined = ("\0" * GRAM).join(["", *(t.lower() for t in texts), ""])
    sizes = np.array([len(t.lower()) + GRAM for t in texts], np.int64)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(_letters()[codes], codes, 0).astype(np.uint64)
    n = len(codes) - GRAM + 1
    mixed = np.zeros(n, np.uint64)
    inside = np.ones(n, bool)
    alone = (codes[:n] == 0) & (codes[1 : n + 1] != 0) & (codes[2 : n + 2] == 0)
    for i in range(GRAM):
        part = codes[i : i + n]
        mixed = mixed * np.uint64(0x100000001B3) + part
        if 0 < i < GRAM - 1:
            inside &= part != 0
    # What follows a single letter is not part of it.
    mixed[alone] = codes[1 : n + 1][alone]
    inside |= alone
    # Each text begins one character before its first letter: its first window holds the edge.
    starts = np.cumsum([0, *sizes[:-1]]).astype(np.int64) + GRAM - 1
    ends = np.append(starts[1:], n)
    counts = np.concatenate([[0], np.cumsum(inside)])
    per_text = counts[np.minimum(ends, n)] - counts[np.minimum(starts, n)]
    mixed = mixed[inside]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return mixed ^ (mixed >> np.uint64(31)), per_text


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = np.array([len(t or "") for t in batch.column("text").to_pylist()], np.int64)
    cuts = np.unique(np.cumsum(sizes) // BATCH_CHARS, return_index=True)[1] if len(sizes) else []
    for lo, hi in zip(cuts, [*cuts[1:], len(sizes)], strict=True):
        yield batch.slice(lo, hi - lo)


@dataclass(frozen=True)
class Filters:
    """Languages in code-point order; masks[s, position] has a bit for each language of slice s
    (64 a slice); `chance` is the false-positive rate of each language."""

    languages: tuple[str, ...]
    masks: np.ndarray
    chance: np.ndarray

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Corrected counts (texts x languages) and the number of n-grams of each text."""
        hashes, sizes = grams(texts)
        starts = np.cumsum(sizes) - sizes
        out = np.zeros((len(texts), len(self.languages)))
        some = sizes > 0
        for s, masks in enumerate(self.masks):
            hit = masks[(hashes & np.uint64(SLOTS - 1)).astype(np.int64)]
            for i in range(1, HASHES):
                hit &= masks[(hashes >> np.uint64(20 * i) & np.uint64(SLOTS - 1)).astype(np.int64)]
            for k in range(64 * s, min(64 * s + 64, len(self.languages))):
                bits = (hit >> hit.dtype.type(k % 64)) & hit.dtype.type(1)
                if some.any():
                    out[some, k] = np.add.reduceat(bits, starts[some], dtype=np.int64)
        out = (out - self.chance * sizes[:, None]) / (1 - self.chance)
        return np.maximum(out, 0), sizes

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language with the largest corrected count (ties: the smaller name) and the share of the
        n-grams that it knows, 0 if no language knows any. `und` and 0 for NULL or a text without
        letters, and for all texts if nothing was learned."""
        step = max(1, BLOCK_COUNTS // max(1, len(self.languages)))
        if len(texts) > step:
            parts = [self.predict(texts[i : i + step]) for i in range(0, len(texts), step)]
            return [n for p in parts for n in p[0]], [x for p in parts for x in p[1]]
        counts, sizes = self.counts([t or "" for t in texts])
        names, scores = [], []
        for row, size in zip(counts, sizes, strict=True):
            best = int(np.argmax(row)) if size and len(row) else None
            names.append(UNKNOWN if best is None else self.languages[best])
            scores.append(0.0 if best is None else float(min(1.0, row[best] / size)))
        return names, scores


def in_training(doc_id: str = "doc_id") -> Column:
    """Three of four documents, by the crc32 of doc_id as text; the rest is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 != 2, F.lit(True))


def learn(docs: DataFrame) -> Filters:
    """Filters from the training part of `docs`: doc_id, text, lang. Rows without text or label
    teach nothing. What reaches the driver is SLOTS masks for each 64 labels."""
    labelled = importable(docs).select("doc_id", "text", "lang").filter(
        in_training() & F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    size = {row["lang"]: row["count"] for row in labelled.groupBy("lang").count().collect()}
    languages = tuple(sorted(size))
    if not languages:
        return Filters((), np.zeros((1, SLOTS), np.uint8), np.zeros(0))
    # A language of few documents counts as one of FEW_DOCS: one document, or a wrong label, is not to
    # outweigh an n-gram's use in the others.
    taken = [min(size[name], SAMPLE_DOCS) for name in languages]
    known = docs.sparkSession.createDataFrame(
        [(name, k, min(1.0, SAMPLE_DOCS / size[name]), max(n, FEW_DOCS), max(1, min(MIN_DOCS, MIN_DOCS * n // FEW_DOCS)))
         for k, (name, n) in enumerate(zip(languages, taken, strict=True))],
        "name string, number int, rate double, taken long, least int",
    )
    sample = (
        labelled.join(F.broadcast(known), F.col("lang") == F.col("name"))
        .filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.col("rate") * (1 << 20))
        .select("text", F.col("number").alias("lang"))
    )

    def count(batches):
        for batch in batches:
            for part in _slices(batch):
                langs = np.array(part.column("lang").to_pylist(), np.int64)
                hashes, sizes = grams(part.column("text").to_pylist())
                docs_ = np.repeat(np.arange(len(langs)), sizes)
                order = np.lexsort((hashes, docs_))
                docs_, hashes = docs_[order], hashes[order]
                new = np.ones(len(hashes), bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (docs_[1:] != docs_[:-1])
                own = langs[docs_[new]]
                for k in np.unique(own):
                    values, times = np.unique(hashes[new][own == k], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(values), k), pa.int32()),
                         pa.array(values.view(np.int64)), pa.array(times, pa.int64())],
                        ["lang", "gram", "docs"],
                    )

    share = (F.col("docs") / F.col("taken")).alias("share")
    uses = (
        sample.mapInArrow(count, "lang int, gram long, docs long")
        .groupBy("gram", "lang")
        .agg(F.sum("docs").alias("docs"))
        .join(F.broadcast(known.drop("rate")), F.col("lang") == F.col("number"))
        .filter(F.col("docs") >= F.col("least"))
        .select("gram", "lang", share)
        .groupBy("gram")
        .agg(F.max("share").alias("top"), F.collect_list(F.struct("lang", "share")).alias("uses"))
        .select("gram", "top", F.explode("uses").alias("use"))
        .filter(F.col("use.share") >= OWN_SHARE * F.col("top"))
    )
    positions = F.explode(
        F.array(
            *(
                F.shiftrightunsigned("gram", 20 * i).bitwiseAND(F.lit(SLOTS - 1))
                for i in range(HASHES)
            )
        )
    )
    bit = F.expr("shiftleft(1L, use.lang % 64)")
    slots = (
        uses.select(positions.alias("at"), F.expr("use.lang div 64").alias("slice"), bit.alias("bit"))
        .groupBy("slice", "at")
        .agg(F.bit_or("bit").alias("mask"))
        .toArrow()
    )
    masks = np.zeros((-(-len(languages) // 64), SLOTS), np.uint64)
    at = slots.column("at").to_numpy().astype(np.int64)
    masks[slots.column("slice").to_numpy().astype(np.int64), at] = (
        slots.column("mask").to_numpy().astype(np.int64).view(np.uint64)
    )
    fill = np.array([np.mean(masks[k // 64] >> np.uint64(k % 64) & np.uint64(1)) for k in range(len(languages))])
    for width in (np.uint8, np.uint16, np.uint32):
        if len(languages) <= np.dtype(width).itemsize * 8:
            masks = masks.astype(width)
            break
    return Filters(languages, masks, np.minimum(fill**HASHES, 0.99))


def predictor(docs: DataFrame, filters: Filters):
    """A column function: text to struct(lang, score). The filters, of bounded size, are broadcast."""
    shared = importable(docs).sparkSession.sparkContext.broadcast(filters)

    @F.arrow_udf("struct<lang: string, score: double>")
    def predict(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for text in parts:
            names, scores = [], []
            for part in _slices(pa.RecordBatch.from_arrays([text], ["text"])):
                found = model.predict(part.column("text").to_pylist())
                names += found[0]
                scores += found[1]
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"]
            )

    return predict


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row; only the text decides."""
    found = predictor(docs, filters)(F.col("text"))
    return docs.select("doc_id", found.alias("found"), (~in_training()).alias("held_out")).select(
        "doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score")
    )


def accepted(found: Column) -> Column:
    """Whether the text is in a language that was learned."""
    return (found["lang"] != UNKNOWN) & (found["score"] >= KNOWN_SHARE)

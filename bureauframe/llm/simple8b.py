"""Token ids in 64-bit words (Simple-8b), written as tables of blocks and read back.

A word holds a 4-bit selector and 60 bits for as many ids as fit at one width. Selectors 1 to 14
stand for the widths below; selector 15 is the escape: the next word is one whole 64-bit id. Every
LANE ids start at a word of their own, whose offset is stored, so a reader can decode any lane, or
all lanes at once, without decoding what stands before.

A file row is a block: whole documents in order, their lengths, the position of their first id in
the part, the words and the lane offsets. Rows are written by Spark's Parquet writer, whose commit
makes a rerun or a lost executor harmless. Parts are ranges of doc_id, numbered in order.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bureauframe.llm import bpe
from bureauframe.llm.common import importable, partitions

LANE = 512  #: ids between two stored offsets
BLOCK_IDS = 262_144  #: a block is closed once it holds this many ids

# Ids per word and bits per id, by selector from 1.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE = 15


_BITS = np.array([i.bit_length() for i in range(1 << 16)], np.uint8)


def _bits(ids: np.ndarray) -> np.ndarray:
    """Bit length of each id."""
    out = _BITS[ids & np.uint64(0xFFFF)]
    for shift in (16, 32, 48):
        part = ids >> np.uint64(shift)
        if not part.any():
            break
        part &= np.uint64(0xFFFF)
        out = np.where(part != 0, _BITS[part] + np.uint8(shift), out)
    return out


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words, and the word at which each lane of LANE ids starts. Any unsigned 64-bit ids."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    # Largest bit length of each run of 1, 2, 4, ... ids; two of them give any run.
    runs = [_bits(ids)]
    while 2 << (len(runs) - 1) <= min(n, COUNTS[0]):
        half = 1 << (len(runs) - 1)
        runs.append(np.maximum(runs[-1][:-half], runs[-1][half:]))
    # Selector of the word that would start at each id: the first (most ids) that fits.
    selector = np.full(n, ESCAPE, np.uint8)
    left = (LANE - np.arange(n) % LANE).astype(np.int16)
    for s in range(len(COUNTS), 0, -1):
        count, width = COUNTS[s - 1], WIDTHS[s - 1]
        if count > n:
            break
        level = count.bit_length() - 1
        longest, size = runs[level], n - count + 1
        most = np.maximum(longest[:size], longest[count - (1 << level) :][:size])
        fits = (most <= width) & (left[:size] >= count)
        selector[:size][fits] = s
    # Follow the words of all lanes at once.
    step = np.array([0, *COUNTS, 1], np.int64)
    at = np.arange(0, n, LANE)
    ends = np.minimum(at + LANE, n)
    starts = []
    while len(at):
        starts.append(at)
        at = at + step[selector[at]]
        live = at < ends
        at, ends = at[live], ends[live]
    first = np.sort(np.concatenate(starts))
    chosen = selector[first]
    cost = np.where(chosen == ESCAPE, 2, 1)
    place = np.cumsum(cost) - cost
    words = np.zeros(int(cost.sum()), np.uint64)
    for s in np.unique(chosen):
        own = first[chosen == s]
        to = place[chosen == s]
        if s == ESCAPE:
            words[to] = np.uint64(ESCAPE)
            words[to + 1] = ids[own]
            continue
        count, width = COUNTS[s - 1], WIDTHS[s - 1]
        word = np.full(len(own), s, np.uint64)
        for k in range(count):
            word |= ids[own + k] << np.uint64(4 + k * width)
        words[to] = word
    lanes = place[np.searchsorted(first, np.arange(0, n, LANE))]
    return words, lanes


def decode(words: np.ndarray, lanes: np.ndarray | None = None) -> np.ndarray:
    """All ids. `lanes` has the word each lane starts at; without it the words are one lane. The next
    word of every lane is read at the same time, so a word after an escape is never taken for one
    with a selector."""
    if not len(words):
        return np.zeros(0, np.uint64)
    selector = (words & np.uint64(15)).astype(np.int64)
    counts = np.array([0, *COUNTS, 1], np.int64)
    at = np.zeros(1, np.int64) if lanes is None else np.asarray(lanes, np.int64)
    ends = np.append(at[1:], len(words))
    if (selector == ESCAPE).any():
        seen = []
        while len(at):
            seen.append(at)
            at = at + np.where(selector[at] == ESCAPE, 2, 1)
            live = at < ends
            at, ends = at[live], ends[live]
        starts = np.sort(np.concatenate(seen))
    else:  # every word is one of its own
        starts = np.arange(len(words))
    chosen = selector[starts]
    size = counts[chosen]
    place = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint64)
    for s in np.unique(chosen):
        own, to = starts[chosen == s], place[chosen == s]
        if s == ESCAPE:
            out[to] = words[own + 1]
            continue
        count, width = COUNTS[s - 1], WIDTHS[s - 1]
        mask = np.uint64((1 << width) - 1)
        for k in range(count):
            out[to + k] = words[own] >> np.uint64(4 + k * width) & mask
    return out


def lane(words: np.ndarray, lanes: np.ndarray, k: int) -> np.ndarray:
    """Ids k * LANE to (k + 1) * LANE, from their own words alone."""
    return decode(words[lanes[k] : lanes[k + 1] if k + 1 < len(lanes) else len(words)])


BLOCK = (
    "part int, block int, first long, doc_ids array<long>, lengths array<long>, "
    "words binary, lanes array<int>"
)


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """Encode every text and write its ids, each document closed by `end_id`, in the order of
    doc_id (NULL first; rows of one doc_id in the order of their ids).

    Part bounds are quantiles of the doc_id column alone, so no text is read for them.
    """
    spark = docs.sparkSession
    parts = partitions(spark)
    points = [i / parts for i in range(1, parts)] or [0.5]
    found = docs.agg(F.percentile_approx("doc_id", points, 10_000).alias("at")).first()
    bounds = np.array(sorted(set((found and found["at"]) or [])), np.int64)

    def packed(enc, doc_ids, rows):
        press = zstandard.ZstdCompressor(level=1)
        part = np.searchsorted(bounds, doc_ids.fill_null(-(2**63)).to_numpy(False), side="right")
        ids = pa.array([press.compress(x) for x in rows], pa.binary())
        return [pa.array(part, pa.int32()), ids]

    def blocks(batches):
        part, number, first, docs_, rows, held = None, 0, 0, [], [], 0

        def close():
            nonlocal number, first, docs_, rows, held
            lengths = [len(x) for x in rows]
            words, lanes = encode(np.concatenate(rows))
            out = {
                "part": [part], "block": [number], "first": [first], "doc_ids": [docs_],
                "lengths": [lengths], "words": [words.astype("<u8").tobytes()],
                "lanes": [lanes.tolist()],
            }
            number, first, docs_, rows, held = number + 1, first + held, [], [], 0
            return pa.RecordBatch.from_pydict(out, BLOCK_SCHEMA)

        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            for p, doc, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if p != part:
                    if rows:
                        yield close()
                    part, number, first = p, 0, 0
                ids = np.frombuffer(expand.decompress(blob), "<u4")
                docs_.append(doc)
                rows.append(np.append(ids, np.uint32(end_id)))
                held += len(ids) + 1
                if held >= BLOCK_IDS:
                    yield close()
        if rows:
            yield close()

    ordered = (
        bpe.encode_documents(docs, tokenizer, packed, "part int, ids binary")
        .repartitionById(len(bounds) + 1, F.col("part"))
        .sortWithinPartitions("part", "doc_id", "ids")
        .select("part", "doc_id", "ids")
    )
    ordered.mapInArrow(blocks, BLOCK).write.option("compression", "zstd").parquet(path)


BLOCK_SCHEMA = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int32()),
        ("first", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("words", pa.binary()),
        ("lanes", pa.list_(pa.int32())),
    ]
)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it) and ids (bytes of little-endian 32-bit
    numbers), decoded from the files. Only the size of each part, one row a part, is collected."""
    table = importable(spark.read.schema(BLOCK).parquet(path))
    total = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b)
    sizes = table.groupBy("part").agg(F.sum(total).alias("n")).orderBy("part").collect()
    base, start = {}, 0
    for row in sizes:
        base[row["part"]] = start
        start += row["n"]

    def unpacked(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode(np.frombuffer(row["words"], "<u8"), np.array(row["lanes"])).astype("<u4")
                cuts = np.cumsum([0, *row["lengths"]])
                begin = base[row["part"]] + row["first"] + cuts[:-1]
                docs = [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(begin, pa.int64()),
                     pa.array(docs, pa.binary())],
                    ["doc_id", "start", "ids"],
                )

    return table.mapInArrow(unpacked, "doc_id long, start long, ids binary")


def checksums(ids: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the unsigned crc32 of the ids of each document read back."""
    return ids.select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def crc(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())

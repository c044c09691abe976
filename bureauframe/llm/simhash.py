"""SimHash near-duplicates through deletion-variant signatures.

Two 64-bit fingerprints that differ at three bits or fewer have a 32-bit half that differs at one
bit or fewer. Every half is therefore indexed under 32 keys, one for each bit left out; an equality
join on (half, bit left out, other bits) brings all such pairs together, and the full distance is
verified. Equal fingerprints are one node, so groups of exact copies never enter the join.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bureauframe.llm.bpe import text_batches
from bureauframe.llm.common import durable, importable
from bureauframe.llm.components import components

SHINGLE = 3  #: words
SEED = 42
DISTANCE = 3
HALF = 32
#: Buckets beyond this size are divided by the bytes of the other half before they are compared.
DIVIDE = 4_096
_SHINGLES_AT_ONCE = 65_536


def fingerprint(text: str | None) -> int:
    """A bit is 1 if it is set in more than half of the shingle hashes. ASCII letters are
    lower-cased; fewer words than a shingle hash as one; no words: 0."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        words = [b" ".join(words)]
        shingles = iter(words)
        n = 1
    else:
        n = len(words) - SHINGLE + 1
        shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)), strict=False))
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64, n)
    for i in range(0, n, _SHINGLES_AT_ONCE):
        block = hashes[i : i + _SHINGLES_AT_ONCE].view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(block, axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > n, bitorder="little")
    return int(packed.view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row; NULL text has no words."""

    def each(batches):
        for batch in text_batches(batches):
            found = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"]
            )

    slim = importable(docs).select("doc_id", "text")
    return slim.mapInArrow(each, "doc_id long, fp long")


def fingerprint_column():
    """A column function: text to its fingerprint in hex digits."""

    @F.arrow_udf("string")
    def each(texts: pa.Array) -> pa.Array:
        return pa.array([f"{fingerprint(t):016x}" for t in texts.to_pylist()], pa.string())

    return each


def variants(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of unsigned fingerprints: half, bit left out and the half without it, in one number."""
    keys = []
    for half in (0, 1):
        own = fps >> np.uint64(HALF * half) & np.uint64(0xFFFFFFFF)
        for bit in range(HALF):
            tag = np.uint64((half * HALF + bit) << HALF)
            keys.append(own & ~np.uint64(1 << bit) | tag)
    return np.concatenate(keys), np.tile(fps, 2 * HALF)


def linked(fps: np.ndarray, key: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the fingerprints of one bucket as all its close pairs do.

    A pair is looked at once: where the bit left out differs, or, for equal halves, in the bucket
    of bit 0. Each member is compared with those not reached yet, so the links form trees, not all
    pairs.
    """
    half, bit = divmod(key >> HALF, HALF)
    if len(fps) > DIVIDE:
        other = fps >> np.uint64(HALF * (1 - half))
        found = []
        for byte in range(4):  # three differing bits leave one byte of the other half equal
            part = other >> np.uint64(8 * byte) & np.uint64(255)
            found += [_trees(fps[part == x], half, bit) for x in np.unique(part)]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
    return _trees(fps, half, bit)


def _trees(fps: np.ndarray, half: int, bit: int) -> tuple[np.ndarray, np.ndarray]:
    left_out = np.uint64(1 << (HALF * half + bit))
    waiting = np.ones(len(fps), bool)
    a, b = [], []
    for root in range(len(fps)):
        if not waiting[root]:
            continue
        waiting[root] = False
        reached = [root]
        while reached:
            at = fps[reached.pop()]
            rest = np.flatnonzero(waiting)
            if not len(rest):
                break
            apart = fps[rest] ^ at
            close = np.bitwise_count(apart) <= DISTANCE
            if bit:
                close &= (apart & left_out) != 0
            near = rest[close]
            waiting[near] = False
            reached += near.tolist()
            a.append(np.full(len(near), fps[root]))
            b.append(fps[near])
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def links(fps: DataFrame) -> DataFrame:
    """Edges (u, v) between distinct fingerprints `fp` that connect all close pairs."""

    def keyed(batches):
        for batch in batches:
            own = batch.column("fp").to_numpy().view(np.uint64)
            for i in range(0, len(own), 4096):
                keys, values = variants(own[i : i + 4096])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(values.view(np.int64))], ["key", "fp"]
                )

    def joined(batches):
        """Rows come in key order; a bucket may go on in the next batch."""
        held_key = np.zeros(0, np.uint64)
        held_fp = np.zeros(0, np.uint64)

        def close(keys, fps_):
            new = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            starts = np.concatenate([[0], new])
            sizes = np.diff(np.append(starts, len(keys)))
            pairs = starts[sizes == 2]  # most buckets with company hold two
            bit = keys[pairs] >> np.uint64(HALF) & np.uint64(HALF - 1)
            place = (keys[pairs] >> np.uint64(HALF)).astype(np.uint64)
            apart = fps_[pairs] ^ fps_[pairs + 1]
            near = np.bitwise_count(apart) <= DISTANCE
            near &= (bit == 0) | ((apart >> place & np.uint64(1)) != 0)
            a, b = [fps_[pairs[near]]], [fps_[pairs[near] + 1]]
            for at, size in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
                found = linked(fps_[at : at + size], int(keys[at]))
                a.append(found[0])
                b.append(found[1])
            a, b = np.concatenate(a), np.concatenate(b)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["u", "v"]
            )

        for batch in batches:
            keys = np.concatenate([held_key, batch.column("key").to_numpy().view(np.uint64)])
            fps_ = np.concatenate([held_fp, batch.column("fp").to_numpy().view(np.uint64)])
            if not len(keys):
                continue
            cut = np.searchsorted(keys, keys[-1])
            held_key, held_fp = keys[cut:].copy(), fps_[cut:].copy()
            if cut:
                yield close(keys[:cut], fps_[:cut])
        if len(held_key):
            yield close(held_key, held_fp)

    table = fps.mapInArrow(keyed, "key long, fp long")
    sorted_ = table.repartition("key").sortWithinPartitions("key")
    return sorted_.mapInArrow(joined, "u long, v long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id that links reach) of
    every row of `docs`. Repeated rows come out as often; a NULL doc_id takes part but is never the
    smallest unless nothing else is there."""
    marked = durable(fingerprints(docs))
    fps = durable(marked.groupBy("fp").agg(F.min("doc_id").alias("root")))
    labels = components(links(fps.select("fp")))
    own = fps.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "root", F.coalesce("label", "fp").alias("label")
    )
    roots = own.groupBy("label").agg(F.min("root").alias("component_id"))
    member = durable(own.join(durable(roots), "label").select("fp", "component_id"))
    return marked.join(member, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )

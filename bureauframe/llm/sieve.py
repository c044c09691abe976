"""Which keys two rows have, as a bit map of bounded size that forgets none.

Each batch sends its sorted keys, shortened to what still tells them apart, to one task for each range
of keys; keys of two rows of the batch are sent twice. A key reaches a task at most twice a batch,
however frequent it is, and a range's bits are all that comes back. Keys are hashes, so ranges are
even; a key that one row alone has passes the map by chance only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from bureauframe.llm.common import scratch, stored

MAP_BITS = 27  #: of the bit map at least: 16 MB
MOST_BITS = 29  #: of the bit map of many keys: 64 MB whatever the input
PART_KEYS = 1 << 20  #: keys a task compares


def pack(sorted_: np.ndarray) -> bytes:
    """Differences, all first bytes, then all second ones: the high ones are zero and compress."""
    return np.diff(sorted_, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


class Compressed:
    """A map that is small on its way to the workers; there `value` of the broadcast is the map itself."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def __reduce__(self):
        return _expanded, (pa.compress(self.bits, codec="zstd", asbytes=True), len(self.bits))


def _expanded(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, decompressed_size=size, codec="zstd"), np.uint8)


def hits(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the map holds each key."""
    place = (keys >> np.uint64(65 - (8 * len(bits)).bit_length())).astype(np.int64)
    return bits[place >> 3] >> (place & 7).astype(np.uint8) & 1 == 1


def shared_keys(
    rows: DataFrame,
    keys_of: Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray]]],
    expected: int,
) -> np.ndarray:
    """The map of the 64-bit keys that two rows have. `keys_of` gives keys and row numbers of a batch,
    some at a time, those of a row together; about `expected` of them in all."""
    map_bits = min(MOST_BITS, max(MAP_BITS, expected.bit_length()))
    part_bits = min(map_bits - 6, max(4, (expected // PART_KEYS).bit_length()))
    kept = min(60, max(map_bits, expected.bit_length() + 7))

    def each(batches):
        for batch in batches:
            for key, row in keys_of(batch):
                if not len(key):
                    continue
                key = key >> np.uint64(64 - kept)
                order = np.argsort(key)  # rows of a key in any order: two that stand side by side differ if any do
                key, row = key[order], row[order]
                new = np.concatenate([[True], key[1:] != key[:-1]])
                other = np.concatenate([[False], ~new[1:] & (row[1:] != row[:-1])])
                first = np.flatnonzero(new)
                twice = np.logical_or.reduceat(other, first)
                key = np.repeat(key[first], 1 + twice)
                ends = np.searchsorted(key >> np.uint64(kept - part_bits), np.arange((1 << part_bits) + 1))
                found = np.flatnonzero(ends[1:] > ends[:-1]).tolist()
                packed = [pack(key[ends[p] : ends[p + 1]]) for p in found]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(packed)], ["part", "keys"])

    def compare(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        keys = np.sort(np.concatenate([unpack(x) for x in table.column("keys").to_pylist()]))
        shared = keys[1:][keys[1:] == keys[:-1]] >> np.uint64(kept - map_bits)
        bits = np.zeros(1 << (map_bits - part_bits), np.uint8)
        bits[shared.astype(np.int64) - (part << (map_bits - part_bits))] = 1
        return pa.table({"part": pa.array([part], pa.int32()), "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    sent = rows.mapInArrow(each, "part int, keys binary")
    bits = np.zeros(1 << (map_bits - 3), np.uint8)
    size = len(bits) >> part_bits
    spark, path, kind = rows.sparkSession, scratch(rows.sparkSession, "bits"), "part int, bits binary"
    stored(sent.groupBy("part").applyInArrow(compare, kind), path)  # its shuffle files go
    for row in spark.read.schema(kind).parquet(path).toLocalIterator():
        bits[row.part * size : (row.part + 1) * size] = np.frombuffer(row.bits, np.uint8)
    return bits

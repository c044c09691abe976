"""Sharding by vector bin packing: bytes, tokens and rows are balanced together.

Equal texts are one group and stay in one shard unless a group alone is larger than a shard; such a
group is split by a hash of doc_id. Groups are placed in order of size, each where the
dot product of its vector with the residual capacity is highest. To place any number of groups in
bounded memory, small ones are first bundled by hash: BUNDLES bundles and the few groups above
1 / HEAVY of the corpus are all the driver ever sees.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bureauframe.llm.common import durable, n_words

BUNDLES = 6_144
HEAVY = 2_048  #: a group with more than this part of all bytes, tokens or rows is placed by itself
PIECES = 8  #: a group larger than a shard is split into pieces of about 1 / PIECES of one
SUBS = 1_024  #: rows of a shard are numbered in so many runs
RECORD = 8  #: bytes of a row beside its text

LAW = "bytes"


def place(vectors: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each item (rows of `vectors`: shares of the total in each dimension).

    Largest item first; the score of a shard is the dot product of the item with what is left of
    the shard's capacity. Ties go to the lower shard.
    """
    scaled = vectors * shards
    left = np.ones((shards, vectors.shape[1]))
    out = np.zeros(len(vectors), np.int64)
    for i in np.lexsort((np.arange(len(vectors)), -scaled.max(axis=1))) if len(vectors) else []:
        out[i] = np.argmax(left @ scaled[i])
        left[out[i]] -= scaled[i]
    return out


def shard(docs: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size, tokens, text_crc32, law, shard, slot and grown_shard of every row of `docs`.

    size is the UTF-8 bytes of the text plus 8, tokens its words; NULL text has neither and its
    rows form one group. Slots number the rows of a shard from 0 without gaps, in an order that
    follows from the rows. grown_shard is NULL under the law of this operator.
    """
    spark = docs.sparkSession
    text_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    rows = durable(
        docs.select(
            "doc_id",
            (text_bytes + RECORD).alias("size"),
            n_words("text").alias("tokens"),
            F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
            F.xxhash64("text").alias("group"),
        )
    )
    sums = [F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n")]
    total = rows.agg(*sums).first()
    whole = np.array([max(1, total[c] or 0) for c in ("b", "t", "n")], float)
    share = F.greatest(*(F.col(c) / F.lit(float(w)) for c, w in zip("btn", whole, strict=True)))
    heavy = [
        (row["group"], int(row["share"] * shards * PIECES) if row["share"] * shards > 1 else 1)
        for row in rows.groupBy("group")
        .agg(*sums)
        .select("group", share.alias("share"))
        .filter(F.col("share") > 1 / HEAVY)
        .collect()  # under 3 * HEAVY rows, as shares add up to 1
    ]
    wide = spark.createDataFrame(heavy, "group long, parts int")
    part = F.pmod(F.xxhash64("doc_id", "text_crc32", F.lit(1)), F.col("parts"))
    item = F.when(
        F.col("parts").isNull(), F.struct(F.pmod("group", F.lit(BUNDLES)).alias("id"), F.lit(-1).alias("part"))
    ).otherwise(F.struct(F.col("group").alias("id"), part.cast("int").alias("part")))
    rows = rows.join(F.broadcast(wide), "group", "left").withColumn("item", item)
    items = sorted(
        (tuple(r["item"]), (r["b"], r["t"], r["n"])) for r in rows.groupBy("item").agg(*sums).collect()
    )
    vectors = np.array([v for _, v in items], float).reshape(-1, 3) / whole
    found = place(vectors, shards).tolist()
    placed = spark.createDataFrame(
        [(*key, s) for (key, _), s in zip(items, found, strict=True)], "id long, part int, shard int"
    )
    sub = F.pmod(F.xxhash64("doc_id", "text_crc32", F.lit(2)), F.lit(SUBS)).cast("int")
    rows = (
        rows.select("*", "item.id", "item.part")
        .join(F.broadcast(placed), ["id", "part"])
        .select("doc_id", "size", "tokens", "text_crc32", "shard", sub.alias("sub"))
    )
    before = Window.partitionBy("shard").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    runs = rows.groupBy("shard", "sub").agg(F.count(F.lit(1)).alias("n"))
    runs = runs.select("shard", "sub", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    run = Window.partitionBy("shard", "sub").orderBy("doc_id", "text_crc32", "size")
    return rows.join(F.broadcast(runs), ["shard", "sub"]).select(
        "doc_id",
        "size",
        "tokens",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        (F.col("base") + F.row_number().over(run) - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

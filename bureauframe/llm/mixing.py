"""Mix sources to target weights by fitting subset sums.

Each source is taken whole as often as its target allows. For what is left of the budget, documents
are counted by exact length; most of it is filled in proportion to the counts, the rest by dynamic
programming over the remaining lengths (a bounded knapsack). Only then are documents picked: of each
length the wanted number, in the order of a seeded hash.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bureauframe.llm.common import durable, importable, n_words, spare_name

WEIGHTS = (5, 2, 1)
MOST = 3  #: times a source or document is taken at most
SEED = 20_240
EXACT_WORDS = 1 << 17  #: budget left to dynamic programming, about
BUCKETS = 1024  #: a length with very many documents is ranked in so many parts


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size -> the same with `number` and `target`; one row a source.

    Weights repeat over the sources in code-point order, NULL last. Without ceilings a target is
    the total times the weight's share; a source at its ceiling (`most` times its size) leaves the
    excess to the others by weight. In the order of ceiling / weight the capped sources come first,
    so running sums find the common factor in one pass.
    """
    everything = Window.partitionBy()
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    by_ratio = everything.orderBy("ratio", "number")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int"))
    ranked = (
        sources.withColumn("number", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight)
        .withColumn("ceiling", F.col("source_size") * most)
        .withColumn("ratio", F.col("ceiling") / F.col("weight"))
    )
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("ceiling").over(before), F.lit(0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    factors = ranked.withColumn("factor", left / open_weight)
    capped = F.col("factor") >= F.col("ratio")
    common = F.min_by("factor", F.when(~capped, F.struct("ratio", "number"))).over(everything)
    target = F.when(capped, F.col("ceiling").cast("double")).otherwise(F.col("common") * F.col("weight"))
    return factors.withColumn("common", common).select("source", "source_size", "number", target.alias("target"))


def fit(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each (distinct, positive) size to take so that the sizes sum up to
    `budget`, or to the nearest sum below it that is found."""
    take = np.zeros(len(sizes), np.int64)
    total = int((sizes * counts).sum())
    if budget <= 0 or not total:
        return take
    if budget >= total:
        return counts.astype(np.int64)
    share = max(0, budget - EXACT_WORDS) / total
    take = np.floor(counts * share).astype(np.int64)
    rest = budget - int((sizes * take).sum())
    order = np.argsort(-sizes)
    for i in order:  # one more of each size, largest first, until the exact part can do it
        if rest <= EXACT_WORDS:
            break
        if take[i] < counts[i] and sizes[i] <= rest:
            take[i] += 1
            rest -= int(sizes[i])
    reached = np.zeros(rest + 1, bool)
    reached[0] = True
    came_by = np.full(rest + 1, -1, np.int64)
    items: list[tuple[int, int]] = []
    for i in order:
        copies, size = int(counts[i] - take[i]), int(sizes[i])
        part = 1
        while copies > 0 and not reached[rest]:
            part = min(part, copies)
            step = part * size
            if step > rest:
                break
            new = reached[: rest + 1 - step] & ~reached[step:]
            at = np.flatnonzero(new) + step
            came_by[at] = len(items)
            reached[at] = True
            items.append((i, part))
            copies -= part
            part *= 2
        if reached[rest]:
            break
    at = int(np.flatnonzero(reached)[-1])
    while at:
        i, part = items[came_by[at]]
        take[i] += part
        at -= part * int(sizes[i])
    return take


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, taken (words taken, repeats counted) and text_hash
    (xxhash64) of every row of `docs` (doc_id, source, text).

    NULL text has size 0 and a NULL source is a source. Rows of one length and source that share a
    doc_id rank next to each other. The result depends on the rows and the seed alone.
    """
    slim = durable(
        importable(docs).select(
            "doc_id",
            "source",
            n_words("text").alias("size"),
            F.xxhash64("doc_id", F.lit(seed)).alias("order"),
            F.xxhash64("text").alias("text_hash"),
        )
    )
    sources = targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    sources = durable(
        sources.withColumn("whole", whole.cast("long")).withColumn("budget", F.round(rest).cast("long"))
    )
    known = sources.withColumnRenamed("source", "name")
    rows = durable(
        slim.join(known, F.col("source").eqNullSafe(F.col("name")))
        .drop("name")
        .withColumn("bucket", F.pmod(F.shiftrightunsigned("order", 40), F.lit(BUCKETS)))
    )
    cells = durable(
        rows.filter("budget > 0 AND size > 0")
        .groupBy("number", "budget", "size", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    lengths = cells.groupBy("number", "budget", "size").agg(F.sum("n").alias("n"))

    def fitted(frame: pd.DataFrame) -> pd.DataFrame:
        """One source: a row for each distinct length, at most as many as the longest text has words."""
        frame = frame.sort_values("size")
        take = fit(frame["size"].to_numpy(), frame["n"].to_numpy(), int(frame["budget"].iloc[0]))
        return pd.DataFrame({"number": frame["number"], "size": frame["size"], "take": take})

    plan = lengths.groupBy("number").applyInPandas(fitted, "number int, size long, take long")
    before = Window.partitionBy("number", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    rooms = (
        cells.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .join(plan, ["number", "size"])
        .select("number", "size", "bucket", (F.col("take") - F.col("before")).alias("room"))
        .filter("room > 0")
    )
    cell = Window.partitionBy("number", "size", "bucket").orderBy("order", "doc_id", "text_hash")
    picked = F.coalesce(F.row_number().over(cell) <= F.col("room"), F.lit(False)).cast("long")
    return rows.join(durable(rooms), ["number", "size", "bucket"], "left").select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("size") * (F.col("whole") + picked)).alias("taken"),
        "text_hash",
    )


def materialized(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """`docs` as the mix takes them: a row for each time a document is taken, with its columns.
    `mixed` is the result of `mix`; rows of size 0 cost nothing and stay once.

    A row is known by doc_id, source and text. Rows equal in these, which the mix may take once more
    or less, share what it takes of them."""
    spark_names = [spare_name(docs, n) for n in ("_id", "_source", "_hash", "_times", "_rows", "_copy")]
    id_, source, hash_, total, equal, copy = spark_names
    times = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(1).cast("long")
    plan = mixed.select(
        F.col("doc_id").alias(id_), F.col("source").alias(source), F.col("text_hash").alias(hash_), times.alias(total)
    )
    plan = plan.groupBy(id_, source, hash_).agg(F.sum(total).alias(total), F.count(F.lit(1)).alias(equal))
    plan = durable(plan.filter(F.col(total) > 0))
    met = (
        F.col("doc_id").eqNullSafe(F.col(id_))
        & docs["source"].eqNullSafe(F.col(source))
        & (F.xxhash64("text") == F.col(hash_))
    )
    single = docs.join(plan.filter(F.col(equal) == 1), met)
    several = docs.join(plan.filter(F.col(equal) > 1), met)
    nth = F.row_number().over(Window.partitionBy(id_, source, hash_).orderBy(F.lit(0)))
    share = F.floor(F.col(total) / F.col(equal)) + (nth <= F.col(total) % F.col(equal)).cast("long")
    several = several.withColumn(total, share).filter(F.col(total) > 0)
    rows = single.unionByName(several)
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col(total)))
    return rows.withColumn(copy, copies).select(*docs.columns)

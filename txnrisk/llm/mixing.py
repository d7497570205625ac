"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by (source, size). A source's target is met by whole
passes over it and, for what is left of the budget, by a set of its documents
whose sizes sum to the rest as nearly as can be: the same share of every size
first, then the last part by a bounded knapsack over all documents left. Which
documents of a size are taken follows from a seeded hash, so reruns agree.

What meets in one place is bounded by the number of sources and of distinct
sizes, never by the number of documents; a source or size with a third of all
rows is ranked in slices of the hash.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.llm.common import fresh_names, ready, staged, word_count

#: Slices of the seeded hash in which a group of equal source and size is ranked.
SLICES = 256


def targets(sizes: Sequence[int], weights: Sequence[float], max_repeat: float = 3.0) -> list[float]:
    """Shares of the total by weight; what exceeds ``max_repeat`` times a size goes to the others by weight."""
    out, free, budget = [0.0] * len(sizes), list(range(len(sizes))), float(sum(sizes))
    while free:
        share = budget / sum(weights[i] for i in free)
        above = [i for i in free if share * weights[i] > max_repeat * sizes[i]]
        if not above:
            for i in free:
                out[i] = share * weights[i]
            break
        for i in above:
            out[i] = float(max_repeat * sizes[i])
            budget -= out[i]
        free = [i for i in free if i not in set(above)]
    return out


def knapsack(sizes: Sequence[int], counts: Sequence[int], budget: int, beyond: int = 0) -> list[int]:
    """How many of each size to take so that their sum is nearest to ``budget``, at most ``beyond`` above it.

    Counts are split into powers of two; bit s of the table says that sum s
    can be reached with the parts so far. The part that reached a sum first
    leads back to a sum that earlier parts reach. Of two sums as near the
    lower one is taken.
    """
    limit = budget + beyond
    mask, table, first, parts = (1 << limit + 1) - 1, 1, np.zeros(limit + 1, np.int32), []
    for i, (size, count) in enumerate(zip(sizes, counts)):
        count, part = min(count, limit // size), 1
        while count > 0 and not table >> budget & 1:
            part = min(part, count)
            fresh = (table << part * size & mask) & ~table
            bits = np.frombuffer(fresh.to_bytes(limit // 8 + 1, "little"), np.uint8)
            first[np.flatnonzero(np.unpackbits(bits, bitorder="little")[:limit + 1])] = len(parts)
            parts.append((i, part, part * size))
            table |= fresh
            count -= part
            part *= 2
    best = (table & (1 << budget + 1) - 1).bit_length() - 1
    above = table >> budget + 1
    if above:
        above = (above & -above).bit_length() + budget
        best = above if above - budget < budget - best else best
    taken = [0] * len(sizes)
    while best:
        i, part, words = parts[first[best]]
        taken[i] += part
        best -= words
    return taken


def fit(sizes: Sequence[int], counts: Sequence[int], budget: int) -> list[int]:
    """How many documents of each size to take for a sum near ``budget``.

    The knapsack fits the last part of the budget, four of the largest
    documents and 65,536 words, with all documents not taken before. What the
    budget has above that is given out in the same share of every size, from
    the largest down, the part of a document that remains going to the next size.
    """
    total = sum(s * c for s, c in zip(sizes, counts))
    if budget >= total:
        return list(counts)
    order = sorted((i for i, s in enumerate(sizes) if s > 0), key=lambda i: -sizes[i])
    largest = sizes[order[0]]
    given = max(0, budget - 4 * largest - (1 << 16))
    taken, carry = [0] * len(sizes), 0  # in words, times the total
    for i in order:
        carry += sizes[i] * counts[i] * given
        taken[i] = min(counts[i], carry // (sizes[i] * total))
        carry -= taken[i] * sizes[i] * total
    left = budget - sum(s * t for s, t in zip(sizes, taken))
    more = knapsack([sizes[i] for i in order], [counts[i] - taken[i] for i in order], left, largest)
    for i, n in zip(order, more):
        taken[i] += n
    return taken


def _draw(seed: int, id_column: str, text_column: str):
    return F.xxhash64(F.lit(seed), F.col(id_column), F.col(text_column))


def _source_key(source_column: str):
    """A key that is never null, so that joins and groups need not treat null apart."""
    return F.coalesce(F.concat(F.lit("="), F.col(source_column).cast("string")), F.lit(""))


def _decide(docs: DataFrame, weights: Sequence[float], max_repeat: int, seed: int, id_column: str, text_column: str,
            source_column: str) -> DataFrame:
    """A row per document with its draw and how many copies the mix takes."""
    spark = ready(docs.sparkSession)
    sized = staged(docs.select(
        F.col(id_column).alias("id"), F.col(source_column).alias("source"),
        _source_key(source_column).alias("key"), word_count(F.col(text_column)).alias("size"),
        _draw(seed, id_column, text_column).alias("draw"))
        .withColumn("slice", F.pmod("draw", F.lit(SLICES)).cast("int")), "mix-sizes")
    # One row per source: a list as long as the list of sources.
    held = sized.groupBy("key").agg(F.sum("size").alias("source_size")).collect()
    held.sort(key=lambda row: (row.key == "", row.key))
    aims = targets([row.source_size for row in held], [weights[i % len(weights)] for i in range(len(held))], max_repeat)
    wanted = spark.createDataFrame(
        [(row.key, row.source_size, aim) for row, aim in zip(held, aims)],
        "key string, source_size long, target double")

    histogram = sized.where("size > 0").groupBy("key", "size").agg(F.count("*").alias("n")).join(wanted, "key")

    def plan(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size")
        whole, rest = divmod(round(group["target"].iloc[0]), int(group["source_size"].iloc[0]))
        whole, rest = min(whole, max_repeat), rest if whole < max_repeat else 0
        extra = fit(group["size"].tolist(), group["n"].tolist(), rest) if rest else 0
        return group.assign(whole=whole, extra=extra)[["key", "size", "whole", "extra"]]

    plans = histogram.groupBy("key").applyInPandas(plan, "key string, size long, whole long, extra long")

    # Rank by the seeded draw within (source, size): the slices' counts give where each slice begins.
    group = ["key", "size"]
    begins = (sized.groupBy(*group, "slice").agg(F.count("*").alias("n")).withColumn("earlier", F.coalesce(
        F.sum("n").over(Window.partitionBy(*group).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0))).drop("n"))
    decided = begins.join(plans, group, "left")
    ranked = sized.withColumn("rank", F.row_number().over(
        Window.partitionBy(*group, "slice").orderBy("draw", F.col("id").asc_nulls_first())))
    copies = F.coalesce(F.col("whole"), F.lit(0)) + F.when(
        F.col("earlier") + F.col("rank") <= F.col("extra"), 1).otherwise(0)
    return ranked.join(decided, [*group, "slice"]).withColumn("copies", copies.cast("int")).join(wanted, "key")


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), max_repeat: int = 3, seed: int = 0,
        id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """(id, size, source, source_size, target, copies, taken) per row of ``docs``.

    ``size`` is the text's number of words (0 for null or none), ``weights``
    repeat over the sources in code point order, null last. ``copies`` times
    the document is in the mix, ``max_repeat`` at most; ``taken`` is copies
    times size. Documents without words are never taken. Rows that repeat an
    id are documents of their own. Other columns are ignored; an empty table
    gives an empty result.
    """
    return _decide(docs, weights, max_repeat, seed, id_column, text_column, source_column).select(
        F.col("id").alias(id_column), "size", F.col("source").alias(source_column), "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def take(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), max_repeat: int = 3, seed: int = 0,
         id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """The mix itself: every row of ``docs``, all columns, as many times as ``mix`` takes it."""
    # Rows alike in id, text and source get the same number of copies but where the cut goes through them:
    # there the first of them, in any order, get one more.
    draw, key, least, extra, number, copy = fresh_names(docs, "draw", "key", "least", "extra", "number", "copy")
    given = staged(_decide(docs, weights, max_repeat, seed, id_column, text_column, source_column)
                   .groupBy(F.col("draw").alias(draw), F.col("key").alias(key))
                   .agg(F.min("copies").alias(least), (F.sum("copies") - F.min("copies") * F.count("*")).alias(extra))
                   .where((F.col(least) > 0) | (F.col(extra) > 0)), "mix-copies")
    drawn = (docs.withColumn(draw, _draw(seed, id_column, text_column))
             .withColumn(key, _source_key(source_column)))
    cut = given.where(F.col(extra) > 0)
    counted = drawn.join(given.where(F.col(extra) == 0), [draw, key]).withColumn(number, F.col(least).cast("int"))
    if not cut.isEmpty():  # else the texts need not be dealt out a second time
        first = F.row_number().over(Window.partitionBy(draw, key).orderBy(F.lit(0))) <= F.col(extra)
        counted = counted.unionByName(drawn.join(cut, [draw, key]).withColumn(
            number, (F.col(least) + F.when(first, 1).otherwise(0)).cast("int")))
    return (counted.withColumn(copy, F.explode(F.array_repeat(F.lit(1), F.col(number))))
            .select(*docs.columns))

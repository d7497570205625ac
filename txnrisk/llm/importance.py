"""Importance resampling towards a target corpus.

Every document is a bag of hashed word runs. The runs of all documents and of
the target are counted per bucket; a bucket's gain is the logarithm of how much
more often the target uses it. Gains are few and fixed in number, so they
travel as one array, and a document's weight is a sum of array elements. Gumbel
noise drawn from the document's id turns "the highest scores" into a sample
without replacement in proportion to the weights.

The cut-off score is found without sorting the table: a quantile sketch
proposes a bracket around it, exact counts outside the bracket confirm or widen
it, and only the rows inside are sorted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.common import ready, slices, staged

BUCKETS = 10_000
LONGEST_RUN = 3
LEAST_WORDS = 20

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_POSITION = (1 << 33) - 1


def _features(text: bytes) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every run of one to three words.

    The checksum of a longer run goes on from that of its beginning.
    """
    words = _WORD.findall(text.lower())  # bytes: lower() changes A-Z only
    if not words:
        return 0, np.empty(0, np.int64)
    sums = list(map(crc32, words))
    spaced = [b" " + word for word in words[1:]]
    every = sums[:]
    for length in range(1, LONGEST_RUN):
        sums = list(map(crc32, spaced[length - 1:], sums))
        every += sums
    return len(words), np.array(every, np.int64) % BUCKETS


def _documents(batch: pa.RecordBatch) -> Iterator[bytes]:
    return (text.as_py() or b"" for text in batch.column("text").cast(pa.large_binary()))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(BUCKETS, np.int64)
    for batch in slices(batches, "text"):
        for text in _documents(batch):
            counts += np.bincount(_features(text)[1], minlength=BUCKETS)
    held = np.nonzero(counts)[0]
    yield pa.record_batch([pa.array(held, pa.int32()), pa.array(counts[held], pa.int64())], ["bucket", "n"])


def bucket_counts(texts: DataFrame, text_column: str = "text") -> DataFrame:
    """``(bucket, n)``: how many word runs of all texts fall into each bucket; buckets without any are left out.

    Each task adds up its own texts, so at most one row per task and bucket is
    shuffled. Null and empty texts hold no words.
    """
    ready(texts.sparkSession)
    return (texts.select(F.col(text_column).alias("text")).mapInArrow(_counted, "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(corpus: DataFrame, target: DataFrame) -> list[int]:
    """The gain of every bucket, from the bucket counts of both sides: an array of ``BUCKETS`` integers."""
    spark = corpus.sparkSession
    s, t = (F.coalesce(F.col(n), F.lit(0)).cast("double") for n in ("s", "t"))
    every = (spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
             .join(corpus.withColumnRenamed("n", "s"), "bucket", "left")
             .join(target.withColumnRenamed("n", "t"), "bucket", "left")
             .select("bucket", s.alias("s"), t.alias("t")))
    every = staged(every, "bucket-counts")
    totals = every.agg(F.sum("s").alias("s_all"), F.sum("t").alias("t_all"))
    ratio = (F.col("t") + 1) * (F.col("s_all") + BUCKETS) / ((F.col("s") + 1) * (F.col("t_all") + BUCKETS))
    rows = (every.crossJoin(F.broadcast(totals))  # one row of totals
            .select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain")).orderBy("bucket").collect())
    return [row.gain for row in rows]


def _weighed(batches: Iterator[pa.RecordBatch], gain: list[int]) -> Iterator[pa.RecordBatch]:
    table = np.array(gain, np.int64)
    for batch in slices(batches, "text"):
        words, features, weights = [], [], []
        for text in _documents(batch):
            n, buckets = _features(text)
            words.append(n)
            features.append(len(buckets))
            weights.append(int(table[buckets].sum()))
        yield pa.record_batch([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in (words, features, weights))],
                              ["doc_id", "n_words", "n_features", "weight"])


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, rounded down, from the SHA-256 of ``seed:doc_id``; a null id counts as empty."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def weigh(docs: DataFrame, gain: list[int], *, seed: int = 42, text_column: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score)`` of every row."""
    ready(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    weighed = docs.select("doc_id", F.col(text_column).alias("text")).mapInArrow(
        partial(_weighed, gain=gain), f"doc_id {id_type}, n_words long, n_features long, weight long")
    return weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


def numbered(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` with ``number`` (1, 2, 3...) in the given order, which must tell all rows apart.

    Sorted in ranges over all executors; a row's number is its place in its
    range and the sizes of the ranges before, of which there is one per
    partition.
    """
    spark = rows.sparkSession
    placed = staged(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("place", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn("part", F.shiftright("place", 33))
    before, ranges = 0, []
    for size in placed.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect():
        ranges.append((size.part, before))
        before += size.n
    bases = spark.createDataFrame(ranges, "part long, before long")
    return (placed.join(F.broadcast(bases), "part")
            .withColumn("number", F.col("before") + F.col("place").bitwiseAND(F.lit(_POSITION)) + 1)
            .drop("part", "place", "before"))


def _bracket(scores: DataFrame, drawn: int, rows: int, spread: float) -> tuple[int, int, int]:
    """Scores between which the cut-off lies, and the exact number of rows above the upper one.

    The sketch promises its quantiles only up to an error, so the counts
    outside decide; where the cut-off is not inside, the bracket is made four
    times as wide, in the end as wide as the table.
    """
    while True:
        if spread < 1:
            ends = [max(0.0, 1 - drawn / rows - spread), min(1.0, 1 - drawn / rows + spread)]
            low, high = scores.agg(F.percentile_approx("score", ends, int(4 / spread))).first()[0]
        else:
            low, high = scores.agg(F.min("score"), F.max("score")).first()
        above, reached = scores.agg(F.count_if(F.col("score") > high), F.count_if(F.col("score") >= low)).first()
        if above < drawn <= reached:
            return low, high, above
        spread *= 4


def _order() -> tuple[Column, ...]:
    return F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row_id")


def draw(weighed: DataFrame, *, percent: int = 5, least_words: int = LEAST_WORDS, spread: float = 0.002) -> DataFrame:
    """``weighed`` with ``rank``: 1, 2, 3... of the rows drawn, null for all others.

    Of the N rows with at least ``least_words`` words the floor(percent * N /
    100) highest scores are drawn; ties go to the smaller id, a null id last.
    Repeated rows count and are drawn one by one. ``spread`` is the share of
    rows on either side of the wanted quantile that the first bracket takes.
    """
    rows = staged(weighed.withColumn("row_id", F.monotonically_increasing_id()), "weighed")
    able = F.col("n_words") >= least_words
    n = rows.where(able).count()
    drawn = percent * n // 100
    unranked = F.lit(None).cast("long")
    if not drawn:
        return rows.withColumn("rank", unranked).drop("row_id")
    low, high, above = _bracket(rows.where(able), drawn, n, spread)
    inside = rows.where(able & F.col("score").between(low, high)).select("score", "doc_id", "row_id")
    last = numbered(inside, *_order()).where(F.col("number") == drawn - above).first()
    same = F.col("doc_id").eqNullSafe(F.lit(last.doc_id))
    later = F.lit(False) if last.doc_id is None else F.col("doc_id").isNull() | (F.col("doc_id") > last.doc_id)
    tied = same & (F.col("row_id") > last.row_id)
    beyond = (F.col("score") < last.score) | ((F.col("score") == last.score) & (later | tied))
    chosen = able & ~beyond
    ranked = numbered(rows.where(chosen), *_order()).withColumnRenamed("number", "rank")
    return ranked.unionByName(rows.where(~chosen).withColumn("rank", unranked)).drop("row_id")


def resample(docs: DataFrame, target: DataFrame, *, percent: int = 5, seed: int = 42) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score, rank)`` of every row of ``docs``.

    Reads ``doc_id`` and ``text`` of ``docs`` and ``text`` of ``target``; other
    columns, whatever their names, are left alone. Null and empty texts have no
    features and weight 0. Every row is a document of its own, also where rows
    or ids repeat. An empty table gives no row; an empty target leaves
    gains that prefer what the corpus holds least of.
    """
    gain = gains(bucket_counts(docs), bucket_counts(target))
    return draw(weigh(docs, gain, seed=seed), percent=percent)

"""Embedding near-duplicates by Euclidean p-stable hashing.

Unit vectors with cosine c are sqrt(2 - 2c) apart. A table's hash is a row of
quantised random projections, floor((a . v + b) / w) with Gaussian a; near
vectors share a bucket often, far ones seldom. Vectors that share a bucket are
compared by exact cosine in double precision. The number of projections grows
with the logarithm of the number of vectors, so that chance company in a bucket
stays constant, and the number of tables follows from the wanted recall at the
threshold itself (pairs above it are found more surely).

Links are counted, not listed: a pair counts in the first table where it shares
a bucket, and each task reports per vector how many links it found and one
member of its connected group. A bucket of more than ``BLOCK`` vectors is
dealt out as pairs of blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnrisk.llm.common import ready, staged
from txnrisk.llm.components import connected_components

#: Vectors of a bucket that meet in one task at most, from either of two blocks.
BLOCK = 512

#: Chance that a pair at the threshold shares a bucket somewhere.
RECALL = 0.95

#: Far vectors that a bucket may hold by chance, about.
COMPANY = 32.0


def same_bucket(distance: float, width: float) -> float:
    """Chance that one projection puts two points at this distance into one cell."""
    r = width / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan(n: int, threshold: float, recall: float = RECALL) -> tuple[float, int, int]:
    """Cell width, projections per table and tables for ``n`` vectors."""
    near = math.sqrt(max(2 - 2 * threshold, 1e-6))
    width = 4.5 * near
    far = same_bucket(math.sqrt(2), width)
    projections = max(1, math.ceil(math.log(max(n, 2) / COMPANY) / -math.log(far)))
    chance = same_bucket(near, width) ** projections
    return width, projections, max(1, math.ceil(math.log(1 - recall) / math.log(1 - chance)))


#: Steps in which the hash takes vectors and directions. Their products add up in a
#: double without rounding, so that a vector's cells are the same in whatever batch.
STEPS, DIRECTION_STEPS = 2.0**24, 2.0**20


class Hash:
    """The tables' hash of unit vectors."""

    def __init__(self, dimension: int, width: float, projections: int, tables: int, seed: int):
        random = np.random.default_rng(seed)
        self.shape, self.width = (tables, projections), width
        self.directions = np.rint(
            random.standard_normal((dimension, tables * projections)) * DIRECTION_STEPS) / DIRECTION_STEPS
        self.offsets = random.uniform(0, width, tables * projections)
        self.mix = random.integers(1, 1 << 62, projections, dtype=np.int64) | 1

    def codes(self, unit: np.ndarray) -> np.ndarray:
        """Bucket of each vector in each table; equal cells give equal buckets."""
        steps = np.rint(unit * STEPS) / STEPS
        cells = np.floor((steps @ self.directions + self.offsets) / self.width).astype(np.int64)
        with np.errstate(over="ignore"):
            mixed = (cells.reshape(len(unit), *self.shape) * self.mix).sum(axis=2)
        return mixed ^ (mixed >> 31)


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(-1, dimension)


def usable(vector):
    """Whether a vector can link: not null, no null or non-finite component, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # no square overflows or vanishes
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _group_labels(linked: np.ndarray) -> np.ndarray:
    """Least row reachable from each row of a symmetric Boolean matrix."""
    n = len(linked)
    labels = np.arange(n)
    while True:
        least = np.where(linked, labels[None, :], n).min(axis=1, initial=n)
        new = np.minimum(labels, least)
        new = new[new]
        if (new == labels).all():
            return labels
        labels = new


def link_counts(vectors: DataFrame, threshold: float = 0.9, seed: int = 11, recall: float = RECALL,
                id_column: str = "vec_id", vector_column: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """``(id, n_links)`` of vectors with links, and ``(a, b)`` edges that connect what links connect.

    Ids must be distinct. Vectors of another length than most are compared
    among their own length.
    """
    ready(vectors.sparkSession)
    kind = vectors.schema[vector_column].dataType
    kind = kind if kind == T.ArrayType(T.FloatType(), kind.containsNull) else T.ArrayType(T.DoubleType())
    usable_rows = vectors.where(usable(F.col(vector_column)) & F.col(id_column).isNotNull()).select(
        F.col(id_column).alias("id"), F.col(vector_column).cast(kind).alias("v"))
    lengths = usable_rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).collect()
    plans = {row.d: plan(row.n, threshold, recall) for row in lengths}

    def hashes(d: int) -> Hash:
        return Hash(d, *plans[d], seed)

    def keyed(with_vectors: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            made = {d: hashes(d) for d in plans}
            for batch in batches:
                for at in range(0, batch.num_rows, 512):
                    part = batch.slice(at, 512)
                    sizes = pc.list_value_length(part.column("v")).to_numpy()
                    for d in np.unique(sizes).tolist():
                        some = part.filter(pa.array(sizes == d))
                        codes = made[d].codes(_unit(_matrix(some.column("v"), d)))
                        rows, tables = codes.shape
                        table = pa.array(np.tile(np.arange(tables, dtype=np.int32), rows))
                        take = pa.array(np.repeat(np.arange(rows), tables))
                        carried = [some.column(c).take(take) for c in ("id", "v")] if with_vectors else []
                        yield pa.RecordBatch.from_arrays(
                            [table, pa.array(codes.reshape(-1)), *carried], ["t", "bucket", "id", "v"][:2 + len(carried)])

        return run

    # Few buckets are crowded; the table of them is written, so that its size is known to the join.
    crowded = staged(
        usable_rows.mapInArrow(keyed(False), "t int, bucket long").groupBy("t", "bucket").agg(F.count("*").alias("n"))
        .where(F.col("n") > BLOCK), "lsh-crowded")
    placed = usable_rows.mapInArrow(keyed(True), T.StructType([
        T.StructField("t", T.IntegerType()), T.StructField("bucket", T.LongType()),
        T.StructField("id", T.LongType()), T.StructField("v", kind)]))
    dealt = (placed.join(crowded, ["t", "bucket"], "left")
             .withColumn("blocks", F.ceil(F.coalesce("n", F.lit(1)) / BLOCK).cast("int"))
             .withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("t", "bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                     "own", "id", "v")
             .repartition("t", "bucket", "low", "high").sortWithinPartitions("t", "bucket", "low", "high"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, Hash] = {}

        def group(t: int, low: int, high: int, own: np.ndarray, ids: np.ndarray, v: list) -> tuple | None:
            sizes = np.fromiter(map(len, v), np.int64, len(v))
            out = []
            for d in np.unique(sizes).tolist():
                here = np.flatnonzero(sizes == d)
                if len(here) < 2:
                    continue
                unit = _unit(np.array([v[i] for i in here], np.float64))
                linked = unit @ unit.T >= threshold
                np.fill_diagonal(linked, False)
                if low != high:
                    linked &= own[here][:, None] != own[here][None, :]
                if not linked.any():
                    continue
                labels = _group_labels(linked)
                if t:  # pairs that met in an earlier table were counted there
                    if d not in made:
                        made[d] = hashes(d)
                    codes = made[d].codes(unit)
                    for earlier in range(t):
                        linked &= codes[:, earlier][:, None] != codes[:, earlier][None, :]
                n = linked.sum(axis=1)
                keep = (n > 0) | (labels != np.arange(len(here)))
                out.append((ids[here][keep], n[keep], ids[here][labels[keep]]))
            return tuple(map(np.concatenate, zip(*out))) if out else None

        held = None
        for batch in _runs(batches, ["t", "bucket", "low", "high"]):
            t, low, high = (batch.column(c)[0].as_py() for c in ("t", "low", "high"))
            held = group(t, low, high, batch.column("own").to_numpy(), batch.column("id").to_numpy(),
                         [np.asarray(x) for x in batch.column("v").to_numpy(zero_copy_only=False)])
            if held:
                yield pa.record_batch([pa.array(held[0]), pa.array(held[1].astype(np.int64)), pa.array(held[2])],
                                      ["id", "n", "with"])

    found = staged(dealt.mapInArrow(compare, "id long, n long, with long"), "lsh-links")
    counted = found.groupBy("id").agg(F.sum("n").alias("n_links")).where("n_links > 0")
    return counted, found.where("id != with").select(F.col("id").alias("a"), F.col("with").alias("b")).distinct()


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """One batch per run of equal keys of two rows or more, across the input's batches."""
    rest: list[pa.RecordBatch] = []

    def joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for column in columns:
            change[1:] |= column[1:] != column[:-1]
        first = tuple(column[0] for column in columns)
        if last is not None and first != last:
            change[0] = True
        last = tuple(column[-1] for column in columns)
        cuts = np.flatnonzero(change).tolist()
        begin = 0
        for cut in [*cuts, batch.num_rows]:
            if cut > begin:
                rest.append(batch.slice(begin, cut - begin))
            if cut < batch.num_rows or cut in cuts:
                if sum(part.num_rows for part in rest) > 1:
                    yield joined(rest)
                rest = []
            begin = cut
    if sum(part.num_rows for part in rest) > 1:
        yield joined(rest)


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, seed: int = 11, recall: float = RECALL,
                    id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) per row: links at cosine ``threshold`` or more, and their components.

    Null, zero and non-finite vectors, and those with such components, link
    with nothing. Ids are taken to be distinct; a row without id has no link
    and no component and is kept. Other columns are ignored; an empty table
    gives an empty result.
    """
    counted, edges = link_counts(vectors, threshold, seed, recall, id_column, vector_column)
    labels = connected_components(edges, "a", "b").withColumnRenamed("node", "id")
    return (vectors.select(F.col(id_column).alias("id"))
            .join(counted, "id", "left").join(labels, "id", "left")
            .select(F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    F.coalesce("component", "id").alias("component_id"),
                    F.coalesce(F.col("component") == F.col("id"), F.lit(True)).alias("kept")))

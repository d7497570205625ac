"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints are cut into so few segments that two of them within the distance
agree in some segment up to one bit. Every distinct fingerprint is indexed
under each segment with each bit in turn left out; equal keys give candidates,
which are verified on the whole fingerprint. Equal fingerprints are one node
throughout, so copies cost nothing.

A key that more than ``bucket_limit`` fingerprints share would pair them all.
Those fingerprints are linked exactly and without pairs instead: two
fingerprints differ in at most two bits just when some value lies within one
bit of both, so each is filed under the 65 values around it, and all that
share a value (65 at most) are linked to their least.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnrisk.llm.common import fresh_names, ready, slices, staged
from txnrisk.llm.components import connected_components

BITS = 64
SEED = 42


def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """64-bit SimHash of the text's word shingles, as an unsigned number; 0 without words."""
    words = (text or "").encode().lower().split()  # of bytes: ASCII letters and white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle_words, len(words))
    cuts = zip(starts[:len(words) - width + 1].tolist(), ends[width - 1:].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in cuts), np.uint64, len(words) - width + 1)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 16384):
        part = hashes[at:at + 16384].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text_column: str = "text", shingle_words: int = 3,
                 name: str = "fingerprint") -> DataFrame:
    """All columns of ``docs`` and the fingerprint as a signed long.

    A column that has that name already is replaced. Null and empty texts have
    fingerprint 0.
    """
    ready(docs.sparkSession)
    others = docs.drop(name)
    result = others.withColumn(name, F.lit(0).cast("long")).schema

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_column):
            prints = [fingerprint(text, shingle_words) for text in batch.column(text_column).to_pylist()]
            signed = np.array(prints, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(signed)], [*batch.schema.names, name])

    return others.mapInArrow(add, result)


def _bucket_pairs(keys: np.ndarray, fps: np.ndarray, variant: np.ndarray, width: int, max_bits: int,
                  limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of whole runs of equal keys: verified pairs, and (fingerprint, None) of runs above the limit."""
    edges = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True])))
    mask = np.uint64((1 << width) - 1)
    for begin, end in zip(edges[:-1][np.diff(edges) > 1].tolist(), edges[1:][np.diff(edges) > 1].tolist()):
        held = fps[begin:end]
        if end - begin > limit:
            yield held, None
            continue
        a, b = np.triu_indices(end - begin, 1)
        a, b = held[a], held[b]
        differ = a ^ b
        segment, bit = divmod(int(variant[begin]), width)
        # Each pair in one bucket alone: the first segment that is close, and there the bit that differs or the first.
        keep = np.bitwise_count(differ) <= max_bits
        own = (differ >> np.uint64(segment * width)) & mask
        if bit:
            keep &= own != 0
        for earlier in range(segment):
            keep &= np.bitwise_count((differ >> np.uint64(earlier * width)) & mask) > 1
        if keep.any():
            yield a[keep], b[keep]


def _key(fps: np.ndarray, variant: np.ndarray, width: int) -> np.ndarray:
    """As the column expression in ``links``: the segment without the bit left out, and which variant it is."""
    at = (variant // width * width).astype(np.uint64)
    rest = (fps >> at) & np.uint64((1 << width) - 1) & ~(np.uint64(1) << (variant % width).astype(np.uint64))
    return rest | variant.astype(np.uint64) << np.uint64(width)


def links(prints: DataFrame, max_bits: int = 2, bucket_limit: int = 32) -> DataFrame:
    """(a, b) of distinct fingerprints (column ``fp``), enough to join all that differ in at most ``max_bits`` bits.

    Every pair within the distance that shares no crowded key is returned; of
    the others, links that connect the same fingerprints.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits is 0, 1 or 2: two segments, one of which differs by one bit at most")
    none = prints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("false")
    if max_bits == 0:
        return none
    if max_bits == 1:  # one segment: what shares a key differs in the bit left out alone
        keyed = prints.select("fp", F.explode(F.array(*[
            F.struct(F.lit(bit).alias("bit"),
                     F.col("fp").bitwiseAND(F.lit(_signed(((1 << BITS) - 1) ^ (1 << bit)))).alias("rest"))
            for bit in range(BITS)])).alias("key"))
        return keyed.groupBy("key").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).where("a < b").select("a", "b")
    width = BITS // (max_bits // 2 + 1)
    key = F.expr(f"(shiftrightunsigned(fp, variant div {width} * {width}) & {(1 << width) - 1}L"
                 f" & ~shiftleft(1L, variant % {width})) | shiftleft(cast(variant as bigint), {width})")
    ready(prints.sparkSession)
    variants = prints.select(
        "fp", F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("variant")).repartition(key).sortWithinPartitions(key)

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = (np.zeros(0, np.uint64), np.zeros(0, np.int32))  # the run that the next batch may go on with
        crowded = None  # its key, if it was above the limit already and its fingerprints are given out
        for batch in chain(batches, [None]):
            if batch is None:
                fps, variant = rest
            else:
                fps = np.concatenate((rest[0], batch.column("fp").to_numpy().view(np.uint64)))
                variant = np.concatenate((rest[1], batch.column("variant").to_numpy()))
            keys = _key(fps, variant, width)
            found = []
            if crowded is not None:
                n = int(np.argmax(keys != crowded)) if keys.size and keys[-1] != crowded else len(keys)
                found.append((fps[:n], None))
                fps, variant, keys = fps[n:], variant[n:], keys[n:]
            if batch is not None and len(keys):
                last = int(np.searchsorted(keys, keys[-1]))
                crowded = keys[-1] if len(keys) - last > bucket_limit else None
                if crowded is None:
                    rest = (fps[last:], variant[last:])
                    fps, variant, keys = fps[:last], variant[:last], keys[:last]
                else:
                    rest = (rest[0][:0], rest[1][:0])
            elif batch is not None:
                rest = (fps, variant)
            if len(keys):
                found.extend(_bucket_pairs(keys, fps, variant, width, max_bits, bucket_limit))
            for kind in (True, False):
                some = [(a, b) for a, b in found if (b is None) == kind]
                if some:
                    a = pa.array(np.concatenate([a for a, _ in some]).view(np.int64))
                    b = pa.nulls(len(a), pa.int64()) if kind else pa.array(np.concatenate([b for _, b in some]).view(np.int64))
                    yield pa.record_batch([a, b], ["a", "b"])

    candidates = staged(variants.mapInArrow(pair, "a long, b long"), "simhash-pairs")
    pairs = candidates.where("b is not null")
    crowded = candidates.where("b is null").select(F.col("a").alias("fp")).distinct()
    around = crowded.select("fp", F.explode(F.array(F.col("fp"), *[
        F.col("fp").bitwiseXOR(F.lit(_signed(1 << bit))) for bit in range(BITS)])).alias("value"))
    shared = around.groupBy("value").agg(F.collect_list("fp").alias("held"), F.min("fp").alias("a")).where(
        F.size("held") > 1)
    balls = shared.select("a", F.explode("held").alias("b")).where("a < b")
    return pairs.unionByName(balls)


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle_words: int = 3,
                    max_bits: int = 2, bucket_limit: int = 32) -> tuple[DataFrame, DataFrame]:
    """Members and classes of the near-duplicates of ``docs``.

    ``members``: (id, fingerprint) per row of ``docs``. ``classes``:
    (fingerprint, label, component_id) per distinct fingerprint, where label
    names its component by a fingerprint and component_id is the smallest id
    reachable by links of at most ``max_bits`` differing bits (ids of null
    count only where a component has no other; then it is null). Rows without words share fingerprint 0 and so one component;
    repeated rows and ids are members like others; other columns are ignored;
    an empty table gives empty results.
    """
    members = staged(fingerprints(docs.select(id_column, text_column), text_column, shingle_words)
                     .select(id_column, "fingerprint"), "simhash-members")
    least = members.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(id_column).alias("least"))
    nodes = staged(least, "simhash-nodes")
    labels = connected_components(links(nodes.select("fp"), max_bits, bucket_limit), "a", "b")
    labelled = nodes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("label"))
    smallest = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    classes = labelled.join(smallest, "label").select(F.col("fp").alias("fingerprint"), "label", "component_id")
    return members, staged(classes, "simhash-classes")


def keep_first(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """One row of each component, that of the smallest id, with the columns of ``docs``.

    Of rows that repeat this id the one with the smallest text stays, null
    first. Ids of null stay only where a component has no other.
    """
    _, classes = near_duplicates(docs, id_column, text_column, **options)
    fingerprint, label, component, rank = fresh_names(docs, "fingerprint", "label", "component", "rank")
    marked = fingerprints(docs, text_column, options.get("shingle_words", 3), fingerprint)
    named = classes.toDF(fingerprint, label, component)
    first = marked.join(named, fingerprint).where(F.col(id_column).eqNullSafe(F.col(component)))
    order = Window.partitionBy(label).orderBy(F.col(text_column).asc_nulls_first())
    return first.withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1).select(*docs.columns)

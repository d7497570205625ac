"""Named tables and layer folders."""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import DataType, StructField, StructType

from txnrisk.session import scratch


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by its one- to three-part name."""
    return spark.table(name)


def layer_path(root: str, name: str, layer: str | None = None, default_layer: str = "default") -> str:
    """Folder of a table: the given layer name as it is, else the default one."""
    chosen = default_layer if layer is None else layer.strip()
    return f"{root}/{chosen}/{name}"


#: So many deltas are never merged before the next one comes.
LEAST_DELTAS = 4

#: Columns that only the files of a table kept by key have.
_BUCKET, _NUMBER, _LIVE = "_bucket", "_number", "_live"


class LayerStore:
    """Tables of a medallion root, each rebuild published as a new folder.

    A rebuild never overwrites what its own plan reads: it is written beside
    the old version and becomes current with one appended row in the list of
    published versions. A run that dies before that leaves the table as it was.

    A table may be kept by key. Its version is then the base, in buckets by the
    hash of the key, and ``replace`` adds a delta that holds all there is now of
    the keys it names, a mark alone for those without rows. A write so costs
    what it changes; reading puts the latest delta of a key in place of what
    was before, and reading some keys opens their buckets only. Once some deltas
    hold more than half as many rows as the base, they are merged into a new one.
    """

    _ENTRY = ("table string, version string, number long, published_at timestamp, keys string, buckets int, "
              "delta boolean, rows long, schema string")

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self._seen: set[str] = set()
        self._log: list[Row] = []
        # Different tables may be written at the same time; the list of versions is one folder.
        self._listing = threading.RLock()

    def path(self, layer: str, name: str) -> str:
        return layer_path(self.root, name, layer)

    def _entries(self, layer: str, name: str) -> list[Row]:
        """The current version and the deltas after it, in order; numbered per table, clocks play no part."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_published")
        system = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        with self._listing:
            files = [str(f.getPath()) for f in system.listStatus(folder)] if system.exists(folder) else []
            new = [f for f in files if f.endswith(".parquet") and f not in self._seen]
            if new:  # a file is never changed, so what has been read of the list stays known
                self._log += self.spark.read.schema(self._ENTRY).parquet(*new).collect()
                self._seen.update(new)
            rows = sorted((row for row in self._log if row.table == f"{layer}.{name}"), key=lambda row: row.number)
        base = max((i for i, row in enumerate(rows) if not row.delta), default=0)
        return rows[base:]

    def _note(self, layer: str, name: str, version: str, number: int, schema: StructType, keys: Sequence[str] = (),
              buckets: int | None = None, delta: bool = False, rows: int | None = None) -> None:
        row = (f"{layer}.{name}", version, number, F.current_timestamp(), ",".join(keys) or None, buckets, delta, rows, schema.json())
        # Of literals: a row from Python would start a Python worker per partition of the data that it is alone in.
        listed = self.spark.range(0, 1, 1, 1).select(*[
            F.lit(value).cast(field.dataType).alias(field.name) for value, field in zip(row, DataType.fromDDL(self._ENTRY))])
        with self._listing:
            listed.write.mode("append").parquet(f"{self.root}/_published")

    def _write(self, df: DataFrame, target: str, keys: Sequence[str], buckets: int, mode: str) -> None:
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        (df.withColumn(_BUCKET, bucket).hint("rebalance", _BUCKET)
         .write.mode(mode).partitionBy(_BUCKET).parquet(target))

    def _rows(self, target: str, schema: StructType) -> int:
        """Number of rows of a folder, from the files' footers."""
        return self.spark.read.schema(_wider(schema, **{_BUCKET: "int"})).parquet(target).count()

    def read(self, layer: str, name: str, keys: DataFrame | None = None) -> DataFrame | None:
        """The table as last published; of one kept by key the rows of ``keys`` alone, if given."""
        entries = self._entries(layer, name)
        if not entries:
            return None
        base, deltas = entries[0], entries[1:]
        folder = f"{self.path(layer, name)}/{base.version}"
        if base.keys is None:
            schema = None if base.schema is None else StructType.fromJson(json.loads(base.schema))
            rows = (self.spark.read.schema(schema) if schema else self.spark.read).parquet(folder)
            return rows if keys is None else _matching(rows, keys.distinct(), keys.columns, "left_semi")
        schema = StructType.fromJson(json.loads(base.schema))
        by = base.keys.split(",")
        held = self.spark.read.schema(_wider(schema, **{_BUCKET: "int"})).parquet(folder)
        changes = self.spark.read.schema(_wider(schema, **{_LIVE: "boolean", _NUMBER: "long", _BUCKET: "int"})).parquet(
            f"{folder}-deltas").filter(F.col(_NUMBER).isin([row.number for row in deltas])) if deltas else None
        if keys is not None:
            wanted = keys.select(*by).distinct()
            bucket = F.pmod(F.xxhash64(*by), F.lit(base.buckets)).cast("int")
            numbers = [row[0] for row in wanted.select(bucket).distinct().collect()]  # no more than there are buckets
            held = held.filter(F.col(_BUCKET).isin(numbers))
            changes = changes if changes is None else changes.filter(F.col(_BUCKET).isin(numbers))
        rows = held.select(*schema.names)
        if changes is not None:
            latest = changes.groupBy(*by).agg(F.max(_NUMBER).alias("_latest"))
            fresh = _matching(changes, latest, by, "left_semi", lambda right: F.col(_NUMBER) == right["_latest"])
            rows = _matching(rows, latest, by, "left_anti").unionByName(fresh.filter(_LIVE).select(*schema.names))
        return rows if keys is None else _matching(rows, wanted, by, "left_semi")

    def merged(self, layer: str, name: str) -> DataFrame | None:
        """The table as last published, to be read more than once: its deltas are put in place once, into a scratch folder."""
        rows = self.read(layer, name)
        if rows is None or not any(row.delta for row in self._entries(layer, name)):
            return rows
        path = scratch(self.spark, name)
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def publish(self, df: DataFrame, layer: str, name: str, partition_by: Sequence[str] = (), *,
                keys: Sequence[str] = ()) -> DataFrame:
        """``df`` as the whole new content; with ``keys`` as a table kept by them."""
        entries = self._entries(layer, name)
        number = entries[-1].number + 1 if entries else 1
        version = f"version-{uuid.uuid4().hex}"
        target = f"{self.path(layer, name)}/{version}"
        if keys:
            self._write(df, target, keys, self.buckets, "overwrite")
            self._note(layer, name, version, number, df.schema, keys, self.buckets, rows=self._rows(target, df.schema))
        else:
            df.write.mode("overwrite").partitionBy(*partition_by).parquet(target)
            self._note(layer, name, version, number, df.schema)
        return self.read(layer, name)

    def replace(self, keys: DataFrame, rows: DataFrame, layer: str, name: str, by: Sequence[str]) -> DataFrame:
        """Put ``rows``, all there is now of ``keys``, in place of what the table holds of them; returns the table.

        ``rows`` are read twice, so they should be a written table.
        A table that is not there yet, or is not kept by these columns, becomes so.
        """
        by = list(by)
        entries = self._entries(layer, name)
        if not entries:
            return self.publish(rows, layer, name, keys=by)
        if entries[0].keys != ",".join(by):
            self.publish(self.read(layer, name), layer, name, keys=by)
            entries = self._entries(layer, name)
        base, number = entries[0], entries[-1].number + 1
        schema = StructType.fromJson(json.loads(base.schema))
        target = f"{self.path(layer, name)}/{base.version}-deltas/{_NUMBER}={number}"
        live = rows.select(*schema.names).withColumn(_LIVE, F.lit(True))
        gone = _matching(keys.select(*by).distinct(), rows.select(*by).distinct(), by, "left_anti")
        marks = gone.select(*[F.col(c) if c in by else F.lit(None).cast(schema[c].dataType).alias(c) for c in schema.names],
                            F.lit(False).alias(_LIVE))
        self._write(live.unionByName(marks), target, by, base.buckets, "overwrite")
        count = self._rows(target, schema)
        self._note(layer, name, base.version, number, schema, by, base.buckets, True, count)
        if len(entries) > LEAST_DELTAS and 2 * (count + sum(row.rows for row in entries[1:])) > base.rows:
            self.publish(self.read(layer, name), layer, name, keys=by)
        return self.read(layer, name)


def _wider(schema: StructType, **more: str) -> StructType:
    fields = [StructField(name, DataType.fromDDL(kind)) for name, kind in more.items()]
    return StructType([*schema.fields, *fields])


def _matching(left: DataFrame, right: DataFrame, by: Sequence[str], how: str, also=None) -> DataFrame:
    """Semi or anti join on ``by`` where null equals null."""
    right = right.withColumnsRenamed({c: f"_right_{c}" for c in by})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(right[f"_right_{c}"]) for c in by])
    return left.join(right, same if also is None else same & also(right), how)

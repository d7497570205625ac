"""Secret scans with an incremental ledger of blobs.

Every historical version of a text is a blob, addressed by the SHA-256 of its
content. A ledger records which (blob, rule, rule version) has been scanned and
what was found. A scan looks only at pairs the ledger lacks, whatever number
of paths hold the blob, appends them, and findings are joined back to all
paths. A new rule or a new version of one is scanned over all blobs, the others
are not scanned again.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.llm.common import fresh_names, ready, slices

SPANS = "array<struct<start: int, end: int>>"


@dataclass(frozen=True)
class Rule:
    """Finds spans (code points, end exclusive) of one kind of secret; a change of what it finds is a new version."""

    kind: str
    version: int
    pattern: str
    #: Any of these must occur, in lower case, for the pattern to match.
    needs: tuple[str, ...] = ()
    #: Group whose length decides, and its least length.
    group: int = 0
    least: int = 1
    flags: int = re.ASCII

    def finder(self) -> Callable[[str, str], list[tuple[int, int]]]:
        iterate, group, least, needs = re.compile(self.pattern, self.flags).finditer, self.group, self.least, self.needs

        def find(text: str, lower: str) -> list[tuple[int, int]]:
            if needs and not any(need in lower for need in needs):
                return []
            return [m.span() for m in iterate(text) if m.end(group) - m.start(group) >= least]

        return find


#: The three rules whose spans are in the digest of the findings.
BASE_RULES = (
    Rule("assign", 1,
         r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         ("password", "passwd", "secret", "token", "apikey", "api_key"), 2, 6, re.ASCII | re.IGNORECASE),
    Rule("access", 1, r"AKIA[A-Z0-9]+", ("akia",), 0, 20),
    # Runs shorter than the least length fail as a whole, so they need not match first.
    Rule("hex", 1, r"(?<![0-9a-f])[0-9a-f]{24,}", (), 0, 24),
)

#: More public token formats.
MORE_RULES = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]*PRIVATE KEY-----)?",
         ("private key-----",)),
    Rule("jwt", 1, r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", ("eyj",)),
    Rule("github", 1, r"\bgh[pousr]_[A-Za-z0-9]{36,}", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
)

RULES = BASE_RULES + MORE_RULES


def blob_id(text: Column) -> Column:
    """Address of a text's content; null counts as empty."""
    return F.unhex(F.sha2(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 256))


class Ledger:
    """Scanned (blob, rule, version) and their spans, as a growing Parquet table below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.schema = f"blob binary, rule string, version int, spans {SPANS}"

    def read(self) -> DataFrame:
        """One row per blob, rule and version. A scan that was repeated after a failure may have added it twice."""
        if not self.exists():
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path).dropDuplicates(["blob", "rule", "version"])

    def exists(self) -> bool:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop)

    def append(self, scanned: DataFrame) -> None:
        scanned.write.mode("append").parquet(self.path)


def unseen(versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...], text_column: str = "text") -> DataFrame:
    """(blob, text, todo): each blob once, with the numbers of the rules that have not scanned it in their version."""
    blobs = versions.select(blob_id(F.col(text_column)).alias("blob"),
                            F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    everything = F.array(*[F.lit(i) for i in range(len(rules))])
    if not ledger.exists():
        return blobs.dropDuplicates(["blob"]).withColumn("todo", everything)
    done = F.coalesce(*[
        F.when((F.col("rule") == rule.kind) & (F.col("version") == rule.version), i) for i, rule in enumerate(rules)])
    seen = (ledger.read().withColumn("number", done).where("number is not null")
            .groupBy("blob").agg(F.collect_set("number").alias("done")))
    complete = seen.where(F.size("done") == len(rules)).select("blob")
    # Blobs that are done go before their texts are grouped.
    todo = blobs.join(complete, "blob", "left_anti").dropDuplicates(["blob"]).join(seen, "blob", "left")
    return todo.withColumn("todo", F.array_except(everything, F.coalesce("done", F.array().cast("array<int>")))).drop("done")


def scan(versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES, text_column: str = "text") -> None:
    """Scan what the ledger lacks and append it. Null texts count as empty; an empty table adds nothing."""
    ready(versions.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finders = [rule.finder() for rule in rules]
        for batch in slices(batches, "text"):
            out: tuple[list, list, list, list] = ([], [], [], [])
            for blob, text, todo in zip(*(batch.column(c).to_pylist() for c in ("blob", "text", "todo"))):
                lower = text.lower()
                for i in todo:
                    spans = [{"start": a, "end": b} for a, b in finders[i](text, lower)]
                    for column, value in zip(out, (blob, rules[i].kind, rules[i].version, spans)):
                        column.append(value)
            yield pa.record_batch(
                [pa.array(out[0], pa.binary()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int32()),
                 pa.array(out[3], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                ["blob", "rule", "version", "spans"])

    ledger.append(unseen(versions, ledger, rules, text_column).mapInArrow(run, ledger.schema))


def findings(ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, spans): the spans of the rules' present versions, by start, then rule; blobs without any are left out."""
    number = F.coalesce(*[
        F.when((F.col("rule") == rule.kind) & (F.col("version") == rule.version), i) for i, rule in enumerate(rules)])
    return (ledger.read().where(F.size("spans") > 0).withColumn("number", number).where("number is not null")
            .groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list(F.transform(
                "spans", lambda s: F.struct(s["start"].alias("start"), F.col("number").alias("number"),
                                            s["end"].alias("end"), F.col("rule").alias("kind")))))).alias("spans")))


def with_findings(paths: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES, text_column: str = "text",
                  keep_text: bool = True) -> DataFrame:
    """All columns of ``paths`` and ``spans``, the findings of the blob each row holds, an empty array for none.

    ``keep_text=False`` drops the text before the join. A column ``spans`` is
    replaced. Every row is a path: repeated rows and ids get the same findings.
    """
    others = paths.drop("spans")
    (blob,) = fresh_names(others, "blob")
    addressed = others.withColumn(blob, blob_id(F.col(text_column)))
    addressed = addressed if keep_text else addressed.drop(text_column)
    found = findings(ledger, rules).withColumnRenamed("blob", blob)
    none = F.array().cast("array<struct<start: int, number: int, end: int, kind: string>>")
    return addressed.join(found, blob, "left").withColumn("spans", F.coalesce("spans", none)).drop(blob)


def spelled(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column, sign: str = "[SECRET]") -> Column:
    """The text with every span replaced by ``sign``; spans that overlap are replaced as one. Null stays null."""
    merged = F.aggregate(
        spans, F.array().cast(SPANS), lambda done, s: F.when(
            (F.size(done) > 0) & (s["start"] < F.element_at(done, F.greatest(F.size(done), F.lit(1)))["end"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
                F.element_at(done, F.greatest(F.size(done), F.lit(1)))["start"].alias("start"),
                F.greatest(F.element_at(done, F.greatest(F.size(done), F.lit(1)))["end"], s["end"]).alias("end")))))
        .otherwise(F.concat(done, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))))
    cut = F.aggregate(
        merged, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda state, s: F.struct(
            F.concat(state["out"], F.substring(text, state["at"] + 1, s["start"] - state["at"]), F.lit(sign)).alias("out"),
            s["end"].alias("at")),
        lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text))))
    return F.when(F.size(spans) == 0, text).otherwise(cut)

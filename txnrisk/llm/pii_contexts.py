"""Personal data by bootstrapped contextual extraction.

Strict rules find e-mail addresses, IP addresses, card and phone numbers; these
are the seeds. The words around a seed are a lexical pattern. Patterns and the
identifiers they occur with form a graph, on which Spark passes confidence to
and fro: a pattern is as good as the share of its identifiers that are known,
an identifier as likely as the patterns that hold it. Identifiers that no rule
knows, but good patterns do, are found wherever they stand.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.common import ready, slices, staged, texts

# The kinds in the order of equal starts, and the patterns of the rules.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
ADDRESS = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
NUMBER = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WHITE = " \t\n\v\f\r"

#: An identifier that no rule knows has a digit or an @, and this many characters without the marks around it.
LEAST_LENGTH = 5
MARKS = ".,;:!?()[]{}<>\"'`=|*_/\\"

#: Of a longer word beside a mention a pattern holds as many characters, those next to it.
LONGEST_WORD = 40

#: A pattern counts from so many known identifiers on; patterns and identifiers are accepted at these confidences.
LEAST_KNOWN = 3
PATTERN_CONFIDENCE = 0.75
FOUND_CONFIDENCE = 0.75
ROUNDS = 3
_UNIT = 1_000_000  # confidences are summed up as whole millionths, so that no order of rows changes them
_SALTS = 16

_HOLDER = re.compile(r"[0-9@]")
_NEXT_WORD = re.compile(r"[\x20\x09-\x0D]+([^\x20\x09-\x0D]+)")
_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32())])
_MENTION = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()), ("instance", pa.int64()),
                      ("patterns", pa.list_(pa.int64()))])
_SPANS = "array<struct<start: int, end: int, kind: int>>"
_MENTIONS = "array<struct<start: int, end: int, kind: int, instance: long, patterns: array<long>>>"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and domain; goes from the @ to the left, as a local part may be long."""
    end = 0
    for match in DOMAIN.finditer(text):
        start = at = match.start()
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            end = match.end()
            yield start, end


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for match in ADDRESS.finditer(text):
        if all(len(part) <= 3 and int(part) <= 255 for part in (p.lstrip("0") or "0" for p in match[0].split("."))):
            yield match.span()


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for match in NUMBER.finditer(text):
        digits = match[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield match.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for match in PHONE.finditer(text):
        if 9 <= sum(c in "0123456789" for c in match[0]) <= 15:
            yield match.span()


RULES = (emails, addresses, cards, phones)


def seeds(text: str) -> list[tuple[int, int, int]]:
    """(start, end, number of the kind) of what the rules find, by start, then kind."""
    return sorted(((start, end, kind) for kind, rule in enumerate(RULES) for start, end in rule(text)),
                  key=lambda span: (span[0], span[2]))


def _others(text: str, known: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Words with a digit or an @, less the marks around them, that touch nothing known."""
    done, i, reached = 0, 0, 0
    for match in _HOLDER.finditer(text):
        if match.start() < done:
            continue
        start, done = match.start(), match.end()
        while start > 0 and text[start - 1] not in WHITE:
            start -= 1
        while done < len(text) and text[done] not in WHITE:
            done += 1
        word = text[start:done].rstrip(MARKS)
        end = start + len(word)
        start = end - len(word.lstrip(MARKS))
        while i < len(known) and known[i][0] < end:
            reached = max(reached, known[i][1])
            i += 1
        if end - start >= LEAST_LENGTH and reached <= start:
            yield start, end


def _hash(*parts: str) -> int:
    value = xxhash.xxh64_intdigest("\0".join(parts).encode())
    return value - (1 << 64) if value >> 63 else value


def _word_before(text: str, end: int) -> tuple[str, int]:
    """The word that ends before ``end``, of a long one the near end, and its place."""
    while end > 0 and text[end - 1] in WHITE:
        end -= 1
    start, least = end, max(0, end - LONGEST_WORD)
    while start > least and text[start - 1] not in WHITE:
        start -= 1
    return text[start:end].strip(MARKS).lower(), start


def patterns(text: str, start: int, end: int) -> list[int]:
    """Lexical patterns around a mention: the word before, the two before, and those on either side."""
    before, at = _word_before(text, start)
    further, _ = _word_before(text, at)
    following = _NEXT_WORD.match(text, end)
    after = following[1][:LONGEST_WORD].strip(MARKS).lower() if following else ""
    made = []
    if before:
        made.append(_hash("before", before))
        if further:
            made.append(_hash("two before", further, before))
        if after:
            made.append(_hash("around", before, after))
    return made


def _mentions(text: str) -> tuple[list, list]:
    known = seeds(text)
    spans = known + [(start, end, None) for start, end in _others(text, known)]
    return ([{"start": a, "end": b, "kind": k} for a, b, k in known],
            [{"start": a, "end": b, "kind": k, "instance": _hash(text[a:b].lower()), "patterns": patterns(text, a, b)}
             for a, b, k in spans])


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        found = [_mentions(text) for text in texts(batch)]
        yield pa.record_batch(
            [batch.column("doc_id"), pa.array([f[0] for f in found], pa.list_(_SPAN)),
             pa.array([f[1] for f in found], pa.list_(_MENTION))], ["doc_id", "known", "mentions"])


def scanned(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``(row, doc_id, known, mentions)``: what the rules find in every document and all mentions with their patterns."""
    ready(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", F.col(text_column).alias("text")).mapInArrow(
        _scanned, f"doc_id {id_type}, known {_SPANS}, mentions {_MENTIONS}")
    return staged(found.withColumn("row", F.monotonically_increasing_id()), "mentions")


def _spread(rows: DataFrame, by: str, side: DataFrame, key: str) -> DataFrame:
    """Inner join on ``key`` where many of ``rows`` may share one: they are dealt over salts, ``side`` repeated."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(_SALTS)).cast("int"))
    copies = side.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(_SALTS)])))
    return salted.join(copies, [key, "salt"]).drop("salt")


def score_graph(edges: DataFrame, known: DataFrame, *, rounds: int = ROUNDS) -> DataFrame:
    """``(instance, kind, confidence)`` of the identifiers found, in millionths.

    ``edges`` holds distinct pairs of ``pattern`` and ``instance``, ``known``
    distinct pairs of ``instance`` and ``kind``. In a round, a pattern's
    confidence in a kind is the sum of its identifiers' over their number and
    one more, if it has ``LEAST_KNOWN`` accepted ones at least; an identifier's
    is one less the product of its accepted patterns' doubts. Known ones
    stay certain. Every round is written and read again.
    """
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("size")).where(F.col("size") >= LEAST_KNOWN)
    edges = staged(_spread(edges, "instance", sizes, "pattern"), "edges")
    certain = known.withColumn("confidence", F.lit(_UNIT).cast("long"))
    labels, found = certain, certain.limit(0)
    for _ in range(rounds):
        good = (_spread(edges, "pattern", labels, "instance").groupBy("pattern", "kind")
                .agg(F.sum("confidence").alias("sum"), F.count("*").alias("accepted"), F.first("size").alias("size"))
                .withColumn("confidence", F.floor(F.col("sum") / (F.col("size") + 1)).cast("long"))
                .where((F.col("accepted") >= LEAST_KNOWN) & (F.col("confidence") >= int(PATTERN_CONFIDENCE * _UNIT)))
                .select("pattern", "kind", "confidence"))
        doubt = F.floor(-_UNIT * F.log(1 - F.col("confidence") / _UNIT)).cast("long")
        likely = (_spread(edges.drop("size"), "instance", good, "pattern").groupBy("instance", "kind")
                  .agg(F.sum(doubt).alias("doubts"))
                  .select("instance", "kind", F.floor(_UNIT * (1 - F.exp(-F.col("doubts") / _UNIT))).cast("long")
                          .alias("confidence"))
                  .where(F.col("confidence") >= int(FOUND_CONFIDENCE * _UNIT)))
        found = staged(likely.join(known.select("instance").distinct(), "instance", "left_anti"), "found")
        labels = certain.unionByName(found)
    return found


def find(docs: DataFrame, *, text_column: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """``(doc_id, known, spans)`` of every row: what the rules find, and that with what was discovered besides.

    Spans hold ``start``, ``end`` and the number of the ``kind``, ordered by
    start, then kind, in code points. Discovered spans touch none of the
    rules'; one that several kinds claim goes to the most confident, ties to
    the first. Reads ``doc_id`` and the text only, whatever other columns are
    called. Null and empty texts have no spans. Repeated rows and ids are rows
    of their own with the same spans; repeats count once in the graph, as it
    holds distinct pairs. An empty table gives no row.
    """
    documents = scanned(docs, text_column)
    mentions = documents.select("row", F.explode("mentions").alias("m")).select("row", "m.*")
    known = staged(mentions.where("kind is not null").select("instance", "kind").distinct(), "known")
    edges = mentions.select("instance", F.explode("patterns").alias("pattern")).distinct()
    found = score_graph(edges, known, rounds=rounds)
    best = found.groupBy("instance").agg(
        F.min(F.struct((-F.col("confidence")).alias("rank"), "kind")).alias("best")).select("instance", "best.kind")
    span = F.struct("start", "end", "kind")
    more = (_spread(mentions.where("kind is null").select("row", "start", "end", "instance"), "row", best, "instance")
            .groupBy("row").agg(F.collect_list(span).alias("more")))
    ordered = F.array_sort(
        F.concat("known", F.coalesce("more", F.array().cast(_SPANS))),
        lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["kind"] - b["kind"]))
    return documents.drop("mentions").join(more, "row", "left").select("doc_id", "known", ordered.alias("spans"))


def spelled(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")

"""The corpus operators applied to their whole tables, with their SQL twins where SQL has one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.llm import (
    conversation_repair, embedding_lsh, importance, language_id, mixing, ordinal_quality, pii_contexts, secret_ledger,
    sentencepiece_codec, simhash, token_store, warc, weak_supervision,
)
from txnrisk.llm.common import read_table
from txnrisk.session import scratch


def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document and whether they decode to its text (with U+2581 read as a space)."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    both = sentencepiece_codec.round_trip(docs)
    plain = F.translate(F.coalesce("text", F.lit("")), sentencepiece_codec.MARK, " ")
    return both.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids",
                       F.crc32(F.encode("decoded", "UTF-8")).alias("decoded_crc32"),
                       (F.col("decoded") == plain).alias("round_trip"))


def op2_ordinal_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Expected grade, probability of the clean grade and verdict of every document."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    model = ordinal_quality.train(docs, read_table(spark, folder, "labels"))
    return ordinal_quality.score(docs, model).drop("text")


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    """What the archives written from all pages hold of each."""
    path = scratch(spark, "warc")
    warc.write_archives(read_table(spark, folder, "pages"), path)
    records = warc.read_archives(spark, path, payloads=False).where("gap_reason is null")
    return records.select(
        warc.page_number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.page_number("refers_to").alias("refers_to"))


def op4_token_store(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's place in the token files and the checksum of its ids."""
    path = scratch(spark, "token-store")
    token_store.write(read_table(spark, folder, "documents"), path)
    return token_store.read(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("token_ids").alias("ids_crc32"))


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document, through a new ledger."""
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    ledger = secret_ledger.Ledger(spark, scratch(spark, "secret-ledger"))
    secret_ledger.scan(docs, ledger)
    found = secret_ledger.with_findings(docs, ledger, keep_text=False)

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = [rule.kind for rule in secret_ledger.BASE_RULES]
    return found.select(
        "doc_id", *map(number, base),
        F.sha2(F.encode(secret_ledger.spelled(F.filter("spans", lambda s: s["kind"].isin(base))), "UTF-8"), 256)
        .alias("base_sha256"),
        secret_ledger.spelled(F.col("spans")).alias("spans"))


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    members, classes = simhash.near_duplicates(read_table(spark, folder, "documents"))
    return members.join(classes, "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op7_embedding_lsh(spark: SparkSession, folder: str) -> DataFrame:
    """Links and component of every embedding."""
    return embedding_lsh.near_duplicates(read_table(spark, folder, "embeddings"))


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """What the mix takes of every document."""
    return mixing.mix(read_table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of every document; a quarter of them is held out of training."""
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    docs = read_table(spark, folder, "documents").select("doc_id", "text", "lang").withColumn(
        "held_out", F.coalesce(part == 2, F.lit(False)))
    model = language_id.train(docs.where(~F.col("held_out")))
    return language_id.predict(docs.select("doc_id", "held_out", "text"), model).drop("text")


def op10_weak_supervision(spark: SparkSession, folder: str) -> DataFrame:
    """Counts, votes, posterior quality and verdict of every document."""
    return weak_supervision.judge(read_table(spark, folder, "documents"))


def op11_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document, by rules and by the contexts learned from what they find."""
    found = pii_contexts.find(read_table(spark, folder, "documents"))
    return found.select(
        "doc_id", *[pii_contexts.count_of(F.col("known"), kind).alias(f"n_{kind}") for kind in pii_contexts.KINDS],
        F.sha2(F.encode(pii_contexts.spelled(F.col("known")), "UTF-8"), 256).alias("base_sha256"),
        pii_contexts.spelled(F.col("spans")).alias("spans"))


def op12_importance(spark: SparkSession, folder: str) -> DataFrame:
    """Weight, score and rank of every document in a draw of 5 % towards the benchmark's texts."""
    return importance.resample(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults, cheapest repair and hash of the repaired turns of every damaged conversation."""
    return conversation_repair.repair(conversation_repair.damage(read_table(spark, folder, "conversations")))


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_ordinal_quality": op2_ordinal_quality,
    "op3_warc": op3_warc,
    "op4_token_store": op4_token_store,
    "op5_secret_scan": op5_secret_scan,
    "op6_simhash": op6_simhash,
    "op7_embedding_lsh": op7_embedding_lsh,
    "op8_mixing": op8_mixing,
    "op9_language_id": op9_language_id,
    "op10_weak_supervision": op10_weak_supervision,
    "op11_pii": op11_pii,
    "op12_importance": op12_importance,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE = {
    "op3_warc": """
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
        m AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id FROM p)
        SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + ((('0x' || substr(h, 1 + (i // 4) * 5, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER, 1)), '')
                   AS payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM m""",
}

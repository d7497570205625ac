import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tests.llm.conftest import EDGE_ROWS
from txnrisk.llm import importance as imp
from txnrisk.llm.common import read_table

FOLDER = "/root/testdata/sf0.001"


def features(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    runs = [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), Counter(crc32(run.encode()) % 10000 for run in runs)


def brute_force(docs, target):
    """doc number -> (doc_id, n_features, weight, score, rank), by the contract's words."""
    held = [(doc_id, *features(text)) for doc_id, text in docs]
    s, t = Counter(), Counter()
    for _, _, buckets in held:
        s += buckets
    for text in target:
        t += features(text)[1]
    all_s, all_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000.0) / ((s[b] + 1) * (all_t + 10000.0))))

    rows, able = [], []
    for doc_id, words, buckets in held:
        weight = sum(gain(b) * n for b, n in buckets.items())
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, sum(buckets.values()), weight, score, None])
        if words >= 20:
            able.append(rows[-1])
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(able[:5 * len(able) // 100], 1):
        row[4] = rank
    return sorted(map(tuple, rows), key=repr)


def collected(frame):
    return sorted((tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in frame.collect()), key=repr)


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in read_table(spark, FOLDER, "documents").collect()]
    target = [r.text for r in read_table(spark, FOLDER, "benchmark").collect()]
    found = queries()["op12_importance"](spark, FOLDER)
    assert dict(found.dtypes) | {"n_words": "bigint"} == dict.fromkeys(
        ["doc_id", "n_words", "n_features", "weight", "score", "rank"], "bigint")
    assert collected(found) == brute_force(docs, target)


def test_edge_rows(spark, edge, nothing):
    target = spark.createDataFrame([(1, "Tie one two"), (2, None)], "item_id long, text string")
    docs = edge.selectExpr("*", "1 AS score", "2 AS row_id", "3 AS rank", "4 AS n", "5 AS place", "6 AS weight")
    expected = brute_force([(r[0], r[1]) for r in EDGE_ROWS], ["Tie one two", None])
    assert collected(imp.resample(docs, target)) == expected
    assert imp.resample(nothing, target).count() == 0
    assert imp.resample(edge, nothing).count() == len(EDGE_ROWS)


@pytest.mark.parametrize("percent, spread", [(1, 0.002), (5, 0.3), (50, 1.0), (100, 0.002)])
def test_ties_repeats_and_wrong_brackets(spark, percent, spread):
    """Scores alike for most rows: whatever the sketch proposes, the right rows get the right ranks."""
    rows = [(None if i % 50 == 0 else i % 97, 30 if i % 3 else 5, 0, 0, 7 if i % 4 else i % 11) for i in range(1500)]
    frame = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long")
    drawn = [r for r in imp.draw(frame, percent=percent, spread=spread).collect() if r.rank is not None]
    able = sorted(((-r[4], r[0] is None, r[0] or 0) for r in rows if r[1] >= 20))
    assert [(-r.score, r.doc_id is None, r.doc_id or 0) for r in sorted(drawn, key=lambda r: r.rank)] == able[:percent * len(able) // 100]
    assert sorted(r.rank for r in drawn) == list(range(1, len(drawn) + 1))


def test_bracket_widens(spark, monkeypatch):
    """A sketch that is far off costs another round, not a wrong cut-off."""
    scores = spark.range(10_000).select(F.col("id").alias("doc_id"), F.col("id").alias("score"))
    monkeypatch.setattr(imp.F, "percentile_approx", lambda *_: F.array(F.lit(1), F.lit(2)))
    assert imp._bracket(scores, 500, 10_000, 0.1) == (0, 9999, 0)

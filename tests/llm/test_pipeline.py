import re

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tests.llm import plain
from tests.llm.test_mixing import words
from txnrisk.llm import sentencepiece_codec
from txnrisk.llm.common import read_table, staged

FOLDER = "/root/testdata/sf0.001"
SECRET = re.compile(r"AKIA[A-Z0-9]{16,}|[0-9a-f]{24,}")


def test_stages(spark):
    docs = read_table(spark, FOLDER, "documents")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    labels = {r.doc_id: r for r in read_table(spark, FOLDER, "labels").collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "simhash_near_dedup", "secret_scan", "mix_sources", "sentencepiece"]
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, FOLDER), name)
        assert docs.columns[:len(columns)] == columns
        rows = docs.collect()
        after = {r.doc_id: r for r in rows}
        if name == "quality_classifier":
            assert all(after[i] == before[i] for i in after)
            rated = {i: (x.quality == 1 and x.toxic == 0) for i, x in labels.items()}
            # Fitted on 87 ratings only, which teach it little; how well it grades is tested on larger samples.
            assert sum(i in after for i, clean in rated.items() if clean) >= 0.9 * sum(rated.values())
            assert not all(i in after for i, clean in rated.items() if not clean)
        elif name == "simhash_near_dedup":
            prints = {i: plain.simhash(r.text) for i, r in before.items()}
            label = plain.components(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 2)
            least = {}
            for i in sorted(prints):
                least.setdefault(label[prints[i]], i)
            assert sorted(after) == sorted(least.values()) and all(after[i] == before[i] for i in after)
        elif name == "secret_scan":
            assert sorted(after) == sorted(before)
            assert all(r.text == before[i].text or "[SECRET]" in r.text for i, r in after.items())
            assert not any(SECRET.search(r.text) for r in rows)
        elif name == "mix_sources":
            assert all(after[i] == before[i] for i in after)
            assert max(sum(r.doc_id == i for r in rows) for i in after) <= 3
            total = sum(words(r.text) for r in before.values())
            assert sum(words(r.text) for r in rows) == pytest.approx(total, rel=0.02)
        else:
            assert len(rows) == len(last)
            assert all(sentencepiece_codec.pieces().decode(r.token_ids) == r.text.replace("▁", " ") for r in rows)
        before, last = after, rows


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_each_stage_takes_odd_rows(spark, edge, nothing, name, stage):
    rows = stage(spark, edge, FOLDER)
    assert rows.columns[:len(edge.columns)] == edge.columns
    rows.collect()
    assert stage(spark, nothing, FOLDER).count() == 0


def test_registered():
    names = queries()
    assert {re.match(r"op\d+", n)[0] for n in names if re.match(r"op\d+_", n)} == {f"op{i}" for i in range(1, 11)}
    assert names["pipeline"] is corpus_pipeline.run and "pipeline" not in oracle_sql()

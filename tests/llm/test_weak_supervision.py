import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.llm.conftest import EDGE_ROWS
from txnrisk.llm import weak_supervision as ws
from txnrisk.llm.common import read_table


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times, covered = {}, set()
    for w in windows:
        times[w] = times.get(w, 0) + 1
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered |= {i, i + 1, i + 2}
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines)}


def check(spark, texts):
    rows = ws.text_counts(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()
    for r in rows:
        assert {k: r[k] for k in counts(r.text)} == counts(r.text), r.text


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=st.sampled_from("ab \n\t\r\x0b#*é😀 "), max_size=40), min_size=20, max_size=40))
def test_counts_equal_plain(spark, texts):
    check(spark, texts)


def test_repeats_of_many_windows(spark):
    passage = " ".join(f"w{i}" for i in range(3000))
    check(spark, [passage, f"{passage} {passage}", f"{passage} between {passage} after", "x " * 500, "a b c d a b c e a b c",
                  "\n".join(["one line", "two", "one line", "", "one line "] * 30), None, ""])


def test_estimate_of_known_accuracies(spark):
    import random
    draw = random.Random(6)
    good, bad, share = (0.95, 0.9, 0.97, 0.99), (0.8, 0.9, 0.6, 0.1), 0.7
    rows = []
    for _ in range(20_000):
        is_good = draw.random() < share
        rows.append(tuple(0 if draw.random() < 0.1 else (1 if draw.random() < g else -1) if is_good else (-1 if draw.random() < b else 1)
                          for g, b in zip(good, bad)))
    found = ws.estimate(spark.createDataFrame(rows, "a int, b int, c int, d int"), list("abcd"))
    assert found.on_good == pytest.approx(good, abs=0.04) and found.on_bad == pytest.approx(bad, abs=0.06)
    assert found.share == pytest.approx(share, abs=0.04)


def test_query(spark):
    from txnrisk.llm.queries import op10_weak_supervision
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in read_table(spark, folder, "documents").collect()}
    rows = op10_weak_supervision(spark, folder).collect()
    assert len(rows) == len(docs)
    for r in rows:
        plain = counts(docs[r.doc_id])
        assert {k: r[k] for k in plain} == plain
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    labels = {r.doc_id: (r.quality, r.toxic) for r in read_table(spark, folder, "labels").collect()}
    own = {k: [r.kept for r in rows if not r.base_failed and r.doc_id in labels and labels[r.doc_id][0] == k] for k in (0, 1)}
    assert sum(own[1]) >= 0.99 * len(own[1]) and sum(own[0]) <= 0.1 * len(own[0])


def test_no_python_in_the_plan(edge, capsys):
    ws.text_counts(edge.sparkSession.read.parquet("/root/testdata/sf0.001/documents.parquet")).explain("formatted")
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


def test_edge_rows(edge, nothing):
    rows = ws.judge(edge.selectExpr("*", "1 AS n_words", "2 AS vote_length", "3 AS posterior")).collect()
    assert len(rows) == len(EDGE_ROWS)
    assert all(r.base_failed and not r.kept for r in rows)
    assert ws.judge(nothing).count() == 0

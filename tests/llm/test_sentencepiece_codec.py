import itertools
import math

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import EDGE_ROWS
from txnrisk.llm import sentencepiece_codec as codec
from txnrisk.llm.common import read_table

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=codec.MODEL)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abeinrst ▁\n\t0é日😀<>xA.,_-"), max_size=60) | st.text(max_size=40))
def test_ids_equal_the_library(text):
    model = codec.pieces()
    ids = model.encode([text])[0].tolist()
    assert ids == LIBRARY.encode(text)
    assert model.decode(ids) == text.replace("▁", " ")


def test_long_runs():
    texts = ["a" * 5000, "=" * 3000, " " * 2000, "ab" * 2500, "é日" * 800]
    assert [ids.tolist() for ids in codec.pieces().encode(texts)] == LIBRARY.encode(texts)


def test_prefixes_are_walked_once(monkeypatch):
    model = codec.Pieces(codec.MODEL)
    steps = []
    step = codec.Pieces.step
    monkeypatch.setattr(codec.Pieces, "step", lambda self, word, end, states: steps.append(word[:end]) or step(self, word, end, states))
    model.segment(["▁interest", "▁interesting", "▁interested", "▁inter"])
    assert len(steps) == len(set(steps)) == len("▁interesting") + len("ed")


def test_unigram_is_the_best_sum():
    model = codec.Pieces(codec.MODEL, "unigram")
    for word in ("▁token", "▁there", "abcab", "▁xé☃y"):
        def best(rest):
            if not rest:
                return 0.0
            options = [model.scores[model.ids[rest[:n]]] + best(rest[n:]) for n in range(1, len(rest) + 1) if rest[:n] in model.ids]
            if rest[0] not in model.ids:
                options.append(model.floor + best(rest[1:]))
            return max(options, default=-math.inf)
        ids = model.segment([word])[word]
        assert model.decode(ids) == word.replace("▁", " ").removeprefix(" ")
        score = sum(model.scores[i] for i in ids if i not in set(model.byte_ids.values()))
        score += model.floor * sum(1 for c in word if c not in model.ids)
        assert score == pytest.approx(best(word))


def test_segmentations_of_the_merges_are_unique():
    """The step's premise: of all segmentations, just one has neighbours that stay apart."""
    model = codec.pieces()
    for word in ("▁there", "ation", "▁ttion"):
        valid = []
        for cuts in itertools.product((0, 1), repeat=len(word) - 1):
            parts, start = [], 0
            for end in [i + 1 for i, cut in enumerate(cuts) if cut] + [len(word)]:
                parts.append(word[start:end])
                start = end
            if all(p in model.ids for p in parts) and all(
                    model.merged(a + b) == [a, b] for a, b in zip(parts, parts[1:])) and all(model.merged(p) == [p] for p in parts):
                valid.append(parts)
        assert valid == [model.merged(word)]


def test_edge_rows(edge, nothing):
    both = codec.decode(codec.encode(edge))
    assert both.columns == [*edge.columns, "token_ids", "decoded"]
    rows = both.collect()
    assert sorted((r.decoded for r in rows)) == sorted((row[1] or "").replace("▁", " ") for row in EDGE_ROWS)
    assert all(r.token_ids == LIBRARY.encode(r.text or "") for r in rows)
    assert codec.decode(codec.encode(nothing)).count() == 0
    again = codec.encode(codec.encode(edge).withColumnRenamed("token_ids", "x").selectExpr("*", "'old' as token_ids"))
    assert again.columns[-1] == "token_ids" and dict(again.dtypes)["token_ids"] == "array<int>"


def test_query(spark):
    from txnrisk.llm.queries import op1_sentencepiece
    rows = {r.doc_id: r for r in op1_sentencepiece(spark, "/root/testdata/sf0.001").collect()}
    docs = read_table(spark, "/root/testdata/sf0.001", "documents").collect()
    assert len(rows) == len(docs)
    for doc in docs:
        row = rows[doc.doc_id]
        assert row.token_ids == LIBRARY.encode(doc.text) and row.round_trip
        assert row.n_tokens == len(row.token_ids) and row.decoded_crc32 == codec.crc32(doc.text)

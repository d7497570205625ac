import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnrisk.llm import language_id as lid
from txnrisk.llm.common import read_table

PIECES = {"▁": 1, "a": 2, "b": 3, "ab": 4, "▁a": 5, "ba": 6}
Q = [0.001, 0.1, 0.2, 0.3, 0.15, 0.12, 0.08]


@pytest.fixture(autouse=True)
def forget():
    """What is remembered holds for one vocabulary; these tests bring their own."""
    lid._BEGINNINGS.clear()
    lid._PIECES.clear()
    yield
    lid._BEGINNINGS.clear()
    lid._PIECES.clear()


def segmentations(word):
    for cuts in itertools.product((0, 1), repeat=len(word) - 1):
        parts, start = [], 0
        for end in [i + 1 for i, cut in enumerate(cuts) if cut] + [len(word)]:
            parts.append(word[start:end])
            start = end
        numbers = [PIECES.get(p, 0 if len(p) == 1 else None) for p in parts]
        if None not in numbers:
            yield numbers


@pytest.mark.parametrize("word", ["▁a", "▁abab", "▁baab", "▁xab", "▁aébx"])
def test_forward_sums_all_segmentations(word):
    arcs = lid.lattice(word, PIECES)
    ways = [(numbers, math.prod(Q[n] for n in numbers)) for numbers in segmentations(word)]
    total = sum(p for _, p in ways)
    assert lid.forward(arcs, Q, 2) == pytest.approx(math.log(total))
    counts = lid.expected_counts(arcs, Q)
    for n in range(7):
        assert counts.get(n, 0.0) == pytest.approx(sum(p * numbers.count(n) for numbers, p in ways) / total)


def test_long_words_do_not_vanish():
    arcs = lid.lattice("▁" + "x" * 3000, PIECES)
    assert lid.forward(arcs, Q, 2) == pytest.approx(math.log(0.1) + 3000 * math.log(0.001))


def test_long_words_are_counted_whole():
    rest = "ab" * 40 + "x" * 3000 + "ba" * 500
    for q in (Q, [x / 50 for x in Q]):
        counts = lid.expected_counts(lid.lattice("▁" + rest, PIECES), q)
        assert counts[0] == pytest.approx(3000)
        assert sum(counts[n] * size for n, size in {1: 1, 2: 1, 3: 1, 4: 2, 5: 2, 6: 2}.items()) == pytest.approx(1 + 80 + 1000)
        alone = lid.expected_counts(lid.lattice("▁" + "ab" * 40, PIECES), q), lid.expected_counts(lid.lattice("ba" * 500, PIECES), q)
        for n in range(1, 7):
            assert counts.get(n, 0.0) == pytest.approx(sum(part.get(n, 0.0) for part in alone))


def test_every_label_and_all_of_a_word_is_learned(spark):
    rows = [(i, "common words of a text", "en") for i in range(300)]
    rows += [(1000 + i, "a" * 80 + "ж" * 40, f"x{i}") for i in range(6)]
    model = lid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_rows=5)
    assert model.languages == ("en", *(f"x{i}" for i in range(6)))
    cyrillic = [n for piece, n in lid.vocabulary()[0].items() if n > 0 and set(piece) == {"ж"}] or [0]
    assert (model.p[cyrillic, 1:].sum(axis=0) > 2 * model.p[cyrillic, :1].sum()).all()


def test_held_out_accuracy(spark):
    from txnrisk.llm.queries import op9_language_id
    rows = op9_language_id(spark, "/root/testdata/sf0.01").join(
        read_table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang"), "doc_id")
    held = rows.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert held[0] >= 0.97 and held[1] > 200
    assert rows.where("score < 0 or score > 1 or score is null").count() == 0


def test_labels_of_held_out_documents_are_not_read(spark):
    import zlib
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    assert {r.doc_id: r.p for r in docs.select("doc_id", part.alias("p")).collect()} == {
        r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 4 for r in docs.collect()}


def test_edge_rows(edge, nothing):
    docs = edge.selectExpr("*", "1 AS score", "'q' AS lang_pred")
    model = lid.train(docs)
    assert model.languages == ("de", "en")
    rows = lid.predict(docs, model).collect()
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in rows if not any(c.isalpha() for c in r.text or ""))
    assert all(r.lang_pred in ("de", "en") and 0 <= r.score <= 1 for r in rows if any(c.isalpha() for c in r.text or ""))
    blank = lid.train(nothing)
    assert blank.languages == () and {r.lang_pred for r in lid.predict(edge, blank).collect()} == {"und"}
    assert lid.predict(nothing, model).count() == 0


def test_training_is_bounded_and_repeatable(edge):
    a, b = lid.train(edge, sample_rows=3), lid.train(edge, sample_rows=3)
    assert a.languages == b.languages and np.array_equal(a.p, b.p)


def test_words_are_letters_and_their_marks(spark):
    import unicodedata

    def plain(text):
        out, inside = [], False
        for c in text.lower():
            kind = unicodedata.category(c)[0]
            if kind == "L" or kind == "M" and inside:
                out[-1:] = [out[-1] + c] if inside else [*out[-1:], c]
                inside = True
            else:
                inside = False
        return [lid.MARK + word for word in out]

    for text in ("½ ²", "①", "Ⅷ x", "क्षेत्र में", "a\u0301b \u0301c", "naïve ÉTÉ ß1ª", "日本語 テスト", "a²b", ""):
        assert lid.words_of(text) == plain(text), text
    model = lid.train(spark.createDataFrame([(1, "some words", "en")], "doc_id long, text string, lang string"))
    odd = spark.createDataFrame([(1, "½ ²"), (2, "①"), (3, "Ⅷ 12"), (4, "\u0301")], "doc_id long, text string")
    assert {(r.lang_pred, r.score) for r in lid.predict(odd, model).collect()} == {("und", 0.0)}


@pytest.mark.parametrize("languages", [1, 3, 4, 6, 9])
@pytest.mark.parametrize("least", [1e-3, 1e-30, 0.0])
def test_scores_of_words_are_their_forward_sums(monkeypatch, languages, least):
    monkeypatch.setitem(lid._PIECES, "own", (PIECES, 2))
    p = np.random.default_rng(languages).uniform(0.01, 0.3, (7, languages))
    p[0] = least
    model = lid.Model(tuple(f"l{i}" for i in range(languages)), p, "own")
    words = {"▁a", "▁abab", "▁xab", "▁" + "ab" * 30, "▁" + "x" * 400, "▁" + "xa" * 9}
    known = lid.word_scores(words, model)
    for word in words:
        arcs = lid.lattice(word, PIECES)
        assert known[word] == tuple(lid.forward(arcs, column.tolist(), 2) for column in p.T)


def test_short_words_are_scored_under_four_languages_at_once(monkeypatch):
    monkeypatch.setitem(lid._PIECES, "own", (PIECES, 2))
    monkeypatch.setattr(lid, "forward", None)
    model = lid.Model(tuple("abcdefgh"), np.full((7, 8), 0.1), "own")
    assert len(lid.word_scores({"▁abab"}, model)["▁abab"]) == 8
    # A word of so many places stays above the limit, one longer than that may not.
    assert 0.1 ** (lid.unscaled_places(model.p) - 1) > lid._SMALL and lid.unscaled_places(np.zeros((7, 8))) == 0

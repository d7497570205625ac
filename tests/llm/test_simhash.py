import random

import pytest

from tests.llm import plain
from txnrisk.llm import simhash
from txnrisk.llm.components import connected_components

TEXTS = [None, "", " \n\t", "one", "One TWO", "a b c", "a b c d", "É é ﬁ Straße a\x0bb\x1cc", "word " * 300,
         "x" * 5000, "the same text again and again", "the same text again and again"]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint_equals_plain(text):
    assert simhash.fingerprint(text) == plain.simhash(text)


def test_long_text():
    text = " ".join(f"w{i % 977}" for i in range(40_000))
    assert simhash.fingerprint(text) == plain.simhash(text)


def _members(frame, classes):
    return {r.doc_id: r.component_id for r in frame.join(classes, "fingerprint").collect()}


def test_documents_with_nulls_repeats_and_clashing_columns(spark):
    rows = [(i, text, "own", 7) for i, text in enumerate(TEXTS)] + [(10, TEXTS[10], "again", 8), (None, "one", "no id", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, component_id int")
    members, classes = simhash.near_duplicates(docs)
    prints = [plain.simhash(text) for _, text, *_ in rows]
    label = plain.components(set(prints), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for (doc_id, *_), p in zip(rows, prints):
        if doc_id is not None:
            least[label[p]] = min(doc_id, least.get(label[p], doc_id))
    expected = sorted((str(doc_id), least[label[p]]) for (doc_id, *_), p in zip(rows, prints))
    found = members.join(classes, "fingerprint").collect()
    assert sorted((str(r.doc_id), r.component_id) for r in found) == expected
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    members, classes = simhash.near_duplicates(docs)
    assert members.count() == classes.count() == simhash.keep_first(docs).count() == 0


@pytest.mark.parametrize("max_bits, limit", [(0, 32), (1, 32), (2, 32), (2, 2), (2, 5)])
def test_links_equal_all_pairs(spark, max_bits, limit):
    """Fingerprints in clusters of near ones; a low limit sends most of them the way of crowded keys."""
    draw = random.Random(5)
    prints = set()
    for _ in range(12):
        centre = draw.getrandbits(64)
        for _ in range(25):
            prints.add(centre)
            for _ in range(draw.randint(1, 3)):
                centre ^= 1 << draw.randrange(64)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = simhash.links(frame, max_bits, limit).collect()
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 2 for a, b in found)
    labels = {r.node: r.component for r in connected_components(
        spark.createDataFrame(found, "a long, b long"), "a", "b").collect()} if found else {}
    expected = plain.components(signed, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= max_bits)
    assert {p: labels.get(p, p) for p in signed} == expected


def test_components_of_a_path_a_star_and_loops(spark):
    path = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    edges = path + star + [(5000, 5000), (2001, 2000), (2000, 2001), (None, 1)]
    found = {r.node: r.component for r in connected_components(
        spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert found == ({i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(50)} | {2000: 2000, 2001: 2000})


def test_more_bits_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 3)


def test_keep_first_leaves_columns_of_any_name(spark):
    helpers = ["fingerprint", "label", "component", "rank", "component_id", "__label", "__fingerprint", "__rank"]
    rows = [(i % 7, f"the same text of {i % 3} words", *[f"{name}{i}" for name in helpers]) for i in range(500)]
    kept = simhash.keep_first(spark.createDataFrame(rows, ["doc_id", "text", *helpers]))
    assert kept.columns == ["doc_id", "text", *helpers] and {tuple(r) for r in kept.collect()} <= set(rows)

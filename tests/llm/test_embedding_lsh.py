import math

import numpy as np
import pytest

from tests.llm import plain
from txnrisk.llm import embedding_lsh as lsh
from txnrisk.llm.common import read_table


def brute(rows, threshold=0.9):
    """{id: (links, component)} by comparing all."""
    unit = {}
    for vec_id, v in rows:
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            a = np.array(v, np.float64)
            a = a / np.abs(a).max()
            unit[vec_id] = a / np.linalg.norm(a)

    def linked(a, b):
        return a in unit and b in unit and len(unit[a]) == len(unit[b]) and float(unit[a] @ unit[b]) >= threshold

    label = plain.components([vec_id for vec_id, _ in rows], lambda a, b: a != b and linked(a, b))
    return {i: (sum(linked(i, j) for j, _ in rows if j != i), label[i]) for i, _ in rows}


def found(frame):
    return {r.vec_id: (r.n_links, r.component_id) for r in frame.collect()}


def test_chances():
    draw = np.random.default_rng(0)
    for distance in (0.3, 0.447, 1.0, 1.414):
        shift, offset = draw.standard_normal(400_000) * distance, draw.uniform(0, 2, 400_000)
        assert np.mean(np.floor((offset + shift) / 2) == np.floor(offset / 2)) == pytest.approx(lsh.same_bucket(distance, 2), abs=0.005)
    assert lsh.plan(10**9, 0.9)[1] > lsh.plan(10**4, 0.9)[1] > lsh.plan(100, 0.9)[1]


def test_clusters_blocks_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(lsh, "BLOCK", 16)  # so that the clusters' buckets are dealt out in blocks
    draw = np.random.default_rng(4)
    rows = []
    for size, noise in ((1, 0), (2, 0.01), (60, 0.01), (40, 0.05), (5, 0.0)):
        centre = draw.standard_normal(16)
        rows += [(centre + noise * draw.standard_normal(16)).tolist() for _ in range(size)]
    rows += [[0.0] * 16, None, [1.0] * 15 + [None], [math.nan] * 16, [math.inf] + [1.0] * 15, [], [3.0] * 16, [5e-200] * 16,
             [1.0, 2.0], [2.0, 4.0]]
    rows = list(enumerate(rows))
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, n_links int, id string")
    assert found(lsh.near_duplicates(frame)) == brute(rows)
    kept = {r.vec_id for r in lsh.near_duplicates(frame).where("kept").collect()}
    assert kept == {i for i, (_, component) in brute(rows).items() if i == component}


def test_recall_at_the_threshold(spark):
    """Pairs just above the threshold, the hardest there are."""
    draw = np.random.default_rng(9)
    rows, angle = [], math.acos(0.905)
    for _ in range(300):
        a = draw.standard_normal(64)
        a /= np.linalg.norm(a)
        b = draw.standard_normal(64)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        rows += [a.astype(np.float32).tolist(), (math.cos(angle) * a + math.sin(angle) * b).astype(np.float32).tolist()]
    rows = list(enumerate(rows))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    expected, actual = brute(rows), found(lsh.near_duplicates(frame))
    hits = sum(actual[i][0] for i in actual)
    assert all(actual[i][0] <= expected[i][0] for i in actual)
    assert hits >= 0.9 * sum(n for n, _ in expected.values())


def test_no_links_below(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.9, math.sqrt(1 - 0.81) + 1e-6]), (3, [0.9, math.sqrt(1 - 0.81) - 1e-6])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(lsh.near_duplicates(frame, recall=0.999999)) == brute(rows)


def test_floats_link_by_their_cosine_in_doubles(spark):
    """Pairs of single-precision vectors within 1e-7 of the threshold, on either side."""
    draw = np.random.default_rng(3)
    rows, sides = [], []
    while len(rows) < 400:
        a = draw.standard_normal(64)
        a /= np.linalg.norm(a)
        b = draw.standard_normal(64)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        pair = [x.astype(np.float32).astype(float) for x in (a, 0.9 * a + math.sqrt(0.19) * b)]
        cosine = pair[0] @ pair[1] / np.linalg.norm(pair[0]) / np.linalg.norm(pair[1])
        if 1e-12 < abs(cosine - 0.9) < 1e-7:
            rows += [x.tolist() for x in pair]
            sides.append(cosine > 0.9)
    assert 50 < sum(sides) < 150
    rows = list(enumerate(rows))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert found(lsh.near_duplicates(frame, recall=0.9999999)) == brute(rows)


def test_cells_do_not_depend_on_the_batch():
    draw = np.random.default_rng(5)
    unit = np.rint(lsh._unit(draw.standard_normal((300, 96))) * 2.0**24) / 2.0**24
    hashed = lsh.Hash(96, 1.0, 4, 8, 1)
    for row in range(20):  # put on the border of a cell in every projection
        hashed.offsets = -(unit[row] @ hashed.directions)
        codes = [hashed.codes(unit[row:row + n])[0].tolist() for n in (1, 2, 3, 7, 64, 280)]
        assert all(c == codes[0] for c in codes)


def test_query_and_empty_table(spark):
    from txnrisk.llm.queries import op7_embedding_lsh
    rows = [(r.vec_id, list(r.embedding)) for r in read_table(spark, "/root/testdata/sf0.001", "embeddings").collect()]
    assert found(op7_embedding_lsh(spark, "/root/testdata/sf0.001")) == brute(rows)
    assert lsh.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0

import itertools
import random
import re

import pytest

from tests.llm.conftest import EDGE_ROWS
from txnrisk.llm import mixing
from txnrisk.llm.common import read_table


def test_targets():
    assert mixing.targets([100, 100, 100], [5, 2, 1]) == pytest.approx([187.5, 75, 37.5])
    assert mixing.targets([10, 100, 190], [5, 2, 1]) == pytest.approx([30, 180, 90])
    assert mixing.targets([10, 20, 970], [5, 2, 1]) == pytest.approx([30, 60, 910])
    assert mixing.targets([0, 5], [5, 2]) == pytest.approx([0, 5])
    assert mixing.targets([0, 0], [5, 2]) == [0, 0] and mixing.targets([], []) == []


def test_knapsack_is_the_best_sum():
    draw = random.Random(1)
    for _ in range(150):
        sizes = draw.sample(range(1, 30), draw.randint(1, 4))
        counts = [draw.randint(0, 4) for _ in sizes]
        budget = draw.randint(0, 120)
        taken = mixing.knapsack(sizes, counts, budget)
        sums = [sum(s * t for s, t in zip(sizes, some)) for some in itertools.product(*(range(c + 1) for c in counts))]
        assert all(0 <= t <= c for t, c in zip(taken, counts))
        assert sum(s * t for s, t in zip(sizes, taken)) == max(x for x in sums if x <= budget)


def test_fit_comes_near_any_budget():
    draw = random.Random(2)
    for _ in range(60):
        sizes = draw.sample(range(1, 60_000), draw.randint(1, 40))
        counts = [draw.randint(1, 50) for _ in sizes]
        total = sum(s * c for s, c in zip(sizes, counts))
        budget = draw.randint(0, total)
        taken = mixing.fit(sizes, counts, budget)
        assert all(0 <= t <= c for t, c in zip(taken, counts))
        assert abs(sum(s * t for s, t in zip(sizes, taken)) - budget) <= max(sizes) / 2
    assert mixing.fit([1, 2, 3], [1000, 1000, 1000], 3001) != [1000] * 3


def best(sizes, counts, budget):
    sums = {0}
    for size, count in zip(sizes, counts):
        sums = {x + size * n for x in sums for n in range(count + 1)}
    return min(abs(x - budget) for x in sums)


@pytest.mark.parametrize("sizes, counts, budget", [
    ([60_000, 70_000, 900_000], [3, 2, 1], 1_060_000), ([60_000, 70_000, 900_000], [3, 2, 1], 70_000),
    ([45_000, 55_000, 700_000], [2, 1, 1], 90_000), ([100_003, 250_007, 1_000_003], [9, 5, 4], 2_345_678)])
def test_budgets_of_very_long_documents(sizes, counts, budget):
    taken = mixing.fit(sizes, counts, budget)
    assert abs(sum(s * t for s, t in zip(sizes, taken)) - budget) == best(sizes, counts, budget)


def test_fit_is_the_best_sum():
    draw = random.Random(3)
    for _ in range(80):
        sizes = [draw.randint(1, 10 ** draw.randint(1, 6)) for _ in range(draw.randint(1, 4))]
        sizes = sorted(set(sizes))
        counts = [draw.randint(0, 4) for _ in sizes]
        budget = draw.randint(0, sum(s * c for s, c in zip(sizes, counts)))
        taken = mixing.fit(sizes, counts, budget)
        assert abs(sum(s * t for s, t in zip(sizes, taken)) - budget) == best(sizes, counts, budget)


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(rows, texts):
    """The contract on rows of (id, size, source_size, target, taken, source)."""
    by_source = {}
    for r in rows:
        by_source.setdefault(r.source, []).append(r)
    assert sorted((str(r.doc_id), r.size) for r in rows) == sorted((str(i), words(t)) for i, t in texts)
    order = sorted(by_source, key=lambda s: (s is None, s or ""))
    sizes = [sum(r.size for r in by_source[s]) for s in order]
    aims = mixing.targets(sizes, [(5, 2, 1)[i % 3] for i in range(len(order))])
    for source, size, aim in zip(order, sizes, aims):
        own = by_source[source]
        assert {r.source_size for r in own} == {size} and own[0].target == pytest.approx(aim)
        assert all(r.taken in (0, r.size, 2 * r.size, 3 * r.size) for r in own)
        smallest = min((r.size for r in own if r.size), default=0)
        assert abs(sum(r.taken for r in own) - aim) <= max(1, smallest)
    return {(str(r.doc_id), r.size): r.taken for r in rows}


def test_query(spark):
    from txnrisk.llm.queries import op8_mixing
    docs = [(r.doc_id, r.text) for r in read_table(spark, "/root/testdata/sf0.01", "documents").collect()]
    first = check(op8_mixing(spark, "/root/testdata/sf0.01").collect(), docs)
    assert first == check(op8_mixing(spark, "/root/testdata/sf0.01").collect(), docs)


def test_many_equal_documents_are_ranked_in_slices(spark):
    docs = spark.range(6000).selectExpr("id AS doc_id", "'same three words' AS text", "if(id < 5000, 'a', 'b') AS source")
    rows = mixing.mix(docs).collect()
    for source, n in (("a", 5000), ("b", 1000)):
        own = [r for r in rows if r.source == source]
        assert len(own) == n and abs(sum(r.taken for r in own) - own[0].target) <= 3


def test_edge_rows(edge, nothing):
    rows = mixing.mix(edge).collect()
    assert sorted((str(r.doc_id), r.size) for r in rows) == sorted((str(row[0]), words(row[1])) for row in EDGE_ROWS)
    assert all(r.taken == 0 for r in rows if r.size == 0) and all(r.taken <= 3 * r.size for r in rows)
    assert mixing.mix(nothing).count() == 0 and mixing.take(nothing).count() == 0
    mixed = mixing.take(edge)
    assert mixed.columns == edge.columns
    assert sum(words(r.text) for r in mixed.collect()) == sum(r.taken for r in rows)


def test_columns_of_any_name_stay(spark):
    helpers = ["draw", "least", "extra", "number", "copy", "key", "size", "slice", "rank", "__draw", "__copy"]
    rows = [(i // 40, f"w{i // 40 % 3} and more", "abc"[i % 3], *[f"{name}{i}" for name in helpers]) for i in range(600)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", "source", *helpers])
    mixed, wanted = mixing.take(docs), mixing.mix(docs)
    assert mixed.columns == docs.columns
    kept = mixed.collect()
    assert {tuple(r) for r in kept} <= set(rows)
    assert sum(words(r.text) for r in kept) == sum(r.taken for r in wanted.collect())

import pytest

from __spark_entry__ import oracle_sql, queries
from tests.compare import compare, connect
from tests.llm import plain
from txnrisk.llm.common import read_table
from txnrisk.llm.queries import ORACLE

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, name):
    assert compare(connect(FOLDER), queries()[name](spark, FOLDER), oracle_sql()[name]) == []


def test_simhash_equals_brute_force(spark):
    prints = {r.doc_id: plain.simhash(r.text) for r in read_table(spark, FOLDER, "documents").collect()}
    label = plain.components(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for doc_id in sorted(prints):
        least.setdefault(label[prints[doc_id]], doc_id)
    rows = queries()["op6_simhash"](spark, FOLDER).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        i: (f"{p:016x}", least[label[p]]) for i, p in prints.items()}

import hashlib
import math
import random
import re
from collections import defaultdict

import pytest
from hypothesis import given, settings, strategies as st

from __spark_entry__ import queries
from tests.llm.conftest import EDGE_ROWS
from txnrisk.llm import pii_contexts as p
from txnrisk.llm.common import read_table

FOLDER = "/root/testdata/sf0.001"


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(text):
    """The contract's spans, by its own patterns."""
    text, out = text or "", []
    out += [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(n) <= 255 for n in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def spelled(spans):
    return ",".join(f"{p.KINDS[kind]}:{a}:{b}" for a, kind, b in spans)


@settings(max_examples=3000, deadline=None)
@given(st.text(alphabet="a.@-+0 159()é%\n٣", max_size=40))
def test_rules_equal_the_contract(text):
    assert [(a, k, b) for a, b, k in p.seeds(text)] == base(text)


@pytest.mark.parametrize("text", [
    "x@y.z@a.b @c.d@e.f", "0000001.02.255.0256 1.2.3.4.5.6.7.8", "4111 1111-1111 1111 2", "é😀 +1 (555) 010-0000.",
    "+1+1 555 010 0000", "1" * 4000 + ".1.1.1", "a" * 300 + "@b-.c", "4111111111111111 4111111111111112"])
def test_tricky_texts(text):
    assert [(a, k, b) for a, b, k in p.seeds(text)] == base(text)


def test_long_texts_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 150_000, "+1 " * 100_000, "1a" * 150_000):
        p._mentions(text)


def test_query_equals_the_contract(spark):
    docs = {r.doc_id: r.text for r in read_table(spark, FOLDER, "documents").collect()}
    rows = queries()["op11_pii"](spark, FOLDER).collect()
    assert len(rows) == len(docs)
    for r in rows:
        spans = base(docs[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in spans) for k in range(4)]
        assert r.base_sha256 == hashlib.sha256(spelled(spans).encode()).hexdigest()
        assert set(filter(None, spelled(spans).split(","))) <= set(r.spans.split(","))


def brute_force(texts, rounds=p.ROUNDS):
    """Spans of each text, with the graph in plain dictionaries."""
    known, edges, mentions = defaultdict(set), defaultdict(set), []
    for i, text in enumerate(texts):
        for m in p._mentions(text)[1]:
            mentions.append((i, m))
            if m["kind"] is not None:
                known[m["instance"]].add(m["kind"])
            for pattern in m["patterns"]:
                edges[pattern].add(m["instance"])
    certain = {(i, k): 1_000_000 for i, kinds in known.items() for k in kinds}
    labels, found = dict(certain), {}
    for _ in range(rounds):
        doubts = defaultdict(int)
        for pattern, held in edges.items():
            for kind in range(4):
                values = [labels[i, kind] for i in held if (i, kind) in labels]
                confidence = math.floor(sum(values) / (len(held) + 1))
                if len(values) >= p.LEAST_KNOWN and confidence >= p.PATTERN_CONFIDENCE * 1_000_000:
                    for i in held:
                        doubts[i, kind] += math.floor(-1_000_000 * math.log(1 - confidence / 1_000_000))
        found = {key: math.floor(1_000_000 * (1 - math.exp(-d / 1_000_000))) for key, d in doubts.items() if key[0] not in known}
        found = {key: c for key, c in found.items() if c >= p.FOUND_CONFIDENCE * 1_000_000}
        labels = certain | found
    spans = [base(text) for text in texts]
    for i, m in mentions:
        kinds = [(-found[m["instance"], k], k) for k in range(4) if (m["instance"], k) in found]
        if m["kind"] is None and kinds:
            spans[i].append((m["start"], min(kinds)[1], m["end"]))
    return [sorted(s) for s in spans]


def found(frame):
    return [[(s.start, s.kind, s.end) for s in r.spans] for r in sorted(frame.collect(), key=lambda r: r.doc_id)]


def letter(rng):
    """One of several form letters, some with identifiers that no rule knows."""
    number, host = rng.randrange(10 ** 6), "localhost" if rng.random() < 0.12 else "mail.example.com"
    phone = f"+1 (555) {number % 1000:03d}-{number % 9000 + 1000}" if rng.random() < 0.88 else f"ext-{number:06d}"
    return rng.choice([
        f"You may call us at {phone} before noon.", f"Please write to agent{number}@{host} today.",
        f"The year {rng.randrange(1900, 2100)}0 was cold; model X{number} sold.", f"my phone: {phone}\nthanks",
        "Nothing to see here."])


def test_discovery_equals_brute_force(spark):
    rng = random.Random(1)
    texts = [letter(rng) for _ in range(400)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    spans = found(p.find(frame))
    assert spans == brute_force(texts)
    unknown = [i for i, text in enumerate(texts) if "ext-" in text or "@localhost" in text]
    assert sum(len(spans[i]) > len(base(texts[i])) for i in unknown) > 0.9 * len(unknown) > 0
    for i, text in enumerate(texts):
        if "model X" in text or "Nothing" in text:
            assert spans[i] == []


def test_second_round_discovers(spark):
    """An identifier found in one context makes another context good, which yields more."""
    texts = [f"reach me under +1 555 010 {1000 + i} always" for i in range(12)]
    texts += ["reach me under desk-000001 always"]
    texts += [f"reach me under desk-{i:06d} always" for i in (2, 3)] * 2
    texts += [f"our hotline desk-{i:06d} rings" for i in (1, 2, 3)] + [f"our hotline +1 555 010 {1000 + i} rings" for i in range(9)]
    texts += ["our hotline bell-777777 rings"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for rounds in (1, 2, 3):
        assert found(p.find(frame, rounds=rounds)) == brute_force(texts, rounds)


def test_edge_rows(spark, edge, nothing):
    rows = p.find(edge.selectExpr("*", "1 AS row", "2 AS known", "3 AS mentions", "4 AS salt", "5 AS instance")).collect()
    assert len(rows) == len(EDGE_ROWS)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted((r[0] is None, r[0] or 0) for r in EDGE_ROWS)
    assert p.find(nothing).count() == 0

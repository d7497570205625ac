import functools
import hashlib
import itertools
import random
import re
from zlib import crc32

import pytest

from __spark_entry__ import queries
from txnrisk.llm import conversation_repair as c
from txnrisk.llm.common import read_table

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
MEASURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))


def faulty(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = ("blank" if not body else "duplicate" if (role, text) in seen else
                 "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
        out.append(fault)
    return out


def cheapest(rows, found):
    """Least (cost, audit) by the grammar as a derivative of its expression: '' -> s -> u -> a -> u..."""
    follows = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @functools.lru_cache(None)
    def least(i, at, inserts):
        options = []
        if i == len(rows) and at in ("", "a"):
            options.append((0, "", ()))
        if inserts < 3:
            for role, name in (("u", "user"), ("a", "assistant")):
                if role in follows[at]:
                    cost, audit, lines = least(i, follows[at][role], inserts + 1)
                    options.append((cost + 3, "I" + audit, (name + ":", *lines)))
        if i < len(rows):
            cost, audit, lines = least(i + 1, at, 0)
            options.append((cost + 4, "D" + audit, lines))
            if found[i] not in ("blank", "duplicate"):
                extra = 3 if found[i] == "truncated" else 0
                role, text = rows[i][2], rows[i][3]
                if role[:1] in follows[at]:
                    cost, audit, lines = least(i + 1, follows[at][role[:1]], 0)
                    options.append((cost + extra, "K" + audit, (f"{role}:{text}", *lines)))
                for new, name in (("u", "user"), ("a", "assistant")):
                    if new in follows[at]:
                        cost, audit, lines = least(i + 1, follows[at][new], 0)
                        options.append((cost + 3 + extra, "R" + audit, (f"{name}:{text}", *lines)))
        return min(options, key=lambda o: o[:2], default=(10 ** 9, "", ()))

    for i in range(len(rows), -1, -1):  # from the end, so that no call goes deep
        for inserts in (3, 2, 1, 0):
            for at in follows:
                least(i, at, inserts)
    return least(0, "", 0)


def plain(rows):
    """The contract's results of one conversation, from rows after damage."""
    rows = in_order(rows)
    found = faulty(rows)
    turns = [r[1] for r in rows if r[1] is not None]
    pairs = [a[2][:1] + b[2][:1] for a, b in itertools.pairwise(rows)]
    cost, audit, lines = cheapest(tuple(rows), tuple(found))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, found.count("blank"),
            found.count("duplicate"), found.count("truncated"), sum(p not in ("su", "ua", "au") for p in pairs),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def expected(rows):
    after = damaged(rows)
    return {conv: plain([r for r in after if r[0] == conv]) for conv in {r[0] for r in rows}}


def collected(frame):
    rows = frame.collect()
    found = {r.conv_id: tuple(r[m] for m in MEASURES) for r in rows}
    assert len(found) == len(rows)
    return found


def random_rows(seed, conversations, longest):
    rng, rows = random.Random(seed), []
    for conv in [None, *range(conversations)]:
        for turn in range(rng.randrange(longest)):
            role = rng.choice(["user", "assistant", "assistant", "user", "system", "tool", "", None, "Sys"])
            text = rng.choice(["a.", "b!", "c", "", " \n", "d? ", None, "e.\x0b", "é.", "x" * 3000 + "."])
            rows.append((conv, None if rng.random() < 0.1 else turn + 2 * rng.randrange(2), role, text))
    return rows


def test_query_equals_brute_force(spark):
    rows = [tuple(r[n] for n in ("conv_id", "turn", "role", "text"))
            for r in read_table(spark, FOLDER, "conversations").collect()]
    found = queries()["op13_conversation_repair"](spark, FOLDER)
    types = dict.fromkeys(("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"), "bigint")
    assert dict(found.dtypes) == types | {"audit": "string", "repaired_sha256": "string"}
    assert collected(found) == expected(rows)


@pytest.mark.parametrize("bits", [0, 1, 9])
def test_random_conversations(spark, bits):
    """Whole conversations and chunks of one, two and many rows give the same."""
    rows = random_rows(bits, 60, 12)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5).selectExpr("*", "1 AS place", "2 AS conv", "3 AS chunk")
    assert collected(c.repair(c.damage(frame), chunk_bits=bits)) == expected(rows)


def test_one_long_conversation(spark):
    """A third of all rows in one conversation, many alike, over several ranges and chunks."""
    rng = random.Random(5)
    rows = [(7, t, rng.choice(["user", "assistant"]), rng.choice(["same.", f"t{t}.", f"t{t}"])) for t in range(900)]
    rows += [(i % 300, i // 300, "user", "hello.") for i in range(1800)]
    found = collected(c.repair(spark.createDataFrame(rows, SCHEMA)))
    alone = [r for r in rows if r[0] == 7]
    assert len(found) == 300 and len(found[7][6]) >= len(alone)
    assert found[7] == plain(alone)


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert c.repair(c.damage(empty)).count() == 0
    gone = spark.createDataFrame([(1, 0, "user", "x.", True)], SCHEMA + ", dropped boolean")
    assert collected(c.repair(gone)) == {1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    repeated = spark.createDataFrame([(1, 0, "user", "x.")] * 700 + [(1, 1, "assistant", "y.")], SCHEMA)
    assert collected(c.repair(repeated))[1][1:7] == (0, 699, 0, 699, 4 * 699, "K" + "D" * 699 + "K")


def test_grammar():
    """The automaton accepts just the legal sequences of initials."""
    for n in range(6):
        for word in itertools.product("sua", repeat=n):
            stack = c.ROOT
            for symbol in word:
                stack = stack and c.shifted(stack, symbol)
            accepted = stack is not None and stack[0] in c.FINAL
            assert accepted == bool(re.fullmatch("(s?(ua)+)?", "".join(word)))

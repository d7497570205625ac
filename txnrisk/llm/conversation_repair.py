"""Repair of the role structure of conversations by a generalised LR parse.

A conversation should read: an optional system turn, then pairs of a user and
an assistant turn. Its rows are read as the words of a small grammar, each kept,
given another role or deleted, with missing turns put in between, every edit at
a price. All readings are followed at once on a graph-structured stack: stacks
with equal tops are merged, and only the least (cost, audit) of them goes on,
the audit being the edits' initials.

Rows are sorted by (conversation, turn) in ranges over all executors. Most
conversations lie within one range and are short; they are repaired there and
then. A conversation that crosses a border or is long is cut into chunks: each
is parsed from every top that may come in, the chunks' outcomes are chained
with costs and ranks only, and the chosen readings are spelled out in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from txnrisk.llm.common import ready, slices, staged

# The role grammar, by initials, and what the edits cost.
GRAMMAR = (("done", ("open", "a")), ("open", ("u",)), ("open", ("s", "u")), ("open", ("done", "u")))
START = "done"  # or nothing at all
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
WHITE = " \t\n\v\f\r"

#: A conversation of more rows than two to this power is cut into chunks of as many.
CHUNK_BITS = 9


# --- the automaton -------------------------------------------------------------------------------------------------


def _closed(items: frozenset) -> frozenset:
    """LR(0) items with those that may begin at their dots."""
    grown = set(items)
    while True:
        wanted = {GRAMMAR[rule][1][dot] for rule, dot in grown if dot < len(GRAMMAR[rule][1])}
        more = {(i, 0) for i, (head, _) in enumerate(GRAMMAR) if head in wanted} - grown
        if not more:
            return frozenset(grown)
        grown |= more


def _automaton() -> tuple[dict, dict, set]:
    """Moves ``(state, symbol) -> state``, reductions ``state -> (head, length)``, and states that may end."""
    first = _closed(frozenset((i, 0) for i, (head, _) in enumerate(GRAMMAR) if head == START))
    numbers, queue, moves, reductions = {first: 0}, [first], {}, {}
    for items in queue:
        for rule, dot in items:
            if dot == len(GRAMMAR[rule][1]):
                reductions[numbers[items]] = (GRAMMAR[rule][0], dot)
        for symbol in sorted({GRAMMAR[rule][1][dot] for rule, dot in items if dot < len(GRAMMAR[rule][1])}):
            after = _closed(frozenset((rule, dot + 1) for rule, dot in items
                                      if GRAMMAR[rule][1][dot:dot + 1] == (symbol,)))
            if after not in numbers:
                numbers[after] = len(numbers)
                queue.append(after)
            moves[numbers[items], symbol] = numbers[after]
    return moves, reductions, {0, moves[0, START]}


MOVES, REDUCTIONS, FINAL = _automaton()
#: A stack is (state, stack below); this one is empty.
ROOT = (0, None)


@lru_cache(None)
def shifted(stack: tuple, symbol: str) -> tuple | None:
    """The stack after ``symbol`` and all reductions then due; None where the grammar has no place for it."""
    state = MOVES.get((stack[0], symbol))
    if state is None or symbol in (head for head, _ in GRAMMAR):
        return None
    stack = (state, stack)
    while stack[0] in REDUCTIONS:
        head, length = REDUCTIONS[stack[0]]
        for _ in range(length):
            stack = stack[1]
        stack = (MOVES[stack[0], head], stack)
    return stack


def _reachable() -> list:
    stacks = [ROOT]
    for stack in stacks:
        stacks += [s for s in map(lambda c: shifted(stack, c), "sua") if s is not None and s not in stacks]
    return stacks


#: All stacks after reductions; with this grammar a top has one stack below it.
STACKS = list(dict.fromkeys(_reachable()))


# --- the parse -----------------------------------------------------------------------------------------------------


def _offer(tops: dict, stack: tuple | None, reading: tuple[int, str]) -> None:
    if stack is not None and (stack not in tops or reading < tops[stack]):
        tops[stack] = reading


def with_inserts(tops: dict) -> dict:
    """The tops, and those reached from them by putting in turns."""
    tops, fresh = dict(tops), tops
    while fresh:
        found: dict = {}
        for stack, (cost, audit) in fresh.items():
            for symbol in ROLES:
                _offer(found, shifted(stack, symbol), (cost + INSERT, audit + "I"))
        fresh = {stack: reading for stack, reading in found.items() if stack not in tops or reading < tops[stack]}
        tops.update(fresh)
    return tops


def after_row(tops: dict, initial: str, unusable: bool, truncated: bool) -> dict:
    """The merged tops after one row.

    Turns are put in before a row only, so all readings of as many rows end
    in a row's letter and none begins another of the same cost; the least of
    two therefore stays the least whatever follows.
    """
    out: dict = {}
    for stack, (cost, audit) in with_inserts(tops).items():
        _offer(out, stack, (cost + DELETE, audit + "D"))
        if not unusable:
            cost += TRUNCATED * truncated
            _offer(out, shifted(stack, initial), (cost + KEEP, audit + "K"))
            for symbol in ROLES:
                _offer(out, shifted(stack, symbol), (cost + REROLE, audit + "R"))
    return out


#: Turns still to be put in when the rows end on a stack.
MISSING = {stack: min(len(audit) for end, (_, audit) in with_inserts({stack: (0, "")}).items() if end[0] in FINAL)
           for stack in STACKS}


def completed(tops: dict) -> tuple[int, str]:
    """The least reading that ends a conversation."""
    return min((cost + INSERT * MISSING[stack], audit + "I" * MISSING[stack]) for stack, (cost, audit) in tops.items())


def spelled(rows: list, audit: str, stack: tuple = ROOT) -> list[str]:
    """``role:text`` of the turns that the audit leaves of ``rows`` (role, text)."""
    lines, left = [], iter(rows)
    for edit in audit:
        role, text = next(left) if edit != "I" else (None, "")
        if edit == "D":
            continue
        initial = role[:1] if edit == "K" else next(c for c in ROLES if shifted(stack, c) is not None)
        stack = shifted(stack, initial)
        lines.append(f"{role if edit == 'K' else ROLES[initial]}:{text}")
    return lines


class Tally:
    """Faults of consecutive rows of one conversation; parts are added up in order."""

    FIELDS = ("low", "high", "turns", "blank", "duplicate", "truncated", "illegal", "first_initial", "last_initial")

    def __init__(self, low=None, high=None, turns=0, blank=0, duplicate=0, truncated=0, illegal=0,
                 first_initial=None, last_initial=None):
        self.low, self.high, self.turns = low, high, turns
        self.blank, self.duplicate, self.truncated, self.illegal = blank, duplicate, truncated, illegal
        self.first_initial, self.last_initial = first_initial, last_initial

    def add(self, later: Tally) -> None:
        if later.first_initial is None:
            return
        if self.first_initial is None:
            self.first_initial = later.first_initial
        else:
            self.illegal += self.last_initial + later.first_initial not in LEGAL
        self.last_initial = later.last_initial
        if later.low is not None:
            # Rows come by turn: a turn on both sides is the last here and the first there.
            self.turns += later.turns - (self.high is not None and self.high == later.low)
            self.low, self.high = later.low if self.low is None else self.low, later.high
        for name in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, getattr(self, name) + getattr(later, name))

    def values(self) -> dict:
        return {name: getattr(self, name) for name in self.FIELDS}

    def measures(self) -> dict:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
                "illegal": self.illegal}


def faults(role: str, text: str, seen_earlier: bool) -> tuple[bool, bool, bool]:
    """Whether the row's first fault is to be blank, a duplicate, truncated."""
    body = text.rstrip(WHITE)
    blank = not body
    duplicate = not blank and seen_earlier
    return blank, duplicate, not blank and not duplicate and body[-1] not in ".!?"


def parsed(rows: list, tops: dict) -> tuple[dict, Tally]:
    """The tops after ``rows``, dicts in order with ``seen`` telling whether role and text occurred earlier."""
    tally = Tally()
    for row in rows:
        blank, duplicate, truncated = faults(row["role"], row["text"], row["seen"])
        turn, initial = row["turn"], row["role"][:1]
        tally.add(Tally(turn, turn, int(turn is not None), blank, duplicate, truncated, 0, initial, initial))
        tops = after_row(tops, initial, blank or duplicate, truncated)
    return tops, tally


# --- on Spark ------------------------------------------------------------------------------------------------------

def _fields(kind: pa.DataType, names: str) -> list[pa.Field]:
    return [pa.field(name, kind) for name in names.split()]


#: ``conv`` names a conversation in all steps; a null id has a name of its own.
_MEASURES = "gaps blank duplicate truncated illegal cost"
_RESULT = _fields(pa.int64(), _MEASURES) + _fields(pa.string(), "audit repaired_sha256")
_ROW = _fields(pa.int64(), "place turn") + _fields(pa.bool_(), "dropped") + _fields(pa.string(), "role text digest")
_OUTCOME = pa.struct(_fields(pa.int32(), "start end rank") + _fields(pa.int64(), "cost") + _fields(pa.string(), "audit"))
_CHUNK = _fields(pa.string(), "conv") + _fields(pa.int64(), "chunk")

_PASSED = pa.schema(_fields(pa.string(), "conv") + _fields(pa.bool_(), "finished") + _ROW + _RESULT)
_OUTCOMES = pa.schema(_CHUNK + [pa.field("outcomes", pa.list_(_OUTCOME))]
                      + _fields(pa.int64(), "low high turns blank duplicate truncated illegal")
                      + _fields(pa.string(), "first_initial last_initial"))
_CHOSEN = pa.schema(_CHUNK + _fields(pa.int32(), "start end missing") + _fields(pa.int64(), _MEASURES))
_SPELLED = pa.schema(_CHUNK + _fields(pa.int64(), _MEASURES) + _fields(pa.string(), "audit repaired"))
_REPAIRED = pa.schema(_fields(pa.string(), "conv") + _RESULT)


def _names(fields) -> list[str]:
    return [field.name for field in fields]


def _table(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema)


def _finished(conv, rows: list[dict]) -> dict:
    """The repaired conversation of a few rows."""
    held, seen = [row for row in rows if not row["dropped"]], set()
    for row in held:
        row["seen"] = (row["role"], row["digest"]) in seen
        seen.add((row["role"], row["digest"]))
    tops, tally = parsed(held, {ROOT: (0, "")})
    cost, audit = completed(tops)
    text = "\n".join(spelled([(row["role"], row["text"]) for row in held], audit))
    return {"conv": conv, "finished": True, **tally.measures(), "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256(text.encode()).hexdigest()}


def _first_pass(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[pa.RecordBatch]:
    """Repair the short conversations inside this range; pass on the rows of all others.

    A range's first and last conversation may go on in another one. No more
    than ``longest`` rows are held.
    """
    place = TaskContext.get().partitionId() << 33
    held, current, is_open = [], None, True  # the first one of the range is open

    def as_rows(conv, rows):
        return [{"conv": conv, "finished": False, **row} for row in rows]

    started = False
    for batch in slices(batches, "text"):
        out = []
        for row in batch.to_pylist():
            conv = row.pop("conv")
            row["place"], place = place, place + 1
            if started and conv != current:
                out += as_rows(current, held) if is_open else [_finished(current, held)]
                held, is_open = [], False
            started, current = True, conv
            held.append(row)
            if is_open or len(held) > longest:
                out += as_rows(current, held)
                held, is_open = [], True
        yield from _table(out, _PASSED).to_batches()
    if held:
        yield from _table(as_rows(current, held), _PASSED).to_batches()


def _chunk_outcomes(key: tuple, rows: pa.Table, firsts: pa.Table) -> pa.Table:
    """Of one chunk: the tally, and for every top before it and after it the least reading and its rank."""
    first = set(firsts.column("place").to_pylist())
    held = sorted((row for row in rows.to_pylist() if not row["dropped"]), key=lambda row: row["place"])
    for row in held:
        row["seen"] = row["place"] not in first
    outcomes = []
    for start, stack in enumerate(STACKS):
        tops, tally = parsed(held, {stack: (0, "")})
        outcomes += [{"start": start, "end": STACKS.index(end), "cost": cost, "audit": audit}
                     for end, (cost, audit) in tops.items()]
    ranks = {audit: rank for rank, audit in enumerate(sorted({o["audit"] for o in outcomes}))}
    for outcome in outcomes:
        outcome["rank"] = ranks[outcome["audit"]]
    return _table([{"conv": key[0].as_py(), "chunk": key[1].as_py(), "outcomes": outcomes, **tally.values()}], _OUTCOMES)


def _chained(key: tuple, chunks: pa.Table) -> pa.Table:
    """Of one conversation: the tops before and after every chunk on the cheapest way, and the totals.

    Ways that meet are compared by cost, then by rank: that of the way so far,
    then that of the chunk's reading. A row here stands for a whole chunk and
    holds no reading.
    """
    tally, steps = Tally(), []
    ways = {0: (0, 0)}  # top -> cost, rank among the ways so far
    rows = sorted(chunks.to_pylist(), key=lambda row: row["chunk"])
    for row in rows:
        tally.add(Tally(**{name: row[name] for name in Tally.FIELDS}))
        best: dict = {}
        for outcome in row["moves"]:
            if outcome["start"] in ways:
                cost, rank = ways[outcome["start"]]
                way = (cost + outcome["cost"], rank, outcome["rank"], outcome["start"])
                if outcome["end"] not in best or way < best[outcome["end"]]:
                    best[outcome["end"]] = way
        order = {way: i for i, way in enumerate(sorted({way[1:3] for way in best.values()}))}
        ways = {end: (way[0], order[way[1:3]]) for end, way in best.items()}
        steps.append({end: way[3] for end, way in best.items()})
    cost, _, end = min((cost + INSERT * MISSING[STACKS[top]], rank, top) for top, (cost, rank) in ways.items())
    totals = {**tally.measures(), "cost": cost}
    out, missing = [], MISSING[STACKS[end]]
    for row, step in zip(reversed(rows), reversed(steps)):
        out.append({"conv": key[0].as_py(), "chunk": row["chunk"], "start": step[end], "end": end,
                    "missing": missing, **totals})
        end, missing = step[end], 0
    return _table(out, _CHOSEN)


def _spelled_chunk(key: tuple, rows: pa.Table, chosen: pa.Table) -> pa.Table:
    """Of one chunk: the audit and the repaired turns on the chosen way."""
    held = sorted((row for row in rows.to_pylist() if not row["dropped"]), key=lambda row: row["place"])
    choice = chosen.to_pylist()[0]
    audit = choice["audit"] + "I" * choice["missing"]
    lines = spelled([(row["role"], row["text"]) for row in held], audit, STACKS[choice["start"]])
    row = {name: choice[name] for name in _MEASURES.split()}
    return _table([{"conv": key[0].as_py(), "chunk": key[1].as_py(), **row, "audit": audit,
                    "repaired": "\n".join(lines) if lines else None}], _SPELLED)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and hash of whole conversations from their chunks in order; a chunk is held at a time."""
    last, audit, digest, empty = None, [], None, True

    def result():
        measures = {name: last[name] for name in _MEASURES.split()}
        return _table([{"conv": last["conv"], **measures, "audit": "".join(audit),
                        "repaired_sha256": digest.hexdigest()}], _REPAIRED).to_batches()

    for batch in batches:
        for row in batch.to_pylist():
            if last is None or row["conv"] != last["conv"]:
                if last is not None:
                    yield from result()
                audit, digest, empty = [], hashlib.sha256(), True
            last = row
            audit.append(row["audit"])
            if row["repaired"] is not None:
                digest.update((b"" if empty else b"\n") + row["repaired"].encode())
                empty = False
    if last is not None:
        yield from result()


def damage(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, dropped)``: the rows as a faulty transport would leave them.

    By the checksum of ``conv_id:turn`` a row in twenty each is dropped (kept
    here as a mark without text), emptied, robbed of its full stops, repeated or
    given to the user. Nulls in role and text become one space.
    """
    def plain(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.encode(F.concat(plain("conv_id"), F.lit(":"), plain("turn")), "UTF-8")) % 20
    text = (F.when(kind.isin(0, 1), "").when(kind == 2, F.translate(plain("text"), ".!?", "")).otherwise(plain("text")))
    one = F.array(F.lit(False))
    copies = F.when(kind == 0, F.array(F.lit(True))).when(kind == 3, F.array(F.lit(False), F.lit(False))).otherwise(one)
    return conversations.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(plain("role")).alias("role"), text.alias("text"),
        F.explode(copies).alias("dropped"))


def repair(rows: DataFrame, *, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` per conversation.

    ``rows`` holds ``conv_id``, ``turn`` (a whole number), ``role`` and ``text``
    and may hold ``dropped``, true for rows that only tell that their
    conversation exists; other columns are left alone. Rows go by turn, nulls
    first, those of one turn by role and by the SHA-256 of their text; repeated
    rows are duplicates. Nulls in role and text count as one space. All rows
    without a ``conv_id`` are one conversation. An empty table gives no row.

    Sorting needs no text, so the longest one costs no more than to carry it,
    and equal rows may lie in several ranges. Only a conversation's hash
    has to pass its turns through one task, a chunk at a time, as the hash is
    sequential; its audit is as long as it has rows, a letter each.
    """
    spark = ready(rows.sparkSession)
    id_type = rows.schema["conv_id"].dataType
    text = F.coalesce("text", F.lit(" "))
    dropped = F.coalesce("dropped", F.lit(False)) if "dropped" in rows.columns else F.lit(False)
    keyed = rows.select(
        F.when(F.col("conv_id").isNotNull(), F.concat(F.lit("="), F.col("conv_id").cast("string")))
        .otherwise("null").alias("conv"),
        dropped.alias("dropped"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"),
        F.sha2(F.encode(text, "UTF-8"), 256).alias("digest"), F.rand(0).alias("tie"))
    order = ("conv", F.asc_nulls_first("turn"), "role", "digest", "tie")
    placed = staged(
        keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
        .mapInArrow(partial(_first_pass, longest=1 << chunk_bits), from_arrow_schema(_PASSED)), "conversations")
    short = placed.where("finished").select("conv", *_names(_RESULT))

    chunk = F.shiftright("place", chunk_bits).alias("chunk")
    open_rows = placed.where("not finished").select("conv", chunk, *_names(_ROW))
    firsts = (open_rows.where("not dropped").groupBy("conv", "role", "digest").agg(F.min("place").alias("place"))
              .select("conv", chunk, "place"))
    outcomes = staged(
        open_rows.groupBy("conv", "chunk").cogroup(firsts.groupBy("conv", "chunk"))
        .applyInArrow(_chunk_outcomes, from_arrow_schema(_OUTCOMES)), "outcomes")
    moves = outcomes.withColumn("moves", F.transform("outcomes", lambda o: o.dropFields("audit"))).drop("outcomes")
    ways = moves.groupBy("conv").applyInArrow(_chained, from_arrow_schema(_CHOSEN))
    chosen = (ways.join(outcomes.select("conv", "chunk", "outcomes"), ["conv", "chunk"])
              .withColumn("audit", F.filter("outcomes", lambda o: (o["start"] == F.col("start")) & (o["end"] == F.col("end")))
                          [0]["audit"]).drop("outcomes"))
    pieces = open_rows.groupBy("conv", "chunk").cogroup(chosen.groupBy("conv", "chunk")).applyInArrow(
        _spelled_chunk, from_arrow_schema(_SPELLED))
    long_ones = pieces.repartition("conv").sortWithinPartitions("conv", "chunk").mapInArrow(
        _joined, from_arrow_schema(_REPAIRED))
    both = short.unionByName(long_ones)
    conv_id = F.when(F.col("conv") != "null", F.substr("conv", F.lit(2))).cast(id_type)
    return both.select(conv_id.alias("conv_id"), *_names(_RESULT))


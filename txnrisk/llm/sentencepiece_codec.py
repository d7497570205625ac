"""SentencePiece encoding and decoding by shared-prefix Viterbi.

A text is marked (a dummy prefix, spaces as U+2581) and cut into marked words,
which no piece crosses. The distinct words a task has not met are sorted, so
that they form a trie, and walked depth-first: the forward states of a common
prefix are computed once and reused by every word below it.

A forward state holds the best score of a prefix, the piece that ends it and
where that begins. ``unigram`` models take the best sum of piece scores. For
``bpe`` models a sum of scores does not give the model's segmentation (merges
are greedy), so a step is admitted only where the two pieces that meet would
stay apart under the model's merges. By the theorem that a sequence is the BPE
of its text just when each neighbouring pair is that of theirs, exactly one
path survives, and it equals the library's result.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from txnrisk.llm.common import ready, slices, texts

MARK = "▁"
MODEL = public_tokenizers.path("piece_bpe_32k.model")

#: Words whose pieces one worker keeps between batches.
REMEMBERED = 500_000


#: Best score of a prefix, the piece that ends it (-1: none), where that begins, and the places where pieces begin that
#: may go on, each with its node in the tree of pieces.
State = tuple[float, int, int, list[tuple[int, int]]]


class Pieces:
    """The vocabulary of a model file and the segmentation of words by it."""

    def __init__(self, path: str, kind: str = "bpe"):
        if kind not in ("bpe", "unigram"):
            raise ValueError("kind is bpe or unigram")
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.kind, self.unknown = kind, model.unk_id()
        self.ids, self.scores, self.bytes_of, self.byte_ids = {}, [], [], {}
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            self.scores.append(model.get_score(i))
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                self.bytes_of.append(" ⁇ ".encode() if model.is_unknown(i) else b"")
            else:
                self.ids[piece] = i
                self.bytes_of.append(piece.replace(MARK, " ").encode())
        self.next: list[dict[str, int]] = [{}]  # the tree of pieces: node, character -> node
        self.ends = [-1]  # node -> piece
        for piece, i in self.ids.items():
            node = 0
            for c in piece:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    self.ends.append(-1)
                node = self.next[node][c]
            self.ends[node] = i
        self.spelling = {i: piece for piece, i in self.ids.items()} | {-1: ""}
        if any(MARK in piece.lstrip(MARK) for piece in self.ids):
            raise ValueError("pieces that cross a space are not supported")
        # A character that only byte pieces cover ends a word as well: nothing joins it.
        cuts = "\n" if not any("\n" in piece for piece in self.ids) else ""
        self.split = re.compile(f"{MARK}*[^{MARK}{cuts}]+|{MARK}+" + (f"|{cuts}" if cuts else "")).findall
        self.floor = min(self.scores, default=0.0) if kind == "bpe" else min(
            (self.scores[i] for i in self.ids.values()), default=0.0) - 10.0
        self.apart: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}

    def mark(self, text: str) -> str:
        return MARK + text.replace(" ", MARK) if text else ""

    def merged(self, word: str) -> list[str]:
        """The pieces that the model's merges leave of a short string: best score first, leftmost of equals."""
        parts = list(word)
        while len(parts) > 1:
            best = at = None
            for i in range(len(parts) - 1):
                piece = self.ids.get(parts[i] + parts[i + 1])
                if piece is not None and (best is None or self.scores[piece] > best):
                    best, at = self.scores[piece], i
            if at is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether the merges leave the two pieces apart; remembered by pair."""
        if len(self.apart) > 2_000_000:
            self.apart.clear()
        pair = [self.spelling[left], self.spelling[right]]
        found = self.apart[left << 32 | right] = self.merged("".join(pair)) == [p for p in pair if p]
        return found

    def step(self, word: str, end: int, states: list[State]) -> State:
        """Forward state of ``word[:end]`` from those of its shorter prefixes."""
        c = word[end - 1]
        following, ends, scores, apart, bpe = self.next, self.ends, self.scores, self.apart, self.kind == "bpe"
        alive, best = [], None
        for start, node in ((end - 1, 0), *states[-1][3]):  # the last character, then longer and longer pieces
            node = following[node].get(c)
            if node is None:
                continue
            if following[node]:
                alive.append((start, node))
            i = ends[node]
            if i < 0:  # only the beginning of longer pieces
                continue
            before = states[start]
            if bpe:
                if best is None:
                    left = before[1]
                    fits = apart.get(left << 32 | i)
                    if fits is None:
                        fits = self.stay_apart(left, i)
                    if fits:
                        best = (before[0] + scores[i], i, start)
            elif best is None or before[0] + scores[i] > best[0]:
                best = (before[0] + scores[i], i, start)
        if best is None or not bpe and c not in self.ids and states[end - 1][0] + self.floor > best[0]:
            best = (states[end - 1][0] + self.floor, -1, end - 1)  # a character without a piece joins nothing
        return *best, alive

    def spell(self, word: str, states: list[State]) -> tuple[int, ...]:
        out: list[int] = []
        end = len(word)
        while end:
            _, piece, start, _ = states[end]
            if piece >= 0:
                out.append(piece)
            elif self.byte_ids:
                out.extend(self.byte_ids[b] for b in reversed(word[start:end].encode()))
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
            end = start
        return tuple(reversed(out))

    def segment(self, words: Iterable[str]) -> dict[str, tuple[int, ...]]:
        """Ids of each distinct word, by a depth-first walk of their trie."""
        found = {}
        states: list[State] = [(0.0, -1, 0, [])]
        previous = ""
        for word in sorted(words):
            shared = 0
            for a, b in zip(previous, word):
                if a != b:
                    break
                shared += 1
            del states[shared + 1:]
            for end in range(shared + 1, len(word) + 1):
                states.append(self.step(word, end, states))
            found[word] = self.spell(word, states)
            previous = word
        return found

    def encode(self, documents: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        cut = [self.split(self.mark(text)) for text in documents]
        met = set(chain.from_iterable(cut))
        new = met.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:  # what these documents share with earlier ones stays
            self.known = {word: self.known[word] for word in met - new}
        known = self.known
        if new:
            known.update((word, array("i", ids).tobytes()) for word, ids in self.segment(new).items())
        return [np.frombuffer(b"".join(map(known.__getitem__, words)), np.int32) for words in cut]

    def decode(self, ids: Iterable[int]) -> str:
        """The text of the ids; without the space that encoding put in front. Ill-formed bytes become U+FFFD."""
        ids = ids.tolist() if isinstance(ids, np.ndarray) else ids
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_LOADED: dict[tuple[str, str], Pieces] = {}


def pieces(path: str = MODEL, kind: str = "bpe") -> Pieces:
    """The model, loaded once per worker."""
    if (path, kind) not in _LOADED:
        _LOADED[path, kind] = Pieces(path, kind)
    return _LOADED[path, kind]


def _with(frame: DataFrame, name: str, kind: T.DataType) -> tuple[DataFrame, T.StructType]:
    others = frame.drop(name)
    return others, T.StructType([*others.schema.fields, T.StructField(name, kind)])


def encode(docs: DataFrame, text_column: str = "text", path: str = MODEL, kind: str = "bpe",
           name: str = "token_ids") -> DataFrame:
    """All columns of ``docs`` and the ids of the whole text as an array of ints.

    Null and empty texts have no ids. A column ``name`` that is there already
    is replaced. Repeated rows are encoded alike; an empty table stays empty.
    """
    ready(docs.sparkSession)
    others, schema = _with(docs, name, T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path, kind)
        for batch in slices(batches, text_column):
            ids = model.encode(texts(batch, text_column))
            yield pa.RecordBatch.from_arrays([*batch.columns, _lists(ids)], [*batch.schema.names, name])

    return others.mapInArrow(run, schema)


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    """Arrays of ints as one Arrow array."""
    offsets = np.concatenate(([0], np.cumsum(list(map(len, ids))))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32)))


def decode(encoded: DataFrame, ids_column: str = "token_ids", path: str = MODEL, kind: str = "bpe",
           name: str = "decoded") -> DataFrame:
    """All columns of ``encoded`` and the text of the ids; null and empty ids give the empty text."""
    ready(encoded.sparkSession)
    others, schema = _with(encoded, name, T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path, kind)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                plain = [model.decode(ids or ()) for ids in part.column(ids_column).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(plain, pa.string())], [*part.schema.names, name])

    return others.mapInArrow(run, schema)


def round_trip(docs: DataFrame, text_column: str = "text", path: str = MODEL, kind: str = "bpe") -> DataFrame:
    """``encode`` and ``decode`` in one pass: all columns of ``docs``, token_ids and decoded."""
    ready(docs.sparkSession)
    encoded, schema = _with(docs.drop("decoded"), "token_ids", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path, kind)
        for batch in slices(batches, text_column):
            ids = model.encode(texts(batch, text_column))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, _lists(ids), pa.array(map(model.decode, ids), pa.string())],
                [*batch.schema.names, "token_ids", "decoded"])

    return encoded.mapInArrow(run, T.StructType([*schema.fields, T.StructField("decoded", T.StringType())]))


def crc32(text: str) -> int:
    return zlib.crc32(text.encode())

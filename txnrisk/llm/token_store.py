"""Token ids in the seekable Zstandard format.

A file is a run of independent Zstandard frames, each holding whole documents'
ids (unsigned little-endian, two bytes where the vocabulary allows, else
four), then a frame with the document index (an Arrow stream: doc_id, frame,
n_tokens, in order; width in its metadata), then the format's seek table: a
skippable frame with each frame's sizes and the low 32 bits of the XXH64 of
its content. A reader takes the table from the end of the file, the index from
the last frame, and decompresses only frames that hold the documents asked for.
Chunks end in an empty skippable frame, whose one byte is the line separator
of the sink (see ``binary_files``); any Zstandard reader skips it.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from txnrisk.llm.binary_files import read_files, write_chunks
from txnrisk.llm.common import ready, slices, texts

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 2

#: Fixed values of the public format.
SEEK_TABLE_MAGIC = 0x184D2A5E
SKIPPABLE_MAGIC = 0x184D2A50
FOOTER_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

LAST = struct.pack("<I", FOOTER_MAGIC)[-1:]
_PAD = struct.pack("<II", SKIPPABLE_MAGIC, 1)

#: Uncompressed bytes after which a frame ends, compressed bytes after which a chunk ends.
FRAME, CHUNK = 128 << 10, 1 << 20

#: Chunks of text whose ids one worker keeps between batches.
REMEMBERED = 500_000

#: A space behind white space of any kind, and the places before spaces behind anything else.
_INNER_SPACE = re.compile(r" (?<=\s )").search
_RUNS = re.compile(r"(?<=\S)(?= )").split
#: Marks that make one part with all that follow a word at once.
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

def _byte_letters() -> dict[int, str]:
    """The public byte-level alphabet: printable Latin-1 stands for itself, other bytes for U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


_LETTERS = _byte_letters()


class Encoder:
    """Packed ids of texts by a tokenizers file.

    The byte-level tokenizer splits a text by its pattern and merges each word
    apart. No alternative of the pattern reaches over a space that follows
    anything but white space, so a text is the run of the chunks that
    begin there; chunks met before need not be encoded again. Texts that
    spell a special token, which the library cuts out first, are left to it whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.width = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.code = {"<u2": "H", "<u4": "I"}[self.width]
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}

    def word(self, word: str) -> bytes:
        plain = word.isascii() and word.isprintable()  # such bytes stand for themselves, but for the space
        letters = word.replace(" ", _LETTERS[32]) if plain else word.encode().decode("latin-1").translate(_LETTERS)
        return array(self.code, [token.id for token in self.merge(letters)]).tobytes()

    def learn(self, new: set[str]) -> None:
        """Ids of the chunks of ``new``; most are one word."""
        known, word = self.known, self.word
        for chunk in new:
            if (chunk[1:] if chunk[:1] == " " else chunk).isalpha():
                if chunk not in known:  # as part of an earlier one
                    known[chunk] = word(chunk)
            else:
                known[chunk] = self.chunk(chunk)

    def chunk(self, chunk: str) -> bytes:
        """A line's end between a letter or mark and a letter is a part by itself, so lines there are encoded apart."""
        _, *rest = lines = chunk.split("\n")
        if not rest:
            return self.line(chunk)
        if all(after[:1].isalpha() and (line[-1:].isalpha() or line and line[-1] in _MARKS) for line, after in zip(lines, rest)):
            return self.part("\n").join(map(self.line, lines))
        return b"".join(map(self.part, self.split(chunk)))

    def line(self, line: str) -> bytes:
        """A word with marks after it is cut without the pattern."""
        start = line[:1] == " "
        stem = (line[1:] if start else line).rstrip(_MARKS)
        if not stem.isalpha():
            return b"".join(map(self.part, self.split(line)))
        end = start + len(stem)
        return self.part(line[:end]) + self.part(line[end:]) if end < len(line) else self.part(line)

    def part(self, part: str) -> bytes:
        found = self.known.get(part)
        if found is None:
            found = self.known[part] = self.word(part)
        return found

    def encode(self, documents: list[str]) -> list[bytes]:
        cut = []
        for text in documents:
            if any(token in text for token in self.special):
                cut.append(None)
            elif _INNER_SPACE(text):
                cut.append(_RUNS(text))
            else:
                first, *rest = text.split(" ")
                cut.append([first, *[" " + word for word in rest]])
        met = set(chain.from_iterable(filter(None, cut)))
        new = met.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:  # what these documents share with earlier ones stays
            self.known = {chunk: self.known[chunk] for chunk in met - new}
        self.learn(new)
        known = self.known.__getitem__
        return [
            b"".join(map(known, chunks)) if chunks is not None
            else np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.width).tobytes()
            for text, chunks in zip(documents, cut)]


_LOADED: dict[str, Encoder] = {}


def encoder(path: str = VOCABULARY) -> Encoder:
    """The tokenizer, loaded once per worker."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def encode(documents: list[str], path: str = VOCABULARY) -> list[bytes]:
    """Packed ids of each text."""
    return encoder(path).encode(documents)


class _Writer:
    """The chunks of one file."""

    def __init__(self, width: str):
        self.width, self.table, self.index = width, [], ([], [], [])
        self.held: list[bytes] = []
        self.size = 0
        self.done: list[bytes] = []
        self.compress = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True).compress

    def add(self, doc_id: int | None, ids: bytes) -> None:
        for column, value in zip(self.index, (doc_id, self._frames(), len(ids) // int(self.width[2:]))):
            column.append(value)
        self.held.append(ids)
        self.size += len(ids)
        if self.size >= FRAME:
            self.flush()

    def _frames(self) -> int:
        return len(self.table)

    def frame(self, content: bytes) -> None:
        packed = self.compress(content)
        self.table.append((len(packed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
        self.done.append(packed)

    def flush(self) -> None:
        if self.held:
            self.frame(b"".join(self.held))
            self.held, self.size = [], 0

    def chunk(self) -> bytes:
        """What is done, padded, without the pad's last byte."""
        out = b"".join(self.done) + _PAD
        self.done = []
        self.table.append((len(_PAD) + 1, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
        return out

    def close(self) -> bytes:
        """The last frames, the index and the seek table, without its last byte."""
        self.flush()
        schema = pa.schema([("doc_id", pa.int64()), ("frame", pa.int32()), ("n_tokens", pa.int64())],
                           metadata={"width": self.width})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, schema) as stream:
            stream.write_batch(pa.record_batch(list(map(pa.array, self.index, schema.types)), schema=schema))
        self.frame(sink.getvalue().to_pybytes())
        entries = b"".join(struct.pack("<III", *row) for row in self.table)
        table = struct.pack("<II", SEEK_TABLE_MAGIC, len(entries) + 9) + entries + struct.pack(
            "<IBI", len(self.table), CHECKSUM_FLAG, FOOTER_MAGIC)
        return b"".join(self.done) + table[:-1]


def write(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text",
          vocabulary: str = VOCABULARY, end_id: int = END_ID) -> None:
    """Encode whole texts and write them in ascending id order, one file per range of ids.

    Null texts count as empty and hold the end id alone. Null ids come first;
    equal ids order by text. Other columns are ignored. An empty table writes
    no file with content.
    """
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = encoder(vocabulary).width
        writer, end = None, np.array([end_id], width).tobytes()
        for batch in slices(batches, text_column, 4 << 20):
            writer = writer or _Writer(width)
            for doc_id, ids in zip(batch.column(id_column).to_pylist(), encode(texts(batch, text_column), vocabulary)):
                writer.add(doc_id, ids + end)
                if sum(map(len, writer.done)) >= CHUNK:
                    yield pa.record_batch([pa.array([writer.chunk()], pa.binary())], ["chunk"])
        if writer:
            yield pa.record_batch([pa.array([writer.close()], pa.binary())], ["chunk"])

    ordered = docs.select(id_column, text_column).repartitionByRange(id_column).sortWithinPartitions(
        F.col(id_column).asc_nulls_first(), F.col(text_column).asc_nulls_first())
    write_chunks(ordered.mapInArrow(run, "chunk binary"), path, LAST)


class Archive:
    """Random access to the bytes of one file."""

    def __init__(self, content: bytes):
        self.content = memoryview(content)
        frames, flags, magic = struct.unpack("<IBI", self.content[-9:])
        if magic != FOOTER_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError("no seek table")
        table = np.frombuffer(self.content[-9 - 12 * frames:-9], "<u4").reshape(-1, 3).astype(np.int64)
        self.sizes, self.sums = table[:, 1], table[:, 2]
        self.starts = np.concatenate(([0], np.cumsum(table[:, 0])))
        stream = pa.ipc.open_stream(self.frame(frames - 1))
        self.width = stream.schema.metadata[b"width"].decode()
        self.index = stream.read_all()

    def frame(self, number: int) -> bytes:
        """Content of one frame, checked against the seek table."""
        packed = self.content[self.starts[number]:self.starts[number + 1]]
        content = zstandard.ZstdDecompressor().decompress(packed, max_output_size=int(self.sizes[number]))
        if xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.sums[number]:
            raise ValueError(f"checksum of frame {number} differs")
        return content

    def documents(self, wanted: Iterable[int] | None = None) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, ids before it in this file, ids); only frames with wanted documents are decompressed."""
        wanted = None if wanted is None else set(wanted)
        current = content = None
        before = at = 0
        for doc_id, frame, n in zip(*(self.index.column(c).to_pylist() for c in ("doc_id", "frame", "n_tokens"))):
            if frame != current:
                current, content, at = frame, None, 0
            if wanted is None or doc_id in wanted:
                if content is None:
                    content = np.frombuffer(self.frame(frame), self.width)
                yield doc_id, before, content[at:at + n]
            at += n
            before += n


def _file_bases(files: DataFrame) -> dict[str, int]:
    """Number of ids in all files before each, in the order of their ids, from the files' indexes.

    One row per file comes to the driver, which lists the files anyway.
    """
    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [Archive(content.as_buffer()).index.column("n_tokens").to_numpy().sum()
                    for content in batch.column("content")]
            yield pa.record_batch([batch.column("path"), pa.array(held, pa.int64())], ["path", "total"])

    bases, before = {}, 0
    rows = files.mapInArrow(totals, "path string, total long").collect()
    for path, total in sorted(rows, key=lambda row: int(re.search(r"part-(\d+)", row.path)[1])):
        bases[path] = before
        before += total
    return bases


def read(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, token_ids binary of little-endian unsigned 32-bit ids) of the files' documents.

    ``start`` counts the ids of all documents before, in all files. ``doc_ids``
    asks for some documents only. The files' indexes are read at once, their
    documents with the result.
    """
    ready(spark)
    files = read_files(spark, path)
    bases = _file_bases(files)
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("token_ids", pa.binary())])

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch(list(map(pa.array, zip(*rows), schema.types)), schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                rows: list[tuple] = []
                for doc_id, before, ids in Archive(content.as_buffer()).documents(doc_ids):
                    rows.append((doc_id, bases[name] + before, len(ids), ids.astype("<u4").tobytes()))
                    if len(rows) == 1024:
                        yield _rows(rows)
                        rows = []
                if rows:
                    yield _rows(rows)

    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, token_ids binary")

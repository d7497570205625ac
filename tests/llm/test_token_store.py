import zlib

import numpy as np
import pytest
import zstandard
from tokenizers import Tokenizer

from tests.llm.conftest import EDGE_ROWS
from txnrisk.llm import token_store
from txnrisk.llm.binary_files import read_files
from txnrisk.llm.common import read_table
from txnrisk.session import scratch

LIBRARY = Tokenizer.from_file(token_store.VOCABULARY)


def plain(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, token_store.END_ID]


@pytest.mark.parametrize("text", [
    "", " ", "  ", "a", " a", "a ", "a  b", "a   b", "a \n b", "a\n  b", "a\n b", "\n\n", "don't  stop, it's\t\there's ",
    "x <|endoftext|> y", "hi <|endoftext|> there  and <|endoftext|>", "x  y  <|endoftext|  z", "a  \t b  c.  d", "é日 😀 1234 !!??     x", "tab\there \r\n line"])
def test_chunks_encode_like_whole_texts(text):
    assert np.frombuffer(token_store.encode([text])[0], "<u2").tolist() == plain(text)[:-1]


@pytest.mark.parametrize("text", [
    "one.\nTwo", "a one,***\nTwo###  three", "don't\n's it'\ns", "***\nab", "a\n\nb", "a.\n\nB", "a\n b", "a \nb", "é,.;\nÈç$$$ ñ", "x_\ny",
    "1\na", "a1.\nb2", "\na", "a\n", "\n".join(["Word", "word,", "wörd!!"] * 1000), "a" + "\n" * 3000 + "b"])
def test_lines_and_marks_encode_like_whole_texts(text):
    for before in ("", " ", "x "):
        assert np.frombuffer(token_store.encode([before + text])[0], "<u2").tolist() == plain(before + text)[:-1]


def test_marks_after_words_and_line_ends_are_cut_without_the_pattern():
    encoder = token_store.Encoder(token_store.VOCABULARY)
    encoder.split = None
    ids = encoder.encode(["One,*** two.\nThree### four!!\nFive six"])[0]
    assert np.frombuffer(ids, "<u2").tolist() == plain("One,*** two.\nThree### four!!\nFive six")[:-1]


@pytest.mark.parametrize("space", [*"\t\n\x0b\x0c\r\x1c\x1f\x85\u00a0\u1680\u2003\u2028\u202f\u205f\u3000"])
def test_white_space_of_all_kinds_encodes_like_whole_texts(space):
    runs = (f" {space} {space} ", f"{space} ", f" {space}", f" {space} ", f"{space}{space}", f" {space}" * 8, f"{space} {space}")
    for text in (f"{before}{run}{after}" for run in runs for before in ("a", "", "1.") for after in ("b", "", "!")):
        assert np.frombuffer(token_store.encode([text])[0], "<u2").tolist() == plain(text)[:-1], repr(text)


def test_query_equals_the_library(spark):
    from txnrisk.llm.queries import op4_token_store
    docs = sorted(read_table(spark, "/root/testdata/sf0.001", "documents").collect(), key=lambda r: r.doc_id)
    rows = sorted(op4_token_store(spark, "/root/testdata/sf0.001").collect(), key=lambda r: r.doc_id)
    start = 0
    assert len(rows) == len(docs)
    for doc, row in zip(docs, rows):
        ids = plain(doc.text)
        assert (row.doc_id, row.start, row.n_tokens) == (doc.doc_id, start, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_files(spark, edge, monkeypatch):
    monkeypatch.setattr(token_store, "FRAME", 4096)
    path = scratch(spark, "tokens")
    token_store.write(edge, path)
    rows = sorted(token_store.read(spark, path).collect(), key=lambda r: r.start)
    order = sorted(EDGE_ROWS, key=lambda row: (row[0] is not None, row[0] or 0, row[1] is not None, row[1] or ""))
    assert [r.doc_id for r in rows] == [row[0] for row in order]
    assert [np.frombuffer(r.token_ids, "<u4").tolist() for r in rows] == [plain(row[1]) for row in order]
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1].tolist()]
    some = token_store.read(spark, path, [5]).collect()
    assert sorted(r.start for r in some) == [r.start for r in rows if r.doc_id == 5]
    for file in read_files(spark, path).collect():
        content = bytes(file.content)
        whole = zstandard.ZstdDecompressor().stream_reader(content, read_across_frames=True).read()  # any reader takes the file
        archive = token_store.Archive(content)
        assert sum(archive.sizes) == len(whole)
        broken = bytearray(content)
        broken[archive.starts[0] + 12] ^= 1
        with pytest.raises((ValueError, zstandard.ZstdError)):
            token_store.Archive(bytes(broken)).frame(0)


def test_only_requested_frames_are_read(monkeypatch):
    writer = token_store._Writer("<u2")
    monkeypatch.setattr(token_store, "FRAME", 64)
    for doc_id in range(50):
        writer.add(doc_id, np.arange(doc_id, dtype="<u2").tobytes())
    archive = token_store.Archive(writer.close() + token_store.LAST)
    read = []
    frame = archive.frame
    archive.frame = lambda number: read.append(number) or frame(number)
    (found,) = archive.documents([17])
    assert found[:2] == (17, sum(range(17))) and found[2].tolist() == list(range(17)) and len(read) == 1


def test_empty_table(spark, nothing):
    path = scratch(spark, "tokens")
    token_store.write(nothing, path)
    assert token_store.read(spark, path).count() == 0

import base64
import gzip
import hashlib
import io
import random
import re

import pytest

from tests.llm.conftest import EDGE_ROWS
from txnrisk.llm import warc
from txnrisk.session import scratch


def member(*records):
    return gzip.compress(b"".join(records), mtime=0)


RECORDS = [warc.record(i, f"http://h/{i}", f"<p>page {i}</p>".encode() * (i + 1)) for i in range(5)]


def names(found):
    return [f.fields["warc-record-id"] for f in found if f.fields is not None]


def gaps(found):
    return [(f.offset, f.length) for f in found if f.fields is None]


def test_sound_files_have_no_gaps():
    for content in (b"".join(map(member, RECORDS)), b"".join(RECORDS), member(*RECORDS)):
        found = list(warc.salvage(content))
        assert names(found) == [f"<urn:x-page:{i}>" for i in range(5)] and gaps(found) == []
        assert [f.payload for f in found] == [f"<p>page {i}</p>".encode() * (i + 1) for i in range(5)]


@pytest.mark.parametrize("packed", [True, False])
def test_damage_loses_its_record_only(packed):
    parts = [member(r) if packed else r for r in RECORDS]
    begin = len(parts[0]) + len(parts[1])
    for at in (0, 3, 30, len(parts[2]) // 2, len(parts[2]) - 6):
        broken = bytearray(b"".join(parts))
        broken[begin + at] ^= 0x55
        found = list(warc.salvage(bytes(broken)))
        assert names(found) in ([f"<urn:x-page:{i}>" for i in (0, 1, 3, 4)], [f"<urn:x-page:{i}>" for i in range(5)])
        if len(names(found)) == 4:
            assert gaps(found) == [(begin, len(parts[2]))]


NOISE = [warc.record(i, f"http://h/{i}", random.Random(i).randbytes(9_000)) for i in range(12)]


@pytest.mark.parametrize("bad", [(0,), (2,), (4,), (1, 2), (0, 4)])
def test_a_bad_record_in_a_member_loses_itself_only(bad):
    records = [r.replace(b"<p>", b"<q>") if i in bad else r for i, r in enumerate(RECORDS)]
    packed = member(*records)
    found = list(warc.salvage(b"junk" + packed + member(RECORDS[0])))
    assert names(found) == [f"<urn:x-page:{i}>" for i in (*(i for i in range(5) if i not in bad), 0)]
    runs = sum(i - 1 not in bad for i in bad)
    assert gaps(found) == [(0, 4)] + [(4, len(packed))] * runs
    assert all(f.reason.startswith("block digest differs (bytes ") for f in found[1:] if f.fields is None)


@pytest.mark.parametrize("level", [0, 6])
@pytest.mark.parametrize("cut", [True, False])
def test_records_before_the_damage_of_a_member_are_kept(level, cut):
    packed = bytearray(gzip.compress(b"".join(NOISE), level, mtime=0))
    if cut:
        del packed[-12_000:]
    else:
        packed[len(packed) * 3 // 4] ^= 0x55
    found = list(warc.salvage(bytes(packed) + member(RECORDS[0])))
    held = [int(re.search("page:([0-9]+)", name)[1]) for name in names(found)]
    assert held[-1] == 0 and len(set(held[:-1])) == len(held[:-1]) and set(range(8)) <= set(held[:-1])
    assert gaps(found) and gaps(found)[-1][0] + gaps(found)[-1][1] == len(packed)


def test_a_header_has_any_length():
    record = warc.record(1, "http://h/" + "é" * 400_000, b"x")
    found = list(warc.salvage(record + RECORDS[0]))
    assert len(record) > 1 << 21 and names(found) == ["<urn:x-page:1>", "<urn:x-page:0>"] and gaps(found) == []
    cut = record[:record.index(b"WARC-Date")]
    found = list(warc.salvage(cut + RECORDS[0]))
    assert names(found) == ["<urn:x-page:0>"] and gaps(found) == [(0, len(cut))]


def test_cut_missing_and_foreign_bytes():
    parts = list(map(member, RECORDS))
    content = b"junk" + parts[0] + parts[1][:20] + parts[2] + RECORDS[3] + b"\0\0\0" + parts[4][:-5]
    found = list(warc.salvage(content))
    assert names(found) == [f"<urn:x-page:{i}>" for i in (0, 2, 3)]
    assert [n for _, n in gaps(found)] == [4, 20, 3 + len(parts[4]) - 5]
    assert all(f.reason for f in found if f.fields is None)
    assert list(warc.salvage(b"")) == []
    assert gaps(warc.salvage(b"no archive at all")) == [(0, 17)]


def test_version_lines_and_magic_inside_payloads():
    inner = warc.record(99, None, b"WARC/1.1\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n" + warc.GZIP * 50)
    found = list(warc.salvage(inner + RECORDS[0]))
    assert names(found) == ["<urn:x-page:99>", "<urn:x-page:0>"]


def test_headers_take_any_url():
    record = warc.record(1, "http://h/\r\nX: y é 😀?q=1#f", b"")
    (found,) = warc.salvage(record)
    assert "x" not in found.fields and found.fields["warc-target-uri"].startswith("http://h/%0D%0AX:%20y%20")


def test_long_payload_ends_like_the_others():
    record = warc.record(1, None, b"\xab" * ((1 << 24) + 5))
    packed = warc._member(record)
    assert packed.endswith(warc.LAST)
    (found,) = warc.salvage(packed)
    assert found.payload == b"\xab" * ((1 << 24) + 5)


def expected(pages, at_least=0):
    payloads = [(page_id, (html or "").encode()) for page_id, html in pages]
    first = {}
    for page_id, payload in payloads:
        if page_id is not None:
            first[payload] = min(page_id, first.get(payload, page_id))
    out = []
    for page_id, payload in payloads:
        again = page_id is not None and len(payload) >= at_least and page_id != first[payload]
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((str(page_id), len(payload), digest, "revisit" if again else "response", first[payload] if again else None))
    return sorted(out, key=str)


def read(spark, path):
    rows = warc.read_archives(spark, path)
    assert rows.where("gap_reason is not null").count() == 0
    return sorted(((str(r.page), r.payload_bytes, r.payload_digest, r.record_type, r.first) for r in rows.select(
        "*", warc.page_number("record_id").alias("page"), warc.page_number("refers_to").alias("first")).collect()), key=str)


@pytest.mark.parametrize("at_least", [0, 10])
def test_round_trip(spark, edge, at_least):
    pages = edge.selectExpr("doc_id AS page_id", "source AS url", "text AS html", "'x' AS payload", "1 AS sha1", "2 AS first")
    path = scratch(spark, "warc")
    warc.write_archives(pages, path, at_least)
    assert read(spark, path) == expected([(row[0], row[1]) for row in EDGE_ROWS], at_least)
    for file in warc.read_files(spark, path).collect():  # any gzip reader takes the files
        assert gzip.GzipFile(fileobj=io.BytesIO(bytes(file.content))).read().startswith(b"WARC/1.1\r\n")


def test_gaps_are_reported_by_spark(spark, tmp_path):
    parts = list(map(member, RECORDS))
    (tmp_path / "part-0").write_bytes(parts[0] + b"\x1f\x8b\x08broken" + parts[1])
    rows = warc.read_archives(spark, str(tmp_path)).orderBy("offset").collect()
    assert [(r.offset, r.length, r.gap_reason is not None) for r in rows] == [
        (0, len(parts[0]), False), (len(parts[0]), 9, True), (len(parts[0]) + 9, len(parts[1]), False)]


def test_archives_of_any_name_and_depth_are_read(spark, tmp_path):
    (tmp_path / "2024" / "01").mkdir(parents=True)
    (tmp_path / "a.warc.gz").write_bytes(member(*RECORDS[:2]))
    (tmp_path / "2024" / "b.warc").write_bytes(RECORDS[2])
    (tmp_path / "2024" / "01" / "part-0").write_bytes(member(RECORDS[3]) + b"junk")
    rows = warc.read_archives(spark, str(tmp_path)).collect()
    assert sorted(r.record_id for r in rows if r.record_id) == [f"urn:x-page:{i}" for i in range(4)]
    assert [(r.path.rsplit("/", 1)[1], r.length) for r in rows if r.gap_reason] == [("part-0", 4)]


def test_empty_table(spark, nothing):
    path = scratch(spark, "warc")
    warc.write_archives(nothing.selectExpr("doc_id AS page_id", "source AS url", "text AS html"), path)
    assert warc.read_archives(spark, path).count() == 0

from __future__ import annotations

import hashlib
import io
import random
import struct
import zipfile

import pyarrow as pa
import pytest
from llm_helpers import rows_of

from ledgerline.llm import zip_warc
from ledgerline.llm.zip_warc import (
    archive_round_trip,
    data_start,
    members,
    parsed,
    read_archives,
    record,
    write_archives,
)
from ledgerline.session import materialize

SCHEMA = "page_id long, url string, html string, refers_to string, path string"


def brute(rows):
    large: dict = {}
    for i, _, h in rows:
        raw = (h or "").encode()
        if len(raw) >= 1000 and i is not None:
            large[raw] = max(large.get(raw, i), i)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        head = large.get(raw)
        revisit = head is not None and (i is None or i < head)
        kind = ("revisit", head) if revisit else ("response", None)
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), *kind))
    return sorted(out, key=repr)


def pages(session, rows):
    return session.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def some_rows(seed=1, n=300):
    rng = random.Random(seed)
    bodies = ["é" * 499 + "b", "é" * 500, "x" * 999, "y" * 1000, "z" * 5000, "", None]
    rows = [(i, f"http://h/{i}?q=%25\n{i}", rng.choice(bodies)) for i in range(n)]
    odd = [(None, None, None), (None, "u", "z" * 5000), (None, "v", "q" * 2000), (-5, "http://é", "w\r\n\r\nWARC/1.1")]
    return [*rows, *odd, rows[3], rows[3]]


def test_round_trip(session):
    rows = some_rows()
    out = archive_round_trip(pages(session, rows))
    assert sorted(rows_of(out), key=repr) == brute(rows)
    assert archive_round_trip(pages(session, [])).count() == 0


def test_small_archives_and_ranges(session, tmp_path, monkeypatch):
    monkeypatch.setattr(zip_warc, "ARCHIVE_BYTES", 3000)
    monkeypatch.setattr(zip_warc, "RANGE_BYTES", 700)
    rows = some_rows(2)
    archives = write_archives(pages(session, rows), f"{tmp_path}/warc")
    assert archives.count() > 5
    found = read_archives(session, archives).collect()
    assert len(found) == len(rows)
    texts = {(r[0], r[1]): (r[2] or "").encode() for r in rows}
    for r in found:
        if r["record_type"] == "response" and r["page_id"] is not None:
            assert bytes(r["payload"]) == texts[r["page_id"], r["url"]]


def test_several_archives_of_one_task(session, tmp_path, monkeypatch):
    monkeypatch.setattr(zip_warc, "ARCHIVE_BYTES", 3000)
    rows = some_rows(3)
    one = pages(session, rows).coalesce(1)
    monkeypatch.setattr(zip_warc, "materialize", lambda df, name: materialize(df.coalesce(1) if name == "archives" else df, name))
    archives = write_archives(one, f"{tmp_path}/warc")
    assert archives.rdd.getNumPartitions() == 1 and archives.count() >= 3
    found = read_archives(session, archives, keep_payload=False).drop("url", "payload")
    assert sorted(rows_of(found), key=repr) == brute(rows)


def test_lost_rows_are_told(session, tmp_path, monkeypatch):
    monkeypatch.setattr(zip_warc, "chain", lambda first, rest: iter(first))
    monkeypatch.setattr(zip_warc, "_rows", lambda *a: iter([(1, "u", "x", None)]))
    with pytest.raises(RuntimeError, match="were written for 5 pages"):
        write_archives(pages(session, some_rows(4)[:5]), f"{tmp_path}/warc")


def test_members_of_any_zip():
    """Comments, many members, data descriptors and names in UTF-8, as zipfile writes them."""
    for comment in (b"", b"PK\x05\x06 is no end record here", b"c" * 65535, b"ends in PK\x05\x06"):
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w") as package:
            for i in range(70):
                package.writestr(f"é{i}", str(i) * i)
            with package.open("wide", "w", force_zip64=True) as out:
                out.write(b"abc")
            package.comment = comment
        file = pa.BufferReader(held.getvalue())
        found = {m.name: m for m in members(file)}
        assert len(found) == 71
        wide = found["wide"]
        start = data_start(file, wide)
        assert held.getvalue()[start : start + wide.size] == b"abc"


def test_zip64_directory():
    """More members than 16 bits count: the directory is found by the ZIP64 records."""
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as package:
        for i in range(66_000):
            package.writestr(str(i), b"")
    assert b"PK\x06\x06" in held.getvalue()[-200:]
    found = members(pa.BufferReader(held.getvalue()))
    assert [m.name for m in found] == [str(i) for i in range(66_000)]


def test_wide_fields_of_a_member():
    """A central header with all three fields in the ZIP64 extra."""
    name, big = b"data", 1 << 33
    extra = struct.pack("<HHQQQ", 1, 24, big, big + 1, big + 2)
    central = struct.pack("<4sHHHHHHIIIHHHHHII", b"PK\x01\x02", 45, 45, 0, 0, 0, 0, 0, *[0xFFFFFFFF] * 2, 4, 28, 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    end = struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 1, 1, len(central), 0, 0)
    (member,) = members(pa.BufferReader(central + end))
    assert (member.size, member.compressed, member.header) == (big, big + 1, big + 2)


@pytest.mark.parametrize(
    "raw",
    [b"", b"no zip at all", b"PK\x05\x06" + b"\0" * 10, b"x" * 50 + b"PK\x05\x06" + b"\0" * 17],
)
def test_broken_archives_are_refused(raw):
    with pytest.raises(ValueError, match="directory|early"):
        members(pa.BufferReader(raw))


def test_a_changed_payload_is_refused():
    raw = record(1, "http://x", b"payload", None)
    assert parsed(raw)["payload"] == b"payload"
    with pytest.raises(ValueError, match="digest"):
        parsed(raw.replace(b"payload\r\n", b"paYload\r\n"))

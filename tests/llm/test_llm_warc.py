from __future__ import annotations

import gzip
import io
import random

import pytest

from cadastra.llm import warc

SCHEMA = "page_id long, url string, html string, payload string"


def round_trip(spark, tmp_path, rows, **more):
    path = str(tmp_path / f"warc-{random.random()}")
    warc.write_archives(spark.createDataFrame(rows, SCHEMA), path, **more)
    return warc.read_archives(spark, path).collect(), path


def test_records_come_back(spark, tmp_path):
    rows = [(5, "http://a", "<p>same", ""), (3, "http://b", "<p>same", ""), (9, None, "<p>same", ""), (1, "x\r\nWARC-Type: x ", "", None), (2, "u%41ü", None, None),
            (7, "http://c", "Größe\r\n\r\nWARC/1.1", None), (8, "", "y" * 3_000_000, None), (None, "n", "<p>same", None), (6, "k", "\x00\x00", None), (6, "k", "\x00\x00", None)]
    got, _ = round_trip(spark, tmp_path, rows)
    assert len(got) == len(rows)
    found = sorted((str(r["page_id"]), r["url"], r["record_type"], r["refers_to"]) for r in got)
    assert found == sorted([
        ("5", "http://a", "revisit", 3), ("3", "http://b", "response", None), ("9", "", "revisit", 3), ("1", "x\r\nWARC-Type: x ", "response", None),
        ("2", "u%41ü", "revisit", 1), ("7", "http://c", "response", None), ("8", "", "response", None), ("None", "n", "revisit", 3),
        ("6", "k", "response", None), ("6", "k", "response", None),
    ])
    payloads = {r[0]: (r[2] or "").encode() for r in rows if r[0] is not None}
    for r in got:
        if r["page_id"] is not None:
            whole = payloads[r["page_id"]]
            assert (r["payload_bytes"], r["payload_digest"]) == (len(whole), warc.digest(whole))
            assert r["payload"] == (whole if r["record_type"] == "response" else None)


def test_small_payloads_need_not_be_revisits(spark, tmp_path):
    rows = [(1, "a", "ab", ""), (2, "b", "ab", ""), (3, "c", "abcd", ""), (4, "d", "abcd", "")]
    got, _ = round_trip(spark, tmp_path, rows, revisit_from=3)
    assert sorted((r["page_id"], r["record_type"]) for r in got) == [(1, "response"), (2, "response"), (3, "response"), (4, "revisit")]


def test_files_are_plain_gzip_with_a_member_for_each_record(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 2)
    rows = [(i, f"u{i}", f"page {i} " * i, "") for i in range(7)]
    got, path = round_trip(spark, tmp_path, rows)
    assert len(got) == 7
    import pathlib

    files = [p for p in pathlib.Path(path).glob("part-*")]
    assert len(files) >= 4
    text = b"".join(gzip.decompress(p.read_bytes()) for p in files)
    assert text.count(b"WARC/1.1\r\n") == 7


def test_empty_table(spark, tmp_path):
    assert round_trip(spark, tmp_path, [])[0] == []


def test_members_above_16_mib_are_padded(spark):
    data = warc.member(1, "u", b"\x00" * (17 << 20), None, False)
    assert data[-1] != 0
    read = list(warc.read_records(io.BytesIO(data + b"\0" + warc.member(2, "v", b"z", None, False))))
    assert [(r[0], r[4]) for r in read] == [(1, 17 << 20), (2, 1)]


@pytest.mark.parametrize("harm", ["cut", "payload", "length", "start"])
def test_harm_is_noticed(harm):
    good = warc.member(1, "u", b"hello" * 100, None, False)
    plain = gzip.decompress(good)
    bad = {
        "cut": lambda: good[:-20],
        "payload": lambda: gzip.compress(plain.replace(b"hello", b"jello", 1)),
        "length": lambda: gzip.compress(plain + b"more"),
        "start": lambda: gzip.compress(b"x" + plain),
    }[harm]()
    with pytest.raises((ValueError, KeyError)):
        list(warc.read_records(io.BytesIO(bad)))


def archives(path):
    import pathlib

    return len([p for p in pathlib.Path(path).glob("part-*") if p.stat().st_size])


def test_a_large_page_changes_no_other_file(spark, tmp_path):
    small = [(i, f"u{i}", f"page {i}", "") for i in range(200)]
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA).coalesce(1)
    counts = []
    for rows in (small, [*small, (900, "large", "z" * (32 << 20), "")]):
        path = str(tmp_path / str(len(rows)))
        warc.write_archives(frame(rows), path)
        counts.append(archives(path))
        assert sorted((r["page_id"], r["payload_bytes"]) for r in warc.read_archives(spark, path).collect()) == sorted((r[0], len(r[2])) for r in rows)
    assert counts == [1, 2]


def test_payloads_that_do_not_repeat_are_not_shuffled(spark, tmp_path):
    draw = random.Random(1)
    rows = [(i, "u", "".join(draw.choices("abcdefghij <>", k=20_000)), "") for i in range(300)]
    before = shuffled(spark)
    warc.write_archives(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "w"))
    assert shuffled(spark) - before < 0.1 * 300 * 20_000


def shuffled(spark):
    """Bytes of shuffle files that the session holds."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).length() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_"))


def test_large_archives_are_streamed(spark, tmp_path):
    rows = [(i, f"u{i}", f"page {i} " * 500, "") for i in range(60)]
    got, path = round_trip(spark, tmp_path, rows)
    streamed = warc.read_archives(spark, path, whole_bytes=0).collect()
    assert sorted(map(repr, streamed)) == sorted(map(repr, got)) and len(got) == 60


def test_a_long_archive_is_read_in_small_steps():
    """Over 1 GB of payloads, made while they are read; the reader never holds more than a record and a step."""

    class Endless(io.RawIOBase):
        def __init__(self, times):
            self.left, self.rest, self.most = times, b"", 0
            self.member = warc.member(1, "u", b"<p>" + bytes(range(256)) * 65_536, None, False)

        def read(self, size=-1):
            self.most = max(self.most, size)
            while self.left and len(self.rest) < size:
                self.rest, self.left = self.rest + self.member, self.left - 1
            out, self.rest = self.rest[:size], self.rest[size:]
            return out

    source = Endless(64)
    assert sum(r[4] for r in warc.read_records(source)) == 64 * (3 + 256 * 65_536) > 1 << 30
    assert source.most <= 64 << 10

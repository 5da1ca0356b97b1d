"""WARC archives: exact round trips, against hashlib and a plain reader of the format."""

import glob
import hashlib
import random

import pytest

from clicklens.llm import queries, warc
from clicklens.session import scratch_path

from .conftest import SF

SCHEMA = "page_id long, url string, html string"


def expected(rows):
    least = {}
    for i, _, h in rows:
        h = (h or "").encode()
        if i is not None and len(h) >= 100:
            least[h] = min(i, least.get(h, i))
    out = []
    for i, _, h in rows:
        h = (h or "").encode()
        to = least.get(h) if i != least.get(h) else None
        out.append((i, len(h), hashlib.sha256(h).hexdigest(), "revisit" if to is not None else "response", to))
    return sorted(out, key=str)


def through(spark, rows, segment):
    path = scratch_path(spark, "warc")
    warc.write_archive(warc.records(spark.createDataFrame(rows, SCHEMA)), path, segment)
    got = warc.read_records(spark, path).select("page_id", "bytes", "digest", "record_type", "refers_to").collect()
    return path, sorted(map(tuple, got), key=str)


def test_query_against_brute_force(lspark):
    rows = [tuple(r) for r in lspark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    got = queries.QUERIES["op8_warc"](lspark, SF).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)


def hostile():
    rnd = random.Random(2)
    bits = ["\r\n\r\n", "WARC/1.1\r\n", "\r\n", "é", "x", "WARC/1.1", "Content-Length: 3", "\r\n\r\nWARC/1.1\r\n", "\n"]
    rows = [(i, "http://x", "".join(rnd.choice(bits) for _ in range(rnd.randrange(0, 60)))) for i in range(60)]
    rows += [(i + 100, None, rows[i][2]) for i in range(20)]
    return rows + [(200, "a b\nc", None), (None, "u", "n" * 150), (None, "u", "n" * 150), (201, "u", "n" * 150), (202, "u", "n" * 99), (203, "u", "n" * 99), (204, "u", "é" * 70_000), (204, "u", "é" * 70_000)]


@pytest.mark.parametrize("segment", [64 << 10, 1000, 7])
def test_round_trip(lspark, segment):
    rows = [r for r in hostile() if segment > 7 or len(r[2] or "") < 10_000]
    assert through(lspark, rows, segment)[1] == expected(rows)


def test_files_are_warc(lspark):
    """A reader that knows only the standard's framing finds every record and its payload."""
    rows = hostile()
    path, _ = through(lspark, rows, 1000)
    parts, kinds = {}, []
    for name in glob.glob(f"{path.removeprefix('file:')}/part-*"):
        data, at = open(name, "rb").read(), 0
        while at < len(data):
            end = data.index(b"\r\n\r\n", at)
            lines = data[at:end].decode().split("\r\n")
            assert lines[0] == "WARC/1.1"
            head = dict(x.split(": ", 1) for x in lines[1:])
            n = int(head["Content-Length"])
            body = data[end + 4 : end + 4 + n]
            at = end + 4 + n
            assert data[at : at + 4] == b"\r\n\r\n"
            at += 4
            kinds.append(head["WARC-Type"])
            key = head.get("WARC-Segment-Origin-ID", head["WARC-Record-ID"])
            parts.setdefault(key, {})[int(head.get("WARC-Segment-Number", 1))] = (head, body)
    assert {"response", "revisit", "continuation"} == set(kinds)
    payloads = sorted(b"".join(p[i + 1][1] for i in range(len(p))) for p in parts.values() if p[1][0]["WARC-Type"] == "response")
    want = [r for r in expected(rows) if r[3] == "response"]
    assert sorted(hashlib.sha256(p).hexdigest() for p in payloads) == sorted(r[2] for r in want)


def test_chunks_carry_digests(lspark):
    path, _ = through(lspark, [(1, "u", "0123456789" * 10)], 16)
    rows = sorted(warc.digests(warc.read_chunks(lspark, path).filter("segmented")).collect(), key=lambda r: r["chunk_no"])
    data = b"0123456789" * 10
    assert [(r["chunk_end"], r["running"]) for r in rows] == [(min(100, 16 * (i + 1)), hashlib.sha256(data[: 16 * (i + 1)]).hexdigest()) for i in range(7)]
    assert [r["is_last"] for r in rows] == [False] * 6 + [True]


def test_damaged_payload_is_refused(lspark):
    path, _ = through(lspark, [(1, "u", "payload " * 20)], 1000)
    other = scratch_path(lspark, "warc")
    raw = lspark.read.option("lineSep", "\r\n\r\n").text(path)
    raw.selectExpr("replace(value, 'payload', 'PAYLOAD') AS value").coalesce(1).write.option("lineSep", "\r\n\r\n").text(other)
    with pytest.raises(Exception, match="differs from its header"):
        warc.read_records(lspark, other).collect()


def test_empty_and_clashing(lspark):
    assert through(lspark, [], 100)[1] == []
    rows = lspark.createDataFrame([(1, "u", "x" * 200, 5, "d")], f"{SCHEMA}, bytes int, digest string")
    path = scratch_path(lspark, "warc")
    warc.write_archive(warc.records(rows), path)
    assert [r["bytes"] for r in warc.read_records(lspark, path).collect()] == [200]


def test_many_version_strings_in_one_payload(lspark):
    rows = [(1, "u", "".join(f"{i}\r\n\r\nWARC/1.1\r\n" for i in range(20_000)))]
    _, got = through(lspark, rows, 1000)
    assert [tuple(r) for r in got] == expected(rows)

import gzip
import hashlib
import json
import zlib

import pytest

from recfold.llm import warc as A

BIG = "<p>" + "é payload " * 30 + "</p>"
PAGES = [(5, "http://a/x", BIG), (3, "http://a/y z\r\nEvil: 1", BIG), (3, "http://a/again", BIG), (9, None, BIG), (None, "u", BIG),
         (1, "http://s", "small"), (2, "http://s", "small"), (7, "http://n", None), (8, "", ""), (None, "v", "x" * 200), (None, "w", "x" * 200),
         (10, "http://crlf", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" + "b" * 100), (11, "http://long", "0123456789" * 200_000)]


def brute(pages):
    out = []
    for p, u, h in pages:
        b = (h or "").encode()
        ids = [q for q, _, g in pages if (g or "") == (h or "") and q is not None] if len(b) >= 100 else []
        first = min(ids) if ids else None
        refers = first if first is not None and p != first else None
        out.append((p, len(b), hashlib.sha256(b).hexdigest(), "response" if refers is None else "revisit", refers, u))
    return sorted(out, key=str)


def test_round_trip_equals_brute_force(spark):
    df = spark.createDataFrame([(p, u, h, 1) for p, u, h in PAGES], "page_id long, url string, html string, digest int").repartition(3)
    assert sorted((tuple(r) for r in A.round_trip(df).collect()), key=str) == brute(PAGES)


def test_empty(spark):
    assert A.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


@pytest.mark.parametrize("members", [1, 3])
def test_members_and_sidecar(tmp_path, monkeypatch, members):
    monkeypatch.setattr(A, "CHUNK", 37)
    recs = [A.record(i, f"http://x/{i}", b"z" * (i * 100), hashlib.sha256(b"z" * (i * 100)).hexdigest(), None) for i in range(6)]
    cut = [recs[i::members] for i in range(members)]
    p = tmp_path / "a.mono.warc.gz"
    p.write_bytes(b"".join(gzip.compress(b"".join(c)) for c in cut))
    new, entries = A.normalise_file(str(p))
    raw = open(new, "rb").read()
    side = [json.loads(x) for x in open(new.replace(".warc.gz", ".idx"))]
    assert side == entries and sum(e["length"] for e in entries) == len(raw)
    got = [zlib.decompress(raw[e["offset"]:e["offset"] + e["length"]], 31) for e in entries]
    assert got == [r for c in cut for r in c]


def test_cut_off_stream_is_an_error(tmp_path):
    p = tmp_path / "a.mono.warc.gz"
    p.write_bytes(gzip.compress(A.record(1, "u", b"z" * 5000, "0", None))[:-20])
    with pytest.raises(EOFError):
        A.normalise_file(str(p))

"""WARC archives: writing, normalising monolithic gzip files, reading by offset.

``write_monolithic`` writes each partition as one WARC file that is a single
gzip stream, as careless tools do. ``normalise`` inflates such a file once
from front to end, writes every record as its own gzip member and a sidecar
index of offsets beside it. ``read_records`` opens records by their index
entry. Memory is bounded by the read buffer and one record header; blocks
pass through in chunks.

Files go through ``pyarrow.fs`` to the folder that driver and executors share.
Every attempt writes files of its own name and only the paths that a finished
task returns are used, so retries and lost executors leave at most unread files.

Records: ``response`` holds an HTTP header and the payload; ``revisit`` holds
the HTTP header only (its Content-Length is that of the full payload) and
refers to the response of the same payload.

Defined results: a null html is an empty payload; of equal payloads of at
least ``MIN_REVISIT`` bytes the rows with the smallest page_id are responses
(all of them, if that page_id repeats); rows without page_id refer to the
response like others and are responses if no row of the payload has one;
control characters, line breaks and spaces in urls are percent-encoded in the
header and decoded again; extra columns are ignored; an empty table makes no file.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from itertools import chain
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recfold.llm.common import materialize, scratch_path

MIN_REVISIT = 100
CHUNK = 1 << 18
#: Raw payload bytes after which a task starts its next archive.
FILE_BYTES = 64 << 20
DATE = "2000-01-01T00:00:00Z"
_IDS = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the URL namespace


def _fs(path: str):
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return pafs.FileSystem.from_uri(path)


def classify(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, html, digest and the page the row refers to (null for responses)."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    body = F.coalesce("html", F.lit("")).cast("binary")
    rows = rows.withColumn("digest", F.sha2(body, 256))
    first = (rows.filter(F.octet_length(F.coalesce("html", F.lit(""))) >= MIN_REVISIT).groupBy("digest")
             .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first"))
    other = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.join(first, "digest", "left").select("page_id", "url", "html", "digest", other.alias("refers_to"))


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record."""
    def name(page, of_url):
        return f"<urn:uuid:{uuid.uuid5(_IDS, f'{page}/{of_url}/{digest}')}>"

    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    head = {"WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": name(page_id, url),
            "WARC-Date": DATE, "WARC-Payload-Digest": f"sha256:{digest}", "Content-Type": "application/http; msgtype=response"}
    if url is not None:
        head["WARC-Target-URI"] = quote(url, safe="!#$&'()*+,-./:;=?@[]_~|")
    if page_id is not None:
        head["X-Page-ID"] = str(page_id)
    if refers_to is not None:
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        head["X-Refers-To-Page"] = str(refers_to)
    block = http + (payload if refers_to is None else b"")
    head["Content-Length"] = str(len(block))
    return "WARC/1.1\r\n".encode() + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def write_monolithic(rows: DataFrame, folder: str, file_bytes: int = FILE_BYTES, level: int = 1) -> DataFrame:
    """Write ``classify``'s rows as WARC files of one gzip stream; returns their paths."""

    def write(batches):
        fs, root = _fs(folder)
        fs.create_dir(root, recursive=True)
        paths, sink, z, raw = [], None, None, 0

        def close():
            if sink is not None:
                sink.write(z.flush())
                sink.close()

        for b in batches:
            for page, url, html, digest, refers in zip(*(b.column(i) for i in range(5))):
                if sink is None or raw >= file_bytes:
                    close()
                    name = f"{uuid.uuid4().hex}.mono.warc.gz"
                    paths.append(f"{folder}/{name}")
                    sink = fs.open_output_stream(f"{root}/{name}", compression=None)
                    z, raw = zlib.compressobj(level, zlib.DEFLATED, 31), 0
                payload = (html.as_py() or "").encode()
                raw += len(payload)
                sink.write(z.compress(record(page.as_py(), url.as_py(), payload, digest.as_py(), refers.as_py())))
        close()
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string())], names=["path"])

    return rows.select("page_id", "url", "html", "digest", "refers_to").mapInArrow(write, "path string")


class _Inflate:
    """The bytes of a gzip file (one or many members), read once, in order."""

    def __init__(self, source):
        self.source, self.z, self.held, self.ended = source, zlib.decompressobj(31), bytearray(), False

    def _more(self) -> bool:
        if self.z.eof:
            rest = self.z.unused_data or self.source.read(CHUNK)
            if not rest:
                self.ended = True
                return False
            self.z = zlib.decompressobj(31)
            self.held += self.z.decompress(rest, CHUNK)
        else:
            data = self.z.unconsumed_tail or self.source.read(CHUNK)
            if not data:
                raise EOFError("the gzip stream ends early")
            self.held += self.z.decompress(data, CHUNK)
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and with ``mark``; None at the end of the file."""
        seen = 0
        while (at := self.held.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.held)
            if not self._more():
                if self.held:
                    raise EOFError("the file ends inside a record header")
                return None
        return self._take(at + len(mark))

    def chunks(self, n: int):
        while n:
            if not self.held and not self._more():
                raise EOFError("the file ends inside a record")
            part = self._take(min(n, len(self.held)))
            n -= len(part)
            if part:
                yield part

    def _take(self, n: int) -> bytes:
        out = bytes(self.held[:n])
        del self.held[:n]
        return out


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:]) if k}


def normalise_file(path: str, level: int = 4) -> tuple[str, list[dict]]:
    """Rewrite one monolithic file as ``.warc.gz`` with a member per record
    and ``.idx`` (JSON lines: offset, length, id, type, page); returns the new
    path and the entries."""
    fs, at = _fs(path)
    stem = f"{path.removesuffix('.mono.warc.gz')}-{uuid.uuid4().hex[:8]}"
    local = f"{at.removesuffix('.mono.warc.gz')}{stem[-9:]}"
    entries, offset = [], 0
    with fs.open_input_stream(at, compression=None) as source, fs.open_output_stream(f"{local}.warc.gz", compression=None) as sink:
        stream = _Inflate(source)
        while (head := stream.until(b"\r\n\r\n")) is not None:
            fields, z = _headers(head), zlib.compressobj(level, zlib.DEFLATED, 31)
            size = 0
            for part in chain((head,), stream.chunks(int(fields["content-length"]) + 4), (None,)):
                data = z.flush() if part is None else z.compress(part)
                sink.write(data)
                size += len(data)
            page = fields.get("x-page-id")
            entries.append({"offset": offset, "length": size, "id": fields["warc-record-id"], "type": fields["warc-type"],
                            "page": int(page) if page is not None else None})
            offset += size
    with fs.open_output_stream(f"{local}.idx") as side:
        for e in entries:
            side.write((json.dumps(e) + "\n").encode())
    return f"{stem}.warc.gz", entries


def normalise(paths: DataFrame, level: int = 4) -> DataFrame:
    """Normalise every file of ``paths``; returns the offset index."""

    def work(batches):
        for b in batches:
            for p in b.column(0).to_pylist():
                new, entries = normalise_file(p, level)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([new] * len(entries), pa.string()), pa.array([e["offset"] for e in entries], pa.int64()),
                     pa.array([e["length"] for e in entries], pa.int64())], names=["file", "offset", "length"])

    return paths.mapInArrow(work, "file string, offset long, length long")


def read_records(index: DataFrame) -> DataFrame:
    """Open each record by its offset; the digest of a response is computed
    from its payload and must be the one in its header."""

    def read(batches):
        held: tuple[str, object] = ("", None)
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
        for b in batches:
            out: list[list] = [[] for _ in names]
            for path, offset, length in zip(*(c.to_pylist() for c in b.columns)):
                if held[0] != path:
                    if held[1] is not None:
                        held[1].close()
                    fs, at = _fs(path)
                    held = (path, fs.open_input_file(at))
                held[1].seek(offset)
                raw = zlib.decompress(held[1].read(length), 31)
                cut = raw.index(b"\r\n\r\n") + 4
                head = _headers(raw[:cut])
                block = raw[cut:cut + int(head["content-length"])]
                body = block.index(b"\r\n\r\n") + 4
                size = int(_headers(block[:body])["content-length"])
                digest = head["warc-payload-digest"].removeprefix("sha256:")
                if head["warc-type"] == "response" and hashlib.sha256(block[body:]).hexdigest() != digest:
                    raise ValueError(f"{path}: the payload at {offset} does not match its digest")
                page, refers, url = head.get("x-page-id"), head.get("x-refers-to-page"), head.get("warc-target-uri")
                for to, v in zip(out, (page and int(page), size, digest, head["warc-type"], refers and int(refers),
                                       None if url is None else unquote(url))):
                    to.append(v)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], names=names)

    return index.mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, "
                                  "refers_to long, url string")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages as monolithic archives, normalise them, read them back."""
    folder = scratch_path(pages.sparkSession, "warc")
    mono = materialize(write_monolithic(classify(pages), folder), "warc-files")
    index = materialize(normalise(mono), "warc-index")
    return read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")

"""WARC 1.1 archives: one gzip member per record, written and read sequentially.

Writing. The payload of a page is its html in UTF-8 (null: empty). Among pages with
equal payloads the one with the least ``page_id`` becomes a response record and the
others become revisit records that refer to it and repeat only its HTTP headers.
Payloads below ``revisit_from`` bytes are always responses. Rows that repeat a
``page_id`` with one payload are all responses; a row without ``page_id`` is a
response unless another row has its payload and an id. Each task streams its rows
into archives of its own in a folder that all executors share, under names no other
attempt uses; the returned manifest lists the archives of the successful attempts
only, so a lost executor leaves stray files but no wrong rows.

Reading. Each archive is read front to back with an incremental decompressor: header
lines to the empty line, then exactly ``Content-Length`` bytes of block, then the end
of the record and of its member. Block and payload digests are computed while reading
and held against the headers. What is broken becomes a row with ``problem`` set, and
reading goes on with the next gzip member that begins like a record. Headers may have
any length.

A task holds one record at a time besides a batch of bounded size. Files are opened
with pyarrow's file systems, so the folder may be local, shared or an object store.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import urllib.parse
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir, stored

#: Compressed size at which a task begins another archive.
ARCHIVE_BYTES = 256 << 20
#: Payload bytes a reading task gathers before it hands rows over.
BATCH_BYTES = 4 << 20
CHUNK = 1 << 16
#: Parts that the pages of one payload are dealt to.
SALTS = 32

# Fixed values of the WARC format.
VERSION = b"WARC/1.1"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
MEMBER = b"\x1f\x8b\x08"  # how a gzip member begins
PAGE_URN = "urn:page:"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in headers), b"Content-Length: %d" % len(block)]
    return gzip.compress(b"\r\n".join(lines) + END + block + END, 6, mtime=0)


def page_urn(page_id: str) -> str:
    return f"<{PAGE_URN}{urllib.parse.quote(page_id, safe='')}>"


def opened(path: str):
    """The file system of a path or URI, and the path in it."""
    path = re.sub(r"^file:/(?!/)", "file:///", path).replace("s3a://", "s3://", 1)
    return pafs.FileSystem.from_uri(path)


def with_types(pages: DataFrame, revisit_from: int) -> DataFrame:
    """(page_id, url, html, first): ``first`` is the page a revisit refers to."""
    html = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(html).alias("sha1"))
    several = (
        rows.where(F.octet_length("html") >= revisit_from)
        .groupBy("sha1")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("sha1", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    first = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).cast("string")
    # A payload that most pages have is dealt to many tasks.
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url", F.monotonically_increasing_id()), F.lit(SALTS)).cast("int"))
    return salted.join(several, ["sha1", "salt"], "left").select(F.col("page_id").cast("string"), "url", "html", first.alias("first"))


def write_archives(
    pages: DataFrame, folder: str, revisit_from: int = 0, date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Writes a record per row of ``pages`` (page_id, url, html; other columns are not
    read) and returns the stored manifest: archive, records, bytes."""

    def page(page_id, url, html, first) -> bytes:
        http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d" % len(html) + END
        block = http if first is not None else http + html
        headers = [
            ("WARC-Type", "response" if first is None else "revisit"),
            ("WARC-Record-ID", page_urn(page_id) if page_id is not None else f"<{uuid.uuid4().urn}>"),
            ("WARC-Date", date),
            ("WARC-Target-URI", urllib.parse.quote(url if url is not None else "about:blank", safe=":/?#[]@!$&'()*+,;=%~")),
            ("WARC-Payload-Digest", f"sha1:{base32_sha1(html)}"),
            ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
            ("Content-Type", "application/http; msgtype=response"),
        ]
        if first is not None:
            headers += [("WARC-Profile", IDENTICAL), ("WARC-Refers-To", page_urn(first))]
        return member(headers, block)

    def run(batches):
        info = member(
            [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{uuid.uuid4().urn}>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")],
            b"format: WARC File Format 1.1\r\n",
        )
        system, root = opened(folder)
        stem = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        out, done = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                if out is None:
                    name = f"{stem}-{len(done):05d}.warc.gz"
                    system.create_dir(root, recursive=True)
                    out, records = system.open_output_stream(f"{root}/{name}", compression=None), 0
                    out.write(info)
                out.write(page(*(batch.column(c)[i].as_py() for c in range(4))))
                records += 1
                if out.tell() >= archive_bytes:
                    done.append((f"{folder}/{name}", records, out.tell()))
                    out = out.close()
        if out is not None:
            done.append((f"{folder}/{name}", records, out.tell()))
            out.close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], names=["archive", "records", "bytes"])

    rows = with_types(pages, revisit_from)
    return stored(rows.mapInArrow(run, "archive string, records bigint, bytes bigint"), "warc-manifest")


class Archive:
    """The decompressed bytes of one archive, member by member."""

    def __init__(self, stream):
        self.stream, self.raw, self.plain = stream, b"", b""
        self.inflate, self.taken = None, bytearray()  # the bytes of the member so far

    def begin(self) -> bool:
        """Starts the next member; False at the end of the archive."""
        self.raw = self.raw or self.stream.read(CHUNK)
        self.inflate, self.plain, self.taken = zlib.decompressobj(31), b"", bytearray()
        return bool(self.raw)

    def more(self) -> bool:
        if self.inflate.eof:
            return False
        self.raw = self.raw or self.stream.read(CHUNK)
        part = self.inflate.decompress(self.raw, CHUNK)
        if not part and not self.raw:
            raise ValueError("archive ends within a record")
        self.plain += part
        rest = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
        self.taken += self.raw[: len(self.raw) - len(rest)]
        self.raw = rest
        return True

    def until(self, mark: bytes) -> bytes:
        seen = 0
        while (at := self.plain.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.plain)
            if not self.more():
                raise ValueError("record without the end of its header")
        out, self.plain = self.plain[:at], self.plain[at + len(mark) :]
        return out

    def exactly(self, n: int):
        while n:
            if not self.plain and not self.more():
                raise ValueError("block shorter than its Content-Length")
            part, self.plain = self.plain[:n], self.plain[n:]
            n -= len(part)
            yield part

    def skip(self) -> None:
        """Leaves a broken record: to the end of its member, or where that is broken
        itself, to the next one that begins like a record."""
        try:
            while self.more():
                self.plain = b""
            return
        except (ValueError, zlib.error):
            self.raw = bytes(self.taken[1:]) + self.raw if self.taken else self.raw[1:]
        while True:
            at = self.raw.find(MEMBER)
            if at < 0:
                added = self.stream.read(CHUNK)
                self.raw = self.raw[1 - len(MEMBER) :] + added if added else b""
                if not added:
                    return
                continue
            self.raw = self.raw[at:]
            while len(self.raw) < CHUNK and (added := self.stream.read(CHUNK)):
                self.raw += added
            try:
                if zlib.decompressobj(31).decompress(self.raw, 7) == VERSION[:7]:
                    return
            except zlib.error:
                pass
            self.raw = self.raw[1:]

    def end(self) -> None:
        while len(self.plain) <= len(END) and self.more():
            pass
        if self.plain != END or not self.inflate.eof:
            raise ValueError("record does not end with its member")


def fields(lines: bytes) -> dict[str, str]:
    pairs = (x.split(":", 1) for x in lines.decode("utf-8", "replace").split("\r\n")[1:] if ":" in x)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def records(stream):
    """(headers, http headers, payload, problem) of each record; problem is None for
    a record that is whole and agrees with its digests."""
    archive = Archive(stream)
    while True:
        headers: dict[str, str] = {}
        try:
            if not archive.begin():
                return
            head = archive.until(END)
            if not head.startswith(b"WARC/1."):
                raise ValueError("not a WARC record")
            headers = fields(head)
            if not headers.get("content-length", "").isdigit():
                raise ValueError("record without Content-Length")
            digest, parts = hashlib.sha1(), []
            for part in archive.exactly(int(headers["content-length"])):
                digest.update(part)
                parts.append(part)
            archive.end()
        except (ValueError, zlib.error) as e:
            yield headers, {}, b"", str(e)
            archive.skip()
            continue
        block = b"".join(parts)
        http, payload = {}, block
        if headers.get("content-type", "").startswith("application/http"):
            head, _, payload = block.partition(END)
            http = fields(head)
        found = {"warc-block-digest": base64.b32encode(digest.digest()).decode()}
        if headers.get("warc-type") != "revisit":
            found["warc-payload-digest"] = base32_sha1(payload)
        wrong = [k for k, v in found.items() if k in headers and headers[k] != f"sha1:{v}"]
        yield headers, http, payload, f"{', '.join(wrong)} differs" if wrong else None


READ = (
    "archive string, record_type string, page_id string, refers_to string, target_uri string, "
    "payload binary, payload_bytes bigint, payload_digest string, problem string"
)


def read_archives(manifest: DataFrame) -> DataFrame:
    """A row per record (warcinfo left out) of the archives named in ``manifest``.

    A revisit has no payload; its length and digest are those of the payload it
    refers to, as its headers state them.
    """

    def page_of(urn: str | None) -> str | None:
        urn = (urn or "").strip("<>")
        return urllib.parse.unquote(urn[len(PAGE_URN) :]) if urn.startswith(PAGE_URN) else None

    def row(path, headers, http, payload, problem):
        kind = headers.get("warc-type")
        length = http.get("content-length", "")
        again = kind == "revisit"
        return (
            path, kind, page_of(headers.get("warc-record-id")), page_of(headers.get("warc-refers-to")), headers.get("warc-target-uri"),
            None if again or problem else payload,
            int(length) if again and length.isdigit() else len(payload),
            headers.get("warc-payload-digest", "").removeprefix("sha1:") if again else base32_sha1(payload), problem,
        )

    def run(batches):
        names = [x.split()[0] for x in READ.split(", ")]
        kinds = [pa.binary() if n == "payload" else pa.int64() if n == "payload_bytes" else pa.string() for n in names]
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, name = opened(path)
                rows, held = [], 0
                with system.open_input_stream(name, compression=None) as stream:
                    for headers, http, payload, problem in records(stream):
                        if headers.get("warc-type") != "warcinfo" or problem:
                            rows.append(row(path, headers, http, payload, problem))
                            held += len(payload)
                        if held >= BATCH_BYTES or len(rows) >= 10_000:
                            yield pack(rows)
                            rows, held = [], 0
                if rows:
                    yield pack(rows)

    archives = manifest.select("archive")
    return archives.repartition(max(1, archives.count())).mapInArrow(run, READ)


def archived(spark: SparkSession, pages: DataFrame, revisit_from: int = 0) -> DataFrame:
    """Pages written to archives in the shared folder and read back, with ``page_id``
    and ``refers_to`` in the type of ``pages``."""
    manifest = write_archives(pages, shared_dir(spark, "warc"), revisit_from)
    kind = pages.schema["page_id"].dataType
    read = read_archives(manifest)
    return read.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})

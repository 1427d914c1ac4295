"""WARC archives: written by tasks with one gzip member per record, read back by a sequential reader.

Writing. Records with equal payloads (SHA-256) of at least ``least`` bytes are written
once: the record with the smallest id is a ``response``, the others are ``revisit`` records
that refer to it and hold the HTTP head alone. The smallest id per digest is a
minimum that combines in tasks; digests with over a thousandth of all rows come back to
their rows by a salted key, so that no task gets all copies of one payload. A
task writes its records one after the other into an archive of its own below ``folder`` and
starts another one after ``archive_bytes``. Archive names are drawn by the attempt; the manifest of
finished archives is written by Spark, so an attempt that was lost leaves an unlisted file at most.

Reading. One task per archive reads compressed bytes in pieces of 64 kB and decompresses them
piece by piece, member after member: the version line, the named fields, as many bytes as Content-Length
says, two line ends, and the end of the member. Block and payload digests are computed
on the way and compared with the labelled ones, so memory is bounded by a piece (and by a
payload, if payloads are asked for). A record that breaks a rule is returned with an ``error``; after bytes
that can't be decompressed the reader goes on at the next gzip head.

Archives lie in any store that pyarrow reads by its URI (file, hdfs, s3, gs).

Edge cases: a null payload is empty; a null url has no target; a null id gives the record id
``<urn:page:>`` and never is the response to rows with ids; rows that share the
smallest id and the payload are all responses; other columns are ignored; an empty table gives no archive.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metroflow.llm.frames import join_counted, partitions, written
from metroflow.session import fresh_dir

PIECE, GZIP = 1 << 16, 31
#: Fixed values of the format.
VERSION, PROFILE = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "archive string, records long, bytes long"
RECORDS = ("archive string, offset long, record_type string, record_id string, target_uri string, date string, refers_to string, "
           "payload_bytes long, payload_digest string, error string")


def store(uri: str) -> tuple[fs.FileSystem, str]:
    """The store and path of an archive or folder; plain paths and ``file:/x`` are files."""
    local = re.sub(r"^file:/+", "/", uri)
    return (fs.LocalFileSystem(), local) if local.startswith("/") else fs.FileSystem.from_uri(uri)


# --- writing -------------------------------------------------------------------------


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member."""
    head = "\r\n".join([VERSION, *(f"{k}: {v}" for k, v in fields), f"Content-Length: {len(block)}", "", ""])
    z = zlib.compressobj(6, zlib.DEFLATED, GZIP)
    return z.compress(head.encode()) + z.compress(block) + z.compress(b"\r\n\r\n") + z.flush()


def _sha(data: bytes) -> str:
    return "sha256:" + hashlib.sha256(data).hexdigest()


def _id(key: int | None) -> str:
    return f"<urn:page:{'' if key is None else key}>"


def _uri(url: str) -> str:
    """The url with what would end a field or be invalid there as %XX."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url)


def page_record(key: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """A response record, or a revisit of the record of ``refers_to``."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if refers_to is None else head
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _id(key)), ("WARC-Date", date)]
    fields += [] if url is None else [("WARC-Target-URI", _uri(url))]
    fields += [] if refers_to is None else [("WARC-Profile", PROFILE), ("WARC-Refers-To", _id(refers_to))]
    fields += [("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Block-Digest", _sha(block)), ("Content-Type", "application/http; msgtype=response")]
    return _record(fields, block)


def _info(date: str) -> bytes:
    block = b"software: metroflow\r\nformat: WARC File Format 1.1\r\n"
    return _record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date),
                    ("WARC-Block-Digest", _sha(block)), ("Content-Type", "application/warc-fields")], block)


def _first_of_equal(rows: DataFrame, least: int) -> DataFrame:
    """``rows`` (id, ..., n_bytes, digest) with ``refers_to``: the smallest id of the same payload, null for the response itself."""
    low = rows.where(F.col("n_bytes") >= least).groupBy("digest").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n")).where("n > 1")
    both = join_counted(rows, low, ["digest"])
    later = F.col("low").isNotNull() & ~F.col("id").eqNullSafe(F.col("low")) & (F.col("n_bytes") >= least)
    return both.withColumn("refers_to", F.when(later, F.col("low"))).drop("low", "n")


def write(df: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
          least: int = 100, archive_bytes: int = 1 << 28, date: str | None = None) -> DataFrame:
    """Write a record per row; the manifest of the archives: ``archive, records, bytes`` (see the module's notes)."""
    spark = df.sparkSession
    folder = folder or fresh_dir(spark, "warc")
    date = date or datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    payload = F.coalesce(F.col(payload_col).cast("string").cast("binary"), F.lit(b""))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"n_bytes": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)})

    def run(batches):
        where, base = store(folder)
        out, name, records, size = None, "", 0, 0
        for b in batches:
            for key, url, page, digest, refers_to in zip(*(b.column(c).to_pylist() for c in ("id", "url", "payload", "digest", "refers_to"))):
                if out is None:
                    where.create_dir(base, recursive=True)
                    name, records = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = where.open_output_stream(f"{base}/{name}", compression=None)
                    first = _info(date)
                    out.write(first)
                    size = len(first)
                member = page_record(key, url, page, digest, refers_to, date)
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= archive_bytes:
                    out.close()
                    yield _batch(MANIFEST, [(f"{folder}/{name}", records, size)])
                    out = None
        if out is not None:
            out.close()
            yield _batch(MANIFEST, [(f"{folder}/{name}", records, size)])

    return written(_first_of_equal(rows, least).select("id", "url", "payload", "digest", "refers_to").mapInArrow(run, MANIFEST), "warc-manifest")


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(zip(*rows), fields)], [n for n, _ in fields])


# --- reading -------------------------------------------------------------------------


class Broken(ValueError):
    """A record that breaks a rule of the format."""


class Raw:
    """Compressed bytes of an archive, a piece at a time, with the place of the next one."""

    def __init__(self, stream):
        self.stream, self.left, self.at = stream, b"", 0

    def piece(self) -> bytes:
        got, self.left = self.left or self.stream.read(PIECE), b""
        self.at += len(got)
        return got

    def back(self, rest: bytes) -> None:
        self.left, self.at = rest + self.left, self.at - len(rest)

    def skip_to_head(self) -> bool:
        """Go on at the next gzip head, if there is one."""
        seen = b""
        while True:
            got = self.piece()
            if not got:
                return False
            seen += got
            k = seen.find(b"\x1f\x8b\x08")
            if k >= 0:
                self.back(seen[k:])
                return True
            seen = seen[-2:]


class Member:
    """The data of one gzip member, decompressed as it is read."""

    def __init__(self, raw: Raw):
        self.raw, self.z, self.data, self.done = raw, zlib.decompressobj(GZIP), b"", False

    def _more(self) -> bool:
        if self.done:
            return False
        got = self.z.unconsumed_tail or self.raw.piece()
        if not got:
            raise Broken("truncated member")
        try:
            self.data += self.z.decompress(got, PIECE)
        except zlib.error as e:
            self.raw.back(got[1:])  # the reader looks for the next head behind this one
            raise Broken(f"gzip: {e}") from None
        if self.z.eof:
            self.done = True
            self.raw.back(self.z.unused_data)
        return True

    def read(self, n: int) -> bytes:
        """At most ``n`` bytes, none at the end of the member."""
        while not self.data and self._more():
            pass
        got, self.data = self.data[:n], self.data[n:]
        return got

    def line(self, limit: int) -> bytes:
        """Up to the next line end, without it."""
        while b"\r\n" not in self.data:
            if len(self.data) > limit:
                raise Broken("a line too long")
            if not self._more():
                raise Broken("an unfinished line")
        got, _, self.data = self.data.partition(b"\r\n")
        return got

    def exactly(self, n: int) -> Iterator[bytes]:
        while n:
            got = self.read(min(n, PIECE))
            if not got:
                raise Broken("a block shorter than its Content-Length")
            n -= len(got)
            yield got


def _fields(member, limit: int) -> dict[str, str]:
    """Named fields up to an empty line, names in lower case; a line that starts with a blank goes on with the one before."""
    out, last = {}, None
    while line := member.line(limit):
        text = line.decode("utf-8", "replace")
        if text[0] in " \t" and last:
            out[last] += " " + text.strip()
            continue
        name, colon, value = text.partition(":")
        if not colon:
            raise Broken("a field without a colon")
        last = name.strip().lower()
        out[last] = value.strip()
    return out


def _length(fields: dict[str, str]) -> int:
    if not re.fullmatch(r"[0-9]+", fields.get("content-length", "")):
        raise Broken("no Content-Length")
    return int(fields["content-length"])


class Digest:
    """A running digest by a labelled value such as ``sha256:...`` in hexadecimal or base 32."""

    def __init__(self, label: str | None):
        name, _, self.value = (label or "").partition(":")
        self.known = name.lower().replace("-", "") in ("md5", "sha1", "sha256", "sha512")
        self.hash = hashlib.new(name.lower().replace("-", "")) if self.known else None

    def update(self, data: bytes) -> None:
        if self.known:
            self.hash.update(data)

    def holds(self) -> bool:
        if not self.known:
            return True
        want = self.value.strip()
        return want.lower() == self.hash.hexdigest() or want.rstrip("=").upper() == base64.b32encode(self.hash.digest()).decode().rstrip("=")


class _Block:
    """A block's bytes as a member of their own, so that an HTTP head in it is read by the same code."""

    def __init__(self, chunks: Iterator[bytes], digest: Digest):
        self.chunks, self.digest, self.data = chunks, digest, b""

    def line(self, limit: int) -> bytes:
        while b"\r\n" not in self.data:
            got = next(self.chunks, None)
            if got is None or len(self.data) > limit:
                raise Broken("an unfinished HTTP head")
            self.digest.update(got)
            self.data += got
        got, _, self.data = self.data.partition(b"\r\n")
        return got

    def rest(self) -> Iterator[bytes]:
        yield self.data
        self.data = b""
        for got in self.chunks:
            self.digest.update(got)
            yield got


def _one(member: Member, with_payload: bool, limit: int) -> dict:
    """The record in a member; a broken rule comes back as ``error`` beside what was read before it."""
    out: dict = {}
    try:
        version = member.line(limit)
        if not re.fullmatch(rb"WARC/[0-9]+\.[0-9]+", version):
            raise Broken("no WARC version line")
        f = _fields(member, limit)
        out.update(record_type=f.get("warc-type"), record_id=f.get("warc-record-id"), target_uri=f.get("warc-target-uri"),
                   date=f.get("warc-date"), refers_to=f.get("warc-refers-to"))
        labelled = f.get("warc-payload-digest")
        block_digest, payload_digest, sha = Digest(f.get("warc-block-digest")), Digest(labelled), hashlib.sha256()
        block = _Block(member.exactly(_length(f)), block_digest)
        http = {}
        if f.get("content-type", "").startswith("application/http") and out["record_type"] in ("response", "revisit"):
            block.line(limit)
            http = _fields(block, limit)
        size, kept = 0, []
        for got in block.rest():
            size += len(got)
            payload_digest.update(got)
            sha.update(got)
            if with_payload:
                kept.append(got)
        if member.line(limit) or member.line(limit) or member.read(1):
            raise Broken("a record doesn't end where its member does")
        if not block_digest.holds():
            raise Broken("block digest")
        if out["record_type"] == "revisit":  # the payload is elsewhere: its size and digest are told by the heads
            name, _, value = (labelled or "").partition(":")
            out.update(payload_bytes=_length(http) if http else None, payload_digest=value if name == "sha256" else None)
            if size:
                raise Broken("a revisit with a payload")
        else:
            out.update(payload_bytes=size, payload_digest=sha.hexdigest(), payload=b"".join(kept) if with_payload else None)
            if http and "content-length" in http and _length(http) != size:
                raise Broken("HTTP Content-Length")
            if not payload_digest.holds():
                raise Broken("payload digest")
    except Broken as e:
        out["error"] = str(e)
    return out


def read_archive(stream, with_payload: bool = False, limit: int = 1 << 20) -> Iterator[dict]:
    """The records of an archive in order, each with the ``offset`` of its member. ``limit`` bounds a line of a head."""
    raw = Raw(stream)
    while True:
        got = raw.piece()
        if not got:
            return
        raw.back(got)
        offset, member = raw.at, Member(raw)
        row = _one(member, with_payload, limit)
        yield {"offset": offset, **row}
        try:
            while member.read(PIECE):  # what a broken record left of its member
                pass
        except Broken as e:
            if e.args[0].startswith("truncated") or not raw.skip_to_head():
                return


def read(manifest: DataFrame, path_col: str = "archive", with_payload: bool = False) -> DataFrame:
    """The records of all archives that ``manifest`` names, ``warcinfo`` included; ``with_payload`` adds ``payload``."""
    schema = RECORDS + (", payload binary" if with_payload else "")
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        for b in batches:
            for path in b.column(0).to_pylist():
                where, name = store(path)
                with where.open_input_stream(name, compression=None) as stream:
                    rows, size = [], 0
                    for r in read_archive(stream, with_payload):
                        r["archive"] = path
                        rows.append(tuple(r.get(c) for c in names))
                        size += 500 + len(r.get("payload") or b"")
                        if size > 1 << 23:
                            yield _batch(schema, rows)
                            rows, size = [], 0
                    if rows:
                        yield _batch(schema, rows)

    paths = manifest.select(F.col(path_col).cast("string").alias("archive"))
    return paths.repartition(partitions(manifest.sparkSession), "archive").mapInArrow(run, schema)


def archives(spark: SparkSession, folder: str) -> DataFrame:
    """A manifest (``archive, bytes``) of the ``.warc.gz`` files that Spark finds below a folder."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.warc.gz").load(folder)
    return found.select(F.col("path").alias("archive"), F.col("length").alias("bytes"))


def unmatched_revisits(records: DataFrame) -> DataFrame:
    """(refers_to, n) of revisits whose response isn't there or has another digest or size. Revisits are counted per response before the join."""
    asked = records.where("record_type = 'revisit'").groupBy("refers_to", "payload_digest", "payload_bytes").agg(F.count(F.lit(1)).alias("n"))
    there = records.where("record_type = 'response' and error is null").select(F.col("record_id").alias("refers_to"), "payload_digest", "payload_bytes").distinct()
    return asked.join(there, ["refers_to", "payload_digest", "payload_bytes"], "left_anti").select("refers_to", "n")


def key_of(record_id: str) -> Column:
    """The id that a record id column names, null if none."""
    return F.nullif(F.regexp_extract(record_id, "^<urn:page:(-?[0-9]*)>$", 1), F.lit("")).cast("long")

"""Web archives: pages written as WARC records with revisits for repeated payloads, and a reader that survives damage.

Every Spark partition writes its own archives, one gzip member per record, into a shared folder. The reader checks each record
(member, version line, length, end, digests). After a failed check it looks for the next valid member or version line, goes on
from there, and reports the bytes in between as a gap.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landledger.llm.common import as_bytes, materialize, parts_for

CHUNK = 1 << 20
# A field or block of more bytes counts as damage. No cell of a table is as long, so nothing that ``write`` makes is lost.
MOST = 1 << 31
# Names and values that the format fixes.
VERSION = b"WARC/1.1"
MAGIC = b"\x1f\x8b\x08"
END = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORDS = (
    "path string, start long, record_type string, record_id string, refers_to string, uri string, payload_digest string, "
    "payload_bytes long, payload binary, gap_end long, inner_start long, reason string"
)
WRITTEN = "path string, records long, bytes long"


def classified(pages: DataFrame, least_bytes: int = 100, id_column: str = "page_id", body_column: str = "html", uri_column: str = "url") -> DataFrame:
    """(page_id, url, html, digest, first): ``first`` is the smallest id with the same payload where this page revisits it, else null.

    Only digests that occur twice meet the pages again, in a join that Spark broadcasts while that table is small; the payloads
    are grouped by digest alone. Null payloads are empty. Rows that repeat the smallest id are responses too; a null id never
    is the smallest, and revisits whatever other page has its payload.
    """
    rows = pages.select(
        F.col(id_column).cast("long").alias("page_id"), F.col(uri_column).cast("string").alias("url"),
        F.coalesce(F.col(body_column).cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    repeated = materialize(
        rows.where(F.octet_length("html") >= least_bytes).groupBy("digest")
        .agg(F.min("page_id").alias("smallest"), F.count("*").alias("n")).where("n > 1 and smallest is not null").drop("n"),
        "warc-repeats",
    )
    joined = rows.join(repeated, "digest", "left")
    return joined.withColumn("first", F.expr("case when page_id is null or page_id > smallest then smallest end")).drop("smallest")


def record(page_id: int | None, uri: str | None, payload: bytes, digest: str, first: int | None, date: str) -> bytes:
    """One WARC record: a response, or with ``first`` a revisit that keeps the HTTP head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if first is not None else head + payload
    fields = [
        ("WARC-Type", "response" if first is None else "revisit"), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", date),
    ]
    if uri is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", uri)))
    if first is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{first}>")]
    fields += [
        ("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
    ]
    return VERSION + b"\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields).encode() + b"\r\n" + block + END


def opened(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path) if ":" in path else f"file://{path}")


def write(pages: DataFrame, folder: str, roll_bytes: int = 64 << 20, date: str = "2024-01-01T00:00:00Z", compress: bool = True, least_bytes: int = 100) -> DataFrame:
    """Write all pages under ``folder`` and return (path, records, bytes) per archive.

    An archive is written under a name of its attempt and renamed when complete, so a repeated task leaves no second copy.
    No archive outgrows ``roll_bytes`` by more than one record. No pages, no archives.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        files, root = opened(folder)
        files.create_dir(root)
        state = {"out": None, "n": 0, "records": 0, "bytes": 0}

        def close() -> pa.RecordBatch:
            state["out"].close()
            name = f"{root}/part-{context.partitionId():06d}-{state['n']:04d}.warc{'.gz' if compress else ''}"
            files.move(state["temporary"], name)
            done = pa.RecordBatch.from_pylist(
                [{"path": f"{folder.rstrip('/')}/{name.rsplit('/', 1)[1]}", "records": state["records"], "bytes": state["bytes"]}],
                schema=pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]),
            )
            state.update(out=None, n=state["n"] + 1, records=0, bytes=0)
            return done

        for batch in batches:
            ids, uris, digests, firsts = (batch.column(i).to_pylist() for i in (0, 1, 3, 4))
            for row, payload in enumerate(as_bytes(batch.column(2))):
                data = record(ids[row], uris[row], payload, digests[row], firsts[row], date)
                if compress:
                    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                    data = packer.compress(data) + packer.flush()
                if state["out"] is None:
                    state["temporary"] = f"{root}/_attempt-{context.taskAttemptId()}-{state['n']}"
                    state["out"] = files.open_output_stream(state["temporary"])
                state["out"].write(data)
                state["records"] += 1
                state["bytes"] += len(data)
                if state["bytes"] >= roll_bytes:
                    yield close()
        if state["out"] is not None:
            yield close()

    chosen = classified(pages, least_bytes).select("page_id", "url", "html", "digest", "first")
    return materialize(chosen.mapInArrow(run, WRITTEN), "warc-written")


class Damage(Exception):
    """A failed check."""


@dataclass
class Plain:
    """Bytes of a file from ``start`` on, read as they are needed."""

    file: object
    start: int
    ahead: bytearray = field(default_factory=bytearray)
    used: int = 0
    at_end: bool = False

    def __post_init__(self):
        self.file.seek(self.start)

    def more(self) -> bool:
        data = self.file.read(CHUNK)
        self.ahead += data
        return bool(data)

    def need(self, n: int) -> bool:
        while len(self.ahead) < n and not self.at_end:
            self.at_end = not self.more()
        return len(self.ahead) >= n

    def take(self, n: int) -> bytes:
        data = bytes(self.ahead[:n])
        del self.ahead[:n]
        self.used += n
        return data


@dataclass
class Member(Plain):
    """The same for what a gzip member holds; ``end`` is the file offset behind it once all of it was read."""

    end: int = 0

    def __post_init__(self):
        super().__post_init__()
        self.unpack = zlib.decompressobj(31)
        self.rest = b""
        self.read = self.start

    def more(self) -> bool:
        if self.unpack.eof:
            return False
        if not self.rest:
            self.rest = self.file.read(CHUNK // 16)
            self.read += len(self.rest)
            if not self.rest:
                raise Damage("the file ends inside a member")
        try:
            self.ahead += self.unpack.decompress(self.rest, CHUNK)
        except zlib.error as error:
            raise Damage(f"bad member: {error}") from None
        self.rest = self.unpack.unconsumed_tail
        if self.unpack.eof:
            self.end = self.read - len(self.unpack.unused_data) - len(self.rest)
        return True


def parsed(source: Plain, most: int) -> tuple[dict[str, str], bytes]:
    """The next record of ``source``: its fields by lower-case name, and its block. Fields are read line by line, so damage among
    them shows at its own line; a long field is no damage.
    """
    if not source.need(8) or not re.match(rb"WARC/\d\.\d\r\n", bytes(source.ahead[:10] if source.need(10) else source.ahead)):
        raise Damage("no version line")
    fields: dict[str, str] = {}
    begin, seen = source.ahead.find(b"\r\n") + 2, 0
    while True:
        while (end := source.ahead.find(b"\r\n", max(begin, seen - 1))) < 0:
            seen = len(source.ahead)
            if seen - begin > most or not source.need(seen + 1):
                raise Damage("no end of the fields")
        if end == begin:
            break
        name, colon, value = bytes(source.ahead[begin:end]).decode("utf-8", "replace").partition(":")
        if not colon:
            raise Damage("a field without a colon")
        fields[name.strip().lower()] = value.strip()
        begin = end + 2
    stop = end - 2
    length = fields.get("content-length", "")
    if not length.isdecimal() or int(length) > most:
        raise Damage("no valid length")
    whole = stop + 4 + int(length)
    if not source.need(whole + 4):
        raise Damage("the record is cut off")
    if source.ahead[whole:whole + 4] != END:
        raise Damage("no end of the record")
    block = bytes(source.ahead[stop + 4:whole])
    kind, _, expected = fields.get("warc-block-digest", "").partition(":")
    if kind.lower() == "sha256" and hashlib.sha256(block).hexdigest() != expected.lower():
        raise Damage("the block digest differs")
    source.take(whole + 4)
    source.need(1)  # reads a member's check sum when this was its last record
    return fields, block


def next_start(file, start: int, size: int) -> int:
    """The next offset from ``start`` on at which a member with a record, or a version line, begins; ``size`` if there is none."""
    while start < size:
        file.seek(start)
        data = file.read(CHUNK)
        for found in re.finditer(rb"\x1f\x8b\x08|WARC/\d\.\d\r\n", data):
            at = start + found.start()
            if found[0][:1] == b"W":
                return at
            try:
                member = Member(file, at)
                if member.need(8) and member.ahead[:5] == b"WARC/":
                    return at
            except Damage:
                pass
        start += max(1, len(data) - 16)  # marks may straddle two chunks
        if len(data) <= 16:
            break
    return size


def salvage(file, size: int, most: int = MOST) -> Iterator[tuple]:
    """("record", start, fields, block) and ("gap", start, end, inner offset or None, reason) of an archive, in file order.

    Plain records and members may alternate. Fields and blocks above ``most`` bytes count as damage. Within a member, records before the
    damage stay good, and later version lines are found again while the member can be unpacked.
    """
    at, lost = 0, None
    while at < size:
        file.seek(at)
        packed = file.read(3) == MAGIC
        source = Member(file, at) if packed else Plain(file, at)
        inner, found = 0, at
        try:
            while source.need(1):
                inner = source.used
                found = at if packed else at + inner
                fields, block = parsed(source, most)
                if lost:
                    yield ("gap", lost[0], found, lost[1], lost[2])
                    lost = None
                yield ("record", found, fields, block)
            at = source.end if packed else size
        except Damage as damage:
            begun = at if packed else at + inner
            lost = lost or (begun, inner if packed and inner else None, str(damage))
            if packed and not str(damage).startswith(("bad member", "the file ends")) and skip_inside(source):
                # The member itself can be read on: look for the next version line inside it.
                for event in rest_of_member(source, at, most):
                    if lost and event[0] == "record":
                        yield ("gap", lost[0], at, lost[1], lost[2])
                        lost = None
                    yield event
                at = source.end or next_start(file, begun + 1, size)
            else:
                at = next_start(file, begun + 1, size)
    if lost:
        yield ("gap", lost[0], size, lost[1], lost[2])


def skip_inside(member: Member) -> bool:
    """Drop bytes of a member up to its next version line; False if there is none or the member breaks."""
    try:
        if member.need(1):
            member.take(1)
        while True:
            found = re.search(rb"WARC/\d\.\d\r\n", member.ahead)
            if found:
                member.take(found.start())
                return True
            if len(member.ahead) > 16:
                member.take(len(member.ahead) - 16)
            if not member.need(len(member.ahead) + 1):
                return False
    except Damage:
        return False


def rest_of_member(member: Member, at: int, most: int) -> Iterator[tuple]:
    try:
        while member.need(1):
            inner = member.used
            try:
                fields, block = parsed(member, most)
                yield ("record", at, fields, block)
            except Damage as damage:
                yield ("gap", at, at, inner, str(damage))
                if not skip_inside(member):
                    return
    except Damage as damage:
        yield ("gap", at, at, member.used, str(damage))


def http_payload(block: bytes) -> tuple[int | None, bytes]:
    """The length that an HTTP head states, and what follows the head."""
    head, _, body = block.partition(END)
    stated = re.search(rb"(?im)^content-length:\s*(\d+)", head)
    return (int(stated[1]) if stated else None), body


def archives(spark: SparkSession, folder: str) -> DataFrame:
    """(path, bytes) of all archives under a folder; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.warc*").load(folder)
    return files.select("path", F.col("length").alias("bytes"))


def read(paths: DataFrame, payloads: bool = True, most: int = MOST, task_bytes: int = 64 << 20) -> DataFrame:
    """One row per record and per gap (``reason`` set) of the archives in ``paths`` (path, bytes).

    A response whose payload does not have its digest is a gap too. ``payload_bytes`` is the full payload's length, also for
    revisits; ``payload`` is null for them and when ``payloads`` is off. One task reads an archive as a stream and holds one
    record at a time. No archives, no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("path", pa.string()), ("start", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()),
            ("refers_to", pa.string()), ("uri", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
            ("payload", pa.binary()), ("gap_end", pa.int64()), ("inner_start", pa.int64()), ("reason", pa.string()),
        ])
        rows, held = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, name = opened(path)
                with files.open_input_file(name) as file:
                    for event in salvage(file, file.size(), most):
                        if event[0] == "gap":
                            rows.append({"path": path, "start": event[1], "gap_end": event[2], "inner_start": event[3], "reason": event[4]})
                            continue
                        _, start, fields, block = event
                        stated, body = http_payload(block)
                        digest = fields.get("warc-payload-digest", "").removeprefix("sha256:")
                        revisit = fields.get("warc-type") == "revisit"
                        if not revisit and digest and hashlib.sha256(body).hexdigest() != digest:
                            rows.append({"path": path, "start": start, "gap_end": start, "reason": "the payload digest differs"})
                            continue
                        rows.append({
                            "path": path, "start": start, "record_type": fields.get("warc-type"), "record_id": fields.get("warc-record-id"),
                            "refers_to": fields.get("warc-refers-to"), "uri": fields.get("warc-target-uri"), "payload_digest": digest or None,
                            "payload_bytes": stated if revisit else len(body), "payload": None if revisit or not payloads else body,
                        })
                        held += len(body) if payloads else 0
                        if len(rows) >= 1000 or held >= 8 * CHUNK:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    total = paths.agg(F.sum("bytes")).head()[0] or 0
    return paths.select("path").repartition(parts_for(total, task_bytes)).mapInArrow(run, RECORDS)


def page_number(column: str) -> Column:
    """The page id in a record id written by ``record``; null where it has none."""
    return F.expr(f"try_cast(regexp_extract({column}, '^<urn:page:(-?[0-9]+)>$', 1) as long)")

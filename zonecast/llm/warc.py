"""Web archives: writing with deduplication and segmentation, reading with reassembly.

Writing: pages with equal payloads are grouped by digest; the one with the
smallest id becomes the response, the others revisit it.  A response block is an
HTTP message in chunked transfer coding; a block longer than one segment is
written as a first record and continuation records.  Reading: whole records are
decoded where they are read; only segments are shuffled, grouped by the origin
record's identifier, put in order, checked against the total length and decoded.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import RollingFiles, batch, open_fs, ready, slices, stored

CRLF = b"\r\n"
_HEX = re.compile(rb"[0-9A-Fa-f]+")
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space

_INDEX = pa.schema([
    ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("record_id", pa.string()),
    ("record_type", pa.string()), ("page_id", pa.int64()),
])
_INDEX_DDL = "file string, offset long, length long, record_id string, record_type string, page_id long"
_PARSED = pa.schema([
    ("origin", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("page_id", pa.int64()),
    ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("digest", pa.string()),
    ("payload_bytes", pa.int64()), ("block", pa.binary()), ("payload", pa.binary()), ("status", pa.string()),
])
_PARSED_DDL = (
    "origin string, segment int, total long, page_id long, url string, record_type string, refers_to long, "
    "digest string, payload_bytes long, block binary, payload binary, status string"
)
_OUT = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload", "status"]
_OUT_DDL = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "payload binary, status string"
)
_OUT_SCHEMA = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("status", pa.string()),
])


class DamagedArchive(ValueError):
    """An archive file that cannot be read as records."""


# --- framing ---------------------------------------------------------------------

def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(payload[i:i + size]), payload[i:i + size]) for i in range(0, len(payload), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes | None:
    """The payload of a chunked body; None if the framing is broken or something follows it."""
    out, at = [], 0
    while True:
        end = body.find(CRLF, at)
        if end < 0:
            return None
        size_field = body[at:end].split(b";")[0].strip()
        if not _HEX.fullmatch(size_field):
            return None
        size = int(size_field, 16)
        at = end + 2
        if size == 0:
            trailer = body[at:]
            # trailer fields may follow; an empty line ends them
            return b"".join(out) if trailer == CRLF or trailer.endswith(CRLF + CRLF) else None
        if body[at + size:at + size + 2] != CRLF:
            return None
        out.append(body[at:at + size])
        at += size + 2


def http_message(payload: bytes, chunk: int) -> bytes:
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    return head + chunked(payload, chunk)


def http_payload(block: bytes) -> bytes | None:
    head, blank, body = block.partition(CRLF + CRLF)
    if not blank:
        return None
    fields = head.lower().split(CRLF)[1:]
    coded = any(f.startswith(b"transfer-encoding:") and f.rpartition(b":")[2].strip() == b"chunked" for f in fields)
    return dechunked(body) if coded else body


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """One record as a gzip member of its own."""
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in fields if v is not None), b"Content-Length: %d" % len(block)]
    squeeze = zlib.compressobj(3, zlib.DEFLATED, 31)
    return squeeze.compress(CRLF.join(lines) + CRLF + CRLF + block + CRLF + CRLF) + squeeze.flush()


def records_of(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and block of one unpacked record."""
    head, blank, rest = data.partition(CRLF + CRLF)
    lines = head.split(CRLF)
    if not blank or not lines[0].startswith(b"WARC/"):
        raise DamagedArchive("not a record")
    fields = {}
    for line in lines[1:]:
        name, _, value = line.decode("utf-8", "replace").partition(":")
        fields[name.strip().lower()] = value.strip()
    length = fields.get("content-length", "")
    size = int(length) if length.isdecimal() else -1
    if size < 0 or len(rest) != size + 4 or rest[size:] != CRLF + CRLF:
        raise DamagedArchive("content length")
    return fields, rest[:size]


_MAGIC = b"\x1f\x8b\x08"


def members(stream, chunk: int = 1 << 20) -> Iterator[tuple[bytes | None, str | None]]:
    """Unpacked gzip members of a file, one at a time: (data, None), or (None, reason) for a
    damaged stretch, after which reading goes on at the next place where a member unpacks.

    The packed bytes of the member at hand are kept, so that a search after damage
    can start right behind the place where the damaged member began.
    """
    held, sound = b"", True
    while True:
        if not held:
            held = stream.read(chunk)
            if not held:
                return
        unpack, out, packed, reason = zlib.decompressobj(31), [], [held], None
        while not unpack.eof:
            if not held:
                held = stream.read(chunk)
                if not held:
                    reason = "cut short"
                    break
                packed.append(held)
            try:
                out.append(unpack.decompress(held))
            except zlib.error:
                reason = "damaged member"
                break
            held = unpack.unused_data
        if reason is None:
            sound = True
            yield b"".join(out), None
            continue
        if sound:  # one row for a damaged stretch, however many places in it are tried
            sound = False
            yield None, reason
        rest = b"".join(packed)
        at = rest.find(_MAGIC, 1)
        while at < 0:
            more = stream.read(chunk)
            if not more:
                return
            rest = rest[-2:] + more  # the mark may lie across two reads
            at = rest.find(_MAGIC)
        held = rest[at:]


# --- writing ---------------------------------------------------------------------

def _clean(value: str | None) -> str | None:
    """A header value on one line."""
    return None if value is None else " ".join(value.split())


def page_records(
    row: int, page_id: int | None, url: str | None, payload: bytes, first: tuple[int, int | None] | None, segment: int, chunk: int,
    space: uuid.UUID = _NAMES,
) -> list[tuple[str, str, bytes]]:
    """(record id, type, bytes) of the records of one page; ``first``: row and id of the response it repeats,
    ``space``: the archive's name space, in which records are named by row and segment."""
    def name(n, k=1):
        return f"<urn:uuid:{uuid.uuid5(space, f'{n}/{k}')}>"

    common = [("WARC-Date", DATE), ("WARC-Target-URI", _clean(url)), ("X-Page-ID", page_id),
              ("WARC-Payload-Digest", f"sha1:{digest(payload)}"), ("X-Payload-Length", len(payload))]
    if first is not None:
        fields = [("WARC-Type", "revisit"), ("WARC-Record-ID", name(row)), *common, ("WARC-Profile", PROFILE),
                  ("WARC-Refers-To", name(first[0])), ("X-Refers-To-Page", first[1])]
        return [(name(row), "revisit", record(fields, b""))]
    block = http_message(payload, chunk)
    parts = [block[i:i + segment] for i in range(0, len(block), segment)]
    out = []
    for k, part in enumerate(parts, 1):
        kind = "response" if k == 1 else "continuation"
        fields = [("WARC-Type", kind), ("WARC-Record-ID", name(row, k)), *(common if k == 1 else [("WARC-Date", DATE)]),
                  ("WARC-Block-Digest", f"sha1:{digest(part)}"), ("Content-Type", "application/http;msgtype=response" if k == 1 else None)]
        if len(parts) > 1:
            fields += [("WARC-Segment-Number", k), ("WARC-Segment-Origin-ID", name(row) if k > 1 else None),
                       ("WARC-Segment-Total-Length", len(block) if k == len(parts) else None)]
        out.append((name(row, k), kind, record(fields, part)))
    return out


def _write(folder: str, segment: int, chunk: int, roll_bytes: int, space: uuid.UUID):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = RollingFiles(folder, ".warc.gz", roll_bytes)
        try:
            for b in slices(batches):
                out: dict[str, list] = {n: [] for n in _INDEX.names}
                columns = [b.column(n).to_pylist() for n in ("row", "page_id", "url", "payload", "first_row", "first_id")]
                for row, page_id, url, payload, first_row, first_id in zip(*columns):
                    first = None if first_row is None or first_row == row else (first_row, first_id)
                    for rid, kind, data in page_records(row, page_id, url, payload, first, segment, chunk, space):
                        file, offset = files.write(data)
                        for n, v in zip(_INDEX.names, (file, offset, len(data), rid, kind, page_id)):
                            out[n].append(v)
                yield batch(_INDEX, out)
        finally:
            files.close()

    return run


def write_archive(
    pages: DataFrame, folder: str, *, segment_bytes: int = 16 << 10, chunk_bytes: int = 4 << 10, min_bytes: int = 0,
    roll_bytes: int = 64 << 20, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
) -> DataFrame:
    """Write ``pages`` to gzip archive files under ``folder``; the index, one row per record.

    Null payload: empty.  Of rows with equal payloads of at least ``min_bytes``
    bytes the one with the smallest id (nulls last, then the first stored row) is
    the response; every other one, also a repeated row, is a revisit.  Null ids
    and urls leave their header out.  Other columns are ignored; an empty table
    writes no record.  Every archive has a name space of its own, chosen here once, so
    record ids differ between archives and stay the same when a task is retried.
    Payloads count as equal by SHA-256: SHA-1, which the format states, has known collisions.
    """
    space = uuid.uuid4()
    spark = pages.sparkSession
    ready(spark)
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = stored(pages.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"), payload.alias("payload"), F.unhex(F.sha2(payload, 256)).alias("sha"),
    ), "warc-pages")
    # minima are pre-aggregated in each task; only digests that repeat go on to the join.  They are
    # stored first, so the planner knows their size: where it is small no payload is shuffled,
    # otherwise the skew-join rule may split the many rows of one payload
    least = F.min(F.struct(F.col("page_id").isNull(), "page_id", "row")).alias("first")
    repeats = stored(
        rows.filter(F.length("payload") >= min_bytes).groupBy("sha").agg(least, F.count("*").alias("n")).filter("n > 1")
        .select("sha", F.col("first.row").alias("first_row"), F.col("first.page_id").alias("first_id")),
        "warc-repeats",
    )
    linked = rows.join(repeats, "sha", "left").select("row", "page_id", "url", "payload", "first_row", "first_id")
    index = linked.mapInArrow(_write(f"{folder}/records", segment_bytes, chunk_bytes, roll_bytes, space), _INDEX_DDL)
    index.write.option("compression", "zstd").parquet(f"{folder}/index")
    return spark.read.schema(_INDEX_DDL).parquet(f"{folder}/index")


# --- reading ---------------------------------------------------------------------

def finished(block: bytes, stated: str | None, length: int | None) -> tuple[bytes | None, str]:
    """Payload and status of a whole response block."""
    payload = http_payload(block)
    if payload is None:
        return None, "transfer framing"
    if stated is not None and stated != digest(payload):
        return None, "payload digest"
    if length is not None and length != len(payload):
        return None, "payload length"
    return payload, "ok"


def _int(value: str | None) -> int | None:
    return None if value is None else int(value)


def _parse(folder: str):
    def row(fields: dict[str, str], block: bytes) -> dict:
        kind = fields.get("warc-type")
        stated = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
        out = dict.fromkeys(_PARSED.names)
        out |= {"origin": fields.get("warc-record-id"), "page_id": _int(fields.get("x-page-id")),
                "url": fields.get("warc-target-uri"), "record_type": kind, "digest": stated,
                "refers_to": _int(fields.get("x-refers-to-page")), "payload_bytes": _int(fields.get("x-payload-length"))}
        part = fields.get("warc-block-digest")
        if part is not None and part != f"sha1:{digest(block)}":
            out["status"] = "block digest"
        if "warc-segment-number" in fields:
            out |= {"segment": int(fields["warc-segment-number"]), "total": _int(fields.get("warc-segment-total-length")),
                    "origin": fields.get("warc-segment-origin-id", out["origin"]), "block": block}
        elif kind == "response" and out["status"] is None:
            out["payload"], out["status"] = finished(block, stated, out["payload_bytes"])
        elif out["status"] is None:
            out["status"] = "ok"
        return out

    def lost(reason: str | None) -> dict:
        return dict.fromkeys(_PARSED.names) | {"status": f"archive: {reason}"}

    def parsed(data: bytes) -> dict:
        try:
            return row(*records_of(data))
        except DamagedArchive as e:
            return lost(str(e))
        except ValueError:  # a number field that is none
            return lost("header")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_fs(f"{folder}/records")
        for b in batches:
            for name in b.column("file").to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for data, damage in members(stream):
                        rows.append(lost(damage) if data is None else parsed(data))
                        held += len(data or b"")
                        if held > 4 << 20:
                            yield batch(_PARSED, {n: [r[n] for r in rows] for n in _PARSED.names})
                            rows, held = [], 0
                if rows:
                    yield batch(_PARSED, {n: [r[n] for r in rows] for n in _PARSED.names})

    return run


def assemble(parts: list[dict], stated: str | None, length: int | None) -> tuple[bytes | None, str]:
    """Payload and status of a response from its segments (segment, total, block, status), in order."""
    numbers = [p["segment"] for p in parts]
    if numbers != list(range(1, len(parts) + 1)):
        return None, "segment numbers"
    if any(p["status"] is not None for p in parts):
        return None, "block digest"
    if parts[-1]["total"] is None:
        return None, "last segment missing"
    block = b"".join(p["block"] for p in parts)
    if len(block) != parts[-1]["total"]:
        return None, "total length"
    return finished(block, stated, length)


def _reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        out = []
        for r in b.to_pylist():
            first = r["parts"][0]
            payload, status = assemble(r["parts"], first["digest"], first["payload_bytes"])
            out.append({"page_id": first["page_id"], "url": first["url"], "payload": payload, "status": status,
                        "payload_bytes": None if payload is None else len(payload), "refers_to": None,
                        "payload_digest": None if payload is None else digest(payload), "record_type": "response"})
        yield batch(_OUT_SCHEMA, {n: [r[n] for r in out] for n in _OUT})


def read_archive(spark: SparkSession, folder: str, *, keep_payload: bool = True) -> DataFrame:
    """One row per page of the archive files that the index names.

    page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload
    (null for revisits), status.  ``status`` is 'ok', or names the check that
    failed (segment numbers, total length, transfer framing, digests); then the
    payload is null, and the other records are still read.  What cannot be read as a
    record at all (a file cut short, a broken gzip member, a wrong length or number in a
    header) gives one row of nulls with a status 'archive: ...' per stretch, and reading goes
    on with the next member; a response that lost a segment there has its own status.  A
    file that the index names and that is not there is an error.  A group is the
    segments of one record, so at most one payload.
    """
    ready(spark)
    files = spark.read.schema(_INDEX_DDL).parquet(f"{folder}/index").select("file").distinct()
    # a task per file: a number that is given is not coalesced at run time, small as these rows are
    parsed = files.repartition(max(1, files.count())).mapInArrow(_parse(folder), _PARSED_DDL)
    parsed = stored(parsed if keep_payload else parsed.drop("payload"), "warc-parsed")
    payload = F.col("payload") if keep_payload else F.lit(None).cast("binary")
    whole = parsed.filter("segment is null").select(
        "page_id", "url", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to",
        payload.alias("payload"), "status",
    )
    segments = parsed.filter("segment is not null").groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct(
            "segment", "total", "status", "page_id", "url", "digest", "payload_bytes", "block"
        ))).alias("parts")
    )
    joined = segments.select("parts").mapInArrow(_reassemble, _OUT_DDL)
    return whole.unionByName(joined if keep_payload else joined.withColumn("payload", payload))


def pages_as_archive(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` to a fresh shared folder and read them back from the files."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    write_archive(pages, folder, **options)
    return read_archive(spark, folder, keep_payload=False)

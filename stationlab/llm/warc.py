"""Web archives: a writer with revisit records and a reader that salvages damaged files.

A record is a gzip member of its own. The reader checks each member and record; where a check fails
it looks for the next valid member, or in plain files for the next version line, goes on there, and
reports the bytes between as a gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationlab.llm.common import Published, opened, stored
from stationlab.session import qualified

MIN_REVISIT = 1000
SPLIT_BYTES = 64 << 20
READ = 1 << 16
MAGIC = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
BATCH_BYTES = 8 << 20

ROWS = (
    "file string, offset long, length long, reason string, record_type string, record_id string,"
    " target_uri string, refers_to string, payload_bytes long, payload_digest string,"
    " payload binary"
)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def record(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool
) -> bytes:
    """A response record, or a revisit that carries the headers of its payload only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += b"Content-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        "WARC-Date: 2000-01-01T00:00:00Z",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
    ]
    if url:
        safe = quote(url, safe=":/?#[]@!$&'()*+,;=%~", errors="replace")
        lines.append(f"WARC-Target-URI: {safe}")
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {record_id(refers_to)}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, html (null: empty), refers_to, revisit.

    Of equal payloads of `min_bytes` or more the largest page_id responds; rows that share it all
    do. Only digests are grouped. A null id is below all others and responds where all are null.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html")).withColumn("digest", F.sha1(html))
    repeated = (
        rows.filter(F.octet_length("html") >= min_bytes)
        .groupBy(F.col("digest").alias("d"))
        .agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 AND largest IS NOT NULL")
    )
    joined = rows.join(repeated, F.col("digest") == F.col("d"), "left")
    revisit = F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest"))
    return joined.select(
        "page_id", "url", "html", F.when(revisit, F.col("largest")).alias("refers_to"),
        revisit.alias("revisit"),
    )


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes one archive per task and returns (file, bytes, records), stored by Spark.

    Only finished files are named there. Repeated rows become records of their own; an empty table
    gives no file."""

    folder = qualified(pages.sparkSession, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size, n = None, 0, 0
        try:
            for batch in batches:
                for i in range(batch.num_rows):
                    row = [batch.column(c)[i].as_py() for c in range(5)]
                    if out is None:
                        out = Published(folder, "pages.warc.gz")
                    member = gzip_member(
                        record(row[0], row[1], row[2].encode("utf-8", "replace"), row[3], row[4])
                    )
                    out.stream.write(member)
                    size, n = size + len(member), n + 1
            if out is not None:
                out.close()
                yield pa.record_batch([[out.name], [size], [n]], names=["file", "bytes", "records"])
        except BaseException:
            if out is not None:
                out.drop()
            raise

    rows = with_revisits(pages)
    return stored(rows.mapInArrow(write, "file string, bytes long, records long"), "archives")


@dataclass
class Found:
    """A record, or with a reason a gap of quarantined bytes."""

    offset: int
    length: int
    reason: str | None = None
    headers: dict[str, str] | None = None
    block: bytes = b""


def parsed(data: bytes, at: int) -> tuple[dict[str, str], bytes, int] | str:
    """(headers, block, end) of the record at a place, or why there is none."""
    if not VERSION.match(data, at):
        return "no version line"
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        # Headers may be of any length, but every whole line has its colon.
        lines = data[at:].split(b"\r\n")[1:-1]
        return "headers have no end" if all(b":" in line for line in lines) else "malformed header"
    headers = {}
    for line in data[at:end].decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            return "malformed header"
        headers[name.strip().lower()] = value.strip()
    size = headers.get("content-length", "")
    if not size.isascii() or not size.isdigit():
        return "no content length"
    begin, stop = end + 4, end + 4 + int(size)
    if data[stop : stop + 4] != b"\r\n\r\n":
        return "block is cut or has another length"
    block = data[begin:stop]
    digest = headers.get("warc-block-digest", "")
    if digest.startswith("sha1:") and digest[5:] != base32_sha1(block):
        return "block digest differs"
    return headers, block, stop + 4


def records_in(data: bytes, offset: int, length: int) -> Iterator[Found]:
    """Records of one whole member; gaps inside it, at version lines, carry the member's place."""
    at = 0
    while at < len(data):
        got = parsed(data, at)
        if isinstance(got, str):
            nxt = VERSION.search(data, at + 1)
            yield Found(offset, length, f"in the member: {got}")
            if nxt is None:
                return
            at = nxt.start()
            continue
        headers, block, at = got
        yield Found(offset, length, None, headers, block)


def member_at(source, offset: int, size: int) -> tuple[bytes, int] | str:
    """(content, end) of the gzip member at a place, or why there is none."""
    unpacker, out, at = zlib.decompressobj(31), [], offset
    while True:
        data = source.read_at(READ, at) if at < size else b""
        if not data:
            return "member is cut off"
        try:
            out.append(unpacker.decompress(data))
        except zlib.error as error:
            return f"member is damaged: {error}"
        at += len(data)
        if unpacker.eof:
            return b"".join(out), at - len(unpacker.unused_data)


def next_member(source, offset: int, size: int) -> int:
    """First place at or after `offset` where a member with a record begins, else the file's end."""
    at = offset
    while at < size:
        data = source.read_at(READ + len(MAGIC) - 1, at)
        hit = data.find(MAGIC)
        while hit >= 0:
            try:
                head = zlib.decompressobj(31).decompress(source.read_at(READ, at + hit), 64)
                if head.startswith(b"WARC/1."):
                    return at + hit
            except zlib.error:
                pass
            hit = data.find(MAGIC, hit + 1)
        at += READ
    return size


def salvage_members(source, begin: int, end: int) -> Iterator[Found]:
    """Records of the members that begin in [begin, end), and the gaps after them.

    A reader of a later range starts at the first valid member of its own, so neighbouring ranges
    neither miss nor repeat a record, and a gap belongs to the range it begins in."""
    size = source.size()
    at = 0 if begin == 0 else next_member(source, begin, size)
    while at < min(end, size):
        got = member_at(source, at, size)
        if isinstance(got, str):
            nxt = next_member(source, at + 1, size)
            yield Found(at, nxt - at, got)
            at = nxt
            continue
        data, after = got
        yield from records_in(data, at, after - at)
        at = after


def salvage_plain(source) -> Iterator[Found]:
    """Records of an archive that is not compressed, read from front to back."""
    size, at, gap, why = source.size(), 0, None, ""
    held, base = b"", 0
    while at < size:
        got, want = "no version line", READ
        while True:
            if len(held) - (at - base) < min(want, size - at):
                held, base = source.read_at(want, at), at
            got = parsed(held, at - base)
            cut = got in ("headers have no end", "block is cut or has another length")
            if not cut or want >= size - at:
                break
            head = held.find(b"\r\n\r\n", at - base)
            length = re.search(rb"(?i)\r\ncontent-length: *(\d{1,12})\r\n", held[at - base : head + 2])
            more = min(want * 2, size - at)
            need = head - (at - base) + 8 + int(length[1]) if head >= 0 and length else more
            if need <= want or need > size - at:
                break
            want = need
        if isinstance(got, str):
            if gap is None:
                gap, why = at, got
            nxt = VERSION.search(held, at - base + 1)
            # Keep the last bytes: a version line may go on in what is read next.
            at = base + nxt.start() if nxt else min(size, max(at + 1, base + len(held) - 9))
            if nxt is None and at >= size - 9:
                at = size
            continue
        if gap is not None:
            yield Found(gap, at - gap, why)
            gap = None
        headers, block, after = got
        yield Found(at, base + after - at, None, headers, block)
        at = base + after
    if gap is not None:
        yield Found(gap, size - gap, why)


def digest_hex(value: str | None) -> str | None:
    """A sha1 digest header, base 32 or hex, as bare lower-case hex."""
    text = (value or "").removeprefix("sha1:")
    if len(text) == 40:
        return text.lower()
    try:
        return base64.b32decode(text).hex() or None
    except ValueError:
        return None


def row_of(file: str, x: Found) -> tuple:
    if x.reason is not None:
        return (file, x.offset, x.length, x.reason, *[None] * 7)
    h = x.headers
    head, split, payload = x.block.partition(b"\r\n\r\n")
    if not h.get("content-type", "").startswith("application/http") or not split:
        head, payload = b"", x.block
    kind = h.get("warc-type")
    size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    if kind == "revisit":
        length = re.search(rb"(?i)\r\ncontent-length: *(\d{1,18})", head)
        size, digest = int(length[1]) if length else None, digest_hex(h.get("warc-payload-digest"))
    return (
        file, x.offset, x.length, None, kind, h.get("warc-record-id"), h.get("warc-target-uri"),
        h.get("warc-refers-to"), size, digest, payload,
    )


def read_archives(
    spark: SparkSession, folder: str, files: DataFrame, split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """Records and gaps of archives: (file, bytes) rows name them within the folder.

    Records have a null reason; a gap has its place, length and reason, all else null. Compressed
    archives are read by as many tasks as ranges, each from the first valid member of its range on;
    a plain one is read by one. A record of any length is held whole; no file gives no rows.
    """
    folder, step = qualified(spark, folder), F.lit(split_bytes)
    ranges = files.select(
        "file",
        F.explode(F.sequence(F.lit(0), F.greatest(F.col("bytes") - 1, F.lit(0)), step)).alias("begin"),
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in ROWS.split(", ")]
        kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        schema = pa.schema([(p.split()[0], kinds[p.split()[1]]) for p in ROWS.split(", ")])
        rows, held = [], 0

        def batch_of() -> pa.RecordBatch:
            return pa.record_batch(
                [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], names=names
            )

        for batch in batches:
            for file, begin in zip(*[batch.column(i).to_pylist() for i in range(2)]):
                fs, path = opened(f"{folder}/{file}")
                with fs.open_input_file(path) as source:
                    packed = source.read_at(3, 0) == MAGIC or next_member(
                        source, 0, min(source.size(), READ)
                    ) < min(source.size(), READ)
                    if packed:
                        found = salvage_members(source, begin, begin + split_bytes)
                    else:
                        found = salvage_plain(source) if begin == 0 else iter(())
                    for x in found:
                        rows.append(row_of(file, x))
                        held += len(x.block)
                        if held > BATCH_BYTES or len(rows) >= 5000:
                            yield batch_of()
                            rows, held = [], 0
        if rows:
            yield batch_of()

    # Few small rows stand for much to read: each range is a task of its own.
    ranges = stored(ranges.withColumn("task", F.row_number().over(Window.orderBy("file", "begin")) - 1), "ranges")
    tasks = max(1, ranges.count())
    return ranges.repartitionById(tasks, F.col("task").cast("int")).select("file", "begin").mapInArrow(read, ROWS)


def page_records(rows: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of what was read."""
    page = lambda c: F.regexp_extract(c, r"^<urn:x-page:(-?\d*)>$", 1)
    return rows.filter("reason IS NULL").select(
        F.nullif(page("record_id"), F.lit("")).cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.nullif(page("refers_to"), F.lit("")).cast("long").alias("refers_to"),
    )

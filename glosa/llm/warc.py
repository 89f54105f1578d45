"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent Zstandard frames of about ``FRAME_BYTES`` raw bytes;
frames are put one after the other into a bundle, whose last, skippable frame is the
seek table (frame sizes before and after decompression).  A record's place is its
bundle, its frame and its offset inside the decompressed frame, so one record is read by
decompressing one frame.

Spark writes and commits the bundles itself, one row per file: the text writer puts the
bytes out as they are and ends a row with ``lineSep``, which is set to the last five
bytes of every seek table.  Bundles therefore reach any file system Spark can write to,
and a lost executor repeats its task without leaving half a bundle behind.

Defined results: null html is an empty payload; a null url gives an empty target; null
ids are kept; of records with equal payloads of at least ``min_payload`` bytes every one
with the smallest id is a response (repeated rows too), the others revisit it, and a null
id comes after all others; an empty table gives an empty archive; other columns are
ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator
from hashlib import sha256
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glosa.llm.tables import quoted
from glosa.session import cut_lineage

FRAME_BYTES = 256 * 1024
BUNDLE_BYTES = 8 * 1024 * 1024
# Fixed values of the seekable format: magic numbers, descriptor without checksums.
SKIPPABLE = 0x184D2A5E
TAIL = b"\x00" + struct.pack("<I", 0x8F92EAB1)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:page:"
#: Extension field of records whose target URI is percent-encoded as a whole.
ESCAPED = "WARC-X-Target-Escaped"
READ_FIELDS = (
    "bundle string, frame int, frame_offset bigint, frame_bytes bigint, record_offset bigint, page_id bigint, "
    "record_type string, url string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary"
)


def with_roles(pages: DataFrame, min_payload: int = 100) -> DataFrame:
    """page_id, url, payload, digest and refers_to (null for responses).

    Only groups with more than one record are kept for the join, and the join is a plain
    one between two stored sides, so that adaptive execution can split a hot payload.
    """
    rows = pages.select(
        quoted("page_id").cast("bigint").alias("page_id"), quoted("url").alias("url"),
        F.encode(F.coalesce(quoted("html"), F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    equal = rows.where(F.octet_length("payload") >= min_payload).groupBy("digest").agg(
        F.min("page_id").alias("first_id"), F.count("*").alias("copies")
    ).where("copies > 1").select("digest", "first_id")
    found = rows.join(cut_lineage(equal), "digest", "left")
    other = F.col("page_id").isNull() | (F.col("page_id") != F.col("first_id"))
    return found.select("page_id", "url", "payload", "digest", F.when(other, F.col("first_id")).alias("refers_to"))


def record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One WARC/1.1 record; a revisit holds the HTTP header only."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    # A header line holds any URL but one with control characters or blanks at its ends.
    escaped = url is not None and (url != url.strip() or any(ord(c) < 32 or ord(c) == 127 for c in url))
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{URN}{'' if page_id is None else page_id}>", f"WARC-Date: {date}",
        f"WARC-Target-URI: {quote(url) if escaped else url or ''}",
        f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{URN}{refers_to}>"]
    if escaped:
        head.append(f"{ESCAPED}: yes")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def bundle_of(frames: list[tuple[bytes, int]]) -> bytes:
    """Frames (compressed bytes, raw length) and their seek table, without the constant ``TAIL``."""
    entries = b"".join(struct.pack("<II", len(data), raw) for data, raw in frames)
    count = struct.pack("<I", len(frames))
    table = struct.pack("<II", SKIPPABLE, len(entries) + len(count) + len(TAIL)) + entries + count
    return b"".join(data for data, _ in frames) + table


def seek_table(bundle: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, raw size) of every frame, read from the end of a bundle."""
    if bundle[-5:] != TAIL:
        raise ValueError("not a seekable bundle")
    (count,) = struct.unpack("<I", bundle[-9:-5])
    at, out = 0, []
    for size, raw in struct.iter_unpack("<II", bundle[-9 - 8 * count : -9]):
        out.append((at, size, raw))
        at += size
    return out


def write_archive(
    pages: DataFrame, path: str, min_payload: int = 100, date: str = "2024-01-01T00:00:00Z", level: int = 3,
) -> None:
    """Write all pages below ``path`` as bundles."""

    def bundles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=level)
        frames: list[tuple[bytes, int]] = []
        held: list[bytes] = []
        raw = size = 0

        def close_frame() -> int:
            nonlocal held, raw
            data = press.compress(b"".join(held))
            frames.append((data, raw))
            held, raw = [], 0
            return len(data)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                one = record(*row, date)
                held.append(one)
                raw += len(one)
                if raw >= FRAME_BYTES:
                    size += close_frame()
                if size >= BUNDLE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([bundle_of(frames)], pa.binary())], ["bundle"])
                    frames, size = [], 0
        if held:
            close_frame()
        if frames:
            yield pa.RecordBatch.from_arrays([pa.array([bundle_of(frames)], pa.binary())], ["bundle"])

    made = with_roles(pages, min_payload).mapInArrow(bundles, "bundle binary")
    made.select(F.col("bundle").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).option(
        "encoding", "ISO-8859-1").option("lineSep", TAIL.decode("latin-1")).text(path)


def parse(bundle: str, frame: int, at: int, size: int, data: bytes) -> Iterator[tuple]:
    """Records of one decompressed frame, in the order of ``READ_FIELDS``."""
    here = 0
    while here < len(data):
        start = here
        end = data.index(b"\r\n\r\n", start)
        head = dict(line.split(": ", 1) for line in data[start:end].decode().split("\r\n")[1:])
        here = end + 4 + int(head["Content-Length"])
        block, here = data[end + 4 : here], here + 4
        http_end = block.index(b"\r\n\r\n")
        payload = block[http_end + 4 :]
        full = int(block[:http_end].split(b"Content-Length: ")[1].split(b"\r\n")[0])
        digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
        if head["WARC-Type"] == "response" and (sha256(payload).hexdigest() != digest or len(payload) != full):
            raise ValueError(f"damaged record in {bundle}, frame {frame}")
        ids = [head[k][len(URN) + 1 : -1] if k in head else "" for k in ("WARC-Record-ID", "WARC-Refers-To")]
        page, refers = (int(x) if x else None for x in ids)
        yield (bundle, frame, at, size, start, page, head["WARC-Type"], unquote(head["WARC-Target-URI"]) if ESCAPED in head else head["WARC-Target-URI"],
               full, digest, refers, payload if head["WARC-Type"] == "response" else None)


_ARROW = pa.schema([
    ("bundle", pa.string()), ("frame", pa.int32()), ("frame_offset", pa.int64()), ("frame_bytes", pa.int64()),
    ("record_offset", pa.int64()), ("page_id", pa.int64()), ("record_type", pa.string()), ("url", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
])


def _rows(rows: list[tuple], payloads: bool) -> pa.RecordBatch:
    columns = list(zip(*rows))
    if not payloads:
        columns[-1] = [None] * len(rows)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def read_archive(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Every record with its place; response payloads are checked against their digests."""

    def records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                data = content.as_py()
                for n, (at, size, raw) in enumerate(seek_table(data)):
                    frame = expand.decompress(data[at : at + size], max_output_size=raw)
                    yield _rows(list(parse(name.as_py(), n, at, size, frame)), payloads)

    return _bundles(spark, path).mapInArrow(records, READ_FIELDS)


def _bundles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def build_index(spark: SparkSession, path: str) -> DataFrame:
    """Record id -> bundle, frame and offset inside the decompressed frame."""
    return read_archive(spark, path, payloads=False).select(
        "page_id", "bundle", "frame", "frame_offset", "frame_bytes", "record_offset")


def lookup(spark: SparkSession, path: str, index: DataFrame, ids: DataFrame) -> DataFrame:
    """Records of the given ids: only the frames that hold one of them are decompressed.

    A revisit is answered with its own record; join on ``refers_to`` for the payload.
    """
    wanted = index.join(ids.select("page_id").distinct(), "page_id", "left_semi").groupBy("bundle", "frame").agg(
        F.collect_set("record_offset").alias("offsets"))
    opened = wanted.join(_bundles(spark, path), F.col("bundle") == F.col("path")).select("bundle", "frame", "offsets", "content")

    def records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            for name, n, offsets, data in zip(*(c.to_pylist() for c in batch.columns)):
                at, size, raw = seek_table(data)[n]
                frame = expand.decompress(data[at : at + size], max_output_size=raw)
                yield _rows([r for r in parse(name, n, at, size, frame) if r[4] in set(offsets)], True)

    return opened.mapInArrow(records, READ_FIELDS)

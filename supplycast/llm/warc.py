"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames that decompress on their own.  The last frame of a bundle is a
skippable one with the seek table (compressed and plain size of every frame), and a separate index maps
each record to its bundle, frame and offset inside the frame, so that one record costs one frame.
Bundles are written by the tasks straight to the shared folder; only those named by the index count,
so what a lost executor left behind is never read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 26
LEVEL = 3
MIN_PAYLOAD = 0

#: fixed values of the seekable format
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
FOOTER_BYTES = 9

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
INDEX = "bundle string, frame int, frame_at long, frame_bytes long, record_at long, record_bytes long"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_name(page: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page!r} {digest}')}>"


def make_record(
    page: str | None, url: str | None, payload: bytes, first: str | None, date: str
) -> bytes:
    """A response, or, where ``first`` names the page with the same payload, a revisit without it."""
    digest = payload_digest(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    headers = [
        ("WARC-Type", "response" if first is None else "revisit"),
        ("WARC-Record-ID", record_name(page, digest)),
        ("WARC-Date", date),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    if page is not None:
        headers.append(("X-Page-ID", quote(page)))
    if first is not None:
        headers += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", record_name(first, digest)),
            ("X-Refers-To-Page", quote(first)),
        ]
    block = http + payload if first is None else http
    headers.append(("Content-Length", str(len(block))))
    head = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes, int, int]]:
    """Headers, payload, offset and length of every record of a plain frame."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no record at offset {at}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        start, size = end + 4, int(headers["Content-Length"])
        block = data[start : start + size]
        yield headers, block[block.index(b"\r\n\r\n") + 4 :], at, start + size + 4 - at
        at = start + size + 4


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """Skippable frame with compressed and plain sizes of the frames before it."""
    entries = b"".join(struct.pack("<II", *s) for s in sizes)
    footer = struct.pack("<IBI", len(sizes), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer


def read_seek_table(source) -> list[tuple[int, int, int]]:
    """``(offset, compressed size, plain size)`` of every frame, read from the end of a bundle."""
    size = source.size()
    source.seek(size - FOOTER_BYTES)
    n, _, magic = struct.unpack("<IBI", source.read(FOOTER_BYTES))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("not a seekable bundle")
    source.seek(size - FOOTER_BYTES - 8 * n)
    table, at = [], 0
    for packed, plain in struct.iter_unpack("<II", source.read(8 * n)):
        table.append((at, packed, plain))
        at += packed
    return table


def _open(uri: str):
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    return system, path


class _Bundle:
    def __init__(self, folder: str, level: int) -> None:
        import zstandard

        self.uri = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        system, path = _open(self.uri)
        system.create_dir(path.rpartition("/")[0])
        self._out = system.open_output_stream(path, compression=None)
        self._zstd = zstandard.ZstdCompressor(level=level)
        self.sizes: list[tuple[int, int]] = []
        self.bytes = 0

    def add(self, frame: bytes) -> tuple[int, int, int]:
        packed = self._zstd.compress(frame)
        place = (len(self.sizes), self.bytes, len(packed))
        self._out.write(packed)
        self.sizes.append((len(packed), len(frame)))
        self.bytes += len(packed)
        return place

    def close(self) -> None:
        self._out.write(seek_table(self.sizes))
        self._out.close()


def with_first(
    pages: DataFrame, *, page_id: str, payload: str, min_payload: int, first: str
) -> DataFrame:
    """``pages`` plus the smallest id that has the same payload, null for that page itself.

    Only payloads that occur more than once meet again with the pages.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    keyed = pages.withColumn("__digest", F.sha1(body)).withColumn("__bytes", F.octet_length(body))
    same = (
        keyed.where(F.col("__bytes") >= min_payload)
        .groupBy("__digest", "__bytes")
        .agg(F.min(page_id).alias(first), F.count(F.lit(1)).alias("__n"))
        .where((F.col("__n") > 1) & F.col(first).isNotNull())
        .drop("__n")
    )
    found = F.when(~F.col(page_id).eqNullSafe(F.col(first)), F.col(first))
    joined = keyed.join(same, ["__digest", "__bytes"], "left")
    return joined.withColumn(first, found).drop("__digest", "__bytes")


def write_archives(
    pages: DataFrame,
    folder: str,
    *,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_payload: int = MIN_PAYLOAD,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
    level: int = LEVEL,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write one record per row of ``pages`` into bundles below ``folder`` and return their index.

    Of equal payloads of at least ``min_payload`` bytes the page with the smallest id is the response,
    the others are revisits of it.  Null payloads are empty ones.  Pages without id are never referred
    to; if only such pages share a payload, all are responses.  Rows that repeat the smallest id are
    responses as well.  A payload longer than a frame makes a frame of its own.

    The index has one row per record, with the page id as text; write it once, since the bundles come
    into being as it is computed.
    """
    first = "first_page"
    rows = with_first(
        pages.select(
            F.col(page_id).alias("page"), F.col(url).alias("url"), F.col(payload).alias("payload")
        ),
        page_id="page",
        payload="payload",
        min_payload=min_payload,
        first=first,
    ).select(
        F.col("page").cast("string"),
        F.col("url").cast("string"),
        F.coalesce(F.col("payload").cast("binary"), F.lit(b"")).alias("payload"),
        F.col(first).cast("string"),
    )

    def write(batches):
        bundle, frame, waiting = None, [], []

        def flush():
            number, at, packed = bundle.add(b"".join(frame))
            out = [(page, bundle.uri, number, at, packed, *place) for page, place in waiting]
            frame.clear()
            waiting.clear()
            return out

        def rows_out(rows):
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
            )

        size = 0
        for batch in batches:
            for page, link, body, refers in zip(*batch.columns, strict=True):
                if bundle is None:
                    bundle = _Bundle(folder, level)
                record = make_record(
                    page.as_py(), link.as_py(), body.as_py(), refers.as_py(), date
                )
                waiting.append((page.as_py(), (size, len(record))))
                frame.append(record)
                size += len(record)
                if size >= frame_bytes:
                    yield rows_out(flush())
                    size = 0
                    if bundle.bytes >= bundle_bytes:
                        bundle.close()
                        bundle = None
        if bundle is not None:
            if frame:
                yield rows_out(flush())
            bundle.close()

    names = [
        "page",
        "bundle",
        "frame",
        "frame_at",
        "frame_bytes",
        "record_at",
        "record_bytes",
    ]
    kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 4]
    return rows.mapInArrow(write, f"page string, {INDEX}")


READ = (
    "page string, record_type string, payload_digest string, payload_bytes long, refers_to string, "
    "target_uri string, payload binary, bundle string, frame int, record_at long"
)


def read_archives(
    index: DataFrame, *, with_payload: bool = True, frames_per_task: int = 64
) -> DataFrame:
    """Read the records of all bundles that ``index`` names, through their seek tables.

    The frames of a bundle are read by different tasks.  Payload length and digest of a response are
    computed from what was read, and a difference from its header is an error; a revisit has those of
    its header and a null payload.
    """
    bundles = index.select("bundle").distinct()

    def frames(batches):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                system, path = _open(uri)
                with system.open_input_file(path) as source:
                    table = read_seek_table(source)
                n = len(table)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([uri] * n, pa.string()),
                        pa.array(range(n), pa.int32()),
                        *(pa.array([f[k] for f in table], pa.int64()) for k in range(3)),
                    ],
                    names=["bundle", "frame", "at", "packed", "plain"],
                )

    listed = bundles.mapInArrow(
        frames, "bundle string, frame int, at long, packed long, plain long"
    ).repartition("bundle", F.floor(F.col("frame") / frames_per_task))

    def read(batches):
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        source, opened = None, None
        for batch in batches:
            for uri, frame, at, packed, plain in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if uri != opened:
                    if source is not None:
                        source.close()
                    system, path = _open(uri)
                    source, opened = system.open_input_file(path), uri
                source.seek(at)
                data = unpack.decompress(source.read(packed), max_output_size=plain)
                yield _read_frame(data, uri, frame, with_payload)
        if source is not None:
            source.close()

    return listed.mapInArrow(read, READ)


def _unquoted(value: str | None) -> str | None:
    from urllib.parse import unquote

    return None if value is None else unquote(value)


def _read_frame(data: bytes, uri: str, frame: int, with_payload: bool) -> pa.RecordBatch:
    out = []
    for headers, body, at, _ in parse_records(data):
        kind = headers["WARC-Type"]
        digest, size = headers["WARC-Payload-Digest"], int(headers["X-Payload-Length"])
        if kind == "response" and (f"sha1:{payload_digest(body)}", len(body)) != (digest, size):
            raise ValueError(f"payload of {headers['WARC-Record-ID']} in {uri} is damaged")
        out.append(
            (
                _unquoted(headers.get("X-Page-ID")),
                kind,
                digest.removeprefix("sha1:"),
                size,
                _unquoted(headers.get("X-Refers-To-Page")),
                headers.get("WARC-Target-URI"),
                body if with_payload and kind == "response" else None,
                uri,
                frame,
                at,
            )
        )
    kinds = [
        *[pa.string()] * 3,
        pa.int64(),
        *[pa.string()] * 2,
        pa.binary(),
        pa.string(),
        pa.int32(),
        pa.int64(),
    ]
    names = [part.split()[0] for part in READ.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names
    )


def read_record(bundle: str, frame_at: int, frame_bytes: int, record_at: int, record_bytes: int):
    """Headers and payload of one record: one seek, one frame."""
    import zstandard

    system, path = _open(bundle)
    with system.open_input_file(path) as source:
        source.seek(frame_at)
        packed = source.read(frame_bytes)
    data = zstandard.ZstdDecompressor().decompress(packed)
    headers, body, _, _ = next(parse_records(data[record_at : record_at + record_bytes]))
    return headers, body

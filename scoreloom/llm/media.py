"""ISO base media files: documents stored as losslessly sampled tracks and read back.

``mux`` writes an ISO BMFF file (ftyp, mdat, moov) whose one track holds uncompressed 24 x 24
frames of one byte a pixel; ``demux`` walks the nested boxes, decodes the sample tables and gives
codec, duration, samples and keyframe byte ranges without decoding payloads.

Cases: null text is empty and gives one frame of padding; repeated rows give equal values;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _shared

SIDE = 24
FRAME = SIDE * SIDE
TIMESCALE = 24
KEY_EVERY = 12
CONTAINERS = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"dinf", b"edts", b"udta", b"moof", b"traf", b"mvex"}
MATRIX = struct.pack(">9i", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


def _box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    if len(body) + 8 >= 1 << 32:
        return struct.pack(">I4sQ", 1, kind, len(body) + 16) + body
    return struct.pack(">I4s", len(body) + 8, kind) + body


def _full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return _box(kind, struct.pack(">I", version << 24 | flags), *parts)


def mux(payload: bytes) -> bytes:
    """A file with ``payload``, a positive multiple of FRAME bytes, as the frames of one track."""
    n = len(payload) // FRAME
    if not n or n * FRAME != len(payload):
        raise ValueError("the payload is no positive multiple of a frame")
    head = _box(b"ftyp", b"isom", struct.pack(">I", 512), b"isom", b"iso2")
    data = _box(b"mdat", payload)
    at = len(head) + len(data) - len(payload)
    entry = _box(b"raw ", bytes(6), struct.pack(">H", 1), bytes(16), struct.pack(">HHIIIH", SIDE, SIDE, 0x480000, 0x480000, 0, 1), bytes(32), struct.pack(">Hh", 8, -1))
    keys = range(1, n + 1, KEY_EVERY)
    place = _full(b"stco", struct.pack(">II", 1, at)) if at < 1 << 32 else _full(b"co64", struct.pack(">IQ", 1, at))
    tables = _box(
        b"stbl",
        _full(b"stsd", struct.pack(">I", 1), entry),
        _full(b"stts", struct.pack(">III", 1, n, 1)),
        _full(b"stss", struct.pack(f">I{len(keys)}I", len(keys), *keys)),
        _full(b"stsc", struct.pack(">IIII", 1, 1, n, 1)),
        _full(b"stsz", struct.pack(">II", FRAME, n)),
        place,
    )
    info = _box(b"minf", _full(b"vmhd", bytes(8), flags=1), _box(b"dinf", _full(b"dref", struct.pack(">I", 1), _full(b"url ", flags=1))), tables)
    media = _box(b"mdia", _full(b"mdhd", struct.pack(">IIIIHH", 0, 0, TIMESCALE, n, 0x55C4, 0)), _full(b"hdlr", bytes(4), b"vide", bytes(12), b"frames\0"), info)
    track = _box(b"trak", _full(b"tkhd", struct.pack(">IIIII", 0, 0, 1, 0, n), bytes(8), struct.pack(">HHHH", 0, 0, 0, 0), MATRIX, struct.pack(">II", SIDE << 16, SIDE << 16), flags=3), media)
    movie = _full(b"mvhd", struct.pack(">IIIIIH", 0, 0, TIMESCALE, n, 0x10000, 0x100), bytes(10), MATRIX, bytes(24), struct.pack(">I", 2))
    return head + data + _box(b"moov", movie, track)


@dataclass
class Track:
    codec: str = ""
    timescale: int = 0
    duration: int = 0
    width: int = 0
    height: int = 0
    sizes: list[int] = field(default_factory=list)
    offsets: list[int] = field(default_factory=list)
    keys: list[int] | None = None

    def key_ranges(self) -> list[tuple[int, int]]:
        """(first byte, bytes) of each keyframe; without a sync table every sample is one."""
        keys = range(1, len(self.sizes) + 1) if self.keys is None else self.keys
        return [(self.offsets[k - 1], self.sizes[k - 1]) for k in keys]


def walk(data: memoryview, start: int = 0, end: int | None = None, path: tuple[bytes, ...] = ()) -> Iterator[tuple[tuple[bytes, ...], int, int]]:
    """Every box as (path, first byte of its body, end), parents before children."""
    end = len(data) if end is None else end
    while start + 8 <= end:
        size, kind = struct.unpack_from(">I4s", data, start)
        body = start + 8
        if size == 1:
            (size,) = struct.unpack_from(">Q", data, body)
            body += 8
        stop = end if size == 0 else start + size
        if stop > end or stop < body:
            raise ValueError(f"box {kind!r} at {start} does not fit its parent")
        here = (*path, kind)
        yield here, body, stop
        if kind in CONTAINERS:
            yield from walk(data, body, stop, here)
        start = stop


def _compact_sizes(view: memoryview, body: int) -> list[int]:
    """The sizes of an stz2 box: fields of 4, 8 or 16 bits."""
    bits, n = struct.unpack_from(">BI", view, body + 7)
    if bits == 4:
        return [x for b in struct.unpack_from(f">{(n + 1) // 2}B", view, body + 12) for x in (b >> 4, b & 15)][:n]
    if bits not in (8, 16):
        raise ValueError(f"sample sizes of {bits} bits")
    return list(struct.unpack_from(f">{n}{'B' if bits == 8 else 'H'}", view, body + 12))


def demux(data: bytes) -> list[Track]:
    """The tracks of a file, from its sample tables."""
    view = memoryview(data)
    found: list[dict[bytes, tuple[int, int]]] = []
    for path, body, end in walk(view):
        if path[-1] in (b"moof", b"mvex"):
            raise ValueError("a fragmented file; its samples are not in the sample tables")
        if path[-1] == b"trak":
            found.append({})
        elif b"trak" in path:
            found[-1][path[-1]] = (body, end)
    tracks = []
    for boxes in found:
        track = Track()
        for needed in ((b"stsd",), (b"stsz", b"stz2"), (b"stco", b"co64"), (b"stsc",)):
            if not any(kind in boxes for kind in needed):
                raise ValueError(f"a track has no {' or '.join(k.decode() for k in needed)} box")
        if b"mdhd" in boxes:
            body, _ = boxes[b"mdhd"]
            track.timescale, track.duration = struct.unpack_from(">IQ", view, body + 20) if view[body] == 1 else struct.unpack_from(">II", view, body + 12)
        body, _ = boxes[b"stsd"]
        track.codec = bytes(view[body + 12 : body + 16]).decode("latin-1")
        track.width, track.height = struct.unpack_from(">HH", view, body + 40)
        if b"stsz" in boxes:
            body, _ = boxes[b"stsz"]
            size, n = struct.unpack_from(">II", view, body + 4)
            track.sizes = [size] * n if size else list(struct.unpack_from(f">{n}I", view, body + 12))
        else:
            body, _ = boxes[b"stz2"]
            track.sizes = _compact_sizes(view, body)
        if b"stss" in boxes:
            body, _ = boxes[b"stss"]
            (k,) = struct.unpack_from(">I", view, body + 4)
            track.keys = list(struct.unpack_from(f">{k}I", view, body + 8))
        body, _ = boxes[kind := b"stco" if b"stco" in boxes else b"co64"]
        (k,) = struct.unpack_from(">I", view, body + 4)
        chunks = struct.unpack_from(f">{k}{'I' if kind == b'stco' else 'Q'}", view, body + 8)
        body, _ = boxes[b"stsc"]
        (k,) = struct.unpack_from(">I", view, body + 4)
        runs = [struct.unpack_from(">III", view, body + 8 + 12 * i) for i in range(k)]
        sample = 0
        for i, (first, per, _) in enumerate(runs):
            last = runs[i + 1][0] if i + 1 < k else len(chunks) + 1
            for chunk in range(first, last):
                at = chunks[chunk - 1]
                for _ in range(per):
                    track.offsets.append(at)
                    at += track.sizes[sample]
                    sample += 1
        if sample != len(track.sizes):
            raise ValueError("the sample tables disagree")
        tracks.append(track)
    return tracks


SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, codec string, duration_ms long, key_ranges array<struct<first:long,bytes:long>>"


def media_columns(docs: DataFrame) -> DataFrame:
    """Each document's stored form, read back: digests, codec, duration and keyframe byte ranges."""

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        import zlib

        import numpy as np

        schema = pa.schema(
            [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()), ("codec", pa.string()), ("duration_ms", pa.int64()), ("key_ranges", pa.list_(pa.struct([("first", pa.int64()), ("bytes", pa.int64())])))]
        )
        for batch in _shared.by_bytes(batches, "text"):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                raw = (text or "").encode()
                media = mux(raw + b"\xff" * ((-len(raw)) % FRAME if raw else FRAME))
                (track,) = demux(media)
                view = memoryview(media)
                back = b"".join(view[a : a + n] for a, n in zip(track.offsets, track.sizes))
                frames = np.frombuffer(back, np.uint8).reshape(-1, FRAME).astype(np.int64)
                feature = f"{track.codec.strip()}:{track.width}x{track.height}:{len(track.sizes)}:{int(frames.sum())}:{int(np.abs(np.diff(frames, axis=0)).sum())}"
                rows.append((
                    doc_id, len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature,
                    track.codec, 1000 * track.duration // track.timescale, [{"first": a, "bytes": n} for a, n in track.key_ranges()],
                ))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(store, SCHEMA)


TRACKS = "array<struct<codec:string,timescale:long,duration:long,width:int,height:int,key_ranges:array<struct<first:long,bytes:long>>>>"


def media_files(files: DataFrame, key: str, media: str) -> DataFrame:
    """``key``, ``media`` (the bytes as they are), ``tracks``, and ``error`` where a file cannot be read; null bytes have neither."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("codec", pa.string()), ("timescale", pa.int64()), ("duration", pa.int64()), ("width", pa.int32()), ("height", pa.int32()), ("key_ranges", pa.list_(pa.struct([("first", pa.int64()), ("bytes", pa.int64())])))]))
        for batch in _shared.by_bytes(batches, media):
            tracks, errors = [], []
            for data in batch.column(media).to_pylist():
                found, error = None, None
                if data is not None:
                    try:
                        found = [
                            {"codec": t.codec, "timescale": t.timescale, "duration": t.duration, "width": t.width, "height": t.height, "key_ranges": [{"first": a, "bytes": n} for a, n in t.key_ranges()]}
                            for t in demux(data)
                        ]
                    except (ValueError, LookupError, struct.error) as e:
                        error = f"{type(e).__name__}: {e}"
                tracks.append(found)
                errors.append(error)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tracks, kind), pa.array(errors, pa.string())], names=[*batch.schema.names, "tracks", "error"])

    own = files.select(key, media)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema)
    return own.mapInArrow(read, f"{kinds}, tracks {TRACKS}, error string")


def op10_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = media_columns(_shared.documents(spark, sf_dir))
    ranges = F.array_join(F.transform("key_ranges", lambda r: F.concat_ws(":", r["first"], r["bytes"])), ",")
    return found.withColumn("key_ranges", ranges)

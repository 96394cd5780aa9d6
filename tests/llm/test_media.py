import hashlib
import zlib

import pytest

from scoreloom.llm import media


def box(kind, *parts):
    body = b"".join(parts)
    return (len(body) + 8).to_bytes(4, "big") + kind + body


def n32(*numbers):
    return b"".join(x.to_bytes(4, "big") for x in numbers)


def expected(payload):
    """The file of ``payload``, its boxes written down from the format's definition, and its keyframe places."""
    n = len(payload) // 576
    head = box(b"ftyp", b"isom", n32(512), b"isom", b"iso2")
    unity = n32(0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)
    entry = box(b"raw ", b"\0" * 6 + b"\0\1" + b"\0" * 16 + b"\0\x18\0\x18" + n32(0x480000, 0x480000, 0) + b"\0\1" + b"\0" * 32 + b"\0\x08\xff\xff")
    keys = list(range(1, n + 1, 12))
    first = len(head) + 8
    tables = box(
        b"stbl", box(b"stsd", n32(0, 1), entry), box(b"stts", n32(0, 1, n, 1)), box(b"stss", n32(0, len(keys), *keys)), box(b"stsc", n32(0, 1, 1, n, 1)),
        box(b"stsz", n32(0, 576, n)), box(b"stco", n32(0, 1, first)),
    )
    info = box(b"minf", box(b"vmhd", n32(1), b"\0" * 8), box(b"dinf", box(b"dref", n32(0, 1), box(b"url ", n32(1)))), tables)
    handler = box(b"hdlr", n32(0, 0) + b"vide" + b"\0" * 12 + b"frames\0")
    media_box = box(b"mdia", box(b"mdhd", n32(0, 0, 0, 24, n) + b"\x55\xc4\0\0"), handler, info)
    track = box(b"trak", box(b"tkhd", n32(3, 0, 0, 1, 0, n) + b"\0" * 16 + unity + n32(24 << 16, 24 << 16)), media_box)
    movie = box(b"mvhd", n32(0, 0, 0, 24, n, 0x10000) + b"\1\0" + b"\0" * 10 + unity + b"\0" * 24 + n32(2))
    return head + box(b"mdat", payload) + box(b"moov", movie, track), [(first + 576 * (k - 1), 576) for k in keys]


@pytest.mark.parametrize("frames", [1, 2, 13, 40])
def test_round_trip(frames):
    payload = bytes(i * 7 % 251 for i in range(frames * media.FRAME))
    data = media.mux(payload)
    (track,) = media.demux(data)
    assert b"".join(data[a : a + n] for a, n in zip(track.offsets, track.sizes)) == payload
    assert (track.codec, track.width, track.height, track.duration) == ("raw ", 24, 24, frames)
    assert [a for a, _ in track.key_ranges()] == track.offsets[:: media.KEY_EVERY]


def test_bad_boxes():
    with pytest.raises(ValueError):
        media.mux(b"short")
    with pytest.raises(ValueError):
        list(media.walk(memoryview(b"\0\0\0\xffmoov")))


def test_rows(small_docs, odd_docs, no_docs):
    assert media.media_columns(no_docs).collect() == []
    for docs in (small_docs, odd_docs):
        rows = media.media_columns(docs).collect()
        texts = docs.select("doc_id", "text").collect()
        assert len(rows) == len(texts)
        by_id = {}
        for doc_id, text in texts:
            by_id.setdefault(doc_id, text)
        for r in rows:
            raw = (by_id[r.doc_id] or "").encode()
            payload = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
            assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
            stored, keys = expected(payload)
            assert (r.media_bytes, r.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest())
            assert [(k.first, k.bytes) for k in r.key_ranges] == keys
            n = len(payload) // 576
            moved = sum(abs(a - b) for a, b in zip(payload[576:], payload))
            assert (r.codec, r.duration_ms, r.feature) == ("raw ", 1000 * n // 24, f"raw:24x24:{n}:{sum(payload)}:{moved}")


def test_files(spark):
    good = media.mux(bytes(media.FRAME * 13))
    files = [(1, good), (2, good + media._box(b"moof")), (3, good[: len(good) - 40]), (4, None), (5, b""), (6, box(b"moov", box(b"trak")))]
    rows = {r.id: r for r in media.media_files(spark.createDataFrame(files, "id long, file binary"), "id", "file").collect()}
    (track,) = rows[1].tracks
    assert [(r.first, r.bytes) for r in track.key_ranges] == media.demux(good)[0].key_ranges() and bytes(rows[1].file) == good and rows[1].error is None
    assert rows[2].tracks is None and "fragmented" in rows[2].error and rows[3].tracks is None and rows[3].error
    assert rows[4].tracks is None and rows[4].error is None and rows[5].tracks == []
    assert rows[6].tracks is None and "stsd" in rows[6].error


def test_compact_sizes():
    for bits, raw in ((4, b"\x12\x30"), (8, b"\1\2\3"), (16, b"\0\1\0\2\0\3")):
        body = bytes(7) + bytes([bits]) + (3).to_bytes(4, "big") + raw
        assert media._compact_sizes(memoryview(body), 0) == [1, 2, 3]


def test_query_keeps_key_ranges(spark):
    (r,) = media.op10_media_columns(spark, "/root/testdata/sf0.001").orderBy("doc_id").limit(1).collect()
    assert all(len(x.split(":")) == 2 for x in r.key_ranges.split(","))

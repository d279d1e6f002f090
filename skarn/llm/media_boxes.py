"""ISO base media files (ISO/IEC 14496-12): write a lossless 8-bit track, walk nested boxes, decode sample tables.

``describe`` stores codec, duration and the byte ranges of key frames of such a file from its boxes alone, whether its
samples are in tables (with sizes as ``stsz`` or the compact ``stz2``) or in movie fragments; payload bytes are never
decoded. ``store`` puts bytes into a file of one raw grey video track, a frame of 24 x 24 samples of
8 bits each 576 bytes, and ``payload`` reads them back through the sample tables.

Defined results: a null or empty text is one frame of padding. A file whose boxes are cut off or contradict each other
has null columns and an ``error``; a file without a track has no codec and duration 0. Repeated rows give repeated
results. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame

from ._common import map_text, ship

FRAME = 576
SIDE = 24
TIMESCALE = 25
PER_CHUNK = 4
KEY_EVERY = 8
#: Boxes that hold boxes (fixed names of the standard).
NESTED = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"dinf", b"edts", b"udta", b"moof", b"traf", b"mvex"}


#: Containers within each other that a file may have.
MOST_DEPTH = 64


def box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    if len(body) + 8 < 1 << 32:
        return struct.pack(">I4s", len(body) + 8, kind) + body
    return struct.pack(">I4sQ", 1, kind, len(body) + 16) + body


def full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return box(kind, struct.pack(">I", version << 24 | flags), *parts)


_MATRIX = struct.pack(">9I", 1 << 16, 0, 0, 0, 1 << 16, 0, 0, 0, 1 << 30)
_FTYP = box(b"ftyp", b"isom", struct.pack(">I", 512), b"isomiso2")


def _table(kind: bytes, rows: np.ndarray) -> bytes:
    return full(kind, struct.pack(">I", len(rows)), rows.astype(">u4").tobytes())


def store(data: bytes) -> bytes:
    """A media file of ``data`` padded with 255 to whole frames."""
    data += b"\xff" * (-len(data) % FRAME or FRAME * (not data))
    n = len(data) // FRAME
    mdat = box(b"mdat", data)
    first = len(_FTYP) + len(mdat) - len(data)
    chunks = np.arange(0, n, PER_CHUNK)
    last = n - chunks[-1]
    per_chunk = [[1, min(PER_CHUNK, n), 1]] if len(chunks) == 1 else [[1, PER_CHUNK, 1]] + ([[len(chunks), last, 1]] if last != PER_CHUNK else [])
    offsets = first + chunks * FRAME
    entry = box(b"raw ", bytes(6), struct.pack(">H", 1), bytes(16), struct.pack(">HHIIIH", SIDE, SIDE, 72 << 16, 72 << 16, 0, 1), bytes(32), struct.pack(">Hh", 8, -1))
    stbl = box(
        b"stbl",
        full(b"stsd", struct.pack(">I", 1), entry),
        _table(b"stts", np.array([[n, 1]])),
        _table(b"stss", np.arange(1, n + 1, KEY_EVERY)),
        _table(b"stsc", np.array(per_chunk)),
        full(b"stsz", struct.pack(">II", FRAME, n)),
        full(b"co64", struct.pack(">I", len(offsets)), offsets.astype(">u8").tobytes()) if offsets[-1] >= 1 << 32 else _table(b"stco", offsets),
    )
    minf = box(b"minf", full(b"vmhd", bytes(8), flags=1), box(b"dinf", full(b"dref", struct.pack(">I", 1), full(b"url ", flags=1))), stbl)
    mdia = box(b"mdia", full(b"mdhd", struct.pack(">IIIIHH", 0, 0, TIMESCALE, n, 0x55C4, 0)), full(b"hdlr", bytes(4), b"vide", bytes(12), b"frames\0"), minf)
    tkhd = full(b"tkhd", struct.pack(">IIIII", 0, 0, 1, 0, n), bytes(16), _MATRIX, struct.pack(">II", SIDE << 16, SIDE << 16), flags=3)
    mvhd = full(b"mvhd", struct.pack(">IIIIIH", 0, 0, TIMESCALE, n, 1 << 16, 1 << 8), bytes(10), _MATRIX, bytes(24), struct.pack(">I", 2))
    return b"".join([_FTYP, mdat, box(b"moov", mvhd, box(b"trak", tkhd, mdia))])


def walk(data):
    """(path, body start, body end) of every box in file order, containers before what they hold."""
    start, open_boxes = 0, [(len(data), ())]
    while open_boxes:
        end, path = open_boxes[-1]
        if start >= end:
            open_boxes.pop()
            continue
        if end - start < 8:
            raise ValueError("a box header is cut off")
        size, kind = struct.unpack_from(">I4s", data, start)
        body = start + 8
        if size == 1:
            if end - start < 16:
                raise ValueError("a long box header is cut off")
            size, body = struct.unpack_from(">Q", data, body)[0], start + 16
        elif size == 0:
            size = end - start
        if kind == b"uuid":
            body += 16
        if size < body - start or start + size > end:
            raise ValueError("a box does not fit its container")
        yield (*path, kind), body, start + size
        if kind in NESTED:
            if len(open_boxes) > MOST_DEPTH:
                raise ValueError("boxes nest too deep")
            open_boxes.append((start + size, (*path, kind)))
            start = body
        else:
            start += size


def tracks(data) -> list[dict]:
    """Each track's codec, timescale, duration and sample tables: offsets, sizes and key flags."""
    found: list[dict] = []
    fragments: list[tuple] = []
    defaults: dict[int, tuple] = {}
    for path, start, end in walk(data):
        kind = path[-1]
        if kind == b"trak":
            found.append({"codec": None, "timescale": 0, "duration": 0, "width": 0, "height": 0, "id": None})
        elif path[:2] == (b"moov", b"trak") and found:
            t = found[-1]
            if kind == b"mdhd":
                t["timescale"], t["duration"] = struct.unpack_from(">IQ" if data[start] else ">II", data, start + (20 if data[start] else 12))
            elif kind == b"tkhd":
                t["id"] = struct.unpack_from(">I", data, start + (20 if data[start] else 12))[0]
                t["width"], t["height"] = (x >> 16 for x in struct.unpack_from(">II", data, end - 8))
            elif kind == b"stsd" and struct.unpack_from(">I", data, start + 4)[0]:
                t["codec"] = bytes(data[start + 12 : start + 16]).decode("latin-1")
            elif kind == b"stsz":
                size, n = struct.unpack_from(">II", data, start + 4)
                if size * n > len(data):
                    raise ValueError("the samples exceed the file")
                t["sizes"] = np.full(n, size, np.int64) if size else _rows(data, start + 12, end, ">u4", n)
            elif kind == b"stz2":
                t["sizes"] = _compact_sizes(data, start, end)
            elif kind in (b"stts", b"stsc"):
                t[kind.decode()] = _rows(data, start + 8, end, ">u4", struct.unpack_from(">I", data, start + 4)[0] * (2 if kind == b"stts" else 3)).reshape(-1, 2 if kind == b"stts" else 3)
            elif kind in (b"stco", b"co64", b"stss"):
                t["stss" if kind == b"stss" else "chunks"] = _rows(data, start + 8, end, ">u8" if kind == b"co64" else ">u4", struct.unpack_from(">I", data, start + 4)[0])
        elif path == (b"moov", b"mvex", b"trex"):
            track, _, *own = struct.unpack_from(">5I", data, start + 4)
            defaults[track] = tuple(own)
        elif path == (b"moof",):
            long = start >= 16 and struct.unpack_from(">I4s", data, start - 16) == (1, b"moof")
            fragments.append((kind, start - (16 if long else 8), end))
        elif path in ((b"moof", b"traf", b"tfhd"), (b"moof", b"traf", b"trun")):
            fragments.append((kind, start, end))
    for t in found:
        _place(t, len(data))
    _fragments(data, found, fragments, defaults)
    return found


def _compact_sizes(data, start: int, end: int) -> np.ndarray:
    bits, n = data[start + 7], struct.unpack_from(">I", data, start + 8)[0]
    if bits == 4:
        both = _rows(data, start + 12, end, ">u1", (n + 1) // 2)
        return np.stack([both >> 4, both & 15], axis=1).ravel()[:n]
    if bits not in (8, 16):
        raise ValueError("compact sizes have 4, 8 or 16 bits")
    return _rows(data, start + 12, end, ">u1" if bits == 8 else ">u2", n)


def _fragments(data, found: list[dict], boxes: list[tuple], defaults: dict[int, tuple]) -> None:
    """Add the samples of movie fragments to their tracks, in file order."""
    of = {t["id"]: t for t in found}
    runs: dict[int, list] = {}
    moof = at = 0
    first, track, own = True, None, (0, 0, 0)
    for kind, start, end in boxes:
        if kind == b"moof":
            moof = at = start
            first, track = True, None
            continue
        flags = struct.unpack_from(">I", data, start)[0] & 0xFFFFFF
        if kind == b"tfhd":
            track, here = struct.unpack_from(">I", data, start + 4)[0], start + 8
            base = moof if first or flags & 0x20000 else at
            if flags & 1:
                base, here = struct.unpack_from(">Q", data, here)[0], here + 8
            here += 4 * bool(flags & 2)
            values = list(defaults.get(track, (0, 0, 0)))  # duration, size and flags of a sample
            for i, bit in enumerate((8, 16, 32)):
                if flags & bit:
                    values[i], here = struct.unpack_from(">I", data, here)[0], here + 4
            if here > end:
                raise ValueError("a fragment's header is cut off")
            own, at, first = tuple(values), base, False
            continue
        if track is None:
            raise ValueError("a run of samples without a header")
        n, here = struct.unpack_from(">I", data, start + 4)[0], start + 8
        if flags & 1:
            at, here = base + struct.unpack_from(">i", data, here)[0], here + 4
        lead = None
        if flags & 4:
            lead, here = struct.unpack_from(">I", data, here)[0], here + 4
        fields = [i for i, bit in enumerate((0x100, 0x200, 0x400, 0x800)) if flags & bit]
        if fields:
            table = _rows(data, here, end, ">u4", n * len(fields)).reshape(n, len(fields))
        elif n > len(data):
            raise ValueError("the samples exceed the file")
        column = lambda i: table[:, fields.index(i)] if i in fields else np.full(n, own[i], np.int64)  # noqa: E731, B023
        sizes, kinds = column(1), column(2).copy()
        if lead is not None and n:
            kinds[0] = lead
        offsets = at + np.cumsum(sizes) - sizes
        at += int(sizes.sum())
        if n and (offsets.min() < 0 or at > len(data)):
            raise ValueError("a sample lies outside the file")
        runs.setdefault(track, []).append((offsets, sizes, kinds & 0x10000 == 0, int(column(0).sum())))
    for track, parts in runs.items():
        if track not in of:
            raise ValueError("a fragment of no track")
        t = of[track]
        t["offsets"], t["sizes"], t["keys"] = (np.concatenate([t[k], *[p[i] for p in parts]]) for i, k in enumerate(("offsets", "sizes", "keys")))
        t["duration"] += sum(p[3] for p in parts)


def _rows(data, start: int, end: int, kind: str, n: int) -> np.ndarray:
    if start + n * np.dtype(kind).itemsize > end:
        raise ValueError("a sample table is cut off")
    return np.frombuffer(data, dtype=kind, count=n, offset=start).astype(np.int64)


def _place(t: dict, length: int) -> None:
    """Byte offset, size and key flag of each sample from the tables."""
    sizes, chunks = t.get("sizes", np.zeros(0, np.int64)), t.get("chunks", np.zeros(0, np.int64))
    runs = t.get("stsc", np.zeros((0, 3), np.int64))
    if len(sizes) and (not len(chunks) or not len(runs)):
        raise ValueError("samples without chunks")
    firsts = np.append(runs[:, 0] - 1, len(chunks))
    if (np.diff(firsts) < 0).any() or (len(runs) and firsts[0] < 0):
        raise ValueError("the runs of chunks are out of order")
    per_chunk = np.repeat(runs[:, 1], np.diff(firsts)) if len(runs) else np.zeros(0, np.int64)
    if per_chunk.sum() != len(sizes):
        raise ValueError("chunks and samples disagree")
    before = np.concatenate([[0], np.cumsum(sizes)])
    lead = np.cumsum(per_chunk) - per_chunk
    t["offsets"] = np.repeat(chunks - before[lead], per_chunk) + before[:-1] if len(sizes) else sizes
    t["sizes"] = sizes
    if len(sizes) and (t["offsets"].min() < 0 or (t["offsets"] + sizes).max() > length):
        raise ValueError("a sample lies outside the file")
    keys = np.zeros(len(sizes), dtype=bool)
    if "stss" in t:
        if len(t["stss"]) and not (1 <= t["stss"].min() and t["stss"].max() <= len(sizes)):
            raise ValueError("a key frame is no sample")
        keys[t["stss"] - 1] = True
    else:
        keys[:] = True  # without the table every sample is a key frame
    t["keys"] = keys


def payload(data, track: dict | None = None) -> bytes:
    """All samples of the first track, in their order."""
    t = track or tracks(data)[0]
    ends = t["offsets"] + t["sizes"]
    breaks = np.flatnonzero(t["offsets"][1:] != ends[:-1]) + 1
    return b"".join(bytes(data[t["offsets"][g[0]] : ends[g[-1]]]) for g in np.split(np.arange(len(ends)), breaks) if len(g))


def feature(t: dict) -> str:
    ranges = ",".join(f"{a}-{a + n}" for a, n in zip(t["offsets"][t["keys"]].tolist(), t["sizes"][t["keys"]].tolist()))
    return f"codec={(t['codec'] or '').strip()};timescale={t['timescale']};duration={t['duration']};samples={len(t['sizes'])};size={t['width']}x{t['height']};keys={ranges}"


def _describe():
    def work(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for key, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                row = {"key": key, "codec": None, "duration_s": None, "samples": None, "keyframes": None, "error": None}
                try:
                    own = tracks(data or b"")
                    t = own[0] if own else {"codec": None, "timescale": 0, "duration": 0, "sizes": [], "offsets": np.zeros(0, np.int64), "keys": np.zeros(0, bool)}
                    sizes = np.asarray(t["sizes"], dtype=np.int64)
                    row |= {"codec": t["codec"], "duration_s": t["duration"] / t["timescale"] if t["timescale"] else 0.0, "samples": len(sizes)}
                    row["keyframes"] = [{"start": a, "end": a + n} for a, n in zip(t["offsets"][t["keys"]].tolist(), sizes[t["keys"]].tolist())]
                except (ValueError, struct.error, IndexError) as e:
                    row["error"] = str(e) or type(e).__name__
                out.append(row)
            kind = batch.schema.field(0).type
            schema = pa.schema([("key", kind), ("codec", pa.string()), ("duration_s", pa.float64()), ("samples", pa.int64()), ("keyframes", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("error", pa.string())])
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return work


def describe(media: DataFrame, id_col: str = "doc_id", data: str = "media") -> DataFrame:
    """(key, codec, duration_s, samples, keyframes, error) of the binary files in ``data``."""
    ship(media.sparkSession)
    kind = media.schema[id_col].dataType.simpleString()
    return media.select(id_col, data).mapInArrow(_describe(), f"key {kind}, codec string, duration_s double, samples bigint, keyframes array<struct<start:bigint,end:bigint>>, error string")


def columns(docs: DataFrame, id_col: str = "doc_id", text: str = "text", with_media: bool = False) -> DataFrame:
    """Each text stored as media and read back: sizes, digests and the feature string; ``with_media`` adds the file."""

    def start():
        def work(flat, offsets, part):
            raw, rows = flat.tobytes(), []
            for d in range(len(offsets) - 1):
                media = store(raw[offsets[d] : offsets[d + 1]])
                track = tracks(media)[0]
                back = payload(media, track)
                rows.append((int(offsets[d + 1] - offsets[d]), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature(track), *([media] if with_media else [])))
            return [list(c) for c in zip(*rows)]

        return work

    fields = "n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string" + ", media binary" * with_media
    return map_text(docs, text, [id_col], fields, start)

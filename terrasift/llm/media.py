"""ISO base media columns: pack payloads into containers, and read codec, duration and keyframe ranges from the boxes.

``pack`` stores a payload losslessly as 8-bit unsigned samples of one sound track. ``inspect`` walks the nested boxes of
any such container and decodes the sample tables (stts, stsc, stsz, stco/co64, stss) and the sample runs of fragments (tfhd, trun, with the
defaults of trex); it never looks into ``mdat``. ``payload`` joins the chunks that these point to.

Results: null text is empty, and still one frame of padding. Equal texts give equal bytes. Bytes that are no container,
or whose boxes run past their parent, give null columns and an ``error``; a fragment without its header or of an unknown track gives an ``error`` beside the rest.
Repeated rows yield repeated results, an empty table none; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

FRAME = 192
RATE = 8000
FRAMES_PER_CHUNK = 16
KEY_EVERY = 25
_MATRIX = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)
_PARENTS = frozenset((b"moov", b"trak", b"mdia", b"minf", b"dinf", b"stbl", b"edts", b"moof", b"traf", b"mvex", b"udta"))


def _box(kind: bytes, *body: bytes) -> bytes:
    data = b"".join(body)
    return struct.pack(">I4s", len(data) + 8, kind) + data


def _full(kind: bytes, *body: bytes, flags: int = 0) -> bytes:
    return _box(kind, struct.pack(">I", flags), *body)


def pad(data: bytes) -> bytes:
    """Spaces up to a positive multiple of the frame size."""
    return data + b" " * (max(FRAME, -(-len(data) // FRAME) * FRAME) - len(data))


def pack(data: bytes) -> bytes:
    """A container of the padded payload: one sound track of 8-bit samples, FRAME bytes to a frame."""
    payload = pad(data)
    n = len(payload) // FRAME
    chunks = -(-n // FRAMES_PER_CHUNK)
    duration = n * FRAME
    keys = range(1, n + 1, KEY_EVERY)
    runs = [(1, FRAMES_PER_CHUNK)] if n % FRAMES_PER_CHUNK == 0 else ([(1, FRAMES_PER_CHUNK)] if chunks > 1 else []) + [(chunks, n % FRAMES_PER_CHUNK)]
    ftyp = _box(b"ftyp", b"isom", struct.pack(">I", 512), b"isomiso2")

    def moov(first: int) -> bytes:
        entry = _box(b"raw ", b"\0" * 6, struct.pack(">H8xHHHHI", 1, 1, 8, 0, 0, RATE << 16))
        offsets = [first + i * FRAMES_PER_CHUNK * FRAME for i in range(chunks)]
        table = (_full(b"stco", struct.pack(f">I{chunks}I", chunks, *offsets)) if offsets[-1] < 1 << 32 else _full(b"co64", struct.pack(f">I{chunks}Q", chunks, *offsets)))
        stbl = _box(
            b"stbl", _full(b"stsd", struct.pack(">I", 1), entry), _full(b"stts", struct.pack(">III", 1, n, FRAME)), _full(b"stss", struct.pack(f">I{len(keys)}I", len(keys), *keys)),
            _full(b"stsc", struct.pack(">I", len(runs)), *[struct.pack(">III", c, k, 1) for c, k in runs]), _full(b"stsz", struct.pack(">II", FRAME, n)), table,
        )
        dinf = _box(b"dinf", _full(b"dref", struct.pack(">I", 1), _full(b"url ", flags=1)))
        minf = _box(b"minf", _full(b"smhd", struct.pack(">HH", 0, 0)), dinf, stbl)
        mdia = _box(b"mdia", _full(b"mdhd", struct.pack(">IIIIHH", 0, 0, RATE, duration, 0x55C4, 0)), _full(b"hdlr", struct.pack(">I4s12x", 0, b"soun"), b"\0"), minf)
        tkhd = _full(b"tkhd", struct.pack(">IIIII8xHHHH", 0, 0, 1, 0, duration, 0, 0, 0x100, 0), _MATRIX, struct.pack(">II", 0, 0), flags=7)
        mvhd = _full(b"mvhd", struct.pack(">IIIIIH10x", 0, 0, RATE, duration, 0x10000, 0x100), _MATRIX, b"\0" * 24, struct.pack(">I", 2))
        return _box(b"moov", mvhd, _box(b"trak", tkhd, mdia))

    wide = len(payload) + 8 >= 1 << 32
    head = struct.pack(">I4sQ", 1, b"mdat", len(payload) + 16) if wide else struct.pack(">I4s", len(payload) + 8, b"mdat")
    first = len(ftyp) + len(moov(1 << 33 if wide else 0)) + len(head)
    return b"".join((ftyp, moov(first), head, payload))


def boxes(data: bytes, start: int = 0, end: int | None = None, path: tuple[bytes, ...] = ()):
    """(path, body start, body end) of every box, parents before children; ValueError where a box doesn't fit."""
    at, end = start, len(data) if end is None else end
    while at < end:
        if at + 8 > end:
            raise ValueError("a box header is cut off")
        size, kind = struct.unpack_from(">I4s", data, at)
        body = at + 8
        if size == 1:
            if at + 16 > end:
                raise ValueError("a box header is cut off")
            (size,), body = struct.unpack_from(">Q", data, body), at + 16
        stop = end if size == 0 else at + size
        if stop < body or stop > end:
            raise ValueError(f"box {kind!r} doesn't fit its parent")
        yield (*path, kind), body, stop
        if kind in _PARENTS:
            yield from boxes(data, body, stop, (*path, kind))
        at = stop


def _table(data: bytes, body: int, end: int, form: str, skip: int = 0) -> list[tuple]:
    (n,) = struct.unpack_from(">I", data, body + 4 + skip)
    size = struct.calcsize(">" + form)
    at = body + 8 + skip
    if at + n * size > end:
        raise ValueError("a sample table is cut off")
    return list(struct.iter_unpack(">" + form, data[at : at + n * size]))


def tracks(data: bytes) -> list[dict[str, Any]]:
    """Per track: codec, handler, timescale, duration, samples as (offset, size), key sample numbers, chunk runs."""
    out: list[dict[str, Any]] = []
    for path, body, end in boxes(data):
        kind = path[-1]
        if kind == b"trak":
            out.append({"id": None, "codec": None, "handler": None, "timescale": None, "duration": None, "deltas": [], "sizes": [], "runs": [], "offsets": [], "keys": None})
        if not out or b"trak" not in path:
            continue
        t = out[-1]
        if kind == b"tkhd":
            (t["id"],) = struct.unpack_from(">I", data, body + (20 if data[body] else 12))
        elif kind == b"mdhd":
            version = data[body]
            t["timescale"], t["duration"] = struct.unpack_from(">IQ" if version else ">II", data, body + (20 if version else 12))
        elif kind == b"hdlr":
            t["handler"] = data[body + 8 : body + 12].decode("latin-1")
        elif kind == b"stsd":
            t["codec"] = data[body + 12 : body + 16].decode("latin-1")
        elif kind == b"stts":
            t["deltas"] = _table(data, body, end, "II")
        elif kind == b"stsc":
            t["runs"] = _table(data, body, end, "III")
        elif kind == b"stsz":
            size, n = struct.unpack_from(">II", data, body + 4)
            t["sizes"] = [size] * n if size else [x[0] for x in _table(data, body, end, "I", 4)]
        elif kind in (b"stco", b"co64"):
            t["offsets"] = [x[0] for x in _table(data, body, end, "I" if kind == b"stco" else "Q")]
        elif kind == b"stss":
            t["keys"] = [x[0] for x in _table(data, body, end, "I")]
    for t in out:
        t["chunks"], t["samples"], done = [], [], 0
        for i, at in enumerate(t["offsets"]):
            per = next((k for first, k, _ in reversed(t["runs"]) if first <= i + 1), 0)
            sizes = t["sizes"][done : done + per]
            done += per
            t["chunks"].append((at, sum(sizes)))
            for size in sizes:
                t["samples"].append((at, size))
                at += size
    _add_fragments(data, out)
    for t in out:
        if t["chunks"] and max(a + n for a, n in t["chunks"]) > len(data):
            raise ValueError("a chunk lies past the end")
    return out


def _add_fragments(data: bytes, out: list[dict[str, Any]]) -> None:
    """Sample runs of movie fragments go to their tracks; what can't be placed is named in each track's ``problem``."""
    by_id, defaults, problem = {t["id"]: t for t in out}, {}, None
    moof = head = None
    for path, body, end in boxes(data):
        kind = path[-1]
        if kind == b"trex":
            track, _, _, size, flags = struct.unpack_from(">5I", data, body + 4)
            defaults[track] = (size, flags)
        elif kind == b"moof":
            wide = body >= 16 and data[body - 16 : body - 8] == b"\0\0\0\1moof"
            moof = next_at = body - (16 if wide else 8)
        elif kind == b"traf":
            head = None
            if not any(p[-1] == b"tfhd" for p, _, _ in boxes(data, body, end)):
                problem = "fragmented: a track fragment without its header"
        elif kind == b"tfhd" and path[-2:-1] == (b"traf",):
            flags, track = struct.unpack_from(">II", data, body)
            at, given = body + 8, {}
            for bit, form in ((0x1, "Q"), (0x2, "I"), (0x8, "I"), (0x10, "I"), (0x20, "I")):
                if flags & bit:
                    (given[bit],) = struct.unpack_from(">" + form, data, at)
                    at += struct.calcsize(">" + form)
            size, mark = defaults.get(track, (0, 0))
            head = {"track": by_id.get(track), "base": given.get(0x1, moof if flags & 0x20000 else next_at), "size": given.get(0x10, size), "flags": given.get(0x20, mark)}
            head["at"] = head["base"]
            if head["track"] is None:
                problem = f"fragmented: a track fragment of the unknown track {track}"
        elif kind == b"trun" and head is not None and head["track"] is not None:
            flags, n = struct.unpack_from(">II", data, body)
            flags &= 0xFFFFFF
            at = body + 8
            if flags & 0x1:
                (offset,) = struct.unpack_from(">i", data, at)
                head["at"] = head["base"] + offset
                at += 4
            first = None
            if flags & 0x4:
                (first,) = struct.unpack_from(">I", data, at)
                at += 4
            each = [bit for bit in (0x100, 0x200, 0x400, 0x800) if flags & bit]
            if at + 4 * len(each) * n > end:
                raise ValueError("a sample run is cut off")
            t, start = head["track"], head["at"]
            for i in range(n):
                given = dict(zip(each, struct.unpack_from(f">{len(each)}I", data, at), strict=True))
                at += 4 * len(each)
                size = given.get(0x200, head["size"])
                mark = first if first is not None and i == 0 else given.get(0x400, head["flags"])
                if t["keys"] is None:
                    t["keys"] = list(range(1, len(t["samples"]) + 1))
                t["samples"].append((head["at"], size))
                if not mark & 0x10000:
                    t["keys"].append(len(t["samples"]))
                head["at"] += size
            t["chunks"].append((start, head["at"] - start))
            next_at = head["at"]
    for t in out:
        t["problem"] = problem


def payload(data: bytes, track: dict[str, Any]) -> bytes:
    """The bytes of a track's chunks, in order."""
    return b"".join([data[a : a + n] for a, n in track["chunks"]])


def key_ranges(track: dict[str, Any]) -> list[tuple[int, int]]:
    """(start, end) bytes of the key samples; without a sync table every sample is one."""
    samples = track["samples"]
    return [(samples[k - 1][0], sum(samples[k - 1])) for k in (range(1, len(samples) + 1) if track["keys"] is None else track["keys"]) if 0 < k <= len(samples)]


_KEYFRAMES = "array<struct<start:long,end:long>>"
_COLUMNS = f"codec string, handler string, timescale long, duration long, n_samples long, keyframes {_KEYFRAMES}, error string, tracks array<struct<codec:string,handler:string,timescale:long,duration:long,n_samples:long,keyframes:{_KEYFRAMES}>>"


def _summary(t: dict[str, Any]) -> dict[str, Any]:
    return {k: t[k] for k in ("codec", "handler", "timescale", "duration")} | {"n_samples": len(t["samples"]), "keyframes": [{"start": a, "end": b} for a, b in key_ranges(t)]}


def _columns(data: bytes | None) -> tuple:
    try:
        every = tracks(data or b"")
        found = [_summary(t) for t in every]
        if not found:
            return (None,) * 6 + ("no track", None)
        return (*found[0].values(), every[0]["problem"], found)
    except (ValueError, struct.error) as e:
        return (None,) * 6 + (str(e), None)


def inspect(media: DataFrame, id_col: str, data_col: str) -> DataFrame:
    """id, codec, handler, timescale, duration, n_samples, keyframes of the first track of each container, its error, and the same of all its tracks."""

    def make():
        return lambda columns: [columns[0], *([list(c) for c in zip(*map(_columns, columns[1]), strict=True)] or [[]] * 8)]

    return map_rows(media.select(F.col(id_col).cast("long").alias("id"), F.col(data_col).cast("binary").alias("data")), "id long, " + _COLUMNS, make)


def media_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text packed into a container and read back through its boxes: sizes, digests, a feature string, codec, duration and the byte ranges of its key frames."""
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, codec string, duration long, keyframes " + _KEYFRAMES

    def one(text: bytes | None) -> tuple:
        stored = pack(text or b"")
        (t,) = tracks(stored)
        back, keys = payload(stored, t), key_ranges(t)
        feature = f"{t['codec']}|{t['duration']}/{t['timescale']}|{len(t['samples'])}|{len(keys)}|{keys[0][0]}-{keys[-1][1]}"
        ranges = [{"start": a, "end": b} for a, b in keys]
        return len(text or b""), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), feature, t["codec"], t["duration"], ranges

    def make():
        return lambda columns: [columns[0], *([list(c) for c in zip(*map(one, columns[1]), strict=True)] or [[]] * 10)]

    return map_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("data")), schema, make)

"""Media columns: ISO media containers written and walked without touching what their samples hold."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StringType, StructField, StructType

from .arrow import map_texts

#: One raw frame: 8 x 8 pixels of three 8-bit samples.
WIDTH = HEIGHT = 8
UNIT = WIDTH * HEIGHT * 3
FRAMES_PER_CHUNK = 64
KEYFRAME_EVERY = 12
TIMESCALE = 24

#: Boxes that hold boxes, with the bytes before the first of them.
NESTED = {b"moov": 0, b"trak": 0, b"mdia": 0, b"minf": 0, b"stbl": 0, b"edts": 0, b"dinf": 0, b"mvex": 0, b"udta": 0, b"moof": 0, b"traf": 0}
MATRIX = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


def payload_of(text: str | None) -> bytes:
    """UTF-8 of the text, filled with spaces up to a positive multiple of UNIT."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw.ljust(max(UNIT, -(-len(raw) // UNIT) * UNIT), b" ")


def _box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return struct.pack(">I4s", 8 + len(body), kind) + body


def _full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return _box(kind, struct.pack(">I", version << 24 | flags), *parts)


def write_container(payload: bytes) -> bytes:
    """An ISO media file with one track of raw RGB frames of UNIT bytes, its index in front; equal payloads give equal files.

    Each frame can be shown alone; the sync table lists every KEYFRAME_EVERY-th as a point to start from.
    """
    frames = len(payload) // UNIT
    chunks = -(-frames // FRAMES_PER_CHUNK)
    rest = frames - (chunks - 1) * FRAMES_PER_CHUNK
    runs = [(1, FRAMES_PER_CHUNK, 1)] if rest == FRAMES_PER_CHUNK or chunks > 1 else []
    if rest != FRAMES_PER_CHUNK:
        runs.append((chunks, rest, 1))
    sync = np.arange(1, frames + 1, KEYFRAME_EVERY, dtype=">u4")
    ftyp = _box(b"ftyp", b"qt  ", struct.pack(">I", 0), b"qt  isom")
    large = len(payload) > (1 << 31)
    head = struct.pack(">I4sQ", 1, b"mdat", 16 + len(payload)) if large else struct.pack(">I4s", 8 + len(payload), b"mdat")
    entry = _box(b"raw ", bytes(6), struct.pack(">H", 1), bytes(16), struct.pack(">HHIIIH", WIDTH, HEIGHT, 72 << 16, 72 << 16, 0, 1), bytes(32), struct.pack(">Hh", 24, -1))

    def moov(first: int) -> bytes:
        offsets = first + np.arange(chunks, dtype=np.int64) * FRAMES_PER_CHUNK * UNIT
        places = _full(b"co64" if large else b"stco", struct.pack(">I", chunks), offsets.astype(">u8" if large else ">u4").tobytes())
        stbl = _box(
            b"stbl",
            _full(b"stsd", struct.pack(">I", 1), entry),
            _full(b"stts", struct.pack(">III", 1, frames, 1)),
            _full(b"stss", struct.pack(">I", len(sync)), sync.tobytes()),
            _full(b"stsc", struct.pack(">I", len(runs)), *(struct.pack(">III", *r) for r in runs)),
            _full(b"stsz", struct.pack(">II", UNIT, frames)),
            places,
        )
        minf = _box(b"minf", _full(b"vmhd", bytes(8), flags=1), _box(b"dinf", _full(b"dref", struct.pack(">I", 1), _full(b"url ", flags=1))), stbl)
        mdia = _box(b"mdia", _full(b"mdhd", struct.pack(">IIIIHH", 0, 0, TIMESCALE, frames, 0x55C4, 0)), _full(b"hdlr", bytes(4), b"vide", bytes(12), b"frames\0"), minf)
        tkhd = _full(b"tkhd", struct.pack(">IIIII", 0, 0, 1, 0, frames), bytes(16), MATRIX, struct.pack(">II", WIDTH << 16, HEIGHT << 16), flags=3)
        mvhd = _full(b"mvhd", struct.pack(">IIII", 0, 0, TIMESCALE, frames), struct.pack(">IH", 0x10000, 0x100), bytes(10), MATRIX, bytes(24), struct.pack(">I", 2))
        return _box(b"moov", mvhd, _box(b"trak", tkhd, mdia))

    index = moov(len(ftyp) + len(moov(0)) + len(head))
    return b"".join((ftyp, index, head, payload))


#: Boxes inside each other up to which a file is walked; real files have about ten.
DEPTH = 32


def _table(body: memoryview, at: int, kind: str, width: int = 1) -> np.ndarray:
    """Rows of a table whose 32-bit count stands before at; the count is held against the box before anything is allocated."""
    n = struct.unpack_from(">I", body, at - 4)[0]
    if n * width * np.dtype(kind).itemsize > len(body) - at:
        raise ValueError("a table is longer than its box")
    return np.frombuffer(body, kind, n * width, at).astype(np.int64)


@dataclass
class Track:
    number: int = 0
    handler: str = ""
    codec: str = ""
    width: int = 0
    height: int = 0
    timescale: int = 0
    duration: int = 0
    tables: dict[bytes, memoryview] = field(default_factory=dict)
    runs: list[tuple] = field(default_factory=list)  # of fragments: (offsets, sizes, ticks, numbers of sync samples)

    def sizes(self, most: int) -> np.ndarray:
        """Sizes of the samples of the sample tables, which lie in a file of most bytes."""
        if b"stz2" in self.tables:
            body = self.tables[b"stz2"]
            bits, n = struct.unpack_from(">BI", body, 7)
            if bits not in (4, 8, 16) or (n * bits + 7) // 8 > len(body) - 12:
                raise ValueError("a table of small sizes is broken")
            if bits == 4:
                pairs = np.frombuffer(body, np.uint8, (n + 1) // 2, 12)
                return np.stack([pairs >> 4, pairs & 15], 1).ravel()[:n].astype(np.int64)
            return np.frombuffer(body, f">u{bits // 8}", n, 12).astype(np.int64)
        body = self.tables[b"stsz"]
        size, n = struct.unpack_from(">II", body, 4)
        if not size:
            return _table(body, 12, ">u4")
        if n * size > most:
            raise ValueError("samples hold more than the file")
        return np.full(n, size, np.int64)

    def samples(self, most: int) -> tuple[np.ndarray, np.ndarray, int, np.ndarray]:
        """Offset and size of each sample, ticks of all, and numbers from 0 of those to start from: of the tables, then of fragments."""
        parts = [self._of_tables(most)] if self.tables.keys() & {b"stsz", b"stz2"} else []
        parts += self.runs
        if not parts:
            raise ValueError("no samples are described")
        before = np.cumsum([0, *(len(p[0]) for p in parts)])
        offsets, sizes = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        return offsets, sizes, sum(p[2] for p in parts), np.concatenate([p[3] + n for p, n in zip(parts, before)])

    def _of_tables(self, most: int) -> tuple:
        t, sizes = self.tables, self.sizes(most)
        n = len(sizes)
        chunks = _table(t[b"co64"], 8, ">u8") if b"co64" in t else _table(t[b"stco"], 8, ">u4")
        runs = _table(t[b"stsc"], 8, ">u4", 3).reshape(-1, 3)
        last = np.append(runs[1:, 0], len(chunks) + 1)
        if len(runs) and (runs[0, 0] != 1 or (last <= runs[:, 0]).any()) or len(chunks) and not len(runs):
            raise ValueError("runs of chunks don't rise")
        per_chunk = np.repeat(runs[:, 1], last - runs[:, 0]) if len(chunks) else np.zeros(0, np.int64)
        if per_chunk.sum() != n:
            raise ValueError("chunk and sample tables disagree")
        before = np.concatenate([[0], np.cumsum(sizes)])  # bytes of the samples before
        first = np.concatenate([[0], np.cumsum(per_chunk)[:-1]]) if len(per_chunk) else per_chunk
        full = per_chunk > 0
        offsets = np.repeat(chunks[full] - before[first[full]], per_chunk[full]) + before[:-1]
        times = _table(t[b"stts"], 8, ">u4", 2).reshape(-1, 2)
        if times[:, 0].sum() != n:
            raise ValueError("time and sample tables disagree")
        sync = np.arange(n) if b"stss" not in t else _table(t[b"stss"], 8, ">u4") - 1
        if len(sync) and not 0 <= sync.min() <= sync.max() < n:
            raise ValueError("the sync table names a sample that isn't there")
        return offsets, sizes, sum(a * b for a, b in times.tolist()), sync


def walk(data: memoryview) -> Iterator[tuple[tuple, int, memoryview]]:
    """(path of box kinds, place, body) of each box, nested ones after the box that holds them; 64-bit and open sizes are understood."""
    open_ = [(0, len(data), ())]
    while open_:
        start, end, path = open_.pop()
        if start + 8 > end:
            continue
        size, kind = struct.unpack_from(">I4s", data, start)
        head = 8
        if size == 1:
            if start + 16 > end:
                raise ValueError("a box is cut off")
            size, head = struct.unpack_from(">Q", data, start + 8)[0], 16
        elif size == 0:
            size = end - start
        if size < head or start + size > end:
            raise ValueError("a box reaches beyond what holds it")
        yield (*path, kind), start, data[start + head : start + size]
        open_.append((start + size, end, path))
        if kind in NESTED:
            if len(path) + 1 >= DEPTH:
                raise ValueError("boxes are nested too deeply")
            open_.append((start + head + NESTED[kind], start + size, (*path, kind)))


class _Fragments:
    """Runs of samples in movie fragments, laid out by the defaults of the movie, the fragment's track and the run itself."""

    def __init__(self, most: int):
        self.most, self.left, self.defaults = most, most, {}
        self.moof = self.next = self.number = 0
        self.own: tuple = ()

    def box(self, path: tuple, start: int, body: memoryview, tracks: list[Track]) -> None:
        kind = path[-1]
        if kind == b"trex":
            number, _, *rest = struct.unpack_from(">5I", body, 4)
            self.defaults[number] = tuple(rest)  # ticks, size, flags
        elif kind == b"moof":
            self.moof, self.next = start, start
        elif kind == b"tfhd":
            flags, self.number = struct.unpack_from(">I", body)[0] & 0xFFFFFF, struct.unpack_from(">I", body, 4)[0]
            at = 8
            if flags & 1:
                self.next, at = struct.unpack_from(">Q", body, at)[0], at + 8
            elif flags & 0x20000:
                self.next = self.moof
            self.base = self.next
            at += 4 * bool(flags & 2)
            own = list(self.defaults.get(self.number, (0, 0, 0)))
            for k, flag in enumerate((8, 16, 32)):
                if flags & flag:
                    own[k], at = struct.unpack_from(">I", body, at)[0], at + 4
            self.own = tuple(own)
        elif kind == b"trun" and self.own:
            self._run(body, next((t for t in tracks if t.number == self.number), None))

    def _run(self, body: memoryview, track: Track | None) -> None:
        flags, n = struct.unpack_from(">I", body)[0] & 0xFFFFFF, struct.unpack_from(">I", body, 4)[0]
        at, first_flags = 8, None
        if flags & 1:
            self.next, at = self.base + struct.unpack_from(">i", body, at)[0], at + 4
        if flags & 4:
            first_flags, at = struct.unpack_from(">I", body, at)[0], at + 4
        held = [k for k, flag in enumerate((0x100, 0x200, 0x400, 0x800)) if flags & flag]
        if n * 4 * len(held) > len(body) - at:
            raise ValueError("a run is longer than its box")
        if n > self.left:
            raise ValueError("runs have more samples than the file has bytes")
        self.left -= n
        rows = np.frombuffer(body, ">u4", n * len(held), at).reshape(n, -1).astype(np.int64) if held else None
        ticks, sizes, marks = (rows[:, held.index(k)] if k in held else np.full(n, self.own[k], np.int64) for k in range(3))
        if first_flags is not None and n:
            marks = marks.copy()
            marks[0] = first_flags
        if int(sizes.sum()) > self.most or n and int(sizes.min()) < 1:
            raise ValueError("samples hold more than the file, or nothing")
        ends = self.next + np.cumsum(sizes)
        if track is not None:
            track.runs.append((ends - sizes, sizes, int(ticks.sum()), np.flatnonzero(marks & 0x10000 == 0)))
        self.next = int(ends[-1]) if n else self.next


def read_tracks(data: bytes) -> list[Track]:
    tracks: list[Track] = []
    fragments = _Fragments(len(data))
    for path, start, body in walk(memoryview(data)):
        kind, parent = path[-1], path[-2] if len(path) > 1 else b""
        fragments.box(path, start, body, tracks)
        if kind == b"trak":
            tracks.append(Track())
        elif not tracks or b"trak" not in path:
            continue
        track = tracks[-1]
        if kind == b"tkhd":
            track.number = struct.unpack_from(">I", body, 20 if body[0] else 12)[0]
        elif kind == b"hdlr" and parent == b"mdia":  # a data handler may stand in minf
            track.handler = bytes(body[8:12]).decode("latin-1")
        elif kind == b"mdhd":
            track.timescale, track.duration = struct.unpack_from(">IQ", body, 20) if body[0] else struct.unpack_from(">II", body, 12)
        elif kind == b"stsd":
            track.codec = bytes(body[12:16]).decode("latin-1")
            if track.handler == "vide" and len(body) >= 44:
                track.width, track.height = struct.unpack_from(">HH", body, 40)
        elif parent == b"stbl":
            track.tables[kind] = body
    return tracks


def _describe(data: bytes) -> dict:
    tracks = read_tracks(data)
    track = next((t for t in tracks if t.handler == "vide"), tracks[0] if tracks else None)
    if track is None:
        raise ValueError("no track")
    offsets, sizes, ticks, keys = track.samples(len(data))
    if len(offsets) and (int((offsets + sizes).max()) > len(data) or int(offsets.min()) < 0):
        raise ValueError("a sample lies beyond the file")
    return {"track": track, "offsets": offsets, "sizes": sizes, "ticks": ticks, "keys": keys}


def _writer():
    return lambda texts: [pa.array([write_container(payload_of(x)) for x in texts], pa.binary())]


def store_texts(df: DataFrame, text: str = "text", keys: tuple = ("doc_id",)) -> DataFrame:
    """keys and media: each text, filled up to whole frames, as an ISO media file.

    Null and empty texts are one frame of spaces; equal texts give equal files. A file is one value, so a text must fit a binary
    cell. Repeated rows each give a row, an empty table gives none; further columns are left out.
    """
    return map_texts(df, _writer, [StructField("media", BinaryType())], keys, text)


_RANGE = StructType([StructField("offset", LongType()), StructField("length", LongType())])


def _reader(digests: bool):
    def read(values: list) -> list:
        rows = []
        for data in values:
            row: list = [None] * 12
            try:
                if data is None:
                    raise ValueError("no file")
                d = _describe(data)
                track, offsets, sizes, keys = d["track"], d["offsets"], d["sizes"], d["keys"]
                ranges = offsets[keys], sizes[keys]
                ticks = d["ticks"]
                row[:8] = [track.codec.strip(), track.width, track.height, len(offsets), track.timescale, ticks / track.timescale if track.timescale else None, int(sizes.sum()), ranges]
                if digests:
                    sha, crc_tail, view = hashlib.sha256(), b"", memoryview(data)
                    for start, length in _joined(offsets, sizes):
                        sha.update(view[start : start + length])
                        crc_tail = (crc_tail + bytes(view[max(start, start + length - 16) : start + length]))[-16:]
                    row[8], row[9] = sha.hexdigest(), zlib.crc32(crc_tail)
                    row[10] = hashlib.sha256(data).hexdigest()
            except (ValueError, KeyError, IndexError, OverflowError, struct.error) as e:
                row[11] = f"{type(e).__name__}: {e}"
            rows.append(row)
        columns = list(zip(*rows)) or [[]] * 12
        columns[7] = _ranges(columns[7])
        return list(columns[:8] + columns[8:11] * digests + columns[11:]) if digests else [*columns[:8], columns[11]]

    return read


def _ranges(pairs: list) -> pa.ListArray:
    """Byte ranges from arrays of offsets and lengths, null for None, without an object for each."""
    held = [x or (np.zeros(0, np.int64),) * 2 for x in pairs]
    ends = np.concatenate([[0], np.cumsum([len(x[0]) for x in held])])
    flat = [pa.array(np.concatenate([np.zeros(0, np.int64), *(x[k] for x in held)]).astype(np.int64)) for k in range(2)]
    ranges = pa.StructArray.from_arrays(flat, ["offset", "length"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ranges, mask=pa.array([x is None for x in pairs], pa.bool_()))


def _joined(offsets: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int]]:
    """Byte ranges of the samples in order, those that touch as one."""
    if not len(offsets):
        return []
    ends = offsets + sizes
    new = np.concatenate([[True], offsets[1:] != ends[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(offsets)) - 1
    return list(zip(offsets[first].tolist(), (ends[last] - offsets[first]).tolist()))


def describe_media(df: DataFrame, media: str = "media", keys: tuple = ("doc_id",), digests: bool = False) -> DataFrame:
    """codec, width, height, n_samples, timescale, seconds, sample_bytes, keyframes (byte ranges) and error of each file.

    The boxes are walked, and the sample tables and runs of fragments decoded; payload bytes are neither decoded nor copied. Counts
    are held against the bytes that are there before anything is allocated: all runs together name no more samples than the file has bytes,
    and none that is empty, so what is held is some integers for each byte at worst. Of several tracks the first
    with pictures counts, else the first. digests adds sha256, tail_crc32 (of the last 16 bytes) of the samples and file_sha256.
    A null or broken file gives a row with nulls and its error. Repeated rows each give a row, an empty table gives none; further
    columns are left out.
    """
    fields = [StructField("codec", StringType()), StructField("width", LongType()), StructField("height", LongType()), StructField("n_samples", LongType()), StructField("timescale", LongType()), StructField("seconds", DoubleType()), StructField("sample_bytes", LongType()), StructField("keyframes", ArrayType(_RANGE))]
    fields += [StructField("sha256", StringType()), StructField("tail_crc32", LongType()), StructField("file_sha256", StringType())] * digests
    return map_texts(df, partial(_reader, digests), [*fields, StructField("error", StringType())], keys, media)


def read_media(spark: SparkSession, path: str, digests: bool = False) -> DataFrame:
    """describe_media over the files at path, with path and length as keys."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return describe_media(files.select("path", "length", "content"), "content", ("path", "length"), digests)


def feature(df: DataFrame) -> DataFrame:
    """Adds feature: codec, picture size, number of frames, seconds, and number, first and last of the keyframes' byte ranges."""
    k = F.col("keyframes")
    edge = lambda i: F.concat_ws("+", F.try_element_at(k, F.lit(i))["offset"], F.try_element_at(k, F.lit(i))["length"])
    return df.withColumn("feature", F.concat_ws(";", "codec", F.concat_ws("x", "width", "height"), F.col("n_samples"), F.format_string("%.6f", "seconds"), F.size(k), edge(1), edge(-1)))

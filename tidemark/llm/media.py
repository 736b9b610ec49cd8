"""MPEG audio columns: bytes kept in the frames of a Layer III stream, and a reader of such streams.

A stream is an ID3v2 tag, a frame with a variable-bitrate (Xing) table, and one MPEG-2 Layer III stereo frame for every
576 bytes of payload: header, checksum, 17 bytes of side information, and the payload as the two channels' main data.
The bitrate of a frame follows its payload (fewer bits for a frame of one repeated byte), so frames differ in size as
in any variable-bitrate stream. The reader finds frames again after damage, checks each checksum, and gives exact
durations and the byte offset of every frame. It takes other Layer III streams too: tags before and behind the sound,
tables of either kind, main data that begins in earlier frames, one channel or two.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .text import documents, shared_dir, slices

UNIT = 576
# Fixed values of MPEG audio, Layer III: kbit/s by index and sampling rates by index, for MPEG-1, and for MPEG-2 and 2.5.
BITRATES = {3: (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320), 2: (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160)}
RATES = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}
CRC_POLYNOMIAL = 0x8005

VERSION, RATE, RATE_INDEX, SIDE = 2, 16000, 2, 17
QUIET, LOUD = 13, 14  # bitrate indexes: 144 and 160 kbit/s, 648 and 720 bytes a frame
TITLE = b"text"


def _crc_step(value: int) -> int:
    """What eight shifts make of a register's upper byte."""
    for _ in range(8):
        value = (value << 1) ^ (CRC_POLYNOMIAL if value & 0x8000 else 0)
    return value & 0xFFFF


CRC_STEPS = [_crc_step(byte << 8) for byte in range(256)]


def crc16(data: bytes) -> int:
    """The checksum of a frame: header bytes 2 and 3, and the side information."""
    value = 0xFFFF
    for byte in data:
        value = (value << 8 & 0xFF00) ^ CRC_STEPS[value >> 8 ^ byte]
    return value


def frame_size(version: int, bitrate: int, rate: int, padding: int) -> int:
    return (144 if version == 3 else 72) * bitrate * 1000 // rate + padding


def header(index: int, checked: bool = True) -> bytes:
    return bytes([0xFF, 0xE0 | VERSION << 3 | 1 << 1 | (not checked), index << 4 | RATE_INDEX << 2, 0])


def _side() -> bytes:
    """Side information of one granule: 288 bytes of main data for each of two channels, all else zero."""
    bits = "0" * 8 + "00" + (format(UNIT // 2 * 8, "012b") + "0" * 51) * 2
    return int(bits, 2).to_bytes(SIDE, "big")


SIDE_INFO = _side()
HEADS = {k: (h := header(k)) + struct.pack(">H", crc16(h[2:] + SIDE_INFO)) + SIDE_INFO for k in (QUIET, LOUD)}
SIZES = {k: frame_size(VERSION, BITRATES[2][k], RATE, 0) for k in (QUIET, LOUD)}


def id3(title: bytes) -> bytes:
    """A version 2.3 tag with a title."""
    frame = b"TIT2" + struct.pack(">IH", len(title) + 1, 0) + b"\0" + title
    n = len(frame)
    return b"ID3\3\0\0" + bytes([n >> 21 & 127, n >> 14 & 127, n >> 7 & 127, n & 127]) + frame


def encode(payload: bytes) -> bytes:
    """The stream of a payload of a positive multiple of UNIT bytes."""
    if not payload or len(payload) % UNIT:
        raise ValueError(f"payload must be a positive multiple of {UNIT} bytes")
    rows = np.frombuffer(payload, np.uint8).reshape(-1, UNIT)
    loud = (rows != rows[:, :1]).any(1)
    sizes = np.where(loud, SIZES[LOUD], SIZES[QUIET])
    body = np.zeros((len(rows), SIZES[LOUD]), np.uint8)
    for k, some in ((QUIET, ~loud), (LOUD, loud)):
        body[some, : len(HEADS[k])] = np.frombuffer(HEADS[k], np.uint8)
    n = len(HEADS[LOUD])
    body[:, n : n + UNIT] = rows
    frames = body.tobytes() if loud.all() else body[np.arange(SIZES[LOUD]) < sizes[:, None]].tobytes()
    first = bytearray(SIZES[LOUD])
    first[:4] = header(LOUD, checked=False)
    total = len(first) + len(frames)
    ends = np.concatenate([[0], np.cumsum(sizes)]) + len(first)
    seek = (256 * ends[np.arange(100) * len(rows) // 100] // total).astype(np.uint8).tobytes()
    table = b"Xing" + struct.pack(">3I", 7, len(rows), total) + seek
    first[4 + SIDE : 4 + SIDE + len(table)] = table
    return id3(TITLE) + bytes(first) + frames


@dataclass
class Table:
    """A variable-bitrate table: its kind, frames and bytes (0: not told), and seek points as (share of the time, byte offset)."""

    kind: str
    frames: int = 0
    size: int = 0
    points: list[tuple[float, int]] = field(default_factory=list)


@dataclass
class Stream:
    """What a reader finds: sizes in bytes, times in samples a channel."""

    title: str = ""
    tagged: int = 0
    table: Table | None = None
    rate: int = 0
    samples: int = 0
    padded: int = 0  # of samples, those that an encoder says it has put before and behind the sound
    offsets: list[int] = field(default_factory=list)
    bitrates: list[int] = field(default_factory=list)
    bad_checksums: int = 0
    skipped: int = 0
    cut: int = 0  # bytes of a last frame that isn't whole
    payload: bytes = b""

    @property
    def duration_us(self) -> int:
        return (self.samples - self.padded) * 1_000_000 // self.rate if self.rate else 0

    def seek(self, sample: int) -> int:
        """The offset of the frame that holds a sample; 0 where there is no frame."""
        return self.offsets[min(sample * len(self.offsets) // max(self.samples, 1), len(self.offsets) - 1)] if self.offsets else 0


def parse_header(data: bytes, at: int) -> tuple[int, int, int, int, bool, int] | None:
    """version, kbit/s, sampling rate, size, checksum present and channels of a Layer III header at that place, if one is there."""
    if at + 4 > len(data) or data[at] != 0xFF or data[at + 1] & 0xE0 != 0xE0:
        return None
    version, layer = data[at + 1] >> 3 & 3, data[at + 1] >> 1 & 3
    bitrate, rate = data[at + 2] >> 4, data[at + 2] >> 2 & 3
    if version == 1 or layer != 1 or bitrate in (0, 15) or rate == 3:
        return None
    kbits, hertz = BITRATES[3 if version == 3 else 2][bitrate], RATES[version][rate]
    return version, kbits, hertz, frame_size(version, kbits, hertz, data[at + 2] >> 1 & 1), not data[at + 1] & 1, 1 if data[at + 3] >> 6 == 3 else 2


def side_size(version: int, channels: int) -> int:
    return (32 if channels == 2 else 17) if version == 3 else (17 if channels == 2 else 9)


def main_data(side: bytes, version: int, channels: int) -> tuple[int, int]:
    """How many bytes before its frame the main data begins, and how many it has, by the side information."""
    bits, left = int.from_bytes(side, "big"), 8 * len(side)

    def read(n: int) -> int:
        nonlocal left
        left -= n
        return bits >> left & (1 << n) - 1

    begin = read(9 if version == 3 else 8)
    read((3 if channels == 2 else 5) + 4 * channels if version == 3 else channels)
    total = 0
    for _ in range((2 if version == 3 else 1) * channels):
        total += read(12)
        read(47 if version == 3 else 51)
    return begin, -(-total // 8)


def _synchsafe(four: bytes) -> int:
    return four[0] << 21 | four[1] << 14 | four[2] << 7 | four[3]


def _text(value: bytes) -> str:
    kind, rest = value[:1], value[1:]
    return rest.decode({b"\1": "utf-16", b"\2": "utf-16-be", b"\3": "utf-8"}.get(kind, "latin-1"), "replace").rstrip("\0")


def leading_tag(data: bytes, at: int) -> tuple[int, str]:
    """Size of an ID3v2 tag at that place (0: none, or cut), and its title, whichever of its frames that is."""
    head = data[at : at + 10]
    if len(head) < 10 or head[:3] != b"ID3" or max(head[6:]) > 127:
        return 0, ""
    major, end = head[3], at + 10 + _synchsafe(head[6:])
    name, width = (b"TT2", 3) if major == 2 else (b"TIT2", 4)
    k = at + 10
    if head[5] & 0x40 and k + 4 <= len(data) and major > 2:  # an extended header
        k += _synchsafe(data[k : k + 4]) if major == 4 else 4 + int.from_bytes(data[k : k + 4], "big")
    title = ""
    while k + 2 * width + (2 if width == 4 else 0) <= min(end, len(data)) and data[k]:
        size = data[k + width : k + 2 * width]
        size = _synchsafe(size) if major == 4 else int.from_bytes(size, "big")
        body = k + 2 * width + (2 if width == 4 else 0)
        if data[k : k + width] == name:
            title = _text(data[body : min(body + size, end)])
            break
        k = body + size
    size = end - at + (10 if head[5] & 0x10 else 0)
    return min(size, len(data) - at), title


def _numbers(data: bytes, at: int, n: int, width: int = 4) -> list[int] | None:
    """n numbers of so many bytes, if they are all there."""
    part = data[at : at + n * width]
    return [int.from_bytes(part[k : k + width], "big") for k in range(0, n * width, width)] if len(part) == n * width else None


def rate_table(data: bytes, at: int, end: int, body: int, side: int) -> tuple[Table, int] | None:
    """The table that the frame at `at` holds in place of sound, and the samples that it says are padding."""
    frame = data[:end]
    if frame[body + side : body + side + 4] in (b"Xing", b"Info"):
        out, k = Table(frame[body + side : body + side + 4].decode()), body + side + 4
        flags = (_numbers(frame, k, 1) or [0])[0]
        k += 4
        for bit, name in ((1, "frames"), (2, "size")):
            if flags & bit and (found := _numbers(frame, k, 1)):
                setattr(out, name, found[0])
                k += 4
        if flags & 4 and (toc := _numbers(frame, k, 100, 1)):
            total = out.size or len(data) - at
            out.points = [(share / 100, at + x * total // 256) for share, x in enumerate(toc)]
            k += 100
        k += 4 if flags & 8 else 0
        padding = 0
        if frame[k : k + 4] in (b"LAME", b"Lavf", b"Lavc") and (gaps := _numbers(frame, k + 21, 1, 3)):
            padding = (gaps[0] >> 12) + (gaps[0] & 0xFFF)
        return out, padding
    if frame[at + 36 : at + 40] == b"VBRI":
        sizes, shape = _numbers(frame, at + 46, 2), _numbers(frame, at + 54, 4, 2)
        out = Table("VBRI", *(sizes[::-1] if sizes else (0, 0)))
        if shape and shape[2] in (1, 2, 3, 4) and (steps := _numbers(frame, at + 62, shape[0], shape[2])):
            offset = at
            for k, step in enumerate(steps):
                out.points.append((min(1.0, k * shape[3] / max(1, out.frames)), offset))
                offset += step * shape[1]
        return out, 0
    return None


def parse(data: bytes) -> Stream:
    """Reads a stream from its bytes alone; any bytes give a result, no bytes an empty one.

    A header counts if its frame ends where another like it begins, or with the sound, or if the frame's checksum holds. The
    payload is all frames' main data, put together across frames as the side information says.
    """
    out, at, end, held = Stream(), 0, len(data), []
    if end >= 128 and data[end - 128 : end - 125] == b"TAG":
        end -= 128
        out.title = data[end + 3 : end + 33].split(b"\0")[0].decode("latin-1").rstrip()
    while (size := leading_tag(data[:end] if at else data, at))[0]:
        at, out.title = at + size[0], size[1] or out.title
    out.tagged = at
    checksums: dict[bytes, int] = {}
    sides: dict[bytes, tuple[int, int]] = {}
    kind, pool = None, b""
    while at + 4 <= end:
        head = parse_header(data, at)
        if head is not None and kind not in (None, (head[0], head[2])):
            head = None
        covered = b""
        if head is not None:
            version, kbits, rate, size, checked, channels = head
            side, body = side_size(version, channels), at + 4 + 2 * checked
            if checked and body + side <= end:
                covered = data[at + 2 : at + 4] + data[body : body + side]
                if covered not in checksums:
                    checksums[covered] = crc16(covered)
            after = parse_header(data, at + size)
            followed = at + size == end or (after is not None and (after[0], after[2]) == (version, rate))
            sound = bool(covered) and checksums[covered] == data[at + 4] << 8 | data[at + 5]
            if at + size > end and (kind or sound):
                out.cut = end - at
                break
            if body + side > at + size or at + size > end or not (followed or sound):
                head = None
        if head is None:
            step = data.find(b"\xff", at + 1, end)
            step = end if step < 0 else step
            out.skipped += step - at
            at = step
            continue
        kind, out.rate = (version, rate), rate
        if not out.offsets and out.table is None and (found := rate_table(data, at, at + size, body, side)):
            out.table, out.padded = found
            at += size
            continue
        out.bad_checksums += bool(covered) and not sound
        out.offsets.append(at)
        out.bitrates.append(kbits)
        out.samples += 1152 if version == 3 else 576
        information = data[body : body + side]
        if information not in sides:
            sides[information] = main_data(information, version, channels)
        begin, n = sides[information]
        if begin or n > at + size - body - side:
            region = pool[max(0, len(pool) - begin) :] + data[body + side : at + size]
            held.append(region[:n])
            pool = (pool + data[body + side : at + size])[-512:]
        else:
            held.append(data[body + side : body + side + n])
            pool = data[max(body + side, at + size - 512) : at + size]
        at += size
    out.skipped += max(0, end - at) if at + 4 > end and not out.cut else 0
    out.padded = out.padded if out.padded < out.samples else 0
    out.payload = b"".join(held)
    return out


def pad(data: bytes) -> bytes:
    return data + b"\xff" * (-len(data) % UNIT or (0 if data else UNIT))


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        data = [(t or "").encode() for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(d) for d in data], pa.int64()), pa.array([encode(pad(d)) for d in data], pa.binary())], ["doc_id", "n_bytes", "media"])


def feature(s: Stream) -> str:
    """Frames, exact duration, sampling rate, mean bitrate, checksums, and a digest of all seek offsets."""
    seeks = zlib.crc32(np.array(s.offsets, "<u8").tobytes())
    mean = sum(s.bitrates) // max(1, len(s.bitrates))
    agrees = s.table is not None and s.table.frames == len(s.offsets)
    return f"frames={len(s.offsets)};us={s.duration_us};hz={s.rate};kbps={mean};bad={s.bad_checksums};skipped={s.skipped};table={int(agrees)};seek={seeks:08x}"


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, text="media"):
        rows = []
        for media in b.column("media").to_pylist():
            media = media or b""
            s = parse(media)
            rows.append((len(s.payload), sha256(s.payload).hexdigest(), zlib.crc32(s.payload[-32:]), len(media), sha256(media).hexdigest(), feature(s), s.duration_us, len(s.offsets), s.bad_checksums))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 9
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], [x.split()[0] for x in SCHEMA.split(", ")])


SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, duration_us long, frames long, bad_checksums long"


def as_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and the column media with each text's stream. A null text is empty, an empty one is one frame of padding."""
    return documents(docs).mapInArrow(_store, "doc_id long, n_bytes long, media binary")


def media_features(media: DataFrame) -> DataFrame:
    """What the streams in the column media hold, one row for each; of any length, read whole. A null is an empty stream."""
    return media.mapInArrow(_features, SCHEMA)


def stored_features(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes the texts' streams to folder, reads them back, and returns their features; a row for every row."""
    spark = docs.sparkSession
    folder = folder or f"{shared_dir(spark)}/media-{uuid.uuid4().hex}"
    as_media(docs).write.option("compression", "zstd").parquet(folder)
    return media_features(spark.read.parquet(folder))

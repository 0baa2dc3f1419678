"""Media columns: MPEG transport streams.

mux stores bytes as one private elementary stream of one program, with a clock; demux reads a stream
back: it follows the program tables, which may span packets, to the elementary stream, checks
continuity counters and the tables' checksums, reassembles the elementary packets and collects
timestamps, clock references and random-access points. Null packets, repeated packets and announced
discontinuities are no errors.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import Batches, lean
from .words import utf8

#: Fixed values of the format, and of this stream's layout.
PACKET, SYNC, PAT_PID, PMT_PID, STREAM_PID, PRIVATE_DATA, PRIVATE_STREAM_1 = 188, 0x47, 0, 0x1000, 0x100, 0x06, 0xBD
NULL_PID, PADDING = 0x1FFF, 0xBE
#: Elementary packets of these stream ids have no header of their own after their length.
BARE = (0xBC, 0xBE, 0xBF, 0xF0, 0xF1, 0xF2, 0xF8, 0xFF)
UNIT, UNITS, TICKS, RANDOM_ACCESS_EVERY = 192, 32, 3600, 8


def _crc_table() -> list[int]:
    out = []
    for i in range(256):
        c = i << 24
        for _ in range(8):
            c = (c << 1 ^ 0x04C11DB7 if c >> 31 else c << 1) & 0xFFFFFFFF
        out.append(c)
    return out


_CRC = _crc_table()


def crc_mpeg(data: bytes) -> int:
    c = 0xFFFFFFFF
    for b in data:
        c = (c << 8 & 0xFFFFFFFF) ^ _CRC[c >> 24 ^ b]
    return c


def _section(table_id: int, number: int, body: bytes) -> bytes:
    head = bytes([table_id]) + (0xB000 | len(body) + 9).to_bytes(2, "big") + number.to_bytes(2, "big") + b"\xc1\x00\x00" + body
    return b"\0" + head + crc_mpeg(head).to_bytes(4, "big")  # a pointer field of 0 before it


_PAT = _section(0, 1, (1).to_bytes(2, "big") + (0xE000 | PMT_PID).to_bytes(2, "big"))
_PMT = _section(2, 1, (0xE000 | STREAM_PID).to_bytes(2, "big") + b"\xf0\x00" + bytes([PRIVATE_DATA]) + (0xE000 | STREAM_PID).to_bytes(2, "big") + b"\xf0\x00")


def _packet(pid: int, start: bool, counter: int, payload: bytes, flags: int = 0, clock: bytes = b"") -> bytes:
    """One packet; an adaptation field, with flags and a clock reference if there is one, fills what the payload leaves."""
    room = 184 - len(payload)
    head = bytes([SYNC, start << 6 | pid >> 8, pid & 255, (0x30 if room else 0x10) | counter])
    if not room:
        return head + payload
    field = bytes([room - 1]) + (bytes([flags]) + clock + b"\xff" * (room - 2 - len(clock)) if room > 1 else b"")
    return head + field + payload


def _clock(ticks: int) -> bytes:
    """A program clock reference of so many 90 kHz ticks."""
    return ((ticks & (1 << 33) - 1) << 15 | 0x3F << 9).to_bytes(6, "big")


def _timestamp(ticks: int) -> bytes:
    ticks &= (1 << 33) - 1
    return bytes([0x21 | ticks >> 29 & 0x0E, ticks >> 22 & 255, 0x01 | ticks >> 14 & 0xFE, ticks >> 7 & 255, 0x01 | ticks << 1 & 0xFE])


def mux(payload: bytes) -> Iterator[bytes]:
    """Packets of a stream of payload, whose size is a multiple of UNIT. An elementary packet holds up to UNITS units."""
    tables = stream = 0
    for n, at in enumerate(range(0, len(payload), UNIT * UNITS)):
        own = payload[at : at + UNIT * UNITS]
        access = n % RANDOM_ACCESS_EVERY == 0
        if access:
            for pid, section in ((PAT_PID, _PAT), (PMT_PID, _PMT)):
                yield _packet(pid, True, tables, section + b"\xff" * (184 - len(section)))
            tables = tables + 1 & 15
        data = b"\0\0\1" + bytes([PRIVATE_STREAM_1]) + (len(own) + 8).to_bytes(2, "big") + b"\x84\x80\x05" + _timestamp(n * TICKS) + own
        size = 176 if access else 184
        yield _packet(STREAM_PID, True, stream, data[:size], *((0x50, _clock(n * TICKS)) if access else ()))
        stream = stream + 1 & 15
        for i in range(size, len(data), 184):
            yield _packet(STREAM_PID, False, stream, data[i : i + 184])
            stream = stream + 1 & 15


class Stream(NamedTuple):
    payload: bytes
    packets: int
    programs: int
    #: Places where packets are lost or out of order, without the sync byte or marked as damaged.
    counter_errors: int
    bad_tables: int
    timestamps: list[int]
    #: Indexes of the elementary packets at which decoding can begin.
    random_access: list[int]
    #: Clock references in 90 kHz ticks.
    clocks: list[int]
    #: Elementary packets of which the end is missing.
    cut_short: int


class Sections:
    """Table sections of one PID, put together from its packets."""

    def __init__(self) -> None:
        self.held = b""
        self.open = False

    def add(self, payload: bytes, start: bool, whole: bool) -> list[bytes | None]:
        """Bodies of the sections that payload ends, None for each of a bad checksum; whole: no packet was lost before."""
        if not whole:
            self.open, self.held = False, b""
        out: list[bytes | None] = []
        if start:
            at = 1 + payload[0]
            if self.open:
                self.held += payload[1:at]
                out += self._ended()
            self.held, self.open = payload[at:], True
        elif self.open:
            self.held += payload
        else:
            return out
        return out + self._ended()

    def _ended(self) -> list[bytes | None]:
        out: list[bytes | None] = []
        while len(self.held) >= 3 and self.held[0] != 0xFF:
            size = 3 + (int.from_bytes(self.held[1:3], "big") & 0xFFF)
            if len(self.held) < size:
                return out
            own, self.held = self.held[:size], self.held[size:]
            out.append(own[8:-4] if size > 12 and crc_mpeg(own) == 0 else None)
        if self.held[:1] == b"\xff":  # stuffing to the packet's end
            self.held, self.open = b"", False
        return out


def _elementary(pes: bytes) -> tuple[bytes, int | None, bool] | None:
    """Payload, timestamp and whether it is all there, of an elementary packet; None if it is none or padding."""
    if pes[:3] != b"\0\0\1" or len(pes) < 6 or pes[3] == PADDING:
        return None
    size = int.from_bytes(pes[4:6], "big")
    end = 6 + size if size else len(pes)
    if pes[3] in BARE:
        return pes[6:end], None, len(pes) >= end
    if len(pes) < 9:
        return None
    time = None
    if pes[7] & 0x80 and len(pes) >= 14:
        t = pes[9:14]
        time = (t[0] & 0x0E) << 29 | t[1] << 22 | (t[2] & 0xFE) << 14 | t[3] << 7 | t[4] >> 1
    return pes[9 + pes[8] : end], time, len(pes) >= end


def demux(data: bytes) -> Stream:
    """The elementary stream of the first program: its first with private data, else its first."""
    programs: dict[int, int] = {}
    wanted: int | None = None
    last: dict[int, tuple[int, bytes, bool]] = {}  # counter, payload, whether it came twice
    tables: dict[int, Sections] = {}
    errors = bad = packets = short = 0
    held: list[bytes] = []
    parts: list[bytes] = []
    times: list[int] = []
    accesses: list[int] = []
    clocks: list[int] = []

    def flush() -> None:
        nonlocal short
        found = _elementary(b"".join(held)) if held else None
        held.clear()
        if found:
            payload, time, whole = found
            short += not whole
            parts.append(payload)
            if time is not None:
                times.append(time)

    for at in range(0, len(data), PACKET):
        p = data[at : at + PACKET]
        packets += 1
        if len(p) < PACKET or p[0] != SYNC or p[1] & 0x80:
            errors += 1
            continue
        pid, start, kind, count = (p[1] & 0x1F) << 8 | p[2], p[1] & 0x40, p[3] & 0x30, p[3] & 15
        if pid == NULL_PID:
            continue
        body = 4
        flags = 0
        if kind & 0x20:
            body = 5 + p[4]
            flags = p[5] if p[4] else 0
        payload = p[body:]
        if not kind & 0x10 or not payload:
            continue
        whole = True
        if pid in last and not flags & 0x80:
            before, same, twice = last[pid]
            if count == before and payload == same and not twice:
                last[pid] = count, payload, True
                continue
            whole = count == before + 1 & 15
            errors += not whole
        last[pid] = count, payload, False
        if flags & 0x10 and len(p) > 11 and p[4] >= 7:
            clocks.append(int.from_bytes(p[6:12], "big") >> 15)
        if pid == wanted:
            if start:
                flush()
                if flags & 0x40:
                    accesses.append(len(parts))
            held.append(payload)
        elif pid == PAT_PID or pid in programs:
            for s in tables.setdefault(pid, Sections()).add(payload, bool(start), whole):
                if s is None:
                    bad += 1
                elif pid == PAT_PID:
                    pairs = [(int.from_bytes(s[i : i + 2], "big"), int.from_bytes(s[i + 2 : i + 4], "big") & 0x1FFF) for i in range(0, len(s) - 3, 4)]
                    programs |= {where: number for number, where in pairs if number}
                elif wanted is None:
                    kinds = []
                    i = 4 + (int.from_bytes(s[2:4], "big") & 0xFFF)
                    while i + 5 <= len(s):
                        kinds.append((s[i] != PRIVATE_DATA, len(kinds), int.from_bytes(s[i + 1 : i + 3], "big") & 0x1FFF))
                        i += 5 + (int.from_bytes(s[i + 3 : i + 5], "big") & 0xFFF)
                    wanted = min(kinds)[2] if kinds else None
    flush()
    return Stream(b"".join(parts), packets, len(programs), errors, bad, times, accesses, clocks, short)


def feature(s: Stream) -> str:
    ends = f"{s.timestamps[0]}..{s.timestamps[-1]}" if s.timestamps else "none"
    return f"mpegts packets={s.packets} programs={s.programs} pes={len(s.timestamps)} pts={ends} clocks={len(s.clocks)} random_access={len(s.random_access)} counter_errors={s.counter_errors} bad_tables={s.bad_tables} cut_short={s.cut_short}"


def padded(data: bytes) -> bytes:
    """data with spaces up to a positive multiple of UNIT."""
    return data + b" " * (max(1, -(-len(data) // UNIT)) * UNIT - len(data))


def streams(docs: DataFrame, media: bool = True) -> DataFrame:
    """One row per document: doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature,
    timestamps and random_access, and, if asked for, media, the stream itself.

    docs needs doc_id and text; other columns are ignored. Null is an empty text, which is stored
    as one unit of spaces. The payload's figures are those of what demux reads back. Equal texts
    have equal streams; an empty table gives no rows.
    """
    fields = [("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()), ("timestamps", pa.list_(pa.int64())), ("random_access", pa.list_(pa.int64())), ("media", pa.binary())][: 10 if media else 9]

    @lean
    def run(batches: Batches) -> Batches:
        for batch in batches:
            rows = []
            for data in utf8(batch.column("text")):
                stored = b"".join(mux(padded(data)))
                s = demux(stored)
                rows.append((len(data), len(s.payload), hashlib.sha256(s.payload).hexdigest(), zlib.crc32(s.payload[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), feature(s), s.timestamps, s.random_access, stored)[: len(fields)])
            columns = list(zip(*rows, strict=True)) or [()] * len(fields)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, k) for x, (_, k) in zip(columns, fields, strict=True))], names=["doc_id", *(n for n, _ in fields)])

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, timestamps array<long>, random_access array<long>"
    return docs.select("doc_id", "text").mapInArrow(run, schema + ", media binary" * media)

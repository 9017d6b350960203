"""MPEG audio columns: frame headers, tags, variable-bitrate tables, checksums, seek offsets.

``parse`` walks any MPEG-1/2/2.5 stream of layers I to III. ``carry`` writes a stream that
holds bytes losslessly: MPEG-2 layer III frames at 16 kHz mono, each silent (its granule has
no main data) and with 576 payload bytes in its ancillary area, protected by the frame CRC
over header and side information and, in the ancillary area, by a CRC-32 of the payload.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SAMPLES = 576
UNIT = 576

#: Fixed values of ISO/IEC 11172-3 and 13818-3: kbit/s by (MPEG-1?, layer) and index, Hz by version and index.
KBITS = {
    (True, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (True, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (True, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (False, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (False, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (False, 3): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
HERTZ = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}


def _crc16_table() -> np.ndarray:
    table = np.zeros(256, dtype=np.uint16)
    for k in range(256):
        word = k << 8
        for _ in range(8):
            word = (word << 1) ^ (0x8005 if word & 0x8000 else 0)
        table[k] = word & 0xFFFF
    return table


CRC16 = _crc16_table()


def crc16(data: bytes, start: int = 0xFFFF, bits: int | None = None) -> int:
    """The standard's CRC-16 (polynomial 8005, from all ones) of the first ``bits`` bits, or of all."""
    word = start
    whole, rest = divmod(8 * len(data) if bits is None else bits, 8)
    for byte in data[:whole]:
        word = ((word << 8) & 0xFFFF) ^ int(CRC16[(word >> 8) ^ byte])
    for k in range(rest):
        bit = data[whole] >> 7 - k & 1 ^ word >> 15
        word = (word << 1 & 0xFFFF) ^ (0x8005 if bit else 0)
    return word


#: Bits of an allocation field by subband, for layer II (13818-3 low rates; 11172-3 tables B.2a to B.2d).
NBAL = {
    "low": [4] * 4 + [3] * 7 + [2] * 19,
    "a": [4] * 11 + [3] * 12 + [2] * 4,
    "b": [4] * 11 + [3] * 12 + [2] * 7,
    "c": [4] * 2 + [3] * 6,
    "d": [4] * 2 + [3] * 10,
}


def protected_bits(frame: bytes, head: dict) -> int:
    """Bits after the checksum that it covers: side information (III), allocation (I), allocation and scale factor selection (II)."""
    if head["layer"] == 3:
        return 8 * head["side"]
    channels = 1 if head["mono"] else 2
    bound = 4 * (head["extension"] + 1) if head["mode"] == 1 else 32
    if head["layer"] == 1:
        return 4 * (channels * bound + 32 - bound) if channels == 2 else 128
    kbits = head["bits"] // 1000 // channels
    if head["version"] != 3:
        table = NBAL["low"]
    elif 0 < kbits <= 48:
        table = NBAL["d" if head["hertz"] == 32000 else "c"]
    else:
        table = NBAL["a" if head["hertz"] == 48000 or 0 < kbits <= 80 else "b"]
    stream, at, used = int.from_bytes(frame[6:166], "big"), 0, 0
    width = 8 * len(frame[6:166])
    for k, size in enumerate(table):
        for _ in range(channels if k < bound else 1):
            used += (channels if k >= bound else 1) * bool(stream >> max(0, width - at - size) & (1 << size) - 1)
            at += size
    return at + 2 * used


def header(word: int) -> dict | None:
    """A frame header's fields, or None when the 32 bits cannot be one. A free format's ``size`` is 0: the stream tells it."""
    version, layer, rate, hz = word >> 19 & 3, 4 - (word >> 17 & 3), word >> 12 & 15, word >> 10 & 3
    if word >> 21 != 0x7FF or version == 1 or layer == 4 or rate == 15 or hz == 3 or word & 3 == 2:
        return None
    one, hertz = version == 3, HERTZ[version][hz]
    bits, pad = KBITS[one, layer][rate] * 1000, word >> 9 & 1
    samples = 384 if layer == 1 else 1152 if one or layer == 2 else 576
    size = 0 if not rate else (12 * bits // hertz + pad) * 4 if layer == 1 else samples // 8 * bits // hertz + pad
    mono = word >> 6 & 3 == 3
    side = (0 if layer != 3 else (17 if mono else 32) if one else (9 if mono else 17))
    return {"version": version, "layer": layer, "bits": bits, "hertz": hertz, "size": size, "samples": samples, "mono": mono, "side": side, "crc": not word >> 16 & 1, "mode": word >> 6 & 3, "extension": word >> 4 & 3, "pad": pad * (4 if layer == 1 else 1)}


#: Most bytes of a free-format frame (layer I at 448 kbit/s and 32 kHz would take 672; rates beyond the tables some more).
FREE_BYTES = 8192


def _free_size(data: bytes, at: int, head: dict, kind: tuple) -> int:
    """Bytes without padding of a free-format frame at ``at``: as far as the next header of the kind that another one, or the end, follows as far on."""
    p = at + 4
    while 0 <= (p := data.find(b"\xff", p + 1, at + FREE_BYTES)):
        after = header(int.from_bytes(data[p : p + 4], "big")) if p + 4 <= len(data) else None
        if after and not after["size"] and (after["version"], after["layer"], after["hertz"]) == kind:
            size = p - at - head["pad"]
            third = p + size + after["pad"]
            again = header(int.from_bytes(data[third : third + 4], "big")) if third + 4 <= len(data) else None
            if third == len(data) or again and (again["version"], again["layer"], again["hertz"]) == kind:
                return size
    return 0


def _tag_size(data: bytes, at: int) -> int:
    """Bytes of an ID3v2 tag at ``at``, header and footer included; 0 when there is none."""
    head = data[at : at + 10]
    if len(head) < 10 or head[:3] != b"ID3" or head[3] == 0xFF or any(b & 0x80 for b in head[6:10]):
        return 0
    size = 0
    for b in head[6:10]:
        size = size << 7 | b
    return 10 + size + (10 if head[5] & 0x10 else 0)


def _tag_frames(tag: bytes) -> dict[str, str]:
    """Text frames of an ID3v2.3 or 2.4 tag."""
    out, at, four = {}, 10, tag[3] == 4
    while at + 10 <= len(tag) and tag[at : at + 4].strip(b"\0"):
        name = tag[at : at + 4].decode("latin-1")
        raw = tag[at + 4 : at + 8]
        size = sum((b & 127) << 7 * k for k, b in enumerate(reversed(raw))) if four else int.from_bytes(raw, "big")
        body = tag[at + 10 : at + 10 + size]
        if name.startswith("T") and body:
            coding = {0: "latin-1", 1: "utf-16", 2: "utf-16-be", 3: "utf-8"}.get(body[0], "latin-1")
            out[name] = body[1:].decode(coding, "replace").rstrip("\0")
        at += 10 + size
    return out


#: Encoders whose name opens the extension of a Xing or Info table.
_ENCODERS = (b"LAME", b"Lavf", b"Lavc", b"GOGO")


def _rate_table(frame: bytes, head: dict) -> dict | None:
    """The Xing/Info or VBRI table in a stream's first frame."""
    at = 4 + head["side"]
    if frame[at : at + 4] in (b"Xing", b"Info"):
        kind, flags, at = frame[at : at + 4].decode(), int.from_bytes(frame[at + 4 : at + 8], "big"), at + 8
        out: dict = {"kind": kind, "frames": None, "bytes": None, "toc": None}
        for bit, name in ((1, "frames"), (2, "bytes")):
            if flags & bit:
                out[name], at = int.from_bytes(frame[at : at + 4], "big"), at + 4
        if flags & 4:
            out["toc"], at = list(frame[at : at + 100]), at + 100
        at += 4 * bool(flags & 8)
        if frame[at : at + 4] in _ENCODERS:  # 12 bits each of samples before and after the sound
            trim = int.from_bytes(frame[at + 21 : at + 24], "big")
            out |= {"delay": trim >> 12, "padding": trim & 0xFFF}
        return out
    if frame[36:40] == b"VBRI":
        return {"kind": "VBRI", "bytes": int.from_bytes(frame[46:50], "big"), "frames": int.from_bytes(frame[50:54], "big"), "toc": None}
    return None


def parse(data: bytes) -> dict:
    """Frames, tags, table, checksum results, exact duration and byte offset of every frame.

    Junk between frames is skipped: a frame counts where a valid header stands at the end of
    the frame before, or, after a loss of sync, where a valid header is followed by another
    consistent one (or by the end of the data). An ID3v1 tag counts only where no frame covers
    its start. Checksums are verified in all three layers; a free format's frame size is measured from
    its headers. ``seconds`` leaves out the encoder's delay and padding where the table states
    them. Empty input has no frames and lasts 0 s.
    """
    free = 0
    offsets, samples, at, lost, checked, wrong, tags, table, first = [], 0, 0, 0, 0, 0, {}, None, None
    n = len(data)
    tag = n - 128 if n >= 128 and data[n - 128 : n - 125] == b"TAG" else n
    synced = False

    def at_header(p: int) -> dict | None:
        return header(int.from_bytes(data[p : p + 4], "big")) if p + 4 <= n else None

    def kind(head: dict) -> tuple:
        return head["version"], head["layer"], head["hertz"]

    while at < n and at != tag:  # "TAG" inside a frame is no tag
        size = _tag_size(data, at)
        if size:
            tags |= _tag_frames(data[at : at + size])
            at += size
            continue
        head = at_header(at)
        if head and not head["size"]:
            free = free or _free_size(data, at, head, kind(head))
            head = head | {"size": free + head["pad"]} if free else None
        if head and at + head["size"] <= n and first in (None, kind(head)):
            follow = at + head["size"]
            cut = tag < follow < n  # a frame cut short by the tag, unless another frame follows
            after = at_header(follow) if cut or not synced else None
            if synced and not cut or follow in (tag, n) or _tag_size(data, follow) or after and kind(after) == kind(head):
                frame, opening, first, synced = data[at:follow], first is None, kind(head), True
                table = _rate_table(frame, head) if opening and head["layer"] == 3 else table
                if not (opening and table):  # the table's frame holds no sound
                    if head["crc"]:
                        checked += 1
                        side = protected_bits(frame, head)
                        wrong += crc16(frame[2:4] + frame[6 : 6 + -(-side // 8)], bits=16 + side) != int.from_bytes(frame[4:6], "big")
                    offsets.append(at)
                    samples += head["samples"]
                at = follow
                continue
        synced = False
        places = [p for p in (data.find(b"\xff", at + 1), data.find(b"ID3", at + 1)) if p >= 0]
        past = min([*places, tag if at < tag else n])
        lost, at = lost + past - at, past
    hertz = first[2] if first else 0
    played = max(0, samples - (table or {}).get("delay", 0) - (table or {}).get("padding", 0))
    return {"offsets": offsets, "samples": samples, "hertz": hertz, "lost": lost, "checked": checked, "wrong": wrong, "tags": tags, "table": table, "seconds": played / hertz if hertz else 0.0}


# -- carrying bytes ------------------------------------------------------------------

_HEAD = 0xFFF20000 | 0xD << 12 | 2 << 10 | 3 << 6  # MPEG-2, layer III, with CRC, 144 kbit/s, 16 kHz, mono
_FRAME = header(_HEAD)
_SIZE, _SIDE = _FRAME["size"], _FRAME["side"]
_AT = 6 + _SIDE
_FIXED = struct.pack(">I", _HEAD)
_START = _FIXED + struct.pack(">H", crc16(_FIXED[2:] + bytes(_SIDE))) + bytes(_SIDE)


def pad(data: bytes) -> bytes:
    """``data`` and bytes 255 up to a positive multiple of 576."""
    return data + b"\xff" * (UNIT - len(data) % UNIT if len(data) % UNIT or not data else 0)


def carry(payload: bytes, title: str = "payload") -> bytes:
    """A stream that holds ``payload`` (a multiple of 576 bytes): ID3v2.4 tag, Xing frame, one frame per 576 bytes."""
    n = len(payload) // UNIT
    body = b"TIT2" + bytes([0, 0, 0, len(title) + 1, 0, 0, 3]) + title.encode("ascii")
    tag = b"ID3\x04\x00\x00" + bytes([len(body) >> 21 & 127, len(body) >> 14 & 127, len(body) >> 7 & 127, len(body) & 127]) + body
    plain = struct.pack(">I", _HEAD | 1 << 16)  # the table's frame has no CRC
    toc = bytes(min(255, (256 * (k * n // 100 + 1)) // (n + 1)) for k in range(100))
    xing = plain + bytes(_SIDE) + b"Xing" + struct.pack(">III", 7, n, (n + 1) * _SIZE) + toc
    rows = np.zeros((n, _SIZE), dtype=np.uint8)
    rows[:, : len(_START)] = np.frombuffer(_START, dtype=np.uint8)
    rows[:, _AT : _AT + UNIT] = np.frombuffer(payload, dtype=np.uint8).reshape(n, UNIT)
    sums = np.array([zlib.crc32(payload[k : k + UNIT]) for k in range(0, len(payload), UNIT)], dtype=">u4")
    rows[:, _AT + UNIT : _AT + UNIT + 4] = sums.view(np.uint8).reshape(n, 4)
    return tag + xing + bytes(_SIZE - len(xing)) + rows.tobytes()


def uncarry(media: bytes, found: dict) -> tuple[bytes, int]:
    """The payload and the number of units whose CRC-32 fails, read at the parsed offsets."""
    parts, wrong = [], 0
    for at in found["offsets"]:
        part = media[at + _AT : at + _AT + UNIT]
        wrong += zlib.crc32(part) != int.from_bytes(media[at + _AT + UNIT : at + _AT + UNIT + 4], "big")
        parts.append(part)
    return b"".join(parts), wrong


def store_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", media: bool = True) -> DataFrame:
    """Per row: id, the stored stream with its parsed columns, and digests of what was read back.

    Null text counts as empty; the payload of an empty text is 576 bytes of 255. Equal texts
    give equal values. Rows are independent (nulls, ties and repeated rows need no rule beyond
    that), an empty table gives an empty one, other columns are ignored. With ``media=False``
    the stream itself is left out of the result. One row at a time is in memory, no exchange.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, seconds double, offsets array<long>" + ", media binary" * media

    def one(text: str | None) -> list:
        raw = (text or "").encode("utf-8")
        stream = carry(pad(raw))
        found = parse(stream)
        back, wrong = uncarry(stream, found)
        seek = hashlib.md5(np.array(found["offsets"], dtype="<i8").tobytes()).hexdigest()
        feature = json.dumps({"crc": [found["checked"], found["wrong"] + wrong], "frames": len(found["offsets"]), "lost": found["lost"], "seconds": round(found["seconds"], 6), "seek_md5": seek, "table": (found["table"] or {}).get("frames"), "title": found["tags"].get("TIT2")}, sort_keys=True, separators=(",", ":"))
        row = [len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(stream), hashlib.sha256(stream).hexdigest(), feature, found["seconds"], found["offsets"]]
        return row + [stream] if media else row

    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(pa.int64())] + [pa.binary()] * media

    def run(batches):
        for batch in batches:
            for part in range(0, batch.num_rows, 256):
                cut = batch.slice(part, 256)
                rows = [one(t) for t in cut.column(1).to_pylist()]
                columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
                names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "seconds", "offsets"] + ["media"] * media
                yield pa.RecordBatch.from_arrays([cut.column(0), *columns], names=[id_col, *names])

    return docs.select(id_col, text_col).mapInArrow(run, schema)

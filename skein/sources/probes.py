"""Capture times read from the bytes of media files: containers (MP4, QuickTime) and EXIF (JPEG, TIFF)."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Seconds from 1904 to 1970; boxes that hold boxes; EXIF tags of the time taken, the time changed, the model, the sub-directory.
EPOCH_1904 = 2_082_844_800
NESTED = (b"moov", b"udta", b"trak", b"mdia")
TAKEN, CHANGED, MODEL, SUB = 36867, 306, 272, 34665


def boxes(data: bytes, at: int = 0, end: int | None = None):
    """(kind, content start, content end) of the boxes in a stretch; ends at the first that cannot be one."""
    end = len(data) if end is None else end
    while at + 8 <= end:
        size, kind, head = int.from_bytes(data[at : at + 4], "big"), data[at + 4 : at + 8], 8
        if size == 1:
            size, head = int.from_bytes(data[at + 8 : at + 16], "big"), 16
        size = size or end - at
        if size < head:
            return
        yield kind, at + head, min(at + size, end)
        at += size


def _tags(data: bytes, start: int, end: int) -> dict[str, str]:
    """Key and value pairs of a QuickTime ``meta`` box, keys in lower case."""
    if data[start : start + 4] == bytes(4):  # a full box, with version and flags
        start += 4
    parts = {kind: (a, b) for kind, a, b in boxes(data, start, end)}
    if b"keys" not in parts or b"ilst" not in parts:
        return {}
    a, b = parts[b"keys"]
    keys, at = [], a + 8
    while at + 8 <= b:
        size = max(8, int.from_bytes(data[at : at + 4], "big"))
        keys.append(data[at + 8 : at + size].decode("utf-8", "replace").lower())
        at += size
    out = {}
    for kind, x, y in boxes(data, *parts[b"ilst"]):
        index = int.from_bytes(kind, "big")
        for inner, p, q in boxes(data, x, y):
            if inner == b"data" and 1 <= index <= len(keys):
                out[keys[index - 1]] = data[p + 8 : q].decode("utf-8", "replace")
    return out


def probe_container(data: bytes) -> tuple[float | None, str | None, str | None]:
    """(seconds, raw time, model) of an MP4 or QuickTime file; the QuickTime date goes before the movie header's. Nones where it tells nothing."""
    seconds = made = None
    tags: dict[str, str] = {}
    todo = [(0, len(data))]
    while todo:
        for kind, a, b in boxes(data, *todo.pop()):
            if kind == b"mvhd":
                long = data[a : a + 1] == b"\1"
                at, width = (a + 4, 8) if long else (a + 4, 4)
                number = lambda p, n: int.from_bytes(data[p : p + n], "big")
                when, scale, lasts = number(at, width), number(at + 2 * width, 4), number(at + 2 * width + 4, width)
                seconds = lasts / scale if scale else None
                made = str(pd.Timestamp(when - EPOCH_1904, unit="s", tz="UTC").strftime("%Y-%m-%dT%H:%M:%SZ")) if when > EPOCH_1904 else None
            elif kind == b"meta":
                tags |= _tags(data, a, b)
            elif kind in NESTED:
                todo.append((a, b))
    return seconds, tags.get("com.apple.quicktime.creationdate") or made, tags.get("com.apple.quicktime.model")


def _directory(data: bytes, at: int, order: str) -> dict[int, object]:
    """Numbers and texts of one directory of a TIFF structure."""
    if at + 2 > len(data):
        return {}
    out: dict[int, object] = {}
    for k in range(struct.unpack_from(order + "H", data, at)[0]):
        entry = at + 2 + 12 * k
        if entry + 12 > len(data):
            break
        tag, kind, count, value = struct.unpack_from(order + "HHII", data, entry)
        if kind == 2:
            start = entry + 8 if count <= 4 else value
            out[tag] = data[start : start + count].split(b"\0")[0].decode("latin-1").strip()
        elif kind in (3, 4):
            out[tag] = value if kind == 4 else struct.unpack_from(order + "H", data, entry + 8)[0]
    return out


def probe_exif(data: bytes) -> tuple[str | None, str | None]:
    """(raw time, model) of a JPEG or TIFF file: the time taken, else changed, else taken as the sub-directory has it."""
    tiff = data if data[:4] in (b"II*\0", b"MM\0*") else b""
    at = 2
    while not tiff and data[:2] == b"\xff\xd8" and at + 4 <= len(data) and data[at] == 0xFF:
        size = int.from_bytes(data[at + 2 : at + 4], "big")
        if data[at + 1] == 0xE1 and data[at + 4 : at + 10] == b"Exif\0\0":
            tiff = data[at + 10 : at + 2 + size]
        at += 2 + size
    if len(tiff) < 8:
        return None, None
    order = "<" if tiff[:2] == b"II" else ">"
    top = _directory(tiff, struct.unpack_from(order + "I", tiff, 4)[0], order)
    sub = _directory(tiff, top[SUB], order) if isinstance(top.get(SUB), int) else {}
    raw = top.get(TAKEN) or top.get(CHANGED) or sub.get(TAKEN)
    return (str(raw) if raw else None), (str(top[MODEL]) if top.get(MODEL) else None)


def probe(files: DataFrame) -> DataFrame:
    """path, duration_s, creation_raw, model, error of ``binaryFile`` rows (path, content).

    Containers are told by their first box, pictures by their first bytes; other files and null contents have nulls. An
    unreadable file is a row with ``error``, never a failed job. A file is one row in one
    task: choose by name (:func:`skein.sources.readers.file_kind`) before reading contents.
    """

    def run(frames):
        for frame in frames:
            rows = []
            for path, content in zip(frame["path"], frame["content"], strict=True):
                row = [path, None, None, None, None]
                try:
                    data = b"" if content is None else bytes(content)
                    if data[4:8] in (b"ftyp", b"moov", b"mdat", b"wide", b"free"):
                        row[1:4] = probe_container(data)
                    elif data[:2] == b"\xff\xd8" or data[:4] in (b"II*\0", b"MM\0*"):
                        row[2:4] = probe_exif(data)
                except (struct.error, ValueError, IndexError) as failed:
                    row[4] = f"unreadable: {failed}"
                rows.append(row)
            yield pd.DataFrame(rows, columns=["path", "duration_s", "creation_raw", "model", "error"])

    return files.select("path", F.col("content")).mapInPandas(run, "path string, duration_s double, creation_raw string, model string, error string")

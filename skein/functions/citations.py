"""Time citations in notes: a grammar for ``(V1 04:22-04:31, 06:13)`` and its relatives."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql.functions import udtf
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructType

#: Extensions of cited media; marks that may stand between times, and those among them that make a range.
MEDIA = "MTS mts mp4 MP4 mov MOV m2ts M2TS avi AVI mp3 MP3 m4a M4A wav WAV aac AAC".split()
BETWEEN, RANGE = r",;/、；，→和及~\-–—", r"~\-–—"

#: A parenthesis with a clock in it, perhaps between backticks.
CANDIDATE = r"\(([^()`]*\d{1,2}:\d{2}[^()`]*)\)"
#: One cited time: a label (a letter and digits, or a media file's name) or none, a mark for rough times or none, the clock.
TIME = re.compile(
    rf"""(?: (?P<code>[A-Za-z]\d+) | (?P<file>[^,;/、；，→~–—:\n()]+?\.(?:{"|".join(MEDIA)})) )?
    \s* (?P<rough>(?:⚠️?\s*)?approx\s*)? (?P<a>\d{{1,3}}) : (?P<b>[0-5]\d) (?: : (?P<c>[0-5]\d) )?""",
    re.VERBOSE,
)
_GAP = re.compile(rf"[\s{BETWEEN}]*")
_NOTE = re.compile(r"[^:()]*")
_SECONDS = re.compile(rf"[{RANGE}]([0-5]?\d)")


def has_candidate(note: Column) -> Column:
    """Whether a note can hold a citation at all; most texts go no further."""
    return note.rlike(CANDIDATE)


def _clock(m: re.Match) -> int:
    parts = [int(m[k]) for k in "abc" if m[k] is not None]
    return parts[0] * 3600 + parts[1] * 60 + parts[2] if len(parts) == 3 else parts[0] * 60 + parts[1]


def parse_group(inner: str, only_file: str | None = None, known: set[str] | None = None) -> list[tuple]:
    """(label, start seconds, end seconds or None, approximate) of one parenthesis; [] when it is not a citation.

    Between times and behind the last only list and range marks may stand; a range's end may be seconds
    alone (``28:30-42``). Before the first time a note without a colon may stand. A time
    without a label takes the one before, at first the segment's only file. A range that names
    no second file is one citation; one that does is two. With ``known``, a label that is not in it
    makes the whole no citation.
    """
    times = list(TIME.finditer(inner))
    if not times:
        return []
    gaps = [inner[m.end() : n.start()] for m, n in zip(times, times[1:], strict=False)]
    rest = inner[times[-1].end() :]
    seconds = _SECONDS.fullmatch(rest)
    if not _NOTE.fullmatch(inner[: times[0].start()]) or not all(map(_GAP.fullmatch, gaps)) or not (seconds or _GAP.fullmatch(rest)):
        return []
    found: list[list] = []
    label = only_file
    for m, gap in zip(times, ["", *gaps], strict=True):
        named = m["code"] or (m["file"] or "").strip()
        label = named or label
        if not label or (known is not None and label not in known):
            return []
        if found and not named and re.search(f"[{RANGE}]", gap):
            found[-1][2] = _clock(m)
        else:
            found.append([label, _clock(m), None, bool(m["rough"])])
    if seconds:
        last = found[-1][1] if found[-1][2] is None else found[-1][2]
        found[-1][2] = last - last % 60 + int(seconds[1])
    return [tuple(x) for x in found]


def citations(note: str, only_file: str | None = None, known: set[str] | None = None) -> list[tuple]:
    return [row for m in re.finditer(CANDIDATE, note or "") for row in parse_group(m[1], only_file, known)]


ROW = StructType().add("label", StringType()).add("start_s", IntegerType()).add("end_s", IntegerType()).add("approx", BooleanType())


@udtf(returnType=ROW)
class Citations:
    """Rows of every citation in a text. Give it only texts that :func:`has_candidate`."""

    def eval(self, text: str, only_file: str):
        yield from citations(text, only_file)

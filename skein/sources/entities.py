"""Entity tables derived from the driver tables; each has the SQL of the same rows beside it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Slides of a clip, and seconds that a slide stands for.
SLIDES_PER_CLIP, SLIDE_SECONDS = 8, 15


def segments(conversations: DataFrame) -> DataFrame:
    """Transcript segments: clip, seg_idx, text, start_ms, end_ms; a text lasts a second per 15 characters."""
    before = Window.partitionBy("clip").orderBy("seg_idx").rowsBetween(Window.unboundedPreceding, -1)
    rows = conversations.select(F.col("conv_id").alias("clip"), F.col("turn").alias("seg_idx"), "role", "text", F.expr("length(text) * 1000L div 15").alias("dur_ms"))
    rows = rows.withColumn("start_ms", F.coalesce(F.sum("dur_ms").over(before), F.lit(0)).cast("long"))
    return rows.withColumn("end_ms", F.col("start_ms") + F.col("dur_ms"))


SEGMENTS = """segments AS (SELECT *, start_ms + dur_ms AS end_ms FROM (
  SELECT conv_id AS clip, turn AS seg_idx, role, text, length(text) * 1000 // 15 AS dur_ms,
         coalesce(sum(length(text) * 1000 // 15) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start_ms
  FROM conversations))"""


def slides(documents: DataFrame) -> DataFrame:
    """Slides: slide_id from 1, clip, pos, start_s (first at 0), end_s, quick_text, source, lang."""
    pos = F.col("doc_id") % SLIDES_PER_CLIP
    return documents.select(
        (F.col("doc_id") + 1).alias("slide_id"),
        F.expr(f"doc_id div {SLIDES_PER_CLIP}").alias("clip"),
        pos.alias("pos"),
        (pos * SLIDE_SECONDS).alias("start_s"),
        ((pos + 1) * SLIDE_SECONDS).alias("end_s"),
        F.col("text").alias("quick_text"),
        "source",
        "lang",
    )


SLIDES = f"""slides AS (SELECT doc_id + 1 AS slide_id, doc_id // {SLIDES_PER_CLIP} AS clip, doc_id % {SLIDES_PER_CLIP} AS pos,
  doc_id % {SLIDES_PER_CLIP} * {SLIDE_SECONDS} AS start_s, (doc_id % {SLIDES_PER_CLIP} + 1) * {SLIDE_SECONDS} AS end_s, text AS quick_text, source, lang FROM documents)"""


def spans(events: DataFrame, cap: int = 4 * 3600) -> DataFrame:
    """Recordings: one per event, from its second to the user's next event, at most ``cap`` seconds; whole seconds."""
    after = Window.partitionBy("user_id").orderBy("ts", "event_id")
    start = F.expr("cast(floor(unix_micros(cast(ts as timestamp)) / 1000000) as bigint)")
    rows = events.select("event_id", "user_id", "event_type", "value", start.alias("start_s"), F.lead(start).over(after).alias("_next"))
    end = F.least(F.coalesce("_next", F.col("start_s") + cap), F.col("start_s") + cap)
    return rows.withColumn("end_s", end).drop("_next")


SPANS = """spans AS (SELECT event_id, user_id, event_type, value, start_s, least(coalesce(lead(start_s) OVER (PARTITION BY user_id ORDER BY ts, event_id), start_s + 14400), start_s + 14400) AS end_s
  FROM (SELECT *, epoch_us(ts) // 1000000 AS start_s FROM events))"""


def note_lines(documents: DataFrame) -> DataFrame:
    """Lines of notes: note, line_no (from 0), line."""
    return documents.select(F.col("doc_id").alias("note"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


NOTE_LINES = """note_lines AS (SELECT doc_id AS note, i - 1 AS line_no, l[i] AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents), unnest(range(1, len(l) + 1)) AS u(i))"""


#: What a note of the audit may hold besides a document's text: before it, and after it.
NOTE_HEAD = [
    "---\ntags: a\n---\n", "---\nkey: 1\n---\n", "# L3 Title\n", "# 總整理\n![[f1.jpg|600]]\n", "# seg 03 title\n", "# 逐段筆記\n", "# Topic `Smith 2020`\n", "# Background\nPrognosis 併發症\n",
    "# Evaluation\n# Management\n## ⭐ algorithm\n", "# Management\n## drugs\n", "> [!summary] Pearls\n", "## empty\n\n## next\n",
]
NOTE_TAIL = [
    "\n# Resource\n", "\n![[f1.jpg|600]]\n![[figures/f2.png]]\n\n> a caption\n![[f3.jpg|300]]\n*after*\n", "\n[[_HUB_x]] [[L2_seg01_a]] [[L3_seg09_z|alias]]\n", "\n縮寫 table\n| a | b |\n", "\n- said (V1 01:02)\n  - deeper\n",
    "\n的==中文== and ==a<b==\n", "\n| [[a|b]] |\n| 1 |\n| 2 |\ntext\n| [[a|b]] |\n| 1 |\n| 2 |\n", "\n[!todo] 屍體 GRF\n", "\n```\ncode\n```\n", "\n🗣️ (citation 3) 各段 GRF (ground)\n", "\n> [!figure] " + "long title " * 5 + "\n> ![[f1.jpg]]\n", "\n- " + "字" * 60 + "\n",
]
_PATHS = ["/c/L3/L3_seg01_a.md", "/c/L2/L2_seg01_a.md", "/c/_HUB_c.md", "/c/notes/x.md", "/c/L3/overview.md", "/c/L2/q.md"]
_MODES, _TEMPLATES = ["lecture-seg", "lecture", "textbook", "lecture-seg", "textbook"], ["disease", "exam", "tool", "atlas"]
NOTE_FILES = ["/c/L2/L2_seg01_a.md", "figures/f1.jpg", "figures/f2.png"]


def _cycle(items: list[str], by: int):
    return F.element_at(F.array(*map(F.lit, items)), (F.col("doc_id") % by % len(items)).cast("int") + 1)


def audit_notes(documents: DataFrame) -> DataFrame:
    """Notes for the audit: note, mode, template, path, text (a document's whole text among parts chosen by its id)."""
    part = lambda k, x: F.when(F.col("doc_id") * (k + 3) % 11 < 3, F.lit(x)).otherwise("")
    head = [part(k, x) for k, x in enumerate(NOTE_HEAD)]
    tail = [part(k + 20, x) for k, x in enumerate(NOTE_TAIL)]
    return documents.select(F.col("doc_id").alias("note"), _cycle(_MODES, 35).alias("mode"), _cycle(_TEMPLATES, 48).alias("template"), _cycle(_PATHS, 66).alias("path"), F.concat(*head, F.coalesce("text", F.lit("")), *tail).alias("text"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def _sql_cycle(items: list[str], by: int) -> str:
    return "[" + ", ".join(map(_quoted, items)) + f"][doc_id % {by} % {len(items)} + 1]"


def _sql_parts(items: list[str], first: int) -> str:
    return " || ".join(f"CASE WHEN doc_id * {k + first + 3} % 11 < 3 THEN {_quoted(x)} ELSE '' END" for k, x in enumerate(items))


AUDIT_NOTES = f"""notes AS (SELECT doc_id AS note, {_sql_cycle(_MODES, 35)} AS mode, {_sql_cycle(_TEMPLATES, 48)} AS template, {_sql_cycle(_PATHS, 66)} AS path,
  {_sql_parts(NOTE_HEAD, 0)} || coalesce(text, '') || {_sql_parts(NOTE_TAIL, 20)} AS text FROM documents),
lines AS (SELECT note, mode, template, i - 1 AS line_no, l[i] AS line FROM (SELECT note, mode, template, string_split(text, chr(10)) AS l FROM notes), unnest(range(1, len(l) + 1)) AS u(i))"""

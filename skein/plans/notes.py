"""The note audit: structure, lines, sections, references, captions."""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.operators import audit as A
from skein.plans.base import query, table
from skein.sources import entities as E

_CJK = "[\\x{3400}-\\x{9fff}\\x{f900}-\\x{faff}]"
_EMBED = "(?i)!\\[\\[([^\\]|]+\\.(?:jpe?g|png|gif|webp|svg))((?:\\|[^\\]]*)?)\\]\\]"


def _notes(spark, folder):
    return E.audit_notes(table(spark, folder, "documents"))


def _lines(spark, folder):
    notes = _notes(spark, folder)
    return notes.select("note", "mode", "template", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))


def _has(pattern: str) -> str:
    return f"regexp_matches(text, '{pattern}')"


def _level(bad: str, worst: str) -> str:
    return f"CASE WHEN {bad} THEN '{worst}' ELSE 'PASS' END"


_LEFT = " OR ".join(f"({_has(chr(92) + 'b' + a + chr(92) + 'b')} AND NOT {_has(a + '[ \\t\\n\\r]*[(]')} AND NOT {_has('[(]' + a + '[)]')} AND NOT {_has('(?m)^.*' + a + '.*[|]')} AND NOT {_has('(?m)^.*[|].*' + a)})" for a in A.RARE)
_TABLE = "(regexp_matches(text, '(?i)縮寫|abbreviation') AND contains(text, '|'))"
_WANTED = " OR ".join(f"(template = '{name}' AND NOT {_has('(?m)^#[ \\t\\n\\r]+' + h + chr(92) + 'b')})" for name, heads in A.TEMPLATES.items() for h in heads)
_NO_HUB = "NOT (contains(text, '課程 Hub') OR contains(text, '[[_HUB_'))"
_STRUCTURE = {
    "resource": ("NOT idx", f"CASE WHEN {_has('(?m)^#[ \\t\\n\\r]+Resource[ \\t\\n\\r]*$')} THEN 'PASS' WHEN kind = 'l3' THEN 'WARN' ELSE 'FAIL' END"),
    "pearls": ("NOT idx", _level(f"NOT {_has('(?m)^>[ \\t\\n\\r]*\\[!summary\\]')}", "FAIL")),
    "tags": ("true", "CASE WHEN regexp_matches(regexp_extract(text, '^(---\\n(?s:.*?)\\n---)', 1), '(?m)^tags:') THEN 'PASS' WHEN idx THEN 'WARN' ELSE 'FAIL' END"),
    "l3_heading": ("kind = 'l3'", _level(f"NOT {_has('(?m)^#[ \\t\\n\\r]+(L3\\b|總整理)')}", "FAIL")),
    "l3_abbreviations": ("kind = 'l3'", _level("NOT contains(text, '縮寫')", "WARN")),
    "hub_backlink": ("kind IN ('l3', 'l2')", _level(_NO_HUB, "WARN")),
    "l2_heading": ("kind = 'l2'", f"CASE WHEN NOT {_has('(?m)^#[ \\t\\n\\r]+[^ \\t\\n\\r]')} THEN 'FAIL' WHEN NOT {_has('(?im)^#[ \\t\\n\\r]+.*seg[ \\t\\n\\r]*[0-9]+')} THEN 'WARN' ELSE 'PASS' END"),
    "l2_timestamps": ("kind = 'l2'", _level(f"NOT {_has('[0-9]{1,2}:[0-9]{2}[)]')}", "FAIL")),
    "hub_table": ("kind = 'hub'", _level(f"NOT {_has('分段|各段|Segmentation|Segments')}", "FAIL")),
    "kind": ("mode = 'lecture-seg' AND kind IS NULL", "'WARN'"),
    "summary_heading": ("mode = 'lecture'", _level(f"NOT {_has('(?m)^#[ \\t\\n\\r]+總整理[ \\t\\n\\r]*$')}", "FAIL")),
    "slides_heading": ("mode = 'lecture'", _level(f"NOT {_has('(?m)^#[ \\t\\n\\r]+(逐投影片筆記|逐段筆記)[ \\t\\n\\r]*$')}", "FAIL")),
    "speaker": ("mode = 'lecture'", _level("NOT contains(text, '🗣️')", "WARN")),
    "template_headings": ("mode = 'textbook' AND template NOT IN ('anatomy', 'atlas')", _level(_WANTED, "FAIL")),
    "citation_placeholder": ("mode = 'textbook'", _level(_has("[(]citation\\b"), "FAIL")),
    "embed_width": ("true", _level(f"len(list_filter(regexp_extract_all(text, '{_EMBED}', 2), lambda x: NOT regexp_matches(x, '[|] *[0-9]+ *([|]|$)'))) > 0", "FAIL")),
    "leftover_todo": ("true", _level("contains(text, '[!todo]')", "FAIL")),
    "forbidden_term": ("true", _level("contains(text, '屍體')", "FAIL")),
    "abbreviation_table": ("true", _level(f"NOT {_TABLE} AND ({_LEFT})", "WARN")),
    "rare_acronyms": ("true", _level(_LEFT, "WARN")),
    "code_blocks": ("true", _level("contains(text, '```')", "WARN")),
}
_KIND = f"""CASE WHEN mode <> 'lecture-seg' THEN NULL WHEN contains(regexp_extract(path, '([^/]*)$', 1), '_HUB_') THEN 'hub' WHEN starts_with(regexp_extract(path, '([^/]*)$', 1), 'L3_') OR contains(path, '/L3/') THEN 'l3'
  WHEN starts_with(regexp_extract(path, '([^/]*)$', 1), 'L2_') OR contains(path, '/L2/') THEN 'l2' WHEN {_has('(?m)^#[ \\t\\n\\r]+.*Hub[ \\t\\n\\r]*$')} THEN 'hub' WHEN {_has('(?m)^#[ \\t\\n\\r]+L3' + chr(92) + 'b')} THEN 'l3' WHEN {_has('(?m)^#[ \\t\\n\\r]+L2' + chr(92) + 'b')} THEN 'l2' END"""


@query(
    "note_audit_structure",
    f"WITH {E.AUDIT_NOTES}, k AS (SELECT *, {_KIND} AS kind FROM notes), n AS (SELECT *, coalesce(kind IN ('l2', 'hub'), false) AS idx FROM k), "
    + 'c AS (SELECT note, unnest([' + ", ".join(f"CASE WHEN {applies} THEN {{'check': '{name}', 'level': {value}}} END" for name, (applies, value) in _STRUCTURE.items()) + ']) AS x FROM n) SELECT note, x."check" AS "check", x.level AS level FROM c WHERE x IS NOT NULL',
)
def note_audit_structure(spark, folder):
    return A.structure(_notes(spark, folder))


_BLOCKS = """SELECT note, h, count(*) AS c FROM (SELECT note, string_agg(regexp_replace(line, '\\s+', '', 'g'), chr(10) ORDER BY line_no) AS h, count(*) AS n_rows FROM (
  SELECT *, line_no - row_number() OVER (PARTITION BY note ORDER BY line_no) AS island FROM lines WHERE starts_with(ltrim(line), '|')) GROUP BY note, island) WHERE n_rows >= 3 GROUP BY 1, 2 HAVING count(*) > 1"""


@query(
    "note_audit_lines",
    f"""WITH {E.AUDIT_NOTES}, m AS (SELECT *, first(line) OVER w AS top, coalesce(sum((line = '---')::INT) OVER (PARTITION BY note ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bars, lead(line) OVER w AS nxt FROM lines WINDOW w AS (PARTITION BY note ORDER BY line_no)),
r AS (SELECT note, unnest([
  CASE WHEN regexp_matches(line, '^#{{1,6}}\\s') AND (regexp_matches(line, '(來源|出處|DOI|（s\\d+）|[(]s\\d+[)])\\s*$') OR (regexp_extract(line, '`([^`]+)`\\s*$', 1) <> '' AND NOT regexp_full_match(trim(regexp_extract(line, '`([^`]+)`\\s*$', 1)), '[\\d:\\-\\s~–.]+'))) THEN 'source_on_heading' END,
  CASE WHEN starts_with(ltrim(line), '|') AND len(list_filter(regexp_extract_all(line, '\\[\\[[^\\]]*\\]\\]'), lambda x: contains(x, '|') AND NOT contains(x, chr(92) || '|'))) > 0 THEN 'pipe_in_table_link' END,
  CASE WHEN regexp_matches(line, '{_CJK}==[^=]+==|==[^=]+=={_CJK}') THEN 'cjk_at_highlight' END,
  CASE WHEN len(list_filter(regexp_extract_all(line, '==([^=]+)==', 1), lambda x: regexp_matches(x, '(^|[^\\\\])[<>|#]'))) > 0 THEN 'raw_mark_in_highlight' END,
  CASE WHEN regexp_matches(line, '^ +[-*] ') AND NOT (top = '---' AND bars < 2) THEN 'space_indent' END,
  CASE WHEN length(trim(regexp_extract(line, '^>\\s*\\[!figure\\]\\s*(.*)$', 1))) > 45 AND regexp_matches(coalesce(nxt, ''), '^>\\s*!\\[\\[') THEN 'long_figure_title' END,
  CASE WHEN regexp_matches(trim(line), '^[-*] ') AND len(regexp_extract_all(line, '{_CJK}')) > 50 THEN 'long_bullet' END]) AS "check" FROM m),
d AS (SELECT note, line_no, length(regexp_extract(line, '^(#{{1,6}})\\s+\\S', 1)) AS depth FROM lines WHERE trim(line) <> ''),
e AS (SELECT note, depth, lead(depth) OVER (PARTITION BY note ORDER BY line_no) AS nxt FROM d),
p AS (SELECT note, line_no, len(regexp_extract_all(line, '{_EMBED}')) AS n_img, line FROM lines),
q AS (SELECT note, n_img, row_number() OVER (PARTITION BY note ORDER BY line_no) - row_number() OVER (PARTITION BY note, n_img > 0 ORDER BY line_no) AS island FROM p WHERE n_img > 0 OR NOT (trim(line) = '' OR starts_with(ltrim(line), '>'))),
g AS (SELECT note, island FROM q WHERE n_img > 0 GROUP BY 1, 2 HAVING sum(n_img) >= 3)
SELECT note, "check", count(*) AS n FROM r WHERE "check" IS NOT NULL GROUP BY 1, 2
UNION ALL SELECT note, 'empty_heading', count(*) FROM e WHERE depth > 0 AND (nxt IS NULL OR (nxt > 0 AND nxt <= depth)) GROUP BY 1
UNION ALL SELECT note, 'gallery', count(*) FROM g GROUP BY 1 UNION ALL SELECT note, 'repeated_table', count(*) FROM ({_BLOCKS}) GROUP BY 1""",
)
def note_audit_lines(spark, folder):
    return A.line_rules(_lines(spark, folder).select("note", "line_no", "line"))


def _section_sql(heading: str) -> str:
    return f"""SELECT note, line_no, line FROM (SELECT *, regexp_matches(line, '^#\\s+\\S') AS top, last(CASE WHEN regexp_matches(line, '^#\\s+\\S') THEN regexp_matches(line, '^#\\s+{heading}') END IGNORE NULLS) OVER (PARTITION BY note ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS inside FROM lines) WHERE inside AND NOT top"""


@query(
    "note_audit_sections",
    f"""WITH {E.AUDIT_NOTES}
SELECT note, 'summary_pictures' AS "check", CASE WHEN sum(len(regexp_extract_all(line, '{_EMBED}'))) = 0 THEN 'WARN' ELSE 'PASS' END AS level FROM ({_section_sql("總整理")}) GROUP BY 1
UNION ALL SELECT note, 'outcome_words', CASE WHEN bool_or(contains(lower(line), 'prognosis') OR contains(line, '預後')) AND bool_or(contains(lower(line), 'complications') OR contains(line, '併發症')) THEN 'PASS' ELSE 'WARN' END FROM ({_section_sql("Background" + chr(92) + "b")}) GROUP BY 1
UNION ALL SELECT note, 'algorithm_first', CASE WHEN regexp_matches(coalesce(arg_min(line, line_no) FILTER (starts_with(line, '## ')), ''), '(?i)algorithm|處置原則|⭐') THEN 'PASS' ELSE 'WARN' END FROM ({_section_sql("Management" + chr(92) + "b")}) GROUP BY 1""",
)
def note_audit_sections(spark, folder):
    return A.section_rules(_lines(spark, folder).select("note", "line_no", "line"))


@query(
    "note_audit_references",
    f"""WITH {E.AUDIT_NOTES}, known AS (SELECT unnest([f, regexp_extract(f, '([^/]*)$', 1)]) AS target FROM (SELECT unnest({E.NOTE_FILES}) AS f)),
t AS (SELECT note, 'broken_picture' AS "check", trim(unnest(regexp_extract_all(text, '{_EMBED}', 1))) AS target FROM notes UNION ALL SELECT note, 'dead_link', trim(unnest(regexp_extract_all(text, '\\[\\[(L[23]_seg[^\\]|]+)', 1))) || '.md' FROM notes)
SELECT note, "check", count(*) AS n FROM t WHERE target NOT IN (SELECT target FROM known) GROUP BY 1, 2""",
)
def note_audit_references(spark, folder):
    return A.unresolved(_notes(spark, folder), spark.createDataFrame([(f,) for f in E.NOTE_FILES], "name string"))


def _taken(around: str, marks: str, blank: bool) -> str:
    # the lines before the first one that ends the search, and of these the marked ones
    ends = f"NOT regexp_matches(x, '{marks}')" + (" AND x <> ''" if blank else "")
    stop = f"coalesce(list_position(list_transform({around}, lambda x: {ends}), true), 5)"
    return f"list_filter({around}[1:{stop} - 1], lambda x: regexp_matches(x, '{marks}'))"


@query(
    "caption_neighborhood",
    f"""WITH {E.AUDIT_NOTES}, n AS (SELECT note, line_no, line, [coalesce(trim(lag(line, 1) OVER w), '|'), coalesce(trim(lag(line, 2) OVER w), '|'), coalesce(trim(lag(line, 3) OVER w), '|'), coalesce(trim(lag(line, 4) OVER w), '|')] AS up,
  [coalesce(trim(lead(line, 1) OVER w), '|'), coalesce(trim(lead(line, 2) OVER w), '|'), coalesce(trim(lead(line, 3) OVER w), '|'), coalesce(trim(lead(line, 4) OVER w), '|')] AS down FROM lines WINDOW w AS (PARTITION BY note ORDER BY line_no))
SELECT note, line_no, array_to_string(list_concat({_taken("up", "^[>*#]", False)}, {_taken("down", "^[>*]", True)}), ' ') AS caption FROM n WHERE regexp_matches(line, '{_EMBED}')""",
)
def caption_neighborhood(spark, folder):
    return A.captions(_lines(spark, folder).select("note", "line_no", "line"))

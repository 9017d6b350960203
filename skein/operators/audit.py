"""The note audit: rules over whole notes and over their lines, each PASS, WARN or FAIL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.operators.sequences import islands

#: Headings that templates ask for, acronyms that must be spelled out, CJK characters.
TEMPLATES = {
    "disease": ["Background", "Evaluation", "Management"],
    "exam": ["Principle", "Indication", "Technique", "Interpretation", "Pitfalls"],
    "technique": ["Mechanism", "Indication", "Protocol", "Evidence"],
    "tool": ["Purpose", "Procedure", "Scoring"],
    "drug": ["Indication", "Mechanism", "Dosing", "Adverse"],
    "anatomy": [],
    "atlas": [],
}
RARE = ["PHCA", "IGHL", "CHL", "ILBCN", "RFD", "GRF", "vAHD"]
CJK = r"[\u3400-\u9fff\uf900-\ufaff]"
EMBED = r"(?i)!\[\[([^\]|]+\.(?:jpe?g|png|gif|webp|svg))((?:\|[^\]]*)?)\]\]"


def level(bad: Column, worst: str) -> Column:
    return F.when(F.coalesce(bad, F.lit(False)), worst).otherwise("PASS")


def segment_kind(path: Column, text: Column) -> Column:
    """hub, l3 or l2 by file name and folder, else by the top heading; null when neither tells."""
    base, folder = F.regexp_extract(path, r"([^/]*)$", 1), F.regexp_extract(path, r"([^/]*)/[^/]*$", 1)
    top = lambda pattern: text.rlike(r"(?md)^#\s+" + pattern)
    named = F.when(F.contains(base, F.lit("_HUB_")), "hub").when(F.startswith(base, F.lit("L3_")) | (folder == "L3"), "l3").when(F.startswith(base, F.lit("L2_")) | (folder == "L2"), "l2")
    return F.coalesce(named, F.when(top(r".*Hub\s*$") | top(".*— *Hub"), "hub").when(top(r"L3\b"), "l3").when(top(r"L2\b"), "l2"))


def _acronyms_left(text: Column) -> Column:
    """The rare acronyms that a note uses and neither spells out nor lists in a table row."""

    def left(a: str) -> Column:
        spelled = text.rlike(rf"{a}\s*\(") | text.rlike(rf"\({a}\)") | text.rlike(rf"(?md)^.*{a}.*\|") | text.rlike(rf"(?md)^.*\|.*{a}")
        return F.when(text.rlike(rf"\b{a}\b") & ~spelled, F.lit(a))

    return F.array_compact(F.array(*map(left, RARE)))


def structure(notes: DataFrame) -> DataFrame:
    """(note, check, level) of the rules that a note's whole text decides. ``notes``: note, mode, template, path, text.

    Checks that do not apply to a note's mode or kind give no row.
    """
    t, mode = F.col("text"), F.col("mode")
    rows = notes.withColumn("kind", F.when(mode == "lecture-seg", segment_kind(F.col("path"), t)))
    seg, kind = mode == "lecture-seg", F.col("kind")
    index = seg & F.coalesce(kind.isin("l2", "hub"), F.lit(False))
    none = lambda pattern: ~t.rlike(pattern)
    no_hub = none(r"課程 Hub|\[\[_HUB_")
    l3, l2, hub = (seg & F.coalesce(kind == k, F.lit(False)) for k in ("l3", "l2", "hub"))
    header = F.regexp_extract(t, r"(?s)\A(---\n.*?\n---)", 1)
    n_widthless = F.size(F.filter(F.regexp_extract_all(t, F.lit(EMBED), F.lit(2)), lambda x: ~x.rlike(r"\|\s*[0-9]+\s*(\||$)")))
    unspelled = F.size(_acronyms_left(t)) > 0
    tabled = t.rlike("(?i)縮寫|abbreviation") & F.contains(t, F.lit("|"))
    wanted = reduce(lambda a, b: a | b, [(F.col("template") == name) & reduce(lambda a, b: a | b, [none(rf"(?md)^#\s+{h}\b") for h in heads], F.lit(False)) for name, heads in TEMPLATES.items()])
    l2_heading = F.when(none(r"(?md)^#\s+\S"), "FAIL").otherwise(level(none(r"(?imd)^#\s+.*seg\s*\d+"), "WARN"))
    checks = {
        "resource": (~index, F.when(none(r"(?md)^#\s+Resource\s*$"), F.when(l3, "WARN").otherwise("FAIL")).otherwise("PASS")),
        "pearls": (~index, level(none(r"(?md)^>\s*\[!summary\]"), "FAIL")),
        "tags": (F.lit(True), F.when(header.rlike("(?md)^tags:"), "PASS").when(index, "WARN").otherwise("FAIL")),
        "l3_heading": (l3, level(none(r"(?md)^#\s+(L3\b|總整理)"), "FAIL")),
        "l3_abbreviations": (l3, level(~F.contains(t, F.lit("縮寫")), "WARN")),
        "hub_backlink": (l3 | l2, level(no_hub, "WARN")),
        "l2_heading": (l2, l2_heading),
        "l2_timestamps": (l2, level(none(r"[0-9]{1,2}:[0-9]{2}\)"), "FAIL")),
        "hub_table": (hub, level(none("分段|各段|Segmentation|Segments"), "FAIL")),
        "kind": (seg & kind.isNull(), F.lit("WARN")),
        "summary_heading": (mode == "lecture", level(none(r"(?md)^#\s+總整理\s*$"), "FAIL")),
        "slides_heading": (mode == "lecture", level(none(r"(?md)^#\s+(逐投影片筆記|逐段筆記)\s*$"), "FAIL")),
        "speaker": (mode == "lecture", level(~F.contains(t, F.lit("🗣️")), "WARN")),
        "template_headings": ((mode == "textbook") & (F.size(F.element_at(F.create_map(*[x for k, v in TEMPLATES.items() for x in (F.lit(k), F.array(*map(F.lit, v)) if v else F.array().cast("array<string>"))]), F.col("template"))) > 0), level(wanted, "FAIL")),
        "citation_placeholder": (mode == "textbook", level(t.rlike(r"\(citation\b"), "FAIL")),
        "embed_width": (F.lit(True), level(n_widthless > 0, "FAIL")),
        "leftover_todo": (F.lit(True), level(F.contains(t, F.lit("[!todo]")), "FAIL")),
        "forbidden_term": (F.lit(True), level(F.contains(t, F.lit("屍體")), "FAIL")),
        "abbreviation_table": (F.lit(True), level(~tabled & unspelled, "WARN")),
        "rare_acronyms": (F.lit(True), level(unspelled, "WARN")),
        "code_blocks": (F.lit(True), level(F.contains(t, F.lit("```")), "WARN")),
    }
    found = F.array_compact(F.array(*[F.when(applies, F.struct(F.lit(name).alias("check"), value.alias("level"))) for name, (applies, value) in checks.items()]))
    return rows.select("note", F.explode(found).alias("x")).select("note", "x.check", "x.level")


def top_section(lines: DataFrame, heading: str) -> DataFrame:
    """The lines of the top-level section ``heading`` of each note, as far as the next top-level heading."""
    top = F.col("line").rlike(r"^#\s+\S")
    own = F.when(top, F.col("line").rlike(rf"^#\s+{heading}\b"))
    w = Window.partitionBy("note").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    marked = lines.withColumn("_in", F.last(own, ignorenulls=True).over(w)).withColumn("_top", top)
    return marked.where(F.col("_in") & ~F.col("_top")).drop("_in", "_top")


def line_rules(lines: DataFrame) -> DataFrame:
    """(note, check, n) of the rules that single lines or runs of lines break, with how many do. ``lines``: note, line_no from 0, line."""
    line, w = F.col("line"), Window.partitionBy("note").orderBy("line_no")
    fence = F.when(line == "---", 1).otherwise(0)
    opened = F.first(line).over(w) == "---"
    upto = w.rowsBetween(Window.unboundedPreceding, -1)
    rows = lines.withColumns({"inside": opened & (F.coalesce(F.sum(fence).over(upto), F.lit(0)) < 2), "after": F.lead(line).over(w)})
    tick = F.regexp_extract(line, r"`([^`]+)`\s*$", 1)
    cited = (tick != "") & ~F.trim(tick).rlike(r"^[\d:\-\s~–.]+$")
    lights = F.regexp_extract_all(line, F.lit("==([^=]+)=="), F.lit(1))
    wiki = F.regexp_extract_all(line, F.lit(r"\[\[[^\]]*\]\]"), F.lit(0))
    title = F.trim(F.regexp_extract(line, r"^>\s*\[!figure\]\s*(.*)$", 1))
    tests = {
        "source_on_heading": line.rlike(r"^#{1,6}\s") & (cited | line.rlike(r"(來源|出處|DOI|（s\d+）|\(s\d+\))\s*$")),
        "pipe_in_table_link": F.startswith(F.ltrim(line), F.lit("|")) & F.exists(wiki, lambda x: F.contains(x, F.lit("|")) & ~F.contains(x, F.lit(r"\|"))),
        "cjk_at_highlight": line.rlike(rf"{CJK}==[^=]+==|==[^=]+=={CJK}"),
        "raw_mark_in_highlight": F.exists(lights, lambda x: x.rlike(r"(?<!\\)[<>|#]")),
        "space_indent": line.rlike("^ +[-*] ") & ~F.col("inside"),
        "long_figure_title": (F.length(title) > 45) & F.col("after").rlike(r"^>\s*!\[\["),
        "long_bullet": F.trim(line).rlike("^[-*] ") & (F.regexp_count(line, F.lit(CJK)) > 50),
    }
    simple = rows.select("note", F.explode(F.array_compact(F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in tests.items()]))).alias("check")).groupBy("note", "check").agg(F.count(F.lit(1)).alias("n"))
    return simple.unionByName(_empty_headings(lines)).unionByName(_galleries(lines)).unionByName(_repeated_tables(lines))


def _empty_headings(lines: DataFrame) -> DataFrame:
    """Headings with nothing but blank lines before the next one, unless that is a deeper one."""
    depth = F.length(F.regexp_extract("line", r"^(#{1,6})\s+\S", 1))
    w = Window.partitionBy("note").orderBy("line_no")
    rows = lines.where(F.trim("line") != "").withColumn("depth", depth)
    bare = (F.col("depth") > 0) & (F.lead("depth", 1, 1).over(w) > 0) & (F.lead("depth", 1, 0).over(w) <= F.col("depth"))
    return rows.withColumn("bare", bare).where("bare").groupBy("note").agg(F.count(F.lit(1)).alias("n")).select("note", F.lit("empty_heading").alias("check"), "n")


def _galleries(lines: DataFrame) -> DataFrame:
    """Runs of three pictures or more between lines of prose; blank and quoted lines do not end a run."""
    count = F.regexp_count("line", F.lit(EMBED))
    kept = lines.withColumn("n_img", count).where((F.col("n_img") > 0) | ~((F.trim("line") == "") | F.startswith(F.ltrim("line"), F.lit(">"))))
    runs = islands(kept, ["note"], ["line_no"], F.col("n_img") > 0).where("n_img > 0").groupBy("note", "island").agg(F.sum("n_img").alias("n")).where("n >= 3")
    return runs.groupBy("note").agg(F.count(F.lit(1)).alias("n")).select("note", F.lit("gallery").alias("check"), "n")


def _repeated_tables(lines: DataFrame) -> DataFrame:
    """Tables of three rows or more that a note holds more than once, white space aside."""
    rows = islands(lines.withColumn("is_row", F.startswith(F.ltrim("line"), F.lit("|"))), ["note"], ["line_no"], F.col("is_row")).where("is_row")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", F.regexp_replace("line", r"\s+", "").alias("x")))), lambda r: r["x"]), "\n")
    tables = rows.groupBy("note", "island").agg(F.count(F.lit(1)).alias("n_rows"), F.md5(text).alias("h")).where("n_rows >= 3")
    twice = tables.groupBy("note", "h").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    return twice.groupBy("note").agg(F.count(F.lit(1)).alias("n")).select("note", F.lit("repeated_table").alias("check"), "n")


def section_rules(lines: DataFrame) -> DataFrame:
    """(note, check, level): pictures in the summary, outcome words under Background, an algorithm first under Management."""
    pictures = top_section(lines, "總整理").groupBy("note").agg(F.sum(F.regexp_count("line", F.lit(EMBED))).alias("n")).select("note", F.lit("summary_pictures").alias("check"), level(F.col("n") == 0, "WARN").alias("level"))
    has = lambda *words: F.bool_or(reduce(lambda a, b: a | b, [F.contains(F.lower("line"), F.lit(w)) for w in words]))
    background = top_section(lines, "Background").groupBy("note").agg((has("prognosis", "預後") & has("complications", "併發症")).alias("ok")).select("note", F.lit("outcome_words").alias("check"), level(~F.col("ok"), "WARN").alias("level"))
    under = top_section(lines, "Management").groupBy("note").agg(F.min(F.when(F.startswith("line", F.lit("## ")), F.struct("line_no", "line")))["line"].alias("first"))
    algorithm = under.select("note", F.lit("algorithm_first").alias("check"), level(~F.coalesce(F.col("first").rlike("(?i)algorithm|處置原則|⭐"), F.lit(False)), "WARN").alias("level"))
    return pictures.unionByName(background).unionByName(algorithm)


def unresolved(notes: DataFrame, files: DataFrame) -> DataFrame:
    """(note, check, n): embedded pictures and segment links that no file answers to. ``files``: name (with or without folders).

    A target with a folder must be a file's whole name; a bare one may be any file's last part. Links
    to segments (``L2_seg..``, ``L3_seg..``) are looked for as Markdown files.
    """
    pictures = notes.select("note", F.explode(F.regexp_extract_all("text", F.lit(EMBED), F.lit(1))).alias("target")).select("note", F.lit("broken_picture").alias("check"), F.trim("target").alias("target"))
    segments = notes.select("note", F.explode(F.regexp_extract_all("text", F.lit(r"\[\[(L[23]_seg[^\]|]+)"), F.lit(1))).alias("target")).select("note", F.lit("dead_link").alias("check"), F.concat(F.trim("target"), F.lit(".md")).alias("target"))
    known = files.select(F.explode(F.array("name", F.regexp_extract("name", r"([^/]*)$", 1))).alias("target")).distinct()
    return pictures.unionByName(segments).join(known, "target", "left_anti").groupBy("note", "check").agg(F.count(F.lit(1)).alias("n"))


def captions(lines: DataFrame) -> DataFrame:
    """(note, line_no, caption): for each line with pictures, the caption lines around it.

    Upwards at most four lines as long as they are quotes, emphasis or headings; downwards at most
    four, of which quotes and emphasis count and blank lines are passed over; any other line ends the search.
    """
    w = Window.partitionBy("note").orderBy("line_no")
    near = lambda f: F.array(*[F.trim(f("line", k).over(w)) for k in range(1, 5)])

    def taken(around: Column, marks: str, blank: bool) -> Column:
        def step(a, s):
            mine = F.coalesce(s.rlike(marks), F.lit(False)) & a["go"]
            go = mine | (a["go"] & (s == "") if blank else F.lit(False))
            return F.struct(F.coalesce(go, F.lit(False)).alias("go"), F.when(mine, F.concat(a["found"], F.array(s))).otherwise(a["found"]).alias("found"))

        return F.aggregate(around, F.struct(F.lit(True).alias("go"), F.array().cast("array<string>").alias("found")), step, lambda a: a["found"])

    rows = lines.withColumns({"up": taken(near(F.lag), r"^[>*#]", False), "down": taken(near(F.lead), r"^[>*]", True)})
    shown = rows.where(F.regexp_count("line", F.lit(EMBED)) > 0)
    return shown.select("note", "line_no", F.array_join(F.concat("up", "down"), " ").alias("caption"))

"""Markdown notes: frontmatter, sections, embeds, links, highlights, bounded cuts, strings inside JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def frontmatter(text: Column, key: str) -> Column:
    """The value of ``key`` in the block between leading dashes; null when either is absent."""
    block = F.regexp_extract(text, r"(?s)\A---\n(.*?)\n---", 1)
    return F.nullif(F.trim(F.regexp_extract(block, rf"(?m)^{key}:[ \t]*(.*)$", 1)), F.lit(""))


def body(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\A---\n.*?\n---\n?", "")


def image_embeds(text: Column) -> Column:
    """(name, width) of ``![[name.ext|width]]`` embeds of pictures; width null when absent."""
    found = F.regexp_extract_all(text, F.lit(r"(?i)!\[\[([^\]|]+\.(?:jpe?g|png|webp|gif)(?:\|[^\]]*)?)\]\]"), F.lit(1))
    return F.transform(found, lambda x: F.struct(F.split_part(x, F.lit("|"), F.lit(1)).alias("name"), F.element_at(F.split(x, r"\|"), -1).try_cast("int").alias("width")))


def links(text: Column) -> Column:
    """(target, section, alias) of ``[[target#section|alias]]`` links that are not embeds."""
    found = F.regexp_extract_all(text, F.lit(r"(?<!!)\[\[([^\]]+)\]\]"), F.lit(1))
    part = lambda x, pattern: F.nullif(F.regexp_extract(x, pattern, 1), F.lit(""))
    return F.transform(found, lambda x: F.struct(F.trim(F.regexp_extract(x, r"^([^#|]*)", 1)).alias("target"), part(x, r"#([^|]*)").alias("section"), part(x, r"\|(.*)$").alias("alias")))


def plain_links(text: Column) -> Column:
    """Embeds go, links become their alias or target, highlights their words."""
    bare = F.regexp_replace(text, r"!\[\[[^\]]+\]\]", "")
    bare = F.regexp_replace(F.regexp_replace(bare, r"\[\[[^\]|]*\|([^\]]+)\]\]", "$1"), r"\[\[([^\]]+)\]\]", "$1")
    return F.regexp_replace(bare, r"==([^=]+)==", "$1")


def cut_at_space(text: Column, limit: int) -> Column:
    """At most ``limit`` characters, cut at the last white space if that keeps four fifths, else hard."""
    head = F.left(text, F.lit(limit))
    kept = F.regexp_extract(head, r"(?s)^(.*)\s\S*$", 1)
    return F.when(F.length(text) <= limit, text).when(F.length(kept) >= 0.8 * limit, kept).otherwise(head)


def json_strings(text: Column) -> Column:
    """The non-empty string leaves of a JSON text, without keys, in order of appearance, escapes as written."""
    found = F.regexp_extract_all(text, F.lit(r'"(?:[^"\\]|\\.)*"\s*:|"((?:[^"\\]|\\.)*)"'), F.lit(1))
    return F.filter(found, lambda x: x != "")


def sections(lines: DataFrame, by: str, order: str, line: str, header: str) -> DataFrame:
    """``lines`` with ``section``: the running count of headers; 0 before the first one."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("section", F.count_if(F.col(line).rlike(header)).over(w))


def table_cells(line: Column) -> Column:
    """The trimmed cells of a table row; null for other lines."""
    return F.when(line.rlike(r"^\s*\|.*\|\s*$"), F.transform(F.split(F.regexp_replace(line, r"^\s*\||\|\s*$", ""), r"\|"), lambda x: F.trim(x)))


def preprocessed(text: Column) -> Column:
    """A note's text made ready for a converter: no frontmatter, no production prefix on headings, no closing hub section,
    callout heads as bold lines with an empty quote line behind, highlights as marks."""
    bare = F.regexp_replace(body(text), r"(?md)^(#{1,3})\s*L[23]\s+", "$1 ")
    bare = F.regexp_replace(bare, r"(?s)(?:\n-{3,}\s*)?\n#{1,3}\s*課程 Hub\b.*\z", "\n")
    bare = F.regexp_replace(bare, r"(?md)^> \[!(\w+)\][ \t]*(\S.*)$", "> **【$1】 $2**\n>")
    bare = F.regexp_replace(bare, r"(?md)^> \[!(\w+)\][ \t]*$", "> **【$1】**\n>")
    return F.regexp_replace(bare, r"==([^=]+)==", "<mark>$1</mark>")


_PIECE = r"(!\[\[[^\]|]+\.(?:jpg|jpeg|png|webp)(?:\|\d+)?\]\])|c\d+_frame_\d+(?:\.jpg)?|(?<!!)\[\[[^\]|#]+(?:#[^\]|]+)?(?:\|[^\]]+)?\]\]"


def rewritten_links(notes: DataFrame, names: DataFrame, key: str = "note", text: str = "text") -> DataFrame:
    """``notes`` (key, text) with their references renamed by ``names`` (old, new): picture embeds keep their width, links their
    section and alias, frame names in prose become the picture's; what has no new name stays.

    References are cut out in order, looked up by one equi-join, and put back by position; the text between
    them is never looked at twice. A link to a segment whose name is not known is looked up by its kind and number.
    """
    pattern = f"(?i){_PIECE}"
    parts = notes.select(key, F.split(text, pattern, -1).alias("between"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))
    refs = parts.select(key, F.posexplode("found").alias("pos", "ref"))
    target = F.regexp_replace(F.regexp_extract("ref", r"^!?\[\[([^\]|#]+)", 1), r"^\s+|\s+$", "")
    frame = F.when(F.lower("ref").endswith(".jpg"), F.col("ref")).otherwise(F.concat("ref", F.lit(".jpg")))
    refs = refs.withColumn("old", F.when(F.contains("ref", F.lit("[[")), target).otherwise(frame))
    segment = lambda c: F.nullif(F.regexp_extract(c, r"^(L[23]_seg\d+_)", 1), F.lit(""))
    by_number = names.where(segment(F.col("old")).isNotNull()).groupBy(segment(F.col("old")).alias("_seg")).agg(F.min("new").alias("_new2"))
    met = refs.join(names.select(F.col("old"), F.col("new")), "old", "left").join(by_number, segment(F.col("old")) == F.col("_seg"), "left")
    named = F.coalesce("new", F.when(~F.startswith("ref", F.lit("!")), F.col("_new2")))
    rest = F.regexp_extract("ref", r"^!?\[\[[^\]|#]+([^\]]*)\]\]$", 1)
    bracket = F.concat(F.when(F.startswith("ref", F.lit("!")), "![[").otherwise("[["), named, rest, F.lit("]]"))
    put = met.withColumn("out", F.when(named.isNull(), F.col("ref")).when(F.contains("ref", F.lit("[[")), bracket).otherwise(named))
    lists = put.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "out"))), lambda x: x["out"]).alias("outs"))
    joined = parts.join(lists, key, "left")
    woven = F.array_join(F.transform("between", lambda b, i: F.concat(b, F.coalesce(F.get("outs", i), F.lit("")))), "")
    return joined.select(key, woven.alias(text))


def stamps_first(html: Column) -> Column:
    """Each list item with its first time link at the front; items with lists inside, and those without a link, stay."""
    items = F.regexp_replace(html, r'(?s)(<li[^>]*>)((?:(?!</li>|<ul|<ol|<a class="ts").)*?)\s*(<a class="ts"(?:(?!</a>).)*</a>)((?:(?!</li>|<ul|<ol).)*)(?=</li>)', "$1$3 \u0001$2$4\u0002")
    return F.regexp_replace(F.regexp_replace(items, "\u0001[ \t\n]*", ""), "[ \t\n]*\u0002", "")


#: A request for a slide's picture, the mark left in a sentence, and a picture's block.
PLACEHOLDER = r"\[\[EMBED\s+s(\d+)(?:\s*:\s*([^\]]+?))?\s*\]\]"
_MARK, _BLOCK = "(見 s%s 圖 ↓)", "> [!figure] s%s — %s (T%s)\n> ![[%s/%s|%s]]"


def expanded_embeds(lines: DataFrame, slides: DataFrame, root: str) -> DataFrame:
    """(note, text): notes (note, line_no, line) with their requests for pictures filled in from ``slides``.

    ``slides``: slide_id, name, width, caption, tier, suppressed. A request alone on its line becomes a block with blank
    lines around it; within a sentence a mark takes its place and the block follows the line. Requests for
    slides that are unknown, beyond tier 2 or suppressed go. Fenced code stays as it is. The note's own words go before
    the slide's caption. One equi-join on the slide; lines meet again by number.
    """
    w = Window.partitionBy("note").orderBy("line_no")
    fence = F.ltrim("line").rlike("^(```|~~~)")
    before = F.coalesce(F.sum(fence.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    none = F.array().cast("array<string>")
    rows = lines.withColumn("_code", fence | (before % 2 == 1))
    rows = rows.withColumn("found", F.when(F.col("_code"), none).otherwise(F.regexp_extract_all("line", F.lit(PLACEHOLDER), F.lit(0))))
    refs = rows.select("note", "line_no", F.posexplode("found").alias("pos", "ref"))
    refs = refs.select("note", "line_no", "pos", F.regexp_extract("ref", PLACEHOLDER, 1).cast("long").alias("slide_id"), F.trim(F.regexp_extract("ref", PLACEHOLDER, 2)).alias("said"))
    met = refs.join(slides, "slide_id", "left")
    good = F.coalesce((F.col("tier") <= 2) & (F.coalesce("suppressed", F.lit("")) == ""), F.lit(False))
    words = F.coalesce(F.nullif("said", F.lit("")), F.nullif("caption", F.lit("")), F.lit("figure"))
    block = F.format_string(_BLOCK, F.col("slide_id"), words, F.col("tier"), F.lit(root), F.coalesce("name", F.format_string("s%02d.jpg", "slide_id")), F.coalesce("width", F.lit(500)))
    made = met.withColumn("x", F.struct("pos", F.when(good, F.format_string(_MARK, "slide_id")).otherwise("").alias("mark"), F.when(good, block).alias("block")))
    made = made.groupBy("note", "line_no").agg(F.array_sort(F.collect_list("x")).alias("made"))
    alone = (F.size("found") == 1) & F.trim("line").rlike(f"^{PLACEHOLDER}$")
    rows = rows.join(made, ["note", "line_no"], "left").withColumns({"_alone": alone, "_blocks": F.coalesce(F.filter(F.transform("made", lambda x: x["block"]), lambda b: b.isNotNull()), none)})
    kept = rows.where(~F.col("_alone") | (F.size("_blocks") > 0))
    blank_end = (F.size("_blocks") > 0) | (F.trim("line") == "")
    kept = kept.withColumn("_open", ~F.coalesce(F.lag(blank_end).over(w), F.lit(True)))
    woven = F.array_join(F.transform(F.split("line", PLACEHOLDER, -1), lambda part, i: F.concat(part, F.coalesce(F.get("made", i)["mark"], F.lit("")))), "")
    around = F.flatten(F.transform("_blocks", lambda b: F.array(F.lit(""), b, F.lit(""))))
    own = F.concat(F.when(F.col("_open"), F.array(F.lit(""))).otherwise(none), "_blocks", F.array(F.lit("")))
    out = F.when(F.col("_alone"), own).when(F.size("found") > 0, F.concat(F.array(woven), around)).otherwise(F.array("line"))
    text = F.array_join(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("line_no", out.alias("out")))), lambda r: r["out"])), "\n")
    return kept.groupBy("note").agg(text.alias("text"))

"""Readers that tolerate the shapes in which documents arrive, and small format probes."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEGMENT = "array<struct<start:double,end:double,text:string,words:array<struct<start:double,end:double,word:string>>>>"

#: Kinds by file extension.
KINDS = {
    "video": "mp4 mov mkv avi mts m2ts webm",
    "audio": "mp3 m4a wav aac flac ogg opus",
    "pdf": "pdf",
    "image": "jpg jpeg png webp bmp tif tiff",
    "convert_first": "pptx ppt key docx doc heic",
}


def segments_from_json(rows: DataFrame, column: str = "value") -> DataFrame:
    """clip, seg_idx, start, end, text, words from JSON texts: a list, or an object with ``segments``.

    Any other shape raises when the row is read; an empty list gives no rows.
    """
    v = F.parse_json(column)
    found = F.coalesce(F.try_variant_get(v, "$.segments", SEGMENT), F.try_variant_get(v, "$", SEGMENT))
    checked = F.when(found.isNull(), F.raise_error(F.concat(F.lit("neither a list nor segments: "), F.left(column, F.lit(80))))).otherwise(found)
    keys = [c for c in rows.columns if c != column]
    return rows.select(*keys, F.posexplode(checked).alias("seg_idx", "x")).select(*keys, "seg_idx", "x.*")


def read_transcripts(spark: SparkSession, pattern: str) -> DataFrame:
    """One transcript file per clip folder; the folder's name is the clip."""
    files = spark.read.text(pattern, wholetext=True).select(F.regexp_extract("_metadata.file_path", "([^/]+)/[^/]+$", 1).alias("clip"), "value")
    return segments_from_json(files)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in whatever store holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def resolve_transcript(spark: SparkSession, folder: str, names: tuple[str, ...] = ("transcript.json", "transcript_clean.json")) -> str:
    """The first of ``names`` in ``folder``, in any store; none is an error, never an empty transcript."""
    for name in names:
        if exists(spark, f"{folder}/{name}"):
            return f"{folder}/{name}"
    raise FileNotFoundError(f"no transcript in {folder}")


def page_texts(rows: DataFrame, column: str = "value", pages: int | None = None) -> DataFrame:
    """page, text from a list of objects or of strings, bare or under ``pages``; the first ``pages`` of them."""
    v = F.parse_json(column)
    objects = "array<struct<page:int,text:string>>"
    texts = F.coalesce(F.try_variant_get(v, "$.pages", objects), F.try_variant_get(v, "$", objects)).getField("text")
    plain = F.coalesce(F.try_variant_get(v, "$.pages", "array<string>"), F.try_variant_get(v, "$", "array<string>"))
    usable = F.when(F.exists(texts, lambda t: t.isNotNull()), texts).otherwise(plain)
    out = rows.select(F.posexplode(usable).alias("page", "text"))
    return out if pages is None else out.where(F.col("page") < pages)


def file_kind(name: Column) -> Column:
    ext = F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1))
    out = F.lit("other")
    for kind, names in reversed(KINDS.items()):
        out = F.when(ext.isin(names.split()), kind).otherwise(out)
    return out


def adapter_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, counts) of JSON lines: lines that do not start with a brace are ignored, broken ones are counted."""
    json = lines.where(F.startswith("value", F.lit("{"))).select(F.try_parse_json("value").alias("v"))
    get = lambda path, kind: F.try_variant_get("v", path, kind)
    good = json.where("v IS NOT NULL").select(F.coalesce(get("$.image", "string"), get("$.fixture", "string")).alias("image"), get("$.engine", "string").alias("engine"), get("$.page_confidence", "double").alias("confidence"), get("$.error", "string").alias("error"))
    return good, json.agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(F.col("v").isNull()).alias("n_broken"))


def route_plan(files: DataFrame) -> DataFrame:
    """Ordered steps for a folder's files (name): counts per kind decide the slide source and the extra steps."""
    count = lambda kind: F.count_if(file_kind(F.col("name")) == kind).alias(kind)
    n = files.agg(*[count(k) for k in KINDS])
    deck, av = F.col("image") >= 3, F.col("video") + F.col("audio")
    slides = F.when(F.col("pdf") > 0, "slides_from_pdf").when(deck, "slides_from_images").when(F.col("video") > 0, "slides_from_video")
    steps = F.array(F.when(F.col("convert_first") > 0, "convert"), F.when(av > 0, "transcribe"), F.when(av >= 2, "align"), slides, F.when(slides.isNotNull() & (av > 0), "ground"), F.lit("write"))
    return n.select(F.posexplode(F.filter(steps, lambda x: x.isNotNull())).alias("n", "step"))


def media_fingerprint(files: DataFrame) -> DataFrame:
    """size and eight hex digits of the SHA-256 over the first and last 64 KiB (``binaryFile`` rows)."""
    edge = F.concat(F.expr("substring(content, 1, 65536)"), F.when(F.col("length") > 65536, F.expr("substring(content, -65536, 65536)")).otherwise(F.lit(b"")))
    return files.select("path", "length", F.left(F.sha2(edge, 256), F.lit(8)).alias("fingerprint"))


def bcd(byte: Column) -> Column:
    """The two decimal digits of a byte."""
    return F.shiftright(byte, 4) * 10 + byte.bitwiseAND(15)


def leaves(settings: dict, path: tuple = ()) -> dict[tuple, object]:
    """A nested dict as one of paths and values; an empty dict below the top is a value."""
    out: dict[tuple, object] = {}
    for key, value in settings.items():
        out |= leaves(value, (*path, key)) if isinstance(value, dict) and value else {(*path, key): value}
    return out


def deep_merge(base: dict, override: dict | None) -> dict:
    """Nested settings, merged leaf by leaf: the override's leaves win, except where they are None.

    A leaf of one side that stands where the other has a dict replaces it (unless it is None).
    """
    merged, new = leaves(base), {path: v for path, v in leaves(override or {}).items() if v is not None and v != {}}
    merged = {path: v for path, v in merged.items() if not any(path[: len(n)] == n or n[: len(path)] == path for n in new)} | new
    tree: dict = {}
    for path, value in merged.items():
        node = tree
        for key in path[:-1]:
            node = node.setdefault(key, {})
        node[path[-1]] = value
    return tree


def avchd_clock(content: Column) -> Column:
    """The recording time in a camcorder stream: the first valid date and time pack behind a metadata mark.

    The bytes are searched as hexadecimal pairs. Behind ``MDPM``, within 256 bytes, a date
    pack is 18, any, 20, year, month and a time pack 19, day, hour, minute, second, all decimal
    digits in half-bytes (flag bits in the high ones are masked). No valid pack gives null.
    """
    marks = F.regexp_extract_all(F.hex(content), F.lit(r"\G(?:..)*?4D44504D(?=((?:..){10,252}))"), F.lit(1))
    packs = F.flatten(F.transform(marks, lambda m: F.regexp_extract_all(m, F.lit(r"\G(?:..)*?(?=(18..20....19........)).."), F.lit(1))))

    def digits(pack: Column, at: int, mask: int) -> Column:
        byte = F.conv(F.substring(pack, 2 * at + 1, 2), 16, 10).cast("int").bitwiseAND(mask)
        return F.lpad(bcd(byte).cast("string"), 2, "0")

    fields = ((3, 0xFF), (4, 0x1F), (6, 0x3F), (7, 0x3F), (8, 0x7F), (9, 0x7F))
    stamp = lambda p: F.try_to_timestamp(F.concat(F.lit("20"), *[digits(p, at, mask) for at, mask in fields]), F.lit("yyyyMMddHHmmss")).cast("timestamp_ntz")
    return F.get(F.filter(F.transform(packs, stamp), lambda t: t.isNotNull()), F.lit(0))


def refine_seconds(claim: Column, mtime: Column) -> Column:
    """The file's time where it falls in the minute that its name claims, else the claim."""
    return F.when(F.date_trunc("minute", mtime) == F.date_trunc("minute", claim), mtime).otherwise(claim)


def slide_rows(rows: DataFrame, item: str, column: str = "value") -> DataFrame:
    """One row per entry ``x`` (of type ``item``) of JSON lists: bare, under ``slides``, or the first list in an object.

    Any other shape raises when the row is read; an empty list gives no rows.
    """
    v, kind = F.parse_json(column), f"array<{item}>"
    members = F.map_values(F.try_variant_get(v, "$", "map<string,variant>"))
    first = F.get(F.filter(members, lambda m: F.schema_of_variant(m).startswith("ARRAY")), F.lit(0))
    found = F.coalesce(F.try_variant_get(v, "$", kind), F.try_variant_get(v, "$.slides", kind), F.try_variant_get(first, "$", kind))
    checked = F.when(found.isNull(), F.raise_error(F.concat(F.lit("no list of slides: "), F.left(column, F.lit(80))))).otherwise(found)
    return rows.select(*[c for c in rows.columns if c != column], F.posexplode(checked).alias("pos", "x"))


def page_range(pages: DataFrame, low: int, high: int, page: str = "page") -> DataFrame:
    """The pages from ``low`` to ``high``; a page without a number is in no range."""
    return pages.where(F.col(page).between(low, high))


def deck(intro: DataFrame, pages: DataFrame) -> DataFrame:
    """A deck's pages with ``part`` and ``part_no``, by which introductory pages go before the others."""
    named = lambda df, name, n: df.withColumns({"part": F.lit(name), "part_no": F.lit(n)})
    return named(intro, "intro", 0).unionByName(named(pages, "pages", 1))


def read_settings(spark: SparkSession, path: str | None, defaults: dict) -> dict:
    """``defaults`` with the settings of a YAML or JSON file merged in; without a path, or where it does not exist, the defaults.

    A file that cannot be read as settings is an error. YAML needs the yaml library; JSON does not.
    """
    if not path or not exists(spark, path):
        return dict(defaults)
    text = spark.read.text(path, wholetext=True).first().value
    try:
        loaded = json.loads(text)
    except ValueError:
        import yaml

        loaded = yaml.safe_load(text)
    if not isinstance(loaded, dict | None):
        raise ValueError(f"{path} holds no settings")
    return deep_merge(defaults, loaded)


def resolve_alias(name: str, settings: dict) -> str:
    """A model's path or public name: an alias from ``models.aliases``, with ``{folder}`` filled in from ``paths.models``.

    An alias that needs a folder where none is set is an error.
    """
    target = (settings.get("models") or {}).get("aliases", {}).get(name, name)
    folder = (settings.get("paths") or {}).get("models")
    if "{folder}" in target and not folder:
        raise ValueError(f"alias {name} needs paths.models")
    return target.replace("{folder}", (folder or "").rstrip("/"))


def scan_media(spark: SparkSession, folders: list[str], kinds: tuple[str, ...] = ("video", "image", "audio")) -> DataFrame:
    """source, path, file, kind, length, modified of the media files right in each folder, given as ``FOLDER`` or ``LABEL=FOLDER``.

    The label, else the folder's last part, is the source. Files of other kinds are left out; contents are not read.
    """
    parts = []
    for given in folders:
        label, _, folder = given.rpartition("=")
        if not exists(spark, folder):
            raise FileNotFoundError(folder)
        files = spark.read.format("binaryFile").load(f"{folder}/*").select("path", "length", F.col("modificationTime").alias("modified"))
        parts.append(files.withColumn("source", F.lit(label or folder.rstrip("/").rpartition("/")[2])))
    every = reduce(DataFrame.unionByName, parts)
    name = F.regexp_extract("path", "([^/]*)$", 1)
    return every.select("source", "path", name.alias("file"), file_kind(name).alias("kind"), "length", "modified").where(F.col("kind").isin(*kinds))

"""Text expressions: clocks, tokens, n-grams, keyword and acronym classes, cleaners."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Token patterns.
GROUNDING_TOKEN = r"[A-Za-z][A-Za-z0-9\-]{1,}|[\u4e00-\u9fff]{2,}"
GUARD_TOKEN = r"[A-Za-z][A-Za-z0-9\-]{2,}|[\u4e00-\u9fff]{2,}"
ASCII_TOKEN = r"[A-Za-z][A-Za-z0-9'\-]*"
ACRONYM = r"^[A-Z0-9]{2,6}$"
CJK = r"[\u4e00-\u9fff\u3400-\u4dbf]"
SCRIPT_CJK = r"[\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff]"
LATIN = r"[A-Za-z]"

#: Keyword classes and cue words.
ABBREVIATIONS = "ALS ADHD CPET RTC ROM DTR ABI CMAP NCS EMG MRI CT US PT OT ST ESWT TENS NMES FES FIM MMT COPD ILD HFrEF HFpEF VO2 VE AT TNM DVT PE SCI TBI CP DMD".split()
DRUG_SUFFIXES = "mab inib statin pril prazole olol sartan pine gliflozin parin".split()
TERM_SUFFIXES = "itis oma pathy osis ectomy plasty algia emia rhea centesis".split()
EMPHASIS = ["重要", "最重要", "核心", "記住", "注意", "千萬", "關鍵", "重點", "一定要", "key point", "important", "remember", "critical", "essential", "must", "absolutely", "takeaway", "highlight", "decision making"]
CONFUSION = ["跳過", "skip", "let's move on", "不重要", "next slide", "等一下回來", "back to", "我們先看", "abandon", "忽略"]
#: Words of screen-sharing interfaces that OCR picks up.
CHROME = "聊天 劇天 人員 舉手 最手 翠手 卑手 取得控制權 控制權 檢視 检视 照相機 照相格 照相 簽到 保密 視訊 麥克風 共享 邀請 錄製 反應 暫停 結束會議 停止共享 新的共享 多雲 時睛 未證 靜音 解除".split()
#: Common words that are never suspects.
STOPWORDS = """
about above after again against all also and any are been before being both but can cannot come could did does doing done
down during each even ever every few for from further get give given going good got had has have having her here him his how
however into its itself just keep know large last later least less let like little long look made make many may more most
much must need never new next not now often once one only other our out over own put quite rather really right said same say
see seem seen she should show shown since small some such sure take tell than that the their them then there these they thing
think this those though three through thus time today together too took two under until upon use used using very want was way
well went were what when where whether which while who whole why will with within without word work would year yes yet you your
""".split()
#: Words that do not make a caption or a frame alike.
SALIENT_STOP = "the and for with this that from your you are was has have not but its all can may use used using show shows showed here there what when then case slide figure image view 投影片 圖片 如圖 顯示 如下 一個 這個 這是 對照 標示 標註".split()


def words(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def hms(seconds: Column) -> Column:
    """MM:SS below an hour, else H:MM:SS; fractions are cut off, negative counts as 0."""
    s = F.greatest(F.floor(seconds), F.lit(0)).cast("long")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    mins, hours = F.floor(s / 60).cast("long"), F.floor(s / 3600).cast("long")
    short = F.concat_ws(":", two(mins), two(s % 60))
    return F.when(s < 3600, short).otherwise(F.concat_ws(":", hours.cast("string"), two(mins % 60), two(s % 60)))


def minute_clock(seconds: Column) -> Column:
    """Minutes in all and seconds, without hours."""
    s = F.floor(seconds).cast("long")
    mins = F.floor(s / 60).cast("long").cast("string")
    return F.concat_ws(":", F.when(F.length(mins) < 2, F.lpad(mins, 2, "0")).otherwise(mins), F.lpad((s % 60).cast("string"), 2, "0"))


def parse_clock(text: Column) -> Column:
    """Seconds of ``SS``, ``MM:SS`` or ``H:MM:SS``; null for anything else."""
    parts = F.split(F.trim(text), ":")
    value = F.aggregate(F.transform(parts, lambda p: p.try_cast("double")), F.lit(0.0), lambda a, x: a * 60 + x)
    return F.when(F.size(parts) <= 3, value)


def char_ngrams(text: Column, n: int) -> Column:
    """Overlapping n-grams of the text without white space, in order; none when it is shorter than ``n``."""
    return F.regexp_extract_all(F.regexp_replace(text, r"(?U)\s+", ""), F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))


def keyword_class(token: Column) -> Column:
    """abbreviation, drug, medical_term, general (5 characters or more) or null."""
    low = F.lower(token)
    short = (F.length(token) <= 4) & token.rlike("^[A-Z]+$")
    known = F.upper(token).isin([a.upper() for a in ABBREVIATIONS])
    ends = lambda suffixes: reduce(lambda a, b: a | b, [F.endswith(low, F.lit(s)) & (F.length(low) > len(s) + 2) for s in suffixes])
    return F.when(short | known, "abbreviation").when(ends(DRUG_SUFFIXES), "drug").when(ends(TERM_SUFFIXES), "medical_term").when(F.length(token) >= 5, "general")


def any_contains(text: Column, parts: list[str]) -> Column:
    """Whether any of ``parts`` occurs in ``text``."""
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in parts])


def exact_hit(text_lower: Column, word_lower: Column) -> Column:
    """A word's start in the text (nothing alphanumeric before it, anything after); CJK words match anywhere."""
    plain = word_lower.rlike("^[a-z0-9]")
    found = F.regexp_like(text_lower, F.concat(F.lit(r"(?<![a-z0-9])\Q"), word_lower, F.lit(r"\E")))
    return F.when(plain, found).otherwise(F.contains(text_lower, word_lower))


def abbreviation_hit(text: Column, word: Column) -> Column:
    """The abbreviation in its own case, with nothing alphanumeric on either side."""
    return F.regexp_like(text, F.concat(F.lit(r"(?<![A-Za-z0-9])\Q"), word, F.lit(r"\E(?![A-Za-z0-9])")))


def strip_chrome_lines(text: Column, parts: list[str] = CHROME) -> Column:
    """The text without lines that hold an interface word."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda line: ~any_contains(line, parts)), "\n")


TIMECODE = r"\d{1,2}[:.]\d{2}([:.]\d{2})?\s*(AM|PM)?|\d{2,4}[-/.]\d{1,2}[-/.]\d{1,2}|\d+°"


def clean_labels(labels: Column, parts: list[str] = CHROME) -> Column:
    """Labels without blanks, interface words and short time codes."""
    return F.filter(labels, lambda x: (F.trim(x) != "") & ~any_contains(x, parts) & ~(x.rlike(TIMECODE) & (F.length(F.trim(x)) <= 25)))


def wordy_chars(text: Column) -> Column:
    """Characters in words of three letters or more and in CJK runs of two or more."""
    count = lambda pattern: F.aggregate(words(text, pattern), F.lit(0), lambda a, w: a + F.length(w))
    return count("[A-Za-z]{3,}") + count(r"[\u3400-\u9fff]{2,}")


def salient_tokens(text: Column) -> Column:
    """Distinct lower-case words of three characters or more and CJK bigrams, without stop words."""
    low = F.lower(text)
    runs = words(low, r"[\u3400-\u9fff\uf900-\ufaff]{2,}")
    pairs = F.flatten(F.transform(runs, lambda r: F.transform(F.sequence(F.lit(1), F.length(r) - 1), lambda i: F.substr(r, i, F.lit(2)))))
    every = F.concat(words(low, r"[a-z][a-z0-9\-]{2,}"), pairs)
    stop = F.array(*map(F.lit, SALIENT_STOP))
    return F.array_distinct(F.filter(every, lambda t: ~F.array_contains(stop, t)))


def script_ratios(text: Column) -> tuple[Column, Column]:
    """(CJK characters, Latin letters)."""
    return F.regexp_count(text, F.lit(CJK)), F.regexp_count(text, F.lit(LATIN))


def script_class(text: Column) -> Column:
    """cjk when 30 % of the visible characters are, else latin."""
    flat = F.regexp_replace(text, r"(?U)\s+", "")
    return F.when((F.length(flat) > 0) & (F.regexp_count(flat, F.lit(SCRIPT_CJK)) >= 0.3 * F.length(flat)), "cjk").otherwise("latin")


def wordless(text: Column) -> Column:
    """No letter or digit of any script."""
    return ~F.coalesce(text, F.lit("")).rlike(r"(?U)[^\W_]")


def squeeze(text: Column) -> Column:
    return F.regexp_replace(text, r"\s+", "")


def tolerant_json(text: Column) -> Column:
    """A variant from JSON text, from fenced JSON, or from the outermost braces in prose; else null."""
    fenced = F.regexp_extract(text, r"(?s)```(?:json)?\s*(.*?)```", 1)
    braces = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    return F.coalesce(F.try_parse_json(text), F.try_parse_json(F.nullif(fenced, F.lit(""))), F.try_parse_json(F.nullif(braces, F.lit(""))))


def html_text(html: Column) -> Column:
    """Text of markup: scripts, styles, comments and tags go, five entities are resolved, white space is collapsed."""
    bare = F.regexp_replace(F.regexp_replace(html, r"(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->", " "), r"<[^>]*>", " ")
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(name), F.lit(char))
    return F.trim(F.regexp_replace(bare, r"[ \t\n\r\f\x0b]+", " "))


def parse_tier(value: Column) -> Column:
    """Null is 3; a number its integer; otherwise the first digit from 1 to 9, or 1 when there is none."""
    digit = F.regexp_extract(value, "[1-9]", 0)
    return F.when(value.isNull(), 3).when(value.rlike(r"^-?[0-9]+([.][0-9]+)?$"), value.try_cast("double").cast("int")).when(digit != "", digit.cast("int")).otherwise(1)


def natural_key(name: Column) -> Column:
    """A string whose order is natural: digit runs by value (their number of digits goes first), the rest in lower case."""
    bare = lambda p: F.regexp_replace(p, "^0+(?=.)", "")
    value = lambda p: F.concat(F.lpad(F.length(bare(p)).cast("string"), 10, "0"), bare(p))
    return F.array_join(F.transform(words(F.lower(name), r"[0-9]+|[^0-9]+"), lambda p: F.when(p.rlike("^[0-9]"), value(p)).otherwise(p)), "\x01")


def glob_to_regex(glob: Column) -> Column:
    """``*``, ``?`` and classes as ``[a-c]`` or ``[!x]``, as in file name patterns; everything else, and an open bracket alone, stands for itself."""
    parts = words(glob, r"\[!?\]?[^\]]*\]|(?s).")
    part = lambda p: (
        F.when(p == "*", ".*").when(p == "?", ".")
        .when(F.length(p) > 1, F.concat(F.lit("["), F.regexp_replace(F.regexp_replace(F.right(p, F.length(p) - 1), "^!", "^"), r"\\", r"\\\\")))
        .otherwise(F.concat(F.lit(r"\Q"), p, F.lit(r"\E")))
    )
    return F.concat(F.lit("(?s)^"), F.array_join(F.transform(parts, part), ""), F.lit("$"))


def human_size(size: Column) -> Column:
    out = F.format_string("%.1f TB", size / 1024.0**4)
    for power, unit in reversed(list(enumerate(["B", "KB", "MB", "GB"]))):
        out = F.when(size < 1024.0 ** (power + 1), F.format_string("%.1f " + unit, size / 1024.0**power)).otherwise(out)
    return out


def safe_name(title: Column, limit: int = 16) -> Column:
    """A short slug: letters, digits and CJK stay, the rest becomes dashes; 'seg' when nothing is left."""
    slug = F.regexp_replace(F.regexp_replace(title, r"[^0-9A-Za-z\u3400-\u9fff]+", "-"), "^-+|-+$", "")
    return F.when(slug == "", "seg").otherwise(F.left(slug, F.lit(limit)))


def normalize_time(raw: Column, utc_offset_hours: float) -> tuple[Column, Column]:
    """(local timestamp without zone, which form matched): Zulu, offset-tagged (wall time kept), EXIF, ISO."""
    zulu = F.try_to_timestamp(raw, F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")).cast("timestamp_ntz") + F.make_dt_interval(mins=F.lit(round(utc_offset_hours * 60)))
    tagged = F.try_to_timestamp(F.regexp_replace(raw, r"[+-]\d\d:?\d\d$", ""), F.lit("yyyy-MM-dd'T'HH:mm:ss")).cast("timestamp_ntz")
    exif = F.try_to_timestamp(raw, F.lit("yyyy:MM:dd HH:mm:ss")).cast("timestamp_ntz")
    iso = F.coalesce(F.try_to_timestamp(raw, F.lit("yyyy-MM-dd HH:mm:ss")), F.try_to_timestamp(raw, F.lit("yyyy-MM-dd'T'HH:mm:ss"))).cast("timestamp_ntz")
    has_tag = raw.rlike(r"T\d\d:\d\d:\d\d[+-]\d\d:?\d\d$")
    value = F.when(raw.endswith("Z"), zulu).when(has_tag, tagged).otherwise(F.coalesce(exif, iso))
    label = F.when(value.isNull(), "none").when(raw.endswith("Z"), "utc").when(has_tag, "tagged").when(exif.isNotNull(), "exif").otherwise("iso")
    return value, label


def filename_time(name: Column) -> Column:
    """The first valid date and time in a file name: 2- or 4-digit year, separators optional."""
    found = F.regexp_extract_all(name, F.lit(r"(?<![0-9])((?:20)?[0-9]{2})[-_.]?([0-9]{2})[-_.]?([0-9]{2})[-_. T]?([0-9]{2})[-_.]?([0-9]{2})(?:[-_.]?([0-9]{2}))?(?![0-9])"), F.lit(0))
    digits = F.transform(found, lambda x: F.regexp_replace(x, "[^0-9]", ""))
    full = F.transform(digits, lambda d: F.when(F.length(d).isin(10, 12) & ~d.rlike("^20[0-9]{10}$"), F.concat(F.lit("20"), d)).otherwise(d))
    times = F.transform(full, lambda d: F.try_to_timestamp(F.rpad(d, 14, "0"), F.lit("yyyyMMddHHmmss")).cast("timestamp_ntz"))
    return F.get(F.filter(times, lambda t: t.isNotNull()), F.lit(0))

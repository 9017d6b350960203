"""Edge rows of the operators, and properties against plain loops."""

import random

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skein.functions import text as T
from skein.functions.citations import citations, parse_group
from skein.functions.fuzzy import common_length, partial, reaches
from skein.operators import folds, gates, match, rules
from skein.operators import sequences as S
from skein.operators.intervals import interval_join
from skein.plans.timeline import replace_segments
from skein.sources import readers, sinks

QUICK = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def col(spark, expr, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").collect()]


def test_clocks(spark):
    assert col(spark, T.hms, [-1.0, 0.0, 59.9, 3599.0, 3600.0, 3661.0], "double") == ["00:00", "00:00", "00:59", "59:59", "1:00:00", "1:01:01"]
    assert col(spark, T.parse_clock, ["75", "01:15", "1:00:05", "x", "1:2:3:4"]) == [75.0, 75.0, 3605.0, None, None]


def test_keyword_classes(spark):
    words = ["ALS", "all", "adalimumab", "mab", "arthritis", "tendon", "walk", "hfref"]
    assert col(spark, T.keyword_class, words) == ["abbreviation", None, "drug", None, "medical_term", "general", None, "abbreviation"]


def test_word_start_hits(spark):
    df = spark.createDataFrame([("emotional tendons", "motion"), ("emotional tendons", "tendon"), ("the motion", "motion")], "t string, w string")
    assert [r[0] for r in df.select(T.exact_hit(F.col("t"), F.col("w"))).collect()] == [False, True, True]
    abbreviations = spark.createDataFrame([("an ALS case", "ALS"), ("fALSe", "ALS"), ("als", "ALS")], "t string, w string")
    assert [r[0] for r in abbreviations.select(T.abbreviation_hit(F.col("t"), F.col("w"))).collect()] == [True, False, False]


def test_ngrams_guard_short_texts(spark):
    assert col(spark, lambda c: T.char_ngrams(c, 3), ["ab", "a b　c", "abcd", ""]) == [[], ["abc"], ["abc", "bcd"], []]


def test_tiers(spark):
    assert col(spark, T.parse_tier, [None, "1", "T1 x", "2.0", "true", "none", "10"]) == [3, 1, 1, 2, 1, 1, 10]


def test_wordless_and_script(spark):
    assert col(spark, T.wordless, ["。。。", "好", "", "é", None]) == [True, False, True, False, True]
    assert col(spark, T.script_class, ["中文字abc", "mostly latin 中", "", "中文"]) == ["cjk", "latin", "latin", "cjk"]


def test_json_in_prose(spark):
    texts = ['{"k": 1}', '```json\n{"k": 2}\n```', 'so: {"k": 3} ok', '{"k": ']
    assert col(spark, lambda c: F.try_variant_get(T.tolerant_json(c), "$.k", "int"), texts) == [1, 2, 3, None]


def test_timestamps(spark):
    raw = ["2024-05-26T11:19:00Z", "2024-05-26T11:19:00+08:00", "2024:05:26 11:19:00", "2024-05-26 11:19:00", "2024-13-45"]
    assert col(spark, lambda c: T.normalize_time(c, 8)[1], raw) == ["utc", "tagged", "exif", "iso", "none"]
    assert str(col(spark, lambda c: T.normalize_time(c, 5.5)[0], raw)[0]) == "2024-05-26 16:49:00"
    names = ["IMG_20240526_111900.jpg", "a 240526-1119.mov", "x_20241399_256199", None]
    assert [None if t is None else str(t) for t in col(spark, T.filename_time, names)] == ["2024-05-26 11:19:00", "2024-05-26 11:19:00", None, None]


def test_unknown_density_keeps_slide(spark):
    df = spark.createDataFrame([(None, 1, 1.0, 1.0), (0.01, 1, 1.0, 1.0), (0.01, 30, 1.0, 1.0)], "d double, n int, k double, l double")
    skip, _ = rules.skip_gate(F.col("d"), F.col("n"), F.col("k"), F.col("l"))
    assert [r[0] for r in df.select(F.coalesce(skip, F.lit(False))).collect()] == [False, True, False]


def test_language_verdict(spark):
    df = spark.createDataFrame([(60, 40), (5, 95), (30, 70), (0, 0), (80, 20), (100, 0), (0, 9)], "c int, l int")
    verdict = rules.language_verdict(F.col("c"), F.col("l"))
    assert [tuple(r) for r in df.select(*verdict).collect()] == [("zh", 0.5), ("en", 1.0), ("bilingual", 0.5), ("bilingual", 0.5), ("zh", 1.0), ("zh", 1.0), ("en", 1.0)]
    near = spark.createDataFrame([(70, 30), (12, 88), (9, 91)], "c int, l int")
    assert [tuple(r) for r in near.select(*verdict).collect()] == [("zh", 0.75), ("bilingual", 0.5), ("en", 0.9)]


def test_unique_match(spark):
    names = spark.createDataFrame([("clip1",), ("clip",), ("take one",), ("zzz",)], "name string")
    stems = spark.createDataFrame([("clip1",), ("clip10",), ("one",)], "stem string")
    got = {r.name: (r.stem, r.how) for r in match.unique_match(names, stems).collect()}
    assert got == {"clip1": ("clip1", "exact"), "clip": (None, "none"), "take one": ("one", "substring"), "zzz": (None, "none")}
    names = spark.createDataFrame([("x",), ("ab",), ("long name q",), ("é",)], "name string")
    stems = spark.createDataFrame([("box",), ("cab",), ("q",), ("tab",), ("né",)], "stem string")
    got = {r.name: (r.stem, r.how) for r in match.unique_match(names, stems).collect()}
    assert got == {"x": ("box", "substring"), "ab": (None, "none"), "long name q": ("q", "substring"), "é": ("né", "substring")}


def test_short_names_are_found_in_texts(spark):
    rows = spark.createDataFrame([(1, "take a1, then b2x"), (2, "c"), (3, "")], "k long, t string")
    names = spark.createDataFrame([("a1",), ("b2x",), ("c",), ("",), ("zz",)], "name string")
    assert sorted(map(tuple, match.contained(rows, "k", "t", names).collect())) == [(1, "a1", 6), (1, "b2x", 15), (2, "c", 1)]


def test_natural_order_of_long_numbers(spark):
    names = ["a2", "a10", "A1", "a" + "9" * 25, "a1" + "0" * 25, "a010", "b"]
    keys = col(spark, T.natural_key, names)
    order = sorted(range(len(names)), key=lambda i: keys[i])
    assert [names[i] for i in order] == ["A1", "a2", "a10", "a010", "a" + "9" * 25, "a1" + "0" * 25, "b"]


def test_globs(spark):
    pairs = [("clip_*.mp4", "clip_01.mp4", True), ("c?.m", "c1.m", True), ("c[0-3]x", "c2x", True), ("c[!0-3]x", "c2x", False), ("c[", "c[", True), ("a.b", "axb", False), ("[]]", "]", True)]
    df = spark.createDataFrame(pairs, "g string, t string, want boolean")
    assert [r[0] for r in df.select(F.regexp_like("t", T.glob_to_regex(F.col("g"))) == F.col("want")).collect()] == [True] * len(pairs)


def test_nearest_hash_ties_and_limit(spark):
    cache = spark.createDataFrame([(10, 0, 0, 0), (11, 1, 0, 3)], "entry long, pos int, hi long, lo long")
    frames = spark.createDataFrame([(1, 0, 1), (2, 0, 2**32 - 1), (3, 0, 3)], "frame long, hi long, lo long")
    assert {r.frame: (r.entry, r.distance) for r in match.nearest_hash(frames, cache).collect()} == {1: (10, 1), 3: (11, 0)}


@QUICK
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 9)), max_size=12), st.lists(st.tuples(st.integers(0, 40), st.integers(0, 9)), max_size=12), st.booleans())
def test_interval_join_is_the_nested_loop(spark, left, right, closed):
    a = spark.createDataFrame([(i, s, s + n) for i, (s, n) in enumerate(left)], "i int, a0 int, a1 int")
    b = spark.createDataFrame([(j, s, s + n) for j, (s, n) in enumerate(right)], "j int, b0 int, b1 int")
    got = sorted((r.i, r.j) for r in interval_join(a, b, [], ("a0", "a1"), ("b0", "b1"), 7, closed).collect())
    meets = (lambda s, e, t, f: s <= f and t <= e) if closed else (lambda s, e, t, f: s < f and t < e)
    assert got == sorted((i, j) for i, (s, n) in enumerate(left) for j, (t, m) in enumerate(right) if meets(s, s + n, t, t + m))


@QUICK
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 8)), min_size=1, max_size=14))
def test_merged_ranges_are_the_sweep(spark, spans):
    df = spark.createDataFrame([(1, i, s, s + n) for i, (s, n) in enumerate(spans)], "g int, i int, a int, b int")
    got = sorted((r.a, r.b) for r in S.merge_ranges(df, ["g"], "a", "b", 5, ["b", "i"]).collect())
    want = []
    for s, e in sorted((s, s + n) for s, n in spans):
        if want and s <= want[-1][1] + 5:
            want[-1][1] = max(want[-1][1], e)
        else:
            want.append([s, e])
    assert got == [tuple(x) for x in want]


def test_replacements(spark):
    master = spark.createDataFrame([("c", 0, 0, 10), ("c", 1, 10, 20), ("c", 2, 20, 30)], "clip string, seg_idx int, start_ms int, end_ms int")
    rep = spark.createDataFrame([("c", 5, 14)], "r_clip string, ra int, rb int")
    merged = sorted((r.start_ms, r.end_ms, r.origin) for r in replace_segments(master, rep).collect())
    assert merged == [(5, 14, "replacement"), (10, 20, "master"), (20, 30, "master")]
    assert replace_segments(master, rep.limit(0)).count() == 3


def test_forward_fill_drops_leading_rows(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, 5), (1, 3, None)], "g int, i int, v int")
    assert [(r.i, r.f) for r in S.forward_fill(df, ["g"], ["i"], "v", "f").orderBy("i").collect()] == [(2, 5), (3, 5)]


def test_transcript_shapes(spark):
    seg = '{"start": 0, "end": 1.5, "text": "a"}'
    df = spark.createDataFrame([("x", f"[{seg}]"), ("y", f'{{"segments": [{seg}, {seg}]}}'), ("z", "[]")], "clip string, value string")
    assert sorted((r.clip, r.seg_idx) for r in readers.segments_from_json(df).collect()) == [("x", 0), ("y", 0), ("y", 1)]
    with pytest.raises(Exception, match="neither a list"):
        readers.segments_from_json(spark.createDataFrame([("w", '{"other": 1}')], "clip string, value string")).collect()


def test_adapter_lines_and_route(spark):
    lines = spark.createDataFrame([("noise",), ('{"image": "a.png", "page_confidence": 0.5}',), ('{"fixture": "b"}',), ("{broken",)], "value string")
    good, counts = readers.adapter_lines(lines)
    assert sorted(r.image for r in good.collect()) == ["a.png", "b"] and tuple(counts.first()) == (3, 1)
    files = spark.createDataFrame([("a.mp4",), ("b.M4A",), ("c.pdf",), ("d.txt",)], "name string")
    assert [r.step for r in readers.route_plan(files).orderBy("n").collect()] == ["transcribe", "align", "slides_from_pdf", "ground", "write"]


def test_merge_settings_and_upsert(spark):
    assert readers.deep_merge({"a": {"b": 1, "c": 2}}, {"a": {"b": None, "c": 3}}) == {"a": {"b": 1, "c": 3}}
    assert readers.deep_merge({"a": {"b": 1}, "x": [1]}, {"a": 5, "n": {"m": {"k": 2}}, "x": None}) == {"a": 5, "x": [1], "n": {"m": {"k": 2}}}
    assert readers.deep_merge({"a": 1, "e": {}}, {"a": {"b": 2}}) == {"a": {"b": 2}, "e": {}} and readers.deep_merge({"a": 1}, None) == {"a": 1}
    old, new = spark.createDataFrame([(1, 5, "o"), (2, 5, "o")], "k int, t int, v string"), spark.createDataFrame([(1, 5, "n"), (3, 1, "n")], "k int, t int, v string")
    assert sorted((r.k, r.v) for r in sinks.upsert(old, new, ["k"], "t").collect()) == [(1, "n"), (2, "o"), (3, "n")]


def test_empty_result_is_not_written(spark, tmp_path):
    with pytest.raises(ValueError):
        sinks.write_if_any(spark.createDataFrame([], "a int"), str(tmp_path / "t"))


def test_fuzzy_ratio():
    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]

    for a, b in [("tendon", "the tendinous part"), ("abc", "xaybzc"), ("", "a"), ("ab", "ba")]:
        assert common_length(a, b) == lcs(a, b)
    assert partial("tendon", "the tendon is") == 100.0 and partial("", "x") == 0.0 and partial("tendon", "tandem") == 60.0


def test_citations():
    assert parse_group("V1 04:22-04:31") == [("V1", 262, 271, False)]
    assert parse_group("V1 05:02, 06:13") == [("V1", 302, None, False), ("V1", 373, None, False)]
    assert parse_group("V1 16:47, V2 00:00") == [("V1", 1007, None, False), ("V2", 0, None, False)]
    assert parse_group("05:02") == [] and parse_group("05:02", "a.mp4") == [("a.mp4", 302, None, False)]
    assert parse_group("see V1 07:30 he says") == [] and parse_group("1:00:05", "a.mp4") == [("a.mp4", 3605, None, False)]
    legal = {
        "seg06 V1 01:10": [("V1", 70, None, False)], "c00 14:17": [("c00", 857, None, False)], "A1 05:00": [("A1", 300, None, False)],
        "V2 28:30-42": [("V2", 1710, 1722, False)], "x.MP4 04:22": [("x.MP4", 262, None, False)], "clip.m2ts 01:02": [("clip.m2ts", 62, None, False)],
        "V1 ⚠️approx 03:00": [("V1", 180, None, True)], "00006.MTS 29:50–00007.MTS 01:25": [("00006.MTS", 1790, None, False), ("00007.MTS", 85, None, False)],
        "15 knee lat 1_x264.mp4 100:43；101:00": [("15 knee lat 1_x264.mp4", 6043, None, False), ("15 knee lat 1_x264.mp4", 6060, None, False)],
    }
    assert {k: parse_group(k) for k in legal} == legal
    assert parse_group("V9 01:00", known={"V1"}) == [] and parse_group("120:80", "a.mp4") == [] and parse_group("a: 1 V1 00:10") == []
    assert citations("x `(V1 00:10)` y (no clock) (120:80)") == [("V1", 10, None, False)] and citations(None) == []


def greedy_pieces(words, max_dur, soft_dur, gap):
    pieces = [[]]
    for k, (text, start, end) in enumerate(words):
        held = pieces[-1]
        if held and (start - held[-1][2] > gap or end - held[0][1] > max_dur or held[-1][0][-1:] in folds.HARD or held[-1][0][-1:] in folds.SOFT and held[-1][2] - held[0][1] >= soft_dur):
            pieces.append(held := [])
        held.append((text, start, end))
    return [(k, round(p[0][1], 2), round(p[-1][2], 2), " ".join(x[0] for x in p)) for k, p in enumerate(pieces) if p]


def test_resegmented_words_are_the_greedy_loop(spark):
    draw, rows, want = random.Random(8), [], []
    for clip in range(4):
        now, words = 0.0, []
        for k in range(80):
            now += draw.choice([0, 0, 0, 0.5, 4.0]) if k else 0
            lasts = draw.choice([0.25, 0.5, 1.0, 9.0 if k % 29 == 0 else 0.5])
            words.append((draw.choice(["one", "two", "three"]) + draw.choice(["", "", "", ".", ",", "。"]), now, now + lasts))
            now += lasts
        rows += [(clip, k // 7, k % 7, f" {w}", a, b) for k, (w, a, b) in enumerate(words)]
        want += [(clip, *p) for p in greedy_pieces(words, 8.0, 4.0, 3.0)]
    got = folds.resegment(spark.createDataFrame(rows, "clip long, seg_idx long, pos long, word string, start double, end double"))
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert folds.resegment(got.limit(0).selectExpr("clip", "piece seg_idx", "piece pos", "text word", "start", "end")).count() == 0


def test_bracketing_looks_backwards_only(spark):
    """Against a plain loop; no frame reaches to a group's end, which Spark reads anew for every row."""
    draw = random.Random(5)
    rows = [(by, k, draw.choice([None, None, 10 * k + draw.randint(0, 9)])) for by in [None, 1, 2] for k in range(40)] + [(3, 0, None), (4, 0, 7), (5, None, 1), (5, 2, None)]
    serial = lambda r: (r[1] is not None, r[1] or 0)
    want = set()
    for by, k, at in rows:
        timed = sorted((r for r in rows if r[0] == by and r[2] is not None), key=serial)
        earlier, later = [r[2] for r in timed if serial(r) < serial((by, k))], [r[2] for r in timed if serial(r) > serial((by, k))]
        want.add((by, k, at, *((earlier or [None])[-1:] + (later or [None])[:1] if at is None else [None, None])))
    draw.shuffle(rows)
    got = gates.bracketed(spark.createDataFrame(rows, "by long, serial long, at long"), "by", "serial", "at")
    assert set(map(tuple, got.collect())) == want and len(want) == len(rows)
    assert "unboundedfollowing" not in got._jdf.queryExecution().toString().lower()


def test_pieces_are_cut_in_one_pass_over_batches(spark):
    """Pieces run across Arrow batches, clips share them, a clip or word without value is not lost; no call per sentence, no join."""
    draw, rows, want = random.Random(21), [], []
    for clip in [None, *range(30)]:
        words, now = [], 0.0
        for _ in range(draw.randint(1, 40)):
            words.append((draw.choice("abc") + draw.choice(["", "", "", ".", ","]), now, now + draw.choice([0.25, 1.0, 9.0])))
            now = words[-1][2] + draw.choice([0, 0, 4.0])
        rows += [(clip, 0, k, *w) for k, w in enumerate(words)]
        want += [(clip, *p) for p in greedy_pieces(words, 8.0, 4.0, 3.0)]
    rows += [(40, 0, 0, None, 0.0, 0.5), (40, 0, 1, "x", 0.5, 1.0), (41, 0, 0, "x", 0.0, None), (41, 0, 1, "y", None, 1.0)]
    want += [(40, 0, 0.0, 0.5, ""), (40, 1, 0.5, 1.0, "x"), (41, 0, 0.0, None, "x"), (41, 1, None, 1.0, "y")]
    draw.shuffle(rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        got = folds.resegment(spark.createDataFrame(rows, "clip long, seg_idx long, pos long, word string, start double, end double"))
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapGroups" not in plan and "Join" not in plan


def test_texts_without_word_times_are_spread(spark):
    rows = spark.createDataFrame([(1, "ab。cdef", 0.0, 20.0), (2, "short", 1.0, 3.0), (3, "", 0.0, 50.0)], "k long, text string, start double, end double")
    got = sorted(map(tuple, folds.spread_text(rows, 9.0).select("k", "piece", "start", "end", "text").collect()))
    assert got == [(1, 0, 0.0, 8.57, "ab。"), (1, 1, 8.57, 17.14, "cde"), (1, 2, 17.14, 20.0, "f"), (2, 0, 1.0, 3.0, "short"), (3, 0, 0.0, 50.0, "")]


def plain_rate_windows(rows, share, window):
    """Every start in turn, by the definition; ``rows`` are (start, end, characters)."""
    rates = sorted(n / (b - a) for a, b, n in rows if b - a > 0.5 and n)
    median, found, at = rates[len(rates) // 2], [], 0
    while at < len(rows):
        mine = []
        for row in rows[at:]:
            if row[1] - rows[at][0] >= window:
                break
            mine.append(row)
        span = mine[-1][1] - rows[at][0] if mine else 0
        slow = mine and rows[at][1] - rows[at][0] >= 0.5 and span >= 0.8 * window and sum(r[2] for r in mine) / span < share * median
        if slow:
            found.append((rows[at][0], mine[-1][1], round(sum(r[2] for r in mine) / span, 6)))
        at += len(mine) if slow else 1
    return found


def test_rate_windows_are_the_definition():
    draw, hits = random.Random(3), 0
    for _ in range(30):
        now, rows = 0.0, []
        for _ in range(60):
            lasts = draw.choice([0.25, 2.0, 5.0, 7.0])
            rows.append((now, now + lasts, draw.choice([0, 3, 10, 60])))
            now += lasts + draw.choice([0, 0, 1.0])
        frame = pd.DataFrame({"clip": 1, "seg_idx": range(60), "start": [r[0] for r in rows], "end": [r[1] for r in rows], "text": ["x" * r[2] for r in rows]})
        got = folds.rate_windows(0.6, 30.0)(frame)
        want = plain_rate_windows(rows, 0.6, 30.0)
        assert list(got[["start", "end", "rate"]].itertuples(index=False, name=None)) == want
        hits += len(want)
    assert hits > 30


def test_folds():
    span = folds.span_groups(60, 100)(pd.DataFrame({"clip": 1, "seg_idx": [0, 1, 2, 3], "start_ms": [0, 50, 90, 300], "end_ms": [40, 80, 120, 310]}))
    assert span["grp"].tolist() == [0, 0, 1, 2]
    hashes = pd.DataFrame({"clip": 1, "pos": [0, 1, 2], "hi": [0, 0, 2**32 - 1], "lo": [0, 1, 2**32 - 1]})
    assert folds.drift_groups(hashes)["grp"].tolist() == [0, 0, 1]


@given(st.text("abcd ", min_size=1, max_size=12), st.text("abcd ", max_size=60), st.sampled_from([85, 88, 90]))
@settings(max_examples=400, deadline=None)
def test_reaching_a_ratio_is_having_it(a, b, least):
    assert reaches(a, b, least) == (partial(a, b) >= least)


@given(st.integers(0, 2**32), st.sampled_from([85, 88, 90]))
@settings(max_examples=300, deadline=None)
def test_reaching_a_ratio_near_the_bound(seed, least):
    draw = random.Random(seed)
    a = "".join(draw.choices("abcdefghijkl", k=draw.randint(8, 24)))
    w = list(a)
    for _ in range(draw.randint(1, 4)):
        w[draw.randrange(len(w)) :][:1] = []
        at = draw.randrange(len(w))
        w[at : at + draw.randint(0, 1)] = draw.choice(["", "x", "y"])
    b = "".join(draw.choices("abcdefghijkl ", k=draw.randint(0, 30))) + "".join(w) + "".join(draw.choices("abcdefghijkl ", k=draw.randint(0, 30)))
    assert reaches(a, b, least) == (partial(a, b) >= least)


def test_grounding_by_plain_loops(spark):
    import re

    from skein.operators.ground import LEAST, ground

    draw = random.Random(6)
    stems = ["tendinopathy", "rehabilitation", "MRI", "adalimumab", "shoulder", "motion", "x-ray", "arthritis", "exercise", "ALS", "肩關節復健科", "supraspinatus"]

    def bend(w):
        at = draw.randrange(1, len(w))
        return draw.choice([w, "e" + w, w[:at] + "x" + w[at + 1 :], w[:at] + w[at + 1 :]]) if len(w) < 8 else w[:at] + draw.choice(["x", "", "xx"]) + w[at + 1 :]

    slides = [(k, 1, 15 * k, 15 * k + 15, " ".join(draw.sample(stems, 6)) + " Motion") for k in range(8)]
    segments = [(1, k, 9000 * k, 9000 * k + 8000, " ".join(bend(draw.choice(stems)) for _ in range(6)) if k % 5 else "knee") for k in range(16)]
    got = {r.slide_id: r for r in ground(spark.createDataFrame(slides, "slide_id long, clip long, start_s long, end_s long, quick_text string"), spark.createDataFrame(segments, "clip long, seg_idx long, start_ms long, end_ms long, text string"), {"msk": ["shoulder", "肩"], "lab": ["none of it"]}).collect()}
    kinds = {w: c for w, c in zip(stems + ["Motion"], col(spark, T.keyword_class, stems + ["Motion"]), strict=True)}
    n_fuzzy = 0
    for k, _, a, b, text in slides:
        heard = [t for _, _, s, e, t in segments if e >= max(0, a * 1000 - 20_000) and s <= b * 1000 + 20_000]
        keys = list(dict.fromkeys((w if kinds[w] == "abbreviation" else w.lower(), kinds[w]) for w in text.split() if kinds[w]))
        hits = []
        for key, kind in keys:
            if kind == "abbreviation":
                ok = any(re.search(rf"(?<![A-Za-z0-9]){key}(?![A-Za-z0-9])", t) for t in heard)
            elif len(key) <= 7:
                ok = any(re.search(rf"(?<![a-z0-9]){key}", t.lower()) if key.isascii() else key in t for t in heard)
            else:
                ok = any(partial(key, t.lower()) >= LEAST[kind] for t in heard)
                n_fuzzy += ok and not any(key in t.lower() for t in heard)
            hits += [key] * ok
        assert got[k].n_keywords == len(keys) and abs(got[k].reference_density - len(hits) / len(keys)) < 1e-6 and got[k].n_segments == len(heard)
        assert got[k].top_keywords == ",".join(list(dict.fromkeys(hits + [w for w, _ in keys]))[:5])
        assert got[k].domains == ("msk" if any("shoulder" in t.lower() or "肩" in t for t in [*heard, text]) else "")
    assert n_fuzzy > 3


@pytest.mark.parametrize("broadcast", [0, 500_000])
def test_votes_are_the_histogram(spark, monkeypatch, broadcast):
    monkeypatch.setattr(match, "BROADCAST_GRAMS", broadcast)
    draw = random.Random(4)
    recs = {k: "".join(draw.choices("abcde", k=400)) + "the same refrain " * 6 for k in range(3)}
    clips = {k: "xx" + recs[k % 3][40 * k : 40 * k + 90] + "the same refrain zz" for k in range(7)} | {9: "short", 10: None}
    rows = lambda d: spark.createDataFrame(list(d.items()), "id long, text string")
    got = {r.clip: (r.rec, r.offset, r.votes) for r in match.vote_offsets(rows(clips), rows(recs), 25).collect()}
    squeezed = lambda t: "".join((t or "").split())
    grams = lambda t: [t[i : i + 6] for i in range(len(t) - 5)]
    want = {}
    for c, text in clips.items():
        votes = {}
        for r, whole in recs.items():
            places = {}
            for at, g in enumerate(grams(squeezed(whole))):
                places.setdefault(g, []).append(at)
            for ct, g in enumerate(grams(squeezed(text))):
                for rt in places.get(g, []) if len(places.get(g, [])) <= 4 else []:
                    key = (r, round((ct - rt) / 25) * 25)
                    votes[key] = votes.get(key, 0) + 1
        ranked = sorted((-sum(votes.get((r, o + d), 0) for d in (-25, 0, 25)), r, o) for r, o in votes)
        if ranked:
            want[c] = (ranked[0][1], ranked[0][2], -ranked[0][0])
    assert got == want and len(want) >= 7


def test_late_events_are_left_out(spark, tmp_path):
    from skein.streaming import events as E

    write = lambda rows, n: spark.createDataFrame(rows, "event_id long, at string, user_id long, event_type string, value double, props string").selectExpr("event_id", "cast(at as timestamp_ntz) ts", "user_id", "event_type", "value", "props").write.parquet(str(tmp_path / f"in/{n}"))
    write([(1, "2024-01-01 00:00:10", 1, "a", 1.0, ""), (2, "2024-01-01 02:00:00", 1, "a", 1.0, "")], 1)
    stream = E.tumbling(E.read_log(spark, str(tmp_path / "in/*")), "1 hour", "10 minutes")
    sink = lambda: stream.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    sink()
    write([(3, "2024-01-01 00:30:00", 1, "a", 1.0, ""), (4, "2024-01-01 05:00:00", 1, "a", 1.0, "")], 2)
    sink()
    got = sorted((r.start_s % 86400, r.n) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(0, 1), (7200, 1)]  # event 3 came behind the watermark


def test_camcorder_clock(spark):
    def stream(pack, mark=b"MDPM"):
        return bytearray(b"\x00\x4d" + mark + b"\x01\x18\x00\x99" + pack + bytes(300))

    good, bad = bytes([0x18, 0xC0, 0x20, 0x24, 0x05, 0x19, 0x26, 0x11, 0x19, 0x42]), bytes([0x18, 0xC0, 0x20, 0x24, 0x13, 0x19, 0x26, 0x11, 0x19, 0x42])
    rows = [stream(good), stream(bad), stream(good, b"NOPE"), stream(bad + good), bytearray(b"")]
    got = col(spark, readers.avchd_clock, rows, "binary")
    assert [None if t is None else str(t) for t in got] == ["2024-05-26 11:19:42", None, None, "2024-05-26 11:19:42", None]


def test_pixels(spark):
    from skein.functions import pixels as P

    assert col(spark, P.mean_hash, [[0.0, 1.0, 2.0, 5.0]], "array<double>") == ["0001"]
    assert col(spark, lambda c: P.gradient_hash(c, 2), [[0.0, 1.0, 5.0, 2.0]], "array<double>") == ["10"]
    flat, spike = [1.0] * 16, [0.0] * 5 + [1.0] + [0.0] * 10
    assert col(spark, lambda c: F.round(P.laplacian_variance(c, 4), 6), [flat, spike], "array<double>") == [0.0, 4.25]
    same = P.bhattacharyya(P.histogram(F.col("v"), 0.0, 1.0, 4), P.histogram(F.col("v"), 0.0, 1.0, 4))
    assert col(spark, lambda c: same, [[0.1, 0.6, 0.6, 2.0]], "array<double>")[0] < 1e-6
    assert col(spark, lambda c: P.polygon_area(c, F.array(F.lit(0.0), F.lit(0.0), F.lit(3.0), F.lit(3.0))), [[0.0, 2.0, 2.0, 0.0]], "array<double>") == [6.0]
    assert col(spark, lambda c: P.fused_similarity(c, F.lit(0.5)), [None, 1.0], "double") == [None, 0.8]


def test_markdown(spark):
    from skein.functions import markdown as M

    note = "---\ntitle: A b\ntier: 2\n---\n# x\n![[a.png|400]] see [[n#s|alias]] and [[m]] ==hot==\n![[b.jpg]]"
    assert col(spark, lambda c: M.frontmatter(c, "title"), [note, "title: no", ""]) == ["A b", None, None]
    assert [[tuple(x) for x in r] for r in col(spark, M.image_embeds, [note])] == [[("a.png", 400), ("b.jpg", None)]]
    assert [[tuple(x) for x in r] for r in col(spark, M.links, [note])] == [[("n", "s", "alias"), ("m", None, None)]]
    assert col(spark, lambda c: M.plain_links(M.body(c)), [note]) == ["# x\n see alias and m hot\n"]
    assert col(spark, lambda c: M.cut_at_space(c, 10), ["short", "123456789 12", "12 3456789012"]) == ["short", "123456789", "12 3456789"]
    assert col(spark, M.json_strings, ['{"k": "v", "l": ["a", 1, {"m": "b\\"c"}]}']) == [["v", "a", 'b\\"c']]
    assert col(spark, M.table_cells, ["| a | b |", "text"]) == [["a", "b"], None]
    lines = spark.createDataFrame([(1, 0, "intro"), (1, 1, "## clip 01 — x"), (1, 2, "t"), (1, 3, "## clip 02 — y")], "n int, i int, line string")
    assert [r.section for r in M.sections(lines, "n", "i", "line", r"^## clip \d+").orderBy("i").collect()] == [0, 1, 1, 2]


def test_adapters(spark):
    from skein.functions import adapters as A

    def weak(paths):
        if len(paths) > 2:
            raise MemoryError
        if "bad" in paths:
            raise ValueError("broken")
        return [(p.upper(), 0.5 if p == "low" else 0.9) for p in paths]

    images = spark.createDataFrame([(x,) for x in ("a", "bad", "low", "d", "e")], "image string").coalesce(1)
    first = A.run_engine(images, weak)
    second = A.run_engine(images, lambda paths: [("2" + p, 1.0) for p in paths])
    got = {r.image: (r.text, r.reason) for r in A.with_fallback(first, second).collect()}
    assert got == {"a": ("A", None), "bad": ("2bad", "error"), "low": ("2low", "low_confidence"), "d": ("D", None), "e": ("E", None)}
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise A.Transient
        return 7

    assert A.retry(flaky) == 7


def test_gates(spark):
    from skein.operators import gates as G

    rows = spark.createDataFrame([("a", True, False, 2.0), ("a", True, True, 4.0), ("a", False, False, None), ("b", False, False, 1.0)], "stage string, called boolean, failed boolean, s double")
    counted = G.counters(rows, "stage", F.col("called"), F.col("failed"), F.col("s"))
    got = {r.stage: (r.n_input, r.n_called, r.n_failed, r.mean_s, r.fail_ratio, r.eta_s) for r in counted.collect()}
    assert got == {"a": (3, 2, 1, 3.0, 0.5, 3.0), "b": (1, 0, 0, None, None, None)}
    assert G.guard(counted.where("stage = 'a'"), 0.5).count() == 1
    for bad in (counted.where("stage = 'a'"), counted.where("stage = 'b'"), counted.limit(0)):
        with pytest.raises(G.GateError):
            G.guard(bad)
    names = ["a/b/x.y.MTS", "plain", ".hidden", "dir.d/file"]
    assert col(spark, G.extension, names) == [".mts", "", ".hidden", ""] and col(spark, G.stem, names) == ["x.y", "plain", ".hidden", "file"]
    assert col(spark, G.language_code, ["auto", "bilingual", "en", None]) == [None, "zh", "en", None]
    assert col(spark, G.schema_fault, ["{", "[]", '{"fixture": 1}', None]) == ["not an object", "not an object", "fixture wrong type", "not an object"]
    assert col(spark, lambda c: F.size(G.ocr_items(c)), ["null", "[]", '[[], "t"]', None, "[[], [0.1]]", '{"txts": []}']) == [0, 0, 0, 0, 0, 0]


def test_rows_are_ranked_across_partitions(spark):
    draw = random.Random(2)
    rows = [(k, draw.choice([None, *range(40)])) for k in range(500)]
    got = {r.k: r.place for r in S.ranked(spark.createDataFrame(rows, "k long, v long").repartition(5), [F.col("v").asc_nulls_last(), "k"], "place").collect()}
    want = sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[0]))
    assert [got[k] for k, _ in want] == list(range(1, 501))
    assert S.ranked(spark.createDataFrame([], "k long"), ["k"]).count() == 0


def test_decks_and_settings(spark, tmp_path):
    texts = [("a", '[{"n": 1}, {"n": 2}]'), ("b", '{"slides": [{"n": 3}]}'), ("c", '{"t": "x", "cards": [{"n": 4}], "more": [{"n": 9}]}'), ("d", "[]")]
    got = readers.slide_rows(spark.createDataFrame(texts, "deck string, value string"), "struct<n:int>")
    assert sorted((r.deck, r.pos, r.x.n) for r in got.collect()) == [("a", 0, 1), ("a", 1, 2), ("b", 0, 3), ("c", 0, 4)]
    with pytest.raises(Exception, match="no list of slides"):
        readers.slide_rows(spark.createDataFrame([("e", '{"t": 1}')], "deck string, value string"), "struct<n:int>").collect()
    path = tmp_path / "settings.json"
    path.write_text('{"models": {"aliases": {"big": "{folder}/large"}}, "paths": {"models": "/m/"}, "k": null}')
    settings = readers.read_settings(spark, str(path), {"k": 1, "models": {"aliases": {}}})
    assert settings["k"] == 1 and readers.resolve_alias("big", settings) == "/m/large" and readers.resolve_alias("other", settings) == "other"
    assert readers.read_settings(spark, None, {"k": 1}) == {"k": 1} and readers.read_settings(spark, str(tmp_path / "none"), {"k": 1}) == {"k": 1}
    with pytest.raises(ValueError, match="needs"):
        readers.resolve_alias("big", {"models": {"aliases": {"big": "{folder}/x"}}})


def test_media_folders_and_transcripts(spark, tmp_path):
    for name in ("cam/a.MP4", "cam/b.txt", "rec [1]/c.mp3", "clip1/transcript_clean.json", "clip1/transcript.json"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text('[{"start": 0, "end": 1, "text": "hi"}]')
    got = readers.scan_media(spark, [str(tmp_path / "cam")])
    assert [(r.source, r.file, r.kind) for r in got.collect()] == [("cam", "a.MP4", "video")]
    assert [(r.source, r.kind) for r in readers.scan_media(spark, [f"room={tmp_path}/cam"]).collect()] == [("room", "video")]
    with pytest.raises(FileNotFoundError):
        readers.scan_media(spark, [str(tmp_path / "none")])
    assert readers.resolve_transcript(spark, str(tmp_path / "clip1")).endswith("clip1/transcript.json")
    with pytest.raises(FileNotFoundError):
        readers.resolve_transcript(spark, str(tmp_path / "cam"))
    assert [(r.clip, r.seg_idx, r.text) for r in readers.read_transcripts(spark, f"{tmp_path}/*/transcript.json").collect()] == [("clip1", 0, "hi")]


def test_page_texts_fingerprints_and_times(spark, tmp_path):
    pages = lambda text, n=None: [(r.page, r.text) for r in readers.page_texts(spark.createDataFrame([(text,)], "value string"), pages=n).collect()]
    assert pages('[{"page": 1, "text": "a"}, {"page": 2, "text": "b"}]') == [(0, "a"), (1, "b")] == pages('{"pages": ["a", "b", "c"]}', 2)
    big = bytes(range(256)) * 1024
    (tmp_path / "big.bin").write_bytes(big)
    (tmp_path / "small.bin").write_bytes(b"abc")
    import hashlib

    got = {r.path.rpartition("/")[2]: (r.length, r.fingerprint) for r in readers.media_fingerprint(spark.read.format("binaryFile").load(str(tmp_path))).collect()}
    assert got == {"big.bin": (len(big), hashlib.sha256(big[:65536] + big[-65536:]).hexdigest()[:8]), "small.bin": (3, hashlib.sha256(b"abc").hexdigest()[:8])}
    df = spark.createDataFrame([("2024-05-26 11:19:00", "2024-05-26 11:19:42"), ("2024-05-26 11:19:00", "2024-05-26 11:20:00")], "a string, b string").selectExpr("cast(a as timestamp) a", "cast(b as timestamp) b")
    assert [r[0].second for r in df.select(readers.refine_seconds(F.col("a"), F.col("b"))).collect()] == [42, 0]


def test_sinks_add_keep_and_refuse(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    rows = lambda *v: spark.createDataFrame([(x,) for x in v], "v int")
    sinks.append_events(spark.createDataFrame([(1, None), (2, "own")], "n int, run string"), at("log"), {"run": "r1", "host": "h"})
    sinks.append_events(spark.createDataFrame([(3,)], "n int"), at("log"), {"run": "r2"})
    assert sorted((r.n, r.run) for r in spark.read.json(at("log")).collect()) == [(1, "r1"), (2, "own"), (3, "r2")]
    sinks.append_run_summary(spark, at("runs"), {"done": 5, "host": "mine"}, "r1")
    line = spark.read.json(at("runs")).first()
    assert (line.done, line.host, line.run_id) == (5, "mine", "r1") and line.ts.startswith("20")
    assert sinks.write_once(rows(1), at("o")) and not sinks.write_once(rows(2), at("o")) and spark.read.parquet(at("o")).first().v == 1
    assert sinks.write_once(rows(3), at("o"), force=True) and spark.read.parquet(at("o")).first().v == 3
    sinks.write_new(rows(1), at("n"))
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.write_new(rows(2), at("n"))
    assert sinks.rewrite(rows(1), at("r")) is None
    assert sinks.rewrite(spark.read.parquet(at("r")).selectExpr("v + 1 as v"), at("r")) == at("r.bak")
    assert sinks.rewrite(rows(9), at("r")).startswith(at("r.bak-")) and spark.read.parquet(at("r.bak")).first().v == 1 and spark.read.parquet(at("r")).first().v == 9
    manifest = spark.createDataFrame([(0, "b", 5), (1, "a", 2)], "idx long, src string, start long")
    sinks.reorder_by_time(manifest, at("m"))
    assert sorted((r.idx, r.src) for r in spark.read.parquet(at("m")).collect()) == [(0, "a"), (1, "b")]
    with pytest.raises(ValueError, match="no time"):
        sinks.reorder_by_time(manifest.withColumn("start", F.lit(None).cast("long")), at("m"))
    sinks.write_transcript_lines(spark.createDataFrame([(1, 61.0, " b "), (0, 0.0, "a")], "seg_idx int, start double, text string"), at("t"))
    assert [r.value for r in spark.read.text(at("t")).collect()] == ["[00:00] a", "[01:01] b"] or sorted(r.value for r in spark.read.text(at("t")).collect()) == ["[00:00] a", "[01:01] b"]
    a, b = spark.createDataFrame([("x", 1, 2), ("y", 1, 2), ("z", 1, 2)], "name string, size int, mtime int"), spark.createDataFrame([("x", 1, 2), ("y", 1, 3)], "name string, size int, mtime int")
    assert sorted(r.name for r in sinks.needs_refresh(a, b).collect()) == ["y", "z"]


def test_runs_and_first_seen(spark, tmp_path):
    from skein.streaming import events as E

    rows = spark.createDataFrame([(1, k, s, float(k), k + 0.5) for k, s in enumerate("aabbbac")], "g int, pos int, s string, a double, b double")
    got = S.runs(rows, ["g"], ["pos"], F.col("s"), F.col("s") != "c", 2, "a", "b")
    assert sorted((r.first_pos, r.last_pos, r.run_start, r.run_end, r.n) for r in got.collect()) == [(0, 1, 0.0, 1.5, 2), (2, 4, 2.0, 4.5, 3)]
    make = lambda rows, n: spark.createDataFrame(rows, "event_id long, at string, user_id long, event_type string, value double, props string").selectExpr("event_id", "cast(at as timestamp_ntz) ts", "user_id", "event_type", "value", "props").write.parquet(str(tmp_path / f"in/{n}"))
    make([(1, "2024-01-01 00:00:10", 1, "a", 1.0, ""), (2, "2024-01-01 00:00:20", 1, "a", 1.0, ""), (3, "2024-01-01 00:00:30", 1, "b", 1.0, "")], 1)
    log = lambda: E.read_log(spark, str(tmp_path / "in/*"))
    assert sorted(r.event_type for r in E.drain(E.first_seen(log(), "1 hour"), "append").collect()) == ["a", "b"]
    name = f"test-{random.random()}"
    follow = lambda: {r.user_id: (r.stage, r.n) for r in E.drain(E.lifecycle(log()), "update", ["user_id"], name).collect()}
    assert follow() == {1: ("b", 3)}
    make([(4, "2024-01-01 01:00:00", 1, "c", 1.0, ""), (5, "2024-01-01 01:00:00", 2, "a", 1.0, "")], 2)
    assert follow() == {1: ("c", 4), 2: ("a", 1)} == follow()  # the named run goes on where it stopped


def test_container_and_exif_probes(spark, tmp_path):
    import struct

    from skein.sources import probes

    box = lambda kind, body: struct.pack(">I", 8 + len(body)) + kind + body
    when = probes.EPOCH_1904 + 1_716_722_340
    mvhd = box(b"mvhd", bytes(4) + struct.pack(">IIII", when, when, 1000, 62_500) + bytes(80))
    name = b"com.apple.quicktime.CreationDate"
    keys = box(b"keys", bytes(4) + struct.pack(">I", 1) + struct.pack(">I", 8 + len(name)) + b"mdta" + name)
    ilst = box(b"ilst", box(struct.pack(">I", 1), box(b"data", struct.pack(">II", 1, 0) + b"2024-05-26T19:19:00+0800")))
    plain = box(b"ftyp", b"isom") + box(b"mdat", b"x" * 50) + box(b"moov", mvhd)
    assert probes.probe_container(plain) == (62.5, "2024-05-26T11:19:00Z", None)
    assert probes.probe_container(box(b"ftyp", b"qt  ") + box(b"moov", mvhd + box(b"meta", keys + ilst))) == (62.5, "2024-05-26T19:19:00+0800", None)
    long = box(b"mvhd", b"\1\0\0\0" + struct.pack(">QQIQ", when, when, 600, 1200))
    assert probes.probe_container(box(b"ftyp", b"isom") + box(b"moov", long))[0] == 2.0

    def tiff(order, taken, changed):
        texts, top, sub = b"", [], []
        base = 8 + 2 + 12 * 3 + 4 + 2 + 12 + 4
        for into, tag, text in ((top, 306, changed), (top, 272, "Cam X"), (sub, 36867, taken)):
            raw = text.encode() + b"\0"
            into.append((tag, 2, len(raw), base + len(texts)))
            texts += raw
        top.append((34665, 4, 1, 8 + 2 + 12 * 3 + 4))
        pack = lambda rows: struct.pack(order + "H", len(rows)) + b"".join(struct.pack(order + "HHII", *r) for r in rows) + bytes(4)
        return (b"II*\0" if order == "<" else b"MM\0*") + struct.pack(order + "I", 8) + pack(top) + pack(sub) + texts

    for order in "<>":
        body = b"Exif\0\0" + tiff(order, "2024:05:26 11:19:00", "2024:06:01 00:00:00")
        jpeg = b"\xff\xd8\xff\xe0\0\4ab\xff\xe1" + struct.pack(">H", 2 + len(body)) + body + b"\xff\xd9"
        assert probes.probe_exif(jpeg) == ("2024:06:01 00:00:00", "Cam X") and probes.probe_exif(body[6:])[1] == "Cam X"
    assert probes.probe_exif(b"\xff\xd8\xff\xd9") == (None, None) and probes.probe_container(b"") == (None, None, None)
    for file, data in (("a.mp4", plain), ("b.jpg", jpeg), ("c.txt", b"text"), ("d.tif", b"II*\0" + b"\xff" * 4)):
        (tmp_path / file).write_bytes(data)
    got = {r.path.rpartition("/")[2]: tuple(r)[1:] for r in probes.probe(spark.read.format("binaryFile").load(str(tmp_path))).collect()}
    assert got["a.mp4"] == (62.5, "2024-05-26T11:19:00Z", None, None) and got["b.jpg"][1] == "2024:06:01 00:00:00" and got["c.txt"] == (None,) * 4 and set(got) == {"a.mp4", "b.jpg", "c.txt", "d.tif"}


def test_notes_are_made_ready(spark):
    from skein.functions import markdown as M

    text = "---\ntags: a\n---\n# L3 Title\n> [!note] Head ==x==\n> [!tip]\ntext\n---\n## 課程 Hub\n[[_HUB]]\n"
    assert col(spark, M.preprocessed, [text, "plain"]) == ["# Title\n> **【note】 Head <mark>x</mark>**\n>\n> **【tip】**\n>\ntext\n", "plain"]
    notes = spark.createDataFrame([(1, "a ![[f1.jpg|600]] b [[L2_seg01_x#s|al]] c01_frame_02 [[gone]] ![[no.png]] [[L3_seg09_wrong]] end"), (2, "none"), (3, "")], "note int, text string")
    names = spark.createDataFrame([("f1.jpg", "nice.jpg"), ("L2_seg01_x", "Part one"), ("c01_frame_02.jpg", "frame two.jpg"), ("L3_seg09_right", "Nine")], "old string, new string")
    got = {r.note: r.text for r in M.rewritten_links(notes, names).collect()}
    assert got == {1: "a ![[nice.jpg|600]] b [[Part one#s|al]] frame two.jpg [[gone]] ![[no.png]] [[Nine]] end", 2: "none", 3: ""}
    ts = '<a class="ts" data-t="5">▶</a>'
    items = [f"<li>said {ts} here</li><li>plain</li>", f"<li>a<ul><li>b {ts}</li></ul></li>", f'<li class="q">{ts} first</li>']
    assert col(spark, M.stamps_first, items) == [f"<li>{ts} said here</li><li>plain</li>", f"<li>a<ul><li>{ts} b</li></ul></li>", f'<li class="q">{ts} first</li>']


@pytest.mark.parametrize("cap", [None, 100])
def test_semantic_groups_by_plain_loops(spark, cap):
    draw = random.Random(9)
    base = ["rotator cuff tear", "frozen shoulder", "supraspinatus tendon", "", None]
    rows, now = [], 0
    for k in range(80):
        now += draw.choice([1, 5, 70])
        text = draw.choice(base)
        rows.append((k // 40, k, now, now + 10, text and draw.choice([text, text + " more", text[:-1]]), draw.choice([None, 0.5, 0.9])))
        now += 10
    want, group = {}, -1
    for k, (clip, pos, start, end, text, fused) in enumerate(rows):
        before = rows[k - 1] if k and rows[k - 1][0] == clip else None
        a, b = (text or "").strip(), (before and before[4] or "").strip()
        alike = bool(a and b and partial(a, b) >= 88) or (fused or 0) > 0.85
        if before is None:
            group, first = 0, start
        elif not (alike and start - before[3] < 60 and (cap is None or end - first <= cap)):
            group, first = group + 1, start
        want[pos] = group
    got = folds.semantic_groups(spark.createDataFrame(rows, "clip long, seg_idx long, start_ms long, end_ms long, text string, fused double"), 60, cap)
    assert {r.seg_idx: r.grp for r in got.collect()} == want and max(want.values()) > 5


def test_reliable_claims(spark):
    from skein.operators import gates as G

    assert col(spark, G.reliable, ["exif", "mtime", "mtime-x", "none", None, "filename"]) == [True, False, False, False, False, True]


@pytest.mark.parametrize("within", [0, 3, 6, 7])
def test_nearest_hash_is_all_pairs(spark, within):
    draw = random.Random(within)
    entries = [draw.getrandbits(64) for _ in range(60)]
    frames = [draw.getrandbits(64) for _ in range(20)]
    for e in entries * 2:
        for bit in draw.sample(range(64), draw.randrange(9)):
            e ^= 1 << bit
        frames.append(e)
    split = lambda h: (h >> 32, h & 0xFFFFFFFF)
    cache = spark.createDataFrame([(100 + k, k, *split(h)) for k, h in enumerate(entries)], "entry long, pos int, hi long, lo long")
    got = {r.frame: (r.entry, r.distance) for r in match.nearest_hash(spark.createDataFrame([(k, *split(h)) for k, h in enumerate(frames)], "frame long, hi long, lo long"), cache, within).collect()}
    want = {}
    for k, f in enumerate(frames):
        distance, entry = min(((f ^ e).bit_count(), j) for j, e in enumerate(entries))
        if distance <= within:
            want[k] = (100 + entry, distance)
    assert got == want and len(want) > 5


@pytest.mark.parametrize("least", [0.3, 0.6, 1.0])
def test_best_jaccard_is_all_pairs(spark, least):
    draw = random.Random(int(least * 10))
    word = lambda: " ".join(draw.choices(["the", "knee", "joint", "exam", "of", "hip", "pain"], k=draw.randint(1, 4)))
    left, right = sorted({word() for _ in range(40)} | {"ab", ""}), sorted({word() for _ in range(40)})
    grams = lambda t: {x[i : i + 3] for x in ["".join(t.lower().split())] for i in range(len(x) - 2)}
    want = {}
    for a in left:
        scored = sorted((-len(grams(a) & grams(b)) / len(grams(a) | grams(b)), b) for b in right if grams(a) & grams(b))
        if scored and -scored[0][0] >= least:
            want[a] = (scored[0][1], round(-scored[0][0], 9))
    got = match.best_jaccard(spark.createDataFrame([(x,) for x in left], "title string"), spark.createDataFrame([(x,) for x in right], "match string"), least)
    assert {r.title: (r.match, round(r.score, 9)) for r in got.collect()} == want and want


def test_embeds_are_expanded(spark):
    from skein.functions import markdown as M

    text = "intro\n[[EMBED s1: my words]]\nsee [[EMBED s2]] and [[EMBED s9]] end\n[[EMBED s3]]\n\n[[EMBED s4]]\n```\n[[EMBED s1]]\n```\nlast [[EMBED s4 : x ]]"
    slides = spark.createDataFrame([(1, "a.jpg", 600, "cap", 1, None), (2, None, None, "two", 2, ""), (3, "c.jpg", 1, "c", 3, None), (4, "d.jpg", 400, None, 2, None), (5, "e.jpg", 1, "", 1, "dup")], "slide_id long, name string, width int, caption string, tier int, suppressed string")
    lines = spark.createDataFrame([(1, k, x) for k, x in enumerate(text.split("\n"))] + [(2, 0, "[[EMBED s5]]"), (2, 1, "stays")], "note long, line_no int, line string")
    got = {r.note: r.text for r in M.expanded_embeds(lines, slides, "att").collect()}
    block = lambda k, words, tier, name, width: f"> [!figure] s{k} — {words} (T{tier})\n> ![[att/{name}|{width}]]"
    one, two, four = block(1, "my words", 1, "a.jpg", 600), block(2, "two", 2, "s02.jpg", 500), block(4, "figure", 2, "d.jpg", 400)
    want = f"intro\n\n{one}\n\nsee (見 s2 圖 ↓) and  end\n\n{two}\n\n\n{four}\n\n```\n[[EMBED s1]]\n```\nlast (見 s4 圖 ↓)\n\n{block(4, 'x', 2, 'd.jpg', 400)}\n"
    assert got == {1: want, 2: "stays"}

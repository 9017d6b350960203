"""Queries that must do the whole job: plain loops over rows that a cut would lose."""

import random

import pytest

from skein.operators import match
from skein.plans import grounding, matching, timeline


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_hints_are_all_pairs(spark):
    draw = random.Random(3)
    made = {"".join(draw.choices("abcd", k=draw.randint(1, 9))) for _ in range(150)}
    tokens, words = ["kardiac", "fone", *sorted(made)[::2]], ["cardiac", "phone", *sorted(made)[1::2], *sorted(made)[:9]]
    want = set()
    for t in tokens:
        near = sorted((d, d / max(len(t), len(w)), w) for w in words if 0 < (d := lev(t, w)) <= max(2, len(t) // 2))
        want |= {(t, w, d, k) for k, (d, _, w) in enumerate(near[:3], 1)}
    table = lambda rows, name: spark.createDataFrame([(r,) for r in rows], f"{name} string")
    assert set(map(tuple, grounding.hints(table(tokens, "token"), table(words, "w")).collect())) == want
    assert {("kardiac", "cardiac", 1, 1), ("fone", "phone", 2, 1)} <= want


def test_scan_reads_past_3000_characters(spark, tmp_path):
    rows = [(k, f"book{k}", "filler " * 1000 + "farword " + "pad " * 73_248 + " beyond") for k in range(3)]
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.word: r.n_books for r in grounding.corpus_scan_capped(spark, str(tmp_path)).collect()}
    assert got == {"filler": 3, "farword": 3, "pad": 3}


def test_interleave_carries_whole_speech_and_six_lines(spark, tmp_path):
    page = "  \r\n" + "\r\n".join(f"line {k} " + "w" * 60 for k in range(4)) + "\n\n\x85more\nlast\n　"
    talk = "said " * 50 + "\nand the end"
    spark.createDataFrame([(0, page, "s", "en"), (1, "", "s", "en"), (2, " one ", "s", "en")], "doc_id long, text string, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, 0, "user", talk), (0, 1, "assistant", "short")], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {(r.kind, r.pos): r.text for r in timeline.time_interleave(spark, str(tmp_path)).collect()}
    lines = lambda t: " / ".join(t.strip().splitlines()[:6])
    assert got == {(0, 0): lines(page), (0, 1): "", (0, 2): "one", (1, 0): talk, (1, 1): "short"}


@pytest.mark.parametrize("limit", [match.BROADCAST_NAMES, 0])
def test_names_meet_texts_and_the_parts_of_texts_stay_off_the_driver(spark, tmp_path, monkeypatch, limit):
    """Names of all head lengths, by both ways; Spark's estimate must not have it broadcast what the texts are cut into."""
    draw = random.Random(12)
    word = lambda: "".join(draw.choices("ab#é𝄞", k=draw.choice([1, 2, 3, 4, 5, 6, 7, 13, 30, 130])))
    rows = [(k, " ".join(word() for _ in range(draw.randint(0, 3))), draw.choice(["a#b", "", "éé"]), draw.choice(["bab", "aaaaaaaa", "𝄞"])) for k in range(120)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    names = {w for _, name, _, _ in rows for w in name.split(" ") if w}
    want = {}
    for k, name, brand, kind in rows:
        text = f"{kind} / {name} / {brand}"
        want[k] = ",".join(w for _, w in sorted((text.find(w), w) for w in names if w in text))
    monkeypatch.setattr(match, "BROADCAST_NAMES", limit)
    got = matching.substring_ordered_collect(spark, str(tmp_path))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BuildLeft" not in plan and plan.count("BroadcastExchange") == (limit > 0)
    assert {r.p_partkey: r.clips for r in got.collect()} == want


@pytest.mark.parametrize("lengths", [match.LENGTHS, 2])
def test_names_that_begin_alike_meet_few_texts_in_vain(spark, monkeypatch, lengths):
    """300 names share a head of six; each meets the texts that hold its own length of it, and none is lost with fewer lengths."""
    names = [f"ring#1{k}" for k in range(300)] + ["r", "ring", "g#1"]
    texts = [(k, f"x ring#1{k} y") for k in range(300)]
    monkeypatch.setattr(match, "LENGTHS", lengths)
    got = match.contained(spark.createDataFrame(texts, "k long, t string"), "k", "t", spark.createDataFrame([(n,) for n in names], "name string"))
    assert set(map(tuple, got.collect())) == {(k, n, t.find(n) + 1) for k, t in texts for n in names if n in t}
    plan = got._jdf.queryExecution().toString()
    assert lengths == 2 or all(f"{{{n}}}" in plan for n in {len(n) for n in names})

"""The corpus operators against brute force, exact round trips or held-out accuracy; nulls, ties, clashes, empty tables."""

import hashlib
import json
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from skein.llm import bpe, components, exact_dedup, histogram_shards, jaccard_join, language_id, mixing, mpeg_audio, secrets, tool_calls, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
RNG = random.Random(7)


def words(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n))


def docs_of(spark, texts, first=0):
    rows = [(first + i, t, "en", f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


LONG = words(30_000, 1)
AWKWARD = [None, "", " ", "a", "same text", "same text", "é中文 \U0001f600\n\tx", LONG, "\x1c odd\x1d spaces \xa0  end  "]


# -- exact dedup


def brute_groups(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    return {(i, max(groups[t or ""]), len(groups[t or ""]), i == max(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows}


def test_exact_dedup(spark):
    texts = AWKWARD + ["copy"] * 40
    got = exact_dedup.exact_dedup(docs_of(spark, texts)).collect()
    assert set(map(tuple, got)) == brute_groups(list(enumerate(texts))) and len(got) == len(texts)


def test_exact_dedup_tells_colliding_hashes_apart(spark):
    weak = lambda text: F.unhex(F.lpad(F.hex(F.length(text) % 2), 2, "0"))
    texts = ["aa", "bb", "aa", "c", "dddd", "bb"]
    got = exact_dedup.exact_dedup(docs_of(spark, texts), hasher=weak)
    assert set(map(tuple, got.collect())) == brute_groups(list(enumerate(texts)))


def test_exact_dedup_empty_and_clashing_columns(spark):
    assert exact_dedup.exact_dedup(docs_of(spark, [])).count() == 0
    clash = docs_of(spark, ["x", "x"]).withColumns({"keep_id": F.lit(1), "_h": F.lit(2), "kept": F.lit(None), "_sha": F.lit(0), "group_size": F.lit(9)})
    assert exact_dedup.exact_dedup(clash).where("kept").count() == 1
    clash = clash.withColumns({"d": F.lit(5), "_id": F.lit(6), "_gh": F.lit(7), "n": F.lit(8)})
    kept = exact_dedup.drop_copies(clash)
    assert kept.columns == clash.columns and [(r.doc_id, r._h, r.d) for r in kept.collect()] == [(1, 2, 5)]
    assert exact_dedup.drop_copies(clash.limit(0)).count() == 0
    again = docs_of(spark, ["x", "x", "y", None]).unionByName(docs_of(spark, ["x", "x", "z", ""])).unionByName(spark.createDataFrame([(None, "n", "b", None, 1), (None, "n", "a", None, 1)], DOCS))
    got = sorted(((r.doc_id, r.text or "", r.lang) for r in exact_dedup.drop_copies(again).collect()), key=str)
    assert got == sorted([(1, "x", "en"), (2, "y", "en"), (2, "z", "en"), (3, "", "en"), (None, "n", "a")], key=str)
    assert exact_dedup.exact_dedup(again).where("doc_id = 1").select("kept", "group_size").distinct().collect() == [(True, 4)]
    nulls = spark.createDataFrame([(None, "x"), (3, "x"), (None, "y")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.kept) for r in exact_dedup.exact_dedup(nulls).collect()) == [(0, False), (0, True), (3, True)]


# -- toxicity


def test_toxicity_on_held_out_rows(spark):
    data = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    scored = toxicity.toxicity(docs, labels)
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert scored.count() == docs.count() and len(rows) > 500
    assert sum(r.predicted == r.toxic for r in rows) / len(rows) >= 0.97
    assert {zlib.crc32(str(r.doc_id).encode()) % 4 for r in rows} == {2}


def test_toxicity_without_labels_and_on_awkward_rows(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    out = toxicity.toxicity(docs_of(spark, AWKWARD).withColumn("score", F.lit("x")), none).collect()
    assert len(out) == len(AWKWARD) and all(0 <= r.score <= 1 for r in out)
    assert toxicity.toxicity(docs_of(spark, []), none).count() == 0
    clash = docs_of(spark, AWKWARD).withColumns({"_score": F.lit("mine"), "_y": F.lit(1), "_id": F.lit(2), "_text": F.lit(3)})
    kept = toxicity.drop_toxic(clash, none)
    assert kept.columns == clash.columns and {r._score for r in kept.collect()} == {"mine"}
    assert toxicity.drop_toxic(clash.limit(0), none).count() == 0
    odd = spark.createDataFrame([(None, "x y z"), (None, "x y z"), (4, None), (4, None)], "doc_id long, text string")
    rows = toxicity.toxicity(odd, spark.createDataFrame([(None, 1), (4, 1), (4, 0)], "doc_id long, toxic int")).collect()
    assert len(rows) == 4 and len({r.score for r in rows if r.doc_id is None}) == 1 and not any(r.held_out for r in rows if r.doc_id is None)


def insulted(n, seed, every):
    w = words(n, seed).split(" ")
    if every:
        for k in range(every // 2, n, every):
            w[k] = ("idiot", "moron", "clown")[k % 3]
    return " ".join(w)


def toxic_model():
    texts = [insulted(60 + k % 50, k, 30 if k % 2 else 0) for k in range(400)]
    return toxicity.fit_model(texts, [k % 2 for k in range(400)], 0.2)


def brute_bucket(gram):
    low, word = (1 << 64) - 1, len(gram)
    for c in gram:
        word = (word * 0x100000001B3 + ord(c)) & low
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        word = (word ^ word >> shift) * factor & low
    return word >> 64 - toxicity.BITS


def test_toxicity_score_is_brute_force():
    model = toxic_model()
    texts = ["", "a", "idiot", "Ä \U0001f600 Idiot,\nmoron", *(insulted(50, 900 + k, 20 * (k % 2)) for k in range(6)), LONG[:20_000] + " idiot" * 30]
    for text, got in zip(texts, model.scores(texts), strict=True):
        low = text.lower()
        held = {brute_bucket(low[k : k + n]) for n in toxicity.ORDERS for k in range(len(low) - n + 1)}
        held = [x for x in held if model.known[x]]
        z = model.bias + sum(float(model.weight[x]) for x in held) / max(1, len(held)) ** 0.5
        assert abs(got - 1 / (1 + np.exp(-z))) < 1e-6


def test_log_count_ratios_speak_for_both_labels():
    texts, labels = [insulted(40, k, 15 if k % 2 else 0) + (" thanks" if not k % 2 else "") for k in range(60)], [k % 2 for k in range(60)]
    held = toxicity.features(texts)
    ratios = toxicity.log_count_ratios(held, np.array(labels, dtype=float))
    for gram, sign in (("moro", 1), ("hanks", -1)):
        n1, n0 = (sum(gram in t.lower() for t, y in zip(texts, labels, strict=True) if y == k) for k in (1, 0))
        want = np.log((n1 + toxicity.SMOOTH / 2) / 30) - np.log((n0 + toxicity.SMOOTH / 2) / 30)
        assert abs(ratios[brute_bucket(gram)] - want) < 1e-6 and want * sign > 0
    model = toxicity.fit_features(held, labels)
    assert (model.weight > 0).any() and (model.weight < 0).any()


def test_toxicity_has_one_rule_for_every_length():
    model = toxic_model()
    for n in (40, 80, 160, 320):
        assert model.scores([insulted(n, 992 + n, 0)])[0] < 0.3 <= model.scores([insulted(n, 991 + n, 20)])[0]
    assert model.scores([insulted(30_000, 990, 0)])[0] < 0.3
    text = insulted(4000, 993, 60)
    z = model.logits([text[:n] for n in range(7900, 8110, 10)])  # a few more characters change little, wherever they stand
    assert np.abs(np.diff(z)).max() < 0.1


def test_an_over_long_labelled_text_is_passed_over(spark, monkeypatch):
    rows = [(k, insulted(60, k, 25 if k % 2 else 0) if k != 5 else LONG) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(300)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "MAX_TEXT", 5000)
    out = toxicity.toxicity(docs, labels).collect()
    assert sum(r.predicted == r.doc_id % 2 for r in out if r.doc_id != 5) > 280
    monkeypatch.setattr(toxicity, "MAX_TEXT", 10**9)
    monkeypatch.setattr(toxicity, "MAX_CHARS", len(LONG) - 1)
    out = toxicity.toxicity(docs, labels).collect()
    assert sum(r.predicted == r.doc_id % 2 for r in out if r.doc_id != 5) > 280


# -- n-gram Jaccard join


def brute_links(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    label = {i: i for i, _ in rows}

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y]):
                a, b = sorted((top(x), top(y)))
                label[b] = a
    return {(i, len(sets[i]), top(i)) for i in ids}


def edited(text, n, seed):
    rng, w = random.Random(seed), text.split(" ")
    for _ in range(n):
        w[rng.randrange(len(w))] = "zz" + str(rng.randrange(10**6))
    return " ".join(w)


def near_copies():
    base = [words(n, n) for n in (3, 4, 5, 9, 17, 40, 80, 160, 400)]
    texts = AWKWARD[:7] + base + [b.upper() for b in base[3:5]]
    for k, b in enumerate(base):
        texts += [edited(b, e, 100 * k + e) for e in range(1, 1 + max(2, len(b.split()) // 20))]
    line = words(14, 5000)
    texts += [words(30, 6000 + k) + "\n" + line for k in range(25)] + [edited(base[7], 4, 9000 + k) for k in range(30)]
    return texts


def test_jaccard_join_is_brute_force(spark):
    rows = list(enumerate(near_copies()))
    got = jaccard_join.link_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert set(map(tuple, got)) == brute_links(rows) and len(got) == len(rows)


def test_jaccard_join_in_one_exhaustive_round(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "ROUNDS", 0)
    monkeypatch.setattr(jaccard_join, "CHUNK_DOCS", 7)
    monkeypatch.setattr(jaccard_join, "BLOCK_DOCS", 5)
    monkeypatch.setattr(jaccard_join, "SEEN", 3)
    monkeypatch.setattr(jaccard_join, "BROADCAST_IDS", 0)  # every table is joined by shuffles
    rows = list(enumerate(near_copies()))
    got = jaccard_join.link_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert set(map(tuple, got)) == brute_links(rows)


def test_jaccard_join_other_seed_and_rows(spark):
    hot = np.zeros(0, dtype=np.uint64)
    one, two = (np.unique(jaccard_join.mix64(np.arange(a, b, dtype=np.uint64))) for a, b in ((0, 300), (20, 300)))
    assert jaccard_join.linked(one, two)
    for seed in (0, 3):
        probe, rest = jaccard_join.signatures(one, 8, True, hot, seed)
        other = np.concatenate(jaccard_join.signatures(two, 8, True, hot, seed))
        assert len(np.intersect1d(probe, other))
    assert jaccard_join.link_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    odd = spark.createDataFrame([(None, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (5, "a b c d e f")], "doc_id long, text string").withColumns({"label": F.lit(1), "part": F.lit(2), "doc": F.lit(3)})
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in jaccard_join.link_documents(odd).collect()) == [(0, 0), (2, 2), (2, 2), (5, 2)]
    assert sorted(r.doc_id or 0 for r in jaccard_join.keep_one(odd).collect()) == [0, 2, 2]


def test_copies_stay_out_of_the_rounds(spark, monkeypatch):
    """Of many copies of few texts, only the few that stand for them come to the driver."""
    looked = []
    real = jaccard_join._lookup
    monkeypatch.setattr(jaccard_join, "_lookup", lambda spark, table, key, values: looked.append(table.count()) or real(spark, table, key, values))
    base = words(80, 77)
    rows = [(k, (base, edited(base, 1, 5), words(60, 78))[k % 3]) for k in range(3000)]
    rows += [(5000, edited(base, 2, 9)), (5001, "alone and apart " + words(9, 4))]
    got = jaccard_join.link_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3, "doc_id")).collect()
    want = {k: 0 if k % 3 < 2 else 2 for k in range(3000)} | {5000: 0, 5001: 5001}
    assert {r.doc_id: r.component_id for r in got} == want and sum(looked) < 100
    odd = [(1, base), (2, base), (2, words(50, 3)), (3, words(50, 3)), (9, words(50, 3)), (4, words(70, 8))]
    got = {r.doc_id: r.component_id for r in jaccard_join.link_documents(spark.createDataFrame(odd, "doc_id long, text string").coalesce(1)).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 9: 1, 4: 4}  # an id that repeats links what its texts link
    assert jaccard_join.keep_one(spark.createDataFrame([], "doc_id long, text string, _gone int")).count() == 0


@pytest.mark.parametrize("band", range(14))
def test_allocation_has_enough_units(band):
    m, _ = jaccard_join.allocate(band)
    assert m == 0 or m >= jaccard_join.units_needed(1 << band) // 2


def test_sketches_never_exceed_the_difference():
    for k in range(30):
        a = np.unique(jaccard_join.mix64(np.arange(0, 200 + k, dtype=np.uint64)))
        b = np.unique(jaccard_join.mix64(np.arange(k, 260, dtype=np.uint64)))
        rows = jaccard_join.fold([jaccard_join.sketch(a), jaccard_join.sketch(b)])
        assert np.bitwise_count(rows[0] ^ rows[1]).sum() <= len(np.setxor1d(a, b))


def test_components_of_chains(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 90), (90, 95)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {k: 0 for k in range(41)} | {90: 90, 95: 90, 100: 90}


# -- mixing


def brute_topic(text):
    return "table" if " | " in text else "legal" if re.search("licen[cs]e|copyright", text.lower()) else "contact" if re.search("@[a-z0-9]+[.]|[0-9]{6}", text) else "lines" if "\n" in text else "prose"


def brute_mix(rows, targets=None, budget=None):
    """Probability by cell; ``rows`` are (source, lang, topic, tokens)."""
    cells = Counter()
    for *cell, tokens in rows:
        cells[tuple(cell)] += tokens
    total, goals = sum(cells.values()), []
    for d, power in enumerate(mixing.POWERS.values()):
        own = Counter()
        for k, v in cells.items():
            own[k[d]] += v
        want = (targets or {}).get(mixing.DIMS[d]) or {x: v**power for x, v in own.items()}
        goals.append({x: want.get(x, 0) / sum(want.values()) for x in own})
    most = min([1.0] + [sum(v for k, v in cells.items() if k[d] == x) / total / g for d in range(3) for x, g in goals[d].items() if g])
    budget, weight = budget or mixing.BUDGET * most, dict.fromkeys(cells, 1.0)
    for _ in range(60):
        for d in range(3):
            for x, share in goals[d].items():
                mine, goal = [k for k in cells if k[d] == x], share * budget * total
                lo, hi = 0.0, 1e12  # bisection for the label's factor
                for _ in range(200):
                    f = (lo + hi) / 2 if lo else hi / 2 if hi > 1e-9 else 0.0
                    lo, hi = (f, hi) if sum(cells[k] * min(1.0, f * weight[k]) for k in mine) < goal else (lo, f)
                for k in mine:
                    weight[k] *= hi
    return {k: min(1.0, w) for k, w in weight.items()}, budget


CELLS = [("a", "en", "x", 500), ("a", "de", "x", 40), ("a", "en", "y", 300), ("b", "en", "x", 30), ("b", "de", "y", 70), ("c", "de", "x", 25), ("c", "en", "y", 35), ("d", "en", "x", 0)]


@pytest.mark.parametrize("budget", [0.3, 0.57])
def test_raking_both_ways_is_brute_force(spark, budget):
    """At the larger budgets some cells are held at probability 1."""
    targets = {"source": {"a": 5, "b": 1, "c": 0.7}, "lang": {"en": 8, "de": 2}, "topic": {"x": 5, "y": 5}}
    table = spark.createDataFrame(CELLS, "source string, lang string, topic string, tokens long")
    want, _ = brute_mix(CELLS, targets, budget)
    assert (max(want.values()) == 1) == (budget > 0.5)  # then one cell is held at 1
    for way in (mixing.rake, mixing.rake_by_source):
        got = {(r.source, r.lang, r.topic): (r.tokens, r.prob) for r in way(table, mixing.given_targets(table, targets), budget, 1e-5).collect()}
        assert got.keys() == want.keys() and all(abs(got[k][1] - want[k]) <= 1e-3 for k in want if got[k][0])
        for d, dim in enumerate(mixing.DIMS):
            for label, weight in targets[dim].items():
                share = sum(n * p for k, (n, p) in got.items() if k[d] == label) / (1000 * budget)
                assert abs(share / (weight / sum(targets[dim].values())) - 1) < 1.1e-5


def test_mixing_meets_every_target(spark, data):
    """Expected tokens within a hundredth of the targets (far less, in fact); those of the sample near them."""
    rows = mixing.mix(spark.read.parquet(f"{data}/documents.parquet")).collect()
    want, budget = brute_mix([(r.source, r.lang, r.topic, r.tokens) for r in rows])
    assert all(abs(r.prob - want[r.source, r.lang, r.topic]) < 1e-5 for r in rows)
    total = sum(r.tokens for r in rows)
    for dim in mixing.DIMS:
        has, expected, drawn = Counter(), Counter(), Counter()
        for r in rows:
            has[r[dim]] += r.tokens
            expected[r[dim]] += r.tokens * r.prob
            drawn[r[dim]] += r.tokens * r.selected
        whole = sum(v ** mixing.POWERS[dim] for v in has.values())
        for label, n in has.items():
            goal = n ** mixing.POWERS[dim] / whole * budget * total
            assert abs(expected[label] / goal - 1) < 0.001 and abs(drawn[label] - goal) < 0.35 * goal
        assert abs(sum(drawn.values()) / total - budget) < 0.05


def test_mixing_to_given_weights(spark):
    docs = docs_of(spark, [words(20 + k % 7, k) for k in range(600)])
    rows = mixing.mix(docs, {"source": {"src0": 1, "src1": 2, "src2": 3}}).collect()
    sums = Counter()
    for r in rows:
        sums[r.source] += r.tokens * r.prob
    assert all(abs(sums[f"src{k}"] / sum(sums.values()) - (k + 1) / 6) < 1e-4 for k in range(3))
    with pytest.raises(mixing.NotMet):
        mixing.mix(docs, {"source": {"src0": 1, "src1": 2, "src2": 3}}, budget=0.9)
    with pytest.raises(mixing.NotMet):
        mixing.mix(docs, {"source": {"src0": 1, "elsewhere": 2}})
    only = mixing.mix(docs, {"source": {"src1": 1}}, budget=0.2).collect()
    assert {r.source for r in only if r.selected} == {"src1"}
    against = spark.createDataFrame([(k, words(30, k), "en" if k % 2 else "de", "s" if k % 2 else "t", 0) for k in range(40)], DOCS)
    with pytest.raises(mixing.NotMet):  # each source holds one language
        mixing.mix(against, {"source": {"s": 1, "t": 3}, "lang": {"en": 3, "de": 1}}, budget=0.1)


def test_mixing_awkward_rows(spark):
    assert mixing.mix(docs_of(spark, [])).count() == 0 and mixing.sample(docs_of(spark, [])).count() == 0
    odd = docs_of(spark, AWKWARD).withColumn("source", F.lit(None).cast("string")).withColumn("lang", F.lit(None).cast("string")).withColumns({"topic": F.lit(1), "prob": F.lit(2), "tokens": F.lit(0), "_id": F.lit(1), "_c_text": F.lit(4), "selected": F.lit(5)})
    out = mixing.mix(odd).collect()
    assert len(out) == len(AWKWARD) and {r.source for r in out} == {"(none)"} and all(0 <= r.prob <= 1 for r in out)
    kept = mixing.sample(odd)
    assert kept.columns == odd.columns and {r.prob for r in kept.collect()} <= {2}
    twice = docs_of(spark, [words(40, k) for k in range(60)])
    twice = twice.unionByName(twice).unionByName(spark.createDataFrame([(None, "no id here", "en", "src0", 3)] * 2, DOCS))
    drawn = defaultdict(set)
    for r in mixing.mix(twice).collect():
        drawn[r.doc_id].add(r.selected)
    assert all(len(v) == 1 for v in drawn.values()) and drawn[None] == {False}
    none = mixing.mix(docs_of(spark, [None, "", " "])).collect()
    assert [(r.tokens, r.prob, r.selected) for r in none] == [(0, 0.0, False)] * 3


# -- sharding


def test_shards_are_even_and_gapless(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = histogram_shards.shard_documents(docs, 16).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert len(rows) == len(texts)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
    load, slots = Counter(), defaultdict(list)
    for r in rows:
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert sorted(load) == list(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(load.values()) / 16
    assert max(abs(v - mean) for v in load.values()) <= 0.01 * mean + max(r.size for r in rows)


def test_shards_are_a_sort(spark, data):
    """Shards in turn, slots in turn: the rows by hash of the text and id; a text lies in one shard; cuts are where sizes ask."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    want = [r.doc_id for r in docs.orderBy(F.xxhash64(F.coalesce("text", F.lit(""))), "doc_id").collect()]
    for source in (docs, docs.withColumn("doc_id", F.concat(F.lit("id-"), "doc_id"))):
        rows = sorted(histogram_shards.shard_documents(source, 16).collect(), key=lambda r: (r.shard, r.slot))
        if source is docs:
            assert [r.doc_id for r in rows] == want
        text, where = {r.doc_id: r.text or "" for r in source.collect()}, defaultdict(set)
        total, below = sum(r.size for r in rows), Counter()
        for r in rows:
            where[text[r.doc_id]].add(r.shard)
            below[r.shard] += r.size
        assert len(rows) == len(want) and all(len(s) == 1 for s in where.values())
        edges = np.cumsum([below[k] for k in range(16)])
        group = Counter()
        for r in rows:
            group[text[r.doc_id]] += r.size
        assert all(abs(edge - total * (k + 1) / 16) <= total / 16 * 0.005 + max(group.values()) for k, edge in enumerate(edges))
    again = docs_of(spark, ["x", None, "y"]).unionByName(docs_of(spark, ["x", None, "y"])).withColumn("doc_id", F.when(F.col("doc_id") > 0, F.col("doc_id")))
    rows = histogram_shards.shard_documents(again, 4).collect()
    assert len(rows) == 6 and sorted((r.shard, r.slot) for r in rows) == sorted({(r.shard, r.slot) for r in rows})


def test_shards_split_hot_groups_and_awkward_rows(spark):
    texts = ["hot text of a third"] * 600 + [words(5, k) for k in range(1200)]
    rows = histogram_shards.shard_documents(docs_of(spark, texts), 16).collect()
    load = Counter()
    for r in rows:
        load[r.shard] += r.size
    assert max(load.values()) - min(load.values()) < 0.2 * sum(load.values()) / 16
    assert histogram_shards.shard_documents(docs_of(spark, [])).count() == 0
    few = histogram_shards.shard_documents(docs_of(spark, AWKWARD).withColumns({"part": F.lit(1), "size": F.lit(2), "_h": F.lit(3)})).collect()
    assert len(few) == len(AWKWARD) and {r.size for r in few if r.doc_id in (0, 1)} == {1}
    assert Counter(r.shard for r in few).total() == len(AWKWARD)


def test_written_shards(spark, tmp_path):
    histogram_shards.write_shards(docs_of(spark, [words(9, k) for k in range(50)]), str(tmp_path / "s"), 4)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 50 and back.select("shard").distinct().count() == 4
    clash = docs_of(spark, [words(9, k) for k in range(20)]).withColumns({"shard": F.lit("mine"), "slot": F.lit(1), "_id": F.lit(2)})
    histogram_shards.write_shards(clash, str(tmp_path / "t"), 2)
    back = spark.read.parquet(str(tmp_path / "t"))
    assert set(back.columns) == {*clash.columns, "shard_"} and {r.shard for r in back.collect()} == {"mine"} and back.count() == 20
    histogram_shards.write_shards(clash.limit(0), str(tmp_path / "u"), 2)
    with pytest.raises(ValueError, match="repeats"):
        histogram_shards.write_shards(docs_of(spark, ["a"]).unionByName(docs_of(spark, ["b"])), str(tmp_path / "v"), 2)


# -- BPE

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_bpe_is_the_library(spark):
    ranks = bpe.read_ranks(PATH)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [*AWKWARD[:7], AWKWARD[8], words(300, 3), " it's  'tis\n\n x\t y  ", "<|endoftext|>", "a" * 3000, "don’t　 \xa0 12 345 ½ x²", "̀combining é"]
    rows = bpe.encode_documents(docs_of(spark, texts), PATH, public_tokenizers.PATTERN).collect()
    for text, r in zip(texts, sorted(rows, key=lambda r: r.doc_id), strict=True):
        ids = library.encode_ordinary(text or "")
        assert r.token_ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_bpe_decodes_and_handles_empty_tables(spark):
    rows = bpe.encode_documents(docs_of(spark, ["é中文", ""]).withColumn("decoded_x", F.lit(1)), PATH, public_tokenizers.PATTERN)
    assert sorted(bytes(r.decoded) for r in bpe.decode_ids(rows, PATH).collect()) == [b"", "é中文".encode()]
    assert bpe.encode_documents(docs_of(spark, []), PATH, public_tokenizers.PATTERN).count() == 0
    clash = rows.withColumn("decoded", F.lit("mine"))
    back = bpe.decode_ids(clash, PATH)
    assert back.columns == [*clash.columns, "decoded_"] and {bytes(r.decoded_) for r in back.collect()} == {b"", "é中文".encode()}
    odd = spark.createDataFrame([(None, "a b"), (None, "a b"), (7, None)], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_tokens) for r in bpe.encode_documents(odd, PATH, public_tokenizers.PATTERN).collect()) == [(0, 2), (0, 2), (7, 0)]


def test_bpe_with_a_pattern_that_spans_spaces(spark):
    pattern = r"\p{L}+(?: \p{L}+)*|\s|[^\s\p{L}]+"
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})
    texts = ["the cat sat on the mat, twice", words(40, 6), "a  b c 1 2"]
    rows = bpe.encode_documents(docs_of(spark, texts), PATH, pattern).collect()
    assert [r.token_ids for r in sorted(rows, key=lambda r: r.doc_id)] == [library.encode_ordinary(t) for t in texts]


def test_perfect_hash_has_no_false_hits_and_full_memos_do_not_matter(monkeypatch):
    keys = [str(k).encode() for k in range(2000)]
    table = bpe.MinimalPerfectHash(keys, list(range(2000)))
    assert [table.get(k) for k in keys] == list(range(2000)) and all(table.get(str(k).encode()) == -1 for k in range(2000, 4000))
    monkeypatch.setattr(bpe, "MEMO_ENTRIES", 3)
    codec = bpe.Codec(bpe.read_ranks(PATH), public_tokenizers.PATTERN)
    text = words(200, 8)
    assert codec.encode(text) == codec.encode(text) and codec.decode(codec.encode(text)) == text.encode()


# -- secrets


def brute_secrets(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in re.finditer(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[1]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    access = [s for s in spans if s[1] == 1]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 24]
    base = sorted(spans)
    weak = [(m.start(), 3, m.end()) for m in re.finditer(secrets.SECRET, text)] + [(m.start(), 4, m.end()) for m in re.finditer(secrets.ENDPOINT, text)]
    near = [w for w in weak if any(w[0] < a[2] + secrets.SCOPE and w[2] > a[0] - secrets.SCOPE for a in access)]
    write = lambda xs: ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in xs)
    count = Counter(k for _, k, _ in base)
    return count[0], count[1], count[2], hashlib.sha256(write(base).encode()).hexdigest(), write(sorted(base + near))


def secret_texts():
    key, part = "AKIA" + "ABCD1234" * 2, "wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEY12"
    texts = [
        f'x {key} token = "abc" password: hunter2x secret:token:abcdefg',
        f"{key} then {part} at https://s3.example.com/b?c=1.",
        f"{part} and https://example.com/ without any key",
        f"{key}" + " far" * 300 + f" {part}",
        "API_KEY='0123456789abcdef0123456789abcdef' PassWd=ab token=password=abcdefgh AKIASHORT",
        "é中文 " * 50 + f"token: {'f' * 30} {key.lower()}",
        " ".join(f"token=value{k:06d}" for k in range(1500)),
        f"{part} " * 30 + key,
    ]
    return texts + AWKWARD[:7]


def test_secrets_are_the_patterns(spark):
    texts = secret_texts()
    rows = secrets.scan_secrets(docs_of(spark, texts).withColumns({"spans": F.lit(1), "base": F.lit(2), "hex": F.lit(3)})).collect()
    for text, r in zip(texts, sorted(rows, key=lambda r: r.doc_id), strict=True):
        assert tuple(r)[1:] == brute_secrets(text), text[:80]


def test_secrets_empty_and_repeated(spark):
    assert secrets.scan_secrets(docs_of(spark, [])).count() == 0
    same = spark.createDataFrame([(None, secret_texts()[1])] * 3, "doc_id long, text string")
    assert [r.spans.count("secret") for r in secrets.scan_secrets(same).collect()] == [1, 1, 1]


# -- language ID


def test_language_of_pages_and_documents(spark, data):
    pages, docs = spark.read.parquet(f"{data}/pages.parquet"), spark.read.parquet(f"{data}/documents.parquet")
    out = language_id.identify(pages, docs)
    assert out.count() == pages.count() + docs.count()
    hits = out.where("doc_id IS NOT NULL").join(docs.select("doc_id", F.col("lang").alias("want")), "doc_id").agg(F.avg((F.col("lang") == F.col("want")).cast("int"))).first()[0]
    assert hits > 0.95
    told = out.where("page_id IS NOT NULL").agg(F.avg((F.col("lang") == F.col("declared")).cast("int"))).first()[0]
    assert told > 0.9


def test_evidence_without_text(spark):
    model = language_id.text_model(["the and of it is " * 20, "der und die das ist " * 20], ["en", "de"])
    page = lambda i, host, lang, body: (i, f"http://{host}/x", f'<html lang="{lang}"><body>{body}</body></html>')
    pages = spark.createDataFrame([page(i, "a.de", "de", "der und die das ist") for i in range(12)] + [page(12, "a.de", "de", ""), page(13, "b.com", "en", "the and of it"), (14, None, None), (15, "not a url", "")], "page_id long, url string, html string")
    none = spark.createDataFrame([], DOCS)
    got = {r.page_id: r for r in language_id.identify(pages, none, model).collect()}
    assert got[12].lang == "de" and got[13].lang == "en" and got[14].host is None and len(got) == 16
    assert language_id.identify(pages.limit(0), none, model).count() == 0


def brute_language(rows, model):
    """(language, confidence) of rows (text or None, markup?, declared, host, suffix), by Bayes' rule in plain loops."""
    names, table = model
    lls, bests = [], []
    for text, markup, *_ in rows:
        if markup and text:
            text = re.sub(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ", text)
        padded, low = f" {(text or '').lower()} ", (1 << 64) - 1
        hit = []
        for k in range(len(padded) - 2):
            a, b, c = map(ord, padded[k : k + 3])
            word = ((a * 0x100000001B3 + b) * 0x100000001B3 + c) & low
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
                word = (word ^ word >> shift) * factor & low
            hit.append(word >> 64 - language_id.BITS)
        ll = [float(np.mean([table[j][x] for x in hit], dtype=np.float64)) * min(len(hit), language_id.EVIDENCE) if hit and text else 0.0 for j in range(len(names))]
        lls.append([round(x - max(ll), 6) for x in ll])
        bests.append(int(np.argmax(lls[-1])) if any(lls[-1]) else None)
    def count(of, value):
        return [sum(1 for r, b in zip(rows, bests, strict=True) if b == k and of(r) == value) for k in range(len(names))]
    every, out = [sum(b == k for b in bests) for k in range(len(names))], []
    for (_, _, declared, host, suffix), ll, best in zip(rows, lls, bests, strict=True):
        own = [float(best == k) for k in range(len(names))]
        post = []
        for k in range(len(names)):
            prior = (every[k] + 1) / (sum(every) + len(names))
            if suffix is not None:
                n = count(lambda r: r[4], suffix)
                prior = (n[k] - own[k] + language_id.KAPPA * prior) / (sum(n) - sum(own) + language_id.KAPPA)
            if host is not None:
                n = count(lambda r: r[3:5], [host, suffix] if isinstance(rows[0], list) else (host, suffix))
                prior = (n[k] - own[k] + language_id.KAPPA * prior) / (sum(n) - sum(own) + language_id.KAPPA)
            said = 0.0
            if declared is not None:
                said = np.log((count(lambda r: r[2], declared)[k] + language_id.ALPHA) / (every[k] + language_id.ALPHA * 10))
            post.append(round(ll[k] + np.log(prior) + said, 6))
        top = max(post)
        out.append((names[post.index(top)], 1 / sum(np.exp(x - top) for x in post)))
    return out


@pytest.mark.parametrize("whole", [True, False])
def test_language_is_brute_force(spark, monkeypatch, whole):
    """With tables broadcast whole, and with hot keys broadcast and the others shuffled."""
    if not whole:
        monkeypatch.setattr(language_id, "BROADCAST_ROWS", 1)
        monkeypatch.setattr(language_id, "HOT_PART", 4)
    samples = {"en": "the cat and the dog sat on the mat", "de": "der hund und die katze sind im haus", "fr": "le chat et le chien dans la maison"}
    model = language_id.text_model([t * 5 for t in samples.values()], list(samples))
    rng, pages, docs, rows = random.Random(4), [], [], []
    for k in range(60):
        lang = rng.choice(list(samples))
        text = None if k % 9 == 0 else "" if k % 10 == 3 else " ".join(rng.sample(samples[lang].split(), 3))
        if k % 2:
            host, said = rng.choice(["a.de", "b.fr", "c.com", "d.com", "127.0.0.1"]), rng.choice([None, lang, "en"])
            html = None if text is None else (f'<html lang="{said}">' if said else "<html>") + f"<script>der die das</script><body>{text}</body></html>"
            pages.append((None if k == 5 else k, f"https://{host}/p{k}" if k % 7 else None, html))
            seen = host if k % 7 else None
            suffix = re.search(r"\.([a-z]{2,})$", seen or "")
            rows.append((html, True, said if html else None, seen, suffix[1] if suffix else None))
        else:
            source = rng.choice(["s1", "s2", None])
            docs.append((k, text, None, source, 0))
            rows.append((text, False, None, source, None))
    pages += [pages[0]] * 2
    rows += [rows[1]] * 2
    want = brute_language(rows, model)
    table = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"lang": F.lit("x"), "n_host": F.lit(1), "_turn": F.lit(2), "best": F.lit(3)})
    got = language_id.identify(table, spark.createDataFrame(docs, DOCS).withColumn("ll", F.lit(1)), model).collect()
    key = lambda i, j, lang, c: (i is None, i or 0, j or 0, lang, round(c, 4))
    names = []
    it_pages, it_docs = iter(pages), iter(docs)
    for r, w in zip(rows, want, strict=True):
        names.append(key(None, next(it_pages)[0], *w) if r[1] else key(next(it_docs)[0], None, *w))
    assert sorted(names) == sorted(key(r.doc_id, r.page_id, r.lang, r.confidence) for r in got)


# -- MPEG audio


def test_audio_round_trip(spark):
    rows = mpeg_audio.store_texts(docs_of(spark, AWKWARD).withColumn("media", F.lit(1))).collect()
    for text, r in zip(AWKWARD, sorted(rows, key=lambda r: r.doc_id), strict=True):
        payload = mpeg_audio.pad((text or "").encode())
        found = mpeg_audio.parse(bytes(r.media))
        assert mpeg_audio.uncarry(bytes(r.media), found) == (payload, 0) and len(payload) % 576 == 0 and payload
        assert (r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert r.seconds == len(payload) // 576 * 576 / 16000 and r.media_sha256 == hashlib.sha256(bytes(r.media)).hexdigest()
    assert mpeg_audio.store_texts(docs_of(spark, [])).count() == 0


def test_audio_features_are_those_of_the_stream(spark):
    texts = ["", "short", words(300, 4), words(300, 4), None]
    rows = sorted(mpeg_audio.store_texts(docs_of(spark, texts)).collect(), key=lambda r: r.doc_id)
    for text, r in zip(texts, rows, strict=True):
        n = max(1, -(-len((text or "").encode()) // 576))
        tag, size = 10 + 10 + 1 + len("payload"), 144 * 144000 // 16000 // 2  # 72 bytes for each 1000 bit/s and kHz in the low layer III
        offsets = np.array([tag + size * (k + 1) for k in range(n)], dtype="<i8")
        want = {"crc": [n, 0], "frames": n, "lost": 0, "seconds": round(n * 576 / 16000, 6), "seek_md5": hashlib.md5(offsets.tobytes()).hexdigest(), "table": n, "title": "payload"}
        assert json.loads(r.feature) == want and r.offsets == offsets.tolist() and r.media_bytes == tag + size * (n + 1)
    assert rows[2].media_sha256 == rows[3].media_sha256 and rows[0].feature == rows[4].feature
    same = spark.createDataFrame([(None, "x")] * 2, "doc_id long, text string")
    assert [r.n_bytes for r in mpeg_audio.store_texts(same).collect()] == [1, 1]


def bit_crc(bits):
    word = 0xFFFF
    for b in bits:
        top = word >> 15 ^ b
        word = (word << 1 & 0xFFFF) ^ (0x8005 if top else 0)
    return word


def frame_of(word, allocations, scale, size):
    """A frame with a checksum over the allocation fields (width, value) and ``scale`` more bits."""
    bits = [word >> 15 - k & 1 for k in range(16)]
    side = [v >> w - 1 - k & 1 for w, v in allocations for k in range(w)] + [k % 2 for k in range(scale)]
    body = side + [0] * (-len(side) % 8)
    raw = bytes(int("".join(map(str, body[k : k + 8])), 2) for k in range(0, len(body), 8))
    data = word.to_bytes(4, "big") + bit_crc(bits + side).to_bytes(2, "big") + raw
    return data + bytes(size - len(data))


def test_audio_checksums_of_layers_one_and_two():
    rng = random.Random(2)
    one = 0xFFFE0000 | 9 << 12 | 1 << 10 | 1 << 6 | 1 << 4  # MPEG-1 layer I, joint stereo with bound 8, 288 kbit/s, 48 kHz
    size = mpeg_audio.header(one)["size"]
    media = b"".join(frame_of(one, [(4, rng.randrange(15)) for _ in range(16 + 24)], 0, size) for _ in range(3))
    found = mpeg_audio.parse(media)
    assert (found["checked"], found["wrong"], found["seconds"]) == (3, 0, 3 * 384 / 48000)
    for word, nbal, bound, channels in ((0xFFFC0000 | 10 << 12 | 0 << 10 | 1 << 6 | 0 << 4, mpeg_audio.NBAL["b"], 4, 2), (0xFFFC0000 | 2 << 12 | 2 << 10 | 3 << 6, mpeg_audio.NBAL["d"], 32, 1), (0xFFF40000 | 8 << 12 | 1 << 10, mpeg_audio.NBAL["low"], 32, 2)):
        frames = []
        for _ in range(3):
            fields, used = [], 0
            for k, width in enumerate(nbal):
                for _ in range(channels if k < bound else 1):
                    value = rng.choice([0, 0, 1, (1 << width) - 1])
                    fields.append((width, value))
                    used += (2 if k >= bound and channels == 2 else 1) * bool(value)
            frames.append(frame_of(word, fields, 2 * used, mpeg_audio.header(word)["size"]))
        found = mpeg_audio.parse(b"".join(frames))
        assert (found["checked"], found["wrong"], len(found["offsets"])) == (3, 0, 3)
        broken = bytearray(b"".join(frames))
        broken[len(frames[0]) + 7] ^= 16
        assert mpeg_audio.parse(bytes(broken))["wrong"] == 1


def test_audio_delay_padding_and_free_format():
    plain = (0xFFFB9064 & ~(3 << 6) | 3 << 6).to_bytes(4, "big")  # MPEG-1 layer III, mono, no checksum
    lame = b"Info" + (15).to_bytes(4, "big") + (4).to_bytes(4, "big") + (417 * 5).to_bytes(4, "big") + bytes(100) + bytes(4) + b"LAME3.100" + bytes(12) + (576 << 12 | 1000).to_bytes(3, "big")
    opening = plain + bytes(17) + lame
    media = opening + bytes(417 - len(opening)) + (plain + bytes(413)) * 4
    found = mpeg_audio.parse(media)
    assert found["samples"] == 4 * 1152 and found["seconds"] == (4 * 1152 - 576 - 1000) / 44100
    free = lambda pad: (0xFFFB0000 | pad << 9 | 3 << 6).to_bytes(4, "big") + b"\xff\xfb\x01" + bytes(293 + pad)
    found = mpeg_audio.parse(b"".join(free(k % 2) for k in range(6)))
    assert found["offsets"] == [0, 300, 601, 901, 1202, 1502] and found["lost"] == 0 and found["samples"] == 6 * 1152
    assert mpeg_audio.parse(free(0))["offsets"] == []


def test_audio_resynchronises_and_finds_damage():
    media = mpeg_audio.carry(mpeg_audio.pad(words(400, 2).encode()))
    whole = mpeg_audio.parse(media)
    assert whole["table"]["frames"] == len(whole["offsets"]) == whole["checked"] and whole["tags"] == {"TIT2": "payload"}
    cut = media[: whole["offsets"][2]] + b"\xff\xf2noise\xff" + media[whole["offsets"][2] :]
    found = mpeg_audio.parse(b"junk" + cut + b"TAG" + bytes(125))
    assert len(found["offsets"]) == len(whole["offsets"]) and found["lost"] == 4 + 8
    damaged = bytearray(media)
    damaged[whole["offsets"][1] + 8] ^= 1
    assert mpeg_audio.parse(bytes(damaged))["wrong"] == 1
    assert mpeg_audio.parse(b"") | {"table": None} == mpeg_audio.parse(b"\xff" * 50) | {"lost": 0, "table": None}
    plain = mpeg_audio.header(0xFFFB9064)
    assert (plain["hertz"], plain["bits"], plain["samples"], plain["size"]) == (44100, 128000, 1152, 417)


# -- tool calls

CALLS = "conv_id long, turn long, call_id string, name string, arguments string, after string"
RESULTS = "conv_id long, turn long, call_id string, content string"


def test_tool_calls_are_linked_ordered_and_checked(spark):
    calls = spark.createDataFrame([
        (1, 3, "c", "search", '{"query": "x", "limit": 2, "extra": {"b": 1, "a": [1,2]}}', "b"), (1, 1, "a", "count", '{"text": "t"}', None),
        (1, 2, "b", "quote", '{"text": 5}', "a"), (1, 4, "d", "shell", "{}", "gone"), (1, 5, "e", "search", "not json", "f"), (1, 6, "f", "search", "[1]", "e"),
        (1, 9, "a", "count", '{"text": "again"}', None), (2, 1, None, "count", '{"text": "n"}', None), (None, None, "g", None, None, None),
    ], CALLS)
    open_search = {k: v for k, v in tool_calls.SCHEMAS["search"].items() if k != "additionalProperties"}
    results = spark.createDataFrame([(1, 7, "c", "rc"), (1, 8, "zz", "orphan"), (1, 8, "a", "ra"), (1, 9, "a", "later"), (3, 1, None, "x")], RESULTS)
    got = {r.call_id or "none": r for r in tool_calls.link_tool_calls(calls.withColumn("depth", F.lit(1)), results, tool_calls.SCHEMAS | {"search": open_search}).collect()}
    assert {k: r.status for k, r in got.items()} == {"a": "ok", "b": "invalid", "c": "ok", "d": "invalid", "e": "cycle", "f": "cycle", "g": "invalid", "none": "no_result", "zz": "orphan_result"}
    assert [got[k].depth for k in "abcdef"] == [0, 1, 2, 0, -1, -1] and [got[k].position for k in "adbcef"] == [1, 2, 3, 4, 5, 6]
    assert got["b"].errors == "missing:width,type:text" and got["d"].errors == "unknown_tool" and got["f"].errors == "not_an_object" and got["a"].n_repeats == 2
    assert got["c"].message == '{"arguments":{"extra":{"a":[1,2],"b":1},"limit":2,"query":"x"},"call_id":"c","content":"rc","name":"search"}'
    json.loads(got["e"].message)


def test_calls_with_several_parents(spark):
    rng, schema = random.Random(5), CALLS.replace("after string", "after array<string>")
    edges = {f"n{k:02d}": sorted({f"n{rng.randrange(k):02d}" for _ in range(rng.randrange(4))}) if k else [] for k in range(60)}
    edges |= {"x": ["y", "n03"], "y": ["x"], "z": ["x", "n01"], "n60": ["n59", "gone", None], "w": ["z"]}
    rows = [(1, k, name, "count", '{"text": "t"}', up) for k, (name, up) in enumerate(edges.items())] + [(1, 99, "none", "count", "{}", None)]

    def deep(name):
        return 1 + max((deep(p) for p in edges.get(name, []) if p in edges), default=-1)

    got = {r.call_id: r for r in tool_calls.link_tool_calls(spark.createDataFrame(rows, schema), spark.createDataFrame([], RESULTS)).collect()}
    want = {name: -1 if name in "xyzw" else deep(name) for name in edges} | {"none": 0}
    assert {k: r.depth for k, r in got.items()} == want and {k for k, r in got.items() if r.status == "cycle"} == set("xyzw")
    place = {k: r.position for k, r in got.items()}
    assert all(place[p] < place[k] for k, up in edges.items() if want[k] >= 0 for p in up if p in edges) and sorted(place.values()) == list(range(1, len(place) + 1))


def test_schemas_are_checked_inside(spark):
    cases = {
        '{"query":"a","limit":1,"options":{"order":"new","fields":["a"]}}': "", '{"query":"a","limit":1.5,"extra":1}': "type:limit,unknown:extra",
        '{"query":"a","limit":1,"options":{"order":"up","fields":["a",1,2]}}': "enum:options.order,type:options.fields[]", '{"query":null,"limit":1,"options":{}}': "missing:options.order,type:query",
        '{"query":"a","limit":1,"options":[1]}': "type:options", '{"query":"a","limit":1,"options":{"order":7}}': "type:options.order", "": "not_an_object",
    }
    rows = [(1, k, f"c{k}", "search", text, None) for k, text in enumerate(cases)]
    got = tool_calls.link_tool_calls(spark.createDataFrame(rows, CALLS), spark.createDataFrame([], RESULTS)).collect()
    assert {r.call_id: r.errors for r in got} == {f"c{k}": v for k, v in enumerate(cases.values())}
    own = {"search": {"type": ["object"], "required": ["n"], "properties": {"query": {"enum": ["a", 1, True]}}}}
    got = tool_calls.link_tool_calls(spark.createDataFrame(rows, CALLS), spark.createDataFrame([], RESULTS), own).collect()
    assert [r.errors for r in got if r.call_id == "c0"] == ["missing:n"]


def test_one_hot_conversation_is_numbered_across_partitions(spark):
    rows = [(7 if k % 3 else 8, k, f"k{k}", "count", '{"text": "t"}', None) for k in range(900)] + [(None, 1, f"m{k}", "count", "{}", None) for k in range(5)]
    got = tool_calls.link_tool_calls(spark.createDataFrame(rows, CALLS), spark.createDataFrame([(7, 5, "zz", "r")], RESULTS)).collect()
    per = defaultdict(list)
    for r in got:
        per[r.conv_id].append((r.position, r.status == "orphan_result", r.turn or 0))
    assert all([p for p, *_ in sorted(v)] == list(range(1, len(v) + 1)) and sorted(v) == sorted(v, key=lambda x: x[1:]) for k, v in per.items() if k is not None)
    assert sorted(p for p, *_ in per[None]) == [1, 2, 3, 4, 5]


def test_long_chains_and_empty_tables(spark):
    chain = spark.createDataFrame([(1, k, f"k{k}", "count", '{"text": "t"}', f"k{k - 1}") for k in range(150)], CALLS)
    none = spark.createDataFrame([], RESULTS)
    assert sorted((r.turn, r.depth, r.position) for r in tool_calls.link_tool_calls(chain, none).collect()) == [(k, k, k + 1) for k in range(150)]
    assert tool_calls.link_tool_calls(chain.limit(0), none).count() == 0


def test_thinned_buckets_keep_every_link():
    base = np.unique(jaccard_join.mix64(np.arange(0, 400, dtype=np.uint64)))
    sets = [np.sort(np.concatenate([base[k:], jaccard_join.mix64(np.arange(1000 * k, 1000 * k + 3 * k, dtype=np.uint64) + np.uint64(10**6))])) for k in range(0, 120, 4)]
    sizes, marks = np.array([len(s) for s in sets]), [jaccard_join.sketch(s) for s in sets]
    parts = jaccard_join.split_bucket(sizes, len(sets), marks)
    part_of = {int(i): n for n, part in enumerate(parts) for i in part}
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if jaccard_join.linked(a, b):
                assert part_of[i] == part_of[j]

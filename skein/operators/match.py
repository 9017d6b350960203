"""Entity and similarity matching: unique names, selectors, nearest hashes, votes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.functions import text as T
from skein.operators.sequences import first_wins

#: Bits of a hash word, the largest distance that counts as the same picture, and the bands that prove it.
HASH_BITS, SAME = 64, 6


#: Lengths of the heads by which names meet texts; names of one head beyond which heads of up to so many other lengths are taken; bytes of names up to which they are broadcast.
HEADS, CROWD, LENGTHS, BROADCAST_NAMES = (1, 2, 3, 6, 12, 24, 48, 96), 16, 32, 16_000_000


def parts(text: Column, lengths: Iterable[int] = (1, 2, 3)) -> Column:
    """The distinct parts of one, two and three characters of a text, or of other ``lengths``."""
    every = [F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)) for n in lengths]
    return F.array_distinct(F.concat(*every))


def contained(rows: DataFrame, key: str, text: str, names: DataFrame) -> DataFrame:
    """(key, name, at) of the names found in each row's short text, by equi-join on a name's head.

    The head is the longest of ``HEADS`` that the name fills; where many names share one, the lengths of the names
    themselves are taken (each length, while there are up to ``LENGTHS``), so that a name meets few texts in vain. Texts
    give parts of the lengths in use only. An empty name is found nowhere.
    The names' bytes are summed first: up to ``BROADCAST_NAMES`` they are broadcast, beyond both sides are
    shuffled. The parts are many times the rows, which Spark's estimate doesn't see: they must never be broadcast.
    """
    named = names.where("name <> ''")

    def headed(lengths: Sequence[int]) -> DataFrame:
        n = reduce(lambda longer, h: longer.when(F.length("name") >= h, h), lengths[-2::-1], F.when(F.length("name") >= lengths[-1], lengths[-1]))
        return named.select("name", F.left("name", n).alias("g"))

    heads = headed(HEADS)
    groups = heads.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("name") + F.octet_length("g") + 64).alias("bytes"))
    known = groups.agg(F.max("n").alias("most"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.collect_set(F.length("g")).alias("used")).first()
    used = sorted(known.used) or HEADS[:1]
    if known.most and known.most > CROWD:
        every = sorted(r.n for r in named.select(F.length("name").alias("n")).distinct().collect())
        used = every[:: -(-len(every) // LENGTHS)]
        heads = headed(used)
    cut = rows.select(key, text, F.explode(parts(F.col(text), used)).alias("g"))
    met = cut.join(F.broadcast(heads), "g") if known.bytes <= BROADCAST_NAMES else cut.hint("merge").join(heads, "g")
    return met.select(key, "name", F.expr(f"locate(name, {text})").alias("at")).where("at > 0")


def unique_match(names: DataFrame, stems: DataFrame) -> DataFrame:
    """(name, stem, how): the equal stem, else the only stem that contains the name or is contained in it.

    ``names`` (name) and ``stems`` (stem) are entity tables: distinct names, not rows of data.
    The longer string holds the first three characters of the shorter one (or all, if it has
    fewer), so candidates come from an equi-join on them; ambiguous names get no stem.
    """
    exact = names.join(stems, F.col("name") == F.col("stem")).select("name", "stem", F.lit("exact").alias("how"))
    rest = names.join(exact, "name", "left_anti")
    inner = lambda df, c: df.select(c, F.left(c, F.lit(3)).alias("g")).where(F.col(c) != "")
    outer = lambda df, c: df.select(c, F.explode(parts(F.col(c))).alias("g"))
    a = inner(rest, "name").join(outer(stems, "stem"), "g").where(F.contains("stem", F.col("name"))).select("name", "stem")
    b = outer(rest, "name").join(inner(stems, "stem"), "g").where(F.contains("name", F.col("stem"))).select("name", "stem")
    near = a.unionByName(b).distinct().groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("stem").alias("stem"))
    only = near.where("n = 1").select("name", "stem", F.lit("substring").alias("how"))
    none = rest.join(only, "name", "left_anti").select("name", F.lit(None).cast("string").alias("stem"), F.lit("none").alias("how"))
    return exact.unionByName(only).unionByName(none)


def first_selector(rows: DataFrame, selectors: list[tuple[str, float]], fields: list[str]) -> DataFrame:
    """``rows`` with ``shift`` (seconds) of the first selector whose pattern matches any of ``fields``; null where none does."""
    shift = F.lit(None).cast("double")
    for glob, seconds in reversed(selectors):
        pattern = T.glob_to_regex(F.lit(glob))
        hit = F.lit(False)
        for field in fields:
            hit = hit | F.regexp_like(F.col(field), pattern)
        shift = F.when(hit, F.lit(float(seconds))).otherwise(shift)
    return rows.withColumn("shift", shift)


def hash_words(vector: Column, above: float) -> tuple[Column, Column]:
    """Which of a vector's first 64 components exceed ``above``, as two 32-bit words."""

    def word(at: int) -> Column:
        return F.aggregate(F.slice(vector, at + 1, 32), F.lit(0).cast("long"), lambda a, x: a * 2 + F.when(x > above, 1).otherwise(0))

    return word(0), word(32)


def nearest_hash(frames: DataFrame, cache: DataFrame, within: int = SAME) -> DataFrame:
    """(frame, entry, distance) of the nearest cache entry, the first of equals, at most ``within`` bits away.

    ``frames`` (frame, hi, lo), ``cache`` (entry, pos, hi, lo). The 64 bits are cut into ``within // 2 + 1``
    bands; hashes that near differ by at most one bit in one of them. So every frame asks, for each band, for
    its word and the words one bit away, an equi-join finds every candidate, and a pair is kept
    in the first band that is that near. With six bits, bands have 16: a probe meets one cache entry in 65,536.
    """
    n = max(2, within // 2 + 1)  # words of 32 bits at most
    cuts = [HASH_BITS * k // n for k in range(n + 1)]

    def bits(hi: Column, lo: Column, a: int, b: int) -> Column:
        high, low = (min(a, 32), min(b, 32)), (max(a, 32) - 32, max(b, 32) - 32)
        part = lambda w, x, y: F.shiftright(w, 32 - y).bitwiseAND((1 << (y - x)) - 1) if y > x else F.lit(0).cast("long")
        return part(hi, *high) * (1 << (low[1] - low[0])) + part(lo, *low)

    words = F.array(*[bits(F.col("hi"), F.col("lo"), a, b) for a, b in zip(cuts, cuts[1:], strict=False)])
    widths = F.array(*[F.lit(b - a) for a, b in zip(cuts, cuts[1:], strict=False)])
    right = cache.withColumn("r_words", words).select("*", F.posexplode("r_words").alias("band", "word"))
    left = frames.withColumn("l_words", words).withColumnsRenamed({"hi": "l_hi", "lo": "l_lo"}).select("*", F.posexplode("l_words").alias("band", "own"))
    flip = lambda i: F.col("own").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))
    near = F.concat(F.array("own"), F.transform(F.sequence(F.lit(0), F.get(widths, F.col("band")) - 1), flip))
    met = left.withColumn("word", F.explode(near)).join(right, ["band", "word"])
    first = F.array_position(F.zip_with("l_words", "r_words", lambda x, y: F.bit_count(x.bitwiseXOR(y)) <= 1), True) - 1
    distance = F.bit_count(F.col("l_hi").bitwiseXOR(F.col("hi"))) + F.bit_count(F.col("l_lo").bitwiseXOR(F.col("lo")))
    met = met.where(first == F.col("band")).withColumn("distance", distance).where(F.col("distance") <= within)
    return first_wins(met, ["frame"], ["distance", "pos"]).select("frame", "entry", "distance")


#: Rows of a recordings' n-gram table up to which it is broadcast (about 60 bytes each).
BROADCAST_GRAMS = 500_000


def vote_offsets(clips: DataFrame, recordings: DataFrame, width: int, rare: int = 4, n: int = 6) -> DataFrame:
    """(clip, rec, offset, votes): the place of each clip in the recording that its n-grams vote for.

    ``clips`` and ``recordings``: (id, text). Character n-grams meet where they are equal and at most ``rare``
    times in the recording; each meeting votes for a binned difference of places. Votes of
    a bin and both neighbours are summed; the highest wins, the smaller offset and then the
    smaller recording on ties.

    The recordings' table has one row per n-gram, with its places in each recording; while it is small
    (counted first) it is broadcast and no n-gram of the clips is exchanged. Otherwise both sides
    meet by 64 bits of the n-gram, compared in full. Votes are counted on the map side; the window's frames are a clip's bins.
    """
    grams = lambda df, key, at: df.select(F.col("id").alias(key), F.posexplode(T.char_ngrams(F.col("text"), n)).alias(at, "gram"))
    few = grams(recordings, "rec", "rt").groupBy("rec", "gram").agg(F.collect_list("rt").alias("rts")).where(F.size("rts") <= rare)
    flat = few.select(F.col("gram").alias("g"), F.xxhash64("gram").alias("h"), "rec", "rts")
    own = grams(clips, "clip", "ct")
    if flat.count() <= BROADCAST_GRAMS:
        listed = flat.groupBy("g").agg(F.collect_list(F.struct("rec", "rts")).alias("places"))  # as many as recordings, all broadcast
        met = own.join(F.broadcast(listed), F.col("gram") == F.col("g")).select("clip", "ct", F.explode("places").alias("p")).select("clip", "p.rec", "ct", F.explode("p.rts").alias("rt"))
    else:
        met = own.withColumn("h", F.xxhash64("gram")).join(flat, "h").where("gram = g").select("clip", "rec", "ct", F.explode("rts").alias("rt"))
    votes = met.groupBy("clip", "rec", (F.bround((F.col("ct") - F.col("rt")) / width) * width).cast("long").alias("offset")).agg(F.count(F.lit(1)).alias("v"))
    w = Window.partitionBy("clip", "rec").orderBy("offset").rangeBetween(-width, width)
    smooth = votes.withColumn("votes", F.sum("v").over(w))
    return first_wins(smooth, ["clip"], [F.desc("votes"), "rec", "offset"]).select("clip", "rec", "offset", "votes")


def best_jaccard(left: DataFrame, right: DataFrame, at_least: float, n: int = 3) -> DataFrame:
    """(title, match, score): for each distinct title the most similar candidate by character n-gram Jaccard, at least ``at_least``.

    Texts that alike share one of their rarest n-grams: of k n-grams, in one order by frequency, the first
    k - ceil(at_least * k) + 1. Only these meet, so common n-grams make few pairs; pairs are then scored in full.
    """
    grams = lambda df, c: df.select(c, F.array_distinct(T.char_ngrams(F.lower(F.col(c)), n)).alias("g")).distinct()
    a, b = grams(left, "title"), grams(right, "match")
    flat = lambda df, c: df.select(c, F.explode("g").alias("gram"))
    often = flat(a, "title").select("gram").union(flat(b, "match").select("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("f"))

    def rarest(df: DataFrame, c: str) -> DataFrame:
        ranked = flat(df, c).join(often, "gram").groupBy(c).agg(F.array_sort(F.collect_list(F.struct("f", "gram"))).alias("r"))
        size = F.size("r") - F.ceil(F.size("r") * at_least - 1e-9).cast("int") + 1
        return ranked.select(c, F.explode(F.slice("r", F.lit(1), size)).alias("x")).select(c, F.col("x.gram").alias("gram"))

    pairs = rarest(a, "title").join(rarest(b, "match"), "gram").select("title", "match").distinct()
    both = pairs.join(a.withColumnRenamed("g", "ga"), "title").join(b.withColumnRenamed("g", "gb"), "match")
    shared = F.size(F.array_intersect("ga", "gb"))
    scored = both.withColumn("score", shared / (F.size("ga") + F.size("gb") - shared)).where(F.col("score") >= at_least)
    return first_wins(scored, ["title"], [F.desc("score"), "match"]).select("title", "match", "score")

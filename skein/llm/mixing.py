"""Mixing sources to target weights: rake token weights to marginals, then sample by calibrated probabilities.

A cell (source, language, topic) is kept with probability min(1, a * b * c), one factor for
each label. Raking fits the factors of one dimension after the other so that the expected tokens of
every label are its target, cells at probability 1 counted with all their tokens; it goes on until
every label is within the tolerance, and is an error when the targets cannot be met.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.common import discard, stored, text_or_empty

DIMS = ("source", "lang", "topic")
#: Without targets of the caller's: each label's share of the tokens to these powers, as shares.
POWERS = {"source": 0.9, "lang": 0.95, "topic": 0.97}
#: Without a budget of the caller's: this part of the most tokens that every single label allows, lowered by ``EASE`` at a time to
#: ``LEAST_BUDGET`` while labels of different dimensions stand against each other.
BUDGET, EASE, LEAST_BUDGET = 0.9, 0.97, 0.01
#: Relative miss of a label's expected tokens that ends raking; sweeps after which targets count as not to be met.
TOLERANCE, SWEEPS = 1e-9, 200
#: Cells (distinct source, language and topic) up to which they are broadcast to the rows.
BROADCAST_CELLS = 20_000
#: Languages and topics up to which their factors are numbers on the driver; beyond, raking joins tables.
FEW_LABELS = 100
WORDS = r"[^\x20\x09-\x0D]+"
_HUGE = 1e300


def topic_of(text: Column) -> Column:
    """A coarse topic by form: tables, legal lines, contact data, lines or prose."""
    return (
        F.when(text.contains(" | "), "table")
        .when(F.lower(text).rlike("licen[cs]e|copyright"), "legal")
        .when(text.rlike("@[a-z0-9]+[.]|[0-9]{6}"), "contact")
        .when(text.contains("\n"), "lines")
        .otherwise("prose")
    )


def _label(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("(none)"))


def power_targets(cells: DataFrame, powers: dict) -> dict[str, DataFrame]:
    """For each dimension (label, share): a label's tokens to a power, as a share. Powers under 1 flatten."""
    out = {}
    for dim, power in powers.items():
        sums = cells.groupBy(F.col(dim).alias("label")).agg(F.sum("tokens").cast("double").alias("t"))
        sums = sums.select("label", F.when(F.col("t") > 0, F.pow("t", F.lit(float(power)))).otherwise(0.0).alias("p"))
        whole = sums.agg(F.sum("p").alias("whole"))
        out[dim] = sums.crossJoin(F.broadcast(whole)).select("label", F.coalesce(F.try_divide("p", "whole"), F.lit(0.0)).alias("share"))  # one row
    return out


def given_targets(cells: DataFrame, targets: dict[str, dict[str, float]]) -> dict[str, DataFrame]:
    """The caller's weights as (label, share); every label of the cells has a row, those without a weight share 0."""
    out, spark = {}, cells.sparkSession
    for dim, weights in targets.items():
        whole = float(sum(weights.values()))
        if whole <= 0 or min(weights.values()) < 0:
            raise ValueError(f"weights of {dim} must be 0 or more, and not all 0")
        rows = F.broadcast(spark.createDataFrame([(k, v / whole) for k, v in sorted(weights.items())], "label string, share double"))  # the caller's list
        out[dim] = cells.select(F.col(dim).alias("label")).distinct().join(rows, "label", "full_outer").select("label", F.coalesce("share", F.lit(0.0)).alias("share"))
    return out


class NotMet(ValueError):
    """Targets that no probabilities from 0 to 1 can meet at the budget."""


def most_budget(cells: DataFrame, targets: dict[str, DataFrame], total: float) -> float:
    """The largest share of all tokens at which no label's target exceeds its tokens (0 when one with a target has none)."""
    most = 1.0
    for dim, target in targets.items():
        has = cells.groupBy(F.col(dim).alias("label")).agg(F.sum("tokens").cast("double").alias("t"))
        part = target.where("share > 0").join(has, "label", "left").agg(F.min(F.coalesce("t", F.lit(0.0)) / (F.col("share") * F.lit(total))).alias("m")).first().m
        most = min(most, 1.0 if part is None else part)
    return most


def rake(cells: DataFrame, targets: dict[str, DataFrame], budget: float, tolerance: float = TOLERANCE, sweeps: int = SWEEPS) -> DataFrame:
    """``cells`` (dims, tokens) with ``prob``, such that each label's expected tokens are ``budget`` * share of all tokens.

    Every sweep fits one dimension after the other: two grouped sums with map-side combining
    (tokens of cells at 1, expected tokens of the others) and a join on the label. The table has a row
    per distinct cell, never one per document, and is written after each sweep. Raises
    :class:`NotMet` when a label is still off by more than ``tolerance`` after ``sweeps``.
    """
    total = float(cells.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("t")).first().t)
    now = cells.withColumn("w", F.lit(budget))
    full = F.col("w") >= 1
    sums = lambda df, dim: df.groupBy(F.col(dim).alias("label")).agg(F.sum(F.when(full, F.col("tokens")).otherwise(0)).cast("double").alias("at_one"), F.sum(F.when(full, 0.0).otherwise(F.col("tokens") * F.col("w"))).alias("free"))
    for _ in range(sweeps):
        before = now
        for dim, target in targets.items():
            goal = F.coalesce(F.col("share"), F.lit(0.0)) * F.lit(total * budget)
            plain = F.coalesce(F.try_divide(goal, F.col("at_one") + F.col("free")), F.lit(0.0))
            factor = F.when((goal > F.col("at_one")) & (F.col("free") > 0), (goal - F.col("at_one")) / F.col("free")).otherwise(plain)
            factors = sums(now, dim).join(target, "label", "left").select("label", factor.alias("factor"))
            now = now.join(factors, now[dim] == factors["label"]).withColumn("w", F.when(F.col("factor") < 1, F.least("w", F.lit(1 / tolerance))).otherwise(F.col("w")) * F.col("factor")).drop("label", "factor")
        now = stored(now, "raked")
        discard(before)
        off = 0.0
        for dim, target in targets.items():
            goal = F.coalesce(F.col("share"), F.lit(0.0)) * F.lit(total * budget)
            worst = sums(now, dim).join(target, "label", "left").agg(F.max(F.abs(F.try_divide(F.col("at_one") + F.col("free"), goal) - 1)).alias("m")).first().m
            off = max(off, worst or 0.0)
        if off <= tolerance:
            return now.withColumn("prob", F.least(F.lit(1.0), "w")).drop("w")
    discard(now)
    raise NotMet(f"targets not met at a budget of {budget:.4f} of the tokens: a label is off by {off:.2%}")


def _shares(target: DataFrame) -> dict[str, float]:
    return {r["label"]: r["share"] for r in target.collect()}


def _pick(values: dict[str, float], label: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in sorted(values.items()) for x in pair]), label)


def _row_factor() -> Column:
    """The factor f at which a row's ``cells`` (tokens, g; largest g first) expect ``goal`` tokens: sum of tokens * min(1, f * g)."""
    start = F.struct(F.lit(0.0).alias("at_one"), F.aggregate("cells", F.lit(0.0), lambda a, x: a + x["tokens"] * x["g"]).alias("free"), F.lit(None).cast("double").alias("f"))

    def step(a, x):
        f = F.try_divide(F.col("goal") - a["at_one"], a["free"])
        fits = a["f"].isNull() & (f * x["g"] <= 1)
        more = F.struct((a["at_one"] + x["tokens"]).alias("at_one"), (a["free"] - x["tokens"] * x["g"]).alias("free"), a["f"].alias("f"))
        return F.when(fits, F.struct(a["at_one"], a["free"], f.alias("f"))).when(a["f"].isNotNull(), a).otherwise(more)

    return F.coalesce(F.aggregate("cells", start, step, lambda a: a["f"]), F.lit(_HUGE))


def rake_by_source(cells: DataFrame, targets: dict[str, DataFrame], budget: float, tolerance: float = TOLERANCE, sweeps: int = SWEEPS) -> DataFrame:
    """What :func:`rake` gives, for few languages and topics (at most ``FEW_LABELS`` each, counted by the caller).

    One row per source holds the source's few cells, so its factor follows in the row from
    those of languages and topics, exactly. A sweep is one aggregate over these rows: expected
    tokens by language and topic, of cells at 1 and of the others. From these few numbers the
    factors of languages and topics are fitted on the driver. Nothing else is exchanged, nothing written.
    """
    total = float(cells.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("t")).first().t)
    goals = {d: {k: v * total * budget for k, v in _shares(targets[d]).items()} for d in ("lang", "topic")}
    packs = cells.groupBy("source").agg(F.collect_list(F.struct("lang", "topic", "tokens")).alias("cells")).join(targets["source"].select(F.col("label").alias("source"), "share"), "source", "left")
    packs = stored(packs.select("source", "cells", (F.coalesce("share", F.lit(0.0)) * F.lit(total * budget)).alias("goal")).coalesce(max(1, packs.sparkSession.sparkContext.defaultParallelism)), "packs")
    b, c = ({k: budget if v else 0.0 for k, v in goals["lang"].items()}, {k: 1.0 if v else 0.0 for k, v in goals["topic"].items()})

    def fitted(b, c):
        ranked = F.transform("cells", lambda x: F.struct((_pick(b, x["lang"]) * _pick(c, x["topic"])).alias("g"), x["lang"].alias("lang"), x["topic"].alias("topic"), x["tokens"].cast("double").alias("tokens")))
        rows = packs.withColumn("cells", F.reverse(F.array_sort(ranked))).withColumn("a", _row_factor())
        return rows.select("source", "a", F.explode("cells").alias("x")).select("source", "x.lang", "x.topic", "x.tokens", (F.col("a") * F.col("x.g")).alias("w"))

    if total <= 0:
        return cells.withColumn("prob", F.lit(0.0))
    off = 0.0
    for _ in range(sweeps):
        full = F.col("w") >= 1
        got = fitted(b, c).groupBy("lang", "topic").agg(F.sum(F.when(full, F.col("tokens")).otherwise(0.0)).alias("one"), F.sum(F.when(full, 0.0).otherwise(F.col("tokens") * F.col("w"))).alias("free")).collect()
        had = {(d, k): 0.0 for d in goals for k in goals[d]}
        for r in got:
            had["lang", r.lang] += r.one + r.free
            had["topic", r.topic] += r.one + r.free
        off = max([abs(had[d, k] / v - 1) for d in goals for k, v in goals[d].items() if v], default=0.0)
        if off <= tolerance:
            break
        more = {"lang": dict.fromkeys(b, 1.0), "topic": dict.fromkeys(c, 1.0)}
        for _ in range(20):  # raking of the small table, cells at 1 held there
            for d in ("lang", "topic"):
                one, free = dict.fromkeys(goals[d], 0.0), dict.fromkeys(goals[d], 0.0)
                for r in got:
                    one[r[d]] += r.one
                    free[r[d]] += r.free * more["lang"][r.lang] * more["topic"][r.topic]
                for k, goal in goals[d].items():
                    room = goal - one[k]
                    more[d][k] *= room / free[k] if room > 0 and free[k] > 0 else goal / (one[k] + free[k]) if one[k] + free[k] > 0 else 1.0
        b, c = {k: b[k] * more["lang"][k] for k in b}, {k: c[k] * more["topic"][k] for k in c}
    else:
        raise NotMet(f"targets not met at a budget of {budget:.4f} of the tokens: a label is off by {off:.2%}")
    return fitted(b, c).select(*DIMS, F.col("tokens").cast("long").alias("tokens"), F.least(F.lit(1.0), "w").alias("prob"))


def calibrate(cells: DataFrame, targets: dict[str, DataFrame], budget: float | None = None) -> DataFrame:
    """``cells`` with ``prob``, raked to the targets at ``budget`` of all tokens, or at the most that :data:`BUDGET` describes.

    Raises :class:`NotMet` when the targets cannot be met at the budget (or, without one, at
    any from ``LEAST_BUDGET``). Cells without tokens have the probability that their labels' factors give.
    """
    few = cells.agg(F.greatest(F.count_distinct("lang"), F.count_distinct("topic")).alias("n")).first().n <= FEW_LABELS
    way = rake_by_source if few else rake
    total = float(cells.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("t")).first().t)
    if total <= 0:
        return cells.withColumn("prob", F.lit(0.0))
    most = most_budget(cells, targets, total)
    if budget is not None:
        if budget > most * (1 + TOLERANCE):
            raise NotMet(f"a budget of {budget:.4f} of the tokens asks more of a label than it has; at most {most:.4f}")
        return way(cells, targets, budget)
    level = BUDGET * most
    while level >= LEAST_BUDGET:
        try:
            return way(cells, targets, level)
        except NotMet:
            level *= EASE
    raise NotMet(f"targets cannot be met at {LEAST_BUDGET} of the tokens or more")


def chance(ident: Column, seed: str) -> Column:
    """A number in [0, 1) that only the id and the seed decide."""
    return F.conv(F.substring(F.md5(F.concat(ident.cast("string"), F.lit(seed))), 1, 8), 16, 10).cast("double") / 4294967296.0


def mix(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, budget: float | None = None, seed: str = ":mix", id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: id, ``source``, ``lang``, ``topic``, ``tokens``, ``prob``, ``selected``, and the columns named in ``carry``.

    ``targets`` gives weights by dimension ('source', 'lang', 'topic') and label; labels without a
    weight get none, a dimension left out keeps :data:`POWERS`. ``budget`` is the share of all
    tokens to expect in the sample. Expected tokens meet the targets in every dimension, or :class:`NotMet` is raised.

    Tokens are words; null text counts as empty (no tokens). A null source or language is the
    label '(none)'. Rows are drawn by a hash of the id: a null id is selected only at
    probability 1; rows that repeat an id are drawn by one number. Without any tokens every
    probability is 0. An empty table gives an empty one.

    One pass over the texts labels rows and counts tokens, into a slim table in the shared
    folder; cells are summed from it (map-side combined, so a hot source is one row per task)
    and joined back to it: by broadcast while they are at most ``BROADCAST_CELLS`` (counted
    first), otherwise by a shuffled join that splits skewed sources.
    """
    text = text_or_empty(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), _label("source").alias("source"), _label("lang").alias("lang"), topic_of(text).alias("topic"), F.regexp_count(text, F.lit(WORDS)).cast("long").alias("tokens"), *[F.col(f"`{c}`").alias(f"_c_{c}") for c in carry])
    rows = rows if carry else stored(rows, "mix-rows")  # with whole rows to carry, labels are read twice rather than texts written
    cells = stored(rows.groupBy(*DIMS).agg(F.sum("tokens").alias("tokens")), "cells")
    wanted = power_targets(cells, POWERS) | (given_targets(cells, targets) if targets else {})
    wanted = {d: stored(wanted[d], "target") for d in DIMS}
    probs = stored(calibrate(cells, wanted, budget).select(*[F.col(d).alias(f"_{d}") for d in DIMS], F.round("prob", 6).alias("prob")), "probabilities")
    side = F.broadcast(probs) if probs.count() <= BROADCAST_CELLS else probs.hint("merge")
    for used in (cells, *wanted.values()):
        discard(used)
    same = (F.col("source") == F.col("_source")) & (F.col("lang") == F.col("_lang")) & (F.col("topic") == F.col("_topic"))
    picked = F.coalesce(chance(F.col("_id"), seed) < F.col("prob"), F.col("prob") >= 1)
    return rows.join(side, same).select(F.col("_id").alias(id_col), *DIMS, "tokens", "prob", picked.alias("selected"), *[F.col(f"`_c_{c}`") for c in carry])


def sample(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with its own columns, whatever their names: the rows that :func:`mix` selects, by its rules for nulls, ties and empty tables."""
    names = docs.columns
    mixed = mix(docs, carry=tuple(names), **options).where("selected")
    return mixed.select(*[F.col(f"`_c_{c}`").alias(c) for c in names])


def _sql(steps: int = 180) -> str:
    shares = ",\n".join(f"t_{dim} AS MATERIALIZED (SELECT {dim}, t, p / sum(p) OVER () AS share FROM (SELECT {dim}, sum(tokens)::DOUBLE AS t, pow(sum(tokens)::DOUBLE, {power}) AS p FROM cells GROUP BY 1))" for dim, power in POWERS.items())
    total = "(SELECT sum(tokens)::DOUBLE FROM cells)"
    most = ", ".join(f"(SELECT min(t / (share * {total})) FROM t_{dim})" for dim in DIMS)
    return f"""
WITH RECURSIVE rows AS (SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang,
  CASE WHEN contains(coalesce(text, ''), ' | ') THEN 'table' WHEN regexp_matches(lower(coalesce(text, '')), 'licen[cs]e|copyright') THEN 'legal'
       WHEN regexp_matches(coalesce(text, ''), '@[a-z0-9]+[.]|[0-9]{{6}}') THEN 'contact' WHEN contains(coalesce(text, ''), chr(10)) THEN 'lines' ELSE 'prose' END AS topic,
  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS tokens FROM documents),
cells AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::BIGINT AS tokens FROM rows GROUP BY ALL),
{shares},
level AS MATERIALIZED (SELECT {BUDGET} * least(1.0, {most}) AS b, {total} AS total),
goals AS MATERIALIZED (SELECT c.*, b, s.share * total * b AS g0, l.share * total * b AS g1, t.share * total * b AS g2
  FROM cells c JOIN t_source s USING (source) JOIN t_lang l USING (lang) JOIN t_topic t USING (topic), level),
it AS (SELECT 0 AS k, source, lang, topic, tokens, g0, g1, g2, b AS w FROM goals
  UNION ALL
  SELECT k + 1, source, lang, topic, tokens, g0, g1, g2, w * coalesce(min(CASE WHEN f * w <= 1 THEN {{'n': n, 'f': f}} END) OVER (PARTITION BY label).f, 1e30)
  FROM (SELECT *, (goal - before) / rest AS f
        FROM (SELECT *, sum(tokens) OVER down - tokens AS before, sum(tokens * w) OVER (PARTITION BY label ORDER BY w DESC, source, lang, topic ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest, row_number() OVER down AS n
              FROM (SELECT *, CASE k % 3 WHEN 0 THEN source WHEN 1 THEN lang ELSE topic END AS label, CASE k % 3 WHEN 0 THEN g0 WHEN 1 THEN g1 ELSE g2 END AS goal FROM it)
              WINDOW down AS (PARTITION BY label ORDER BY w DESC, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)))
  WHERE k < {steps}),
probs AS (SELECT source, lang, topic, round(least(1.0, w), 6) AS prob FROM it WHERE k = {steps})
SELECT doc_id, source, lang, topic, tokens, prob, (('0x' || substr(md5(doc_id || ':mix'), 1, 8))::BIGINT / 4294967296.0) < prob AS selected
FROM rows JOIN probs USING (source, lang, topic)"""


SQL = _sql()

"""The registered queries with SQL against DuckDB, and the pipeline against a brute-force run of its stages."""

import hashlib
import math
import os
import re

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skein.llm import mixing, registry, toxicity
from tests.llm.test_llm_operators import brute_bucket, brute_links, brute_mix, brute_topic

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SMALL}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_is_its_sql(spark, duck, name):
    got, want = registry.QUERIES[name](spark, SMALL).toPandas(), duck.execute(registry.ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    plain = lambda f: sorted(tuple("" if pd.isna(v) else str(float(v)) if pd.api.types.is_number(v) else str(v) for v in r) for r in f[sorted(f.columns)].itertuples(index=False))
    assert plain(got) == plain(want)


def test_every_operator_has_a_query():
    assert [n.split("_")[0] for n in sorted(registry.QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == [f"op{k}" for k in range(1, 11)]


def test_jaccard_query_is_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert set(map(tuple, registry.QUERIES["op3_jaccard_join"](spark, SMALL).collect())) == brute_links(rows)


def drawn(ident, probability):
    return int(hashlib.md5(f"{ident}:mix".encode()).hexdigest()[:8], 16) / 2**32 < probability


def test_pipeline_stages(spark):
    """Every stage by loops of its own: scores from single n-grams, groups of texts, all pairs, raking by bisection."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    text = {i: r.text or "" for i, r in rows.items()}
    model = toxicity.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    stay = set()
    for i, t in text.items():
        low = t.lower()
        held = [x for x in {brute_bucket(low[k : k + n]) for n in toxicity.ORDERS for k in range(len(low) - n + 1)} if model.known[x]]
        z = model.bias + sum(float(model.weight[x]) for x in held) / max(1, len(held)) ** 0.5
        if 1 / (1 + math.exp(-z)) < toxicity.THRESHOLD:
            stay.add(i)
    best: dict = {}
    for i in stay:
        best[text[i]] = max(best.get(text[i], i), i)
    stay = set(best.values())
    stay = {i for i, _, c in brute_links([(i, text[i]) for i in sorted(stay)]) if i == c}
    cells = {i: (rows[i].source, rows[i].lang, brute_topic(text[i]), len(re.findall(mixing.WORDS, text[i]))) for i in stay}
    chance, _ = brute_mix(list(cells.values()))
    stay = {i for i in stay if drawn(i, round(chance[cells[i][:3]], 6))}
    out = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in out} == stay and len(out) == len(stay) > 50
    for _, function in corpus_pipeline.STAGES[:-1]:
        assert function(spark, docs, SMALL).columns == docs.columns


def test_pipeline_stages_on_awkward_tables(spark):
    """Empty tables, nulls in every column, repeated rows and clashing columns pass through every stage."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(40)
    odd = spark.createDataFrame([(None,) * 5, (None,) * 5, (10**9, None, None, None, None), (10**9, "same", "en", None, 4), (10**9, "same", "en", None, 4), (10**9 + 1, "", None, "s", 0)], docs.schema)
    clash = docs.unionByName(odd).withColumns({"_score": F.lit(1), "_h": F.lit(2), "_gone": F.lit(3), "prob": F.lit(4), "token_ids": F.lit(5), "topic": F.lit("x")})
    for stage in (clash, clash.limit(0)):
        n = stage.count()
        for _, function in corpus_pipeline.STAGES:
            kept = function(spark, stage, SMALL)
            assert kept.count() <= n
            if function is not corpus_pipeline.encode:
                assert kept.columns == clash.columns
    assert corpus_pipeline.drop_copies(spark, odd, SMALL).count() == 2

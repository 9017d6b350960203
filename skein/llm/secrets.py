"""Secret scans: patterned findings, and weak parts that count only beside an access identifier."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.common import stored, text_or_empty

#: The patterns of the base kinds (group 2 of ``assign`` has 6 characters or more).
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Weak parts: a lone run of 40 base64 characters, an address of a service.
SECRET = r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])"
ENDPOINT = r"https?://[A-Za-z0-9._~:/?#@!$&*+,;=%-]+|[a-z0-9.-]+\.amazonaws\.com"
KINDS = ("assign", "access", "hex", "secret", "endpoint")
#: Code points on either side of an access identifier that form its scope.
SCOPE = 400
_BLOCK = 512


def _sum(array: Column) -> Column:
    return F.aggregate(array, F.lit(0).cast("long"), lambda a, x: a + x)


def _starts(gaps: Column, hits: Column) -> Column:
    """Running starts: start[i] = sum of gaps[..i] and hits[..i-1], in blocks so that n hits cost about 512 n."""
    steps = F.transform(hits, lambda h, i: h + F.get(gaps, i))
    count = F.size(hits)
    blocks = F.sequence(F.lit(0), F.floor(count / _BLOCK).cast("int"))
    sums = F.transform(blocks, lambda b: _sum(F.slice(steps, b * _BLOCK + 1, F.lit(_BLOCK))))
    bases = F.transform(blocks, lambda b: _sum(F.slice(sums, F.lit(1), b)))
    return F.transform(
        hits,
        lambda h, i: F.get(bases, F.floor(i / _BLOCK).cast("int")) + _sum(F.slice(steps, F.floor(i / _BLOCK).cast("int") * _BLOCK + 1, i % _BLOCK)) + F.get(gaps, i),
    )


def _found(text: Column, gate: Column, pattern: str, group: int | None = None, least: int = 0) -> Column:
    """(gap lengths, match lengths, whether each match counts) of a pattern's matches, empty where ``gate`` is not met."""
    none = F.array().cast("array<long>")
    lengths = lambda found: F.transform(found, lambda x: F.length(x).cast("long"))
    every = F.lit(pattern)
    hits = lengths(F.regexp_extract_all(text, every, F.lit(0)))
    kept = lengths(F.regexp_extract_all(text, every, F.lit(group))) if group else hits
    return F.struct(
        F.when(gate, lengths(F.split(text, pattern, -1))).otherwise(none).alias("gaps"),
        F.when(gate, hits).otherwise(none).alias("hits"),
        F.when(gate, F.transform(kept, lambda n: n >= least)).otherwise(F.array().cast("array<boolean>")).alias("ok"),
    )


def _fence(df: DataFrame, *made: Column) -> DataFrame:
    """Select ``made`` beside the columns of ``df`` once per row: what follows reads values, never repeats the expressions."""
    return df.select("*", F.explode(F.array(F.struct(*made))).alias("_row")).select(*df.columns, "_row.*")


def _spans(kind: str) -> Column:
    at = F.transform(F.col(f"{kind}_at"), lambda s, i: F.struct(s.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (s + F.get(F.col(f"{kind}.hits"), i)).alias("end"), F.get(F.col(f"{kind}.ok"), i).alias("ok")))
    return F.transform(F.filter(at, lambda x: x["ok"]), lambda x: F.struct(x["start"], x["kind"], x["end"]))


def _written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    parts = F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string")))
    return F.array_join(parts, ",")


def find_parts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, a row number, and the arrays ``base`` and ``weak`` of (start, kind, end) in code points."""
    lower = F.lower(F.col("_text"))
    words = ("password", "passwd", "secret", "token", "apikey", "api_key")
    gates = {
        "assign": reduce(lambda a, b: a | b, (F.contains(lower, F.lit(w)) for w in words)),
        "access": F.contains(F.col("_text"), F.lit("AKIA")),
        "hex": F.col("_text").rlike(HEX),
    }
    rows = docs.select(F.col(id_col).alias("_id"), F.monotonically_increasing_id().alias("_rid"), text_or_empty(text_col).alias("_text"))
    rows = _fence(
        rows,
        _found(F.col("_text"), gates["assign"], ASSIGN, 2, 6).alias("assign"),
        _found(F.col("_text"), gates["access"], ACCESS).alias("access"),
        _found(F.col("_text"), gates["hex"], HEX).alias("hex"),
    )
    beside = F.size("access.hits") > 0
    rows = _fence(rows, _found(F.col("_text"), beside, SECRET).alias("secret"), _found(F.col("_text"), beside, ENDPOINT).alias("endpoint")).drop("_text")
    rows = _fence(rows, *(_starts(F.col(f"{k}.gaps"), F.col(f"{k}.hits")).alias(f"{k}_at") for k in KINDS))
    return rows.select("_id", "_rid", F.concat(*map(_spans, KINDS[:3])).alias("base"), F.concat(*map(_spans, KINDS[3:])).alias("weak"))


def link_parts(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(row number, start, kind, end) of the weak parts within ``scope`` code points of an access identifier.

    An interval join: both sides are cut into cells of the scope's width, joined on (row,
    cell), and compared exactly; a weak part is then counted once. Both sides come from one
    row's text, so a cell's rows are bounded by the scope, not by the corpus.
    """
    cells = lambda a, b: F.explode(F.sequence(F.floor(a / scope), F.floor(b / scope)))
    wide = parts.where(F.size("weak") > 0)
    access = wide.select("_rid", F.explode("base").alias("x")).where(F.col("x.kind") == KINDS.index("access"))
    access = access.select("_rid", (F.col("x.start") - scope).alias("from"), (F.col("x.end") + scope).alias("till"))
    access = access.select("*", cells(F.col("from"), F.col("till")).alias("cell"))
    weak = wide.select("_rid", F.explode("weak").alias("x")).select("_rid", "x.*").select("*", cells(F.col("start"), F.col("end")).alias("cell"))
    met = weak.join(access, ["_rid", "cell"]).where((F.col("start") < F.col("till")) & (F.col("end") > F.col("from")))
    return met.select("_rid", "start", "kind", "end").distinct()


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256``, ``spans``.

    Base findings always stand. A run of 40 base64 characters or a service address is weak:
    it joins ``spans`` only where an access identifier stands within ``SCOPE`` code points.
    Null text counts as empty: zero counts, no spans. Repeated rows and null ids are rows of
    their own. An empty table gives an empty one; other columns are ignored.

    One pass over the texts writes the findings (a few numbers a row) to the shared folder;
    rows without weak parts, nearly all, never enter an exchange.
    """
    parts = stored(find_parts(docs, id_col, text_col), "secret-parts")
    linked = link_parts(parts).groupBy("_rid").agg(F.collect_list(F.struct("start", "kind", "end")).alias("more"))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    plain = parts.where(F.size("weak") == 0).select("_id", "base", none.alias("more"))
    wide = parts.where(F.size("weak") > 0).join(linked, "_rid", "left").select("_id", "base", F.coalesce("more", none).alias("more"))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    return plain.unionByName(wide).select(F.col("_id").alias(id_col), *map(count, KINDS[:3]), F.sha2(_written(F.col("base")), 256).alias("base_sha256"), _written(F.concat("base", "more")).alias("spans"))


def _sql_kind(number: int, pattern: str, keep: str, source: str = "docs") -> str:
    pattern = pattern.replace("'", "''")
    group = 2 if number == 0 else 0
    return f"""
SELECT rid, doc_id, {number} AS kind,
       list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS s,
       length(m[i]) AS n
FROM (SELECT rid, doc_id, regexp_extract_all(t, '{pattern}', 0) AS m, regexp_extract_all(t, '{pattern}', {group}) AS k,
             string_split_regex(t, '{pattern}') AS g FROM {source}), unnest(range(1, len(m) + 1)) AS u(i)
WHERE {keep}"""


SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
base AS ({_sql_kind(0, ASSIGN, "length(k[i]) >= 6")} UNION ALL {_sql_kind(1, ACCESS, "true")} UNION ALL {_sql_kind(2, HEX, "true")}),
near AS (SELECT * FROM docs WHERE rid IN (SELECT rid FROM base WHERE kind = 1)),
weak AS ({_sql_kind(3, "[A-Za-z0-9+/]+=*", "regexp_full_match(m[i], '[A-Za-z0-9+/]{40}')", "near")} UNION ALL {_sql_kind(4, ENDPOINT, "true", "near")}),
linked AS (SELECT DISTINCT w.* FROM weak w JOIN base a ON a.rid = w.rid AND a.kind = 1 AND w.s < a.s + a.n + {SCOPE} AND w.s + w.n > a.s - {SCOPE}),
spans AS (SELECT *, true AS is_base FROM base UNION ALL SELECT *, false FROM linked),
named AS (SELECT *, (['{"','".join(KINDS)}'])[kind + 1] || ':' || s::BIGINT || ':' || (s + n)::BIGINT AS w FROM spans),
sums AS (SELECT rid, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
                string_agg(w, ',' ORDER BY s, kind) FILTER (is_base) AS b, string_agg(w, ',' ORDER BY s, kind) AS spans FROM named GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN sums USING (rid)
"""

"""The registered queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabletrust.llm import (
    ann, collocations, language, licenses, line_dedup, mixing, ngram_join, packing, secrets, sharding, topk, weighted_sampling, whitening)
from tabletrust.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return add


def _hash_sql(*parts: str) -> str:
    """The SQL of :func:`common.hash60`."""
    text = " || '|' || ".join(f"coalesce(CAST({p} AS VARCHAR), 'null')" for p in parts)
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


# Seats are dealt one by one here: every quotient is listed and ranked.
_MIX_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce('=' || source, 'null') AS s,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         {_hash_sql("'mix'", "'shard'", "doc_id")} % 64 AS shard, {_hash_sql("'mix'", "'order'", "doc_id")} AS place
  FROM documents),
cells AS (
  SELECT source, s, shard, CAST(sum(size) AS BIGINT) AS tokens,
         CAST(CASE WHEN sum(size) > 0 THEN greatest(1, round(sum(size) / 16.0)) ELSE 0 END AS BIGINT) AS blocks
  FROM sized GROUP BY ALL),
sources AS (
  SELECT s, CAST(sum(tokens) AS BIGINT) AS source_size, CAST(sum(blocks) AS BIGINT) AS blocks,
         row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM cells GROUP BY source, s),
weighed AS (SELECT *, 1.0::DOUBLE + (rank - 1) % 3 AS w, 3.0::DOUBLE * source_size AS cap FROM sources),
leveled AS (
  SELECT *, cap / w AS full_at,
         (sum(source_size) OVER () - coalesce(sum(cap) OVER earlier, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER earlier, 0)) AS level
  FROM weighed WINDOW earlier AS (ORDER BY cap / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT s, source_size, blocks, CASE WHEN full_at > f.level THEN f.level * w ELSE cap END AS target
  FROM leveled LEFT JOIN (SELECT arg_min(level, (full_at, rank)) AS level FROM leveled WHERE level * w < cap) f ON true),
voted AS (SELECT *, CASE WHEN source_size > 0 THEN target * blocks / source_size ELSE 0 END AS votes FROM targets),
won AS (
  SELECT s, (k + 0.5::DOUBLE) / votes AS cost FROM voted, unnest(range(0, 3 * blocks)) t(k) WHERE votes > 0
  QUALIFY row_number() OVER (ORDER BY cost, s) <= (SELECT round(sum(votes)) FROM voted)),
quota AS (SELECT v.*, (SELECT count(*) FROM won WHERE won.s = v.s) AS seats FROM voted v),
cell_won AS (
  SELECT c.s, c.shard, (k + 0.5::DOUBLE) / c.blocks AS cost, q.seats
  FROM cells c JOIN quota q USING (s), unnest(range(0, 3 * c.blocks)) t(k)
  QUALIFY row_number() OVER (PARTITION BY c.s ORDER BY cost, c.shard) <= seats),
dealt AS (
  SELECT c.s, c.shard, c.tokens, greatest(c.blocks, 1) AS b, coalesce(w.n, 0) AS n,
         {_hash_sql("'mix'", "'start'", "c.s", "c.shard")} % greatest(c.blocks, 1) AS first
  FROM cells c LEFT JOIN (SELECT s, shard, count(*) AS n FROM cell_won GROUP BY ALL) w ON w.s = c.s AND w.shard = c.shard),
laid AS (
  SELECT *, CAST(sum(size) OVER (PARTITION BY s, shard ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stop FROM sized),
runs AS (
  SELECT *, first + n % b AS last, tokens // b AS even, tokens % b AS odd FROM dealt),
spans AS (
  SELECT *, first * even + least(first, odd) AS lo, least(last, b) * even + least(least(last, b), odd) AS hi,
         greatest(last - b, 0) * even + least(greatest(last - b, 0), odd) AS wrap FROM runs)
SELECT l.doc_id, l.size, t.source_size, t.target,
       CAST(l.size * (r.n // r.b) + greatest(0, least(r.wrap, l.stop) - (l.stop - l.size))
            + greatest(0, least(r.hi, l.stop) - greatest(r.lo, l.stop - l.size)) AS BIGINT) AS taken
FROM laid l JOIN spans r USING (s, shard) JOIN targets t USING (s)
"""


@query("op2_sainte_lague_mix", _MIX_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op5_hash_tree_shards")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.assign_shards(table(spark, sf_dir, "documents"), sharding.uniform_tree(24))
    return shards.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query("op10_ngram_jaccard_join", r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
c AS (SELECT text, min(doc_id) AS id, count(*) AS n_copies FROM d GROUP BY text),
w AS (SELECT id, list_filter(string_split_regex(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM c),
g AS (SELECT DISTINCT id, unnest(list_transform(range(1, greatest(2, len(w) - 3)), lambda i: array_to_string(w[i:i + 4], ' '))) AS gram
      FROM w WHERE len(w) > 0),
n AS (SELECT id, count(*) AS n FROM g GROUP BY id),
p AS (SELECT a.id AS a, b.id AS b, count(*) AS shared FROM g a JOIN g b ON a.gram = b.gram AND a.id <> b.id GROUP BY ALL),
links AS (SELECT a, b FROM p JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE shared >= 0.8 * (x.n + y.n - shared) - 1e-9),
reach(a, b) AS (SELECT id, id FROM c UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT d.doc_id, r.class_id, coalesce(l.n, 0) AS n_links, c.id AS text_id, c.n_copies
FROM d JOIN c USING (text) JOIN (SELECT a, min(b) AS class_id FROM reach GROUP BY a) r ON r.a = c.id
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) l ON l.a = c.id
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_links(table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "n_links", "text_id", "n_copies")


@query("op7_fuzzy_line_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


@query("op9_vector_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query("op8_family_svm_language")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@query("op1_segment_top_k", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x::DOUBLE), false)))),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10
""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


@query("op3_projection_forest_ann")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def _license_sql() -> str:
    """Texts are made canonical line by line, as in :mod:`licenses`, but
    every digest is taken and joined, whatever its number of words."""
    def canonical(text: str) -> str:
        line = "replace(regexp_replace(lower(x), '[-‐‑]', '', 'g'), '&', ' and ')"
        words = f"trim(regexp_replace({line}, '[^\\p{{L}}\\p{{Nd}}]+', ' ', 'g'))"
        return f"list_transform(string_split({text}, chr(10)), lambda x: CASE WHEN regexp_matches(lower(x), '{licenses.COPYRIGHT_LINE}') THEN '' ELSE {words} END)"

    def spelled(text: str) -> str:
        return f"array_to_string(list_transform(string_split({text}, ' '), lambda x: coalesce(same[x], x)), ' ')"

    known = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in licenses.KNOWN)
    same = "MAP {" + ", ".join(f"'{a}': '{b}'" for a, b in licenses.SAME.items()) + "}"
    whole = "array_to_string(list_filter(lines, lambda x: x <> ''), ' ')"
    return f"""
WITH same AS (SELECT {same} AS same),
known AS (SELECT license, {canonical("text")} AS lines FROM (VALUES {known}) t(license, text)),
digests AS (SELECT {spelled("c")} AS c, min(license) AS license FROM (SELECT license, {whole} AS c FROM known), same GROUP BY 1),
docs AS (SELECT row_number() OVER () AS r, doc_id, {canonical("coalesce(text, '')")} AS lines FROM documents),
whole AS (SELECT r, license FROM (SELECT r, {spelled("c")} AS c FROM (SELECT r, {whole} AS c FROM docs), same WHERE c <> '') JOIN digests USING (c)),
per_line AS (SELECT r, license FROM (SELECT r, {spelled("c")} AS c FROM (SELECT r, unnest(lines) AS c FROM docs), same WHERE c <> '') JOIN digests USING (c)),
found AS (SELECT r, count(*) AS n_notices, list_sort(list_distinct(list(license))) AS notices FROM per_line GROUP BY r)
SELECT doc_id, w.license, coalesce(n_notices, 0) AS n_notices, coalesce(notices, CAST([] AS VARCHAR[])) AS notices
FROM docs LEFT JOIN whole w USING (r) LEFT JOIN found USING (r)
"""


@query("op4_license_digests", _license_sql())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_matches(table(spark, sf_dir, "documents"), licenses.known_licenses(spark))


@query("op6_random_secrets")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(table(spark, sf_dir, "documents"))

    def count(name: str):
        return F.size(F.filter("base", lambda s: s["name"] == name)).cast("bigint").alias(f"n_{name}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(secrets.span_text(F.col("base")), 256).alias("base_sha256"), secrets.span_text(F.col("spans")).alias("spans"))


@query("op11_jacobi_davidson_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("bigint"))


@query("op12_weighted_fingerprints")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_sampling.edited_fingerprints(table(spark, sf_dir, "documents"))


@query("op13_toivonen_collocations", r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang,
  unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
p AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM t),
g AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
  FROM p, (VALUES (1), (2), (3)) x(m) WHERE len(w) >= m),
f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= 10),
kept AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM c x WHERE x.lang = c.lang AND x.m > c.m AND 100 * x.a >= 50 * c.a
  AND contains(' ' || x.phrase || ' ', ' ' || c.phrase || ' '))),
cuts AS (SELECT *, unnest(range(1, m)) AS k FROM kept),
scored AS (SELECT c.*, l.f AS l, r.f AS r, CAST((1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:k], ' ') JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[k + 1:c.m], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest JOIN totals USING (lang) QUALIFY rank <= 2000
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))

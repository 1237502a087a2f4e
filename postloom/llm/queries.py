"""One query per operator over its whole table, in the form its contract fixes."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import ann, bpe, chat, html_text, kmeans, neardup, packing, quality, simhash, substring, topk, toxicity, tries
from .common import own_columns, ship, table
from .learning import crc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

VOCABULARY = "word_bpe_49k.json"


Query = Callable[[SparkSession, str], DataFrame]


def query(fn: Query, sql: str | None = None) -> Query:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(ship(spark), sf_dir)
    if sql is not None:
        SQL[fn.__name__] = sql
    return fn


def vocabulary_path() -> str:
    return public_tokenizers.path(VOCABULARY)


@query
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token and decoded-text digests of every document."""
    coded = bpe.encode(table(spark, sf_dir, "documents"), vocabulary_path())
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.sha2("text", 256).alias("text_sha256"),
    )


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in as few sequences of 4096 tokens as best fit finds."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary_path())


@query
def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold the template's own marks, formatted and read back."""
    marks = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", marks), (-7, 1, "assistant", marks)], "conv_id LONG, turn LONG, role STRING, text STRING"
    )
    turns = own_columns(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text").union(extra)
    return chat.read_back(chat.format_chats(chat.turn_events(turns)))


@query
def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five largest integer inner products of every fiftieth vector, exactly."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(vectors["vec_id"] % 50 == 0), 5)


@query
def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest vectors by cosine of every fiftieth vector, approximately."""
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where(vectors["vec_id"] % 50 == 0), 5)


@query
def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    texts = html_text.extract(table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def _judged(scores: DataFrame, held_out: Column) -> DataFrame:
    predicted = F.when(F.col("score") >= 0.3, 1).otherwise(0)
    made = scores.withColumns({"held_out": held_out, "predicted": predicted.cast("int")})
    first = ["doc_id", "held_out", "score", "predicted"]
    return made.select(*first, *[c for c in scores.columns if c not in first])


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; a quarter of the labels is held out."""
    docs, held_out = table(spark, sf_dir, "documents"), crc(F.col("doc_id")) % 4 == 2
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return _judged(toxicity.score(docs, model), held_out)


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; a fifth of the labels is held out."""
    docs, held_out = table(spark, sf_dir, "documents"), crc(F.col("doc_id")) % 5 == 0
    model = quality.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return _judged(quality.score(docs, model), held_out)


@query
def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class and number of links of every document."""
    return neardup.classes(table(spark, sf_dir, "documents"))


@query
def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-word passages of documents before it."""
    cut = substring.dedup(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query
def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and component of every document."""
    return simhash.clusters(table(spark, sf_dir, "documents"))


#: Masks of failed filters per document, then counts of masks for every step of every order.
_AUDIT_SQL = r"""
WITH labelled AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
base AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
split AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first_id FROM base),
masked AS (
  SELECT doc_id, part,
    CASE WHEN len(w) < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > first_id THEN 16 ELSE 0 END AS mask
  FROM split),
counts AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE quality = 1) AS good, count(*) FILTER (WHERE toxic = 1) AS bad
  FROM masked LEFT JOIN labelled USING (doc_id) GROUP BY part, mask),
letters(l, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT p.l || q.l || r.l || s.l || t.l AS filter_order, [p.b, q.b, r.b, s.b, t.b] AS bits
  FROM letters p JOIN letters q ON q.b <> p.b JOIN letters r ON r.b NOT IN (p.b, q.b)
  JOIN letters s ON s.b NOT IN (p.b, q.b, r.b) JOIN letters t ON t.b NOT IN (p.b, q.b, r.b, s.b)),
steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::BIGINT AS before
  FROM orders, unnest([1, 2, 3, 4, 5]) AS u(step)),
each AS (
  SELECT part, filter_order, step, bit, n, good, bad, mask, (mask & bit) <> 0 AS fails, (mask & before) = 0 AS here
  FROM counts CROSS JOIN steps),
removals AS (SELECT part, bit, sum(n) AS shapley FROM each WHERE fails AND here GROUP BY part, bit)
SELECT part, filter_order, step,
  CAST(sum(CASE WHEN NOT fails AND here THEN n ELSE 0 END) AS BIGINT) AS kept,
  CAST(sum(CASE WHEN fails AND here THEN n ELSE 0 END) AS BIGINT) AS removed,
  CAST(sum(CASE WHEN fails AND NOT here THEN n ELSE 0 END) AS BIGINT) AS redundant,
  CAST(sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
  CAST(sum(CASE WHEN fails AND here THEN good ELSE 0 END) AS BIGINT) AS good_lost,
  CAST(sum(CASE WHEN fails AND here THEN bad ELSE 0 END) AS BIGINT) AS toxic_lost,
  CAST(coalesce(max(shapley), 0) AS BIGINT) AS shapley
FROM each LEFT JOIN removals USING (part, bit) GROUP BY part, filter_order, step
"""


@partial(query, sql=_AUDIT_SQL)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from every source, in all orders."""
    fails = tries.surface_fails(F.col("text"))
    return tries.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), fails, "E")


def _cluster_sql(k: int = 40, rounds: int = 5, dim: int = 64) -> str:
    """The same rounds as a chain of common table expressions."""
    parts = [
        f"""z AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
          FROM embeddings WHERE len(embedding) = {dim} AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))))""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS cluster, v AS c
          FROM z QUALIFY cluster < {k})""",
    ]
    for i in range(rounds + 1):
        parts.append(
            f"""a{i} AS MATERIALIZED (SELECT vec_id, any_value(v) AS v, min(p) AS p FROM (
              SELECT rid, vec_id, v, {{'d': CAST(list_sum(list_transform(list_zip(v, c), lambda q: (q[1] - q[2]) * (q[1] - q[2]))) AS BIGINT),
                'k': cluster}} AS p FROM (SELECT *, row_number() OVER () AS rid FROM z) CROSS JOIN c{i}) GROUP BY rid, vec_id)"""
        )
        if i < rounds:
            parts.append(
                f"""c{i + 1} AS MATERIALIZED (SELECT cluster, coalesce(m, c) AS c FROM c{i} LEFT JOIN (
                  SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY d) AS m FROM (
                    SELECT p.k AS cluster, d, sum(v[d]) AS s, count(*) AS n FROM a{i}, unnest(range(1, {dim + 1})) AS u(d) GROUP BY 1, 2)
                  GROUP BY cluster) USING (cluster))"""
            )
    return f"""WITH {", ".join(parts)}
      SELECT vec_id, CAST(p.k AS INTEGER) AS cluster, p.d AS distance, CAST(sum(p.d) OVER (PARTITION BY p.k) AS BIGINT) AS cluster_inertia,
        CAST(sum(p.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
      FROM a{rounds} JOIN c{rounds} ON cluster = p.k"""


@partial(query, sql=_cluster_sql())
def op13_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector's cluster of 40 after five rounds."""
    found = kmeans.cluster(table(spark, sf_dir, "embeddings"))
    digits = F.concat_ws(",", F.col("centroid").cast("array<string>"))
    return found.withColumn("centroid_sha256", F.sha2(digits, 256)).drop("centroid")

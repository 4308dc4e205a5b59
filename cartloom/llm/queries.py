"""Registered queries of the text operators: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.llm import (
    centroids, fingerprint, hard_negatives, html_extract, langid, line_dedup, lm, mixing, ngram_join, secrets, sentencepiece_match, topk,
    toxicity,
)
from cartloom.llm.common import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


@query("op1_language_id")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held = langid.held_out(docs, 3)
    found = langid.identify(docs.select("doc_id", "text"), langid.train(docs, ~held))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


@query("op2_lm_scoring")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held = langid.held_out(docs, 5)
    return lm.score_texts(docs, ~held).withColumn("held_out", held)


@query("op3_fingerprints")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.fingerprint_documents(table(spark, folder, "documents"))


@query("op4_html_extraction")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, folder, "pages"))


@query("op5_ngram_jaccard")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, folder, "documents"))


@query("op6_sentencepiece")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepiece_match.encode_documents(table(spark, folder, "documents").select("doc_id", "text")).drop("text")


@query("op7_line_dedup")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, folder, "documents").select("doc_id", "text", "source"))


@query("op8_mixing")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "passes", "in_rest", "block", "shard", "place")


@query("op9_secret_scan")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents"))
    sizes = [F.size(k).cast("long").alias(f"n_{k}") for k in secrets.KINDS]
    digest = F.sha2(secrets.joined_spans(*secrets.KINDS[:3]), 256).alias("base_sha256")
    return found.select("doc_id", *sizes, digest, secrets.joined_spans(*secrets.KINDS).alias("spans"))


TOP_SQL = """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
    s AS (
      SELECT q.vec_id AS query_id, c.vec_id,
        CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op10_top_k", TOP_SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op11_toxicity")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held = toxicity.held_out(docs)
    model = toxicity.train(docs, table(spark, folder, "labels"), ~held)
    return toxicity.score_texts(docs.select("doc_id", "text"), model).select("doc_id", held.alias("held_out"), "score", "predicted")


def rounds_sql(k: int = 8, rounds: int = 10, width: int = 64, scale: int = 1024, seed: int = 3) -> str:
    """All rounds of exact clustering, one pair of steps (nearest centroid, means) after the other."""
    floors = f"list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT))"
    steps = [f"""
      v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, {floors} AS e FROM embeddings WHERE len(embedding) = {width}
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
      p AS MATERIALIZED (SELECT r, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM v),
      c0 AS MATERIALIZED (SELECT j, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM (
        SELECT e, row_number() OVER (ORDER BY sha256('{seed}:' || CAST(vec_id AS VARCHAR))) - 1 AS j FROM v) WHERE j < {k})"""]
    for n in range(rounds + 1):
        steps.append(f"""
      a{n} AS MATERIALIZED (SELECT r, arg_min(j, (d, j)) AS j, CAST(min(d) AS BIGINT) AS d FROM (
        SELECT p.r, c{n}.j, sum((p.x - c{n}.x) * (p.x - c{n}.x)) AS d FROM p JOIN c{n} USING (i) GROUP BY p.r, c{n}.j) GROUP BY r)""")
        if n < rounds:
            steps.append(f"""
      m{n} AS (SELECT j, i, sum(x) AS s, count(*) AS n FROM p JOIN a{n} USING (r) GROUP BY j, i),
      c{n + 1} AS MATERIALIZED (SELECT c.j, c.i, CASE WHEN m.n IS NULL THEN c.x ELSE CAST((m.s - ((m.s % m.n) + m.n) % m.n) // m.n AS BIGINT) END AS x
        FROM c{n} AS c LEFT JOIN m{n} AS m ON c.j = m.j AND c.i = m.i)""")
    return f"""WITH {",".join(steps)},
      h AS (SELECT j, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY j)
    SELECT v.vec_id, CAST(a.j AS INTEGER) AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.j) AS BIGINT) AS cluster_inertia,
      CAST(sum(a.d) OVER () AS BIGINT) AS inertia, h.centroid_sha256
    FROM a{rounds} AS a JOIN v USING (r) JOIN h USING (j)"""


@query("op12_centroid_clustering", rounds_sql())
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster_vectors(table(spark, folder, "embeddings"))


NEGATIVES_SQL = """
    WITH v AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
    s AS MATERIALIZED (
      SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
        CAST(list_sum(list_transform(list_zip(a.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v AS a JOIN v AS c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
    p AS (SELECT DISTINCT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
      SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS n FROM s WHERE same) WHERE n <= 5),
    r AS (
      SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
        CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id, p.positive_score ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 100 * s.score BETWEEN 30 * p.positive_score AND 90 * p.positive_score)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 10
"""


@query("op13_hard_negatives", NEGATIVES_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)

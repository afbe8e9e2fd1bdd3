"""Queries of the numbered operators: production parameters, whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidmill.llm import (hard_negatives, imatch, labelled, line_dedup, minhash_dedup, mixing,
                         passage_dedup, periodic_runs, quality_cnn, sentencepiece_viterbi,
                         topk_search, toxicity_nbsvm, url_templates, warc)
from bidmill.llm.store import WORD, discard, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.judge(_table(spark, sf_dir, "pages"))


def _scored(module, spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = module.train(docs, _table(spark, sf_dir, "labels"))
    rows = module.score(docs, model).select(F.col("row.doc_id").alias("doc_id"), "score")
    return rows.select(
        "doc_id", labelled.held_out(module.MODULUS, module.HELD).alias("held_out"), "score",
        F.when(F.col("score") >= module.THRESHOLD, 1).otherwise(0).alias("predicted"))


@_query
def op2_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(quality_cnn, spark, sf_dir)


@_query
def op3_norm_bucket_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@_query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.remove_repeated_lines(docs).select(
        F.col("row.doc_id").alias("doc_id"), F.col("cut.lines").cast("long").alias("n_lines"),
        F.col("cut.removed").cast("long").alias("n_removed"),
        F.col("cut.runs").cast("long").alias("n_runs"),
        F.sha2(F.col("cut.text"), 256).alias("kept_sha256"))


ORACLES["op4_line_dedup"] = rf"""
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents),
marked AS (
  SELECT *, regexp_matches(line, '[^\x20\x09-\x0D]') AS filled FROM split),
ordered AS (
  SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY place) AS following,
         row_number() OVER (PARTITION BY doc_id ORDER BY place) AS idx
  FROM marked WHERE filled),
firsts AS (
  SELECT *, min((doc_id, idx)) OVER (PARTITION BY line) AS first_line,
         CASE WHEN following IS NOT NULL
              THEN min((doc_id, idx)) OVER (PARTITION BY line, following) END AS first_pair
  FROM ordered),
later AS (
  SELECT *, coalesce(following IS NOT NULL AND (doc_id, idx) > first_pair, false) AS starts,
         length(line) >= {line_dedup.MIN_CHARS} AND (doc_id, idx) > first_line AS whole
  FROM firsts),
gone AS (
  SELECT *, starts OR whole OR coalesce(lag(starts) OVER (PARTITION BY doc_id ORDER BY idx), false)
            AS removed
  FROM later),
runs AS (
  SELECT *, removed AND NOT coalesce(lag(removed) OVER (PARTITION BY doc_id ORDER BY idx), false)
            AS begins
  FROM gone),
kept AS (
  SELECT m.doc_id, m.place, m.line, m.filled, coalesce(r.removed, false) AS removed,
         coalesce(r.begins, false) AS begins
  FROM marked m LEFT JOIN runs r ON m.doc_id = r.doc_id AND m.place = r.place)
SELECT doc_id, CAST(count(*) FILTER (filled) AS BIGINT) AS n_lines,
       CAST(count(*) FILTER (removed) AS BIGINT) AS n_removed,
       CAST(count(*) FILTER (begins) AS BIGINT) AS n_runs,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT removed), ''))
         AS kept_sha256
FROM kept GROUP BY doc_id
"""


@_query
def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


@_query
def op6_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.compared(_table(spark, sf_dir, "documents"))


@_query
def op7_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = passage_dedup.remove_repeated_passages(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed",
                      F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


@_query
def op8_toxicity_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(toxicity_nbsvm, spark, sf_dir)


@_query
def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = sentencepiece_viterbi.round_trip(docs, sentencepiece_viterbi.load())
    return out.select(
        F.col("row.doc_id").alias("doc_id"), F.col("n_tokens").cast("long").alias("n_tokens"),
        "ids_sha256", F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("row.text", F.lit(""))).alias("exact"))


@_query
def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


@_query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    rows = _table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding",
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"))
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0)


ORACLES["op11_hard_negatives"] = """
WITH ok AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM ok a JOIN ok b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score
  FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id
                               ORDER BY score DESC, other_id) AS INTEGER) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


@_query
def op12_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.write(_table(spark, sf_dir, "pages"))
    records = stored(warc.read(spark, folder), "warc-records")
    return warc.resolved(warc.captures(records)).select(
        F.col("capture.metadata.page_id").alias("page_id"), "payload_bytes", "payload_digest",
        F.col("capture.response.type").alias("record_type"), "refers_to")


ORACLES["op12_warc_captures"] = f"""
WITH held AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (
  SELECT *, CASE WHEN payload_bytes >= {warc.MIN_REVISIT}
                 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_id FROM held)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id < page_id THEN first_id END AS refers_to
FROM firsts
"""


def repeating(docs: DataFrame) -> DataFrame:
    """doc_id and text; where h = crc32(doc_id as text) is divisible by 10, the
    words from a on repeat with period p (a, p by h and the word count)."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    wide = docs.select("doc_id", "text", g.alias("g"), F.when(
        h % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"), 1)).alias("words"))
    n = F.size("words")
    where = wide.withColumn("a", F.when(n > 0, F.col("g") % n)).withColumn(
        "p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    copied = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get(
        "words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    return where.select("doc_id", F.when(F.col("a").isNull(), F.col("text"))
                        .otherwise(F.array_join(copied, " ")).alias("text"))


@_query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = periodic_runs.collapse_runs(repeating(docs))

    # the run with the greatest length / period, exactly: products, not quotients
    def better(best, run):
        return F.when(best.isNull() | (run["length"] * best["period"]
                                       > best["length"] * run["period"]), run).otherwise(best)
    best = F.aggregate("runs", F.lit(None).cast(periodic_runs.RUNS.elementType), better)
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[r[f] for f in periodic_runs.FIELDS]))
    return out.withColumn("best", best).select(
        F.col("row.doc_id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"),
        "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform(lines, lambda x: F.concat(x, F.lit("\n")))), 256)
        .alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"))

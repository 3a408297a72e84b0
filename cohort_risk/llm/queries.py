"""Registered queries of this subpackage, and their comparison SQL."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_risk.llm import (bpe, dedup, filter_audit, fingerprints, langid, licenses, mixing, near_dedup, quality,
                             secrets, token_counts, toxicity, whitening)

BYTE_BPE = "byte_bpe_50k.json"
#: Tokens that a model's context holds.
CONTEXT = 1024

QUERIES = {}
ORACLES = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _remainder(of: str, by: int) -> F.Column:
    return F.crc32(F.col(of).cast("string")) % by


@register
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir).withColumn(
        "held_out", F.coalesce(_remainder("doc_id", 3) == 1, F.lit(False)))
    samples = langid.fit(docs.filter(~F.col("held_out")))
    return langid.predict(docs, samples, keep=("doc_id", "held_out"))


@register
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.mark(table(spark, sf_dir))


ORACLES["op2_exact_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, t
      FROM d WINDOW w AS (PARTITION BY t))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g
"""


@register
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (
        table(spark, sf_dir, name).withColumn("held_out", F.coalesce(_remainder("doc_id", 5) == 0, F.lit(False)))
        for name in ("documents", "labels"))
    model = toxicity.fit(docs, labels.filter(~F.col("held_out")).drop("held_out"))
    scored = toxicity.score(docs, model, keep=("doc_id", "held_out"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@register
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir).select("doc_id", "text", "lang")
    return quality.assess(docs, keep=("doc_id",)).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", *(F.round(c, 6).alias(c) for c in ("char_distance", "word_distance")))


ORACLES["op4_quality_rules"] = quality.oracle()


@register
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir), public_tokenizers.path(BYTE_BPE))


@register
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir)
    found = secrets.scan(docs, secrets.train(secrets.labelled_samples(docs)))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{name}")
              for k, name in enumerate(secrets.KINDS[:3])]
    return found.select("doc_id", *counts, F.sha2(secrets.joined(F.col("base")), 256).alias("base_sha256"),
                        secrets.joined(F.col("spans")).alias("spans"))


@register
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(table(spark, sf_dir), public_tokenizers.path(BYTE_BPE))
    return counts.withColumn("over_limit", F.col("n_tokens") > CONTEXT)


@register
def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.col("found")
    return licenses.scan(table(spark, sf_dir)).select(
        "doc_id", F.size(found).cast("bigint").alias("n_licenses"),
        F.array_join(F.array_distinct(F.transform(found, lambda h: h["license"])), ",").alias("licenses"),
        F.array_join(F.transform(found, lambda h: F.concat_ws(
            ":", h["license"], h["start"].cast("string"), h["end"].cast("string"), h["matched"].cast("string"))),
            ",").alias("spans"),
        F.array_max(F.transform(found, lambda h: h["coverage"])).alias("coverage"))


@register
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighed = mixing.weigh(table(spark, sf_dir).select("doc_id", "text", "source", "lang"))
    return weighed.select("row.doc_id", *mixing.DIMENSIONS, "n_tokens", F.round("weight", 6).alias("weight"),
                          F.round("p", 6).alias("p"), "sampled")


ORACLES["op9_mixing"] = mixing.oracle()


@register
def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir))


@register
def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited(table(spark, sf_dir))


@register
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))


@register
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir), table(spark, sf_dir, "labels"))


# Counted directly, document by document, not by potentials: a filter's removals summed over
# all 120 orders are 120 / k for each document that fails it and k filters in all.
ORACLES["op13_filter_audit"] = r"""
WITH RECURSIVE perms(p) AS (
  SELECT l FROM (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v(l)
  UNION ALL
  SELECT p || l FROM perms, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v(l)
  WHERE length(p) < 5 AND strpos(p, l) = 0),
steps AS (
  SELECT p AS filter_order, s AS step, substr(p, s, 1) AS letter, substr(p, 1, s - 1) AS before
  FROM perms, range(1, 6) r(s) WHERE length(p) = 5),
d AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(CAST(lang AS VARCHAR), '') AS part,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
lab AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part,
         len(words) < 100 AS fa,
         100 * len(list_distinct(words)) < 80 * len(words) AS fb,
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) AS fc,
         regexp_matches(t, '[#$%&*|]') AS fd,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS fe,
         coalesce(lab.good, false) AS good, coalesce(lab.toxic, false) AS toxic
  FROM d LEFT JOIN lab USING (doc_id)),
c AS (SELECT part, fa, fb, fc, fd, fe, good, toxic, count(*) AS n FROM f GROUP BY ALL),
x AS (
  SELECT c.*, s.filter_order, s.step, s.letter,
         (strpos(s.before, 'A') > 0 AND fa) OR (strpos(s.before, 'B') > 0 AND fb)
           OR (strpos(s.before, 'C') > 0 AND fc) OR (strpos(s.before, 'D') > 0 AND fd)
           OR (strpos(s.before, 'E') > 0 AND fe) AS gone,
         CASE s.letter WHEN 'A' THEN fa WHEN 'B' THEN fb WHEN 'C' THEN fc WHEN 'D' THEN fd ELSE fe END AS fails,
         fa::int + fb::int + fc::int + fd::int + fe::int AS k
  FROM c, steps s)
SELECT part, filter_order, step, letter,
       CAST(coalesce(sum(n) FILTER (WHERE NOT gone AND NOT fails), 0) AS BIGINT) AS kept,
       CAST(coalesce(sum(n) FILTER (WHERE NOT gone AND fails), 0) AS BIGINT) AS removed,
       CAST(coalesce(sum(n) FILTER (WHERE gone AND fails), 0) AS BIGINT) AS redundant,
       CAST(coalesce(sum(n) FILTER (WHERE fails AND k = 1), 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(sum(n) FILTER (WHERE NOT gone AND fails AND good), 0) AS BIGINT) AS good_lost,
       CAST(coalesce(sum(n) FILTER (WHERE NOT gone AND fails AND toxic), 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(n * (120 // greatest(k, 1))) FILTER (WHERE fails), 0) AS BIGINT) AS shapley
FROM x GROUP BY part, filter_order, step, letter
"""

"""The queries opN_<name>: each applies one operator to its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .jaccard_join import jaccard_groups
from .ngram_lm import backoff_scores
from .html_layout import extract
from .additive_ann import nearest
from .passage_dedup import dedup_passages
from .vector_dedup import near_vectors
from .bpe_codec import encode_decode
from .packing import pack
from .toxicity import toxicity_scores
from .quality_rules import quality_scores


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"), k=4, percent=85)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_vector_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op10_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_passages(table(spark, sf_dir, "documents"))


def op2_additive_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op1_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op3_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff_scores(table(spark, sf_dir, "documents"))


QUERIES = {"op3_stupid_backoff": op3_stupid_backoff, "op1_html_layout": op1_html_layout, "op2_additive_ann": op2_additive_ann, "op10_passage_dedup": op10_passage_dedup, "op4_vector_near_dedup": op4_vector_near_dedup, "op8_bpe_chunks": op8_bpe_chunks, "op7_best_fit_packing": op7_best_fit_packing, "op6_toxicity": op6_toxicity, "op9_quality_rules": op9_quality_rules, "op5_ngram_jaccard_join": op5_ngram_jaccard_join}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of each document as a list.
_WORDS = f"words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents)"

ORACLES: dict[str, str] = {}

ORACLES["op3_stupid_backoff"] = f"""
WITH {_WORDS},
ends AS (SELECT doc_id, w, len(w) AS n_words, unnest(range(1, len(w) + 1)) AS i FROM words),
c1 AS (SELECT w[i] AS g, count(*) AS c FROM ends GROUP BY 1),
c2 AS (SELECT w[i - 1 : i] AS g, count(*) AS c FROM ends WHERE i >= 2 GROUP BY 1),
c3 AS (SELECT w[i - 2 : i] AS g, count(*) AS c FROM ends WHERE i >= 3 GROUP BY 1),
total AS (SELECT CAST(round(ln(greatest(count(*), 1)) * 1000000000) AS BIGINT) AS log FROM ends),
scored AS (
  SELECT doc_id, CASE WHEN i = 1 THEN CAST(round(ln(a.c) * 1000000000) AS BIGINT) - total.log
                      WHEN i = 2 THEN CAST(round(ln(b.c) * 1000000000) AS BIGINT) - CAST(round(ln(x.c) * 1000000000) AS BIGINT)
                      ELSE CAST(round(ln(t.c) * 1000000000) AS BIGINT) - CAST(round(ln(y.c) * 1000000000) AS BIGINT) END AS log
  FROM ends CROSS JOIN total
  LEFT JOIN c1 a ON a.g = w[i] LEFT JOIN c2 b ON i >= 2 AND b.g = w[i - 1 : i] LEFT JOIN c3 t ON i >= 3 AND t.g = w[i - 2 : i]
  LEFT JOIN c1 x ON i = 2 AND x.g = w[i - 1] LEFT JOIN c2 y ON i >= 3 AND y.g = w[i - 2 : i - 1]),
summed AS (SELECT doc_id, sum(log)::BIGINT AS log FROM scored GROUP BY doc_id)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, CASE WHEN len(w) > 0 THEN log / 1000000000.0::DOUBLE ELSE 0.0 END AS log_score,
       CASE WHEN len(w) > 0 THEN log / 1000000000.0::DOUBLE / len(w) END AS mean_log_score
FROM words LEFT JOIN summed ON words.doc_id = summed.doc_id
"""

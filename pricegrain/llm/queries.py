"""The registered queries of the training-data operators and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import covertree, langid, licenses, mixing, packing, projections, quality, secrets, simhash, suffixes
from .common import lean
from .common import table as read


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    lean(spark)
    return read(spark, sf_dir, name)


def op1_covertree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op2_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"), least=400)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, radius=2)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find(table(spark, sf_dir, "documents"), alpha=0.01, fdr=0.01)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(table(spark, sf_dir, "documents"), length=4096)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), rows=6000, good=0.7)


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"), rows_per_language=500)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), most=3).drop("source")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.search(table(spark, sf_dir, "embeddings"), every=50, k=5)


OPERATORS = (op1_covertree, op2_suffixes, op3_simhash, op4_secrets, op5_packing, op6_quality, op7_langid, op8_mixing, op9_licenses, op10_projections)

#: All pairs by brute force, then the smallest id reachable.
OP1_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::double) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9),
reach(id, seen) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.id, links.b FROM reach JOIN links ON reach.seen = links.a),
least AS (SELECT id, min(seen) AS component_id FROM reach GROUP BY id)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id)::bigint AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN least l ON l.id = e.vec_id"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return {"op1_covertree": OP1_SQL, "op9_licenses": licenses.sql()}

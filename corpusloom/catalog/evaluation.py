"""Evaluation measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog.corpora import MAJORITY_SQL
from corpusloom.catalog.inputs import annotations, documents, table
from corpusloom.catalog.registry import query
from corpusloom.operators.documents import majority_level, severity_level
from corpusloom.operators.metrics import accuracy, agreement, argmax, masked_mean


@query(
    """SELECT lang, avg(CASE WHEN (n_chars > 800) = (quality = 1) THEN 1.0::DOUBLE ELSE 0 END) AS accuracy, count(*) AS n
    FROM documents JOIN labels USING (doc_id) GROUP BY lang"""
)
def accuracy_query(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id", "lang", "n_chars")
    rows = docs.join(table(spark, sf_dir, "labels"), "doc_id").withColumn("guess", (F.col("n_chars") > 800).cast("int"))
    return accuracy(rows, "guess", "quality", by=["lang"])


@query("SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS predicted FROM embeddings")
def argmax_class(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return rows.select("vec_id", argmax(F.col("embedding")).cast("bigint").alias("predicted"))


@query(
    f"""SELECT doc_id, prediction, CAST(label AS BIGINT) AS label, prediction = label AS correct FROM (
      SELECT doc_id, (('0x'||substr(md5(doc_id||'|0'),1,8))::BIGINT) % 5 AS prediction, label FROM {MAJORITY_SQL} m)"""
)
def annotator_agreement(spark, sf_dir):
    rows = annotations(spark, sf_dir)
    first = rows.select("doc_id", severity_level(F.get("annotations", F.lit(0))["label"]).cast("bigint").alias("prediction"))
    gold = rows.select("doc_id", majority_level(F.col("annotations")).cast("bigint").alias("label"))
    return agreement(first, gold, "doc_id")


@query(
    """SELECT CAST(label AS BIGINT) AS label, CAST(i - 1 AS BIGINT) AS component, round(sum(x) / count(*), 6) AS mean FROM (
      SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings WHERE embedding[1] > 0)
    GROUP BY ALL"""
)
def mean_pool(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    means = masked_mean(rows, "embedding", F.get("embedding", F.lit(0)) > 0, by=["label"])
    return means.select(
        F.col("label").cast("bigint").alias("label"), F.posexplode("mean").alias("component", "mean")
    ).select("label", F.col("component").cast("bigint").alias("component"), F.round("mean", 6).alias("mean"))

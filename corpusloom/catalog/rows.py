"""Batches and masked rows."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from corpusloom.catalog.inputs import TOKENS_CTE, encoded, packed, packed_cte, tokenizer
from corpusloom.catalog.registry import query
from corpusloom.functions.arrays import joined
from corpusloom.operators.batching import (
    gathered,
    masked_positions,
    pad_batches,
    real_places,
    scattered,
    sequence_offsets,
    with_batches,
)
from corpusloom.operators.hooks import collate, collect_batches, map_batches
from corpusloom.operators.masking import mask_tokens, masked_count, stage_parameters
from corpusloom.operators.ordering import Order, dense_index
from corpusloom.operators.packing import PACKED_KEYS, curriculum_stages, packed_order, repack_stages
from corpusloom.operators.tokenizer import MASK, PAD, SEP, UNK

BATCH = 16

BATCHES_CTE = f"""
{TOKENS_CTE},
indexed AS (SELECT doc_id, input_ids, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM enc),
batched AS (SELECT *, idx // {BATCH} AS batch, idx % {BATCH} AS pos FROM indexed),
sized AS (SELECT *, (max(length(input_ids)) OVER (PARTITION BY batch) + 7) // 8 * 8 AS width, length(input_ids) AS len FROM batched)
"""


def _batched(spark, sf_dir):
    return with_batches(dense_index(encoded(spark, sf_dir), Order.of_id("doc_id")), BATCH)


def _padded(spark, sf_dir):
    return pad_batches(_batched(spark, sf_dir), PAD, multiple=8)


@query(
    f"""WITH RECURSIVE {BATCHES_CTE}
    SELECT doc_id, CAST(batch AS BIGINT) AS batch, CAST(width AS BIGINT) AS width,
      array_to_string(list_concat(input_ids, list_transform(range(0, width - len), lambda x: 0)), ',') AS input_ids,
      CAST(len AS BIGINT) AS n_real FROM sized"""
)
def pad_batches_query(spark, sf_dir):
    rows = _padded(spark, sf_dir)
    real = F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).cast("bigint")
    return rows.select("doc_id", "batch", "width", joined(F.col("input_ids")).alias("input_ids"), real.alias("n_real"))


@query(
    f"""WITH RECURSIVE {BATCHES_CTE}
    SELECT CAST(batch AS BIGINT) AS batch, doc_id, CAST(len AS BIGINT) AS len,
      CAST(sum(len) OVER (PARTITION BY batch ORDER BY pos) - len AS BIGINT) AS cu_len,
      CAST(max(len) OVER (PARTITION BY batch) AS BIGINT) AS max_len FROM sized"""
)
def unpad_offsets(spark, sf_dir):
    return sequence_offsets(_padded(spark, sf_dir)).select("batch", "doc_id", "len", "cu_len", "max_len")


@query(
    f"""WITH RECURSIVE {BATCHES_CTE}
    SELECT CAST(batch AS BIGINT) AS batch, CAST(pos AS BIGINT) AS pos,
      array_to_string(list_concat(input_ids, list_transform(range(0, width - len), lambda x: 0)), ',') AS values FROM sized"""
)
def repad_batches(spark, sf_dir):
    """The real ids of every row, and from these the padded row again."""
    rows = _padded(spark, sf_dir).withColumn("places", real_places(F.col("attention_mask")))
    real = rows.withColumn("values", gathered(F.col("input_ids"), F.col("places")))
    out = scattered(F.col("values"), F.col("places"), F.col("width"))
    return real.select("batch", "pos", joined(out).alias("values"))


@query(
    f"""WITH RECURSIVE {BATCHES_CTE},
    cells AS (
      SELECT batch, pos * width + j - 1 AS flat, tok FROM (
        SELECT batch, pos, width, unnest(input_ids) AS tok, generate_subscripts(input_ids, 1) AS j FROM sized)),
    edge_places AS (SELECT batch, pos * width AS flat FROM sized UNION ALL SELECT batch, pos * width + len FROM sized)
    SELECT CAST(e.batch AS BIGINT) AS batch, CAST(e.flat AS BIGINT) AS flat, CAST(coalesce(c.tok, 0) AS BIGINT) AS value
    FROM edge_places e LEFT JOIN cells c USING (batch, flat)"""
)
def gather_positions(spark, sf_dir):
    """First token and the place just after the last of every row, where a full row is followed by the next one's first."""
    # taken before padding, so that only the ids themselves are sorted
    after = F.lead(F.get("input_ids", F.lit(0))).over(Window.partitionBy("batch").orderBy("pos"))
    rows = pad_batches(_batched(spark, sf_dir).withColumn("after", after), PAD, multiple=8)
    size = F.size(F.filter("attention_mask", lambda m: m == 1))
    found = gathered(F.col("cells"), F.array(F.lit(0), F.col("len")))
    rows = rows.withColumns({"len": size, "cells": F.concat("input_ids", F.array(F.coalesce("after", F.lit(0))))})
    edges = rows.select("batch", "pos", "width", F.posexplode(F.arrays_zip(F.array(F.lit(0), F.col("len")).alias("at"), found.alias("value"))).alias("_", "edge"))
    return edges.select("batch", (F.col("pos") * F.col("width") + F.col("edge.at")).alias("flat"), F.col("edge.value").cast("bigint").alias("value"))


MASK_P, VOCAB = 0.3, "(SELECT count(*) FROM vocab)"


def _mask_cte(source: str, key: str, p: str) -> str:
    return f"""
    toks AS (SELECT *, unnest(input_ids) AS tok, generate_subscripts(input_ids, 1) - 1 AS i FROM {source}),
    digests AS (SELECT *, md5({key}||'|'||i||'|0|42') AS d FROM toks),
    draws AS (
      SELECT *, ('0x'||substr(d,1,8))::BIGINT AS h1, ('0x'||substr(d,9,8))::BIGINT AS h2, ('0x'||substr(d,17,8))::BIGINT AS h3 FROM digests),
    picked AS (SELECT *, h1 < {p} * 4294967296.0::DOUBLE AND tok NOT IN (0, 1, 2, 3) AS sel FROM draws),
    masked AS (
      SELECT *, CASE WHEN NOT sel THEN -100 ELSE tok END AS label,
        CASE WHEN NOT sel THEN tok WHEN h2 < 0.8::DOUBLE * 4294967296 THEN 3
             WHEN h2 < (0.8::DOUBLE + 0.1::DOUBLE) * 4294967296 THEN h3 % {VOCAB} ELSE tok END AS new
      FROM picked)"""


def _masked(spark, sf_dir):
    wp = tokenizer(spark, sf_dir)
    return mask_tokens(packed(spark, sf_dir, 128), MASK_P, ["grp", "chunk"], wp.size, MASK, [PAD, UNK, SEP, MASK])


PACKED_128 = packed_cte("packed", "enc", "doc_id", "128", True, 16000)


@query(
    f"""WITH RECURSIVE {TOKENS_CTE}, {PACKED_128}, {_mask_cte('packed', "grp||'|'||chunk", '0.3::DOUBLE')}
    SELECT CAST(grp AS BIGINT) AS grp, CAST(chunk AS BIGINT) AS chunk, string_agg(new::VARCHAR, ',' ORDER BY i) AS input_ids,
           string_agg(label::VARCHAR, ',' ORDER BY i) AS labels
    FROM masked GROUP BY ALL"""
)
def mlm_mask(spark, sf_dir):
    rows = _masked(spark, sf_dir)
    return rows.select("grp", "chunk", joined(F.col("input_ids")).alias("input_ids"), joined(F.col("labels")).alias("labels"))


@query(
    f"""WITH RECURSIVE {TOKENS_CTE}, {PACKED_128}, {_mask_cte('packed', "grp||'|'||chunk", '0.3::DOUBLE')}
    SELECT CAST(chunk // 64 AS BIGINT) AS batch, count(*) FILTER (label <> -100) AS masked
    FROM masked GROUP BY ALL"""
)
def masked_token_counts(spark, sf_dir):
    rows = _masked(spark, sf_dir).withColumn("batch", F.expr("chunk div 64"))
    return rows.groupBy("batch").agg(F.sum(masked_count(F.col("labels"))).alias("masked"))


@query(
    f"""WITH RECURSIVE {TOKENS_CTE}, {PACKED_128}, {_mask_cte('packed', "grp||'|'||chunk", '0.3::DOUBLE')}
    SELECT CAST(grp AS BIGINT) AS grp, CAST(chunk AS BIGINT) AS chunk,
      string_agg(i||':'||CASE WHEN label > 0 THEN label ELSE -100 END, ',' ORDER BY i) FILTER (label > 0 OR i = 0) AS kept
    FROM masked GROUP BY ALL"""
)
def masked_subset(spark, sf_dir):
    kept = masked_positions(F.col("labels"), keep_first=True)
    text = F.transform(kept, lambda s: F.concat_ws(":", s["at"].cast("string"), s["label"].cast("string")))
    return _masked(spark, sf_dir).select("grp", "chunk", F.array_join(text, ",").alias("kept"))


@query(
    f"""WITH RECURSIVE {TOKENS_CTE}, {packed_cte('packed', 'enc', 'doc_id', '512', True, 16000)},
    source_rows AS (SELECT input_ids, row_number() OVER (ORDER BY grp, chunk) - 1 AS idx, count(*) OVER () AS n FROM packed),
    bounds AS (SELECT *, CAST(floor(n - n * 0.25::DOUBLE) AS BIGINT) AS b1 FROM source_rows),
    bounds2 AS (SELECT *, CAST(floor(b1 - n * 0.25::DOUBLE) AS BIGINT) AS b2 FROM bounds),
    bounds3 AS (SELECT *, CAST(floor(b2 - n * 0.25::DOUBLE) AS BIGINT) AS b3 FROM bounds2),
    staged AS (SELECT *, CASE WHEN idx >= b1 THEN 0 WHEN idx >= b2 THEN 1 WHEN idx >= b3 THEN 2 ELSE 3 END AS stage FROM bounds3),
    totals AS (SELECT stage, sum(length(input_ids)) AS tokens, count(*) AS rows, CASE stage WHEN 0 THEN 64 WHEN 1 THEN 128 WHEN 2 THEN 256 ELSE 512 END AS seq_len FROM staged GROUP BY ALL)
    SELECT CAST(stage AS BIGINT) AS stage, CAST(seq_len AS BIGINT) AS seq_len, 0.3::DOUBLE AS mlm_p,
      CAST(CASE stage WHEN 0 THEN 512 WHEN 1 THEN 256 WHEN 2 THEN 128 ELSE 64 END AS BIGINT) AS micro_batch,
      CAST(tokens // seq_len AS BIGINT) AS n_rows FROM totals"""
)
def stage_schedule(spark, sf_dir):
    lengths = [64, 128, 256, 512]
    staged = curriculum_stages(packed(spark, sf_dir, 512), packed_order(), PACKED_KEYS, [0.25] * 4, lengths, 512)
    cut, same = repack_stages(staged, packed_order(), 512)
    sizes = cut.select("stage").unionByName(same.select("stage")).groupBy("stage").agg(F.count("*").alias("n_rows"))
    out = stage_parameters(sizes, [0.3] * 4, [512, 256, 128, 64], lengths)
    wide = {c: F.col(c).cast("bigint") for c in ("stage", "seq_len", "micro_batch")}
    return out.withColumns(wide).select("stage", "seq_len", "mlm_p", "micro_batch", "n_rows")


@query("SELECT doc_id, length(text) AS n FROM documents")
def user_batch_map(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")

    def measure(frame):
        return frame.assign(n=frame["text"].str.len())[["doc_id", "n"]]

    return map_batches(docs, measure, "doc_id bigint, n bigint")


@query(
    f"""WITH RECURSIVE {BATCHES_CTE}
    SELECT CAST(batch AS BIGINT) AS batch, count(*) AS n_rows, CAST(sum(len) AS BIGINT) AS n_tokens,
           CAST(arg_min(input_ids[2], pos) AS BIGINT) AS first_token FROM sized GROUP BY ALL"""
)
def user_collate(spark, sf_dir):
    def summarize(frame):
        frame = frame.sort_values("pos")
        return frame.iloc[:1].assign(
            n_rows=len(frame), n_tokens=frame["input_ids"].str.len().sum(), first_token=frame["input_ids"].iloc[0][1]
        )[["batch", "n_rows", "n_tokens", "first_token"]]

    rows = _batched(spark, sf_dir).select("batch", "pos", "input_ids")
    return collate(rows, summarize, "batch bigint, n_rows bigint, n_tokens bigint, first_token bigint")


@query(
    f"""WITH RECURSIVE {BATCHES_CTE}
    SELECT CAST(batch AS BIGINT) AS batch, string_agg(doc_id::VARCHAR, ',' ORDER BY pos) AS docs FROM sized GROUP BY ALL"""
)
def collate_rows(spark, sf_dir):
    rows = collect_batches(_batched(spark, sf_dir), ["doc_id"])
    return rows.select("batch", joined(F.transform("rows", lambda r: r["doc_id"])).alias("docs"))

"""Vocabulary, encoding, packing."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog.inputs import (
    REVIEWS_SQL,
    TOKENS_CTE,
    VOCABULARY_CTE,
    documents,
    encoded,
    normalize_sql,
    packed,
    packed_cte,
    reviews,
    tokenizer,
    vocabulary,
    wordpiece_cte,
    literal,
)
from corpusloom.catalog.registry import query
from corpusloom.functions.arrays import joined
from corpusloom.functions.text import LEADING_SPACE, SPACED_WORD
from corpusloom.operators.documents import sentiment_label
from corpusloom.operators.metrics import length_stats, split_counts
from corpusloom.operators.ordering import Order, shuffle_order, tail_split
from corpusloom.operators.packing import PACKED_KEYS, at_lengths, pack, packed_order, repack
from corpusloom.operators.tokenizer import SEP, encode_classification, encode_pretraining, with_masks

TEXT = "array_to_string(input_ids, ',')"


@query(f"WITH {VOCABULARY_CTE} SELECT piece, CAST(id AS BIGINT) AS id FROM vocab")
def vocab_build(spark, sf_dir):
    return vocabulary(spark, sf_dir).select("piece", F.col("id").cast("bigint").alias("id"))


@query(f"WITH RECURSIVE {TOKENS_CTE} SELECT doc_id, array_to_string(ids, ',') AS ids FROM bare")
def wordpiece_encode(spark, sf_dir):
    wp = tokenizer(spark, sf_dir)
    docs = documents(spark, sf_dir).where(~F.col("text").isin("", "\n"))
    return docs.select("doc_id", joined(wp.token_ids(F.col("text"))).alias("ids"))


@query(
    f"""WITH RECURSIVE {TOKENS_CTE}
    SELECT doc_id, {TEXT} AS input_ids, CAST(length(input_ids) AS BIGINT) AS n FROM enc"""
)
def encode_pretrain(spark, sf_dir):
    rows = encode_pretraining(documents(spark, sf_dir), tokenizer(spark, sf_dir))
    return with_masks(rows).select(
        "doc_id", joined(F.col("input_ids")).alias("input_ids"), F.size("attention_mask").cast("bigint").alias("n")
    )


@query(
    f"""WITH RECURSIVE {TOKENS_CTE}
    SELECT doc_id, array_to_string(list_concat([2], ids[1:126], [2]), ',') AS input_ids,
           CAST(CASE sentiment WHEN 'positive' THEN 2 WHEN 'neutral' THEN 1 ELSE 0 END AS BIGINT) AS labels
    FROM bare JOIN {REVIEWS_SQL} r USING (doc_id)"""
)
def encode_seqcls(spark, sf_dir):
    rows = reviews(spark, sf_dir).select(
        F.substring_index("url", "/", -1).cast("bigint").alias("doc_id"),
        "text",
        sentiment_label(F.col("sentiment")).alias("label"),
    )
    out = encode_classification(rows, tokenizer(spark, sf_dir), 128)
    return out.select("doc_id", joined(F.col("input_ids")).alias("input_ids"), F.col("labels").cast("bigint").alias("labels"))


SPANS_CTE = f"""
runs AS (
  SELECT doc_id, regexp_extract_all(text, {literal(SPACED_WORD)}) AS runs FROM documents),
run_rows AS (SELECT doc_id, unnest(runs) AS run, generate_subscripts(runs, 1) AS pos FROM runs),
span_words AS (
  SELECT doc_id, pos, regexp_replace(run, {literal(LEADING_SPACE)}, '') AS raw,
         sum(length(run)) OVER (PARTITION BY doc_id ORDER BY pos) AS e FROM run_rows),
span_norm AS (SELECT doc_id, pos, e, e - length(raw) AS b, {normalize_sql('raw')} AS word FROM span_words),
span_distinct AS (SELECT DISTINCT word FROM span_norm WHERE word <> ''),
{wordpiece_cte('span_distinct')},
span_pieces AS (
  SELECT doc_id, pos, b, e, unnest(ids) AS id, unnest(lens) AS n, generate_subscripts(ids, 1) AS j
  FROM span_norm JOIN wp USING (word)),
offsets AS (
  SELECT doc_id, pos, j, id, least(b + sum(n) OVER w - n, e) AS s, least(b + sum(n) OVER w, e) AS e
  FROM span_pieces WINDOW w AS (PARTITION BY doc_id, pos ORDER BY j))
"""


@query(
    f"""WITH RECURSIVE {VOCABULARY_CTE}, {SPANS_CTE}
    SELECT doc_id, string_agg(id||':'||CAST(s AS BIGINT)||'-'||CAST(e AS BIGINT), ' ' ORDER BY pos, j) AS spans
    FROM offsets GROUP BY doc_id"""
)
def token_offsets(spark, sf_dir):
    wp = tokenizer(spark, sf_dir)
    spans = F.transform(
        "pieces",
        lambda t: F.concat(t["id"].cast("string"), F.lit(":"), t["s"].cast("string"), F.lit("-"), t["e"].cast("string")),
    )
    located = documents(spark, sf_dir).select("doc_id", wp.token_spans(F.col("text")).alias("pieces"))
    return located.select("doc_id", F.array_join(spans, " ").alias("spans"))


@query(
    f"""WITH RECURSIVE {TOKENS_CTE}, {packed_cte('packed', 'enc', 'doc_id', '128', True, 16000)}
    SELECT CAST(grp AS BIGINT) AS grp, CAST(chunk AS BIGINT) AS chunk, {TEXT} AS input_ids FROM packed"""
)
def pack_sequences(spark, sf_dir):
    rows = pack(encoded(spark, sf_dir), Order.of_id("doc_id"), 128, SEP)
    return rows.select("grp", "chunk", joined(F.col("input_ids")).alias("input_ids"))


@query(
    f"""WITH RECURSIVE {TOKENS_CTE}, {packed_cte('packed', 'enc', 'doc_id', '128', True, 16000)},
    {packed_cte('re', 'packed', 'grp, chunk', '96', False, 300)}
    SELECT CAST(grp AS BIGINT) AS grp, CAST(chunk AS BIGINT) AS chunk, {TEXT} AS input_ids FROM re"""
)
def repack_sequences(spark, sf_dir):
    rows = repack(packed(spark, sf_dir, 128), packed_order(), 96, group_rows=300)
    return rows.select("grp", "chunk", joined(F.col("input_ids")).alias("input_ids"))


SHUFFLED_PACKED = """
mixed AS (SELECT *, (('0x'||substr(md5(concat_ws('|', grp, chunk, '42')),1,8))::BIGINT) AS key FROM packed),
ranked AS (SELECT *, row_number() OVER (ORDER BY key, grp, chunk) AS rn, count(*) OVER () AS n FROM mixed)
"""


@query(
    f"""WITH RECURSIVE {TOKENS_CTE}, {packed_cte('packed', 'enc', 'doc_id', '256', True, 16000)}, {SHUFFLED_PACKED},
    wide AS (SELECT input_ids, key, grp AS g0, chunk AS c0, unnest([64, 128, 512]) AS seq_len FROM ranked WHERE rn > n - 300),
    {packed_cte('re', 'wide', 'key, g0, c0', 'seq_len', False, 100, 'seq_len')}
    SELECT CAST(seq_len AS BIGINT) AS seq_len, CAST(grp AS BIGINT) AS grp, CAST(chunk AS BIGINT) AS chunk,
           {TEXT} AS input_ids FROM re"""
)
def dev_multi_length(spark, sf_dir):
    mixed = shuffle_order(packed(spark, sf_dir, 256), PACKED_KEYS)
    keys = ["shuffle_key", *PACKED_KEYS]
    _, dev = tail_split(mixed, Order.of_hash(*keys), keys, 300)
    rows = at_lengths(dev, Order.of_hash(*keys), [64, 128, 512], group_rows=100)
    return rows.select(F.col("seq_len").cast("bigint").alias("seq_len"), "grp", "chunk", joined(F.col("input_ids")).alias("input_ids"))


@query(
    f"""WITH RECURSIVE {TOKENS_CTE}, lens AS (SELECT length(input_ids) AS len FROM enc),
    sorted AS (SELECT len, row_number() OVER (ORDER BY len) - 1 AS i, count(*) OVER () AS n FROM lens)
    SELECT count(*) AS n, min(len) AS min_len, max(len) AS max_len, avg(len) AS mean_len,
           max(CASE WHEN i = n // 2 THEN len END) AS median_len FROM sorted"""
)
def length_stats_query(spark, sf_dir):
    return length_stats(encoded(spark, sf_dir))


@query(
    f"""WITH RECURSIVE {TOKENS_CTE}
    SELECT lang, CAST(length(input_ids) // 128 AS BIGINT) AS part, count(*) AS size
    FROM enc JOIN documents USING (doc_id) GROUP BY ALL"""
)
def split_counts_query(spark, sf_dir):
    rows = encoded(spark, sf_dir).join(documents(spark, sf_dir, "doc_id", "lang"), "doc_id")
    return split_counts(rows.withColumn("part", F.expr("cast(size(input_ids) div 128 as bigint)")), ["lang", "part"])

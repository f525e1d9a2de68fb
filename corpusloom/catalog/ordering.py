"""Shuffles, splits and corpus builds."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from corpusloom.catalog.inputs import (
    REVIEWS_SQL,
    TOKENS_CTE,
    documents,
    encoded,
    hash_sql,
    packed,
    packed_cte,
    reviews,
    tokenizer,
)
from corpusloom.catalog.registry import query
from corpusloom.functions.arrays import joined
from corpusloom.operators.documents import sentiment_label
from corpusloom.operators.metrics import step_budget
from corpusloom.operators.ordering import (
    Order,
    cap_rows,
    dense_index,
    discard_fraction,
    head,
    shuffle_order,
    tail_split,
)
from corpusloom.operators.packing import (
    PACKED_KEYS,
    curriculum_stages,
    length_membership,
    pack,
    packed_order,
    repack_stages,
)
from corpusloom.operators.tokenizer import SEP
from corpusloom.plans.finetuning import build_finetuning
from corpusloom.plans.pretraining import build_pretraining, pretraining_manifest
from corpusloom.plans.settings import BuildSettings
from corpusloom.session import materialize, scratch_path
from corpusloom.sources.manifest import read_manifest, route, with_paths, write_manifest
from corpusloom.sources.readers import with_row_ids
from corpusloom.sources.sinks import write_splits

KEYS = ["shuffle_key", "doc_id"]


def _by_hash() -> Order:
    return Order.of_hash(*KEYS)


MIXED_SQL = f"""(SELECT doc_id, n_chars, row_number() OVER (ORDER BY {hash_sql("doc_id||'|42'")}, doc_id) AS rn,
  count(*) OVER () AS n FROM documents)"""


def _mixed(spark, sf_dir):
    return shuffle_order(documents(spark, sf_dir, "doc_id", "n_chars"), ["doc_id"])


@query(f"SELECT doc_id, rn - 1 AS idx FROM {MIXED_SQL} m")
def shuffle_order_query(spark, sf_dir):
    return dense_index(_mixed(spark, sf_dir), _by_hash()).select("doc_id", "idx")


@query(f"SELECT doc_id, n_chars FROM {MIXED_SQL} m WHERE rn <= CAST(floor((1 - 0.98::DOUBLE) * n) AS BIGINT)")
def discard_fraction_query(spark, sf_dir):
    return discard_fraction(documents(spark, sf_dir, "doc_id", "n_chars"), ["doc_id"], 0.98)


@query(f"SELECT doc_id, CASE WHEN rn > n - 150 THEN 'dev' ELSE 'train' END AS role FROM {MIXED_SQL} m")
def val_split(spark, sf_dir):
    train, dev = tail_split(_mixed(spark, sf_dir), _by_hash(), KEYS, 150)
    return train.select("doc_id", F.lit("train").alias("role")).unionByName(dev.select("doc_id", F.lit("dev").alias("role")))


@query("SELECT doc_id FROM labels ORDER BY doc_id LIMIT 100")
def provided_dev_head(spark, sf_dir):
    dev = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id")
    return head(dev, Order.of_id("doc_id"), ["doc_id"], lambda n: 100)


@query(f"SELECT doc_id, n_chars FROM {MIXED_SQL} m WHERE rn <= 333")
def cap_train(spark, sf_dir):
    return cap_rows(_mixed(spark, sf_dir), _by_hash(), KEYS, 333).select("doc_id", "n_chars")


@query(
    f"""SELECT doc_id, CAST(epoch AS BIGINT) AS epoch,
      row_number() OVER (PARTITION BY epoch ORDER BY {hash_sql("doc_id||'|42|'||epoch")}, doc_id) - 1 AS idx
    FROM documents, (VALUES (0),(1)) t(epoch)"""
)
def epoch_reshuffle(spark, sf_dir):
    docs = documents(spark, sf_dir, "doc_id")
    out = None
    for epoch in (0, 1):
        one = dense_index(shuffle_order(docs, ["doc_id"], epoch=epoch), _by_hash()).select(
            "doc_id", F.lit(epoch).cast("bigint").alias("epoch"), "idx"
        )
        out = one if out is None else out.unionByName(one)
    return out


TEXT = "array_to_string(input_ids, ',')"


@query(
    f"""WITH RECURSIVE {TOKENS_CTE},
    {packed_cte('packed', 'enc', 'length(input_ids) DESC, doc_id', '128', True, 200)}
    SELECT CAST(grp AS BIGINT) AS grp, CAST(chunk AS BIGINT) AS chunk, {TEXT} AS input_ids FROM packed"""
)
def sorted_pack(spark, sf_dir):
    out = pack(encoded(spark, sf_dir), Order.longest_first("n", "doc_id"), 128, SEP, group_rows=200)
    return out.select("grp", "chunk", joined(F.col("input_ids")).alias("input_ids"))


STAGE_SQL = """
bounds AS (
  SELECT n, b1, b2, CAST(floor(b2 - n * 0.15::DOUBLE) AS BIGINT) AS b3 FROM (
    SELECT n, b1, CAST(floor(b1 - n * 0.15::DOUBLE) AS BIGINT) AS b2 FROM (
      SELECT n, CAST(floor(n - n * 0.15::DOUBLE) AS BIGINT) AS b1 FROM (SELECT count(*) AS n FROM source_rows)))),
staged AS (
  SELECT r.*, CASE WHEN idx >= b1 THEN 0 WHEN idx >= b2 THEN 1 WHEN idx >= b3 THEN 2 ELSE 3 END AS stage,
         CASE WHEN idx >= b1 THEN 64 WHEN idx >= b2 THEN 128 WHEN idx >= b3 THEN 256 ELSE 512 END AS seq_len
  FROM source_rows r, bounds)
"""


@query(
    f"""WITH RECURSIVE {TOKENS_CTE}, {packed_cte('packed', 'enc', 'doc_id', '512', True, 16000)},
    source_rows AS (SELECT input_ids, grp AS g0, chunk AS c0, row_number() OVER (ORDER BY grp, chunk) - 1 AS idx FROM packed),
    {STAGE_SQL},
    {packed_cte('re', '(SELECT * FROM staged WHERE seq_len < 512)', 'idx', 'seq_len', False, 16000, 'seq_len')},
    all_rows AS (
      SELECT seq_len, grp, chunk, input_ids FROM re
      UNION ALL SELECT seq_len, g0, c0, input_ids FROM staged WHERE seq_len = 512)
    SELECT CAST(seq_len AS BIGINT) AS seq_len, CAST(grp AS BIGINT) AS grp, CAST(chunk AS BIGINT) AS chunk, {TEXT} AS input_ids
    FROM all_rows"""
)
def curriculum_split(spark, sf_dir):
    staged = curriculum_stages(
        packed(spark, sf_dir, 512), packed_order(), PACKED_KEYS, [0.15, 0.15, 0.15, 0.55], [64, 128, 256, 512], 512
    )
    cut, same = repack_stages(staged, packed_order(), 512)
    columns = ["seq_len", "grp", "chunk", "input_ids"]
    rows = cut.select(*columns).unionByName(same.select(*columns))
    return rows.select(F.col("seq_len").cast("bigint").alias("seq_len"), "grp", "chunk", joined(F.col("input_ids")).alias("input_ids"))


@query(
    f"""WITH RECURSIVE {TOKENS_CTE}
    SELECT doc_id, CASE WHEN length(input_ids) IN (64, 128, 256, 20, 21, 22) THEN 'train' ELSE 'dev' END AS role,
      CAST(length(input_ids) AS BIGINT) AS seq_len FROM enc"""
)
def select_seq_lengths(spark, sf_dir):
    train, dev = length_membership(encoded(spark, sf_dir), [64, 128, 256, 20, 21, 22])
    rows = train.select("doc_id", F.lit("train").alias("role"), F.col("seq_len").cast("bigint").alias("seq_len"))
    rest = dev.select("doc_id", F.lit("dev").alias("role"), F.size("input_ids").cast("bigint").alias("seq_len"))
    return rows.unionByName(rest)


HYBRID = dict(
    train_lengths="64,128,256,512", dev_lengths="64,128,256,512", size_splits="0.15,0.15,0.15,0.55", dev_rows=100
)
FLAT = "CAST(part AS BIGINT) AS part, CAST(seq_len AS BIGINT) AS seq_len, array_to_string(row_key, ',') AS row_key"


def _flat_columns():
    return [
        F.col("role"),
        F.col("part").cast("bigint").alias("part"),
        F.col("seq_len").cast("bigint").alias("seq_len"),
        joined(F.col("row_key")).alias("row_key"),
        joined(F.col("input_ids")).alias("input_ids"),
    ]


def _flat(splits):
    return splits.select(*_flat_columns())


def _hybrid_sql(pack_order: str, row_order: str, same_key: str) -> str:
    return f"""WITH RECURSIVE {TOKENS_CTE}, {packed_cte('packed', 'enc', pack_order, '512', True, 16000)},
    mixed AS (SELECT *, (('0x'||substr(md5(concat_ws('|', grp, chunk, '42')),1,8))::BIGINT) AS key FROM packed),
    ranked AS (SELECT *, row_number() OVER (ORDER BY {row_order}) AS rn, count(*) OVER () AS total FROM mixed),
    source_rows AS (SELECT input_ids, key, grp AS g0, chunk AS c0, rn - 1 AS idx FROM ranked WHERE rn <= total - 100),
    dev_rows AS (SELECT input_ids, key, grp AS g0, chunk AS c0, rn FROM ranked WHERE rn > total - 100),
    {STAGE_SQL},
    {packed_cte('re', '(SELECT * FROM staged WHERE seq_len < 512)', 'idx', 'seq_len', False, 16000, 'seq_len')},
    wide AS (SELECT input_ids, rn, unnest([64, 128, 256]) AS seq_len FROM dev_rows),
    {packed_cte('dv', 'wide', 'rn', 'seq_len', False, 16000, 'seq_len')},
    splits AS (
      SELECT 'train' AS role, CASE seq_len WHEN 64 THEN 0 WHEN 128 THEN 1 ELSE 2 END AS part, seq_len, [grp, chunk] AS row_key, input_ids FROM re
      UNION ALL SELECT 'train', 3, 512, {same_key}, input_ids FROM staged WHERE seq_len = 512
      UNION ALL SELECT 'dev', CASE seq_len WHEN 64 THEN 0 WHEN 128 THEN 1 ELSE 2 END, seq_len, [grp, chunk], input_ids FROM dv
      UNION ALL SELECT 'dev', 3, 512, {same_key}, input_ids FROM dev_rows)"""


_NAIVE = _hybrid_sql("doc_id", "key, grp, chunk", "[key, g0, c0]")
_SORTED = _hybrid_sql("length(input_ids) DESC, doc_id", "grp, chunk", "[g0, c0]")


def _hybrid(spark, sf_dir, strategy, tokens=True):
    docs = documents(spark, sf_dir)
    return build_pretraining(docs, tokenizer(spark, sf_dir), BuildSettings(strategy=strategy, **HYBRID), tokens)


@query(f"{_NAIVE} SELECT role, {FLAT}, {TEXT} AS input_ids FROM splits")
def pretrain_corpus(spark, sf_dir):
    return _flat(_hybrid(spark, sf_dir, "naive"))


@query(f"{_SORTED} SELECT role, {FLAT}, {TEXT} AS input_ids FROM splits")
def pretrain_corpus_sorted(spark, sf_dir):
    return _flat(_hybrid(spark, sf_dir, "sorted"))


@query(
    f"""WITH RECURSIVE {TOKENS_CTE},
    rest AS (SELECT doc_id, input_ids, row_number() OVER (ORDER BY doc_id) AS rn, count(*) OVER () AS n FROM enc
             WHERE length(input_ids) NOT IN (20, 40, 60, 200)),
    dev_rows AS (SELECT doc_id, input_ids FROM rest WHERE rn > n - 100),
    {packed_cte('dv', 'dev_rows', 'doc_id', '64', False, 16000)},
    splits AS (
      SELECT 'train' AS role, list_position([20, 40, 60, 200], length(input_ids)) - 1 AS part, length(input_ids) AS seq_len,
             [doc_id] AS row_key, input_ids FROM enc WHERE length(input_ids) IN (20, 40, 60, 200)
      UNION ALL SELECT 'dev', 0, 64, [grp, chunk], input_ids FROM dv
      UNION ALL SELECT 'dev', 1, 512, [doc_id], input_ids FROM dev_rows)
    SELECT role, {FLAT}, {TEXT} AS input_ids FROM splits"""
)
def pretrain_corpus_not_packed(spark, sf_dir):
    settings = BuildSettings(strategy="not_packed", train_lengths="20,40,60,200", dev_lengths="64,512", dev_rows=100)
    return _flat(build_pretraining(documents(spark, sf_dir), tokenizer(spark, sf_dir), settings))


@query(
    f"""WITH RECURSIVE {TOKENS_CTE},
    rows AS (SELECT doc_id, CASE sentiment WHEN 'positive' THEN 2 WHEN 'neutral' THEN 1 ELSE 0 END AS labels FROM {REVIEWS_SQL} r),
    mixed AS (SELECT doc_id, labels, list_concat([2], ids, [2]) AS input_ids,
              row_number() OVER (ORDER BY {hash_sql("doc_id||'|42'")}, doc_id) AS rn, count(*) OVER () AS n
              FROM rows JOIN bare USING (doc_id))
    SELECT CASE WHEN rn > n - 60 THEN 'dev' ELSE 'train' END AS role, doc_id, CAST(labels AS BIGINT) AS labels, {TEXT} AS input_ids
    FROM mixed WHERE rn > n - 60 OR rn <= 200"""
)
def finetune_corpus(spark, sf_dir):
    rows = reviews(spark, sf_dir).select(
        F.substring_index("url", "/", -1).cast("bigint").alias("doc_id"), "text", sentiment_label(F.col("sentiment")).alias("label")
    )
    settings = BuildSettings(dev_rows=60, max_train_rows=200, truncate=False)
    train, dev = build_finetuning(rows, None, tokenizer(spark, sf_dir), "sequence-classification", settings)
    both = train.withColumn("role", F.lit("train")).unionByName(dev.withColumn("role", F.lit("dev")))
    return both.select("role", "doc_id", F.col("labels").cast("bigint").alias("labels"), joined(F.col("input_ids")).alias("input_ids"))


@query(
    f"""WITH RECURSIVE {TOKENS_CTE},
    rows AS (SELECT doc_id, lang IS NOT DISTINCT FROM 'de' AS given,
             CASE sentiment WHEN 'positive' THEN 2 WHEN 'neutral' THEN 1 ELSE 0 END AS labels FROM {REVIEWS_SQL} r),
    mixed AS (SELECT doc_id, labels, given, list_concat([2], ids, [2]) AS input_ids,
              row_number() OVER (PARTITION BY given ORDER BY CASE WHEN given THEN 0 ELSE {hash_sql("doc_id||'|42'")} END, doc_id) AS rn
              FROM rows JOIN bare USING (doc_id))
    SELECT CASE WHEN given THEN 'dev' ELSE 'train' END AS role, doc_id, CAST(labels AS BIGINT) AS labels, {TEXT} AS input_ids
    FROM mixed WHERE rn <= CASE WHEN given THEN 30 ELSE 200 END"""
)
def finetune_corpus_given_dev(spark, sf_dir):
    """A dev set of its own (the reviews of one language), of which the head is taken."""
    rows = reviews(spark, sf_dir).select(
        F.substring_index("url", "/", -1).cast("bigint").alias("doc_id"),
        "text",
        sentiment_label(F.col("sentiment")).alias("label"),
        F.col("aspect").eqNullSafe("de").alias("given"),
    )
    settings = BuildSettings(dev_rows=30, max_train_rows=200, truncate=False)
    train, dev = build_finetuning(
        rows.where("not given"), rows.where("given"), tokenizer(spark, sf_dir), "sequence-classification", settings
    )
    both = train.withColumn("role", F.lit("train")).unionByName(dev.withColumn("role", F.lit("dev")))
    return both.select("role", "doc_id", F.col("labels").cast("bigint").alias("labels"), joined(F.col("input_ids")).alias("input_ids"))


@query(
    f"""{_NAIVE}
    SELECT role||'_'||part||'.jsonl' AS file, role, CAST(part AS BIGINT) AS part, CAST(seq_len AS BIGINT) AS seq_len, count(*) AS size
    FROM splits GROUP BY ALL"""
)
def manifest(spark, sf_dir):
    rows = pretraining_manifest(_hybrid(spark, sf_dir, "naive", tokens=False))
    return rows.withColumns({c: F.col(c).cast("bigint") for c in ("part", "seq_len")})


@query(
    f"""{_NAIVE}
    SELECT role||'_'||part||'.jsonl' AS file, row_number() OVER (PARTITION BY role, part ORDER BY row_key) - 1 AS position,
      role, {FLAT}, {TEXT} AS input_ids FROM splits"""
)
def corpus_on_disk(spark, sf_dir):
    """A written build, read back by the paths of its manifest: every row and its place in the files."""
    out = scratch_path(spark, "build")
    splits = materialize(_hybrid(spark, sf_dir, "naive"), "splits")
    write_splits(splits, os.path.join(out, "data"), order=("row_key",))
    write_manifest(with_paths(pretraining_manifest(splits)), os.path.join(out, "manifest"))
    found = None
    for entry in read_manifest(spark, os.path.join(out, "manifest")).collect():  # a row per split
        rows = with_row_ids(spark.read.parquet(os.path.join(out, "data", entry.path)), "position").withColumns(
            {"file": F.lit(entry.file), "role": F.lit(entry.role), "part": F.lit(entry.part)}
        )
        found = rows if found is None else found.unionByName(rows)
    return found.select("file", "position", *_flat_columns())


@query(
    f"""{_NAIVE}
    SELECT file, role, position, CASE role WHEN 'dev' THEN 'val/loss_'||seq_len END AS metric,
           role = 'dev' AND position = max(position) OVER (PARTITION BY role) AS monitored
    FROM (SELECT role||'_'||part||'.jsonl' AS file, role, seq_len,
                 row_number() OVER (PARTITION BY role ORDER BY role||'_'||part||'.jsonl') - 1 AS position
          FROM splits GROUP BY role, part, seq_len)"""
)
def manifest_routing(spark, sf_dir):
    path = scratch_path(spark, "manifest")
    write_manifest(pretraining_manifest(_hybrid(spark, sf_dir, "naive", tokens=False)), path)
    return route(read_manifest(spark, path)).select("file", "role", "position", "metric", "monitored")


@query(
    f"""{_NAIVE}
    SELECT role||'_'||part||'.jsonl' AS file, size, CAST(ceil(size / 16) AS BIGINT) AS steps_per_epoch,
           CAST(ceil(size / 16) * 3 AS BIGINT) AS max_steps, CAST(floor(0.06::DOUBLE * (ceil(size / 16) * 3)) AS BIGINT) AS warmup_steps
    FROM (SELECT role, part, count(*) AS size FROM splits WHERE role = 'train' GROUP BY ALL)"""
)
def step_budget_query(spark, sf_dir):
    files = pretraining_manifest(_hybrid(spark, sf_dir, "naive", tokens=False)).where("role = 'train'")
    return step_budget(files, 16, 3, 0.06).select("file", "size", "steps_per_epoch", "max_steps", "warmup_steps")

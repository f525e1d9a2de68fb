"""Question answering."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.catalog.inputs import (
    QUESTIONS_SQL,
    VOCABULARY_CTE,
    WORD_SQL,
    literal,
    normalize_sql,
    questions,
    strip_sql,
    tokenizer,
    wordpiece_cte,
    written,
)
from corpusloom.catalog.registry import query
from corpusloom.functions.arrays import joined
from corpusloom.functions.hashing import hash32
from corpusloom.functions.text import LEADING_SPACE, SPACED_WORD
from corpusloom.operators.qa import (
    best_spans,
    context_windows,
    encode_examples,
    mean_scores,
    rekeyed_answers,
    span_labels,
    span_mismatch,
    squad_scores,
    top_positions,
)
from corpusloom.plans.finetuning import build_finetuning
from corpusloom.plans.settings import BuildSettings
from corpusloom.session import materialize

LENGTH, STRIDE = 256, 50

QA_CTE = f"""
{VOCABULARY_CTE},
qa AS (SELECT * FROM {QUESTIONS_SQL} q),
q_words AS (SELECT id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM (
  SELECT id, regexp_extract_all({normalize_sql(strip_sql('question'))}, {WORD_SQL}) AS ws FROM qa)),
runs AS (SELECT id, regexp_extract_all(context, {literal(SPACED_WORD)}) AS runs FROM qa),
run_rows AS (SELECT id, unnest(runs) AS run, generate_subscripts(runs, 1) AS pos FROM runs),
c_spans AS (
  SELECT id, pos, regexp_replace(run, {literal(LEADING_SPACE)}, '') AS raw,
         sum(length(run)) OVER (PARTITION BY id ORDER BY pos) AS e FROM run_rows),
c_words AS (SELECT id, pos, e, e - length(raw) AS b, {normalize_sql('raw')} AS word FROM c_spans),
all_words AS (SELECT word FROM q_words UNION SELECT word FROM c_words WHERE word <> ''),
{wordpiece_cte('all_words')},
q_ids AS (
  SELECT id, coalesce(ids, []) AS q FROM qa LEFT JOIN (
    SELECT id, flatten(list(ids ORDER BY pos)) AS ids FROM q_words JOIN wp USING (word) GROUP BY id) x USING (id)),
c_pieces AS (
  SELECT id, pos, b, e, unnest(ids) AS tok, unnest(lens) AS n, generate_subscripts(ids, 1) AS j FROM c_words JOIN wp USING (word)),
c_tokens AS (
  SELECT id, tok, least(b + sum(n) OVER w - n, e) AS s, least(b + sum(n) OVER w, e) AS e,
         row_number() OVER (PARTITION BY id ORDER BY pos, j) - 1 AS t
  FROM c_pieces WINDOW w AS (PARTITION BY id, pos ORDER BY j)),
shapes AS (
  SELECT id, q, length(q) AS nq, {LENGTH} - length(q) - 3 AS cap, coalesce(n, 0) AS n
  FROM q_ids LEFT JOIN (SELECT id, count(*) AS n FROM c_tokens GROUP BY id) c USING (id)),
windows AS (
  SELECT id, q, nq, cap, unnest(CASE WHEN n <= cap THEN [0] ELSE range(0, n - {STRIDE}, cap - {STRIDE}) END) AS b,
         unnest(CASE WHEN n <= cap THEN [0] ELSE range(0, length(range(0, n - {STRIDE}, cap - {STRIDE}))) END) AS win
  FROM shapes),
window_tokens AS (
  SELECT w.id, w.win, w.nq, w.q, c.tok, c.s, c.e, c.t - w.b + w.nq + 2 AS p
  FROM windows w JOIN c_tokens c ON c.id = w.id AND c.t >= w.b AND c.t < w.b + w.cap),
features AS (
  SELECT id, win, any_value(nq) + 2 AS c0, list(tok ORDER BY p) AS part, min(s) AS first_s, max(e) AS last_e,
         list_concat([2], any_value(q), [2], list(tok ORDER BY p), [2]) AS input_ids
  FROM window_tokens GROUP BY id, win)
"""


def _windows(spark, sf_dir, max_length=LENGTH):
    examples = encode_examples(questions(spark, sf_dir), tokenizer(spark, sf_dir))
    return context_windows(examples, max_length, STRIDE)


@query(
    f"""WITH RECURSIVE {QA_CTE}
    SELECT id, CAST(win AS BIGINT) AS win, array_to_string(input_ids, ',') AS input_ids, CAST(c0 AS BIGINT) AS context_begin,
           CAST(first_s AS BIGINT) AS first_char, CAST(last_e AS BIGINT) AS last_char FROM features"""
)
def qa_windows(spark, sf_dir):
    spans = F.filter("offsets", lambda o: o.isNotNull())
    return _windows(spark, sf_dir).select(
        "id",
        F.col("window").cast("bigint").alias("win"),
        joined(F.col("input_ids")).alias("input_ids"),
        F.col("context_begin").cast("bigint").alias("context_begin"),
        F.get(spans, F.lit(0))["s"].cast("bigint").alias("first_char"),
        F.element_at(spans, -1)["e"].cast("bigint").alias("last_char"),
    )


LABELS_CTE = f"""
answers AS (SELECT id, answer_start AS a, answer_start + length({strip_sql('answer_text')}) AS z FROM qa),
labelled AS (
  SELECT f.id, f.win, first_s <= a AND last_e >= z AS inside,
    (SELECT max(p) FROM window_tokens t WHERE t.id = f.id AND t.win = f.win AND t.s <= a) AS sp,
    (SELECT min(p) FROM window_tokens t WHERE t.id = f.id AND t.win = f.win AND t.e >= z) AS ep
  FROM features f JOIN answers USING (id))
"""


@query(
    f"""WITH RECURSIVE {QA_CTE}, {LABELS_CTE}
    SELECT id, CAST(win AS BIGINT) AS win, CAST(CASE WHEN inside THEN sp ELSE 0 END AS BIGINT) AS start_position,
           CAST(CASE WHEN inside THEN ep ELSE 0 END AS BIGINT) AS end_position FROM labelled"""
)
def qa_span_labels(spark, sf_dir):
    rows = span_labels(_windows(spark, sf_dir))
    return rows.select(
        "id",
        F.col("window").cast("bigint").alias("win"),
        F.col("start_position").cast("bigint").alias("start_position"),
        F.col("end_position").cast("bigint").alias("end_position"),
    )


@query(
    f"""WITH RECURSIVE {QA_CTE.replace(f'{LENGTH} - length(q) - 3 AS cap', '1000000 AS cap')}, {LABELS_CTE}
    SELECT id, CAST(sp AS BIGINT) AS start_position, CAST(ep AS BIGINT) AS end_position,
           CAST(length(input_ids) AS BIGINT) AS n FROM labelled JOIN features USING (id, win)"""
)
def qa_untruncated_labels(spark, sf_dir):
    rows = span_labels(_windows(spark, sf_dir, None))
    return rows.select(
        "id",
        F.col("start_position").cast("bigint").alias("start_position"),
        F.col("end_position").cast("bigint").alias("end_position"),
        F.size("input_ids").cast("bigint").alias("n"),
    )


@query(
    f"""SELECT CAST(id AS VARCHAR) AS id, answer_text, substr(context, answer_start + 1, length(answer_text)) <> answer_text AS mismatch
    FROM {QUESTIONS_SQL} q"""
)
def qa_span_check(spark, sf_dir):
    rows = questions(spark, sf_dir)
    answers = F.struct(F.array("answer_text").alias("text"), F.array("answer_start").alias("answer_start"))
    keyed = rows.withColumn("reference", rekeyed_answers(answers, F.col("id")))
    wrong = span_mismatch(F.col("context"), F.col("answer_start"), F.col("answer_text"))
    return keyed.select("reference.id", F.get("reference.answers.text", F.lit(0)).alias("answer_text"), wrong.alias("mismatch"))


def _features(spark, sf_dir):
    """Windows with stand-in logits drawn from hashes of the position; model output, so a written table."""

    def logits(side):
        return F.transform(
            "input_ids",
            lambda _, i: hash32(F.lit(side), F.col("id"), F.col("window"), i) / F.lit(2.0**32),
        )

    return written(
        spark,
        sf_dir,
        "qa-features",
        lambda: _windows(spark, sf_dir).withColumns({"start_logits": logits("s"), "end_logits": logits("e")}),
    )


LOGITS_CTE = f"""
positions AS (SELECT id, win, c0, length(input_ids) AS len, unnest(range(0, length(input_ids))) AS p FROM features),
logits AS (
  SELECT *, ('0x'||substr(md5('s|'||id||'|'||win||'|'||p),1,8))::BIGINT / 4294967296.0::DOUBLE AS ls,
            ('0x'||substr(md5('e|'||id||'|'||win||'|'||p),1,8))::BIGINT / 4294967296.0::DOUBLE AS le FROM positions),
tops AS (
  SELECT *, row_number() OVER (PARTITION BY id, win ORDER BY ls DESC, p) AS rs,
            row_number() OVER (PARTITION BY id, win ORDER BY le DESC, p) AS re FROM logits)
"""


@query(
    f"""WITH RECURSIVE {QA_CTE}, {LOGITS_CTE}
    SELECT id, CAST(win AS BIGINT) AS win, string_agg(p::VARCHAR, ',' ORDER BY rs) FILTER (rs <= 21) AS starts,
           string_agg(p::VARCHAR, ',' ORDER BY re) FILTER (re <= 21) AS ends FROM tops GROUP BY ALL"""
)
def qa_topk_logits(spark, sf_dir):
    def places(column):
        return joined(F.transform(top_positions(F.col(column)), lambda t: t["at"]))

    return _features(spark, sf_dir).select(
        "id", F.col("window").cast("bigint").alias("win"), places("start_logits").alias("starts"), places("end_logits").alias("ends")
    )


BEST_CTE = f"""
{LOGITS_CTE},
pairs AS (
  SELECT a.id, a.win, a.p AS sp, b.p AS ep, a.ls + b.le AS score
  FROM tops a JOIN tops b ON a.id = b.id AND a.win = b.win AND b.p >= a.p AND b.p - a.p + 1 <= 100
  WHERE a.rs <= 21 AND b.re <= 21 AND a.p >= a.c0 AND b.p >= b.c0 AND a.p < a.len - 1 AND b.p < b.len - 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, win, sp, ep) AS rn FROM pairs),
best AS (
  SELECT r.id, r.score, s.s AS s, e.e AS e FROM ranked r
  JOIN window_tokens s ON s.id = r.id AND s.win = r.win AND s.p = r.sp
  JOIN window_tokens e ON e.id = r.id AND e.win = r.win AND e.p = r.ep WHERE rn = 1),
predicted AS (
  SELECT id, score, coalesce(substr(context, CAST(s + 1 AS BIGINT), CAST(e - s AS BIGINT)), '') AS prediction
  FROM qa LEFT JOIN best USING (id))
"""


@query(f"WITH RECURSIVE {QA_CTE}, {BEST_CTE} SELECT id, round(score, 6) AS score, prediction FROM predicted")
def qa_best_span(spark, sf_dir):
    spans = best_spans(_features(spark, sf_dir), questions(spark, sf_dir).select("id", "context"))
    return spans.withColumn("score", F.round("score", 6))


def _norm_sql(text: str) -> str:
    def without_articles(x: str) -> str:
        return rf"regexp_replace({x}, '(^|[^\p{{L}}\p{{N}}_])(?:a|an|the)([^\p{{L}}\p{{N}}_]|$)', '\1 \2', 'g')"

    plain = f"regexp_replace(lower({text}), '[!-/:-@\\[-`{{-~]', '', 'g')"
    # neighbours share the space between them, so a second pass catches every other one
    squeezed = rf"regexp_replace({without_articles(without_articles(plain))}, '[\s\p{{Z}}]+', ' ', 'g')"
    return strip_sql(squeezed)


SCORES_CTE = f"""
golds AS (
  SELECT id, 0 AS gold_no, answer_text AS gold FROM qa
  UNION ALL SELECT id, 1, question FROM qa),
norms AS (SELECT id, gold_no, {_norm_sql('gold')} AS g, {_norm_sql('prediction')} AS p FROM golds JOIN predicted USING (id)),
bags AS (
  SELECT id, gold_no, token, sum(np) AS np, sum(ng) AS ng FROM (
    SELECT id, gold_no, unnest(string_split(p, ' ')) AS token, 1 AS np, 0 AS ng FROM norms
    UNION ALL SELECT id, gold_no, unnest(string_split(g, ' ')), 0, 1 FROM norms)
  WHERE token <> '' GROUP BY ALL),
sums AS (SELECT id, gold_no, sum(least(np, ng)) AS same, sum(np) AS n_p, sum(ng) AS n_g FROM bags GROUP BY ALL),
scored AS (
  SELECT id, max(CASE WHEN g = p THEN 100.0::DOUBLE ELSE 0 END) AS exact_match,
         max(CASE WHEN same > 0 THEN 200.0::DOUBLE * same / (n_p + n_g) ELSE 0 END) AS f1
  FROM norms LEFT JOIN sums USING (id, gold_no) GROUP BY id)
"""


@query(
    f"""WITH RECURSIVE {QA_CTE}, {BEST_CTE}, {SCORES_CTE}
    SELECT id, exact_match, round(f1, 6) AS f1 FROM scored
    UNION ALL SELECT -1, round(avg(exact_match), 6), round(avg(f1), 6) FROM scored"""
)
def squad_scores_query(spark, sf_dir):
    """Scores per example, and their means as example -1."""
    examples = questions(spark, sf_dir)
    predictions = best_spans(_features(spark, sf_dir), examples.select("id", "context"))
    golds = examples.select("id", F.array("answer_text", "question").alias("answers"))
    scores = materialize(squad_scores(predictions, golds), "scores")
    both = scores.unionByName(mean_scores(scores).withColumn("id", F.lit(-1).cast("bigint")))
    return both.select("id", F.round("exact_match", 6).alias("exact_match"), F.round("f1", 6).alias("f1"))


@query(
    f"""WITH RECURSIVE {QA_CTE}, {LABELS_CTE},
    mixed AS (
      SELECT id, win, CASE WHEN inside THEN sp ELSE 0 END AS sp, CASE WHEN inside THEN ep ELSE 0 END AS ep, input_ids,
        row_number() OVER (ORDER BY (('0x'||substr(md5(concat_ws('|', id, win, '42')),1,8))::BIGINT), id, win) AS rn, count(*) OVER () AS n
      FROM labelled JOIN features USING (id, win))
    SELECT CASE WHEN rn > n - 40 THEN 'dev' ELSE 'train' END AS role, id, CAST(win AS BIGINT) AS win,
      CAST(sp AS BIGINT) AS start_position, CAST(ep AS BIGINT) AS end_position, array_to_string(input_ids, ',') AS input_ids FROM mixed"""
)
def finetune_qa_corpus(spark, sf_dir):
    answers = F.struct(F.array("answer_text").alias("text"), F.array("answer_start").alias("answer_start"))
    examples = questions(spark, sf_dir).select("id", "question", "context", answers.alias("answers"))
    settings = BuildSettings(max_seq_length=LENGTH, dev_rows=40)
    train, dev = build_finetuning(
        examples, None, tokenizer(spark, sf_dir), "question-answering", settings, keys=("id", "window")
    )
    both = train.withColumn("role", F.lit("train")).unionByName(dev.withColumn("role", F.lit("dev")))
    return both.select(
        "role",
        "id",
        F.col("window").cast("bigint").alias("win"),
        F.col("start_position").cast("bigint").alias("start_position"),
        F.col("end_position").cast("bigint").alias("end_position"),
        joined(F.col("input_ids")).alias("input_ids"),
    )

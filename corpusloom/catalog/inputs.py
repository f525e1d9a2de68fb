"""Inputs of the operators derived from the test tables, in Spark and (as CTEs) in SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from corpusloom.functions.hashing import hash32
from corpusloom.functions.text import CONTROL, WHITESPACE, WORD
from corpusloom.operators.documents import SEVERITY_LEVELS
from corpusloom.operators.ordering import Order, dense_index
from corpusloom.operators.packing import pack
from corpusloom.operators.tokenizer import SEP, WordPiece, encode_pretraining, frequent_words, vocabulary_of, word_counts
from corpusloom.session import scratch_path

N_WORDS, N_SUFFIXES = 4000, 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def few_splits(df: DataFrame) -> bool:
    """Whether the rows of a scan lie in fewer splits than there are cores, or one holds more than twice its share.

    A Parquet file is cut by size, but a row group goes to one split as a whole: of the splits of a large file with one row
    group all but one are empty. Rows per split come from the files' footers.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return True
    held = df.groupBy(F.spark_partition_id()).count()
    splits, most, rows = held.agg(F.count("*"), F.max("count"), F.sum("count")).first()
    return splits > 0 and (splits < cores or most * cores > 2 * rows)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, *keys)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Documents; a table of few splits is spread over the cores, a real corpus is read as it lies."""
    docs = table(spark, sf_dir, "documents").select(*(columns or ("doc_id", "text")))
    return spread(docs, "doc_id") if few_splits(docs) else docs


_WRITTEN: dict[tuple[str, str, str], tuple[str, StructType]] = {}
_TOKENIZERS: dict[tuple[str, str], WordPiece] = {}


def written(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A derived input as a table that is written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _WRITTEN:
        df = build()
        path = scratch_path(spark, name)
        df.write.parquet(path)
        _WRITTEN[key] = (path, df.schema)
    path, schema = _WRITTEN[key]
    return spark.read.schema(schema).parquet(path)


def counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written(spark, sf_dir, "word-counts", lambda: word_counts(documents(spark, sf_dir)))


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocabulary_of(counted(spark, sf_dir), N_WORDS, N_SUFFIXES)


def tokenizer(spark: SparkSession, sf_dir: str) -> WordPiece:
    """The tokenizer of a test folder (a vocabulary is an input, made once)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TOKENIZERS:
        pieces = written(spark, sf_dir, "vocabulary", lambda: vocabulary(spark, sf_dir))
        _TOKENIZERS[key] = WordPiece(pieces, frequent=frequent_words(counted(spark, sf_dir)))
    return _TOKENIZERS[key]


def encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded documents."""
    return written(
        spark, sf_dir, "encoded", lambda: encode_pretraining(documents(spark, sf_dir), tokenizer(spark, sf_dir))
    )


def packed(spark: SparkSession, sf_dir: str, length: int) -> DataFrame:
    """Packed rows of one length."""
    return written(
        spark, sf_dir, f"packed{length}", lambda: pack(encoded(spark, sf_dir), Order.of_id("doc_id"), length, SEP)
    )


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five raters per labelled document; each level is drawn from a hash."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    names = F.array(*[F.lit(x) for x in SEVERITY_LEVELS])
    raters = F.array(*[F.lit(k) for k in range(5)])
    votes = F.transform(
        raters,
        lambda k: F.struct(
            F.concat(F.lit("rater"), k.cast("string")).alias("user"),
            F.get(names, F.pmod(hash32(F.col("doc_id"), k), F.lit(5)).cast("int")).alias("label"),
        ),
    )
    return docs.join(labels, "doc_id").select("doc_id", "text", votes.alias("annotations"))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    sentiment = F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").otherwise("neutral")
    return docs.join(labels, "doc_id").select(
        F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("url"),
        "text",
        (F.col("quality") == 1).alias("relevance"),
        sentiment.alias("sentiment"),
        F.col("lang").alias("aspect"),
    )


def below(value: Column, limit: int, what: str) -> Column:
    """The value, or an error where an id would run into the next one's range."""
    return F.when(value < limit, value).otherwise(F.raise_error(F.lit(f"too many {what} for its ids")).cast("int"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as lines, each ending in a newline, with a lone newline after every document."""
    split = F.concat(
        F.transform(F.split("text", "\n"), lambda x: F.concat(x, F.lit("\n"))), F.array(F.lit("\n"))
    )
    rows = documents(spark, sf_dir).select("doc_id", F.posexplode(split).alias("pos", "text"))
    # up to 2^20 lines a document this id keeps their order; more are an error
    line_id = F.shiftleft("doc_id", 20) + below(F.col("pos"), 1 << 20, "lines of a document")
    return rows.select(line_id.alias("line_id"), "text")


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns as questions, the next assistant turn as context, thirty of its characters as answer."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.where("role = 'user'").select(
        "conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("question")
    )
    replies = turns.where("role = 'assistant'").select("conv_id", "turn", F.col("text").alias("context"))
    start = F.expr("cast(length(context) div 3 as int)")
    pairs = asked.join(replies, ["conv_id", "turn"])
    if few_splits(turns):
        pairs = spread(pairs, "conv_id", "turn")
    return pairs.select(
        (F.col("conv_id") * 1000 + below(F.col("turn"), 1000, "turns of a conversation")).alias("id"),
        "question",
        "context",
        F.substring("context", start + 1, F.lit(30)).alias("answer_text"),
        start.alias("answer_start"),
    )


def metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a metric log, a written table: one run per user, steps numbered by time."""
    return written(spark, sf_dir, "metric-log", lambda: _metric_log(spark, sf_dir))


def _metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the table's times are UTC without a zone; name the instants whatever the session's zone is
    ts = F.expr("cast(convert_timezone('UTC', current_timezone(), ts) as timestamp)")
    events = (
        table(spark, sf_dir, "events")
        .select(F.col("user_id").alias("run"), ts.alias("ts"), "event_id", F.col("event_type").alias("metric"), "value")
        .withColumn("at", F.unix_micros("ts"))
    )
    order = Order((F.col("at"), F.col("event_id")), (F.shiftright("at", 38), F.shiftright("at", 24)))
    return dense_index(events, order, "_step", by=["run"]).select(
        "run", (F.col("_step") + 1).alias("step"), "ts", "event_id", "metric", "value"
    )


# ---- the same inputs in SQL --------------------------------------------------------------------------------


def literal(text: str) -> str:
    """A SQL string expression; control characters become chr() calls."""
    parts, plain = [], ""
    for c in text:
        if c.isprintable() and c != "'":
            plain += c
            continue
        if plain:
            parts.append(f"'{plain}'")
            plain = ""
        parts.append(f"chr({ord(c)})")
    if plain or not parts:
        parts.append(f"'{plain}'")
    return "(" + "||".join(parts) + ")"


STRIP_SET = literal(WHITESPACE)


def strip_sql(text: str) -> str:
    return f"trim({text}, {STRIP_SET})"


def normalize_sql(text: str) -> str:
    return f"strip_accents(lower(regexp_replace({text}, {literal(CONTROL)}, '', 'g')))"


def hash_sql(text: str) -> str:
    return f"(('0x'||substr(md5({text}),1,8))::BIGINT)"


WORD_SQL = literal(WORD)

VOCABULARY_CTE = f"""
counted AS (
  SELECT word, count(*) AS n FROM (
    SELECT unnest(regexp_extract_all({normalize_sql('text')}, {WORD_SQL})) AS word FROM documents)
  WHERE length(word) <= 100 GROUP BY word),
letters AS (SELECT DISTINCT unnest(string_split(word, '')) AS piece FROM counted),
top AS (SELECT word AS piece, n FROM counted WHERE length(word) > 1 ORDER BY n DESC, word LIMIT {N_WORDS}),
ends AS (
  SELECT '##'||right(word, k) AS piece, sum(n) AS n
  FROM counted, (VALUES (2),(3),(4)) AS t(k)
  WHERE length(word) > 2 AND k <= length(word) - 1
  GROUP BY 1 ORDER BY n DESC, piece LIMIT {N_SUFFIXES}),
pieces AS (
  SELECT piece, 0 AS n, 1 AS kind FROM letters WHERE piece <> ''
  UNION ALL SELECT '##'||piece, 0, 2 FROM letters WHERE piece <> ''
  UNION ALL SELECT piece, n, 3 FROM top
  UNION ALL SELECT piece, n, 4 FROM ends),
vocab AS (
  SELECT piece, id FROM (VALUES ('[PAD]',0),('[UNK]',1),('[SEP]',2),('[MASK]',3)) AS s(piece, id)
  UNION ALL
  SELECT piece, row_number() OVER (ORDER BY kind, n DESC, piece) + 3 FROM pieces)
"""


def wordpiece_cte(words: str) -> str:
    """CTE ``wp(word, ids, lens)``: the longest-match walk for the distinct words of the relation ``words(word)``."""
    return f"""
starts AS (SELECT word, unnest(range(1, length(word) + 1)) AS bgn FROM {words} WHERE length(word) <= 100),
spans AS (
  SELECT word, bgn, unnest(range(1, CASE WHEN bgn = 1 THEN length(word) ELSE least(length(word) - bgn + 1, 4) END + 1)) AS n
  FROM starts),
hits AS (
  SELECT s.word, s.bgn, max(s.n) AS n, arg_max(v.id, s.n) AS id
  FROM spans s JOIN vocab v ON v.piece = CASE WHEN s.bgn = 1 THEN '' ELSE '##' END || substr(s.word, s.bgn, s.n)
  GROUP BY ALL),
chains AS (
  SELECT word, list_reduce(
    list({{'bgn': bgn, 'nxt': bgn + n, 'ids': [id], 'lens': [n]}} ORDER BY bgn),
    lambda a, x: CASE WHEN x.bgn = a.nxt
      THEN {{'bgn': a.bgn, 'nxt': x.nxt, 'ids': list_concat(a.ids, x.ids), 'lens': list_concat(a.lens, x.lens)}} ELSE a END) AS c
  FROM hits GROUP BY word),
wp AS (
  SELECT d.word, coalesce(w.c.ids, [1]) AS ids, coalesce(w.c.lens, [length(d.word)]) AS lens
  FROM {words} d LEFT JOIN chains w ON w.word = d.word AND w.c.bgn = 1 AND w.c.nxt = length(d.word) + 1)
"""


TOKENS_CTE = f"""
{VOCABULARY_CTE},
docs AS (
  SELECT doc_id, regexp_extract_all({normalize_sql('text')}, {WORD_SQL}) AS words
  FROM documents WHERE text NOT IN ('', chr(10))),
placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM docs),
vocabulary_words AS (SELECT DISTINCT word FROM placed),
{wordpiece_cte('vocabulary_words')},
bare AS (
  SELECT d.doc_id, coalesce(p.ids, []) AS ids FROM docs d LEFT JOIN (
    SELECT doc_id, flatten(list(ids ORDER BY pos)) AS ids FROM placed JOIN wp USING (word) GROUP BY doc_id) p USING (doc_id)),
enc AS (SELECT doc_id, list_concat([2], ids, [2]) AS input_ids FROM bare)
"""


def packed_cte(name: str, source: str, order: str, length: str, separator: bool, group_rows: int, by: str = "") -> str:
    """CTE ``name(by, grp, chunk, ids)``: the token stream of ``source(by, input_ids, order columns)`` cut token by token."""
    keys = f"{by}, " if by else ""
    ids = "list_append(input_ids, 2)" if separator else "input_ids"
    return f"""
{name}_rows AS (
  SELECT {keys}input_ids, {length} AS _len,
         row_number() OVER ({'PARTITION BY ' + by if by else ''} ORDER BY {order}) - 1 AS idx FROM {source}),
{name}_tokens AS (
  SELECT {keys}_len, idx, idx // {group_rows} AS grp, unnest({ids}) AS tok, generate_subscripts({ids}, 1) AS j
  FROM {name}_rows),
{name}_stream AS (
  SELECT {keys}_len, grp, tok, row_number() OVER (PARTITION BY {keys}grp ORDER BY idx, j) - 1 AS p FROM {name}_tokens),
{name} AS (
  SELECT {keys}grp, p // _len AS chunk, list(tok ORDER BY p) AS input_ids
  FROM {name}_stream GROUP BY {keys}grp, p // _len, _len
  HAVING count(*) = _len OR p // _len = 0)
"""


REVIEWS_SQL = """(
  SELECT d.doc_id, d.text, l.quality = 1 AS relevance,
         CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END AS sentiment, lang
  FROM documents d JOIN labels l USING (doc_id))"""

LOG_SQL = """(
  SELECT user_id AS run, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step,
         ts, event_id, event_type AS metric, value FROM events)"""

QUESTIONS_SQL = """(
  SELECT u.conv_id * 1000 + a.turn AS id, u.text AS question, a.text AS context,
         length(a.text) // 3 AS answer_start, substr(a.text, length(a.text) // 3 + 1, 30) AS answer_text
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""

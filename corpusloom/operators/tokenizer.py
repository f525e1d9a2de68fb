"""WordPiece as a column expression.

A vocabulary is bounded (tens of thousands of pieces), so it rides along as a constant hash table and each
document is encoded where it is read: no shuffle, no join on words (whose frequencies are as skewed as data
gets) and no Python worker. Only offsets into the text (``token_spans``) are counted in Arrow batches, whose distinct words
are looked up once.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from corpusloom.functions.arrays import let
from corpusloom.functions.text import SPACE, SPACED_WORD, WORD, document_text, normalize_word, words, words_apart
from corpusloom.session import materialize

# Special pieces in id order; sequences both begin and end with the separator.
SPECIALS = ("[PAD]", "[UNK]", "[SEP]", "[MASK]")
PAD, UNK, SEP, MASK = 0, 1, 2, 3
LONGEST_WORD = 100
MAX_PIECES = 250_000

PIECE = "struct<id:int,n:int>"
BUCKETS = 1 << 15

#: Frequent words whose pieces are worked out beforehand.
FREQUENT_WORDS = 100_000

#: Words whose pieces a task remembers.
KNOWN_WORDS = 500_000


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """``piece, id`` from a text file with one piece per line; the id is the line number."""
    lines = spark.read.text(path, wholetext=True).select(F.split("value", "\r?\n").alias("lines"))
    return (
        lines.select(F.posexplode("lines").alias("id", "piece"))
        .where("piece <> ''")
        .select("piece", "id")
    )


def word_counts(docs: DataFrame, text: str = "text", accents: bool = False) -> DataFrame:
    """``word, n`` of all normalised words that are not too long.

    White space ends words and clean-up leaves it alone, so the runs between are counted as they lie, and only distinct
    ones are cleaned up and split into words. Counts combine map-side, so popular words do not skew.
    """
    runs = docs.select(F.explode(F.split(text, f"[{SPACE}]+")).alias("run")).groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    split = runs.select(F.explode(words(F.col("run"), accents)).alias("word"), "n")
    return split.groupBy("word").agg(F.sum("n").alias("n")).where(F.length("word") <= LONGEST_WORD)


def frequent_words(counted: DataFrame, n_words: int = FREQUENT_WORDS) -> DataFrame:
    """``word``: the commonest of ``word_counts``."""
    return counted.orderBy(F.desc("n"), "word").limit(n_words).select("word")


def derive_vocabulary(docs: DataFrame, n_words: int, n_suffixes: int, text: str = "text", accents: bool = False):
    """``piece, id`` of the words of documents; their counts are written once because three rankings read them."""
    return vocabulary_of(materialize(word_counts(docs, text, accents), "word-counts"), n_words, n_suffixes)


def vocabulary_of(counted: DataFrame, n_words: int, n_suffixes: int) -> DataFrame:
    """``piece, id``: specials, single characters, the commonest words and the commonest word endings.

    Stands in for a published vocabulary file. ``counted`` is a written table of ``word_counts``.
    """
    letters = counted.select(F.explode(F.array_distinct(F.split("word", ""))).alias("piece")).where("piece <> ''").distinct()
    top = counted.where(F.length("word") > 1).orderBy(F.desc("n"), "word").limit(n_words)
    ends = (
        counted.where(F.length("word") > 2)
        .select(
            F.explode(
                F.transform(
                    F.sequence(F.lit(2), F.least(F.lit(4), F.length("word") - 1)),
                    lambda k: F.concat(F.lit("##"), F.substring(F.col("word"), F.length("word") - k + 1, k)),
                )
            ).alias("piece"),
            "n",
        )
        .groupBy("piece")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "piece")
        .limit(n_suffixes)
    )
    zero = F.lit(0).cast("bigint").alias("n")
    pieces = (
        letters.select("piece", zero, F.lit(1).alias("kind"))
        .unionByName(letters.select(F.concat(F.lit("##"), "piece").alias("piece"), zero, F.lit(2).alias("kind")))
        .unionByName(top.select(F.col("word").alias("piece"), "n", F.lit(3).alias("kind")))
        .unionByName(ends.select("piece", "n", F.lit(4).alias("kind")))
    )
    rank = F.row_number().over(Window.orderBy("kind", F.desc("n"), "piece"))  # a vocabulary, not the corpus
    specials = counted.sparkSession.createDataFrame(list(zip(SPECIALS, range(len(SPECIALS)))), "piece string, id int")
    return specials.unionByName(pieces.select("piece", (rank + len(SPECIALS) - 1).cast("int").alias("id")))


class WordPiece:
    """Greedy longest-match-first WordPiece over a bounded vocabulary.

    ``frequent`` may name words of the corpus: the pieces of up to ``FREQUENT_WORDS`` of them join the constant table, so that
    only rarer words are walked where they occur. The results are the same without it.
    """

    def __init__(self, vocabulary: DataFrame, accents: bool = False, frequent: DataFrame | None = None):
        rows = (
            vocabulary.select(
                "piece", "id", F.regexp_replace("piece", "^##(?=.)", "").alias("key"), F.col("piece").rlike("^##.").alias("inner")
            )
            .withColumn("bucket", _bucket(F.col("key")))
            .limit(MAX_PIECES + 1)
            .collect()
        )
        if len(rows) > MAX_PIECES:
            raise ValueError(f"vocabulary has more than {MAX_PIECES} pieces")
        self.accents = accents
        self.size = len(rows)
        self.ids = {r.piece: r.id for r in rows if r.piece in SPECIALS}
        plain = [r for r in rows if r.piece not in SPECIALS]
        first, inner = [r for r in plain if not r.inner], [r for r in plain if r.inner]
        self._longest = {k: max((len(r.key) for r in v), default=1) for k, v in (("first", first), ("inner", inner))}
        self._first, self._inner = {r.key: r.id for r in first}, {r.key: r.id for r in inner}
        whole = [(r.bucket, r.key, [{"id": r.id, "n": len(r.key)}]) for r in first]
        self._tables = {
            "word": _table(whole, f"array<{PIECE}>"),
            "first": _table([(b, key, piece) for b, key, (piece,) in whole], PIECE),
            "inner": _table([(r.bucket, r.key, {"id": r.id, "n": len(r.key)}) for r in inner], PIECE),
        }
        if frequent is not None:
            taken = frequent.limit(FREQUENT_WORDS).repartition(frequent.sparkSession.sparkContext.defaultParallelism)
            walked = taken.select("word", _bucket(F.col("word")).alias("bucket"))
            known = walked.withColumn("pieces", self.pieces(F.col("word"))).collect()
            cut = [(r.bucket, r.word, [{"id": p.id, "n": p.n} for p in r.pieces]) for r in known]
            self._tables["word"] = _table(whole + cut, f"array<{PIECE}>")

    def _lookup(self, table: str, key: Column) -> Column:
        return F.element_at(F.element_at(self._tables[table], _bucket(key) + 1), key)

    def _longest_at(self, word: Column, at: Column, table: str) -> Column:
        """The longest piece of ``table`` starting at a 1-based position, or null."""
        return F.aggregate(
            F.sequence(F.lit(1), F.least(F.lit(self._longest[table]), F.length(word) - at + 1)),
            F.lit(None).cast(PIECE),
            lambda best, n: F.coalesce(self._lookup(table, F.substring(word, at, n)), best),
        )

    def pieces(self, word: Column) -> Column:
        """``array<struct<id, n>>`` of one normalised word: piece ids and their lengths in characters."""
        unknown = F.array(F.struct(F.lit(self.ids["[UNK]"]).alias("id"), F.length(word).alias("n")))
        start = F.expr(f"cast(named_struct('at', 1, 'out', array()) as struct<at:int,out:array<{PIECE}>>)")

        def advance(state: Column, at: Column) -> Column:
            found = F.when(at == 1, self._longest_at(word, at, "first")).otherwise(self._longest_at(word, at, "inner"))
            taken = let(
                found,
                lambda hit: F.when(
                    hit.isNull(), F.struct(F.lit(-1).alias("at"), state["out"].alias("out"))
                ).otherwise(F.struct((at + hit["n"]).alias("at"), F.concat(state["out"], F.array(hit)).alias("out"))),
            )
            return F.when(state["at"] != at, state).otherwise(taken)

        walked = F.aggregate(
            F.sequence(F.lit(1), F.length(word)),
            start,
            advance,
            lambda state: F.when(state["at"] < 0, unknown).otherwise(state["out"]),
        )
        return F.coalesce(
            self._lookup("word", word), F.when(F.length(word) > LONGEST_WORD, unknown).otherwise(walked)
        )

    def _walk(self) -> Callable[[str], list[tuple[int, int]]]:
        """A function from a word to its piece ids and their lengths in characters."""
        first, inner, unknown = self._first, self._inner, self.ids["[UNK]"]
        longest = [max(map(len, table), default=1) for table in (first, inner)]

        def walk(word: str) -> list[tuple[int, int]]:
            if word in first:
                return [(first[word], len(word))]
            if len(word) > LONGEST_WORD:
                return [(unknown, len(word))]
            at, out = 0, []
            while at < len(word):
                table, most = (inner, longest[1]) if at else (first, longest[0])
                end = next((e for e in range(min(at + most, len(word)), at, -1) if word[at:e] in table), None)
                if end is None:
                    return [(unknown, len(word))]
                out.append((table[word[at:end]], end - at))
                at = end
            return out

        return walk

    def _lookups(self) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """A function from words to the number of pieces of each, all piece ids and their lengths in characters.

        It looks up the distinct words of a batch, each once, and keeps what it found.
        """
        walk, known = self._walk(), {}

        def pieces(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            coded = words.dictionary_encode()
            if len(known) > KNOWN_WORDS:
                known.clear()
            found = []
            for word in coded.dictionary.to_pylist():
                if word not in known:
                    known[word] = walk(word)
                found.append(known[word])
            codes = coded.indices.to_numpy()
            counts = np.array([len(f) for f in found], dtype=np.int64)
            pool = np.array([piece for f in found for piece in f], dtype=np.int32).reshape(-1, 2)
            n = counts[codes]
            places = np.repeat((counts.cumsum() - counts)[codes] - (n.cumsum() - n), n) + np.arange(n.sum())
            return n, pool[places, 0], pool[places, 1]

        return pieces

    def token_ids(self, text: Column) -> Column:
        """Piece ids of a text, without specials."""
        return F.transform(
            F.flatten(F.transform(words(text, self.accents), self.pieces)), lambda piece: piece["id"]
        )

    def token_count(self, text: Column) -> Column:
        """The number of ``token_ids``, which are not put together for it.

        Words are taken apart in the JVM; an Arrow batch adds up their counts, and a word is walked once as long as it is
        remembered. Give it a column of its own.
        """
        walk = self._walk()

        class Counts(dict):
            def __missing__(self, word: str) -> int:
                count = self[word] = len(walk(word))
                return count

        known = Counts()

        def count(texts: pa.Array) -> pa.Array:
            out = []
            for text in texts.to_pylist():
                if len(known) > KNOWN_WORDS:
                    known.clear()
                # control characters are gone, so these blanks are those of the splitter
                out.append(None if text is None else sum(map(known.__getitem__, text.split())))
            return pa.array(out, pa.int32())

        return _whole(F.arrow_udf(count, "int"))(words_apart(text, self.accents))

    def token_spans(self, text: Column) -> Column:
        """``array<struct<id, s, e>>``: piece ids with character offsets into the original text.

        Give it a column of its own before array functions with lambdas read it.
        """
        pieces = self._lookups()

        def encode(runs: pa.Array, raw: pa.Array, normal: pa.Array) -> pa.Array:
            n_runs = runs.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.r_[0, np.cumsum(n_runs)]
            # runs tile the text; the word sits at the end of its run, and pieces split it from the left
            run, length = (pc.utf8_length(texts.flatten()).to_numpy().astype(np.int64) for texts in (runs, raw))
            upto = np.r_[0, run.cumsum()]
            e = upto[1:] - np.repeat(upto[ends[:-1]], n_runs)
            n, ids, sizes = pieces(normal.flatten())
            done = np.r_[0, sizes.cumsum()]
            after = done[1:] - np.repeat(done[np.r_[0, n.cumsum()][:-1]], n)
            begin, last = np.repeat(e - length, n), np.repeat(e, n)
            columns = (ids, np.minimum(begin + after - sizes, last), np.minimum(begin + after, last))
            spans = pa.StructArray.from_arrays([pa.array(c, pa.int32()) for c in columns], ["id", "s", "e"])
            return pa.ListArray.from_arrays(pa.array(np.r_[0, n.cumsum()][ends], pa.int32()), spans, mask=runs.is_null())

        runs, raw = (F.regexp_extract_all(text, F.lit(pattern), F.lit(0)) for pattern in (SPACED_WORD, WORD))
        # words hold no line break and clean-up leaves it alone, so all words are cleaned up at once
        cleaned = F.split(normalize_word(F.array_join(raw, "\n"), self.accents), "\n", -1)
        normal = F.when(F.size(raw) > 0, cleaned).otherwise(F.expr("cast(array() as array<string>)"))
        return _whole(F.arrow_udf(encode, "array<struct<id:int,s:int,e:int>>"))(runs, raw, normal)

    def framed(self, ids: Column, max_length: int | None = None) -> Column:
        """Add the separator at both ends, first cutting so that the whole fits ``max_length``."""
        sep = F.array(F.lit(self.ids["[SEP]"]))
        body = ids if max_length is None else F.slice(ids, 1, max(max_length - 2, 0))
        return F.concat(sep, body, sep)


def _bucket(key: Column) -> Column:
    return F.pmod(F.hash(key), F.lit(BUCKETS))


def _table(entries: list[tuple[int, str, object]], value_type: str) -> Column:
    """A constant hash table: an array of small maps addressed by the key's hash."""
    buckets: list[dict] = [{} for _ in range(BUCKETS)]
    for bucket, key, value in entries:
        buckets[bucket][key] = value
    return F.from_json(F.lit(json.dumps(buckets)), f"array<map<string,{value_type}>>")


def _whole(udf):
    """A function that Spark works out where it stands: it would carry others into later lambdas or their arguments, where none can run."""
    return udf.asNondeterministic()


def _not_blank(docs: DataFrame, text: str) -> DataFrame:
    return docs.where(~F.col(text).isin("", "\n"))


def encode_pretraining(docs: DataFrame, tokenizer: WordPiece, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, input_ids, n`` for every document that is neither empty nor a lone newline; ``n`` is the length."""
    ids = tokenizer.framed(tokenizer.token_ids(document_text(F.col(text))))
    return _not_blank(docs, text).select(key, ids.alias("input_ids")).withColumn("n", F.size("input_ids"))


def pretraining_lengths(
    docs: DataFrame, tokenizer: WordPiece, ids_of: Sequence[int] = (), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, n`` of ``encode_pretraining``, for what needs no tokens; ``input_ids`` too where ``n`` is one of ``ids_of``."""
    whole = document_text(F.col(text))
    rows = _not_blank(docs, text).select(key, text, tokenizer.token_count(whole).alias("_n")).withColumn("n", F.col("_n") + 2)
    if not ids_of:
        return rows.select(key, "n")
    ids = F.when(F.col("n").isin(list(ids_of)), tokenizer.framed(tokenizer.token_ids(whole)))
    return rows.select(key, ids.alias("input_ids"), "n")


def encode_classification(
    rows: DataFrame, tokenizer: WordPiece, max_length: int | None, key: str = "doc_id", text: str = "text", label: str = "label"
) -> DataFrame:
    """``key, input_ids, labels``; ``max_length=None`` leaves long rows whole."""
    ids = tokenizer.framed(tokenizer.token_ids(F.col(text)), max_length)
    return rows.select(key, ids.alias("input_ids"), F.col(label).cast("int").alias("labels"))


def with_masks(rows: DataFrame, ids: str = "input_ids") -> DataFrame:
    """Attention mask of ones and token types of zeros; derived on read rather than stored."""
    size = F.size(ids)
    return rows.withColumns(
        {"attention_mask": F.array_repeat(F.lit(1), size), "token_type_ids": F.array_repeat(F.lit(0), size)}
    )

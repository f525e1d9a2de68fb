"""Phrase collocations by SON partitioning, with exact counts.

First pass: every shard (the texts of a language that one task holds at a time) is mined completely for two-word phrases
at a support lowered to its share of the language. A phrase with the global support reaches the lowered one in some
shard, so the union of what the shards report misses none; what shards did not report is bounded by their lowered
supports, which narrows that union to phrases that can still reach the support. Three-word phrases are mined likewise where
both of their two-word parts are candidates. Last pass: all candidates are counted in all shards and the counts added up.

Shards report 32-bit codes of phrases, sorted and packed, so that a phrase takes about two octets on its way. Candidates
travel on as bit tables of fixed size. A bit or code shared with another phrase costs a count that is dropped later; every
result rests on the counts of the phrases themselves, never on hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusloom.llm.common import mixed, narrow, windows
from corpusloom.session import arrow_octets, materialize

#: Occurrences a phrase needs, phrases reported per language, share (percent) of a phrase that a longer one must hold to replace it.
SUPPORT, TOP, INSIDE = 10, 2000, 50
#: Text octets of the shards that a task mines at a time (all languages together); bits of the table of candidates, as a power of two.
SHARD_OCTETS, TABLE_BITS = 16 << 20, 27
#: Octets of an Arrow batch of texts, which Spark and Python each hold, some of it twice.
ARROW_OCTETS = 2 << 20
#: Rows of a batch handed back to Spark; words looked at at a time where temporary arrays would be several times the shard.
BATCH, BLOCK = 50_000, 1 << 18

_END = b"\xff"  # stands for the end of a piece; no UTF-8 text has this byte
_BYTES = bytes(0xFF if chr(b) in ".,;:!?\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_and_ends(text: bytes) -> list[bytes]:
    """Words of UTF-8 text (A-Z lower-cased, between blanks and tabs) with a mark between pieces."""
    return text.translate(_BYTES).replace(_END, b" \xff ").split()


class _Numbers(dict):
    """Numbers of words from 1, as they come; the end of a piece is 0."""

    def __init__(self):
        super().__init__({_END: 0})

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


class _Shard:
    """The texts of one language that a task holds: word numbers with 0 between pieces."""

    def __init__(self, octets: int):
        self.all_octets, self.octets, self.parts = octets, 0, []

    def add(self, words: list[bytes], numbers: _Numbers, octets: int) -> None:
        self.octets += octets
        if words:
            self.parts.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
            self.parts.append(np.zeros(1, np.uint32))

    def numbers(self) -> np.ndarray:
        self.parts = [np.concatenate(self.parts) if self.parts else np.zeros(0, np.uint32)]  # the pieces are not kept beside it
        return self.parts[0]

    def support(self, support: int) -> int:
        """The support lowered to the shard's share of its language, rounded up."""
        return max(1, -(-support * self.octets // max(self.all_octets, 1)))


def _shards(batches: Iterator[pa.RecordBatch], octets: int) -> Iterator[tuple[_Numbers, dict[str, _Shard]]]:
    """Shards by language, as much as ``octets`` of text at a time; a text is never cut.

    Who takes a shard lets go of it before asking for the next, so that a task holds one at a time.
    """
    numbers, held, size = _Numbers(), {}, 0
    for batch in batches:
        for row in zip(batch["lang"], batch["all_octets"], batch["text"].cast(pa.binary())):  # a view: the octets are not copied
            lang, all_octets, text = (x.as_py() for x in row)  # one text at a time leaves Arrow
            if lang not in held:
                held[lang] = _Shard(all_octets)
            held[lang].add(words_and_ends(text), numbers, len(text))
            size += len(text)
            if size >= octets:
                yield numbers, held
                numbers, held, size = _Numbers(), {}, 0
    if held:
        yield numbers, held


def _codes(numbers: _Numbers) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, numbers), np.uint64, len(numbers))


def _pairs(words: np.ndarray, codes: np.ndarray, lang: str) -> tuple[np.ndarray, np.ndarray]:
    """A code of every two neighbours, and whether both are words."""
    pairs = windows(codes[words], 2) ^ np.uint64(xxhash.xxh3_64_intdigest(lang, seed=1))
    return pairs, (words[:-1] > 0) & (words[1:] > 0)


def _pair_codes(words: np.ndarray, codes: np.ndarray, lang: str) -> np.ndarray:
    """32-bit codes of all two neighbours that are words, block by block."""
    found = [np.zeros(0, np.uint32)]
    for begin in range(0, len(words) - 1, BLOCK):
        pairs, inside = _pairs(words[begin : begin + BLOCK + 1], codes, lang)
        found.append(pairs[inside].astype(np.uint32))
    return np.concatenate(found)


def _tally(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, ascending, and how often each occurs; sorts in place, where ``np.unique`` holds several arrays."""
    values.sort()
    first = np.flatnonzero(np.concatenate([np.ones(min(len(values), 1), bool), values[1:] != values[:-1]]))
    return values[first], np.diff(first, append=len(values))


def _slices(n: int) -> Iterator[slice]:
    return (slice(begin, begin + BATCH) for begin in range(0, n, BATCH))


def _packed(codes: np.ndarray, sure: np.ndarray) -> bytes:
    """Ascending codes and their counts: gaps of codes are small, so octets of one place are put side by side and compressed."""
    both = np.concatenate([np.diff(codes, prepend=np.uint32(0)), sure]).astype("<u4")
    return zlib.compress(both.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    octets = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1)
    gaps, sure = np.ascontiguousarray(octets.T).view("<u4").reshape(2, -1)
    return gaps.cumsum(dtype=np.uint32), sure


def _part_bits(all_octets: int, octets: int) -> int:
    """Codes are counted in 2^k ranges, each of about the phrases of two shards."""
    return min(16, max(0, all_octets // (2 * octets)).bit_length())


MINED = "lang string, part int, codes binary, slack int"
_MINED = pa.schema({"lang": pa.string(), "part": pa.int32(), "codes": pa.binary(), "slack": pa.int32()})


def mine(texts: DataFrame, support: int, octets: int, table: np.ndarray | None = None) -> DataFrame:
    """Codes of the phrases that reach the lowered support of a shard, packed by ranges, with their counts there less its slack.

    Phrases have two words or, with a table of candidates, three words that are candidates twice. ``slack`` is what a shard may
    have left unreported of a phrase; a row without a part states it for the whole shard.
    """
    shared = None if table is None else texts.sparkSession.sparkContext.broadcast(table)  # of fixed size

    def of_shard(numbers: _Numbers, held: dict[str, _Shard]) -> Iterator[pa.RecordBatch]:
        codes = _codes(numbers)
        for lang, shard in held.items():
            least = shard.support(support)
            yield pa.record_batch([[lang], [None], [None], [least - 1]], _MINED)
            words = shard.numbers()
            if len(words) < 2:
                continue
            if shared is None:
                found = _pair_codes(words, codes, lang)
            else:
                flag = _flagged(words, codes, lang, shared.value)
                found = np.concatenate([np.zeros(0, np.uint32), *(_triples(words, codes, lang, at).astype(np.uint32) for at in _twice(flag))])
            found, n = _tally(found)
            found, n = found[n >= least], n[n >= least]
            sure = np.minimum(n - (least - 1), support).astype(np.uint32)
            bits = _part_bits(shard.all_octets, octets)
            bounds = np.searchsorted(found, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(32 - bits))
            parts = np.flatnonzero(np.diff(bounds))
            for some in _slices(len(parts)):
                packed = [_packed(found[bounds[k] : bounds[k + 1]], sure[bounds[k] : bounds[k + 1]]) for k in parts[some].tolist()]
                m = len(packed)
                yield pa.record_batch([pa.repeat(lang, m), pa.array(parts[some], pa.int32()), packed, pa.repeat(least - 1, m).cast(pa.int32())], _MINED)

    def mined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for numbers, held in _shards(batches, octets):
            yield from of_shard(numbers, held)
            del numbers, held

    return texts.mapInArrow(mined, MINED)


def candidates(mined: DataFrame, support: int) -> DataFrame:
    """Codes whose reported counts and unreported remainder can together reach the support."""
    # written, so that Spark sees how small it is and joins it where the counts lie
    slack = materialize(mined.where("part is null").groupBy("lang").agg(F.sum("slack").alias("missing")), "phrase-slack")

    def reached(rows: pd.DataFrame) -> pd.DataFrame:
        codes, sure = (np.concatenate(x) for x in zip(*map(_unpacked, rows["codes"])))
        order = np.argsort(codes, kind="stable")
        codes, sure = codes[order], sure[order].astype(np.int64)
        first = np.flatnonzero(np.diff(codes, prepend=~codes[:1]) != 0)
        found = codes[first][np.add.reduceat(sure, first) + int(rows["missing"].iloc[0]) >= support]
        return pd.DataFrame({"code": found.astype(np.int64)})

    packed = mined.where("part is not null").select("lang", "part", "codes").join(slack, "lang")
    return packed.groupBy("lang", "part").applyInPandas(reached, "code bigint")


def bit_table(codes: DataFrame, bits: int) -> np.ndarray:
    """A table of 2^bits bits (32 at most) with those of the codes set: that size bounds what comes to the driver."""
    place = F.col("code").bitwiseAND(F.lit((1 << bits) - 1))
    bit = F.expr("shiftleft(1L, cast(code & 63 as int))")
    words = codes.groupBy(F.shiftright(place, 6).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    table = np.zeros(1 << (bits - 6), np.int64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy()
    return table.view(np.uint64)


def _bits(table: np.ndarray, codes: np.ndarray) -> np.ndarray:
    place = codes & np.uint64(len(table) * 64 - 1)
    return ((table[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1)).astype(bool)


def _flagged(words: np.ndarray, codes: np.ndarray, lang: str, table: np.ndarray) -> np.ndarray:
    """Whether every two neighbours are words with their bit set, block by block."""
    flag = np.zeros(max(len(words) - 1, 0), bool)
    for begin in range(0, len(flag), BLOCK):
        pairs, inside = _pairs(words[begin : begin + BLOCK + 1], codes, lang)
        flag[begin : begin + BLOCK] = inside & _bits(table, pairs)
    return flag


def _twice(flag: np.ndarray) -> Iterator[np.ndarray]:
    """Places that are flagged like the next one, block by block."""
    for begin in range(0, len(flag) - 1, BLOCK):
        end = min(begin + BLOCK, len(flag) - 1)
        yield begin + np.flatnonzero(flag[begin:end] & flag[begin + 1 : end + 1])


def _triples(words: np.ndarray, codes: np.ndarray, lang: str, at: np.ndarray) -> np.ndarray:
    """A code of the three words from each place."""
    two = mixed(codes[words[at]]) + codes[words[at + 1]]
    return mixed(mixed(two) + codes[words[at + 2]]) ^ np.uint64(xxhash.xxh3_64_intdigest(lang, seed=2))


def _places(values: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    """The place of each value among the sorted distinct ones, block by block; ``np.unique`` holds several arrays for it."""
    at = np.zeros(len(values), np.uint32)
    for begin in range(0, len(values), BLOCK):
        at[begin : begin + BLOCK] = np.searchsorted(distinct, values[begin : begin + BLOCK])
    return at


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    both = a.astype(np.uint64)
    both <<= np.uint64(32)
    both |= b
    return both


def _parted(both: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (both >> np.uint64(32)).astype(np.uint32), both.astype(np.uint32)


COUNTS = "lang string, phrase string, n bigint"
_COUNTS = pa.schema({"lang": pa.string(), "phrase": pa.string(), "n": pa.int64()})


def count(texts: DataFrame, pairs: np.ndarray, triples: np.ndarray, octets: int) -> DataFrame:
    """Occurrences in every shard of its words and of the candidates of two and of three words.

    The empty phrase counts all words.
    """
    shared = [texts.sparkSession.sparkContext.broadcast(table) for table in (pairs, triples)]  # of fixed size

    def of_shard(numbers: _Numbers, held: dict[str, _Shard]) -> Iterator[pa.RecordBatch]:
        table, table_of_three = (x.value for x in shared)
        codes, spelled = _codes(numbers), pa.array((w.decode("utf-8", "replace") for w in numbers), pa.string())

        def rows(lang: str, n: np.ndarray, *words: np.ndarray) -> Iterator[pa.RecordBatch]:
            for part in _slices(len(n)):
                phrase = pc.binary_join_element_wise(*(spelled.take(pa.array(w[part])) for w in words), " ")
                yield pa.record_batch([pa.repeat(lang, len(phrase)), phrase, pa.array(n[part], pa.int64())], _COUNTS)

        for lang, shard in held.items():
            words = shard.numbers()
            n = np.bincount(words, minlength=1)
            used = np.flatnonzero(n[1:]) + 1
            yield pa.record_batch([[lang], [""], [int(n[1:].sum())]], _COUNTS)
            yield from rows(lang, n[used], used)
            del n, used
            if len(words) < 2:
                continue
            flag = _flagged(words, codes, lang, table)
            two, n = _tally(_joined(words[:-1][flag], words[1:][flag]))
            first, second = _parted(two)
            yield from rows(lang, n, first, second)

            def threes() -> Iterator[np.ndarray]:
                for at in _twice(flag):
                    at = at[_bits(table_of_three, _triples(words, codes, lang, at))]
                    yield _joined(_places(_joined(words[at], words[at + 1]), two), words[at + 2])

            three, n = _tally(np.concatenate([np.zeros(0, np.uint64), *threes()]))
            pair, third = _parted(three)
            yield from rows(lang, n, first[pair], second[pair], third)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for numbers, held in _shards(batches, octets):
            yield from of_shard(numbers, held)
            del numbers, held

    return texts.mapInArrow(counted, COUNTS)


def phrase_counts(
    docs: DataFrame, support: int = SUPPORT, text_col: str = "text", lang_col: str = "lang", octets: int = SHARD_OCTETS, bits: int = TABLE_BITS
) -> DataFrame:
    """lang, phrase, f: exact occurrences of every word and of every phrase of 2 or 3 words with at least ``support`` of them.

    The empty phrase has the number of words of the language, whatever it is.
    """
    rows = narrow(docs, lang=lang_col, text=text_col).select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")
    )
    sizes = rows.groupBy("lang").agg(F.sum(F.octet_length("text").cast("bigint")).alias("all_octets"))
    texts = rows.join(materialize(sizes, "phrase-languages"), "lang").select("lang", "all_octets", "text")
    with arrow_octets(docs.sparkSession, ARROW_OCTETS):
        pairs = bit_table(candidates(materialize(mine(texts, support, octets), "phrase-mined"), support), bits)
        triples = bit_table(candidates(materialize(mine(texts, support, octets, pairs), "phrase-mined"), support), bits)
        # dealt out before they are added up: a shard has a phrase once, so the tasks that count would only hold tables of them
        dealt = count(texts, pairs, triples, octets).repartition("lang", "phrase")
        counts = dealt.groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
        return materialize(counts.where((F.col("f") >= support) | (F.col("phrase") == "")), "phrase-counts")


def _number_of_words() -> Column:
    return F.length("phrase") - F.length(F.translate("phrase", " ", "")) + 1


def collocations(
    docs: DataFrame,
    support: int = SUPPORT,
    top: int = TOP,
    inside: int = INSIDE,
    text_col: str = "text",
    lang_col: str = "lang",
    octets: int = SHARD_OCTETS,
    bits: int = TABLE_BITS,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the ``top`` phrases of each language.

    A phrase of 2 or 3 words with ``a`` occurrences is cut in two; with ``l`` and ``r`` occurrences of its parts the cut scores
    floor(1000000 a a / (l r)). The lowest cut counts (ties: the shorter first part). A phrase goes if a longer one with
    at least ``inside`` percent of its occurrences holds it. Order: score and a descending, phrase in byte order. ``n``
    counts the words of the language. A null language is ``und``; null and empty texts have no words; repeated
    rows count each time; other columns are ignored; an empty table gives no rows. A text is held whole by a task.
    """
    counts = phrase_counts(docs, support, text_col, lang_col, octets, bits)
    kept = counts.where(_number_of_words() > 1).select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))

    def cut(k: int, first, second):
        return [F.struct(F.lit(k).alias("cut"), F.lit(side).alias("side"), part.alias("part")) for side, part in (("l", first), ("r", second))]

    one, two, three = (F.get("w", F.lit(i)) for i in range(3))
    cuts_of_three = [*cut(1, one, F.concat_ws(" ", two, three)), *cut(2, F.concat_ws(" ", one, two), three)]
    parts = kept.select("lang", "phrase", "a", F.explode(F.when(F.size("w") == 2, F.array(*cut(1, one, two))).otherwise(F.array(*cuts_of_three))).alias("p"))
    counted = parts.select("lang", "phrase", "a", "p.*").join(counts.withColumnRenamed("phrase", "part"), ["lang", "part"])
    of = lambda k, side: F.max(F.when((F.col("cut") == k) & (F.col("side") == side), F.col("f"))).alias(f"{side}{k}")
    sums = counted.groupBy("lang", "phrase", "a").agg(of(1, "l"), of(1, "r"), of(2, "l"), of(2, "r"))
    wide = "cast({} as decimal(38,0))".format
    score = lambda k: F.expr(f"1000000 * {wide('a')} * {wide('a')} div ({wide(f'l{k}')} * {wide(f'r{k}')})")
    second = F.col("s2").isNotNull() & (F.col("s2") < F.col("s1"))
    pick = lambda a, b: F.when(second, F.col(b)).otherwise(F.col(a))
    scored = sums.withColumns({"s1": score(1), "s2": score(2)}).select(
        "lang", "phrase", "a", pick("l1", "l2").alias("l"), pick("r1", "r2").alias("r"), pick("s1", "s2").cast("bigint").alias("score")
    )

    held = kept.where(F.size("w") == 3).select(
        "lang", F.explode(F.array(F.concat_ws(" ", one, two), F.concat_ws(" ", two, three))).alias("phrase"), F.col("a").alias("longer")
    )
    held = held.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    scored = scored.join(held, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a"))).drop("longer")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of every part of a language first, so that no language is sorted as a whole
    within = F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))
    best = scored.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn("_rank", within).where(F.col("_rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)
    totals = counts.where("phrase = ''").select("lang", F.col("f").alias("n"))
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

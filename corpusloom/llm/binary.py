"""Token ids as Re-Pair grammars: frequent pairs of ids become nonterminals, shard by shard.

A shard is a run of whole documents in ascending id order. Its payload holds the rules, the length that every rule
expands to, and the shortened sequence, in which no rule spans two documents: any document, or any stretch of one,
is decoded from its own symbols alone. Files are written by Spark's own committer, so lost tasks leave nothing behind.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from corpusloom.llm.common import Memo, narrow
from corpusloom.session import scratch_path

#: Ids of a shard (whole documents, so the last may exceed it); grammar rounds; rules made in a round; least uses.
SHARD_IDS, ROUNDS, RULES, LEAST_USES = 1 << 20, 3, 1536, 8
#: Stands for the end of a document inside a payload; tokenizers with ids up to here do not fit the 16-bit symbols.
END = 60_000
_MAGIC, _HEAD = b"RPG1", struct.Struct("<4sIIIII")

SCHEMA = "part int, shard int, n_docs bigint, n_ids bigint, payload binary"


def grammar(sequence: np.ndarray, rounds: int = ROUNDS, rules: int = RULES, least: int = LEAST_USES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shortened sequence, left, right): rule k stands for symbol END + 1 + k.

    A round counts all pairs, takes the most frequent ones (ties: the smaller pair) and replaces their occurrences;
    where two overlap, the more frequent pair wins, then the one further left. Pairs with END are never replaced.
    """
    left, right, next_symbol = [], [], END + 1
    slots = np.full(1 << 20, -1, np.int16)
    for _ in range(rounds):
        room = min(rules, 65_535 - next_symbol)
        if len(sequence) < 2 or room <= 0:
            break
        pairs = (sequence[:-1].astype(np.uint32) << np.uint32(16)) | sequence[1:]
        ordered = np.sort(pairs)
        starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        uses = np.diff(np.append(starts, len(ordered)))
        often = np.flatnonzero(uses >= least)
        values, uses = ordered[starts[often]], uses[often]
        inner = ((values >> np.uint32(16)) != END) & ((values & np.uint32(0xFFFF)) != END)
        values, uses = values[inner], uses[inner]
        # candidates by a hash table; of those that share a slot the most frequent stays, the rest may come in again
        chosen = values[np.argsort(-uses, kind="stable")[:room]]
        at_slot = _slot(chosen)
        slots[at_slot[::-1]] = np.arange(len(chosen), dtype=np.int16)[::-1]
        rank_all = slots[_slot(pairs)]
        slots[at_slot] = -1
        at = np.flatnonzero(rank_all >= 0)
        rank = rank_all[at].astype(np.int64)
        real = chosen[rank] == pairs[at]
        at, rank = at[real], rank[real]
        if not len(at):
            break
        near = np.diff(at) == 1
        wins = np.ones(len(at), bool)
        wins[1:] &= ~near | (rank[1:] < rank[:-1])
        wins[:-1] &= ~near | (rank[:-1] <= rank[1:])
        at, rank = at[wins], rank[wins]
        used = np.bincount(rank, minlength=len(chosen))
        alive = np.flatnonzero(used >= 2)
        numbers = np.full(len(chosen), -1)
        numbers[alive] = np.arange(len(alive))
        at, rank = at[used[rank] >= 2], rank[used[rank] >= 2]
        made = chosen[alive]
        left += (made >> np.uint32(16)).tolist()
        right += (made & np.uint32(0xFFFF)).tolist()
        sequence = sequence.copy()
        sequence[at] = (next_symbol + numbers[rank]).astype(np.uint16)
        keep = np.ones(len(sequence), bool)
        keep[at + 1] = False
        sequence = sequence[keep]
        next_symbol += len(alive)
    return sequence, np.array(left, np.uint16), np.array(right, np.uint16)


def _slot(pairs: np.ndarray) -> np.ndarray:
    return (pairs * np.uint32(0x9E3779B1)) >> np.uint32(12)


def _lengths(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Ids that every rule expands to; rules only use earlier ones."""
    out = np.ones(len(left), np.uint32)
    for k, (a, b) in enumerate(zip(left.tolist(), right.tolist())):
        out[k] = (out[a - END - 1] if a > END else 1) + (out[b - END - 1] if b > END else 1)
    return out


def pack(doc_ids: np.ndarray, ids: list[bytes]) -> bytes:
    """The payload of one shard; ``ids`` holds the 16-bit ids of each document, without the end."""
    end = np.array([END], "<u2").tobytes()
    sequence = np.frombuffer(end.join([*ids, b""]), "<u2")
    short, left, right = grammar(sequence)
    lengths = _lengths(left, right)
    head = _HEAD.pack(_MAGIC, len(ids), len(sequence), len(left), len(short), 0)
    return b"".join(
        [head, doc_ids.astype("<i8").tobytes(), left.astype("<u2").tobytes(), right.astype("<u2").tobytes(), lengths.astype("<u4").tobytes(), short.astype("<u2").tobytes()]
    )


class Shard:
    """A payload opened for reading: documents in order, decoded whole or in part."""

    def __init__(self, payload: bytes):
        magic, self.n_docs, self.n_ids, rules, symbols, _ = _HEAD.unpack_from(payload)
        if magic != _MAGIC:
            raise ValueError("not a grammar shard")
        at = _HEAD.size
        parts = []
        for kind, n in (("<i8", self.n_docs), ("<u2", rules), ("<u2", rules), ("<u4", rules), ("<u2", symbols)):
            parts.append(np.frombuffer(payload, kind, n, at))
            at += n * np.dtype(kind).itemsize
        self.doc_ids, left, right, lengths, self.symbols = parts
        ends = np.flatnonzero(self.symbols == END)
        self.begins = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
        self.ends = ends
        # expansions of all symbols laid end to end, so that decoding is one gather
        self.length = np.ones(END + 1 + rules, np.int64)
        self.length[END + 1 :] = lengths
        self.place = np.arange(END + 1 + rules)
        self.place[END + 1 :] = END + 1 + np.cumsum(lengths, dtype=np.int64) - lengths
        self.flat = np.arange(END + 1 + int(lengths.sum()), dtype=np.uint32)
        self.flat[END] = 0
        for k, (a, b) in enumerate(zip(left.tolist(), right.tolist())):
            at = int(self.place[END + 1 + k])
            for s in (a, b):
                n, source = int(self.length[s]), int(self.place[s])
                self.flat[at : at + n] = self.flat[source : source + n]
                at += n

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        n = self.length[symbols]
        first = np.cumsum(n) - n
        return self.flat[np.repeat(self.place[symbols] - first, n) + np.arange(int(n.sum()))]

    def document(self, k: int) -> np.ndarray:
        """All ids of the k-th document, with the end id."""
        return self.expand(self.symbols[self.begins[k] : self.ends[k] + 1])

    def slice(self, k: int, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the k-th document; only the symbols that cover them are expanded."""
        symbols = self.symbols[self.begins[k] : self.ends[k] + 1]
        upto = np.cumsum(self.length[symbols])
        a = int(np.searchsorted(upto, start, side="right"))
        b = int(np.searchsorted(upto, stop, side="left")) + 1
        before = int(upto[a - 1]) if a else 0
        return self.expand(symbols[a:b])[start - before : stop - before]


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write for bytes: printable ones stand for themselves, others follow at 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


#: A line break or nothing, letters that Unicode has below U+0250, and the punctuation behind them.
_PLAIN = re.compile("(\n?)([A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-/:-@\\[-`{-~]*)")


class Encoder:
    """Whole-text token ids by the tokenizers library, as 16-bit bytes.

    A byte-level pre-tokenizer never joins what a single blank or line break separates, nor letters and the
    punctuation that ends a piece, so each such part has its own ids. Distinct pieces are looked up once per call; those not
    held are encoded together, and what was in use among the last ``limit`` pieces or more stays held. Texts with any other
    white space are encoded in one go.
    """

    def __init__(self, path: str, limit: int = 400_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > END:
            raise ValueError("ids do not fit")
        self.letters = _byte_letters()
        # no text holds the byte 255: where the vocabulary has it on its own only, it parts words encoded together
        self.gap = self.letters[255]
        alone = [t for t in self.tokenizer.get_vocab() if self.gap in t] == [self.gap]
        self.at_once = 64 if alone else 1
        self.line, self.tails = self._ids("\n"), Memo(self._ids)
        self.limit, self.pieces, self.older = limit, {}, {}

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def _units(self, units: list[str]) -> Iterator[bytes]:
        """Ids of words in the vocabulary's letters, each with its blank or without one; the model alone can encode these."""
        gap = self.tokenizer.token_to_id(self.gap)
        for k in range(0, len(units), self.at_once):
            some = units[k : k + self.at_once]
            ids = np.array([t.id for t in self.tokenizer.model.tokenize(self.gap.join(some))], "<u2")
            raw, cuts = ids.tobytes(), np.flatnonzero(ids == gap).tolist() if len(some) > 1 else []
            for i, j in zip([0, *(c + 1 for c in cuts)], [*cuts, len(ids)]):
                yield raw[2 * i : 2 * j]

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of pieces: of what follows a blank, with it, or of a line break and what follows that.

        Pieces that hold other white space, or nothing, are left out.
        """
        learned, units = {}, []
        plain, lines, tails = [], [], []  # lists of strings, which the garbage collector need not follow
        for piece in pieces:
            parts = _PLAIN.fullmatch(piece)
            if parts:
                line, word, tail = parts.groups()
                if word.isascii():
                    units.append(word if line else self.letters[32] + word)
                else:
                    units.append((word if line else " " + word).encode().decode("latin-1").translate(self.letters))
                plain.append(piece)
                lines.append(line)
                tails.append(tail)
            elif (rest := piece.removeprefix("\n")).split() == [rest]:
                learned[piece] = self._ids(piece if rest != piece else " " + piece)
        for piece, line, tail, ids in zip(plain, lines, tails, self._units(units)):
            if line:
                ids = self.line + ids
            learned[piece] = ids + self.tails[tail] if tail else ids
        return learned

    def _known(self, pieces: list[str]) -> list[bytes | None]:
        if len(self.pieces) >= self.limit:
            self.pieces, self.older = {}, self.pieces
        new, old = self.pieces.get, self.older.get
        known = [new(p) or old(p) for p in pieces]
        learned = self._learn([p for p, k in zip(pieces, known) if k is None])
        known = [k or learned.get(p) for p, k in zip(pieces, known)]
        self.pieces.update((p, k) for p, k in zip(pieces, known) if k)
        return known

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of every text; null counts as empty."""
        texts = pc.fill_null(texts, "")
        # every text is given a line break, whose one id is left out again; what comes before it is empty
        lined = pc.replace_substring(pc.binary_join_element_wise("\n", texts, ""), "\n", " \n")
        lists = pc.split_pattern(lined, " ")
        pieces = lists.flatten().dictionary_encode()
        begins = lists.offsets.to_numpy()
        begins = (begins - begins[0])[:-1]
        places = pieces.indices.to_numpy()
        known = self._known(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        odd = np.array([k is None for k in known], bool)[places]
        odd[begins] = False
        odd = np.logical_or.reduceat(odd, begins) if len(begins) else odd
        known = [k or b"" for k in known]
        lengths = np.fromiter(map(len, known), np.int64, len(known)) // 2
        pool, at = np.frombuffer(b"".join(known), "<u2"), np.cumsum(lengths) - lengths
        ids = [np.empty(0, "<u2"), *(_gathered(pool, at, lengths, places[k : k + _STEP]) for k in range(0, len(places), _STEP))]
        ends = np.cumsum(np.add.reduceat(lengths[places], begins)) if len(begins) else begins
        raw, starts = np.concatenate(ids).tobytes(), np.concatenate(([0], ends))[:-1]
        return [
            self._ids(texts[k].as_py()) if whole else raw[2 * i + 2 : 2 * j]
            for k, (i, j, whole) in enumerate(zip(starts.tolist(), ends.tolist(), odd.tolist()))
        ]


#: Pieces laid end to end at a time; bytes of text encoded at a time (a longer text alone).
_STEP, _CHUNK = 1 << 18, 16 << 20


def _gathered(pool: np.ndarray, at: np.ndarray, lengths: np.ndarray, places: np.ndarray) -> np.ndarray:
    n = lengths[places]
    first = np.cumsum(n) - n
    return pool[np.repeat(at[places] - first, n) + np.arange(int(n.sum()))]


def chunks(batch: pa.RecordBatch, text_col: str, size: int = _CHUNK) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``size`` bytes of text."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = np.flatnonzero(np.diff(upto // size, prepend=0)).tolist()
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
        if a < b:
            yield batch.slice(a, b - a)


@cache
def encoder_of(path: str) -> Encoder:
    """One encoder per Python worker: what a task has learned serves the next."""
    return Encoder(path)


def write_shards(docs: DataFrame, tokenizer_path: str, path: str, id_col: str = "doc_id", text_col: str = "text", shard_ids: int = SHARD_IDS) -> None:
    """Encode every text and write the shards to ``path`` in ascending order of id (nulls first).

    Rows are dealt by ranges of id; rows of one id, however many, may spread over several ranges and keep one order.
    A task holds one shard at a time, and encodes about 16 MB of text, or one longer text, at a time.
    """

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, shard = encoder_of(tokenizer_path), TaskContext.get().partitionId(), 0
        kinds = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("payload", pa.binary())])
        keys: list[int] = []
        ids: list[bytes] = []
        size = 0

        def ready() -> pa.RecordBatch:
            payload = pack(np.array(keys, np.int64), ids)
            row = {"part": part, "shard": shard, "n_docs": len(ids), "n_ids": size, "payload": payload}
            return pa.RecordBatch.from_pylist([row], kinds)

        for chunk in (c for batch in batches for c in chunks(batch, "text")):
            for key, encoded in zip(chunk.column("doc_id").to_pylist(), encoder.encode(chunk.column("text"))):
                keys.append(key)
                ids.append(encoded)
                size += len(encoded) // 2 + 1
                if size >= shard_ids:
                    yield ready()
                    keys, ids, size, shard = [], [], 0, shard + 1
        if ids:
            yield ready()

    rows = narrow(docs, doc_id=id_col, text=text_col).select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID).cast("bigint")).alias("doc_id"), "text"
    )
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    placed = rows.repartitionByRange("doc_id", "_row").sortWithinPartitions("doc_id", "_row").select("doc_id", "text")
    placed.mapInArrow(shards, SCHEMA).write.option("compression", "zstd").parquet(path)


#: Stands for a null id in the files.
NO_ID = -(2**63)


def read_documents(spark, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens (with the end id) and ids_crc32, decoded from the files.

    Shard totals are added up within each part, part totals over the parts (a row per written part): starts need no
    pass over the ids.
    """
    files = spark.read.schema(SCHEMA).parquet(path)
    totals = files.select("part", "shard", "n_ids")
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = totals.groupBy("part").agg(F.sum("n_ids").alias("_n")).select(
        "part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_part_start")
    )
    bases = totals.withColumn("_before", F.coalesce(F.sum("n_ids").over(within), F.lit(0))).join(parts, "part")
    bases = bases.select("part", "shard", (F.col("_before") + F.col("_part_start")).alias("_base"))

    def decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, number, payload in zip(batch["part"], batch["shard"], batch["payload"]):
                shard = Shard(payload)
                ids = shard.expand(shard.symbols)
                n = np.add.reduceat(shard.length[shard.symbols], shard.begins) if shard.n_docs else np.zeros(0, int)
                last = np.cumsum(n)
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * (b - k) : 4 * b]) for b, k in zip(last.tolist(), n.tolist())]
                yield pd.DataFrame(
                    {"part": part, "shard": number, "doc_id": shard.doc_ids, "_at": last - n, "n_tokens": n, "ids_crc32": crc}
                )

    rows = files.select("part", "shard", "payload").mapInPandas(
        decoded, "part int, shard int, doc_id bigint, _at bigint, n_tokens bigint, ids_crc32 bigint"
    )
    return rows.join(bases, ["part", "shard"]).select(
        F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"),
        (F.col("_base") + F.col("_at")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


def encode_documents(docs: DataFrame, tokenizer_path: str, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all texts as grammar shards (by default to the shared scratch folder) and read every document back.

    A null text counts as empty and has the end id alone; null ids come first; rows of equal ids follow each other; other
    columns are ignored; an empty table gives no rows. The end of a document is id 0.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-shards")
    write_shards(docs, tokenizer_path, path, id_col, text_col)
    return read_documents(spark, path)

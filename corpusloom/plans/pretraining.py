"""Pre-training corpus: documents to packed, shuffled, split and staged token rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusloom.operators.ordering import Order, cap_rows, shuffle_order, tail_split
from corpusloom.operators.packing import (
    PACKED_KEYS,
    at_lengths,
    curriculum_stages,
    length_membership,
    pack,
    packed_order,
    repack,
    repack_stages,
)
from corpusloom.operators.tokenizer import WordPiece, encode_pretraining, pretraining_lengths
from corpusloom.plans.settings import BuildSettings
from corpusloom.session import materialize
from corpusloom.sources.manifest import build_manifest

COLUMNS = ("role", "part", "seq_len", "row_key", "input_ids")


def build_pretraining(docs: DataFrame, tokenizer: WordPiece, settings: BuildSettings, tokens: bool = True) -> DataFrame:
    """All splits as one table: ``role, part, seq_len, row_key, input_ids``.

    ``row_key`` orders the rows of a part. Encoded documents and packed rows are written once to the shared scratch
    folder, because several later passes read a column or two of them. Without ``tokens`` the same rows come without
    ``input_ids``: which rows there are follows from the documents' lengths, so no token is written or moved.
    """
    if settings.strategy == "not_packed":
        return _whole_documents(docs, tokenizer, settings, tokens)
    encode = encode_pretraining if tokens else pretraining_lengths
    return _packed(materialize(encode(docs, tokenizer), "encoded"), tokenizer.ids["[SEP]"], settings)


def _packed(encoded: DataFrame, separator: int, s: BuildSettings) -> DataFrame:
    if s.strategy == "sorted":
        source = Order.longest_first("n", "doc_id", s.id_bits)
    else:
        source = Order.of_id("doc_id", s.id_bits)
    packed = materialize(pack(encoded, source, s.max_seq_length, separator, group_rows=s.group_rows), "packed")
    if s.strategy == "sorted":
        order, keys = packed_order(), list(PACKED_KEYS)
    else:
        packed = shuffle_order(packed, PACKED_KEYS, s.seed)
        keys = ["shuffle_key", *PACKED_KEYS]
        order = Order.of_hash(*keys)
    train, dev = tail_split(packed, order, keys, s.dev_rows)
    if len(s.training) > 1:
        staged = curriculum_stages(train, order, keys, s.splits, s.training, s.max_seq_length)
        cut, same = repack_stages(staged, order, s.max_seq_length, s.group_rows)
        train = _named(cut, F.col("stage")).unionByName(_numbered(same, order, F.col("stage")))
        last = F.col("part") == len(s.training) - 1
        capped = _cap(train.where(last), s.max_train_rows)
        train = train.where(~last).unionByName(capped) if capped is not None else train
    else:
        if s.training[0] != s.max_seq_length:
            train = repack(train, order, s.training[0], s.group_rows)
            train = _named(train.withColumn("seq_len", F.lit(s.training[0])), F.lit(0))
        else:
            train = _numbered(train.withColumn("seq_len", F.lit(s.training[0])), order, F.lit(0))
        train = _cap(train, s.max_train_rows) or train
    return _tagged(train, "train").unionByName(_tagged(_dev(dev, order, s), "dev"))


def _dev(dev: DataFrame, order: Order, s: BuildSettings) -> DataFrame:
    """The dev rows at every validation length; at the packed length the rows stay as they are."""
    part = F.array_position(F.array(*[F.lit(n) for n in s.validation]), F.col("seq_len")) - 1
    others = [n for n in s.validation if n != s.max_seq_length]
    sides = []
    if others:
        sides.append(_named(at_lengths(dev, order, others, s.group_rows), part))
    if len(others) < len(s.validation):
        sides.append(_numbered(dev.withColumn("seq_len", F.lit(s.max_seq_length)), order, part))
    return sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])


def _whole_documents(docs: DataFrame, tokenizer: WordPiece, s: BuildSettings, tokens: bool) -> DataFrame:
    """Documents of exactly the wanted lengths train; the last of the others are dev, re-packed to each length.

    Most documents are neither: all are counted, and the ids of those that are taken alone are put together. The dev
    documents, ``dev_rows`` ids, are known after all are counted, and encoded then.
    """
    lengths = materialize(pretraining_lengths(docs, tokenizer, s.training if tokens else ()), "encoded")
    train, rest = length_membership(lengths, s.training)
    order = Order.of_id("doc_id", s.id_bits)
    _, dev = tail_split(rest, order, ["doc_id"], s.dev_rows)
    if tokens:
        # at most dev_rows ids; written before lengths are looked at, or that filter would be worked out ahead of the join
        again = encode_pretraining(docs.join(F.broadcast(dev.select("doc_id")), "doc_id", "left_semi"), tokenizer)
        dev = length_membership(materialize(again, "dev"), s.training)[1]  # another document of an id may have a wanted length
    part = F.array_position(F.array(*[F.lit(n) for n in s.training]), F.col("seq_len")) - 1
    train = _with_key(train, part, F.array(F.col("doc_id")))
    return _tagged(train, "train").unionByName(_tagged(_dev(dev, order, s), "dev"))


def _with_key(rows: DataFrame, part, key) -> DataFrame:
    return rows.select(part.cast("int").alias("part"), "seq_len", key.alias("row_key"), *[c for c in ("input_ids",) if c in rows.columns])


def _named(rows: DataFrame, part) -> DataFrame:
    return _with_key(rows, part, F.array(F.col("grp"), F.col("chunk")))


def _numbered(rows: DataFrame, order: Order, part) -> DataFrame:
    return _with_key(rows, part, F.array(*[c.cast("bigint") for c in order.by]))


def _cap(rows: DataFrame, max_rows: int | None) -> DataFrame | None:
    if max_rows in (None, 0, -1):
        return None
    keyed = rows.withColumns({"_hi": F.get("row_key", F.lit(0)), "_lo": F.get("row_key", F.lit(1))})
    order = Order((F.col("row_key"),), (F.shiftright("_hi", 12), F.col("_hi"), F.shiftright("_lo", 8)))
    return cap_rows(keyed, order, ["row_key"], max_rows).drop("_hi", "_lo")


def _tagged(rows: DataFrame, role: str) -> DataFrame:
    return rows.withColumn("role", F.lit(role)).select(*[c for c in COLUMNS if c == "role" or c in rows.columns])


def pretraining_manifest(splits: DataFrame) -> DataFrame:
    return build_manifest(splits)

"""Fine-tuning sets: labelled or question-answering rows to encoded train and dev rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusloom.operators.ordering import Order, cap_rows, head, shuffle_order, tail_split
from corpusloom.operators.qa import context_windows, encode_examples, span_labels
from corpusloom.operators.tokenizer import WordPiece, encode_classification
from corpusloom.plans.settings import BuildSettings
from corpusloom.session import materialize


def encode_for_task(rows: DataFrame, tokenizer: WordPiece, task: str, settings: BuildSettings) -> DataFrame:
    limit = settings.max_seq_length if settings.truncate else None
    if task == "sequence-classification":
        return encode_classification(rows, tokenizer, limit)
    if task == "question-answering":
        examples = rows
        if "answers" in rows.columns:
            examples = rows.withColumns(
                {
                    "answer_text": F.get(F.col("answers")["text"], F.lit(0)),
                    "answer_start": F.get(F.col("answers")["answer_start"], F.lit(0)),
                }
            )
        return span_labels(context_windows(encode_examples(examples, tokenizer), limit, sep=tokenizer.ids["[SEP]"]))
    raise ValueError(f"unknown task: {task}")


def build_finetuning(
    train: DataFrame,
    dev: DataFrame | None,
    tokenizer: WordPiece,
    task: str,
    settings: BuildSettings,
    keys: tuple[str, ...] = ("doc_id",),
) -> tuple[DataFrame, DataFrame]:
    """Encode, shuffle, split off dev (or take the head of the one provided; -1 takes it all), cap train."""
    encoded = materialize(encode_for_task(train, tokenizer, task, settings), "finetune")
    mixed = shuffle_order(encoded, keys, settings.seed)
    names = ["shuffle_key", *keys]
    order = Order.of_hash(*names)
    if dev is None:
        train_rows, dev_rows = tail_split(mixed, order, names, settings.dev_rows)
    else:
        train_rows, dev_rows = mixed, materialize(encode_for_task(dev, tokenizer, task, settings), "finetune-dev")
        if settings.dev_rows != -1:
            by_key = Order(tuple(F.col(k) for k in keys), Order.of_id(keys[0], bits=64).levels)
            dev_rows = head(dev_rows, by_key, list(keys), lambda n: settings.dev_rows)
        dev_rows = dev_rows.withColumn("shuffle_key", F.lit(None).cast("bigint"))  # a given dev set keeps its order
    return cap_rows(train_rows, order, names, settings.max_train_rows), dev_rows

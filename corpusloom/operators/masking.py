"""Masked-token training rows."""

from __future__ import annotations

import math
from collections.abc import Sequence
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# The label of positions that do not count, and the split of selected tokens.
IGNORE = -100
MASK_SHARE = 0.8
RANDOM_SHARE = 0.1



def mask_tokens(
    rows: DataFrame,
    probability: Column | float,
    key: Sequence[str],
    vocabulary_size: int,
    mask_id: int,
    specials: Sequence[int],
    seed: int = 42,
    epoch: int = 0,
    ids: str = "input_ids",
) -> DataFrame:
    """Replace ``input_ids`` by their masked form and add ``labels``.

    Each non-special token is selected with the given probability (a number or a column, such as the stage's);
    of the selected, 80 % become the mask piece, 10 % a random piece and 10 % stay. All draws come from one digest
    of (row key, position, epoch, seed), so a retried task masks the same tokens and another epoch masks others.
    """
    p = F.lit(float(probability)) if isinstance(probability, (int, float)) else probability
    row = F.concat_ws("|", *[F.col(k).cast("string") for k in key])
    # a draw is below a share of 2^32; a null share selects nothing
    limit = F.coalesce(F.ceil(p * float(2**32)).cast("bigint"), F.lit(0).cast("bigint"))
    masks, randoms = (math.ceil(share * 2**32) for share in (MASK_SHARE, MASK_SHARE + RANDOM_SHARE))
    kind = "array<bigint>" if dict(rows.dtypes)[ids] == "array<bigint>" else "array<int>"
    tail = f"|{epoch}|{seed}"

    def draw(keys: pa.Array, limits: pa.Array, tokens: pa.Array) -> pa.Array:
        sizes = tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        tails = [f"|{i}{tail}".encode() for i in range(sizes.max(initial=0))]
        digests = b"".join(
            md5(k + t, usedforsecurity=False).digest() for k, n in zip(keys.cast(pa.binary()).to_pylist(), sizes) for t in tails[:n]
        )
        draws = np.frombuffer(digests, ">u4").reshape(-1, 4).astype(np.int64)
        flat = tokens.flatten()
        empty = flat.is_null().to_numpy(zero_copy_only=False)
        old = flat.fill_null(0).to_numpy(zero_copy_only=False)
        selected = (draws[:, 0] < np.repeat(limits.to_numpy(zero_copy_only=False), sizes)) & ~np.isin(old, specials) & ~empty
        masked = np.where(draws[:, 1] < masks, mask_id, np.where(draws[:, 1] < randoms, draws[:, 2] % vocabulary_size, old))
        ends = pa.array(np.r_[0, np.cumsum(sizes)], pa.int32())
        new = pa.array(np.where(selected, masked, old), flat.type, mask=empty)
        labels = pa.array(np.where(selected, old, IGNORE), flat.type)
        sides = [pa.ListArray.from_arrays(ends, side, mask=tokens.is_null()) for side in (new, labels)]
        return pa.StructArray.from_arrays(sides, ["ids", "labels"])

    drawn = F.arrow_udf(draw, f"ids {kind}, labels {kind}")(row, limit, F.col(ids).cast(kind))
    return rows.withColumn("_drawn", drawn).withColumns({ids: F.col("_drawn.ids"), "labels": F.col("_drawn.labels")}).drop("_drawn")


def masked_count(labels: Column) -> Column:
    """Number of positions that count."""
    return F.size(F.filter(labels, lambda x: x != IGNORE))


def stage_parameters(
    stages: DataFrame, probabilities: Sequence[float], micro_batches: Sequence[int], lengths: Sequence[int], stage: str = "stage"
) -> DataFrame:
    """Add the stage's ``mlm_p``, ``micro_batch`` and ``seq_len``; stages past the last keep the last one's."""
    if not len(probabilities) == len(micro_batches) == len(lengths):
        raise ValueError("one probability, micro-batch and length per training file is needed")
    at = F.least(F.col(stage), F.lit(len(lengths) - 1)).cast("int")

    def pick(values: Sequence) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), at)

    return stages.withColumns(
        {"mlm_p": pick([float(p) for p in probabilities]), "micro_batch": pick(micro_batches), "seq_len": pick(lengths)}
    )

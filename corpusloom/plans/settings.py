"""Settings of a corpus build; ``id_bits`` is the size of the largest document id (see ``Order.of_id``)."""

from __future__ import annotations

from dataclasses import dataclass

from corpusloom.functions.scalars import equal_shares
from corpusloom.operators.ordering import ID_BITS
from corpusloom.operators.packing import GROUP_ROWS

STRATEGIES = ("naive", "sorted", "not_packed")


def numbers(text: str | None, kind: type, default: list) -> list:
    """A comma-separated list, or the default when none is given."""
    return [kind(x) for x in text.split(",")] if text else default


@dataclass(frozen=True)
class BuildSettings:
    max_seq_length: int = 512
    train_lengths: str | None = None
    dev_lengths: str | None = None
    size_splits: str | None = None
    dev_rows: int = 2_500
    max_train_rows: int | None = None
    percent: float = 100.0
    discard: float | None = None
    strategy: str = "naive"
    truncate: bool = True
    seed: int = 42
    group_rows: int = GROUP_ROWS
    id_bits: int = ID_BITS

    def __post_init__(self):
        if self.strategy not in STRATEGIES:
            raise ValueError(f"unknown strategy: {self.strategy}")
        if not 0 < self.percent <= 100:
            raise ValueError("percent lies above 0 and up to 100")
        if len(self.splits) != len(self.training):
            raise ValueError("one size split per training length is needed")
        if abs(sum(self.splits) - 1) > 1e-9:
            raise ValueError("the size splits must sum to 1")

    @property
    def training(self) -> list[int]:
        return numbers(self.train_lengths, int, [self.max_seq_length])

    @property
    def validation(self) -> list[int]:
        return numbers(self.dev_lengths, int, [self.max_seq_length])

    @property
    def splits(self) -> list[float]:
        return numbers(self.size_splits, float, equal_shares(len(self.training)))

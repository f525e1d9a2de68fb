"""Benchmark decontamination by greedy string tiling with running Karp-Rabin matching.

Seeds (runs of ``least`` words) shared with a benchmark item lead to the item; tiling then marks the longest
non-overlapping matches again and again, so a passage counts even if its parts stand in another order. Coverage is the
share of the item's words under tiles.

The benchmark is the query set: it is read in blocks of bounded size and every block meets all texts. Rows are written
between blocks, so no plan, worker or driver holds more than one block, whatever the size of either table. A row never
leaves its task.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.common import codes, mixed, narrow, windows, word_memo
from corpusloom.session import materialize

#: Words of a seed and of the shortest tile; share of an item that must be covered; bytes of benchmark text per block.
LEAST, COVERAGE, BLOCK_BYTES = 5, 0.5, 4_000_000

_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Words without case and punctuation: runs of ASCII letters and digits and of characters beyond ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


def tiles(item: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two sequences of word codes: (item start, text start, length), longest first.

    Each round hashes all unmarked runs of the search length, extends equal ones as far as they go, and marks the
    longest that do not overlap, earliest first. A round that finds a much longer match searches on from that length;
    otherwise the length halves down to ``least``.
    """
    marked_item, marked_text = np.zeros(len(item), bool), np.zeros(len(text), bool)
    found: list[tuple[int, int, int]] = []
    length = max(least, min(len(item), len(text)) // 2)
    while min(len(item), len(text)) >= least:
        matches = _longest(item, text, marked_item, marked_text, length)
        most = max((n for _, _, n in matches), default=0)
        if most > 2 * length:
            length = most
            continue
        for a, b, n in sorted(matches, key=lambda m: (-m[2], m[0], m[1])):
            if not marked_item[a : a + n].any() and not marked_text[b : b + n].any():
                marked_item[a : a + n] = marked_text[b : b + n] = True
                found.append((a, b, n))
            elif n > length:
                break  # what is left of a long match may be longer than the next one: search this length again
        else:
            if length == least:
                break
            length = max(least, length // 2)
    return found


def _longest(item: np.ndarray, text: np.ndarray, in_item: np.ndarray, in_text: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """Maximal matches of at least ``length`` unmarked words that start with an unmarked run of that length."""
    if min(len(item), len(text)) < length:
        return []
    free_item = np.flatnonzero(np.convolve(in_item, np.ones(length, int), "valid") == 0)
    free_text = np.flatnonzero(np.convolve(in_text, np.ones(length, int), "valid") == 0)
    if not len(free_item) or not len(free_text):
        return []
    at = defaultdict(list)
    hashes = windows(item, length)
    for a in free_item:
        at[hashes[a]].append(int(a))
    hashes = windows(text, length)
    free_text = free_text[np.isin(hashes[free_text], np.fromiter(at, np.uint64, len(at)))]
    out = []
    for b in map(int, free_text):
        for a in at[hashes[b]]:
            if a and b and item[a - 1] == text[b - 1] and not in_item[a - 1] and not in_text[b - 1]:
                continue  # part of the match that starts earlier
            n = 0
            while (
                a + n < len(item) and b + n < len(text) and item[a + n] == text[b + n] and not in_item[a + n] and not in_text[b + n]
            ):
                n += 1
            if n >= length:
                out.append((a, b, n))
    return out


@dataclass
class Block:
    """Items of the benchmark with an index of their seeds. Items shorter than a seed are one seed as a whole."""

    ids: list[int]
    items: list[np.ndarray]
    least: int
    seeds: np.ndarray = field(init=False)
    owners: dict = field(init=False)

    def __post_init__(self) -> None:
        owners = defaultdict(set)
        for k, item in enumerate(self.items):
            for seed in windows(item, self.least):
                owners[(min(len(item), self.least), int(seed))].add(k)
        self.owners = {key: sorted(ks) for key, ks in owners.items()}
        self.widths = sorted({n for n, _ in self.owners})
        self.seeds = np.unique(np.array([s for _, s in self.owners], np.uint64))
        bits = 22
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, bool)
        self.table[(self.seeds >> self.shift).astype(np.int64)] = True

    def matches(self, text: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(item id, covered words, item words, tiles) of every item that shares a seed with the text."""
        near: dict[int, list[np.ndarray]] = defaultdict(list)
        for width in self.widths:
            if len(text) < width:
                continue
            hashes = windows(text, width)
            maybe = np.flatnonzero(self.table[(hashes >> self.shift).astype(np.int64)])
            hits = defaultdict(list)
            for p in maybe:
                for k in self.owners.get((width, int(hashes[p])), ()):
                    hits[k].append(p)
            for k, ps in hits.items():
                near[k].append(np.add.outer(np.array(ps), np.arange(width)).ravel())
        out = []
        for k, ps in near.items():
            # only words under a shared seed can be in a tile; a gap of one stands for all that lies between
            at = np.unique(np.concatenate(ps))
            gaps = np.flatnonzero(np.diff(at) > 1) + 1
            shared = np.insert(text[at], gaps, self.gap)
            least = min(self.least, len(self.items[k]))
            found = tiles(self.items[k], shared, least)
            out.append((self.ids[k], sum(n for *_, n in found), len(self.items[k]), len(found)))
        return out

    @property
    def gap(self) -> np.uint64:
        return mixed(np.array([0x6761705F], np.uint64))[0]


def blocks(benchmark: DataFrame, id_col: str, text_col: str, least: int, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """The benchmark in blocks of about ``block_bytes`` of text, one in memory at a time; items without words are left out."""
    rows = narrow(benchmark, item_id=id_col, text=text_col).where("text is not null")
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    parts, memo = -(-total // block_bytes) if total else 0, word_memo()
    part_of = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(parts, 1)))
    for part in range(parts):
        got = sorted(rows.where(part_of == part).collect(), key=lambda r: (r.item_id is None, r.item_id or 0, r.text))
        items = [(r.item_id, codes(words_of(r.text), memo)) for r in got]
        items = [(i, w) for i, w in items if len(w)]
        if items:
            yield Block([i for i, _ in items], [w for _, w in items], least)


def coverage_of(block: Block):
    """A column function of the text: the item of the block with the highest coverage, and how many reach COVERAGE."""

    @F.pandas_udf("item_id bigint, covered bigint, item_words bigint, tiles bigint")
    def best(texts: pd.Series) -> pd.DataFrame:
        memo, out = word_memo(), []
        for text in texts:
            found = block.matches(codes(words_of(text), memo)) if text else []
            found.sort(key=lambda m: (-m[1] / m[2], m[0] is None, m[0] or 0))
            out.append(found[0] if found else (None, 0, 0, 0))
        names = ["item_id", "covered", "item_words", "tiles"]
        return pd.DataFrame(out, columns=names).astype({"item_id": "Int64"})

    return best


def with_coverage(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", least: int = LEAST, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """All rows and columns with ``_leak``: item_id, covered, item_words and tiles of the best covered item."""
    nothing = F.struct(
        F.lit(None).cast("bigint").alias("item_id"),
        *[F.lit(0).cast("bigint").alias(c) for c in ("covered", "item_words", "tiles")],
    )
    out = docs.withColumn("_leak", nothing)
    for k, block in enumerate(blocks(benchmark, "item_id", "text", least, block_bytes)):
        out = materialize(out, "leak-block") if k else out
        new = out.withColumn("_new", coverage_of(block)(F.col(f"`{text_col}`")))
        now = F.col("_new.covered") * F.greatest(F.col("_leak.item_words"), F.lit(1))
        before = F.col("_leak.covered") * F.greatest(F.col("_new.item_words"), F.lit(1))
        smaller = F.coalesce(F.col("_new.item_id") < F.col("_leak.item_id"), F.lit(False))
        better = (now > before) | ((now == before) & (F.col("_new.covered") > 0) & smaller)
        out = new.withColumn("_leak", F.when(better, F.col("_new")).otherwise(F.col("_leak"))).drop("_new")
    return out


def contaminated(least_coverage: float = COVERAGE):
    return (F.col("_leak.covered") > 0) & (F.col("_leak.covered") >= least_coverage * F.col("_leak.item_words"))


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = LEAST,
    least_coverage: float = COVERAGE,
) -> DataFrame:
    """doc_id, item_id, covered, item_words, tiles, coverage and contaminated of every row.

    item_id is the item with the highest coverage (ties: the smallest id), null if no seed is shared. Null and empty
    texts share nothing; items without words are left out; items shorter than a seed match as a whole. Repeated rows are
    judged each on its own, other columns are ignored, an empty benchmark leaves every row clean.
    """
    rows = with_coverage(narrow(docs, doc_id=id_col, text=text_col), benchmark, "text", least)
    words = F.greatest(F.col("_leak.item_words"), F.lit(1))
    return rows.select(
        "doc_id", "_leak.*", (F.col("_leak.covered") / words).alias("coverage"), contaminated(least_coverage).alias("contaminated")
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", least_coverage: float = COVERAGE) -> DataFrame:
    """The rows that are not contaminated, with all their columns."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text_col}`").alias("text"))
    return with_coverage(whole, benchmark).where(~contaminated(least_coverage)).select("_row.*")

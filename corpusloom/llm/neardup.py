"""Near-duplicate groups by circulant MinHash.

Two permutations give all signature coordinates: the first scatters the shingles over the circle of 32-bit positions,
the second, shifted by k, ranks them for coordinate k. Coordinates are banded; documents that share a band are candidates;
candidates are confirmed on their full shingle sets; confirmed links are followed to connected components.

Texts with equal sets are one class before anything is compared. In a band's bucket each class is first compared with
the smallest class only; what one component already joins needs no more comparisons, and only buckets that still hold
several components get the pairs across them. A bucket of near copies thus costs a comparison per class. Such pairs
are weighed inside the join: they must agree in about as many coordinates as similar sets do, and two bit tables of the
sets must leave room for enough common shingles, which no similar pair fails. Only the rest read the full texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.llm.common import codes, mixed, narrow, windows, word_memo
from corpusloom.session import materialize


@dataclass(frozen=True)
class Settings:
    """Words of a shingle, the similarity in percent, and the banding.

    A pair of that similarity shares no band with probability (1 - s^rows)^bands: 5e-8 for 0.8. It differs in more than
    ``most_different`` coordinates (5.5 standard deviations above the mean) with probability 2e-8.
    """

    width: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 4

    @property
    def size(self) -> int:
        return self.bands * self.rows

    @property
    def most_different(self) -> int:
        share = (1 - self.percent / 100) * (1 - 2.0**-PLANES)
        return int(self.size * share + 5.5 * (self.size * share * (1 - share)) ** 0.5) + 1


#: Bits of each coordinate that are kept for comparing signatures.
PLANES = 4

_BLANK_CASE = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingles(text: str | None, width: int, memo) -> np.ndarray:
    """Distinct shingle codes of a text, sorted; words are lower-cased (A-Z) and end at ASCII white space."""
    if not text:
        return np.zeros(0, np.uint64)
    words = text.encode("utf-8", "surrogatepass").translate(_BLANK_CASE).split()
    return np.unique(windows(codes(words, memo), width))


def _scattered(x: np.ndarray) -> np.ndarray:
    """The second permutation, of 32-bit positions; works in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def signature(shingle_set: np.ndarray, size: int) -> np.ndarray:
    """``size`` coordinates: the least rank of the set's positions, under the second permutation shifted by 0, 1, ..."""
    places = (mixed(shingle_set ^ np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)
    shifts = np.arange(size, dtype=np.uint32)[:, None]
    out = np.full(size, 0xFFFFFFFF, np.uint32)
    for begin in range(0, len(places), 1024):
        out = np.minimum(out, _scattered(places[None, begin : begin + 1024] - shifts).min(axis=1))
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band, different for different bands."""
    parts = sig.reshape(bands, rows).astype(np.uint64)
    key = np.arange(bands, dtype=np.uint64) + np.uint64(1)
    for i in range(rows):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, i])
    return key.view(np.int64)


def planes(sig: np.ndarray) -> np.ndarray:
    """The lowest bits of all coordinates, bit by bit, as 64-bit words."""
    padded = np.zeros(-(-len(sig) // 64) * 64, np.uint32)
    padded[: len(sig)] = sig
    return np.concatenate([np.packbits((padded >> np.uint32(p)) & np.uint32(1)).view(np.int64) for p in range(PLANES)])


def alike(a: Column, b: Column, settings: Settings) -> Column:
    """Whether the signatures behind two columns of ``planes`` agree as often as those of similar sets."""
    n = -(-settings.size // 64)
    different = F.lit(0)
    for w in range(n):
        bits = F.lit(0).cast("bigint")
        for p in range(PLANES):
            bits = bits.bitwiseOR(F.get(a, F.lit(p * n + w)).bitwiseXOR(F.get(b, F.lit(p * n + w))))
        different = different + F.bit_count(bits)
    return different <= settings.most_different


def sketches(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, n_shingles, set_key (128 bits of the whole set, null for an empty one), keys of all bands, and planes."""

    def sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = word_memo()
        for batch in batches:
            n, keys, bands, bits = [], [], [], []
            for text in batch["text"]:
                found = shingles(text, settings.width, memo)
                n.append(len(found))
                keys.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                sig = signature(found, settings.size) if len(found) else None
                bands.append(band_keys(sig, settings.bands, settings.rows) if len(found) else np.zeros(0, np.int64))
                bits.append(planes(sig) if len(found) else np.zeros(0, np.int64))
            whose = {"doc_id": batch["doc_id"], "named": batch["named"]}
            yield pd.DataFrame(whose | {"n_shingles": n, "set_key": keys, "bands": bands, "planes": bits})

    # a null among the ids of a batch would turn all of them into floats
    given = docs.select(F.coalesce("doc_id", F.lit(0).cast("bigint")).alias("doc_id"), F.col("doc_id").isNotNull().alias("named"), "text")
    kinds = "doc_id bigint, named boolean, n_shingles bigint, set_key binary, bands array<bigint>, planes array<bigint>"
    found = given.mapInPandas(sketched, kinds)
    return found.withColumn("doc_id", F.when(F.col("named"), F.col("doc_id"))).drop("named")


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets (sorted, distinct) have ``percent`` of their union in common."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def bit_table(shingle_set: np.ndarray) -> np.ndarray:
    """A bit for every shingle, at least eight times as many bits as shingles, as 64-bit words (a power of two, 32 or more)."""
    words = max(WORDS, 1 << max(0, int(len(shingle_set) * 8 - 1).bit_length() - 6))
    bits = np.zeros(64 * words, np.uint8)
    bits[(shingle_set % np.uint64(64 * words)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


#: Words of the smallest bit table.
WORDS = 32


def room(a: Column, b: Column, n_a: Column, n_b: Column, percent: int) -> Column:
    """Whether bit tables leave room for ``percent`` of the union in common.

    A bit that only the first table has set is a shingle that only the first set has. A longer table is folded to the other's size.
    """

    def folded(x: Column, to: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(to) - 1), lambda i: F.get(x, i).bitwiseOR(F.get(x, i + F.size(to)))
        )

    def enough(x: Column, y: Column) -> Column:
        only = F.aggregate(
            F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q)))), F.lit(0), lambda t, v: t + v
        )
        return 100 * (n_a - only) >= percent * (n_b + only)

    return (
        F.when(F.size(a) == F.size(b), enough(a, b))
        .when(F.size(a) == 2 * F.size(b), enough(folded(a, b), b))
        .when(F.size(b) == 2 * F.size(a), enough(a, folded(b, a)))
        .otherwise(F.lit(True))
    )


def bit_tables(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id and the bit table of each text."""

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = word_memo()
        for batch in batches:
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "bits": [bit_table(shingles(t, settings.width, memo)) for t in batch["text"]]}
            )

    return docs.mapInPandas(made, "doc_id bigint, bits array<bigint>")


def confirmed(pairs: DataFrame, docs: DataFrame, settings: Settings, group: int = 64) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough.

    Pairs are dealt by ``b`` in groups of about ``group``; a task reads, for each, the text of ``b`` and then those of the
    others, in order, and holds one set at a time. A document with very many pairs spreads over many groups.
    """
    percent, width = settings.percent, settings.width
    size = pairs.groupBy("b").agg(F.ceil(F.count("*") / group).cast("int").alias("_groups"))
    dealt = pairs.join(size, "b").withColumn("_group", F.pmod(F.xxhash64("a"), F.col("_groups")).cast("int"))
    firsts = dealt.select("b", "_group").distinct().withColumns({"doc_id": F.col("b"), "_first": F.lit(0)})
    wanted = firsts.unionByName(dealt.select("b", "_group", F.col("a").alias("doc_id"), F.lit(1).alias("_first")))
    texts = wanted.hint("merge").join(docs, "doc_id")
    ordered = texts.repartition("b", "_group").sortWithinPartitions("b", "_group", "_first")

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo, at, bases = word_memo(), None, []
        for batch in batches:
            links = []
            for b, part, first, a, text in zip(batch["b"], batch["_group"], batch["_first"], batch["doc_id"], batch["text"]):
                own = shingles(text, width, memo)
                if first == 0:
                    bases = [*bases, own] if at == (b, part) else [own]
                    at = (b, part)
                elif at == (b, part) and any(similar(own, base, percent) for base in bases):
                    links.append((a, b))
            yield pd.DataFrame(links, columns=["a", "b"]).astype("int64")

    return ordered.select("b", "_group", "_first", "doc_id", "text").mapInPandas(compared, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) of every node with a link; links are pairs (a, b), a > b.

    Every round points each node at the least node next to it and then at that one's own choice; rounds end when no
    edge is left between different choices. Depth halves per round at least, and each round's table is written, so
    lineage stays short.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "near-links")
    nodes = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("to")).withColumnRenamed("a", "node")
        hop = least.select(F.col("node").alias("to"), F.col("to").alias("further"))
        round_of = materialize(least.join(hop, "to").select("node", F.col("further").alias("to")), "near-roots")
        if nodes is None:
            nodes = round_of
        else:
            step = round_of.select(F.col("node").alias("to"), F.col("to").alias("next"))
            nodes = materialize(nodes.join(step, "to", "left").select("node", F.coalesce("next", "to").alias("to")), "near-nodes")
        to_a = round_of.select(F.col("node").alias("a"), F.col("to").alias("ra"))
        to_b = round_of.select(F.col("node").alias("b"), F.col("to").alias("rb"))
        joined = edges.join(to_a, "a").join(to_b, "b").select("ra", "rb").where("ra <> rb")
        moved = round_of.where("node <> to").select(F.col("node").alias("ra"), F.col("to").alias("rb")).join(
            round_of.select(F.col("to").alias("ra")).distinct(), "ra", "left_semi"
        )
        edges = materialize(
            joined.union(moved).select(F.greatest("ra", "rb").alias("a"), F.least("ra", "rb").alias("b")).distinct(), "near-links"
        )
        if edges.isEmpty():
            return nodes.select("node", F.col("to").alias("component"))


def _named(sides: DataFrame, key: str, name: str) -> DataFrame:
    return sides.select(F.col("doc_id").alias(key), F.col("n_shingles").alias(f"n_{name}"), F.col("planes").alias(name))


def near_duplicates(
    docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable over links) and kept, for every row.

    Null and empty texts, and texts without words, have no shingles, are linked with nothing and are kept. Rows with a
    null id are classed by their text's set like others if it occurs under an id, and keep a null component otherwise.
    Rows of one id are one document each: they share that id. Other columns are ignored; an empty table gives no rows.
    """
    texts = narrow(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    sketch = materialize(sketches(texts, settings), "near-sketches")
    classes = materialize(
        sketch.where("set_key is not null and doc_id is not null").groupBy("set_key").agg(F.min("doc_id").alias("rep")), "near-classes"
    )
    # a class is compared through one row of its smallest id
    reps = classes.withColumnRenamed("rep", "doc_id")
    heads = sketch.join(reps, ["doc_id", "set_key"], "left_semi").dropDuplicates(["doc_id", "set_key"])
    heads = materialize(heads.drop("set_key"), "near-heads")
    sides = heads.select("doc_id", "n_shingles", "planes")
    left, right = _named(sides, "a", "la"), _named(sides, "b", "lb")
    close = (100 * F.least("n_la", "n_lb") >= settings.percent * F.greatest("n_la", "n_lb")) & alike(F.col("la"), F.col("lb"), settings)

    bands = heads.select("doc_id", F.explode("bands").alias("band"))
    centers = bands.groupBy("band").agg(F.min("doc_id").alias("b"), F.max("doc_id").alias("_most")).where("b <> _most").drop("_most")
    buckets = materialize(bands.join(centers, "band"), "near-buckets")
    suspects = materialize(texts.join(buckets.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi"), "near-suspects")
    stars = buckets.where("doc_id <> b").select(F.col("doc_id").alias("a"), "b").distinct()
    stars = materialize(stars.join(left, "a").join(right, "b").where(close).select("a", "b"), "near-stars")
    links = materialize(confirmed(stars, suspects, settings), "near-confirmed")
    joined = components(links)

    labelled = buckets.join(joined.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id")
    )
    # the largest component of every bucket; a bucket of one component is done
    sizes = labelled.groupBy("band", "component").agg(F.count("*").alias("_n"))
    largest = sizes.groupBy("band").agg(F.max_by("component", "_n").alias("largest"), F.count("*").alias("_components"))
    rest = materialize(labelled.join(largest.where("_components > 1"), "band").select("band", "doc_id", "component", "largest"), "near-open")
    tables = bit_tables(suspects.join(rest.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi"), settings)
    weighed = materialize(sides.join(tables, "doc_id"), "near-tables")
    left = rest.where("component <> largest").join(weighed, "doc_id").select(
        "band", "largest", F.col("doc_id").alias("a"), F.col("component").alias("ca"), F.col("n_shingles").alias("n_la"), F.col("planes").alias("la"), F.col("bits").alias("ta")
    )
    right = rest.join(weighed, "doc_id").select(
        "band", F.col("doc_id").alias("b"), F.col("component").alias("cb"), F.col("n_shingles").alias("n_lb"), F.col("planes").alias("lb"), F.col("bits").alias("tb")
    )
    once = (F.col("cb") == F.col("largest")) | (F.col("a") > F.col("b"))
    fits = room(F.col("ta"), F.col("tb"), F.col("n_la"), F.col("n_lb"), settings.percent)
    across = left.join(right, "band").where((F.col("ca") != F.col("cb")) & once & close & fits)
    pairs = materialize(across.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().join(stars, ["a", "b"], "left_anti"), "near-across")
    if not pairs.isEmpty():
        more = materialize(confirmed(pairs, suspects, settings), "near-confirmed")
        if not more.isEmpty():
            joined = components(links.union(more))

    roots = classes.join(joined, classes.rep == joined.node, "left").select("set_key", F.coalesce("component", "rep").alias("_root"))
    own = sketch.select("doc_id", "n_shingles", "set_key").join(roots, "set_key", "left")
    component = F.coalesce(F.col("_root"), F.col("doc_id"))
    return own.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group, that of the smallest id, with all its columns; rows without words all stay.

    Rows are compared one by one, on numbers of their own: of equal rows one stays, also of one id, and another text under
    an id that a copy carries stays too. Rows without an id come after all others. An empty table gives no rows.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = materialize(docs.select(row, F.monotonically_increasing_id().alias("_n")), "near-rows")
    groups = near_duplicates(rows.select("_n", F.col(f"_row.`{text_col}`").alias("_text")), settings, "_n", "_text")
    groups = materialize(groups.select(F.col("doc_id").alias("_n"), "component_id"), "near-groups")
    # groups of one row are their own component, so only those that another row points to have anything to give up
    shared = groups.where("_n <> component_id")
    members = shared.union(shared.select(F.col("component_id").alias("_n"), "component_id").distinct())
    id_ = F.col(f"_row.`{id_col}`")
    ids = rows.select("_n", id_.alias("_id")).join(members.hint("merge"), "_n")
    first = F.min(F.struct(F.col("_id").isNull(), "_id", "_n"))["_n"]  # combines before the shuffle: a large group is a few rows
    stays = ids.groupBy("component_id").agg(first.alias("_n")).select("_n")
    gone = members.select("_n").join(stays.hint("merge"), "_n", "left_anti")
    return rows.join(gone.hint("merge"), "_n", "left_anti").select("_row.*")

"""N-gram Jaccard join by T-occurrence search.

Two sets at the similarity share at least T = percent of the larger one's shingles, so a set's partners occur at least T times in
the inverted lists of its shingles. The lists are divided: with up to T - 1 long ones set aside, every partner is
still found in the short ones. Across the corpus the long lists (shingles of very many texts, found by exact counts
of what shards report) come last in one order of shingles for all texts, so that the short lists of a set are its first
n - T + 1 shingles. Records that share a short list are searched: in blocks of records, a query's lists over the block
are merged with a heap up to the occurrences that the long ones leave over, and what remains probes the
long lists by binary search (DivideSkip).

Texts with equal sets are one class. In a list, classes are first held against one center, in long ones then against centers
of other draws, and only lists that still hold several components get the pairs across them. These pairs are weighed inside
the join: the parity tables of two sets differ in no more places than the sets do. No list is cut short.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.llm.common import narrow, word_memo
from corpusloom.llm.neardup import components, shingles
from corpusloom.llm.phrases import bit_table
from corpusloom.session import materialize


@dataclass(frozen=True)
class Settings:
    """Words of a shingle and the similarity in percent; then what only shapes the work, never the result.

    A shingle of more than ``long_list`` texts, and of more than 2^-``long_bits`` of all shingles, has a long list (that many bits
    bound their number). Shards of ``shard`` shingles report those of ``reported`` texts or more. ``centers`` rounds
    of comparisons with one member per list come before the pairs; ``block`` records are searched at a time.
    """

    width: int = 3
    percent: int = 90
    long_list: int = 64
    long_bits: int = 22
    shard: int = 4_000_000
    reported: int = 2
    centers: int = 2
    block: int = 64
    block_shingles: int = 1_000_000


def needed(n: int, percent: int) -> int:
    """T: the occurrences that a partner of any size has at least."""
    return -(-percent * n // 100)


# ---- the lists ---------------------------------------------------------------------------------------------


def long_lists(texts: DataFrame, settings: Settings) -> np.ndarray:
    """Shingles of very many texts, sorted; any choice gives right results, so shards need not report rare ones."""

    def reported(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo, held, size = word_memo(), [], 0

        def often() -> pd.DataFrame:
            found, n = np.unique(np.concatenate(held), return_counts=True)
            total = pd.DataFrame({"shingle": pd.array([None], "Int64"), "n": [int(n.sum())]})
            found, n = found[n >= settings.reported], n[n >= settings.reported]
            return pd.concat([total, pd.DataFrame({"shingle": pd.array(found.view(np.int64), "Int64"), "n": n})])

        for batch in batches:
            for text in batch["text"]:
                held.append(shingles(text, settings.width, memo))
                size += len(held[-1])
                if size >= settings.shard:
                    yield often()
                    held, size = [], 0
        if held:
            yield often()

    counts = materialize(texts.select("text").mapInPandas(reported, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n")), "overlap-counts")
    total = counts.where("shingle is null").agg(F.sum("n")).first()[0] or 0
    least = max(settings.long_list, total >> settings.long_bits)
    rows = counts.where(F.col("shingle").isNotNull() & (F.col("n") > least)).select("shingle").toArrow()
    return np.sort(rows["shingle"].to_numpy().astype(np.int64).view(np.uint64))


def short_part(shingle_set: np.ndarray, long: np.ndarray, percent: int) -> np.ndarray:
    """The first n - T + 1 shingles in the order of all texts: by code, those with long lists last."""
    n = len(shingle_set)
    if len(long) and n:
        at = np.minimum(np.searchsorted(long, shingle_set), len(long) - 1)
        shingle_set = shingle_set[np.argsort(long[at] == shingle_set, kind="stable")]
    return shingle_set[: n - needed(n, percent) + 1] if n else shingle_set


def parity_table(shingle_set: np.ndarray) -> np.ndarray:
    """For every place modulo a power of two the parity of its shingles, half as many bits as shingles or more, as 64-bit words."""
    words = max(4, 1 << max(0, int(len(shingle_set) - 1).bit_length() - 7))
    odd = np.bincount((shingle_set % np.uint64(64 * words)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def sketches(texts: DataFrame, long: np.ndarray, settings: Settings) -> DataFrame:
    """doc_id, n_shingles, set_key (128 bits of the whole set, null for an empty one), short shingles, parity table."""
    shared = texts.sparkSession.sparkContext.broadcast(long)

    def sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo, long = word_memo(), shared.value
        for batch in batches:
            sets = [shingles(text, settings.width, memo) for text in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "named": batch["named"],
                    "n_shingles": [len(s) for s in sets],
                    "set_key": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                    "short": [short_part(s, long, settings.percent).view(np.int64) for s in sets],
                    "parity": [parity_table(s) for s in sets],
                }
            )

    kinds = "doc_id bigint, named boolean, n_shingles bigint, set_key binary, short array<bigint>, parity array<bigint>"
    return texts.mapInPandas(sketched, kinds)


def close(settings: Settings) -> Column:
    """Whether sizes and parity tables (n_a, p_a, n_b, p_b) leave room for the similarity.

    Sets at the similarity differ in (100 - percent) / (100 + percent) of their sizes' sum at most, and in at least as
    many shingles as their tables do in bits; a table twice as long is folded first.
    """

    def folded(x: Column) -> Column:
        half = (F.size(x) / 2).cast("int")
        return F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseXOR(q))

    def differ(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda t, v: t + v)

    a, b = F.col("p_a"), F.col("p_b")
    bits = (
        F.when(F.size(a) == F.size(b), differ(a, b))
        .when(F.size(a) == 2 * F.size(b), differ(folded(a), b))
        .when(F.size(b) == 2 * F.size(a), differ(a, folded(b)))
        .otherwise(0)
    )
    sizes = settings.percent * F.greatest("n_a", "n_b") <= 100 * F.least("n_a", "n_b")
    return sizes & ((100 + settings.percent) * bits <= (100 - settings.percent) * (F.col("n_a") + F.col("n_b")))


def side(heads: DataFrame, name: str) -> DataFrame:
    return heads.select(F.col("doc_id").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("parity").alias(f"p_{name}"))


# ---- the search --------------------------------------------------------------------------------------------


def search(query: np.ndarray, records: list[np.ndarray], percent: int) -> list[int]:
    """Places of the records (sorted sets) whose similarity to the query reaches the percentage."""
    n, m = len(query), len(records)
    least = needed(n, percent)
    flat = np.concatenate(records)
    owner = np.repeat(np.arange(m), [len(r) for r in records])
    at = np.minimum(np.searchsorted(query, flat), n - 1)
    common = query[at] == flat
    at, owner = at[common], owner[common]
    order = np.lexsort((owner, at))
    at, owner = at[order], owner[order]
    lengths = np.bincount(at, minlength=n)
    begins = np.cumsum(lengths) - lengths
    # how many long lists to set aside: more of them, the dearer merging is against probing
    n_long = min(least - 1, int(least / (0.0085 * math.log2(max(int(lengths.max()), 2)) + 1)))
    by_length = np.argsort(lengths, kind="stable")
    short, aside = by_length[: n - n_long], by_length[n - n_long :]
    seen: dict[int, int] = {}
    for record in heapq.merge(*(owner[begins[k] : begins[k] + lengths[k]].tolist() for k in short.tolist() if lengths[k])):
        seen[record] = seen.get(record, 0) + 1
    entries = at * m + owner  # all lists end to end, sorted
    out = []
    for record, times in seen.items():
        if times < least - n_long:
            continue
        probes = aside * m + record
        found = np.minimum(np.searchsorted(entries, probes), len(entries) - 1)
        overlap = times + int((entries[found] == probes).sum())
        if 100 * overlap >= percent * (n + len(records[record]) - overlap):
            out.append(record)
    return sorted(out)


#: Bits, as a power of two, of the table that tells which texts' sets are wanted.
WANTED_BITS = 24


def set_table(texts: DataFrame, wanted: DataFrame, settings: Settings) -> DataFrame:
    """doc_id and the whole set, sorted, as 64-bit words, of the wanted ids.

    A bit table of the ids, of fixed size, goes to the texts, so that only sets are shuffled and no texts; sets let through by the bits
    of other ids go in the join.
    """
    code = F.xxhash64("doc_id")
    shared = texts.sparkSession.sparkContext.broadcast(bit_table(wanted.select(code.alias("code")), WANTED_BITS))

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo, table = word_memo(), shared.value
        for batch in batches:
            place = batch["code"].to_numpy().view(np.uint64) & np.uint64(len(table) * 64 - 1)
            batch = batch[((table[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1)).astype(bool)]
            sets = [shingles(t, settings.width, memo).tobytes() for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy(), "shingles": sets})

    sets = texts.select("doc_id", "text", code.alias("code")).mapInPandas(made, "doc_id bigint, shingles binary")
    return sets.join(wanted, "doc_id", "left_semi").distinct()


def searched(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) that are similar, by search of ``b`` in blocks of the others.

    A query with very many records is dealt into several groups; a task holds the query and one block.
    """
    size = pairs.groupBy("b").agg(F.ceil(F.count("*") / settings.block).cast("int").alias("_groups"))
    dealt = pairs.join(size, "b").withColumn("_group", F.pmod(F.xxhash64("a"), F.col("_groups")).cast("int"))
    queries = dealt.select("b", "_group").distinct().withColumns({"doc_id": F.col("b"), "_record": F.lit(0)})
    wanted = queries.unionByName(dealt.select("b", "_group", F.col("a").alias("doc_id"), F.lit(1).alias("_record")))
    rows = wanted.hint("merge").join(sets, "doc_id").repartition("b", "_group").sortWithinPartitions("b", "_group", "_record")

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, queries, ids, block, size = None, [], [], [], 0

        def links() -> pd.DataFrame:
            similar = sorted({ids[k] for query in queries for k in search(query, block, settings.percent)})
            return pd.DataFrame({"a": similar, "b": [at[0]] * len(similar)}).astype("int64")

        for batch in batches:
            for b, group, record, doc, data in zip(batch["b"], batch["_group"], batch["_record"], batch["doc_id"], batch["shingles"]):
                codes = np.frombuffer(data, np.uint64)
                if block and (not record or size >= settings.block_shingles):
                    yield links()
                    ids, block, size = [], [], 0
                if not record:  # an id may carry several sets
                    queries = [*queries, codes] if at == (b, group) else [codes]
                    at = (b, group)
                else:
                    ids.append(doc)
                    block.append(codes)
                    size += len(codes)
        if block:
            yield links()

    return rows.select("b", "_group", "_record", "doc_id", "shingles").mapInPandas(found, "a bigint, b bigint")


# ---- the join ----------------------------------------------------------------------------------------------


def overlap_groups(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest id reachable over links, itself included) of every row.

    Null and empty texts, and texts without words, have no shingles and no links; fewer words than a shingle's are
    one shingle. Rows with a null id take the component of the equal sets that occur under an id, and a null one otherwise.
    Rows of one id are one node, with the links of all its sets. Other columns are ignored; an empty table gives no rows.
    A task holds one text, or one block of sets, at a time.
    """
    # a null beside large ids would turn a batch of them into floats
    texts = narrow(docs, doc_id=id_col, text=text_col).select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0).cast("bigint")).alias("doc_id"), F.col("doc_id").isNotNull().alias("named"), "text"
    )
    sketch = materialize(sketches(texts, long_lists(texts, settings), settings), "overlap-sketches")
    named = sketch.where("set_key is not null and named")
    classes = materialize(named.groupBy("set_key").agg(F.min("doc_id").alias("rep")), "overlap-classes")
    # the sets of one id belong together whatever smaller ids they occur under
    many = named.groupBy("doc_id").agg(F.min("set_key").alias("_s"), F.max("set_key").alias("_t")).where("_s <> _t").select("doc_id")
    same = named.select("doc_id", "set_key").join(many, "doc_id").join(classes, "set_key").where("doc_id <> rep")
    links = materialize(same.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct(), "overlap-links")
    heads = named.join(classes.withColumnRenamed("rep", "doc_id"), ["doc_id", "set_key"], "left_semi").dropDuplicates(["doc_id", "set_key"])
    heads = materialize(heads.select("doc_id", "n_shingles", "parity", "short"), "overlap-heads")
    # every list with several records, its length, and its smallest record as first center
    postings = heads.select("doc_id", F.explode("short").alias("shingle"))
    several = postings.groupBy("shingle").agg(F.count("*").cast("int").alias("size"), F.min("doc_id").alias("center")).where("size > 1")
    lists = materialize(postings.join(several, "shingle").select("shingle", "doc_id", "size", "center"), "overlap-lists")
    join = _Join(texts.where("named"), heads.select("doc_id", "n_shingles", "parity"), links, settings)
    join.link(lists.select(F.col("doc_id").alias("a"), F.col("center").alias("b")).where("a <> b"))
    many = lists.where(F.col("size") >= settings.block)
    for r in range(1, settings.centers):
        records = join.open(many)
        centers = records.groupBy("shingle").agg(F.min_by("doc_id", F.xxhash64("doc_id", F.lit(r))).alias("b"))
        join.link(records.select("shingle", F.col("doc_id").alias("a")).join(centers, "shingle").where("a <> b").select("a", "b"))

    # every pair of lists that hold several components; two records are a pair with the center
    rows = join.open(lists.where("size > 2")).join(join.sides, "doc_id")
    # a list with very many records is dealt: one side by parts, the other to all parts
    parts = F.ceil(F.col("size") / 512).cast("int")
    left = rows.where("component <> main").withColumn("_part", F.pmod(F.xxhash64("doc_id"), parts).cast("int")).select(
        "shingle", "_part", "main", F.col("doc_id").alias("a"), F.col("component").alias("c_a"), F.col("n_shingles").alias("n_a"), F.col("parity").alias("p_a")
    )
    right = rows.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).select(
        "shingle", "_part", F.col("doc_id").alias("b"), F.col("component").alias("c_b"), F.col("n_shingles").alias("n_b"), F.col("parity").alias("p_b")
    )
    once = (F.col("c_b") == F.col("main")) | (F.col("a") > F.col("b"))
    across = left.join(right, ["shingle", "_part"]).where((F.col("c_a") != F.col("c_b")) & once & close(settings))
    join.link(across.select("a", "b"))

    roots = classes.join(join.component.withColumnRenamed("doc_id", "rep"), "rep", "left").select("set_key", F.coalesce("component", "rep").alias("_root"))
    own = sketch.select("doc_id", "named", "n_shingles", "set_key").join(roots, "set_key", "left")
    key = F.when(F.col("named"), F.col("doc_id"))
    return own.select(key.alias("doc_id"), "n_shingles", F.coalesce("_root", key).alias("component_id"))


class _Join:
    """What is known so far: links, searched pairs, components, and the sets read for them."""

    def __init__(self, texts: DataFrame, sides: DataFrame, links: DataFrame, settings: Settings):
        self.texts, self.sides, self.links, self.settings = texts, sides, links, settings
        self.component = components(links).withColumnRenamed("node", "doc_id")
        self.searched: DataFrame | None = None
        self.sets: DataFrame | None = None

    def open(self, lists: DataFrame) -> DataFrame:
        """Records of lists that hold several components, with their component and the center's (``main``)."""
        of = self.component.select(F.col("doc_id").alias("center"), F.col("component").alias("main"))
        labelled = lists.join(self.component, "doc_id", "left").join(of, "center", "left")
        labelled = labelled.withColumns({"component": F.coalesce("component", "doc_id"), "main": F.coalesce("main", "center")})
        labelled = materialize(labelled.drop("center"), "overlap-labelled")
        several = labelled.where("component <> main").select("shingle").distinct()
        return labelled.join(several, "shingle", "left_semi")

    def link(self, pairs: DataFrame) -> None:
        """Search those of the pairs (a, b) that were not searched before and lie in two components."""
        pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        near = pairs.join(side(self.sides, "a"), "a").join(side(self.sides, "b"), "b").where(close(self.settings)).select("a", "b").distinct()
        for end in ("a", "b"):
            near = near.join(self.component.select(F.col("doc_id").alias(end), F.col("component").alias(f"_{end}")), end, "left")
        near = near.where(F.coalesce("_a", "a") != F.coalesce("_b", "b")).select("a", "b")
        if self.searched is not None:
            near = near.join(self.searched, ["a", "b"], "left_anti")
        near = materialize(near, "overlap-pairs")
        self.searched = near if self.searched is None else self.searched.union(near)
        if near.isEmpty():
            return
        wanted = near.select(F.col("a").alias("doc_id")).union(near.select("b")).distinct()
        if self.sets is not None:
            wanted = wanted.join(self.sets.select("doc_id"), "doc_id", "left_anti")
        sets = materialize(set_table(self.texts, materialize(wanted, "overlap-wanted"), self.settings), "overlap-sets")
        self.sets = sets if self.sets is None else self.sets.union(sets)
        found = materialize(searched(near, self.sets, self.settings), "overlap-links")
        if not found.isEmpty():
            self.links = self.links.union(found)
            self.component = components(self.links).withColumnRenamed("node", "doc_id")

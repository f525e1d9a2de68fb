"""Phrase mining, resampling and the Jaccard join against brute force, and on odd rows."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import overlap, phrases, resampling
from corpusloom.llm.common import Memo, positions
from corpusloom.session import arrow_octets

LONG = "alpha beta gamma delta " * 4000
ODD = [
    (1, "one two three, one two three", "en"),
    (1, "one two three, one two three", "en"),
    (1, "something else under the same id", "en"),
    (2, None, None),
    (3, "", "en"),
    (4, " \n\t ", None),
    (None, "a row without an id", "en"),
    (5, "12 34 !!", "de"),
    (6, LONG, "en"),
    (7, "MIT License. Ünïcode x  y z \x01\x7f", None),
    (2**53 + 1, "large ids stay what they are", "en"),
    (2**53 + 3, "large ids stay what they are", "en"),
]
DOCS = "doc_id bigint, text string, lang string"


@pytest.fixture(scope="module")
def odd(spark):
    extra = {c: F.lit("x") for c in ("_row", "_key", "_range", "component", "shingle", "n", "f", "phrase", "code", "rank", "score")}
    return spark.createDataFrame(ODD, DOCS).withColumns(extra | {"a": F.lit(None).cast("string")})


# ---- phrases -----------------------------------------------------------------------------------------------


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute_collocations(rows, support, top):
    f, n, out = defaultdict(Counter), Counter(), []
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang or "und"] += len(words)
            for k in (1, 2, 3):
                f[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    for lang, counts in f.items():
        able = {p: a for p, a in counts.items() if len(p) > 1 and a >= support}
        found = []
        for p, a in able.items():
            cuts = [(10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            if any(len(q) == 3 and len(p) == 2 and p in (q[:2], q[1:]) and 100 * b >= 50 * a for q, b in able.items()):
                continue
            found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def collocations(df, **settings):
    return sorted(tuple(r) for r in phrases.collocations(df, bits=16, **settings).collect())


@pytest.mark.parametrize("octets", [200, 10_000])
def test_phrases_are_those_of_brute_force(spark, octets):
    """Whatever the shards: many small ones (support 1 each) or a few large ones (supports up to the whole)."""
    rnd = random.Random(octets)
    words = ["the", "of", "New", "york", "city", "a", "é", "x y", "b"]
    rows = [(i, "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "\t", ", ", ".\n"]) for _ in range(rnd.randrange(40))), rnd.choice(["en", "fr", None])) for i in range(120)]
    rows += [(999, "x x x x x x x x x x x x", "en"), (999, None, "fr")]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    for support, top in ((10, 2000), (4, 7)):
        assert collocations(df, support=support, top=top, octets=octets) == brute_collocations(rows, support, top)


def test_large_counts_are_exact(spark):
    """1000000 a a passes 64 bits."""
    rows = spark.range(1).select(F.expr(f"1000000 * cast({3 * 10**9} as decimal(38,0)) * cast({3 * 10**9} as decimal(38,0)) div (cast({4 * 10**9} as decimal(38,0)) * cast({10**10} as decimal(38,0)))"))
    assert rows.first()[0] == 10**6 * 9 * 10**18 // (4 * 10**19)


def test_phrases_of_odd_rows(odd):
    got = collocations(odd, support=2)
    assert got == brute_collocations(ODD, 2, 2000)
    assert ("en", "one two three") in {(r[0], r[2]) for r in got}
    assert collocations(odd.limit(0)) == []
    assert collocations(odd.where("doc_id in (2, 3, 4)")) == []


# ---- resampling --------------------------------------------------------------------------------------------


def brute_resample(rows, target, percent, least_words, buckets):
    def features(text):
        return [zlib.crc32(w.encode()) % buckets for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))]

    s, t = Counter(b for _, x, *_ in rows for b in features(x)), Counter(b for x in target for b in features(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    out = []
    for i, x, *_ in rows:
        found = features(x)
        weight = sum(map(gain, found)) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= least_words), key=lambda r: (-r[3], 2**63 if r[0] is None else r[0]))
    return out, able[: percent * len(able) // 100]


def by_id(rows):
    return sorted(rows, key=repr)


def test_resampling_is_that_of_brute_force(spark):
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(60)] + ["É", "Z"]
    rows = [(i, " ".join(rnd.choices(words, k=rnd.randrange(0, 50)))) for i in range(400)]
    target = [" ".join(rnd.choices(words[:8], k=20)) for _ in range(10)] + [None, ""]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    bench = spark.createDataFrame([(x,) for x in target], "text string")
    got = resampling.resample(docs, bench, buckets=500).collect()
    every, drawn = brute_resample(rows, target, 10, 20, 500)
    assert by_id((r.doc_id, r.n_features, r.weight, r.score) for r in got) == by_id(every)
    assert [r.doc_id for r in sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])] == [r[0] for r in drawn]
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, len(drawn) + 1))


def test_runs_of_several_words():
    found = resampling.features([b"a", b"b", b"a"], 2, 1000)
    assert sorted(found) == sorted(zlib.crc32(x) % 1000 for x in (b"a", b"b", b"a", b"a b", b"b a"))


@pytest.mark.parametrize("kind", ["spread", "tied", "few"])
def test_the_bracket_holds_the_cutoff(spark, kind):
    """Scores that are all different, that are one value for most rows, and hardly any rows."""
    rnd = random.Random(1)
    n = 5 if kind == "few" else 3000
    scores = [rnd.randrange(10**6) if kind != "tied" or i % 3 else 777 for i in range(n)]
    rows = [(i, s, i // 2, i) for i, s in enumerate(scores)]
    df = spark.createDataFrame(rows, "doc_id bigint, score bigint, _key bigint, _row bigint").repartition(3)
    for k in {1, n // 10, n // 2, n}:
        if k:
            got = sorted(r.doc_id for r in resampling.drawn_rows(df, k, n).collect())
            assert got == sorted(r[0] for r in sorted(rows, key=lambda r: (-r[1], r[2], r[3]))[:k])


def test_a_bracket_that_misses_is_widened(spark, monkeypatch):
    df = spark.range(1000).select(F.col("id").alias("score"))
    monkeypatch.setattr(resampling, "ACCURACY", 2)  # a sketch so coarse that narrow brackets miss
    for k in (1, 100, 500, 1000):
        low, high, above = resampling.bracket(df, k, 1000)
        assert (low is None and above == 0) or (above == 999 - high and above < k <= 1000 - low)


def test_resampling_of_odd_rows(odd, spark):
    target = spark.createDataFrame([("alpha beta",), (None,)], "text string")
    got = resampling.resample(odd, target, percent=50, least_words=4).collect()
    every, drawn = brute_resample(ODD, ["alpha beta", None], 50, 4, resampling.BUCKETS)
    assert by_id((r.doc_id, r.n_features, r.weight, r.score) for r in got) == by_id(every)
    assert [r.doc_id for r in sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])] == [r[0] for r in drawn]
    assert resampling.resample(odd.limit(0), target).count() == 0
    assert resampling.resample(odd, target.limit(0)).count() == len(ODD)
    assert all(r["rank"] is None for r in resampling.resample(odd.where("doc_id in (2, 3)"), target).collect())


def test_positions_follow_the_order(spark):
    df = spark.createDataFrame([(k % 7, k) for k in range(500)], "a bigint, b bigint").repartition(5)
    got = positions(df, [F.desc("a"), F.asc("b")], "at").collect()
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r["at"])] == sorted(((k % 7, k) for k in range(500)), key=lambda r: (-r[0], r[1]))
    assert sorted(r["at"] for r in got) == list(range(500))


def test_memo_keeps_what_is_in_use():
    made = []
    memo = Memo(lambda k: made.append(k) or -k, limit=4)
    for k in [1, 2, 3, 1, 4, 5, 1, 6, 7, 8, 1, 9, 1]:
        assert memo[k] == -k
    assert made.count(1) == 1 and len(memo) <= 4 and len(memo.older) <= 4


# ---- Jaccard join ------------------------------------------------------------------------------------------


def shingle_set(text, width):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower(text)) if w]
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if len(words) >= width else ({tuple(words)} if words else set())


def brute_groups(rows, width, percent):
    """By id; rows without one are left out."""
    sets = [(i, shingle_set(t, width)) for i, t, *_ in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in sets:
        for j, b in sets:
            if a and b and i != j and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return sorted((i, len(a), find(i)) for i, a in sets)


def test_search_finds_all_records_and_no_other():
    rnd = random.Random(2)
    for _ in range(150):
        n = rnd.randrange(1, 60)
        base = rnd.sample(range(200), n)
        records = []
        for _ in range(rnd.randrange(1, 12)):
            other = [x for x in base if rnd.random() > 0.08] + rnd.sample(range(200, 400), rnd.randrange(4))
            records.append(sorted(other or [1]))
        records.append(sorted(rnd.sample(range(200), rnd.randrange(1, 60))))
        for percent in (50, 80, 90, 100):
            want = [k for k, r in enumerate(records) if 100 * len({*base} & {*r}) >= percent * len({*base} | {*r})]
            arrays = [np.array(r, np.uint64) for r in records]
            assert overlap.search(np.array(sorted(base), np.uint64), arrays, percent) == want


def test_short_parts_of_similar_sets_meet():
    rng = np.random.default_rng(3)
    long = np.sort(rng.choice(2000, 300, replace=False)).astype(np.uint64)
    for _ in range(200):
        a = np.sort(rng.choice(2000, int(rng.integers(1, 120)), replace=False)).astype(np.uint64)
        b = np.unique(np.concatenate((a[rng.random(len(a)) > 0.05], rng.choice(2000, int(rng.integers(0, 3))).astype(np.uint64))))
        if len(b) and 100 * len(np.intersect1d(a, b)) >= 90 * len(np.union1d(a, b)):
            assert len(np.intersect1d(overlap.short_part(a, long, 90), overlap.short_part(b, long, 90)))


def copies(rnd, vocabulary):
    """A large group around the threshold, many texts that share a long passage, chains, and copies."""
    texts, base, passage = [], rnd.choices(vocabulary, k=120), rnd.choices(vocabulary, k=40)
    for _ in range(70):
        near = list(base)
        for _ in range(rnd.randrange(0, 4)):
            near[rnd.randrange(len(near))] = f"x{rnd.randrange(10_000)}"
        texts.append(" ".join(near))
    for k in range(60):
        texts.append(" ".join([*rnd.choices(vocabulary, k=rnd.randrange(1, 30)), *passage, f"y{k}"]))
    chain = [f"c{i}" for i in range(100)]
    for _ in range(12):
        chain = [*chain[1:], f"c{rnd.randrange(10**6)}"]
        texts.append(" ".join(chain))
    return [*texts, *texts[:5], "one", "one", "two words", "Two words", "", None, " \n "]


def test_groups_are_those_of_brute_force(spark):
    rnd = random.Random(7)
    texts = copies(rnd, [f"w{i}" for i in range(3000)])
    rnd.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    for settings in (overlap.Settings(), overlap.Settings(long_list=10, reported=2, centers=1, block=3, block_shingles=500, shard=4000)):
        got = sorted(tuple(r) for r in overlap.overlap_groups(df, settings).collect())
        assert got == brute_groups(rows, 3, 90)


def test_groups_of_odd_rows(odd):
    got = overlap.overlap_groups(odd).collect()
    assert sorted(tuple(r) for r in got if r.doc_id is not None) == brute_groups(ODD, 3, 90)
    (unnamed,) = [r for r in got if r.doc_id is None]
    assert (unnamed.n_shingles, unnamed.component_id) == (3, None)
    assert overlap.overlap_groups(odd.limit(0)).count() == 0
    assert overlap.overlap_groups(odd.where("doc_id in (2, 3, 4)")).count() == 3


def test_an_id_with_several_texts_is_one_node(spark):
    rows = [(1, "a b c d e f g"), (5, "a b c d e f g"), (5, "h i j k l m n"), (9, "h i j k l m n")]
    got = overlap.overlap_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.component_id for r in got} == {1} and len(got) == 4


def test_a_shard_is_looked_at_in_blocks(monkeypatch):
    """Flags and places of a shard, whatever the block; the temporary arrays are those of a block."""
    monkeypatch.setattr(phrases, "BLOCK", 7)
    rng = np.random.default_rng(5)
    words = rng.integers(0, 6, 200).astype(np.uint32)
    codes = rng.integers(0, 2**63, 6).astype(np.uint64)
    table = rng.integers(0, 2**63, 4).astype(np.uint64)
    pairs, inside = phrases._pairs(words, codes, "de")
    want = [bool(i) and bool(int(table[(int(p) & 255) >> 6]) >> (int(p) & 63) & 1) for p, i in zip(pairs, inside)]
    assert phrases._flagged(words, codes, "de", table).tolist() == want
    assert len(phrases._flagged(words[:1], codes, "de", table)) == 0
    values = rng.integers(0, 50, 100).astype(np.uint64)
    distinct, at = np.unique(values, return_inverse=True)
    assert phrases._places(values, distinct).tolist() == at.tolist()


def test_mined_codes_are_packed(spark):
    """op11: what a shard reports takes a few octets a phrase, and what is read from it is what was put in."""
    rng = np.random.default_rng(5)
    codes = np.unique(rng.integers(0, 1 << 32, 300_000, np.uint64)).astype(np.uint32)
    sure = rng.integers(1, 11, len(codes)).astype(np.uint32) * (rng.random(len(codes)) < 0.05) + np.uint32(1)
    packed = phrases._packed(codes, sure)
    assert len(packed) < 3 * len(codes)
    back = phrases._unpacked(packed)
    assert (back[0] == codes).all() and (back[1] == sure).all()
    words = " ".join(f"w{i % 50}" for i in range(400))
    texts = spark.createDataFrame([("de", 4 * len(words), words)] * 4, "lang string, all_octets bigint, text string").repartition(2)
    pairs = phrases.bit_table(phrases.candidates(phrases.mine(texts, 10, 100), 10), 20)
    triples = phrases.bit_table(phrases.candidates(phrases.mine(texts, 10, 100, pairs), 10), 20)
    none = phrases.bit_table(phrases.candidates(phrases.mine(texts, 33, 100, pairs), 33), 20)
    assert [int(np.bitwise_count(t).sum()) for t in (pairs, triples, none)] == [50, 50, 0]


def test_a_task_that_counts_holds_one_shard_and_little_more(monkeypatch):
    """op11: peak memory of a task over several shards, as a multiple of a shard's text; it took 20 times that."""
    monkeypatch.setattr(phrases, "BLOCK", 1 << 14)
    rnd = random.Random(3)
    words = [f"word{i}" for i in range(20_000)]
    texts = [" ".join(rnd.choices(words, k=2000)) for _ in range(240)]
    octets = 75 * min(map(len, texts))

    def batches(table, kind):
        for some in (texts[i : i + 20] for i in range(0, 240, 20)):
            yield table({"lang": ["en"] * 20, "all_octets": [10**6] * 20, "text": [kind(x) for x in some]})

    context = SimpleNamespace(broadcast=lambda table: SimpleNamespace(value=table))
    docs = SimpleNamespace(
        sparkSession=SimpleNamespace(sparkContext=context),
        mapInPandas=lambda f, _: f(batches(pd.DataFrame, str)),
        mapInArrow=lambda f, _: f(batches(pa.record_batch, str.encode)),
    )
    table = np.full(1 << 10, 2**64 - 1, np.uint64)
    tracemalloc.start()
    try:
        assert sum(1 for _ in phrases.count(docs, table, table, octets)) > 3
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 12 * octets


def test_arrow_batches_are_bounded_for_the_jobs_inside(spark):
    """op11: by octets, and only there; a size of the session's own stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    rows = spark.range(0, 5000, 1, 1).select(F.repeat(F.lit("x"), 1000).alias("text"))

    def most():
        sizes = rows.mapInArrow(lambda batches: (pa.record_batch([[b.num_rows]], names=["n"]) for b in batches), "n bigint")
        return max(r.n for r in sizes.collect())

    assert spark.conf.get(key, None) is None and most() == 5000
    with arrow_octets(spark, 1 << 20):
        assert 500 < most() < 1500
    assert spark.conf.get(key, None) is None and most() == 5000
    spark.conf.set(key, "16m")
    try:
        with arrow_octets(spark, 1 << 20):
            assert most() == 5000
        assert spark.conf.get(key) == "16m"
    finally:
        spark.conf.unset(key)

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.packing import (
    at_lengths,
    curriculum_stages,
    length_membership,
    pack,
    packed_order,
    repack,
    repack_stages,
)
from corpusloom.operators.metrics import length_stats
from corpusloom.operators.ordering import Order
from corpusloom.operators.tokenizer import WordPiece, encode_pretraining, pretraining_lengths, read_vocabulary, word_counts

PIECES = ["[PAD]", "[UNK]", "[SEP]", "[MASK]", "ge", "le", "lern", "##lern", "##en", "##r", "##n", "##e", "##t"]


@pytest.fixture(scope="module")
def wp(spark):
    return WordPiece(spark.createDataFrame(list(zip(PIECES, range(len(PIECES)))), "piece string, id int"))


def pieces(spark, wp, text):
    ids = spark.createDataFrame([(text,)], "t string").select(wp.token_ids(F.col("t"))).first()[0]
    return [PIECES[i] for i in ids]


def test_longest_match_first(spark, wp):
    assert pieces(spark, wp, "gelernt") == ["ge", "##lern", "##t"]
    assert pieces(spark, wp, "Lernen") == ["lern", "##en"]
    assert pieces(spark, wp, "xyz lern") == ["[UNK]", "lern"]
    assert pieces(spark, wp, "le" + "n" * 98) == ["le"] + ["##n"] * 98
    assert pieces(spark, wp, "le" + "n" * 99) == ["[UNK]"]
    assert pieces(spark, wp, " ") == []


def test_brute_force_on_random_words(spark, wp):
    rng = random.Random(3)
    texts = ["".join(rng.choice("gelrnt") for _ in range(rng.randrange(1, 12))) for _ in range(300)]

    def walk(word):
        at, out = 0, []
        while at < len(word):
            for end in range(len(word), at, -1):
                piece = ("##" if at else "") + word[at:end]
                if piece in PIECES:
                    out.append(piece)
                    at = end
                    break
            else:
                return ["[UNK]"]
        return out

    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", wp.token_ids(F.col("t")).alias("i")).collect()
    for r in rows:
        assert [PIECES[i] for i in r.i] == walk(r.t)


def test_spans_point_into_the_original_text(spark, wp):
    text = "  Gélernt,\n x lernen"
    spans = spark.createDataFrame([(text,)], "t string").select(wp.token_spans(F.col("t"))).first()[0]
    assert [(PIECES[s.id], text[s.s : s.e]) for s in spans] == [
        ("ge", "Gé"), ("##lern", "lern"), ("##t", "t"), ("[UNK]", ","), ("[UNK]", "x"), ("lern", "lern"), ("##en", "en"),
    ]


def test_encoding_frames_and_skips_blank(spark, wp):
    docs = spark.createDataFrame([(0, ""), (1, "\n"), (2, "  "), (3, "lern"), (4, None)], "doc_id bigint, text string")
    got = {r.doc_id: r.input_ids for r in encode_pretraining(docs, wp).collect()}
    assert got == {2: [2, 2], 3: [2, 6, 2]}


def test_truncation_counts_the_frame(spark, wp):
    ids = F.array(*[F.lit(i) for i in range(10, 20)])
    assert spark.range(1).select(wp.framed(ids, 6)).first()[0] == [2, 10, 11, 12, 13, 2]
    assert len(spark.range(1).select(wp.framed(ids)).first()[0]) == 12


def test_vocabulary_file(spark, tmp_path):
    path = tmp_path / "vocab.txt"
    path.write_text("\n".join(PIECES) + "\n", encoding="utf-8")
    assert {r.piece: r.id for r in read_vocabulary(spark, str(path)).collect()} == {p: i for i, p in enumerate(PIECES)}


def stream_pack(docs, length, sep, size):
    out = []
    for g in range(0, len(docs), size):
        stream = []
        for ids in docs[g : g + size]:
            stream += list(ids) + ([] if sep is None else [sep])
        total = len(stream) // length * length if len(stream) >= length else len(stream)
        out += [stream[i : i + length] for i in range(0, total, length)]
    return out


def table(spark, docs):
    return spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, input_ids array<int>")


def packed_list(df):
    return [r.input_ids for r in df.orderBy("grp", "chunk").collect()]


@pytest.mark.parametrize(
    "docs,want", [([[1, 2], [3], [4, 5, 6]], [[1, 2, 9, 3], [9, 4, 5, 6]]), ([[1]], [[1, 9]])]
)
def test_pack_small(spark, docs, want):
    assert packed_list(pack(table(spark, docs), Order.of_id("doc_id"), 4, 9)) == want


@pytest.mark.parametrize("length,want", [(3, [[1, 2, 9], [3, 9, 4]]), (2, [[1, 2], [9, 3], [9, 4], [5, 6]])])
def test_repack_small(spark, length, want):
    rows = spark.createDataFrame(
        [(0, 0, [1, 2, 9, 3]), (0, 1, [9, 4, 5, 6])], "grp bigint, chunk bigint, input_ids array<int>"
    )
    assert packed_list(repack(rows, packed_order(), length)) == want


@pytest.mark.parametrize("size", [3, 40, 100_000])
def test_pack_equals_the_stream(spark, size):
    rng = random.Random(size)
    docs = [[rng.randrange(10, 99) for _ in range(rng.choice([0, 1, 3, 17, 400]))] for _ in range(700)]
    df = table(spark, docs).repartition(6)
    for length, sep in ((16, 2), (7, None)):
        got = packed_list(pack(df, Order.of_id("doc_id"), length, sep, group_rows=size))
        assert got == stream_pack(docs, length, sep, size)


def test_one_dev_set_at_several_lengths(spark):
    docs = [list(range(i, i + 32)) for i in range(50)]
    got = at_lengths(table(spark, docs), Order.of_id("doc_id"), [8, 20], group_rows=15).collect()
    for length in (8, 20):
        rows = sorted((r.grp, r.chunk, r.input_ids) for r in got if r.seq_len == length)
        assert [r[2] for r in rows] == stream_pack(docs, length, None, 15)


def test_stages_come_from_the_end(spark):
    rows = table(spark, [[i] * 8 for i in range(10)])
    order, lengths = Order.of_id("doc_id"), [2, 4, 8, 8]
    staged = curriculum_stages(rows, order, ["doc_id"], [0.15, 0.15, 0.15, 0.55], lengths, 8)
    got = {}
    for r in staged.collect():
        got.setdefault(r.stage, []).append(r.doc_id)
    assert {k: sorted(v) for k, v in got.items()} == {0: [8, 9], 1: [6, 7], 2: [4, 5], 3: [0, 1, 2, 3]}
    cut, same = repack_stages(staged, order, 8)
    assert sorted((r.stage, len(r.input_ids)) for r in cut.collect()) == [(0, 2)] * 8 + [(1, 4)] * 4
    assert sorted(r.doc_id for r in same.collect()) == [0, 1, 2, 3, 4, 5]
    with pytest.raises(ValueError):
        curriculum_stages(rows, order, ["doc_id"], [0.5, 0.4], [4, 8], 8)


def test_length_membership(spark):
    inside, outside = length_membership(table(spark, [[1], [1, 2], [1, 2, 3], [1, 2]]), [2])
    assert sorted(r.doc_id for r in inside.collect()) == [1, 3]
    assert sorted(r.doc_id for r in outside.collect()) == [0, 2]


def test_length_stats(spark):
    row = length_stats(table(spark, [[0] * n for n in (9, 3, 5, 7)])).first()
    assert (row.n, row.min_len, row.max_len, row.mean_len, row.median_len) == (4, 3, 9, 6.0, 7)
    assert length_stats(table(spark, [[0] * n for n in (9, 3, 5)])).first().median_len == 5


def test_encoder_and_packer_stay_in_the_jvm(spark, wp):
    docs = spark.createDataFrame([(0, "lern")], "doc_id bigint, text string")
    plan = pack(encode_pretraining(docs, wp), Order.of_id("doc_id"), 4, 2)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan


def test_packing_cost_follows_the_tokens(spark):
    import time

    from corpusloom.operators.ordering import Order
    from corpusloom.operators.packing import pack
    from pyspark.sql import functions as F

    def seconds(n):
        rows = spark.range(1).select("id", F.sequence(F.lit(1), F.lit(n)).alias("input_ids"), F.lit(n).alias("n"))
        started = time.perf_counter()
        packed = pack(rows, Order.of_id("id"), 128, 0)
        assert packed.agg(F.sum("n")).first()[0] == (n + 1) // 128 * 128
        return time.perf_counter() - started

    seconds(1000)
    assert seconds(1_600_000) < 4 * seconds(400_000) + 10


def test_words_of_spans_are_not_walked_in_lambdas(spark, wp):
    """Distinct words of a batch are looked up at once; nulls, empty texts and accents in spans hold."""
    rows = spark.createDataFrame([(0, "gelernt  Gélernt xyz"), (1, None), (2, " "), (3, "lern")], "k int, t string")
    spans = wp.token_spans(F.col("t")).alias("s")
    out = rows.coalesce(1).select("k", wp.token_ids(F.col("t")).alias("i"), spans)
    assert "aggregate(" not in rows.select(spans)._jdf.queryExecution().executedPlan().toString()
    got = {r.k: r for r in out.collect()}
    assert [PIECES[i] for i in got[0].i] == ["ge", "##lern", "##t"] * 2 + ["[UNK]"]
    assert [(s.s, s.e) for s in got[0].s] == [(0, 2), (2, 6), (6, 7), (9, 11), (11, 15), (15, 16), (17, 20)]
    assert (got[1].i, got[1].s, got[2].i, got[2].s) == (None, None, [], []) and len(got[3].i) == 1


def test_frequent_words_are_not_walked(spark, wp, monkeypatch):
    """Their pieces come from the constant table: the same ids, and none at all of the walk."""
    words = spark.createDataFrame([("gelernt",), ("xyz",), ("lern",), ("le" + "n" * 99,)], "word string")
    known = WordPiece(spark.createDataFrame(list(zip(PIECES, range(len(PIECES)))), "piece string, id int"), frequent=words)
    monkeypatch.setattr(known, "_longest_at", lambda word, at, table: F.raise_error(F.lit("walked")).cast("struct<id:int,n:int>"))
    rows = spark.createDataFrame([("Gelernt xyz, lern le" + "n" * 99,)], "t string").select(F.replace("t", F.lit(","), F.lit("")).alias("t"))
    plain = rows.select(wp.token_ids(F.col("t"))).first()[0]
    assert rows.select(known.token_ids(F.col("t"))).first()[0] == plain == [4, 7, 12, 1, 6, 1]
    with pytest.raises(Exception, match="walked"):
        spark.createDataFrame([("lerne",)], "t string").select(known.token_ids(F.col("t"))).collect()


def test_runs_are_counted_before_clean_up(spark):
    docs = spark.createDataFrame([("Ab, \u00c4b,\tab  caf\u00e9\u00a0x\u200by ",), ("ab, " + "z" * 101,), (None,), ("",)], "text string")
    counts = word_counts(docs)
    assert {r.word: r.n for r in counts.collect()} == {"ab": 4, ",": 3, "cafe": 1, "xy": 1}
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("Aggregate") > plan.index("lower(")  # the deeper of two aggregates lies below the clean-up


def test_lengths_without_tokens(spark, wp):
    """counted lengths are those of the ids, whatever the text; ids come only where they are asked for."""
    odd = ["Gelernt, lern!", " ", "", "\n", None, "ge\x0blern\u2028x", "le\x1crn \u200bge", "\u00c9ge\u00a0\u4e2d\u6587lern", "le" + "n" * 99, "\u0130\u00df\u03a3 \u1680ge\x85n"]
    docs = spark.createDataFrame([(k % 8, t) for k, t in enumerate(odd * 2)], "doc_id bigint, text string")
    full = sorted((r.doc_id, r.n, r.input_ids) for r in encode_pretraining(docs, wp).collect())
    assert sorted((r.doc_id, r.n) for r in pretraining_lengths(docs, wp).collect()) == [r[:2] for r in full]
    some = pretraining_lengths(docs, wp, (4, 7)).collect()
    assert sorted((r.doc_id, r.n, r.input_ids or []) for r in some) == sorted((k, n, ids if n in (4, 7) else []) for k, n, ids in full)


def test_packing_by_length_alone(spark):
    rows = spark.range(90).select(F.col("id").alias("doc_id"), F.sequence(F.lit(1), F.lit(1) + F.col("id") % 11).alias("input_ids"))
    rows = rows.withColumn("n", F.size("input_ids"))
    whole = pack(rows, Order.of_id("doc_id"), 8, 0, group_rows=20)
    bare = pack(rows.drop("input_ids"), Order.of_id("doc_id"), 8, 0, group_rows=20)
    assert bare.columns == ["grp", "chunk", "n"] and "collect_list" not in bare._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, bare.collect())) == sorted((r.grp, r.chunk, len(r.input_ids)) for r in whole.collect())

from pyspark.sql import functions as F
import pandas as pd
import pytest

from corpusloom.functions.arrays import running_sum
from corpusloom.functions.scalars import elapsed_text, equal_shares, float_list, int_list, metrics_text, round_up
from corpusloom.operators.batching import gathered, pad_batches, real_places, scattered, sequence_offsets, with_batches
from corpusloom.operators.hooks import collate, map_batches
from corpusloom.operators.masking import IGNORE, mask_tokens, masked_count, stage_parameters


def rows_of(spark, lengths):
    return spark.createDataFrame([(i, [7] * n) for i, n in enumerate(lengths)], "idx bigint, input_ids array<int>")


def test_padding(spark):
    padded = pad_batches(with_batches(rows_of(spark, [3, 5, 8, 9]), 2), 0, multiple=8).orderBy("idx").collect()
    assert [len(r.input_ids) for r in padded] == [8, 8, 16, 16]
    assert [sum(r.attention_mask) for r in padded] == [3, 5, 8, 9]
    plain = pad_batches(with_batches(rows_of(spark, [3, 5, 8, 9]), 2), 0).orderBy("idx").collect()
    assert [len(r.input_ids) for r in plain] == [5, 5, 9, 9]


def test_labels_are_padded_with_the_ignore_value(spark):
    rows = rows_of(spark, [1, 3]).withColumn("labels", F.col("input_ids"))
    got = pad_batches(with_batches(rows, 2), 0).orderBy("idx").collect()
    assert got[0].labels == [7, IGNORE, IGNORE]


def test_offsets_of_unpadded_rows(spark):
    padded = pad_batches(with_batches(rows_of(spark, [3, 1, 4]), 3), 0)
    got = sequence_offsets(padded).orderBy("pos").collect()
    assert [r.cu_len for r in got] == [0, 3, 4] and {r.max_len for r in got} == {4}


def test_real_values_give_the_padded_row_again(spark):
    rows = spark.createDataFrame([(i, list(range(1, n + 1))) for i, n in enumerate([3, 0, 4, 2, 6])], "idx bigint, input_ids array<int>")
    padded = pad_batches(with_batches(rows, 2), 0, multiple=8).withColumn("places", real_places(F.col("attention_mask")))
    real = padded.withColumn("real", gathered(F.col("input_ids"), F.col("places")))
    got = real.withColumn("back", scattered(F.col("real"), F.col("places"), F.col("width"))).orderBy("idx").collect()
    assert [len(r.real) for r in got] == [3, 0, 4, 2, 6] and all(r.back == r.input_ids for r in got)


def test_scattered_values_leave_gaps(spark):
    rows = spark.createDataFrame([([5], [1], 3), ([6, 7], [0, 1], 3), ([], [], 3), ([8, 9], [0, 2], 4)], "v array<int>, p array<int>, w int")
    got = rows.select(scattered(F.col("v"), F.col("p"), F.col("w")).alias("x"), gathered(F.col("v"), F.array(F.lit(1), F.lit(0))).alias("y")).collect()
    assert [r.x for r in got] == [[0, 5, 0], [6, 7, 0], [0, 0, 0], [8, 0, 9, 0]]
    assert [r.y for r in got] == [[0, 5], [7, 6], [0, 0], [9, 8]]


def test_expressions_for_values_and_places_are_worked_out_once(spark):
    """A padded row that is an expression is not built again for each of its places."""
    rows = spark.createDataFrame([([5, 6], [0, 1], 4)], "v array<int>, p array<int>, w int")
    wide, at = F.concat("v", F.array_repeat(F.lit(0), 2)), F.transform("p", lambda i: i * 2)
    plan = lambda c: rows.select(c.alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert rows.select(gathered(wide, F.col("p")), scattered(F.col("v"), at, F.col("w"))).first()[:] == ([5, 6], [5, 0, 6, 0])
    assert plan(gathered(wide, F.col("p"))).index("concat(") < plan(gathered(wide, F.col("p"))).index("transform(p")
    assert plan(scattered(F.col("v"), at, F.col("w"))).count("transform(p") == 1


def test_masking_is_no_lambda_and_keeps_nulls(spark):
    rows = spark.createDataFrame([(1, [10, None, 12]), (2, None), (3, [])], "id bigint, input_ids array<int>")
    out = mask_tokens(rows, 1.0, ["id"], 100, 3, [0, 1, 2, 3])
    assert "lambda" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r.id: r for r in out.collect()}
    assert got[1].labels == [10, IGNORE, 12] and got[1].input_ids[1] is None
    assert got[2].labels is None and got[2].input_ids is None and got[3].labels == []


def masked(spark, p, epoch=0, parts=3):
    rows = spark.createDataFrame(
        [(i, [2] + [10 + (i + j) % 80 for j in range(60)] + [2]) for i in range(200)], "id bigint, input_ids array<int>"
    ).withColumn("before", F.col("input_ids"))
    out = mask_tokens(rows.repartition(parts), p, ["id"], 100, 3, [0, 1, 2, 3], epoch=epoch)
    return {r.id: r for r in out.collect()}


def test_masking_keeps_its_promises(spark):
    got = masked(spark, 0.3)
    chosen = changed = kept = 0
    for r in got.values():
        assert len(r.labels) == len(r.input_ids) == 62
        assert r.labels[0] == r.labels[-1] == IGNORE and r.input_ids[0] == r.input_ids[-1] == 2
        for old, new, label in zip(r.before, r.input_ids, r.labels):
            if label == IGNORE:
                assert new == old
            else:
                assert label == old
                chosen += 1
                changed += new == 3
                kept += new == old
    assert abs(chosen / (200 * 60) - 0.3) < 0.02
    assert abs(changed / chosen - 0.8) < 0.03 and abs(kept / chosen - 0.1) < 0.03
    again = masked(spark, 0.3, parts=8)
    assert all(again[i].input_ids == r.input_ids for i, r in got.items())
    assert any(masked(spark, 0.3, epoch=1)[i].labels != r.labels for i, r in got.items())


@pytest.mark.parametrize("p,share", [(0.0, 0), (1.0, 60)])
def test_masking_extremes(spark, p, share):
    assert all(sum(x != IGNORE for x in r.labels) == share for r in masked(spark, p).values())


def test_masked_count(spark):
    assert spark.range(1).select(masked_count(F.array(F.lit(-100), F.lit(4), F.lit(0)))).first()[0] == 2


def test_stages_past_the_last_keep_it(spark):
    got = stage_parameters(spark.range(6).select(F.col("id").alias("stage")), [0.3, 0.2], [512, 64], [64, 512]).collect()
    assert [(r.mlm_p, r.micro_batch, r.seq_len) for r in sorted(got)] == [(0.3, 512, 64)] + [(0.2, 64, 512)] * 5
    with pytest.raises(ValueError):
        stage_parameters(spark.range(1), [0.3], [1, 2], [1])


@pytest.mark.parametrize(
    "seconds,text",
    [(0.0005, "0ms"), (12.5, "12.50s"), (75.0, "1:15m"), (3661.0, "1:01:01h"), (90061.0, "1:01:01:01d"), (0.125, "0.12s"), (59.999, "60.00s")],
)
def test_elapsed(spark, seconds, text):
    assert spark.range(1).select(elapsed_text(F.lit(seconds))).first()[0] == text


def test_metric_map(spark):
    m = F.create_map(F.lit("val/loss"), F.lit(1.0625), F.lit("a/time"), F.lit(75.0))
    assert spark.range(1).select(metrics_text(m, "run")).first()[0] == "run time: 1:15m, loss: 1.062"


def test_small_helpers(spark):
    row = spark.range(1).select(
        round_up(F.lit(9), 8), round_up(F.lit(16), 8), int_list(F.lit("64, 128")), float_list(F.lit("0.5,0.25"))
    ).first()
    assert list(row) == [16, 16, [64, 128], [0.5, 0.25]]
    assert equal_shares(4) == [0.25] * 4
    with pytest.raises(ValueError):
        round_up(F.lit(1), 0)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 100, 101, 5000])
def test_running_sum(spark, n):
    values = [(i * 7) % 11 for i in range(n)]
    want, total = [], 0
    for v in values:
        total += v
        want.append(total)
    got = spark.createDataFrame([(values,)], "v array<int>").select(running_sum(F.col("v"))).first()[0]
    assert got == want


def test_hooks(spark):
    doubled = map_batches(spark.range(10), lambda f: pd.concat([f, f]), "id bigint")
    assert doubled.count() == 20
    rows = spark.range(10).select(F.expr("id div 4").alias("batch"), "id")
    sums = collate(rows, lambda f: pd.DataFrame({"batch": f["batch"][:1], "s": [f["id"].sum()]}), "batch bigint, s bigint")
    assert {r.batch: r.s for r in sums.collect()} == {0: 6, 1: 22, 2: 17}

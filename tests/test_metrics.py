import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.metrics import (
    accuracy,
    argmax,
    best_checkpoint,
    in_steps,
    interval_steps,
    masked_mean,
    running_progress,
    step_budget,
    throughput,
    units_per_step,
)
from corpusloom.operators.ordering import Order
from corpusloom.operators.plateau import plateau_switches
from corpusloom.streaming import plateau, progress
from corpusloom.streaming.plateau import plateau_stream, write_rows
from corpusloom.streaming.progress import stream_progress
from corpusloom.streaming.reorder import GROUPS, heartbeat, late_rows


def losses(spark, runs):
    rows = [(run, step, float(v)) for run, values in runs.items() for step, v in enumerate(values, 1)]
    return spark.createDataFrame(rows, "run bigint, step bigint, loss double").repartition(5)


def by_hand(values, patience, delta, datasets, mode="min"):
    sign = 1 if mode == "min" else -1
    best, wait, out = float("inf"), 0, []
    for step, v in enumerate(values, 1):
        if sign * v + delta < best:
            best, wait = sign * v, 0
        else:
            wait += 1
            if wait >= patience:
                wait = 0
                out.append(step)
    return out[: datasets - 1]


def switches(df):
    out = {}
    for r in df.orderBy("run", "switch_no").collect():
        out.setdefault(r.run, []).append(r.step)
    return out


def test_plateau_by_hand(spark):
    df = losses(spark, {1: [10, 8.5, 8.0, 7.9, 7.6, 6.0]})
    order = Order.of_id("step")
    assert switches(plateau_switches(df, order, 2, 1.0, 2)) == {1: [4]}
    assert switches(plateau_switches(df, order, 2, 1.0, 1)) == {}


@pytest.mark.parametrize("mode,delta,patience", [("min", 0.0, 1), ("min", 0.7, 3), ("max", 0.5, 2), ("min", 2.0, 4)])
def test_plateau_equals_the_fold(spark, mode, delta, patience):
    rng = random.Random(11)
    runs = {r: [round(rng.gauss(20 - s / 40, 3), 2) for s in range(n)] for r, n in enumerate([1, 2, 30, 400, 3000])}
    runs[9] = [5000 - s for s in range(2000)]
    want = {r: w for r, v in runs.items() if (w := by_hand(v, patience, delta, 50, mode))}
    assert switches(plateau_switches(losses(spark, runs), Order.of_id("step"), patience, delta, 50, mode)) == want


@pytest.mark.parametrize("delta", [0.0, 3.5, 9000.0])
def test_plateau_of_one_long_falling_run(spark, delta):
    """Nearly every loss is a new minimum, over more than two hundred blocks."""
    n = 1_000_000
    falling = lambda s: 2.0 * n - s + (s * 7 % 5) / 4
    df = spark.range(1, n + 1).select(F.lit(1).cast("bigint").alias("run"), F.col("id").alias("step"), falling(F.col("id")).alias("loss"))
    want = by_hand([falling(s) for s in range(1, n + 1)], 2, delta, 10**9)
    got = plateau_switches(df, Order.of_id("step"), 2, delta, 10**9).agg(F.count("*"), F.sum("step"), F.max("switch_no")).first()
    assert tuple(got) == (len(want), sum(want) or None, len(want) or None)


def arriving(df, source, values=None, parts=3):
    """Write rows, a minute a step, in random slices to a folder, then a heartbeat; yields after each."""
    rows = df.withColumns({"ts": F.timestamp_seconds(F.col("step") * 60), "_slice": F.pmod(F.xxhash64("run", "step"), F.lit(parts))}).cache()
    for k in range(parts):
        rows.where(F.col("_slice") == k).drop("_slice").coalesce(1).write.mode("append").parquet(source)
        yield
    if values:
        heartbeat(rows.drop("_slice"), F.timestamp_seconds(F.lit(10**6)), "run", values).write.mode("append").parquet(source)
        yield


def test_plateau_stream_equals_the_table(spark, tmp_path):
    """Losses come in any order; each slice is a query of its own that picks up from the checkpoint."""
    rng = random.Random(2)
    runs = {r: [round(rng.gauss(20 - s / 9, 3), 2) for s in range(90)] for r in range(4)}
    source, schema = str(tmp_path / "in"), "run bigint, step bigint, loss double, ts timestamp"
    for _ in arriving(losses(spark, runs), source, plateau.VALUES):
        found = plateau_stream(spark.readStream.schema(schema).parquet(source), 2, 1.0, 5, delay="2 hours")
        write_rows(found, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    want = {r: w for r, v in runs.items() if (w := by_hand(v, 2, 1.0, 5))}
    assert switches(spark.read.schema(plateau.SWITCHES).parquet(str(tmp_path / "out"))) == want


def test_progress(spark):
    rows = [(1, 1, 4, 8, 5), (1, 2, 0, 0, 0), (1, 3, 2, 16, 3), (2, 1, 1, 1, 1)]
    df = spark.createDataFrame(rows, "run bigint, step bigint, rows bigint, width bigint, masked bigint")
    got = running_progress(df, Order.of_id("step"), 2).orderBy("run", "step").collect()
    assert [(r.samples, r.tokens, r.masked_tokens) for r in got] == [(8, 64, 5), (8, 64, 5), (12, 128, 8), (2, 2, 1)]


def test_progress_stream_resumes_its_totals(spark, tmp_path):
    """Run 2 rests for a while, run 3 only comes in later; nothing but rows and the checkpoint is left behind."""
    rows = [(r, s, 1 + s % 3, 4, s % 5) for r in range(4) for s in range(1, 41) if not (r == 2 and 10 < s < 31) and not (r == 3 and s < 25)]
    df = spark.createDataFrame(rows, "run bigint, step bigint, rows bigint, width bigint, masked bigint")
    source, out, schema = str(tmp_path / "in"), str(tmp_path / "out"), "run bigint, step bigint, rows bigint, width bigint, masked bigint, ts timestamp"
    for _ in arriving(df, source, progress.VALUES):
        write_rows(stream_progress(spark.readStream.schema(schema).parquet(source), 2, "1 hour"), out, str(tmp_path / "check")).awaitTermination()
    columns = ["run", "step", "samples", "tokens", "masked_tokens"]
    want = running_progress(df, Order.of_id("step"), 2).select(columns)
    assert sorted(spark.read.schema(progress.PROGRESS).parquet(out).select(columns).collect()) == sorted(want.collect())


def test_silent_runs_are_forgotten_and_late_rows_counted(spark, tmp_path):
    """With 10 minutes of delay: the first slice reaches minute 100, the second has rows of minutes 80, 90 and 91."""
    source, schema = str(tmp_path / "in"), "run bigint, step bigint, rows bigint, width bigint, masked bigint, ts timestamp"
    slices = [[(1, 1), (1, 2), (2, 100)], [(1, 80), (1, 90), (1, 91), (2, 101)], [(2, 5), (1, 200), (1, 201)], [(1, 400)]]
    for steps in slices:
        df = spark.createDataFrame([(r, s, 1, 1, 1) for r, s in steps], "run bigint, step bigint, rows bigint, width bigint, masked bigint")
        df.withColumn("ts", F.timestamp_seconds(F.col("step") * 60)).coalesce(1).write.mode("append").parquet(source)
        totals = stream_progress(spark.readStream.schema(schema).parquet(source), 1, "10 minutes", expire="30 minutes")
        write_rows(totals, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
        late = late_rows(spark.readStream.schema(schema).parquet(source), "run", "10 minutes")
        write_rows(late, str(tmp_path / "late"), str(tmp_path / "late-check")).awaitTermination()
    counts = spark.read.schema("run bigint, late bigint").parquet(str(tmp_path / "late")).groupBy("run").agg(F.max("late")).collect()
    assert sorted(map(tuple, counts)) == [(1, 2), (2, 1)]
    got = sorted((r.run, r.step, r.samples) for r in spark.read.schema(progress.PROGRESS).parquet(str(tmp_path / "out")).collect())
    # run 1 was silent from minute 2 past minute 90, and from 91 past 190: its totals start anew
    assert got == [(1, 1, 1), (1, 2, 2), (1, 91, 1), (1, 200, 1), (1, 201, 2), (2, 100, 1), (2, 101, 2)]


def test_many_runs_share_groups_of_state(spark, tmp_path):
    """A null key and keys beyond doubles keep their totals; state has a row per group, not one per run."""
    rows = [(r, s, 1, 1, 1) for r in [*range(700), None, 2**60, 2**60 + 1] for s in (1, 2, 3)]
    schema = "run bigint, step bigint, rows bigint, width bigint, masked bigint"
    df = spark.createDataFrame(rows, schema)
    source, out, late_out = (str(tmp_path / n) for n in ("in", "out", "late"))
    for _ in arriving(df, source, progress.VALUES):
        stream = spark.readStream.schema(f"{schema}, ts timestamp").parquet(source)
        query = write_rows(stream_progress(stream, 1, "1 hour"), out, str(tmp_path / "check"))
        query.awaitTermination()
        sizes = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
        late = write_rows(late_rows(stream, "run", "1 second"), late_out, str(tmp_path / "late-check"))
        late.awaitTermination()
    got = spark.read.schema(progress.PROGRESS).parquet(out).select("run", "step", "samples").collect()
    assert sorted(map(tuple, got), key=str) == sorted(((r, s, s) for r, s, *_ in rows), key=str)
    assert 0 < max(sizes) <= GROUPS < 700
    counts = spark.read.schema("run bigint, late bigint").parquet(late_out).groupBy("run").agg(F.max("late").alias("late")).collect()
    assert {None, 2**60} & {r.run for r in counts} and all(0 < r.late <= 3 for r in counts)


def test_best_checkpoint_takes_the_earliest(spark):
    df = spark.createDataFrame([(1, 1, 3.0), (1, 2, 1.0), (1, 3, 1.0), (1, 4, 5.0)], "run int, step int, value double")
    assert tuple(best_checkpoint(df, ["run"]).first()) == (1, 1.0, 2)
    assert tuple(best_checkpoint(df, ["run"], mode="max").first()) == (1, 5.0, 4)


def test_budget_and_units(spark):
    row = step_budget(spark.createDataFrame([(1001,)], "size bigint"), 16, 3, 0.06).first()
    assert (row.steps_per_epoch, row.max_steps, row.warmup_steps) == (63, 189, 11)
    assert units_per_step("tokens", 16, 128) == 2048 and units_per_step("iters", 16, accumulation=4) == 4
    assert spark.range(1).select(in_steps(F.lit(5000), 2048)).first()[0] == 2
    assert interval_steps(0.25, 1000) == 250 and interval_steps(40, 1000) == 40
    with pytest.raises(ValueError):
        units_per_step("days", 1)
    with pytest.raises(ValueError):
        units_per_step("tokens", 16)


def test_rates_and_measures(spark):
    df = spark.createDataFrame([(1, 10, 0), (2, 10, 500), (2, 20, 500)], "run int, tokens bigint, millis bigint")
    assert {r.run: r.tokens_per_sec for r in throughput(df, ["run"]).collect()} == {1: None, 2: 30.0}
    rows = spark.createDataFrame([(1, 1), (0, 1)], "p int, l int")
    assert accuracy(rows, "p", "l").first().accuracy == 0.5
    assert spark.range(1).select(argmax(F.array(F.lit(1.0), F.lit(3.0), F.lit(3.0)))).first()[0] == 1


def test_masked_mean(spark):
    rows = spark.createDataFrame([(0, [1.0, 2.0], 1), (0, [3.0, 4.0], 1), (0, [99.0, 99.0], 0)], "g int, v array<double>, m int")
    assert masked_mean(rows, "v", F.col("m"), ["g"]).first()["mean"] == [2.0, 3.0]


def test_masked_mean_of_odd_groups_sums_whole_vectors(spark):
    rows = [(0, [1.0, 2.0], 0), (None, [1.0, 5.0], 1), (None, [2.0, 7.0], 1), (1, None, 1), (1, [4.0, 4.0], 1), (2, [9.0, 9.0], None)]
    means = masked_mean(spark.createDataFrame(rows, "g int, v array<double>, m int"), "v", F.col("m"), ["g"])
    assert {r.g: r["mean"] for r in means.collect()} == {None: [1.5, 6.0], 1: [4.0, 4.0]}
    assert "Generate" not in means._jdf.queryExecution().executedPlan().toString()

"""Training logs, as tables and as streams."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from corpusloom.catalog.inputs import LOG_SQL, hash_sql, metric_log
from corpusloom.catalog.registry import query
from corpusloom.functions.hashing import hash32
from corpusloom.functions.scalars import elapsed_text, metrics_text
from corpusloom.operators.metrics import (
    at_interval,
    best_checkpoint,
    device_reduce,
    interval_steps,
    mean_by_set,
    running_progress,
    throughput,
)
from corpusloom.operators.ordering import Order
from corpusloom.operators.plateau import plateau_switches
from corpusloom.session import materialize, scratch_path
from corpusloom.streaming.logs import deduplicated, read_metric_stream
from corpusloom.streaming import plateau, progress
from corpusloom.streaming.plateau import plateau_stream, write_rows
from corpusloom.streaming.progress import stream_progress
from corpusloom.streaming.reorder import heartbeat, late_rows
from corpusloom.streaming.throughput import read_throughput, windowed_throughput, write_throughput

DEVICES, WIDTH = 2, 64
PATIENCE, DELTA, DATASETS = 2, 1.0, 4


def _steps(log):
    """Clicks play training steps of ``rows x width`` tokens; other events carry none."""
    trained = F.col("metric") == "click"
    return log.select(
        "run",
        "step",
        "ts",
        F.when(trained, F.floor("value")).otherwise(0).alias("rows"),
        F.lit(WIDTH).cast("bigint").alias("width"),
        F.when(trained, F.floor(F.col("value") * 9)).otherwise(0).alias("masked"),
    )


PROGRESS_SQL = f"""
SELECT run, step, CAST(sum(rows) OVER w * {DEVICES} AS BIGINT) AS samples,
       CAST(sum(rows) OVER w * {DEVICES * WIDTH} AS BIGINT) AS tokens, CAST(sum(masked) OVER w AS BIGINT) AS masked_tokens
FROM (SELECT run, step, CASE WHEN metric = 'click' THEN floor(value) ELSE 0 END AS rows,
             CASE WHEN metric = 'click' THEN floor(value * 9) ELSE 0 END AS masked FROM {LOG_SQL} l)
WINDOW w AS (PARTITION BY run ORDER BY step)"""


@query(PROGRESS_SQL)
def running_progress_query(spark, sf_dir):
    out = running_progress(_steps(metric_log(spark, sf_dir)), Order.of_id("step"), DEVICES)
    return out.select("run", "step", "samples", "tokens", "masked_tokens")


PLATEAU_SQL = f"""
WITH folded AS (
  SELECT run, list_reduce(
    list({{'loss': value, 'step': step, 'best': value, 'wait': 0, 'due': CAST([] AS BIGINT[])}} ORDER BY step),
    lambda a, x: CASE
      WHEN x.loss + {DELTA} < a.best THEN {{'loss': x.loss, 'step': x.step, 'best': x.loss, 'wait': 0, 'due': a.due}}
      WHEN a.wait + 1 >= {PATIENCE} THEN {{'loss': x.loss, 'step': x.step, 'best': a.best, 'wait': 0, 'due': list_append(a.due, x.step)}}
      ELSE {{'loss': x.loss, 'step': x.step, 'best': a.best, 'wait': a.wait + 1, 'due': a.due}} END) AS s
  FROM {LOG_SQL} l WHERE metric = 'view' GROUP BY run),
switches AS (SELECT run, unnest(s.due) AS step, generate_subscripts(s.due, 1) AS switch_no FROM folded)
SELECT run, CAST(step AS BIGINT) AS step, CAST(switch_no AS BIGINT) AS switch_no FROM switches WHERE switch_no < {DATASETS}"""


def _losses(log):
    return log.where("metric = 'view'").select("run", "step", "ts", F.col("value").alias("loss"))


@query(PLATEAU_SQL)
def plateau_switch(spark, sf_dir):
    losses = _losses(metric_log(spark, sf_dir))
    return plateau_switches(losses, Order.of_id("step"), PATIENCE, DELTA, DATASETS)


@query(f"SELECT run, metric, round(avg(value), 9) AS mean_loss, count(*) AS n FROM {LOG_SQL} l GROUP BY ALL")
def val_metric_by_set(spark, sf_dir):
    return mean_by_set(metric_log(spark, sf_dir), ["run", "metric"]).withColumn("mean_loss", F.round("mean_loss", 9))


@query(
    f"""SELECT run, value AS best, step FROM (
      SELECT *, row_number() OVER (PARTITION BY run ORDER BY value, step) AS rn FROM {LOG_SQL} l WHERE metric = 'view') WHERE rn = 1"""
)
def best_checkpoint_query(spark, sf_dir):
    return best_checkpoint(metric_log(spark, sf_dir).where("metric = 'view'"), ["run"])


THROUGHPUT_SQL = """
SELECT user_id AS run, CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS hour, CAST(sum(floor(value * 100)) AS BIGINT) AS tokens,
       round(sum(floor(value * 100)) / (sum(floor(value) + 1) / 1000), 4) AS tokens_per_sec
FROM events WHERE event_type = 'click' GROUP BY ALL"""


def _timed(log):
    return log.where("metric = 'click'").select(
        "run", "step", "ts", F.floor(F.col("value") * 100).alias("tokens"), (F.floor("value") + 1).alias("millis")
    )


@query(THROUGHPUT_SQL)
def throughput_query(spark, sf_dir):
    rows = _timed(metric_log(spark, sf_dir)).withColumn("hour", F.expr("unix_seconds(ts) div 3600 * 3600"))
    out = throughput(rows, ["run", "hour"])
    return out.withColumn("tokens_per_sec", F.round("tokens_per_sec", 4))


@query(
    f"""SELECT run, CAST(step // 4 AS BIGINT) AS step, max(value) AS max_memory, round(avg(value / 10), 6) AS avg_seconds
    FROM {LOG_SQL} l GROUP BY run, step // 4"""
)
def device_reduce_query(spark, sf_dir):
    """Four neighbouring rows of a run play the devices of one step."""
    log = metric_log(spark, sf_dir).select(
        "run", F.expr("step div 4").alias("step"), F.col("value").alias("memory"), (F.col("value") / 10).alias("seconds")
    )
    return device_reduce(log, ["run", "step"]).withColumn("avg_seconds", F.round("avg_seconds", 6))


@query(f"SELECT run, step, metric, value FROM {LOG_SQL} l WHERE step % 12 = 0")
def eval_steps(spark, sf_dir):
    return at_interval(metric_log(spark, sf_dir), interval_steps(0.05, 250)).select("run", "step", "metric", "value")


@query(
    """SELECT event_id, CAST(scale AS BIGINT) AS scale, CASE
      WHEN s < 0.001 THEN CAST(floor(s * 1000) AS BIGINT)||'ms'
      WHEN s < 60 THEN printf('%.2fs', s)
      WHEN s < 3600 THEN printf('%d:%02dm', CAST(floor(s / 60) AS BIGINT), CAST(floor(s) AS BIGINT) % 60)
      WHEN s < 86400 THEN printf('%d:%02d:%02dh', CAST(floor(s / 3600) AS BIGINT), CAST(floor(s / 60) AS BIGINT) % 60, CAST(floor(s) AS BIGINT) % 60)
      ELSE printf('%d:%02d:%02d:%02dd', CAST(floor(s / 86400) AS BIGINT), CAST(floor(s / 3600) AS BIGINT) % 24,
                  CAST(floor(s / 60) AS BIGINT) % 60, CAST(floor(s) AS BIGINT) % 60) END AS elapsed
    FROM (SELECT event_id, scale, value * power(10, scale) AS s FROM events, (VALUES (-4),(0),(1),(3)) t(scale))"""
)
def elapsed_format(spark, sf_dir):
    scales = F.explode(F.array(*[F.lit(k) for k in (-4, 0, 1, 3)])).alias("scale")
    rows = metric_log(spark, sf_dir).select("event_id", "value", scales)
    seconds = F.col("value") * F.pow(F.lit(10.0), F.col("scale"))
    return rows.select("event_id", F.col("scale").cast("bigint").alias("scale"), elapsed_text(seconds).alias("elapsed"))


@query(
    f"""SELECT run, 'run '||string_agg(
      CASE WHEN metric = 'click' THEN 'time_click: '||(CASE WHEN m < 60 THEN printf('%.2fs', m)
             ELSE printf('%d:%02dm', CAST(floor(m / 60) AS BIGINT), CAST(floor(m) AS BIGINT) % 60) END)
           ELSE metric||': '||printf('%.3f', m) END, ', ' ORDER BY CASE WHEN metric = 'click' THEN 'train/time_click' ELSE 'val/'||metric END) AS report
    FROM (SELECT run, metric, round(avg(value), 9) AS m FROM {LOG_SQL} l GROUP BY ALL) GROUP BY run"""
)
def metric_report(spark, sf_dir):
    means = metric_log(spark, sf_dir).groupBy("run", "metric").agg(F.round(F.avg("value"), 9).alias("m"))
    name = F.when(F.col("metric") == "click", "train/time_click").otherwise(F.concat(F.lit("val/"), "metric"))
    # a run has one entry per metric name, a handful
    maps = means.groupBy("run").agg(F.map_from_entries(F.collect_list(F.struct(name, "m"))).alias("metrics"))
    return maps.select("run", metrics_text(F.col("metrics"), "run").alias("report"))


def _growing(rows, label: str):
    """Write the rows to a folder in four steps of time, yielding the folder after each, the way a log grows."""
    path = scratch_path(rows.sparkSession, label)
    rows = materialize(rows, label)
    at = F.unix_micros("ts")
    cuts = rows.select(at.alias("at")).approxQuantile("at", [0.25, 0.5, 0.75], 0.01)
    bounds = [None, *cuts, None]
    for low, high in zip(bounds, bounds[1:]):
        after = F.lit(True) if low is None else at >= low
        before = F.lit(True) if high is None else at < high
        rows.where(after & before).write.mode("append").parquet(path)
        yield path


#: Rows of a log arrive up to this many hours after their time; slices of arrival are this many days long.
LAG_HOURS, SLICE_DAYS = 48, 8


def _arriving(rows, label: str, values=None):
    """Write the rows to a folder slice by slice of their arrival, out of order, yielding the folder after each.

    With ``values`` (the columns of a stream in event order) a heartbeat ends it.
    """
    path = scratch_path(rows.sparkSession, label)
    lag = F.pmod(hash32(F.col("run"), F.col("step")), F.lit(LAG_HOURS)) * 3600
    arrival = F.floor((F.unix_seconds("ts") + lag) / (SLICE_DAYS * 86400))
    rows = materialize(rows.withColumn("_slice", arrival), label)
    for (part,) in rows.select("_slice").distinct().orderBy("_slice").collect():
        rows.where(F.col("_slice") == part).drop("_slice").write.mode("append").parquet(path)
        yield path
    if values:
        plain = rows.drop("_slice")
        latest = plain.agg(F.max("ts")).first()[0]
        if latest is not None:
            heartbeat(plain, F.lit(latest) + F.expr(f"interval {2 * LAG_HOURS} hours"), "run", values).write.mode("append").parquet(path)
            yield path


@query(PROGRESS_SQL)
def stream_progress_query(spark, sf_dir):
    steps = _steps(metric_log(spark, sf_dir))
    out = scratch_path(spark, "progress")
    for path in _arriving(steps, "steps", progress.VALUES):
        totals = stream_progress(read_metric_stream(spark, path, steps.schema), DEVICES, f"{LAG_HOURS} hours")
        write_rows(totals, os.path.join(out, "rows"), os.path.join(out, "checkpoint")).awaitTermination()
    return spark.read.schema(progress.PROGRESS).parquet(os.path.join(out, "rows"))


@query(PLATEAU_SQL)
def stream_plateau(spark, sf_dir):
    losses = _losses(metric_log(spark, sf_dir))
    out = scratch_path(spark, "switches")
    for path in _arriving(losses, "losses", plateau.VALUES):
        found = plateau_stream(read_metric_stream(spark, path, losses.schema), PATIENCE, DELTA, DATASETS, delay=f"{LAG_HOURS} hours")
        write_rows(found, os.path.join(out, "rows"), os.path.join(out, "checkpoint")).awaitTermination()
    return spark.read.schema(plateau.SWITCHES).parquet(os.path.join(out, "rows"))


LATE_DELAY_HOURS = 6


@query(
    f"""WITH arrived AS (
      SELECT run, epoch_ms(ts) AS ms, epoch_us(ts) AS exact,
             (epoch_us(ts) // 1000000 + {hash_sql("run || '|' || step")} % {LAG_HOURS} * 3600) // {SLICE_DAYS * 86400} AS slice FROM {LOG_SQL} l),
    passed AS (SELECT slice, max(max(ms)) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {LATE_DELAY_HOURS * 3600000} AS watermark
      FROM arrived GROUP BY slice)
    SELECT run, count(*) AS late FROM arrived JOIN passed USING (slice) WHERE exact <= watermark * 1000 GROUP BY run"""
)
def stream_late_rows(spark, sf_dir):
    """Rows that come in a later slice than the one that moved the watermark past them."""
    log = metric_log(spark, sf_dir).select("run", "step", "ts")
    out = scratch_path(spark, "late")
    for path in _arriving(log, "late-log"):
        late = late_rows(read_metric_stream(spark, path, log.schema), "run", f"{LATE_DELAY_HOURS} hours")
        write_rows(late, os.path.join(out, "rows"), os.path.join(out, "checkpoint")).awaitTermination()
    counts = spark.read.schema("run bigint, late bigint").parquet(os.path.join(out, "rows"))
    return counts.groupBy("run").agg(F.max("late").alias("late"))


@query(THROUGHPUT_SQL)
def stream_throughput(spark, sf_dir):
    timed = _timed(metric_log(spark, sf_dir)).withColumn("metric", F.lit("tokens"))
    out = scratch_path(spark, "throughput")
    for path in _growing(timed, "timed"):
        stream = windowed_throughput(deduplicated(read_metric_stream(spark, path, timed.schema)), delay=None)
        write_throughput(stream, os.path.join(out, "rows"), os.path.join(out, "checkpoint")).awaitTermination()
    rows = read_throughput(spark, os.path.join(out, "rows"))
    return rows.select(
        "run", F.unix_timestamp("window.start").alias("hour"), "tokens", F.round("tokens_per_sec", 4).alias("tokens_per_sec")
    )

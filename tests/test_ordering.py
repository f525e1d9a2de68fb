import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.ordering import (
    Order,
    cap_rows,
    cut_into,
    dense_index,
    discard_fraction,
    grouped_offsets,
    prefix_sums,
    shuffle_order,
    tail_split,
)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    ids = rng.sample(range(1 << 40), 900) + list(range(2000, 4500))
    return spark.createDataFrame(
        [(i, rng.randrange(0, 50), i % 3 if i % 2 else 0) for i in ids], "id bigint, w int, g int"
    ).cache()


def test_prefix_sums_match_a_running_total(spark, rows):
    want, total = {}, 0
    for r in sorted(rows.collect()):
        want[r.id] = total
        total += r.w
    for parts in (1, 3, 8):
        got = prefix_sums(rows.repartition(parts), Order.of_id("id"), {"s": F.col("w")})
        assert {r.id: r.s for r in got.collect()} == want


def test_prefix_sums_restart_in_groups(spark, rows):
    want, totals = {}, {}
    for r in sorted(rows.collect()):
        totals[r.g] = totals.get(r.g, 0) + r.w
        want[r.id] = totals[r.g]
    got = prefix_sums(rows, Order.of_id("id"), {"s": F.col("w")}, by=["g"], inclusive=True)
    assert {r.id: r.s for r in got.collect()} == want


@pytest.mark.parametrize("bits,levels", [(8, 1), (22, 1), (36, 2), (50, 3), (64, 4)])
def test_id_levels_do_not_change_the_result(rows, bits, levels):
    order = Order.of_id("id", bits)
    assert len(order.levels) == levels
    got = dense_index(rows, order).collect()
    assert [r.idx for r in sorted(got)] == list(range(len(got)))


def test_dense_index_of_the_shuffled_order(rows):
    mixed = shuffle_order(rows, ["id"])
    got = dense_index(mixed, Order.of_hash("shuffle_key", "id")).collect()
    assert [r.idx for r in sorted(got, key=lambda r: (r.shuffle_key, r.id))] == list(range(len(got)))
    again = shuffle_order(rows.repartition(3), ["id"]).collect()
    assert {r.id: r.shuffle_key for r in again} == {r.id: r.shuffle_key for r in got}
    other = shuffle_order(rows, ["id"], epoch=1).collect()
    assert {r.id: r.shuffle_key for r in other} != {r.id: r.shuffle_key for r in got}


def test_longest_first(rows):
    got = dense_index(rows, Order.longest_first("w", "id")).collect()
    assert [r.id for r in sorted(got, key=lambda r: r.idx)] == [
        r.id for r in sorted(got, key=lambda r: (-r.w, r.id))
    ]


@pytest.mark.parametrize("size", [1, 7, 1000, 10_000])
def test_grouped_offsets(rows, size):
    ordered = sorted(rows.collect())
    want = {}
    for at, r in enumerate(ordered):
        run = at // size
        want[r.id] = (run, sum(x.w for x in ordered[run * size : at]))
    got = grouped_offsets(rows, Order.of_id("id"), F.col("w"), size)
    assert {r.id: (r._run, r._start) for r in got.collect()} == want


def test_tail_split_is_exact(rows):
    train, dev = tail_split(rows, Order.of_id("id"), ["id"], 37)
    ids = sorted(r.id for r in rows.collect())
    assert sorted(r.id for r in dev.collect()) == ids[-37:]
    assert sorted(r.id for r in train.collect()) == ids[:-37]
    everything, none = tail_split(rows, Order.of_id("id"), ["id"], 0)
    assert everything.count() == len(ids) and none.count() == 0
    assert tail_split(rows, Order.of_id("id"), ["id"], len(ids))[0].count() == 0
    with pytest.raises(ValueError):
        tail_split(rows, Order.of_id("id"), ["id"], len(ids) + 1)


def test_cut_into_pieces(rows):
    ids = sorted(r.id for r in rows.collect())
    cut = cut_into(rows, Order.of_id("id"), ["id"], lambda n: [0, 10, 10, 500, n + 5], "p").collect()
    want = [1] * 10 + [3] * 490 + [4] * (len(ids) - 500)
    assert [r.p for r in sorted(cut, key=lambda r: r.id)] == want


def test_discard_keeps_the_exact_count(spark):
    for n, fraction, keep in ((200, 0.98, 4), (10, 0.8, 1), (10, 0.0, 10)):
        rows = spark.range(n)
        assert discard_fraction(rows, ["id"], fraction).count() == keep


def test_cap(rows):
    ids = sorted(r.id for r in rows.collect())
    for off in (None, 0, -1, 10**9):
        assert cap_rows(rows, Order.of_id("id"), ["id"], off).count() == len(ids)
    assert sorted(r.id for r in cap_rows(rows, Order.of_id("id"), ["id"], 5).collect()) == ids[:5]


def test_no_window_spans_the_data(rows):
    """Every window over rows is partitioned by bucket; the only open ones run on bucket totals."""
    plan = dense_index(rows, Order.of_id("id", bits=36))._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    # printed as: expressions, partitioning (left out when there is none), order
    unpartitioned = [line for line in windows if len(line.split("], [")) == 2]
    assert len(windows) == 3 and len(unpartitioned) == 1
    assert unpartitioned[0].endswith("ASC NULLS FIRST]") and "_level1" not in unpartitioned[0]

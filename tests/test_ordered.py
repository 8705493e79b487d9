"""Row-order operators give the plain window's result whatever the task size."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridloom.operators.ordered import (
    RowOrder,
    carry_backward,
    carry_forward,
    look_around,
    number_rows,
    ordered_concat,
    running_sum,
)


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows, positions are bursty, one key is null."""
    rng = random.Random(3)
    rows = []
    for i in range(400):
        key = "hot" if rng.random() < 0.6 else rng.choice(["a", "b", None])
        rows.append((key, int(i if i < 200 else 10_000 + i // 3), i, rng.choice(["m", "x", "y"])))
    return spark.createDataFrame(rows, "k string, pos long, id long, kind string").cache()


def plain():
    return Window.partitionBy("k").orderBy("pos", "id")


def mark():
    return F.when(F.col("kind") == "m", F.col("id"))


def sized(rows):
    return RowOrder(["k"], ["pos", "id"], F.col("pos"), rows)


def same(got, wanted, *cols):
    order = ["id", *cols]
    assert sorted(map(tuple, got.select(*order).collect()), key=str) == sorted(
        map(tuple, wanted.select(*order).collect()), key=str
    )


@pytest.mark.parametrize("rows", [1, 5, 40, 1000])
def test_carry_and_number(skewed, rows):
    up_to = plain().rowsBetween(Window.unboundedPreceding, 0)
    same(carry_forward(skewed, sized(rows), {"v": mark()}), skewed.withColumn("v", F.last(mark(), True).over(up_to)), "v")
    after = plain().rowsBetween(0, Window.unboundedFollowing)
    same(carry_backward(skewed, sized(rows), {"v": mark()}), skewed.withColumn("v", F.first(mark(), True).over(after)), "v")
    same(number_rows(skewed, sized(rows), "n"), skewed.withColumn("n", F.row_number().over(plain())), "n")
    amount = F.length("kind") + F.col("id") % 3
    same(running_sum(skewed, sized(rows), {"s": amount}), skewed.withColumn("s", F.sum(amount).over(up_to)), "s")


@pytest.mark.parametrize("rows", [1, 7, 40])
def test_look_around(skewed, rows):
    def compute(w):
        return {
            "a": F.lead("id", 3).over(w),
            "b": F.lag("id", 2).over(w),
            "c": F.first(mark(), True).over(w.rowsBetween(-5, -1)),
        }

    same(look_around(skewed, sized(rows), 5, 3, compute), skewed.withColumns(compute(plain())), "a", "b", "c")


@pytest.mark.parametrize("rows", [3, 1000])
def test_concat(skewed, rows):
    got = ordered_concat(skewed, sized(rows), {"t": F.when(F.col("kind") != "x", F.col("kind"))})
    wanted = {}
    for r in skewed.orderBy("pos", "id").collect():
        wanted.setdefault(r.k, []).append(r.kind)
    assert {r.k: (r.row_count, r.t) for r in got.collect()} == {
        k: (len(v), "; ".join(x for x in v if x != "x")) for k, v in wanted.items()
    }


def test_measured_once(skewed):
    by = sized(40).measured(skewed)
    assert [r.k for r in by.large] and by.with_keys("kind").large is None
    assert sized(10_000).measured(skewed).with_keys("kind").large == []


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 9), st.booleans()), min_size=1, max_size=30))
def test_forward_fill_property(spark, rows):
    df = spark.createDataFrame([(k, p, i, m) for i, (k, p, m) in enumerate(rows)], "k string, pos long, id long, m boolean")
    got = carry_forward(df, sized(4), {"v": F.when(F.col("m"), F.col("id"))})
    seen, wanted = {}, []
    for i, (k, p, m) in sorted(enumerate(rows), key=lambda x: (x[1][1], x[0])):
        if m:
            seen[k] = i
        wanted.append((i, seen.get(k)))
    assert sorted((r.id, r.v) for r in got.collect()) == sorted(wanted)


def test_plans_of_chains_stay_small(spark, skewed):
    """Steps on large keys read what the step before stored: the plan does not multiply along a chain."""
    by = RowOrder(["k"], ["pos", "id"], F.col("pos"), rows_per_task=20)
    df = skewed
    for i in range(4):
        df = carry_forward(df, by, {f"c{i}": mark()})
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 8
    assert df.select("k", "id", "c3").exceptAll(carry_forward(skewed, RowOrder(["k"], ["pos", "id"], F.col("pos")), {"c3": mark()}).select("k", "id", "c3")).isEmpty()

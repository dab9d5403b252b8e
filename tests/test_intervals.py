"""Containment as an equi-join against the comparison of all pairs."""

import datetime
import random

import pytest

from noticeloom.operators.intervals import containing

START = datetime.datetime(2024, 1, 1)
MINUTE = datetime.timedelta(minutes=1)


def brute(moments, intervals, keyed):
    return sorted((m[0], i[0]) for m in moments for i in intervals
                  if m[2] is not None and i[2] is not None and i[3] is not None and (not keyed or (m[1] is not None and m[1] == i[1])) and i[2] <= m[2] <= i[3])


@pytest.mark.parametrize("keyed", [True, False])
def test_pairs_of_all_lengths(spark, keyed):
    rng = random.Random(3)
    moments = [(n, 0 if n % 3 == 0 else rng.randrange(8), START + rng.randrange(-4000, 60_000) * MINUTE) for n in range(150)]
    intervals = [(n, 0 if n % 3 == 0 else rng.randrange(8), a := START + rng.randrange(60_000) * MINUTE, a + rng.choice([0, 1, 8, 9, 64, 500, 4096, 40_000, 3_000_000]) * MINUTE) for n in range(150)]
    moments += [(500 + n, i[1], x) for n, i in enumerate(intervals[:40]) for x in (i[2], i[3], i[3] + datetime.timedelta(microseconds=1))]
    moments += [(900, None, START), (901, 0, None), (902, 77, START)]
    intervals += [(900, None, START, START), (901, 0, None, START), (902, 0, START, None), (903, 0, START + MINUTE, START), (904, 0, datetime.datetime(1900, 1, 1), datetime.datetime(9999, 12, 31)),
                  (905, 1, datetime.datetime(1969, 12, 31, 23), datetime.datetime(1970, 1, 1, 1))]
    moments += [(910, 1, datetime.datetime(1969, 12, 31, 23, 30)), (911, 1, datetime.datetime(1970, 1, 1)), (910, 1, datetime.datetime(1969, 12, 31, 23, 30))]
    left = spark.createDataFrame(moments, "m long, k long, at timestamp_ntz")
    right = spark.createDataFrame(intervals, "i long, k long, starts_at timestamp_ntz, ends_at timestamp_ntz")
    df = containing(left, right if keyed else right.drop("k"), ["k"] if keyed else [], "at")
    assert sorted((r["m"], r["i"]) for r in df.collect()) == brute(moments, intervals, keyed)
    plan = df._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_empty_sides(spark):
    left = spark.createDataFrame([(1, 1, START)], "m long, k long, at timestamp_ntz")
    right = spark.createDataFrame([], "i long, k long, starts_at timestamp_ntz, ends_at timestamp_ntz")
    assert containing(left, right, ["k"], "at").collect() == []
    assert containing(left, right.drop("k"), [], "at").collect() == []
    assert containing(left.limit(0), right, ["k"], "at").collect() == []

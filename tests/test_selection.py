"""Rows of a given rank against sorted lists."""

import random

import pytest
from pyspark.sql import functions as F

from cartloom.operators.selection import nth_rows

SHAPE = "k string, score double, tie long"


def groups():
    rng = random.Random(5)
    rows = [("hot", rng.choice([None, 0.0, 1.0, 1.0, rng.random() * 50, float("nan")]), i) for i in range(1500)]
    rows += [("tied", 3.5, rng.randrange(10**6)) for i in range(900)]  # every score equal: the tie decides
    rows += [("two", float(i % 2), i) for i in range(801)]  # the middle lies between two heavy values
    rows += [(None, rng.gauss(0, 1), i) for i in range(700)]
    rows += [("cold", float(i), i) for i in range(8)] + [("one", None, 1)]
    rng.shuffle(rows)
    return rows


def order(row):
    score = row[1]
    return (0 if score is None else 2 if score != score else 1, 0 if score is None or score != score else score, row[2])


@pytest.mark.parametrize("share", [0.5, 0.001, 0.93, 1.0])
def test_rank_in_hot_and_cold_groups(spark, share):
    rows = groups()
    found = nth_rows(spark.createDataFrame(rows, SHAPE), ["k"], ["score", "tie"], lambda n: F.ceil(n * F.lit(share)), 40).collect()
    expected = {}
    for key in {r[0] for r in rows}:
        group = sorted((r for r in rows if r[0] == key), key=order)
        expected[key] = group[-(-int(round(len(group) * share * 1000)) // 1000) - 1]
    assert {r.k: repr(tuple(r)) for r in found} == {k: repr(v) for k, v in expected.items()}


def test_no_hot_group_empty_and_text_ties(spark):
    df = spark.createDataFrame([("a", 1.0, "x"), ("a", 1.0, "y"), ("a", 1.0, "z")], "k string, score double, tie string")
    assert [r.tie for r in nth_rows(df, ["k"], ["score", "tie"], lambda n: n, 2).collect()] == ["z"]
    assert [r.tie for r in nth_rows(df, ["k"], ["score", "tie"], lambda n: F.lit(2)).collect()] == ["y"]
    assert nth_rows(df, ["k"], ["score", "tie"], lambda n: n + 1, 2).count() == 0
    assert nth_rows(df.limit(0), ["k"], ["score", "tie"], lambda n: n).count() == 0

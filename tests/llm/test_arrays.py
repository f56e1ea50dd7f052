"""Array scans against plain Python."""

import random
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from gabarito.llm.arrays import merged, running


def union(spans):
    out = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(s) for s in out]


@pytest.fixture(scope="module")
def cases(spark):
    rng = random.Random(3)
    rows = []
    for i, n in enumerate([0, 1, 2, 3, 4, 5, 7, 8, 9, 10, 15, 16, 17, 99, 100, 101, 4000]):
        starts = [rng.randrange(0, 4 * n) for _ in range(n)]
        spans = [(s, s + rng.randrange(1, 6)) for s in starts]
        text = "".join(rng.choice("aé😀 x") for _ in range(4 * n + 6))
        rows.append((i, [rng.randrange(50) for _ in range(n)], spans, text))
    rows.append((len(rows), [1, 1], [(0, 3), (3, 3)], "abc"))
    return rows, spark.createDataFrame(rows, "i int, v array<int>, s array<struct<start:int,end:int>>, text string")


def test_running(cases):
    rows, df = cases
    largest = lambda a, b: F.greatest(a, b)
    found = df.orderBy("i").select(running(F.col("v"), lambda a, b: a + b).alias("sums"), running(F.col("v"), largest).alias("peaks"))
    for (_, v, *_), got in zip(rows, found.collect()):
        assert got["sums"] == list(accumulate(v))
        assert got["peaks"] == list(accumulate(v, max))


def test_merged_spans(cases):
    rows, df = cases
    found = df.orderBy("i").select(merged(F.col("s")).alias("m"))
    for (_, _, spans, _), got in zip(rows, found.collect()):
        assert [tuple(s) for s in got["m"]] == union(spans)

"""Top-k retrieval against all products in plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gabarito.llm import top_k
from gabarito.llm.top_k import top_products

SCHEMA = "vec_id long, embedding array<float>"


def by_hand(rows, k=5, every=50):
    clean = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    scored = {}
    for q, a in clean:
        if q % every == 0:
            scored.setdefault(q, []).extend((-sum(x * y for x, y in zip(a, b)), i) for i, b in clean if i != q and len(a) == len(b))
    return sorted((q, rank + 1, i, -s) for q, found in scored.items() for rank, (s, i) in enumerate(sorted(found)[:k]))


def got(spark, rows, **options):
    return sorted(map(tuple, top_products(spark.createDataFrame(rows, SCHEMA).repartition(3), **options).collect()))


@pytest.fixture
def vectors():
    rng = random.Random(2)
    whole = lambda x: float(round(x * 64)) / 64  # noqa: E731  exact in single precision
    centres = [[rng.gauss(0, 1) for _ in range(12)] for _ in range(8)]
    rows = [(i, [whole(c + rng.gauss(0, 0.05)) * rng.choice([0.2, 1, 3]) for c in rng.choice(centres)]) for i in range(900)]
    rows += [(1000 + i, rows[0][1]) for i in range(300)]  # one very common vector
    rows += [(-50, [0.0] * 12), (-100, [-1.0] * 12), (2050, [0.25, 0.5]), (2051, [1.0, -1.0]), (2100, []), (2101, [])]
    rows += [(2150, None), (2200, [1.0, None]), (2250, [float("nan")] * 12), (2300, [float("inf")] * 12), (None, [1.0] * 12)]
    return rows


def test_equals_all_products(spark, vectors):
    assert got(spark, vectors) == by_hand(vectors)


@pytest.mark.parametrize("tight", [-1.0, 0.5, 2.0])
def test_small_buckets_and_either_pruning(spark, vectors, monkeypatch, tight):
    for name, value in {"BUCKET_ROWS": 40, "BLOCK_QUERIES": 7, "ROWS_PER_PARTITION": 150, "TIGHT_COSINE": tight}.items():
        monkeypatch.setattr(top_k, name, value)
    assert got(spark, vectors) == by_hand(vectors)


def test_few_rows_repeats_and_large_numbers(spark):
    assert got(spark, []) == []
    assert got(spark, [(50, [1.0])]) == []
    rows = [(50, [1.0, 2.0]), (50, [1.0, 2.0]), (51, [1.0, 0.0]), (52, [1.0, 0.0])]
    assert got(spark, rows) == by_hand(rows)
    rows = [(50, [1.0, 2.0]), (51, [1.0, 0.0]), (51, [1.0, 0.0]), (51, [1.0, 0.5]), (52, [0.5, 0.0])]
    assert got(spark, rows) == by_hand(rows) == [(50, 1, 51, 131_072), (50, 2, 51, 65_536), (50, 3, 51, 65_536), (50, 4, 52, 32_768)]
    rows = [(50, [1.0])] * 9 + [(60, [2.0])] * 7 + [(61, [1.0])] * 30
    assert got(spark, rows) == by_hand(rows)
    rows = [(i, [float(2**20 + i), -float(2**19)]) for i in range(50, 60)]
    assert got(spark, rows) == by_hand(rows)


def test_extra_columns(spark):
    df = spark.createDataFrame([(50, [1.0]), (51, [2.0])], SCHEMA).withColumns({"score": F.lit(1), "V": F.lit(2), "length": F.lit(3)})
    assert [tuple(r) for r in top_products(df).collect()] == [(50, 1, 51, 256 * 512)]


def test_repeated_rows_count_as_in_sql(spark, vectors):
    import duckdb
    import pyarrow as pa

    from gabarito.llm.queries import SQL

    rows = vectors + vectors[:60] * 2 + [vectors[5]] * 9
    # SQL knows no vectors of several dimensions.
    same = [r for r in rows if r[1] is not None and len(r[1]) == 12]
    embeddings = pa.table({"vec_id": [i for i, _ in same], "embedding": pa.array([v for _, v in same], pa.list_(pa.float32()))})  # noqa: F841
    want = duckdb.sql(SQL["op2_top_k"]).fetchall()
    assert got(spark, same) == sorted(want)

"""Whitening against plain integer sums and numpy's own eigenvectors."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from gabarito.llm import whitening
from gabarito.llm.whitening import scatter, whiten

SCHEMA = "vec_id long, embedding array<float>"


def by_hand(vectors, components=8):
    """Integer vectors, their number, exact covariance, falling eigenvalues and trace."""
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(column) for column in zip(*x)]
    cov = [[Fraction(sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in x), n**3) for j in range(d)] for i in range(d)]
    values = np.linalg.eigvalsh(np.array(cov, float))[::-1][:components]
    deviation = [sum((n * c - t) ** 2 for c, t in zip(r, s)) for r in x]
    return x, n, s, np.array(cov, float), values, deviation, float(sum(cov[i][i] for i in range(d)))


@pytest.mark.parametrize("rows, spread", [(1, 5), (63, 1), (64, 2**40), (65, 1000), (300, 2**20)])
def test_scatter_is_exact(rows, spread):
    x = np.random.default_rng(rows).integers(-spread, spread, (rows, 5))
    sums, products = scatter(x)
    exact = x.astype(object)
    assert sums == exact.sum(axis=0).tolist()
    want = (exact.T @ exact).tolist()
    assert products == [line[i:] for i, line in enumerate(want)]


def test_equals_plain_sums(spark, monkeypatch):
    monkeypatch.setattr(whitening, "ROWS_PER_BLOCK", 50)
    rng = np.random.default_rng(3)
    mix = rng.normal(size=(12, 12)) * np.linspace(0.02, 0.5, 12)
    vectors = (rng.normal(size=(400, 12)) @ mix).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    bad = [(900, None), (901, [None] * 12), (902, [float("nan")] * 12), (903, [float("-inf")] * 12), (904, [1.0]), (905, []), (906, [1e30] * 12)]
    df = spark.createDataFrame(rows + bad, SCHEMA).repartition(5).withColumns({"component": F.lit("x"), "W": F.lit(1), "x": F.lit(2)})
    x, n, s, cov, values, deviation, trace = by_hand(vectors)
    found = {}
    for r in whiten(df).collect():
        found.setdefault(r["component"], {})[r["vec_id"]] = r
    assert sorted(found) == list(range(1, 9)) and all(sorted(f) == list(range(400)) for f in found.values())
    centred = np.array(x, float) - np.array(s) / n
    for k, of in found.items():
        w = np.array([of[i]["whitened"] for i in range(400)])
        assert [int(of[i]["deviation"]) for i in range(400)] == deviation
        assert of[0]["n"] == 400 and abs(of[0]["explained"] / (values[k - 1] / trace) - 1) < 1e-9
        # The coordinates are those of an eigenvector: their products with the data give it back, scaled.
        direction = centred.T @ w / n / math.sqrt(values[k - 1])
        assert np.abs(np.linalg.norm(direction) - 1) < 1e-9
        assert np.abs(cov @ direction - values[k - 1] * direction).max() < 1e-7 * values[0]
        assert of[0]["identity_error"] < 1e-9


def test_few_dimensions_repeats_and_flat_directions(spark):
    rows = [(i % 7, [float(i % 3), 2.0, float(i % 3)]) for i in range(21)] + [(None, [0.0, 2.0, 0.0])]
    found = whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 22 * 3 and {r["component"] for r in found} == {1, 2, 3}
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in found)
    assert abs(sum({r["component"]: r["explained"] for r in found}.values()) - 1) < 1e-12
    assert {r["identity_error"] < 1e-9 for r in found} == {True}


def test_tables_without_variance_or_rows(spark):
    one = whiten(spark.createDataFrame([(1, [1.0, 2.0])], SCHEMA)).collect()
    assert [(r["whitened"], r["identity_error"], int(r["deviation"])) for r in one] == [(None, None, 0)] * 2
    assert whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whiten(spark.createDataFrame([(1, []), (2, None)], SCHEMA)).collect() == []
    assert whiten(spark.createDataFrame([], SCHEMA)).columns == whiten(spark.createDataFrame([(1, [1.0])], SCHEMA)).columns


def test_query_over_a_whole_table(spark):
    from gabarito.llm.queries import QUERIES

    data = "/root/testdata/sf0.001"
    vectors = spark.read.parquet(f"{data}/embeddings.parquet").orderBy("vec_id").collect()
    usable = [r for r in vectors if r["embedding"] is not None and all(c is not None and math.isfinite(c) for c in r["embedding"])]
    _, n, _, _, values, deviation, trace = by_hand([np.array(r["embedding"], np.float32) for r in usable])
    rows = QUERIES["op12_whitening"](spark, data).orderBy("vec_id", "component").collect()
    assert [(r["vec_id"], r["component"]) for r in rows] == [(r["vec_id"], k) for r in usable for k in range(1, 9)]
    assert [r["deviation"] for r in rows[::8]] == deviation and {r["n"] for r in rows} == {n}
    assert all(abs(r["explained"] * trace / values[r["component"] - 1] - 1) < 1e-9 for r in rows)
    assert max(r["identity_error"] for r in rows) < 1e-9

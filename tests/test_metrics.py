"""Scores against plain Python over small groups with odd shapes."""

import random
from collections import Counter
from math import sqrt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gabarito.operators import metrics as M

SCHEMA = "model_name string, benchmark string, label string, parsed_model_answer string"


def brute(pairs):
    """Accuracy and support-weighted precision, recall, F1 of (label, prediction) pairs."""
    n = len(pairs)
    support, predicted = Counter(t for t, _ in pairs), Counter(p for _, p in pairs)
    hits = Counter(t for t, p in pairs if t == p)
    precision = sum(s * (hits[c] / predicted[c] if predicted[c] else 0) for c, s in support.items()) / n
    f1 = sum(s * 2 * hits[c] / (s + predicted[c]) for c, s in support.items()) / n
    return sum(hits.values()) / n, precision, sum(hits.values()) / n, f1


def test_category_scores(spark):
    rng = random.Random(3)
    groups = {
        ("m1", "oab"): [(rng.choice("ABCD"), rng.choice("ABCDE")) for _ in range(200)],
        ("m2", "oab"): [("A", "A")],
        ("m3", "oab"): [("A", "B"), ("B", "C")],
        ("m1", "enem"): [("A", "A")] * 5 + [("B", "A")] * 3,
    }
    rows = [(m, b, t, p) for (m, b), pairs in groups.items() for t, p in pairs]
    rows += [("m1", "oab", "A", None)] * 50 + [("m4", "oab", "A", None)] * 4
    got = {(r.model_name, r.benchmark): r for r in M.evaluate(spark.createDataFrame(rows, SCHEMA)).collect()}
    for key, pairs in groups.items():
        r = got[key]
        assert (r.accuracy, r.precision, r.recall, r.f1_score) == pytest.approx(brute(pairs))
        assert r.pearson_correlation is None
    assert got["m1", "oab"].non_parsed_rate == pytest.approx(50 / 250)
    empty = got["m4", "oab"]
    assert (empty.accuracy, empty.precision, empty.f1_score, empty.non_parsed_rate) == (None, None, None, 1.0)


def test_correlation(spark):
    xs = [(float(i), (i * 37 % 11) / 3) for i in range(30)]
    rows = [("m1", "assin2sts", str(x), str(y)) for x, y in xs]
    rows += [("m1", "assin2sts", "9.0", None)] * 10
    rows += [("m2", "assin2sts", str(x), "2.0") for x, _ in xs]
    rows += [("m3", "assin2sts", "1.0", "2.0"), ("m4", "assin2sts", "1.0", None)]
    got = {r.model_name: r for r in M.evaluate(spark.createDataFrame(rows, SCHEMA)).collect()}
    mx, my = (sum(v) / len(xs) for v in zip(*xs))
    cov = sum((x - mx) * (y - my) for x, y in xs)
    want = cov / sqrt(sum((x - mx) ** 2 for x, _ in xs) * sum((y - my) ** 2 for _, y in xs))
    assert got["m1"].pearson_correlation == pytest.approx(want)
    assert got["m1"].non_parsed_rate == pytest.approx(0.25)
    assert all(got[m].pearson_correlation is None for m in ("m2", "m3", "m4"))
    assert got["m1"].accuracy is None


def test_unreadable_label_of_a_correlation_is_named(spark):
    rows = [("m", "assin2sts", "1.5", "1.0"), ("m", "assin2sts", None, "2.0"), ("m", "assin2sts", "odd", None)]
    fine = spark.createDataFrame(rows, SCHEMA).withColumn("id_bench", F.lit("id7"))
    assert M.evaluate(fine).first().pearson_correlation is None
    broken = fine.withColumn("parsed_model_answer", F.lit("1.0"))
    with pytest.raises(PySparkException, match="label is no number: assin2sts id7 odd"):
        M.evaluate(broken).collect()


def test_integer_labels_are_normalised_and_both_rates_kept(spark):
    rows = [
        ("m", "aime24", r"\(336^\circ\)", "336"),
        ("m", "aime24", "12.0", "12"),
        ("m", "aime24", "7", "8"),
        ("m", "aime24", "n/d", "1"),
        ("m", "aime24", "5", None),
        ("none", "aime24", "5", None),
    ]
    got = {r.model_name: r for r in M.evaluate(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got["m"].accuracy == pytest.approx(2 / 3)
    assert got["m"].non_parsed_rate == pytest.approx(1 / 4)
    assert got["m"].non_parsed_total_rate == pytest.approx(1 / 5)
    assert (got["none"].accuracy, got["none"].non_parsed_rate) == (None, 1.0)


def test_unknown_benchmark_fails(spark):
    rows = spark.createDataFrame([("m", "nope", "1", "1")], SCHEMA)
    with pytest.raises(PySparkException, match="unknown benchmark: nope"):
        M.evaluate(rows).collect()


def test_summary_agrees_with_eval(spark):
    rng = random.Random(5)
    rows = [
        (m, b, rng.choice("ABC"), rng.choice(["A", "B", "C", None])) for m in "xy" for b in ("oab", "mmlu") for _ in range(40)
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    left = M.parse_summary(df).select("model_name", "benchmark", "accuracy", "non_parsed_rate")
    right = M.evaluate(df).select("model_name", "benchmark", "accuracy", "non_parsed_rate")
    assert left.exceptAll(right).count() == 0 and left.count() == 4


def test_benchmark_filter_reaches_the_scan(spark, tmp_path):
    rows = [("m", "oab", "A", "A"), ("m", "assin2sts", "1.0", "2.0")]
    path = str(tmp_path / "answers")
    spark.createDataFrame(rows, SCHEMA).write.partitionBy("model_name", "benchmark").parquet(path)
    plan = M.continuous_eval(spark.read.schema(SCHEMA).parquet(path).where(F.col("benchmark").isin("assin2sts")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(benchmark" in text and "assin2sts" in text

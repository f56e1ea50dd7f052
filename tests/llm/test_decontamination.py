"""Benchmark search against all windows in plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from gabarito.llm.decontamination import find_benchmark_words, is_contaminated, n_hit


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def by_hand(docs, items, window):
    patterns = set()
    for item, text in items:
        ws = words(text)
        for i in range(max(1, len(ws) - window + 1) if ws else 0):
            patterns.add((tuple(ws[i : i + window]), item))
    out = []
    for i, text in docs:
        ws, hit, found = words(text), set(), set()
        for pattern, item in patterns:
            for at in range(len(ws) - len(pattern) + 1):
                if tuple(ws[at : at + len(pattern)]) == pattern:
                    hit.update(range(at, at + len(pattern)))
                    found.add(str(item))
        out.append((i, len(ws), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(ws)))
    return sorted(out, key=repr)


def got(df, benchmark, **options):
    rows = find_benchmark_words(df, benchmark, **options).select("doc_id", "n_words", n_hit(), "items", is_contaminated()).collect()
    return sorted(map(tuple, rows), key=repr)


@pytest.fixture
def tables(spark, docs_of):
    rng = random.Random(11)
    vocabulary = ["a", "b", "C", "dé", "e1", "日本", "F_g", "h-i"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, text(rng.randrange(1, 12))) for k in range(30)] + [(30, ""), (31, None), (32, "..."), (33, "b"), (33, "b"), (34, "dé dé")]
    docs = [(i, " ! ".join(rng.choice([text(9), rng.choice(items)[1] or ""]) for _ in range(rng.randrange(6)))) for i in range(120)]
    docs += [(500, None), (501, ""), (502, "?!"), (503, text(3000))]
    return docs, items, docs_of(docs), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("window", [3, 5, 13])
def test_equals_all_windows(tables, window):
    docs, items, df, benchmark = tables
    assert got(df, benchmark, window=window) == by_hand(docs, items, window)


def test_several_passes_change_nothing(tables):
    docs, items, df, benchmark = tables
    assert got(df, benchmark, window=3, patterns_per_pass=17) == by_hand(docs, items, 3)


def test_several_passes_judge_rows_without_unique_ids(tables, docs_of):
    """Null and repeated ids: each row gets the findings of its own text in every pass."""
    docs, items, _, benchmark = tables
    docs = [(None if k % 3 == 0 else k % 5, t) for k, (_, t) in enumerate(docs)]
    df = docs_of(docs).withColumn("_ROW", F.lit(1))
    assert got(df, benchmark, window=3, patterns_per_pass=17) == by_hand(docs, items, 3)
    assert find_benchmark_words(df, benchmark, window=3, patterns_per_pass=17).columns == find_benchmark_words(df, benchmark, window=3).columns


def test_several_passes_keep_clashing_columns(tables):
    docs, items, df, benchmark = tables
    df = df.withColumns({"_spans": F.lit("a"), "_ITEMS": F.lit("b"), "_row": F.lit("c"), "a.b": F.lit("d"), "items": F.lit("e")})
    found = find_benchmark_words(df, benchmark, window=3, patterns_per_pass=17)
    assert found.select("_spans", "_ITEMS", "_row", "`a.b`").distinct().collect() == [("a", "b", "c", "d")]
    assert got(df, benchmark, window=3, patterns_per_pass=17) == by_hand(docs, items, 3)


def test_share_of_one_in_twenty(docs_of, spark):
    benchmark = spark.createDataFrame([("q", "alpha")], "item_id string, text string")
    docs = [(1, "alpha " + "x " * 19), (2, "alpha " + "x " * 20), (3, "x")]
    assert [r[4] for r in got(docs_of(docs), benchmark)] == [True, False, False]


def test_rows_repeat_columns_clash_tables_are_empty(docs_of, spark):
    benchmark = spark.createDataFrame([(None, "a b"), (1, "c")], "item_id long, text string")
    df = docs_of([(1, "a b c"), (1, "a b c"), (None, "a b")]).withColumns({"Spans": F.lit(1), "items": F.lit(2)})
    assert got(df, benchmark) == sorted([(1, 3, 3, ["1"], True)] * 2 + [(None, 2, 2, [], True)], key=repr)
    assert got(docs_of([(1, "a b c")]), benchmark.where("false")) == [(1, 3, 0, [], False)]
    assert got(docs_of([]), benchmark) == []

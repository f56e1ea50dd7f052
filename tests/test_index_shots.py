"""Dense indexes and few-shot draws against plain Python."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gabarito.operators import shots as S
from gabarito.operators.index import (
    contiguous_shard,
    dense_index,
    head_percent,
    prompt_ids,
    renumber,
    with_dense_index,
)
from gabarito.operators.shots import SEED
from gabarito.staging import staged


def grouped(spark, sizes):
    """Groups of given sizes, keys spread and shuffled."""
    rows = [(b, (i * 7919) % 100003, f"row{i}") for b, n in sizes.items() for i in range(n)]
    random.Random(0).shuffle(rows)
    return spark.createDataFrame(rows, "benchmark string, item_key long, text string"), rows


def expected_index(rows):
    out = {}
    for b in {r[0] for r in rows}:
        for i, key in enumerate(sorted(r[1] for r in rows if r[0] == b)):
            out[b, key] = i
    return out


@pytest.mark.parametrize("partitions", [None, 1, 13])
def test_dense_index_with_a_hot_group(spark, partitions):
    df, rows = grouped(spark, {"hot": 900, "a": 60, "b": 1})
    got = dense_index(df, ["benchmark"], ["item_key"], partitions=partitions).collect()
    assert {(r.benchmark, r.item_key): r.idx for r in got} == expected_index(rows)
    assert {(r.benchmark, r.n_rows) for r in got} == {("hot", 900), ("a", 60), ("b", 1)}


def test_dense_index_splits_a_hot_group(spark):
    df, _ = grouped(spark, {"hot": 900})
    parts = dense_index(df, ["benchmark"], ["item_key"], partitions=9)
    assert parts.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).filter(bool).count() > 4


def test_dense_index_over_text_keys_and_whole_table(spark):
    df, rows = grouped(spark, {"x": 50, "y": 30})
    got = dense_index(df, [], ["benchmark", "item_key"], partitions=4).collect()
    order = sorted((r[0], r[1]) for r in rows)
    assert [(r.benchmark, r.item_key) for r in sorted(got, key=lambda r: r.idx)] == order
    assert renumber(df, ["benchmark", "item_key"]).agg(F.min("id"), F.max("id")).first()[:] == (1, 80)


@pytest.mark.parametrize("percent, kept", [(100, 61), (10, 7), (0, 0), (99.9, 61), (1.0, 1)])
def test_head_percent(spark, percent, kept):
    df, _ = grouped(spark, {"a": 61})
    head = head_percent(with_dense_index(df, ["benchmark"], ["item_key"]), percent)
    assert head.count() == kept
    assert {r.n_rows for r in head.collect()} <= {kept}


@pytest.mark.parametrize("n, shards", [(7, 3), (3, 5), (10, 1), (12, 4), (1, 2)])
def test_contiguous_shards(spark, n, shards):
    rows = spark.range(n).select("id", contiguous_shard(F.col("id"), F.lit(n), shards).alias("s"))
    got = [r.s for r in rows.orderBy("id").collect()]
    sizes = [n // shards + (1 if i < n % shards else 0) for i in range(shards)]
    assert got == [i for i, size in enumerate(sizes) for _ in range(size)]


def indexed(spark, sizes):
    df, _ = grouped(spark, sizes)
    items = with_dense_index(df, ["benchmark"], ["item_key"])
    return items.withColumn("id_bench", F.concat_ws("_", "benchmark", F.col("idx").cast("string")))


def reference_draw(q, n, k, seed):
    return random.Random(seed).sample([i for i in range(n) if i != q], k)


@pytest.mark.parametrize("limit", [None, 0])
def test_seeded_shots_equal_a_draw_from_the_other_rows(spark, limit, monkeypatch):
    if limit is not None:  # force the salted join
        plain = S.small_join
        monkeypatch.setattr(S, "small_join", lambda *a, **k: plain(*a, **{**k, "limit": limit, "salts": 3}))
    sizes = {"hot": 200, "b": 12}
    items = indexed(spark, sizes)
    ranks = S.draw_ranks(items.where("idx = 0").select("benchmark", "n_rows"), 5, 3)
    rows = S.with_shots(items, ranks, F.col("id_bench")).collect()
    assert len(rows) == 3 * 212
    for r in rows:
        want = reference_draw(r.idx, sizes[r.benchmark], 5, SEED + r.experiment)
        assert r.shots == [f"{r.benchmark}_{i}" for i in want]


def test_row_draws_are_distinct_and_repeatable(spark):
    items = indexed(spark, {"a": 40, "b": 9})
    draw = S.with_shots_per_row(items, 6, 2, 7, F.col("id_bench"))
    rows = {(r.id_bench, r.experiment): r.shots for r in draw.collect()}
    assert len(rows) == 2 * 49
    for (own, _), shots in rows.items():
        assert len(set(shots)) == 6 and own not in shots
        assert {s.split("_")[0] for s in shots} == {own.split("_")[0]}
    again = {(r.id_bench, r.experiment): r.shots for r in draw.repartition(3).collect()}
    assert rows == again
    assert len({tuple(s) for s in rows.values()}) > 40


def test_every_ordered_pair_of_positions_is_equally_frequent(spark):
    """Seven rows, two shots: 30 ordered pairs of the six others, over 700 experiments of each row."""
    rows = S.with_experiments(spark.range(7).select(F.lit("b").alias("benchmark"), F.col("id").alias("idx")), 700)
    ranks = S.row_ranks(F.lit(7), F.col("benchmark"), F.col("idx"), F.col("experiment").cast("long"), 2, 5)
    counts = {tuple(r.ranks): r["count"] for r in rows.groupBy(ranks.alias("ranks")).count().collect()}
    assert set(counts) == {(a, b) for a in range(6) for b in range(6) if a != b}
    expected = 7 * 700 / 30
    assert all(abs(n - expected) < 5 * expected**0.5 for n in counts.values())
    assert sum((n - expected) ** 2 / expected for n in counts.values()) < 65  # 29 degrees of freedom, one in 10,000


def test_all_rows_drawn_and_three_of_many(spark):
    rows = S.with_experiments(spark.range(40).select(F.col("id").alias("idx")), 100)
    draw = lambda n, k: S.row_ranks(F.lit(n), F.lit("b"), F.col("idx"), F.col("experiment").cast("long"), k, 1)
    orders = {tuple(r.x) for r in rows.select(draw(4, 3).alias("x")).collect()}
    assert orders == {(a, b, 3 - a - b) for a in range(3) for b in range(3) if a != b}
    # Neighbours at equal distance are as rare as chance makes them.
    drawn = [sorted(r.x) for r in rows.select(draw(101, 3).alias("x")).collect()]
    assert sum(c - b == b - a for a, b, c in drawn) / len(drawn) < 0.03


def test_row_draws_keep_all_columns(spark):
    items = indexed(spark, {"a": 6}).withColumns({"pos": F.lit(1), "row": F.lit("x"), "a.b": F.lit(2)})
    rows = S.with_shots_per_row(items, 2, 1, 3, F.struct("text", "row"))
    assert rows.columns == [*items.columns, "experiment", "shots"]
    texts = {r.idx: r.text for r in items.collect()}
    for r in rows.collect():
        assert r.text == texts[r.idx] and len(r.shots) == 2 and r["a.b"] == 2
        assert {s.text for s in r.shots} <= set(texts.values()) - {r.text}


def test_row_draws_do_not_broadcast_the_rows(spark):
    """A staged table's files are small beside its rows, so their size must not decide."""
    items = staged(indexed(spark, {"a": 40, "b": 9}), "items")
    rows = S.with_shots_per_row(items, 6, 2, 7, F.col("id_bench"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert rows.count() == 2 * 49


def test_no_shots_and_too_many(spark):
    items = indexed(spark, {"a": 5})
    none = S.without_shots(items, 2, F.struct("id_bench"))
    assert none.count() == 10 and none.where(F.size("shots") > 0).count() == 0
    with pytest.raises((PySparkException, ValueError)):
        ranks = S.draw_ranks(items.where("idx = 0").select("benchmark", "n_rows"), 5, 1)
        S.with_shots(items, ranks, F.col("id_bench")).collect()


def test_prompt_ids_follow_benchmark_item_experiment(spark):
    items = indexed(spark, {"a": 5, "b": 3})
    rows = S.without_shots(items, 2, F.col("id_bench"))
    got = prompt_ids(rows, 2, ["b", "a"]).orderBy("id").collect()
    assert [r.id for r in got] == list(range(16))
    assert [(r.benchmark, r.idx, r.experiment) for r in got] == [
        (b, i, e) for b, n in (("b", 3), ("a", 5)) for i in range(n) for e in range(2)
    ]

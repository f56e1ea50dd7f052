"""The shuffle: exact sizes, gapless slots, and uniform draws."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gabarito.llm import sharding
from gabarito.llm.sharding import communication_matrix, shuffle_into_shards


def check(rows, shards):
    counts = Counter(r["shard"] for r in rows)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sizes[s]))


@pytest.mark.parametrize("n", [0, 1, 15, 16, 17, 1000])
def test_sizes_and_slots(docs_of, n):
    rows = shuffle_into_shards(docs_of([(i, f"text {i}") for i in range(n)])).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(n))
    check(rows, 16)


def test_values_ties_and_nulls(docs_of):
    texts = [None, "", "é", "same", "same", "x" * 100_000]
    df = docs_of([(1, t) for t in texts] + [(None, "same")]).withColumns({"SLOT": F.lit(9), "_key": F.lit(8), "_mine": F.lit(7), "rest": F.lit(6), "a.b": F.lit(5)})
    rows = shuffle_into_shards(df, shards=3).collect()
    check(rows, 3)
    want = Counter((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for t in [*texts, "same"])
    assert Counter((r["size"], r["text_crc32"]) for r in rows) == want
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("rows", None)}
    assert "source" in rows[0].asDict() and not {"text", "SLOT"} & set(rows[0].asDict())
    assert {(r["_key"], r["_mine"], r["rest"], r["a.b"]) for r in rows} == {(8, 7, 6, 5)}


def test_small_buckets(docs_of, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", 3)
    check(shuffle_into_shards(docs_of([(i, "t") for i in range(500)]), shards=4).collect(), 4)


def test_seed_decides(docs_of):
    df = docs_of([(i, "t") for i in range(200)])
    places = lambda seed: {r["doc_id"]: (r["shard"], r["slot"]) for r in shuffle_into_shards(df, seed=seed).collect()}
    assert places(1) == places(1) != places(2)


def test_matrix_margins_and_law():
    sizes = [5, 0, 17, 1, 60]
    m = communication_matrix(sizes, 4, 3)
    assert m.sum(axis=1).tolist() == sizes and sorted(m.sum(axis=0).tolist()) == [20, 21, 21, 21]
    # 6 rows in two partitions of 3, two shards of 3: k of the first go to shard 0 in C(3,k)^2 of 20 ways.
    counts = np.bincount([communication_matrix([3, 3], 2, s)[0, 0] for s in range(4000)], minlength=4) / 4000
    assert np.abs(counts - np.array([1, 9, 9, 1]) / 20).max() < 0.03


def test_large_draws_stay_in_bounds(monkeypatch):
    monkeypatch.setattr(sharding, "GENERATOR_LIMIT", 10)
    m = communication_matrix([50, 3, 0, 47], 3, 1)
    assert m.sum(axis=1).tolist() == [50, 3, 0, 47] and sorted(m.sum(axis=0).tolist()) == [33, 33, 34]
    assert (m >= 0).all()


@pytest.mark.parametrize("good, bad, sample", [(6, 9, 5), (3, 40, 20), (40, 3, 20), (1, 1, 2), (5, 0, 3), (0, 7, 3), (30, 30, 0)])
def test_draws_beyond_the_generator_hold_the_law(monkeypatch, good, bad, sample):
    monkeypatch.setattr(sharding, "GENERATOR_LIMIT", 0)
    rng = np.random.default_rng(9)
    counts = np.bincount([sharding.drawn(rng, good, bad, sample) for _ in range(20_000)], minlength=sample + 1) / 20_000
    law = [math.comb(good, k) * math.comb(bad, sample - k) / math.comb(good + bad, sample) for k in range(sample + 1)]
    assert np.abs(counts - law).max() < 0.015


def test_a_very_large_draw():
    rng = np.random.default_rng(2)
    good, bad, sample = 10**10, 15 * 10**10, 10**6
    found = np.array([sharding.drawn(rng, good, bad, sample) for _ in range(3000)])
    spread = (sample / 16 * (15 / 16)) ** 0.5
    assert abs(found.mean() - sample / 16) < 6 * spread / 3000**0.5 and abs(found.std() / spread - 1) < 0.06
    # A small partition, whose expected count is far below one.
    small = np.array([sharding.drawn(rng, 10**8, 10**12, 20) for _ in range(2000)])
    assert set(small.tolist()) <= {0, 1} and small.sum() < 20


def test_the_shuffle_by_hand(docs_of):
    """Rows of a partition are dealt out by the matrix, in the order of their keys."""
    rows = shuffle_into_shards(docs_of([(i, f"t{i % 7}") for i in range(400)]).repartition(5), shards=6, seed=3).collect()
    check(rows, 6)
    by_shard = [[r["doc_id"] for r in sorted(rows, key=lambda r: r["slot"]) if r["shard"] == s] for s in range(6)]
    # Neither the shards nor the slots follow the ids.
    assert all(abs(np.corrcoef(np.arange(len(ids)), ids)[0, 1]) < 0.4 for ids in by_shard)
    assert max(abs(np.mean(ids) - 199.5) for ids in by_shard) < 60

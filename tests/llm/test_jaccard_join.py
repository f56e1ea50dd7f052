"""The near-duplicate join against all pairs in plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from gabarito.llm import jaccard_join
from gabarito.llm.components import components
from gabarito.llm.jaccard_join import near_duplicates


def shingles(text):
    words = [w for w in re.split(r"[ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def by_all_pairs(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(i, least.get(find(k), i))
    return sorted((i, len(sets[k]), least[find(k)]) for k, (i, _) in enumerate(rows))


@pytest.fixture(autouse=True)
def few_blocks(monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCKS", 8)


def got(df):
    return sorted((r["id"], r["n_shingles"], r["component_id"]) for r in near_duplicates(df).collect())


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"x{rng.random()}"
    return " ".join(words)


@pytest.fixture
def corpus():
    """Groups of near copies, passages shared by otherwise different texts, copies, and edges."""
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    rows = []
    base = text(90)
    rows += [edited(rng, base, rng.randrange(4)) for _ in range(60)]
    passage = text(40)
    rows += [" ".join(passage + text(rng.randrange(2, 30))) for _ in range(40)]
    rows += [" ".join(text(30)) for _ in range(30)]
    rows += ["same TEXT here and now \t again"] * 20 + ["same text HERE and now again"]
    rows += [None, "", " \t\n", "one", "One", "one two", "one two", "é È", "a b c d e"]
    rng.shuffle(rows)
    return [(1000 - 3 * k, t) for k, t in enumerate(rows)]


def test_equals_all_pairs(docs_of, corpus):
    assert got(docs_of(corpus)) == by_all_pairs(corpus)


def test_small_bounds_change_nothing(docs_of, corpus, monkeypatch):
    """Many pieces, blocks and flushes, and neighbourhoods that hardly gather."""
    for name, value in {"NEIGHBOURS": 4, "BLOCK_ROWS": 3, "SHINGLES_PER_FLUSH": 50, "ROUNDS": 1, "SHINGLES_PER_BLOCK": 100}.items():
        monkeypatch.setattr(jaccard_join, name, value)
    assert got(docs_of(corpus)) == by_all_pairs(corpus)


def links_by_all_pairs(rows):
    sets = [shingles(t) for _, t in rows]
    linked = lambda a, b: bool(a & b) and 100 * len(a & b) >= 75 * len(a | b)
    return sorted((i, sum(linked(a, b) for m, b in enumerate(sets) if m != k)) for k, ((i, _), a) in enumerate(zip(rows, sets)))


@pytest.mark.parametrize("bounds", [{}, {"NEIGHBOURS": 4, "BLOCK_ROWS": 3, "ROUNDS": 1}, {"NEIGHBOURS": 4, "BLOCK_ROWS": 3, "ROUNDS": 2}])
def test_every_link_is_counted_once(docs_of, corpus, monkeypatch, bounds):
    """Links inside groups that are connected already count too, whatever the blocks."""
    for name, value in bounds.items():
        monkeypatch.setattr(jaccard_join, name, value)
    found = sorted((r["id"], r["n_links"]) for r in near_duplicates(docs_of(corpus)).collect())
    assert found == links_by_all_pairs(corpus)


def test_edge_of_the_threshold(docs_of):
    words = [f"w{i}" for i in range(104)]
    # 100 shingles against a beginning with 75, and against one with 74.
    rows = [(3, " ".join(words)), (2, " ".join(words[:79])), (1, " ".join(words[:78]))]
    assert got(docs_of(rows[:2])) == [(2, 75, 2), (3, 100, 2)]
    assert got(docs_of([rows[0], rows[2]])) == [(1, 74, 1), (3, 100, 3)]
    assert got(docs_of(rows)) == [(1, 74, 1), (2, 75, 1), (3, 100, 1)]


def test_rows_repeat_and_ids_lack(docs_of, spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (7, "other words")]
    found = {(r["id"], r["component_id"]): r["count"] for r in near_duplicates(docs_of(rows)).groupBy("id", "component_id").count().collect()}
    assert found == {(5, 5): 2, (None, 5): 1, (7, 7): 1}
    assert near_duplicates(docs_of([])).count() == 0


def test_clashing_columns(docs_of):
    df = docs_of([(1, "a b c d e"), (2, "a b c d e")]).withColumns({"id": F.lit("x"), "class": F.lit(0), "n_shingles": F.lit(None)})
    assert got(df) == [(1, 1, 1), (2, 1, 1)]


def test_very_long_text(docs_of):
    long = " ".join(f"w{i % 5000}" for i in range(200_000))
    assert got(docs_of([(1, long), (2, long + " end"), (3, "end")])) == [(1, 5000, 1), (2, 5001, 1), (3, 1, 3)]


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(200) if i % 20 != 19] + [(500, k) for k in range(501, 600)] + [(7, 7), (3, 2)]
    rng.shuffle(links)
    found = dict(components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect())
    want = {i: i - i % 20 for i in range(200) if i % 20} | {k: 500 for k in range(501, 600)}
    assert found == want
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0

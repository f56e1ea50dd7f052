"""Winnowing against plain Python, and the guarantee that shared passages share prints."""

import random
from hashlib import md5

import pytest
import regex
from pyspark.sql import functions as F

from gabarito.llm.winnowing import BASE, GRAM, PRIME, WINDOW, edited_by_next, fingerprints, written

TOKEN = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}]|[^ \t-\r\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}]{1,16}")


def by_hand(text):
    """(hash, position) of the rightmost least gram of every window."""
    words = [int(md5(t.encode()).hexdigest()[:7], 16) for t in TOKEN.findall((text or "").lower())]
    if not words:
        return []
    k = min(GRAM, len(words))
    grams = []
    for i in range(len(words) - k + 1):
        value = 0
        for h in words[i : i + k]:
            value = (value * BASE + h) % PRIME
        grams.append(value)
    w = min(WINDOW, len(grams))
    chosen = {min(((grams[j], -j) for j in range(i, i + w))) for i in range(len(grams) - w + 1)}
    return sorted(((g, -j) for g, j in chosen), key=lambda p: p[1])


def likeness(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


TEXTS = [None, "", " \n ", "one", "One", "a b c d", "a b c d e", "x " * 30, "it is the same " * 9, "漢字かな交じり文" * 4 + " and more", "é" * 50, "😀 b" * 20, "word " * 40_000]


def test_equals_plain_windows(docs_of):
    rng = random.Random(5)
    texts = TEXTS + [" ".join(rng.choice("abcdefgh") for _ in range(n)) for n in list(range(1, 20)) + [50, 300]]
    found = {r["doc_id"]: [tuple(p) for p in r["prints"]] for r in fingerprints(docs_of(list(enumerate(texts)))).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        assert found[i] == by_hand(text), text


def test_shared_passages_share_prints():
    rng = random.Random(6)
    for _ in range(200):
        passage = [f"p{rng.randrange(9)}" for _ in range(GRAM + WINDOW - 1)]
        sides = [[f"{side}{rng.randrange(9)}" for _ in range(rng.randrange(30))] for side in "abcd"]
        one, two = (set(h for h, _ in by_hand(" ".join(x + passage + y))) for x, y in (sides[:2], sides[2:]))
        assert one & two


def expected(rows):
    """Result rows of `edited_by_next` for (id, text) rows, in order."""
    n, out = len(rows), []
    for k, (i, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % n][1] or ""
        q = len(text) // 4
        edited = text[: len(text) - q] + after[:q]
        own = by_hand(text)
        out.append((i, len(text), edited, own, by_hand(edited), likeness(own, by_hand(edited)), likeness(own, by_hand(after))))
    return out


@pytest.mark.parametrize("keyed", [True, False])
def test_edited_by_next(spark, docs_of, keyed, tmp_path):
    rng = random.Random(7)
    rows = [(None, "null comes first, once")] + [(i - 5, t) for i, t in enumerate(TEXTS)]
    rows += [(100 + i, " ".join(rng.choice(["sun", "rain", "wind", "über"]) for _ in range(rng.randrange(80)))) for i in range(60)]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    df = docs_of(shuffled).withColumns({"prints": F.lit(1), "AT": F.lit(2), "key": F.lit(3), "n": F.lit(4)})
    if keyed:
        df.write.parquet(str(tmp_path / "t"))
        df = spark.read.parquet(str(tmp_path / "t"))
    found = edited_by_next(df, [F.col("_metadata.file_path"), F.col("_metadata.row_index")] if keyed else None)
    found = found.withColumn("written", written(F.col("prints"))).withColumn("edited_written", written(F.col("edited_prints"))).collect()
    text_of = lambda p: " ".join(f"{h:x}:{i}" for h, i in p)
    want = [(i, n, e, text_of(a), text_of(b), x, y) for i, n, e, a, b, x, y in expected(rows)]
    got = [(r["doc_id"], r["n_chars"], r["edited"], r["written"], r["edited_written"], r["near_edited"], r["near_next"]) for r in found]
    order = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted(got, key=order) == want


def test_repeated_and_few_rows(docs_of):
    assert edited_by_next(docs_of([])).count() == 0
    text = "a lonely text of some words that meets nobody but itself at all"
    (alone,) = edited_by_next(docs_of([(1, text)])).collect()
    assert alone["near_next"] == 1.0 and alone["edited"] == text[:-15] + text[:15] and alone["next_id"] == 1
    rows = edited_by_next(docs_of([(1, text)] * 500 + [(2, "other words")])).collect()
    assert len(rows) == 501 and sum(r["near_next"] == 1.0 for r in rows) == 499
    assert sorted({r["near_next"] for r in rows}) == [0.0, 1.0]

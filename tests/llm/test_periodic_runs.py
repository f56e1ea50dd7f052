"""Runs against a plain search over all periods."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gabarito.llm import periodic_runs
from gabarito.llm.periodic_runs import Grammar, Scanner, find_runs, listed, strongest, with_repeated_tail


def by_hand(words, least=24):
    """Maximal stretches of every period, smallest period first."""
    n, found = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 3 * q):
                b, e = i, j + q
                if not any(p < q and x <= b and e <= y for x, y, p in found):
                    found.append((b, e, q))
            i = max(j, i + 1)
    return sorted((b, e - b, q) for b, e, q in found)


def collapsed_by_hand(words, runs):
    gone = {i for b, size, q in runs for i in range(b + q, b + size)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def random_text(rng):
    letters = "abcdefgh"[: rng.choice([1, 2, 3, 8])]
    out = []
    while len(out) < rng.choice([10, 60, 150, 400]):
        part = [rng.choice(letters) for _ in range(rng.randint(1, 30))]
        part = part * rng.choice([1, 1, 2, 3, 4, 9])
        out += part[: len(part) - rng.randint(0, len(part) // 2)]
        if out and rng.random() < 0.3:
            k = rng.randrange(len(out))
            out += out[k : k + rng.randint(1, 80)]
    return out


def scanned(texts):
    runs, collapsed = Scanner().scan(texts)
    return [[(r["start"], r["length"], r["period"]) for r in one] for one in runs], collapsed


def test_equals_plain_search():
    rng = random.Random(4)
    samples = [random_text(rng) for _ in range(700)]
    runs, collapsed = scanned([" ".join(s) for s in samples])
    assert sum(map(bool, runs)) > 200 and max(map(len, runs)) >= 3
    for words, found, text in zip(samples, runs, collapsed):
        want = by_hand(words)
        assert found == want, words
        assert text == collapsed_by_hand(words, want)


@pytest.mark.parametrize("seed", range(3))
def test_the_grammar_derives_the_text(seed):
    rng = random.Random(seed)
    for _ in range(60):
        ids = [ord(c) - 97 for c in random_text(rng)]
        alone = {max(ids) + 1}
        ids = ids + list(alone) + ids[: len(ids) // 2] + list(alone)
        g = Grammar(ids, alone)

        def derive(s):
            return [s] if s < g.base else derive(g.left[s - g.base]) + derive(g.right[s - g.base])

        assert [x for s in g.top for x in derive(s)] == ids
        for k in range(len(g.left)):
            own = derive(g.base + k)
            assert ids[g.first[k] : g.first[k] + g.length[k]] == own and not alone & set(own)
        for s, at in g.derived(1).items():
            assert all(ids[p : p + g.words(s)] == derive(s) for p in at)
        # No pair is left that occurs twice without overlap.
        pairs = {}
        for i, pair in enumerate(zip(g.top, g.top[1:])):
            if not alone & set(pair):
                pairs.setdefault(pair, []).append(i)
        assert all(max(at) - min(at) < 2 for at in pairs.values())


def test_long_texts():
    rng = random.Random(1)
    unit = [f"w{rng.randrange(50)}" for _ in range(1000)]
    words = ["x"] * 100_000 + unit * 30 + [f"u{i}" for i in range(5000)] + ["p", "q"] * 20_000
    (runs,), (text,) = scanned([" ".join(words)])
    assert runs == [(0, 100_000, 1), (100_000, 30_000, 1000), (135_000, 40_000, 2)]
    assert len(text.split()) == 1 + 1000 + 5000 + 2


def test_edges():
    a = " ".join(["a"] * 23)
    texts = [None, "", " \n\t", "one", a, a + " a", (a + " a").replace(" ", "\x0b"), "a b " * 30, "  " + "x y z " * 8 + "x\r\n"]
    runs, collapsed = scanned(texts)
    assert runs == [[], [], [], [], [], [(0, 24, 1)], [(0, 24, 1)], [(0, 30, 1)], [(0, 25, 3)]]
    assert collapsed == ["", "", "", "one", a, "a", "a", "a b", "x y z"]
    # Three periods of nine are enough, three less a word are not.
    nine = [str(i) for i in range(9)]
    assert scanned([" ".join(nine * 3), " ".join((nine * 3)[:-1])])[0] == [[(0, 27, 9)], []]


def test_columns_and_rows(docs_of, monkeypatch):
    monkeypatch.setattr(periodic_runs, "VOCABULARY", 1)
    text = "la la " * 20 + "end"
    df = docs_of([(1, text), (1, text), (None, text), (2, None), (3, "x " * 300_000)]).withColumns({"RUNS": F.lit(1), "collapsed": F.lit("c")})
    rows = find_runs(df).select("doc_id", "lang", listed(F.col("runs")).alias("l"), strongest(F.col("runs")).alias("s"), "collapsed").collect()
    found = sorted(((r["doc_id"] or 0, r["l"], r["collapsed"], r["s"]) for r in rows), key=lambda r: r[:2])
    assert [f[:3] for f in found] == [(0, "0,40,1\n", "la end"), (1, "0,40,1\n", "la end"), (1, "0,40,1\n", "la end"), (2, "", ""), (3, "0,300000,1\n", "x")]
    assert found[3][3] is None and found[0][3]["length"] == 40
    assert find_runs(docs_of([])).count() == 0


def test_strongest_breaks_ties_by_start_then_period(spark):
    runs = [[(5, 30, 10), (9, 60, 20)], [(0, 24, 8), (3, 25, 8)], [(3, 24, 2), (3, 36, 3)]]
    df = spark.createDataFrame([([{"start": a, "length": b, "period": c} for a, b, c in r],) for r in runs], "runs array<struct<start:long,length:long,period:long>>")
    found = [tuple(r["b"]) for r in df.repartition(1).select(strongest(F.col("runs")).alias("b")).collect()]
    assert sorted(found) == sorted([(5, 30, 10), (3, 25, 8), (3, 24, 2)])


def test_repeated_tail(spark):
    texts = [" ".join(f"w{i}" for i in range(n)) for n in (1, 2, 7, 40)] + ["", " a\tb ", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    for at, divisor in ((0, 3), (5, 10), (429_496_729, 7)):
        got = {r["i"]: r["t"] for r in df.select("i", with_repeated_tail(F.col("text"), F.lit(at), F.lit(divisor)).alias("t")).collect()}
        for i, text in enumerate(texts):
            words = (text or "").split()
            if words:
                n = len(words)
                a = at % n
                p = 1 + (n - a) // divisor
                words = [words[a + (k - a) % p] if k >= a else w for k, w in enumerate(words)]
                assert got[i] == " ".join(words)
            else:
                assert got[i] == text


DATA = "/root/testdata/sf0.001"


def test_query_equals_plain_search(spark):
    from gabarito.llm.queries import QUERIES, digest  # noqa: F401
    from hashlib import sha256

    texts = dict(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op13_periodic_runs"](spark, DATA).collect()
    assert len(rows) == len(texts) and sum(r["n_runs"] > 0 for r in rows) >= 10
    for r in rows:
        words = (texts[r["doc_id"]] or "").encode().split()
        h = zlib.crc32(str(r["doc_id"]).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
        if len(words) > 6000 and h % 10:
            continue  # the plain search is quadratic
        ids = np.unique(np.array(words, dtype=object), return_inverse=True)[1].tolist() if words else []
        want = by_hand(ids)
        lines = "".join(f"{b},{size},{q}\n" for b, size, q in want)
        kept = collapsed_by_hand([w.decode() for w in words], want)
        best = max(want, key=lambda x: (x[1] / x[2], -x[0], -x[2])) if want else (None,) * 3
        milli = 1000 * best[1] // best[2] if want else None
        assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"]) == (len(want), *best, milli)
        assert (r["runs_sha256"], r["collapsed_sha256"]) == (sha256(lines.encode()).hexdigest(), sha256(kept.encode()).hexdigest())

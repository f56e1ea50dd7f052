"""Runs of repeating words, found in a grammar of each text.

A run is a longest stretch of words with one period that holds the period at least three times.
Re-Pair turns the words into a grammar: the most frequent pair of neighbours becomes a new symbol
until no pair occurs twice. A run lies across the boundary of the lowest symbol that contains it,
so runs are looked for at that boundary once a symbol, moved to all places the symbol derives,
and merged where they overlap by a period.

Every eight words of a run occur again one period further within it. Texts, and parts of texts,
whose eight words in a row never return have no run and get no grammar.
"""

import heapq
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable
from itertools import chain, count

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gabarito.llm.common import append_columns

LEAST_LENGTH = 24  # words of a run
LEAST_PERIODS = 3
SEED = 8  # words that must return; at most a third of LEAST_LENGTH
VOCABULARY = 1_000_000  # words remembered by a task before it starts anew
RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
FIELDS = [T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())]


class Grammar:
    """Re-Pair over `ids`: symbols below `base` are ids, later ones stand for a pair of symbols.

    `left` and `right` are a symbol's parts, `first` a place where it derives the text, `length`
    the words it derives. `top` is what remains of the text, and `top_at` where each symbol begins.
    Ids of `alone` are separators and join no pair.
    """

    def __init__(self, ids: list[int], alone: set[int]):
        n = len(ids)
        self.base = base = max(ids, default=-1) + 1
        self.left, self.right, self.first, self.length = [], [], [], []
        symbol = list(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # Where each pair stands. Of equal symbols in a row every neighbouring two are noted.
        places: dict[tuple[int, int], set[int]] = defaultdict(set)
        for i in range(n - 1):
            if symbol[i] not in alone and symbol[i + 1] not in alone:
                places[symbol[i], symbol[i + 1]].add(i)

        def free(pair: tuple[int, int], at: set[int]) -> list[int]:
            """Places of a pair that do not overlap, from the left."""
            if pair[0] != pair[1]:
                return sorted(at)
            chosen, taken = [], -1
            for i in sorted(at):
                if i != taken:
                    chosen.append(i)
                    taken = after[i]
            return chosen

        # Most frequent first; ties go to the pair of the earliest symbols.
        queue = [(-len(at), pair) for pair, at in places.items() if len(at) > 1]
        heapq.heapify(queue)
        while queue:
            size, pair = heapq.heappop(queue)
            at = places.get(pair)
            if at is None or len(at) < 2:
                continue
            chosen = free(pair, at) if pair[0] == pair[1] or len(at) == -size else at
            if len(chosen) != -size:
                if len(chosen) > 1:
                    heapq.heappush(queue, (-len(chosen), pair))
                continue
            a, b = pair
            new = base + len(self.left)
            del places[pair]
            touched = set()
            for i in chosen:
                j = after[i]
                h, k = before[i], after[j]
                if h >= 0 and symbol[h] not in alone:
                    self.forget(places, (symbol[h], a), h)
                    places[symbol[h], new].add(h)
                    touched.add((symbol[h], new))
                if k < n and symbol[k] not in alone:
                    self.forget(places, (b, symbol[k]), j)
                    places[new, symbol[k]].add(i)
                    touched.add((new, symbol[k]))
                symbol[i] = new
                after[i] = k
                if k < n:
                    before[k] = i
            length = self.length
            self.left.append(a)
            self.right.append(b)
            self.first.append(chosen[0])
            length.append((1 if a < base else length[a - base]) + (1 if b < base else length[b - base]))
            for other in touched:
                now = places.get(other)
                if now is not None and len(now) > 1:
                    heapq.heappush(queue, (-len(now), other))
        self.top, self.top_at = [], []
        i = 0
        while i < n:
            self.top.append(symbol[i])
            self.top_at.append(i)
            i = after[i]

    @staticmethod
    def forget(places: dict, pair: tuple[int, int], at: int) -> None:
        held = places.get(pair)
        if held is not None:
            held.discard(at)
            if not held:
                del places[pair]

    def words(self, symbol: int) -> int:
        return 1 if symbol < self.base else self.length[symbol - self.base]

    def derived(self, least: int) -> dict[int, list[int]]:
        """Places of every symbol that derives at least `least` words, in the order of its making, last first."""
        found: dict[int, list[int]] = defaultdict(list)
        for s, at in zip(self.top, self.top_at):
            if self.words(s) >= least:
                found[s].append(at)
        for k in range(len(self.left) - 1, -1, -1):
            own = found.get(self.base + k)
            if own:
                a, b = self.left[k], self.right[k]
                shift = self.words(a)
                if shift >= least:
                    found[a].extend(own)
                if self.words(b) >= least:
                    found[b].extend([at + shift for at in own])
        return found


class Stretch:
    """Words in a row, where their seeds occur, and how far they go on with a period."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        self.seeds = seed_hashes(ids)
        self.by_seed = np.argsort(self.seeds, kind="stable")
        values, self.kind, sizes = np.unique(self.seeds, return_inverse=True, return_counts=True)
        self.ends = np.cumsum(sizes)
        self.begins = self.ends - sizes

    def occurrences(self, c: int, start: int, stop: int) -> np.ndarray:
        """Where within [start, stop) the seed at `c` occurs, in order."""
        k = self.kind[c]
        at = self.by_seed[self.begins[k] : self.ends[k]]
        return at[np.searchsorted(at, start) : np.searchsorted(at, stop - SEED, "right")]

    def forward(self, i: int, q: int, stop: int) -> int:
        """First place from `i` on whose word differs from the one `q` later, or `stop - q`."""
        ids, step = self.ids, 64
        while i < stop - q:
            until = min(i + step, stop - q)
            differ = ids[i:until] != ids[i + q : until + q]
            k = int(differ.argmax())
            if differ[k]:
                return i + k
            i, step = until, step * 4
        return i

    def backward(self, i: int, q: int, start: int) -> int:
        """Lowest place down to `start` from which words agree with those `q` later up to `i`."""
        ids, step = self.ids, 64
        while i > start:
            since = max(i - step, start)
            differ = (ids[since:i] != ids[since + q : i + q])[::-1]
            k = int(differ.argmax())
            if differ[k]:
                return i - k
            i, step = since, step * 4
        return i

    def crossing(self, start: int, boundary: int, stop: int) -> list[tuple[int, int, int]]:
        """Runs (start, end, period) within [start, stop) that hold the words on both sides of `boundary`.

        A run has eight words before or after the boundary, and these occur again in it a period
        away. It goes on for a period on one side at least, so the seed at that end must return,
        too. What is left is tried from near to far, leaving out multiples of a known period.
        """
        tried: list[tuple[int, int, int]] = []
        seeds = self.seeds
        for c in (boundary, boundary - SEED):
            if c < start or c + SEED > stop:
                continue
            at = self.occurrences(c, start, stop)
            if len(at) < 2:
                continue
            q, low = np.abs(at - c), np.minimum(at, c)
            fits = (q > 0) & (LEAST_PERIODS * q <= stop - start)
            q, low = q[fits], low[fits]
            right = low + np.maximum(q - SEED, 0)
            on, back = right + q + SEED <= stop, low - q >= start
            for part in (1, 2, 3):
                right = low + np.maximum(part * q // 3 - SEED, 0)
                on &= seeds[right] == seeds[np.minimum(right + q, len(seeds) - 1)]
                left = np.maximum(low - part * q // 3, 0)
                back &= seeds[left] == seeds[left + q]
            likely = np.flatnonzero(on | back)
            likely = likely[np.argsort(q[likely], kind="stable")]
            q, low = q[likely], low[likely]
            for known in tried:
                q, low = beyond(q, low, *known)
            while len(q):
                period, i = int(q[0]), int(low[0])
                known = self.backward(i, period, start), self.forward(i, period, stop) + period, period
                tried.append(known)
                q, low = beyond(q[1:], low[1:], *known)
        long = [(b, e, p) for b, e, p in tried if e - b >= max(LEAST_LENGTH, LEAST_PERIODS * p)]
        return least_periods([(b, e, p) for b, e, p in long if b < boundary < e])


def beyond(q: np.ndarray, low: np.ndarray, begin: int, end: int, period: int) -> tuple[np.ndarray, np.ndarray]:
    """The candidates that are no multiples of a known period within its words."""
    rest = (q % period != 0) | (low < begin) | (low + q + SEED > end)
    return q[rest], low[rest]


def least_periods(runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Each stretch once, with its smallest period."""
    kept: list[tuple[int, int, int]] = []
    for begin, end, q in sorted(set(runs), key=lambda r: (r[2], r[0])):
        if not any(q % p == 0 and b <= begin and end <= e for b, e, p in kept):
            kept.append((begin, end, q))
    return kept


def merged(runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Stretches of one period that overlap by a period, as one; by start, then period."""
    out: list[tuple[int, int, int]] = []
    for begin, end, q in sorted(runs, key=lambda r: (r[2], r[0], r[1])):
        if out and out[-1][2] == q and begin <= out[-1][1] - q:
            out[-1] = (out[-1][0], max(end, out[-1][1]), q)
        else:
            out.append((begin, end, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def runs_of(ids: np.ndarray, returning: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs (start, end, period) of the words `ids`; `returning` marks seeds that occur again.

    The grammar covers the words of returning seeds; between stretches stands a separator.
    """
    covered = np.zeros(len(ids) + 1, np.int64)
    marks = np.flatnonzero(returning)
    np.add.at(covered, marks, 1)
    np.add.at(covered, marks + SEED, -1)
    inside = np.r_[False, np.cumsum(covered)[:-1] > 0, False]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    spans = [(b, e) for b, e in zip(edges[::2].tolist(), edges[1::2].tolist()) if e - b >= LEAST_LENGTH]
    if not spans:
        return []
    separator = int(ids.max()) + 1
    pieces, origin = [], []
    for b, e in spans:
        pieces += [ids[b:e], np.array([separator])]
        origin += [np.arange(b, e), np.array([-1])]
    words, origin = np.concatenate(pieces), np.concatenate(origin)
    dense = np.unique(words, return_inverse=True)[1]
    grammar = Grammar(dense.tolist(), {int(dense.max())})
    stretch = Stretch(dense)
    runs = []
    for s, at in grammar.derived(LEAST_LENGTH).items():
        begin = grammar.first[s - grammar.base]
        inner = begin + grammar.words(grammar.left[s - grammar.base])
        for b, e, q in stretch.crossing(begin, inner, begin + grammar.words(s)):
            runs += [(p + b - begin, p + e - begin, q) for p in at]
    # The rest of the text is a row of symbols: its boundaries, each within its stretch.
    ends = np.flatnonzero(words == separator).tolist()
    for at in grammar.top_at[1:]:
        k = bisect_left(ends, at)
        start = ends[k - 1] + 1 if k else 0
        if start < at < ends[k]:
            runs += stretch.crossing(start, at, ends[k])
    return [(int(origin[b]), int(origin[b]) + e - b, q) for b, e, q in merged(runs)]


def seed_hashes(ids: np.ndarray) -> np.ndarray:
    """Hashes of SEED words in a row; equal words always hash alike, and matches are compared by word."""
    if len(ids) < SEED:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        h = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        factor, width = np.uint64(0xD6E8FEB86659FD93), 1
        while width < SEED:
            h = h[:-width] * factor + h[width:]
            factor, width = factor * factor, 2 * width
    return h


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay: those that no run contains after its first period."""
    change = np.zeros(n + 1, np.int64)
    for begin, end, q in runs:
        change[begin + q] += 1
        change[end] -= 1
    return np.cumsum(change)[:-1] == 0


class Scanner:
    """Runs of the texts of a batch, with word numbers remembered between batches."""

    def __init__(self):
        self.numbers = defaultdict(count().__next__)

    def scan(self, texts: list[str | None]) -> tuple[list, list]:
        if len(self.numbers) > VOCABULARY:
            self.numbers = defaultdict(count().__next__)
        # Bytes split at exactly the six ASCII blanks.
        words = [(t or "").encode().split() for t in texts]
        all_runs, collapsed = [], []
        ends = np.cumsum([len(ws) for ws in words])
        flat = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(words)), np.int64, int(ends[-1]))
        returning = self.returning(flat, ends)
        for ws, end in zip(words, ends.tolist()):
            begin = end - len(ws)
            again = returning[begin:end]
            runs = runs_of(flat[begin:end], again) if again.any() else []
            if runs:
                ws = [w for w, keep in zip(ws, kept_words(len(ws), runs)) if keep]
            all_runs.append([{"start": b, "length": e - b, "period": q} for b, e, q in runs])
            collapsed.append(b" ".join(ws).decode())
        return all_runs, collapsed

    @staticmethod
    def returning(flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Marks of the seeds that occur twice in one text."""
        marks = np.zeros(len(flat), bool)
        seeds = seed_hashes(flat)
        if not len(seeds):
            return marks
        owner = np.repeat(np.arange(len(ends)), np.diff(np.r_[0, ends]))
        whole = np.flatnonzero(owner[: len(seeds)] == owner[SEED - 1 :])
        with np.errstate(over="ignore"):
            keys = seeds[whole] ^ (owner[whole].astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
        ordered = np.sort(keys)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if len(twice):
            near = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
            marks[whole[twice[near] == keys]] = True
        return marks


def find_runs(df: DataFrame, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """`df` with `runs` (start, length, period in words, by start, then period) and `collapsed`.

    Words are parted by ASCII blanks. A run has a smallest period q, at least LEAST_LENGTH words
    and three periods, and can be extended on neither side. `collapsed` has the words, joined by
    one blank, that no run contains after its first q words. A null, empty or blank text has no
    runs and collapses to nothing. Equal texts get equal results, repeated rows stay, an empty
    table gives no rows, and columns named like a result give way. A text is one task's work.
    """

    def start() -> Callable[[list], list]:
        scanner = Scanner()
        return lambda texts: list(scanner.scan(texts))

    return append_columns(df, text_col, FIELDS, start, keep_text)


def strongest(runs: Column) -> Column:
    """The run with most periods; of equal ones the first. Null without runs."""
    none = F.lit(None).cast(RUN)
    return F.aggregate(
        runs,
        none,
        lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best),
    )


def listed(runs: Column) -> Column:
    """Every run as a line `start,length,period`."""
    return F.array_join(F.transform(runs, lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")


def with_repeated_tail(text: Column, at: Column, divisor: Column) -> Column:
    """`text` whose words from number `at % n` on repeat, with period 1 + floor((n - a) / divisor).

    Words are joined by one blank. A text without words stays as it is.
    """
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def edited(ws: Column) -> Column:
        n = F.size(ws)
        a = at % n
        p = 1 + F.floor((n - a) / divisor)
        place = lambda i: F.when(i >= a, a + (i - a) % p).otherwise(i).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(ws, place(i))), " ")

    # One element, so that the words are taken from the text once.
    return F.get(F.transform(F.array(words), lambda ws: F.when(F.size(ws) > 0, edited(ws)).otherwise(text)), 0)

"""Benchmark decontamination by Wu-Manber search for benchmark word windows in whole texts.

The windows of all items are cut and made distinct by Spark. A slice of them, of bounded
number, becomes search tables that every task holds: for each pattern length a shift table over
blocks of two words, which lets the search skip the positions where no pattern can end, and
buckets by the last block, in which a direct comparison confirms an occurrence.
"""

from collections import defaultdict
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from gabarito.llm.arrays import merged
from gabarito.llm.common import append_columns, unused
from gabarito.staging import staged

WINDOW = 13
# Windows searched for in one pass; about 100 MB of tables in a Python worker.
PATTERNS_PER_PASS = 300_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Lower-cased bytes, with a blank for each byte that belongs to no word.
NORMAL = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)

SPAN = StructType([StructField("start", IntegerType(), False), StructField("end", IntegerType(), False)])
FIELDS = [
    StructField("n_words", LongType()),
    StructField("spans", ArrayType(SPAN, False)),
    StructField("items", ArrayType(StringType(), False)),
]


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(NORMAL).split()


class Patterns:
    """Search tables for patterns of one length in words."""

    def __init__(self, length: int):
        self.length = length
        self.block = min(2, length)
        self.longest = length - self.block + 1
        self.shift: dict[bytes, int] = {}
        self.buckets: dict[bytes, dict[bytes, list[str]]] = defaultdict(dict)

    def add(self, pattern: list[bytes], item: str | None) -> None:
        for end in range(self.block, self.length + 1):
            block = b" ".join(pattern[end - self.block : end])
            self.shift[block] = min(self.shift.get(block, self.longest), self.length - end)
        items = self.buckets[block].setdefault(b" ".join(pattern), [])
        if item is not None:
            items.append(item)

    def search(self, words: list[bytes]) -> Iterable[tuple[int, int, list[str]]]:
        """(start, end, items) of every occurrence, by its place in words."""
        length, block, longest = self.length, self.block, self.longest
        shift_of, size, at = self.shift.get, len(words), self.length
        while at <= size:
            last = words[at - 2] + b" " + words[at - 1] if block == 2 else words[at - 1]
            shift = shift_of(last, longest)
            if shift:
                at += shift
                continue
            found = self.buckets[last].get(b" ".join(words[at - length : at]))
            if found is not None:
                yield at - length, at, found
            at += 1


class Searcher:
    def __init__(self, patterns: Iterable[tuple[str, str | None]]):
        by_length: dict[int, Patterns] = {}
        for pattern, item in patterns:
            words = pattern.encode().split(b" ")
            if len(words) not in by_length:
                by_length[len(words)] = Patterns(len(words))
            by_length[len(words)].add(words, item)
        self.tables = list(by_length.values())

    def scan(self, text: str) -> tuple[int, list[dict], list[str]]:
        """Number of words, merged spans of hit words, and the items found."""
        words = words_of(text)
        spans, items = [], set()
        for table in self.tables:
            for start, end, found in table.search(words):
                items.update(found)
                if spans and start <= spans[-1][1] and start >= spans[-1][0]:
                    spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
                else:
                    spans.append((start, end))
        merged: list[dict] = []
        for start, end in sorted(spans):
            if merged and start <= merged[-1]["end"]:
                merged[-1]["end"] = max(end, merged[-1]["end"])
            else:
                merged.append({"start": start, "end": end})
        return len(words), merged, sorted(items)


def windows(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """Distinct (pattern, item): all runs of `window` words, or a shorter item's whole words."""
    words = F.regexp_extract_all(F.translate(F.col(text_col), UPPER, LOWER), F.lit(WORD), F.lit(0))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
    return (
        benchmark.select(F.col(item_col).cast("string").alias("item"), words.alias("words"))
        .where(F.size("words") > 0)
        .select("item", F.explode(F.transform(starts, lambda i: F.array_join(F.slice("words", i, window), " "))).alias("pattern"))
        .distinct()
    )


def scan(docs: DataFrame, text_col: str, patterns: list[tuple[str, str | None]]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(patterns)

    def start() -> Callable[[list], list]:
        searcher = Searcher(shared.value)
        return lambda texts: [list(c) for c in zip(*(searcher.scan(t or "") for t in texts))]

    return append_columns(docs, text_col, FIELDS, start)


def find_benchmark_words(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    patterns_per_pass: int = PATTERNS_PER_PASS,
) -> DataFrame:
    """`docs` with `n_words`, `spans` of hit words ([start, end) in words) and the `items` found.

    Texts are searched whole. A null or empty text has no words and no hits. An item without
    words has no windows; one with a null id marks words but is not listed; repeated items
    count once, and an empty benchmark hits nothing. Rows of `docs` stay as they are, repeated
    ones too; columns named like a result give way. The distinct windows are counted first
    (this runs a job). They reach the tasks in slices of `patterns_per_pass`; one slice is one
    pass over the documents without any shuffle. For more slices the documents are staged with
    a row number, by which the findings of further passes, only of rows with some, are joined.
    Every row is judged by its own text; `id_col` is not read.
    """
    found = windows(benchmark, item_col, item_text_col, window)
    passes = max(1, -(-found.count() // patterns_per_pass))
    row, spans, items = unused(docs, ["row", "spans", "items"])
    if passes > 1:
        docs = staged(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    scans = []
    for number in range(passes):
        part = found.where(F.pmod(F.xxhash64("pattern"), F.lit(passes)) == number) if passes > 1 else found
        patterns = [(r["pattern"], r["item"]) for r in part.select("pattern", "item").collect()]
        scans.append(scan(docs.select(row, text_col) if number else docs, text_col, patterns))
    first, *others = scans
    if not others:
        return first
    more = None
    for other in others:
        hits = other.where(F.size("spans") > 0).select(row, "spans", "items")
        more = hits if more is None else more.unionByName(hits)
    more = more.groupBy(row).agg(
        F.flatten(F.collect_list("spans")).alias(spans), F.flatten(F.collect_list("items")).alias(items)
    )
    empty = F.array()
    return (
        first.join(more, row, "left")
        .withColumn("spans", merged(F.concat("spans", F.coalesce(spans, empty.cast(ArrayType(SPAN))))))
        .withColumn("items", F.array_sort(F.array_distinct(F.concat("items", F.coalesce(items, empty.cast("array<string>"))))))
        .select([f"`{c}`" for c in first.columns if c != row])
    )


def n_hit(spans: str = "spans") -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])


def is_contaminated(n_words: str = "n_words", spans: str = "spans") -> Column:
    """Some word is hit, and at least one in twenty."""
    return (n_hit(spans) > 0) & (20 * n_hit(spans) >= F.col(n_words))

"""Uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

How many rows of each source partition go to each shard is drawn first, so that shard sizes
hold exactly and every assignment of rows to shards is equally likely. Then each partition is
permuted locally, its rows are dealt out by their place, exchanged, and permuted again.
"""

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gabarito.llm.common import without
from gabarito.staging import small_join, staged

ROWS_PER_BUCKET = 20_000
LEAST_BUCKETS = 4
GENERATOR_LIMIT = 1_000_000_000


def communication_matrix(sizes: list[int], shards: int, seed: int) -> np.ndarray:
    """Rows of each partition (first axis) for each shard; shard totals differ by one at most.

    A row is drawn without replacement from what the shards still lack, which is the
    multivariate hypergeometric law of a uniform shuffle.
    """
    total = sum(sizes)
    room = np.full(shards, total // shards, np.int64)
    room[: total % shards] += 1
    rng, rows = np.random.default_rng(seed), []
    for size in sizes:
        row, rest, left = np.zeros(shards, np.int64), int(size), int(room.sum())
        for k in range(shards):
            row[k] = drawn(rng, int(room[k]), left - int(room[k]), rest)
            rest, left = rest - int(row[k]), left - int(room[k])
        room -= row
        rows.append(row)
    return np.array(rows, np.int64).reshape(len(sizes), shards)


def drawn(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """A hypergeometric count. Where the generator does not reach, by inversion from the most likely count.

    The weights of the counts around it follow from exact ratios of neighbours; those beyond
    a weight of 1e-30 are left out, which is less than the generator's own rounding.
    """
    if good + bad < GENERATOR_LIMIT:
        return int(rng.hypergeometric(good, bad, sample)) if sample else 0
    low, high = max(0, sample - bad), min(good, sample)
    middle = min(max((good + 1) * (sample + 1) // (good + bad + 2), low), high)
    up = chain(middle, high, lambda k: ((good - k) * (sample - k), (k + 1) * (bad - sample + k + 1)), 1)
    down = chain(middle, low, lambda k: (k * (bad - sample + k), (good - k + 1) * (sample - k + 1)), -1)
    weights = np.concatenate([down[::-1], [1.0], up])
    place = np.searchsorted(np.cumsum(weights), rng.random() * weights.sum(), "right")
    return middle - len(down) + min(int(place), len(weights) - 1)


def chain(start: int, end: int, ratio: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], step: int) -> np.ndarray:
    """Weights of the counts after `start` up to `end`, relative to that of `start`, until they vanish."""
    parts, last, k, size = [], 1.0, start, 256
    while k != end and last > 1e-30:
        size = min(size * 2, abs(end - k))
        upper, lower = ratio(k + step * np.arange(size, dtype=np.float64))
        parts.append(last * np.cumprod(upper / lower))
        last, k = float(parts[-1][-1]), k + step * size
    return np.concatenate(parts) if parts else np.zeros(0)


def shuffle_into_shards(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = 16,
    seed: int = 17,
) -> DataFrame:
    """`df` without its text, with `size`, `text_crc32`, `law`, `shard`, `slot`, `grown_shard`.

    The law is `rows`: shard sizes differ by one row at most, and slots of a shard are 0, 1, ...
    without gaps in uniformly random order. `size` is the UTF-8 bytes of the text plus one;
    a null text has no bytes. `grown_shard` is null, as this law does not grow in place.
    Equal texts are shuffled apart like others, repeated rows and null ids count as rows, and an
    empty table gives no rows. Columns named like a result give way, all others stay.

    Rows are numbered once, in a table in the shared folder, so lost executors change nothing.
    Only row counts of the source partitions reach the driver. A shard of any size is permuted
    in buckets of random keys, whose counts give the slots at which they begin.
    """
    names = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    raw = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    # The other columns travel in one struct, so that none can be taken for a working column.
    others = [c for c in without(df, names).columns if c != text_col]
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("rest") if others else F.lit(None).alias("rest"),
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.xxhash64(F.lit(seed), F.monotonically_increasing_id(), F.col(id_col).cast("string")).alias("_key"),
    )
    # Local permutation: a partition sorted by a random key, numbered in that order.
    keyed = rows.sortWithinPartitions("_key").withColumn("_number", F.monotonically_increasing_id())
    keyed = staged(
        keyed.withColumns({"_part": F.shiftright("_number", 33), "_place": F.col("_number").bitwiseAND((1 << 33) - 1)}),
        "shuffle",
    )
    counts = sorted((r["_part"], r["count"]) for r in keyed.groupBy("_part").count().collect())
    total = sum(n for _, n in counts)
    matrix = communication_matrix([n for _, n in counts], shards, seed)
    spark = df.sparkSession
    ends = spark.createDataFrame(
        [(part, ends) for (part, _), ends in zip(counts, matrix.cumsum(axis=1).tolist())], "_part long, _from array<long>"
    )
    dealt = small_join(keyed, ends, ["_part"], spread=F.col("_place")).withColumn(
        "shard", F.size(F.filter("_from", lambda end: end <= F.col("_place")))
    )
    # Second permutation: by another random key, in buckets of its upper part.
    buckets = max(LEAST_BUCKETS, -(-total // (shards * ROWS_PER_BUCKET)))
    order = F.xxhash64(F.lit(seed + 1), "_number")
    dealt = dealt.withColumns({"_order": order, "_bucket": F.pmod(F.shiftrightunsigned(order, 20), F.lit(buckets)).cast("int")})
    return numbered(dealt, shards, buckets).select(
        *["rest.*"] * bool(others),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def numbered(dealt: DataFrame, shards: int, buckets: int) -> DataFrame:
    """`slot`: rows in earlier buckets of the shard, plus the place in the own one."""
    sizes = dealt.groupBy("shard", "_bucket").count()
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("shard", "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_begin"))
    inside = Window.partitionBy("shard", "_bucket").orderBy("_order", "_number")
    placed = dealt.withColumn("_place", F.row_number().over(inside) - 1)
    return small_join(placed, begins, ["shard", "_bucket"], spread=F.col("_number")).withColumn(
        "slot", F.col("_begin") + F.col("_place")
    )

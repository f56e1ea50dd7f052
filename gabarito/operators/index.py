"""Dense row numbers, heads and shards that never put one group, or the table, in one task."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gabarito.staging import pinned, small_join

# monotonically_increasing_id keeps the row position of a partition in its low 33 bits.
POSITION_BITS = 33


def dense_index(
    df: DataFrame,
    groups: list[str],
    order: list[str],
    index: str = "idx",
    size: str = "n_rows",
    partitions: int | None = None,
) -> DataFrame:
    """Key columns of `df` with a 0-based dense `index` per group and the group's `size`.

    `groups + order` must identify a row. The keys alone are range-partitioned, so one huge
    group spreads over many tasks, and pinned, because range bounds are re-sampled by every
    job. A row's number is its position in the partition plus the rows its group has in
    earlier partitions; that second part is one small row per (group, partition).
    """
    keys = [*groups, *order]
    ranged = df.select(*keys)
    ranged = ranged.repartitionByRange(partitions, *keys) if partitions else ranged.repartitionByRange(*keys)
    placed = pinned(
        ranged.sortWithinPartitions(*keys).withColumn("__at", F.monotonically_increasing_id())
    ).withColumn("__part", F.shiftright("__at", POSITION_BITS))
    parts = placed.groupBy(*groups, "__part").agg(
        F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first")
    )
    whole = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    before = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = parts.select(
        *groups,
        "__part",
        (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"),
        F.sum("__n").over(whole).alias(size),
    )
    numbered = small_join(placed, shifts, [*groups, "__part"], spread=F.col("__at"))
    return numbered.select(*keys, (F.col("__at") + F.col("__shift")).alias(index), size)


def with_dense_index(
    df: DataFrame, groups: list[str], order: list[str], index: str = "idx", size: str = "n_rows"
) -> DataFrame:
    """`df` with its dense index, joined back on the unique row key (no group is hot there).

    The index has a row per row of `df`, so it is never broadcast.
    """
    return df.join(dense_index(df, groups, order, index, size).hint("merge"), [*groups, *order])


def head_percent(indexed: DataFrame, percent: float, index: str = "idx", size: str = "n_rows") -> DataFrame:
    """First `ceil(n * percent / 100)` rows of every group of an indexed table."""
    if percent >= 100:
        return indexed
    wanted = F.least(F.ceil(F.col(size) * F.lit(float(percent)) / 100), F.col(size))
    return indexed.where(F.col(index) < wanted).withColumn(size, wanted)


def contiguous_shard(index: Column, size: Column, shards: int) -> Column:
    """Shard number when `size` rows are cut into runs, the first ones taking the extra rows."""
    short = F.floor(size / shards)
    extra = size % shards
    boundary = extra * (short + 1)
    late = extra + F.floor((index - boundary) / F.greatest(short, F.lit(1)))
    return F.when(index < boundary, F.floor(index / (short + 1))).otherwise(late).cast("int")


def round_robin_shard(index: Column, shards: int) -> Column:
    return F.pmod(index, F.lit(shards)).cast("int")


def prompt_ids(items: DataFrame, n_experiments: int, benchmarks: list[str], first: int = 0) -> DataFrame:
    """Sequential `id` over (benchmark in list order, idx, experiment), by arithmetic.

    Every item has the same number of experiments, so an id follows from its benchmark's
    offset; only the benchmarks' sizes are aggregated.
    """
    rank = F.array_position(F.array(*[F.lit(b) for b in benchmarks]), F.col("benchmark"))
    sizes = items.where(F.col("idx") == 0).select("benchmark", "n_rows").distinct()
    earlier = Window.partitionBy(F.lit(0)).orderBy("__rank").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("__rank", rank).select(
        "benchmark",
        (F.coalesce(F.sum("n_rows").over(earlier), F.lit(0)) * n_experiments).alias("__offset"),
    )
    numbered = small_join(items, offsets, ["benchmark"], spread=F.col("idx"))
    position = F.col("idx") * n_experiments + F.col("experiment")
    return numbered.withColumn("id", F.col("__offset") + position + first).drop("__offset")


def renumber(df: DataFrame, order: list[str], first: int = 1, column: str = "id") -> DataFrame:
    """Fresh sequential ids in the order of a unique key, which may contain the old id."""
    indexed = with_dense_index(df, [], order, "__idx", "__n")
    return indexed.withColumn(column, F.col("__idx") + first).drop("__idx", "__n")

"""Few-shot examples: seeded positions, the few rows behind them, and their attachment.

A seeded draw depends only on how many candidates there are. All rows of a benchmark
therefore share the same ranks `r` over the rows other than themselves, and row `q` takes
row `r` when `r < q`, else row `r + 1`. At most `2 * n_shots` rows per benchmark and
experiment are ever used as shots: they are fetched and rendered once and travel as a small
side, so attaching shots shuffles nothing.
"""

import random

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gabarito.staging import small_join

# Seed of the first experiment; experiment i uses SEED + i (fixed value).
SEED = 42
# Hex digits of a digest that make a number, for draws that run in the JVM.
DIGITS = 15


def draw_ranks(sizes: DataFrame, n_shots: int, n_experiments: int, seed: int = SEED) -> DataFrame:
    """(benchmark, experiment, ranks) from (benchmark, n_rows), drawn without replacement."""

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def draw(n_rows: pd.Series, experiment: pd.Series) -> pd.Series:
        return pd.Series(
            [
                random.Random(seed + int(e)).sample(range(int(n) - 1), n_shots)
                for n, e in zip(n_rows, experiment)
            ]
        )

    return with_experiments(sizes, n_experiments).select(
        "benchmark", "experiment", draw("n_rows", "experiment").alias("ranks")
    )


def with_experiments(df: DataFrame, n_experiments: int) -> DataFrame:
    """One row per experiment."""
    return df.withColumn("experiment", F.explode(F.sequence(F.lit(0), F.lit(n_experiments - 1))))


def slots(ranks: DataFrame) -> DataFrame:
    """One row per drawn rank and each of the two rows (`idx`) it can stand for."""
    drawn = ranks.select("benchmark", "experiment", F.posexplode("ranks").alias("pos", "rank"))
    return drawn.withColumn("idx", F.explode(F.array(F.col("rank"), F.col("rank") + 1)))


def mark_drawn(items: DataFrame, ranks: DataFrame, column: str = "drawn") -> DataFrame:
    """Flag the few items any draw can use, so that a table laid out by the flag serves them alone."""
    # (benchmark, idx) names one item, so no key is hot and nothing has to be spread.
    few = slots(ranks).select("benchmark", "idx").distinct().withColumn(column, F.lit(True))
    marked = small_join(items, few, ["benchmark", "idx"], "left")
    return marked.withColumn(column, F.coalesce(column, F.lit(False)))


def shot_sides(pool: DataFrame, ranks: DataFrame, shot: Column) -> DataFrame:
    """(benchmark, experiment, pairs): per drawn rank the row at it and the row after it."""
    # A key is one item here too.
    found = small_join(
        pool.select("benchmark", "idx", shot.alias("shot")), slots(ranks), ["benchmark", "idx"]
    )
    low = F.any_value(F.when(F.col("idx") == F.col("rank"), F.col("shot")), F.lit(True))
    high = F.any_value(F.when(F.col("idx") > F.col("rank"), F.col("shot")), F.lit(True))
    pairs = found.groupBy("benchmark", "experiment", "pos", "rank").agg(
        low.alias("low"), high.alias("high")
    )
    return pairs.groupBy("benchmark", "experiment").agg(
        F.sort_array(F.collect_list(F.struct("pos", "rank", "low", "high"))).alias("pairs")
    )


def with_shots(items: DataFrame, ranks: DataFrame, shot: Column, pool: DataFrame | None = None) -> DataFrame:
    """Every item once per experiment, with `shots`: the drawn rows, in draw order.

    `items` needs benchmark and a dense idx; `shot` is what to take along from a drawn row.
    `pool` is where drawn rows are looked up, by default all items.
    """
    sides = shot_sides(items if pool is None else pool, ranks, shot)
    joined = small_join(items, sides, ["benchmark"], spread=F.col("idx"))
    picked = F.transform(
        "pairs", lambda p: F.when(p["rank"] < F.col("idx"), p["low"]).otherwise(p["high"])
    )
    return joined.withColumn("shots", picked).drop("pairs")


def without_shots(items: DataFrame, n_experiments: int, shot: Column) -> DataFrame:
    """The zero-shot form of `with_shots`."""
    none = F.filter(F.array(shot), lambda s: F.lit(False))
    return with_experiments(items, n_experiments).withColumn("shots", none)


def row_number_of(run_seed: int, benchmark: Column, row: Column, experiment: Column, step: Column) -> Column:
    """A 60-bit number that looks random, the same whenever it is asked for."""
    name = F.concat_ws(":", F.lit(str(run_seed)), benchmark, *[c.cast("string") for c in (experiment, row, step)])
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, DIGITS), 16, 10).cast("long")


def row_ranks(n_rows: Column, benchmark: Column, row: Column, experiment: Column, n_shots: int, run_seed: int) -> Column:
    """Distinct ranks of a row's own draw: every ordered choice of `n_shots` other rows is equally likely.

    Floyd's sampling: step i draws a rank up to the last one it may use. A new rank goes to the
    front; a rank that is there already is kept, and the last one is put behind it. So k draws
    give a uniform sample in uniform order, without a list of the other rows. The remainder of a
    60-bit number favours no rank by more than a row count in 2^60. Too few other rows fail the job.
    """
    others = n_rows - 1
    steps = F.transform(
        F.sequence(F.lit(0), F.lit(n_shots - 1)),
        lambda i: F.struct(
            (others - n_shots + i).alias("last"),
            (row_number_of(run_seed, benchmark, row, experiment, i) % (others - n_shots + i + 1)).alias("rank"),
        ),
    )

    def step(chosen: Column, s: Column) -> Column:
        at = F.array_position(chosen, s["rank"]).cast("int")
        behind = F.concat(F.slice(chosen, F.lit(1), at), F.array(s["last"]), F.slice(chosen, at + 1, F.size(chosen)))
        return F.when(at > 0, behind).otherwise(F.concat(F.array(s["rank"]), chosen))

    ranks = F.aggregate(steps, F.array().cast("array<bigint>"), step)
    short = F.raise_error(F.concat(F.lit("too few rows to draw shots from: "), n_rows.cast("string")))
    return F.when(others < n_shots, short.cast("array<bigint>")).otherwise(ranks)


def with_shots_per_row(
    items: DataFrame, n_shots: int, n_experiments: int, run_seed: int, shot: Column
) -> DataFrame:
    """Like `with_shots`, every row drawing its own shots (the unseeded mode).

    The draw is a function of `run_seed` and the row, so a lost task redraws the same shots.
    Every row asks for itself and for its shots. The requests are looked up by
    (benchmark, idx), which spreads a large benchmark, and what is found goes to the row that
    asked in one exchange. Neither side is small, whatever a staged table's files weigh, so
    the lookup is never broadcast. `items` is read twice and should be a staged table.
    """
    ranks = row_ranks(
        F.col("n_rows"), F.col("benchmark"), F.col("idx"), F.col("experiment").cast("long"), n_shots, run_seed
    )
    keys = with_experiments(items.select("benchmark", "idx", "n_rows"), n_experiments)
    places = F.transform(ranks, lambda rank: F.when(rank < F.col("idx"), rank).otherwise(rank + 1))
    asked = F.concat(F.array(F.col("idx").cast("long")), places)
    requests = keys.select("benchmark", F.col("idx").alias("__q"), "experiment", F.posexplode(asked).alias("__pos", "__idx"))
    row = F.struct(*[F.col(f"`{c}`") for c in items.columns])
    known = items.select(F.col("benchmark"), F.col("idx").cast("long").alias("__idx"), row.alias("__row"), shot.alias("__shot"))
    found = requests.join(known.hint("merge"), ["benchmark", "__idx"])
    own = F.any_value(F.when(F.col("__pos") == 0, F.col("__row")), F.lit(True)).alias("__row")
    drawn = F.collect_list(F.when(F.col("__pos") > 0, F.struct("__pos", "__shot")))
    met = found.groupBy("benchmark", "__q", "experiment").agg(own, F.sort_array(drawn).alias("__drawn"))
    return met.select("__row.*", "experiment", F.col("__drawn.__shot").alias("shots"))

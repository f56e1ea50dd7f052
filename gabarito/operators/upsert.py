"""Replace what a new batch covers, keep the rest."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gabarito.staging import small_join

ANSWER_KEYS = ["model_name", "benchmark"]


def without_keys(old: DataFrame, new: DataFrame, keys: list[str], spread: Column | None = None) -> DataFrame:
    """Rows of `old` whose keys do not occur in `new`.

    `spread` tells the rows of one key apart, by default all their other columns.
    """
    others = [c for c in old.columns if c not in keys]
    if spread is None and others:
        spread = F.struct(*[F.col(f"`{c}`") for c in others])
    return small_join(old, new.select(*keys).distinct(), keys, "left_anti", spread)


def upsert(
    old: DataFrame | None, new: DataFrame, keys: list[str] | None = None, spread: Column | None = None
) -> DataFrame:
    """Old rows outside the batch's keys, then the batch.

    `keys` decides what a batch replaces: `(model_name, benchmark)` only the pairs it holds,
    `model_name` everything its models had. The batch's distinct keys are the small side.
    """
    if old is None:
        return new
    kept = without_keys(old, new, keys or ANSWER_KEYS, spread)
    return kept.unionByName(new, allowMissingColumns=True)


def upsert_eval(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """A model scored again loses all its earlier eval rows."""
    return upsert(old, new, ["model_name"])


def keep_last(df: DataFrame, keys: list[str], sequence: Column) -> DataFrame:
    """Row with the highest `sequence` per key; a map-side aggregate, so repeats stay cheap."""
    last = F.max_by(F.struct("*"), sequence).alias("__row")
    return df.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(last).select("__row.*")


def upsert_board(
    old: DataFrame | None, new: DataFrame, overwrite: bool = True, sequence: str | None = None
) -> DataFrame:
    """Board rows by `model_name`: overwritten, or appended.

    An overwrite also removes repeats, keeping the last; `sequence` says which row is later,
    and a row of the new batch is always later than an old one. Rows that tie in that are told
    apart by their content, so the outcome never depends on the order of tasks.
    """
    key = "model_name"
    if old is None:
        return new
    if not overwrite:
        return old.unionByName(new, allowMissingColumns=True)
    kept = without_keys(old, new, [key]).withColumn("__new", F.lit(0))
    both = kept.unionByName(new.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    content = F.to_json(F.struct(*[F.col(f"`{c}`") for c in both.columns]))
    order = F.struct("__new", *([sequence] if sequence else []), content)
    return keep_last(both, [key], order).drop("__new")


def skip_existing(models: DataFrame, board: DataFrame, key: str = "model_name") -> DataFrame:
    """Models that are not on the board yet; a model is one row, so no key is hot."""
    return small_join(models, board.select(F.col("model_name").alias(key)).distinct(), [key], "left_anti")

"""Job 1: benchmark tables -> prompts."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gabarito.functions.prompts import build_chat, escaped_block
from gabarito.operators.clean import bench_id, clean_benchmark
from gabarito.operators.index import dense_index, head_percent, prompt_ids
from gabarito.operators.models import Renderer, group_models, pack_prompts
from gabarito.operators.shots import (
    SEED,
    draw_ranks,
    mark_drawn,
    with_shots,
    with_shots_per_row,
    without_shots,
)
from gabarito.registry import benchmark, pattern_of
from gabarito.schemas import PROMPTS
from gabarito.sources.tables import SOURCE_ORDER, load_benchmark
from gabarito.staging import pinned, staged


def cleaned_sources(sources: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: clean_benchmark(rows, benchmark(name)) for name, rows in sources.items()}


def rendered_items(cleaned: dict[str, DataFrame], order: list[str]) -> DataFrame:
    """Clean rows of all benchmarks in one shape: benchmark, row key, label, turns."""
    parts = [
        rows.select("benchmark", *order, "label", benchmark(name).template(rows).alias("turns"))
        for name, rows in cleaned.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def staged_keys(cleaned: dict[str, DataFrame], order: list[str]) -> DataFrame:
    """Benchmark and row key of all clean rows, without their texts."""
    keys = reduce(DataFrame.unionByName, (rows.select("benchmark", *order) for rows in cleaned.values()))
    return staged(keys, "keys")


def heads(cleaned: dict[str, DataFrame], order: list[str], percent: float) -> tuple[dict[str, DataFrame], DataFrame]:
    """The first `percent` of every benchmark's rows, and their index, made from staged keys.

    Only the last kept key of each benchmark is collected, to cut the rows where they are read.
    """
    index = pinned(head_percent(dense_index(staged_keys(cleaned, order), ["benchmark"], order), percent))
    last = {r.benchmark: r.last for r in index.groupBy("benchmark").agg(F.max(F.struct(*order)).alias("last")).collect()}

    def head(name: str, rows: DataFrame) -> DataFrame:
        if name not in last:
            return rows.where(F.lit(False))
        return rows.where(F.struct(*order) <= F.struct(*[F.lit(last[name][c]).alias(c) for c in order]))

    return {name: head(name, rows) for name, rows in cleaned.items()}, index


def staged_items(
    sources: dict[str, DataFrame],
    order: list[str],
    percent: float,
    draw: Callable[[DataFrame], DataFrame | None],
) -> tuple[DataFrame, DataFrame | None]:
    """Items with dense `idx`, group size and `id_bench`, and the ranks drawn for them.

    The keys are read first and numbered; a head is cut by key before anything is rendered. The
    texts are then read, rendered, moved to their numbers and written once each. The index has
    a row per item, so it is never broadcast. The few items that a draw can use are laid out in
    a partition of their own.
    """
    cleaned = cleaned_sources(sources)
    if percent < 100:
        cleaned, index = heads(cleaned, order, percent)
    else:
        index = dense_index(staged_keys(cleaned, order), ["benchmark"], order)
    ranks = draw(index.where(F.col("idx") == 0).select("benchmark", "n_rows"))
    numbered = rendered_items(cleaned, order).join(index.hint("merge"), ["benchmark", *order])
    items = numbered.withColumn("id_bench", bench_id())
    if ranks is None:
        return staged(items, "items"), None
    ranks = pinned(ranks)
    return staged(mark_drawn(items, ranks), "items", ["drawn"]), ranks


def seeded_shot() -> Column:
    """What the few drawn rows bring along: id, turns, and their escaped block, made here once."""
    return F.struct("id_bench", "turns", escaped_block(F.col("turns")).alias("block"))


def build_prompts(
    sources: dict[str, DataFrame],
    models: list[tuple[str, str, str]],
    order: list[str] | None = None,
    n_shots: int = 0,
    n_experiments: int = 1,
    percent: float = 100,
    structured: bool = False,
    fixed_seed: bool = True,
    seed: int = SEED,
    chat_templates: dict[str, Renderer] | None = None,
    ranks: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The prompts table of `sources` (benchmark name -> source rows with a unique `order` key).

    Ranks are drawn by seed, unless a function of (benchmark, n_rows) gives them; without a
    fixed seed every row draws its own. Planning runs jobs: the keys are numbered, the draw is
    made and the items are staged before this returns.
    """
    if not 0 <= percent <= 100:
        raise ValueError(f"percent must be between 0 and 100, got {percent}")
    groups = group_models(models)

    def draw(sizes: DataFrame) -> DataFrame | None:
        if n_shots == 0 or not fixed_seed:
            return None
        return ranks(sizes) if ranks else draw_ranks(sizes, n_shots, n_experiments, seed)

    items, drawn = staged_items(sources, order or SOURCE_ORDER, percent, draw)
    shot = F.struct("id_bench", "turns")
    blocks = None
    if n_shots == 0:
        rows = without_shots(items, n_experiments, shot)
    elif drawn is None:
        rows = with_shots_per_row(items, n_shots, n_experiments, seed, shot)
    else:
        rows = with_shots(items, drawn, seeded_shot(), pool=items.where("drawn"))
        blocks = F.col("shots.block")
    shots = F.col("shots.turns")
    pattern = pattern_of(F.col("benchmark"))
    chat = build_chat(F.col("turns"), shots, pattern, structured)
    packed = pack_prompts(chat, F.col("turns"), shots, pattern, groups, structured, chat_templates, blocks)
    rows = rows.withColumns({"prompt": packed, "shot_indices": F.col("shots.id_bench")})
    return prompt_ids(rows, n_experiments, list(sources)).select(*PROMPTS.names)


def build_prompts_from(
    spark: SparkSession, root: str, names: list[str], models: list[tuple[str, str, str]], **options
) -> DataFrame:
    """`build_prompts` over the benchmark folders below `root`."""
    return build_prompts({n: load_benchmark(spark, root, benchmark(n)) for n in names}, models, **options)

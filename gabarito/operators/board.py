"""From the eval table to scores, pivots, model metadata and the wide leaderboard."""

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gabarito.functions.text import joined_or_null, round3
from gabarito.registry import AREAS, BOARD, DEFAULT_METRICS, DESCRIPTIONS, board_table
from gabarito.schemas import METRICS
from gabarito.staging import small_join

# Columns of the published board (fixed values): metadata in its order, and the overall mean.
MODEL_COLUMNS = [
    "T",
    "Modelo",
    "Tipo",
    "Arquitetura",
    "Tipo de Peso",
    "Precisão",
    "Licença",
    "#Params (B)",
    "Hub Likes",
    "Disponível no hub",
    "SHA do modelo",
]
OVERALL = "Média Geral"


def with_board_info(
    eval_rows: DataFrame, dim: DataFrame | None = None, spread: str = "model_name"
) -> DataFrame:
    """Area, display column and metric names by benchmark; unknown benchmarks keep nulls.

    The default dimension is a fixed list of a few dozen rows; another one is measured.
    """
    if dim is None:
        return eval_rows.join(F.broadcast(board_table(eval_rows.sparkSession)), "benchmark", "left")
    return small_join(eval_rows, dim, ["benchmark"], "left", spread=F.col(spread))


def score(metrics: Column) -> Column:
    """Mean of a benchmark's declared metrics that have a value, 0.0 when none has."""
    declared = F.coalesce(metrics, F.array(*map(F.lit, DEFAULT_METRICS)))
    values = F.array_compact(
        F.array(*[F.when(F.array_contains(declared, m), F.col(m)) for m in METRICS])
    )
    total = F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
    return F.coalesce(F.try_divide(total, F.size(values)), F.lit(0.0))


def bench_scores(eval_rows: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """Eval rows with area, display column and score."""
    return with_board_info(eval_rows, dim).withColumn("score", score(F.col("metrics")))


def benchmark_exists(scores: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """For every benchmark of the board: did any model score above zero on it?"""
    known = dim if dim is not None else board_table(scores.sparkSession)
    ran = scores.groupBy("benchmark").agg(F.bool_or(F.col("score") > 0).alias("has_scores"))
    return known.select("benchmark").join(ran, "benchmark", "left").select(
        "benchmark", F.coalesce("has_scores", F.lit(False)).alias("has_scores")
    )


def existing_benchmarks(scores: DataFrame) -> DataFrame:
    """Mapped benchmarks someone scored above zero on; at most one row per board benchmark."""
    mapped = scores.where(F.col("area").isNotNull() & (F.col("score") > 0))
    return mapped.select("benchmark").distinct()


def on_board(scores: DataFrame) -> DataFrame:
    """Scores of existing benchmarks."""
    existing = existing_benchmarks(scores)
    return small_join(scores, existing, ["benchmark"], "left_semi", spread=F.col("model_name"))


def area_means(scores: DataFrame) -> DataFrame:
    """Long form: mean score per (model, area) over existing benchmarks."""
    return on_board(scores).groupBy("model_name", "area").agg(F.avg("score").alias("mean_score"))


def first_scores(scores: DataFrame, sequence: str | None = None) -> DataFrame:
    """One score per (model, benchmark), the earliest by `sequence`."""
    pick = F.min_by("score", sequence) if sequence else F.any_value("score")
    return scores.groupBy("model_name", "benchmark").agg(pick.alias("score"))


def overall_means(scores: DataFrame, sequence: str | None = None) -> DataFrame:
    """Mean over all existing benchmarks; one a model did not run counts as zero."""
    n = existing_benchmarks(scores).agg(F.count(F.lit(1))).scalar()
    per_benchmark = first_scores(on_board(scores), sequence)
    ran = per_benchmark.groupBy("model_name").agg(F.sum("score").alias("total"))
    models = scores.select("model_name").distinct()
    return models.join(ran, "model_name", "left").select(
        "model_name", F.coalesce(F.try_divide("total", n), F.lit(0.0)).alias("overall_mean")
    )


def metric_pivot(eval_rows: DataFrame, benchmarks: list[str]) -> DataFrame:
    """Model x benchmark table of the headline metric at three decimals, and its row mean."""
    first_metric = F.coalesce(F.get(F.col("metrics"), F.lit(0)), F.lit(DEFAULT_METRICS[0]))
    headline = F.coalesce(*[F.when(first_metric == m, F.col(m)) for m in METRICS], F.lit(0.0))
    cells = with_board_info(eval_rows).select("model_name", "benchmark", round3(headline).alias("cell"))
    columns = [F.any_value(F.when(F.col("benchmark") == b, F.col("cell")), F.lit(True)).alias(b) for b in benchmarks]
    shown = F.when(F.col("benchmark").isin(benchmarks), F.col("cell"))
    return cells.groupBy(F.col("model_name").alias("Model")).agg(*columns, round3(F.avg(shown)).alias("avg"))


def parse_error_pivot(eval_rows: DataFrame, benchmarks: list[str]) -> DataFrame:
    """Model x benchmark table of unparsed shares at three decimals."""
    columns = [
        F.any_value(F.when(F.col("benchmark") == b, round3(F.col("non_parsed_rate"))), F.lit(True)).alias(b)
        for b in benchmarks
    ]
    return eval_rows.groupBy(F.col("model_name").alias("Model")).agg(*columns)


def unmapped_benchmarks(eval_rows: DataFrame) -> DataFrame:
    """Scored benchmarks the board has no place for, with how many models ran them."""
    info = with_board_info(eval_rows)
    return (
        info.where(F.col("area").isNull())
        .groupBy("benchmark")
        .agg(F.count_distinct("model_name").alias("n_models"))
    )


def custom_flags(spark, paths: list[str], flags: list[str]) -> DataFrame | None:
    """(model_name, is_custom) from two parallel job arguments; null when they do not match up."""
    if len(paths) != len(flags):
        warnings.warn(f"{len(flags)} custom flags for {len(paths)} model paths: ignored", stacklevel=2)
        return None
    rows = [(p.rsplit("/", 1)[-1], f.lower() == "true") for p, f in zip(paths, flags)]
    return spark.createDataFrame(rows, "model_name string, is_custom boolean")


def model_metadata(
    models: DataFrame,
    overrides: DataFrame,
    fetched: DataFrame | None = None,
    flags: DataFrame | None = None,
) -> DataFrame:
    """The board's metadata columns: fixed override, else fetched value, else default.

    `models` has model_name; `overrides` has model_name, model_id and any of t, modelo, tipo,
    arquitetura (array or text), tipo_peso, precisao, licenca, params_b, hub_likes,
    disponivel_no_hub, sha_modelo; `fetched` has model_id and hub_id, sha, likes, private,
    license, architectures, precision, params_total, base_model (array), is_adapter.
    Models without a model_id are left out. A custom model's kind is never overridden.
    """
    known = overrides.where(F.col("model_id").isNotNull())
    rows = models.join(known, "model_name")
    empty = "model_id string, hub_id string, sha string, likes long, private boolean, license string, "
    empty += "architectures array<string>, precision string, params_total long, "
    empty += "base_model array<string>, is_adapter boolean"
    info = fetched if fetched is not None else models.sparkSession.createDataFrame([], empty)
    rows = rows.join(info, "model_id", "left")
    if flags is not None:
        rows = rows.join(flags, "model_name", "left")
    else:
        rows = rows.withColumn("is_custom", F.lit(False))
    custom = F.coalesce("is_custom", F.lit(False))
    base = F.get(F.col("base_model"), F.lit(0))
    tuned = F.coalesce((base != "") & (base != F.col("hub_id")), F.lit(False))

    def given(name: str, otherwise: Column) -> Column:
        return F.coalesce(F.col(name), otherwise) if name in overrides.columns else otherwise

    def kind(name: str, custom_name: str, tuned_name: str, base_name: str) -> Column:
        found = F.when(tuned, tuned_name).otherwise(base_name)
        return F.when(custom, custom_name).otherwise(given(name, found))

    architecture = joined_or_null(F.col("architectures"))
    if "arquitetura" in overrides.columns:
        own = F.col("arquitetura")
        is_list = overrides.schema["arquitetura"].dataType.typeName() == "array"
        architecture = F.coalesce(F.array_join(own, ",") if is_list else own, architecture)
    billions = F.coalesce(round3(F.col("params_total") / F.lit(1e9)), F.lit(0.0))
    # Board column -> content and its default.
    columns = {
        "T": kind("t", "Custom", "SFT", "Base"),
        "Modelo": given("modelo", F.coalesce("hub_id", "model_name")),
        "Tipo": kind("tipo", "Custom", "SFT: Supervised Finetuning", "Base"),
        "Arquitetura": architecture,
        "Tipo de Peso": given(
            "tipo_peso", F.when(F.coalesce("is_adapter", F.lit(False)), "Adapter").otherwise("Original")
        ),
        "Precisão": given("precisao", F.col("precision")),
        "Licença": given("licenca", F.coalesce("license", F.lit("unknown"))),
        "#Params (B)": given("params_b", billions),
        "Hub Likes": given("hub_likes", F.coalesce("likes", F.lit(0).cast("long"))),
        "Disponível no hub": given("disponivel_no_hub", F.coalesce(~F.col("private"), F.lit(False))),
        "SHA do modelo": given("sha_modelo", F.coalesce("sha", F.lit("unknown"))),
    }
    return rows.select("model_name", *[c.alias(n) for n, c in columns.items()])


def board_scores(scores: DataFrame, sequence: str | None = None) -> DataFrame:
    """Wide scores per model: every area, every display column, the overall mean.

    One aggregation by model with a fixed column list, so no pivot job runs. "Not run" and
    "scored zero" are both 0.0 here.
    """
    existing = existing_benchmarks(scores)
    n = existing.agg(F.count(F.lit(1))).scalar()
    flagged = existing.withColumn("__exists", F.lit(True))
    marked = small_join(scores, flagged, ["benchmark"], "left", spread=F.col("model_name"))
    exists = F.coalesce(F.col("__exists"), F.lit(False))

    def first(condition: Column) -> Column:
        value = F.when(condition, F.col("score"))
        if sequence:
            return F.min_by("score", F.when(condition, F.col(sequence)))
        return F.any_value(value, F.lit(True))

    areas = [
        F.coalesce(F.avg(F.when(exists & (F.col("area") == a), F.col("score"))), F.lit(0.0)).alias(a)
        for a in sorted(AREAS)
    ]
    columns = [F.coalesce(first(F.col("benchmark") == b), F.lit(0.0)).alias(c) for b, _, c in BOARD]
    # Benchmarks that do not exist score 0.0 for everyone, so the plain sum is over existing ones.
    wide = marked.groupBy("model_name").agg(*areas, *columns)
    total = sum((F.col(f"`{c}`") for _, _, c in BOARD), F.lit(0.0))
    return wide.withColumn(OVERALL, F.coalesce(F.try_divide(total, n), F.lit(0.0)))


def with_descriptions(board: DataFrame, compat: bool = False) -> DataFrame:
    """Constant description columns. Two of their names are also areas: those get a suffix here,
    or replace the area score in `compat` form.
    """
    taken = set() if compat else set(AREAS)
    return board.withColumns(
        {f"{n} (datasets)" if n in taken else n: F.lit(v) for n, v in DESCRIPTIONS.items()}
    )


def leaderboard(
    eval_rows: DataFrame, metadata: DataFrame, sequence: str | None = None, compat: bool = False
) -> DataFrame:
    """The wide board of the models that have metadata, keyed by `model_name`.

    Scores of the other models still decide which benchmarks exist. `Modelo` is for display: it
    is the hub's id where one is known, and two models may share it.
    """
    wide = board_scores(bench_scores(eval_rows), sequence)
    board = with_descriptions(metadata.join(wide, "model_name"), compat)
    return board.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in board_schema(compat)])


def board_schema(compat: bool = False) -> T.StructType:
    """Columns of the board, in order."""
    text, number = T.StringType(), T.DoubleType()
    kinds = {"#Params (B)": number, "Hub Likes": T.LongType(), "Disponível no hub": T.BooleanType()}
    columns = {c: kinds.get(c, text) for c in ["model_name", *MODEL_COLUMNS]}
    columns |= {c: number for c in [*sorted(AREAS), *[c for _, _, c in BOARD], OVERALL]}
    taken = set() if compat else set(AREAS)
    for name, value in DESCRIPTIONS.items():
        columns[f"{name} (datasets)" if name in taken else name] = number if isinstance(value, float) else text
    return T.StructType([T.StructField(c, kind) for c, kind in columns.items()])


def run_summary(models: DataFrame, board: DataFrame, overrides: DataFrame) -> DataFrame:
    """How many models of a run are processed, already on the board, or without metadata."""
    on = board.select("model_name", F.lit(True).alias("on_board")).distinct()
    known = overrides.where(F.col("model_id").isNotNull())
    known = known.select("model_name", F.lit(True).alias("known")).distinct()
    flagged = models.select("model_name").distinct().join(on, "model_name", "left").join(known, "model_name", "left")
    skipped = F.coalesce("on_board", F.lit(False))
    described = F.coalesce("known", F.lit(False))
    return flagged.agg(
        F.count_if(~skipped & described).alias("n_processed"),
        F.count_if(skipped).alias("n_skipped_existing"),
        F.count_if(~skipped & ~described).alias("n_skipped_unknown"),
    )

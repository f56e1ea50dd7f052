"""Job 4: eval + model metadata -> leaderboard."""

from pyspark.sql import DataFrame, SparkSession

from gabarito.operators.board import board_schema, leaderboard, model_metadata
from gabarito.operators.clean import exclude_models
from gabarito.operators.upsert import skip_existing, upsert_board
from gabarito.sources.tables import read_table, replace_table, table_exists, write_table
from gabarito.staging import pinned


def board_rows(
    eval_rows: DataFrame,
    overrides: DataFrame,
    fetched: DataFrame | None = None,
    flags: DataFrame | None = None,
    exclude: list[str] | None = None,
    board: DataFrame | None = None,
    overwrite: bool = False,
    compat: bool = False,
) -> DataFrame:
    """New board rows; without `overwrite` only of models that are not on `board`."""
    rows = exclude_models(eval_rows, exclude or [])
    models = rows.select("model_name").distinct()
    if board is not None and not overwrite:
        models = skip_existing(models, board)
    return leaderboard(rows, model_metadata(models, overrides, fetched, flags), compat=compat)


def store_board(
    spark: SparkSession, eval_rows: DataFrame, path: str, overrides: DataFrame, overwrite: bool = False, **options
) -> None:
    """Upsert the board at `path`: one row per `model_name`, whatever hub id it shows.

    `eval_rows`, a row per model and benchmark, are computed once, however often the board reads them.
    """
    eval_rows = pinned(eval_rows)
    schema = board_schema(options.get("compat", False))
    old = read_table(spark, path, schema) if table_exists(spark, path) else None
    new = board_rows(eval_rows, overrides, board=old, overwrite=overwrite, **options)
    if old is None:
        write_table(new, path)
    else:
        replace_table(upsert_board(old, new, overwrite), path)

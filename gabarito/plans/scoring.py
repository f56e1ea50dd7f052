"""Job 3: answers -> eval."""

from pyspark.sql import DataFrame, SparkSession

from gabarito.operators.metrics import evaluate
from gabarito.operators.upsert import upsert_eval
from gabarito.schemas import EVAL
from gabarito.sources.tables import read_table, replace_table, table_exists, write_table


def score_answers(answers: DataFrame, old_eval: DataFrame | None = None) -> DataFrame:
    """Eval rows of the answers, replacing earlier rows of the same models."""
    return upsert_eval(old_eval, evaluate(answers))


def store_eval(spark: SparkSession, answers: DataFrame, path: str) -> None:
    """Score and upsert into the eval table at `path`."""
    if table_exists(spark, path):
        replace_table(score_answers(answers, read_table(spark, path, EVAL)), path)
    else:
        write_table(score_answers(answers), path)

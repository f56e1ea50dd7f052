"""Job 2: prompts x models -> answers."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gabarito.operators.clean import string_columns
from gabarito.operators.index import renumber
from gabarito.operators.infer import Scorer, answer_prompts
from gabarito.operators.resume import score_resumable
from gabarito.operators.upsert import ANSWER_KEYS
from gabarito.schemas import ANSWERS
from gabarito.sources.csv import write_csv
from gabarito.sources.replacing import replace_owners
from gabarito.sources.tables import write_table
from gabarito.staging import small_join, staged


def answers_table(prompts: DataFrame, paths: list[str], scorer: Scorer, resume: str | None = None, **options) -> DataFrame:
    """Answers of the given models in the stored schema.

    With a folder `resume` answers are logged there while the models are asked, when this is
    called, and rows that an earlier, stopped call has logged are not asked again.
    """
    if resume:
        size = options.get("batch_size", 32)
        options["score"] = lambda rows: score_resumable(rows, scorer, resume, batch_size=size)
    rows = answer_prompts(prompts, paths, scorer, **options)
    return string_columns(rows, ["shot_indices"]).select(*ANSWERS.names)


def store_answers(answers: DataFrame, path: str) -> None:
    """Upsert by (model, benchmark): overwrite just the partitions the batch covers."""
    write_table(answers, path, ANSWER_KEYS)


def store_answers_by_model(spark: SparkSession, answers: DataFrame, path: str) -> None:
    """Upsert by model: what the batch's models had on other benchmarks goes, too.

    The batch is scored once, into a staged copy. Its partitions are overwritten first, then the
    other partitions of its models are removed; no other model's files are read or written. A
    run that stops in between is finished by the next one (`sources.replacing`).
    """
    replace_owners(answers, path, ANSWER_KEYS)


def export_answers(answers: DataFrame, path: str) -> None:
    """CSV form: ids renumbered from 1 in (model, benchmark, id) order, backslashes protected.

    The answers are staged once. Prompt ids run without gaps within a model and benchmark, so a
    group's offset gives the new ids; only where they do not are rows numbered by their key.
    """
    rows = staged(answers, "answers")
    groups = rows.groupBy(*ANSWER_KEYS).agg(F.min("id").alias("__first"), F.max("id").alias("__last"), F.count("*").alias("__n"))
    groups = staged(groups, "groups")
    if groups.where("__last - __first + 1 <> __n").isEmpty():
        before = Window.orderBy(*ANSWER_KEYS).rowsBetween(Window.unboundedPreceding, -1)
        shifts = groups.select(*ANSWER_KEYS, (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first") + 1).alias("__shift"))
        numbered = small_join(rows, shifts, ANSWER_KEYS, spread=F.col("id"))
        numbered = numbered.withColumn("id", F.col("id") + F.col("__shift")).select(rows.columns)
    else:
        numbered = renumber(rows, [*ANSWER_KEYS, "id"])
    write_csv(numbered, path, escape=True)

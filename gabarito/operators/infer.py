"""Answer generation with a caller-supplied scorer, batch by batch in the tasks."""

import re
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gabarito.functions.parsers import parse_answer, structured_fields
from gabarito.functions.text import mid_truncate, model_short_name, tag_body
from gabarito.operators.models import PROVIDERS, prompts_for_models, provider
from gabarito.registry import pattern_of

# Fixed value: how a failed call shows in a stored answer.
ERROR_PREFIX = "__API_ERROR__: "

# (model path, prompts) -> answers, same length; an exception in an answer's place fails that row.
Scorer = Callable[[str, Sequence[str]], Sequence[str | Exception]]

# A mistake in the scorer itself, which no repetition mends.
PROGRAMMING_ERRORS = (TypeError, NameError, AttributeError, ImportError, SyntaxError, AssertionError)


def caller(scorer: Scorer, attempts: int) -> Callable[[str, list[str]], list[tuple[str | None, str | None]]]:
    """(model path, prompts) -> (answer, error) of each prompt, failed ones called up to `attempts` times."""

    def once(path: str, prompts: list[str]) -> list[str | Exception]:
        try:
            answers = list(scorer(path, prompts))
        except PROGRAMMING_ERRORS:
            raise
        except Exception as e:
            return [e] * len(prompts)
        if len(answers) != len(prompts):
            problem = ValueError(f"scorer gave {len(answers)} answers for {len(prompts)} prompts")
            return [problem] * len(prompts)
        for answer in answers:
            if isinstance(answer, PROGRAMMING_ERRORS):
                raise answer
        return answers

    def call(path: str, prompts: list[str]) -> list[tuple[str | None, str | None]]:
        answers = once(path, prompts)
        for _ in range(attempts - 1):
            failed = [i for i, a in enumerate(answers) if isinstance(a, Exception)]
            if not failed:
                break
            together = len(failed) < len(prompts) or len(prompts) == 1
            groups = [failed] if together else [[i] for i in failed]
            for group in groups:
                for i, answer in zip(group, once(path, [prompts[i] for i in group])):
                    answers[i] = answer
        return [(None, str(a)) if isinstance(a, Exception) else (a, None) for a in answers]

    return call


def score_batches(df: DataFrame, scorer: Scorer, batch_size: int = 32, attempts: int = 3) -> DataFrame:
    """Adds `model_answer` and `error` to a table with `model_path` and `prompt`.

    A row that fails is called up to `attempts` times: its answer is then null and `error` says
    why. Rows that got an answer are never called again. A scorer reports a failed row with an
    exception in its place; when it raises instead, the whole call failed, and its rows are
    called one by one. Programming errors fail the job. Rows keep their order and every one
    comes back.
    """
    fields = [*df.schema.fields, T.StructField("model_answer", T.StringType())]
    schema = T.StructType([*fields, T.StructField("error", T.StringType())])

    call = caller(scorer, attempts)

    def run(pages: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for page in pages:
            page = page.reset_index(drop=True)
            answers = pd.Series([None] * len(page), dtype=object)
            errors = pd.Series([None] * len(page), dtype=object)
            for path, rows in page.groupby("model_path", sort=False).groups.items():
                rows = list(rows)
                for start in range(0, len(rows), batch_size):
                    part = rows[start : start + batch_size]
                    pairs = call(path, page.loc[part, "prompt"].tolist())
                    answers[part] = [a for a, _ in pairs]
                    errors[part] = [e for _, e in pairs]
            yield page.assign(model_answer=answers, error=errors)

    return df.mapInPandas(run, schema)


def answer_prompts(
    prompts: DataFrame,
    paths: list[str],
    scorer: Scorer,
    batch_size: int = 32,
    max_chars: int | None = None,
    structured: bool = False,
    sentinel: bool = False,
    tasks: int | None = None,
    score: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Prompts x models -> answers: resolve the prompt, generate, parse.

    `max_chars` cuts the middle out of longer prompts. `tasks` spreads slow scoring over that
    many tasks. With `sentinel` a failed row's answer is the prefixed error text, as in
    published tables; its parsed answer is null either way. `score` takes the place of
    `score_batches`, e.g. to resume a stopped run.
    """
    rows = prompts_for_models(prompts, paths)
    rows = rows.withColumn("model_name", model_short_name(F.col("model_path")))
    if max_chars is not None:
        rows = rows.withColumn("prompt", mid_truncate(F.col("prompt"), max_chars))
    if tasks:
        rows = rows.repartition(tasks, "id", "model_path")
    answers = score(rows) if score else score_batches(rows, scorer, batch_size)
    return parse_answers(answers, structured, sentinel).drop("model_path")


def parse_answers(answers: DataFrame, structured: bool = False, sentinel: bool = False) -> DataFrame:
    """`explanation` and `parsed_model_answer` from `model_answer`, by the benchmark's pattern."""
    pattern = pattern_of(F.col("benchmark"))
    out = answers
    if structured:
        out = out.withColumn("__reply", structured_fields(F.col("model_answer")))
        explanation, final = F.col("__reply.explanation"), F.col("__reply.final")
    else:
        explanation, final = F.lit(None).cast("string"), F.col("model_answer")
    out = out.withColumns({"explanation": explanation, "parsed_model_answer": parse_answer(pattern, final)})
    if sentinel:
        failed = F.concat(F.lit(ERROR_PREFIX), F.col("error"))
        out = out.withColumn("model_answer", F.coalesce("model_answer", failed))
    return out.drop("__reply")


def split_sentinel(answer: Column) -> Column:
    """Stored answer -> struct(model_answer, error): failed rows are no answers."""
    failed = F.startswith(answer, F.lit(ERROR_PREFIX))
    return F.struct(
        F.when(~failed, answer).alias("model_answer"),
        F.when(failed, F.regexp_replace(answer, f"^{re.escape(ERROR_PREFIX)}", "")).alias("error"),
    )


def hosted_scorer(clients: dict[str, Callable[[str, str, str], str]]) -> Scorer:
    """Scorer for hosted models from provider name -> client(model, system, user).

    Network clients are the caller's. Providers are told apart like `models.provider` does.
    """
    tags = {t: re.compile(rf"<{t}>\s*(.*?)\s*</{t}>", re.S | re.I) for t in ("system", "user")}

    def body(prompt: str, tag: str) -> str:
        match = tags[tag].search(prompt or "")
        return match.group(1).strip() if match else ""

    def one(client: Callable[[str, str, str], str], path: str, prompt: str) -> str | Exception:
        try:
            return client(path, body(prompt, "system"), body(prompt, "user"))
        except Exception as e:
            return e

    def score(path: str, prompts: Sequence[str]) -> list[str | Exception]:
        known = [p for part, p in PROVIDERS.items() if part in path.lower()]
        if not known:
            raise ValueError(f"Unknown API provider for model {path}")
        return [one(clients[known[0]], path, p) for p in prompts]

    return score


def hosted_messages(prompts: DataFrame) -> DataFrame:
    """System and user text of tagged prompts, and the provider of each model."""
    return prompts.withColumns(
        {
            "system": tag_body(F.col("prompt"), "system"),
            "user": tag_body(F.col("prompt"), "user"),
            "provider": provider(F.col("model_path")),
        }
    )

"""The four jobs from the command line, e.g. with spark-submit or `python -m gabarito`.

prompts  source folders -> prompts table
answers  prompts table -> answers table, with a scorer given as `module:function`
score    answers table -> eval table, and its summary pivots
board    eval table + metadata tables -> leaderboard
preview  the first item of each benchmark, rendered
merge    CSV shards of answers -> answers table
"""

import argparse
import importlib

from pyspark.sql import SparkSession

from gabarito.operators.board import (
    board_schema,
    custom_flags,
    metric_pivot,
    parse_error_pivot,
    run_summary,
    unmapped_benchmarks,
)
from gabarito.operators.models import BASE, HOSTED, INSTRUCT
from gabarito.plans.answers import answers_table, store_answers
from gabarito.plans.leaderboard import store_board
from gabarito.plans.prompts import build_prompts_from
from gabarito.plans.scoring import store_eval
from gabarito.registry import BENCHMARKS
from gabarito.schemas import ANSWERS, EVAL, PROMPTS
from gabarito.sources.csv import read_shards, write_csv
from gabarito.sources.tables import load_benchmark, previews, read_table, read_table_or_csv, write_table
from gabarito.staging import clear_scratch


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="gabarito", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    prompts = jobs.add_parser("prompts")
    prompts.add_argument("--sources", required=True)
    prompts.add_argument("--prompts", required=True)
    prompts.add_argument("--benchmarks", nargs="+", required=True, choices=sorted(BENCHMARKS))
    prompts.add_argument("--models", nargs="+", required=True)
    prompts.add_argument("--tokenizers", nargs="+", required=True)
    prompts.add_argument("--types", nargs="+", required=True, choices=[INSTRUCT, BASE])
    prompts.add_argument("--shots", type=int, default=5)
    prompts.add_argument("--experiments", type=int, default=3)
    prompts.add_argument("--percent", type=float, default=100)
    prompts.add_argument("--structured", action="store_true")
    prompts.add_argument("--random-shots", action="store_true", help="every row draws its own shots")
    prompts.add_argument("--seed", type=int, default=42)
    prompts.add_argument("--chat-template", help="module:function, chat column -> text column")

    answers = jobs.add_parser("answers")
    answers.add_argument("--prompts", required=True)
    answers.add_argument("--answers", required=True)
    answers.add_argument("--models", nargs="+", required=True)
    answers.add_argument("--scorer", required=True, help="module:function, (model, prompts) -> answers")
    answers.add_argument("--batch-size", type=int, default=32)
    answers.add_argument("--resume", help="folder that logs answers, for a run that may stop")
    answers.add_argument("--max-chars", type=int)
    answers.add_argument("--tasks", type=int)
    answers.add_argument("--structured", action="store_true")

    score = jobs.add_parser("score")
    score.add_argument("--answers", required=True)
    score.add_argument("--eval", required=True)

    score.add_argument("--csv", help="CSV form of the answers, read where there is no table")
    score.add_argument("--summary", help="folder for the metric and error pivots, as CSV")

    shown = jobs.add_parser("preview")
    shown.add_argument("--sources", required=True)
    shown.add_argument("--benchmarks", nargs="+", required=True, choices=sorted(BENCHMARKS))

    merge = jobs.add_parser("merge")
    merge.add_argument("--shards", required=True)
    merge.add_argument("--answers", required=True)
    merge.add_argument("--expected", type=int)

    board = jobs.add_parser("board")
    board.add_argument("--eval", required=True)
    board.add_argument("--board", required=True)
    board.add_argument("--overrides", required=True)
    board.add_argument("--fetched")
    board.add_argument("--exclude", nargs="*", default=[])
    board.add_argument("--models", nargs="*", default=[])
    board.add_argument("--custom-flags", nargs="*", default=[])
    board.add_argument("--overwrite", action="store_true")
    board.add_argument("--compat", action="store_true")
    return parser.parse_args(argv)


def load(reference: str):
    module, _, name = reference.partition(":")
    return getattr(importlib.import_module(module), name)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "prompts":
        if not len(args.models) == len(args.tokenizers) == len(args.types):
            raise ValueError("models, tokenizers and types must have the same length")
        template = load(args.chat_template) if args.chat_template else None
        names = set(args.tokenizers) - {HOSTED}
        table = build_prompts_from(
            spark,
            args.sources,
            args.benchmarks,
            list(zip(args.models, args.tokenizers, args.types)),
            n_shots=args.shots,
            n_experiments=args.experiments,
            percent=args.percent,
            structured=args.structured,
            fixed_seed=not args.random_shots,
            seed=args.seed,
            chat_templates={name: template for name in names} if template else None,
        )
        write_table(table, args.prompts)
    elif args.job == "answers":
        prompts = read_table(spark, args.prompts, PROMPTS)
        options = {"batch_size": args.batch_size, "max_chars": args.max_chars}
        options |= {"tasks": args.tasks, "structured": args.structured, "resume": args.resume}
        store_answers(answers_table(prompts, args.models, load(args.scorer), **options), args.answers)
    elif args.job == "score":
        if args.csv:
            rows = read_table_or_csv(spark, args.answers, args.csv, ANSWERS)
        else:
            rows = read_table(spark, args.answers, ANSWERS)
        store_eval(spark, rows, args.eval)
        if args.summary:
            scored = read_table(spark, args.eval, EVAL)
            names = sorted(r.benchmark for r in scored.select("benchmark").distinct().collect())
            write_csv(metric_pivot(scored, names), f"{args.summary}/metrics")
            write_csv(parse_error_pivot(scored, names), f"{args.summary}/parse_errors")
    elif args.job == "merge":
        rows = read_shards(spark, args.shards, ANSWERS, expected=args.expected)
        store_answers(rows.select(ANSWERS.names), args.answers)
    elif args.job == "preview":
        rows = previews({name: load_benchmark(spark, args.sources, BENCHMARKS[name]) for name in args.benchmarks})
        for turns in rows.collect():  # one row a benchmark
            name, *texts = turns.asDict().items()
            print(f"[{name[1]}]", *[f"{k}: {v}" for k, v in texts], sep="\n")
    else:
        flags = custom_flags(spark, args.models, args.custom_flags) if args.custom_flags else None
        scored = read_table(spark, args.eval, EVAL)
        store_board(
            spark,
            scored,
            args.board,
            read_table(spark, args.overrides),
            overwrite=args.overwrite,
            fetched=read_table(spark, args.fetched) if args.fetched else None,
            flags=flags,
            exclude=args.exclude,
            compat=args.compat,
        )
        models = scored.select("model_name").distinct()
        stored = read_table(spark, args.board, board_schema(args.compat))
        run_summary(models, stored, read_table(spark, args.overrides)).show()
        unmapped_benchmarks(scored).show(100, truncate=False)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName(f"gabarito-{args.job}").getOrCreate()
    run(spark, args)
    clear_scratch(spark)  # not after a failure, which may name a staged copy


if __name__ == "__main__":
    main()

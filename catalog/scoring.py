"""Parsing and scoring queries."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import views as V
from catalog.sql import parse, query
from gabarito.functions.parsers import PARSERS
from gabarito.operators import metrics as M
from gabarito.operators.infer import parse_answers
from gabarito.schemas import EVAL, METRICS

RATES = ["non_parsed_rate", "non_parsed_total_rate"]
QUERIES = {}
SQL = {}


def score_yes_no(spark: SparkSession, sf: str) -> DataFrame:
    """Yes/no answers parsed and scored per model."""
    parsed = parse_answers(V.benchmark_answers(spark, sf, "hatebr"))
    return V.rounded(M.parse_summary(parsed), ["accuracy", "non_parsed_rate"])


QUERIES["score_yes_no"] = score_yes_no
SQL["score_yes_no"] = query(
    """SELECT model_name, benchmark, count(*) AS n_rows, count(*) - count(parsed_model_answer) AS n_unparsed,
        round((count(*) - count(parsed_model_answer)) / count(*), 6) AS non_parsed_rate,
        count(parsed_model_answer) AS n_parsed, count(*) FILTER (label = parsed_model_answer) AS n_correct,
        round(count(*) FILTER (label = parsed_model_answer) / count(parsed_model_answer), 6) AS accuracy
    FROM answers WHERE benchmark = 'hatebr' GROUP BY ALL"""
)


def non_parsed_rate(spark: SparkSession, sf: str) -> DataFrame:
    summary = M.parse_summary(V.answers(spark, sf))
    return V.rounded(summary, ["non_parsed_rate"]).select(
        "model_name", "benchmark", "n_rows", "n_unparsed", "non_parsed_rate"
    )


QUERIES["non_parsed_rate"] = non_parsed_rate
SQL["non_parsed_rate"] = query(
    """SELECT model_name, benchmark, n_rows, n_unparsed, round(n_unparsed / n_rows, 6) AS non_parsed_rate
    FROM rates"""
)


def accuracy_by_model(spark: SparkSession, sf: str) -> DataFrame:
    summary = M.parse_summary(V.answers(spark, sf))
    return V.rounded(summary, ["accuracy"]).select(
        "model_name", "benchmark", "n_parsed", "n_correct", "accuracy"
    )


QUERIES["accuracy_by_model"] = accuracy_by_model
SQL["accuracy_by_model"] = query(
    """SELECT model_name, benchmark, count(*) AS n_parsed, count(*) FILTER (label = parsed_model_answer) AS n_correct,
        round(count(*) FILTER (label = parsed_model_answer) / count(*), 6) AS accuracy
    FROM answers WHERE parsed_model_answer IS NOT NULL GROUP BY ALL"""
)


def _parse_query(benchmark: str, pattern: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        rows = V.benchmark_answers(spark, sf, benchmark)
        return rows.select("item_key", "model_name", "model_answer", PARSERS[pattern](F.col("model_answer")).alias("parsed"))

    return run


for key, bench, pattern in [
    ("parse_yes_no", "hatebr", "yes_no"),
    ("parse_choice", "oab", "multiple_choice"),
    ("parse_word", "tweetsentbr", "multiple_choice_full_word"),
    ("parse_number", "assin2sts", "continue_value"),
    ("parse_integer_math", "aime24", "integer_exact_math"),
]:
    QUERIES[key] = _parse_query(bench, pattern)
    SQL[key] = query(
        f"""SELECT item_key, model_name, model_answer, {parse(pattern, "model_answer")} AS parsed
        FROM raw_answers WHERE benchmark = '{bench}'"""
    )


def parse_dispatch(spark: SparkSession, sf: str) -> DataFrame:
    """Every answer read by its benchmark's own parser."""
    return V.answers(spark, sf).select("benchmark", "item_key", "model_name", "parsed_model_answer")


QUERIES["parse_dispatch"] = parse_dispatch
SQL["parse_dispatch"] = query("SELECT benchmark, item_key, model_name, parsed_model_answer FROM answers")


def parse_free_text(spark: SparkSession, sf: str) -> DataFrame:
    """All five parsers on whole documents, the longest and least regular texts at hand."""
    text = F.col("text")
    return V.table(spark, sf, "documents").select(
        "doc_id", *[parse(text).alias(name) for name, parse in PARSERS.items()]
    )


QUERIES["parse_free_text"] = parse_free_text
SQL["parse_free_text"] = "SELECT doc_id, " + ", ".join(
    f"{parse(p, 'text')} AS {p}" for p in PARSERS
) + " FROM documents"


def confusion_counts(spark: SparkSession, sf: str) -> DataFrame:
    return M.confusion_counts(V.answers(spark, sf))


QUERIES["confusion_counts"] = confusion_counts
SQL["confusion_counts"] = query(
    "SELECT model_name, benchmark, true_class, predicted_class, CAST(n AS BIGINT) AS n FROM confusion"
)


def weighted_prf(spark: SparkSession, sf: str) -> DataFrame:
    rows = V.answers(spark, sf).where(F.col("benchmark") != "assin2sts")
    scores = ["accuracy", "precision", "recall", "f1_score"]
    return V.rounded(M.category_eval(rows), scores).select("model_name", "benchmark", *scores)


QUERIES["weighted_prf"] = weighted_prf
SQL["weighted_prf"] = query(
    """SELECT model_name, benchmark, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision,
        round(recall, 6) AS recall, round(f1_score, 6) AS f1_score FROM category_scores"""
)


def pearson_by_model(spark: SparkSession, sf: str) -> DataFrame:
    rows = parse_answers(V.benchmark_answers(spark, sf, "assin2sts"))
    return V.rounded(M.continuous_eval(rows), ["pearson_correlation", "non_parsed_rate"]).select(
        "model_name", "benchmark", "pearson_correlation", "non_parsed_rate"
    )


QUERIES["pearson_by_model"] = pearson_by_model
SQL["pearson_by_model"] = query(
    """SELECT model_name, benchmark, round(pearson_correlation, 6) AS pearson_correlation,
        round(n_unparsed / n_rows, 6) AS non_parsed_rate
    FROM correlations JOIN rates USING (model_name, benchmark)"""
)


def integer_math_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Integer benchmarks: normalised labels, and both unparsed rates. Some labels are spoilt."""
    rows = parse_answers(V.benchmark_answers(spark, sf, "aime24"))
    label = F.when(F.col("item_key") % 9 == 0, "n/d").otherwise(F.concat(F.lit("$0"), "label", F.lit("$")))
    return V.rounded(M.category_eval(rows.withColumn("label", label)), ["accuracy", *RATES]).select(
        "model_name", "benchmark", "accuracy", *RATES
    )


QUERIES["integer_math_metrics"] = integer_math_metrics
SQL["integer_math_metrics"] = query(
    """SELECT model_name, benchmark,
        round(count(*) FILTER (p = t) / count(*) FILTER (p IS NOT NULL AND t IS NOT NULL), 6) AS accuracy,
        round(1 - count(*) FILTER (p IS NOT NULL AND t IS NOT NULL) / count(p), 6) AS non_parsed_rate,
        round((count(*) - count(p)) / count(*), 6) AS non_parsed_total_rate
    FROM (SELECT model_name, benchmark, parsed_model_answer AS p,
            CASE WHEN item_key % 9 <> 0 THEN CAST(CAST(label AS INTEGER) AS VARCHAR) END AS t
          FROM answers WHERE benchmark = 'aime24') GROUP BY ALL"""
)


def eval_table(spark: SparkSession, sf: str) -> DataFrame:
    return V.rounded(M.evaluate(V.answers(spark, sf)), [*METRICS, *RATES])


QUERIES["eval_table"] = eval_table
SQL["eval_table"] = query(
    "SELECT model_name, benchmark, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in EVAL.names[2:])
    + " FROM eval_rows"
)


def run_benchmarks(spark: SparkSession, sf: str) -> DataFrame:
    return M.run_benchmarks(V.answers(spark, sf))


QUERIES["run_benchmarks"] = run_benchmarks
SQL["run_benchmarks"] = query("SELECT DISTINCT benchmark FROM answers")


def structured_answer(spark: SparkSession, sf: str) -> DataFrame:
    """JSON replies: explanation, final answer parsed, raw reply kept."""
    return parse_answers(V.structured_replies(spark, sf), structured=True).select(
        "item_key", "label", "model_answer", "explanation", "parsed_model_answer"
    )


QUERIES["structured_answer"] = structured_answer
SQL["structured_answer"] = query(
    f"""SELECT item_key, label, model_answer, explanation, {parse("yes_no", "final")} AS parsed_model_answer
    FROM (SELECT item_key, label, model_answer,
            json_extract_string(reply, '$.explicacao') AS explanation,
            CASE WHEN json_exists(reply, '$.explicacao')
                 THEN json_extract_string(reply, '$.resposta') ELSE model_answer END AS final
          FROM (SELECT *, CASE WHEN json_exists(reply_json, '$.explicacao') THEN reply_json END AS reply
          FROM (SELECT *, CASE WHEN json_valid(model_answer) THEN model_answer END AS reply_json
          FROM (SELECT item_key, label, CASE item_key % 4
                    WHEN 0 THEN '{{"explicacao": "' || source || '", "resposta": "' || word || '"}}'
                    WHEN 1 THEN '{{"resposta": "' || word || '"}}'
                    WHEN 2 THEN word || ', ok' END AS model_answer
                FROM (SELECT *, CASE label WHEN '1' THEN 'Sim' ELSE 'Não' END AS word FROM items_yes_no)))))"""
)


"""Scores per (model, benchmark) from parsed answers.

Categorical scores come from confusion counts, so rows are aggregated map-side once and the
per-class work runs on a table of distinct (label, prediction) pairs. Correlations are one
streaming aggregate. Nothing is collected, and one large (model, benchmark) is just more
partial sums.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gabarito.functions.parsers import integer_math
from gabarito.registry import names_where, pattern_of
from gabarito.schemas import EVAL

GROUP = ["model_name", "benchmark"]
PREDICTION = "parsed_model_answer"


def ratio(part: Column, whole: Column) -> Column:
    """Quotient, null on an empty denominator."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def gold_label(benchmark: Column, label: Column) -> Column:
    """Label as predictions spell it: integer benchmarks go through their own parser."""
    is_integer = benchmark.isin(names_where(pattern="integer_exact_math"))
    return F.when(is_integer, integer_math(label)).otherwise(F.coalesce(label, F.lit("None")))


def parse_summary(answers: DataFrame) -> DataFrame:
    """Rows, unparsed rows and exact matches per (model, benchmark), in one aggregation.

    The accuracy is over parsed rows and null when there is none.
    """
    parsed = F.col(PREDICTION)
    correct = gold_label(F.col("benchmark"), F.col("label")) == parsed
    return (
        answers.groupBy(*GROUP)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(parsed.isNull()).alias("n_unparsed"),
            F.count(parsed).alias("n_parsed"),
            F.count_if(correct).alias("n_correct"),
        )
        .withColumns(
            {
                "non_parsed_rate": ratio(F.col("n_unparsed"), F.col("n_rows")),
                "accuracy": ratio(F.col("n_correct"), F.col("n_parsed")),
            }
        )
    )


def confusion_counts(answers: DataFrame) -> DataFrame:
    """Rows per (model, benchmark, true class, predicted class); null is "not parsed"."""
    return (
        answers.withColumn("true_class", gold_label(F.col("benchmark"), F.col("label")))
        .groupBy(*GROUP, "true_class", F.col(PREDICTION).alias("predicted_class"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def class_counts(confusion: DataFrame) -> DataFrame:
    """Support, predictions and hits per class, from one pass over the confusion counts.

    The row with a null class carries the group's totals: rows, parsed and scored ones.
    """
    scored = F.col("true_class").isNotNull() & F.col("predicted_class").isNotNull()
    n, zero = F.col("n"), F.lit(0).cast("long")
    hit = F.when(F.col("true_class") == F.col("predicted_class"), n).otherwise(zero)

    def part(name: Column, support=zero, predicted=zero, hits=zero, rows=zero, parsed=zero, kept=zero):
        values = {
            "class": name,
            "support": support,
            "predicted": predicted,
            "hits": hits,
            "rows": rows,
            "parsed": parsed,
            "kept": kept,
        }
        return F.struct(*[v.alias(k) for k, v in values.items()])

    nothing = F.lit(None).cast("string")
    parsed = F.when(F.col("predicted_class").isNotNull(), n).otherwise(zero)
    totals = part(nothing, rows=n, parsed=parsed, kept=F.when(scored, n).otherwise(zero))
    classes = F.when(
        scored,
        F.array(
            totals,
            part(F.col("true_class"), support=n, hits=hit),
            part(F.col("predicted_class"), predicted=n),
        ),
    ).otherwise(F.array(totals))
    parts = confusion.select(*GROUP, F.inline(classes))
    sums = ["support", "predicted", "hits", "rows", "parsed", "kept"]
    return parts.groupBy(*GROUP, "class").agg(*[F.sum(c).alias(c) for c in sums])


def category_eval(answers: DataFrame) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1; 0 where a class has no divisor."""
    c = {k: F.col(k) for k in ("support", "predicted", "hits", "rows", "parsed", "kept")}
    n = F.sum("support")

    def weighted(value: Column) -> Column:
        return ratio(F.sum(c["support"] * F.coalesce(value, F.lit(0.0))), n)

    nothing = F.lit(None).cast("double")
    unparsed = ratio(F.sum(c["rows"]) - F.sum(c["parsed"]), F.sum(c["rows"]))
    dropped = 1 - ratio(F.sum(c["kept"]), F.sum(c["parsed"]))
    is_integer = F.col("benchmark").isin(names_where(pattern="integer_exact_math"))
    return (
        class_counts(confusion_counts(answers))
        .groupBy(*GROUP)
        .agg(
            ratio(F.sum("hits"), n).alias("accuracy"),
            weighted(ratio(c["hits"], c["predicted"])).alias("precision"),
            weighted(ratio(c["hits"], c["support"])).alias("recall"),
            weighted(ratio(c["hits"] * 2, c["support"] + c["predicted"])).alias("f1_score"),
            unparsed.alias("non_parsed_total_rate"),
            dropped.alias("__dropped"),
        )
        .withColumn("pearson_correlation", nothing)
        # Integer benchmarks report the share of parsed rows without a usable label instead.
        .withColumn(
            "non_parsed_rate",
            F.when(is_integer, F.coalesce("__dropped", "non_parsed_total_rate")).otherwise(
                F.col("non_parsed_total_rate")
            ),
        )
        .select(*EVAL.names)
    )


def pearson(x: Column, y: Column) -> Column:
    """Correlation, null instead of an error when one side does not vary."""
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def continuous_eval(answers: DataFrame) -> DataFrame:
    """Pearson correlation of label and prediction over parsed rows.

    A label that is no number fails the job, with its benchmark, its id (where the answers have
    one) and the label in the message; a null label takes no part.
    """
    nothing = F.lit(None).cast("double")
    parsed = F.col(PREDICTION)
    number = F.col("label").try_cast("double")
    row = [F.col(c).cast("string") for c in ("benchmark", "id_bench") if c in answers.columns]
    fault = F.raise_error(F.concat_ws(" ", F.lit("label is no number:"), *row, F.col("label").cast("string")))
    readable = F.when(number.isNull() & F.col("label").isNotNull(), fault.cast("double")).otherwise(number)
    label = F.when(parsed.isNotNull(), readable)
    unparsed = ratio(F.count_if(parsed.isNull()), F.count(F.lit(1)))
    return (
        answers.groupBy(*GROUP)
        .agg(
            pearson(label, parsed.cast("double")).alias("pearson_correlation"),
            unparsed.alias("non_parsed_rate"),
        )
        .withColumns({m: nothing for m in ("accuracy", "precision", "recall", "f1_score")})
        .withColumn("non_parsed_total_rate", F.col("non_parsed_rate"))
        .select(*EVAL.names)
    )


def evaluate(answers: DataFrame) -> DataFrame:
    """The eval table. An answer of an unknown benchmark, or of none, fails the job instead of vanishing.

    The two answer types are told apart by literal benchmark lists, so each branch's filter
    reaches the scan and prunes partitions of a table laid out by benchmark.
    """
    continuous = names_where(answer_type="continue")
    name = F.col("benchmark")
    category = answers.where(name.isNull() | ~name.isin(continuous))
    # pattern_of raises on names outside the registry
    known = category.withColumn("benchmark", F.when(pattern_of(name).isNotNull(), name))
    return category_eval(known).unionByName(continuous_eval(answers.where(name.isin(continuous))))


def run_benchmarks(answers: DataFrame) -> DataFrame:
    """Benchmarks present in a run."""
    return answers.select("benchmark").distinct()

"""Row filters, label standardisation and column shaping of benchmark tables."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gabarito.functions.choices import native_repair, repair_with
from gabarito.registry import Benchmark
from gabarito.schemas import ANSWERS

# Columns of a stored answers table that are always text.
TEXT_COLUMNS = [f.name for f in ANSWERS.fields if isinstance(f.dataType, T.StringType)]


def present(df: DataFrame, column: str) -> Column:
    """Non-null and, for text, not empty."""
    ok = F.col(column).isNotNull()
    if isinstance(df.schema[column].dataType, T.StringType):
        ok = ok & (F.col(column) != "")
    return ok


def complete_rows(df: DataFrame, columns: list[str] | tuple[str, ...] | None = None) -> DataFrame:
    """Rows whose required columns are all present; the ones a table lacks are not required.

    Without a declaration every column is required.
    """
    required = [c for c in columns if c in df.columns] if columns is not None else df.columns
    return df.where(reduce(and_, (present(df, c) for c in required))) if required else df


def standardise(df: DataFrame, bench: Benchmark) -> DataFrame:
    """Declared label column as text `label`, plus the constant `benchmark`.

    Labels stored as positions become the letters predictions are compared with.
    """
    stored = F.col(bench.label)
    gold = bench.gold(stored) if bench.gold else stored
    if isinstance(df.schema[bench.label].dataType, T.BooleanType):
        gold = gold.cast("int")  # the binary templates read 1 and 0
    named = df.withColumns({"label": gold.cast("string"), "benchmark": F.lit(bench.name)})
    return named if bench.label == "label" else named.drop(bench.label)


def sanitised(df: DataFrame, bench: Benchmark) -> DataFrame:
    """Rows whose stored alternatives are repaired, where the benchmark asks for it.

    What the JVM makes of them is a column of its own for a while, so that it is computed once.
    """
    if bench.sanitize and isinstance(df.schema[bench.sanitize].dataType, T.StringType):
        text, native = F.col(bench.sanitize), "__native"
        while native in df.columns:
            native += "_"
        return df.withColumn(native, native_repair(text)).withColumn(bench.sanitize, repair_with(text, F.col(native))).drop(native)
    return df


def clean_benchmark(df: DataFrame, bench: Benchmark) -> DataFrame:
    """Complete, sanitised and standardised rows of one benchmark.

    A repair leaves null and empty texts as they are and makes no others, so rows are filtered
    before it.
    """
    return standardise(sanitised(complete_rows(df, bench.columns), bench), bench)


def bench_id(index: str = "idx") -> Column:
    """`{benchmark}_{index}`."""
    return F.concat_ws("_", F.col("benchmark"), F.col(index).cast("string"))


def string_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Listed columns as text where present; arrays as JSON. Nulls stay null."""
    wanted = [c for c in (columns or TEXT_COLUMNS) if c in df.columns]

    def as_text(name: str) -> Column:
        if isinstance(df.schema[name].dataType, (T.ArrayType, T.StructType, T.MapType)):
            return F.to_json(name)
        return F.col(name).cast("string")

    return df.withColumns({c: as_text(c) for c in wanted})


def drop_index_columns(df: DataFrame) -> DataFrame:
    """Without the index columns a CSV round trip leaves behind."""
    # The names such columns get.
    extra = [c for c in df.columns if c.startswith("__index_level_") or c == "Unnamed: 0"]
    return df.drop(*extra)


def exclude_models(df: DataFrame, models: list[str]) -> DataFrame:
    """Rows of other models; a row without a model name stays."""
    name = F.col("model_name")
    return df.where(name.isNull() | ~name.isin(models)) if models else df

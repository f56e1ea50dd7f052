"""Pipeline and benchmark tables on any file system Spark reads."""

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from gabarito.operators.clean import sanitised, standardise
from gabarito.registry import Benchmark, benchmark
from gabarito.sources.csv import read_csv
from gabarito.staging import scratch_path

# Columns that keep the order of a source: file and position in it.
SOURCE_ORDER = ["source_file", "source_row"]


def table_exists(spark: SparkSession, path: str) -> bool:
    """Is there a readable table at `path`?"""
    try:
        spark.read.parquet(path)
    except AnalysisException:
        return False
    return True


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def read_table_or_csv(spark: SparkSession, path: str, csv_path: str, schema: StructType) -> DataFrame:
    """The table if it is there, else its CSV form."""
    if table_exists(spark, path):
        return read_table(spark, path, schema)
    return read_csv(spark, csv_path, schema)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace the table at `path`; partitions of a partitioned one only where `df` has rows.

    Laid out by (model_name, benchmark), an upsert is a dynamic overwrite of the partitions
    the batch covers, and the rest of the table is not even read. Rows are rebalanced by the
    partition columns, which keeps files few without sending a large partition to one task.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(path)


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite a whole table with rows that may derive from it: staged first, then swapped in.

    If the second write fails, the error names the staged copy, which holds all rows.
    """
    spark, copy = df.sparkSession, scratch_path(df.sparkSession, "replace")
    df.write.parquet(copy)
    rows = spark.read.schema(df.schema).parquet(copy).select(df.columns)
    if partition_by:
        rows = rows.hint("rebalance", *partition_by)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    try:
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    except Exception as e:
        raise RuntimeError(f"{path} could not be replaced; its new rows are in {copy}") from e


def resolve_split(spark: SparkSession, folder: str, declared: str | None) -> str:
    """Declared split, else `test` when the source has one, else `train`."""
    if declared:
        return declared
    return "test" if table_exists(spark, f"{folder}/test") else "train"


def union_subsets(subsets: dict[str, DataFrame]) -> DataFrame:
    """Subsets of one benchmark under `subset_name`; their schemas must be the same."""
    (first, reference), *_ = subsets.items()
    wanted = [(f.name, f.dataType) for f in reference.schema]
    for name, df in subsets.items():
        if [(f.name, f.dataType) for f in df.schema] != wanted:
            raise ValueError(
                f"subset {name!r} has another schema than {first!r}: {df.columns} / {reference.columns}"
            )
    tagged = [df.withColumn("subset_name", F.lit(name)) for name, df in subsets.items()]
    return reduce(DataFrame.unionByName, tagged)


def load_benchmark(spark: SparkSession, root: str, bench: Benchmark) -> DataFrame:
    """Source rows of a benchmark from `{root}/{benchmark}[/{subset}]/{split}`.

    `SOURCE_ORDER` identifies a row and keeps the source's own order.
    """

    def load(subset: str | None) -> DataFrame:
        folder = "/".join(p for p in (root.rstrip("/"), bench.name, subset) if p)
        rows = read_table(spark, f"{folder}/{resolve_split(spark, folder, bench.split)}")
        place = [F.col("_metadata.file_path"), F.col("_metadata.row_index")]
        return rows.select("*", *[c.alias(n) for c, n in zip(place, SOURCE_ORDER)])

    if isinstance(bench.subset, (list, tuple)):
        return union_subsets({s: load(s) for s in bench.subset})
    return load(bench.subset)


def previews(sources: dict[str, DataFrame], order: list[str] | None = None) -> DataFrame:
    """First row of every benchmark, by its `order` key, as it is stored and rendered through its template.

    The first row is shown even if it is incomplete: missing texts read None. It is found by a
    map-side minimum, all benchmarks in one job, and only that row is rendered. A benchmark
    without rows is not shown.
    """

    def first(name: str, rows: DataFrame) -> DataFrame:
        bench = benchmark(name)
        whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
        kept = rows.agg(F.min_by(whole, F.struct(*(order or SOURCE_ORDER))).alias("row")).where("row IS NOT NULL")
        row = standardise(sanitised(kept.select("row.*"), bench), bench)
        texts = [f.name for f in row.schema if isinstance(f.dataType, StringType)]
        row = row.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit("None")) for c in texts})
        return row.select(F.lit(name).alias("benchmark"), bench.template(row).alias("turns"))

    shown = reduce(DataFrame.unionByName, (first(name, rows) for name, rows in sources.items()))
    return shown.select("benchmark", "turns.*")


def preview(rows: DataFrame, bench: Benchmark, order: list[str] | None = None) -> DataFrame:
    """First row of one benchmark, rendered."""
    return previews({bench.name: rows}, order).drop("benchmark")

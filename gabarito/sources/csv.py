"""CSV forms of the pipeline tables."""

import csv
import re
import warnings
from collections import Counter
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gabarito.functions.text import escape_backslashes
from gabarito.operators.clean import drop_index_columns, string_columns

# Quotes are doubled, and only fields that need quotes get them. A bare empty
# field is null, a quoted one is the empty text.
FORMAT = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# What a quoted empty field reads as until it becomes '' again; the reader would make it null.
EMPTY = "\x01"
FILE = "__file"
NESTED = (T.ArrayType, T.StructType, T.MapType)


def files_below(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Files that a read of `path` takes in; their contents are not read."""
    found = spark.read.format("binaryFile").load(path).select("path").collect()
    return sorted(r.path for r in found)


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """CSV with a fixed schema, columns matched by each file's own header, index columns dropped.

    Files may hold their columns in different orders: they are read in groups of equal headers,
    and a column that a group lacks is null. Nested columns are stored as JSON. Of every file
    only the beginning is opened when this is called, to see its header; no job runs for that.
    """
    return _read_csv(spark, path, schema).drop(FILE)


def _read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    headers: dict[tuple[str, ...], list[str]] = {}
    for file in files_below(spark, path):
        headers.setdefault(header_of(spark, file), []).append(literal_path(file))
    groups = [_read_group(spark, files, header, schema) for header, files in headers.items() if header]
    if not groups:
        return spark.createDataFrame([], schema).withColumn(FILE, F.lit(None).cast("string"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), groups)


def header_of(spark: SparkSession, file: str) -> tuple[str, ...]:
    """Column names in the first record of a file, which may be compressed; none if it is empty.

    Names that repeat, and empty ones, are numbered by their place, so that every column has its own.
    """
    hadoop = spark._jvm.org.apache.hadoop
    path = hadoop.fs.Path(file)
    codec = hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(path)
    raw = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    lines = spark._jvm.java.io.BufferedReader(
        spark._jvm.java.io.InputStreamReader(codec.createInputStream(raw) if codec else raw, "UTF-8")
    )
    try:
        # A quoted line break goes on in the next line; the parser asks for as many as it needs.
        names = next(csv.reader(iter(lambda: _line(lines), None), doublequote=True), [])
    finally:
        lines.close()
    names = [n.removeprefix("\ufeff") if i == 0 else n for i, n in enumerate(names)]
    lowered = Counter(n.lower() for n in names)
    return tuple(n if n and lowered[n.lower()] == 1 else f"{n or '_c'}{i}" for i, n in enumerate(names))


def _line(lines: object) -> str | None:
    text = lines.readLine()
    return None if text is None else text + "\n"


def literal_path(file: str) -> str:
    """A path whose pattern characters stand for themselves."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", file)


def _read_group(spark: SparkSession, files: list[str], header: tuple[str, ...], schema: T.StructType) -> DataFrame:
    nested = {f.name: f.dataType for f in schema if isinstance(f.dataType, NESTED)}
    flat = {f.name: f.dataType for f in schema if f.name not in nested}
    names = [T.StructField(c, flat.get(c, T.StringType())) for c in header]
    rows = spark.read.options(**FORMAT, emptyValue=EMPTY).schema(T.StructType(names)).csv(files)
    text = [f.name for f in names if isinstance(f.dataType, T.StringType)]
    filled = {c: F.when(F.col(f"`{c}`") == EMPTY, "").otherwise(F.col(f"`{c}`")) for c in text}
    rows = drop_index_columns(rows.withColumns(filled))
    rows = rows.withColumns({c: F.from_json(c, t) for c, t in nested.items() if c in header})
    return rows.withColumn(FILE, F.input_file_name())


def write_csv(df: DataFrame, path: str, escape: bool = False) -> None:
    """CSV files under `path`; nested columns as JSON. `escape` protects backslashes first."""
    nested = [f.name for f in df.schema if isinstance(f.dataType, NESTED)]
    out = string_columns(df, nested) if nested else df
    if escape:
        text = [f.name for f in out.schema if isinstance(f.dataType, T.StringType)]
        out = out.withColumns({c: escape_backslashes(F.col(c)) for c in text})
    out.write.mode("overwrite").options(**FORMAT).csv(path)


def write_shards(df: DataFrame, path: str, shard: str = "shard", shards: int | None = None, files: int = 1) -> None:
    """One sub-folder per shard number, with `files` files each.

    With the number of `shards` known, rows go straight to the task of their shard, so tasks and
    shards do not multiply; a large shard is dealt over several `files`. Without it every task
    writes a file for each shard it holds rows of. Shards without rows get no folder.
    """
    if shards:
        # By content, so that a repeated task deals its rows out alike.
        part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(files)).cast("int")
        df = df.repartitionById(shards * files, F.col(shard).cast("int") * files + part)
    df.write.mode("overwrite").options(**FORMAT).partitionBy(shard).csv(path)


def read_shards(
    spark: SparkSession, path: str, schema: T.StructType, shard: str = "shard", expected: int | None = None
) -> DataFrame:
    """All shard folders below `path` as one table, with the shard each row came from.

    Missing ones of the `expected` shards are warned about; no shard at all is an error.
    """
    pattern = f"/{re.escape(shard)}=([0-9]+)/"
    try:
        files = files_below(spark, f"{path.rstrip('/')}/{shard}=*")
    except AnalysisException:
        files = []
    there = {int(m[1]) for f in files if (m := re.search(pattern, f))}
    if not there:
        raise FileNotFoundError(f"no shard below {path}")
    if expected is not None and (missing := sorted(set(range(expected)) - there)):
        warnings.warn(f"shards {missing} of {expected} are missing below {path}", stacklevel=2)
    rows = _read_csv(spark, f"{path.rstrip('/')}/{shard}=*", schema)
    return rows.withColumn(shard, F.regexp_extract(FILE, pattern, 1).cast("int")).drop(FILE)


def missing_shards(shards: DataFrame, expected: int, shard: str = "shard") -> DataFrame:
    """Shard numbers below `expected` that brought no row."""
    wanted = shards.sparkSession.range(expected).select(F.col("id").cast("int").alias(shard))
    return wanted.join(shards.select(shard).distinct(), shard, "left_anti")

"""Helpers of the training-data operators: shipping, batch functions, column names, words."""

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

PACKAGE = Path(__file__).resolve().parent.parent
SLICE_BYTES = 2 << 20
SLICE_ROWS = 4096

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="gabarito-llm-")) / "gabarito_llm.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(PACKAGE.rglob("*.py")):
            out.write(source, source.relative_to(PACKAGE.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """`df` without columns of these names, in any case: results take their place."""
    taken = {n.lower() for n in names}
    clashing = [c for c in df.columns if c.lower() in taken]
    return df.drop(*clashing) if clashing else df


def unused(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Working names for columns beside those of `df`: none of them is taken in any case."""
    taken, tail = {c.lower() for c in df.columns}, ""
    names = list(names)
    while any(f"_{n}{tail}" in taken for n in names):
        tail += "_"
    return [f"_{n}{tail}" for n in names]


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of bounded text bytes and rows, so that work per part fits in memory."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and (total + size > SLICE_BYTES or i - start >= SLICE_ROWS):
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)


def append_columns(
    df: DataFrame,
    text_col: str,
    fields: list[StructField],
    start: Callable[[], Callable[[list], list]],
    keep_text: bool = True,
) -> DataFrame:
    """`df` with `fields` computed from its text column, batch by batch.

    `start` runs once per task and returns a function from a list of texts (str or None) to
    one list of values per field. Columns that have a result's name give way to it.
    """
    names = [f.name for f in fields]
    rest = without(df, [n for n in names if n.lower() != text_col.lower()])
    text_at = rest.columns.index(text_col)
    kept = [i for i, c in enumerate(rest.columns) if keep_text or i != text_at]
    schema = StructType([rest.schema.fields[i] for i in kept] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        compute, arrow = None, to_arrow_schema(schema)
        for batch in batches:
            for part in slices(batch, text_at):
                compute = compute or start()
                results = compute(part.column(text_at).to_pylist())
                columns = [part.column(i) for i in kept]
                new = [pa.array(r, arrow.field(n).type) for r, n in zip(results, names)]
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) for c, f in zip(columns + new, arrow)], schema=arrow
                )

    # By position, since names with dots are read as paths there.
    return rest.toDF(*[f"c{i}" for i in range(len(rest.columns))]).mapInArrow(run, schema)

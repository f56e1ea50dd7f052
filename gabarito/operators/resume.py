"""Scoring that can be stopped and taken up again without asking a model twice.

Tasks write finished answers to a folder while they go on, through a data source whose writer
calls the scorer. A later run first takes out the rows that are answered there.
"""

import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

from gabarito.operators.infer import Scorer, caller
from gabarito.staging import small_join

COMMIT_ROWS = 512
CALL = "__call"  # digest of what tells a call apart
ANSWERED, FAILED = "answered", "failed"


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


class AnswerLog:
    """Files of one task in the folder; a file is there whole or not at all."""

    def __init__(self, folder: str, run: str, task: int, schema: pa.Schema):
        self.files, self.root = file_system(folder)
        self.place, self.schema, self.written = f"{run}/{task}", schema, 0

    def calls(self) -> set[str]:
        """What earlier attempts of this task have written in this run."""
        found: set[str] = set()
        for kind in (ANSWERED, FAILED):
            at = fs.FileSelector(f"{self.root}/{kind}/{self.place}", allow_not_found=True)
            for info in self.files.get_file_info(at):
                if info.base_name.endswith(".parquet"):
                    with self.files.open_input_file(info.path) as source:
                        found.update(pq.read_table(source, columns=[CALL]).column(0).to_pylist())
        return found

    def add(self, kind: str, rows: list[dict]) -> None:
        if not rows:
            return
        data = io.BytesIO()
        pq.write_table(pa.Table.from_pylist(rows, self.schema), data)
        folder = f"{self.root}/{kind}/{self.place}"
        self.files.create_dir(folder, recursive=True)
        name = uuid.uuid4().hex
        with self.files.open_output_stream(f"{folder}/.{name}") as out:
            out.write(data.getvalue())
        self.files.move(f"{folder}/.{name}", f"{folder}/{name}.parquet")


def scoring_sink(
    schema: T.StructType, scorer: Scorer, folder: str, run: str, batch_size: int, attempts: int, commit_rows: int
) -> type[DataSource]:
    """A sink that answers the rows written to it and logs the answers."""

    class Writer(DataSourceArrowWriter):
        def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
            log = AnswerLog(folder, run, TaskContext.get().partitionId(), to_arrow_schema(schema))
            call, there = caller(scorer, attempts), log.calls()
            held: dict[str, list[dict]] = {}
            done: list[dict] = []

            def flush() -> None:
                # What failed goes first: a file of answers says that its task got this far.
                log.add(FAILED, [r for r in done if r["error"] is not None])
                log.add(ANSWERED, [r for r in done if r["error"] is None])
                done.clear()

            def answer(path: str) -> None:
                rows = held.pop(path)
                for row, (text, error) in zip(rows, call(path, [r["prompt"] for r in rows])):
                    done.append({**row, "model_answer": text, "error": error})
                if len(done) >= commit_rows:
                    flush()

            try:
                for page in iterator:
                    for row in page.to_pylist():
                        if row[CALL] not in there:
                            path = row["model_path"]
                            held.setdefault(path, []).append(row)
                            if len(held[path]) == batch_size:
                                answer(path)
                for path in list(held):
                    answer(path)
            finally:
                flush()
            return WriterCommitMessage()

    class Sink(DataSource):
        @classmethod
        def name(cls) -> str:
            return "gabarito_scoring"

        def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
            return Writer()

    return Sink


def logged(rows: DataFrame, path: str, schema: T.StructType) -> DataFrame | None:
    """What is logged below `path`, whichever run wrote it."""
    try:
        return rows.sparkSession.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)
    except AnalysisException:
        return None


def score_resumable(
    rows: DataFrame,
    scorer: Scorer,
    folder: str,
    row_key: list[str] | None = None,
    batch_size: int = 32,
    attempts: int = 3,
    commit_rows: int = COMMIT_ROWS,
) -> DataFrame:
    """`score_batches` with a log of answers in `folder`, which a stopped run leaves and the next one uses.

    A row is told by a digest of `row_key` (null or not), its model and its prompt, so a changed
    prompt is asked anew; rows that agree in all three are one. Answers count once they are in a file: a task writes one after `commit_rows` rows, at
    its end, and when an exception ends it; what an executor loses between two files is asked
    again. A repeated attempt of a task leaves out what earlier ones have logged. Rows that
    failed have an error in this run's result, and the next run asks them again. Rows keep no
    order. The jobs run when this is called; the result reads the log, which is the caller's to
    delete once the answers are stored. The folder must be on a file system that pyarrow reaches.
    """
    told = F.to_json(F.struct(*(row_key or ["id"]), "model_path", "prompt"), {"ignoreNullFields": "false"})
    rows = rows.withColumn(CALL, F.md5(told.cast("binary")))
    fields = [T.StructField("model_answer", T.StringType()), T.StructField("error", T.StringType())]
    schema = T.StructType([*rows.schema.fields, *fields])
    run, spark = uuid.uuid4().hex, rows.sparkSession
    before = logged(rows, f"{folder}/{ANSWERED}", schema)
    todo = rows if before is None else small_join(rows, before.select(CALL).distinct(), [CALL], "left_anti")
    spark.dataSource.register(scoring_sink(schema, scorer, folder, run, batch_size, attempts, commit_rows))
    todo.write.format("gabarito_scoring").mode("append").save()
    answered, failed = (logged(rows, f"{folder}/{kind}", schema) for kind in (ANSWERED, f"{FAILED}/{run}"))
    found = [df for df in (answered, failed) if df is not None]
    if not found:
        return spark.createDataFrame([], schema).drop(CALL)
    # Attempts that ran side by side may both have logged a row; an answer wins over a failure.
    both = found[0].unionByName(found[1]) if len(found) == 2 else found[0]
    once = both.groupBy(CALL).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in schema.names]), F.struct(F.col("error").isNotNull(), "model_answer", "error")).alias("row"))
    return once.join(rows.select(CALL), CALL, "left_semi").select("row.*").drop(CALL)

"""Replacing all partitions of some owners in a partitioned table, so that a stopped run can be finished.

The partitions of a batch are overwritten and the other partitions of its owners removed. An
intent file in the table's folder names the staged batch and the folders to remove before
anything changes; whoever replaces next first finishes what it finds. Readers do not see the
file, as its name begins with an underscore. Two replacements of one table must not run at once.
"""

import json
import warnings
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from gabarito.sources.tables import table_exists, write_table
from gabarito.staging import delete_path, scratch_path

WRITING, WRITTEN = "_replacing.json", "_replaced.json"
# Fixed value: the folder name of a null or empty partition value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class Folder:
    """A folder on whatever file system holds it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.root = self.path_of(path)
        self.files = self.root.getFileSystem(spark._jsc.hadoopConfiguration())

    def path_of(self, *parts: object) -> object:
        return self.spark._jvm.org.apache.hadoop.fs.Path(*parts)

    def child(self, name: str) -> object:
        return self.path_of(self.root, name)

    def has(self, name: str) -> bool:
        return self.files.exists(self.child(name))

    def read(self, name: str) -> str:
        stream = self.files.open(self.child(name))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self.files.create(self.child(name), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def rename(self, name: str, to: str) -> None:
        if not self.files.rename(self.child(name), self.child(to)):
            raise OSError(f"could not rename {name} to {to} in {self.root}")

    def remove(self, name: str) -> None:
        delete_path(self.spark, self.child(name).toString())

    def folders(self, name: str | None = None) -> list[str]:
        """Names of the folders in this one, or in one of them."""
        at = self.child(name) if name else self.root
        return [s.getPath().getName() for s in self.files.listStatus(at) if s.isDirectory()]


def partition_value(folder: str, key: str) -> str | None:
    """The value a partition folder's name stands for; None if it is no partition of `key`, or one without a value."""
    name, found, value = folder.partition("=")
    return unquote(value) if found and name == key and value != NO_VALUE else None


def stale_partitions(folder: Folder, keys: list[str], covered: set[tuple[str, str]]) -> list[str]:
    """Partition folders of the owners in `covered` that hold none of its (owner, part) pairs."""
    owners = {owner for owner, _ in covered}
    stale = []
    for outer in sorted(folder.folders()):
        owner = partition_value(outer, keys[0])
        if owner in owners:
            parts = sorted(folder.folders(outer))
            stale += [f"{outer}/{p}" for p in parts if (owner, partition_value(p, keys[1])) not in covered]
    return stale


def replace_owners(batch: DataFrame, path: str, keys: list[str]) -> None:
    """Store `batch` in the table at `path`, partitioned by `keys` (owner, part): its owners keep nothing else.

    The batch is computed once, into a staged copy. Only its distinct keys reach the driver. A
    null or empty key is an error, as it names no partition. An empty batch changes nothing.
    """
    spark, copy = batch.sparkSession, scratch_path(batch.sparkSession, "batch")
    finish_replacement(spark, path, keys)
    batch.write.parquet(copy)
    rows = spark.read.schema(batch.schema).parquet(copy).select(batch.columns)
    covered = {tuple(r) for r in rows.select(*keys).distinct().collect()}
    if any(not value for pair in covered for value in pair):
        raise ValueError(f"every row needs {' and '.join(keys)}")
    if not covered:
        return
    folder = Folder(spark, path)
    stale = stale_partitions(folder, keys, covered) if folder.files.exists(folder.root) else []
    folder.write(WRITING, json.dumps({"batch": copy, "schema": batch.schema.json(), "stale": stale}))
    _carry_out(rows, path, keys, folder, stale)


def finish_replacement(spark: SparkSession, path: str, keys: list[str]) -> bool:
    """Finish what a stopped run has left at `path`; tells whether there was anything.

    If it stopped before its rows were written and its staged batch is gone, nothing is removed:
    a warning says so, and that batch has to be stored again.
    """
    folder = Folder(spark, path)
    if folder.has(WRITTEN):
        _clean_up(folder, json.loads(folder.read(WRITTEN))["stale"])
        return True
    if not folder.has(WRITING):
        return False
    intent = json.loads(folder.read(WRITING))
    if table_exists(spark, intent["batch"]):
        schema = StructType.fromJson(json.loads(intent["schema"]))
        rows = spark.read.schema(schema).parquet(intent["batch"]).select(schema.names)
        _carry_out(rows, path, keys, folder, intent["stale"])
    else:
        warnings.warn(f"a stopped replacement at {path} lost its rows in {intent['batch']}; store them again", stacklevel=2)
        folder.remove(WRITING)
    return True


def _carry_out(rows: DataFrame, path: str, keys: list[str], folder: Folder, stale: list[str]) -> None:
    write_table(rows, path, keys)
    folder.rename(WRITING, WRITTEN)
    _clean_up(folder, stale)


def _clean_up(folder: Folder, stale: list[str]) -> None:
    for name in stale:
        folder.remove(name)
    folder.remove(WRITTEN)

"""Where intermediate results are cut, and how a side of a join earns its broadcast."""

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"
BROADCAST_LIMIT = 64 * 1024 * 1024
SALTS = 64


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder; a private one only in local mode where none is set."""
    folder = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if folder:
        return folder
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="gabarito-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there, on whatever file system holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.delete(target, True) and files.exists(target):
        raise OSError(f"could not remove {path}")


def clear_scratch(spark: SparkSession) -> None:
    """Remove all staged copies this process has made; for the end of a job that has stored its result."""
    while _scratch:
        delete_path(spark, _scratch.pop())


def pinned(df: DataFrame) -> DataFrame:
    """`df` checkpointed in the shared folder: computed once, same rows for every later pass."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


def staged(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """`df` as a written table in the shared folder, for results that several passes prune."""
    path = scratch_path(df.sparkSession, name)
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns])


def pinned_and_measured(df: DataFrame) -> tuple[DataFrame, int]:
    """`df` pinned, and an upper estimate of its bytes taken while it was written."""
    seen = Observation()
    row = F.octet_length(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}))
    kept = pinned(df.observe(seen, F.sum(row.cast("long")).alias("bytes")))
    return kept, 2 * (seen.get["bytes"] or 0)


def small_join(
    fact: DataFrame,
    dim: DataFrame,
    on: list[str],
    how: str = "inner",
    spread: Column | None = None,
    limit: int = BROADCAST_LIMIT,
    salts: int = SALTS,
) -> DataFrame:
    """Join a fact with a side that is normally tiny, without betting on it.

    The side is pinned and measured. Under `limit` it is broadcast, so the fact is not
    shuffled. Beyond it both sides are shuffled on the key plus a salt taken from `spread`
    (a column with many values per key), so a key that holds a third of the fact is split
    over `salts` tasks instead of landing in one.
    """
    dim, size = pinned_and_measured(dim)
    if size <= limit:
        return fact.join(F.broadcast(dim), on, how)
    if spread is None:
        return fact.join(dim, on, how)
    salt = "__salt"
    wide = dim.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = fact.withColumn(salt, F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    return salted.join(wide, [*on, salt], how).drop(salt)

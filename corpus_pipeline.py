"""Corpus preparation in five stages: documents in, token ids out.

Every stage reads what its predecessor kept, and all but the last return the columns of the
documents they got. Columns of the input that are named like a result of an operator are put
aside meanwhile and come back unchanged.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gabarito.llm.common import ship, table
from gabarito.llm.decontamination import find_benchmark_words, is_contaminated
from gabarito.llm.jaccard_join import near_duplicates
from gabarito.llm.language_id import UNDETERMINED, identify_languages, train_on_sample
from gabarito.llm.pieces import encode_texts
from gabarito.llm.queries import PIECES, digest
from gabarito.llm.secret_scan import redacted, scan_secrets
from gabarito.staging import BROADCAST_LIMIT, pinned_and_measured, scratch_path, small_join

LEAST_SCORE = 0.3  # of the language network; a short clean text in a known language lies above


def keeping(docs: DataFrame, names: list[str], stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`stage` applied while columns of these names are out of its way; the columns of `docs` come back."""
    aside = {c: f"_aside_{i}" for i, c in enumerate(docs.columns) if c.lower() in names}
    done = stage(docs.withColumnsRenamed(aside))
    return done.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language: no letter, or a score below LEAST_SCORE.

    The network learns from a bounded sample of the labelled documents themselves. Without any
    label nothing is known of languages, and only documents without a letter go.
    """
    ship(spark)
    net = train_on_sample(docs)

    def stage(rows: DataFrame) -> DataFrame:
        if net is None:
            return rows.where(F.col("text").rlike(r"\p{L}"))
        found = identify_languages(rows, net)
        return found.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_SCORE))

    return keeping(docs, ["lang_pred", "score"], stage)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest doc_id of every group of near duplicates.

    A row is its doc_id and text, told by a 128-bit hash of the text, so rows that share a
    doc_id but not a text are judged one by one; of a group's rows with the smallest doc_id the
    one with the smallest hash stays. Of rows that share both, the one whose columns, written as
    JSON, come first stays. Documents without a doc_id stay, as do those without words. The rows to drop are few against the texts, which
    are not shuffled while they can be broadcast.
    """
    ship(spark)
    key = ["doc_id", "_hash_1", "_hash_2"]

    def stage(rows: DataFrame) -> DataFrame:
        rows = rows.withColumns({key[1]: F.xxhash64("text"), key[2]: F.xxhash64(F.lit(1), "text")})
        row = F.when(F.col("doc_id").isNotNull(), F.struct(*key))
        found = near_duplicates(rows.select(row.alias("row"), "text"), id_col="row")
        dropped = found.where(F.col("id") != F.col("component_id")).select("id.*").distinct()
        kept = small_join(rows, dropped, key, how="left_anti")
        repeated = rows.groupBy(*key).count().where("count > 1 AND doc_id IS NOT NULL").select(*key)
        repeated, size = pinned_and_measured(repeated)
        if size <= BROADCAST_LIMIT:
            repeated = F.broadcast(repeated)
        again = kept.join(repeated, key, "left_semi")
        row = F.struct(*[F.col(f"`{c}`") for c in again.columns])
        first = F.min_by(row, F.to_json(row)).alias("row")
        again = again.groupBy(F.col("doc_id").alias("_id"), F.col("text").alias("_text")).agg(first).select("row.*")
        return kept.join(repeated, key, "left_anti").unionByName(again)

    return keeping(docs, key[1:], stage)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a word in twenty or more lies in a window of the benchmark."""
    ship(spark)
    benchmark = table(spark, sf_dir, "benchmark")

    def stage(rows: DataFrame) -> DataFrame:
        return find_benchmark_words(rows, benchmark).where(~is_contaminated())

    return keeping(docs, ["n_words", "spans", "items"], stage)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret in the texts: all base spans, and other tokens that only their owner has.

    Tokens that many sources share are examples and stay. `n_chars` follows the text.
    """

    def stage(rows: DataFrame) -> DataFrame:
        found = scan_secrets(rows)
        clean = {"text": redacted()}
        if "n_chars" in rows.columns:
            touched = F.size("spans") > 0
            clean["n_chars"] = F.when(touched, F.length(redacted())).otherwise(F.col("n_chars")).cast(rows.schema["n_chars"].dataType)
        return found.withColumns(clean)

    # The scan's result and its own working columns.
    names = ["spans", "_row", "_base", "_candidates", "_verdicts", "_owner", "_repository"]
    return keeping(docs, names, stage)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`doc_id`, the token `ids`, their number, and digests of ids and decoded text."""
    ship(spark)
    found = encode_texts(docs.select("doc_id", "text"), PIECES, keep_text=False)
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        digest(F.concat_ws(",", F.col("ids").cast("array<string>"))).alias("ids_sha256"),
        digest(F.col("decoded")).alias("decoded_sha256"),
        "ids",
    )


STAGES = [
    ("language", language),
    ("distinct_documents", distinct_documents),
    ("decontaminated", decontaminated),
    ("without_secrets", without_secrets),
    ("encoded", encoded),
]

# A trained network and a tokenizer are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

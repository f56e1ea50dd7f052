"""Upsert, leaderboard and metadata queries."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import views as V
from catalog.sql import query, quoted
from gabarito.operators import board as B
from gabarito.operators.metrics import evaluate
from gabarito.operators.upsert import (
    keep_last,
    skip_existing,
    upsert,
    upsert_board,
    upsert_eval,
)
from gabarito.plans.leaderboard import store_board
from gabarito.registry import AREAS, BOARD, DESCRIPTIONS, board_table
from gabarito.schemas import EVAL
from gabarito.sources.tables import read_table
from gabarito.staging import pinned, scratch_path

QUERIES = {}
SQL = {}
SCORED = sorted(V.SHIFTS)


# --- upserts


def upsert_by_model_bench(spark: SparkSession, sf: str) -> DataFrame:
    """The batch replaces just the (model, benchmark) pairs it holds."""
    return upsert(V.old_answers(spark, sf), V.new_answers(spark, sf), spread=F.col("item_key"))


QUERIES["upsert_answers_model_bench"] = upsert_by_model_bench
SQL["upsert_answers_model_bench"] = query(
    """SELECT * FROM new_answers UNION ALL SELECT * FROM old_answers
    WHERE NOT (model_name = 'beta' AND benchmark = 'tweetsentbr')"""
)


def upsert_by_model(spark: SparkSession, sf: str) -> DataFrame:
    """The batch replaces everything its models had."""
    return upsert(
        V.old_answers(spark, sf), V.new_answers(spark, sf), ["model_name"], spread=F.col("item_key")
    )


QUERIES["upsert_answers_model"] = upsert_by_model
SQL["upsert_answers_model"] = query(
    "SELECT * FROM new_answers UNION ALL SELECT * FROM old_answers WHERE model_name <> 'beta'"
)


def upserted_eval(spark: SparkSession, sf: str) -> DataFrame:
    """A model scored again on one benchmark loses its other rows."""
    rows = V.answers(spark, sf)
    old = evaluate(rows.where(F.col("item_key") % 2 == 0))
    new = evaluate(rows.where((F.col("model_name") == "beta") & (F.col("benchmark") == "tweetsentbr")))
    return V.rounded(upsert_eval(old, new), EVAL.names[2:])


QUERIES["upsert_eval"] = upserted_eval
SQL["upsert_eval"] = query(
    "SELECT model_name, benchmark, " + ", ".join(f"round({c}, 6) AS {c}" for c in EVAL.names[2:]) + " FROM eval_rows"
).replace(
    "FROM raw_answers r JOIN descriptors USING (benchmark)",
    """FROM raw_answers r JOIN descriptors USING (benchmark)
    WHERE CASE WHEN model_name = 'beta' THEN benchmark = 'tweetsentbr' ELSE item_key % 2 = 0 END""",
)


def board_version(spark: SparkSession, sf: str, divisor: int, version: int) -> DataFrame:
    key = F.col("model_key")
    return V.supplier_models(spark, sf).where(key % divisor == 0).select(
        "model_name",
        (F.col("s_acctbal") + version).alias("score"),
        (key + version * 1000000).alias("seq"),
    )


def upserted_board(spark: SparkSession, sf: str) -> DataFrame:
    """Overwriting upsert: new rows win, and of repeated old rows the last one stays."""
    old = board_version(spark, sf, 1, 1).unionByName(board_version(spark, sf, 2, 2))
    return upsert_board(old, board_version(spark, sf, 3, 0), sequence="seq")


def appended_board(spark: SparkSession, sf: str) -> DataFrame:
    return upsert_board(board_version(spark, sf, 2, 1), board_version(spark, sf, 3, 0), overwrite=False)


VERSION = """SELECT s_name AS model_name, s_acctbal + {v} AS score, s_suppkey + {v} * 1000000 AS seq
    FROM supplier WHERE s_suppkey % {d} = 0"""
QUERIES["upsert_board"] = upserted_board
SQL["upsert_board"] = f"""
WITH old AS ({VERSION.format(v=1, d=1)} UNION ALL {VERSION.format(v=2, d=2)}), new AS ({VERSION.format(v=0, d=3)})
SELECT model_name, score, seq FROM new UNION ALL
SELECT model_name, score, seq FROM (
    SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY seq DESC) AS rn FROM old
    WHERE model_name NOT IN (SELECT model_name FROM new)) WHERE rn = 1"""
QUERIES["append_board"] = appended_board
SQL["append_board"] = f"{VERSION.format(v=1, d=2)} UNION ALL {VERSION.format(v=0, d=3)}"


def kept_last(spark: SparkSession, sf: str) -> DataFrame:
    """Last event per user and type."""
    events = V.table(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    return keep_last(events, ["user_id", "event_type"], F.col("event_id"))


QUERIES["keep_last"] = kept_last
SQL["keep_last"] = """
SELECT user_id, event_type, event_id, value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn FROM events)
WHERE rn = 1"""


def skipped_existing(spark: SparkSession, sf: str) -> DataFrame:
    models = V.supplier_models(spark, sf).select("model_name", "model_path")
    return skip_existing(models, board_version(spark, sf, 3, 1))


QUERIES["skip_existing"] = skipped_existing
SQL["skip_existing"] = query("SELECT model_name, model_path FROM supplier_models WHERE model_key % 3 <> 0")


# --- scores


def bench_score(spark: SparkSession, sf: str) -> DataFrame:
    """Eval rows with area, display column and score."""
    scores = B.bench_scores(evaluate(V.answers(spark, sf)))
    return V.rounded(scores, ["score"]).select("model_name", "benchmark", "area", "column", "score")


QUERIES["bench_score"] = bench_score
SQL["bench_score"] = query(
    'SELECT model_name, benchmark, area, board_column AS "column", round(score, 6) AS score FROM scores'
)


def exists_by_benchmark(spark: SparkSession, sf: str) -> DataFrame:
    return B.benchmark_exists(B.bench_scores(evaluate(V.answers(spark, sf))))


QUERIES["benchmark_exists"] = exists_by_benchmark
SQL["benchmark_exists"] = query(
    "SELECT benchmark, benchmark IN (SELECT benchmark FROM existing) AS has_scores FROM board_dim"
)


def area_means(spark: SparkSession, sf: str) -> DataFrame:
    return V.rounded(B.area_means(B.bench_scores(V.eval_rows(spark, sf))), ["mean_score"])


QUERIES["area_means"] = area_means
SQL["area_means"] = query(
    """SELECT model_name, area, round(avg(score), 6) AS mean_score FROM scores
    WHERE benchmark IN (SELECT benchmark FROM existing) GROUP BY ALL"""
)


def overall_mean(spark: SparkSession, sf: str) -> DataFrame:
    """One model did not run one of the benchmarks, which then counts as zero for it."""
    rows = V.eval_rows(spark, sf)
    ran = rows.where(~((F.col("model_name") == "gamma") & (F.col("benchmark") == "oab")))
    return V.rounded(B.overall_means(B.bench_scores(ran)), ["overall_mean"])


QUERIES["overall_mean"] = overall_mean
SQL["overall_mean"] = query(
    """SELECT model_name, round(sum(CASE WHEN model_name = 'gamma' AND benchmark = 'oab' THEN 0 ELSE score END)
        / (SELECT count(*) FROM existing), 6) AS overall_mean
    FROM scores WHERE benchmark IN (SELECT benchmark FROM existing) GROUP BY ALL"""
)


def first_score(spark: SparkSession, sf: str) -> DataFrame:
    """Events as scores: the earliest per (user, type)."""
    rows = V.table(spark, sf, "events").select(
        F.col("user_id").alias("model_name"), F.col("event_type").alias("benchmark"), F.col("value").alias("score"), "event_id"
    )
    return B.first_scores(rows, "event_id")


QUERIES["first_score"] = first_score
SQL["first_score"] = """
SELECT user_id AS model_name, event_type AS benchmark, arg_min(value, event_id) AS score
FROM events GROUP BY ALL"""


def metric_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return B.metric_pivot(evaluate(V.answers(spark, sf)), SCORED)


HEADLINE = "CASE WHEN benchmark = 'assin2sts' THEN pearson_correlation ELSE accuracy END"
QUERIES["metric_pivot"] = metric_pivot
SQL["metric_pivot"] = query(
    'SELECT model_name AS "Model", '
    + ", ".join(f"max(cell) FILTER (benchmark = '{b}') AS {b}" for b in SCORED)
    + f""", round_even(avg(cell), 3) AS avg
    FROM (SELECT model_name, benchmark, round_even(coalesce({HEADLINE}, 0.0), 3) AS cell FROM eval_rows)
    GROUP BY model_name"""
)


def parse_error_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return B.parse_error_pivot(evaluate(V.answers(spark, sf)), SCORED)


QUERIES["parse_error_pivot"] = parse_error_pivot
SQL["parse_error_pivot"] = query(
    'SELECT model_name AS "Model", '
    + ", ".join(f"max(round_even(non_parsed_rate, 3)) FILTER (benchmark = '{b}') AS {b}" for b in SCORED)
    + " FROM eval_rows GROUP BY model_name"
)


def unmapped(spark: SparkSession, sf: str) -> DataFrame:
    return B.unmapped_benchmarks(evaluate(V.answers(spark, sf)))


QUERIES["unmapped_benchmarks"] = unmapped
SQL["unmapped_benchmarks"] = query(
    "SELECT benchmark, count(DISTINCT model_name) AS n_models FROM scores WHERE area IS NULL GROUP BY benchmark"
)


def area_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Area of every single answer, a dimension join on the fact table."""
    info = B.with_board_info(V.raw_answers(spark, sf), board_table(spark), "item_key")
    return info.select("benchmark", "item_key", "model_name", "area", "column")


QUERIES["benchmark_area"] = area_lookup
SQL["benchmark_area"] = query(
    """SELECT benchmark, item_key, model_name, area, board_column AS "column"
    FROM raw_answers LEFT JOIN board_dim USING (benchmark)"""
)


# --- metadata and the wide board


def supplier_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as models: overrides, fetched facts, defaults and custom flags."""
    models = V.supplier_models(spark, sf)
    flags = models.select("model_name", (F.col("model_key") % 10 == 3).alias("is_custom")).where(
        F.col("model_key") % 2 == 1
    )
    return B.model_metadata(
        models.select("model_name"), V.metadata_overrides(spark, sf), V.metadata_fetched(spark, sf), flags
    )


QUERIES["model_metadata"] = supplier_metadata
SQL["model_metadata"] = query(
    """SELECT model_name,
        CASE WHEN k % 10 = 3 THEN 'Custom' WHEN k % 2 <> 0 THEN 'SFT' WHEN hub AND k % 8 = 2 THEN 'SFT' ELSE 'Base' END AS "T",
        CASE WHEN hub THEN 'hub/' || k ELSE model_name END AS "Modelo",
        CASE WHEN k % 10 = 3 THEN 'Custom' WHEN k % 2 <> 0 THEN 'SFT : Supervised Finetuning'
            WHEN hub AND k % 8 = 2 THEN 'SFT: Supervised Finetuning' ELSE 'Base' END AS "Tipo",
        CASE WHEN k % 7 = 0 THEN 'A1,A2' WHEN hub AND k % 3 = 1 THEN 'ArchX' END AS "Arquitetura",
        CASE WHEN k % 3 <> 0 THEN 'Original' WHEN hub AND k % 9 = 0 THEN 'Adapter' ELSE 'Original' END AS "Tipo de Peso",
        CASE WHEN k % 4 <> 0 THEN 'BF16' WHEN hub THEN 'F32' END AS "Precisão",
        CASE WHEN k % 2 <> 0 THEN 'research' WHEN hub AND k % 3 = 0 THEN 'mit' ELSE 'unknown' END AS "Licença",
        CASE WHEN k % 6 = 1 THEN 7.0 WHEN hub AND k % 5 = 1 THEN round_even(k * 1000000 / 1e9, 3) ELSE 0.0 END::DOUBLE AS "#Params (B)",
        CASE WHEN hub THEN k * 3 ELSE 0 END AS "Hub Likes",
        CASE WHEN hub THEN k % 2 <> 0 ELSE false END AS "Disponível no hub",
        CASE WHEN hub THEN 'sha' || k ELSE 'unknown' END AS "SHA do modelo"
    FROM (SELECT model_name, model_key AS k, model_key % 11 <> 0 AS hub FROM supplier_models WHERE model_key % 5 <> 0)"""
)


def job_metadata(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Metadata of the three models of the answers; one of them is unknown."""
    overrides = spark.createDataFrame(
        [("alpha", "org/alpha", "SFT", "apache-2.0", 7.0), ("beta", "org/beta", None, None, None), ("gamma", None, None, None, None)],
        "model_name string, model_id string, t string, licenca string, params_b double",
    )
    return B.model_metadata(rows.select("model_name").distinct(), overrides)


def wide_leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    """The published board, from raw answers all the way."""
    rows = V.eval_rows(spark, sf)
    wide = B.leaderboard(rows, job_metadata(spark, rows))
    return V.rounded(wide, [*AREAS, *[c for _, _, c in BOARD], B.OVERALL])


AREA_COLUMNS = ",\n".join(
    f"""coalesce(round(avg(score) FILTER (area = {quoted(a)} AND benchmark IN (SELECT benchmark FROM existing)), 6), 0.0)
        AS "{a}\""""
    for a in AREAS
)
BENCH_COLUMNS = ",\n".join(
    f"""coalesce(round(max(score) FILTER (benchmark = '{b}'), 6), 0.0) AS "{c}\"""" for b, _, c in BOARD
)
DESCRIPTION_COLUMNS = ",\n".join(
    (f"CAST({v} AS DOUBLE)" if isinstance(v, float) else quoted(v))
    + f' AS "{n} (datasets)"' * (n in AREAS)
    + f' AS "{n}"' * (n not in AREAS)
    for n, v in DESCRIPTIONS.items()
)
QUERIES["leaderboard"] = wide_leaderboard
SQL["leaderboard"] = query(
    f"""SELECT model_name, CASE model_name WHEN 'alpha' THEN 'SFT' ELSE 'Base' END AS "T", model_name AS "Modelo", 'Base' AS "Tipo",
        CAST(NULL AS VARCHAR) AS "Arquitetura", 'Original' AS "Tipo de Peso", CAST(NULL AS VARCHAR) AS "Precisão",
        CASE model_name WHEN 'alpha' THEN 'apache-2.0' ELSE 'unknown' END AS "Licença",
        CASE model_name WHEN 'alpha' THEN 7.0 ELSE 0.0 END::DOUBLE AS "#Params (B)", CAST(0 AS BIGINT) AS "Hub Likes",
        false AS "Disponível no hub", 'unknown' AS "SHA do modelo",
        {AREA_COLUMNS}, {BENCH_COLUMNS}, {DESCRIPTION_COLUMNS},
        round(sum(score) FILTER (benchmark IN (SELECT benchmark FROM existing))
            / (SELECT count(*) FROM existing), 6) AS "Média Geral"
    FROM scores WHERE model_name <> 'gamma' GROUP BY model_name"""
)


def stored_again(spark: SparkSession, sf: str) -> DataFrame:
    """A board stored twice, kept and overwritten; both models show the same hub id."""
    answers = V.answers(spark, sf)
    overrides = spark.createDataFrame([("alpha", "org/alpha"), ("beta", "org/beta")], "model_name string, model_id string")
    fetched = spark.createDataFrame(
        [("org/alpha", "hub/shared"), ("org/beta", "hub/shared")], "model_id string, hub_id string"
    ).withColumns(
        {c: F.lit(None).cast(kind) for c, kind in [("sha", "string"), ("likes", "long"), ("private", "boolean"), ("license", "string"), ("architectures", "array<string>"), ("precision", "string"), ("params_total", "long"), ("base_model", "array<string>"), ("is_adapter", "boolean")]}
    )
    first, second = pinned(evaluate(answers.where(F.col("item_key") % 2 == 0))), V.eval_rows(spark, sf)
    boards = []
    for overwrite in (False, True):
        path = scratch_path(spark, "board")
        for rows in (first, second, second):
            store_board(spark, rows, path, overrides, overwrite=overwrite, fetched=fetched)
        stored = read_table(spark, path, B.board_schema())
        boards.append(stored.select("model_name", "Modelo", F.round(B.OVERALL, 6).alias("overall"), F.lit(overwrite).alias("overwritten")))
    return boards[0].unionByName(boards[1])


QUERIES["board_stored_again"] = stored_again
OVERALL_SQL = """SELECT model_name, 'hub/shared' AS "Modelo",
    round(sum(score) FILTER (benchmark IN (SELECT benchmark FROM existing)) / (SELECT count(*) FROM existing), 6) AS overall,
    {} AS overwritten FROM scores WHERE model_name <> 'gamma' GROUP BY model_name"""
EVEN = "FROM raw_answers r JOIN descriptors USING (benchmark)"
SQL["board_stored_again"] = "SELECT * FROM ({}) UNION ALL SELECT * FROM ({})".format(
    query(OVERALL_SQL.format("false")).replace(EVEN, f"{EVEN} WHERE item_key % 2 = 0"),
    query(OVERALL_SQL.format("true")),
)


def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    models = V.supplier_models(spark, sf).select("model_name")
    return B.run_summary(models, board_version(spark, sf, 3, 1), V.metadata_overrides(spark, sf))


QUERIES["run_summary"] = run_summary
SQL["run_summary"] = query(
    """SELECT count(*) FILTER (model_key % 3 <> 0 AND model_key % 5 <> 0) AS n_processed,
        count(*) FILTER (model_key % 3 = 0) AS n_skipped_existing,
        count(*) FILTER (model_key % 3 <> 0 AND model_key % 5 = 0) AS n_skipped_unknown
    FROM supplier_models"""
)

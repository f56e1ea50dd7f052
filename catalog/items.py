"""Cleaning, indexing, sharding, source and few-shot queries."""

import random
import warnings
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import views as V
from catalog.sql import query
from gabarito.functions.choices import read_alternatives, sanitize_alternatives
from gabarito.functions.text import escape_backslashes
from gabarito.operators.clean import (
    bench_id,
    clean_benchmark,
    complete_rows,
    drop_index_columns,
    exclude_models,
    string_columns,
)
from gabarito.operators.index import (
    contiguous_shard,
    dense_index,
    head_percent,
    prompt_ids,
    renumber,
    round_robin_shard,
    with_dense_index,
)
from gabarito.operators.shots import (
    DIGITS,
    draw_ranks,
    with_experiments,
    with_shots,
    with_shots_per_row,
)
from gabarito.plans.answers import store_answers_by_model
from gabarito.registry import benchmark
from gabarito.schemas import ANSWERS
from gabarito.sources.csv import read_csv, read_shards, write_csv, write_shards
from gabarito.sources.tables import (
    load_benchmark,
    read_table,
    read_table_or_csv,
    union_subsets,
    write_table,
)
from gabarito.staging import scratch_path, staged

QUERIES = {}
SQL = {}

# Drawn positions that SQL can repeat: distinct, and spread over a whole benchmark from its last row on.
SHOTS, EXPERIMENTS = 4, 2


def spread_ranks(sizes: DataFrame) -> DataFrame:
    """(benchmark, experiment, ranks) from (benchmark, n_rows)."""
    rank = "transform(sequence(0, {k} - 1), pos -> n_rows - 2 - pos * ((n_rows - 1) div {k}) - experiment * ((n_rows - 1) div 9))"
    return with_experiments(sizes, EXPERIMENTS).select("benchmark", "experiment", F.expr(rank.format(k=SHOTS)).alias("ranks"))


def ranks_sql(indexed: str) -> str:
    """The same, one row each, over a view with the benchmark and n_rows of every item."""
    return f"""ranks AS (
        SELECT benchmark, experiment, pos,
            n_rows - 2 - pos * ((n_rows - 1) // {SHOTS}) - experiment * ((n_rows - 1) // 9) AS rank
        FROM (SELECT DISTINCT benchmark, n_rows FROM {indexed}),
            (SELECT unnest(range({EXPERIMENTS})) AS experiment), (SELECT unnest(range({SHOTS})) AS pos))"""


RANKS_SQL = ranks_sql("indexed")


def gappy_parts(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("p_partkey")
    return V.table(spark, sf, "part").select(
        key.alias("item_key"),
        F.when(key % 7 == 0, "").when(key % 11 != 0, F.col("p_name")).alias("question"),
        F.when(key % 5 != 0, F.col("p_size")).alias("answer"),
        F.when(key % 3 == 0, "").otherwise(F.col("p_type")).alias("remark"),
    )


GAPPY_SQL = """gappy AS (
    SELECT p_partkey AS item_key,
        CASE WHEN p_partkey % 7 = 0 THEN '' WHEN p_partkey % 11 <> 0 THEN p_name END AS question,
        CASE WHEN p_partkey % 5 <> 0 THEN p_size END AS answer,
        CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_type END AS remark
    FROM part)"""


def complete_required(spark: SparkSession, sf: str) -> DataFrame:
    """Required columns present; one required column the table does not have is ignored."""
    return complete_rows(gappy_parts(spark, sf), ["question", "answer", "not_there"])


QUERIES["complete_rows"] = complete_required
SQL["complete_rows"] = query(
    "SELECT * FROM gappy WHERE question <> '' AND answer IS NOT NULL", GAPPY_SQL
)


def complete_all(spark: SparkSession, sf: str) -> DataFrame:
    """Without a declaration all columns are required."""
    return complete_rows(gappy_parts(spark, sf))


QUERIES["complete_rows_all_columns"] = complete_all
SQL["complete_rows_all_columns"] = query(
    "SELECT * FROM gappy WHERE question <> '' AND answer IS NOT NULL AND remark <> ''", GAPPY_SQL
)


def standard_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Renamed, text-typed labels and the benchmark constant; stored booleans become 1 and 0."""
    rows = V.items_yes_no(spark, sf).select(
        "item_key", F.col("sentence").alias("text"), (F.col("label") == "1").alias("is_toxic")
    )
    return clean_benchmark(rows, benchmark("toxsyn_pt")).select("item_key", "label", "benchmark")


QUERIES["standard_labels"] = standard_labels
SQL["standard_labels"] = query(
    "SELECT item_key, label, 'toxsyn_pt' AS benchmark FROM items_yes_no WHERE sentence <> ''"
)


def index_label_letters(spark: SparkSession, sf: str) -> DataFrame:
    """Gold labels stored as positions become letters."""
    rows = V.table(spark, sf, "part").select(
        F.col("p_partkey").alias("item_key"),
        F.col("p_name").alias("question"),
        *[F.col(c).alias(o) for c, o in zip(["p_brand", "p_type", "p_name", "p_brand"], ["option_a", "option_b", "option_c", "option_d"])],
        (F.col("p_partkey") % 4).alias("answer"),
    )
    return clean_benchmark(rows, benchmark("include")).select("item_key", "label", "benchmark")


QUERIES["index_label_letters"] = index_label_letters
SQL["index_label_letters"] = query("SELECT item_key, label, 'include' AS benchmark FROM items_choice")


def keyed_items(spark: SparkSession, sf: str, names=tuple(V.SHIFTS)) -> DataFrame:
    parts = [V.ITEMS[b](spark, sf).select(F.lit(b).alias("benchmark"), "item_key", "label") for b in names]
    return reduce(DataFrame.unionByName, parts)


KEYED_SQL = """keyed AS (
    SELECT 'hatebr' AS benchmark, item_key, label FROM items_yes_no
    UNION ALL SELECT b, item_key, label FROM items_choice, (VALUES ('oab'), ('mmlu_en')) v(b)
    UNION ALL SELECT 'tweetsentbr', item_key, label FROM items_tone
    UNION ALL SELECT 'assin2sts', item_key, label FROM items_number
    UNION ALL SELECT 'aime24', item_key, label FROM items_integer)"""
INDEXED_SQL = """indexed AS (
    SELECT *, row_number() OVER (PARTITION BY benchmark ORDER BY item_key) - 1 AS idx,
        count(*) OVER (PARTITION BY benchmark) AS n_rows FROM keyed)"""


def bench_index(spark: SparkSession, sf: str) -> DataFrame:
    """Dense index and composed key of every item of every benchmark."""
    indexed = dense_index(keyed_items(spark, sf), ["benchmark"], ["item_key"])
    return indexed.withColumn("id_bench", bench_id())


QUERIES["bench_index"] = bench_index
SQL["bench_index"] = query(
    "SELECT benchmark, item_key, idx, n_rows, benchmark || '_' || idx AS id_bench FROM indexed",
    KEYED_SQL,
    INDEXED_SQL,
)


def head_of_benchmarks(spark: SparkSession, sf: str) -> DataFrame:
    """First 7 % of every benchmark, rounded up."""
    return head_percent(dense_index(keyed_items(spark, sf), ["benchmark"], ["item_key"]), 7)


QUERIES["head_percent"] = head_of_benchmarks
SQL["head_percent"] = query(
    """SELECT benchmark, item_key, idx, CAST(ceil(n_rows * 7.0 / 100) AS BIGINT) AS n_rows
    FROM indexed WHERE idx < ceil(n_rows * 7.0 / 100)""",
    KEYED_SQL,
    INDEXED_SQL,
)


def contiguous_shards(spark: SparkSession, sf: str) -> DataFrame:
    """The whole orders table cut into seven runs, written as a file each and read back."""
    rows = V.items_tone(spark, sf).select("item_key")
    indexed = dense_index(rows, [], ["item_key"])
    path = scratch_path(spark, "shards")
    write_shards(indexed.select("item_key", contiguous_shard(F.col("idx"), F.col("n_rows"), 7).alias("shard")), path, shards=7)
    return read_shards(spark, path, rows.schema, expected=7).select("item_key", "shard")


QUERIES["contiguous_shards"] = contiguous_shards
SQL["contiguous_shards"] = query(
    "SELECT item_key, CAST(ntile(7) OVER (ORDER BY item_key) - 1 AS INTEGER) AS shard FROM items_tone"
)


def round_robin_shards(spark: SparkSession, sf: str) -> DataFrame:
    indexed = dense_index(V.items_tone(spark, sf).select("item_key"), [], ["item_key"])
    return indexed.select("item_key", round_robin_shard(F.col("idx"), 7).alias("shard"))


QUERIES["round_robin_shards"] = round_robin_shards
SQL["round_robin_shards"] = query(
    """SELECT item_key, CAST((row_number() OVER (ORDER BY item_key) - 1) % 7 AS INTEGER) AS shard
    FROM items_tone"""
)


def multi_subset_union(spark: SparkSession, sf: str) -> DataFrame:
    """Two subsets of one schema, tagged."""

    def subset(name: str, p: str, key: str) -> DataFrame:
        columns = {key: "item_key", f"{p}_name": "sentence", f"{p}_nationkey": "label", f"{p}_acctbal": "score"}
        return V.table(spark, sf, name).select(*[F.col(c).alias(n) for c, n in columns.items()])

    return union_subsets({"pt": subset("customer", "c", "c_custkey"), "en": subset("supplier", "s", "s_suppkey")})


QUERIES["multi_subset_union"] = multi_subset_union
SQL["multi_subset_union"] = """
SELECT c_custkey AS item_key, c_name AS sentence, c_nationkey AS label, c_acctbal AS score, 'pt' AS subset_name
FROM customer UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 'en' FROM supplier"""


def renumber_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Ids from 1 over the whole answers table, in key order."""
    rows = V.raw_answers(spark, sf).select("benchmark", "item_key", "model_name")
    return renumber(rows, ["benchmark", "item_key", "model_name"])


QUERIES["renumber_ids"] = renumber_ids
SQL["renumber_ids"] = query(
    """SELECT benchmark, item_key, model_name,
        row_number() OVER (ORDER BY benchmark, item_key, model_name) AS id FROM raw_answers"""
)


PAIR = ["hatebr", "oab"]


def indexed_pair(spark: SparkSession, sf: str) -> DataFrame:
    rows = keyed_items(spark, sf, PAIR)
    indexed = with_dense_index(rows, ["benchmark"], ["item_key"]).withColumn("id_bench", bench_id())
    return staged(indexed, "items")


def sizes_of(items: DataFrame) -> DataFrame:
    return items.where(F.col("idx") == 0).select("benchmark", "n_rows")


SHOTS_SQL = """shots AS (
    SELECT q.benchmark, q.idx, q.item_key, q.label, q.n_rows, experiment, pos, s.item_key AS shot_key,
        s.label AS shot_label, s.benchmark || '_' || s.idx AS shot_id
    FROM indexed q JOIN ranks r ON r.benchmark = q.benchmark JOIN indexed s
        ON s.benchmark = q.benchmark AND s.idx = r.rank + CASE WHEN r.rank < q.idx THEN 0 ELSE 1 END
    WHERE q.benchmark IN ('hatebr', 'oab'))"""


def fewshot_shots(spark: SparkSession, sf: str) -> DataFrame:
    """Every item's shots, one row each: never the item itself."""
    items = indexed_pair(spark, sf)
    shot = F.struct(F.col("item_key").alias("shot_key"), F.col("label").alias("shot_label"))
    rows = with_shots(items, spread_ranks(sizes_of(items)), shot)
    return rows.select(
        "benchmark", "item_key", "experiment", F.posexplode("shots").alias("pos", "shot")
    ).select("benchmark", "item_key", "experiment", "pos", "shot.*")


QUERIES["fewshot_shots"] = fewshot_shots
SQL["fewshot_shots"] = query(
    "SELECT benchmark, item_key, experiment, pos, shot_key, shot_label FROM shots",
    KEYED_SQL,
    INDEXED_SQL,
    RANKS_SQL,
    SHOTS_SQL,
)


def fewshot_indices(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of the shots in draw order."""
    items = indexed_pair(spark, sf)
    rows = with_shots(items, spread_ranks(sizes_of(items)), F.col("id_bench"))
    return rows.select("id_bench", "experiment", F.array_join("shots", ",").alias("shot_indices"))


QUERIES["fewshot_indices"] = fewshot_indices
SQL["fewshot_indices"] = query(
    """SELECT benchmark || '_' || idx AS id_bench, experiment, string_agg(shot_id, ',' ORDER BY pos) AS shot_indices
    FROM shots GROUP BY benchmark, idx, experiment""",
    KEYED_SQL,
    INDEXED_SQL,
    RANKS_SQL,
    SHOTS_SQL,
)


def fewshot_seeded(spark: SparkSession, sf: str) -> DataFrame:
    """Ranks drawn by seed 42, 43 and 44."""
    items = indexed_pair(spark, sf)
    rows = with_shots(items, draw_ranks(sizes_of(items), 5, 3), F.col("id_bench"))
    return rows.select("id_bench", "experiment", F.array_join("shots", ",").alias("shot_indices"))


# What Python's generator draws for the row counts of the two benchmarks in the test tables.
SIZES = [87, 399, 3980, 200, 2000, 20000]
SEEDED = ", ".join(
    f"({n}, {e}, {pos}, {rank})"
    for n in SIZES
    for e in range(3)
    for pos, rank in enumerate(random.Random(42 + e).sample(range(n - 1), 5))
)
QUERIES["fewshot_seeded"] = fewshot_seeded
SQL["fewshot_seeded"] = query(
    """SELECT benchmark || '_' || idx AS id_bench, CAST(experiment AS INTEGER) AS experiment,
        string_agg(benchmark || '_' || (rank + CASE WHEN rank < idx THEN 0 ELSE 1 END), ',' ORDER BY pos) AS shot_indices
    FROM indexed JOIN seeded USING (n_rows) WHERE benchmark IN ('hatebr', 'oab') GROUP BY benchmark, idx, experiment""",
    KEYED_SQL,
    INDEXED_SQL,
    f"seeded AS (SELECT * FROM (VALUES {SEEDED}) t(n_rows, experiment, pos, rank))",
)


def fewshot_per_row(spark: SparkSession, sf: str) -> DataFrame:
    """Every row draws its own shots (unseeded mode), reproducible for one run."""
    rows = with_shots_per_row(indexed_pair(spark, sf), 5, 2, 7, F.col("id_bench"))
    return rows.select("id_bench", "experiment", F.array_join("shots", ",").alias("shot_indices"))


QUERIES["fewshot_per_row"] = fewshot_per_row
def floyd_sql(shots: int, seed: int) -> str:
    """Ranks of every (benchmark, idx, experiment), one step of the sampling a subquery."""
    rows = "SELECT benchmark, idx, n_rows, experiment, CAST([] AS BIGINT[]) AS chosen FROM indexed, (SELECT unnest(range(2)) AS experiment)"
    for i in range(shots):
        last = f"(n_rows - 1 - {shots} + {i})"
        number = f"CAST('0x' || substr(md5(concat_ws(':', '{seed}', benchmark, experiment, idx, {i})), 1, {DIGITS}) AS BIGINT)"
        rows = f"""SELECT benchmark, idx, n_rows, experiment, CASE WHEN list_contains(chosen, t)
                THEN chosen[1 : list_position(chosen, t)] || [{last}] || chosen[list_position(chosen, t) + 1 :]
                ELSE [t] || chosen END AS chosen
            FROM (SELECT *, {number} % ({last} + 1) AS t FROM ({rows}))"""
    return rows


SQL["fewshot_per_row"] = query(
    f"""SELECT benchmark || '_' || idx AS id_bench, CAST(experiment AS INTEGER) AS experiment,
        array_to_string([benchmark || '_' || (rank + CASE WHEN rank < idx THEN 0 ELSE 1 END) for rank in chosen], ',') AS shot_indices
    FROM ({floyd_sql(5, 7)}) WHERE benchmark IN ('hatebr', 'oab')""",
    KEYED_SQL,
    INDEXED_SQL,
)


def experiment_melt(spark: SparkSession, sf: str) -> DataFrame:
    """One row per (item, experiment) with sequential ids."""
    items = indexed_pair(spark, sf)
    rows = with_shots(items, spread_ranks(sizes_of(items)), F.col("id_bench"))
    ids = prompt_ids(rows, EXPERIMENTS, ["oab", "hatebr"])
    return ids.select("id", "id_bench", "benchmark", "label", F.array_join("shots", ",").alias("shot_indices"))


QUERIES["experiment_melt"] = experiment_melt
SQL["experiment_melt"] = query(
    """SELECT row_number() OVER (ORDER BY benchmark DESC, idx, experiment) - 1 AS id,
        benchmark || '_' || idx AS id_bench, benchmark, label,
        string_agg(shot_id, ',' ORDER BY pos) AS shot_indices
    FROM shots GROUP BY benchmark, idx, label, experiment""",
    KEYED_SQL,
    INDEXED_SQL,
    RANKS_SQL,
    SHOTS_SQL,
)


def parse_choice_literals(spark: SparkSession, sf: str) -> DataFrame:
    """Stored alternatives read from JSON and literal forms; unreadable ones are null."""
    rows = V.choice_strings(spark, sf).withColumn("a", read_alternatives(F.col("alternatives")))

    def shown(column: str):
        return F.array_join(column, "|", "None")

    return rows.select("item_key", shown("a.text").alias("texts"), shown("a.label").alias("labels"))


QUERIES["parse_choice_literals"] = parse_choice_literals
SQL["parse_choice_literals"] = """
SELECT p_partkey AS item_key,
    CASE p_partkey % 8 WHEN 0 THEN p_name || '|' || p_brand WHEN 1 THEN p_name || '|' || p_brand
        WHEN 2 THEN p_name || '|None' WHEN 3 THEN 'it''s ' || p_name || '|' || p_brand
        WHEN 5 THEN p_name END AS texts,
    CASE WHEN p_partkey % 8 < 4 THEN 'A|B' END AS labels
FROM part"""


def sanitize_choices(spark: SparkSession, sf: str) -> DataFrame:
    """LaTeX-damaged literals repaired and written back as JSON."""
    repaired = sanitize_alternatives(F.col("alternatives"))
    return V.choice_strings(spark, sf).select("item_key", repaired.alias("alternatives"))


QUERIES["sanitize_choices"] = sanitize_choices
SQL["sanitize_choices"] = r"""
SELECT p_partkey AS item_key, CASE p_partkey % 8
    WHEN 0 THEN '{"text":["' || p_name || '","' || p_brand || '"],"label":["A","B"]}'
    WHEN 1 THEN '{"text":["' || p_name || '","' || p_brand || '"],"label":["A","B"]}'
    WHEN 2 THEN '{"text":["' || p_name || '",null],"label":["A","B"]}'
    WHEN 3 THEN '{"text":["it''s ' || p_name || '","' || p_brand || '"],"label":["A","B"]}'
    WHEN 4 THEN '{"text":["$\\uparrow$ ' || p_name || '","\\underline{x}"],"label":["A","B"]}'
    WHEN 5 THEN '{"text":["' || p_name || '"],"label":[]}'
    WHEN 6 THEN '  ' ELSE 'broken [''' || p_name END AS alternatives
FROM part"""


def text_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Answers whose texts need quoting: quotes, commas, line breaks, blanks and nulls."""
    text = F.concat(F.lit('"q", \n'), F.col("model_answer"), F.lit("\\ é"))
    return V.raw_answers(spark, sf).select("benchmark", "item_key", "label", "model_name", "model_answer", text.alias("prompt"))


TEXT_ANSWERS_SQL = r"""text_answers AS (
    SELECT benchmark, item_key, label, model_name, model_answer, '"q", ' || chr(10) || model_answer || '\ é' AS prompt
    FROM raw_answers)"""


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Written as CSV and read back with the fixed schema: nothing changes type or becomes null."""
    rows = text_answers(spark, sf)
    path = scratch_path(spark, "csv")
    write_csv(rows, path)
    return read_csv(spark, path, rows.schema)


QUERIES["csv_roundtrip"] = csv_roundtrip
SQL["csv_roundtrip"] = query("SELECT * FROM text_answers", TEXT_ANSWERS_SQL)


def shard_union(spark: SparkSession, sf: str) -> DataFrame:
    """One CSV folder per shard, some with their columns in another order, read as one table; one is missing."""
    rows = text_answers(spark, sf)
    path = scratch_path(spark, "shards")
    shard = F.pmod("item_key", F.lit(4)).cast("int")
    for number in range(4):
        columns = rows.columns if number % 2 else sorted(rows.columns)
        write_csv(rows.where(shard == number).select(columns), f"{path}/shard={number}")
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        read = read_shards(spark, path, rows.schema, expected=5)
    if not any("[4] of 5" in str(w.message) for w in caught):
        raise ValueError("the missing shard went unnoticed")
    return read.select(*rows.columns, "shard")


QUERIES["shard_union"] = shard_union
SQL["shard_union"] = query(
    "SELECT *, CAST(item_key % 4 AS INTEGER) AS shard FROM text_answers", TEXT_ANSWERS_SQL
)


def table_or_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Half the answers as a table, half as CSV only: each is found where it is."""
    rows = text_answers(spark, sf)
    paths = [scratch_path(spark, "either") for _ in range(2)]
    write_table(rows.where("item_key % 2 = 0"), paths[0])
    write_csv(rows.where("item_key % 2 = 1"), f"{paths[1]}-csv")
    read = [read_table_or_csv(spark, p, f"{p}-csv", rows.schema) for p in paths]
    return read[0].unionByName(read[1].select(rows.columns))


QUERIES["table_or_csv"] = table_or_csv
SQL["table_or_csv"] = query("SELECT * FROM text_answers", TEXT_ANSWERS_SQL)


def loaded_subsets(spark: SparkSession, sf: str) -> DataFrame:
    """A benchmark of two subsets read from its folder: one has a test split, the other only train."""
    root = scratch_path(spark, "sources")
    bench = replace(benchmark("mmlu_pro_x"), split=None)
    for subset, split, table in (("pt", "test", "customer"), ("en", "train", "supplier")):
        rows = V.table(spark, sf, table)
        key, name = rows.columns[:2]
        rows = rows.select(F.col(key).alias("item_key"), F.col(name).alias("question"))
        write_table(rows, f"{root}/{bench.name}/{subset}/{split}")
    return load_benchmark(spark, root, bench).select("item_key", "question", "subset_name")


QUERIES["load_subsets"] = loaded_subsets
SQL["load_subsets"] = """
SELECT c_custkey AS item_key, c_name AS question, 'pt' AS subset_name FROM customer
UNION ALL SELECT s_suppkey, s_name, 'en' FROM supplier"""


def partition_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """Upsert as a dynamic overwrite of just the (model, benchmark) partitions of the batch."""
    keys = ["model_name", "benchmark"]
    path = scratch_path(spark, "answers")
    write_table(V.old_answers(spark, sf), path, keys)
    write_table(V.new_answers(spark, sf), path, keys)
    return read_table(spark, path, V.new_answers(spark, sf).schema)


QUERIES["partition_overwrite"] = partition_overwrite
SQL["partition_overwrite"] = query(
    """SELECT * FROM new_answers UNION ALL SELECT * FROM old_answers
    WHERE NOT (model_name = 'beta' AND benchmark = 'tweetsentbr')"""
)


# What a partition folder's name has to escape, or could be taken to have escaped.
ODD_NAME = " a:b%20=é*?"


def stored_by_model(spark: SparkSession, sf: str) -> DataFrame:
    """A new batch of one model on one benchmark: all its other stored answers go, the other model's stay."""
    path = scratch_path(spark, "answers")
    for rows in (V.old_answers(spark, sf), V.new_answers(spark, sf)):
        odd = rows.withColumn("model_name", F.concat("model_name", F.lit(ODD_NAME)))
        store_answers_by_model(spark, as_stored(odd), path)
    stored = read_table(spark, path, ANSWERS)
    return stored.select("id", "id_bench", "benchmark", "label", "model_name", "model_answer")


def as_stored(rows: DataFrame) -> DataFrame:
    """Raw answers in the stored schema."""
    named = rows.withColumns({"id": F.col("item_key"), "id_bench": F.concat_ws("_", "benchmark", F.col("item_key").cast("string"))})
    return named.select(*[F.col(f.name) if f.name in named.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in ANSWERS])


QUERIES["store_by_model"] = stored_by_model
SQL["store_by_model"] = query(
    f"""SELECT item_key AS id, benchmark || '_' || item_key AS id_bench, benchmark, label, model_name || '{ODD_NAME}' AS model_name, model_answer
    FROM (SELECT * FROM new_answers UNION ALL SELECT * FROM old_answers WHERE model_name <> 'beta')"""
)


def without_index_columns(spark: SparkSession, sf: str) -> DataFrame:
    rows = V.table(spark, sf, "events").withColumns(
        {"__index_level_0__": F.col("event_id"), "Unnamed: 0": F.col("event_id")}
    )
    kept = drop_index_columns(rows)
    return kept.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))  # engines print timestamps differently


QUERIES["drop_index_columns"] = without_index_columns
SQL["drop_index_columns"] = "SELECT * REPLACE (strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts) FROM events"


def as_strings(spark: SparkSession, sf: str) -> DataFrame:
    """Listed columns forced to text, arrays as JSON."""
    rows = V.table(spark, sf, "events").select(
        "event_id",
        F.col("user_id").alias("label"),
        F.array(F.concat(F.lit("x_"), "event_type"), F.lit("y")).alias("shot_indices"),
        F.when(F.col("event_id") % 3 != 0, F.col("user_id")).alias("parsed_model_answer"),
    )
    return string_columns(rows)


QUERIES["string_columns"] = as_strings
SQL["string_columns"] = """
SELECT event_id, CAST(user_id AS VARCHAR) AS label, '["x_' || event_type || '","y"]' AS shot_indices,
    CASE WHEN event_id % 3 <> 0 THEN CAST(user_id AS VARCHAR) END AS parsed_model_answer FROM events"""


def excluded_models(spark: SparkSession, sf: str) -> DataFrame:
    """Rows without a model name stay."""
    rows = V.raw_answers(spark, sf).select("benchmark", "item_key", F.nullif("model_name", F.lit("gamma")).alias("model_name"))
    return exclude_models(rows, ["beta", "delta"])


QUERIES["exclude_models"] = excluded_models
SQL["exclude_models"] = query(
    "SELECT benchmark, item_key, nullif(model_name, 'gamma') AS model_name FROM raw_answers WHERE model_name <> 'beta'"
)


def csv_escape(spark: SparkSession, sf: str) -> DataFrame:
    r"""Backslashes before `\uXXXX` escapes and elsewhere."""
    text = F.concat(
        "text", F.lit(r" ç \alpha \underline \U0001x "), "source", F.lit("\\\\ \\"), "lang"
    )
    return V.table(spark, sf, "documents").select("doc_id", escape_backslashes(text).alias("escaped"))


QUERIES["csv_escape"] = csv_escape
SQL["csv_escape"] = r"""
SELECT doc_id, regexp_replace(regexp_replace(
    text || ' ç \alpha \underline \U0001x ' || source || '\\ \' || lang,
    '\\([uU][0-9a-fA-F]{4})', '\\\\\1', 'g'), '\\([^uU])', '\\\\\1', 'g') AS escaped
FROM documents"""

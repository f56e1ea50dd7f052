"""Prompt building, routing and answer generation queries."""

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import views as V
from catalog.items import EXPERIMENTS, KEYED_SQL, SHOTS, ranks_sql, spread_ranks
from catalog.sql import parse, query, quoted
from gabarito.functions import prompts as P
from gabarito.functions.choices import columns_to_texts, drop_placeholders, render_choices, render_letters
from gabarito.functions.text import escape_xml, mid_truncate, model_short_name, unescape_xml
from gabarito.operators.clean import clean_benchmark
from gabarito.operators.infer import Scorer, answer_prompts, hosted_messages
from gabarito.operators.models import (
    for_each_listed_model,
    group_models,
    models_by_tokenizer,
    pack_prompts,
    prompts_for_models,
    provider,
    split_hosted,
)
from gabarito.operators.resume import score_resumable
from gabarito.operators.shots import with_shots
from gabarito.plans.prompts import build_prompts, seeded_shot, staged_items
from gabarito.registry import (
    ENTAILMENT_NO,
    ENTAILMENT_USER,
    ENTAILMENT_YES,
    OFFENSIVE_NO,
    OFFENSIVE_USER,
    OFFENSIVE_YES,
    SATISFIES_NO,
    SATISFIES_USER,
    SATISFIES_YES,
    TONE_USER,
    UNREGISTERED,
    Benchmark,
    benchmark,
    pattern_of,
)
from gabarito.sources.tables import previews
from gabarito.staging import scratch_path

QUERIES = {}
SQL = {}


def sql_fill(pattern: str, **slots: str) -> str:
    """A wording as SQL concatenation; slots default to columns of their own name."""
    out, rest = [], pattern
    while "{" in rest:
        text, rest = rest.split("{", 1)
        slot, rest = rest.split("}", 1)
        out += [quoted(text)] if text else []
        out.append(f"CAST({slots.get(slot, slot)} AS VARCHAR)")
    out += [quoted(rest)] if rest else []
    return "(" + " || ".join(out) + ")"


def turns_of(rows: DataFrame, name: str) -> DataFrame:
    """Items of one benchmark cleaned and rendered."""
    bench = benchmark(name)
    cleaned = clean_benchmark(rows, bench)
    return cleaned.select("item_key", "label", bench.template(cleaned).alias("turns"))


def turns_query(name: str, rows):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return turns_of(rows(spark, sf), name).select("item_key", "label", "turns.*")

    return run


# --- one query per template family

QUERIES["prompt_yes_no"] = turns_query("hatebr", V.items_yes_no)
YES_NO_SQL = f"""turns_hatebr AS (
    SELECT item_key, label, {quoted(P.SYSTEM_PT)} AS system, {sql_fill(OFFENSIVE_USER, comment="sentence")} AS "user",
        CASE label WHEN '1' THEN {quoted(OFFENSIVE_YES)} ELSE {quoted(OFFENSIVE_NO)} END AS with_answer,
        'Resposta: ' AS without_answer
    FROM items_yes_no)"""
SQL["prompt_yes_no"] = query("SELECT * FROM turns_hatebr", YES_NO_SQL)


def sentence_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return V.items_number(spark, sf).select(
        "item_key",
        F.col("item_key").alias("idx"),
        "sentence1",
        "sentence2",
        (F.col("item_key") % 2).alias("label"),
    )


QUERIES["prompt_entailment"] = turns_query("assin2rte", sentence_pairs)
SQL["prompt_entailment"] = query(
    f"""SELECT item_key, CAST(item_key % 2 AS VARCHAR) AS label, {quoted(P.SYSTEM_PT)} AS system,
        {sql_fill(ENTAILMENT_USER)} AS "user",
        CASE item_key % 2 WHEN 1 THEN {quoted(ENTAILMENT_YES)} ELSE {quoted(ENTAILMENT_NO)} END AS with_answer,
        'Resposta: ' AS without_answer
    FROM items_number"""
)


def question_answers(spark: SparkSession, sf: str) -> DataFrame:
    """User turns with the reply that follows them, as question and answer."""
    talk = V.table(spark, sf, "conversations")
    asked = talk.where(F.col("role") == "user").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("question"))
    replies = talk.where(F.col("role") == "assistant").select("conv_id", "turn", F.col("text").alias("answer"))
    return asked.join(replies, ["conv_id", "turn"]).select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("item_key"),
        "question",
        "answer",
        F.pmod(F.col("turn") + F.col("conv_id"), F.lit(2)).alias("label"),
    )


QUERIES["prompt_answer_check"] = turns_query("faquad", question_answers)
SQL["prompt_answer_check"] = query(
    f"""SELECT item_key, CAST(label AS VARCHAR) AS label, {quoted(P.SYSTEM_PT)} AS system,
        {sql_fill(SATISFIES_USER)} AS "user",
        CASE label WHEN 1 THEN {quoted(SATISFIES_YES)} ELSE {quoted(SATISFIES_NO)} END AS with_answer,
        'Resposta: ' AS without_answer
    FROM (SELECT a.conv_id * 1000 + r.turn AS item_key, a.text AS question, r.text AS answer,
            (r.turn + a.conv_id) % 2 AS label
          FROM conversations a JOIN conversations r ON r.conv_id = a.conv_id AND r.turn = a.turn + 1
          WHERE a.role = 'user' AND r.role = 'assistant' AND a.text <> '' AND r.text <> '')"""
)


def similarity_items(spark: SparkSession, sf: str) -> DataFrame:
    return V.items_number(spark, sf).withColumn("idx", F.col("item_key"))


QUERIES["prompt_sts"] = turns_query("assin2sts", similarity_items)
SIMILARITY_DEGREE = "CASE WHEN CAST(label AS DOUBLE) < 3 THEN 'pouco' ELSE 'muito' END"
SQL["prompt_sts"] = query(
    f"""SELECT item_key, label, {quoted(P.SYSTEM_PT)} AS system, {sql_fill(P.SIMILARITY_USER)} AS "user",
        {sql_fill(P.SIMILARITY_ANSWER, degree=SIMILARITY_DEGREE)} AS with_answer,
        {quoted(P.SIMILARITY_PREFIX)} AS without_answer
    FROM items_number"""
)

QUERIES["prompt_tone"] = turns_query("tweetsentbr", V.items_tone)
SQL["prompt_tone"] = query(
    f"""SELECT item_key, label, {quoted(P.SYSTEM_PT)} AS system, {sql_fill(TONE_USER)} AS "user",
        'Resposta: ' || label AS with_answer, 'Resposta: ' AS without_answer
    FROM items_tone"""
)


def integer_items(spark: SparkSession, sf: str) -> DataFrame:
    return V.items_integer(spark, sf).withColumnRenamed("label", "answer")


QUERIES["prompt_integer"] = turns_query("aime24", integer_items)
SQL["prompt_integer"] = query(
    f"""SELECT item_key, label, {quoted(P.SYSTEM_PT)} AS system,
        {sql_fill(P.INTEGER_USER, problem="problem_pt")} AS "user",
        'Resposta: ' || label AS with_answer, 'Resposta: ' AS without_answer
    FROM items_integer"""
)


def statement_items(spark: SparkSession, sf: str) -> DataFrame:
    """Choice questions in the stored-record shape."""
    return V.items_choice(spark, sf).select(
        "item_key",
        F.col("question").alias("statement"),
        F.struct(F.col("choices").alias("text"), F.array(F.lit("A")).alias("label")).alias("alternatives"),
        F.col("label").alias("answer"),
    )


def choices_sql(texts: str) -> str:
    return (
        f"array_to_string(list_transform({texts}, lambda t, i: '(' || chr(CAST(64 + i AS INTEGER)) || '): ' "
        "|| coalesce(t, 'None')), chr(10))"
    )


def letters_sql(texts: str) -> str:
    return (
        f"array_to_string(list_transform({texts}, lambda t, i: '(' || chr(CAST(64 + i AS INTEGER)) || '),'), '')"
    )


def choice_turns_sql(source: str, texts: str, system: str, user: str, prefix: str, question: str = "question") -> str:
    lead = sql_fill(prefix, letters=letters_sql(texts))
    return f"""SELECT item_key, label, {quoted(system)} AS system,
        {sql_fill(user, question=question, choices=choices_sql(texts))} AS "user",
        {lead} || label || ')' AS with_answer, {lead} AS without_answer FROM {source}"""


QUERIES["prompt_choice"] = turns_query("oab", statement_items)
CHOICE_SQL = "turns_oab AS (" + choice_turns_sql(
    "items_choice", "choices", P.SYSTEM_PT, P.CHOICE_USER_PT, P.CHOICE_PREFIX_PT
) + ")"
SQL["prompt_choice"] = query("SELECT * FROM turns_oab", CHOICE_SQL)


def english_items(spark: SparkSession, sf: str) -> DataFrame:
    """Choice questions in the stored-literal shape."""
    record = F.struct(F.col("choices").alias("text"), F.array(F.lit("A")).alias("label"))
    return V.items_choice(spark, sf).select(
        "item_key", "question", F.to_json(record).alias("choices"), F.col("label").alias("answer")
    )


QUERIES["prompt_choice_english"] = turns_query("mmlu_en", english_items)
SQL["prompt_choice_english"] = query(
    choice_turns_sql("items_choice", "choices", P.SYSTEM_EN, P.CHOICE_USER_EN, P.CHOICE_PREFIX_EN)
)

REAL_CHOICES = "list_filter(choices, lambda t: t IS NOT NULL AND trim(t) NOT IN ('-', '–', ''))"
QUERIES["prompt_choice_filtered"] = turns_query("mmlu_pro_en", english_items)
SQL["prompt_choice_filtered"] = query(
    choice_turns_sql("items_choice", REAL_CHOICES, P.SYSTEM_EN, P.CHOICE_USER_EN_BLANKS, P.CHOICE_PREFIX_EN)
)


def ten_option_items(spark: SparkSession, sf: str) -> DataFrame:
    """Ten option columns; every sixth item misses one and is dropped as incomplete."""
    options = [
        F.when((F.col("p_partkey") % 6 != 0) | F.lit(i != 9), F.concat("p_brand", F.lit(f" v{i}"))).alias(f"option_{i}")
        for i in range(10)
    ]
    return V.table(spark, sf, "part").select(
        F.col("p_partkey").alias("item_key"),
        F.col("p_name").alias("question"),
        *options,
        F.char(65 + F.col("p_partkey") % 10).alias("answer"),
    )


QUERIES["prompt_choice_columns"] = turns_query("mmlu_pro_x", ten_option_items)
SQL["prompt_choice_columns"] = query(
    choice_turns_sql("ten", "choices", P.SYSTEM_PT, P.CHOICE_USER_PT_NO_STOP, P.CHOICE_PREFIX_PT),
    """ten AS (SELECT p_partkey AS item_key, p_name AS question, chr(CAST(65 + p_partkey % 10 AS INTEGER)) AS label,
        list_transform(range(10), lambda i: p_brand || ' v' || i) AS choices
        FROM part WHERE p_partkey % 6 <> 0)""",
)


# --- whole families, every benchmark in the shape its source stores


def choice_source(items: DataFrame, bench: Benchmark) -> DataFrame:
    """Choice items in the columns that a benchmark declares."""
    record = F.struct(F.col("choices").alias("text"), F.array(F.lit("A")).alias("label"))
    gold = (F.ascii("label") - 65) if bench.gold else F.col("label")
    if "statement" in bench.columns:
        stored = F.to_json(record) if bench.sanitize else record
        return items.select("item_key", F.col("question").alias("statement"), stored.alias("alternatives"), gold.alias("answer"))
    if "answerKey" in bench.columns:
        context = F.concat(F.lit("context of "), "question").alias("right_context")
        return items.select("item_key", context, "question", record.alias("choices"), gold.alias("answerKey"))
    if "choices" in bench.columns:
        return items.select("item_key", "question", F.to_json(record).alias("choices"), gold.alias("answer"))
    question, *options, answer = bench.columns
    texts = [F.get("choices", F.lit(i)).alias(o) for i, o in enumerate(options)]
    return items.select("item_key", F.col("question").alias(question), *texts, gold.alias(answer))


def family(rendered: list[tuple[str, Benchmark, DataFrame]]) -> DataFrame:
    parts = []
    for name, bench, rows in rendered:
        cleaned = clean_benchmark(rows, bench)
        turns = bench.template(cleaned).alias("turns")
        parts.append(cleaned.select(F.lit(name).alias("benchmark"), "item_key", "label", turns).select("benchmark", "item_key", "label", "turns.*"))
    return reduce(DataFrame.unionByName, parts)


PORTUGUESE = (P.SYSTEM_PT, P.CHOICE_USER_PT, P.CHOICE_PREFIX_PT)
ENGLISH = (P.SYSTEM_EN, P.CHOICE_USER_EN, P.CHOICE_PREFIX_EN)
CHOICE_FAMILY = {
    **{n: ("choices", PORTUGUESE) for n in ("bluex", "enem", "oab", "poscomp", "energy_regulacao", "mmlu", "mmlu_hard", "supergpqa")},
    **{n: ("choices", ENGLISH) for n in ("mmlu_en", "mmlu_redux_en")},
    "supergpqa_en": (REAL_CHOICES, PORTUGUESE),
    **{n: ("choices[1:4]", PORTUGUESE) for n in ("include", "mmmlu")},
}
OTHER_FAMILY = {
    **{n: ("choices", PORTUGUESE) for n in ("bluex", "enem", "gpqa_diamond")},
    "mmlu_en_alt": ("choices", ENGLISH),
}


def choice_family(spark: SparkSession, sf: str) -> DataFrame:
    """All choice benchmarks, and the descriptors outside a default run.

    The rows of the table's few small files are dealt out to all cores before they are rendered.
    """
    items = V.items_choice(spark, sf, spark.sparkContext.defaultParallelism)
    known = [(n, benchmark(n)) for n in CHOICE_FAMILY] + [(f"other {b.name}", b) for b in UNREGISTERED]
    return family([(name, bench, choice_source(items, bench)) for name, bench in known])


QUERIES["prompt_choice_all"] = choice_family
SQL["prompt_choice_all"] = query(
    " UNION ALL ".join(
        f"SELECT '{prefix}{name}' AS benchmark, * FROM ({choice_turns_sql('items_choice', texts, *wording)})"
        for prefix, names in (("", CHOICE_FAMILY), ("other ", OTHER_FAMILY))
        for name, (texts, wording) in names.items()
    )
)


def offensive_family(spark: SparkSession, sf: str) -> DataFrame:
    items = V.items_yes_no(spark, sf)
    toxic = items.select("item_key", F.col("sentence").alias("text"), (F.col("label") == "1").alias("is_toxic"))
    rows = {"hatebr": items, "portuguese_hate_speech": items, "toxsyn_pt": toxic}
    return family([(name, benchmark(name), source) for name, source in rows.items()])


QUERIES["prompt_offensive_all"] = offensive_family
SQL["prompt_offensive_all"] = query(
    " UNION ALL ".join(
        f"SELECT '{n}' AS benchmark, * FROM turns_hatebr" for n in ("hatebr", "portuguese_hate_speech", "toxsyn_pt")
    ),
    YES_NO_SQL,
)


def integer_family(spark: SparkSession, sf: str) -> DataFrame:
    items = integer_items(spark, sf)
    rows = {"aime24": items, "aime25": items.withColumnRenamed("problem_pt", "question_pt")}
    return family([(name, benchmark(name), source) for name, source in rows.items()])


QUERIES["prompt_integer_all"] = integer_family
SQL["prompt_integer_all"] = query(
    f"""SELECT benchmark, item_key, label, {quoted(P.SYSTEM_PT)} AS system,
        {sql_fill(P.INTEGER_USER, problem="problem_pt")} AS "user",
        'Resposta: ' || label AS with_answer, 'Resposta: ' AS without_answer
    FROM items_integer, (VALUES ('aime24'), ('aime25')) b(benchmark)"""
)


def choices_from_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Option columns of which some are null, skipped or kept."""
    key = F.col("p_partkey")
    rows = V.table(spark, sf, "part").select(
        key.alias("item_key"), F.when(key % 3 != 0, F.col("p_brand")).alias("a"), F.col("p_type").alias("b"), F.when(key % 2 == 0, F.col("p_name")).alias("c")
    )
    shown = lambda skip: F.array_join(columns_to_texts(["a", "b", "c"], skip), "|", "None")
    return rows.select("item_key", shown(True).alias("present"), shown(False).alias("every"))


QUERIES["choices_from_columns"] = choices_from_columns
SQL["choices_from_columns"] = """
SELECT item_key, array_to_string(list_filter(texts, lambda t: t IS NOT NULL), '|') AS present,
    array_to_string(list_transform(texts, lambda t: coalesce(t, 'None')), '|') AS every
FROM (SELECT p_partkey AS item_key,
    [CASE WHEN p_partkey % 3 <> 0 THEN p_brand END, p_type, CASE WHEN p_partkey % 2 = 0 THEN p_name END] AS texts FROM part)"""


# --- pieces of a prompt


def choices_render(spark: SparkSession, sf: str) -> DataFrame:
    texts = F.col("choices")
    return V.items_choice(spark, sf).select(
        "item_key", render_choices(texts).alias("lines"), render_letters(texts).alias("letters")
    )


QUERIES["choices_render"] = choices_render
SQL["choices_render"] = query(
    f"SELECT item_key, {choices_sql('choices')} AS lines, {letters_sql('choices')} AS letters FROM items_choice"
)


def choices_filter(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("item_key")
    more = F.array(F.when(key % 3 == 0, " – ").when(key % 3 == 1, "  "), F.lit("last"))
    kept = drop_placeholders(F.concat("choices", more))
    return V.items_choice(spark, sf).select("item_key", F.array_join(kept, "|").alias("kept"))


QUERIES["choices_filter"] = choices_filter
SQL["choices_filter"] = query(
    """SELECT item_key, array_to_string(list_filter(list_concat(choices,
        [CASE item_key % 3 WHEN 0 THEN ' – ' WHEN 1 THEN '  ' END, 'last']),
        lambda t: t IS NOT NULL AND trim(t) NOT IN ('-', '–', '')), '|') AS kept FROM items_choice"""
)


def structured_instruction(spark: SparkSession, sf: str) -> DataFrame:
    """JSON-reply instruction of every item, by its benchmark's pattern."""
    parts = [V.ITEMS[b](spark, sf).select(F.lit(b).alias("benchmark"), "item_key") for b in V.SHIFTS]
    rows = reduce(DataFrame.unionByName, parts)
    return rows.withColumn("instruction", P.structured_instruction(pattern_of(F.col("benchmark"))))


QUERIES["structured_instruction"] = structured_instruction
STRUCTURED_SQL = (
    f"({quoted(P.STRUCTURED_INTRO)} || CASE answer_pattern "
    + " ".join(f"WHEN '{p}' THEN {quoted(t)}" for p, t in P.STRUCTURED_SPEC.items())
    + f" END || chr(10) || {quoted(P.STRUCTURED_EXAMPLE)})"
)
SQL["structured_instruction"] = query(
    f"SELECT benchmark, item_key, {STRUCTURED_SQL} AS instruction FROM keyed JOIN descriptors USING (benchmark)",
    KEYED_SQL,
)


# --- chats with shots


def shot_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Both benchmarks' items with turns, two experiments of four shots."""
    sources = {"hatebr": V.items_yes_no(spark, sf), "oab": statement_items(spark, sf)}
    items, ranks = staged_items(sources, ["item_key"], 100, spread_ranks)
    return with_shots(items, ranks, seeded_shot(), pool=items.where("drawn"))


TURNS_SQL = [
    YES_NO_SQL,
    CHOICE_SQL,
    """turns AS (SELECT 'hatebr' AS benchmark, * FROM turns_hatebr UNION ALL SELECT 'oab', * FROM turns_oab)""",
    """placed AS (SELECT *, row_number() OVER (PARTITION BY benchmark ORDER BY item_key) - 1 AS idx,
        count(*) OVER (PARTITION BY benchmark) AS n_rows FROM turns)""",
    ranks_sql("placed"),
    """with_shots AS (
        SELECT q.benchmark, q.item_key, q.idx, q.label, q.system, q."user", q.without_answer, experiment,
            string_agg('User: ' || s."user" || chr(10) || chr(10) || 'Assistant: ' || s.with_answer,
                chr(10) || chr(10) ORDER BY pos) AS spoken,
            string_agg('Shot ' || (pos + 1) || ':' || chr(10) || 'Usuário: ' || s."user" || chr(10)
                || 'Assistente: ' || s.with_answer, chr(10) || chr(10) ORDER BY pos) AS listed,
            string_agg(s.benchmark || '_' || s.idx, ',' ORDER BY pos) AS shot_indices
        FROM placed q JOIN ranks r ON r.benchmark = q.benchmark JOIN placed s
            ON s.benchmark = q.benchmark AND s.idx = r.rank + CASE WHEN r.rank < q.idx THEN 0 ELSE 1 END
        GROUP BY ALL)""",
    """prompts AS (
        SELECT *, benchmark || '_' || idx AS id_bench,
            'System: ' || system || chr(10) || chr(10) || spoken || chr(10) || chr(10) || 'User: ' || "user"
                || chr(10) || chr(10) || 'Assistant: ' || without_answer AS raw,
            '<system>' || replace(replace(replace(system, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')
                || '</system>' || chr(10) || '<user>'
                || replace(replace(replace('Example shots:' || chr(10) || listed || chr(10) || chr(10)
                    || 'Sample to evaluate:' || chr(10) || "user", '&', '&amp;'), '<', '&lt;'), '>', '&gt;')
                || '</user>' || chr(10) || '<assistant>' || without_answer || '</assistant>' AS hosted
        FROM with_shots)""",
]


def chat_raw_text(spark: SparkSession, sf: str) -> DataFrame:
    """Few-shot chats as plain text."""
    chat = P.build_chat(F.col("turns"), F.col("shots.turns"), pattern_of(F.col("benchmark")))
    return shot_rows(spark, sf).select("id_bench", "experiment", P.raw_text(chat).alias("prompt"))


QUERIES["chat_raw_text"] = chat_raw_text
SQL["chat_raw_text"] = query("SELECT id_bench, experiment, raw AS prompt FROM prompts", *TURNS_SQL)


def chat_structured(spark: SparkSession, sf: str) -> DataFrame:
    """The same chats asking for a JSON reply: instruction appended, no answer prefix."""
    pattern = pattern_of(F.col("benchmark"))
    chat = P.build_chat(F.col("turns"), F.col("shots.turns"), pattern, structured=True)
    return shot_rows(spark, sf).select("id_bench", "experiment", P.raw_text(chat).alias("prompt"))


QUERIES["chat_structured"] = chat_structured
SQL["chat_structured"] = query(
    f"""SELECT id_bench, experiment, 'System: ' || system || chr(10) || chr(10) || spoken || chr(10) || chr(10)
        || 'User: ' || "user" || chr(10) || chr(10) || {STRUCTURED_SQL} AS prompt
    FROM prompts JOIN descriptors USING (benchmark)""",
    *TURNS_SQL,
)


def prompt_api_xml(spark: SparkSession, sf: str) -> DataFrame:
    """Few-shot prompts in the tagged form of hosted models."""
    prompt = P.hosted_prompt(
        F.col("turns"), F.col("shots.turns"), pattern_of(F.col("benchmark")), blocks=F.col("shots.block")
    )
    return shot_rows(spark, sf).select("id_bench", "experiment", prompt.alias("prompt"))


QUERIES["prompt_api_xml"] = prompt_api_xml
SQL["prompt_api_xml"] = query("SELECT id_bench, experiment, hosted AS prompt FROM prompts", *TURNS_SQL)

JOB_MODELS = [("org/alpha", "api", "instruct"), ("org/beta", "tok", "base"), ("org/gamma", "tok", "base")]
JOB_PATHS = [path for path, _, _ in JOB_MODELS]


def packed_prompts(spark: SparkSession, sf: str) -> DataFrame:
    turns, shots, pattern = F.col("turns"), F.col("shots.turns"), pattern_of(F.col("benchmark"))
    chat = P.build_chat(turns, shots, pattern)
    packed = pack_prompts(chat, turns, shots, pattern, group_models(JOB_MODELS), blocks=F.col("shots.block"))
    return shot_rows(spark, sf).select("benchmark", "id_bench", "experiment", packed.alias("prompt"))


def prompt_pack(spark: SparkSession, sf: str) -> DataFrame:
    """All models' prompts of an item in one JSON cell."""
    return packed_prompts(spark, sf).drop("benchmark")


QUERIES["prompt_pack"] = prompt_pack
SQL["prompt_pack"] = query(
    """SELECT id_bench, experiment, '{"api":{"prompt":' || to_json(hosted) || ',"models":["org/alpha"]},'
        || '"tok_base":{"prompt":' || to_json(raw) || ',"models":["org/beta","org/gamma"]}}' AS prompt
    FROM prompts""",
    *TURNS_SQL,
)


def resolved_prompts(spark: SparkSession, sf: str) -> DataFrame:
    """Each model's own prompt out of the packed cell."""
    rows = prompts_for_models(packed_prompts(spark, sf), JOB_PATHS)
    return rows.select("id_bench", "experiment", "model_path", "prompt")


QUERIES["prompt_for_model"] = resolved_prompts
SQL["prompt_for_model"] = query(
    """SELECT id_bench, experiment, model_path, CASE model_path WHEN 'org/alpha' THEN hosted ELSE raw END AS prompt
    FROM prompts, (VALUES ('org/alpha'), ('org/beta'), ('org/gamma')) m(model_path)""",
    *TURNS_SQL,
)


def listed_models(spark: SparkSession, sf: str) -> DataFrame:
    """The same pairs from the models the cell itself lists."""
    rows = for_each_listed_model(packed_prompts(spark, sf))
    return rows.select("id_bench", "experiment", "model_path", "prompt")


QUERIES["prompts_by_listed_model"] = listed_models
SQL["prompts_by_listed_model"] = SQL["prompt_for_model"]


def prompts_table(spark: SparkSession, sf: str) -> DataFrame:
    """Job 1 from source tables to the prompts table, with computed ranks."""
    sources = {
        "hatebr": V.items_yes_no(spark, sf),
        "oab": statement_items(spark, sf),
    }
    table = build_prompts(
        sources,
        JOB_MODELS,
        order=["item_key"],
        n_shots=SHOTS,
        n_experiments=EXPERIMENTS,
        ranks=spread_ranks,
    )
    return table.withColumn("shot_indices", F.array_join("shot_indices", ","))


def prompts_table_head(spark: SparkSession, sf: str) -> DataFrame:
    """Job 1 over the first tenth of either benchmark, without shots."""
    sources = {"hatebr": V.items_yes_no(spark, sf), "oab": statement_items(spark, sf)}
    table = build_prompts(sources, JOB_MODELS[:1], order=["item_key"], percent=10)
    return table.select("id", "id_bench", "benchmark", "label")


QUERIES["prompts_table_head"] = prompts_table_head
SQL["prompts_table_head"] = query(
    """SELECT row_number() OVER (ORDER BY benchmark, idx) - 1 AS id, benchmark || '_' || idx AS id_bench, benchmark, label
    FROM placed WHERE idx < ceil(n_rows / 10.0)""",
    *TURNS_SQL[:4],
)

QUERIES["prompts_table"] = prompts_table
SQL["prompts_table"] = query(
    """SELECT row_number() OVER (ORDER BY benchmark, idx, experiment) - 1 AS id, id_bench, benchmark,
        '{"api":{"prompt":' || to_json(hosted) || ',"models":["org/alpha"]},'
        || '"tok_base":{"prompt":' || to_json(raw) || ',"models":["org/beta","org/gamma"]}}' AS prompt,
        shot_indices, label
    FROM prompts""",
    *TURNS_SQL,
)


# --- models


def tokenizer_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Models grouped by tokenizer and type, in table form."""
    return models_by_tokenizer(V.supplier_models(spark, sf), "model_key").select(
        "tokenizer_path", "model_type", "position", "n_models", "model_path"
    )


QUERIES["models_by_tokenizer"] = tokenizer_groups
SQL["models_by_tokenizer"] = query(
    """SELECT tokenizer_path, model_type, model_path,
        row_number() OVER (PARTITION BY tokenizer_path, model_type ORDER BY model_key) - 1 AS position,
        count(*) OVER (PARTITION BY tokenizer_path, model_type) AS n_models FROM supplier_models"""
)


def provider_route(spark: SparkSession, sf: str) -> DataFrame:
    """Backend, provider and short name of every model."""
    path = F.col("model_path")
    return split_hosted(V.supplier_models(spark, sf)).select(
        "model_path", "backend", provider(path).alias("provider"), model_short_name(path).alias("model_name")
    )


QUERIES["provider_route"] = provider_route
SQL["provider_route"] = query(
    """SELECT model_path, CASE tokenizer_path WHEN 'api' THEN 'api' ELSE 'local' END AS backend,
        CASE WHEN contains(lower(model_path), 'gpt') THEN 'openai'
            WHEN contains(lower(model_path), 'gemini') THEN 'gemini' END AS provider,
        split_part(model_path, '/', -1) AS model_name FROM supplier_models"""
)


# --- texts


def xml_escape(spark: SparkSession, sf: str) -> DataFrame:
    """Whole pages escaped, and back again."""
    escaped = escape_xml(F.col("html"))
    return V.table(spark, sf, "pages").select(
        "page_id", escaped.alias("escaped"), (unescape_xml(escaped) == F.col("html")).alias("reversible")
    )


QUERIES["xml_escape"] = xml_escape
SQL["xml_escape"] = """
SELECT page_id, replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS escaped,
    true AS reversible FROM pages"""


def extract_system_user(spark: SparkSession, sf: str) -> DataFrame:
    """System and user part of tagged prompts over whole documents."""
    rows = V.tagged_prompts(spark, sf).withColumn("model_path", F.lit("org/GPT-x"))
    return hosted_messages(rows).select("item_key", "system", "user", "provider")


QUERIES["extract_system_user"] = extract_system_user
SQL["extract_system_user"] = r"""
SELECT doc_id AS item_key, CASE WHEN doc_id % 10 = 0 THEN '' ELSE source END AS system,
    regexp_replace(replace(replace(replace('<doc> & ' || text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'),
        '^\s+|\s+$', '', 'g') AS "user", 'openai' AS provider
FROM documents"""


def mid_truncated(spark: SparkSession, sf: str) -> DataFrame:
    """Documents cut in the middle at three limits: usual, tiny, none left."""
    text = F.col("text")
    return V.table(spark, sf, "documents").select(
        "doc_id", *[mid_truncate(text, n).alias(f"at_{n}") for n in (1001, 12, 9)]
    )


QUERIES["mid_truncate"] = mid_truncated
SQL["mid_truncate"] = """
SELECT doc_id,
    CASE WHEN length(text) > 1001 THEN substr(text, 1, 495) || ' ... ' || right(text, 496) ELSE text END AS at_1001,
    CASE WHEN length(text) > 12 THEN substr(text, 1, 1) || ' ... ' || right(text, 1) ELSE text END AS at_12,
    CASE WHEN length(text) > 9 THEN '...' ELSE text END AS at_9
FROM documents"""


# --- generation


def parity_scorer(path: str, prompts: Sequence[str]) -> list[str]:
    """Stands in for a model: answers by the prompt's length, and fails on every seventh."""
    if any(len(p) % 7 == 0 for p in prompts):
        raise RuntimeError("length divisible by seven")
    return ["Sim, claro" if len(p) % 2 == 0 else "não" for p in prompts]


def job_prompts(spark: SparkSession, sf: str) -> DataFrame:
    turns = turns_of(V.items_yes_no(spark, sf), "hatebr")
    none = F.filter(F.array("turns"), lambda t: F.lit(False))
    pattern = F.lit("yes_no")
    chat = P.build_chat(F.col("turns"), none, pattern)
    packed = pack_prompts(chat, F.col("turns"), none, pattern, group_models(JOB_MODELS))
    return turns.select("item_key", F.lit("hatebr").alias("benchmark"), packed.alias("prompt"))


def batch_generate(spark: SparkSession, sf: str) -> DataFrame:
    """Prompts x models through a batch scorer; a failing row costs only itself."""
    answered = answer_prompts(job_prompts(spark, sf), JOB_PATHS, parity_scorer, batch_size=16, max_chars=5000)
    return answered.select("item_key", "model_name", "model_answer", "parsed_model_answer", "error")


QUERIES["batch_generate"] = batch_generate
SQL["batch_generate"] = query(
    f"""SELECT item_key, model_name, model_answer, {parse("yes_no", "model_answer")} AS parsed_model_answer,
        CASE WHEN n % 7 = 0 THEN 'length divisible by seven' END AS error
    FROM (SELECT *, CASE WHEN n % 7 = 0 THEN NULL WHEN n % 2 = 0 THEN 'Sim, claro' ELSE 'não' END AS model_answer
          FROM (SELECT item_key, model_name,
                CASE WHEN length(prompt) > 5000 THEN 4995 ELSE length(prompt) END AS n
                FROM (SELECT item_key, model_name, CASE model_name WHEN 'alpha' THEN
                    '<system>' || system || '</system>' || chr(10) || '<user>'
                    || replace(replace(replace("user", '&', '&amp;'), '<', '&lt;'), '>', '&gt;')
                    || '</user>' || chr(10) || '<assistant>' || without_answer || '</assistant>'
                    ELSE 'System: ' || system || chr(10) || chr(10) || 'User: ' || "user" || chr(10) || chr(10)
                    || 'Assistant: ' || without_answer END AS prompt FROM turns_hatebr, models)))""",
    YES_NO_SQL,
)


def stopping_scorer(path, prompts):
    """Breaks down on a prompt whose length ends in 3, which ends its task."""
    if any(len(p) % 10 == 3 for p in prompts):
        raise AssertionError("stopped")
    return parity_scorer(path, prompts)


def resume_answers(spark: SparkSession, sf: str) -> DataFrame:
    """A run that breaks down half way, and one that takes its logged answers and asks for the rest."""
    prompts, folder = job_prompts(spark, sf), scratch_path(spark, "log")

    def answered(scorer: Scorer) -> DataFrame:
        def score(rows: DataFrame) -> DataFrame:
            return score_resumable(rows, scorer, folder, ["item_key"], batch_size=2)

        return answer_prompts(prompts, JOB_PATHS, scorer, max_chars=5000, score=score)

    try:
        answered(stopping_scorer)
    except PySparkException as e:
        if "stopped" not in str(e):
            raise
    rows = answered(parity_scorer)
    return rows.select("item_key", "model_name", "model_answer", "parsed_model_answer", "error")


QUERIES["resume_answers"] = resume_answers
SQL["resume_answers"] = SQL["batch_generate"]


def first_rows(spark: SparkSession, sf: str) -> DataFrame:
    """First row of two benchmarks rendered, one of them without its text."""
    hate = V.items_yes_no(spark, sf).withColumn("third", F.col("item_key") % 3)
    sources = {
        "hatebr": hate.withColumn("sentence", F.when(F.col("third") != 0, F.col("sentence"))),
        "tweetsentbr": V.items_tone(spark, sf).withColumn("third", -F.col("item_key")),
    }
    return previews(sources, ["third", "item_key"])


QUERIES["preview"] = first_rows
SQL["preview"] = query(
    f"""SELECT 'hatebr' AS benchmark, {quoted(P.SYSTEM_PT)} AS system, {sql_fill(OFFENSIVE_USER, comment="sentence")} AS "user",
        CASE label WHEN '1' THEN {quoted(OFFENSIVE_YES)} ELSE {quoted(OFFENSIVE_NO)} END AS with_answer, 'Resposta: ' AS without_answer
    FROM (SELECT 'None' AS sentence, label FROM items_yes_no WHERE item_key % 3 = 0 ORDER BY item_key LIMIT 1)
    UNION ALL SELECT 'tweetsentbr', {quoted(P.SYSTEM_PT)}, {sql_fill(TONE_USER)}, 'Resposta: ' || label, 'Resposta: '
    FROM (SELECT * FROM items_tone ORDER BY item_key DESC LIMIT 1)"""
)

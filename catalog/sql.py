"""The derived views and the scoring rules once more, in SQL for the comparison engine."""

from gabarito.registry import BOARD, REGISTERED


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


STRIP_LEFT = r"regexp_replace({t}, '^\s+', '')"

PARSE = {
    "yes_no": r"""CASE WHEN contains(lower({t}), 'sim') THEN '1' WHEN contains(lower({t}), 'não') THEN '0'
        WHEN upper(substr(regexp_replace({t}, '^\s+', ''), 1, 1)) = 'S' THEN '1'
        WHEN upper(substr(regexp_replace({t}, '^\s+', ''), 1, 1)) = 'N' THEN '0' END""",
    "multiple_choice": r"nullif(upper(substr(regexp_replace({t}, '^\s+', ''), 1, 1)), '')",
    "multiple_choice_full_word": r"""CASE WHEN regexp_matches({t}, '\S') THEN
        upper(substr(regexp_replace(regexp_extract({t}, '\S+'), '[.,!?;:]+$', ''), 1, 1)) ||
        lower(substr(regexp_replace(regexp_extract({t}, '\S+'), '[.,!?;:]+$', ''), 2)) END""",
    "continue_value": r"nullif(replace(regexp_extract(translate({t}, '０１２３４５６７８９', '0123456789'), '\d+([\.,]?\d+)?'), ',', '.'), '')",
    "integer_exact_math": r"""CAST(TRY_CAST(nullif(regexp_extract(
        replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
            translate({t}, '０１２３４５６７８９', '0123456789'), '\\\(|\\\)|\\\[|\\\]', '', 'g'), '\$+', '', 'g'), '\\mathrm\{{|\}}', '', 'g'),
            '\^\s*\\?circ|\\(deg|circ)', '', 'g'), '°', ''),
        '[-+]?\d+'), '') AS HUGEINT) AS VARCHAR)""",
}


def parse(pattern: str, text: str) -> str:
    return PARSE[pattern].format(t=text)


def dispatch(text: str, pattern: str = "answer_pattern") -> str:
    whens = " ".join(f"WHEN {pattern} = '{p}' THEN {parse(p, text)}" for p in PARSE)
    return f"CASE {whens} END"


DESCRIPTORS = ", ".join(f"('{b.name}', '{b.pattern}', '{b.answer_type}')" for b in REGISTERED)
BOARD_ROWS = ", ".join(
    f"({quoted(b)}, {quoted(a)}, {quoted(c)}, '{'pearson_correlation' if b == 'assin2sts' else 'accuracy'}')"
    for b, a, c in BOARD
)

BASE = rf"""
descriptors AS (SELECT * FROM (VALUES {DESCRIPTORS}) t(benchmark, answer_pattern, answer_type)),
board_dim AS (SELECT * FROM (VALUES {BOARD_ROWS}) t(benchmark, area, board_column, metric)),
models AS (SELECT * FROM (VALUES (0, 'alpha'), (1, 'beta'), (2, 'gamma')) t(m, model_name)),
items_yes_no AS (
    SELECT doc_id AS item_key, text AS sentence, lang, source, CAST(toxic AS VARCHAR) AS label
    FROM documents JOIN labels USING (doc_id)),
items_choice AS (
    SELECT p_partkey AS item_key, p_name AS question,
        [p_brand, p_type, p_name, 'size ' || p_size,
         CASE WHEN p_partkey % 4 = 0 THEN '-' ELSE 'other' END] AS choices,
        chr(CAST(65 + p_partkey % 4 AS INTEGER)) AS label
    FROM part),
items_tone AS (
    SELECT o_orderkey AS item_key, o_orderpriority AS sentence,
        CASE o_orderstatus WHEN 'F' THEN 'Positivo' WHEN 'O' THEN 'Negativo' ELSE 'Neutro' END AS label
    FROM orders),
items_number AS (
    SELECT event_id AS item_key, event_type AS sentence1, props AS sentence2,
        CAST(CAST(value AS DECIMAL(10, 2)) AS VARCHAR) AS label,
        CAST(CAST(value AS DECIMAL(10, 2)) * 100 AS BIGINT) AS hundredths
    FROM events),
items_integer AS (
    SELECT p_partkey AS item_key, p_name AS problem_pt, CAST(p_size AS VARCHAR) AS label FROM part),
raw_hatebr AS (
    SELECT 'hatebr' AS benchmark, item_key, label, model_name,
        CASE WHEN h = 9 THEN NULL WHEN h = 4 THEN CASE label WHEN '1' THEN ' s' ELSE 'n' END
            WHEN h IN (5, 6) THEN CASE label WHEN '1' THEN 'Não, nunca' ELSE 'Sim, claro' END
            WHEN h = 7 THEN 'talvez' WHEN h = 8 THEN ''
            ELSE CASE label WHEN '1' THEN 'Sim, claro' ELSE 'Não, nunca' END END AS model_answer
    FROM (SELECT *, (item_key * 7 + m * 13) % 10 AS h FROM items_yes_no, models)),
raw_choice AS (
    SELECT benchmark, item_key, label, model_name,
        CASE WHEN h = 9 THEN NULL WHEN h = 6 THEN ' ' || lower(label)
            WHEN h = 7 THEN chr(CAST(65 + (ascii(label) - 64) % 4 AS INTEGER)) || ')'
            WHEN h = 8 THEN '' ELSE label || ')' END AS model_answer
    FROM (SELECT *, (item_key * 7 + m * 13 + shift) % 10 AS h
          FROM items_choice, models, (VALUES ('oab', 0), ('mmlu_en', 3)) s(benchmark, shift))),
raw_tone AS (
    SELECT 'tweetsentbr' AS benchmark, item_key, label, model_name,
        CASE WHEN h = 9 THEN NULL WHEN h = 5 THEN lower(label) WHEN h = 6 THEN upper(label) || '!'
            WHEN h = 7 THEN 'Neutro' WHEN h = 8 THEN '   ' ELSE label || '.' END AS model_answer
    FROM (SELECT *, (item_key * 7 + m * 13) % 10 AS h FROM items_tone, models)),
raw_number AS (
    SELECT 'assin2sts' AS benchmark, item_key, label, model_name,
        CASE WHEN h = 9 THEN NULL WHEN h = 8 THEN 'sem valor'
            WHEN h = 6 THEN translate(CAST(x // 100 AS VARCHAR) || '.' || lpad(CAST(x % 100 AS VARCHAR), 2, '0'), '0123456789', '０１２３４５６７８９')
            WHEN h = 7 THEN CAST(x // 100 AS VARCHAR) || ',' || lpad(CAST(x % 100 AS VARCHAR), 2, '0')
            ELSE 'valor ' || CAST(x // 100 AS VARCHAR) || '.' || lpad(CAST(x % 100 AS VARCHAR), 2, '0')
        END AS model_answer
    FROM (SELECT *, hundredths + m * 700 + h * 100 AS x
          FROM (SELECT *, (item_key * 7 + m * 13) % 10 AS h FROM items_number, models))),
raw_integer AS (
    SELECT 'aime24' AS benchmark, item_key, label, model_name,
        CASE WHEN h = 9 THEN NULL WHEN h = 4 THEN '\(' || label || '^\circ\)'
            WHEN h = 5 THEN translate('$0' || label || '$', '0123456789', '０１２３４５６７８９') WHEN h = 6 THEN label || '.0'
            WHEN h = 7 THEN CAST(CAST(label AS INTEGER) + 1 AS VARCHAR) WHEN h = 8 THEN 'x'
            ELSE label END AS model_answer
    FROM (SELECT *, (item_key * 7 + m * 13) % 10 AS h FROM items_integer, models)),
raw_answers AS (
    SELECT * FROM raw_hatebr UNION ALL SELECT * FROM raw_choice UNION ALL SELECT * FROM raw_tone
    UNION ALL SELECT * FROM raw_number UNION ALL SELECT * FROM raw_integer),
answers AS (
    SELECT r.*, {dispatch("model_answer")} AS parsed_model_answer
    FROM raw_answers r JOIN descriptors USING (benchmark)),
confusion AS (
    SELECT model_name, benchmark,
        CASE WHEN answer_pattern = 'integer_exact_math'
             THEN {parse("integer_exact_math", "label")} ELSE label END AS true_class,
        parsed_model_answer AS predicted_class, count(*) AS n
    FROM answers JOIN descriptors USING (benchmark) GROUP BY ALL),
supports AS (
    SELECT c.model_name, c.benchmark, true_class AS class, sum(n) AS support,
        coalesce(sum(n) FILTER (true_class = predicted_class), 0) AS hits
    FROM confusion c JOIN descriptors USING (benchmark)
    WHERE true_class IS NOT NULL AND predicted_class IS NOT NULL AND answer_type = 'category' GROUP BY ALL),
predictions AS (
    SELECT model_name, benchmark, predicted_class AS class, sum(n) AS predicted
    FROM confusion WHERE true_class IS NOT NULL AND predicted_class IS NOT NULL GROUP BY ALL),
category_scores AS (
    SELECT model_name, benchmark, sum(hits) / sum(support) AS accuracy,
        sum(support * coalesce(CAST(hits AS DOUBLE) / predicted, 0)) / sum(support) AS precision,
        sum(support * (CAST(hits AS DOUBLE) / support)) / sum(support) AS recall,
        sum(support * (2.0 * CAST(hits AS DOUBLE) / (support + coalesce(predicted, 0)))) / sum(support) AS f1_score
    FROM supports LEFT JOIN predictions USING (model_name, benchmark, class) GROUP BY ALL),
pairs AS (
    SELECT model_name, benchmark, CAST(label AS DOUBLE) AS x, CAST(parsed_model_answer AS DOUBLE) AS y
    FROM answers JOIN descriptors USING (benchmark)
    WHERE answer_type = 'continue' AND parsed_model_answer IS NOT NULL),
correlations AS (
    SELECT model_name, benchmark,
        CASE WHEN stddev_pop(x) > 0 AND stddev_pop(y) > 0 THEN corr(x, y) END AS pearson_correlation
    FROM pairs GROUP BY ALL),
rates AS (
    SELECT model_name, benchmark, answer_pattern, CAST(sum(n) AS BIGINT) AS n_rows,
        CAST(coalesce(sum(n) FILTER (predicted_class IS NULL), 0) AS BIGINT) AS n_unparsed,
        coalesce(sum(n) FILTER (predicted_class IS NOT NULL AND true_class IS NOT NULL), 0) AS n_kept
    FROM confusion JOIN descriptors USING (benchmark) GROUP BY ALL),
eval_rows AS (
    SELECT model_name, benchmark, accuracy, precision, recall, f1_score, pearson_correlation,
        CASE WHEN answer_pattern = 'integer_exact_math' AND n_rows > n_unparsed
             THEN 1 - CAST(n_kept AS DOUBLE) / (n_rows - n_unparsed)
             ELSE CAST(n_unparsed AS DOUBLE) / n_rows END AS non_parsed_rate,
        CAST(n_unparsed AS DOUBLE) / n_rows AS non_parsed_total_rate
    FROM rates LEFT JOIN category_scores USING (model_name, benchmark)
        LEFT JOIN correlations USING (model_name, benchmark)),
scores AS (
    SELECT e.*, area, board_column,
        coalesce(CASE WHEN metric = 'pearson_correlation' THEN pearson_correlation ELSE accuracy END, 0.0) AS score
    FROM eval_rows e LEFT JOIN board_dim USING (benchmark)),
existing AS (SELECT DISTINCT benchmark FROM scores WHERE area IS NOT NULL AND score > 0),
supplier_models AS (
    SELECT s_suppkey AS model_key,
        'org/' || CASE s_suppkey % 3 WHEN 0 THEN 'GPT-x' WHEN 1 THEN 'gemini-x' ELSE 'other' END
            || '/' || s_name AS model_path,
        CASE WHEN s_suppkey % 3 = 0 THEN 'api' ELSE 'tok/' || s_nationkey END AS tokenizer_path,
        CASE WHEN s_suppkey % 4 = 0 THEN 'base' ELSE 'instruct' END AS model_type,
        s_name AS model_name, s_acctbal
    FROM supplier),
old_answers AS (
    SELECT benchmark, item_key, label, model_name, 'old' AS model_answer FROM raw_answers
    WHERE model_name IN ('alpha', 'beta') AND item_key % 2 = 0),
new_answers AS (SELECT * FROM raw_tone WHERE model_name = 'beta')"""


def query(body: str, *extra: str) -> str:
    """SQL over the shared views, with the query's own ones appended."""
    return "WITH " + ",\n".join([BASE.strip(), *extra]) + "\n" + body

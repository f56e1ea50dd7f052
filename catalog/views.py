"""Evaluation-shaped views of the test tables. All formulas are integer or string arithmetic."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gabarito.functions.parsers import parse_answer
from gabarito.operators.metrics import evaluate
from gabarito.registry import pattern_of
from gabarito.staging import pinned

MODELS = ["alpha", "beta", "gamma"]
# benchmark -> shift of its answer forms
SHIFTS = {"hatebr": 0, "oab": 0, "tweetsentbr": 0, "assin2sts": 0, "aime24": 0, "mmlu_en": 3}


SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "pages": "page_id long, url string, html string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table with its fixed schema: no footer is read to infer one."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def rounded(df: DataFrame, columns: list[str]) -> DataFrame:
    """Six decimals, so that the order of summation does not show."""
    return df.withColumns({c: F.round(F.col(f"`{c}`"), 6) for c in columns})


def items_yes_no(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    return docs.join(labels, "doc_id").select(
        F.col("doc_id").alias("item_key"),
        F.col("text").alias("sentence"),
        "lang",
        "source",
        F.col("toxic").cast("string").alias("label"),
    )


def items_choice(spark: SparkSession, sf: str, partitions: int | None = None) -> DataFrame:
    """Parts as choice questions; dealt out to `partitions` where much is made of every row."""
    key, rows = F.col("p_partkey"), table(spark, sf, "part")
    return (rows.repartition(partitions) if partitions else rows).select(
        key.alias("item_key"),
        F.col("p_name").alias("question"),
        F.array(
            F.col("p_brand"),
            F.col("p_type"),
            F.col("p_name"),
            F.concat(F.lit("size "), F.col("p_size").cast("string")),
            F.when(key % 4 == 0, "-").otherwise("other"),
        ).alias("choices"),
        F.char(65 + key % 4).alias("label"),
    )


def items_tone(spark: SparkSession, sf: str) -> DataFrame:
    status = F.col("o_orderstatus")
    label = F.when(status == "F", "Positivo").when(status == "O", "Negativo").otherwise("Neutro")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("item_key"), F.col("o_orderpriority").alias("sentence"), label.alias("label")
    )


def items_number(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_id").alias("item_key"),
        F.col("event_type").alias("sentence1"),
        F.col("props").alias("sentence2"),
        F.col("value").cast("decimal(10,2)").cast("string").alias("label"),
        (F.col("value").cast("decimal(10,2)") * 100).cast("long").alias("hundredths"),
    )


def items_integer(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("item_key"),
        F.col("p_name").alias("problem_pt"),
        F.col("p_size").cast("string").alias("label"),
    )


def two_decimals(hundredths: Column, point: str = ".") -> Column:
    whole = F.floor(hundredths / 100).cast("string")
    return F.concat(whole, F.lit(point), F.lpad(F.pmod(hundredths, F.lit(100)).cast("string"), 2, "0"))


def wide_digits(text: Column) -> Column:
    """Digits of another script."""
    return F.translate(text, "0123456789", "０１２３４５６７８９")


def answer_text(benchmark: str, h: Column, m: Column) -> Column:
    """Ten answer forms per benchmark, right, odd, wrong, unreadable and missing."""
    label = F.col("label")

    def by_form(usual: Column, forms: dict[int, Column]) -> Column:
        case = F.when(h == 9, F.lit(None).cast("string"))
        for form, text in forms.items():
            case = case.when(h == form, text)
        return case.otherwise(usual)

    if benchmark == "hatebr":
        yes, no = F.lit("Sim, claro"), F.lit("Não, nunca")
        right = F.when(label == "1", yes).otherwise(no)
        wrong = F.when(label == "1", no).otherwise(yes)
        short = F.when(label == "1", " s").otherwise("n")
        return by_form(right, {4: short, 5: wrong, 6: wrong, 7: F.lit("talvez"), 8: F.lit("")})
    if benchmark in ("oab", "mmlu_en"):
        shifted = F.concat(F.char(65 + F.pmod(F.ascii(label) - 64, F.lit(4))), F.lit(")"))
        forms = {6: F.concat(F.lit(" "), F.lower(label)), 7: shifted, 8: F.lit("")}
        return by_form(F.concat(label, F.lit(")")), forms)
    if benchmark == "tweetsentbr":
        forms = {
            5: F.lower(label),
            6: F.concat(F.upper(label), F.lit("!")),
            7: F.lit("Neutro"),
            8: F.lit("   "),
        }
        return by_form(F.concat(label, F.lit(".")), forms)
    if benchmark == "assin2sts":
        x = F.col("hundredths") + m * 700 + h * 100
        forms = {6: wide_digits(two_decimals(x)), 7: two_decimals(x, ","), 8: F.lit("sem valor")}
        return by_form(F.concat(F.lit("valor "), two_decimals(x)), forms)
    forms = {
        4: F.concat(F.lit("\\("), label, F.lit("^\\circ\\)")),
        5: wide_digits(F.concat(F.lit("$0"), label, F.lit("$"))),
        6: F.concat(label, F.lit(".0")),
        7: (label.cast("int") + 1).cast("string"),
        8: F.lit("x"),
    }
    return by_form(label, forms)


ITEMS = {
    "hatebr": items_yes_no,
    "oab": items_choice,
    "tweetsentbr": items_tone,
    "assin2sts": items_number,
    "aime24": items_integer,
    "mmlu_en": items_choice,
}


def benchmark_answers(spark: SparkSession, sf: str, benchmark: str) -> DataFrame:
    """One benchmark's items x the three models, raw answers."""
    rows = ITEMS[benchmark](spark, sf).withColumn("m", F.explode(F.sequence(F.lit(0), F.lit(2))))
    rows = rows.withColumn("h", (F.col("item_key") * 7 + F.col("m") * 13 + SHIFTS[benchmark]) % 10)
    return rows.select(
        F.lit(benchmark).alias("benchmark"),
        "item_key",
        "label",
        F.element_at(F.array(*map(F.lit, MODELS)), F.col("m") + 1).alias("model_name"),
        answer_text(benchmark, F.col("h"), F.col("m")).alias("model_answer"),
    )


def raw_answers(spark: SparkSession, sf: str) -> DataFrame:
    return reduce(DataFrame.unionByName, (benchmark_answers(spark, sf, b) for b in SHIFTS))


def answers(spark: SparkSession, sf: str) -> DataFrame:
    """All benchmarks, parsed."""
    parsed = parse_answer(pattern_of(F.col("benchmark")), F.col("model_answer"))
    return raw_answers(spark, sf).withColumn("parsed_model_answer", parsed)


def eval_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of all answers, computed once for the queries that read it several times."""
    return pinned(evaluate(answers(spark, sf)))


def old_answers(spark: SparkSession, sf: str) -> DataFrame:
    """An earlier answers table: two of the models, every other item."""
    earlier = raw_answers(spark, sf).where(
        F.col("model_name").isin("alpha", "beta") & (F.col("item_key") % 2 == 0)
    )
    return earlier.withColumn("model_answer", F.lit("old"))


def new_answers(spark: SparkSession, sf: str) -> DataFrame:
    """A new batch: one model on one benchmark."""
    return benchmark_answers(spark, sf, "tweetsentbr").where(F.col("model_name") == "beta")


def supplier_models(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as models: path, tokenizer and type by formula."""
    key = F.col("s_suppkey")
    tokenizer = F.when(key % 3 == 0, "api").otherwise(
        F.concat(F.lit("tok/"), F.col("s_nationkey").cast("string"))
    )
    family = F.element_at(F.array(*map(F.lit, ["GPT-x", "gemini-x", "other"])), (key % 3 + 1).cast("int"))
    return table(spark, sf, "supplier").select(
        key.alias("model_key"),
        F.concat(F.lit("org/"), family, F.lit("/"), F.col("s_name")).alias("model_path"),
        tokenizer.alias("tokenizer_path"),
        F.when(key % 4 == 0, "base").otherwise("instruct").alias("model_type"),
        F.col("s_name").alias("model_name"),
        "s_acctbal",
    )


def metadata_overrides(spark: SparkSession, sf: str) -> DataFrame:
    """Overrides of the supplier models; every fifth has no model_id, some fields are null."""
    key = F.col("model_key")

    def unless(divisor: int, value: Column) -> Column:
        return F.when(key % divisor != 0, value)

    return supplier_models(spark, sf).select(
        "model_name",
        unless(5, F.concat(F.lit("hub/"), key.cast("string"))).alias("model_id"),
        unless(2, F.lit("SFT")).alias("t"),
        unless(2, F.lit("SFT : Supervised Finetuning")).alias("tipo"),
        unless(3, F.lit("Original")).alias("tipo_peso"),
        unless(2, F.lit("research")).alias("licenca"),
        unless(4, F.lit("BF16")).alias("precisao"),
        F.when(key % 7 == 0, F.array(F.lit("A1"), F.lit("A2"))).alias("arquitetura"),
        F.when(key % 6 == 1, F.lit(7.0)).alias("params_b"),
    )


def metadata_fetched(spark: SparkSession, sf: str) -> DataFrame:
    """What a hub would report; every eleventh model is unknown there."""
    key = F.col("model_key")
    hub = F.concat(F.lit("hub/"), key.cast("string"))
    return (
        supplier_models(spark, sf)
        .where(key % 11 != 0)
        .select(
            hub.alias("model_id"),
            hub.alias("hub_id"),
            F.concat(F.lit("sha"), key.cast("string")).alias("sha"),
            (key * 3).alias("likes"),
            (key % 2 == 0).alias("private"),
            F.when(key % 3 == 0, "mit").alias("license"),
            F.when(key % 3 == 1, F.array(F.lit("ArchX"))).alias("architectures"),
            F.when(key % 4 == 0, "F32").alias("precision"),
            F.when(key % 5 == 1, key * 1000000).alias("params_total"),
            F.when(key % 8 == 2, F.array(F.lit("hub/base")))
            .when(key % 8 == 4, F.array(hub))
            .alias("base_model"),
            (key % 9 == 0).alias("is_adapter"),
        )
    )


def choice_strings(spark: SparkSession, sf: str) -> DataFrame:
    """Stored literals in the forms sources use, good and broken."""
    key, name, brand = F.col("p_partkey"), F.col("p_name"), F.col("p_brand")

    def cat(*parts) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    form = key % 8
    text = (
        F.when(form == 0, cat('{"text": ["', name, '", "', brand, '"], "label": ["A", "B"]}'))
        .when(form == 1, cat("{'text': ['", name, "', '", brand, "'], 'label': ['A', 'B']}"))
        .when(form == 2, cat("{'text': ['", name, "', None], 'label': ['A', 'B']}"))
        .when(form == 3, cat("{'text': [\"it's ", name, "\", '", brand, "'], 'label': ['A', 'B']}"))
        .when(form == 4, cat("{'text': ['$\\uparrow$ ", name, "', '\\underline{x}'], 'label': ['A', 'B']}"))
        .when(form == 5, cat("{'text': ['", name, "']}"))
        .when(form == 6, F.lit("  "))
        .otherwise(cat("broken ['", name))
    )
    return table(spark, sf, "part").select(key.alias("item_key"), text.alias("alternatives"), name.alias("name"), brand.alias("brand"))


def tagged_prompts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as tagged prompts: mixed-case tags, every tenth without a system part."""
    key = F.col("doc_id")
    body = F.concat(F.lit("<doc> & "), F.col("text"))
    escaped = F.replace(
        F.replace(F.replace(body, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
        F.lit(">"),
        F.lit("&gt;"),
    )
    system = F.when(key % 10 == 0, "").otherwise(
        F.concat(
            F.when(key % 3 == 0, "<SYSTEM> ").otherwise("<system>"),
            F.col("source"),
            F.when(key % 3 == 0, "\n</System>\n").otherwise("</system>\n"),
        )
    )
    return table(spark, sf, "documents").select(
        key.alias("item_key"),
        "text",
        F.concat(system, F.lit("<user>\n"), escaped, F.lit(" </user>")).alias("prompt"),
    )


def structured_replies(spark: SparkSession, sf: str) -> DataFrame:
    """Replies to yes/no items: valid, incomplete, not JSON, missing."""
    form = F.col("item_key") % 4
    word = F.when(F.col("label") == "1", "Sim").otherwise("Não")
    reply = (
        F.when(form == 0, F.concat(F.lit('{"explicacao": "'), F.col("source"), F.lit('", "resposta": "'), word, F.lit('"}')))
        .when(form == 1, F.concat(F.lit('{"resposta": "'), word, F.lit('"}')))
        .when(form == 2, F.concat(word, F.lit(", ok")))
    )
    return items_yes_no(spark, sf).select(
        "item_key", F.lit("hatebr").alias("benchmark"), "label", reply.alias("model_answer")
    )

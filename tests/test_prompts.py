"""Templates, choices and prompt assembly, spelled out."""

import json
import random
import re

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.prompting import choice_family
from gabarito.functions import choices as C
from gabarito.functions import prompts as P
from gabarito.functions import text as X
from gabarito.operators import models as M
from gabarito.operators.clean import clean_benchmark
from gabarito.registry import BENCHMARKS, REGISTERED, UNREGISTERED, faquad_template

SYSTEM = "Você é um assistente prestativo, responda de forma direta e objetiva."
LITERAL = "{'text': ['um', None, \"d'ois\"], 'label': ['A', 'B', 'C']}"


def one(spark, bench, **row):
    df = spark.createDataFrame([tuple(row.values())], list(row)) if isinstance(row, dict) else row
    cleaned = clean_benchmark(df, bench)
    return cleaned.select("label", bench.template(cleaned).alias("t")).select("label", "t.*").first()


def test_yes_no_wordings(spark):
    got = one(spark, BENCHMARKS["assin2rte"], idx=1, sentence1="Um", sentence2="Dois", label=1)
    assert got.system == SYSTEM
    assert got.user == (
        "Premissa: Um.\nHipótese: Dois.\n\nCom base na nossa premissa, a hipótese acima é verdadeira ou falsa? "
        "Responda com Sim ou Não."
    )
    assert got.with_answer == "Resposta: Sim, com base na nossa premissa, a hipótese acima é verdadeira."
    assert got.without_answer == "Resposta: "
    for name, column in (("hatebr", "sentence"), ("portuguese_hate_speech", "sentence")):
        got = one(spark, BENCHMARKS[name], **{column: "oi", "label": "0"})
        assert got.user == "Comentário: oi.\nO comentário acima é ofensivo? Responda com Sim ou Não."
        assert got.with_answer == "Resposta: Não, o texto não é ofensivo."
    assert one(spark, BENCHMARKS["toxsyn_pt"], text="oi", is_toxic=True).with_answer == "Resposta: Sim, o texto é ofensivo."
    got = one(spark, BENCHMARKS["faquad"], question="Q", answer="R", label=1)
    assert got.user == "Pergunta: Q\n\nResposta: R\nA resposta dada satisfaz à pergunta? Responda com Sim ou Não."
    assert got.with_answer == "Resposta: Sim, a resposta dada satisfaz à pergunta."


def test_always_negative_answers_on_request(spark):
    df = spark.createDataFrame([("Q", "R", "1")], "question string, answer string, label string")
    answer = df.select(faquad_template(positive="")(df)["with_answer"]).first()[0]
    assert answer == "Resposta: Não, a resposta dada não satisfaz à pergunta."


def test_similarity_tone_and_integer_wordings(spark):
    got = one(spark, BENCHMARKS["assin2sts"], idx=0, sentence1="a", sentence2="b", label=2.5)
    lead = "Resposta: Ao ler a Sentença 1 e a Sentença 2, o valor da similaridade é de "
    assert got.with_answer == lead + "2.5, ou seja, são pouco similares." and got.without_answer == lead
    assert got.user == (
        "Sentença 1: a.\nSentença 2: b.\n\nApós ler as sentenças, o quão similares elas são? Utilize valores "
        "entre 1 e 5, sendo 1 pouco similares e 5 muito similares."
    )
    got = one(spark, BENCHMARKS["assin2sts"], idx=0, sentence1="a", sentence2="b", label="3")
    assert got.with_answer.endswith("3, ou seja, são muito similares.")
    got = one(spark, BENCHMARKS["tweetsentbr"], sentence="x", label="Neutro")
    assert got.user == (
        "Comentário: x.\nQual é o tom do comentário acima? Responda com apenas uma das seguintes opções: "
        "Positivo, Negativo ou Neutro."
    )
    assert got.with_answer == "Resposta: Neutro"
    assert one(spark, BENCHMARKS["tweetsentbr"], sentence="x", label="?").with_answer is None
    for name, column in (("aime24", "problem_pt"), ("aime25", "question_pt")):
        got = one(spark, BENCHMARKS[name], **{column: "P", "answer": 33})
        assert got.user == (
            "Problema: P\n\nForneça apenas a resposta final como um número inteiro, sem formatação de LaTeX ou matemática."
        )
        assert got.with_answer == "Resposta: 33"


PT_USER = "Pergunta:\nQ.\n\nLeia as alternativas abaixo e responda corretamente a pergunta:\n\n"
PT_LEAD = "Lendo as alternativas {} a alternativa que responde corretamente a pergunta é a letra ("
EN_LEAD = "Reading the options {} the letter that correctly answers the question is ("
EN_USER = "Question:\nQ.\n\nRead the options below and answer correctly:\n\n"
EN_BLANKS = "Question:\nQ.\n\nRead the options below and answer correctly or complete the blanks correctly:\n\n"
LINES = "(A): um\n(B): None\n(C): d'ois"


@pytest.mark.parametrize("bench", [b for b in REGISTERED + UNREGISTERED if b.columns[-2:-1] in (("alternatives",), ("choices",))], ids=lambda b: b.name)
def test_choice_wordings_from_stored_literals(spark, bench):
    question = next(c for c in ("statement", "question") if c in bench.columns)
    row = {question: "Q", bench.columns[-2]: LITERAL, "right_context": "ctx", bench.label: "B"}
    if bench.gold:
        row |= {bench.columns[-2]: "['um', None, \"d'ois\"]", bench.label: 1}
    got = one(spark, bench, **row)
    english = bench.name in ("mmlu_en", "mmlu_redux_en", "mmlu_pro_en", "mmlu_en_alt")
    filtered = bench.name in ("mmlu_pro_en", "supergpqa_en")
    lines = "(A): um\n(B): d'ois" if filtered else LINES
    letters = "(A),(B)," if filtered else "(A),(B),(C),"
    user = EN_BLANKS if bench.name == "mmlu_pro_en" else EN_USER if english else PT_USER
    lead = (EN_LEAD if english else PT_LEAD).format(letters)
    assert got.user == user + lines
    assert (got.without_answer, got.with_answer) == (lead, lead + "B)")
    assert got.system == ("You are a helpful assistant. Answer directly and objectively." if english else SYSTEM)


def test_choice_columns(spark):
    got = one(spark, BENCHMARKS["include"], question="Q", option_a="a", option_b="b", option_c="c", option_d="d", answer=2)
    assert got.user == PT_USER + "(A): a\n(B): b\n(C): c\n(D): d"
    assert got.label == "C" and got.with_answer.endswith("é a letra (C)")
    got = one(spark, BENCHMARKS["mmmlu"], Question="Q", A="a", B="b", C="c", D="d", Answer="D")
    assert got.user == PT_USER + "(A): a\n(B): b\n(C): c\n(D): d" and got.with_answer.endswith("é a letra (D)")
    options = {f"option_{i}": f"o{i}" for i in range(10)}
    got = one(spark, BENCHMARKS["mmlu_pro_x"], question="Q", **options, answer="J")
    assert got.user.startswith("Pergunta:\nQ\n\nLeia") and got.user.endswith("(J): o9")


def test_every_benchmark_is_described():
    assert len(REGISTERED) == 24 and len(UNREGISTERED) == 4
    assert {b.pattern for b in REGISTERED} == set(P.STRUCTURED_SPEC)
    assert all(b.label in b.columns for b in REGISTERED + UNREGISTERED)


def test_stored_forms_of_alternatives(spark):
    texts = [
        '{"text": ["a", "b"], "label": ["A", "B"]}',
        LITERAL,
        "{'text': ['it\\'s', 'tab\\t', '\\\\x'], 'label': []}",
        "['x', 'y, z']",
        "('t', 1)",
        "{'label': ['A']}",
        "oops",
        "",
        None,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r[1] for r in df.orderBy("i").select("i", C.read_alternatives(F.col("t"))["text"]).collect()]
    assert got == [["a", "b"], ["um", None, "d'ois"], ["it's", "tab\t", "\\x"], ["x", "y, z"], ["t", "1"], None, None, None, None]


def test_sanitised_literals(spark):
    texts = [
        r"{'text': ['$\uparrow$', '\underline{x}'], 'label': ['A', 'B']}",
        "{'text': ['a, b', None], 'label': ['A', 'B']}",
        "{'label': ['A'], 'fonte': 1}",
        "broken [",
        "  ",
        None,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r[1] for r in df.orderBy("i").select("i", C.sanitize_alternatives(F.col("t"))).collect()]
    assert json.loads(got[0]) == {"text": [r"$\uparrow$", r"\underline{x}"], "label": ["A", "B"]}
    assert json.loads(got[1]) == {"text": ["a, b", None], "label": ["A", "B"]}
    assert json.loads(got[2]) == {"label": ["A"], "fonte": 1, "text": []}
    assert got[3:] == texts[3:]


@pytest.fixture(scope="module")
def random_literals():
    """Lists and records of quoted strings with escapes of every kind, some of them broken."""
    rng = random.Random(12)
    bits = ["\\\\", "\\'", '\\"', "\\n", "\\t", "\\a", "\\f", "\\alpha", "\\frac{1}{2}", "\\c", "\\ ", "x", "é", "😀", ", ", "]", ":", "/", "$"]
    odd = ["\\x41", "\\u00e9", "\\101", "\\v", "\\uparrow", "\\\n", "\ue001", "'", '"', "\t", "\\"]

    def string(strange):
        quote = rng.choice("'\"")
        return quote + "".join(rng.choice(odd if rng.random() < strange else bits) for _ in range(rng.randrange(6))) + quote

    def items(strange):
        inside = [string(strange) for _ in range(rng.randrange(5))]
        return "[" + rng.choice([",", ", ", " ,\n"]).join(inside) + rng.choice(["]"] * 20 + [",]", "", ", None]", ", 1.50]"])

    forms = [
        "{t}",
        "{{'text': {t}, 'label': {l}}}",
        "{{'label': {l}, \"text\":{t}}}",
        " {{ 'text' : {t} , 'label' : {l} }} ",
        "{{'text': {t}}}",
        "{{'text': {t}, 'other': {l}}}",
        "({t}, {l})",
    ]
    return [rng.choice(forms).format(t=items(s), l=items(s)) for s in [0.0] * 1500 + [0.1] * 1500]


def test_random_literals_are_read_as_python_reads_them(spark, random_literals):
    df = spark.createDataFrame(list(enumerate(random_literals)), "i int, t string")
    jvm = F.coalesce(
        F.from_json(C._marked(F.col("t"), C.LIST), "array<string>"), F.from_json(C._marked(F.col("t"), C.RECORD), C.ALTERNATIVES)["text"]
    )
    read = df.orderBy("i").select("t", C.read_alternatives(F.col("t")).alias("a"), jvm.isNotNull().alias("jvm")).collect()
    strings = lambda v: isinstance(v, list) and all(isinstance(x, str) for x in v)
    for nth, row in enumerate(read):
        if "\\" not in row["t"]:
            continue
        value = C._literal(row["t"])
        both = isinstance(value, dict)
        assert row["a"]["text"] == C._items(value.get("text") if both else value), row["t"]
        assert row["a"]["label"] == (C._items(value.get("label")) if both else None), row["t"]
        simple = strings(value) or (both and set(value) == {"text", "label"} and all(map(strings, value.values())))
        if nth < 1500 and simple and not re.search(r",\s*]", row["t"]):
            assert row["jvm"], row["t"]


def test_random_literals_are_repaired_as_python_repairs_them(spark, random_literals):
    df = spark.createDataFrame(list(enumerate(random_literals)), "i int, t string")
    repaired = df.orderBy("i").select("t", C.sanitize_alternatives(F.col("t")).alias("s")).collect()
    by_python = C._repair_literal.func(iter([pd.Series([t.replace("\\uparrow", "\\\\uparrow") for t in random_literals])]))
    for row, expected in zip(repaired, next(by_python)):
        if "\\" in row["t"]:
            assert row["s"] == (expected or row["t"]), row["t"]


def test_very_long_literal(spark):
    text = "['" + "\\'\\\\alpha " * 200_000 + "', '" + "', '".join(["\\n"] * 50_000) + "']"
    found = spark.createDataFrame([(text,)], "t string").select(C.read_alternatives(F.col("t"))["text"].alias("a")).first()["a"]
    assert found == ["'\\alpha " * 200_000, *["\n"] * 50_000]


def test_incomplete_and_empty_items_are_dropped(spark):
    df = spark.createDataFrame([("a", "1"), ("", "1"), (None, "1"), ("b", None)], "sentence string, label string")
    assert [r.sentence for r in clean_benchmark(df, BENCHMARKS["hatebr"]).collect()] == ["a"]


TURNS = "system string, user string, with_answer string, without_answer string"


@pytest.fixture
def item(spark):
    schema = T.StructType(
        [
            T.StructField("turns", T._parse_datatype_string(TURNS)),
            T.StructField("shots", T.ArrayType(T._parse_datatype_string(TURNS))),
        ]
    )
    shots = [("s", "u1 <b>", "a1", "w"), ("s", "u2", None, "w")]
    return spark.createDataFrame([(("s&", "u", "a", "w "), shots), (("s&", "u", "a", "w "), [])], schema)


def test_raw_text_and_hosted_prompt(item):
    turns, shots = F.col("turns"), F.col("shots")
    chat = P.build_chat(turns, shots, F.lit("yes_no"))
    raw = [r[0] for r in item.select(P.raw_text(chat)).collect()]
    assert raw[0] == "System: s&\n\nUser: u1 <b>\n\nAssistant: a1\n\nUser: u2\n\nUser: u\n\nAssistant: w "
    assert raw[1] == "System: s&\n\nUser: u\n\nAssistant: w "
    hosted = [r[0] for r in item.select(P.hosted_prompt(turns, shots, F.lit("yes_no"))).collect()]
    assert hosted[0] == (
        "<system>s&amp;</system>\n<user>Example shots:\nShot 1:\nUsuário: u1 &lt;b&gt;\nAssistente: a1\n\n"
        "Shot 2:\nUsuário: u2\nAssistente: None\n\nSample to evaluate:\nu</user>\n<assistant>w </assistant>"
    )
    assert hosted[1] == "<system>s&amp;</system>\n<user>u</user>\n<assistant>w </assistant>"


@pytest.mark.parametrize("pattern", [*P.STRUCTURED_SPEC, "other"])
def test_structured_mode(item, pattern):
    turns, shots = F.col("turns"), F.col("shots")
    chat = P.build_chat(turns, shots, F.lit(pattern), structured=True)
    messages = item.select(chat).collect()[1][0]
    spec = P.STRUCTURED_SPEC.get(pattern, P.STRUCTURED_SPEC_OTHER)
    want = "u\n\n" + P.STRUCTURED_INTRO + spec + '\nExemplo: {"explicacao": "...", "resposta": "..."}'
    assert [tuple(m) for m in messages] == [("system", "s&"), ("user", want)]
    hosted = item.select(P.hosted_prompt(turns, shots, F.lit(pattern), structured=True)).collect()[1][0]
    assert "<assistant>" not in hosted and hosted.endswith("</user>")


def test_packing_and_resolving(item):
    models = [("o/a", "tokA", "instruct"), ("o/b", "tokA", "base"), ("o/c", "api", "instruct"), ("o/d", "api", "base"), ("o/e", "tokA", "base")]
    groups = M.group_models(models)
    turns, shots, pattern = F.col("turns"), F.col("shots"), F.lit("yes_no")
    chat = P.build_chat(turns, shots, pattern)

    def markers(c):
        return F.array_join(F.transform(c, lambda m: F.concat(F.lit("<|"), m["role"], F.lit("|>"), m["content"])), "")

    packed = M.pack_prompts(chat, turns, shots, pattern, groups, chat_templates={"tokA": markers})
    cell = json.loads(item.select(packed).collect()[1][0])
    assert list(cell) == ["tokA_instruct", "tokA_base", "api"]
    assert cell["tokA_instruct"] == {"prompt": "<|system|>s&<|user|>u<|assistant|>w ", "models": ["o/a"]}
    assert cell["tokA_base"]["models"] == ["o/b", "o/e"] and cell["api"]["models"] == ["o/c", "o/d"]
    prompts = item.select(packed.alias("prompt"))
    for path, key in (("o/a", "tokA_instruct"), ("o/e", "tokA_base"), ("o/d", "api")):
        assert prompts.select(M.prompt_for_model(F.col("prompt"), F.lit(path))).collect()[1][0] == cell[key]["prompt"]
    with pytest.raises(PySparkException, match="model not found"):
        prompts.select(M.prompt_for_model(F.col("prompt"), F.lit("o/zzz"))).collect()
    with pytest.raises(ValueError, match="no chat template"):
        M.pack_prompts(chat, turns, shots, pattern, groups)
    with pytest.raises(ValueError, match="instruct models"):
        M.pack_prompts(chat, turns, shots, pattern, groups, structured=True, chat_templates={"tokA": markers})


def test_small_texts(spark):
    def value(column):
        return spark.range(1).select(column).first()[0]

    assert value(X.tag_body(F.lit("x <SyStem>\xa0 a\nb </system> <system>c</system>"), "system")) == "a\nb"
    assert value(X.tag_body(F.lit("no tags"), "user")) == ""
    assert value(X.tag_body(F.lit(None).cast("string"), "user")) == ""
    assert value(X.mid_truncate(F.lit("a" * 10 + "b" * 10), 15)) == "aa ... bbb"
    assert value(X.mid_truncate(F.lit("abc"), 3)) == "abc"
    assert value(X.mid_truncate(F.lit("abcd"), 3)) == "..."
    assert value(X.mid_truncate(F.lit("x" * 20 + "yz"), 11)) == " ... z"
    assert value(X.unescape_xml(X.escape_xml(F.lit("&lt; <a> & b")))) == "&lt; <a> & b"
    assert value(X.escape_backslashes(F.lit("\\u00e7 \\alpha \\underline"))) == "\\\\\\u00e7 \\\\alpha \\underline"
    assert value(X.strip(F.lit("\xa0\n a b\x1c "))) == "a b"
    assert value(X.joined_or_null(F.array().cast("array<string>"))) is None
    assert value(X.round3(F.lit(0.0625))) == 0.062
    assert value(X.model_short_name(F.lit("a/b/c"))) == "c" and value(X.model_short_name(F.lit("c"))) == "c"


def test_added_benchmark(spark, monkeypatch):
    from gabarito import registry as R

    monkeypatch.setattr(R, "BENCHMARKS", dict(R.BENCHMARKS))
    own = R.Benchmark("mine", ("q", "a"), "a", "yes_no", lambda df: P.yes_no_turns(X.fill("Q: {q}"), "Sim", "Não"))
    R.register(own)
    assert one(spark, R.benchmark("mine"), q="x", a="1").user == "Q: x"
    assert spark.range(1).select(R.pattern_of(F.lit("mine"))).first()[0] == "yes_no"
    assert "mine" in R.names_where(pattern="yes_no")


def test_a_repair_runs_once_a_row_after_the_filter(spark):
    """Incomplete rows are dropped before the repair, and Python sees no row twice."""
    rows = [(1, LITERAL, "A"), (2, None, "A"), (3, "", "B"), (4, LITERAL, None), (5, "  ", "A")]
    df = spark.createDataFrame(rows, "k int, alternatives string, answer string")
    df = df.withColumns({"statement": F.lit("s"), "__native": F.lit("own")})
    cleaned = clean_benchmark(df, BENCHMARKS["poscomp"])
    assert cleaned._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    got = {r.k: (r.alternatives, r["__native"]) for r in cleaned.collect()}
    assert got == {1: ('{"text":["um",null,"d\'ois"],"label":["A","B","C"]}', "own"), 5: ("  ", "own")}


def test_blocks_escaped_beforehand_give_the_same_prompt(spark):
    turns = "struct<system string, user string, with_answer string, without_answer string>".replace(" string", ":string")
    shots = [[("s", "a & b", "<c>", ""), ("s", None, "d", ""), None], [], None]
    rows = [(("x<y", "q > &amp;", "w", "hint"), s) for s in shots] + [(("x", None, "w", None), shots[0])]
    df = spark.createDataFrame(rows, f"item {turns}, shots array<{turns}>")
    blocks = F.transform("shots", P.escaped_block)
    for structured in (False, True):
        forms = [P.hosted_prompt(F.col("item"), F.col("shots"), F.lit("yes_no"), structured, b) for b in (None, blocks)]
        for whole, pieces in df.select(*forms).collect():
            assert whole == pieces


def test_choice_rows_are_dealt_out_to_all_cores(spark, tmp_path):
    """One small file is one task, however many rows and benchmarks are rendered from it."""
    columns = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    parts = spark.createDataFrame([(i, f"n{i}", "b", "t", i, 1.0) for i in range(64)], columns)
    parts.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    rows = choice_family(spark, str(tmp_path))
    assert rows.count() == 17 * 64
    oab = rows.where("benchmark = 'oab'").withColumn("task", F.spark_partition_id())
    assert oab.select("task").distinct().count() == spark.sparkContext.defaultParallelism

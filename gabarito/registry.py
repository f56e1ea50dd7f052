"""Benchmark descriptors and the dimension tables made from them."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gabarito.functions import prompts as P
from gabarito.functions.choices import (
    choice_texts,
    columns_to_texts,
    drop_placeholders,
    index_to_letter,
)
from gabarito.functions.text import fill

Template = Callable[[DataFrame], Column]


@dataclass(frozen=True)
class Benchmark:
    """One benchmark: which columns it needs, how its answers read, how an item is worded.

    `template` sees a table whose label column is already called `label` and gives a
    `schemas.TURNS` column. `gold` maps the stored label to the one predictions are
    compared with.
    """

    name: str
    columns: tuple[str, ...]
    label: str
    pattern: str
    template: Template
    answer_type: str = "category"
    split: str | None = "test"
    subset: str | tuple[str, ...] | None = None
    sanitize: str | None = None
    gold: Callable[[Column], Column] | None = None


# --- Fixed values: per-benchmark wordings, columns, splits and subsets.

OFFENSIVE_USER = "Comentário: {comment}.\nO comentário acima é ofensivo? Responda com Sim ou Não."
OFFENSIVE_YES = "Resposta: Sim, o texto é ofensivo."
OFFENSIVE_NO = "Resposta: Não, o texto não é ofensivo."

ENTAILMENT_USER = (
    "Premissa: {sentence1}.\nHipótese: {sentence2}.\n\nCom base na nossa premissa, a hipótese acima "
    "é verdadeira ou falsa? Responda com Sim ou Não."
)
ENTAILMENT_YES = "Resposta: Sim, com base na nossa premissa, a hipótese acima é verdadeira."
ENTAILMENT_NO = "Resposta: Não, com base na nossa premissa, a hipótese acima não é verdadeira."

SATISFIES_USER = (
    "Pergunta: {question}\n\nResposta: {answer}\nA resposta dada satisfaz à pergunta? "
    "Responda com Sim ou Não."
)
SATISFIES_YES = "Resposta: Sim, a resposta dada satisfaz à pergunta."
SATISFIES_NO = "Resposta: Não, a resposta dada não satisfaz à pergunta."

TONE_USER = (
    "Comentário: {sentence}.\nQual é o tom do comentário acima? Responda com apenas uma das "
    "seguintes opções: Positivo, Negativo ou Neutro."
)

STATEMENT = ("statement", "alternatives", "answer")
QUESTION = ("question", "choices", "answer")
QUESTION_KEY = ("question", "choices", "answerKey")
OPTIONS_AD = ("option_a", "option_b", "option_c", "option_d")
OPTIONS_TEN = tuple(f"option_{i}" for i in range(10))


def _offensive(column: str) -> Template:
    return lambda df: P.yes_no_turns(
        fill(OFFENSIVE_USER, comment=F.col(column)), OFFENSIVE_YES, OFFENSIVE_NO
    )


def _entailment(df: DataFrame) -> Column:
    return P.yes_no_turns(fill(ENTAILMENT_USER), ENTAILMENT_YES, ENTAILMENT_NO)


def faquad_template(positive: str = "1") -> Template:
    """`positive=None`-like values that never match (e.g. `''`) reproduce always-negative shots."""
    return lambda df: P.yes_no_turns(
        fill(SATISFIES_USER), SATISFIES_YES, SATISFIES_NO, positive=positive
    )


def _choices(question: str, stored: str, filtered: bool = False, **wording: str) -> Template:
    def template(df: DataFrame) -> Column:
        texts = choice_texts(df, stored)
        texts = drop_placeholders(texts) if filtered else texts
        return P.choice_turns(F.col(question), texts, F.col("label"), **wording)

    return template


def _options(
    question: str, columns: tuple[str, ...], skip_null: bool = False, **wording: str
) -> Template:
    return lambda df: P.choice_turns(
        F.col(question), columns_to_texts(list(columns), skip_null), F.col("label"), **wording
    )


ENGLISH = {"system": P.SYSTEM_EN, "user": P.CHOICE_USER_EN, "prefix": P.CHOICE_PREFIX_EN}
ENGLISH_BLANKS = {**ENGLISH, "user": P.CHOICE_USER_EN_BLANKS}

_statement = _choices("statement", "alternatives")
_question = _choices("question", "choices")


def _mc(name: str, columns: tuple[str, ...], template: Template, **more) -> Benchmark:
    return Benchmark(name, columns, columns[-1], "multiple_choice", template, **more)


REGISTERED = [
    Benchmark(
        "assin2rte",
        ("idx", "sentence1", "sentence2", "label"),
        "label",
        "yes_no",
        _entailment,
        subset="assin2-rte",
    ),
    Benchmark(
        "assin2sts",
        ("idx", "sentence1", "sentence2", "label"),
        "label",
        "continue_value",
        lambda df: P.similarity_turns(),
        answer_type="continue",
        subset="assin2-sts",
    ),
    _mc("bluex", STATEMENT, _statement, split="train"),
    _mc("enem", STATEMENT, _statement, split="enem"),
    Benchmark(
        "hatebr",
        ("sentence", "label"),
        "label",
        "yes_no",
        _offensive("sentence"),
        subset="HateBR_offensive_binary",
    ),
    Benchmark(
        "portuguese_hate_speech",
        ("sentence", "label"),
        "label",
        "yes_no",
        _offensive("sentence"),
        subset="Portuguese_Hate_Speech_binary",
    ),
    Benchmark("toxsyn_pt", ("text", "is_toxic"), "is_toxic", "yes_no", _offensive("text")),
    Benchmark("faquad", ("question", "answer", "label"), "label", "yes_no", faquad_template()),
    Benchmark(
        "tweetsentbr",
        ("sentence", "label"),
        "label",
        "multiple_choice_full_word",
        lambda df: P.tone_turns(fill(TONE_USER)),
    ),
    _mc("oab", STATEMENT, _statement, split="oab"),
    _mc("poscomp", STATEMENT, _statement, split="poscomp", sanitize="alternatives"),
    _mc("energy_regulacao", ("right_context", *QUESTION_KEY), _question, split="train"),
    Benchmark(
        "aime24",
        ("problem_pt", "answer"),
        "answer",
        "integer_exact_math",
        lambda df: P.integer_turns(F.col("problem_pt")),
        split="train",
    ),
    Benchmark(
        "aime25",
        ("question_pt", "answer"),
        "answer",
        "integer_exact_math",
        lambda df: P.integer_turns(F.col("question_pt")),
    ),
    _mc("mmlu", QUESTION, _question, split="train"),
    _mc("mmlu_en", QUESTION, _choices("question", "choices", **ENGLISH)),
    _mc("mmlu_hard", QUESTION, _question, split="train"),
    _mc("mmlu_redux_en", QUESTION, _choices("question", "choices", **ENGLISH)),
    _mc("mmlu_pro_en", QUESTION, _choices("question", "choices", filtered=True, **ENGLISH_BLANKS)),
    _mc(
        "mmlu_pro_x",
        ("question", *OPTIONS_TEN, "answer"),
        _options("question", OPTIONS_TEN, skip_null=True, user=P.CHOICE_USER_PT_NO_STOP),
        subset=("pt", "en"),
    ),
    _mc("supergpqa", QUESTION, _question, split="train"),
    _mc("supergpqa_en", QUESTION, _choices("question", "choices", filtered=True)),
    _mc(
        "include",
        ("question", *OPTIONS_AD, "answer"),
        _options("question", OPTIONS_AD),
        subset="Portuguese",
        gold=index_to_letter,
    ),
    _mc(
        "mmmlu",
        ("Question", "A", "B", "C", "D", "Answer"),
        _options("Question", ("A", "B", "C", "D")),
        subset="PT_BR",
    ),
]

# Descriptors that exist but are not part of a default run; the first two share their
# benchmark name with a registered one.
UNREGISTERED = [
    _mc("bluex", QUESTION_KEY, _question, split="train"),
    _mc("enem", QUESTION_KEY, _question, split="train"),
    _mc("gpqa_diamond", QUESTION_KEY, _question, split="train"),
    _mc(
        "mmlu_en_alt",
        QUESTION,
        _choices("question", "choices", **ENGLISH),
        subset="all",
        gold=index_to_letter,
    ),
]

# Benchmarks the leaderboard knows: name, area, display column.
BOARD = [
    ("hatebr", "Discurso de Ódio", "HateBR"),
    ("portuguese_hate_speech", "Discurso de Ódio", "PT Hate Speech"),
    ("tweetsentbr", "Discurso de Ódio", "tweetSentBR"),
    ("toxsyn_pt", "Discurso de Ódio", "ToxSyn-PT"),
    ("oab", "Área do Direito", "OAB"),
    ("revalida", "Área Médica", "Revalida"),
    ("mrex", "Área Médica", "MREX"),
    ("enam", "Área do Direito", "ENAM"),
    ("afa", "Provas Militares", "AFA"),
    ("ita", "Provas Militares", "ITA"),
    ("ime", "Provas Militares", "IME"),
    ("poscomp", "Computação", "POSCOMP"),
    ("obi", "Computação", "OBI"),
    ("bcb", "Economia e Contabilidade", "BCB"),
    ("cfces", "Economia e Contabilidade", "CFCES"),
    ("assin2rte", "Semântica e Inferência", "ASSIN2 RTE"),
    ("assin2sts", "Semântica e Inferência", "ASSIN2 STS"),
    ("faquad", "Semântica e Inferência", "FAQUAD NLI"),
    ("bluex", "Multidisciplinar", "BLUEX"),
    ("enem", "Multidisciplinar", "ENEM"),
    ("cnpu", "Multidisciplinar", "CNPU"),
    ("enade", "Multidisciplinar", "ENADE"),
    ("bndes", "Multidisciplinar", "BNDES"),
    ("cacd_1_fase", "Multidisciplinar", "CACD (1ª fase)"),
    ("cacd_2_fase", "Multidisciplinar", "CACD (2ª fase)"),
    ("energy_regulacao", "Energy", "ENERGY-REGULAÇÃO"),
    ("gpqa_diamond", "STEM", "GPQA-Diamond"),
    ("aime24", "STEM", "AIME 24"),
    ("aime25", "STEM", "AIME 25"),
    ("mmlu", "General Tasks (Inglês)", "MMLU"),
    ("mmlu_hard", "General Tasks (Inglês)", "MMLU-Hard"),
    ("mmlu_redux", "General Tasks (Inglês)", "MMLU-Redux"),
    ("mmlu_pro", "General Tasks (Inglês)", "MMLU-Pro"),
    ("supergpqa", "General Tasks (Inglês)", "SuperGPQA"),
]

# Metrics that make up a benchmark's score, where it is not the accuracy.
DEFAULT_METRICS = ["accuracy"]
OTHER_METRICS = {"assin2sts": ["pearson_correlation"]}

# Constant description columns of the published board.
DESCRIPTIONS = {
    "Datasets Área Médica": "Revalida, MREX",
    "Datasets Área do Direito": "OAB, ENAM",
    "Datasets Provas Militares": "AFA, ITA, IME",
    "Datasets Computação": "POSCOMP, OBI",
    "Datasets Discurso de Ódio": "HateBR, PT Hate Speech, tweetSentBR, ToxSyn-PT",
    "Datasets Economia e Contabilidade": "BCB, CFCES",
    "Datasets Semântica e Inferência": "FAQUAD NLI, ASSIN2 RTE, ASSIN2 STS",
    "Datasets Multidisciplinar": "ENEM, BLUEX, CNPU, ENADE, BNDES, CACD (1ª fase), CACD (2ª fase)",
    "energy_dataset": "ENERGY-REGULAÇÃO",
    "STEM": "AIME 24, AIME 25, GPQA-Diamond",
    "General Tasks (Inglês)": "MMLU, MMLU-Redux, MMLU-Pro, SuperGPQA",
    "reasoning_dataset": 0.5,
}

# --- End of the fixed values.

BENCHMARKS = {b.name: b for b in REGISTERED}
AREAS = list(dict.fromkeys(area for _, area, _ in BOARD))


def register(bench: Benchmark) -> None:
    """Add a benchmark, or replace the one of its name, for the jobs of this application."""
    BENCHMARKS[bench.name] = bench


def benchmark(name: str) -> Benchmark:
    if name not in BENCHMARKS:
        raise KeyError(f"unknown benchmark {name!r}; known: {sorted(BENCHMARKS)}")
    return BENCHMARKS[name]


def names_where(**attributes: str) -> list[str]:
    """Registered benchmarks with these attribute values, e.g. `answer_type="continue"`."""
    return [b.name for b in BENCHMARKS.values() if all(getattr(b, k) == v for k, v in attributes.items())]


def board_table(spark: SparkSession) -> DataFrame:
    """One row per benchmark the board knows: area, display column, metrics."""
    rows = [(n, a, c, OTHER_METRICS.get(n, DEFAULT_METRICS)) for n, a, c in BOARD]
    return spark.createDataFrame(
        rows, "benchmark string, area string, column string, metrics array<string>"
    )


def pattern_of(name: Column) -> Column:
    """Answer pattern of a benchmark as a codegen'd CASE; an unknown name fails the job."""
    return _case(name, {b.name: b.pattern for b in BENCHMARKS.values()})


def _case(name: Column, values: dict[str, str]) -> Column:
    unknown = F.raise_error(F.concat(F.lit("unknown benchmark: "), F.coalesce(name, F.lit("null"))))
    by_value: dict[str, list[str]] = {}
    for key, value in values.items():
        by_value.setdefault(value, []).append(key)
    case = None
    for value, keys in by_value.items():
        test = name.isin(keys)
        case = F.when(test, value) if case is None else case.when(test, value)
    return case.otherwise(unknown)

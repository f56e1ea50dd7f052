"""From one item to its prompt: turns, chat, raw text and tagged form."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from gabarito.functions.choices import render_choices, render_letters
from gabarito.functions.text import escape_xml, fill

# --- Fixed values: the wordings below must equal the published prompts character by character.

SYSTEM_PT = "Você é um assistente prestativo, responda de forma direta e objetiva."
SYSTEM_EN = "You are a helpful assistant. Answer directly and objectively."

ANSWER_PREFIX = "Resposta: "

TONE_LABELS = ["Positivo", "Negativo", "Neutro"]

SIMILARITY_USER = (
    "Sentença 1: {sentence1}.\nSentença 2: {sentence2}.\n\nApós ler as sentenças, o quão similares "
    "elas são? Utilize valores entre 1 e 5, sendo 1 pouco similares e 5 muito similares."
)
SIMILARITY_PREFIX = "Resposta: Ao ler a Sentença 1 e a Sentença 2, o valor da similaridade é de "
SIMILARITY_ANSWER = SIMILARITY_PREFIX + "{label}, ou seja, são {degree} similares."

INTEGER_USER = (
    "Problema: {problem}\n\nForneça apenas a resposta final como um número inteiro, "
    "sem formatação de LaTeX ou matemática."
)

CHOICE_USER_PT = (
    "Pergunta:\n{question}.\n\nLeia as alternativas abaixo e responda corretamente a pergunta:\n\n{choices}"
)
CHOICE_USER_PT_NO_STOP = (
    "Pergunta:\n{question}\n\nLeia as alternativas abaixo e responda corretamente a pergunta:\n\n{choices}"
)
CHOICE_PREFIX_PT = (
    "Lendo as alternativas {letters} a alternativa que responde corretamente a pergunta é a letra ("
)
CHOICE_USER_EN = "Question:\n{question}.\n\nRead the options below and answer correctly:\n\n{choices}"
CHOICE_USER_EN_BLANKS = (
    "Question:\n{question}.\n\nRead the options below and answer correctly or complete the blanks "
    "correctly:\n\n{choices}"
)
CHOICE_PREFIX_EN = "Reading the options {letters} the letter that correctly answers the question is ("

STRUCTURED_INTRO = (
    "IMPORTANTE: Responda APENAS no formato JSON com as chaves 'explicacao' e 'resposta'. "
    "A chave 'explicacao' deve conter um raciocínio breve e objetivo. "
    "A chave 'resposta' deve conter SOMENTE a resposta final no formato especificado abaixo.\n"
)
STRUCTURED_SPEC = {
    "yes_no": "Para 'resposta', use exatamente 'Sim' ou 'Não'.",
    "multiple_choice": "Para 'resposta', use exatamente UMA letra entre 'A', 'B', 'C', 'D' ou 'E'.",
    "multiple_choice_full_word": (
        "Para 'resposta', use exatamente uma palavra entre 'Positivo', 'Negativo' ou 'Neutro'."
    ),
    "continue_value": "Para 'resposta', use apenas um número (use ponto decimal se necessário).",
    "integer_exact_math": "Para 'resposta', forneça apenas um número inteiro (sem LaTeX).",
}
STRUCTURED_SPEC_OTHER = "Para 'resposta', forneça apenas o valor final esperado para o benchmark."
STRUCTURED_EXAMPLE = 'Exemplo: {"explicacao": "...", "resposta": "..."}'

SHOTS_HEADING = "Example shots:\n"
SAMPLE_HEADING = "Sample to evaluate:\n"

# --- End of the fixed values.


def turns(system: str, user: Column, with_answer: Column, without_answer: Column) -> Column:
    """What a template gives for one item, in the shape of `schemas.TURNS`."""
    return F.struct(
        F.lit(system).alias("system"),
        user.alias("user"),
        with_answer.alias("with_answer"),
        without_answer.alias("without_answer"),
    )


def yes_no_turns(user: Column, yes: str, no: str, positive: str = "1") -> Column:
    """Binary question; the label `positive` is answered with `yes`."""
    answer = F.when(F.col("label") == positive, yes).otherwise(no)
    return turns(SYSTEM_PT, user, answer, F.lit(ANSWER_PREFIX))


def similarity_turns() -> Column:
    """Two sentences and a similarity from 1 to 5; below 3 reads as little."""
    degree = F.when(F.col("label").cast("double") < 3, "pouco").otherwise("muito")
    return turns(
        SYSTEM_PT,
        fill(SIMILARITY_USER),
        fill(SIMILARITY_ANSWER, degree=degree),
        F.lit(SIMILARITY_PREFIX),
    )


def tone_turns(user: Column) -> Column:
    """Three-way tone; a label outside the three words has no answer sentence."""
    answer = F.when(F.col("label").isin(TONE_LABELS), F.concat(F.lit(ANSWER_PREFIX), F.col("label")))
    return turns(SYSTEM_PT, user, answer, F.lit(ANSWER_PREFIX))


def integer_turns(problem: Column) -> Column:
    return turns(
        SYSTEM_PT,
        fill(INTEGER_USER, problem=problem),
        F.concat(F.lit(ANSWER_PREFIX), F.col("label")),
        F.lit(ANSWER_PREFIX),
    )


def choice_turns(
    question: Column,
    texts: Column,
    label: Column,
    system: str = SYSTEM_PT,
    user: str = CHOICE_USER_PT,
    prefix: str = CHOICE_PREFIX_PT,
) -> Column:
    """Lettered choice question."""
    lead = fill(prefix, letters=render_letters(texts))
    return turns(
        system,
        fill(user, question=question, choices=render_choices(texts)),
        F.concat(lead, label, F.lit(")")),
        lead,
    )


def structured_instruction(pattern: Column) -> Column:
    """Instruction for a JSON reply, by answer pattern."""
    spec = F.lit(STRUCTURED_SPEC_OTHER)
    for name, text in STRUCTURED_SPEC.items():
        spec = F.when(pattern == name, text).otherwise(spec)
    return F.concat(F.lit(STRUCTURED_INTRO), spec, F.lit("\n" + STRUCTURED_EXAMPLE))


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def user_text(item: Column, pattern: Column, structured: bool) -> Column:
    """The item's own question, followed by the JSON instruction in structured mode."""
    if not structured:
        return item["user"]
    return F.concat(item["user"], F.lit("\n\n"), structured_instruction(pattern))


def build_chat(item: Column, shots: Column, pattern: Column, structured: bool = False) -> Column:
    """System, one user/assistant pair per shot, the question, and the answer prefix.

    The prefix is left out in structured mode, where the reply is a JSON document.
    """
    examples = F.flatten(
        F.transform(
            shots,
            lambda s: F.array(message("user", s["user"]), message("assistant", s["with_answer"])),
        )
    )
    last = [message("user", user_text(item, pattern, structured))]
    if not structured:
        last.append(message("assistant", item["without_answer"]))
    return F.concat(F.array(message("system", item["system"])), examples, F.array(*last))


def raw_text(chat: Column) -> Column:
    """`Role: content` blocks of the non-empty messages, blank line between them."""
    spoken = F.filter(chat, lambda m: m["content"].isNotNull() & (m["content"] != ""))
    blocks = F.transform(spoken, lambda m: F.concat(F.initcap(m["role"]), F.lit(": "), m["content"]))
    return F.array_join(blocks, "\n\n")


def shot_block(shot: Column) -> Column:
    """A shot as hosted models see it, without its number; missing texts read None."""
    return F.concat(
        F.lit(":\nUsuário: "),
        F.coalesce(shot["user"], F.lit("None")),
        F.lit("\nAssistente: "),
        F.coalesce(shot["with_answer"], F.lit("None")),
    )


def escaped_block(shot: Column) -> Column:
    """The same, escaped; made once per shot, it need not be made again in every prompt."""
    return escape_xml(shot_block(shot))


def hosted_text(blocks: Column, sample: Column) -> Column:
    """Numbered shots, then the sample."""
    none = shot_block(F.struct(*[F.lit(None).cast("string").alias(c) for c in ("user", "with_answer")]))
    numbered = F.transform(
        blocks, lambda b, i: F.concat(F.lit("Shot "), (i + 1).cast("string"), F.coalesce(b, none))
    )
    return F.when(
        F.size(blocks) > 0,
        F.concat(
            F.lit(SHOTS_HEADING),
            F.array_join(numbered, "\n\n"),
            F.lit("\n\n" + SAMPLE_HEADING),
            sample,
        ),
    ).otherwise(sample)


def hosted_user_text(item: Column, shots: Column, pattern: Column, structured: bool = False) -> Column:
    """One user text for hosted models: numbered shots, then the sample."""
    return hosted_text(F.transform(shots, shot_block), user_text(item, pattern, structured))


def tagged(parts: dict[str, Column]) -> Column:
    """Escaped texts in their tags, one per line."""
    return F.concat_ws(
        "\n", *[F.concat(F.lit(f"<{t}>"), c, F.lit(f"</{t}>")) for t, c in parts.items()]
    )


def tagged_prompt(system: Column, user: Column, hint: Column | None = None) -> Column:
    """`<system>`, `<user>` and, when there is a hint, `<assistant>`, one per line, escaped."""
    parts = {"system": system, "user": user}
    if hint is not None:
        parts["assistant"] = hint
    return tagged({t: escape_xml(c) for t, c in parts.items()})


def hosted_prompt(
    item: Column, shots: Column, pattern: Column, structured: bool = False, blocks: Column | None = None
) -> Column:
    """The tagged prompt every hosted model shares.

    `blocks` holds the `escaped_block` of every shot, where the shots bring it along.
    """
    hint = None if structured else item["without_answer"]
    if blocks is None:
        return tagged_prompt(item["system"], hosted_user_text(item, shots, pattern, structured), hint)
    # The headings have nothing to escape.
    user = hosted_text(blocks, escape_xml(user_text(item, pattern, structured)))
    parts = {"system": escape_xml(item["system"]), "user": user}
    return tagged(parts if hint is None else parts | {"assistant": escape_xml(hint)})

"""Free-text answers -> typed predictions. Total expressions: whatever cannot be read is null."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from gabarito.functions.text import NOT_SPACE, SPACE, ascii_digits, first_char, first_match, strip


def yes_no(text: Column) -> Column:
    """'1' / '0': the words first ("sim" wins over "não"), then an initial S or N."""
    lowered = F.lower(text)
    initial = F.upper(first_char(text))
    return (
        F.when(F.contains(lowered, F.lit("sim")), "1")
        .when(F.contains(lowered, F.lit("não")), "0")
        .when(initial == "S", "1")
        .when(initial == "N", "0")
    )


def choice_letter(text: Column) -> Column:
    """First visible character, upper-cased; not checked against the offered letters."""
    return F.substring(F.upper(first_char(text)), 1, 1)


def full_word(text: Column) -> Column:
    """First word without trailing punctuation, capitalised."""
    word = first_match(text, f"^{SPACE}*+({NOT_SPACE}++)", 1)
    return F.initcap(F.rtrim(word, F.lit(".,!?;:")))


def number(text: Column) -> Column:
    """First unsigned number in ASCII digits, decimal comma turned into a point."""
    found = first_match(text, r"^\P{Nd}*+(\p{Nd}+(?:[\.,]?\p{Nd}+)?)", 1)
    return ascii_digits(F.replace(found, F.lit(","), F.lit(".")))


def integer_math(text: Column) -> Column:
    """Integer part of the first signed number once LaTeX and degree marks are gone.

    Kept as text: answers may exceed any integer type.
    """
    # The markup removed, in this order; each needs one of the marker characters.
    markup = [
        r"\\\(|\\\)|\\\[|\\\]",
        r"\$+",
        r"\\mathrm\{",
        r"\}",
        rf"\^{SPACE}*\\?circ",
        r"\\(deg|circ)",
        "°",
    ]
    markers = r"[\\$}^°]"
    clean = text
    for pattern in markup:
        clean = F.regexp_replace(clean, pattern, "")
    plain = F.when(F.rlike(text, F.lit(markers)), clean).otherwise(text)
    found = ascii_digits(first_match(plain, r"^(?s).*?([-+]?\p{Nd}++)", 1))
    shape = [
        ("^[-+]?0*(?=0$)", ""),  # any zero is 0
        (r"^\+?(-?)0*(?=[1-9])", "$1"),
    ]
    for pattern, replacement in shape:
        found = F.regexp_replace(found, pattern, replacement)
    return first_match(found, "^.+")


PARSERS = {
    "yes_no": yes_no,
    "multiple_choice": choice_letter,
    "multiple_choice_full_word": full_word,
    "continue_value": number,
    "integer_exact_math": integer_math,
}


def parse_answer(pattern: Column, text: Column) -> Column:
    """Dispatch on the answer pattern; an unknown pattern reads as null."""
    (name, parse), *others = PARSERS.items()
    parsed = F.when(pattern == name, parse(text))
    for name, parse in others:
        parsed = parsed.when(pattern == name, parse(text))
    return parsed


def structured_fields(answer: Column) -> Column:
    """Explanation and final answer of a structured reply.

    A reply counts only as strict JSON whose two fields are both strings; any other reply
    has no explanation and is its own final answer.
    """
    reply = F.try_parse_json(answer)

    def is_text(key: str) -> Column:
        return F.schema_of_variant(F.try_variant_get(reply, f"$.{key}", "variant")) == "STRING"

    closed = F.endswith(strip(answer), F.lit("}"))
    complete = F.coalesce(closed & is_text("explicacao") & is_text("resposta"), F.lit(False))
    return F.struct(
        F.when(complete, F.try_variant_get(reply, "$.explicacao", "string")).alias("explanation"),
        F.when(complete, F.try_variant_get(reply, "$.resposta", "string"))
        .otherwise(answer)
        .alias("final"),
    )

"""Small string functions shared by templates, parsers and sinks."""

import sys
import unicodedata
from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as the answers' producers see it, i.e. Unicode White_Space plus the
# four separator controls. Printable ASCII comes first in the complement, so that common
# characters are settled by one comparison; the (?U) classes are several times slower.
_BLANKS = r"\p{Z}\t-\r\x1c-\x1f\x85"
SPACE = f"[{_BLANKS}]"
NOT_SPACE = f"[!-~[^{_BLANKS}]]"


# All decimal digits of Unicode beyond ASCII, and the ASCII digit of each.
_DIGITS = [c for c in map(chr, range(0x80, sys.maxunicode + 1)) if unicodedata.category(c) == "Nd"]
_DIGITS_FROM, _DIGITS_TO = "".join(_DIGITS), "".join(str(unicodedata.digit(c)) for c in _DIGITS)


def ascii_digits(text: Column) -> Column:
    """Decimal digits of any script as 0 to 9."""
    return F.when(
        text.rlike(r"[\p{Nd}&&[^0-9]]"), F.translate(text, _DIGITS_FROM, _DIGITS_TO)
    ).otherwise(text)


def strip(text: Column) -> Column:
    """Trim every kind of whitespace, not only U+0020."""
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+\z", "")


def first_match(text: Column, pattern: str, group: int = 0) -> Column:
    """Group of the first match, null on a miss; anchor `pattern` so that there is just one."""
    return F.get(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.lit(0))


def first_char(text: Column) -> Column:
    """First character that is not whitespace; null when there is none."""
    return first_match(text, f"^{SPACE}*+({NOT_SPACE})", 1)


def fill(pattern: str, **columns: Column) -> Column:
    """Fill `{name}` slots of a fixed wording with columns, as one codegen'd concat."""
    parts: list[Column] = []
    for text, slot, _, _ in Formatter().parse(pattern):
        if text:
            parts.append(F.lit(text))
        if slot is not None:
            parts.append(columns.get(slot, F.col(slot)).cast("string"))
    return F.concat(*parts)


def letter(position: Column) -> Column:
    """0 -> A, 1 -> B, ..."""
    return F.char(F.lit(65) + position.cast("int"))


def escape_xml(text: Column) -> Column:
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text


def unescape_xml(text: Column) -> Column:
    for raw, entity in ((">", "&gt;"), ("<", "&lt;"), ("&", "&amp;")):
        text = F.replace(text, F.lit(entity), F.lit(raw))
    return text


def tag_body(prompt: Column, tag: str) -> Column:
    """Stripped body of the first `<tag>` element in any letter case, `''` when there is none."""
    # The long s counts as an s when letter case is ignored.
    name = "".join(f"[{c}{c.upper()}{'ſ' if c == 's' else ''}]" for c in tag)
    body = F.regexp_extract(prompt, f"(?s)<{name}>(.*?)</{name}>", 1)
    return strip(F.coalesce(body, F.lit("")))


def mid_truncate(text: Column, limit: int) -> Column:
    """Cut the middle out of a text longer than `limit` characters."""
    # The mark put in place of the cut, and the slack kept for it.
    mark, slack = " ... ", 10
    keep = max(limit - slack, 0)
    head, tail = keep // 2, keep - keep // 2
    if keep == 0:
        cut = F.lit(mark.strip())
    else:
        cut = F.concat(F.substring(text, 1, head), F.lit(mark), F.right(text, F.lit(tail)))
    return F.when(F.length(text) > limit, cut).otherwise(text)


def escape_backslashes(text: Column) -> Column:
    r"""CSV-safe backslashes: double the one of a `\uXXXX` escape, then any not followed by u/U."""
    text = F.regexp_replace(text, r"\\([uU][0-9a-fA-F]{4})", r"\\\\$1")
    return F.regexp_replace(text, r"\\([^uU])", r"\\\\$1")


def model_short_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def joined_or_null(items: Column) -> Column:
    """Comma-joined list, null when the list is empty or null."""
    return F.nullif(F.array_join(items, ","), F.lit(""))


def round3(value: Column) -> Column:
    """Three decimals, half to even."""
    return F.bround(value, 3)

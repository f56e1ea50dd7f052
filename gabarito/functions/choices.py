"""Alternatives of a choice question: reading their stored forms and rendering them."""

import ast
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gabarito.functions.text import letter, strip
from gabarito.schemas import ALTERNATIVES


def _items(value) -> list | None:
    return [None if v is None else str(v) for v in value] if isinstance(value, (list, tuple)) else None


def _literal(text: str):
    try:
        return ast.literal_eval(text)
    except (ValueError, SyntaxError, MemoryError, RecursionError):
        return None


@F.pandas_udf(ALTERNATIVES)
def _read_literal(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Literals the JVM cannot read (None, tuples, escapes by number or name). Rows handled before arrive as null."""
    for batch in batches:
        rows = []
        for text in batch:
            value = None if text is None else _literal(text)
            if isinstance(value, dict):
                rows.append((_items(value.get("text")), _items(value.get("label"))))
            else:
                rows.append((_items(value), None))
        yield pd.DataFrame(rows, columns=["text", "label"])


# Escapes of a Python string that stand for one character, without the vertical
# tab, which Python and the JVM write differently in JSON; and how those begin that only Python reads.
ESCAPES = {"\\": "\\", "'": "'", '"': '"', "n": "\n", "t": "\t", "r": "\r", "a": "\a", "b": "\b", "f": "\f"}
LONG_ESCAPE = r"\\(?:[xuUNv0-7\n\r]|$)"
# Characters for private use, one an escape, that stand for it while the literal is read.
MARKS = "".join(chr(0xE000 + i) for i in range(len(ESCAPES)))


def _marked(text: Column, forms: str) -> Column:
    """A literal of strings only, with a mark for every escape; null if its skeleton has another form.

    The skeleton is what stays without strings and blanks. Backslashes stand in runs, which are
    read in pairs from the left; one before any other character is part of the string.
    """
    marked = text
    for escape, mark in zip(ESCAPES, MARKS):
        marked = F.replace(marked, F.lit("\\" + escape), F.lit(mark))
    skeleton = F.regexp_replace(F.regexp_replace(marked, r"""'[^']*'|"[^"]*\"""", ""), r"\s", "")
    readable = ~text.rlike(f"[{MARKS}]") & ~marked.rlike(LONG_ESCAPE) & skeleton.rlike(f"^(?:{forms})$")
    return F.when(F.contains(text, F.lit("\\")) & readable, F.replace(marked, F.lit("\\"), F.lit(MARKS[0])))


def _unmarked(items: Column) -> Column:
    return F.transform(items, lambda t: F.translate(t, MARKS, "".join(ESCAPES.values())))


# Skeletons of a list of strings and of a record of two such lists.
LIST = r"\[,*\]"
RECORD = r"\{:\[,*\],:\[,*\]\}"


def read_alternatives(text: Column) -> Column:
    """Stored literal (JSON or Python form, `{text, label}` or plain list) -> struct(text, label).

    JSON-compatible literals are read by the JVM, and so are lists of strings with one-character
    escapes, in Python's sense of them. Only what is left goes to Python (None, tuples, escapes
    by number or name), and every row already read passes there as null. What neither reads has
    a null `text`.
    """
    simple = F.when(~F.contains(text, F.lit("\\")), text)
    plain = F.from_json(simple, "array<string>")
    as_list = F.when(F.startswith(F.ltrim(simple), F.lit("[")) & plain.isNotNull(), plain)
    record = F.from_json(simple, ALTERNATIVES)
    escaped_list = _unmarked(F.from_json(_marked(text, LIST), "array<string>"))
    escaped = F.from_json(_marked(text, RECORD), ALTERNATIVES)
    texts = F.coalesce(record["text"], as_list, _unmarked(escaped["text"]), escaped_list)
    labels = F.coalesce(record["label"], _unmarked(escaped["label"]))
    rest = _read_literal(F.when(texts.isNull(), text))
    return F.struct(
        F.coalesce(texts, rest["text"]).alias("text"),
        F.when(texts.isNotNull(), labels).otherwise(rest["label"]).alias("label"),
    )


def choice_texts(df: DataFrame, column: str) -> Column:
    """Alternatives as `array<string>`, whichever way the table stores them."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StructType):
        return F.col(column)["text"]
    if isinstance(kind, T.ArrayType):
        return F.col(column).cast("array<string>")
    return read_alternatives(F.col(column))["text"]


@F.pandas_udf(T.StringType())
def _repair_literal(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        repaired = []
        for text in batch:
            value = None if text is None else _literal(text)
            if isinstance(value, dict):
                lists = {key: _items(value.get(key, [])) for key in ("text", "label")}
                repaired.append(
                    json.dumps({**value, **lists}, ensure_ascii=False, separators=(",", ":"), default=str)
                )
            else:
                repaired.append(None)
        yield pd.Series(repaired, dtype=object)


# The order of keys stays, so the JVM writes only what it would write in the same order.
FIRST_TEXT = r"""^\s*\{\s*["']text["']"""


def _safe(text: Column) -> Column:
    """With the backslash doubled of LaTeX commands that would be read as broken escapes."""
    # The LaTeX commands that collide with unicode escapes.
    for command in (r"\uparrow", r"\underline"):
        text = F.replace(text, F.lit(command), F.lit("\\" + command))
    return text


def native_repair(text: Column) -> Column:
    """What `sanitize_alternatives` makes of the literals that the JVM can repair, else null."""
    safe = _safe(text)
    simple = F.when(~F.contains(safe, F.lit("\\")), safe)
    # Only a record holding both lists and nothing else is rewritten by the JVM.
    keys = F.json_object_keys(simple)
    record = F.from_json(simple, ALTERNATIVES)
    whole = (
        (F.array_sort(keys) == F.array(F.lit("label"), F.lit("text")))
        & record["text"].isNotNull()
        & record["label"].isNotNull()
    )
    native = F.when(whole, F.to_json(record))
    marked = F.from_json(_marked(F.when(safe.rlike(FIRST_TEXT), safe), RECORD), ALTERNATIVES)
    lists = F.struct(*[_unmarked(marked[key]).alias(key) for key in ("text", "label")])
    escaped = F.when(marked["text"].isNotNull() & marked["label"].isNotNull(), F.to_json(lists))
    return F.coalesce(native, escaped)


def repair_with(text: Column, native: Column) -> Column:
    """The repaired text, given what the JVM made of it; only what is left goes to Python."""
    blank = strip(text) == ""
    return F.coalesce(native, _repair_literal(F.when(native.isNull() & ~blank, _safe(text))), text)


def sanitize_alternatives(text: Column) -> Column:
    r"""Repair LaTeX backslashes in a stored literal and write it back as JSON.

    `\uparrow` and `\underline` would be read as broken escapes, so their backslash is doubled
    first; a missing `text` or `label` becomes an empty list, their items become strings. A blank
    value or one that still cannot be read stays as it is.
    """
    return repair_with(text, native_repair(text))


def drop_placeholders(texts: Column) -> Column:
    """Without null, blank and dash-only choices."""
    # What a source writes for "no such choice".
    blanks = ["-", "–", ""]
    return F.filter(texts, lambda t: t.isNotNull() & ~strip(t).isin(blanks))


def columns_to_texts(columns: list[str], skip_null: bool = False) -> Column:
    """One array from one column per choice."""
    texts = F.array(*[F.col(c).cast("string") for c in columns])
    return F.array_compact(texts) if skip_null else texts


def render_choices(texts: Column) -> Column:
    """`(A): first` lines; a null choice shows as None."""
    return F.array_join(
        F.transform(
            texts,
            lambda t, i: F.concat(F.lit("("), letter(i), F.lit("): "), F.coalesce(t, F.lit("None"))),
        ),
        "\n",
    )


def render_letters(texts: Column) -> Column:
    """`(A),(B),` for as many letters as there are choices."""
    return F.array_join(
        F.transform(texts, lambda t, i: F.concat(F.lit("("), letter(i), F.lit("),"))), ""
    )


def index_to_letter(label: Column) -> Column:
    """Gold labels stored as 0-based positions."""
    return letter(label.cast("int"))

"""Truth tables of the answer parsers."""

import pytest
from pyspark.sql import functions as F

from gabarito.functions import parsers as P


def run(spark, parse, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(parse(F.col("t"))).collect()]


CASES = {
    P.yes_no: [
        ("Sim", "1"),
        ("não", "0"),
        ("NÃO!", "0"),
        ("Assim não", "1"),
        ("nao", "0"),
        ("  s", "1"),
        ("\n N", "0"),
        ("não", "0"),
        ("talvez", None),
        ("", None),
        ("   ", None),
        (None, None),
        ("ßim", None),
    ],
    P.choice_letter: [
        ("b) texto", "B"),
        (" \n c", "C"),
        ("(A)", "("),
        ("ß", "S"),
        ("", None),
        (" \t", None),
        (None, None),
        ("\x1cd", "D"),
    ],
    P.full_word: [
        ("positivo!", "Positivo"),
        (" NEUTRO. bla", "Neutro"),
        (" negativo x", "Negativo"),
        ("...", ""),
        ("", None),
        ("  ", None),
        (None, None),
    ],
    P.number: [
        ("valor 3,5", "3.5"),
        ("-2.25 e 7", "2.25"),
        ("10", "10"),
        ("1.", "1"),
        ("valor ３,５", "3.5"),
        ("٤", "4"),
        ("sem", None),
        ("", None),
        (None, None),
    ],
    P.integer_math: [
        (r"336^\circ", "336"),
        (r"336^{\circ}", "336"),
        ("336°", "336"),
        (r"\(336^\circ\)", "336"),
        ("-12.0", "-12"),
        ("1,000", "1"),
        ("$007$", "7"),
        ("+5", "5"),
        ("-0", "0"),
        ("000", "0"),
        (r"\mathrm{45}", "45"),
        (r"$$\mathrm{1}2$$", "12"),
        ("90\\degree", "90"),
        ("x", None),
        ("", None),
        (None, None),
        ("9" * 40, "9" * 40),
        ("9" * 5000, "9" * 5000),
        ("１２", "12"),
        ("x = -٣٤.0", "-34"),
    ],
}


@pytest.mark.parametrize("parse", CASES, ids=lambda p: p.__name__)
def test_truth_table(spark, parse):
    texts, expected = zip(*CASES[parse])
    assert run(spark, parse, texts) == list(expected)


def test_dispatch_and_unknown_pattern(spark):
    rows = spark.createDataFrame(
        [("yes_no", "Sim"), ("multiple_choice", "c"), ("integer_exact_math", "$08$"), ("other", "Sim")],
        "p string, t string",
    )
    got = [r[0] for r in rows.select(P.parse_answer(F.col("p"), F.col("t"))).collect()]
    assert got == ["1", "C", "8", None]


def test_structured_fields(spark):
    good = '{"explicacao": "porque", "resposta": "Sim", "z": 1}'
    texts = [
        good,
        '{"explicacao": "porque", "resposta": 5}',
        "{'explicacao': 'x', 'resposta': 'y'}",
        '{"resposta": "Sim"}',
        "Sim",
        good + " fim",
        None,
    ]
    got = run(spark, P.structured_fields, texts)
    assert tuple(got[0]) == ("porque", "Sim")
    assert [tuple(g) for g in got[1:]] == [(None, t) for t in texts[1:]]

from __future__ import annotations

import sys

import pytest
from pyspark.sql import functions as F

from prefspark.functions.judge import parse_rating, parse_verdict
from prefspark.functions.text import format_prompt, format_response, strip_text, text_or_default


def test_strip_agrees_with_python(spark):
    edges = [chr(c) for c in range(1, sys.maxunicode + 1) if chr(c).isspace()]
    others = [chr(c) for c in range(1, 0x3100) if not chr(c).isspace()]
    texts = [f"{c}a {c} b{c}" for c in edges + others] + ["", " ", "".join(edges)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for text, stripped in rows.select("t", strip_text(F.col("t"))).collect():
        assert stripped == text.strip(), ascii(text)


def test_templates(one_row):
    prompt, response, empty = one_row(
        format_prompt(F.lit("\n hi there ")), format_response(F.lit(" yes ")), format_response(F.lit(""))
    )
    assert prompt == "[CLS] [BOS] hi there [SEP] [BOS]"
    assert response == " [assistant]:  yes  <|endoftext|> [SEP]"
    assert empty == " [assistant]:  <|endoftext|> [SEP]"


def test_fallback(one_row):
    null = F.lit(None).cast("string")
    columns = [text_or_default(c, "none") for c in (null, F.lit(""), F.lit(" "))]
    assert one_row(*columns) == ("none", "none", " ")


@pytest.mark.parametrize(
    "raw, verdict",
    [("A", "A"), (" b ", "B"), ("\tB\n", "B"), ("　a", "A"), ("B.", None), ("AB", None), ("", None), (None, None)],
)
def test_verdicts(one_row, raw, verdict):
    assert one_row(parse_verdict(F.lit(raw).cast("string"))) == (verdict,)


RATINGS = [
    "nan", "inf", "Infinity", "4d", "4f", "0.99", "1", "5.0", "5.01", "2e0", "5.", ".5e1", "+3", "-3", "",
    " 3.5 ", "\n4\t", "four", "4 stars", "0x3", "1_0", "0_4.5", "1__0", "_4", "4_", "3e", "1e400", "٤",
    "４.５", "4,0", "0004", "40e-1", "..", "e1", "1.e0",
]


def test_ratings_agree_with_python(spark):
    def expected(raw):
        try:
            value = float(raw)
        except ValueError:
            return None
        return value if 1.0 <= value <= 5.0 else None

    rows = spark.createDataFrame([(r,) for r in RATINGS], "r string")
    for raw, rating in rows.select("r", parse_rating(F.col("r"))).collect():
        assert rating == expected(raw), ascii(raw)
    assert spark.range(1).select(parse_rating(F.lit(None).cast("string"))).first()[0] is None

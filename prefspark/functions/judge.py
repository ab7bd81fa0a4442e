"""Parse what a judge wrote; null marks a malformed reply."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from prefspark import defaults as D
from prefspark.functions.text import strip_text

_DIGITS = r"\d+(?:_\d+)*"
# Decimal literal with optional sign, fraction and exponent; single underscores may
# separate digits. Spark's own cast also takes a type suffix ("4d"), this does not.
_NUMBER = rf"^[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"


@cache
def _digits() -> tuple[str, str]:
    """Decimal digits outside ASCII, and the ASCII digit of each."""
    others = [
        c for c in map(chr, range(128, sys.maxunicode + 1)) if unicodedata.category(c) == "Nd"
    ]
    return "".join(others), "".join(str(unicodedata.decimal(c)) for c in others)


def parse_verdict(raw: Column) -> Column:
    """``A`` or ``B`` after stripping and upper-casing, else null."""
    verdict = F.upper(strip_text(raw))
    return F.when(verdict.isin("A", "B"), verdict)


def parse_rating(raw: Column) -> Column:
    """Number from 1 to 5, else null."""
    text = F.translate(strip_text(raw), *_digits())
    number = F.when(text.rlike(_NUMBER), F.replace(text, F.lit("_"), F.lit(""))).try_cast("double")
    return F.when(number.between(1.0, 5.0), number)


def preference_request(prompt: Column, answer_a: Column, answer_b: Column) -> Column:
    """User message that asks for the better of two answers."""
    return F.concat(
        F.lit("Question:\n"), prompt,
        F.lit("\n\nAnswer A:\n"), answer_a,
        F.lit("\n\nAnswer B:\n"), answer_b,
        F.lit(f"\n\n{D.PREFERENCE_CLOSING}"),
    )


def rating_request(prompt: Column, answer: Column) -> Column:
    """User message that asks for a rating of one answer."""
    return F.concat(
        F.lit("Question:\n"), prompt,
        F.lit("\n\nAnswer:\n"), answer,
        F.lit(f"\n\n{D.RATING_CLOSING}"),
    )

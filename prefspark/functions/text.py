"""Text clean-up and the training templates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from prefspark import defaults as D


def strip_text(text: Column) -> Column:
    """Remove whitespace at both ends, with Unicode's idea of whitespace.

    Spark's one-argument ``trim`` removes U+0020 only.
    """
    return F.btrim(text, F.lit(D.WHITESPACE))


def text_or_default(text: Column, default: str) -> Column:
    """``default`` where ``text`` is null or empty."""
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(default))


def format_prompt(prompt: Column) -> Column:
    """Stripped prompt between the opening and the closing special tokens."""
    return F.concat(
        F.lit(f"{D.CLS} {D.BOS} "), strip_text(prompt), F.lit(f" {D.SEP} {D.BOS}")
    )


def format_response(response: Column) -> Column:
    """Response as it is, tagged as the assistant's turn and closed by eos and sep."""
    return F.concat(F.lit(" [assistant]: "), response, F.lit(f" {D.EOS} {D.SEP}"))

"""Pieces that several of these operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words between ASCII white space, and words of letters and digits (A-Z already lower).
BLANK_WORD = r"[^\x20\x09-\x0D]+"
PLAIN_SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, all else as it is (``lower`` would change other letters too)."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def either_case(word: str) -> str:
    """A pattern for a word with each ASCII letter in either case, for any regex engine."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in word)


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, as a local variable would be."""
    return F.transform(F.array(value), body)[0]


def text_key(text: Column) -> Column:
    """128 bits that stand for a text; NULL and empty texts share one."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def plain_words(text: Column) -> Column:
    """Lower-case words of letters and digits of a text, in order; none for NULL."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), PLAIN_SEPARATOR, -1), "")

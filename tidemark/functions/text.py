"""Text to words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what separates two words.
BLANKS = "[ \\t\\n\\r\\f\\x0B]+"


def words(c: Column | str) -> Column:
    """Lower-case words of a text as an array, without empty words."""
    text = F.col(c) if isinstance(c, str) else c
    return F.array_remove(F.split(F.lower(text), BLANKS), "")

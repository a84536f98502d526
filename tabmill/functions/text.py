"""Text helpers."""

from __future__ import annotations

import string

from pyspark.sql import Column, functions as F

# Fixed value: the 32 ASCII punctuation characters.
PUNCTUATION = string.punctuation

# Fixed value: a word is two or more letters, digits or underscores, in any script.
WORD = r"[\p{L}\p{N}_]{2,}"


def plain(text: Column | str) -> Column:
    """Lower case, ASCII punctuation removed."""
    return F.translate(F.lower(text), PUNCTUATION, "")


def words(text: Column | str) -> Column:
    """Array of the words of a text, lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))

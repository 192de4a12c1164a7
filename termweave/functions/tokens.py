"""Tokenizers, as column expressions ``STRING -> ARRAY<STRING>``.

Two punctuation tokenizers exist on purpose.  They differ in the backslash (a
delimiter for documents, not for lines), in vertical tab and carriage return
(whitespace for lines, ordinary characters for documents) and in which tokens
survive (lines keep only tokens that start with ``a``..``z``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The delimiter sets are part of the result's definition.
DOCUMENT_DELIMITERS = r"""[ \t\n\f*$&#/"'\\,.:;?!\[\](){}<>~\-_]+"""
LINE_DELIMITERS = r"""[ \t\n\x0B\f\r*$&#/"',.:;?!\[\](){}<>~\-_]+"""


def document_tokens(text: Column) -> Column:
    """Words of a document, delimiters removed, case kept."""
    return F.array_remove(F.split(text, DOCUMENT_DELIMITERS), "")


def line_tokens(line: Column) -> Column:
    """Lower-cased words of a line that begin with a letter ``a``..``z``."""
    words = F.split(F.lower(line), LINE_DELIMITERS)
    return F.filter(words, lambda w: F.substring(w, 1, 1).between("a", "z"))


def space_tokens(line: Column) -> Column:
    """Fields between single spaces; repeated spaces give no empty field."""
    return F.array_remove(F.split(line, " "), "")


def letter_runs(text: Column) -> Column:
    """Distinct lower-cased runs of ``a``..``z``, the token set of a free text."""
    return F.array_distinct(F.array_remove(F.split(F.lower(text), "[^a-z]+"), ""))

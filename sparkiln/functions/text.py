"""Tokenisation and token cleaning (FN1-FN6) as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The delimiter set of java.util.StringTokenizer's default
# constructor, Java's \s class, and the characters kept by the cleaning rule.
TOKENIZER_DELIMS = "[ \\t\\n\\r\\f]+"
JAVA_WS = "[ \\t\\n\\x0B\\f\\r]"
KEEP_CHARS = "[^a-zA-Z0-9£]"
KEEP_OR_DELIM = "[^a-zA-Z0-9£ \\t\\n\\r\\f]"


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokenize(text) -> Column:
    """FN1: StringTokenizer semantics, i.e. split on runs of space, tab,
    newline, carriage return and form feed, with no empty tokens."""
    return F.filter(F.split(_as_col(text), TOKENIZER_DELIMS), lambda t: t != F.lit(""))


def java_split_ws(line) -> Column:
    """FN2: Java ``line.split("\\\\s+")`` on one line of text.

    Java keeps a leading empty token (line starting with white space), drops
    trailing empty tokens, returns ``[""]`` for an empty line and ``[]`` for
    a line of white space only.
    """
    line = _as_col(line)
    stripped = F.regexp_replace(line, JAVA_WS + "+\\z", "")
    return (F.when(line == F.lit(""), F.array(F.lit("")))
            .when(stripped == F.lit(""), F.array().cast("array<string>"))
            .otherwise(F.split(stripped, JAVA_WS + "+")))


def split_ws(text) -> Column:
    """Non-strict white-space split: Java's \\s class, no empty tokens."""
    return F.filter(F.split(_as_col(text), JAVA_WS + "+"), lambda t: t != F.lit(""))


def clean_token(token) -> Column:
    """FN4: keep only ASCII letters, digits and the pound sign."""
    return F.regexp_replace(_as_col(token), KEEP_CHARS, "")


def length_bucket(token) -> Column:
    """AGG2 bucket of one token: Tiny (1), Small (2-4), Medium (5-9), Big (else,
    including the empty token Java's split can produce)."""
    n = F.length(_as_col(token))
    return (F.when(n == 1, F.lit("Tiny"))
            .when((n >= 2) & (n <= 4), F.lit("Small"))
            .when((n >= 5) & (n <= 9), F.lit("Medium"))
            .otherwise(F.lit("Big")))


def text_lines(text) -> Column:
    """Lines of a text as a line-oriented file reader sees them: split on
    newlines, a final newline does not start an extra empty line."""
    return F.split(F.regexp_replace(_as_col(text), "\\n\\z", ""), "\\n")


def path_stem(path) -> Column:
    """FN6: file name up to the first dot."""
    name = F.element_at(F.split(_as_col(path), "/"), -1)
    return F.split_part(name, F.lit("."), F.lit(1))


def parent_folder(path) -> Column:
    """Name of the folder that holds a file."""
    return F.element_at(F.split(_as_col(path), "/"), -2)

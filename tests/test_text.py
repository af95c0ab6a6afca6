import re

from pyspark.sql import functions as F

from sparkiln.functions.text import clean_token, java_split_ws, tokenize
from sparkiln.operators.text import word_count, word_length_buckets


def java_split(line):
    """Java String.split("\\s+") written out in Python (test reference)."""
    if line == "":
        return [""]
    parts = re.split(r"[ \t\n\x0b\f\r]+", line)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


LINES = ["", "   ", " a b", "a  b ", "word", "\tx\ty\t", "one two three", "é à", " "]


def test_java_split_semantics(spark):
    df = spark.createDataFrame([(s,) for s in LINES], "value string")
    got = [r[0] for r in df.select(java_split_ws("value")).collect()]
    assert got == [java_split(s) for s in LINES]


def test_tokenize_and_clean(spark):
    df = spark.createDataFrame([("Hello, World!  £5\tfoo-bar\n",)], "value string")
    toks = df.select(tokenize("value")).first()[0]
    assert toks == ["Hello,", "World!", "£5", "foo-bar"]
    cleaned = df.select(F.transform(tokenize(F.lower("value")), clean_token)).first()[0]
    assert cleaned == ["hello", "world", "£5", "foobar"]


def test_word_count_and_buckets(spark):
    df = spark.createDataFrame([("a bb ccc",), ("a  dddddd",), ("",), (" x",)], "value string")
    wc = {r["word"]: r["count"] for r in word_count(df).collect()}
    assert wc == {"a": 2, "bb": 1, "ccc": 1, "dddddd": 1, "x": 1}
    strict = {r["bucket"]: r["count"] for r in word_length_buckets(df, strict=True).collect()}
    # empty line and the leading empty token of " x" are both "Big" in the reference
    assert strict == {"Tiny": 2 + 1, "Small": 2, "Medium": 1, "Big": 2}
    loose = {r["bucket"]: r["count"] for r in word_length_buckets(df).collect()}
    assert loose == {"Tiny": 3, "Small": 2, "Medium": 1}

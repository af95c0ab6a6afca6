"""Text statistics and cleaning (AGG1-AGG3, JN4, JN5).

Tokens are produced by ``explode`` inside the scan stage; every count is a
partial (map-side) plus final hash aggregate, the DataFrame form of the
reference's combiner.  A word that makes up a third of all tokens therefore
costs one row per task in the shuffle, not a third of the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkiln.functions.text import (KEEP_OR_DELIM, TOKENIZER_DELIMS, java_split_ws,
                                     length_bucket, split_ws, text_lines)
from sparkiln.operators.ranking import dense_index
from sparkiln.session import block_of, in_blocks, materialize, materialize_blocks, planned_with
from sparkiln.sources.tables import dealt

TEXT_BYTES = 16 << 20  # text whose distinct terms a task counts in memory
BLOCK = "block"


def word_count(lines: DataFrame, col: str = "value", partitions: int | None = None) -> DataFrame:
    """AGG1: (word, count) over StringTokenizer tokens of every line."""
    words = dealt(lines.select(col), partitions).select(
        F.explode(F.split(F.col(col), TOKENIZER_DELIMS)).alias("word"))
    return words.where(F.col("word") != F.lit("")).groupBy("word").agg(
        F.count(F.lit(1)).alias("count"))


def word_length_buckets(lines: DataFrame, col: str = "value", strict: bool = False,
                        partitions: int | None = None) -> DataFrame:
    """AGG2: token counts per length bucket.

    ``strict=True`` reproduces the reference exactly on line input (Java's
    ``split("\\\\s+")``: a leading empty token and an empty line each count
    once as "Big"); the default drops empty tokens.
    """
    split = java_split_ws(F.col(col)) if strict else split_ws(F.col(col))
    toks = dealt(lines.select(col), partitions).select(F.explode(split).alias("token"))
    return toks.groupBy(length_bucket(F.col("token")).alias("bucket")).agg(
        F.count(F.lit(1)).alias("count"))


def explode_lines(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per line of each text (a document read as a text file)."""
    return docs.select(*keep, F.explode(text_lines(F.col(text))).alias("value"))


def clean_tokens(docs: DataFrame, id: str = "doc_id", text: str = "text",
                 partitions: int | None = None) -> DataFrame:
    """FN1-FN4: lower case, tokenise, strip to [a-zA-Z0-9£], drop empties.
    Output (id, token), one row per token occurrence.

    Stripping every character that is neither kept nor a delimiter from the
    whole text, then splitting, gives exactly the tokens of split-then-strip
    (a removed character never separates tokens), with one regex pass per
    document instead of one per token."""
    docs = dealt(docs.select(id, text), partitions)
    kept = F.regexp_replace(F.lower(F.col(text)), KEEP_OR_DELIM, "")
    toks = docs.select(F.col(id), F.explode(F.split(kept, TOKENIZER_DELIMS)).alias("token"))
    return toks.where(F.col("token") != F.lit(""))


def term_counts(tokens: DataFrame, id: str = "doc_id", token: str = "token") -> DataFrame:
    """AGG3 first half: (doc_id, term, count) per distinct document-token pair."""
    return tokens.groupBy(F.col(id).alias("doc_id"), F.col(token).alias("term")).agg(
        F.count(F.lit(1)).alias("count"))


def build_dictionaries(counts: DataFrame, min_df: int = 1, max_df_ratio: float = 1.0):
    """Derive the two dictionaries the reference loads from files, from the
    document-term counts of ``term_counts``:

    * stop words: terms present in more than ``max_df_ratio`` of documents (none
      by default);
    * vocabulary: the remaining terms present in at least ``min_df``
      documents, ``term_id`` = 1-based rank of the term in byte order.

    Returns (stop(token), vocab(term_id, term)).  The document count is a
    scalar taken on the driver; the vocabulary ids come from the skew-proof
    ``dense_index`` (no single-task global window).
    """
    n_docs = counts.agg(F.count_distinct("doc_id").alias("n")).first()["n"]
    # one row per term, read twice (stop words, vocabulary): written once
    dfs = materialize(counts.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "doc-freq")
    limit = max_df_ratio * n_docs
    stop = dfs.where(F.col("df") > F.lit(limit)).select(F.col("term").alias("token"))
    kept = dfs.where((F.col("df") >= F.lit(min_df)) & (F.col("df") <= F.lit(limit)))
    vocab = dense_index(kept.select("term"), ["term"], out="term_id", start=1)
    return stop, vocab.select(F.col("term_id").cast("int").alias("term_id"), "term")


def doc_term_counts(counts: DataFrame, stop: DataFrame, vocab: DataFrame,
                    block: str | None = None) -> DataFrame:
    """AGG3 + JN4 + JN5: (term_id, doc_id, count) for terms that are not stop
    words and are in the vocabulary (unknown terms are dropped, as an inner
    dictionary lookup).  ``counts`` comes from ``term_counts``.  The
    dictionaries are joined as DataFrames: Spark broadcasts them when their
    measured size is under the broadcast threshold and shuffles otherwise.

    With ``block``, a column by which the counts lie in partitions (see
    ``in_blocks``), the distinct terms of each block are looked up and brought back to
    it, so that the counts do not move; the block is kept as a column."""
    terms = counts if block is None else counts.select(block, "term").distinct()
    kept = terms.join(stop.select(F.col("token").alias("term")), "term", "left_anti")
    known = kept.join(vocab, "term", "inner")
    if block is None:
        return known.select("term_id", "doc_id", "count")
    return counts.join(known.hint("shuffle_hash"), [block, "term"]).select(
        "term_id", "doc_id", "count", block)


def corpus_blocks(docs: DataFrame, id: str = "doc_id", text: str = "text",
                  min_df: int = 1, max_df_ratio: float = 1.0,
                  partitions: int | None = None) -> tuple[DataFrame, int]:
    """Whole chain text -> (term_id, doc_id, count, block) with derived dictionaries
    (by default every term is in the vocabulary and none is a stop word), and the
    number of blocks.

    The document-term counts feed three jobs (document count, dictionary,
    final join), so they are written once to the shared checkpoint folder
    instead of re-tokenising.  The texts are dealt by
    document, about ``TEXT_BYTES`` a task (``partitions`` tasks at least), so that a
    document's terms are counted where it lies and in memory: the counts are
    not exchanged.  Counts and triples are written in these blocks of documents, so
    that later steps bring to a block what its distinct terms need.
    """
    spark = docs.sparkSession
    bytes_ = docs.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    n = max(partitions or 1, -(-bytes_ // TEXT_BYTES))
    dealt_docs = docs.select(id, text).repartition(n, id)
    counts = term_counts(clean_tokens(dealt_docs, id, text), id)
    counts = materialize_blocks(counts.withColumn(BLOCK, block_of(spark, "doc_id", n)), n, BLOCK,
                                "term-counts")
    stop, vocab = build_dictionaries(counts, min_df, max_df_ratio)
    # the triples feed several jobs downstream (document count, tf and df
    # aggregates), so they are written once
    with planned_with(spark, in_blocks(n)):
        return materialize_blocks(doc_term_counts(counts, stop, vocab, BLOCK), n, BLOCK,
                                  "triples"), n


def corpus_triples(docs: DataFrame, id: str = "doc_id", text: str = "text",
                   min_df: int = 1, max_df_ratio: float = 1.0,
                   partitions: int | None = None) -> DataFrame:
    """The (term_id, doc_id, count) rows of ``corpus_blocks``."""
    return corpus_blocks(docs, id, text, min_df, max_df_ratio, partitions)[0].drop(BLOCK)

"""Term frequency, IDF and TF-IDF over sparse (term, doc, value) triples (AGG4-AGG8).

Per-term totals are partial/final aggregates joined back on their key; a term has one
entry per document at most.  Per-document totals are a window over the document's
entries, at most its distinct terms, which move once.  Triples that lie in blocks of
documents (``block``, see ``session.in_blocks``) do not move at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def doc_total(triples: DataFrame, doc: str = "doc_id") -> DataFrame:
    """AGG6: number of distinct documents N, one row (total_docs)."""
    return triples.agg(F.count_distinct(F.col(doc)).cast("long").alias("total_docs"))


def term_frequency(triples: DataFrame, doc: str = "doc_id", term: str = "term_id",
                   count: str = "count", keep: Sequence[str] = (),
                   block: str | None = None) -> DataFrame:
    """AGG4: tf = count / total count of the document.  One exchange: a document's
    entries meet in one task, at most its distinct terms.  None if they lie by ``block``,
    a column that depends on the document alone."""
    own = [doc] if block is None else [block, doc]
    words = F.sum(F.col(count)).over(Window.partitionBy(*own)).cast("double")
    rows = triples.where(F.col(doc).isNotNull()).withColumn("doc_words", words)
    return rows.select(doc, term, count, (F.col(count) / F.col("doc_words")).alias("tf"), *keep)


def tfidf(triples: DataFrame, doc: str = "doc_id", term: str = "term_id",
          count: str = "count", n_docs: int | None = None,
          block: str | None = None) -> DataFrame:
    """AGG5: idf = ln(N / df(term)) (unsmoothed, unlike MLlib's IDF) and
    tfidf = tf * idf.  N is the number of distinct documents (a scalar).

    With ``block``, a column by which the triples lie in partitions and that depends on
    the document alone, df goes to the distinct terms of each block; run it
    under ``session.in_blocks``, and no triple moves."""
    if n_docs is None:
        n_docs = doc_total(triples, doc).first()["total_docs"]
    dfs = triples.groupBy(term).agg(F.count(F.lit(1)).alias("df"))
    # df first: the rows that move by term are still without tf; hashed, not sorted
    if block is None:
        known = triples.select(doc, term, count).join(dfs.hint("shuffle_hash"), term, "left")
    else:
        here = triples.select(block, term).distinct().join(dfs, term)
        known = triples.select(block, doc, term, count).join(
            here.hint("shuffle_hash"), [block, term], "left")
    tf = term_frequency(known, doc, term, count, ["df"], block).where(F.col("df").isNotNull())
    out = tf.withColumn("idf", F.ln(F.lit(float(n_docs)) / F.col("df")))
    return out.select(doc, term, "tf", "idf", (F.col("tf") * F.col("idf")).alias("tfidf"))


def unique_terms(triples: DataFrame, term: str = "term_id") -> DataFrame:
    """AGG7: sorted distinct term ids."""
    return triples.select(term).distinct().orderBy(term)


def doc_vectors(triples: DataFrame, doc: str = "doc_id", term: str = "term_id",
                value: str = "tfidf") -> DataFrame:
    """AGG8: one sparse vector per document, entries sorted by term.

    Output: doc, vector array<struct<term, value>>, n_terms, norm.  A vector
    is bounded by its document's distinct terms.
    """
    entries = F.array_sort(F.collect_list(F.struct(F.col(term).alias("term"),
                                                   F.col(value).alias("value"))))
    return triples.groupBy(doc).agg(
        entries.alias("vector"),
        F.count(F.lit(1)).alias("n_terms"),
        F.sqrt(F.sum(F.col(value) * F.col(value))).alias("norm"),
    )

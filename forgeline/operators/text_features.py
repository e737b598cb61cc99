"""Text features for issue / PR titles and commit messages.

Two forms, both distributed and deterministic:

* :func:`term_weights` -- TF-IDF as rows ``(doc, term, tf, df, weight)`` with
  L2-normalised weights, built from DataFrame operations only. Terms stay
  readable, so the result can be joined, filtered or checked in SQL.
  ``idf = ln((N + 1) / (df + 1))`` (the same smoothing as ``pyspark.ml.feature.IDF``).
* :func:`text_vectors` -- the same features as sparse vectors through
  ``pyspark.ml`` (``RegexTokenizer -> HashingTF -> IDF -> Normalizer``) for
  downstream ML.

Whole texts are tokenised; nothing is truncated. The document count ``N`` is a
scalar subquery, not a driver round trip. Document frequency joins back to
the (doc, term) rows on the term; very common terms make that join skewed,
which AQE's skew-join handling splits at run time (the vocabulary is not
bounded, so it is not broadcast).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Terms are runs of letters (with their marks) and digits of any script, lower-cased.
TOKEN_SPLIT = r"[^\p{L}\p{M}\p{N}]+"


def documents(fct_issues: DataFrame, fct_prs: DataFrame, fct_commits: DataFrame) -> DataFrame:
    """``(doc_kind, repo_full_name, doc_key, text)`` from titles and commit messages."""
    return (fct_issues.selectExpr("'issue' AS doc_kind", "repo_full_name", "CAST(issue_number AS STRING) AS doc_key",
                                  "title AS text")
            .unionByName(fct_prs.selectExpr("'pr' AS doc_kind", "repo_full_name",
                                            "CAST(pr_number AS STRING) AS doc_key", "title AS text"))
            .unionByName(fct_commits.selectExpr("'commit' AS doc_kind", "repo_full_name", "sha AS doc_key",
                                                "message AS text")))


def documents_combined(issue_or_pr_latest: DataFrame, fct_commits: DataFrame) -> DataFrame:
    """:func:`documents` from the one-pass issue/PR dedup (one scan and one shuffle for both kinds)."""
    ip = issue_or_pr_latest.where("is_pull_request IS NOT NULL").selectExpr(
        "CASE WHEN is_pull_request THEN 'pr' ELSE 'issue' END AS doc_kind", "repo_full_name",
        "CAST(number AS STRING) AS doc_key", "title AS text")
    return ip.unionByName(fct_commits.selectExpr("'commit' AS doc_kind", "repo_full_name", "sha AS doc_key",
                                                 "message AS text"))


def tokens(docs: DataFrame, doc_cols: Sequence[str], text_col: str = "text") -> DataFrame:
    words = F.explode(F.split(F.lower(F.col(text_col)), TOKEN_SPLIT)).alias("term")
    return docs.select(*doc_cols, words).filter(F.col("term") != "")


def term_weights(docs: DataFrame, doc_cols: Sequence[str] = ("doc_kind", "repo_full_name", "doc_key"),
                 text_col: str = "text") -> DataFrame:
    doc_cols = list(doc_cols)
    tf = tokens(docs, doc_cols, text_col).groupBy(*doc_cols, "term").agg(F.count(F.lit(1)).alias("tf"))
    df_ = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    weighted = tf.join(df_, "term").withColumn(
        "_w", F.col("tf") * F.log((n_docs + F.lit(1)) / (F.col("df") + F.lit(1))))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(*doc_cols)))
    return weighted.select(
        *doc_cols, "term", F.col("tf").cast("bigint").alias("tf"), F.col("df").cast("bigint").alias("df"),
        F.when(norm > 0, F.col("_w") / norm).otherwise(F.lit(0.0)).alias("weight"),
    )


def text_vectors(docs: DataFrame, text_col: str = "text", num_features: int = 1 << 18) -> DataFrame:
    """Sparse TF-IDF vectors (L2) via ``pyspark.ml``; IDF is fitted with one distributed pass.

    Terms are hashed: two terms of one bucket become one feature. With ``v`` distinct terms
    about ``v * v / (2 * num_features)`` pairs meet, so choose ``num_features`` well above the vocabulary
    (262,144 suits some hundred terms without a meeting, some thousand with a few).
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer

    pipe = Pipeline(stages=[
        RegexTokenizer(inputCol=text_col, outputCol="_tokens", pattern=TOKEN_SPLIT, toLowercase=True),
        HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=num_features),
        IDF(inputCol="_tf", outputCol="_tfidf"),
        Normalizer(inputCol="_tfidf", outputCol="features", p=2.0),
    ])
    return pipe.fit(docs).transform(docs).drop("_tokens", "_tf", "_tfidf")

"""TF-IDF retrieval: raw term counts, smoothed idf, L2 norm, cosine similarity.

``idf = ln((1 + n) / (1 + df)) + 1``. Scores are compared after rounding to nine decimals, so that
exact copies of a document tie whatever the order of the floating-point sums.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkmon.functions.text import is_content, tokens
from sparkmon.operators.text_index import best_documents, build_index
from sparkmon.session import broadcast_if_small, fresh_dir, stage

SCORE_DECIMALS = 9
HOT_TOKENS = 20_000


def term_weights(corpus: DataFrame, text: str, stop_words: list[str] | None = None) -> DataFrame:
    """``(token, df, idf)`` of a corpus.

    Each document is reduced to its distinct tokens in place and the counts are combined before
    the shuffle, so a token that occurs in every document costs one row per task.
    """
    n = corpus.select(F.count(F.lit(1))).scalar()
    return (
        corpus.select(F.explode(F.array_distinct(tokens(text))).alias("token"))
        .filter(is_content("token", stop_words))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("df"))
        .select("token", "df", (F.log((1 + n) / (1 + F.col("df"))) + 1).alias("idf"))
    )


def query_weights(
    queries: DataFrame,
    query_id: str,
    text: str,
    idf: DataFrame,
    stop_words: list[str] | None = None,
) -> DataFrame:
    """``(query_id, token, weight)`` with unit norm; tokens the corpus lacks are left out."""
    counts = (
        queries.select(query_id, F.explode(tokens(text)).alias("token"))
        .filter(is_content("token", stop_words))
        .groupBy(query_id, "token")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    raw = counts.join(idf, "token").withColumn("raw", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(query_id)))
    return raw.select(query_id, "token", (F.col("raw") / norm).alias("weight"), "idf", "df")


def cosine_scores(
    corpus: DataFrame,
    doc_id: str,
    text: str,
    queries: DataFrame,
    query_id: str,
    query_text: str,
    stop_words: list[str] | None = None,
    small_corpus: bool = False,
    hot_tokens: int = HOT_TOKENS,
) -> DataFrame:
    """``(query_id, doc_id, score)`` for every pair that shares a token.

    The corpus is shuffled once, as text, by ``doc_id``. The frequent tokens, which make up most of a
    text and would skew a shuffle, are looked up in place where their staged table allows a
    broadcast; the rare rest is joined by token. The idf table is staged too, unless the caller
    knows the corpus to be small enough to be tokenised twice.
    """
    idf = term_weights(corpus, text, stop_words)
    if not small_corpus:
        idf = stage(idf, "idf")
    weights = query_weights(queries, query_id, query_text, idf, stop_words)
    # One factor per (token, query), plus one per token with no query that yields the norm.
    factors = stage(
        weights.select(
            "token", "df", query_id, (F.col("weight") * F.col("idf")).alias("factor")
        ).union(
            idf.select(
                "token", "df", F.lit(None).cast(queries.schema[query_id].dataType), F.col("idf")
            )
        ),
        "factors",
    )
    counts = (
        corpus.select(doc_id, text)
        .repartition(doc_id)
        .select(doc_id, F.explode(tokens(text)).alias("token"))
        .filter(is_content("token", stop_words))
        .groupBy(doc_id, "token")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    sums = _pair_sums(counts, factors, doc_id, query_id, hot_tokens)
    norm = F.sqrt(
        F.sum(F.when(F.col(query_id).isNull(), F.col("total"))).over(Window.partitionBy(doc_id))
    )
    return (
        sums.withColumn("norm", norm)
        .filter(F.col(query_id).isNotNull())
        .select(
            query_id,
            doc_id,
            F.round(F.col("total") / F.col("norm"), SCORE_DECIMALS).alias("score"),
        )
    )


def _pair_sums(
    counts: DataFrame, factors: DataFrame, doc_id: str, query_id: str, hot_tokens: int
) -> DataFrame:
    """``(doc_id, query_id, total)``: dot products, and the squared norm where the query is NULL.

    A token is hot from a ``1 / hot_tokens`` share of all postings on, so there are at most
    ``hot_tokens`` of them and their list can be broadcast whatever the corpus. A cold token holds
    less than that share, so no partition of the shuffled join stands out.
    """
    part = F.col("tf") * F.col("factor")
    term = F.when(F.col(query_id).isNull(), part * part).otherwise(part)
    pair = [doc_id, query_id]
    one_per_token = factors.select("token", "df").distinct()
    cutoff = one_per_token.select(F.sum("df") / hot_tokens).scalar()
    hot = stage(factors.filter(F.col("df") >= cutoff), "hot")
    hot_list = stage(hot.select("token").distinct(), "hot-tokens")
    cold = factors.filter(F.col("df") < cutoff)
    # Hot terms are summed where the document lies; only their sums meet the cold terms.
    hot_sums = (
        counts.join(broadcast_if_small(hot), "token").groupBy(*pair).agg(F.sum(term).alias("total"))
    )
    cold_terms = (
        counts.join(F.broadcast(hot_list), "token", "left_anti")
        .join(cold, "token")
        .select(*pair, term.alias("total"))
    )
    return (
        hot_sums.unionByName(cold_terms)
        .repartition(doc_id)
        .groupBy(*pair)
        .agg(F.sum("total").alias("total"))
    )


def retrieve_best(
    corpus: DataFrame,
    doc_id: str,
    text: str,
    queries: DataFrame,
    query_id: str,
    query_text: str,
    stop_words: list[str] | None = None,
) -> DataFrame:
    """Best document of every query; a query without a shared token gets the first document.

    The corpus is indexed in a scratch folder; pairs that cannot win are not scored.
    """
    index = build_index(corpus, doc_id, text, fresh_dir(corpus.sparkSession, "text-index"), stop_words)
    best = best_documents(index, queries, query_id, query_text, stop_words)
    first = corpus.select(F.min(doc_id)).scalar()
    return (
        queries.select(query_id)
        .join(best, query_id, "left")
        .select(
            query_id,
            F.coalesce("doc", first).alias(doc_id),
            F.coalesce("score", F.lit(0.0)).alias("score"),
        )
    )

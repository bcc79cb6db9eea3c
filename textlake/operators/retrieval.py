"""Chunk retrieval, prompts, page search and search result texts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlake.functions import fixed
from textlake.functions import text as T
from textlake.operators.cleaning import default_result_fields
from textlake.operators.features import idf_table, tfidf_transform
from textlake.plans.lookup import lookup
from textlake.plans.nearest import bucket_matrix, cosines, nearest, nearest_sparse
from textlake.plans.staging import stage

EMBED_DIMS = 256


def word_buckets(text: Column, dims: int = EMBED_DIMS) -> Column:
    """Hashed words of a text: a model-free embedding, as the list of its bucket numbers.

    The vector is the count per bucket; a column from a real model can take its place.
    """
    hashed = F.transform(T.word_tokens(text), lambda w: F.conv(F.substring(F.md5(w), 1, 4), 16, 10).cast("int"))
    return F.transform(hashed, lambda h: h % dims)


def _closeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minus the squared distance of the unit vectors."""
    return 2.0 * cosines(a, b) - 2.0


def retrieve_top_k(chunks: DataFrame, questions: DataFrame, k: int = 4, dims: int = EMBED_DIMS) -> DataFrame:
    """(query_id, chunk_id, distance, rank): the k nearest chunks by squared distance.

    chunks: (chunk_id, text); questions: (query_id, text).
    """
    rows = chunks.select("chunk_id", word_buckets(F.col("text"), dims).alias("buckets"))
    asked = questions.select("query_id", word_buckets(F.col("text"), dims).alias("buckets"))
    found = nearest(rows, "chunk_id", asked, k, bucket_matrix("buckets", dims), _closeness)
    return found.select("query_id", "chunk_id", (-F.col("score")).alias("distance"), "rank")


def assemble_context(found: DataFrame, chunks: DataFrame) -> DataFrame:
    """(query_id, context): retrieved chunk texts in rank order, a blank line between them."""
    hits = lookup(chunks.select("chunk_id", "text"), stage(found, "found"), ["chunk_id"], how="inner")
    ordered = F.sort_array(F.collect_list(F.struct("rank", "text"))).getField("text")
    return hits.groupBy("query_id").agg(F.array_join(ordered, "\n\n").alias("context"))


def build_prompts(contexts: DataFrame, questions: DataFrame) -> DataFrame:
    """(query_id, prompt): the question with its context; an empty context when nothing was found."""
    joined = questions.join(contexts, "query_id", "left")
    prompt = T.filled(fixed.PROMPT_FORMAT, context=F.coalesce("context", F.lit("")), question=F.col("text"))
    return joined.select("query_id", prompt.alias("prompt"))


def page_records(pages: DataFrame) -> DataFrame:
    """(page_id, title, url, content) from raw HTML; missing parts are NULL."""
    empty = F.lit("")
    return pages.select(
        "page_id",
        F.nullif(T.page_title(F.col("html")), empty).alias("title"),
        "url",
        F.nullif(T.page_text(F.col("html")), empty).alias("content"),
    )


def search_pages(records: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, page_id, score, rank): TF-IDF cosine of query and page content, best k.

    records: (page_id, content); queries: (query_id, text).
    """
    # written once: the words are read for the term weights, the page vectors and the page count
    tokens = records.select(F.col("page_id").alias("doc_id"), T.word_tokens(F.col("content")).alias("tokens"))
    tokens = stage(tokens, "page-words").where(F.col("tokens").isNotNull())
    idf = idf_table(tokens)
    asked = queries.select(F.col("query_id").alias("doc_id"), T.word_tokens(F.col("text")).alias("tokens"))
    asked = tfidf_transform(asked, idf).select(F.col("doc_id").alias("query_id"), "term", "weight")
    asked = stage(asked, "asked")
    # weights of all terms give a page its length; only terms of some query are kept as cells
    wanted = stage(asked.select("term").distinct(), "wanted")
    weights = tfidf_transform(tokens, idf)
    kept = lookup(weights, wanted, ["term"], how="inner")
    cells = kept.groupBy(F.col("doc_id").alias("page_id")).agg(
        F.collect_list(F.struct("term", "weight")).alias("cells")
    )
    return nearest_sparse(stage(cells, "page-cells"), "page_id", asked, k)


def with_records(found: DataFrame, records: DataFrame) -> DataFrame:
    """Found pages with title, url and content; only found pages are taken apart."""
    found = stage(found, "found")
    kept = lookup(records, stage(found.select("page_id").distinct(), "hits"), ["page_id"], how="left_semi")
    return lookup(kept, found, ["page_id"], how="inner")


def article_block(number: Column) -> Column:
    return F.concat(
        F.lit("**Article "), number.cast("string"), F.lit(":** "), F.col("title"),
        F.lit("\n   URL: "), F.col("url"), F.lit("\n   Summary: "), F.col("content"), F.lit("\n"),
    )


def format_results(queries: DataFrame, found: DataFrame, records: DataFrame) -> DataFrame:
    """(query_id, n_articles, results): numbered articles, or a fixed sentence when none."""
    hits = default_result_fields(with_records(found, records))
    ordered = F.sort_array(F.collect_list(F.struct("rank", article_block(F.col("rank")).alias("block"))))
    texts = hits.groupBy("query_id").agg(
        F.count("*").alias("n_articles"), F.array_join(ordered.getField("block"), "\n").alias("results")
    )
    return queries.select("query_id").join(texts, "query_id", "left").select(
        "query_id",
        F.coalesce("n_articles", F.lit(0)).alias("n_articles"),
        F.coalesce("results", F.lit(fixed.NO_RESULTS)).alias("results"),
    )

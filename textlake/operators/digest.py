"""Extractive news digests: one text per topic from the pages found for it."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textlake.functions import text as T
from textlake.operators.cleaning import default_result_fields
from textlake.operators.features import idf_table, tokenized
from textlake.operators.retrieval import search_pages
from textlake.plans.lookup import lookup
from textlake.plans.staging import stage


def search_queries(topics: DataFrame) -> DataFrame:
    """(query_id, text): the search query of a topic, the raw topic when it has none."""
    return topics.select("query_id", F.coalesce("search_query", "topic").alias("text"))


def page_summaries(records: DataFrame, idf: DataFrame, n: int = 2) -> DataFrame:
    """(page_id, summary): the n sentences whose words weigh most, in text order."""
    rows = records.where(F.col("content").isNotNull()).select(
        "page_id", F.posexplode(T.sentences(F.col("content"))).alias("pos", "sentence")
    )
    words = rows.select("page_id", "pos", F.explode(T.word_tokens(F.col("sentence"))).alias("term"))
    weighed = lookup(words, idf.select("term", "df", "idf"), ["term"], weight="df", how="inner")
    scores = weighed.groupBy("page_id", "pos").agg(F.round(F.sum("idf"), 4).alias("score"))
    window = Window.partitionBy("page_id").orderBy(F.desc("score"), "pos")
    best = scores.withColumn("r", F.row_number().over(window)).where(F.col("r") <= n)
    chosen = rows.join(best.select("page_id", "pos"), ["page_id", "pos"])
    ordered = F.sort_array(F.collect_list(F.struct("pos", "sentence"))).getField("sentence")
    return chosen.groupBy("page_id").agg(F.array_join(ordered, " ").alias("summary"))


def news_digest(topics: DataFrame, records: DataFrame, run_date: str, k: int = 5) -> DataFrame:
    """(query_id, topic, digest): header, date, headlines, article bodies and source urls.

    topics: (query_id, topic, search_query); the date is an argument, so a rerun gives the
    same text. Only pages that were found are summarized.
    """
    # written once: title and text of a page are read by the search, the weights and the digest
    records = stage(records, "records")
    found = stage(search_pages(records, search_queries(topics), k), "found")
    hits = found.select("page_id").distinct()
    kept = lookup(records, stage(hits, "hits"), ["page_id"], how="left_semi")
    idf = idf_table(tokenized(records.where(F.col("content").isNotNull()).select("content"), text="content"))
    summaries = page_summaries(kept, idf)
    articles = default_result_fields(
        kept.join(summaries, "page_id", "left").select("page_id", "title", "url", F.col("summary").alias("content"))
    )
    rows = articles.join(found, "page_id")
    ordered = F.sort_array(F.collect_list(F.struct("rank", "title", "url", "content")))

    def lines(shape):
        return F.array_join(F.transform("all", shape), "\n")

    per_topic = rows.groupBy("query_id").agg(ordered.alias("all"))
    shown = datetime.date.fromisoformat(run_date).strftime("%B %d, %Y")
    text = F.concat(
        F.lit("**News Digest**\n**Topic:** "), F.col("topic"), F.lit(f"\n**Date:** {shown}\n\n---\n\n**Key Headlines**\n"),
        lines(lambda a: F.concat(F.lit("- "), a.getField("title"))),
        F.lit("\n\n**Articles**\n"),
        lines(lambda a: a.getField("content")),
        F.lit("\n\n**Sources**\n"),
        lines(lambda a: a.getField("url")),
    )
    empty = F.concat(F.lit("**News Digest**\n**Topic:** "), F.col("topic"), F.lit(f"\n**Date:** {shown}\n\n---\n\nNo results found for the given query."))
    joined = topics.select("query_id", "topic").join(per_topic, "query_id", "left")
    return joined.select("query_id", "topic", F.when(F.col("all").isNull(), empty).otherwise(text).alias("digest"))

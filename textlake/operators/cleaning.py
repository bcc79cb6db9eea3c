"""Cleaning, label mapping and record defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textlake.functions import fixed
from textlake.functions import text as T
from textlake.plans.lookup import lookup
from textlake.plans.staging import stage


def upper_stage(df: DataFrame) -> DataFrame:
    return df.withColumn("text", T.upper_stage(F.col("text")))


def exclaim_stage(df: DataFrame) -> DataFrame:
    return df.withColumn("text", T.exclaim_stage(F.col("text")))


def clean_text(df: DataFrame) -> DataFrame:
    """Lower-case, collapse whitespace, drop null and blank texts."""
    return df.withColumn("text", T.cleaned(F.col("text"))).where(F.col("text") != "")


def map_labels(label: Column, mapping: dict[str, int]) -> Column:
    """Number of a label; NULL when the mapping does not know it."""
    number = F.lit(None).cast("int")
    for name, value in mapping.items():
        number = F.when(label == name, F.lit(value)).otherwise(number)
    return number


def missing_report(df: DataFrame) -> DataFrame:
    """before, dropped, remaining rows when every row with a NULL is dropped; one pass."""
    missing = F.lit(False)
    for c in df.columns:
        missing = missing | F.col(c).isNull()
    return df.agg(
        F.count("*").alias("before"),
        F.count_if(missing).alias("dropped"),
        F.count_if(~missing).alias("remaining"),
    )


def drop_missing_rows(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def split_features_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    return df.drop(target), df.select(target)


def default_result_fields(df: DataFrame) -> DataFrame:
    return df.select(
        *[c for c in df.columns if c not in ("title", "url", "content")],
        F.coalesce("title", F.lit(fixed.NO_TITLE)).alias("title"),
        F.coalesce("url", F.lit(fixed.NO_URL)).alias("url"),
        F.coalesce("content", F.lit(fixed.NO_CONTENT)).alias("content"),
    )


def take_first_n(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.orderBy(key).limit(n)


def remove_stopwords(df: DataFrame, stop: list[str] | None = None) -> DataFrame:
    """Drop stop words from the `tokens` array, order and duplicates kept."""
    return df.withColumn("tokens", T.without(F.col("tokens"), fixed.STOP_WORDS if stop is None else stop))


def lemma_column(token: Column, lemmas: dict[str, str] | None = None) -> Column:
    """Dictionary form of a token, the token itself when unknown."""
    lemmas = fixed.LEMMAS if lemmas is None else lemmas
    if not lemmas:
        return token
    pairs = [F.lit(v) for kv in lemmas.items() for v in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), token), token)


def lemmatize(df: DataFrame, lemmas: dict[str, str] | None = None) -> DataFrame:
    return df.withColumn("tokens", F.transform("tokens", lambda t: lemma_column(t, lemmas)))


def lemma_table(spark: SparkSession, lemmas: dict[str, str] | None = None) -> DataFrame:
    """Written (form, lemma) of a small dictionary."""
    rows = list((fixed.LEMMAS if lemmas is None else lemmas).items())
    return stage(spark.createDataFrame(rows, "form string, lemma string"), "lemmas")


def lemma_lookup(words: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Add the lemma of each `token` from a written table (form, lemma), the token itself when unknown."""
    forms = dictionary.select(F.col("form").alias("token"), F.col("lemma").alias("_lemma"))
    found = lookup(words, forms, ["token"])
    return found.withColumn("lemma", F.coalesce("_lemma", "token")).drop("_lemma")


def lemmatize_with(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(doc_id, tokens) in dictionary forms, from a written table (form, lemma) of any size, one row per form.

    A document's distinct tokens are looked up; only the known ones are gathered again, and the
    document's tokens are replaced in the row.
    """
    words = df.select("doc_id", T.each(F.array_distinct("tokens")).alias("form"))
    known = lookup(words, dictionary.select("form", "lemma"), ["form"], how="inner")
    maps = known.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("form", "lemma"))).alias("_lemmas"))
    rows = df.join(maps, "doc_id", "left")
    changed = F.transform("tokens", lambda t: F.coalesce(F.element_at("_lemmas", t), t))
    return rows.withColumn("tokens", F.when(F.col("_lemmas").isNull(), F.col("tokens")).otherwise(changed)).drop("_lemmas")


def normalise_corpus(df: DataFrame, stop: list[str] | None = None) -> DataFrame:
    """Clean, tokenize, drop stop words, reduce to dictionary forms; one narrow job with a small dictionary."""
    tokens = df.transform(clean_text).select("doc_id", T.word_tokens(F.col("text")).alias("tokens"))
    return tokens.transform(lambda d: remove_stopwords(d, stop)).transform(lemmatize)

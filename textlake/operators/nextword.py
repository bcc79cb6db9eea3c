"""Next-word statistics: pair counts, most probable continuations, perplexity, masked mean."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlake.functions import text as T
from textlake.operators.features import term_counts
from textlake.plans.lookup import lookup
from textlake.plans.ranking import running_total
from textlake.plans.staging import stage

LOSS_LIMIT = 20.0  # perplexity is infinite from this mean loss on


def _pairs() -> Column:
    """The adjacent pairs of `tokens`, array<struct<prev, next>>, built inside the row."""
    n = F.size("tokens")
    pairs = F.arrays_zip(
        F.slice("tokens", F.lit(1), F.greatest(n - 1, F.lit(0))).alias("prev"),
        F.slice("tokens", F.lit(2), F.greatest(n - 1, F.lit(0))).alias("next"),
    )
    return pairs


def ngram_counts(tokens: DataFrame) -> DataFrame:
    """(prev, next, n): adjacent token pairs, counted before the shuffle."""
    rows = tokens.select(F.explode(_pairs()).alias("p"))
    return rows.groupBy("p.prev", "p.next").agg(F.count("*").alias("n"))


def pair_table(tokens: DataFrame) -> DataFrame:
    """Written pair counts with `prev_n`, the count of all pairs that start with prev."""
    counts = stage(ngram_counts(tokens), "pairs")
    totals = stage(counts.groupBy("prev").agg(F.sum("n").alias("prev_n"), F.count("*").alias("forms")), "pair-totals")
    # a first word with very many continuations is looked up without being shuffled
    return stage(lookup(counts, totals, ["prev"], weight="forms", how="inner"), "pair-table")


def next_token_top_k(pairs: DataFrame, k: int = 5, temperature: float = 1.0) -> DataFrame:
    """(prev, next, rank, prob): the k most probable continuations, temperature applied, renormalised."""
    window = Window.partitionBy("prev").orderBy(F.desc("n"), "next")
    best = pairs.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)
    # the count of prev cancels out when the kept k are renormalised
    weight = F.exp(F.log(F.col("n") / F.col("prev_n")) / temperature)
    best = best.withColumn("w", weight)
    total = F.sum("w").over(Window.partitionBy("prev"))
    return best.select("prev", "next", F.col("rank").cast("bigint"), (F.col("w") / total).alias("prob"))


def next_token_top_p(pairs: DataFrame, p: float = 0.95, rows_per_range: int | None = None) -> DataFrame:
    """(prev, next, prob): the smallest set of likeliest continuations that reaches p.

    Counts are compared as whole numbers. A first word with very many continuations is cut
    into ranges of the order, so no task has to walk through all of them.
    """
    ordered = pairs.withColumn("_rare", -F.col("n"))
    more = {"rows_per_range": rows_per_range} if rows_per_range else {}
    placed = running_total(ordered, ["_rare", "next"], F.col("n"), group=["prev"], out="_upto", **more)
    before = F.col("_upto") - F.col("n")
    kept = placed.where(before < F.lit(p) * F.col("prev_n"))
    return kept.select("prev", "next", (F.col("n") / F.col("prev_n")).alias("prob"))


def guarded_exp(mean: Column) -> Column:
    return F.when(mean < LOSS_LIMIT, F.exp(mean)).otherwise(F.lit(float("inf")))


def pair_losses(tokens: DataFrame, pairs: DataFrame) -> DataFrame:
    """(doc_id, loss): add-one smoothed loss of every pair of a document."""
    size = tokens.select(T.each("tokens").alias("t")).distinct().count()
    rows = tokens.select("doc_id", F.explode(_pairs()).alias("p"))
    found = lookup(rows.select("doc_id", "p.prev", "p.next"), pairs.select("prev", "next", "n", F.col("n").alias("w"), "prev_n"), ["prev", "next"], weight="w", how="inner")
    loss = -F.log((F.col("n") + 1) / (F.col("prev_n") + F.lit(size)))
    return found.select("doc_id", loss.alias("loss"))


def perplexity(losses: DataFrame) -> DataFrame:
    """(doc_id, mean_loss, perplexity) per document."""
    means = losses.groupBy("doc_id").agg(F.avg("loss").alias("mean_loss"))
    return means.withColumn("perplexity", guarded_exp(F.col("mean_loss")))


def corpus_perplexity(losses: DataFrame) -> DataFrame:
    mean = losses.agg(F.avg("loss").alias("mean_loss"))
    return mean.withColumn("perplexity", guarded_exp(F.col("mean_loss")))


def token_counts(tokens: DataFrame) -> DataFrame:
    """Written (token, n): occurrences of every token."""
    counts = term_counts(tokens.select("tokens"))
    return stage(counts.groupBy(F.col("term").alias("token")).agg(F.sum("tf").alias("n")), "token-counts")


def token_losses(tokens: DataFrame, counts: DataFrame) -> DataFrame:
    """(doc_id, token, loss, mask): unigram add-one loss; mask 0 for tokens that were not counted."""
    t = counts.agg(F.sum("n").alias("total"), F.count("*").alias("size")).first()
    rows = tokens.select("doc_id", T.each("tokens").alias("token"))
    found = lookup(rows, counts.select("token", "n", F.col("n").alias("w")), ["token"], weight="w")
    share = (F.coalesce("n", F.lit(0)) + 1) / F.lit(float(t["total"] + t["size"] + 1))
    return found.select("doc_id", "token", (-F.log(share)).alias("loss"), F.col("n").isNotNull().cast("int").alias("mask"))


def masked_mean(losses: DataFrame, by: list[str]) -> DataFrame:
    """Σ(loss·mask) / Σ(mask) per group; NULL where nothing is unmasked."""
    mean = F.try_divide(F.sum(F.col("loss") * F.col("mask")), F.sum("mask"))
    return losses.groupBy(*by).agg(mean.alias("masked_mean"), F.sum("mask").alias("n_real"))

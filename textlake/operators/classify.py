"""Multinomial Naive Bayes over TF-IDF weights, and label scoring by similarity."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.functions import text as T
from textlake.operators.features import idf_table, tfidf_transform
from textlake.plans.lookup import lookup
from textlake.plans.staging import stage

MAX_CLASSES = 10_000  # classes to tell apart: each is a column of the model


def class_list(df: DataFrame, column: str) -> list:
    """Sorted distinct values of a column; an error, not a cut, when there are too many."""
    rows = df.select(column).where(F.col(column).isNotNull()).distinct().limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{column} has more than {MAX_CLASSES} classes")
    return sorted(r[0] for r in rows)


@dataclass
class NaiveBayes:
    """idf: written term table; terms: (term, df, ll_0, ll_1, …); one prior per class."""

    classes: list
    priors: list[float]
    idf: DataFrame
    terms: DataFrame


def nb_train(tokens: DataFrame, labels: DataFrame, alpha: float = 1.0) -> NaiveBayes:
    """Class priors and smoothed term log-likelihoods from (doc_id, tokens) and (doc_id, label)."""
    known = stage(tokens.join(labels, "doc_id").select("doc_id", "tokens", "label"), "nb-train")
    classes = class_list(known, "label")
    sizes = known.agg(F.count("*"), *[F.count_if(F.col("label") == c) for c in classes]).first()
    priors = [n / sizes[0] for n in sizes[1:]]
    idf = idf_table(known.select("doc_id", "tokens"))
    weights = tfidf_transform(known, idf)
    weights = weights.join(known.select("doc_id", "label"), "doc_id")
    per_class = [
        F.coalesce(F.sum(F.when(F.col("label") == c, F.col("weight"))), F.lit(0.0)).alias(f"w_{i}")
        for i, c in enumerate(classes)
    ]
    sums = stage(weights.groupBy("term").agg(F.count("*").alias("df"), *per_class), "nb-terms")
    totals = sums.agg(F.count("*").alias("v"), *[F.sum(f"w_{i}").alias(f"w_{i}") for i in range(len(classes))])
    totals = totals.first()
    likelihoods = [
        F.log((F.col(f"w_{i}") + alpha) / F.lit(totals[f"w_{i}"] + alpha * totals["v"])).alias(f"ll_{i}")
        for i in range(len(classes))
    ]
    return NaiveBayes(classes, priors, idf, sums.select("term", "df", *likelihoods))


def nb_table(model: NaiveBayes) -> DataFrame:
    """The model in long form: (label, term, log_likelihood)."""
    cells = [F.struct(F.lit(c).alias("label"), F.col(f"ll_{i}").alias("ll")) for i, c in enumerate(model.classes)]
    long = model.terms.select("term", F.explode(F.array(*cells)).alias("e"))
    return long.select("e.label", "term", F.col("e.ll").alias("log_likelihood"))


def nb_predict(tokens: DataFrame, model: NaiveBayes) -> DataFrame:
    """(doc_id, score_0 …, prediction); documents without known terms follow the prior."""
    weights = tfidf_transform(tokens, model.idf)
    found = lookup(weights, model.terms, ["term"], weight="df", how="inner")
    parts = [F.sum(F.col("weight") * F.col(f"ll_{i}")).alias(f"part_{i}") for i in range(len(model.classes))]
    sums = found.groupBy("doc_id").agg(*parts)
    scored = tokens.select("doc_id").join(sums, "doc_id", "left")
    scores = [
        (F.log(F.lit(p)) + F.coalesce(f"part_{i}", F.lit(0.0))).alias(f"score_{i}")
        for i, p in enumerate(model.priors)
    ]
    scored = scored.select("doc_id", *scores)
    best = F.lit(model.classes[0])
    top = F.col("score_0")
    for i, c in list(enumerate(model.classes))[1:]:
        best = F.when(F.col(f"score_{i}") > top, F.lit(c)).otherwise(best)
        top = F.greatest(top, F.col(f"score_{i}"))
    return scored.withColumn("prediction", best)


def label_profiles(tokens: DataFrame, group: str) -> DataFrame:
    """(label, term, weight): all terms of the label's texts by document count, unit length per label."""
    counts = tokens.select(F.col(group).alias("label"), T.each(F.array_distinct("tokens")).alias("term"))
    counts = counts.groupBy("label", "term").agg(F.count("*").alias("n"))
    counts = stage(counts, "label-terms")
    length = counts.groupBy("label").agg(F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("length"))
    profiles = lookup(counts, stage(length, "label-lengths"), ["label"], how="inner")
    return stage(profiles.select("label", "term", (F.col("n") / F.col("length")).alias("weight")), "label-profiles")


def zero_shot_scores(weights: DataFrame, docs: DataFrame, profiles: DataFrame) -> DataFrame:
    """(doc_id, label, score, rank): softmax over the cosines to each label's description.

    weights: unit-length (doc_id, term, weight); docs keeps documents without any match.
    """
    labels = class_list(profiles, "label")
    found = lookup(weights, profiles.select("label", "term", F.col("weight").alias("lw")), ["term"], how="inner")
    parts = [
        F.sum(F.when(F.col("label") == c, F.col("weight") * F.col("lw"))).alias(f"c{i}") for i, c in enumerate(labels)
    ]
    dots = docs.select("doc_id").join(found.groupBy("doc_id").agg(*parts), "doc_id", "left")
    powers = [F.exp(F.coalesce(f"c{i}", F.lit(0.0))).alias(f"e{i}") for i in range(len(labels))]
    powers = dots.select("doc_id", *powers)
    total = sum((F.col(f"e{i}") for i in range(len(labels))), F.lit(0.0))
    cells = [
        F.struct((-F.round(F.col(f"e{i}") / total, 6)).alias("neg"), F.lit(c).alias("label"))
        for i, c in enumerate(labels)
    ]
    ranked = powers.select("doc_id", F.posexplode(F.sort_array(F.array(*cells))).alias("pos", "e"))
    return ranked.select("doc_id", "e.label", (-F.col("e.neg")).alias("score"), (F.col("pos") + 1).alias("rank"))

"""Stems of a vocabulary under three algorithms, and the terms each of them merges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.functions import stems
from textlake.functions import text as T
from textlake.plans.staging import stage

ALGORITHMS = {"porter": stems.porter, "snowball": stems.snowball, "lancaster": stems.lancaster}


def stem_terms(terms: DataFrame) -> DataFrame:
    """terms with one column per algorithm."""
    for name, add in ALGORITHMS.items():
        terms = add(terms, "term", name)
    return terms


def stem_vocabulary(tokens: DataFrame) -> DataFrame:
    """Written (term, n, porter, snowball, lancaster): every distinct term is stemmed once."""
    counts = tokens.select(T.each("tokens").alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    return stage(stem_terms(counts), "stems")


def conflation_groups(stemmed: DataFrame) -> DataFrame:
    """(algorithm, stem, n_forms, freq, top_form): what each algorithm merges.

    Terms are reduced to numbers per stem before the shuffle; the merged terms themselves
    are the rows of the stem table.
    """
    long = stemmed.unpivot(["term", "n"], list(ALGORITHMS), "algorithm", "stem")
    return long.groupBy("algorithm", "stem").agg(
        F.count("*").alias("n_forms"),
        F.sum("n").alias("freq"),
        F.min(F.struct((-F.col("n")).alias("neg"), "term")).getField("term").alias("top_form"),
    )

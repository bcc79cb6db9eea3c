"""Vocabulary, bag of words, TF-IDF and corpus statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlake.functions import text as T
from textlake.plans.lookup import lookup
from textlake.plans.ranking import running_total
from textlake.plans.staging import stage


def tokenized(docs: DataFrame, tokenizer=T.word_tokens, text: str = "text") -> DataFrame:
    """docs with a `tokens` array in place of the text."""
    return docs.withColumn("tokens", tokenizer(F.col(text))).drop(text)


def term_counts(tokens: DataFrame) -> DataFrame:
    """One row per row and distinct token: the other columns, term, tf.

    Counted inside the row: the sorted tokens are cut where the token changes. No
    shuffle is needed, however many documents there are.
    """
    others = [c for c in tokens.columns if c != "tokens"]
    ordered = tokens.withColumn("_sorted", F.sort_array("tokens"))
    cut = ordered.withColumn(
        "_starts",
        F.filter(
            F.transform(
                "_sorted",
                lambda t, i: F.when((i == 0) | (t != F.get(F.col("_sorted"), i - 1)), i),
            ),
            lambda i: i.isNotNull(),
        ),
    )
    counted = cut.select(
        *others,
        F.explode(
            F.transform(
                "_starts",
                lambda s, j: F.struct(
                    F.get(F.col("_sorted"), s).alias("term"),
                    (F.coalesce(F.get(F.col("_starts"), j + 1), F.size("_sorted")) - s)
                    .cast("bigint")
                    .alias("tf"),
                ),
            )
        ).alias("_c"),
    )
    return counted.select(*others, "_c.term", "_c.tf")


def document_frequency(tokens: DataFrame) -> DataFrame:
    """(term, df): documents per term."""
    terms = tokens.select(T.each(F.array_distinct("tokens")).alias("term"))
    return terms.groupBy("term").agg(F.count("*").alias("df"))


def vocabulary(tokens: DataFrame) -> DataFrame:
    """(term, index): sorted distinct terms, index from 0."""
    terms = stage(tokens.select(T.each("tokens").alias("term")).distinct(), "terms")
    ranked = running_total(terms, ["term"], out="n")
    return ranked.select("term", (F.col("n") - 1).alias("index"))


def bag_of_words(tokens: DataFrame) -> DataFrame:
    """(doc_id, term, count): the non-zero cells of the document-term matrix."""
    return term_counts(tokens).withColumnRenamed("tf", "count")


def doc_word_frequency(docs: DataFrame, doc_id: int) -> DataFrame:
    """Term counts of one document; the key filter reaches the scan."""
    chosen = docs.where(F.col("doc_id") == doc_id).select("doc_id", "text")
    return bag_of_words(tokenized(chosen))


def idf_weight(n_docs: int) -> Column:
    """Smooth inverse document frequency."""
    return F.log(F.lit(1.0 + n_docs) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)


def idf_table(tokens: DataFrame) -> DataFrame:
    """Written table (term, df, idf) of a training corpus."""
    n_docs = tokens.count()
    return stage(document_frequency(tokens).withColumn("idf", idf_weight(n_docs)), "idf")


def tfidf_transform(tokens: DataFrame, idf: DataFrame) -> DataFrame:
    """(doc_id, term, tf, weight): documents scored with a given idf table.

    Terms outside the table are dropped before the row is scaled to length 1.
    """
    counts = term_counts(tokens.select("doc_id", "tokens"))
    scored = lookup(counts, idf.select("term", "df", "idf"), ["term"], weight="df", how="inner")
    scored = scored.withColumn("w", F.col("tf") * F.col("idf"))
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc_id")))
    return scored.select("doc_id", "term", "tf", (F.col("w") / length).alias("weight"))


def tfidf(tokens: DataFrame) -> DataFrame:
    return tfidf_transform(tokens, idf_table(tokens))


def tfidf_matrix_sample(docs: DataFrame, n: int = 5) -> DataFrame:
    """TF-IDF of the first n documents as a wide table: term, doc_1 … doc_n.

    Only terms that occur in the sample appear. Weights use the whole corpus, but only
    the n chosen documents are scored.
    """
    idf = idf_table(tokenized(docs.select("doc_id", "text")).select("doc_id", "tokens"))
    first = docs.select("doc_id", "text").orderBy("doc_id").limit(n)
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("doc_id"))  # n rows
    first = first.withColumn("place", place)
    scored = tfidf_transform(tokenized(first).select("doc_id", "tokens"), idf)
    scored = scored.join(F.broadcast(first.select("doc_id", "place")), "doc_id")
    wide = scored.groupBy("term").pivot("place", list(range(1, n + 1))).agg(F.first("weight"))
    cells = [F.coalesce(F.col(str(i)), F.lit(0.0)).alias(f"doc_{i}") for i in range(1, n + 1)]
    return wide.select("term", *cells)


def top_terms(weights: DataFrame, k: int = 5) -> DataFrame:
    """The k heaviest terms per document, ties by term."""
    window = Window.partitionBy("doc_id").orderBy(F.desc("weight"), "term")
    return weights.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def corpus_stats(docs: DataFrame, block: int = 512) -> DataFrame:
    """One row: documents, characters, size in millions, tokens, training samples, matrix cells, vocabulary.

    A training sample is a full block of tokens of all documents put end to end.
    """
    tokens = docs.select(F.length("text").alias("chars"), T.word_tokens(F.col("text")).alias("tokens"))
    terms = tokens.select(T.each("tokens").alias("term")).distinct()
    return tokens.agg(
        F.count("*").alias("n_docs"),
        F.sum("chars").alias("n_chars"),
        F.round(F.sum("chars") / F.lit(1e6), 2).alias("size_mb"),
        F.sum(F.size("tokens")).alias("n_tokens"),
        F.floor(F.sum(F.size("tokens")) / F.lit(block)).alias("n_samples"),
        F.sum(F.size(F.array_distinct("tokens"))).alias("n_cells"),
    ).select("*", terms.agg(F.count("*")).scalar().alias("vocab_size"))


def approx_vocabulary_size(tokens: DataFrame, rsd: float = 0.01) -> DataFrame:
    return tokens.select(T.each("tokens").alias("term")).agg(
        F.approx_count_distinct("term", rsd).alias("vocab_size")
    )

"""File sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from textlake.functions import text as T


def read_delimited(spark: SparkSession, path: str, schema: StructType | str | None = None, sep: str = ";") -> DataFrame:
    """A separated file with a header line; types are inferred only without a schema."""
    reader = spark.read.option("sep", sep).option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_labelled_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated label and message, no header, quotes taken literally."""
    reader = spark.read.option("sep", "\t").option("quote", "\u0000").schema("label STRING, message STRING")
    return reader.csv(path)


def read_text_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """(path, text): every *.txt file below a folder, one row per file."""
    reader = spark.read.option("pathGlobFilter", "*.txt").option("recursiveFileLookup", True)
    files = reader.text(folder, wholetext=True)
    if files.isEmpty():  # reads one file; no list of them comes to the driver
        raise FileNotFoundError(f"no .txt files below {folder}")
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def read_text_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(path, block_start, place, line): every line of every *.txt file below a folder.

    Files are read by byte ranges in parallel, so that a file may be of any size; a row of
    `read_text_corpus` holds a whole file and thus 2 GB at most. Lines of a file are in order of
    (block_start, place).
    """
    reader = spark.read.option("pathGlobFilter", "*.txt").option("recursiveFileLookup", True).option("lineSep", "\n")
    lines = reader.text(folder)
    if lines.isEmpty():
        raise FileNotFoundError(f"no lines in .txt files below {folder}")
    return lines.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").alias("line"),
    )


def write_digest_files(digests: DataFrame, folder: str, timestamp: str) -> DataFrame:
    """Write one text per topic into a folder named from the timestamp and the topic.

    `digests` has topic and digest. Topics that give the same name are told apart by a number.
    Returns what was written: name, digest.
    """
    named = digests.select(
        F.concat(F.lit(timestamp + "_"), T.safe_topic(F.col("topic"))).alias("name"), "topic", "digest"
    )
    number = F.row_number().over(Window.partitionBy("name").orderBy("topic", "digest"))
    named = named.withColumn("_number", number)
    numbered = F.when(F.col("_number") > 1, F.concat_ws("_", "name", "_number")).otherwise(F.col("name"))
    named = named.select(numbered.alias("name"), "digest")
    named.write.mode("overwrite").partitionBy("name").option("lineSep", "\n").text(folder)
    spark = digests.sparkSession
    back = spark.read.option("recursiveFileLookup", True).text(folder, wholetext=True)
    name = F.url_decode(F.regexp_extract("_metadata.file_path", r"name=([^/]*)/", 1))
    return back.select(name.alias("name"), F.col("value").alias("digest"))


def write_processed_corpus(docs: DataFrame, path: str) -> DataFrame:
    """Write cleaned documents and return them read back; fails if rows were lost."""
    seen = Observation()  # counts the rows while they are written
    docs.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    back = docs.sparkSession.read.schema(docs.schema).parquet(path)
    written, wanted = back.count(), seen.get["n"]
    if written != wanted:
        raise OSError(f"wrote {written} rows of {wanted} to {path}")
    return back


def write_tokenizer_tables(vocab: DataFrame, merges: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    vocab.write.mode("overwrite").parquet(f"{folder}/vocab")
    merges.write.mode("overwrite").parquet(f"{folder}/merges")
    return read_tokenizer_tables(vocab.sparkSession, folder)


def read_tokenizer_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    vocab = spark.read.schema("token STRING, id INT").parquet(f"{folder}/vocab")
    merges = spark.read.schema("rank INT, left STRING, right STRING").parquet(f"{folder}/merges")
    return vocab, merges

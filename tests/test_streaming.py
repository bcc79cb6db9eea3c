from __future__ import annotations

from pyspark.sql import functions as F

from textlake.functions import text as T
from textlake.operators import chunks, cleaning
from textlake.plans.staging import new_path
from textlake.streaming.stages import run_available, stream_parquet

SCHEMA = "doc_id bigint, text string"


def test_stateless_stages_on_a_stream_equal_the_batch(spark):
    def stage(df):
        return df.transform(cleaning.clean_text).transform(chunks.chunk_fixed).withColumn("n", F.size(T.word_tokens(F.col("text"))))

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    source, out, memory = (new_path(spark, n) for n in ("stream-in", "stream-out", "stream-memory"))
    docs.where("doc_id < 90").write.parquet(source)
    run_available(stream_parquet(spark, source, SCHEMA), stage, out, memory)
    docs.where("doc_id >= 90").write.mode("append").parquet(source)
    run_available(stream_parquet(spark, source, SCHEMA), stage, out, memory)  # only the new files
    found, expected = spark.read.parquet(out), stage(docs)
    assert found.count() == expected.count()
    assert found.exceptAll(expected).isEmpty()

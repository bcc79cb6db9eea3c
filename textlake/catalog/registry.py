"""Registration of queries; each module of this package adds its own."""

from __future__ import annotations

import re
from collections.abc import Callable
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession

from textlake.plans.shipping import ship
from textlake.plans.staging import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


# Tables whose rows are long texts, with their key.
TEXT_KEYS = {"documents": "doc_id", "pages": "page_id"}


class Tables:
    """The tables of one data folder, read lazily by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return spread(table, TEXT_KEYS[name]) if name in TEXT_KEYS else table


def query(name: str, sql: str | None = None):
    """Register f(tables) under a name, with the SQL that gives the same rows."""

    def add(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            spark.conf.set("spark.sql.unionOutputPartitioning", "false")  # see stacked()
            return build(Tables(spark, folder))

        QUERIES[name] = run
        if sql:
            ORACLES[name] = dedent(sql).strip()
        return build

    return add


# Shared SQL pieces.
WORDS = r"""
toks AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}') AS t FROM documents),
words AS (SELECT doc_id, unnest(t) AS term, unnest(range(len(t))) AS pos FROM toks)"""

RAW = r"""
raw AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS t FROM documents),
raw_words AS (SELECT doc_id, unnest(t) AS token, unnest(range(len(t))) AS pos FROM raw)"""


def quoted(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def filled_sql(template: str, **columns: str) -> str:
    """SQL of a text with expressions in place of its {names}."""
    text = lambda part: "'" + part.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
    parts = re.split(r"\{(\w+)\}", template)
    return " || ".join(columns[part] if i % 2 else text(part) for i, part in enumerate(parts))

"""Text expressions; every one is a built-in column expression that runs in the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token patterns.
WORD = r"[\p{L}\p{N}_]{2,}"
CONTRACTION = r"(?i)(n't|'(?:s|re|ve|m|ll|d))\b"
PUNCT_TOKEN = r"[\p{L}\p{N}]*'\p{L}+|[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"
SENTENCE_GAP = r"(?<=[.!?])\s+"


def each(array: Column | str) -> Column:
    """explode, written so that the optimizer does not add a size filter for the array.

    Such a filter is pushed down to the scan and computes the tokens a second time there.
    """
    return F.explode(F.slice(array, F.lit(1), F.lit(2**31 - 1)))


def upper_stage(text: Column) -> Column:
    return F.upper(text)


def exclaim_stage(text: Column) -> Column:
    return F.concat(text, F.lit("!"))


def cleaned(text: Column) -> Column:
    """Lower-case, one space between words, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def ws_tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"\s+"), lambda t: t != "")


def raw_ws_tokens(text: Column) -> Column:
    """Whitespace tokens with their case kept."""
    return F.filter(F.split(text, r"\s+"), lambda t: t != "")


def word_tokens(text: Column) -> Column:
    """Lower-case runs of at least two word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def punct_tokens(text: Column) -> Column:
    """Words and punctuation marks; contractions split off as their own token."""
    split_off = F.regexp_replace(text, CONTRACTION, " $1")
    return F.regexp_extract_all(split_off, F.lit(PUNCT_TOKEN), F.lit(0))


def sentences(text: Column) -> Column:
    return F.split(text, SENTENCE_GAP)


def characters(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def without(tokens: Column, stop: list[str]) -> Column:
    """Tokens not in the stop list, in order, duplicates kept."""
    return F.filter(tokens, lambda t: ~t.isin(*stop))


def safe_topic(topic: Column) -> Column:
    kept = F.regexp_replace(topic, r"[^\p{L}\p{N} _-]", "")
    return F.substring(F.replace(kept, F.lit(" "), F.lit("_")), 1, 50)


def page_title(html: Column) -> Column:
    return F.regexp_extract(html, r"(?is)<title>(.*?)</title>", 1)


def page_text(html: Column) -> Column:
    """Visible text: head, scripts, styles, comments and tags removed, spaces collapsed."""
    body = F.regexp_replace(
        html, r"(?is)<head\b.*?</head>|<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->", " "
    )
    return F.trim(F.regexp_replace(F.regexp_replace(body, r"(?s)<[^>]*>", " "), r"\s+", " "))


def filled(template: str, **columns: Column) -> Column:
    """A text with columns in place of its {names}."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[columns[part] if i % 2 else F.lit(part) for i, part in enumerate(parts)])

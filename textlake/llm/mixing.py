"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Each source has a target of words. A document's rate, how often it enters the mix, is the
one nearest to even (in entropy, with room between 0 and 2 copies) whose sizes add up to the
target: rate = 2 / (1 + exp(-tilt * size)), exponentially tilted by size. The tilt of each
source solves a convex dual by Newton steps, each one aggregation over the distinct sizes of
each source. Rates become whole copies by systematic rounding in order of size, so that a
source's words miss their target by at most about its largest document.

Defined results: a null text has size 0; a null source is a source of its own, the last. A
source without words has target 0. Repeated rows are documents of their own. An empty table
gives no rows. Columns named like the new ones are replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlake.llm.columns import carried
from textlake.plans.ranking import running_total
from textlake.plans.staging import stage

WEIGHTS = (5, 2, 1)  # of the sources in order, repeating
SHARE = 1.5  # words of the mix by all words
MOST = 2.0  # copies of a document, and times a source's words
NEWTON_STEPS = 60  # at most; each halves the bracket at least
EXACT = 1e-10  # relative miss at which a source is solved
UNIT = 1_000_000  # a rate of one as a whole number
RANGE = 100_000  # documents put in order at once


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def targets(sources: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target): shares by weight, stopped at `most` times the size.

    sources: (source, source_size), written. What a stopped source leaves is shared among
    the others by weight until none is above; each round is one aggregation.
    """
    ranked = running_total(
        sources.withColumn("_last", F.col("source").isNull().cast("int")), ["_last", "source"], out="_rank"
    )
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("_rank") - 1, len(weights)).cast("int") + 1)
    ranked = stage(ranked.select("source", "source_size", weight.alias("_weight")), "sources")
    cap = F.col("source_size") * most
    total = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * share
    level, full = 0.0, -1  # words per weight; sources that are full at that level
    while True:
        stopped = F.col("_weight") * level > cap
        seen = ranked.agg(
            F.count(F.when(stopped, 1)),
            F.coalesce(F.sum(F.when(stopped, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~stopped, F.col("_weight"))), F.lit(0.0)),
        ).first()
        if seen[0] == full or not seen[2]:
            break
        full, level = seen[0], (total - seen[1]) / seen[2]
    return ranked.select("source", "source_size", F.least(F.col("_weight") * level, cap).alias("target"))


def _rate(tilt: Column, size: Column, most: float) -> Column:
    return F.lit(most) / (1 + F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), tilt * size))))


def tilts(sizes: DataFrame, wanted: DataFrame, most: float = MOST) -> DataFrame:
    """(source, tilt) by Newton steps kept inside a bracket.

    sizes: (source, size, n), written; wanted: (source, source_size, target), written.
    """
    # sizes are scaled by the source's mean of size^2 / size, so that tilts are near one
    scale = sizes.groupBy("source").agg(
        (F.sum(F.col("n") * F.col("size") * F.col("size")) / F.greatest(F.sum(F.col("n") * F.col("size")), F.lit(1))).alias("scale")
    )
    open_ = (F.col("target") > 0) & (F.col("target") < most * F.col("source_size") * (1 - 1e-12))
    state = stage(
        wanted.withColumnRenamed("source", "_s").join(scale, F.col("_s").eqNullSafe(F.col("source")))
        .select(
            "source", "target", F.greatest("scale", F.lit(1.0)).alias("scale"),
            F.when(open_, 0.0).when(F.col("target") > 0, 1e300).otherwise(-1e300).alias("tilt"),
            F.lit(-700.0).alias("low"), F.lit(700.0).alias("high"), (~open_).alias("done"),
        ),
        "tilts",
    )
    for _ in range(NEWTON_STEPS):
        todo = state.where("not done").select(F.col("source").alias("_s"), "tilt", "scale")
        size = F.col("size") / F.col("scale")
        rate = _rate(F.col("tilt"), size, most)
        sums = (
            sizes.join(todo, F.col("source").eqNullSafe(F.col("_s")))
            .groupBy("_s")
            .agg(
                F.sum(F.col("n") * F.col("size") * rate).alias("got"),
                F.sum(F.col("n") * F.col("size") * size * rate * (1 - rate / most)).alias("slope"),
            )
        )
        miss = F.col("got") - F.col("target")
        low = F.when(miss < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(miss > 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - miss / F.col("slope")
        done = F.col("done") | (F.abs(miss) <= EXACT * F.col("target")) | (high - low < 1e-12)
        inside = F.when((F.col("slope") > 0) & (newton > low) & (newton < high), newton).otherwise((low + high) / 2)
        state = stage(
            state.join(sums, F.col("source").eqNullSafe(F.col("_s")), "left").select(
                "source", "target", "scale",
                F.when(F.coalesce(done, F.lit(True)), F.col("tilt")).otherwise(inside).alias("tilt"),
                F.coalesce(low, F.col("low")).alias("low"), F.coalesce(high, F.col("high")).alias("high"),
                F.coalesce(done, F.lit(True)).alias("done"),
            ),
            "tilts",
        )
        if state.where("not done").isEmpty():
            break
    # rounded, so that sums in another order give the same rates
    return state.select("source", F.round(F.col("tilt"), 9).alias("tilt"), "scale")


def copies(narrow: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """narrow(doc_id, source, size), written, with source_size, target, rate and copies."""
    sizes = stage(narrow.groupBy("source", "size").agg(F.count("*").alias("n")), "size-counts")
    sources = stage(sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), "sources")
    wanted = stage(targets(sources, weights, share, most), "targets")
    tilted = tilts(sizes, wanted, most).withColumnRenamed("source", "_s")
    solved = stage(wanted.join(tilted, F.col("source").eqNullSafe(F.col("_s"))).withColumn("_s", F.col("source")).drop("source"), "solved")
    rated = narrow.join(solved, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    rated = rated.withColumn("rate", _rate(F.col("tilt"), F.col("size") / F.col("scale"), most)).drop("tilt", "scale")
    rated = stage(rated.withColumn("_units", F.round(F.col("rate") * UNIT).cast("bigint")), "rates")
    # in order of source and size, each document takes the whole numbers its rate moves past
    placed = running_total(rated, ["source", "size", "doc_id"], F.col("_units"), out="_upto", rows_per_range=RANGE)
    past = lambda units: F.floor((units + UNIT // 2) / UNIT)
    return placed.withColumn("copies", past(F.col("_upto")) - past(F.col("_upto") - F.col("_units"))).drop("_units", "_upto")


def mixed_words(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, rate, copies, taken), a row per document."""
    narrow = stage(docs.select("doc_id", "source", words_in(F.col("text")).alias("size")), "sizes")
    found = copies(narrow, **options)
    return found.select(
        "doc_id", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs, each as often as the mix takes it; other columns are kept, whatever their names."""
    return carried(docs, ("doc_id", "source", "text"), lambda rows: _copied(rows, **options))


def _copied(docs: DataFrame, **options) -> DataFrame:
    key = ["doc_id", "source", "_size"]
    nth = F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64("text")))
    sized = docs.withColumn("_size", words_in(F.col("text")))
    narrow = stage(sized.select("doc_id", "source", F.col("_size").alias("size")), "sizes")
    taken = copies(narrow, **options).where("copies > 0")
    taken = taken.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(["doc_id", "source", "size"])], "copies")
    same = Window.partitionBy("_k0", "_k1", "_k2").orderBy(F.desc("copies"))
    taken = taken.withColumn("_k3", F.row_number().over(same)).withColumnRenamed("copies", "_copies")
    on = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate([*key, "_nth"])]
    rows = sized.withColumn("_nth", nth).join(taken, reduce(lambda a, b: a & b, on))
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))

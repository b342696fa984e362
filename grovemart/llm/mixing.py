"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight in each phase of training. The integral of its weight over time
is its share of the words taken; a source too small for its share is repeated, up to a
limit, and what it cannot give goes to the others by weight. Documents of a source
stand in a keyed random order; a document that starts at word x of the demand of its source is
met at the training time at which the source's cumulative demand reaches x. Sorting by
that time interleaves all sources as the schedule wants it.

Nothing but DataFrame functions. Running sums go over (source, slice of the random order),
so a source with a third of all rows is spread over thousands of slices; what is sorted in
one task is one row per source.

Defined cases: null text has size 0; size 0 takes 0 and has no position; a null source is a
source, last in order; equal doc_ids are told apart by size and text hash, wholly equal
rows are interchangeable; an empty table gives an empty one; columns with the names of
the result are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grovemart.llm.common import before, n_words, put_back, set_aside

#: Slices of a source's random order: the first three hex digits of the key.
SLICE_DIGITS = 3

PLAN_COLUMNS = ["size", "source_size", "target", "taken", "position"]


@dataclass(frozen=True)
class Phase:
    """A part of training and the weights of the sources in it, by rank, repeating."""

    length: float
    weights: tuple[float, ...]


#: Integrates to the weights 5, 2, 1; the third kind of source is all used in the first half.
PRODUCTION = (Phase(0.5, (4.0, 2.0, 2.0)), Phase(0.5, (6.0, 2.0, 0.0)))


def _by_rank(weights: tuple[float, ...]) -> Column:
    at = ((F.col("_rank") - 1) % len(weights) + 1).cast("int")
    return F.element_at(F.array(*[F.lit(float(w)) for w in weights]), at)


def source_targets(sizes: DataFrame, schedule: tuple[Phase, ...], repeats: float) -> DataFrame:
    """One row per source key: its rank, size, and target words.

    Level filling: sources by the weight-scaled size at which they are exhausted; those before
    the first that its share does not exhaust stop at their limit.
    """
    by_key = sizes.groupBy("_source", "_key").agg(F.sum("size").alias("source_size"))
    ranked = by_key.withColumn(
        "_rank", F.row_number().over(Window.orderBy(F.col("_source").asc_nulls_last()))
    )
    weight = sum((F.lit(p.length) * _by_rank(p.weights) for p in schedule), F.lit(0.0))
    full = Window.orderBy(F.col("_limit") / F.col("_weight"), "_rank")
    everything = Window.partitionBy()
    rest = full.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    earlier = full.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("_limit").over(earlier), F.lit(0.0))
    levels = (
        ranked.withColumn("_weight", weight)
        .withColumn("_limit", F.lit(float(repeats)) * F.col("source_size"))
        .withColumn("_left", left)
        .withColumn("_weights", F.sum("_weight").over(rest))
        .withColumn("_open", F.col("_left") * F.col("_weight") / F.col("_weights") <= F.col("_limit"))
    )
    ratio = F.col("_limit") / F.col("_weight")
    first_open = F.min(F.when(F.col("_open"), F.struct(ratio, "_rank", "_left", "_weights")))
    share = F.col("_level._left") * F.col("_weight") / F.col("_level._weights")
    return (
        levels.withColumn("_level", first_open.over(everything))
        .withColumn("target", F.coalesce(F.least(share, F.col("_limit")), F.col("_limit")))
        .select("_source", "_key", "_rank", "source_size", "target")
    )


def position(start: Column, target: Column, schedule: tuple[Phase, ...]) -> Column:
    """Training time, 0 to 1, at which the demand of a source reaches its word `start`."""
    weight = sum((F.lit(p.length) * _by_rank(p.weights) for p in schedule), F.lit(0.0))
    wanted = start / target * weight
    length = sum(p.length for p in schedule)
    time, done = F.lit(0.0), F.lit(0.0)
    for phase in schedule:
        gain = F.lit(phase.length) * _by_rank(phase.weights)
        inside = F.greatest(F.least((wanted - done) / gain, F.lit(1.0)), F.lit(0.0))
        skipped = (wanted >= done).cast("double")
        time = time + F.lit(phase.length / length) * F.when(gain > 0, inside).otherwise(skipped)
        done = done + gain
    return time


def mix(
    docs: DataFrame,
    schedule: tuple[Phase, ...] = PRODUCTION,
    repeats: float = 3.0,
    seed: str = "mix",
) -> DataFrame:
    """All rows of `docs` (doc_id, text, source, ...) with size, source_size, target, taken, position.

    `taken` is the number of words the mix takes, repeats counted: whole rounds over
    the source, then the documents up to its target, the one on the border in part.
    `position` is the training time of the first copy, null if nothing is taken.
    `copies` has the times of all copies. The result is sorted by position.
    """
    rows, names = set_aside(docs)
    plan = _planned(rows, names, schedule, repeats, seed).orderBy(F.col("position").asc_nulls_last(), names["doc_id"])
    own = [*PLAN_COLUMNS, "copies"]
    return plan.select(*put_back(names, own), *own)


def _planned(
    rows: DataFrame, names: dict[str, str], schedule: tuple[Phase, ...], repeats: float, seed: str
) -> DataFrame:
    """All rows with the plan's columns; `names` tells where doc_id, text and source are."""
    doc_id, text = F.col(names["doc_id"]).cast("string"), F.col(names["text"])
    sized = (
        rows.withColumn("size", n_words(text))
        .withColumn("_source", F.col(names["source"]).cast("string"))
        .withColumn("_key", F.coalesce(F.concat(F.lit("s"), F.col("_source")), F.lit("")))
        .withColumn("_random", F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id, F.lit("")))))
        .withColumn("_slice", F.substring("_random", 1, SLICE_DIGITS))
        .withColumn("_print", F.xxhash64(text))
    )
    # One row per source and slice: how many words come before it, and what the source gives.
    slices = sized.groupBy("_source", "_key", "_slice").agg(F.sum("size").alias("size"))
    targets = source_targets(slices, schedule, repeats).drop("_source")
    offsets = (
        slices.withColumn("_offset", before(["_key"], ["_slice"], "size"))
        .select("_key", "_slice", "_offset")
        .join(targets, "_key")
    )
    whole = F.floor(F.col("_words") / F.col("source_size"))
    part = F.col("_words") - F.col("_rounds") * F.col("source_size") - F.col("_start")
    placed = (
        sized.withColumn("_within", before(["_key", "_slice"], ["_random", "size", "_print"], "size"))
        .join(offsets, ["_key", "_slice"])
        .withColumn("_start", F.col("_offset") + F.col("_within"))
        .withColumn("_words", F.floor("target"))
        .withColumn("_rounds", F.when(F.col("source_size") > 0, whole).otherwise(0))
        .withColumn("_part", F.greatest(F.least(part, F.col("size")), F.lit(0)))
        .withColumn("taken", F.col("_rounds") * F.col("size") + F.col("_part"))
        .withColumn("_copies", F.when(F.col("size") > 0, F.col("_rounds") + (F.col("_part") > 0).cast("long")).otherwise(0))
    )
    at = F.col("_start") + F.lit(0.0)
    first = F.when(F.col("_copies") > 0, position(at, F.col("target"), schedule))
    return placed.withColumn("position", first).withColumn("copies", F.col("_copies").cast("int"))


def mixed(
    docs: DataFrame,
    schedule: tuple[Phase, ...] = PRODUCTION,
    repeats: float = 3.0,
    seed: str = "mix",
) -> DataFrame:
    """The training rows themselves: each document once per copy, in order of position.

    The columns are those of `docs`. A copy on the border of a target keeps its first words,
    joined by one space.
    """
    rows, names = set_aside(docs)
    plan = _planned(rows, names, schedule, repeats, seed).where("copies > 0")
    copies = plan.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    start = F.col("_start") + F.col("_copy") * F.col("source_size") + F.lit(0.0)
    text = F.col(names["text"])
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    border = (F.col("_copy") == F.col("copies") - 1) & (F.col("_part") > 0) & (F.col("_part") < F.col("size"))
    kept = F.array_join(F.slice(words, F.lit(1), F.col("_part").cast("int")), " ")
    cut = copies.withColumn(names["text"], F.when(border, kept).otherwise(text))
    timed = cut.withColumn("_at", position(start, F.col("target"), schedule))
    return timed.orderBy("_at", names["doc_id"], "_copy").select(*put_back(names, []))

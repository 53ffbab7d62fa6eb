"""Mixing sources to target token counts by entropy balancing, in DataFrame operations only.

A document's rate is exp(lambda * size / mean size of its source), at most `cap`: of all
rates that make a source's tokens meet its target, those nearest in relative entropy to
taking every document once, under that bound. The lambda of each source is the solution of
a convex dual, found by Newton steps inside a bracket. A step is one distributed sum over
the size histogram of each source, as documents of one source and size share their rate;
the lambdas, one row per source, are stored after every step.

Rates become whole copies per size by rounding running sums from the longest size down, so
a source misses its target by less than its longest document; the rest is made up by some
copies more or fewer at up to eight sizes per power of two. Within a size, copies go round evenly,
the odd ones by the hash of the document's id.

Defined results: a null text has size 0; a null source is a source, the last; documents of
size 0 stay once and take nothing; repeated rows are mixed each on their own; a null id is
kept; an empty table gives an empty one; other columns are not read; texts are counted
whole. Reruns agree.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import FILE, ROW, WORD, numbered, stored, with_row_key

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3
TOLERANCE = 1e-7
MAX_STEPS = 100


def source_targets(
    cells: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP
) -> DataFrame:
    """Per source its size, weight, target and number.

    Shares of all tokens by weight; what exceeds cap times a source's size is shared among
    the others by weight. With sources in order of size per weight, the level at which
    nothing exceeds any more is the first at which the source at hand is not filled.
    """
    sources = cells.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"),
        F.sum(F.when(F.col("size") > 0, F.col("n")).otherwise(0)).alias("filled"),
        F.min(F.when(F.col("size") > 0, F.col("size"))).alias("shortest"),
    )
    # One row per source from here on.
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    listed = sources.withColumn("s", F.row_number().over(by_name) - 1)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    listed = listed.withColumn(
        "weight", F.element_at(cycle, (F.col("s") % len(weights) + 1).cast("int"))
    ).withColumn("most", F.col("source_size") * F.lit(cap))
    by_fill = Window.orderBy(F.col("source_size") / F.col("weight"), "s")
    earlier = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    later = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything)
    level = (total - F.coalesce(F.sum("most").over(earlier), F.lit(0))) / F.sum("weight").over(later)
    leveled = listed.withColumn("level", level)
    fill = F.col("source_size") / F.col("weight")
    unfilled = F.col("most") >= F.col("weight") * F.col("level")
    open_level = F.min(F.when(unfilled, F.struct(fill, "s", "level"))).over(everything)["level"]
    target = F.least(F.col("most").cast("double"), F.col("weight") * F.col("open"))
    return (
        leveled.withColumn("open", open_level)
        .withColumn("target", F.coalesce(target, F.col("most").cast("double")))
        .select("s", "source", "source_size", "filled", "shortest", "weight", "target")
    )


def solve(
    cells: DataFrame,
    targets: DataFrame,
    cap: int = CAP,
    tolerance: float = TOLERANCE,
    max_steps: int = MAX_STEPS,
) -> DataFrame:
    """Per source s the lambda that meets its target, with the mean size it refers to.

    Newton on the logarithm of the tokens, which is nearly straight in lambda; a step that
    leaves the bracket of the solution is replaced by its middle. Sums are decimals, which
    do not depend on the order in which they are added up. Warns if a source is still off
    by more than the tolerance after the last step.
    """
    live = targets.where("source_size > 0 AND target > 0")
    unit = F.col("source_size") / F.col("filled")
    ratio = F.log(F.col("target") / F.col("source_size"))
    least = F.col("shortest") / unit
    low, high = F.least(ratio, F.lit(0.0)) / least, F.when(ratio > 0, F.log(F.lit(float(cap))) / least).otherwise(0.0)
    state = stored(
        live.select(
            "s",
            F.col("target"),
            unit.alias("unit"),
            low.alias("low"),
            high.alias("high"),
            F.least(F.greatest(ratio, low), high).alias("lam"),
            F.lit(1.0).alias("gap"),
        ),
        "lambda",
    )
    def added(value: Column) -> Column:
        return F.sum(value.cast("decimal(38,8)")).cast("double")

    worst = None
    x = F.col("size") / F.col("unit")
    tilt = F.exp(F.col("lam") * x)
    for _ in range(max_steps):
        tokens = F.col("size") * F.col("n")
        sums = (
            cells.join(state.select("s", "lam", "unit"), "s")
            .groupBy("s")
            .agg(
                F.greatest(added(tokens * F.least(tilt, F.lit(float(cap)))), F.lit(1e-8)).alias("f"),
                added(F.when(tilt < cap, tokens * x * tilt).otherwise(0.0)).alias("slope"),
            )
        )
        gap = F.log(F.col("f") / F.col("target"))
        moved = (
            state.drop("gap")
            .join(sums, "s")
            .withColumn("gap", gap)
            .withColumn("low", F.when(F.col("gap") < 0, F.col("lam")).otherwise(F.col("low")))
            .withColumn("high", F.when(F.col("gap") > 0, F.col("lam")).otherwise(F.col("high")))
        )
        newton = F.col("lam") - F.col("gap") * F.col("f") / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > F.col("low")) & (newton < F.col("high"))
        step = F.when(inside, newton).otherwise((F.col("low") + F.col("high")) / 2)
        state = stored(
            moved.withColumn(
                "lam", F.when(F.abs("gap") > tolerance, step).otherwise(F.col("lam"))
            ).select("s", "target", "unit", "low", "high", "lam", "gap"),
            "lambda",
        )
        worst = state.agg(F.max(F.abs("gap"))).first()[0]
        if worst is None or worst <= tolerance:
            break
    else:
        warnings.warn(f"a source is off its target by {worst:.1e} in logarithm", stacklevel=2)
    return state.select("s", "lam", "unit")


def _round(cells: DataFrame, targets: DataFrame, cap: int) -> DataFrame:
    """Whole copies K of each source and size, from the rates: s, size, n, K.

    Running sums are rounded from the longest size down; then up to eight sizes per power
    of two take copies more or fewer, longest first, until the source's rest is shorter.
    """
    down = Window.partitionBy("s").orderBy(F.col("size").desc())
    run = F.sum(F.col("n") * F.col("rate")).over(down)
    upto = F.floor(run + 0.5)
    before = F.coalesce(F.lag("upto").over(down), F.lit(0))
    rounded = (
        cells.withColumn("upto", upto)
        .withColumn("K", F.least(F.greatest(F.col("upto") - before, F.lit(0)), F.col("n") * cap))
        .drop("upto")
    )
    rounded = stored(rounded, "rounded")
    left = (
        rounded.groupBy("s")
        .agg(F.sum(F.col("size") * F.col("K")).alias("taken"))
        .join(targets.select("s", "target"), "s")
        .select("s", (F.col("target") - F.col("taken")).alias("left"))
    )
    room = F.when(F.col("left") > 0, F.col("n") * cap - F.col("K")).otherwise(F.col("K"))
    picks = (
        rounded.where("size > 0")
        .join(left, "s")
        .withColumn("room", room)
        .where("room > 0")
        .groupBy("s", "left", F.floor(F.log2("size")).alias("octave"), (F.col("size") % 8).alias("of8"))
        .agg(F.max_by(F.struct("size", "room"), F.struct("room", "size")).alias("pick"))
        .groupBy("s", "left")
        .agg(F.sort_array(F.collect_list("pick"), asc=False).alias("picks"))  # at most 512
    )
    move = "struct<size:long,change:long>"
    start = F.struct(
        F.col("left").alias("left"), F.array().cast(f"array<{move}>").alias("moves")
    )

    def place(held, pick):
        copies = F.least(F.floor(F.abs(held["left"]) / pick["size"]), pick["room"])
        change = F.when(held["left"] > 0, copies).otherwise(-copies).cast("long")
        moved = F.struct(pick["size"].cast("long").alias("size"), change.alias("change"))
        return F.struct(
            (held["left"] - change * pick["size"]).alias("left"),
            F.concat(held["moves"], F.array(moved)).alias("moves"),
        )

    moves = picks.select("s", F.explode(F.aggregate("picks", start, place)["moves"]).alias("m"))
    changes = moves.select("s", F.col("m.size").alias("size"), F.col("m.change").alias("change"))
    return rounded.join(changes, ["s", "size"], "left").withColumn(
        "K", F.col("K") + F.coalesce("change", F.lit(0))
    )


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    cap: int = CAP,
) -> DataFrame:
    """Per row: doc_id, row key, size, source_size, target, rate, copies, taken."""
    named = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    sizes = stored(with_row_key(named), "sizes")
    histogram = stored(sizes.groupBy("source", "size").agg(F.count("*").alias("n")), "histogram")
    targets = stored(source_targets(histogram, weights, cap), "targets")
    same = histogram["source"].eqNullSafe(targets["source"])
    cells = stored(
        histogram.join(targets, same).select("s", histogram["source"], "size", "n"), "cells"
    )
    solved = solve(cells, targets, cap)
    rate = F.least(F.exp(F.col("lam") * F.col("size") / F.col("unit")), F.lit(float(cap)))
    rated = cells.join(solved, "s", "left").withColumn(
        "rate", F.when(F.col("size") > 0, F.coalesce(rate, F.lit(1.0))).otherwise(1.0)
    )
    plan = _round(rated.select("s", "size", "n", "rate"), targets, cap)
    # Rows of one source and size in the order of their ids' hashes, whatever their number.
    keyed = sizes.withColumn("deal", F.xxhash64("doc_id"))
    order = ["source", "size", "deal", "doc_id", FILE, ROW]
    placed, _ = numbered(keyed, order, "dealt")
    firsts = placed.groupBy("source", "size").agg(F.min("index").alias("first"))
    per_source = targets.select("s", "source", "source_size", "target")
    first_of = firsts.join(
        per_source, firsts["source"].eqNullSafe(per_source["source"])
    ).select("s", firsts["source"], "size", "first", "source_size", "target")
    chosen = first_of.join(plan.select("s", "size", "n", "K", "rate"), ["s", "size"])
    # A null source meets itself by its stand-in; hot sizes are skewed keys that Spark splits.
    stand_in = F.when(F.col("source").isNull(), F.lit(1)).otherwise(0)
    left = placed.withColumn("none", stand_in).withColumn("source", F.coalesce("source", F.lit("")))
    right = chosen.drop("s").withColumn("none", stand_in).withColumn("source", F.coalesce("source", F.lit("")))
    rank = F.col("index") - F.col("first")
    copies = F.floor(F.col("K") / F.col("n")) + F.when(rank < F.col("K") % F.col("n"), 1).otherwise(0)
    return (
        left.join(right, ["none", "source", "size"])
        .withColumn("copies", copies.cast("long"))
        .select(
            "doc_id",
            FILE,
            ROW,
            "size",
            "source_size",
            "target",
            "rate",
            "copies",
            (F.col("copies") * F.col("size")).alias("taken"),
        )
    )

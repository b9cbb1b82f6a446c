"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import as_row, from_row
from .store import cut

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Token target of each source: its weight's part of `share` times all sizes, never above `cap` times its own size.

    Filling to the caps has a closed form. With level x, a source gets least(cap * size, x * weight), and the level
    at which source i reaches its cap is cap * size / weight. In that order the caps of all sources before i and the
    weights from i on give the level if exactly those before i are capped; the first such level not above its own
    source's is the answer. One row per source is all that the ordered windows see.

    Sources weigh 5, 2, 1, repeating, by code point, null last. Sources without words get 0.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    ranked = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
        .withColumn("_cap", cap * F.col("source_size"))
        .withColumn("_at", F.col("_cap") / F.col("_w"))
    )
    up = Window.orderBy("_at", F.col("source").isNull(), "source")
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = (
        ranked.withColumn("_all", share * F.sum("source_size").over(everything))
        .withColumn("_level", (F.col("_all") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(up.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("_x", F.min(F.when(F.col("_level") <= F.col("_at"), F.struct("_at", F.col("source").isNull().alias("n"), "source", "_level"))).over(everything)["_level"])
    )
    level = F.coalesce(F.col("_x"), F.lit(float("inf")))
    return levels.select("source", "source_size", F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(F.least(F.col("_cap"), level * F.col("_w"))).alias("target"))


#: Plans of at most so many sources are broadcast; beyond that Spark sorts both sides of their joins.
MOST_SOURCES = 100_000


def _few(plan: DataFrame) -> bool:
    """Whether a plan, one row per source, is small enough to be broadcast: counted, not assumed."""
    return plan.limit(MOST_SOURCES + 1).count() <= MOST_SOURCES


def _side(plan: DataFrame, few: bool) -> DataFrame:
    return F.broadcast(plan) if few else plan.hint("merge")


def tilts(hist: DataFrame, targets: DataFrame, cap: float = 2.0, few: bool = True, rounds: int = 40, tolerance: float = 1e-7) -> DataFrame:
    """The multiplier of each source's token constraint.

    A document of x = size / mean size of its source is repeated at rate least(cap, exp(tilt * x)): of all rates
    within the cap that meet the source's token target, those nearest to 1 in relative entropy. The dual is convex
    with one multiplier per source, so its Hessian is diagonal and Newton's step is a sum per source and round. `hist` has
    the number of documents per (source, size), from which Spark sums both derivatives; a bracket per source keeps
    each step inside the interval that must hold the root. Sources at their cap need no tilt: all rates are the cap.
    """
    x = F.col("size") / F.col("_mean")
    state = cut(
        targets.join(hist.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("_mean")).withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
        .filter((F.col("target") > 0) & (F.col("target") < cap * F.col("source_size") * (1 - 1e-12)))
        .select("source", "target", "_mean", F.lit(0.0).alias("tilt"), F.lit(-1e3).alias("_lo"), F.lit(1e3).alias("_hi"), F.lit(False).alias("_done"))
    )
    for _ in range(rounds):
        raw = F.exp(F.least(F.col("tilt") * x, F.lit(700.0)))
        rate = F.least(F.lit(cap), raw)
        moments = (
            hist.withColumnRenamed("source", "_s")
            .join(_side(state, few), F.col("_s").eqNullSafe(F.col("source")))
            .groupBy("source", "target", "_mean", "tilt", "_lo", "_hi")
            .agg(F.sum(F.col("n") * F.col("size") * rate).alias("_sum"), F.sum(F.when(raw < cap, F.col("n") * F.col("size") * x * raw).otherwise(0.0)).alias("_slope"))
        )
        over = F.col("_sum") > F.col("target")
        lo, hi = F.when(over, F.col("_lo")).otherwise(F.col("tilt")), F.when(over, F.col("tilt")).otherwise(F.col("_hi"))
        step = F.col("tilt") - (F.col("_sum") - F.col("target")) / F.when(F.col("_slope") > 0, F.col("_slope"))
        done = F.abs(F.col("_sum") - F.col("target")) <= tolerance * F.col("target")
        state = cut(
            moments.withColumns({"_lo": lo, "_hi": hi, "_step": step, "_done": done}).select(
                "source", "target", "_mean",
                F.when(F.col("_done"), F.col("tilt")).when((F.col("_step") > F.col("_lo")) & (F.col("_step") < F.col("_hi")), F.col("_step")).otherwise((F.col("_lo") + F.col("_hi")) / 2).alias("tilt"),
                "_lo", "_hi", "_done",
            )
        )
        if state.filter(~F.col("_done")).isEmpty():
            break
    return state.select("source", "_mean", "tilt")


FINE = 1 << 24


def _crossing(need: DataFrame, docs: DataFrame, bin_of: Column, few: bool) -> DataFrame:
    """Which bin of each source takes the running words over what it needs; what is left for that bin."""
    bins = docs.withColumn("_bin", bin_of).groupBy("source", "_bin").agg(F.sum("size").alias("_words"))
    run = Window.partitionBy("source").orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    return (
        bins.withColumn("_upto", F.sum("_words").over(run))
        .withColumnRenamed("source", "_s")
        .join(_side(need, few), F.col("_s").eqNullSafe(F.col("source")))
        .filter((F.col("_upto") > F.col("_need")) & (F.col("_upto") - F.col("_words") <= F.col("_need")))
        .select("source", F.col("_bin").alias("_cross"), (F.col("_need") - (F.col("_upto") - F.col("_words"))).alias("_need"))
    )


def _per_source(rows: DataFrame, plan: DataFrame, few: bool) -> DataFrame:
    """Rows with the columns of their source's row of `plan`, one row per source; `few` tells whether these were counted as few."""
    return rows.join(_side(plan.withColumnRenamed("source", "_s"), few), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")


def _rated(rows: DataFrame, cap: int) -> DataFrame:
    """rate, its whole part, and the document's place in the order in which documents get one copy more."""
    tilted = F.least(F.lit(float(cap)), F.exp(F.least(F.col("_tilt") * F.col("size") / F.col("_mean"), F.lit(700.0))))
    capped = F.when(F.col("target") > 0, F.lit(float(cap))).otherwise(F.lit(0.0))
    unit = F.pmod(F.xxhash64(F.col("_id"), F.lit("mix")), F.lit(1 << 40)) / float(1 << 40)
    return (
        rows.withColumn("rate", F.when(F.col("size") == 0, F.lit(0.0)).when(F.col("_tilt").isNull(), capped).otherwise(tilted))
        .withColumn("_floor", F.floor(F.col("rate") + 1e-9))
        .withColumn("_key", (unit - (F.col("rate") - F.col("_floor")) + 1) / 2)
        .withColumn("_fine", F.least(F.floor(F.col("_key") * FINE), F.lit(FINE - 1)))
        .withColumn("_open", (F.col("_floor") < cap) & (F.col("size") > 0))
    )


def _copies(rated: DataFrame) -> DataFrame:
    more = F.col("_open") & ((F.col("_fine") < F.coalesce("_edge", F.lit(FINE))) | F.coalesce(F.col("_key") <= F.col("_last"), F.lit(False)))
    return rated.withColumn("copies", (F.col("_floor") + more.cast("int")).cast("long"))


def mix_plan(rows: DataFrame, weights: tuple = WEIGHTS, share: float = 1.5, cap: int = 2) -> DataFrame:
    """What decides the copies of every document of a source, one row per source, for rows (_id, source, size).

    Rates from `tilts` are rounded down to whole copies; the words that a source then still lacks go to documents in
    the order of (hash of id - fraction), each at most one more copy, up to the last that fits; then the one document
    whose size is nearest to the rest takes one copy more if that brings the source nearer. The place in that order
    at which a source is full is found by two histograms of 4,096 bins, so no task orders a whole source: only the
    documents of one bin of one bin are ordered.
    """
    hist = cut(rows.groupBy("source", "size").agg(F.count("*").alias("n")))
    targets = cut(source_targets(hist.select("source", (F.col("size") * F.col("n")).alias("size")), weights, share, cap))
    few = _few(targets)
    tilt = tilts(hist.filter("size > 0"), targets, cap, few).withColumnRenamed("tilt", "_tilt")
    plan = cut(_per_source(targets, tilt, few))
    rated = _rated(_per_source(rows, plan, few), cap)
    need = cut(rated.groupBy("source").agg((F.max("target") - F.sum(F.col("_floor") * F.col("size"))).alias("_need")))
    open_ = rated.filter("_open").select("_id", "source", "size", "_key", "_fine")
    one = cut(_crossing(need, open_, F.floor(F.col("_fine") / 4096), few))
    in_one = _per_source(open_, one, few).filter(F.floor(F.col("_fine") / 4096) == F.col("_cross"))
    two = cut(_crossing(one.select("source", "_need"), in_one, F.col("_fine"), few))
    order = Window.partitionBy("source").orderBy("_key", "_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    in_two = _per_source(open_, two, few).filter(F.col("_fine") == F.col("_cross")).withColumn("_fits", F.sum("size").over(order) <= F.col("_need"))
    last = in_two.filter("_fits").groupBy("source").agg(F.max("_key").alias("_last"))
    plan = cut(_per_source(_per_source(plan, two.select("source", F.col("_cross").alias("_edge")), few), last, few))
    first = _copies(_rated(_per_source(rows, plan, few), cap))
    rest = cut(first.groupBy("source").agg((F.max("target") - F.sum(F.col("copies") * F.col("size"))).alias("_rest")))
    gap = F.abs(F.col("_rest") - F.col("size"))
    pick = _per_source(first.filter((F.col("copies") < cap) & (F.col("size") > 0)), rest, few).filter(gap < F.abs(F.col("_rest"))).groupBy("source").agg(F.min(F.struct(gap.alias("d"), "_id", "size")).alias("_p"))
    return cut(_per_source(plan, pick.select("source", F.col("_p._id").alias("_pick_id"), F.col("_p.size").alias("_pick_size")), few))


def apply_plan(rows: DataFrame, plan: DataFrame, cap: int = 2) -> DataFrame:
    """source_size, target, rate, copies and taken for rows (_id, source, size, ...): the same at each run."""
    few = _few(plan)
    picked = F.col("_id").eqNullSafe(F.col("_pick_id")) & F.col("_pick_size").isNotNull() & (F.col("size") == F.col("_pick_size")) & (F.col("copies") < cap)
    mixed = _copies(_rated(_per_source(rows, plan, few), cap)).withColumn("copies", F.col("copies") + picked.cast("long"))
    return mixed.withColumn("taken", F.col("copies") * F.col("size")).drop("_mean", "_tilt", "_edge", "_last", "_pick_id", "_pick_size", "_floor", "_key", "_fine", "_open")


def sizes(docs: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id") -> list[Column]:
    return [F.col(f"`{id_col}`").cast("string").alias("_id"), F.col(f"`{source}`").cast("string").alias("source"), F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long").alias("size")]


def told_apart(rows: DataFrame) -> DataFrame:
    """Rows (_id, source, size, ...) in which those that share all three are told apart by a number, so that a mix may take some of them more often than others. Without any, the rows as they are."""
    key = ["_id", "source", "size"]
    again = rows.groupBy(*key).agg(F.count("*").alias("_n")).filter("_n > 1").select(*[F.col(c).alias(f"_{c}_again") for c in key])
    if again.isEmpty():
        return rows
    on = [F.col(c).eqNullSafe(F.col(f"_{c}_again")) for c in key]
    numbered = F.concat_ws("#", "_id", F.monotonically_increasing_id().cast("string"))
    joined = rows.join(again.withColumn("_again", F.lit(True)), on, "left").withColumn("_id", F.when(F.col("_again"), numbered).otherwise(F.col("_id")))
    return cut(joined.drop("_again", *[f"_{c}_again" for c in key]))


NEW = ("size", "source_size", "target", "rate", "copies", "taken")


def mix_sources(docs: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id", weights: tuple = WEIGHTS, share: float = 1.5, cap: int = 2) -> DataFrame:
    """Every input row with size, source_size, target, rate, copies and taken appended.

    Defined cases: null text or a text without words has size 0 and takes 0; null sources are one source, the last;
    copies depend on (id, source, size), and rows that share all three on their number too, so that a source of one repeated document comes near its target as well; an empty table gives an empty
    result. Columns of the input that clash with appended names are replaced; any other name may occur.
    """
    wide = docs.select(*sizes(docs, text, source, id_col), as_row(docs, NEW))
    wide = told_apart(wide)
    plan = mix_plan(cut(wide.select("_id", "source", "size")), weights, share, cap)
    return apply_plan(wide, plan, cap).select(*from_row(docs, NEW), *NEW)


def op10_source_mix(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = told_apart(cut(docs.select(*sizes(docs), "doc_id")))
    return apply_plan(rows, mix_plan(rows.drop("doc_id"))).select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")

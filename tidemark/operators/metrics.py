"""Ranking and calibration metrics over a score order, per group.

Scores are first summed up by distinct value; ordered running sums see one row per range of scores of a group, then one per distinct score of a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def by_score(df: DataFrame, score: str, *groups: str) -> DataFrame:
    """Positives, negatives and positive value at each distinct score, with running totals from the top and each group's totals."""
    cells = df.groupBy(*groups, F.col(score).alias("s")).agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"), F.sum(F.when(F.col("label") == 1, F.col("amount")).otherwise(0)).alias("val"))
    return running(cells, *groups)


#: Ranges of a group's scores.
RANGES = 4096


def running(cells: DataFrame, *groups: str) -> DataFrame:
    """Rows (groups, s, pos, neg, val, ...), one a distinct score, with running totals tp, fp, tv from the top and the group's totals P, N, V.

    In two levels: totals of RANGES ranges of a group's scores are added up from the top, then scores within their range. So no task sees all scores of a group.
    """
    g, sums = list(groups), {"pos": ("tp", "P"), "neg": ("fp", "N"), "val": ("tv", "V")}
    per = cells.groupBy(*g).agg(F.min("s").alias("_lo"), F.max("s").alias("_hi"), *[F.sum(c).alias(n) for c, (_, n) in sums.items()])
    with_per = (lambda df: df.join(per, g)) if g else (lambda df: df.crossJoin(F.broadcast(per)))
    place = F.coalesce(F.floor((F.col("s") - F.col("_lo")) / F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0.0)) * RANGES), F.lit(0)).cast("long")
    placed = with_per(cells).withColumn("_range", place)
    down = Window.partitionBy(*g).orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy(*g, "_range").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, 0)
    totals = placed.groupBy(*g, "_range").agg(*[F.sum(c).alias(c) for c in sums]).select(*g, "_range", *[F.coalesce(F.sum(c).over(down), F.lit(0)).alias(f"_{c}") for c in sums])
    inner = placed.withColumns({n: F.sum(c).over(within) for c, (n, _) in sums.items()})
    return inner.join(totals, [*g, "_range"]).withColumns({n: F.col(n) + F.col(f"_{c}") for c, (n, _) in sums.items()}).drop("_range", "_lo", "_hi", *[f"_{c}" for c in sums])


def average_precision() -> Column:
    """Over by_score: the sum of recall gained times precision there. Null without positives."""
    return F.sum(F.col("pos") / F.nullif(F.col("P"), F.lit(0)) * F.col("tp") / (F.col("tp") + F.col("fp")))


def roc_auc() -> Column:
    """Over by_score: the chance that a positive outranks a negative, ties half."""
    return F.sum(F.col("pos") * (F.col("N") - F.col("fp") + F.col("neg") / 2)) / F.nullif(F.max("P") * F.max("N"), F.lit(0))


def recall_at(cells: DataFrame, levels: tuple[float, ...], *groups: str) -> DataFrame:
    """Recall, value recall and alert rate at the lowest score whose false-positive rate is at most each level; ties aren't split."""
    g = list(groups)
    at = cells.withColumn("level", F.explode(F.array(*[F.lit(x) for x in levels])))
    last = at.filter(F.col("fp") / F.col("N") <= F.col("level")).groupBy(*g, "level").agg(F.min_by(F.struct("s", "tp", "fp", "tv", "P", "N", "V"), "s").alias("r"))
    every = at.select(*g, "level").distinct()
    r = lambda x: F.coalesce(x, F.lit(0.0))
    return every.join(last, [*g, "level"], "left").select(
        *g, "level", F.col("r.s").alias("threshold"), r(F.round(F.col("r.fp") / F.col("r.N"), 6)).alias("fpr"), r(F.round(F.col("r.tp") / F.col("r.P"), 6)).alias("recall"),
        r(F.round((F.col("r.tv") / F.col("r.V")).cast("double"), 6)).alias("value_recall"), r(F.round((F.col("r.tp") + F.col("r.fp")) / (F.col("r.P") + F.col("r.N")), 6)).alias("alert_rate"),
    )


def calibration_bins(df: DataFrame, p: str, bins: int = 10, *groups: str) -> DataFrame:
    """Equal-count bins of each group by (p, t, id), larger ones first: bin, rows, mean prediction, observed rate.

    A row's place is its rank within its range of p plus the rows of the ranges below, so no task orders all rows.
    """
    g, cell = list(groups), F.floor(F.col(p) * 4096)
    within = Window.partitionBy(*g, "_c").orderBy(p, "t", "id")
    counts = df.groupBy(*g, cell.alias("_c")).agg(F.count("*").alias("n"))
    before = Window.partitionBy(*g).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    below = counts.select(*g, "_c", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_below"), F.sum("n").over(Window.partitionBy(*g)).alias("_all"))
    placed = df.withColumn("_c", cell).join(F.broadcast(below), [*g, "_c"]).withColumn("_at", F.row_number().over(within) + F.col("_below") - 1)
    size, more = F.floor(F.col("_all") / bins), F.col("_all") % bins
    big = (size + 1) * more
    bin_ = F.when(F.col("_at") < big, F.floor(F.col("_at") / (size + 1))).otherwise(more + F.floor((F.col("_at") - big) / F.greatest(size, F.lit(1))))
    return placed.groupBy(*g, bin_.cast("long").alias("bin")).agg(F.count("*").alias("rows"), F.avg(p).alias("predicted"), F.avg("label").alias("observed"))


def calibration_error() -> Column:
    """Over calibration_bins: the mean gap of prediction and rate, by rows."""
    return F.sum(F.col("rows") * F.abs(F.col("predicted") - F.col("observed"))) / F.sum("rows")


#: Bits of a double that are its range, in the first round; each further one takes as many more.
STEP_BITS = 12
#: Distinct values of a range that one task may order.
FITS = 1_000_000


def _ordered(v: Column) -> Column:
    """A double as a long in the same order, by its own bits: sign, then size. So ranges of any distribution are cut where its values are."""
    zero = F.lit(0.0)
    size = F.when(v == 0, F.lit(0)).otherwise(F.floor(F.log2(F.abs(v)) * (1 << 40)).cast("long") + F.lit(1 << 51))
    return F.when(v < zero, -size).otherwise(size)


def exact_quantiles(df: DataFrame, value: str, probs: tuple[float, ...], *groups: str) -> DataFrame:
    """(groups, q): exact quantiles of each group, in the order of `probs`, between neighbouring ranks as numpy's; nulls are left out, and groups without any value too.

    Values are counted by distinct value, distinct values by range of their place on a scale of logarithms. Running totals of ranges tell which of them hold a wanted rank; those ranges alone are cut again,
    until each fits a task (FITS distinct values), and only their values are ordered. So no task sees all values of a group, however many there are.
    """
    g = list(groups)
    cells = df.filter(F.col(value).isNotNull()).groupBy(*g, F.col(value).cast("double").alias("v")).agg(F.count("*").alias("n")).withColumn("_o", _ordered(F.col("v")))
    per = cells.groupBy(*g).agg(F.sum("n").alias("_n"))
    at = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), (F.lit(float(p)) * (F.col("_n") - 1)).alias("at")) for k, p in enumerate(probs)]))
    wanted = per.select(*g, at.alias("x")).select(*g, "x.k", "x.at")
    ranks = wanted.select(*g, "k", F.explode(F.array(F.struct(F.floor("at").alias("rank"), (1 - (F.col("at") - F.floor("at"))).alias("w")), F.struct((F.floor("at") + 1).alias("rank"), (F.col("at") - F.floor("at")).alias("w")))).alias("x")).select(*g, "k", "x.rank", "x.w").filter("w > 0")
    join = (lambda a, b, *more: a.join(b, [*g, *more])) if g else (lambda a, b, *more: a.join(b, list(more)) if more else a.crossJoin(b))
    held, key, shift = cells.withColumn("_below", F.lit(0).cast("long")), [], 0
    while True:
        shift += STEP_BITS
        name = f"_r{shift}"
        held = held.withColumn(name, F.shiftright("_o", max(0, 52 - shift)))
        key = [*key, name]
        totals = held.groupBy(*g, *key, "_below").agg(F.sum("n").alias("_t"), F.count("*").alias("_d"))
        upto = Window.partitionBy(*g, *key[:-1]).orderBy(name).rowsBetween(Window.unboundedPreceding, -1)
        ranges = totals.withColumn("_first", F.col("_below") + F.coalesce(F.sum("_t").over(upto), F.lit(0)))
        in_range = (F.col("rank") >= F.col("_first")) & (F.col("rank") < F.col("_first") + F.col("_t"))
        chosen = join(ranges, ranks.select(*g, "rank").distinct()).filter(in_range).select(*g, *key, "_first", "_d").distinct()
        if 52 - shift <= 0 or not chosen.filter(F.col("_d") > FITS).limit(1).count():
            break
        held = join(held.drop("_below"), chosen.select(*g, *key, F.col("_first").alias("_below")), *key)
    line = Window.partitionBy(*g, *key).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    values = join(held.drop("_below"), chosen.drop("_d"), *key).withColumn("_upto", F.col("_first") + F.sum("n").over(line))
    found = join(values.select(*g, "v", "n", "_upto"), ranks).filter((F.col("rank") < F.col("_upto")) & (F.col("rank") >= F.col("_upto") - F.col("n")))
    each = found.groupBy(*g, "k").agg(F.sum(F.col("v") * F.col("w")).alias("v"))
    return each.groupBy(*g).agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "v"))), lambda x: x["v"]).alias("q"))  # as many as `probs`


def deciles(reference: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """(e): the distinct edges of the reference's equal-count bins, one row."""
    return exact_quantiles(reference, column, tuple(k / bins for k in range(bins + 1))).select(F.array_sort(F.array_distinct("q")).alias("e"))


def bin_counts(df: DataFrame, edges: DataFrame, column: str, name: str, *groups: str) -> DataFrame:
    """Rows of each bin `b` between the inner edges, by group."""
    inner = F.expr("slice(e, 2, greatest(size(e) - 2, 0))")
    return df.crossJoin(F.broadcast(edges)).groupBy(*groups, F.size(F.filter(inner, lambda x: x <= F.col(column))).alias("b")).agg(F.count("*").alias(name))


def every_bin(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.sequence(F.lit(0), F.greatest(F.size("e") - 2, F.lit(0)))).alias("b"))


def stability(both: DataFrame, *groups: str) -> DataFrame:
    """psi of each group, from a row a bin with counts r and c; empty bins count 1e-4."""
    all_ = Window.partitionBy(*groups)
    share = lambda n: F.greatest(F.coalesce(F.col(n), F.lit(0)) / F.greatest(F.sum(n).over(all_), F.lit(1)), F.lit(1e-4))
    return both.withColumns({"rs": share("r"), "cs": share("c")}).groupBy(*groups).agg(F.sum((F.col("cs") - F.col("rs")) * F.log(F.col("cs") / F.col("rs"))).alias("psi"))


def psi(reference: DataFrame, current: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """(psi): population stability on the reference's deciles; equal edges are one, empty bins count 1e-4."""
    edges = deciles(reference, column, bins)
    return stability(every_bin(edges).join(bin_counts(reference, edges, column, "r"), "b", "left").join(bin_counts(current, edges, column, "c"), "b", "left"))


def _sides(value: str) -> list[Column]:
    return [F.count(F.when(~F.col("current"), F.col(value))).alias("r"), F.count(F.when(F.col("current"), F.col(value))).alias("c")]


def number_distance(values: DataFrame, spread: DataFrame, *groups: str) -> DataFrame:
    """(groups, field, distance) of rows (groups, field, v, r, c), one a distinct value with its number of reference and current rows: the first Wasserstein distance over the field's `sd`.

    Running totals see one row for each of 4,096 ranges of a field, then one for each distinct value within its range, so no task orders a whole field.
    """
    g = [*groups, "field"]
    per = values.groupBy(*g).agg(F.sum("r").alias("r_all"), F.sum("c").alias("c_all"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    cell = F.coalesce(F.floor((F.col("v") - F.col("lo")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0)) * 4096), F.lit(0))
    placed = values.join(per, g).withColumn("cell", cell)
    along = Window.partitionBy(*g).orderBy("cell")
    before, within = along.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*g, "cell").orderBy("v")
    upto = within.rowsBetween(Window.unboundedPreceding, 0)
    cells = placed.groupBy(*g, "cell").agg(F.sum("r").alias("r"), F.sum("c").alias("c"), F.min("v").alias("first"))
    cells = cells.select(*g, "cell", *[F.coalesce(F.sum(x).over(before), F.lit(0)).alias(f"{x}_below") for x in ("r", "c")], F.lead("first").over(along).alias("next"))
    share = lambda x, n: F.coalesce((F.col(f"{x}_below") + F.sum(x).over(upto)) / F.nullif(F.col(n), F.lit(0)), F.lit(0.0))
    step = F.coalesce(F.lead("v").over(within), F.col("next")) - F.col("v")
    area = placed.join(cells, [*g, "cell"]).select(*g, (F.abs(share("r", "r_all") - share("c", "c_all")) * step).alias("a"))
    whole = area.groupBy(*g).agg(F.coalesce(F.sum("a"), F.lit(0.0)).alias("a"))
    return whole.join(F.broadcast(spread), "field").select(*g, (F.col("a") / F.nullif(F.col("sd"), F.lit(0.0))).alias("distance"))


def level_distance(levels: DataFrame, *groups: str) -> DataFrame:
    """(groups, field, distance) of rows (groups, field, level, r, c), one a level: the Jensen-Shannon distance of the shares of levels."""
    g = [*groups, "field"]
    per = levels.groupBy(*g).agg(F.sum("r").alias("r_all"), F.sum("c").alias("c_all"))
    share = lambda x, n: F.coalesce(F.col(x) / F.nullif(F.col(n), F.lit(0)), F.lit(0.0)).alias(x)
    shares = levels.join(per, g).select(*g, share("r", "r_all"), share("c", "c_all"))
    part = lambda x: F.when(F.col(x) > 0, F.col(x) * F.log(2 * F.col(x) / (F.col("r") + F.col("c")))).otherwise(0.0)
    return shares.groupBy(*g).agg(F.sqrt(F.greatest(F.sum((part("r") + part("c")) / 2), F.lit(0.0)) / F.log(F.lit(2.0))).alias("distance"))


def number_drift(long: DataFrame) -> DataFrame:
    """(field, distance) of rows (field, v, current): current from reference values. Nulls are left out."""
    some = long.filter("v IS NOT NULL")
    return number_distance(some.groupBy("field", "v").agg(*_sides("v")), some.groupBy("field").agg(F.stddev_pop(F.when(~F.col("current"), F.col("v"))).alias("sd")))


def level_drift(long: DataFrame) -> DataFrame:
    """(field, distance) of rows (field, level, current): current from reference levels. Nulls are left out."""
    return level_distance(long.filter("level IS NOT NULL").groupBy("field", "level").agg(*_sides("level")))


def input_drift(reference: DataFrame, current: DataFrame, numbers: tuple[str, ...], levels: tuple[str, ...], limit: float = 0.1, missing_limit: float = 0.2) -> DataFrame:
    """(field, distance, missing_shift, drifted, drifted_share): a field drifts at a distance of `limit` or a change of its missing share of `missing_limit`."""
    both = reference.select(*numbers, *levels, F.lit(False).alias("current")).unionByName(current.select(*numbers, *levels, F.lit(True).alias("current")))
    long = lambda names, n, kind: both.select("current", F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast(kind).alias(n)) for c in names])).alias("x")).select("current", "x.*")
    distance = number_drift(long(numbers, "v", "double")).unionByName(level_drift(long(levels, "level", "string")))
    gone = lambda on: F.avg(F.when(F.col("current") == on, F.col("gone")))
    missing = both.select("current", F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).isNull().cast("int").alias("gone")) for c in (*numbers, *levels)])).alias("x")).select("current", "x.*")
    missing = missing.groupBy("field").agg(F.round(F.abs(gone(True) - gone(False)), 6).alias("missing_shift"))
    out = missing.join(F.broadcast(distance), "field", "left").select("field", F.round("distance", 6).alias("distance"), "missing_shift")
    out = out.withColumn("drifted", (F.coalesce("distance", F.lit(0.0)) >= limit) | (F.coalesce("missing_shift", F.lit(0.0)) >= missing_limit))
    return out.withColumn("drifted_share", F.round(F.avg(F.col("drifted").cast("int")).over(Window.partitionBy()), 6))

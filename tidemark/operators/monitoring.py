"""Monitoring of a decision log: each day's trailing week against a reference, cohorts by the labels that have come, and when to retrain.

Everything is counted per day once, and a day's counts are served to the days whose trailing week holds it. So no day reads the log again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import metrics

DAY = 86400


@dataclass(frozen=True)
class Limits:
    """From where a change counts; the defaults are fixed values, but for the length of a run and of the log."""

    window: int = 7  # days before a day
    drifted: float = 0.1
    missing: float = 0.2
    drifted_share: float = 0.3
    psi_warn: float = 0.1
    psi_alert: float = 0.2
    alert_rate: float = 0.5
    present: float = 0.05
    silent: float = 0.5
    pr_auc: float = 0.8
    caught: float = 0.1
    run: int = 3  # days of score alerts in a row


def served(counts: DataFrame, days: DataFrame, window: int) -> DataFrame:
    """Each day's rows, served to the days after it whose trailing window holds it."""
    later = F.explode(F.sequence(F.col("day") + 1, F.col("day") + window))
    return counts.select(later.alias("day"), *[c for c in counts.columns if c != "day"]).join(F.broadcast(days), "day", "left_semi")


def judged_days(log: DataFrame, window: int) -> DataFrame:
    """(day): every day with a whole window before it, up to the day after the last. One row a day."""
    return log.agg((F.min("day") + window).alias("a"), (F.max("day") + 1).alias("b")).filter("a <= b").select(F.explode(F.sequence("a", "b")).alias("day"))


def _long(df: DataFrame, fields: tuple[str, ...], value: str, kind: str, *keep: str) -> DataFrame:
    each = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast(kind).alias(value)) for c in fields])
    return df.select(*keep, F.explode(each).alias("x")).select(*keep, "x.*")


def daily_input_drift(log: DataFrame, reference: DataFrame, days: DataFrame, numbers: tuple[str, ...], levels: tuple[str, ...], limits: Limits = Limits()) -> DataFrame:
    """(day, field, distance, missing_shift, drifted): each day's trailing week against the reference, from counts of values per day and field.

    A field drifts at a distance of `drifted` (Wasserstein over the reference's deviation for numbers, Jensen-Shannon for levels) or a change of its missing share of `missing`.
    """
    key = ["day", "field"]

    def cells(fields: tuple[str, ...], value: str, kind: str) -> DataFrame:
        own = served(_long(log, fields, value, kind, "day").filter(F.col(value).isNotNull()).groupBy("day", "field", value).agg(F.count("*").alias("c")), days, limits.window)
        ref = _long(reference, fields, value, kind).filter(F.col(value).isNotNull()).groupBy("field", value).agg(F.count("*").alias("r"))
        both = own.select("day", "field", value, F.lit(0).cast("long").alias("r"), "c").unionByName(ref.crossJoin(F.broadcast(days)).select("day", "field", value, "r", F.lit(0).cast("long").alias("c")))
        return both.groupBy("day", "field", value).agg(F.sum("r").alias("r"), F.sum("c").alias("c"))

    spread = _long(reference, numbers, "v", "double").groupBy("field").agg(F.stddev_pop("v").alias("sd"))
    distance = metrics.number_distance(cells(numbers, "v", "double"), spread, "day").unionByName(metrics.level_distance(cells(levels, "level", "string"), "day"))
    gone = lambda df, *g: _long(df.withColumns({c: F.col(c).isNull() for c in (*numbers, *levels)}), (*numbers, *levels), "gone", "int", *g).groupBy(*g, "field").agg(F.sum("gone").alias("gone"), F.count("*").alias("n"))
    now = served(gone(log, "day"), days, limits.window).groupBy(*key).agg((F.sum("gone") / F.sum("n")).alias("now"))
    missing = now.join(F.broadcast(gone(reference).select("field", (F.col("gone") / F.col("n")).alias("then"))), "field").select(*key, F.round(F.abs(F.col("now") - F.col("then")), 6).alias("missing_shift"))
    out = missing.join(distance, key, "left").select(*key, F.round("distance", 6).alias("distance"), "missing_shift")
    return out.withColumn("drifted", (F.coalesce("distance", F.lit(0.0)) >= limits.drifted) | (F.coalesce("missing_shift", F.lit(0.0)) >= limits.missing))


def daily_feed_alerts(log: DataFrame, reference: DataFrame, days: DataFrame, fields: tuple[str, ...], limits: Limits = Limits()) -> DataFrame:
    """(day, feed_alerts): fields present in the reference that are silent on the day before, in order of name; days without any aren't there."""
    share = lambda df, *g: _long(df.withColumns({c: F.col(c).isNotNull() for c in fields}), fields, "there", "int", *g).groupBy(*g, "field").agg(F.avg("there").alias("share"))
    usual = share(reference).filter(F.col("share") >= limits.present).withColumnRenamed("share", "usual")
    last = share(log.withColumn("day", F.col("day") + 1), "day").join(F.broadcast(days), "day", "left_semi")
    quiet = last.join(F.broadcast(usual), "field").filter(F.col("share") < limits.silent * F.col("usual"))
    return quiet.groupBy("day").agg(F.array_join(F.array_sort(F.collect_list("field")), ",").alias("feed_alerts"))  # as many as fields


def timeline(log: DataFrame, reference: DataFrame, numbers: tuple[str, ...], levels: tuple[str, ...], limits: Limits = Limits()) -> DataFrame:
    """One row a day, over its trailing week: transactions, alert_rate and its relative change, score_psi and its status, drifted fields and their share, feed alerts of the day before.

    `log` and `reference` have day, p, action and the fields. They are read more than once: settle them first.
    """
    days = judged_days(log, limits.window)
    acted = (F.col("action") != "approve").cast("int")
    week = served(log.groupBy("day").agg(F.count("*").alias("n"), F.sum(acted).alias("k")), days, limits.window).groupBy("day").agg(F.sum("n").alias("transactions"), (F.sum("k") / F.sum("n")).alias("rate"))
    usual = reference.agg(F.avg(acted).alias("usual"))
    edges = metrics.deciles(reference, "p")
    bins = served(metrics.bin_counts(log, edges, "p", "c", "day"), days, limits.window).groupBy("day", "b").agg(F.sum("c").alias("c"))
    both = week.select("day").crossJoin(F.broadcast(metrics.every_bin(edges))).join(bins, ["day", "b"], "left").join(F.broadcast(metrics.bin_counts(reference, edges, "p", "r")), "b", "left")
    shift = metrics.stability(both, "day").select("day", F.round("psi", 6).alias("score_psi"))
    fields = daily_input_drift(log, reference, days, numbers, levels, limits)
    drift = fields.groupBy("day").agg(F.array_join(F.array_sort(F.collect_list(F.when(F.col("drifted"), F.col("field")))), ",").alias("drifted_fields"), F.round(F.avg(F.col("drifted").cast("int")), 6).alias("drifted_share"))
    status = F.when(F.col("score_psi") >= limits.psi_alert, "alert").when(F.col("score_psi") >= limits.psi_warn, "warn").otherwise("ok")
    out = week.crossJoin(F.broadcast(usual)).join(shift, "day").join(drift, "day").join(daily_feed_alerts(log, reference, days, (*numbers, *levels), limits), "day", "left")
    change = F.round(F.col("rate") / F.nullif(F.col("usual"), F.lit(0.0)) - 1, 6)
    return out.select(
        "day", "transactions", F.round("rate", 6).alias("alert_rate"), change.alias("alert_rate_change"), (F.abs(change) >= limits.alert_rate).alias("alert_rate_warn"), "score_psi", status.alias("score_status"),
        "drifted_fields", "drifted_share", (F.col("drifted_share") >= limits.drifted_share).alias("input_drift_warn"), F.coalesce("feed_alerts", F.lit("")).alias("feed_alerts"),
    )


def caught_value() -> list[Column]:
    """What was lost, and what of it the actions caught, of rows with a known label."""
    amount = F.col("amount").cast("double")
    saved = F.when(F.col("action") == "decline", amount).when(F.col("action") == "review", 0.9 * amount).otherwise(0.0)
    fraud = F.col("label") == 1
    return [F.sum(F.when(fraud, amount).otherwise(0.0)).alias("lost"), F.sum(F.when(fraud, saved).otherwise(0.0)).alias("caught")]


def performance(log: DataFrame) -> DataFrame:
    """(pr_auc, value_caught) of rows whose labels are all known: one row."""
    ranked = metrics.by_score(log, "p").agg(F.round(metrics.average_precision(), 6).alias("pr_auc"))
    return ranked.crossJoin(log.agg(*caught_value()).select(F.round(F.col("caught") / F.nullif(F.col("lost"), F.lit(0.0)), 6).alias("value_caught")))


def cohorts_by_day(log: DataFrame, delay: int, through: int, cohort_days: int = 7, first: int = 0) -> DataFrame:
    """(day, cohort, transactions, labelled, complete, fraud_rate, pr_auc, value_caught) of each cohort as seen at the start of each day from `first` to `through`.

    A label counts on a day if its transaction is more than `delay` seconds before the day's start. So a cohort has at most cohort_days + 1 states, one for each day on which labels come: counts by
    (cohort, day of coming, score) are served to that day's and all later states of the cohort, metrics are taken once a state, and a state stands until the next. No day joins the log.
    """
    key = ["cohort", "since"]
    cohort = F.floor(F.col("day") / cohort_days)
    comes = (F.floor((F.col("t") + delay) / DAY) + 1).alias("comes")
    rows = log.select(cohort.alias("cohort"), comes, "p", "label", "amount", "action")
    sizes = rows.groupBy("cohort").agg(F.count("*").alias("transactions"))
    states = rows.select("cohort", F.col("comes").alias("since")).distinct()
    counts = rows.groupBy("cohort", "comes", "p").agg(F.sum("label").alias("label"), F.count("*").alias("n"), *caught_value())
    seen = counts.join(F.broadcast(states.withColumnRenamed("cohort", "_c")), (F.col("cohort") == F.col("_c")) & (F.col("comes") <= F.col("since"))).drop("_c")
    cells = seen.groupBy(*key, "p").agg(F.sum("label").alias("pos"), F.sum(F.col("n") - F.col("label")).alias("neg"), F.sum("lost").alias("lost"), F.sum("caught").alias("caught"))
    ranked = metrics.running(cells.withColumnsRenamed({"p": "s", "lost": "val"}), *key)
    value = F.sum("val")
    some = F.max("P") > 0
    done = ranked.groupBy(*key).agg(
        F.sum(F.col("pos") + F.col("neg")).alias("labelled"), F.when(some, F.round(F.max("P") / F.sum(F.col("pos") + F.col("neg")), 6)).alias("fraud_rate"),
        F.round(metrics.average_precision(), 6).alias("pr_auc"), F.when(some, F.round(F.sum("caught") / F.nullif(value, F.lit(0.0)), 6)).alias("value_caught"),
    )
    until = F.coalesce(F.lead("since").over(Window.partitionBy("cohort").orderBy("since")) - 1, F.lit(through))
    known = done.withColumn("until", until).filter((F.col("since") <= F.col("until")) & (F.col("until") >= first))
    on = known.select("cohort", "labelled", "fraud_rate", "pr_auc", "value_caught", F.explode(F.sequence(F.greatest("since", F.lit(first)), "until")).alias("day"))
    every = sizes.select("cohort", "transactions", F.explode(F.sequence(F.lit(first), F.lit(through))).alias("day"))
    out = every.join(on, ["cohort", "day"], "left").withColumn("labelled", F.coalesce("labelled", F.lit(0)).cast("long"))
    return out.select("day", "cohort", "transactions", "labelled", (F.col("labelled") == F.col("transactions")).alias("complete"), "fraud_rate", "pr_auc", "value_caught")


def runs(flags: DataFrame, *groups: str) -> DataFrame:
    """(groups, day, first_day, run) of rows (groups, day), one a day: each day's place in its run of consecutive days."""
    island = flags.withColumn("_i", F.col("day") - F.row_number().over(Window.partitionBy(*groups).orderBy("day")))
    own = Window.partitionBy(*groups, "_i").orderBy("day")
    return island.withColumns({"first_day": F.min("day").over(own), "run": F.row_number().over(own)}).drop("_i")


def retraining(daily: DataFrame, cohorts: DataFrame, reference: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(retrain_day, reason, first_feed_day, first_feed_alerts), one row; nulls where there is none.

    A day calls for retraining if score alerts have lasted for `run` days and inputs drift, or if a complete cohort ranks below `pr_auc` of the reference's average precision or catches less of the value by
    `caught`. Of one day the first reason counts, of cohorts the earliest. A silent feed calls for mending the feed, so it is told apart.
    """
    scores = runs(daily.filter("score_status = 'alert'").select("day", "input_drift_warn", F.lit(0).alias("one")), "one").filter((F.col("run") >= limits.run) & F.col("input_drift_warn"))
    by_score = scores.select("day", F.lit(-1).cast("long").alias("rank"), F.lit("score drift with input drift").alias("reason"))
    bad = (F.col("pr_auc") < limits.pr_auc * F.col("_pr_auc")) | (F.col("value_caught") <= F.col("_value_caught") - limits.caught)
    base = reference.select(F.col("pr_auc").alias("_pr_auc"), F.col("value_caught").alias("_value_caught"))
    by_cohort = cohorts.filter("complete AND pr_auc IS NOT NULL").crossJoin(F.broadcast(base)).filter(bad).select("day", F.col("cohort").alias("rank"), F.concat(F.lit("performance alert on cohort "), F.col("cohort")).alias("reason"))
    called = by_score.unionByName(by_cohort).agg(F.min(F.struct("day", "rank", "reason")).alias("r")).select(F.col("r.day").alias("retrain_day"), F.col("r.reason").alias("reason"))
    feed = daily.filter("feed_alerts <> ''").agg(F.min(F.struct("day", "feed_alerts")).alias("f")).select(F.col("f.day").alias("first_feed_day"), F.col("f.feed_alerts").alias("first_feed_alerts"))
    return called.crossJoin(feed)

"""Scores, expected and realised costs, decision policies and their tuning."""

from __future__ import annotations

from dataclasses import dataclass
from types import SimpleNamespace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import history, metrics
from .history import FEATURES

ARRIVAL = ("t", "id")


@dataclass(frozen=True)
class Costs:
    """What actions cost; the defaults and their ranges are fixed values."""

    fee: float = 20.0
    review: float = 7.0
    catch: float = 0.9
    margin: float = 0.25
    fixed: float = 10.0
    delay: float = 2.0
    capacity: int = 10  # reviews a day; the log has some 300 rows a day at the smallest scale


RANGES = {"fee": (10.0, 40.0), "review": (4.0, 12.0), "catch": (0.8, 1.0), "margin": (0.1, 0.4), "fixed": (5.0, 20.0), "delay": (0.0, 5.0), "capacity": (5, 20)}

#: Limits of the rules; those of a grid may be columns instead.
LIMITS = {"amount": 150.0, "txn_1h": 1, "txn_24h": 4, "spend_24h": 300.0, "new_device_amount": 100.0}

#: The rules: name, points (fixed) and condition in SQL, with limits in braces. Missing history counts as none.
RULES = (
    ("large_amount", 2, "double(amount) >= {amount}"),
    ("burst_last_hour", 2, "coalesce(card_txn_1h, 0) >= {txn_1h}"),
    ("many_last_24h", 1, "coalesce(card_txn_24h, 0) >= {txn_24h}"),
    ("high_spend_24h", 1, "coalesce(card_amt_24h, 0) + double(amount) >= {spend_24h}"),
    ("new_device_and_large", 1, "coalesce(card_new_device, 0) = 1 AND double(amount) >= {new_device_amount}"),
)


def conditions(limits: dict = LIMITS) -> list[tuple[str, int, Column]]:
    """(name, points, condition) of each rule; limits are numbers or names of columns."""
    return [(name, worth, F.expr(text.format(**{k: f"{v!r}D" if isinstance(v, float) else v for k, v in limits.items()}))) for name, worth, text in RULES]


def points(limits: dict = LIMITS) -> Column:
    return sum((F.when(c, worth).otherwise(0) for _, worth, c in conditions(limits)), F.lit(0))


def rules_score(p: Column) -> Column:
    """Points, with the amount as the order within equal points."""
    return p + F.least(F.greatest(F.col("amount").cast("double"), F.lit(0.0)), F.lit(1e5)) / 1e5 * 0.99


def featured(txn: DataFrame) -> DataFrame:
    """Transactions with the four features that rules and the linear score take."""
    names = ("card_txn_1h", "card_txn_24h", "card_amt_24h", "card_new_device")
    return history.add_history(txn, tuple(f for f in FEATURES if f.name in names))


def scored(txn: DataFrame, limits: dict = LIMITS) -> DataFrame:
    """featured with points, rules_score and a probability p of a fixed linear form, which takes nothing but features."""
    z = -4.5 + 0.5 * F.log(1 + F.col("card_txn_24h")) + 0.012 * F.col("amount").cast("double") + 0.8 * F.coalesce("card_new_device", F.lit(0))
    return featured(txn).withColumn("points", points(limits)).withColumn("rules_score", rules_score(F.col("points"))).withColumn("p", F.round(1 / (1 + F.exp(-z)), 6))


def expected(p: Column, amount: Column, c: Costs) -> dict[str, Column]:
    """Expected cost of each action."""
    loss = amount + c.fee
    return {"approve": p * loss, "decline": (1 - p) * (c.margin * amount + c.fixed), "review": c.review + p * (1 - c.catch) * loss + (1 - p) * c.delay}


def priced(df: DataFrame, c: Costs = Costs()) -> DataFrame:
    """e_approve, e_decline, e_review, and what a review saves over the best action without one."""
    e = expected(F.col("p"), F.col("amount").cast("double"), c)
    return df.withColumns({f"e_{k}": v for k, v in e.items()}).withColumn("priority", F.least("e_approve", "e_decline") - F.col("e_review"))


def within_capacity(df: DataFrame, asks: dict[str, Column], capacity: Column | int, *groups: str, most: int | None = None) -> DataFrame:
    """df with a Boolean column for each of `asks`: true for the first `capacity` rows of each day, in order of arrival, that ask for it. Ids are unique.

    Only rows that ask are ranked, and no task sends on more than `most` of a day (the capacity; its upper bound where it is a column), so a day of any size ends in few
    rows. What comes back is one row a day: the last one that is taken.
    """
    by, arrival = [*groups, "day"], F.struct(*ARRIVAL)
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("ask"), F.coalesce(c, F.lit(False)).alias("on")) for k, c in asks.items()]))
    limit = F.lit(capacity) if isinstance(capacity, int) else capacity
    asking = df.select(*by, *ARRIVAL, limit.alias("_limit"), each.alias("_x")).filter("_x.on").select(*by, *ARRIVAL, "_limit", F.col("_x.ask").alias("_ask"))
    first = asking.withColumn("_rank", F.row_number().over(Window.partitionBy(*by, "_ask").orderBy(*ARRIVAL))).filter(F.col("_rank") <= (most or capacity)).filter("_rank <= _limit")
    last = first.groupBy(*by).agg(*[F.max(F.when(F.col("_ask") == k, arrival)).alias(f"_last_{i}") for i, k in enumerate(asks)])
    taken = {k: F.coalesce(c & (arrival <= F.col(f"_last_{i}")), F.lit(False)) for i, (k, c) in enumerate(asks.items())}
    return df.join(last, by, "left").withColumns(taken).drop(*[f"_last_{i}" for i in range(len(asks))])


def wants_review(threshold: float | Column) -> Column:
    return (F.col("priority") > threshold) & (F.col("priority") > 0)


def expected_loss(df: DataFrame, threshold: float | Column, c: Costs, *groups: str, most: int | None = None) -> DataFrame:
    """df with the action: decline only where strictly cheaper; review where that saves more than the threshold and the day has room."""
    seated = within_capacity(df, {"_review": wants_review(threshold)}, c.capacity, *groups, most=most)
    return seated.withColumn("action", F.when(F.col("_review"), "review").otherwise(without_review())).drop("_review")


def without_review() -> Column:
    return F.when(F.col("e_decline") < F.col("e_approve"), "decline").otherwise("approve")


def between(score: str, decline_at: float | Column, review_at: float | Column) -> Column:
    return (F.col(score) >= review_at) & (F.col(score) < decline_at)


def cutoffs(df: DataFrame, score: str, decline_at: float | Column, review_at: float | Column, c: Costs, *groups: str) -> DataFrame:
    """df with the action: decline from one score on, review from a lower one on while the day has room."""
    seated = within_capacity(df, {"_review": between(score, decline_at, review_at)}, c.capacity, *groups)
    return seated.withColumn("action", F.when(F.col(score) >= decline_at, "decline").when(F.col("_review"), "review").otherwise("approve")).drop("_review")


def decided(df: DataFrame, c: Costs = Costs()) -> DataFrame:
    """(policy, action) for four policies over priced rows."""
    asks = {"expected loss": wants_review(0.5), "rules": between("points", 6, 3), "cut-offs": between("p", 0.5, 0.1)}
    otherwise = {"expected loss": without_review(), "rules": F.when(F.col("points") >= 6, "decline").otherwise("approve"), "cut-offs": F.when(F.col("p") >= 0.5, "decline").otherwise("approve")}
    acts = [F.struct(F.lit(k).alias("policy"), F.when(F.col(k), "review").otherwise(o).alias("action")) for k, o in otherwise.items()]
    acts.append(F.struct(F.lit("approve all").alias("policy"), F.lit("approve").alias("action")))
    kept = ("id", "t", "day", "split", "amount", "label", "card", "device", "email", "p", "points")
    return within_capacity(df, asks, c.capacity).select(*kept, F.explode(F.array(*acts)).alias("a")).select(*kept, "a.policy", "a.action")


def realised(c: Costs = Costs()) -> list[Column]:
    """Aggregates of what actions cost on labelled rows (action, label, amount)."""
    amount, fraud, loss = F.col("amount").cast("double"), F.col("label") == 1, F.col("amount").cast("double") + c.fee
    is_ = lambda a: F.col("action") == a
    add = lambda cond, v: F.sum(F.when(cond, v).otherwise(0.0))
    count = lambda cond: F.count_if(cond)
    missed = add(fraud & is_("approve"), loss) + add(fraud & is_("review"), (1 - c.catch) * loss)
    friction = add(~fraud & is_("decline"), c.margin * amount + c.fixed)
    review, delay = add(is_("review"), c.review), add(is_("review") & ~fraud, c.delay)
    value = add(fraud, amount)
    caught = add(fraud & is_("decline"), amount) + add(fraud & is_("review"), c.catch * amount)
    return [
        F.round(missed + friction + review + delay, 4).alias("total_cost"), F.round(missed, 4).alias("missed_fraud_cost"), F.round(friction, 4).alias("declined_legit_cost"),
        F.round(review, 4).alias("review_cost"), F.round(delay, 4).alias("review_delay_cost"), F.round(value, 4).alias("fraud_value"), F.round(caught, 4).alias("fraud_value_caught"),
        count(is_("decline")).alias("declines"), count(is_("decline") & ~fraud).alias("declined_legit"), count(is_("review")).alias("reviews"),
        count(is_("review") & fraud).alias("reviewed_fraud"), count(is_("approve") & fraud).alias("approved_fraud"),
        F.round(caught / F.nullif(value, F.lit(0.0)), 6).alias("fraud_value_caught_share"),
    ]


def top_of_day(df: DataFrame, priority: Column, k: int) -> DataFrame:
    """With hindsight over each day: its k rows of highest priority, earlier ones first among equals. No task sends on more than k rows of a day."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy("day").orderBy(F.desc(priority), *ARRIVAL))).filter(F.col("_rank") <= k).drop("_rank")


def quantile_grid(df: DataFrame, value: str, n: int) -> DataFrame:
    """(g): the distinct ones of n evenly spaced exact quantiles. n rows, whatever the input."""
    q = metrics.exact_quantiles(df.select(value), value, tuple(k / (n - 1) for k in range(n)))
    return q.select(F.explode("q").alias("g")).select(F.round("g", 6).alias("g")).distinct()


def tune_expected_loss(df: DataFrame, c: Costs = Costs(), n: int = 60) -> DataFrame:
    """(threshold, total_cost, reviews) of each threshold of a grid: 0 and quantiles of the positive savings.

    Rows that no threshold could review cost the same in all trials, so they are summed once and only the others meet the grid.
    """
    grid = quantile_grid(df.filter("priority > 0"), "priority", n).unionByName(df.sparkSession.createDataFrame([(0.0,)], "g double")).distinct()
    rest = df.filter("priority <= 0").withColumn("action", without_review()).agg(*[x.alias(n) for n, x in (("base", realised(c)[0]),)])
    trials = expected_loss(df.filter("priority > 0").crossJoin(F.broadcast(grid)), F.col("g"), c, "g")
    cost = trials.groupBy("g").agg(realised(c)[0].alias("own"), F.count_if(F.col("action") == "review").alias("reviews"))
    return cost.crossJoin(F.broadcast(rest)).select(F.col("g").alias("threshold"), F.round(F.col("own") + F.coalesce("base", F.lit(0.0)), 4).alias("total_cost"), "reviews")


def tune_cutoffs(df: DataFrame, score: str, c: Costs = Costs(), n: int = 40) -> DataFrame:
    """(decline_at, review_at, total_cost) for pairs of cut-offs over quantiles of the top tenth of scores, and never."""
    low = metrics.exact_quantiles(df.select(score), score, (0.9,)).select(F.round(F.col("q")[0], 6).alias("low"))
    top = df.crossJoin(F.broadcast(low)).filter(F.col(score) >= F.col("low"))
    grid = quantile_grid(top, score, n).unionByName(df.sparkSession.createDataFrame([(1e9,)], "g double"))
    pairs = grid.select(F.col("g").alias("decline_at")).crossJoin(grid.select(F.col("g").alias("review_at"))).filter("review_at <= decline_at")
    rest = df.crossJoin(F.broadcast(low)).filter(F.col(score) < F.col("low")).withColumn("action", F.lit("approve")).agg(realised(c)[0].alias("base"))
    trials = cutoffs(top.crossJoin(F.broadcast(pairs)), score, F.col("decline_at"), F.col("review_at"), c, "decline_at", "review_at")
    cost = trials.groupBy("decline_at", "review_at").agg(realised(c)[0].alias("own"))
    return cost.crossJoin(F.broadcast(rest)).select("decline_at", "review_at", F.round(F.col("own") + F.coalesce("base", F.lit(0.0)), 4).alias("total_cost"))


def sensitivity(df: DataFrame, c: Costs = Costs(), n: int = 60) -> DataFrame:
    """(parameter, value, threshold, total_cost): each cost parameter at both ends, the threshold tuned anew on validation, its cost on test.

    df is scored rows. All variants are one plan: rows times a fixed grid of variants, and those that a threshold could review times the variant's thresholds.
    """
    names = list(RANGES)
    own = {k: getattr(c, k) for k in names}
    rows = [(name, float(end), *[float((own | {name: end})[k]) for k in names]) for name, ends in RANGES.items() for end in ends]
    variants = df.sparkSession.createDataFrame(rows, "parameter string, value double, " + ", ".join(f"c_{k} double" for k in names))
    costs = SimpleNamespace(**{k: F.col(f"c_{k}") for k in names})
    key = ["parameter", "value"]
    all_ = priced(df.select("id", "t", "day", "split", "amount", "label", "p").crossJoin(F.broadcast(variants)), costs)
    valid, wanted = all_.filter("split = 'valid'"), F.col("priority") > 0
    q = metrics.exact_quantiles(valid.filter(wanted).select(*key, "priority"), "priority", tuple(k / (n - 1) for k in range(n)), *key)
    grid = q.select(*key, F.explode("q").alias("g")).select(*key, F.round("g", 6).alias("g")).unionByName(variants.select(*key, F.lit(0.0).alias("g"))).distinct()
    rest = valid.filter(~wanted).withColumn("action", without_review()).groupBy(*key).agg(realised(costs)[0].alias("base"))
    most = max(c.capacity, *RANGES["capacity"])
    trials = expected_loss(valid.filter(wanted).join(F.broadcast(grid), key), F.col("g"), costs, *key, "g", most=most)
    cost = trials.groupBy(*key, "g").agg(realised(costs)[0].alias("own")).join(rest, key, "left").withColumn("cost", F.round(F.col("own") + F.coalesce("base", F.lit(0.0)), 4))
    best = cost.groupBy(*key).agg(F.min(F.struct("cost", "g")).alias("m")).select(*key, F.col("m.g").alias("threshold"))
    act = expected_loss(all_.filter("split = 'test'").join(F.broadcast(best), key), F.col("threshold"), costs, *key, most=most)
    return act.groupBy(*key, "threshold").agg(realised(costs)[0].alias("total_cost"))


def top_share(df: DataFrame, score: str, share: float) -> DataFrame:
    """The rows of highest score, `share` of all, earlier ones first among equals.

    The score at the edge comes from a histogram of distinct scores (scores have six digits, so it is bounded), and only rows of that score are ordered.
    """
    k = int(df.count() * share)
    upto = Window.orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, 0)
    hist = df.groupBy(score).agg(F.count("*").alias("n")).withColumn("upto", F.sum("n").over(upto)).filter((F.col("upto") >= k) & (F.col("upto") - F.col("n") < k))
    edge = hist.first()
    if edge is None:
        return df.limit(0)
    return df.filter(F.col(score) > edge[score]).unionByName(df.filter(F.col(score) == edge[score]).orderBy(*ARRIVAL).limit(k - edge.upto + edge.n))


def paired_saving(daily: DataFrame, *groups: str, draws: int = 1000) -> DataFrame:
    """(pooled, low, high, adopted) of rows (period, day, saving): the saving with the middle 95 % of its sums over days drawn anew within each period.

    The draws are a hash of (draw, period, place), so reruns agree. Adopted: cheaper in every period, and the lower end above none.
    """
    g = list(groups)
    days = daily.groupBy(*g, "period").agg(F.array_sort(F.collect_list(F.struct("day", "saving"))).alias("d"))  # a month's days at most
    each = days.crossJoin(daily.sparkSession.range(draws).withColumnRenamed("id", "draw")).select(*g, "draw", "period", F.explode(F.sequence(F.lit(1), F.size("d"))).alias("k"), "d")
    number = F.conv(F.substring(F.md5(F.concat_ws(":", "draw", "period", "k")), 1, 8), 16, 10).cast("long")
    totals = each.groupBy(*g, "draw").agg(F.sum(F.col("d")[(number % F.size("d")).cast("int")]["saving"]).alias("total"))
    ends = totals.groupBy(*g).agg(*[F.round(F.percentile("total", F.lit(q)), 2).alias(n) for n, q in (("low", 0.025), ("high", 0.975))])
    pooled = daily.groupBy(*g, "period").agg(F.sum("saving").alias("saving")).groupBy(*g).agg(F.round(F.sum("saving"), 2).alias("pooled"), F.bool_and(F.col("saving") > 0).alias("every"))
    both = pooled.join(ends, g) if g else pooled.crossJoin(ends)
    return both.select(*g, "pooled", "low", "high", (F.col("every") & (F.col("low") > 0)).alias("adopted"))


def month(day: str = "day") -> Column:
    """The calendar month of a day of the log, counted from year 0."""
    date = F.date_add(F.lit("2024-01-01").cast("date"), F.col(day).cast("int"))
    return (12 * F.year(date) + F.month(date) - 1).cast("long")


def cheapest(trials: DataFrame, *order: str) -> DataFrame:
    """The cheapest trial, the lowest limits among equals."""
    return trials.orderBy("total_cost", *order).limit(1)

"""Queries over scores, costs, policies, ranking metrics and calibration."""

from __future__ import annotations

import itertools
from functools import reduce


from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import metrics
from ..operators import policy as P
from ..sources import lake
from ..sources.store import settled
from .registry import COSTS_SQL, query, sql

C = P.Costs()


def scored(spark, sf_dir) -> DataFrame:
    """Scored rows, settled: policies and tuning read them more than once, and the sweeps of history behind them should run once."""
    return settled(P.scored(lake.txn(spark, sf_dir)))


def priced(spark, sf_dir) -> DataFrame:
    return P.priced(scored(spark, sf_dir))


def acts(spark, sf_dir) -> DataFrame:
    return P.decided(priced(spark, sf_dir))


DAILY_SQL = sql(f"SELECT day, policy, count(*) AS transactions, CAST(sum(label) AS BIGINT) AS fraud_transactions, {COSTS_SQL}, count(*) FILTER (action <> 'approve' AND label = 0) AS false_alarms FROM acts GROUP BY day, policy", "acts")


@query("daily_policy_results", DAILY_SQL)
def daily_results(spark, sf_dir):
    """The flagship: events, history, scores, four policies with a daily review budget, and what they cost by day."""
    return acts(spark, sf_dir).groupBy("day", "policy").agg(F.count("*").alias("transactions"), F.sum("label").alias("fraud_transactions"), *P.realised(C), F.count_if((F.col("action") != "approve") & (F.col("label") == 0)).alias("false_alarms"))


query("agg_11_daily_results", DAILY_SQL)(daily_results)


@query("prj_9_rules_fired", sql("""
SELECT id, amount >= 150 AS large_amount, card_txn_1h >= 1 AS burst_last_hour, card_txn_24h >= 4 AS many_last_24h, card_amt_24h + amount >= 300 AS high_spend_24h,
       coalesce(card_new_device, 0) = 1 AND amount >= 100 AS new_device_and_large FROM feat""", "feat"))
def rules_fired(spark, sf_dir):
    return P.featured(lake.txn(spark, sf_dir)).select("id", *[c.alias(n) for n, _, c in P.conditions()])


@query("prj_10_rules_score", sql("SELECT id, points, round(points + least(greatest(CAST(amount AS DOUBLE), 0), 100000) / 100000 * 0.99 + 1e-9, 6) AS rules_score FROM scored", "scored"))
def rules_score(spark, sf_dir):
    return scored(spark, sf_dir).select("id", "points", F.round(F.col("rules_score") + 1e-9, 6).alias("rules_score"))


@query("prj_11_expected_cost", sql("SELECT id, p, round(e_approve + 1e-9, 4) AS e_approve, round(e_decline + 1e-9, 4) AS e_decline, round(e_review + 1e-9, 4) AS e_review FROM priced", "priced"))
def expected_cost(spark, sf_dir):
    return priced(spark, sf_dir).select("id", "p", *[F.round(F.col(c) + 1e-9, 4).alias(c) for c in ("e_approve", "e_decline", "e_review")])


@query("prj_12_review_priority", sql("SELECT id, round(least(e_approve, e_decline) - e_review + 1e-9, 4) AS priority FROM priced", "priced"))
def review_priority(spark, sf_dir):
    return priced(spark, sf_dir).select("id", F.round(F.col("priority") + 1e-9, 4).alias("priority"))


def _policy(name: str):
    def run(spark, sf_dir):
        return acts(spark, sf_dir).filter(F.col("policy") == name).select("id", "action")

    return run


for key, name in (("pol_1_expected_loss", "expected loss"), ("pol_2_cutoffs", "cut-offs"), ("pol_3_rules", "rules"), ("pol_4_approve_all", "approve all")):
    query(key, sql(f"SELECT id, action FROM acts WHERE policy = '{name}'", "acts"))(_policy(name))


@query("win_13_within_capacity", sql("""
SELECT id, want AND sum(CAST(want AS INTEGER)) OVER (PARTITION BY day ORDER BY t, id ROWS UNBOUNDED PRECEDING) <= 10 AS taken
FROM (SELECT *, amount >= 80 AS want FROM txn)""", "txn"))
def within_capacity(spark, sf_dir):
    return P.within_capacity(lake.txn(spark, sf_dir), {"taken": F.col("amount") >= 80}, 10).select("id", "taken")


@query("win_14_daily_top_k", sql("SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY day ORDER BY p DESC, t, id) AS r FROM scored) WHERE r <= 10", "scored"))
def daily_top_k(spark, sf_dir):
    return P.top_of_day(scored(spark, sf_dir), F.col("p"), 10).select("id")


@query("agg_8_realised_cost", sql(f"SELECT {COSTS_SQL} FROM acts WHERE policy = 'expected loss' AND split = 'test'", "acts"))
def realised(spark, sf_dir):
    return acts(spark, sf_dir).filter("policy = 'expected loss' AND split = 'test'").agg(*P.realised(C))


@query("agg_9_cost_of_a_policy", sql(f"SELECT split, {COSTS_SQL} FROM acts WHERE policy = 'rules' GROUP BY split", "acts"))
def cost_of_policy(spark, sf_dir):
    return acts(spark, sf_dir).filter("policy = 'rules'").groupBy("split").agg(*P.realised(C))


@query("agg_10_policy_table", sql(f"""
SELECT *, row_number() OVER (PARTITION BY split ORDER BY total_cost, policy) = 1 AS cheapest
FROM (SELECT policy, split, {COSTS_SQL} FROM acts WHERE split <> 'train' GROUP BY policy, split)""", "acts"))
def policy_table(spark, sf_dir):
    t = acts(spark, sf_dir).filter("split <> 'train'").groupBy("policy", "split").agg(*P.realised(C))
    return t.withColumn("cheapest", F.row_number().over(Window.partitionBy("split").orderBy("total_cost", "policy")) == 1)


@query("agg_13_segment_table", sql("""
SELECT segment, value, count(*) AS rows, round(avg(CAST(action <> 'approve' AS INTEGER)), 6) AS alert_rate,
  round(count(*) FILTER (action <> 'approve' AND label = 1) / nullif(count(*) FILTER (action <> 'approve'), 0), 6) AS "precision",
  round(count(*) FILTER (action <> 'approve' AND label = 1) / nullif(count(*) FILTER (label = 1), 0), 6) AS recall,
  round(sum(CASE WHEN label = 1 AND action = 'decline' THEN CAST(amount AS DOUBLE) WHEN label = 1 AND action = 'review' THEN 0.9 * CAST(amount AS DOUBLE) ELSE 0 END), 4) AS value_caught
FROM (SELECT 'email' AS segment, email AS value, action, label, amount FROM acts WHERE policy = 'expected loss'
      UNION ALL SELECT 'band', CASE WHEN amount < 20 THEN 'low' WHEN amount < 100 THEN 'middle' ELSE 'high' END, action, label, amount FROM acts WHERE policy = 'expected loss')
GROUP BY segment, value""", "acts"))
def segment_table(spark, sf_dir):
    a = acts(spark, sf_dir).filter("policy = 'expected loss'")
    band = F.when(F.col("amount") < 20, "low").when(F.col("amount") < 100, "middle").otherwise("high")
    long = a.select("action", "label", "amount", F.explode(F.array(F.struct(F.lit("email").alias("segment"), F.col("email").alias("value")), F.struct(F.lit("band").alias("segment"), band.alias("value")))).alias("s")).select("s.*", "action", "label", "amount")
    alert, fraud = F.col("action") != "approve", F.col("label") == 1
    share = lambda x, y: F.round(F.count_if(x) / F.nullif(F.count_if(y), F.lit(0)), 6)
    return long.groupBy("segment", "value").agg(F.count("*").alias("rows"), F.round(F.avg(alert.cast("int")), 6).alias("alert_rate"), share(alert & fraud, alert).alias("precision"), share(alert & fraud, fraud).alias("recall"), P.realised(C)[6].alias("value_caught"))


#: What (action, label, amount) cost in all, with cost parameters as columns or numbers.
def _total_sql(fee="20", review="7", catch="0.9::DOUBLE", margin="0.25", fixed="10", delay="2") -> str:
    loss = f"(CAST(amount AS DOUBLE) + {fee})"
    return f"""round(coalesce(sum(CASE WHEN label = 1 AND action = 'approve' THEN {loss} WHEN label = 1 AND action = 'review' THEN (1 - {catch}) * {loss} ELSE 0 END)
    + sum(CASE WHEN label = 0 AND action = 'decline' THEN {margin} * CAST(amount AS DOUBLE) + {fixed} ELSE 0 END)
    + sum(CASE WHEN action = 'review' THEN {review} + CASE WHEN label = 0 THEN {delay} ELSE 0 END ELSE 0 END), 0), 4)"""


@query("pol_5_tune_expected_loss", sql(f"""
SELECT g AS threshold, round({_total_sql()} + coalesce(max(base), 0), 4) AS total_cost, count(*) FILTER (action = 'review') AS reviews
FROM (SELECT *, CASE WHEN want AND sum(CAST(want AS INTEGER)) OVER (PARTITION BY g, day ORDER BY t, id ROWS UNBOUNDED PRECEDING) <= 10 THEN 'review' WHEN e_decline < e_approve THEN 'decline' ELSE 'approve' END AS action
      FROM (SELECT *, priority > g AS want FROM v, grid WHERE priority > 0)),
     (SELECT {_total_sql()} AS base FROM (SELECT *, CASE WHEN e_decline < e_approve THEN 'decline' ELSE 'approve' END AS action FROM v WHERE priority <= 0))
GROUP BY g""", "priced", more="""
v AS (SELECT *, least(e_approve, e_decline) - e_review AS priority FROM priced WHERE split = 'valid'),
grid AS (SELECT DISTINCT round(g, 6) AS g FROM (SELECT unnest(quantile_cont(priority, [k / 59.0::DOUBLE for k in range(60)])) AS g FROM v WHERE priority > 0) UNION SELECT 0.0::DOUBLE)"""))
def tune_expected_loss(spark, sf_dir):
    return P.tune_expected_loss(priced(spark, sf_dir).filter("split = 'valid'"), C)


@query("pol_6_tune_cutoffs", sql(f"""
SELECT decline_at, review_at, round({_total_sql()} + coalesce(max(base), 0), 4) AS total_cost
FROM (SELECT *, CASE WHEN p >= decline_at THEN 'decline' WHEN want AND sum(CAST(want AS INTEGER)) OVER (PARTITION BY decline_at, review_at, day ORDER BY t, id ROWS UNBOUNDED PRECEDING) <= 10 THEN 'review' ELSE 'approve' END AS action
      FROM (SELECT *, p >= review_at AND p < decline_at AS want FROM top, (SELECT a.g AS decline_at, b.g AS review_at FROM grid a, grid b WHERE b.g <= a.g))),
     (SELECT {_total_sql()} AS base FROM (SELECT *, 'approve' AS action FROM priced WHERE split = 'valid' AND p < (SELECT low FROM low)))
GROUP BY decline_at, review_at""", "priced", more="""
low AS (SELECT round(quantile_cont(p, 0.9), 6) AS low FROM priced WHERE split = 'valid'),
top AS (SELECT * FROM priced WHERE split = 'valid' AND p >= (SELECT low FROM low)),
grid AS (SELECT DISTINCT round(g, 6) AS g FROM (SELECT unnest(quantile_cont(p, [k / 39.0::DOUBLE for k in range(40)])) AS g FROM top) UNION SELECT 1e9::DOUBLE)"""))
def tune_cutoffs(spark, sf_dir):
    return P.tune_cutoffs(priced(spark, sf_dir).filter("split = 'valid'"), "p", C)


@query("pol_7_compare_rankings", sql(f"""
SELECT ranking, {COSTS_SQL} FROM (
  SELECT 'expected saving' AS ranking, label, amount, CASE WHEN row_number() OVER (PARTITION BY day ORDER BY round(e_approve - e_review, 6) DESC, t, id) <= 10 THEN 'review' ELSE 'approve' END AS action FROM priced
  UNION ALL SELECT 'probability', label, amount, CASE WHEN row_number() OVER (PARTITION BY day ORDER BY p DESC, t, id) <= 10 THEN 'review' ELSE 'approve' END FROM priced)
GROUP BY ranking""", "priced"))
def compare_rankings(spark, sf_dir):
    df = priced(spark, sf_dir)
    keys = {"expected saving": F.round(F.col("e_approve") - F.col("e_review"), 6), "probability": F.col("p")}
    reviewed = reduce(DataFrame.unionByName, [P.top_of_day(df, by, 10).select("id", F.lit(k).alias("ranking"), F.lit("review").alias("action")) for k, by in keys.items()])
    both = df.select("id", "label", "amount", F.explode(F.array(*[F.lit(k) for k in keys])).alias("ranking")).join(reviewed, ["id", "ranking"], "left")
    return both.withColumn("action", F.coalesce("action", F.lit("approve"))).groupBy("ranking").agg(*P.realised(C))


#: Limits that the rules are tuned over; here 432 combinations scaled to this log's amounts.
GRID = {"amount": (50.0, 100.0, 150.0, 200.0), "txn_1h": (1, 2, 3), "txn_24h": (2, 3, 4), "spend_24h": (100.0, 200.0, 300.0, 400.0), "new_device_amount": (50.0, 100.0, 150.0)}
_POINTS_SQL = """2 * CAST(amount >= g_amount AS INTEGER) + 2 * CAST(card_txn_1h >= g_1h AS INTEGER) + CAST(card_txn_24h >= g_24h AS INTEGER)
  + CAST(card_amt_24h + amount >= g_spend AS INTEGER) + CAST(coalesce(card_new_device, 0) = 1 AND amount >= g_new AS INTEGER)"""
_GRID_SQL = "(VALUES " + ",".join(str(v) for v in itertools.product(*GRID.values())) + ") g(g_amount, g_1h, g_24h, g_spend, g_new)"


@query("pol_9_tune_rules", sql(f"""
SELECT CAST(g_amount AS DOUBLE) AS amount, g_1h AS txn_1h, g_24h AS txn_24h, CAST(g_spend AS DOUBLE) AS spend_24h, CAST(g_new AS DOUBLE) AS new_device_amount, round(sum(pos / P * tp / (tp + fp)), 4) AS pr_auc
FROM (SELECT *, sum(pos) OVER w AS tp, sum(n - pos) OVER w AS fp, sum(pos) OVER (PARTITION BY g_amount, g_1h, g_24h, g_spend, g_new) AS P
      FROM (SELECT g_amount, g_1h, g_24h, g_spend, g_new, s, sum(label) AS pos, count(*) AS n
            FROM (SELECT g.*, label, round({_POINTS_SQL} + least(greatest(CAST(amount AS DOUBLE), 0), 100000) / 100000 * 0.99, 9) AS s FROM feat, {_GRID_SQL} WHERE split = 'valid') GROUP BY ALL)
      WINDOW w AS (PARTITION BY g_amount, g_1h, g_24h, g_spend, g_new ORDER BY s DESC))
GROUP BY ALL""", "feat"))
def tune_rules(spark, sf_dir):
    """Average precision of all 432 combinations of limits. A combination tells rows apart only by their amount and by how many limits of each rule they meet, so rows are counted by these first, and only the counts meet the grid."""
    df = P.featured(lake.txn(spark, sf_dir)).filter("split = 'valid'")
    limits, met = {k: sorted(v) for k, v in GRID.items()}, {}
    for rule, (k, values) in enumerate(limits.items()):
        met[f"m_{k}"] = sum((F.coalesce(P.conditions(P.LIMITS | {k: v})[rule][2], F.lit(False)).cast("int") for v in values), F.lit(0))
    counts = df.groupBy("amount", *[c.alias(k) for k, c in met.items()]).agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"), F.sum(F.when(F.col("label") == 1, F.col("amount")).otherwise(0)).alias("val"))
    g = [f"g_{k}" for k in GRID]
    places = [tuple(x for k, v in zip(limits, combination, strict=True) for x in (v, limits[k].index(v))) for combination in itertools.product(*GRID.values())]
    kinds = dict(zip(GRID, ("double", "int", "int", "double", "double"), strict=True))
    grid = spark.createDataFrame(places, ", ".join(f"g_{k} {kinds[k]}, i_{k} int" for k in GRID))
    points = sum((F.when(F.col(f"m_{k}") > F.col(f"i_{k}"), worth).otherwise(0) for k, (_, worth, _) in zip(GRID, P.RULES, strict=True)), F.lit(0))
    trials = counts.crossJoin(F.broadcast(grid)).groupBy(*g, F.round(P.rules_score(points), 9).alias("s")).agg(*[F.sum(c).alias(c) for c in ("pos", "neg", "val")])
    cells = metrics.running(trials, *g)
    return cells.groupBy(*g).agg(F.round(metrics.average_precision(), 4).alias("pr_auc")).select(*[F.col(f"g_{k}").alias(k) for k in GRID], "pr_auc")


@query("jn_12_parameter_grid", sql("SELECT fee, review, round(sum(least(p * (CAST(amount AS DOUBLE) + fee), review + p * 0.1 * (CAST(amount AS DOUBLE) + fee))), 3) AS cost FROM scored, (VALUES (10.0), (20.0), (40.0)) a(fee), (VALUES (4.0), (7.0), (12.0)) b(review) GROUP BY fee, review", "scored"))
def parameter_grid(spark, sf_dir):
    grid = spark.createDataFrame([(f, r) for f in (10.0, 20.0, 40.0) for r in (4.0, 7.0, 12.0)], "fee double, review double")
    loss = F.col("p") * (F.col("amount").cast("double") + F.col("fee"))
    df = scored(spark, sf_dir).crossJoin(F.broadcast(grid))
    return df.groupBy("fee", "review").agg(F.round(F.sum(F.least(loss, F.col("review") + 0.1 * loss)), 3).alias("cost")).select(F.col("fee").cast("decimal(3,1)").alias("fee"), F.col("review").cast("decimal(3,1)").alias("review"), "cost")


_VARIANTS = "(VALUES " + ", ".join(
    f"('{name}', {float(end)}::DOUBLE, " + ", ".join(f"{float(end if k == name else getattr(C, k))}::DOUBLE" for k in P.RANGES) + ")" for name, ends in P.RANGES.items() for end in ends
) + ") w(parameter, value, " + ", ".join(f"c_{k}" for k in P.RANGES) + ")"
_ANY = _total_sql("c_fee", "c_review", "c_catch", "c_margin", "c_fixed", "c_delay")


@query("agg_12_sensitivity", sql(f"""
SELECT parameter, value, threshold, {_ANY} AS total_cost
FROM (SELECT *, CASE WHEN want AND sum(CAST(want AS INTEGER)) OVER (PARTITION BY parameter, value, day ORDER BY t, id ROWS UNBOUNDED PRECEDING) <= c_capacity THEN 'review' WHEN e_decline < e_approve THEN 'decline' ELSE 'approve' END AS action
      FROM (SELECT *, priority > threshold AND priority > 0 AS want FROM varied JOIN best USING (parameter, value) WHERE split = 'test'))
GROUP BY parameter, value, threshold""", "scored", more=f"""
varied AS (SELECT *, least(e_approve, e_decline) - e_review AS priority FROM (
  SELECT *, p * (CAST(amount AS DOUBLE) + c_fee) AS e_approve, (1 - p) * (c_margin * CAST(amount AS DOUBLE) + c_fixed) AS e_decline,
    c_review + p * (1 - c_catch) * (CAST(amount AS DOUBLE) + c_fee) + (1 - p) * c_delay AS e_review FROM scored, {_VARIANTS})),
v AS (SELECT * FROM varied WHERE split = 'valid'),
grid AS (SELECT DISTINCT parameter, value, round(g, 6) AS g FROM (SELECT parameter, value, unnest(quantile_cont(priority, [k / 59.0::DOUBLE for k in range(60)])) AS g FROM v WHERE priority > 0 GROUP BY parameter, value)
         UNION SELECT parameter, value, 0.0::DOUBLE FROM {_VARIANTS}),
rest AS (SELECT parameter, value, {_ANY} AS base FROM (SELECT *, CASE WHEN e_decline < e_approve THEN 'decline' ELSE 'approve' END AS action FROM v WHERE priority <= 0) GROUP BY parameter, value),
trials AS (
  SELECT parameter, value, g, {_ANY} AS own
  FROM (SELECT *, CASE WHEN want AND sum(CAST(want AS INTEGER)) OVER (PARTITION BY parameter, value, g, day ORDER BY t, id ROWS UNBOUNDED PRECEDING) <= c_capacity THEN 'review' WHEN e_decline < e_approve THEN 'decline' ELSE 'approve' END AS action
        FROM (SELECT *, priority > g AS want FROM v JOIN grid USING (parameter, value) WHERE priority > 0))
  GROUP BY parameter, value, g),
best AS (SELECT parameter, value, g AS threshold FROM (SELECT *, row_number() OVER (PARTITION BY parameter, value ORDER BY round(own + coalesce(base, 0), 4), g) AS r FROM trials LEFT JOIN rest USING (parameter, value)) WHERE r = 1)"""))
def sensitivity(spark, sf_dir):
    """Each cost parameter at both ends: tuned anew on validation, its cost on test."""
    return P.sensitivity(scored(spark, sf_dir), C)


_CELLS = """
cells AS (
  SELECT model, s, pos, n, v, sum(pos) OVER w AS tp, sum(n - pos) OVER w AS fp, sum(v) OVER w AS tv, sum(pos) OVER (PARTITION BY model) AS pp, sum(n - pos) OVER (PARTITION BY model) AS nn, sum(v) OVER (PARTITION BY model) AS vv
  FROM (SELECT model, s, sum(label) AS pos, count(*) AS n, sum(CASE WHEN label = 1 THEN amount ELSE 0 END) AS v
        FROM (SELECT 'linear' AS model, p AS s, label, amount FROM scored UNION ALL SELECT 'points', CAST(points AS DOUBLE), label, amount FROM scored) GROUP BY model, s)
  WINDOW w AS (PARTITION BY model ORDER BY s DESC))"""


def _cells(spark, sf_dir) -> DataFrame:
    df = scored(spark, sf_dir)
    long = df.select("label", "amount", F.explode(F.array(F.struct(F.lit("linear").alias("model"), F.col("p").alias("x")), F.struct(F.lit("points").alias("model"), F.col("points").cast("double").alias("x")))).alias("m")).select("m.model", "m.x", "label", "amount")
    return metrics.by_score(long, "x", "model")


@query("met_1_average_precision", sql("SELECT model, round(sum(pos / pp * tp / (tp + fp)), 6) AS pr_auc FROM cells GROUP BY model", "scored", more=_CELLS))
def pr_auc(spark, sf_dir):
    return _cells(spark, sf_dir).groupBy("model").agg(F.round(metrics.average_precision(), 6).alias("pr_auc"))


@query("met_2_roc_auc", sql("SELECT model, round(sum(pos * (nn - fp + (n - pos) / 2)) / (max(pp) * max(nn)), 6) AS roc_auc FROM cells GROUP BY model", "scored", more=_CELLS))
def roc_auc(spark, sf_dir):
    return _cells(spark, sf_dir).groupBy("model").agg(F.round(metrics.roc_auc(), 6).alias("roc_auc"))


LEVELS = (0.001, 0.005, 0.01, 0.05)


@query("met_3_recall_at_fpr", sql("""
SELECT c.model, l.level, r.s AS threshold, coalesce(round(r.fp / r.nn, 6), 0) AS fpr, coalesce(round(r.tp / r.pp, 6), 0) AS recall, coalesce(round(CAST(r.tv AS DOUBLE) / CAST(r.vv AS DOUBLE), 6), 0) AS value_recall, coalesce(round((r.tp + r.fp) / (r.pp + r.nn), 6), 0) AS alert_rate
FROM (SELECT DISTINCT model FROM cells) c CROSS JOIN (VALUES (0.001::DOUBLE), (0.005::DOUBLE), (0.01::DOUBLE), (0.05::DOUBLE)) l(level)
LEFT JOIN LATERAL (SELECT * FROM cells d WHERE d.model = c.model AND d.fp / d.nn <= l.level ORDER BY d.s LIMIT 1) r ON true""", "scored", more=_CELLS))
def recall_at_fpr(spark, sf_dir):
    return metrics.recall_at(_cells(spark, sf_dir), LEVELS, "model")


@query("win_20_cumulative_counts", sql("SELECT model, s, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp FROM cells WHERE model = 'points'", "scored", more=_CELLS))
def cumulative(spark, sf_dir):
    return _cells(spark, sf_dir).filter("model = 'points'").select("model", "s", "tp", "fp")


@query("met_4_brier", sql("SELECT split, round(avg((p - label) * (p - label)), 6) AS brier FROM scored GROUP BY split", "scored"))
def brier(spark, sf_dir):
    return scored(spark, sf_dir).groupBy("split").agg(F.round(F.avg((F.col("p") - F.col("label")) ** 2), 6).alias("brier"))


@query("met_5_calibration_curve", sql("SELECT CAST(b - 1 AS BIGINT) AS bin, count(*) AS rows, round(avg(p), 6) AS predicted, round(avg(label), 6) AS observed FROM (SELECT p, label, ntile(10) OVER (ORDER BY p, t, id) AS b FROM scored) GROUP BY b", "scored"))
def calibration(spark, sf_dir):
    return metrics.calibration_bins(scored(spark, sf_dir), "p").withColumns({"predicted": F.round("predicted", 6), "observed": F.round("observed", 6)})


@query("met_5_expected_calibration_error", sql("SELECT round(sum(n * abs(pr - ob)) / sum(n), 6) AS ece FROM (SELECT count(*) AS n, avg(p) AS pr, avg(label) AS ob FROM (SELECT p, label, ntile(10) OVER (ORDER BY p, t, id) AS b FROM scored) GROUP BY b)", "scored"))
def ece(spark, sf_dir):
    return metrics.calibration_bins(scored(spark, sf_dir), "p").agg(F.round(metrics.calibration_error(), 6).alias("ece"))


@query("prj_17_signed_log", sql("SELECT id, round(sign(x) * ln(1 + abs(x)), 6) AS signed_log FROM (SELECT id, CAST(amount AS DOUBLE) - 50 AS x FROM txn)", "txn"))
def signed_log(spark, sf_dir):
    x = F.col("amount").cast("double") - 50
    return lake.txn(spark, sf_dir).select("id", F.round(F.signum(x) * F.log1p(F.abs(x)), 6).alias("signed_log"))


@query("prj_18_platt", sql("SELECT id, round(1 / (1 + exp(-(0.8 * ln(q / (1 - q)) - 0.3))), 6) AS calibrated FROM (SELECT id, least(greatest(p, 1e-6), 1 - 1e-6) AS q FROM scored)", "scored"))
def platt(spark, sf_dir):
    q = F.least(F.greatest("p", F.lit(1e-6)), F.lit(1 - 1e-6))
    return scored(spark, sf_dir).select("id", F.round(1 / (1 + F.exp(-(0.8 * F.log(q / (1 - q)) - 0.3))), 6).alias("calibrated"))


@query("prj_20_block_list", sql("""
SELECT id, CASE WHEN coalesce(sum(label) OVER (PARTITION BY card ORDER BY t RANGE BETWEEN UNBOUNDED PRECEDING AND 259201 PRECEDING), 0) > 0 THEN 1.0 ELSE p END::DOUBLE AS p FROM scored""", "scored"))
def block_list(spark, sf_dir):
    from ..operators import history

    known = history.add_history(lake.txn(spark, sf_dir), (history.Feature("known", "card", "known", None, "label", 3 * 86400),)).select("id", "known")
    return scored(spark, sf_dir).join(known, "id").select("id", F.when(F.col("known") > 0, 1.0).otherwise(F.col("p")).alias("p"))


@query("srt_3_top_reasons", sql("""
SELECT id, list_transform(list_sort(list_filter([{'c': -2 * CAST(amount >= 150 AS INTEGER), 'f': 'large_amount'}, {'c': -2 * CAST(card_txn_1h >= 1 AS INTEGER), 'f': 'burst_last_hour'}, {'c': -CAST(card_txn_24h >= 4 AS INTEGER), 'f': 'many_last_24h'},
  {'c': -CAST(card_amt_24h + amount >= 300 AS INTEGER), 'f': 'high_spend_24h'}, {'c': -CAST(coalesce(card_new_device, 0) = 1 AND amount >= 100 AS INTEGER), 'f': 'new_device_and_large'}], lambda x: x.c < 0))[1:3], lambda x: x.f).array_to_string(',') AS reasons FROM feat""", "feat"))
def top_reasons(spark, sf_dir):
    """The three largest positive contributions to a rules score, in order."""
    each = F.array(*[F.struct((-F.when(c, worth).otherwise(0)).alias("c"), F.lit(n).alias("f")) for n, worth, c in P.conditions()])
    top = F.slice(F.array_sort(F.filter(each, lambda x: x["c"] < 0)), 1, 3)
    return P.featured(lake.txn(spark, sf_dir)).select("id", F.array_join(F.transform(top, lambda x: x["f"]), ",").alias("reasons"))


@query("ml_10_linear_contributions", sql("""
SELECT id, round(0.5 * (ln(1 + card_txn_24h) - avg(ln(1 + card_txn_24h)) OVER ()), 6) AS c_txn, round(0.012 * (CAST(amount AS DOUBLE) - avg(CAST(amount AS DOUBLE)) OVER ()), 6) AS c_amount, round(0.8 * (coalesce(card_new_device, 0) - avg(coalesce(card_new_device, 0)) OVER ()), 6) AS c_device FROM feat""", "feat"))
def contributions(spark, sf_dir):
    """Exact additive contributions of a linear score: coefficient times distance from the mean. The means are one row."""
    df = P.featured(lake.txn(spark, sf_dir)).select("id", (0.5 * F.log(1 + F.col("card_txn_24h"))).alias("txn"), (0.012 * F.col("amount").cast("double")).alias("amount"), (0.8 * F.coalesce("card_new_device", F.lit(0))).alias("device"))
    means = df.agg(*[F.avg(c).alias(f"m_{c}") for c in ("txn", "amount", "device")])
    return df.crossJoin(F.broadcast(means)).select("id", *[F.round(F.col(c) - F.col(f"m_{c}"), 6).alias(f"c_{c}") for c in ("txn", "amount", "device")])


#: What each part of the linear score looks at, fixed.
PART_FAMILY = {"txn": "velocity", "amount": "amount", "device": "novelty"}
_MEAN_ABS = """
parts AS (SELECT name, avg(abs(c)) AS m FROM (
  SELECT unnest(['txn', 'amount', 'device']) AS name, unnest([0.5 * (ln(1 + card_txn_24h) - avg(ln(1 + card_txn_24h)) OVER ()), 0.012 * (CAST(amount AS DOUBLE) - avg(CAST(amount AS DOUBLE)) OVER ()), 0.8 * (coalesce(card_new_device, 0) - avg(coalesce(card_new_device, 0)) OVER ())]) AS c FROM feat) GROUP BY name)"""


@query("agg_25_mean_abs_contribution", sql("""
SELECT level, name, round(m, 6) AS mean_abs, round(m / sum(m) OVER (PARTITION BY level), 6) AS share FROM (
  SELECT 'feature' AS level, name, m FROM parts UNION ALL SELECT 'family', CASE name WHEN 'txn' THEN 'velocity' WHEN 'device' THEN 'novelty' ELSE 'amount' END, sum(m) FROM parts GROUP BY ALL)""", "feat", more=_MEAN_ABS))
def mean_abs(spark, sf_dir):
    """Mean absolute contribution and its share, by feature and by family."""
    long = contributions(spark, sf_dir).select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(f).alias("family"), F.col(f"c_{c}").alias("c")) for c, f in PART_FAMILY.items()])).alias("x")).select("x.*")
    parts = long.groupBy("feature", "family").agg(F.avg(F.abs("c")).alias("m"))
    both = parts.select("m", F.explode(F.array(*[F.struct(F.lit(n).alias("level"), F.col(n).alias("name")) for n in ("feature", "family")])).alias("x")).groupBy("x.level", "x.name").agg(F.sum("m").alias("m"))
    return both.select("level", "name", F.round("m", 6).alias("mean_abs"), F.round(F.col("m") / F.sum("m").over(Window.partitionBy("level")), 6).alias("share"))


@query("srt_2_top_features", sql("SELECT name, round(m, 6) AS mean_abs FROM parts ORDER BY m DESC, name LIMIT 20", "feat", more=_MEAN_ABS))
def top_features(spark, sf_dir):
    """The twenty features of the largest mean absolute contribution."""
    return mean_abs(spark, sf_dir).filter("level = 'feature'").select("name", "mean_abs").orderBy(F.desc("mean_abs"), "name").limit(20)


_FIRST_REASON = "CASE WHEN card_txn_1h >= 1 THEN 'burst_last_hour' WHEN amount >= 150 THEN 'large_amount' WHEN card_amt_24h + amount >= 300 THEN 'high_spend_24h' WHEN card_txn_24h >= 4 THEN 'many_last_24h' WHEN coalesce(card_new_device, 0) = 1 AND amount >= 100 THEN 'new_device_and_large' END"
#: What each rule looks at, fixed.
FAMILY = {"large_amount": "amount", "burst_last_hour": "velocity", "many_last_24h": "velocity", "high_spend_24h": "amount", "new_device_and_large": "novelty"}
_FAMILY_SQL = "CASE reason " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FAMILY.items()) + " END"


@query("agg_26_top_reason_shares", sql(f"""
SELECT level, name, rows, round(rows / sum(rows) OVER (PARTITION BY level), 6) AS share FROM (
  SELECT 'feature' AS level, reason AS name, count(*) AS rows FROM r GROUP BY reason UNION ALL SELECT 'family', {_FAMILY_SQL}, count(*) FROM r GROUP BY ALL)""", "scored", more=f"""
r AS (SELECT {_FIRST_REASON} AS reason FROM scored WHERE points >= 3)"""))
def reason_shares(spark, sf_dir):
    """Among alerts of the rules (3 points or more), the first reason's share, by feature and by family."""
    alerts = scored(spark, sf_dir).filter("points >= 3")
    reason = F.array_min(F.array(*[F.when(c, F.struct(F.lit(-worth).alias("c"), F.lit(n).alias("f"), F.lit(FAMILY[n]).alias("family"))) for n, worth, c in P.conditions()]))
    both = alerts.select(reason.alias("r")).select(F.explode(F.array(F.struct(F.lit("feature").alias("level"), F.col("r.f").alias("name")), F.struct(F.lit("family").alias("level"), F.col("r.family").alias("name")))).alias("x")).select("x.*")
    return both.groupBy("level", "name").agg(F.count("*").alias("rows")).withColumn("share", F.round(F.col("rows") / F.sum("rows").over(Window.partitionBy("level")), 6))


@query("srt_2_top_reasons", sql(f"SELECT {_FIRST_REASON} AS name, count(*) AS rows FROM scored WHERE points >= 3 GROUP BY name ORDER BY rows DESC, name LIMIT 10", "scored"))
def commonest_reasons(spark, sf_dir):
    """The ten commonest first reasons among alerts."""
    return reason_shares(spark, sf_dir).filter("level = 'feature'").select("name", "rows").orderBy(F.desc("rows"), "name").limit(10)


@query("agg_27_busiest_key", sql("""
SELECT card, rows, round(rate, 6) AS rate, round(top_rows / k, 6) AS share_of_top
FROM (SELECT card, count(*) AS rows, avg(label) AS rate FROM scored GROUP BY card ORDER BY rows DESC, card LIMIT 1),
     (SELECT count(*) AS top_rows FROM (SELECT card, row_number() OVER (ORDER BY p DESC, t, id) AS r FROM scored) WHERE r <= (SELECT count(*) // 100 FROM scored) AND card = (SELECT card FROM scored GROUP BY card ORDER BY count(*) DESC, card LIMIT 1)),
     (SELECT count(*) // 100 AS k FROM scored)""", "scored"))
def busiest_key(spark, sf_dir):
    df = scored(spark, sf_dir)
    k = df.count() // 100
    top = P.top_share(df, "p", 0.01)
    busy = df.groupBy("card").agg(F.count("*").alias("rows"), F.round(F.avg("label"), 6).alias("rate")).orderBy(F.desc("rows"), "card").limit(1)
    share = top.join(F.broadcast(busy.select("card")), "card", "left_semi").agg(F.round(F.count("*") / k, 6).alias("share_of_top"))
    return busy.crossJoin(F.broadcast(share))


@query("srt_4_top_percent", sql("SELECT id FROM (SELECT id, row_number() OVER (ORDER BY p DESC, t, id) AS r FROM scored) WHERE r <= (SELECT count(*) // 100 FROM scored)", "scored"))
def top_percent(spark, sf_dir):
    df = scored(spark, sf_dir)
    return P.top_share(df, "p", 0.01).select("id")


@query("win_17_cumulative_saving", sql(f"""
SELECT day, round(sum(a - b) OVER (ORDER BY day), 4) AS saving FROM (
  SELECT day, max(total_cost) FILTER (policy = 'approve all') AS a, max(total_cost) FILTER (policy = 'rules') AS b FROM (SELECT day, policy, {COSTS_SQL} FROM acts GROUP BY day, policy) GROUP BY day)""", "acts"))
def cumulative_saving(spark, sf_dir):
    wide = acts(spark, sf_dir).groupBy("day").pivot("policy", ["approve all", "rules"]).agg(P.realised(C)[0])
    return wide.select("day", F.round(F.sum(F.col("approve all") - F.col("rules")).over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)), 4).alias("saving"))


@query("agg_30_daily_cost_of_variants", sql(f"""
SELECT day, round(max(total_cost) FILTER (policy = 'expected loss'), 4) AS expected_loss, round(max(total_cost) FILTER (policy = 'cut-offs'), 4) AS cutoffs FROM (SELECT day, policy, {COSTS_SQL} FROM acts GROUP BY day, policy) GROUP BY day""", "acts"))
def daily_variants(spark, sf_dir):
    wide = acts(spark, sf_dir).groupBy("day").pivot("policy", ["expected loss", "cut-offs"]).agg(P.realised(C)[0])
    return wide.select("day", F.col("expected loss").alias("expected_loss"), F.col("cut-offs").alias("cutoffs"))


@query("agg_31_paired_day_bootstrap", sql("""
SELECT round((SELECT sum(saving) FROM daily), 2) AS pooled, round(quantile_cont(total, 0.025), 2) AS low, round(quantile_cont(total, 0.975), 2) AS high,
  (SELECT bool_and(s > 0) FROM (SELECT sum(saving) AS s FROM daily GROUP BY period)) AND round(quantile_cont(total, 0.025), 2) > 0 AS adopted FROM totals""", "acts", more=f"""
daily AS (SELECT day, 12 * year(d) + month(d) - 1 AS period, b - a AS saving FROM (
  SELECT day, DATE '2024-01-01' + CAST(day AS INTEGER) AS d, max(total_cost) FILTER (policy = 'expected loss') AS a, max(total_cost) FILTER (policy = 'rules') AS b FROM (SELECT day, policy, {COSTS_SQL} FROM acts GROUP BY day, policy) GROUP BY day)),
months AS (SELECT period, list(saving ORDER BY day) AS d, len(list(saving)) AS n FROM daily GROUP BY period),
places AS (SELECT period, d, n, unnest(range(1, n + 1)) AS k FROM months),
totals AS (SELECT draw, sum(d[1 + CAST('0x' || substr(md5(draw || ':' || period || ':' || k), 1, 8) AS BIGINT) % n]) AS total FROM places, range(1000) r(draw) GROUP BY draw)"""))
def bootstrap(spark, sf_dir):
    """Saving of expected loss against rules, pooled over calendar months, with a 95 % interval from whole days drawn anew within each month."""
    wide = acts(spark, sf_dir).groupBy("day").pivot("policy", ["expected loss", "rules"]).agg(P.realised(C)[0])
    return P.paired_saving(wide.select(P.month().alias("period"), "day", (F.col("rules") - F.col("expected loss")).alias("saving")))


@query("ml_5_expanding_folds", sql("""
SELECT fold, role, count(*) AS rows, min(day) AS first_day, max(day) AS last_day FROM (
  SELECT f.fold, day, CASE WHEN day < f.start - 3 THEN 'fit' WHEN day < f.start THEN 'inner' WHEN day < f.start + 6 THEN 'score' END AS role FROM txn, (VALUES (1, 12), (2, 18), (3, 24)) f(fold, start))
WHERE role IS NOT NULL GROUP BY fold, role""", "txn"))
def folds(spark, sf_dir):
    """Train before the fold's start, its last days to stop on, then the fold itself."""
    f = F.explode(F.array(*[F.struct(F.lit(k).alias("fold"), F.lit(s).alias("start")) for k, s in ((1, 12), (2, 18), (3, 24))]))
    df = lake.txn(spark, sf_dir).select("day", f.alias("f"))
    role = F.when(F.col("day") < F.col("f.start") - 3, "fit").when(F.col("day") < F.col("f.start"), "inner").when(F.col("day") < F.col("f.start") + 6, "score")
    return df.withColumn("role", role).filter("role IS NOT NULL").groupBy("f.fold", "role").agg(F.count("*").alias("rows"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))


_EVALUATED = """
rows_ AS (SELECT 'linear' AS model, split, p AS s, label, amount, t, id FROM scored WHERE split <> 'train' UNION ALL SELECT 'points', split, points / 7, label, amount, t, id FROM scored WHERE split <> 'train'),
cells AS (SELECT model, split, s, pos, n - pos AS neg, sum(pos) OVER w AS tp, sum(n - pos) OVER w AS fp, sum(v) OVER w AS tv, sum(pos) OVER g AS pp, sum(n - pos) OVER g AS nn, sum(v) OVER g AS vv
  FROM (SELECT model, split, s, sum(label) AS pos, count(*) AS n, sum(CASE WHEN label = 1 THEN CAST(amount AS DOUBLE) ELSE 0 END) AS v FROM rows_ GROUP BY model, split, s)
  WINDOW w AS (PARTITION BY model, split ORDER BY s DESC), g AS (PARTITION BY model, split)),
ranked AS (SELECT model, split, round(sum(pos / pp * tp / (tp + fp)), 6) AS pr_auc, round(sum(pos * (nn - fp + neg / 2)) / (max(pp) * max(nn)), 6) AS roc_auc, %s FROM cells GROUP BY model, split),
plain AS (SELECT model, split, count(*) AS rows, CAST(sum(label) AS BIGINT) AS fraud, round(avg((s - label) * (s - label)), 6) AS brier FROM rows_ GROUP BY model, split),
ece AS (SELECT model, split, round(sum(n * abs(pr - ob)) / sum(n), 6) AS ece FROM (SELECT model, split, count(*) AS n, avg(s) AS pr, avg(label) AS ob FROM (SELECT *, ntile(10) OVER (PARTITION BY model, split ORDER BY s, t, id) AS b FROM rows_) GROUP BY model, split, b) GROUP BY model, split)""" % ", ".join(
    f"coalesce(round(max(tp) FILTER (fp / nn <= {x}) / max(pp), 6), 0) AS recall_at_{k}, coalesce(round(max(tv) FILTER (fp / nn <= {x}) / max(vv), 6), 0) AS value_recall_at_{k}" for k, x in enumerate(LEVELS)
)


@query("ml_4_evaluate_models", sql("SELECT * FROM plain JOIN ranked USING (model, split) JOIN ece USING (model, split)", "scored", more=_EVALUATED))
def evaluate(spark, sf_dir):
    """Each model on validation and test: average precision, area under the curve, recall of rows and of value at each level of false positives, Brier score, calibration error."""
    df, key = scored(spark, sf_dir).filter("split <> 'train'"), ["model", "split"]
    both = F.explode(F.array(F.struct(F.lit("linear").alias("model"), F.col("p").alias("s")), F.struct(F.lit("points").alias("model"), (F.col("points") / 7).alias("s"))))
    long = df.select("id", "t", "split", "label", "amount", both.alias("m")).select("m.*", "id", "t", "split", "label", "amount")
    plain = long.groupBy(*key).agg(F.count("*").alias("rows"), F.sum("label").alias("fraud"), F.round(F.avg((F.col("s") - F.col("label")) ** 2), 6).alias("brier"))
    cells = metrics.by_score(long, "s", *key)
    ranked = cells.groupBy(*key).agg(F.round(metrics.average_precision(), 6).alias("pr_auc"), F.round(metrics.roc_auc(), 6).alias("roc_auc"))
    at = lambda c, x: F.max(F.when(F.col("level") == x, F.col(c)))
    recall = metrics.recall_at(cells, LEVELS, *key).groupBy(*key).agg(*[at(c, x).alias(f"{c}_at_{k}") for k, x in enumerate(LEVELS) for c in ("recall", "value_recall")])
    error = metrics.calibration_bins(long, "s", 10, *key).groupBy(*key).agg(F.round(metrics.calibration_error(), 6).alias("ece"))
    return plain.join(ranked, key).join(recall, key).join(error, key)

"""Queries over the monitoring of decisions, on the log in which the feed of devices falls silent on day 24: scores, actions and inputs are those of a system that goes on without it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import monitoring
from ..operators import policy as P
from ..sources import lake
from ..sources.store import settled
from .registry import query, sql

DAY = 86400
NUMBERS, LEVELS = ("amount", "hour", "p"), ("email", "device")
LIMITS = monitoring.Limits()
#: Score status as if smaller changes of scores counted: the log is short, and the score takes little from devices.
SHORT = monitoring.Limits(psi_warn=0.005, psi_alert=0.02, alert_rate=0.02, run=3, drifted_share=0.2)


def _silent_sql(body: str, *ctes: str, more: str = "") -> str:
    """SQL over the log with the silent feed, under the same names."""
    device = "json_extract_string(props, '$.k')"
    return sql(body, *ctes, more=more).replace(device, f"CASE WHEN floor(epoch(ts)) - {lake.ANCHOR} < {lake.SILENT_DAY * DAY} THEN {device} END")


def decisions(spark, sf_dir) -> DataFrame:
    """The rules policy's decisions, settled: every part of the monitor reads them."""
    log = P.decided(P.priced(P.scored(lake.silent(spark, sf_dir)))).filter("policy = 'rules'")
    return settled(log.select("id", "t", "day", "split", "amount", "label", "email", "device", F.floor(F.col("t") % DAY / 3600).alias("hour"), "p", "action"))


_LOG = f"""
lg AS MATERIALIZED (SELECT id, t, day, split, amount, label, email, device, t % {DAY} // 3600 AS hour, p, action FROM acts WHERE policy = 'rules'),
rf AS (SELECT * FROM lg WHERE split = 'train'),
days AS (SELECT unnest(range(min(day) + 7, max(day) + 2)) AS day FROM lg),
wk AS MATERIALIZED (SELECT d.day AS dd, lg.* FROM days d JOIN lg ON lg.day >= d.day - 7 AND lg.day < d.day)"""

_DRIFT = _LOG + """,
nl AS (SELECT 'amount' AS field, dd, CAST(amount AS DOUBLE) AS v FROM wk UNION ALL SELECT 'hour', dd, hour FROM wk UNION ALL SELECT 'p', dd, p FROM wk),
nr AS (SELECT 'amount' AS field, CAST(amount AS DOUBLE) AS v FROM rf UNION ALL SELECT 'hour', hour FROM rf UNION ALL SELECT 'p', p FROM rf),
cl AS (SELECT 'email' AS field, dd, email AS v FROM wk UNION ALL SELECT 'device', dd, device FROM wk),
cr AS (SELECT 'email' AS field, email AS v FROM rf UNION ALL SELECT 'device', device FROM rf),
nv AS (SELECT dd, field, v, sum(r) AS r, sum(c) AS c FROM (
  SELECT dd, field, v, 0 AS r, 1 AS c FROM nl WHERE v IS NOT NULL UNION ALL SELECT d.day, field, v, 1, 0 FROM nr, days d WHERE v IS NOT NULL) GROUP BY ALL),
num AS (SELECT dd, field, sum(r) OVER w / sum(r) OVER g AS fr, coalesce(sum(c) OVER w / nullif(sum(c) OVER g, 0), 0) AS fc, lead(v) OVER w - v AS step
  FROM nv WINDOW w AS (PARTITION BY dd, field ORDER BY v), g AS (PARTITION BY dd, field)),
lv AS (SELECT dd, field, v, sum(r) AS r, sum(c) AS c FROM (
  SELECT dd, field, v, 0 AS r, 1 AS c FROM cl WHERE v IS NOT NULL UNION ALL SELECT d.day, field, v, 1, 0 FROM cr, days d WHERE v IS NOT NULL) GROUP BY ALL),
lev AS (SELECT dd, field, r / sum(r) OVER g AS r, coalesce(c / nullif(sum(c) OVER g, 0), 0) AS c FROM lv WINDOW g AS (PARTITION BY dd, field)),
dist AS (SELECT dd, field, round(sum(abs(fr - fc) * step) / (SELECT stddev_pop(v) FROM nr WHERE nr.field = num.field), 6) AS distance FROM num GROUP BY dd, field
  UNION ALL SELECT dd, field, round(sqrt(greatest(sum((CASE WHEN r > 0 THEN r * ln(2 * r / (r + c)) ELSE 0 END + CASE WHEN c > 0 THEN c * ln(2 * c / (r + c)) ELSE 0 END) / 2), 0) / ln(2)), 6) FROM lev GROUP BY dd, field),
fields AS (SELECT dd, field, CAST(v AS VARCHAR) AS v FROM nl UNION ALL SELECT dd, field, v FROM cl),
rfields AS (SELECT field, avg(CAST(v IS NULL AS INTEGER)) AS then_ FROM (SELECT field, CAST(v AS VARCHAR) AS v FROM nr UNION ALL SELECT field, v FROM cr) GROUP BY field),
gone AS (SELECT dd, field, round(abs(avg(CAST(v IS NULL AS INTEGER)) - max(then_)), 6) AS missing_shift FROM fields JOIN rfields USING (field) GROUP BY dd, field),
drift AS (SELECT dd AS day, field, distance, missing_shift, coalesce(distance, 0) >= 0.1 OR missing_shift >= 0.2 AS drifted FROM gone LEFT JOIN dist USING (dd, field))"""


@query("agg_17_daily_drift", _silent_sql("SELECT * FROM drift", "acts", more=_DRIFT))
def daily_drift(spark, sf_dir):
    """Each field's distance from the reference over each day's trailing week."""
    log = decisions(spark, sf_dir)
    return monitoring.daily_input_drift(log, log.filter("split = 'train'"), monitoring.judged_days(log, LIMITS.window), NUMBERS, LEVELS)


_TIMELINE = _DRIFT + """,
usual AS (SELECT avg(CAST(action <> 'approve' AS INTEGER)) AS u FROM rf),
stat AS (SELECT dd AS day, count(*) AS n, avg(CAST(action <> 'approve' AS INTEGER)) AS rate FROM wk GROUP BY dd),
edges AS (SELECT list_sort(list_distinct(quantile_cont(p, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e FROM rf),
inner_edges AS (SELECT unnest(e[2:len(e) - 1]) AS x FROM edges),
spine AS (SELECT unnest(range(0, greatest(len(e) - 1, 1))) AS b FROM edges),
binned AS (SELECT dd, (SELECT count(*) FROM inner_edges WHERE x <= p) AS b FROM wk),
refs AS (SELECT b, count(*) AS r FROM (SELECT (SELECT count(*) FROM inner_edges WHERE x <= p) AS b FROM rf) GROUP BY b),
shift AS (SELECT day, round(sum((c - r) * ln(c / r)), 6) AS psi FROM (
  SELECT stat.day, greatest(coalesce(r.r, 0) / (SELECT count(*) FROM rf), 1e-4) AS r, greatest(coalesce(w.c, 0) / stat.n, 1e-4) AS c
  FROM stat CROSS JOIN spine LEFT JOIN (SELECT dd, b, count(*) AS c FROM binned GROUP BY dd, b) w ON w.dd = stat.day AND w.b = spine.b LEFT JOIN refs r ON r.b = spine.b) GROUP BY day),
there AS (SELECT lg.day + 1 AS day, f.field, avg(CAST(f.v IS NOT NULL AS INTEGER)) AS share FROM lg, LATERAL (VALUES ('amount', CAST(amount AS VARCHAR)), ('hour', CAST(hour AS VARCHAR)), ('p', CAST(p AS VARCHAR)), ('email', email), ('device', device)) f(field, v) GROUP BY ALL),
feeds AS (SELECT day, string_agg(field, ',' ORDER BY field) AS alerts FROM there JOIN (SELECT field, 1 - then_ AS usual FROM rfields) USING (field) WHERE usual >= 0.05 AND share < 0.5 * usual GROUP BY day),
line AS (
  SELECT day, n AS transactions, round(rate, 6) AS alert_rate, round(rate / u - 1, 6) AS alert_rate_change, abs(round(rate / u - 1, 6)) >= 0.02 AS alert_rate_warn, psi AS score_psi,
    CASE WHEN psi >= 0.02 THEN 'alert' WHEN psi >= 0.005 THEN 'warn' ELSE 'ok' END AS score_status, coalesce(drifted_fields, '') AS drifted_fields, drifted_share, drifted_share >= 0.2 AS input_drift_warn, coalesce(alerts, '') AS feed_alerts
  FROM stat JOIN shift USING (day) JOIN (SELECT day, string_agg(CASE WHEN drifted THEN field END, ',' ORDER BY field) AS drifted_fields, round(avg(CAST(drifted AS INTEGER)), 6) AS drifted_share FROM drift GROUP BY day) USING (day)
  LEFT JOIN feeds USING (day), usual)"""


@query("agg_33_daily_monitor", _silent_sql("SELECT * FROM line", "acts", more=_TIMELINE))
def daily_monitor(spark, sf_dir):
    """Each day's week before it: rows, alert rate and its change, how far scores have moved, drifted inputs; and the fields that were silent on the day before."""
    log = decisions(spark, sf_dir)
    return monitoring.timeline(log, log.filter("split = 'train'"), NUMBERS, LEVELS, SHORT)


@query("win_18_alert_runs", _silent_sql("""
SELECT kind, min(day) AS first_day, count(*) AS days FROM (SELECT kind, day, day - row_number() OVER (PARTITION BY kind ORDER BY day) AS island FROM (
  SELECT 'alert rate' AS kind, day FROM line WHERE alert_rate_warn UNION ALL SELECT 'scores', day FROM line WHERE score_status = 'alert' UNION ALL SELECT 'inputs', day FROM line WHERE input_drift_warn UNION ALL SELECT 'feed', day FROM line WHERE feed_alerts <> ''))
GROUP BY kind, island""", "acts", more=_TIMELINE))
def alert_runs(spark, sf_dir):
    """Runs of consecutive days of each kind of alert: where they begin and how long they last. One row per day and kind is all that is ordered."""
    kinds = {"alert rate": F.col("alert_rate_warn"), "scores": F.col("score_status") == "alert", "inputs": F.col("input_drift_warn"), "feed": F.col("feed_alerts") != ""}
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), c.alias("on")) for k, c in kinds.items()]))
    flags = daily_monitor(spark, sf_dir).select("day", each.alias("x")).filter("x.on").select("day", "x.kind")
    return monitoring.runs(flags, "kind").groupBy("kind", "first_day").agg(F.max("run").cast("long").alias("days"))


#: Labels come three days after their transactions, so the last ones come on day 34.
THROUGH = 35
_COHORTS = _LOG + f""",
known_on AS (SELECT d.day AS dd, lg.day // 7 AS cohort, p, action, amount, CASE WHEN t + {3 * DAY} < d.day * {DAY} THEN label END AS seen FROM lg, (SELECT unnest(range(0, {THROUGH + 1})) AS day) d),
curve AS (SELECT dd, cohort, pos, sum(pos) OVER w AS tp, sum(n) OVER w AS upto, sum(pos) OVER (PARTITION BY dd, cohort) AS pp
  FROM (SELECT dd, cohort, p, sum(seen) AS pos, count(*) AS n FROM known_on WHERE seen IS NOT NULL GROUP BY dd, cohort, p) WINDOW w AS (PARTITION BY dd, cohort ORDER BY p DESC)),
ap AS (SELECT dd, cohort, round(sum(pos / nullif(pp, 0) * tp / upto), 6) AS pr_auc FROM curve GROUP BY dd, cohort),
cohorts AS (
  SELECT dd AS day, cohort, count(*) AS transactions, count(seen) AS labelled, count(*) = count(seen) AS complete, CASE WHEN sum(seen) > 0 THEN round(avg(seen), 6) END AS fraud_rate, any_value(pr_auc) AS pr_auc,
    CASE WHEN sum(seen) > 0 THEN round(sum(CASE WHEN seen = 1 AND action = 'decline' THEN CAST(amount AS DOUBLE) WHEN seen = 1 AND action = 'review' THEN 0.9 * CAST(amount AS DOUBLE) ELSE 0 END) / sum(CASE WHEN seen = 1 THEN CAST(amount AS DOUBLE) END), 6) END AS value_caught
  FROM known_on LEFT JOIN ap USING (dd, cohort) GROUP BY dd, cohort)"""


def _cohorts(log: DataFrame) -> DataFrame:
    return monitoring.cohorts_by_day(log, lake.LABEL_DELAY, THROUGH)


@query("agg_14_cohorts", _silent_sql("SELECT * FROM cohorts", "acts", more=_COHORTS))
def cohorts(spark, sf_dir):
    """Weekly cohorts as seen at the start of every day: labels count once they have come, ranking and value caught are those of the known rows, and a cohort is complete with all of them."""
    return _cohorts(decisions(spark, sf_dir))


@query("ml_12_retrain_decision", _silent_sql("""
SELECT retrain_day, reason, first_feed_day, first_feed_alerts FROM (
  SELECT min({'d': day, 'k': rank, 'r': reason}) AS m FROM (
    SELECT day, -1 AS rank, 'score drift with input drift' AS reason FROM (
      SELECT day, input_drift_warn, row_number() OVER (PARTITION BY island ORDER BY day) AS run FROM (SELECT day, input_drift_warn, day - row_number() OVER (ORDER BY day) AS island FROM line WHERE score_status = 'alert')) WHERE run >= 3 AND input_drift_warn
    UNION ALL SELECT day, cohort, 'performance alert on cohort ' || cohort FROM cohorts, base WHERE complete AND pr_auc IS NOT NULL AND (pr_auc < 0.8 * base_pr OR value_caught <= base_value - 0.1))) a,
  LATERAL (SELECT m.d AS retrain_day, m.r AS reason),
  (SELECT min(day) AS first_feed_day, min_by(feed_alerts, day) AS first_feed_alerts FROM line WHERE feed_alerts <> '') b""", "acts", more=_TIMELINE + "," + _COHORTS.removeprefix(_LOG + ",") + """,
rcurve AS (SELECT pos, sum(pos) OVER w AS tp, sum(n) OVER w AS upto, sum(pos) OVER () AS pp FROM (SELECT p, sum(label) AS pos, count(*) AS n FROM rf GROUP BY p) WINDOW w AS (ORDER BY p DESC)),
base AS (SELECT (SELECT round(sum(pos / pp * tp / upto), 6) FROM rcurve) AS base_pr,
  (SELECT round(sum(CASE WHEN label = 1 AND action = 'decline' THEN CAST(amount AS DOUBLE) WHEN label = 1 AND action = 'review' THEN 0.9 * CAST(amount AS DOUBLE) ELSE 0 END) / sum(CASE WHEN label = 1 THEN CAST(amount AS DOUBLE) END), 6) FROM rf) AS base_value)"""))
def retrain(spark, sf_dir):
    """The first day that calls for retraining, by scores and inputs or by a complete cohort, and why; and the first silent feed."""
    log = decisions(spark, sf_dir)
    reference = log.filter("split = 'train'")
    daily = settled(monitoring.timeline(log, reference, NUMBERS, LEVELS, SHORT))
    return monitoring.retraining(daily, _cohorts(log), monitoring.performance(reference), SHORT)

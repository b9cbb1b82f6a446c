"""Queries over history features, their checks, and other window functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import history
from ..operators.history import FEATURES, Feature
from ..sources import lake
from .registry import query, sql

H, D = 3600, 86400


def _features(name: str, *wanted: Feature, source=lake.txn, digits: int = 6):
    def run(spark, sf_dir: str) -> DataFrame:
        out = history.add_history(source(spark, sf_dir), wanted)
        return out.select("id", *[F.round(f.name, digits).alias(f.name) if f.kind in ("sum", "zscore", "ratio", "known_rate", "prior_mean") else F.col(f.name) for f in wanted])

    return run


def _over(entity: str, low: str, high: str = "1 PRECEDING") -> str:
    return f"OVER (PARTITION BY {entity} ORDER BY t RANGE BETWEEN {low} PRECEDING AND {high})"


def _keyed(entity: str, value: str) -> str:
    return f"CASE WHEN {entity} IS NOT NULL THEN {value} END"


ALL = "UNBOUNDED"

query("win_1_windowed_counts", sql(f"""
SELECT id, count(*) {_over('card', H)} AS card_txn_1h, count(*) {_over('card', D)} AS card_txn_24h, count(*) {_over('card', 7 * D)} AS card_txn_7d, count(*) {_over('card', 30 * D)} AS card_txn_30d FROM txn""", "txn"))(
    _features("counts", *FEATURES[:4]))
query("win_1_hot_key_counts", sql(f"SELECT id, count(*) {_over('email', 7 * D)} AS email_txn_7d FROM txn", "txn"))(_features("email", FEATURES[16]))
query("win_1_tied_counts", sql(f"SELECT id, count(*) {_over('card', D)} AS n FROM gappy", "gappy"))(_features("tied", Feature("n", "card", "count", D), source=lake.gappy))
query("win_1_order_counts", sql("""
SELECT o_orderkey AS id, count(*) OVER (PARTITION BY o_custkey ORDER BY CAST(epoch(o_orderdate) AS BIGINT) RANGE BETWEEN 31536000 PRECEDING AND 1 PRECEDING) AS n FROM orders"""))(
    _features("orders", Feature("n", "card", "count", 365 * D), source=lake.order_txn))
query("win_2_prior_counts", sql(f"SELECT id, count(*) {_over('card', ALL)} AS card_txn_prior FROM txn", "txn"))(_features("prior", FEATURES[4]))
query("win_3_windowed_sums", sql(f"""
SELECT id, round(CAST(coalesce(sum(amount) {_over('card', D)}, 0) AS DOUBLE), 6) AS card_amt_24h, round(CAST(coalesce(sum(amount) {_over('card', 7 * D)}, 0) AS DOUBLE), 6) AS card_amt_7d FROM txn""", "txn"))(_features("sums", *FEATURES[5:7]))
query("win_4_windowed_distinct", sql(f"""
SELECT id, count(DISTINCT device) {_over('card', 30 * D)} AS card_devices_30d, count(DISTINCT email) {_over('card', 30 * D)} AS card_emails_30d FROM txn""", "txn"))(_features("distinct", *FEATURES[10:12]))
query("win_4_distinct_cards_of_a_device", sql(f"SELECT id, {_keyed('device', f'count(DISTINCT card) {_over("device", 7 * D)}')} AS device_cards_7d FROM gappy", "gappy"))(
    _features("devices", FEATURES[15], source=lake.gappy))
query("win_5_seconds_since_previous", sql(f"SELECT id, t - max(t) {_over('card', ALL)} AS card_secs_since_prev FROM txn", "txn"))(_features("since", FEATURES[7]))
query("win_6_amount_zscore", sql("""
SELECT id, CASE WHEN n >= 2 AND sd > 1e-9 THEN round((CAST(amount AS DOUBLE) - m) / sd, 4) END AS card_amt_zscore
FROM (SELECT id, amount, count(*) OVER w AS n, avg(CAST(amount AS DOUBLE)) OVER w AS m, stddev_samp(CAST(amount AS DOUBLE)) OVER w AS sd FROM txn
      WINDOW w AS (PARTITION BY card ORDER BY t RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""", "txn"))(_features("zscore", FEATURES[8], digits=4))
query("win_7_amount_ratio", sql(f"""
SELECT id, CASE WHEN s > 0 THEN round(CAST(amount AS DOUBLE) / (CAST(s AS DOUBLE) / n), 6) END AS card_amt_ratio
FROM (SELECT id, amount, sum(amount) {_over('card', ALL)} AS s, count(*) {_over('card', ALL)} AS n FROM txn)""", "txn"))(_features("ratio", FEATURES[9]))
query("win_8_new_values", sql("""
SELECT id, CASE WHEN device IS NOT NULL THEN CAST(t = min(t) OVER (PARTITION BY card, device) AS INTEGER) END AS card_new_device,
       CASE WHEN email IS NOT NULL THEN CAST(t = min(t) OVER (PARTITION BY card, email) AS INTEGER) END AS card_new_email FROM gappy""", "gappy"))(_features("new", *FEATURES[12:14], source=lake.gappy))
query("win_9_known_adverse_labels", sql(f"SELECT id, coalesce(CAST(sum(label) {_over('card', ALL, f'{3 * D + 1} PRECEDING')} AS BIGINT), 0) AS card_known_chargebacks FROM txn", "txn"))(_features("known", FEATURES[17]))
query("win_10_known_labelled_rows", sql(f"SELECT id, count(*) {_over('card', ALL, f'{3 * D + 1} PRECEDING')} AS card_known_labelled FROM txn", "txn"))(_features("labelled", FEATURES[18]))
query("win_11_known_adverse_rate", sql(f"""
SELECT id, round(CAST(s AS DOUBLE) / n, 6) AS card_known_fraud_rate
FROM (SELECT id, sum(label) {_over('card', ALL, f'{3 * D + 1} PRECEDING')} AS s, nullif(count(*) {_over('card', ALL, f'{3 * D + 1} PRECEDING')}, 0) AS n FROM txn)""", "txn"))(_features("rate", FEATURES[19]))
query("win_12_null_entity", sql(f"SELECT id, {_keyed('device', 'count(*) ' + _over('device', D))} AS device_txn_24h FROM gappy", "gappy"))(_features("null", FEATURES[14], source=lake.gappy))
query("win_15_prior_means", sql(f"""
SELECT id, round(CAST(s AS DOUBLE) / n, 6) AS prior_amount
FROM (SELECT id, sum(amount) {_over('email', ALL)} AS s, nullif(count(amount) {_over('email', ALL)}, 0) AS n FROM gappy)""", "gappy"))(_features("means", Feature("prior_amount", "email", "prior_mean"), source=lake.gappy))
query("win_16_prior_known_counts", sql(f"""
SELECT id, {_keyed('device', f'count(*) ' + _over('device', ALL, f'{D + 1} PRECEDING'))} AS known_rows, {_keyed('device', 'coalesce(CAST(sum(label) ' + _over('device', ALL, f'{D + 1} PRECEDING') + ' AS BIGINT), 0)')} AS known_positives FROM gappy""", "gappy"))(
    _features("counts", Feature("known_rows", "device", "known_all", None, "label", D), Feature("known_positives", "device", "known", None, "label", D), source=lake.gappy))


TWENTY = sql(f"""
SELECT id, count(*) {_over('card', H)} AS card_txn_1h, count(*) {_over('card', D)} AS card_txn_24h, count(*) {_over('card', 7 * D)} AS card_txn_7d, count(*) {_over('card', 30 * D)} AS card_txn_30d, n AS card_txn_prior,
  round(CAST(coalesce(sum(amount) {_over('card', D)}, 0) AS DOUBLE), 6) AS card_amt_24h, round(CAST(coalesce(sum(amount) {_over('card', 7 * D)}, 0) AS DOUBLE), 6) AS card_amt_7d,
  t - max(t) {_over('card', ALL)} AS card_secs_since_prev, CASE WHEN n >= 2 AND sd > 1e-9 THEN round((CAST(amount AS DOUBLE) - m) / sd, 4) END AS card_amt_zscore, CASE WHEN s > 0 THEN round(CAST(amount AS DOUBLE) / (CAST(s AS DOUBLE) / n), 6) END AS card_amt_ratio,
  count(DISTINCT device) {_over('card', 30 * D)} AS card_devices_30d, count(DISTINCT email) {_over('card', 30 * D)} AS card_emails_30d,
  CAST(t = min(t) OVER (PARTITION BY card, device) AS INTEGER) AS card_new_device, CAST(t = min(t) OVER (PARTITION BY card, email) AS INTEGER) AS card_new_email,
  count(*) {_over('device', D)} AS device_txn_24h, count(DISTINCT card) {_over('device', 7 * D)} AS device_cards_7d, count(*) {_over('email', 7 * D)} AS email_txn_7d,
  coalesce(k, 0) AS card_known_chargebacks, kn AS card_known_labelled, round(CAST(k AS DOUBLE) / nullif(kn, 0), 6) AS card_known_fraud_rate
FROM (SELECT *, count(*) {_over('card', ALL)} AS n, sum(amount) {_over('card', ALL)} AS s, avg(CAST(amount AS DOUBLE)) {_over('card', ALL)} AS m, stddev_samp(CAST(amount AS DOUBLE)) {_over('card', ALL)} AS sd,
        CAST(sum(label) {_over('card', ALL, f'{3 * D + 1} PRECEDING')} AS BIGINT) AS k, count(*) {_over('card', ALL, f'{3 * D + 1} PRECEDING')} AS kn FROM txn)""", "txn")


def rounded(df: DataFrame) -> DataFrame:
    """The features to the digits that SQL and Spark share."""
    digits = {"sum": 6, "zscore": 4, "ratio": 6, "known_rate": 6}
    return df.select("id", *[F.round(f.name, digits[f.kind]).alias(f.name) if f.kind in digits else F.col(f.name) for f in FEATURES])


@query("features_all_twenty", TWENTY)
def all_features(spark, sf_dir):
    """All twenty in one plan."""
    return rounded(history.add_history(lake.txn(spark, sf_dir)))


CARD = tuple(f for f in FEATURES if f.entity == "card")
_CHECKED = ",".join(f"('{f.name}')" for f in FEATURES)


def _check(spark, sf_dir, leaky: bool, wanted=CARD) -> DataFrame:
    df = lake.gappy(spark, sf_dir)
    ids = history.sample_rows(df)
    got = history.long_form(history.add_history(df, wanted, leaky=leaky).join(ids, "id", "left_semi"), [f.name for f in wanted])
    return history.differences(history.recompute(df, ids, wanted), got)


_SAMPLE = f"""
top AS (SELECT card FROM (SELECT card, count(*) AS n FROM txn GROUP BY card) ORDER BY n DESC, card LIMIT 20),
sampled AS (SELECT id FROM txn WHERE id % 50 = 0 UNION SELECT id FROM txn WHERE label = 1 UNION SELECT id FROM txn WHERE card IN (SELECT card FROM top))"""


@query("ver_1_point_in_time_check", sql(f"SELECT feature, (SELECT count(*) FROM sampled) AS rows, 0 AS different FROM (VALUES {_CHECKED}) v(feature)", "gappy", more=_SAMPLE))
def point_in_time(spark, sf_dir):
    """All twenty features against a range self-join over hourly ties: no differences."""
    return _check(spark, sf_dir, leaky=False, wanted=FEATURES)


def _leaks(value: str, low: str = ALL, empty: str = "0") -> str:
    return f"coalesce({value} {_over('card', low)}, {empty}) <> coalesce({value} {_over('card', low, 'CURRENT ROW')}, {empty})"


_LEAKS = ", ".join(f"count(*) FILTER (l{k}) > 0" for k in range(9))
_LEAK_COLUMNS = ", ".join(f"{x} AS l{k}" for k, x in enumerate([
    *[_leaks("count(*)", w) for w in (H, D, 7 * D, 30 * D, ALL)], _leaks("sum(amount)", D), _leaks("sum(amount)", 7 * D), _leaks("max(t)", empty="-1"),
    "device IS NOT NULL AND t = min(t) OVER (PARTITION BY card, device)",
]))


@query("ver_2_leak_canary", sql(f"""
SELECT 'every count, gap and label feature' AS found, list_bool_and([{_LEAKS}]) AS caught FROM (SELECT * FROM (SELECT id, {_LEAK_COLUMNS} FROM gappy) WHERE id IN (SELECT id FROM sampled))""", "gappy", more=_SAMPLE))
def canary(spark, sf_dir):
    """Frames that see their own second must be found by the same check."""
    must = ["card_txn_1h", "card_txn_24h", "card_txn_7d", "card_txn_30d", "card_txn_prior", "card_amt_24h", "card_amt_7d", "card_secs_since_prev", "card_new_device"]
    bad = _check(spark, sf_dir, leaky=True).filter(F.col("feature").isin(must) & (F.col("different") > 0))
    return bad.agg((F.count("*") == len(must)).alias("caught")).select(F.lit("every count, gap and label feature").alias("found"), "caught")


@query("ver_4_differences_by_feature", sql(f"""
SELECT 'card_txn_24h' AS feature, count(*) AS rows, CAST(sum(CAST(strict <> leaky AS INTEGER)) AS BIGINT) AS different
FROM (SELECT count(*) {_over('card', D)} AS strict, count(*) {_over('card', D, 'CURRENT ROW')} AS leaky FROM gappy)""", "gappy"))
def by_feature(spark, sf_dir):
    df, f = lake.gappy(spark, sf_dir), FEATURES[1:2]
    return history.differences(history.long_form(history.add_history(df, f), ["card_txn_24h"]), history.long_form(_leaky_24h(df), ["card_txn_24h"]))


def _leaky_24h(df: DataFrame) -> DataFrame:
    w = Window.partitionBy("card").orderBy("t").rangeBetween(-D, 0)
    return df.select("id", F.count("*").over(w).alias("card_txn_24h"))


@query("jn_10_range_self_join", sql(f"""
SELECT a.id, count(b.id) AS n, round(CAST(coalesce(sum(b.amount), 0) AS DOUBLE), 6) AS spent
FROM txn a LEFT JOIN txn b ON a.card = b.card AND b.t < a.t AND b.t >= a.t - {D} WHERE a.id IN (SELECT id FROM sampled) GROUP BY a.id""", "txn", more=_SAMPLE))
def range_join(spark, sf_dir):
    df = lake.txn(spark, sf_dir)
    long = history.recompute(df, history.sample_rows(df), (Feature("n", "card", "count", D), Feature("spent", "card", "sum", D)))
    return long.groupBy("id").pivot("feature", ["n", "spent"]).agg(F.first("value")).select("id", F.col("n").cast("long").alias("n"), F.round("spent", 6).alias("spent"))


@query("jn_5_as_of_known_positives", sql(f"""
SELECT q.id, coalesce(h.positives, 0) AS positives
FROM txn q ASOF LEFT JOIN (SELECT card, t, CAST(max(c) AS BIGINT) AS positives FROM (SELECT card, t, sum(label) OVER (PARTITION BY card ORDER BY t) AS c FROM txn) GROUP BY card, t) h
ON q.card = h.card AND q.t - {3 * D} > h.t""", "txn"))
def as_of(spark, sf_dir):
    """Backward, strict, by key: the cumulative count of positives as it stood at t - delay."""
    out = history.add_history(lake.txn(spark, sf_dir), (Feature("positives", "card", "known", None, "label", 3 * D),))
    return out.select("id", "positives")


@query("ml_8_candidate_columns", sql(f"""
SELECT id, day - CAST(device AS INTEGER) AS normalised_day, round(CAST(s AS DOUBLE) / nullif(n, 0), 6) AS prior_amount, k AS known_rows
FROM (SELECT *, sum(amount) {_over('card', ALL)} AS s, count(*) {_over('card', ALL)} AS n, count(*) {_over('card', ALL, f'{3 * D + 1} PRECEDING')} AS k FROM txn)""", "txn"))
def candidates(spark, sf_dir):
    out = history.add_history(lake.txn(spark, sf_dir), (Feature("prior_amount", "card", "prior_mean"), Feature("known_rows", "card", "known_all", None, "label", 3 * D)))
    return out.select("id", (F.col("day") - F.col("device").cast("int")).alias("normalised_day"), F.round("prior_amount", 6).alias("prior_amount"), "known_rows")


@query("srt_5_verification_sample", sql("SELECT id FROM sampled", "txn", more=_SAMPLE))
def verification_sample(spark, sf_dir):
    return history.sample_rows(lake.txn(spark, sf_dir))


@query("jn_4_semi_join_on_sample", sql("SELECT t.id, t.card, t.amount::DOUBLE AS amount FROM txn t WHERE id IN (SELECT id FROM sampled)", "txn", more=_SAMPLE))
def semi_join(spark, sf_dir):
    df = lake.txn(spark, sf_dir)
    return df.join(history.sample_rows(df), "id", "left_semi").select("id", "card", F.col("amount").cast("double").alias("amount"))


@query("set_1_union_distinct", sql("SELECT id FROM txn WHERE id % 7 = 0 UNION SELECT id FROM txn WHERE label = 1", "txn"))
def union_distinct(spark, sf_dir):
    df = lake.txn(spark, sf_dir)
    return df.filter("id % 7 = 0").select("id").unionByName(df.filter("label = 1").select("id")).dropDuplicates(["id"])


@query("prj_23_tolerant_equality", sql("SELECT count(*) AS rows, count(*) FILTER (label = 1) AS near, count(*) FILTER (device IS NULL) AS both_missing FROM gappy", "gappy"))
def tolerant(spark, sf_dir):
    """Values moved by less than the tolerance are equal, positives' by more aren't; missing equals missing."""
    df = lake.gappy(spark, sf_dir)
    a = F.col("amount").cast("double") + 1
    same = history.close(a, F.when(F.col("label") == 1, a * (1 + 1e-3)).otherwise(a * (1 + 1e-8)), 1e-6)
    none = history.close(F.col("device").cast("double"), F.col("device").cast("double"), 1e-6) & F.col("device").isNull()
    return df.agg(F.count("*").alias("rows"), F.sum((~same).cast("long")).alias("near"), F.sum(none.cast("long")).alias("both_missing"))

"""Every query with SQL against DuckDB on the smallest tables; the others by what must hold."""

import math
from dataclasses import replace

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import history, metrics, policy, tables
from tidemark.plans import catalog
from tidemark.sources import lake

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, bool):
        return v
    try:
        return round(float(v), 5)
    except (TypeError, ValueError):
        return str(v)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    got = con.execute(SQL[name])
    names = [d[0] for d in got.description]
    assert sorted(names) == sorted(df.columns)
    order = lambda rows: sorted(rows, key=str)
    want = order(tuple(plain(v) for v in r) for r in got.fetchall())
    assert order(tuple(plain(r[n]) for n in names) for r in df.collect()) == want and want


def test_every_query_has_rows(spark, sf):
    for name in ("pol_5_tune_expected_loss", "pol_6_tune_cutoffs", "ml_1_linear_model", "met_7_choose_calibration"):
        assert QUERIES[name](spark, sf).count() > 0


def test_tuning_returns_the_cheapest(spark, sf):
    df = policy.priced(policy.scored(lake.txn(spark, sf))).filter("split = 'valid'")
    trials = policy.tune_expected_loss(df, n=6).collect()
    for t in trials[:3]:
        alone = policy.expected_loss(df, t.threshold, policy.Costs()).agg(policy.realised()[0].alias("c")).first().c
        assert abs(alone - t.total_cost) < 0.01


def test_calibration_choice(spark, sf):
    rows = QUERIES["met_7_choose_calibration"](spark, sf).collect()
    assert all((r.test_brier is not None) == r.chosen for r in rows)  # the chosen one is fitted anew on all rows
    assert len(rows) == 3 and sum(r.chosen for r in rows) == 1 and min(rows, key=lambda r: r.brier).brier == next(r.brier for r in rows if r.chosen)


def test_header_contract(spark, tmp_path):
    at = str(tmp_path / "x")
    spark.createDataFrame([("1", "2")], "a string, b string").write.option("header", True).csv(at)
    assert lake.read_csv(spark, at, ["a", "b"]).count() == 1
    with pytest.raises(lake.HeaderError):
        lake.read_csv(spark, at, ["a", "c"])


def test_checks_fail_by_name(spark):
    df = spark.createDataFrame([(1, None), (1, "x")], "k int, v string")
    with pytest.raises(tables.QualityError, match="v_missing"):
        tables.enforce(tables.run_checks(df, {"v_missing": df.v.isNull(), "k_missing": df.k.isNull()}), "typed")


def test_held_out_needs_a_purpose(spark, sf):
    with pytest.raises(ValueError):
        lake.load_frame(spark, sf, ("test",), ("amount",), "")


def test_edges_of_a_window(spark):
    rows = [(1, 0, "c", 10.0), (2, 100, "c", 10.0), (3, 100, "c", 10.0), (4, 3700, "c", 10.0), (5, 3701, "c", 1.0), (6, 5, None, 1.0)]
    df = spark.createDataFrame(rows, "id long, t long, card string, amount double").selectExpr("id", "t", "card", "CAST(amount AS DECIMAL(18,2)) AS amount")
    got = {r.id: (r.n, r.s) for r in history.add_history(df, (history.Feature("n", "card", "count", 3600), history.Feature("s", "card", "sum", 3600))).collect()}
    assert got == {1: (0, 0.0), 2: (1, 10.0), 3: (1, 10.0), 4: (2, 20.0), 5: (1, 10.0), 6: (None, None)}


def test_tuning_grids_are_whole(spark, sf):
    df = policy.priced(policy.scored(lake.txn(spark, sf))).filter("split = 'valid'")
    rows = df.select("p", "priority").toPandas()
    quantiles = lambda v, n: sorted({round(float(x), 6) for x in np.quantile(v, np.linspace(0, 1, n))})
    thresholds = sorted(r.threshold for r in QUERIES["pol_5_tune_expected_loss"](spark, sf).collect())
    assert thresholds == pytest.approx([0.0, *quantiles(rows.priority[rows.priority > 0], 60)], abs=2e-6)
    n = len(quantiles(rows.p[rows.p >= round(np.quantile(rows.p, 0.9), 6)], 40)) + 1
    pairs = [(r.decline_at, r.review_at) for r in QUERIES["pol_6_tune_cutoffs"](spark, sf).collect()]
    assert len(pairs) == len({*pairs}) == n * (n + 1) // 2 and all(r <= d for d, r in pairs)


def test_sensitivity_takes_the_cheapest_of_sixty(spark, sf):
    got = {(r.parameter, r.value): r.threshold for r in QUERIES["agg_12_sensitivity"](spark, sf).collect()}
    scored = policy.scored(lake.txn(spark, sf)).filter("split = 'valid'").cache()
    for name in ("fee", "capacity"):
        for end in policy.RANGES[name]:
            c = replace(policy.Costs(), **{name: end})
            assert got[name, float(end)] == policy.cheapest(policy.tune_expected_loss(policy.priced(scored, c), c, 60), "threshold").first().threshold


def test_experiments_have_a_verdict(spark, sf):
    rows = {r.variant: r for r in QUERIES["ml_7_experiments"](spark, sf).collect()}
    assert set(rows) == {"baseline", "no category", "recent days", "weighted", "readable", "trees", "block list"}
    for r in rows.values():
        assert r.low <= r.high and r.saving == pytest.approx(rows["baseline"].cost - r.cost, abs=0.05)
        assert r.adopted == (r.saving > 0 and r.low > 0)
    assert not rows["baseline"].adopted and rows["baseline"].low == rows["baseline"].high == 0


def test_adversarial_names_inputs(spark, sf):
    r = QUERIES["ml_9_adversarial_validation"](spark, sf).first()
    assert 0 <= r.auc <= 1 and len(r.top.split(",")) <= 5


def test_input_drift_of_empty_and_constant_fields(spark):
    frame = lambda rows: spark.createDataFrame(rows, "n double, c string")
    got = {r.field: r for r in metrics.input_drift(frame([(1.0, None), (1.0, "a")]), frame([(1.0, None), (1.0, None)]), ("n",), ("c",)).collect()}
    assert got["n"].distance is None and not got["n"].drifted  # a reference without spread has no distance
    assert got["c"].drifted and got["c"].missing_shift == 0.5 and got["c"].drifted_share == 0.5
    nothing = metrics.input_drift(frame([]), frame([]), ("n",), ("c",)).collect()
    assert [r.drifted for r in nothing] == []


def test_rolling_comparison_has_a_best_setting(spark, sf):
    rows = QUERIES["ml_6_rolling_comparison"](spark, sf).collect()
    for library in ("linear", "boosted"):
        own = [r for r in rows if r.library == library]
        mean = {s: np.mean([r.pr_auc for r in own if r.setting == s]) for s in {r.setting for r in own}}
        (best,) = {r.setting for r in own if r.best}
        assert len(own) == 4 and mean[best] == max(mean.values())
    for fold in {r.fold for r in rows}:
        base, other = (next(r for r in rows if r.fold == fold and r.best and r.library == x) for x in ("linear", "boosted"))
        assert base.pr_auc_gap == base.cost_gap == 0 and abs(other.cost_gap - (other.total_cost - base.total_cost)) < 1e-4
        assert [r.total_cost for r in rows if r.fold == fold and r.cheapest] == [min(r.total_cost for r in rows if r.fold == fold)]


def test_broker_options():
    from tidemark.streaming import landing

    got = landing.broker_options("host:9092", ("a", "b"), 500)
    assert got == {"kafka.bootstrap.servers": "host:9092", "subscribe": "a,b", "startingOffsets": "earliest", "failOnDataLoss": "true", "maxOffsetsPerTrigger": "500"}
    assert "maxOffsetsPerTrigger" not in landing.broker_options("host:9092", ("a",))


def test_messages_of_a_broker(spark):
    """Rows as a broker's reader has them, whose key and value are bytes, become messages."""
    from tidemark.streaming import landing

    raw = spark.createDataFrame([(bytearray(b"7"), bytearray(b"{}"), "a", 2, 5, 0)], "key binary, value binary, topic string, partition int, offset long, timestampType int").selectExpr("*", "timestamp_seconds(9) AS timestamp")
    df = landing.as_messages(raw)
    assert df.columns == list(landing.COLUMNS) and [(r.key, r.value, r.topic, r.partition, r.offset) for r in df.collect()] == [("7", "{}", "a", 2, 5)]


def test_slots_of_a_day_leave_the_first_that_ask(spark, sf, monkeypatch):
    """Any number of slots gives the day's first askers their reviews."""
    from tidemark.streaming import features

    want = {r.id: r.action for r in QUERIES["str_9_daily_budget"](spark, sf).collect()}
    monkeypatch.setattr(features, "SPREAD", 1)
    assert {r.id: r.action for r in QUERIES["str_9_daily_budget"](spark, sf).collect()} == want


@pytest.mark.parametrize("heavy", [2, 40])
def test_heavy_entities_have_the_same_features(spark, sf, monkeypatch, heavy):
    """Entities cut into buckets of time, on top of earlier totals, or not: the same features, also of missing entities and of rows whose ids repeat."""
    df = lake.gappy(spark, sf).limit(400).withColumn("email", F.when(F.col("id") % 5 > 0, F.col("email")))
    key = lambda rows: sorted((tuple(plain(v) for v in r) for r in rows), key=str)
    want = key(history.add_history(df, leaky=False).select("t", "card", "device", *[f.name for f in history.FEATURES]).collect())
    monkeypatch.setattr(history, "HEAVY", heavy)
    got = history.add_history(df.withColumn("id", F.lit(1))).select("t", "card", "device", *[f.name for f in history.FEATURES]).collect()
    assert key(got) == want and len(want) == 400


def test_warm_state_of_a_key_may_come_in_pieces(spark, sf, con):
    """A key's state from the table counts in whole, however many rows of it a task gets at a time."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        got = QUERIES["str_8_state_warm_up"](spark, sf).select("id", "email_txn_7d", "device_cards_7d").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    want = con.execute(f"SELECT id, email_txn_7d, device_cards_7d FROM ({SQL['str_8_state_warm_up']})").fetchall()
    assert sorted(tuple(r) for r in got) == sorted(want)


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_the_point_in_time_check_joins_each_history_once(spark, sf):
    """One range join for all features of an entity and column, over what is summed up by second."""
    df = lake.gappy(spark, sf)
    plan = plan_of(history.recompute(df, history.sample_rows(df), history.FEATURES))
    ranged = [x for x in plan.splitlines() if "Join LeftOuter" in x and " < " in x]
    assert len(ranged) == len({(f.entity, f.column) for f in history.FEATURES if f.kind != "is_new"}) == 7


def test_tuning_rules_multiplies_counts_only(spark, sf):
    lines = plan_of(QUERIES["pol_9_tune_rules"](spark, sf)).splitlines()
    crossed = [lines[k + 1] for k, x in enumerate(lines) if x.strip(" :+-").startswith(("Join Cross", "Join Inner, rightHint=(strategy=broadcast)"))]
    assert crossed and all("Aggregate" in x for x in crossed)


def test_features_and_actions_come_from_one_stream(spark, sf, monkeypatch):
    from tidemark.streaming import features

    runs, real = [], features.feature_stream
    monkeypatch.setattr(features, "feature_stream", lambda *a, **k: runs.append(a) or real(*a, **k))
    rows = QUERIES["str_10_stream_equals_batch"](spark, sf).collect()
    assert len(rows) == 23 and not any(r.different for r in rows) and len({a[1] for a in runs}) == 1

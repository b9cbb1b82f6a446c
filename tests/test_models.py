"""Models, metrics and monitoring against plain Python."""

import random

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.operators import history, metrics, models, monitoring
from tidemark.plans import learning
from tidemark.sources import lake
from tidemark.sources.store import settled


@pytest.fixture(scope="module")
def ready(spark, sf):
    return settled(models.inputs(history.add_history(lake.txn(spark, sf))))


def precision(rows):
    """Average precision over distinct scores."""
    ap, tp, n, every = 0.0, 0, 0, sum(y for _, y in rows)
    for s in sorted({s for s, _ in rows}, reverse=True):
        own = [y for x, y in rows if x == s]
        tp, n = tp + sum(own), n + len(own)
        ap += sum(own) / every * tp / n
    return ap


def test_running_totals_of_any_scores(spark, monkeypatch):
    monkeypatch.setattr(metrics, "RANGES", 5)
    rng = random.Random(3)
    rows = [(rng.choice("ab"), round(rng.choice([rng.random(), 100 * rng.random(), 0.5]), 2), int(rng.random() < 0.3), rng.randint(1, 9)) for _ in range(500)] + [("one", 1.0, 1, 2)]
    cells = metrics.by_score(spark.createDataFrame(rows, "g string, p double, label int, amount int"), "p", "g").collect()
    assert len(cells) == len({(g, p) for g, p, _, _ in rows})
    for c in cells:
        above = [r for r in rows if r[0] == c.g and r[1] >= c.s]
        assert (c.tp, c.fp, c.tv) == (sum(r[2] for r in above), sum(1 - r[2] for r in above), sum(r[2] * r[3] for r in above))


@pytest.mark.parametrize("fits", [1_000_000, 3])
def test_exact_quantiles(spark, monkeypatch, fits):
    monkeypatch.setattr(metrics, "FITS", fits)
    rng = random.Random(4)
    kinds = {"wide": lambda: rng.choice([-1, 1]) * 10 ** rng.uniform(-200, 200), "near": lambda: 1 + rng.random() * 1e-9, "ties": lambda: float(rng.choice([-2, 0, 0, 7])), "one": lambda: 5.0}
    rows = [(g, f()) for g, f in kinds.items() for _ in range(1 if g == "one" else 300)] + [("ties", None), ("none", None)]
    probs = (0.0, 0.1, 0.333, 0.5, 0.99, 1.0)
    got = {r.g: r.q for r in metrics.exact_quantiles(spark.createDataFrame(rows, "g string, x double"), "x", probs, "g").collect()}
    assert set(got) == set(kinds)
    for g in kinds:
        assert got[g] == pytest.approx(np.quantile([x for k, x in rows if k == g and x is not None], probs), rel=1e-12)


def test_the_best_of_eight(spark, ready):
    """The chosen trees are those that are best when all are fitted one by one."""
    fit_on, judged = ready.filter("split <> 'test'").withColumn("stop", F.col("split") == "valid"), ready.filter("split = 'valid'")
    pre = models.prepared(ready.filter("split = 'train'"), None)
    estimator = models.tree_estimator(rounds=3, stop_on="stop")
    grid = models.tree_grid(estimator)
    k, _, values = models.best_of(estimator, grid, settled(pre.transform(fit_on).select("features", "y", "w_1", "w_5", "stop")), settled(pre.transform(judged).select("features", "y")))
    assert len(grid) == 8
    alone = []
    for g in grid:
        scored = estimator.copy(g).fit(pre.transform(fit_on)).transform(pre.transform(judged)).select(F.round(vector_to_array("probability")[1], 9).alias("p"), "y").collect()
        alone.append(precision([(r.p, int(r.y)) for r in scored]))
    assert values == pytest.approx(alone, abs=1e-9)
    assert k == max(range(8), key=lambda j: (round(alone[j], 9), -j))


def test_grid_queries_choose_one(spark, sf):
    rows = learning.linear_grid(spark, sf).collect()
    assert len(rows) == 8 and [r.pr_auc for r in rows if r.chosen] == [max(r.pr_auc for r in rows)]


def test_contributions_add_up(spark, ready):
    train, test = ready.filter("split = 'train'"), ready.filter("split = 'test'")
    for model in (models.linear(train), models.boosted(train, depth=4, rounds=4, category=models.CATEGORY)):
        raw = {r.id: r.m for r in model.transform(test).select("id", vector_to_array("rawPrediction")[1].alias("m")).collect()}
        rows = models.contributions(model, test, train).select("*", models.reasons().alias("r")).collect()
        assert len(rows) == len(raw) > 0
        for r in rows:
            assert r.margin == pytest.approx(raw[r.id]) and r.base + sum(p.c for p in r.parts) == pytest.approx(r.margin, abs=1e-8)
            top = sorted((p for p in r.parts if p.c > 0), key=lambda p: (-p.c, p.feature))[:3]
            assert [x.reason for x in r.r] == [models.PLAIN[p.feature] for p in top]
            assert [x.contribution for x in r.r] == pytest.approx([round(p.c, 4) for p in top], abs=1e-4)
        assert len({p.feature for r in rows for p in r.parts if p.c}) > 2


def test_rare_levels_are_kept_when_saved(spark, tmp_path):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 4 + [("c",)] + [(None,)], "x string")
    fitted = Pipeline(stages=[models.RareLevels(inputCol="x", outputCol="y", least=4)]).fit(df)
    fitted.write().overwrite().save(str(tmp_path / "m"))
    more = spark.createDataFrame([("a",), ("b",), ("c",), ("unseen",), (None,)], "x string")
    for m in (fitted, PipelineModel.load(str(tmp_path / "m"))):
        assert [r.y for r in m.transform(more).collect()] == ["a", "b", "(other)", "(other)", "(missing)"]


def test_rolling_looks_back_only(spark, ready):
    lr = models.linear_estimator()
    rows = models.rolling(ready, (12,), 6, 3, {"linear": (lr, [{lr.regParam: 0.01}, {lr.regParam: 0.3}])})
    later = ready.withColumn("y", F.when(F.col("day") >= 12, 1 - F.col("y")).otherwise(F.col("y")))
    again = models.rolling(later, (12,), 6, 3, {"linear": (lr, [{lr.regParam: 0.01}, {lr.regParam: 0.3}])})
    key = lambda df: sorted((r.setting, r.calibration, r.id, r.q) for r in df.collect())
    assert key(rows) == key(again)  # labels of the scored days change nothing
    assert {r.day for r in rows.collect()} <= set(range(12, 18))


def line(spark, status, drift, feed):
    rows = [(7 + k, s, d == "1", f) for k, (s, d, f) in enumerate(zip(status, drift, feed, strict=True))]
    names = {"o": "ok", "w": "warn", "a": "alert"}
    return spark.createDataFrame([(d, names[s], x, "device" if f == "1" else "") for d, s, x, f in rows], "day long, score_status string, input_drift_warn boolean, feed_alerts string")


COHORT = "day long, cohort long, complete boolean, pr_auc double, value_caught double"


@pytest.mark.parametrize("status, drift, feed, cohorts, want", [
    ("ooaaoaaaa", "111111111", "000000000", [], (14, "score drift with input drift", None)),
    ("aaaaaa", "000010", "000100", [], (11, "score drift with input drift", 10)),
    ("aawaa", "11111", "00000", [], (None, None, None)),
    ("ooo", "000", "010", [(9, 1, True, 0.3, 0.5), (9, 0, True, 0.1, 0.5), (8, 2, False, 0.0, 0.0)], (9, "performance alert on cohort 0", 8)),
    ("aaa", "111", "000", [(9, 0, True, 0.1, 0.5)], (9, "score drift with input drift", None)),
    ("ooo", "000", "000", [(8, 3, True, 0.4, 0.4), (8, 4, True, None, None)], (8, "performance alert on cohort 3", None)),
])
def test_retraining(spark, status, drift, feed, cohorts, want):
    reference = spark.createDataFrame([(0.4, 0.5)], "pr_auc double, value_caught double")
    r = monitoring.retraining(line(spark, status, drift, feed), spark.createDataFrame(cohorts, COHORT), reference, monitoring.Limits(run=3)).first()
    assert (r.retrain_day, r.reason, r.first_feed_day) == want


def test_nothing_to_monitor(spark):
    log = spark.createDataFrame([], "id long, t long, day long, label int, amount double, p double, action string, device string")
    assert monitoring.judged_days(log, 7).count() == 0 and monitoring.cohorts_by_day(log, 3 * 86400, 9).count() == 0
    assert monitoring.timeline(log, log, ("p",), ("device",)).count() == 0


def test_fits_keep_no_vectors(spark, sf, monkeypatch):
    """What is kept of the log is its columns and features; vectors and scaled inputs follow from a row."""
    kept = []
    monkeypatch.setattr(learning, "settled", lambda df: kept.append(df.columns) or settled(df))
    learning.tuned(learning._ready(spark, sf), "linear")
    assert kept and not any(c == "features" or c.startswith(("x_", "m_")) for columns in kept for c in columns)

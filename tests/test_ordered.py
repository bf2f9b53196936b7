"""Running sums, quantiles and ROC points against sorted lists."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import audit, metrics, ordered
from corpusloom.sources import accesslog


def slow_quantile(values, p):
    values = sorted(values)
    at = (len(values) - 1) * p
    low = values[math.floor(at)]
    return low + (values[math.ceil(at)] - low) * (at - math.floor(at))


def test_running_sums(spark):
    rng = random.Random(1)
    rows = [(rng.choice("abc"), i, rng.randrange(10)) for i in range(3000)] + [(None, 1, 5), (None, 2, 6)]
    got = ordered.running_sums(spark.createDataFrame(rows, "g string, i int, n int"), ["n"], [F.desc("i")], ["g"]).collect()
    before, want = {}, {}
    for g, i, n in sorted(rows, key=lambda r: -r[1]):
        want[g, i] = before.get(g, 0)
        before[g] = before.get(g, 0) + n
    assert {(r.g, r.i): r.before_n for r in got} == want and len(got) == len(rows)


@pytest.mark.parametrize("cells", [1024, 1, 3])
def test_quantiles(spark, cells):
    rng = random.Random(2)
    rows = [(g, rng.choice([rng.random(), 0.5, 1e9, -3.0]) if g != "same" else 7.0) for g in ("a", "b", "same") for _ in range(801)]
    rows += [("few", 1.0), ("few", 2.0), ("nulls", None), ("a", None), ("a", float("nan")), (None, 4.0), (None, 6.0)]
    probs = {"least": 0.0, "q1": 0.25, "mid": 0.5, "p95": 0.95, "most": 1.0}
    got = {r.g: r for r in ordered.quantiles(spark.createDataFrame(rows, "g string, v double"), "v", probs, ["g"], cells).collect()}
    held = {}
    for g, v in rows:
        held.setdefault(g, []).extend([v] if v is not None and v == v else [])
    assert set(got) == set(held)
    for g, values in held.items():
        assert got[g].n == len(values)
        for name, p in probs.items():
            assert got[g][name] == (pytest.approx(slow_quantile(values, p), abs=1e-12) if values else None), (g, name)


def test_quantiles_of_a_whole_table(spark):
    frame = spark.range(1, 102).select(F.col("id").cast("int").alias("v"))
    assert tuple(ordered.quantiles(frame, "v", {"m": 0.5, "q": 0.25}).first()) == (101, 51.0, 26.0)
    assert tuple(ordered.quantiles(frame.limit(0), "v", {"m": 0.5}).first()) == (0, None)


def test_no_state_holds_a_group(spark):
    """One very busy endpoint: its values are dealt to many parts."""
    lines = spark.range(20000).select(F.format_string("2024-01-01 00:00:00,000 | INFO | GET /busy status=200 client=c time_ms=%.3f", F.col("id") / 7).alias("value"))
    log = accesslog.parse(lines)
    row = accesslog.endpoint_summary(log).first()
    times = sorted(float(f"{i / 7:.3f}") for i in range(20000))
    assert (row.requests, row.median_ms, row.max_ms) == (20000, pytest.approx(slow_quantile(times, 0.5)), times[-1])
    assert row.p95_ms == pytest.approx(slow_quantile(times, 0.95), abs=1e-6)
    plan = accesslog.endpoint_summary(log)._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan


def test_roc_of_close_scores(spark):
    """Scores that differ in the 9th digit are different thresholds."""
    rng = random.Random(3)
    rows = [(g, rng.choice(["fake", "real"]), 0.5 + rng.randrange(40) * 1e-9) for g in ("x", "y") for _ in range(500)] + [("one", "real", 0.1)]
    points = metrics.roc_points(spark.createDataFrame(rows, "g string, label string, score double"), by=["g"]).collect()
    area = {r.g: r.auc for r in metrics.auc(spark.createDataFrame(points), ["g"]).collect()}
    for g in ("x", "y"):
        mine = [(label, s) for k, label, s in rows if k == g]
        real, fake = ([s for label, s in mine if label == c] for c in ("real", "fake"))
        got = {r.threshold: (r.fpr, r.tpr) for r in points if r.g == g}
        assert got == {t: (sum(s >= t for s in fake) / len(fake), sum(s >= t for s in real) / len(real)) for t in {s for _, s in mine}}
        wins = sum((p > q) + 0.5 * (p == q) for p in real for q in fake)
        assert area[g] == pytest.approx(wins / len(real) / len(fake), abs=1e-15)
    assert area["one"] == 0.0


def test_describe_equals_sorting(spark):
    values = [float(x) for x in np.random.default_rng(4).integers(0, 50, 400)]
    row = audit.describe(spark.createDataFrame([(v,) for v in values], "v double"), ["v"]).first()
    assert (row["count"], row.q25, row.q50, row.q75) == (400, *[pytest.approx(slow_quantile(values, p)) for p in (0.25, 0.5, 0.75)])

"""Survival on synthetic histories with known answers."""

import datetime as dt

from rollcall.operators import survival

START = dt.datetime(2026, 1, 1)
DAYS = dt.timedelta(days=1)


def outcome(spark, checks, horizons=(30, 90), tolerance=7, **kw):
    """checks: (agent, time, live) or (agent, time, live, category)."""
    rows = [(1, a, START + at, live, *(rest or (None,))) for a, at, live, *rest in checks]
    table = spark.createDataFrame(
        rows, "run_id bigint, agent_id string, checked_at timestamp, live_strict boolean, "
              "failure_category string")
    runs = spark.createDataFrame([(1, "panel", "completed"), (2, "sweep", "completed")],
                                 "id bigint, kind string, status string")
    agents = table.select("agent_id").distinct().selectExpr(
        "agent_id", "timestamp '2025-12-01' AS registered_at")
    history = survival.panel_history(table, runs, **kw)
    return survival.agent_outcomes(history, agents, horizons, tolerance), horizons


def counts(result):
    outcomes, horizons = result
    return [(r.k, r.n) for r in survival.survival(outcomes, horizons).orderBy("horizon_days")
            .collect()]


def history():
    checks = []
    for i in range(50):
        name = f"a{i}"
        checks += [(name, 0 * DAYS, True), (name, 27 * DAYS, False), (name, 33 * DAYS, False),
                   (name, 30 * DAYS, i < 30), (name, 90 * DAYS, i < 20)]
        checks += [(f"never{i}", d * DAYS, False) for d in (0, 30, 90)]
    return checks


def test_published_check(spark):
    assert counts(outcome(spark, history())) == [(30, 50), (20, 50)]


def test_window_edges(spark):
    second = dt.timedelta(seconds=1)
    checks = []
    for name, at in [("in7", 23 * DAYS), ("out7", 23 * DAYS - second),
                     ("in23h", 37 * DAYS + 23 * 3600 * second), ("out8", 38 * DAYS)]:
        checks += [(name, 0 * DAYS, True), (name, at, True)]
    outcomes, _ = outcome(spark, checks, (30,))
    assert {r.agent_id for r in outcomes.collect()} == {"in7", "in23h"}


def test_equally_near(spark):
    checks = [("a", 0 * DAYS, True), ("a", 28 * DAYS, True), ("a", 32 * DAYS, False),
              ("b", 0 * DAYS, True), ("b", 30 * DAYS, True), ("b", 30 * DAYS, False)]
    outcomes, _ = outcome(spark, checks, (30,))
    assert {r.agent_id: r.survived for r in outcomes.collect()} == {"a": True, "b": False}


def test_censoring(spark):
    checks = [("a", 0 * DAYS, True), ("a", 30 * DAYS, False, "undetermined"),
              ("a", 31 * DAYS, True)]
    assert counts(outcome(spark, checks, (30,))) == [(0, 1)]
    assert counts(outcome(spark, checks, (30,), censor="skip")) == [(1, 1)]


def test_horizon_nobody_reached(spark):
    outcomes, horizons = outcome(spark, [("a", 0 * DAYS, True)], (30,))
    row = survival.survival(outcomes, horizons).first()
    assert (row.n, row.k, row.pct) == (0, 0, None)


def test_many_horizons(spark):
    """Fifty horizons against a plain search; a check makes rows for those it lies near only."""
    import random

    r = random.Random(4)
    second = dt.timedelta(seconds=1)
    checks = [(f"a{k % 9}", r.randrange(70 * 86400) * second, r.random() < 0.6) for k in range(300)]
    horizons = tuple(range(1, 51))
    outcomes, _ = outcome(spark, checks, horizons, tolerance=2)
    want = {}
    for name in {c[0] for c in checks}:
        own = [(at, live) for a, at, live in checks if a == name]
        anchor = min(at for at, live in own if live)
        for h in horizons:
            near = [(abs(at - anchor - h * DAYS), at, live) for at, live in own if at > anchor
                    and -2 * DAYS <= at - anchor - h * DAYS < 3 * DAYS]
            if near:
                want[name, h] = min(near)[2]
    assert {(x.agent_id, x.horizon_days): x.survived for x in outcomes.collect()} == want
    plan = outcomes._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode(filter(" in plan

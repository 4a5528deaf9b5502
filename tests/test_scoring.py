import random
from datetime import datetime, timedelta
from statistics import fmean, median, stdev

import pytest
from pyspark.sql import functions as F

from amperline.functions.numeric import severity, shown
from amperline.operators import gold, scoring
from amperline.plans import serving

START = datetime(2026, 7, 1)
MART = (
    "period timestamp, respondent string, respondent_name string, entity_type string, "
    "demand_mwh double, demand_forecast_mwh double, demand_forecast_error_pct double, "
    "net_generation_mwh double, total_interchange_mwh double, generation_demand_gap_mwh double, "
    "contains_replay boolean"
)


def series(name, kind, points):
    """Mart rows from (demand, signed error pct, gap) triples, one per hour."""
    return [
        (START + timedelta(hours=i), name, name.title(), kind, d,
         None if d is None else d * 0.98, e, None, None, g, i % 2 == 0)
        for i, (d, e, g) in enumerate(points)
    ]


def mart(spark, *rows):
    return spark.createDataFrame([row for part in rows for row in part], MART)


def steady(n, demand=lambda i: 1000.0):
    return [(demand(i), 1.0 + i % 3, 20.0 + 10 * (i % 3)) for i in range(n)]


AUTHORITY = "balancing_authority"


@pytest.fixture(scope="module")
def anomaly_rows(spark):
    return mart(
        spark,
        series("STABLE", AUTHORITY, steady(30) + [(1000.0, 2.0, 30.0)]),
        series("SPIKE", AUTHORITY, steady(30) + [(1000.0, -40.0, 800.0)]),
        series("SHORT", AUTHORITY, steady(5) + [(1000.0, 40.0, 800.0)]),
        series("AREA", "region", steady(30) + [(1000.0, 40.0, 800.0)]),
    )


def test_stable_and_spike(anomaly_rows):
    found = scoring.grid_anomalies(anomaly_rows).collect()
    assert [r.respondent for r in found] == ["SPIKE", "STABLE"]
    spike, stable = found
    assert (spike.risk_score, spike.severity) == (100.0, "CRITICAL")
    assert spike.forecast_deviation_score == spike.generation_deviation_score == 4.0
    assert spike.forecast_error_pct == -40.0
    assert (stable.risk_score, stable.severity) == (0.0, "NORMAL")
    assert (stable.forecast_baseline_pct, stable.generation_baseline_pct) == (2.0, 3.0)
    assert stable.history_points == 30


def test_limit(anomaly_rows):
    assert [r.respondent for r in serving.anomalies(anomaly_rows, 1).collect()] == ["SPIKE"]
    with pytest.raises(ValueError):
        serving.anomalies(anomaly_rows, 101)


@pytest.mark.parametrize(
    ("score", "label"),
    [(54.94, "NORMAL"), (54.96, "ELEVATED"), (74.9, "ELEVATED"), (75.0, "HIGH"), (89.9, "HIGH"),
     (90.0, "CRITICAL")],
)
def test_severity_cuts(spark, score, label):
    assert spark.range(1).select(severity(F.lit(score))).first()[0] == label


@pytest.mark.parametrize(
    ("value", "digits"), [(54.95, 1), (0.125, 2), (-2.5, 0), (9260761.405, 2)]
)
def test_shown_rounds_like_python(spark, value, digits):
    assert spark.range(1).select(shown(F.lit(value), digits)).first()[0] == round(value, digits)


def test_zero_mad_uses_stddev_and_zero_stddev_scores_nothing(spark):
    mostly_flat = [(1000.0, 2.0, 30.0)] * 28 + [(1000.0, 4.0, 30.0)] * 2
    rows = mart(
        spark,
        series("FALLBACK", AUTHORITY, [*mostly_flat, (1000.0, 5.0, 35.0)]),
        series("FLAT", AUTHORITY, [(1000.0, 0.1, 30.0)] * 30 + [(1000.0, 9.0, 30.0)]),
    )
    found = {r.respondent: r for r in scoring.grid_anomalies(rows).collect()}
    errors = [2.0] * 28 + [4.0] * 2
    wanted = min(4.0, abs(5.0 - fmean(errors)) / stdev(errors))
    assert found["FALLBACK"].forecast_deviation_score == round(wanted, 2)
    assert found["FALLBACK"].generation_deviation_score == 0.0
    assert found["FLAT"].forecast_deviation_score == 0.0


def test_regions_ranked_and_authorities_left_out(spark):
    load = steady(30, lambda i: 980.0 + 10 * (i % 5))
    rows = mart(
        spark,
        series("CALM", "region", [*load, (1000.0, 2.0, 30.0)]),
        series("SPIKE", "region", [*load, (1700.0, 30.0, 900.0)]),
        series("LOW", "region", [*load, (500.0, None, None)]),
        series("TVA", AUTHORITY, [*load, (5000.0, 90.0, 900.0)]),
    )
    found = {r.region: r for r in scoring.regional_signals(rows).collect()}
    assert list(found)[0] == "SPIKE" and "TVA" not in found
    spike = found["SPIKE"]
    assert (spike.pressure_score, spike.severity) == (100.0, "CRITICAL")
    assert spike.demand_vs_baseline_pct == 70.0
    assert spike.demand_change_pct == round((1700 - 1020) * 100 / 1020, 2)
    assert found["LOW"].demand_deviation_score == 0 and found["LOW"].pressure_score == 0
    peers = scoring.peer_regions(scoring.regional_signals(rows), "SPIKE").collect()
    assert "SPIKE" not in [r.region for r in peers]


def skewed_low():
    """Median 10 with MAD 0, mean far above: a value of 11 is under the mean."""
    return [(10.0, 1.0, 1.0)] * 28 + [(500.0, 1.0, 1.0)] * 3


def test_negative_fallback_stays_in_signals_and_is_clamped_in_the_timeline(spark):
    rows = mart(spark, series("A", "region", [*skewed_low(), (11.0, 1.0, 1.0)]))
    signal = scoring.regional_signals(rows).first()
    newest = scoring.regional_timeline(rows, 24).orderBy(F.col("period").desc()).first()
    demands = [d for d, _, _ in skewed_low()]
    assert signal.demand_deviation_score == round((11 - fmean(demands)) / stdev(demands), 2) < 0
    assert newest.demand_deviation_score == 0.0


def test_history(spark):
    rows = mart(
        spark,
        series("TEN", "region", [(1000.0 + 10 * i, 1.0, 5.0) for i in range(40)]),
        series("TVA", AUTHORITY, steady(40)),
    )
    found = scoring.regional_history(rows, " ten ", 24).collect()
    assert len(found) == 24 and [r.period for r in found] == sorted(r.period for r in found)
    last = found[-1]
    assert last.demand_baseline_mwh == median(1000.0 + 10 * i for i in range(39))
    assert last.demand_change_pct == pytest.approx(1000 / 1380)
    assert found[0].demand_change_pct is not None
    assert scoring.regional_history(rows, "TVA", 24).count() == 0
    assert scoring.regional_history(rows, "  ", 24).count() == 0
    whole = scoring.regional_history(rows, "TEN", 720).collect()
    assert whole[0].demand_baseline_mwh is None and whole[0].demand_change_pct is None
    summary = scoring.history_summary(scoring.regional_history(rows, "TEN", 24)).first()
    assert (summary.peak_demand_mwh, summary.minimum_demand_mwh) == (1390.0, 1160.0)
    assert summary.replay_points == 12


def robust(current, past, high=False):
    if current is None or len(past) < 24:
        return 0.0
    middle = median(past)
    if high and current <= middle:
        return 0.0
    sign = (lambda x: x) if high else abs
    mad = median(abs(v - middle) for v in past)
    if mad > 0:
        score = 0.6745 * sign(current - middle) / mad
    else:
        spread = stdev(past)
        score = sign(current - fmean(past)) / spread if spread > 0 else 0.0
    return min(4.0, max(0.0, score))


def test_timeline_has_no_look_ahead(spark):
    rng = random.Random(4)
    parts, wanted = [], {}
    for name, n in (("AA", 70), ("BB", 31), ("CC", 20)):
        points = [
            (rng.uniform(900, 1100), rng.choice([None, rng.uniform(-9, 9)]), rng.uniform(-90, 90))
            for _ in range(n)
        ]
        parts.append(series(name, "region", points))
        for i in range(max(24, n - 40), n):
            d, e, g = points[i]
            past = points[:i]
            errors = [abs(x) for _, x, _ in past if x is not None]
            gaps = [abs(y / x) * 100 for x, _, y in past]
            parts_of_score = (
                robust(d, [x for x, _, _ in past], True),
                robust(None if e is None else abs(e), errors),
                robust(abs(g / d) * 100, gaps),
            )
            wanted[name, START + timedelta(hours=i)] = (i, *parts_of_score)
    found = scoring.regional_timeline(mart(spark, *parts), 40).collect()
    assert {(r.region, r.period) for r in found} == set(wanted)
    assert [(r.period, r.region) for r in found] == sorted((r.period, r.region) for r in found)
    for r in found:
        points, *scores = wanted[r.region, r.period]
        assert r.history_points == points
        got = (r.demand_deviation_score, r.forecast_deviation_score, r.generation_deviation_score)
        assert got == pytest.approx(scores, abs=0.0051)
        total = 25 * (0.5 * scores[0] + 0.3 * scores[1] + 0.2 * scores[2])
        assert r.pressure_score == pytest.approx(min(100.0, total), abs=0.051)


def test_timeline_spike_and_frames(spark):
    load = [(1000.0 + i % 5, 1.0 + i % 3, 20.0 + 10 * (i % 3)) for i in range(40)]
    rows = mart(spark, series("SPIKE", "region", [*load, (1700.0, 30.0, 900.0)]))
    scored = scoring.regional_timeline(rows)
    found = scored.collect()
    assert found[0].history_points == 24 and len(found) == 17
    assert found[-1].severity == "CRITICAL" and found[-1].demand_deviation_score == 4.0
    assert scoring.timeline_periods(scored).count() == 17
    assert scoring.timeline_frame(scored, found[-1].period).count() == 1
    assert {r.severity for r in scoring.severity_counts(scored).collect()} >= {"CRITICAL"}


def test_grid_measures_feed_the_scores(spark):
    rows = spark.createDataFrame(
        [(START, 100.0, 80.0, None, None)],
        "period timestamp, demand_mwh double, demand_forecast_mwh double, "
        "net_generation_mwh double, total_interchange_mwh double",
    ).withColumns(gold.hourly_measures())
    assert rows.first().generation_demand_gap_mwh is None


def test_no_task_holds_a_whole_series(spark):
    """The history reaches the scores through counted bins, never a full window."""
    rows = mart(spark, series("A", "region", steady(60)))
    plan = scoring.regional_timeline(rows, 24)._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan and "collect_list(period" not in plan


def test_newest_rows_are_limited_before_the_shuffle(spark):
    rows = mart(spark, series("A", "region", steady(60)))
    rows.createOrReplaceTempView("rows_to_rank")
    ranked = spark.sql(
        "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY respondent "
        "ORDER BY period DESC, respondent_name DESC) AS recency FROM rows_to_rank) "
        "WHERE recency <= 721"
    )
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2

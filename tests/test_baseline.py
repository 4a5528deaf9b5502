import random
from statistics import fmean, median, stdev

import pytest
from pyspark.sql import functions as F

from amperline.operators import baseline


def brute(history, tail):
    """Baselines of each tail row from everything before it."""
    seen, out = list(history), []
    for value in tail:
        if seen:
            middle = median(seen)
            mad = median([abs(v - middle) for v in seen])
            sd = stdev(seen) if len(seen) > 1 else None
            out.append((len(seen), middle, mad, fmean(seen), sd))
        else:
            out.append((0, None, None, None, None))
        if value is not None:
            seen.append(value)
    return out


def run(spark, series, points):
    """``series`` maps a name to (history, tail)."""
    old = [(name, "c", v) for name, (history, _) in series.items() for v in history]
    new = [
        (name, "c", len(tail) - i, v)
        for name, (_, tail) in series.items()
        for i, v in enumerate(tail)
    ]
    history = spark.createDataFrame(old, "series string, component string, value double")
    scored = spark.createDataFrame(new, "series string, component string, recency int, value double")
    found = {
        (r.series, r.recency): (r.points, r.median, r.mad, r.mean, r.stddev)
        for r in baseline.baselines(scored, history.repartition(5), points).collect()
    }
    for name, (history_values, tail) in series.items():
        for i, wanted in enumerate(brute(history_values, tail)):
            got = found[name, len(tail) - i]
            assert got[0] == wanted[0], (name, i)
            for a, b in zip(got[1:], wanted[1:], strict=True):
                assert (a is None) == (b is None), (name, i, got, wanted)
                assert a is None or a == pytest.approx(b, rel=1e-9, abs=1e-9), (name, i)


def shapes(rng):
    return {
        "normal": ([rng.gauss(1000, 50) for _ in range(700)], [rng.gauss(1000, 80) for _ in range(9)]),
        "heavy": ([rng.paretovariate(0.7) for _ in range(501)], [1e9, 0.0, None, 3.0]),
        "signed": ([rng.uniform(-5, 5) for _ in range(300)], [rng.uniform(-9, 9) for _ in range(12)]),
        "ties": ([rng.choice([1.0, 2.0, 2.0, 7.5]) for _ in range(400)], [2.0, 2.0, 7.5, 1.0, 100.0]),
        "flat": ([0.1] * 333, [0.1, 0.1, 5.0]),
        "narrow": ([300 + rng.random() * 1e-6 for _ in range(600)], [300.0, 300.1]),
        "bimodal": (
            [rng.choice([1, 1000]) + rng.random() for _ in range(800)],
            [500.0] + [rng.random() for _ in range(11)],
        ),
        "short": ([1.0, 4.0], [9.0, 2.0, 2.0]),
        "one": ([3.0], [4.0]),
        "none": ([], [4.0, 6.0, 5.0]),
    }


@pytest.mark.parametrize(("seed", "points"), [(1, 12), (2, 12), (3, 12_000)])
def test_baselines_match_brute_force(spark, seed, points):
    run(spark, shapes(random.Random(seed)), points)


def test_bins_are_split_until_few_values_are_left(spark, monkeypatch):
    monkeypatch.setattr(baseline, "MAX_GATHERED_VALUES", 80)
    monkeypatch.setattr(baseline, "BINS_PER_LOG_UNIT", 2)
    monkeypatch.setattr(baseline, "SPLITS", 8)
    calls = []
    original = baseline._split
    monkeypatch.setattr(
        baseline, "_split", lambda *args: calls.append(1) or original(*args)
    )
    rng = random.Random(3)
    run(
        spark,
        {
            "a": ([rng.gauss(50, 3) for _ in range(3000)], [55.0, 40.0, 50.0]),
            "b": ([rng.expovariate(0.01) for _ in range(2000)], [1.0, 900.0]),
            "same": ([4.0] * 500, [4.0]),
        },
        3,
    )
    assert calls


def test_most_values_of_a_long_series_are_never_gathered(spark):
    rng = random.Random(5)
    values = [(rng.gauss(1000, 100),) for _ in range(20000)]
    history = spark.createDataFrame(values, "value double").withColumns(
        {"series": F.lit("s"), "component": F.lit("c")}
    )
    row = baseline.summarise_history(history, 24).first()
    assert row.n == 20000 and len(row["values"]) < 1000


def test_exact_median_with_a_hot_key(spark):
    rng = random.Random(11)
    rows = [("hot" if i % 3 else f"k{i % 7}", rng.random()) for i in range(4000)]
    frame = spark.createDataFrame(rows + [("hot", None)], "k string, v double")
    got = {r.k: (r.n, r.median) for r in baseline.exact_median(frame, "k", "v").collect()}
    for key in {k for k, _ in rows}:
        values = [v for k, v in rows if k == key]
        assert got[key] == (len(values), pytest.approx(median(values), rel=1e-12))

"""Per-type statistics, exact medians and z-score outliers."""

import random
import statistics

import pytest

from loamline.config import PipelineConfig
from loamline.operators import outliers, profiles
from tests.helpers import at, close, readings

CFG = PipelineConfig()


def pairs(spark, groups):
    rows = [(k, float(v) if v is not None else None) for k, vs in groups.items() for v in vs]
    return spark.createDataFrame(rows, "k string, v double")


def groups():
    rng = random.Random(3)
    return {
        "normal": [rng.gauss(0, 50) for _ in range(501)],
        "even": [rng.gauss(5, 1) for _ in range(400)],
        "wide": [10 ** rng.uniform(-8, 8) * rng.choice([-1, 1]) for _ in range(300)],
        "heavy": [7.25] * 200 + [rng.uniform(0, 100) for _ in range(150)],
        "one": [4.0],
        "two": [-3.0, 9.0],
        "zeros": [0.0, 0.0, -0.0, 1.0],
        "constant": [2.5] * 30,
        "holes": [1.0, None, 3.0, None],
        "huge": [1e300, -1e300, 5.0, float("inf"), 2.0],
    }


@pytest.mark.parametrize("direct", [10**6, 0])
def test_exact_medians(spark, monkeypatch, direct):
    monkeypatch.setattr(profiles, "DIRECT_VALUES", direct)
    data = groups()
    out = {r.k: r for r in profiles.group_profile(pairs(spark, data), "k", "v").collect()}
    for k, vs in data.items():
        vs = [v for v in vs if v is not None]
        assert out[k].n == len(vs)
        assert close(out[k].median, statistics.median(vs)), k


def test_moments(spark):
    data = {k: v for k, v in groups().items() if k != "huge"}
    out = {r.k: r for r in profiles.group_profile(pairs(spark, data), "k", "v").collect()}
    for k, vs in data.items():
        vs = [v for v in vs if v is not None]
        assert close(out[k].mean, statistics.fmean(vs), 1e-7)
        assert close(out[k].m2 / out[k].n, statistics.pvariance(vs), 1e-7)
        assert (out[k].min, out[k].max) == (min(vs), max(vs))


def test_log_bin_is_monotone(spark):
    rng = random.Random(5)
    values = sorted({s * 10 ** rng.uniform(-300, 300) for s in (-1, 1) for _ in range(300)} | {0.0, 5e-324, 1.7e308})
    df = spark.createDataFrame([(v,) for v in values], "v double")
    bins = [r[0] for r in df.select(profiles.log_bin(df.v)).collect()]
    assert bins == sorted(bins)


def sample(spark, count, spike=1000.0, kind="t"):
    rows = [("s", at(i), kind, 10.0 + i % 2, 90.0) for i in range(count - 1)]
    return readings(spark, rows + [("s", at(count), kind, spike, 90.0)])


def test_ten_rows_are_too_few_eleven_are_not(spark):
    # With n rows a lone spike has z = sqrt(n - 1): 3 at 10 rows, 3.16 at 11.
    for count, found in ((10, 0), (11, 1)):
        df = sample(spark, count)
        out = outliers.replace_outliers(df, outliers.type_moments(df), CFG)
        assert out.where("is_outlier").count() == found


def test_replacement_is_the_median_with_outliers(spark):
    df = sample(spark, 40)
    out = outliers.replace_outliers(df, outliers.type_moments(df), CFG)
    (r,) = out.where("is_outlier").collect()
    assert r.value == statistics.median([10.0 + i % 2 for i in range(39)] + [1000.0])
    assert r.source_value == 1000.0 and out.count() == 40


def test_constant_type_has_no_outliers(spark):
    df = readings(spark, [("s", at(i), "t", 5.0, 1.0) for i in range(20)])
    out = outliers.flag_outliers(df, outliers.type_moments(df), CFG)
    assert out.where("is_outlier").count() == 0
    assert out.where("is_outlier IS NULL").count() == 0


def test_approximate_moments(spark):
    df = sample(spark, 40)
    (r,) = outliers.type_moments(df, approx=True).collect()
    assert r.n == 40 and 10.0 <= r.median <= 11.0


def test_profile_columns(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 5), (4.0, 7)], "a double, b int")
    out = {r.column: r for r in profiles.profile_columns(df, ["a", "b", "absent"]).collect()}
    assert set(out) == {"a", "b"}
    assert (out["a"]["count"], out["a"].median, out["b"].median) == (3, 2.0, 6.0)
    assert out["b"].missing_count == 1 and close(out["b"].missing_pct, 100 / 3)
    assert close(out["a"].std, statistics.stdev([1, 2, 4]))
